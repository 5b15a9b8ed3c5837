import json

import pytest
from helpers import DAY0, at, post, tables, user
from pyspark.sql import functions as F

from plumbline import cli
from plumbline.operators.decay import decay_scores, reply_source
from plumbline.plans.refresh import difference
from plumbline.plans.runner import ScoreRunner, run_all
from plumbline.sources.store import SinkError, VersionedTable, reconcile, write_parts
from plumbline.streaming.scores import burst_stream, score_stream


def network(spark):
    rows = [post(f"root{k}", f"a{k}", -1) for k in range(4)]
    rows += [post(f"q{k:03}", f"u{k % 3}", k * 0.7, replied=f"root{k * 5 % 4}", ingest=k * 0.7 + k % 9) for k in range(90)]
    return tables(spark, rows, [user(f"u{k}", 20 + k) for k in range(3)])


def test_incremental_runs_keep_state_and_equal_a_full_build(spark, tmp_path):
    posts, users = network(spark)
    runner = ScoreRunner(spark, str(tmp_path), "project")
    first = runner.incremental(posts.where(posts.created_at <= at(30)), users)
    assert runner.log.status(first)["phase"] == "full"
    second = runner.incremental(posts, users)
    assert runner.log.status(second)["status"] == "done" and runner.table.state()["dirty"] == 3
    assert difference(runner.table.read(), decay_scores(posts, users)).isEmpty()
    third = runner.incremental(posts, users)
    assert runner.table.state()["run_id"] == second and runner.log.status(third)["message"] == "0 repliers"


@pytest.mark.parametrize("scope", ["project", "global"])
def test_a_refresh_writes_only_the_parts_that_change(spark, tmp_path, scope):
    posts, users = network(spark)
    late = post("late", "u0", 61.5, replied="root1", ingest=90)
    earlier = post("early", "u1", 35.5, replied="root2", ingest=91)
    runner = ScoreRunner(spark, str(tmp_path), scope)
    runner.full(posts, users)
    first = runner.table.state()
    posts = posts.unionByName(tables(spark, [late], [])[0])
    runner.incremental(posts, users)
    second = runner.table.state()
    new = [p for p, v in second["places"].items() if v != first["places"].get(p)]
    assert len(new) == 1 and new[0].startswith("202408-") and second["rows"] == 91
    assert difference(runner.table.read(), decay_scores(posts, users, scope)).isEmpty()
    posts = posts.unionByName(tables(spark, [earlier], [])[0])
    runner.incremental(posts, users)
    third = runner.table.state()
    assert all(v == second["places"][p] for p, v in third["places"].items() if p.startswith("202406-"))
    assert difference(runner.table.read(), decay_scores(posts, users, scope)).isEmpty() and third["rows"] == 92
    runner.table.clear(keep=1)  # versions that hold parts of the latest stay
    assert runner.table.read().count() == 92
    # seen again without a change: the watermark moves, nothing is written
    again = posts.withColumn("updated_at", F.when(F.col("post_id") == "late", F.lit(at(95))).otherwise(F.col("updated_at")))
    runner.incremental(again, users)
    assert runner.table.state()["places"] == third["places"] and runner.table.state()["since"] == at(95)


def test_tables_without_rows_are_published_and_read(spark, tmp_path):
    posts, users = network(spark)
    runner = ScoreRunner(spark, str(tmp_path))
    runner.full(posts.where("false"), users)
    assert runner.table.read().count() == 0 and runner.table.state()["rows"] == 0
    with pytest.raises(SinkError):  # rows outside the parts that they are said to be
        runner.table.publish(decay_scores(posts, users), None, None, "x", 1, after=runner.table.state()["version"], parts=["202406-0"])


def test_a_failed_run_moves_no_watermark(spark, tmp_path):
    posts, users = network(spark)
    runner = ScoreRunner(spark, str(tmp_path), "global")
    runner.full(posts, users)
    before = runner.table.state()
    outcome = run_all({"broken": lambda: runner.full(posts.drop("post_created_at"), users), "fine": lambda: None})
    assert outcome["broken"].startswith("failed") and outcome["fine"] == "done"
    assert runner.table.state() == before


def test_write_once_runs_keep_rows(spark, tmp_path):
    posts, users = network(spark)
    runner = ScoreRunner(spark, str(tmp_path))
    runner.append(posts.where(posts.created_at <= at(30)), users)
    old = runner.table.read()
    runner.append(posts, users)
    new = runner.table.read()
    assert old.exceptAll(new).isEmpty() and new.count() == 90


def test_parts_are_checked(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    path = str(tmp_path / "t")
    with pytest.raises(SinkError):
        write_parts(df, path, source=path)
    assert write_parts(df, path, by=["p"]) == 2
    with pytest.raises(Exception, match="(?i)exist"):
        write_parts(df, path)
    assert write_parts(df.where("p = 'a'").selectExpr("n + 9 as n", "p"), path, overwrite=True, by=["p"]) == 1
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [2, 10]


def test_columns_are_reconciled(spark):
    df = spark.createDataFrame([(1, "x")], "b int, extra string")
    wanted = spark.createDataFrame([], "a string, b long").schema
    assert reconcile(df, wanted).collect()[0].asDict() == {"a": None, "b": 1}
    wanted["a"].nullable = False
    with pytest.raises(SinkError):
        reconcile(df, wanted)


def test_command_line(spark, tmp_path, capsys):
    posts, users = network(spark)
    posts.write.parquet(str(tmp_path / "posts"))
    users.write.parquet(str(tmp_path / "users"))
    args = ["--posts", str(tmp_path / "posts"), "--users", str(tmp_path / "users"), "--out", str(tmp_path / "out")]
    assert cli.main(["full", *args, "--summary", str(tmp_path / "s.json")]) == 0
    assert json.loads((tmp_path / "s.json").read_text())["scopes"] == {"project": "done"}
    assert cli.main(["inspect", *args]) == 0 and "LOCAL_DECAY" in capsys.readouterr().out


def stream_of(spark, df, path, parts):
    for k, cond in enumerate(parts):
        df.where(cond).coalesce(1).write.parquet(f"{path}/in/{k}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{path}/in")


def finish(df, path, name):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


@pytest.mark.parametrize("scope", ["project", "global"])
def test_a_stream_in_time_order_scores_like_a_batch(spark, tmp_path, scope):
    rows = [post(f"root{k}", f"a{k}", -1) for k in range(4)] + [post(f"q{k:03}", f"u{k % 3}", k * 0.7, replied=f"root{k * 5 % 4}") for k in range(90)]
    posts, users = tables(spark, rows, [user(f"u{k}", 20 + k) for k in range(3)])
    source = reply_source(posts, users, scope)
    cut = at(25)
    stream = stream_of(spark, source, str(tmp_path), [source.post_created_at <= cut, source.post_created_at > cut])
    got = {r["reply_post_id"]: (r["contribution_score"], r["decay_type"], r["reply_number"]) for r in finish(score_stream(stream, scope), str(tmp_path), f"scores_{scope}").collect()}
    want = {r["reply_post_id"]: (r["contribution_score"], r["decay_type"], r["reply_number"]) for r in decay_scores(posts, users, scope).collect()}
    assert got == want


def test_entries_of_a_silent_replier_go_and_its_number_stays(spark, tmp_path):
    roots = [post(f"root{k}", f"a{k}", -1) for k in range(3)]
    rows = [post("s1", "silent", 1, replied="root0"), post("s2", "silent", 2, replied="root0"), post("l1", "loud", 2, replied="root1")]
    rows += [post("l2", "loud", 40, replied="root2"), post("l3", "loud", 41, replied="root1"), post("s3", "silent", 60, replied="root0")]
    posts, users = tables(spark, roots + rows, [user("silent", 50), user("loud", 70)])
    source = reply_source(posts, users)
    t = source.post_created_at
    early = stream_of(spark, source, str(tmp_path), [t <= at(3), (t > at(3)) & (t < at(40.5)), (t > at(40.5)) & (t < at(50))])

    def run(stream):
        out = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True)
        out.start().awaitTermination()

    run(score_stream(early))

    def held(name):
        found = spark.read.format("statestore").option("path", f"{tmp_path}/state").option("stateVarName", name).load()
        return sorted({r["key"]["replier_x_id"] for r in found.collect()})

    assert held("entries") == ["loud"] and held("number") == ["loud", "silent"]
    source.where(t > at(50)).coalesce(1).write.parquet(f"{tmp_path}/in/9")
    last = spark.readStream.schema(source.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    run(score_stream(last))
    got = {r["reply_post_id"]: (r["contribution_score"], r["decay_type"], r["reply_number"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {r["reply_post_id"]: (r["contribution_score"], r["decay_type"], r["reply_number"]) for r in decay_scores(posts, users).collect()}
    assert got == want and want["s3"][1:] == ("FIRST_REPLY", 3)


def test_bursts_are_sent_when_the_hour_is_over(spark, tmp_path):
    rows = [("x", at(0)), ("x", at(0.01)), ("x", at(0.5)), ("y", at(3))]
    df = spark.createDataFrame(rows, "root_post_id string, engaged_tweet_created_at timestamp_ntz")
    stream = stream_of(spark, df, str(tmp_path), ["engaged_tweet_created_at < timestamp_ntz '2024-06-02 00:00:00'", "engaged_tweet_created_at >= timestamp_ntz '2024-06-02 00:00:00'"])
    got = {(r["root_post_id"], r["hour_start"].hour): r["engagements"] for r in finish(burst_stream(stream), str(tmp_path), "bursts").collect()}
    assert got == {("x", DAY0.hour): 2, ("x", 12): 1}


@pytest.mark.parametrize("share", [0.5, 0.95])
def test_carving_by_ingest_and_refreshing_equals_a_full_build(spark, share):
    from plumbline.plans.refresh import carve_point, refresh_scores

    posts, users = network(spark)
    when = carve_point(posts, share)
    early = posts.where(posts.created_at <= when)
    assert share * posts.count() <= early.count() < posts.count()
    assert difference(refresh_scores(posts, users, decay_scores(early, users), when), decay_scores(posts, users)).isEmpty()


def test_a_run_on_an_old_version_publishes_nothing(spark, tmp_path):
    posts, users = network(spark)
    runner = ScoreRunner(spark, str(tmp_path))
    runner.full(posts, users)
    now = runner.table.state()
    with pytest.raises(SinkError):
        runner.table.publish(decay_scores(posts, users), None, None, "late", 0, after="older")
    assert runner.table.state() == now


def test_of_two_runs_from_one_version_one_publishes(spark, tmp_path, monkeypatch):
    posts, users = network(spark)
    one, two = (VersionedTable(spark, str(tmp_path), "P") for _ in range(2))
    scores = decay_scores(posts, users)
    one.publish(scores, None, None, "first", None)
    start = one.state()
    assert one.publish(scores, None, None, "a", 1, after=start["version"]) == 90
    monkeypatch.setattr(two, "state", lambda real=two.state, seen=[start]: seen.pop() if seen else real())  # it looked before the other one published
    with pytest.raises(SinkError):
        two.publish(scores, None, None, "b", 1, after=start["version"])
    assert one.state()["version"] == "p-a" and one.state()["number"] == 1
    (tmp_path / "state/p/00000002.json").write_text('{"scope": "P", "vers')  # a run ended while it was writing
    assert one.state()["version"] == "p-a"
    one.publish(scores, None, None, "c", 1, after="p-a")
    assert (one.state()["version"], one.state()["number"]) == ("p-c", 3)
    assert one.clear(keep=1) == ["p-a", "p-b", "p-first"] and one.read().count() == 90


def test_a_job_over_its_time_is_cancelled(spark):
    slow = lambda: spark.range(0, 10**12, 1, 4).selectExpr("sum(id % 7)").collect()
    out = run_all({"slow": slow, "quick": lambda: spark.range(3).count()}, spark, timeout=3)
    assert out["slow"].startswith("failed") and out["quick"] == "done"


def test_sql_views_and_table_functions(spark):
    from plumbline.plans.catalog import register
    from plumbline.plans.lineage import Lineage

    posts, users = network(spark)
    t = Lineage({"users": users, "posts": posts, "user_posts": posts, "nucleus_posts": posts}.__getitem__)
    register(spark, t)
    start, end = 1717113600, 1735689600
    got = spark.sql(f"select root_post_id from engagement_clustering({start}, {end}, 'p')")
    assert got.count() == t.features.where("root_tweet_created_at >= timestamp_ntz '2024-05-31 00:00:00'").count()
    assert spark.sql("select * from user_post_engagement_clustering('a1')").count() == 1
    assert spark.sql("select count(*) as n from contribution_scores").first()["n"] == 90


def test_stored_layers_give_the_same_answers_and_prune_projects(spark, tmp_path):
    from plumbline.operators import leaderboard
    from plumbline.plans.lineage import STORED, Lineage, materialise

    posts, users = network(spark)
    lazy = Lineage({"users": users, "posts": posts, "user_posts": posts, "nucleus_posts": posts}.__getitem__)
    stored = materialise(lazy, str(tmp_path))
    for layer in STORED:
        assert difference(getattr(stored, layer), getattr(lazy, layer)).isEmpty(), layer
    args = ("p", 1717113600, 1735689600)
    boards = [leaderboard.leaderboard(t.engagement, t.posts, t.users, t.scores, *args) for t in (lazy, stored)]
    assert [r for r in boards[0].collect()] == [r for r in boards[1].collect()]
    plan = stored.features.where("project_keyword = 'p'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(project_keyword" in plan
