"""What travels between tasks, and what a query's result must not depend on."""

import time
from pathlib import Path

import pytest
from helpers import post, tables, user
from pyspark.sql import functions as F

from plumbline.operators import engagement, features
from plumbline.plans import registry
from plumbline.plans.kept import KeptEngagement
from plumbline.plans.lineage import Lineage
from plumbline.plans.refresh import difference
from plumbline.sources.ingest import IngestTable
from plumbline.sources.versioned import Change, VersionedStore

SMALL = "/root/testdata/sf0.001"
sample = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are of tables that are too large to be sent to all tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def odd(spark):
    """Ids of two roots, rows without project, author, id or time, reposts that quote, replies to nobody."""
    rows = [post("r", "a", 0), post("r", "b", 0.5), post("s", "a", 1), post("n", None, 1), post(None, "a", 2), post("x", "c", 1, project=None), post("y", "c", 2, replied="x", project=None)]
    rows += [post(f"e{k}", f"u{k % 4}", 2 + k / 48, replied="rsnq"[k % 4]) for k in range(9)] + [post("rt", "a", 1, retweeted="s"), post("rq", "b", 3, retweeted="s", quoted="s"), post("q", "u1", 3, quoted="e0")]
    return tables(spark, rows, [user("a", 1), user("b", 2), user("u1", 3)])


def test_one_pass_gives_the_rows_of_the_table(spark):
    posts, users = odd(spark)
    found = engagement.crowd(posts)
    assert difference(found, engagement.engagement(posts, users).select(found.columns)).isEmpty()
    same = features.features(engagement.audience(posts, users), prev_overlap=True)
    assert difference(features.features(found, prev_overlap=True, names=users).select(same.columns), same).isEmpty()


def test_the_whole_table_is_the_join(spark):
    posts, users = odd(spark)
    assert difference(engagement.engagement_table(posts, users), engagement.engagement(posts, users)).isEmpty()


@sample
def test_the_whole_table_reads_lines_and_users_once(spark, no_broadcast):
    plan = physical(registry.QUERIES["engagement_project"](spark, SMALL))
    assert plan.count("/lineitem.parquet") == 1 and plan.count("hashpartitioning(user_x_id") == 2  # posts and users


@sample
def test_features_read_lines_once_and_move_rows_twice(spark, no_broadcast):
    """Lines meet their orders, rows go to a post, pairs to an author, where users come to them."""
    plan = physical(Lineage.of_sample(spark, SMALL).features)
    assert plan.count("/lineitem.parquet") == 1
    assert plan.count("hashpartitioning(project_keyword") == 1 and plan.count("hashpartitioning(root_user_id") == 2


@sample
def test_lines_travel_once_to_their_orders(spark, no_broadcast):
    posts = Lineage.of_sample(spark, SMALL).posts
    moves = [line for line in physical(posts.select("post_id")).splitlines() if "Exchange hashpartitioning" in line]
    assert sum("l_orderkey" in line for line in moves) == 1 and not any("l_partkey" in line for line in moves)


def test_rows_of_few_parts_are_written_where_they_lie(spark, tmp_path):
    rows = spark.range(0, 90, 1, 3)
    for name, few, files in (("near", ["t"], 3), ("far", [], 1)):
        store = VersionedStore(spark, str(tmp_path), name, {"t": F.lit("all")}, few)
        state = store.publish({"t": Change(rows, None)}, {}, "run", store.state())
        assert store.read("t", state).count() == 90 and len(list((tmp_path / name).rglob("*.zstd.parquet"))) == files
    assert KeptEngagement(spark, str(tmp_path), buckets=8).store.few and not KeptEngagement(spark, str(tmp_path)).store.few


def test_keys_of_versions_travel_once(spark, tmp_path):
    posts, _ = tables(spark, [post("r", "a", 0, ingest=1), post("r", "b", 0, ingest=2), post("s", "a", 1)], [])
    base = IngestTable(spark, str(tmp_path / "posts"), posts.schema, ["project_keyword", "post_id"])
    base.add(posts)
    found = base.since(None, None, ["user_x_id", "post_id"])
    assert sorted(map(tuple, found.collect())) == [("a", "s"), ("b", "r")]
    moves = [line for line in physical(found).splitlines() if "max_by" in line and "partial" in line]
    assert moves and all("post_id, post_id" not in line and "_k0" not in line for line in moves)
    assert base.since(None, None, ["post_id"]).count() == 2


@sample
@pytest.mark.parametrize("name", ["project_users", "project_analytics"])
def test_a_projects_posts_are_made_once(spark, name):
    """What is used several times lies in the shared folder."""
    assert "/lineitem.parquet" not in physical(registry.QUERIES[name](spark, SMALL))


@sample
def test_the_ledger_cut_is_not_moved_by_the_zone_of_the_process(spark, monkeypatch):
    def scores():
        return registry.QUERIES["decay_ledger"](spark, SMALL).agg(F.count(F.lit(1)), F.sum(F.xxhash64("reply_post_id", "contribution_score", "reply_number").cast("decimal(38,0)"))).first()

    want = scores()
    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        assert scores() == want
    finally:
        monkeypatch.undo()
        time.tzset()
