import random

import pytest
from helpers import at, post, tables, user
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators import engagement, features
from plumbline.plans.kept import VARIANTS, KeptEngagement
from plumbline.plans.refresh import difference
from plumbline.sources.ingest import IngestTable


def base(spark, root, keys):
    posts, users = tables(spark, [], [])
    return IngestTable(spark, f"{root}/posts", posts.schema, keys), IngestTable(spark, f"{root}/users", StructType([*users.schema.fields]).add("updated_at", "timestamp_ntz"), ["x_id"])


def arrive(spark, base, posts=(), users=(), day=0.0):
    p, u = tables(spark, list(posts), list(users))
    if posts:
        base[0].add(p)
    if users:
        base[1].add(u.withColumn("updated_at", F.lit(at(day)).cast("timestamp_ntz")))


def check(kept, base, scope):
    posts, users = base[0].since(None, None), base[1].since(None, None)
    engaged = (engagement.engagement if scope == "project" else engagement.user_engagement)(posts, users)
    assert difference(kept.engagement(), engaged).isEmpty()
    assert difference(kept.features(), features.features(engaged, **VARIANTS[scope])).isEmpty()


def test_an_empty_row_goes_and_comes_back(spark, tmp_path):
    b = base(spark, tmp_path / "base", ["project_keyword", "post_id"])
    kept = KeptEngagement(spark, str(tmp_path / "kept"), buckets=8)
    arrive(spark, b, [post(f"r{k}", f"a{k}", k) for k in range(6)] + [post("e0", "u0", 1.5, replied="r0", ingest=2)], [user(f"u{k}", k) for k in range(4)], day=2)
    assert kept.run(*b).dirty is None
    check(kept, b, "project")
    row = lambda: [(r["engaged_tweet_id"], r["engaged_user_score"]) for r in kept.engagement().where("root_post_id = 'r1'").collect()]
    assert row() == [(None, None)]
    arrive(spark, b, [post("e1", "u1", 2.5, replied="r1", ingest=10)])
    report = kept.run(*b)
    assert row() == [("e1", 1.0)] and report.dirty == 2 and len(report.parts_written["engagement"]) <= 2 and len(report.parts_read["engagement"]) <= 2
    check(kept, b, "project")
    arrive(spark, b, [post("e1", "u1", 2.5, replied="r2", ingest=11)])  # turns to another post
    kept.run(*b)
    assert row() == [(None, None)]
    check(kept, b, "project")
    number = kept.store.state().number
    assert kept.run(*b).dirty == 0 and kept.store.state().number == number  # nothing new: nothing is written
    arrive(spark, b, [post("e1", "u1", 2.5, replied="r2", views=12345, ingest=12)])
    report = kept.run(*b)
    assert report.dirty == 0 and not report.parts_written  # a view count is in neither table
    arrive(spark, b, [], [user("u1", 9), user("u0", 0)], day=13)
    kept.run(*b)
    check(kept, b, "project")
    marks = {r["project_keyword"]: r for r in kept.watermarks().collect()}
    assert marks["p"]["last_engaged_at"] == at(2.5) and marks["p"]["mode"] == "incremental"


@pytest.mark.parametrize("scope", ["project", "network"])
def test_random_streams_equal_a_rebuild(spark, tmp_path, scope):
    rng = random.Random(scope)
    b = base(spark, tmp_path / "base", ["project_keyword", "post_id"] if scope == "project" else ["post_id"])
    kept = KeptEngagement(spark, str(tmp_path / "kept"), scope, buckets=4)
    project: dict = {}
    for turn in range(3):
        rows = {}
        for _ in range(80 if turn == 0 else 15):
            k = rng.randrange(60)
            kind = rng.choice(["post", "reply", "quote", "both", "repost"])
            other = lambda: f"t{rng.randrange(60)}"
            links = {"post": {}, "reply": {"replied": other()}, "quote": {"quoted": other()}, "both": {"replied": other(), "quoted": other()}, "repost": {"retweeted": other()}}[kind]
            rows[k] = post(f"t{k}", f"u{rng.randrange(4)}", rng.choice([rng.uniform(0, 3), float(rng.randrange(3))]), **links, likes=rng.randrange(2), project=project.setdefault(k, rng.choice("pq")), ingest=100 + 10 * turn + rng.random())
        arrive(spark, b, list(rows.values()), [user(f"u{k}", rng.randrange(9), name=rng.choice("xyz")) for k in range(3) if turn == 0 or rng.random() < 0.3], day=100 + 10 * turn)
        kept.run(*b)
        check(kept, b, scope)


def test_only_the_columns_that_are_asked_for_are_read(spark, tmp_path):
    b = base(spark, tmp_path / "base", ["project_keyword", "post_id"])
    arrive(spark, b, [post("r0", "a0", 0, likes=1, ingest=1), post("r0", "a1", 0, likes=2, ingest=2)], [user("a0", 1)])
    rows = b[0].since(None, None, ["post_id", "user_x_id"])
    assert [tuple(r) for r in rows.collect()] == [("r0", "a1")]
    assert "full_text" not in rows._jdf.queryExecution().executedPlan().toString()
