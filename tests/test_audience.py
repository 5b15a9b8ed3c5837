import os

import pytest
from helpers import post, tables, user
from pyspark.sql import functions as F

from plumbline.operators import features
from plumbline.plans.lineage import Lineage
from plumbline.plans.refresh import difference


def lineage(spark):
    rows = [post(f"r{k}", f"a{k % 3}", -1 - k // 2, project="pq"[k % 2]) for k in range(12)] + [post("rt", "a1", 1, retweeted="r0"), post("none", None, 1, replied="r1")]
    rows += [post(f"e{k}", f"u{k % 7}", k / 50, replied=f"r{k * k % 14}", project="pq"[k * k % 14 % 2]) for k in range(60)]
    posts, users = tables(spark, rows, [user(f"u{k}", k) for k in range(5)] + [user("a0", 1)])
    return Lineage({"posts": posts, "users": users}.__getitem__)


@pytest.mark.parametrize("variant", [{}, {"burst": "hour"}, {"prev_overlap": True}, {"by_hour": True}])
def test_the_audience_gives_the_features_of_the_table(spark, variant):
    t = lineage(spark)
    assert "root_rank" in t.audience.columns and "engaged_user_score" not in t.audience.columns
    assert difference(features.features(t.audience, **variant), features.features(t.engagement, **variant)).isEmpty()


def test_an_authors_features_are_made_alone(spark):
    t = lineage(spark)
    own = t.features.where((F.col("project_keyword") == "p") & (F.col("root_user_id") == "a0"))
    assert own.count() == 2 and difference(t.features_of("p", "a0"), own).isEmpty()


def test_an_authors_engagement_is_made_alone(spark):
    """Replies by nobody known, by the author and to other projects' posts too; features of the same rows."""
    t = lineage(spark)
    for project, author in (("p", "a0"), ("q", "a1"), ("q", "u3"), ("p", "gone")):
        ours = (F.col("project_keyword") == project) & (F.col("root_user_id") == author)
        assert difference(t.engagement_of(project, author), t.engagement.where(ours)).isEmpty()
        assert difference(t.features_of(project, author), t.features.where(ours)).isEmpty()


def test_others_rows_are_left_out_where_they_are_read(spark):
    """Below the grouping of the sample's replies, so they aren't shuffled first."""
    small = "/root/testdata/sf0.001"
    if not os.path.isdir(small):
        pytest.skip("no test tables")
    plan = Lineage.of_sample(spark, small).engagement_of("BUILDING", "u1")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    grouped = [k for k, line in enumerate(plan) if "Aggregate" in line]
    assert any("LeftSemi" in line and any(g < k and all(d > depth[g] for d in depth[g + 1 : k + 1]) for g in grouped) for k, line in enumerate(plan))
