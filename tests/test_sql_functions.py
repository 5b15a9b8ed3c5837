"""Every SQL table function against its Python query, over stored layers of the smallest tables."""

import math
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plumbline.operators import analytics, features, leaderboard, metrics
from plumbline.plans import catalog, registry
from plumbline.plans.lineage import Lineage, materialise

SMALL = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="no test tables")

P, S, E, NS, NE = registry.PROJECT, registry.START, registry.END, registry.NET_START, registry.NET_END
WS, WE = registry.WIDE_START, registry.WIDE_END
IDS, USERS = registry.LISTED, registry.NET_USERS
USER, NET_USER, POST = "u92", "u7", "o297"  # some that have rows in these tables
CAPS = [(P, "global", 2, "month", registry.ANCHOR, None), (P, "private", None, "day", None, datetime(1995, 1, 1)), ("AUTOMOBILE", "global", 0, None, None, None)]


def sql_list(values):
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    lazy = Lineage.of_sample(spark, str(SMALL))
    stored = materialise(lazy, str(tmp_path_factory.mktemp("layers")))
    for name in ("users", "posts", "user_posts", "nucleus_posts"):
        path = str(tmp_path_factory.mktemp(name))
        getattr(lazy, name).write.mode("overwrite").parquet(path)
        setattr(stored, name, spark.read.parquet(path))
    caps = spark.createDataFrame(CAPS, catalog.CAPS)
    projects = spark.createDataFrame([(P, S, E), ("MACHINERY", 0, None)], catalog.PROJECTS)
    catalog.register(spark, stored, caps, projects)
    stored.caps, stored.projects = caps, projects
    return stored


def clustered(t, *args, **how):
    return features.clustering(*args, **how).drop("project_keyword", "prev_post_overlap")  # which the functions leave out


def board(t, project, kind="global", exclude=None, only=None):
    return leaderboard.leaderboard(t.engagement, t.posts, t.users, t.scores, project, S, E, leaderboard.cap_of(t.caps, project, kind), exclude, only)


def users_of(t, only=None):
    return analytics.project_users(t.posts, t.users, t.engagement, t.features, t.scores, P, S, E, only)


def analytics_of(t, key, only=None):
    return analytics.project_analytics(t.posts, t.users, t.engagement, t.features, t.scores, P, S, E, key, only)


def listed(t, **how):
    return analytics.posts_of({"project_post": t.posts, "user_post": t.user_posts, "nucleus_post": t.nucleus_posts}, IDS, t.projects, as_of=F.lit(registry.AS_OF).cast("date"), **how)


def quality(t):
    return analytics.engagement_quality(t.nucleus_posts, t.users, USERS)


SOME = [f"u{k}" for k in range(60)]
EARLY = S + 86400 * 365
CASES = {
    f"engagement_clustering({S}, {EARLY}, '{P}')": lambda t: clustered(t, t.features.where(F.col("project_keyword") == P), S, EARLY),
    f"user_post_engagement_clustering('{NET_USER}')": lambda t: clustered(t, t.user_features, user=NET_USER),
    f"user_post_engagement_clustering(start_ts => {NS}, end_ts => {NE})": lambda t: clustered(t, t.user_features, NS, NE),
    f"post_level_metrics({S}, {E}, '{P}')": lambda t: metrics.post_metrics(t.engagement, t.posts, t.users, t.scores, P, S, E),
    f"single_post_smart_reach('{POST}', '{P}')": lambda t: metrics.single_post_smart_reach(t.engagement, t.posts, t.users, t.scores, P, POST),
    f"single_post_smart_reach('{POST}', '{P}', {S}, {E})": lambda t: metrics.single_post_smart_reach(t.engagement, t.posts, t.users, t.scores, P, POST, S, E),
    f"post_engagement_ratios({S}, {E}, '{P}')": lambda t: metrics.post_engagement_ratios(t.engagement, t.posts, P, S, E),
    f"account_level_metrics({WS}, {WE}, '{P}')": lambda t: metrics.account_metrics(t.engagement, t.posts, t.user_posts, t.users, t.scores, P, WS, WE),
    f"account_keyword_unique_reach_ratio({WS}, {WE}, '{P}')": lambda t: metrics.account_keyword_reach_ratio(t.engagement, t.user_posts, t.users, P, WS, WE),
    f"unique_reach_increase({S}, {E}, '{P}')": lambda t: metrics.unique_reach_increase(t.engagement, t.posts, t.users, P, S, E),
    f"unique_reach_increase_flags({S}, {E}, '{P}')": lambda t: metrics.reach_increase_flags(metrics.unique_reach_increase(t.engagement, t.posts, t.users, P, S, E)),
    f"global_unique_reach_increase({NS}, {NE})": lambda t: metrics.global_unique_reach_increase(t.user_posts, t.users, NS, NE),
    f"global_unique_reach_increase_flags({NS}, {NE})": lambda t: metrics.reach_increase_flags(metrics.global_unique_reach_increase(t.user_posts, t.users, NS, NE)),
    f"global_post_level_metrics({NS}, {NE})": lambda t: metrics.global_post_metrics(t.user_posts, t.users, t.global_scores, NS, NE),
    f"global_account_level_metrics({NS}, {NE})": lambda t: metrics.global_account_metrics(t.user_posts, t.users, t.global_scores, NS, NE),
    f"global_post_engagement_ratios({NS}, {NE})": lambda t: metrics.global_post_engagement_ratios(t.user_posts, t.users, NS, NE),
    f"leaderboard({S}, {E}, '{P}')": lambda t: board(t, P),
    f"leaderboard({S}, {E}, 'AUTOMOBILE')": lambda t: board(t, "AUTOMOBILE"),
    f"leaderboard({S}, {E}, 'MACHINERY')": lambda t: board(t, "MACHINERY"),
    f"private_leaderboard({S}, {E}, '{P}')": lambda t: board(t, P, "private"),
    f"private_leaderboard({S}, {E}, '{P}', array(), {sql_list(SOME)})": lambda t: board(t, P, "private", [], SOME),
    f"private_leaderboard({S}, {E}, '{P}', exclude => {sql_list(SOME)})": lambda t: board(t, P, "private", SOME),
    f"project_users({S}, {E}, '{P}')": lambda t: users_of(t),
    f"project_totals({S}, {E}, '{P}')": lambda t: analytics.project_totals(t.posts, t.users, P, S, E),
    f"project_analytics({S}, {E}, '{P}', 'SMART_REACH')": lambda t: analytics_of(t, "SMART_REACH"),
    f"project_analytics({S}, {E}, '{P}', only => {sql_list(SOME)})": lambda t: analytics_of(t, "MOST_POSTS", SOME),
    f"project_user_posts('{USER}', {S}, {E}, '{P}')": lambda t: analytics.project_user_posts(t.posts, t.users, t.engagement, t.features, t.scores, USER, P, S, E),
    f"user_posts_analytics('{NET_USER}', {NS}, {NE})": lambda t: analytics.user_posts_analytics(t.user_posts, t.users, t.user_features, t.global_scores, NET_USER, NS, NE),
    "all_users_analytics()": lambda t: analytics.all_users_analytics(t.user_posts, t.users, t.user_features, t.global_scores),
    "all_users_analytics(2)": lambda t: analytics.all_users_analytics(t.user_posts, t.users, t.user_features, t.global_scores, 2),
    f"user_analytics('{NET_USER}', 20)": lambda t: analytics.user_analytics(t.user_posts, t.users, t.user_features, NET_USER, 20),
    f"user_analytics('{NET_USER}')": lambda t: analytics.user_analytics(t.user_posts, t.users, t.user_features, NET_USER),
    f"user_engagement_quality({sql_list(USERS)})": quality,
    f"posts_from_users({sql_list(IDS)}, '{P}', as_of => date '{registry.AS_OF}')": lambda t: listed(t, project=P),
    f"posts_from_users({sql_list(IDS)}, 'MACHINERY', as_of => date '{registry.AS_OF}')": lambda t: listed(t, project="MACHINERY"),
    f"posts_from_users({sql_list(IDS)}, source => 'user_post', as_of => date '{registry.AS_OF}')": lambda t: listed(t, table="user_post"),
    f"posts_from_users({sql_list(IDS)}, source => 'nucleus_post', as_of => date '{registry.AS_OF}')": lambda t: listed(t, table="nucleus_post"),
    f"posts_from_users({sql_list(IDS)}, source => 'elsewhere', as_of => date '{registry.AS_OF}')": lambda t: listed(t, table="elsewhere"),
}


#: No source is called so.
NO_ROWS = f"posts_from_users({sql_list(IDS)}, source => 'elsewhere'"


def same(a, b):
    a, b = (float(v) if isinstance(v, Decimal) else v for v in (a, b))
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("call", list(CASES))
def test_function_equals_its_query(spark, layers, call):
    want = CASES[call](layers)
    got = spark.sql(f"select * from {call}")
    if "sort_key" not in want.columns:
        got = got.drop("sort_key")
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    key = lambda r: [(v is None, f"{v:.6f}" if isinstance(v, float) else str(v)) for v in r]
    a, b = (sorted((tuple(r) for r in df.select(*columns).collect()), key=key) for df in (got, want))
    assert len(a) == len(b) and (bool(a) != call.startswith(NO_ROWS))
    for x, y in zip(a, b, strict=True):
        assert all(map(same, x, y)), (dict(zip(columns, x, strict=True)), dict(zip(columns, y, strict=True)))


def test_arguments_reach_the_scans(spark, layers):
    plan = spark.sql(f"select * from post_level_metrics({S}, {E}, '{P}')")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "PartitionFilters: [" in line]
    projects = [line for line in scans if "/engagement" in line or "/scores" in line]
    assert projects and all("PartitionFilters: [isnotnull(project_keyword" in line for line in projects)
    assert "CartesianProduct" not in plan
