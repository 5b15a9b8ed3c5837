import json

import pytest
from helpers import at, post, tables, user

from plumbline.operators import analytics, leaderboard, metrics
from plumbline.operators.decay import decay_scores
from plumbline.operators.engagement import engagement, user_engagement
from plumbline.operators.features import features
from plumbline.plans.refresh import difference, refresh_features

EPOCH = int((at(0) - at(0).__class__(1970, 1, 1)).total_seconds())


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_a_reply_that_quotes_counts_for_what_it_replies_to(spark):
    posts, users = tables(spark, [post("x", "a", 0), post("y", "b", 0), post("r", "c", 1, replied="x", quoted="y")], [user("c", 5)])
    found = {r["root_post_id"]: r["engaged_tweet_id"] for r in engagement(posts, users).collect()}
    assert found == {"x": "r", "y": None, "r": None}


def test_projects_dont_mix(spark):
    posts, users = tables(spark, [post("x", "a", 0), post("r", "c", 1, replied="x", project="other")], [user("c", 5)])
    assert all(r["engaged_tweet_id"] is None for r in engagement(posts, users).collect())


def test_unknown_engagers_score_nothing_or_null(spark):
    posts, users = tables(spark, [post("x", "a", 0), post("r", "c", 1, replied="x"), post("s", "d", 1, retweeted="x")], [user("z", 5)])
    assert [r["engaged_user_score"] for r in engagement(posts, users).where("engaged_tweet_id = 'r'").collect()] == [None]
    assert [r["engaged_user_score"] for r in user_engagement(posts, users).collect()] == [0.0, 0.0]


def test_a_root_without_engagement_has_a_row_and_a_score(spark):
    posts, users = tables(spark, [post("x", "a", 0), post("y", "a", 1)], [user("a", 5)])
    found = {r["root_post_id"]: r for r in features(engagement(posts, users)).collect()}
    assert (found["x"]["total_engagements"], found["x"]["burst_concentration"], found["x"]["farming_score"]) == (1, 1.0, 25.0)
    assert found["y"]["farming_score"] == 50.0
    hourly = {r["root_post_id"]: r["farming_score"] for r in features(engagement(posts, users), burst="hour").collect()}
    assert hourly == {"x": 0.0, "y": 25.0}


def test_burst_bounds(spark):
    hour = 1 / 24
    rows = [post("x", "a", 0), *[post(f"r{k}", f"u{k}", 1 + d, replied="x") for k, d in enumerate([0, hour, hour * 2.5])]]
    posts, users = tables(spark, rows, [user("a", 5)])
    assert one(features(engagement(posts, users)).where("root_post_id = 'x'"))["burst_concentration"] == pytest.approx(2 / 3)
    assert one(features(user_engagement(posts, users), burst="59:59").where("root_post_id = 'x'"))["burst_concentration"] == pytest.approx(1 / 3)


def test_recurring_audience(spark):
    rows = [post(f"x{k}", "a", k) for k in range(4)] + [post(f"r{k}", "fan", k + 0.5, replied=f"x{k}") for k in range(4)]
    posts, users = tables(spark, rows, [user("a", 5)])
    found = {r["root_post_id"]: r for r in features(user_engagement(posts, users), burst="59:59", distinct_participants=True, prev_overlap=True).collect()}
    assert [found[f"x{k}"]["cross_post_overlap"] for k in range(4)] == [0, 100, 100, 100]
    assert [found[f"x{k}"]["prev_post_overlap"] for k in range(4)] == [0, 100, 100, 100]
    assert {f["coordinated_burst"] for f in found.values()} == {1.0}


def test_feature_refresh_equals_a_full_build(spark):
    import random

    rng = random.Random(3)
    rows = [post(f"x{k}", f"a{k % 4}", k) for k in range(20)] + [post(f"r{k}", f"u{rng.randrange(6)}", rng.uniform(0, 60), replied=f"x{rng.randrange(20)}") for k in range(150)]
    posts, users = tables(spark, rows, [user("a1", 5)])
    full = user_engagement(posts, users)
    early = features(full.where(full.engaged_tweet_created_at <= at(30)))
    assert difference(refresh_features(full, early, at(30)), features(full)).isEmpty()


def board(spark, **how):
    rows = [post(f"x{k}", "a", k * 0.1, content=80) for k in range(4)] + [post(f"r{k}", f"u{k}", 1, replied=f"x{k}") for k in range(4)] + [post("n", "noname", 0), post("b", "boss", 0)]
    posts, users = tables(spark, rows, [user("a", 10), user("boss", 9, name="p"), *[user(f"u{k}", 100 * (k + 1)) for k in range(4)]])
    scores = decay_scores(posts, users)
    found = leaderboard.leaderboard(engagement(posts, users), posts, users, scores, "p", EPOCH - 10, EPOCH + 86400 * 9, **how).collect()
    return {r["x_user_id"]: r for r in found}


def test_the_best_posts_survive_the_cap(spark):
    found = board(spark, cap=leaderboard.Cap(2, "week", None))
    assert found["a"]["influence_score"] == (400 + 300) * 0.8 + 2 * 10
    assert "boss" not in found and "noname" not in found


def test_no_cap_and_lists(spark):
    found = board(spark, cap=leaderboard.Cap(0, "none", None), only=["a", "u0"], exclude=["u0"])
    assert list(found) == ["a"] and found["a"]["influence_score"] == 1000 * 0.8 + 40 and found["a"]["influence_percent"] == 100.0


def test_cap_rows_with_defaults(spark):
    schema = "project_keyword string, leaderboard_type string, post_cap int, cap_period string, cap_start_date timestamp_ntz, project_start_date timestamp_ntz"
    caps = spark.createDataFrame([("p", "global", None, "day", None, at(1)), ("p", "private", 0, None, at(2), at(1))], schema)
    assert leaderboard.cap_of(caps, "p") == leaderboard.Cap(5, "day", at(1))
    assert leaderboard.cap_of(caps, "p", "private") == leaderboard.Cap(0, "week", at(2))
    assert leaderboard.cap_of(caps, "q") == leaderboard.Cap()


def test_flags_of_a_post(spark):
    rows = [post("x", "a", 0, likes=10, views=10), *[post(f"r{k}", f"u{k}", 1, replied="x") for k in range(12)]]
    posts, users = tables(spark, rows, [user("a", 10), *[user(f"u{k}", 5) for k in range(12)]])
    scores = decay_scores(posts, users)
    r = one(metrics.post_metrics(engagement(posts, users), posts, users, scores, "p", EPOCH - 10, EPOCH + 86400 * 9))
    assert (r["total_replies"], r["post_unique_reach"], r["smart_reach"], r["like_reply_ratio"]) == (12, 60.0, 60.0, 0.83)
    assert r["like_reply_engagement_farming_flag"] and r["impression_unique_reach_engagement_farming_flag"] and not r["like_reply_botting_flag"]


def test_analytics_json_lists_the_users_in_order(spark):
    rows = [post("x", "a", 0), post("y", "b", 0), post("r", "c", 1, replied="x")]
    posts, users = tables(spark, rows, [user("a", 10), user("c", 5)])
    eng, scores = engagement(posts, users), decay_scores(posts, users)
    r = one(analytics.project_analytics(posts, users, eng, features(eng), scores, "p", EPOCH - 10, EPOCH + 86400 * 9, "REACH"))
    listed = json.loads(r["project_analytics"])
    assert [u["x_id"] for u in listed][0] == "a" and len(listed) == 3 and listed[0]["contributions"] == {"post_count": 1, "quote_post_count": 0, "replies_count": 0}
    assert (r["total_post_count"], r["total_replies_count"], r["community_score"]) == (2, 1, 15.0)


def test_posts_of_an_unknown_table_are_none(spark):
    posts, _ = tables(spark, [post("x", "a", 0)], [user("a", 1)])
    assert analytics.posts_of({"project_post": posts}, ["a"], table="else").isEmpty()
    assert one(analytics.posts_of({"project_post": posts}, ["a"]))["status"] == "tracked"


def test_posts_without_engagement_are_each_others_audience_or_not(spark):
    posts, users = tables(spark, [post("x", "a", 0), post("y", "a", 1)], [user("a", 5)])
    found = {r["root_post_id"]: r["cross_post_overlap"] for r in features(engagement(posts, users), unknown_return=False).collect()}
    assert found == {"x": 0.0, "y": 0.0}
