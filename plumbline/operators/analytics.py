"""Project and user analytics: contributions, views, engagement, reach and scores side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.flags import FLAGS, with_flags
from plumbline.functions.numeric import exact_sum, ratio, round_n, stable_mean
from plumbline.functions.time import at, within
from plumbline.operators.leaderboard import user_weight
from plumbline.operators.metrics import first_contributions, of_project, own_posts, smart_reach
from plumbline.operators.ranks import numbered


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _sum(condition: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.coalesce(F.col(value), F.lit(0)).cast("long"))), F.lit(0).cast("long"))



def _kinds() -> tuple[Column, Column, Column, Column]:
    """Original post, pure quote, reply, and either of the first two."""
    post, quote, reply = F.col("is_post"), F.col("is_quote") & ~F.col("is_reply"), F.col("is_reply")
    return post, quote, reply, post | quote


def project_users(
    posts: DataFrame, users: DataFrame, engagement: DataFrame, features: DataFrame, scores: DataFrame, project: str, start: int, end: int, only: Sequence[str] | None = None
) -> DataFrame:
    """One row a user who posted in the project and range, with rank by influence score."""
    post, quote, reply, own = _kinds()
    filtered = posts.where(F.col("project_keyword") == project).where(within("post_created_at", start, end))
    if only:
        filtered = filtered.where(F.col("user_x_id").isin(list(only)))
    fe = features.where(F.col("project_keyword") == project).select(F.col("root_post_id").alias("post_id"), "duration_days_p90")
    # durations join once; a post has at most one feature row, so the sums keep their rows
    rows = filtered.join(fe, "post_id", "left")
    stats = rows.groupBy(F.col("user_x_id").alias("x_id")).agg(
        _sum(own, "favorite_count").alias("likes"), _sum(own, "retweet_count").alias("retweets"), _count(post).alias("post_count"), _count(quote).alias("quote_post_count"),
        _count(reply).alias("replies_count"), _sum(post, "view_count").alias("post_view_count"), _sum(quote, "view_count").alias("quote_view_count"), _sum(reply, "view_count").alias("replies_view_count"),
        F.avg(F.when(own, F.col("content_score").cast("double"))).alias("_content"), stable_mean(F.when(own, F.col("duration_days_p90"))).alias("_p90"),
    )
    named = users.select(F.col("x_id"), F.coalesce("x_username", F.lit("")).alias("x_username"), F.col("score").cast("double").alias("x_score"))
    stats = stats.join(named, "x_id", "left").withColumns({"x_score": F.coalesce("x_score", F.lit(0.0)), "x_username": F.coalesce("x_username", F.lit(""))})

    stream = engagement.where(F.col("project_keyword") == project).where("not is_root_reply and is_engaged_reply").where(within("root_tweet_created_at", start, end))
    stream = stream.where(within("engaged_tweet_created_at", start, end)).where(F.col("engaged_user_id") != F.col("root_user_id"))
    stream = stream.join(stats.select(F.col("x_id").alias("root_user_id")), "root_user_id", "left_semi")
    per_post = stream.groupBy("root_user_id", "root_post_id", "engaged_user_id").agg(F.max("engaged_user_score").alias("_s"), F.count(F.lit(1)).alias("_n"))
    pairs = per_post.groupBy("root_user_id", "engaged_user_id").agg(F.max("_s").alias("_s"), exact_sum("_s").alias("_reach"), F.sum("_n").alias("_n"))
    reach = pairs.groupBy(F.col("root_user_id").alias("x_id")).agg(
        F.count(F.lit(1)).alias("unique_engager"), exact_sum("_s").alias("unique_reach"), exact_sum("_reach").alias("reach"), F.sum("_n").alias("_received"),
        F.percentile("_s", 0.5).alias("_median"), (exact_sum("_s") / F.count("_s")).alias("_mean"),
    )
    valid = per_post.select(F.col("root_post_id").alias("post_id"), F.col("root_user_id").alias("x_id")).distinct()
    content = posts.where(F.col("project_keyword") == project).select("post_id", F.col("content_score").cast("double").alias("_c"))
    smart = smart_reach(scores.where(F.col("project_keyword") == project), start, end)
    points = valid.join(smart, "post_id").join(content, "post_id").withColumn("_points", round_n(F.col("smart_reach") * (F.coalesce("_c", F.lit(100.0)) / 100.0), 4))
    points = points.groupBy("x_id").agg(exact_sum("smart_reach").alias("smart_reach"), F.sum(F.col("_points").cast("decimal(20,4)")).cast("double").alias("_points"))

    full = stats.join(reach, "x_id", "left").join(points, "x_id", "left")
    received, weight = F.coalesce("_received", F.lit(0)), user_weight("x_score")
    score = F.coalesce("_points", F.lit(0.0)) + (F.col("post_count") + F.col("quote_post_count")) * weight + F.col("replies_count") * weight / 100.0
    full = full.select(
        "x_id", "x_username", "x_score", (F.col("likes") + F.col("retweets") + received).alias("engagements"), "likes", received.alias("replies"), "retweets",
        F.coalesce(ratio(F.col("likes"), received, 2), F.lit(0.0)).alias("like_to_reply_ratio"), "post_count", "quote_post_count", "replies_count", "post_view_count",
        "quote_view_count", "replies_view_count", F.coalesce("unique_engager", F.lit(0)).alias("unique_engager"), round_n("_median", 2).alias("median_unique_engagers_score"),
        round_n("_mean", 2).alias("average_unique_engagers_score"), "unique_reach", "reach", F.coalesce("smart_reach", F.lit(0.0)).alias("smart_reach"),
        round_n("_content", 2).alias("average_content_score"), round_n("_p90", 2).alias("average_p90"), round_n(score, 3).alias("influence_score"),
    )
    return numbered(full, [F.desc("influence_score"), F.col("x_id")])


def sort_value(key: str) -> Column:
    """The order of users that a sort key names; an unknown key means posts."""
    c = F.col
    return {
        "MOST_VIEWS": c("post_view_count") + c("quote_view_count"), "UNIQUE_ENGAGERS": c("unique_engager"), "UNIQUE_REACH": c("unique_reach"), "REACH": c("reach"),
        "ENGAGEMENTS": c("engagements") + c("replies"), "INFLUENCE_SCORE": c("influence_score"), "SMART_REACH": c("smart_reach"),
    }.get(key, c("post_count") + c("quote_post_count"))


def project_totals(posts: DataFrame, users: DataFrame, project: str, start: int, end: int, only: Sequence[str] | None = None) -> DataFrame:
    """One row: posters, contributions and views of the project in the range, and the posters' added scores."""
    post, quote, reply, _ = _kinds()
    filtered = posts.where(F.col("project_keyword") == project).where(within("post_created_at", start, end))
    if only:
        filtered = filtered.where(F.col("user_x_id").isin(list(only)))
    by_user = filtered.groupBy("user_x_id").agg(
        _count(post).alias("a"), _count(quote).alias("b"), _count(reply).alias("c"), _sum(post, "view_count").alias("d"), _sum(quote, "view_count").alias("e"), _sum(reply, "view_count").alias("f")
    )
    scored = by_user.join(users.select(F.col("x_id").alias("user_x_id"), "score"), "user_x_id", "left")
    names = {"a": "total_post_count", "b": "total_quote_post_count", "c": "total_replies_count", "d": "total_post_view_count", "e": "total_quote_post_view_count", "f": "total_replies_view_count"}
    sums = [F.coalesce(F.sum(k), F.lit(0)).alias(v) for k, v in names.items()]
    out = scored.agg(F.count("user_x_id").alias("total_unique_engaged_users"), *sums, F.coalesce(exact_sum("score"), F.lit(0.0)).alias("community_score"))
    return out.withColumn("total_view_count", F.col("total_post_view_count") + F.col("total_quote_post_view_count") + F.col("total_replies_view_count"))


SORT_KEYS = ("MOST_POSTS", "MOST_VIEWS", "UNIQUE_ENGAGERS", "UNIQUE_REACH", "REACH", "ENGAGEMENTS", "INFLUENCE_SCORE", "SMART_REACH")


def project_analytics(
    posts: DataFrame, users: DataFrame, engagement: DataFrame, features: DataFrame, scores: DataFrame, project: str, start: int, end: int, sort_keys: str | Sequence[str] = "MOST_POSTS",
    only: Sequence[str] | None = None, rows: int = 1100,
) -> DataFrame:
    """The totals with the first ``rows`` users as a JSON array, one row for each of ``sort_keys``; all come from one table."""
    sort_keys = (sort_keys,) if isinstance(sort_keys, str) else sort_keys
    table = project_users(posts, users, engagement, features, scores, project, start, end, only)
    c = F.col
    item = F.struct(
        "x_id", "x_username", "x_score", "engagements", "likes", "replies", "retweets", "like_to_reply_ratio", F.struct("post_count", "quote_post_count", "replies_count").alias("contributions"),
        F.struct(c("post_view_count"), c("quote_view_count").alias("quote_post_view_count"), c("replies_view_count")).alias("views"), c("unique_engager").alias("unique_engagers_count"),
        "median_unique_engagers_score", "average_unique_engagers_score", "average_content_score", "average_p90", "unique_reach", "reach", "smart_reach", "influence_score", "rank",
    )
    by = F.array(*[F.struct(F.lit(k).alias("sort_key"), sort_value(k).cast("double").alias("value")) for k in sort_keys])
    listed = table.select(item.alias("i"), c("rank").alias("r"), F.inline(by))
    place = F.row_number().over(Window.partitionBy("sort_key").orderBy(F.desc_nulls_last("value"), "r"))
    top = listed.withColumn("p", place).where(c("p") <= rows)  # each task keeps its first rows only, before they are put together
    lists = top.groupBy("sort_key").agg(F.array_sort(F.collect_list(F.struct("p", "i"))).alias("l"))  # bounded lists
    lists = lists.select("sort_key", F.to_json(F.transform("l", lambda x: x["i"]), {"ignoreNullFields": "false"}).alias("json"))
    keys = posts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(k) for k in sort_keys])).alias("sort_key"))
    full = keys.join(lists, "sort_key", "left").select("sort_key", F.coalesce("json", F.lit("[]")).alias("project_analytics"))
    return project_totals(posts, users, project, start, end, only).crossJoin(F.broadcast(full))  # one row, and one for each key


def project_user_posts(posts: DataFrame, users: DataFrame, engagement: DataFrame, features: DataFrame, scores: DataFrame, user: str, project: str, start: int, end: int) -> DataFrame:
    """A user's own posts in a project, those without engagement too, with ratios, features and flags."""
    own = own_posts(posts.where((F.col("user_x_id") == user) & (F.col("project_keyword") == project)), start, end)
    own = own.select("post_id", F.col("user_x_id").alias("handle"), F.col("full_text").alias("content"), F.col("content_score").cast("double").alias("content_score"), "view_count", "favorite_count")
    rows = engagement.where((F.col("project_keyword") == project) & (F.col("root_user_id") == user)).where("is_engaged_reply").where(within("engaged_tweet_created_at", start, end)).where(F.col("engaged_user_id") != user)
    pairs = rows.groupBy(F.col("root_post_id").alias("post_id"), "engaged_user_id").agg(F.max("engaged_user_score").alias("_s"), F.count(F.lit(1)).alias("_n"))
    per_post = pairs.groupBy("post_id").agg(F.count(F.lit(1)).alias("unique_engagers"), exact_sum("_s").alias("post_unique_reach"), F.sum("_n").alias("total_replies"))
    smart = smart_reach(of_project(scores, project).where(F.col("original_author_x_id") == user), start, end)
    ec = features.where((F.col("project_keyword") == project) & (F.col("root_user_id") == user)).select(F.col("root_post_id").alias("post_id"), "burst_concentration", "duration_days_p90", "cross_post_overlap", "coordinated_burst")
    named = users.where(F.col("x_id") == user).select(F.col("x_id").alias("handle"), F.col("x_username").alias("username"), F.col("score").cast("double").alias("_author"))
    full = own.join(per_post, "post_id", "left").join(smart, "post_id", "left").join(ec, "post_id", "left").join(named, "handle", "left")
    full = full.withColumns(
        {
            "unique_engagers": F.coalesce("unique_engagers", F.lit(0)), "total_replies": F.coalesce("total_replies", F.lit(0)),
            "total_impressions": F.coalesce("view_count", F.lit(0)), "total_likes": F.coalesce("favorite_count", F.lit(0)),
        }
    )
    full = full.withColumns(
        {
            "like_reply_ratio": ratio(F.col("total_likes"), F.col("total_replies"), 2), "impression_to_unique_reach_ratio": ratio(F.col("view_count"), F.col("post_unique_reach"), 2),
            "unique_engager_scores_to_count_ratio": ratio(F.col("post_unique_reach"), F.col("unique_engagers"), 2),
        }
    )
    full = with_flags(full, "total_replies", "like_reply_ratio", "impression_to_unique_reach_ratio", "_author")
    keep = [
        "post_id", "handle", "username", "content", "content_score", "total_impressions", "total_likes", "total_replies", "unique_engagers", "post_unique_reach", "smart_reach", "like_reply_ratio",
        "impression_to_unique_reach_ratio", "unique_engager_scores_to_count_ratio", "burst_concentration", "duration_days_p90", "cross_post_overlap", "coordinated_burst", *FLAGS,
    ]
    return full.select(*keep).orderBy(F.desc_nulls_last("post_unique_reach"), "post_id")


def user_posts_analytics(user_posts: DataFrame, users: DataFrame, user_features: DataFrame, global_scores: DataFrame, user: str, start: int, end: int) -> DataFrame:
    """A user's root posts over the network, start included and end not, with reach, features and flags."""
    inside = (F.col("post_created_at") >= at(start)) & (F.col("post_created_at") < at(end))
    thread_root = (F.col("post_id") == F.col("root_post_id")) | F.col("root_post_id").isNull()
    kind = (
        F.when(F.col("retweeted_post_id").isNotNull(), "retweet")
        .when(F.col("replied_post_id").isNotNull() & F.col("quoted_post_id").isNotNull(), "quoted_reply")
        .when(F.col("replied_post_id").isNotNull(), "reply")
        .when(F.col("quoted_post_id").isNotNull(), "quote")
        .otherwise("post")
    )
    own = user_posts.where(F.col("user_x_id") == user).where(inside & thread_root).where("(is_post or is_quote) and not is_reply and not is_retweet")
    own = own.select(
        "post_id", F.col("user_x_id").alias("handle"), F.col("full_text").alias("content"), F.col("view_count").cast("long").alias("impressions"), F.col("favorite_count").alias("likes_count"),
        F.col("retweet_count").alias("retweets_count"), F.col("quote_count").alias("quotes_count"), kind.alias("post_type"),
    )
    replies = user_posts.where(inside).where("replied_post_id is not null").select(F.col("replied_post_id").alias("post_id"), F.col("user_x_id").alias("engaged_user_id"))
    scored = replies.join(own.select("post_id"), "post_id", "left_semi").join(users.select(F.col("x_id").alias("engaged_user_id"), F.col("score").cast("double").alias("_s")), "engaged_user_id", "left")
    other = F.col("engaged_user_id") != user
    pairs = scored.groupBy("post_id", "engaged_user_id").agg(F.count(F.lit(1)).alias("_n"), F.max(F.coalesce("_s", F.lit(0.0))).alias("_s"))
    per_post = pairs.groupBy("post_id").agg(
        _sum(other, "_n").alias("replies_count"), _sum(~other, "_n").alias("self_replies_count"), _count(other).alias("unique_engagers"),
        exact_sum(F.when(other, F.col("_s") * F.col("_n"))).alias("reach"), exact_sum(F.when(other, F.col("_s"))).alias("unique_reach"),
    )
    smart = global_scores.where(F.col("original_author_x_id") == user).where(inside)
    ec = user_features.where(F.col("root_user_id") == user).select(F.col("root_post_id").alias("post_id"), "burst_concentration", "duration_days_p90", "cross_post_overlap", "coordinated_burst")
    named = users.where(F.col("x_id") == user).select(F.col("x_id").alias("handle"), F.col("x_username").alias("username"), F.col("score").cast("double").alias("_author"))
    full = own.join(per_post, "post_id", "left").join(smart_reach(smart), "post_id", "left").join(ec, "post_id", "left").join(named, "handle", "left")
    zeros = {c: F.coalesce(c, F.lit(0)) for c in ("replies_count", "self_replies_count", "unique_engagers")}
    zeros |= {c: F.coalesce(c, F.lit(0.0)) for c in ("reach", "unique_reach", "smart_reach")}
    full = full.withColumns(zeros)
    full = full.withColumns(
        {
            "engagements": F.col("likes_count") + F.col("replies_count") + F.col("retweets_count"), "like_reply_ratio": ratio(F.col("likes_count"), F.col("replies_count"), 2),
            "impression_to_unique_reach_ratio": ratio(F.col("impressions"), F.col("unique_reach"), 4), "unique_engager_scores_to_count_ratio": ratio(F.col("unique_reach"), F.col("unique_engagers"), 2),
        }
    )
    full = with_flags(full, "replies_count", "like_reply_ratio", "impression_to_unique_reach_ratio", "_author")
    keep = [
        "post_id", "handle", "username", "content", "likes_count", "replies_count", "quotes_count", "retweets_count", "impressions", "burst_concentration", "duration_days_p90", "cross_post_overlap",
        "coordinated_burst", "reach", "unique_reach", "engagements", "self_replies_count", "like_reply_ratio", "impression_to_unique_reach_ratio", "post_type", "smart_reach", "unique_engagers",
        "unique_engager_scores_to_count_ratio", *FLAGS,
    ]
    return full.select(*keep).orderBy(F.desc_nulls_last("unique_reach"), "post_id")


def _incoming(user_posts: DataFrame, users: DataFrame, targets: DataFrame) -> DataFrame:
    """Replies and quotes of ``targets`` (post_id, author_id), a row for each target that one replies to or quotes: two rows
    if these are two targets, one if they are the same. Two equi-joins in place of a join on either."""
    t = targets.select(F.col("post_id").alias("target_post_id"), "author_id")
    cols = ["post_id", "user_x_id", "replied_post_id", "quoted_post_id"]
    by_reply = user_posts.select(*cols).join(t, F.col("replied_post_id") == F.col("target_post_id"))
    quoting = user_posts.select(*cols).where("quoted_post_id is not null and (replied_post_id is null or replied_post_id <> quoted_post_id)")
    by_quote = quoting.join(t, F.col("quoted_post_id") == F.col("target_post_id"))
    both = by_reply.withColumn("_via", F.lit("reply")).unionByName(by_quote.withColumn("_via", F.lit("quote")))
    scores = users.select(F.col("x_id").alias("user_x_id"), F.col("score").cast("double").alias("_s"))
    return both.join(scores, "user_x_id", "left").select("post_id", F.col("user_x_id").alias("engaged_user_id"), "replied_post_id", "target_post_id", "author_id", "_via", F.coalesce("_s", F.lit(0.0)).alias("engaged_user_score"))


def all_users_analytics(user_posts: DataFrame, users: DataFrame, user_features: DataFrame, global_scores: DataFrame, limit_per_user: int | None = None) -> DataFrame:
    """One row an author of original posts or pure quotes, over all their posts or the latest ``limit_per_user``."""
    own = user_posts.where("(is_post or is_quote) and not is_reply and not is_retweet")
    if limit_per_user is not None:
        latest = Window.partitionBy("user_x_id").orderBy(F.desc("post_created_at"), "post_id")
        own = own.withColumn("_rn", F.row_number().over(latest)).where(F.col("_rn") <= limit_per_user)
    fe = user_features.select(F.col("root_post_id").alias("post_id"), "duration_days_p90")
    stats = own.join(fe, "post_id", "left").groupBy(F.col("user_x_id").alias("x_id")).agg(
        _sum(F.col("is_post"), "view_count").alias("total_post_view_count"), _sum(F.col("is_quote"), "view_count").alias("total_quote_post_view_count"),
        _count(F.col("is_post")).alias("total_post_count"), _count(F.col("is_quote")).alias("total_quote_post_count"), _sum(F.lit(True), "favorite_count").alias("likes"),
        _sum(F.lit(True), "retweet_count").alias("retweets"), F.min("post_created_at").alias("first_post_date"), F.max("post_created_at").alias("last_post_date"), round_n(stable_mean("duration_days_p90"), 2).alias("average_p90"),
    )
    came = _incoming(user_posts, users, own.select("post_id", F.col("user_x_id").alias("author_id")))
    self_ = F.col("engaged_user_id") == F.col("author_id")
    per_post = came.groupBy("author_id", "target_post_id", "engaged_user_id").agg(F.max("engaged_user_score").alias("_s"), F.count(F.lit(1)).alias("_n"))
    pairs = per_post.groupBy("author_id", "engaged_user_id").agg(F.max("_s").alias("_s"), exact_sum("_s").alias("_reach"), F.sum("_n").alias("_n"))
    score = F.when(~self_, F.col("_s"))
    agg = pairs.groupBy(F.col("author_id").alias("x_id")).agg(
        _sum(~self_, "_n").alias("replies"), _sum(self_, "_n").alias("self_replies"), _count(~self_).alias("unique_engagers_count"), exact_sum(F.when(~self_, F.col("_reach"))).alias("reach"),
        exact_sum(score).alias("unique_reach"), F.percentile(score, 0.5).alias("_median"), (exact_sum(score) / F.count(score)).alias("_mean"),
    )
    valid = per_post.where(~self_).select(F.col("target_post_id").alias("original_post_id"), F.col("author_id").alias("x_id")).distinct()
    smart = first_contributions(global_scores).join(valid, "original_post_id").groupBy("x_id").agg(exact_sum("contribution_score").alias("smart_reach"))
    named = users.select("x_id", "x_username", F.col("score").cast("double").alias("x_score"))
    full = stats.join(agg, "x_id", "left").join(smart, "x_id", "left").join(named, "x_id", "left")
    n = F.coalesce("replies", F.lit(0))
    return full.select(
        "x_id", F.coalesce("x_username", F.lit("")).alias("x_username"), F.coalesce("x_score", F.lit(0.0)).alias("x_score"), F.coalesce("unique_engagers_count", F.lit(0)).alias("total_unique_engaged_users"),
        "total_post_count", "total_quote_post_count", "total_post_view_count", "total_quote_post_view_count", (F.col("total_post_view_count") + F.col("total_quote_post_view_count")).alias("total_view_count"),
        (F.col("likes") + F.col("retweets") + n).alias("engagements"), "likes", n.alias("replies"), "retweets", F.coalesce(ratio(F.col("likes"), n, 2), F.lit(0.0)).alias("like_to_reply_ratio"),
        F.coalesce("reach", F.lit(0.0)).alias("reach"), F.coalesce("unique_reach", F.lit(0.0)).alias("unique_reach"), "average_p90", "first_post_date", "last_post_date",
        F.coalesce("self_replies", F.lit(0)).alias("self_replies"), F.coalesce("smart_reach", F.lit(0.0)).alias("smart_reach"), F.coalesce("unique_engagers_count", F.lit(0)).alias("unique_engagers_count"),
        round_n(F.coalesce("_median", F.lit(0.0)), 2).alias("median_unique_engagers_score"), round_n(F.coalesce("_mean", F.lit(0.0)), 2).alias("average_unique_engagers_score"),
    )


def user_analytics(user_posts: DataFrame, users: DataFrame, user_features: DataFrame, user: str, limit: int | None = None) -> DataFrame:
    """One row: a user's latest ``limit`` own posts (default all) and what came back. No row without a post.

    An engagement that replies elsewhere and quotes one of the posts counts, under the post that it replies to.
    """
    own = own_posts(user_posts.where(F.col("user_x_id") == user))
    if limit is not None:
        own = own.orderBy(F.desc("post_created_at"), "post_id").limit(limit)
    post, quote, _, _ = _kinds()
    fe = user_features.where(F.col("root_user_id") == user).select(F.col("root_post_id").alias("post_id"), "duration_days_p90")
    stats = own.join(fe, "post_id", "left").groupBy(F.col("user_x_id").alias("x_id")).agg(
        _count(post).alias("total_post_count"), _count(quote).alias("total_quote_post_count"), _sum(post, "view_count").alias("total_post_view_count"), _sum(quote, "view_count").alias("total_quote_post_view_count"),
        _sum(F.lit(True), "favorite_count").alias("likes"), _sum(F.lit(True), "retweet_count").alias("retweets"), F.min("post_created_at").alias("first_post_date"), F.max("post_created_at").alias("last_post_date"),
        round_n(stable_mean("duration_days_p90"), 2).alias("average_p90"),
    )
    came = _incoming(user_posts, users, own.select("post_id", F.col("user_x_id").alias("author_id"))).withColumn("target", F.coalesce("replied_post_id", "target_post_id"))
    # a post that replies to one target and quotes another is one engagement
    came = came.groupBy("post_id", "engaged_user_id", "target").agg(F.max("engaged_user_score").alias("_s"))
    mine = F.col("engaged_user_id") == user
    per_post = came.groupBy("target", "engaged_user_id").agg(F.max("_s").alias("_s"), F.count(F.lit(1)).alias("_n"))
    pairs = per_post.groupBy("engaged_user_id").agg(F.max("_s").alias("_s"), exact_sum("_s").alias("_reach"), F.sum("_n").alias("_n"))
    back = pairs.agg(
        _count(~mine).alias("total_unique_engaged_users"), _sum(~mine, "_n").alias("replies"), _sum(mine, "_n").alias("self_replies"),
        F.coalesce(exact_sum(F.when(~mine, F.col("_reach"))), F.lit(0.0)).alias("reach"), F.coalesce(exact_sum(F.when(~mine, F.col("_s"))), F.lit(0.0)).alias("unique_reach"),
    )
    named = users.where(F.col("x_id") == user).select("x_id", "x_username", F.col("score").cast("double").alias("x_score"))
    full = stats.crossJoin(F.broadcast(back)).join(named, "x_id", "left")  # one row each
    return full.select(
        "total_unique_engaged_users", "total_post_count", "total_quote_post_count", "total_post_view_count", "total_quote_post_view_count",
        (F.col("total_post_view_count") + F.col("total_quote_post_view_count")).alias("total_view_count"), "x_id", F.coalesce("x_username", F.lit("")).alias("x_username"), F.coalesce("x_score", F.lit(0.0)).alias("x_score"),
        (F.col("likes") + F.col("retweets") + F.col("replies")).alias("engagements"), "likes", "replies", "retweets", F.coalesce(ratio(F.col("likes"), F.col("replies"), 2), F.lit(0.0)).alias("like_to_reply_ratio"),
        "reach", "unique_reach", "first_post_date", "last_post_date", "self_replies", "average_p90",
    )


def engagement_quality(nucleus_posts: DataFrame, users: DataFrame, ids: Sequence[str], latest: int = 50) -> DataFrame:
    """Flag counts over each listed user's latest posts; users without posts stay with zeros. Of several versions of
    a post the latest update counts, one without a time being the latest; of equals the one seen and liked most."""

    def newest(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc_nulls_first("updated_at"), F.desc("created_at"), F.desc("view_count"), F.desc("favorite_count"))
        return rows.withColumn("_v", F.row_number().over(order)).where("_v = 1").drop("_v")

    ids = list(ids)
    own = newest(own_posts(nucleus_posts.where(F.col("user_x_id").isin(ids))).where("is_reply_fetched"), "post_id", "user_x_id")
    recent = Window.partitionBy("user_x_id").orderBy(F.desc("post_created_at"), "post_id")
    own = own.withColumn("_rn", F.row_number().over(recent)).where(F.col("_rn") <= latest)
    own = own.select(F.col("post_id").alias("root_post_id"), F.col("user_x_id").alias("handle"), F.col("favorite_count").alias("total_likes"), "view_count")
    engaged = nucleus_posts.where("replied_post_id is not null").join(own.select(F.col("root_post_id").alias("replied_post_id")), "replied_post_id", "left_semi")
    engaged = newest(engaged, "post_id").select(F.col("replied_post_id").alias("root_post_id"), F.col("user_x_id").alias("engaged_user_id"), F.col("is_reply").alias("_reply"))
    scored = engaged.join(users.select(F.col("x_id").alias("engaged_user_id"), F.col("score").cast("double").alias("_s")), "engaged_user_id", "left")
    met = own.join(scored, "root_post_id").where(F.col("engaged_user_id") != F.col("handle"))
    pairs = met.groupBy("root_post_id", "handle", "engaged_user_id").agg(F.max("_s").alias("_s"), _count(F.col("_reply")).alias("_n"))
    reach = pairs.groupBy("handle", "engaged_user_id").agg(F.max("_s").alias("_s")).groupBy("handle").agg(exact_sum("_s").alias("unique_reach"))
    per_post = pairs.groupBy("root_post_id").agg(F.coalesce(exact_sum("_s"), F.lit(0.0)).alias("post_unique_reach"), F.sum("_n").alias("total_replies"))
    rows = own.join(per_post, "root_post_id", "left")
    rows = rows.withColumns({"like_reply_ratio": ratio(F.col("total_likes"), F.col("total_replies"), 2), "impression_to_unique_reach_ratio": ratio(F.col("view_count"), F.col("post_unique_reach"), 2)})
    listed = users.where(F.col("x_id").isin(ids)).select(F.col("x_id").alias("handle"), F.coalesce("x_username", F.lit("")).alias("username"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    rows = with_flags(rows.join(listed.select("handle", "score"), "handle", "left"), "total_replies", "like_reply_ratio", "impression_to_unique_reach_ratio", "score")
    like_farm, like_bot, view_farm, view_bot = (F.col(f) for f in FLAGS)
    counts = rows.groupBy("handle").agg(_count(like_farm | view_farm).alias("engagement_flag_count"), _count(like_bot | view_bot).alias("botting_flag_count"), F.count(F.lit(1)).alias("total_posts"))
    full = listed.join(counts, "handle", "left").join(reach, "handle", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("engagement_flag_count", "botting_flag_count", "total_posts")} | {"unique_reach": F.coalesce("unique_reach", F.lit(0.0))}
    return full.withColumns(zero).select("handle", "username", "score", "unique_reach", "engagement_flag_count", "botting_flag_count", "total_posts")


def posts_of(tables: dict[str, DataFrame], ids: Sequence[str], projects: DataFrame | None = None, project: str | None = None, table: str | None = None, as_of: Column | None = None) -> DataFrame:
    """Listed users' own posts from ``project_post`` (the default), ``user_post`` or ``nucleus_post``, latest first.

    With a project its dates restrict the range (those over 0), and its keyword the rows of tables that have one.
    status says whether a project post is two days old on ``as_of`` (default today). Another table name: no rows.
    """
    name = table or "project_post"
    rows = tables.get(name)
    empty = rows is None
    if empty:
        rows = next(iter(tables.values())).limit(0)
    rows = rows.where(F.col("user_x_id").isin(list(ids))).where("not is_reply and not is_retweet")
    if project is not None:
        span = projects.where(F.col("project_name") == project).select("start_ts", "end_ts").first() if projects is not None else None
        if span is not None:
            rows = rows.where(within("post_created_at", span["start_ts"] if (span["start_ts"] or 0) > 0 else None, span["end_ts"] if (span["end_ts"] or 0) > 0 else None))
        if name != "user_post":
            rows = rows.where(F.col("project_keyword") == project)
    kind = F.when(F.col("is_post"), "post").when(F.col("is_quote") & ~F.col("is_reply"), "quote").when(F.col("is_reply"), "reply")
    age = F.datediff(F.current_date() if as_of is None else as_of, F.col("created_at").cast("date"))
    status = F.when(age >= 2, "tracked").otherwise("Under Review") if name == "project_post" else F.lit(None).cast("string")
    keyword = F.lit(None).cast("string") if name == "user_post" else F.col("project_keyword")
    return rows.select(
        "post_id", "user_x_id", keyword.alias("project_keyword"), F.lit(name).alias("source_table"), "favorite_count", "view_count", "post_created_at", "is_post", "is_quote", "is_reply", "updated_at",
        kind.alias("post_type"), status.alias("status"),
    ).orderBy(F.desc("post_created_at"), "post_id")


def latest_per_user(posts: DataFrame, n: int = 100) -> DataFrame:
    """Each user's latest ``n`` posts."""
    order = Window.partitionBy("user_x_id").orderBy(F.desc("post_created_at"), "post_id")
    return posts.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n)
