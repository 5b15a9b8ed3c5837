"""Engagement tables: every root post with the replies, quotes and reposts it got."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROOT = ["root_post_id", "root_user_id", "root_username", "root_tweet_created_at", "is_root_post", "is_root_quote", "is_root_reply", "root_favorite_count", "root_reply_count"]
ENGAGED = ["engaged_tweet_id", "engaged_user_id", "is_engaged_reply", "is_engaged_quote", "is_engaged_repost", "engaged_tweet_created_at"]


def with_flags(posts: DataFrame) -> DataFrame:
    """Posts with is_reply, is_quote, is_retweet and is_post derived from their links, whatever the input says."""
    links = {"is_reply": "replied_post_id", "is_quote": "quoted_post_id", "is_retweet": "retweeted_post_id"}
    flagged = posts.withColumns({flag: F.col(link).isNotNull() for flag, link in links.items()})
    return flagged.withColumn("is_post", ~(F.col("is_reply") | F.col("is_quote") | F.col("is_retweet")))


def _roots(posts: DataFrame, users: DataFrame, keys: list[str]) -> DataFrame:
    named = posts.join(users.select(F.col("x_id").alias("user_x_id"), F.col("x_username").alias("root_username")), "user_x_id", "left")
    return named.select(
        *keys, F.col("post_id").alias("root_post_id"), F.col("user_x_id").alias("root_user_id"), "root_username",
        F.col("post_created_at").alias("root_tweet_created_at"), F.col("is_post").alias("is_root_post"), F.col("is_quote").alias("is_root_quote"),
        F.col("is_reply").alias("is_root_reply"), F.col("favorite_count").alias("root_favorite_count"), F.col("reply_count").alias("root_reply_count"),
    )


def _engaged(posts: DataFrame, keys: list[str], target) -> DataFrame:
    return posts.where(target.isNotNull()).select(
        *keys, target.alias("root_post_id"), F.col("post_id").alias("engaged_tweet_id"), F.col("user_x_id").alias("engaged_user_id"),
        F.col("is_reply").alias("is_engaged_reply"), F.col("is_quote").alias("is_engaged_quote"), F.col("is_retweet").alias("is_engaged_repost"),
        F.col("post_created_at").alias("engaged_tweet_created_at"),
    )


def _scored(found: DataFrame, users: DataFrame) -> DataFrame:
    return found.join(users.select(F.col("x_id").alias("engaged_user_id"), F.col("score").cast("double").alias("engaged_user_score")), "engaged_user_id", "left")


def _joined(posts: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Root posts of all projects and what came to a post."""
    keys = ["project_keyword"]
    posts = with_flags(posts)
    return _roots(posts.where("is_post or is_reply or is_quote"), users, keys), _engaged(posts, keys, F.coalesce("replied_post_id", "quoted_post_id"))


def engagement(posts: DataFrame, users: DataFrame) -> DataFrame:
    """All projects at once: replies and pure quotes of posts, quotes and replies of the same project; a post that
    nobody engaged with stands once, with nulls. A post that replies and quotes counts for what it replies to."""
    keys = ["project_keyword"]
    roots, engaged = _joined(posts, users)
    # one outer join gives the matches and the roots without any; an engager is matched to one root only
    return _scored(roots.join(engaged, [*keys, "root_post_id"], "left"), users).select(*keys, *ROOT, *ENGAGED, "engaged_user_score")


def audience(posts: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of ``engagement`` with what features are made of only, and ``root_rank``, a post's place among its author's in
    the project. Every root is in the table, so it is ranked before its engagements join it; scores of engagers aren't looked up."""
    keys = ["project_keyword"]
    roots, engaged = _joined(posts, users)
    place = F.dense_rank().over(Window.partitionBy(*keys, "root_user_id").orderBy("root_tweet_created_at", "root_post_id"))
    roots = roots.select(*keys, "root_post_id", "root_user_id", "root_username", "root_tweet_created_at", place.alias("root_rank"))
    return roots.join(engaged.select(*keys, "root_post_id", "engaged_user_id", "engaged_tweet_created_at"), [*keys, "root_post_id"], "left")


def _met(posts: DataFrame, keys: list[str], root: dict[str, Column], engaged: dict[str, Column]) -> DataFrame:
    """Root posts with what came to them, as a left join gives them, from one pass over ``posts``: a post goes to its own id with the
    columns ``root`` and to the id that it engages with with the columns ``engaged`` (of equal types, in their order; those whose name
    begins with ``_`` only fill a place), and the rows of an id meet in a window."""
    target = F.coalesce("replied_post_id", "quoted_post_id")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    filled = lambda values: [v.alias(f"_{k}") for k, v in enumerate(values)]
    own = F.when(F.col("is_post") | F.col("is_reply") | F.col("is_quote"), F.struct(F.col("post_id").alias("root_post_id"), F.lit(True).alias("_root"), *filled(root.values())))
    other = F.when(target.isNotNull() & known, F.struct(target.alias("root_post_id"), F.lit(False).alias("_root"), *filled(engaged.values())))
    laid = posts.select(*keys, F.inline(F.filter(F.array(own, other), lambda r: r.isNotNull())))
    by_id = Window.partitionBy(*keys, "root_post_id")
    values = [F.col(f"_{k}") for k in range(len(root))]
    laid = laid.withColumns({"_roots": F.collect_list(F.when(F.col("_root"), F.struct(*values))).over(by_id), "_came": F.count(F.when(~F.col("_root"), 1)).over(by_id)})
    # an id stands for one post; if it stands for several, each gets what came to the id
    named = lambda side: [(k, c) for k, c in enumerate(side) if not c.startswith("_")]
    pair = lambda r, of: F.struct(*[r[f"_{k}"].alias(c) for k, c in named(root)], *[of(k).alias(c) for k, c in named(engaged)])
    nothing = F.array(pair(F.struct(*values), lambda k: F.when(F.lit(False), values[k])))
    rows = F.when(~F.col("_root"), F.transform("_roots", lambda r: pair(r, lambda k: values[k]))).when(F.col("_came") == 0, nothing)
    return laid.select(*keys, "root_post_id", F.inline(rows))


def engagement_table(posts: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of ``engagement`` for the table as a whole: posts meet their users once, as roots and as engagers, and are read once. A
    filter on roots doesn't get below it, as it does in the join; one on projects does."""
    c, none = F.col, lambda of: F.when(F.lit(False), of)
    people = users.select(c("x_id").alias("user_x_id"), c("x_username").alias("_name"), c("score").cast("double").alias("_score"))
    known = with_flags(posts).join(people, "user_x_id", "left")
    root = {
        "root_user_id": c("user_x_id"), "root_username": c("_name"), "root_tweet_created_at": c("post_created_at"), "is_root_post": c("is_post"), "is_root_quote": c("is_quote"),
        "is_root_reply": c("is_reply"), "root_favorite_count": c("favorite_count"), "root_reply_count": c("reply_count"), "_score": none(c("_score")),
    }
    engaged = {
        "engaged_user_id": c("user_x_id"), "engaged_tweet_id": c("post_id"), "engaged_tweet_created_at": c("post_created_at"), "is_engaged_reply": c("is_reply"), "is_engaged_quote": c("is_quote"),
        "is_engaged_repost": c("is_retweet"), "_likes": none(c("favorite_count")), "_replies": none(c("reply_count")), "engaged_user_score": c("_score"),
    }
    return _met(known, ["project_keyword"], root, engaged).select("project_keyword", *ROOT, *ENGAGED, "engaged_user_score")


def crowd(posts: DataFrame) -> DataFrame:
    """The rows of ``engagement`` with what features are made of only, without names, scores and ranks: these don't have to travel
    with the rows (see ``features.features``)."""
    c = F.col
    root = {"root_user_id": c("user_x_id"), "root_tweet_created_at": c("post_created_at")}
    return _met(with_flags(posts), ["project_keyword"], root, {"engaged_user_id": c("user_x_id"), "engaged_tweet_created_at": c("post_created_at")})


def targets(posts: DataFrame) -> DataFrame:
    """What each engagement of a project came to, without looking for the root."""
    return _engaged(with_flags(posts), ["project_keyword"], F.coalesce("replied_post_id", "quoted_post_id")).select("project_keyword", "root_post_id")


def user_engagement(user_posts: DataFrame, users: DataFrame) -> DataFrame:
    """The whole network: replies, pure quotes and reposts of posts and pure quotes; unknown engagers score 0."""
    found = _scored(_user_joined(user_posts, users), users)
    return found.select(*ROOT, *ENGAGED, F.coalesce("engaged_user_score", F.lit(0.0)).alias("engaged_user_score"))


def user_audience(user_posts: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of ``user_engagement`` without the scores of engagers, as features don't need them."""
    return _user_joined(user_posts, users).select(*ROOT, *ENGAGED)


def _user_joined(user_posts: DataFrame, users: DataFrame) -> DataFrame:
    posts = with_flags(user_posts)
    roots = _roots(posts.where("(is_post or is_quote) and not is_reply and not is_retweet"), users, [])
    reply_or_quote = _engaged(posts, [], F.coalesce("replied_post_id", "quoted_post_id"))
    return roots.join(reply_or_quote.unionByName(_engaged(posts, [], F.col("retweeted_post_id"))), "root_post_id")
