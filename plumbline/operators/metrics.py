"""Post-, account- and growth-level metrics over engagement tables, for one project or the whole network.

Ranges are inclusive and in epoch seconds. Scores have two decimals and are added exactly. "Smart reach" of
a post is the sum of each replier's earliest contribution to it, the author's own replies left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.flags import FLAGS, with_flags
from plumbline.functions.numeric import exact_sum, ratio, round_n
from plumbline.functions.time import within

POST = ["root_post_id", "root_user_id", "root_username"]


def own_posts(posts: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Original posts and pure quotes of a range."""
    return posts.where("is_post or (is_quote and not is_reply)").where(within("post_created_at", start, end))


def of_project(scores: DataFrame, project: str) -> DataFrame:
    """The scores of one project. The project is a key of the decay windows, so the filter goes below them. A post
    belongs to one project, so nothing that is joined by post is lost."""
    return scores.where(F.col("project_keyword") == project) if "project_keyword" in scores.columns else scores


def first_contributions(scores: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """(original_post_id, replier_x_id, contribution_score): each replier's earliest contribution to each post."""
    rows = scores.where(within("post_created_at", start, end)).where(F.col("replier_x_id") != F.col("original_author_x_id"))
    first = F.min_by("contribution_score", F.struct("post_created_at", "reply_post_id"))
    return rows.groupBy("original_post_id", "replier_x_id").agg(first.alias("contribution_score"))


def smart_reach(scores: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """(post_id, smart_reach)."""
    first = first_contributions(scores, start, end)
    return first.groupBy(F.col("original_post_id").alias("post_id")).agg(exact_sum("contribution_score").alias("smart_reach"))


def _engaged(engagement: DataFrame, start: int | None, end: int | None, replies_only: bool = True) -> DataFrame:
    """What others did on non-reply roots, both within the range."""
    rows = engagement.where(within("engaged_tweet_created_at", start, end)).where(within("root_tweet_created_at", start, end))
    rows = rows.where(~F.col("is_root_reply")).where(F.col("root_user_id") != F.col("engaged_user_id"))
    return rows.where("is_engaged_reply") if replies_only else rows


def _per_post(rows: DataFrame, replies: Column, extra: list[Column] | None = None) -> DataFrame:
    """Two-level aggregate: a row a (post, engager), then a row a post. An engager's score is one number."""
    pairs = rows.groupBy(*POST, "engaged_user_id").agg(
        F.max("engaged_user_score").alias("_score"), F.max("root_favorite_count").alias("_likes"), F.sum(F.when(replies, 1).otherwise(0)).alias("_replies"), *(extra or [])
    )
    return pairs.groupBy(*POST).agg(
        F.count(F.lit(1)).alias("unique_engagers"), exact_sum("_score").alias("post_unique_reach"), F.max("_likes").cast("int").alias("total_likes"),
        F.sum("_replies").alias("total_replies"), *([F.max("view_count").alias("view_count")] if extra else []),
    ).select(F.col("root_post_id").alias("post_id"), F.col("root_user_id").alias("handle"), F.col("root_username").alias("username"), "*")


def _with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "total_impressions": F.col("view_count").cast("long"),
            "impression_to_unique_reach_ratio": ratio(F.col("view_count"), F.col("post_unique_reach"), 2),
            "like_reply_ratio": ratio(F.col("total_likes"), F.col("total_replies"), 2),
            "unique_engager_scores_to_count_ratio": ratio(F.col("post_unique_reach"), F.col("unique_engagers"), 2),
        }
    )


def _flagged(df: DataFrame, users: DataFrame, reach: DataFrame) -> DataFrame:
    strong = users.select(F.col("x_id").alias("handle"), F.col("score").cast("double").alias("_author_score"))
    full = df.join(strong, "handle", "left").join(reach, "post_id", "left")
    return with_flags(full, "total_replies", "like_reply_ratio", "impression_to_unique_reach_ratio", "_author_score")


POST_COLUMNS = [
    "post_id", "handle", "username", "post_unique_reach", "total_impressions", "total_likes", "total_replies", "unique_engagers", "smart_reach",
    "like_reply_ratio", "impression_to_unique_reach_ratio", "unique_engager_scores_to_count_ratio", *FLAGS,
]


def post_metrics(engagement: DataFrame, posts: DataFrame, users: DataFrame, scores: DataFrame, project: str, start: int | None, end: int | None, post_id: str | None = None) -> DataFrame:
    """Reach, ratios and flags of a project's posts from the replies they got. post_id restricts to one, before anything is joined."""
    rows = engagement.where(F.col("project_keyword") == project)
    views = posts.where(F.col("project_keyword") == project).select("post_id", "view_count")
    if post_id is not None:
        rows, views, scores = rows.where(F.col("root_post_id") == post_id), views.where(F.col("post_id") == post_id), scores.where(F.col("original_post_id") == post_id)
    found = _with_ratios(_per_post(_engaged(rows, start, end), F.lit(True)).join(views, "post_id"))
    return _flagged(found, users, smart_reach(of_project(scores, project), start, end)).select(*POST_COLUMNS).orderBy(F.desc_nulls_first("post_unique_reach"), "post_id")


def single_post_smart_reach(engagement: DataFrame, posts: DataFrame, users: DataFrame, scores: DataFrame, project: str, post_id: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """``post_metrics`` of one post, over an optional range; no row if nobody else replied to it."""
    keep = ["post_id", "handle", "username", "post_unique_reach", "smart_reach", "like_reply_ratio", "impression_to_unique_reach_ratio", "unique_engager_scores_to_count_ratio", *FLAGS]
    return post_metrics(engagement, posts, users, scores, project, start, end, post_id).select(*keep)


RATIO_COLUMNS = [
    "post_id", "handle", "username", "post_unique_reach", "total_impressions", "reach_to_impression_ratio", "total_likes", "total_replies",
    "like_reply_ratio", "unique_engagers", "unique_engager_scores_to_count_ratio",
]


def post_engagement_ratios(engagement: DataFrame, posts: DataFrame, project: str, start: int, end: int) -> DataFrame:
    """Ratios from replies and quotes alike; only replies count as replies."""
    rows = _engaged(engagement.where(F.col("project_keyword") == project), start, end, replies_only=False)
    views = posts.where(F.col("project_keyword") == project).select("post_id", "view_count")
    found = _with_ratios(_per_post(rows, F.col("is_engaged_reply")).join(views, "post_id"))
    found = found.withColumn("reach_to_impression_ratio", ratio(F.col("post_unique_reach"), F.col("view_count"), 4))
    return found.select(*RATIO_COLUMNS).orderBy(F.desc_nulls_first("post_unique_reach"), "post_id")


def _replies_to(posts: DataFrame, users: DataFrame, roots: DataFrame, start: int | None, end: int | None, link: str = "replied_post_id", how: str = "inner") -> DataFrame:
    """Replies in the range by others than the author: (root columns, engaged_user_id, engaged_user_score)."""
    replies = posts.where(within("post_created_at", start, end)).where(F.col(link).isNotNull()).select(F.col(link).alias("root_post_id"), F.col("user_x_id").alias("engaged_user_id"), F.col("post_id").alias("_reply"))
    met = roots.join(replies, "root_post_id").where(F.col("engaged_user_id") != F.col("root_user_id"))
    return met.join(users.select(F.col("x_id").alias("engaged_user_id"), F.col("score").cast("double").alias("engaged_user_score")), "engaged_user_id", how)


def account_reach(user_posts: DataFrame, users: DataFrame, start: int, end: int) -> DataFrame:
    """(root_user_id, account_unique_reach): scores of all who replied to an author's own posts, each once."""
    roots = own_posts(user_posts, start, end).select(F.col("post_id").alias("root_post_id"), F.col("user_x_id").alias("root_user_id"))
    pairs = _replies_to(user_posts, users, roots, start, end).groupBy("root_user_id", "engaged_user_id").agg(F.max("engaged_user_score").alias("_s"))
    return pairs.groupBy("root_user_id").agg(exact_sum("_s").alias("account_unique_reach"))


def _keyword_reach(rows: DataFrame) -> DataFrame:
    pairs = rows.groupBy("root_user_id", "root_username", "engaged_user_id").agg(F.max("engaged_user_score").alias("_s"))
    return pairs.groupBy("root_user_id", "root_username").agg(F.coalesce(exact_sum("_s"), F.lit(0.0)).alias("keyword_unique_reach"))


def account_metrics(engagement: DataFrame, posts: DataFrame, user_posts: DataFrame, users: DataFrame, scores: DataFrame, project: str, start: int, end: int) -> DataFrame:
    """Accounts of a project: reach by keyword and overall, posts with engagement, smart reach, and the score smart reach + posts * user score."""
    rows = _engaged(engagement.where(F.col("project_keyword") == project), start, end)
    known = posts.where(F.col("project_keyword") == project).select(F.col("post_id").alias("root_post_id"))
    valid = rows.select("root_post_id", "root_user_id").distinct().join(known, "root_post_id")
    reach = smart_reach(of_project(scores, project), start, end).withColumnRenamed("post_id", "root_post_id")
    counts = valid.join(reach, "root_post_id", "left").groupBy("root_user_id").agg(F.count(F.lit(1)).alias("post_count"), F.coalesce(exact_sum("smart_reach"), F.lit(0.0)).alias("smart_reach"))
    full = _keyword_reach(rows).join(account_reach(user_posts, users, start, end), "root_user_id", "left").join(counts, "root_user_id", "left")
    full = full.join(users.select(F.col("x_id").alias("root_user_id"), F.col("score").cast("double").alias("score")), "root_user_id", "left")
    n, sr = F.coalesce("post_count", F.lit(0)), F.coalesce("smart_reach", F.lit(0.0))
    full = full.select(
        F.col("root_user_id").alias("handle"), F.col("root_username").alias("username"), "score", n.alias("post_count"), sr.alias("smart_reach"),
        round_n(sr + n * F.coalesce("score", F.lit(0.0)), 3).alias("influence_score"), "keyword_unique_reach",
        F.coalesce("account_unique_reach", F.lit(0.0)).alias("account_unique_reach"),
    )
    return full.withColumn("account_keyword_unique_reach_ratio", ratio(F.col("account_unique_reach"), F.col("keyword_unique_reach"), 2)).orderBy(F.desc_nulls_last("influence_score"), "handle")


def account_keyword_reach_ratio(engagement: DataFrame, user_posts: DataFrame, users: DataFrame, project: str, start: int, end: int) -> DataFrame:
    """Reach over the whole account against reach on the keyword, quotes counted too."""
    rows = _engaged(engagement.where(F.col("project_keyword") == project), start, end, replies_only=False)
    full = _keyword_reach(rows).join(account_reach(user_posts, users, start, end), "root_user_id", "left")
    full = full.select(F.col("root_user_id").alias("handle"), F.col("root_username").alias("username"), "keyword_unique_reach", F.coalesce("account_unique_reach", F.lit(0.0)).alias("account_unique_reach"))
    return full.withColumn("account_keyword_unique_reach_ratio", ratio(F.col("account_unique_reach"), F.col("keyword_unique_reach"), 2)).orderBy(F.desc_nulls_last("account_unique_reach"), "handle")


def _growth(pairs: DataFrame) -> DataFrame:
    """pairs: a row a (post, engager) or a post without one, with post_sequence_number. Growth of the audience post by post."""
    author = Window.partitionBy("handle", "engaged_user_id")
    new = F.col("engaged_user_id").isNotNull() & (F.col("post_sequence_number") == F.min("post_sequence_number").over(author))
    marked = pairs.withColumn("_new", new)
    per_post = marked.groupBy("handle", "username", "root_post_id", "root_tweet_created_at", "post_sequence_number").agg(
        F.count("engaged_user_id").alias("total_engagements"), exact_sum("engaged_user_score").alias("post_unique_reach"),
        # the score of a new engager without one is unknown, and unknown ones alone leave the sum unknown
        exact_sum(F.when(F.col("_new"), F.col("engaged_user_score")).otherwise(0.0)).alias("expansion_unique_reach"),
        F.count(F.when(F.col("_new"), 1)).alias("new_audience_count"),
    )
    so_far = Window.partitionBy("handle").orderBy("post_sequence_number")
    return per_post.withColumns(
        {
            "cumulative_new_audience_count": F.sum("new_audience_count").over(so_far),
            "cumulative_expansion_unique_reach": F.sum(F.col("expansion_unique_reach").cast("decimal(18,2)")).over(so_far).cast("double"),
        }
    ).orderBy("handle", F.desc("root_tweet_created_at"), "root_post_id")


def _sequenced(roots: DataFrame) -> DataFrame:
    order = Window.partitionBy("handle").orderBy("root_tweet_created_at", "root_post_id")
    return roots.withColumn("post_sequence_number", F.row_number().over(order).cast("long"))


def unique_reach_increase(engagement: DataFrame, posts: DataFrame, users: DataFrame, project: str, start: int, end: int) -> DataFrame:
    """Which of an author's posts reached whom first; posts without engagement stay."""
    named = users.select(F.col("x_id").alias("user_x_id"), F.col("x_username").alias("username"))
    own = own_posts(posts.where(F.col("project_keyword") == project).where(F.col("user_x_id") != ""), start, end).join(named, "user_x_id", "left")
    roots = _sequenced(own.select(F.col("user_x_id").alias("handle"), "username", F.col("post_id").alias("root_post_id"), F.col("post_created_at").alias("root_tweet_created_at")))
    rows = engagement.where(F.col("project_keyword") == project).where("is_engaged_reply").where(within("engaged_tweet_created_at", start, end)).where(F.col("engaged_user_id") != F.col("root_user_id"))
    pairs = rows.groupBy("root_post_id", "engaged_user_id").agg(F.max("engaged_user_score").alias("engaged_user_score"))
    return _growth(roots.join(pairs, "root_post_id", "left"))


def global_unique_reach_increase(user_posts: DataFrame, users: DataFrame, start: int, end: int) -> DataFrame:
    """``unique_reach_increase`` over the whole network, from direct replies."""
    named = users.select(F.col("x_id").alias("user_x_id"), F.col("x_username").alias("username"))
    own = own_posts(user_posts, start, end).join(named, "user_x_id", "left")
    roots = _sequenced(own.select(F.col("user_x_id").alias("handle"), "username", F.col("post_id").alias("root_post_id"), F.col("post_created_at").alias("root_tweet_created_at")))
    met = _replies_to(user_posts, users, roots.select("root_post_id", F.col("handle").alias("root_user_id")), start, end, how="left")
    pairs = met.groupBy("root_post_id", "engaged_user_id").agg(F.max("engaged_user_score").alias("engaged_user_score"))
    return _growth(roots.join(pairs, "root_post_id", "left"))


#: Bounds of the four growth flags, posts that an author needs, flags that make one suspicious.
EARLY, SLOPE, VARIABILITY, SPIKE, MIN_POSTS, MIN_FLAGS = 0.5, 0.1, 2, 5, 5, 2


def reach_increase_flags(growth: DataFrame) -> DataFrame:
    """Growth flags of authors with enough posts. growth: a result of one of the two functions above."""
    e, c, n = F.col("expansion_unique_reach"), F.col("cumulative_expansion_unique_reach"), F.col("post_sequence_number")
    # sums are added exactly and divided once, so the statistics don't depend on the order of the rows
    known = F.count(e)
    users = growth.groupBy("handle", "username").agg(
        F.count(F.lit(1)).alias("total_posts"), F.max(c).alias("final_cumulative_reach"), exact_sum(F.when(n <= 2, e).otherwise(0.0)).alias("_early"),
        F.regr_slope(c, n).alias("growth_slope"), (exact_sum(e) / known).alias("avg_expansion"), F.stddev_samp(e).alias("growth_variability"), F.max(e).alias("_top"),
    )
    users = users.where(F.col("total_posts") >= MIN_POSTS)
    whole = F.when(F.col("final_cumulative_reach") != 0, F.col("final_cumulative_reach"))
    mean = F.when(F.col("avg_expansion") != 0, F.col("avg_expansion"))
    users = users.withColumns({"early_spike_ratio": F.col("_early") / whole, "max_spike_ratio": F.col("_top") / mean})
    tests = {
        "esr_flag": F.col("early_spike_ratio") > EARLY,
        "gs_flag": F.col("growth_slope") < SLOPE * F.col("avg_expansion"),
        "gv_flag": F.col("growth_variability") > VARIABILITY * F.col("avg_expansion"),
        "msr_flag": F.col("max_spike_ratio") > SPIKE,
    }
    users = users.withColumns({k: F.when(t, 1).otherwise(0) for k, t in tests.items()})
    users = users.withColumn("farming_score", sum((F.col(k) for k in tests), F.lit(0)))
    users = users.withColumn("farming_flag", F.when(F.col("farming_score") >= MIN_FLAGS, "potential_engagement_farming").otherwise("organic"))
    keep = ["handle", "username", "total_posts", "final_cumulative_reach", "early_spike_ratio", "growth_slope", "avg_expansion", "growth_variability", "max_spike_ratio", *tests, "farming_score", "farming_flag"]
    return users.select(*keep).orderBy(F.desc("farming_score"), "handle")


# ---- the whole network -----------------------------------------------------------------------


def thread_replies(user_posts: DataFrame, users: DataFrame, start: int, end: int) -> DataFrame:
    """Pure replies to the thread root, an original post, by others; both authors known. The like count is the reply's."""
    named = users.select(F.col("x_id").alias("root_user_id"), F.col("x_username").alias("root_username"))
    scored = users.select(F.col("x_id").alias("engaged_user_id"), F.col("score").cast("double").alias("engaged_user_score"))
    inside = user_posts.where(within("post_created_at", start, end))
    roots = inside.where("is_post and not is_retweet and not is_quote").select(F.col("post_id").alias("root_post_id"), F.col("user_x_id").alias("root_user_id"), "view_count")
    replies = inside.where("is_reply and not is_retweet and not is_quote").select(
        "root_post_id", F.col("user_x_id").alias("engaged_user_id"), F.col("favorite_count").alias("root_favorite_count"), F.col("post_created_at").alias("_at"), F.col("post_id").alias("_reply")
    )
    met = replies.join(roots, "root_post_id").where(F.col("root_user_id") != F.col("engaged_user_id"))
    return met.join(named, "root_user_id").join(scored, "engaged_user_id")


def global_post_metrics(user_posts: DataFrame, users: DataFrame, scores: DataFrame, start: int, end: int) -> DataFrame:
    """``post_metrics`` by thread root. Likes are the largest of the engagers' earliest replies. scores: a decay table of either scope."""
    rows = thread_replies(user_posts, users, start, end)
    pairs = rows.groupBy(*POST, "engaged_user_id").agg(
        F.max("engaged_user_score").alias("_s"), F.min_by("root_favorite_count", F.struct("_at", "_reply")).alias("_likes"), F.count(F.lit(1)).alias("_n"), F.max("view_count").alias("view_count")
    )
    found = pairs.groupBy(F.col("root_post_id").alias("post_id"), F.col("root_user_id").alias("handle"), F.col("root_username").alias("username")).agg(
        F.count(F.lit(1)).alias("unique_engagers"), exact_sum("_s").alias("post_unique_reach"), F.max("_likes").cast("int").alias("total_likes"), F.sum("_n").alias("total_replies"), F.max("view_count").alias("view_count")
    )
    return _flagged(_with_ratios(found), users, smart_reach(scores, start, end)).select(*POST_COLUMNS).orderBy(F.desc_nulls_first("post_unique_reach"), "post_id")


def global_account_metrics(user_posts: DataFrame, users: DataFrame, scores: DataFrame, start: int, end: int) -> DataFrame:
    """Accounts by thread replies: posts with engagement, smart reach, score and unique reach."""
    rows = thread_replies(user_posts, users, start, end)
    pairs = rows.groupBy("root_user_id", "engaged_user_id").agg(F.max("engaged_user_score").alias("_s"))
    reach = pairs.groupBy("root_user_id").agg(exact_sum("_s").alias("account_unique_reach"))
    valid = rows.select("root_post_id", "root_user_id").distinct().join(smart_reach(scores, start, end).withColumnRenamed("post_id", "root_post_id"), "root_post_id", "left")
    counts = valid.groupBy("root_user_id").agg(F.count(F.lit(1)).alias("post_count"), F.coalesce(exact_sum("smart_reach"), F.lit(0.0)).alias("smart_reach"))
    named = users.select(F.col("x_id").alias("root_user_id"), F.col("x_username").alias("username"), F.col("score").cast("double").alias("score"))
    full = reach.join(counts, "root_user_id").join(named, "root_user_id", "left")
    score = round_n(F.col("smart_reach") + F.col("post_count") * F.coalesce("score", F.lit(0.0)), 3)
    return full.select(F.col("root_user_id").alias("handle"), "username", "score", "post_count", "smart_reach", score.alias("influence_score"), "account_unique_reach").orderBy(F.desc_nulls_last("influence_score"), "handle")


def global_post_engagement_ratios(user_posts: DataFrame, users: DataFrame, start: int, end: int) -> DataFrame:
    """``post_engagement_ratios`` over the whole network, from direct replies."""
    named = users.select(F.col("x_id").alias("root_user_id"), F.col("x_username").alias("root_username"))
    roots = own_posts(user_posts, start, end).select(F.col("post_id").alias("root_post_id"), F.col("user_x_id").alias("root_user_id"), F.col("favorite_count").alias("root_favorite_count"), "view_count").join(named, "root_user_id", "left")
    rows = _replies_to(user_posts, users, roots, start, end, how="left")
    found = _with_ratios(_per_post(rows, F.lit(True), [F.max("view_count").alias("view_count")]))
    found = found.withColumn("reach_to_impression_ratio", ratio(F.col("post_unique_reach"), F.col("view_count"), 4))
    return found.select(*RATIO_COLUMNS).orderBy(F.desc_nulls_first("post_unique_reach"), "post_id")
