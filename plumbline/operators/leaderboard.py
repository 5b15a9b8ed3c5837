"""Leaderboards: posts scored by smart reach and content, capped by user and period, added up to users."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numeric import round_n
from plumbline.functions.time import cap_bucket, within
from plumbline.operators.metrics import smart_reach

#: What counts where a project has no cap, an unrated post or a user no score; rows of a board.
DEFAULT_CAP, DEFAULT_PERIOD, DEFAULT_CONTENT, DEFAULT_SCORE, ROWS = 5, "week", 50, 0.01, 1100


@dataclass(frozen=True)
class Cap:
    """``posts`` a user and ``period`` (day, week, month, none); 0 posts: no cap. Buckets start at ``anchor``, else by calendar."""

    posts: int = DEFAULT_CAP
    period: str = DEFAULT_PERIOD
    anchor: datetime | None = None


def cap_of(post_caps: DataFrame, project: str, board: str = "global") -> Cap:
    """The cap of a project's board: one small row, with defaults for what it leaves open."""
    row = post_caps.where((F.col("project_keyword") == project) & (F.col("leaderboard_type") == board)).first()
    if row is None:
        return Cap()
    posts, period = row["post_cap"], row["cap_period"]
    return Cap(DEFAULT_CAP if posts is None else posts, period or DEFAULT_PERIOD, row["cap_start_date"] or row["project_start_date"])


def user_weight(score: str):
    """A user's score, 0.01 if it is 0 or unknown."""
    s = F.col(score).cast("double")
    return F.when(s != 0, s).otherwise(F.lit(DEFAULT_SCORE))


def leaderboard(
    engagement: DataFrame, posts: DataFrame, users: DataFrame, scores: DataFrame, project: str, start: int, end: int, cap: Cap | None = None,
    exclude: Sequence[str] | None = None, only: Sequence[str] | None = None, rows: int | None = ROWS,
) -> DataFrame:
    """Users of a project by score with their share of the total, at most ``rows`` of them.

    exclude and only are lists of user ids (none or empty: no restriction); they act before shares are taken.
    The user named like the project, and users without a name, don't take part.
    """
    cap = cap or Cap()
    roots = engagement.where(F.col("project_keyword") == project).where(within("root_tweet_created_at", start, end)).where(F.col("root_user_id") != "")
    roots = roots.select("root_post_id", "root_user_id", "root_username", "root_tweet_created_at", "is_root_reply").distinct()
    counts = roots.groupBy("root_user_id", "root_username").agg(F.count(F.when(F.col("is_root_reply"), 1)).alias("_replies"))
    reach = smart_reach(scores.where(F.col("project_keyword") == project), start, end).withColumnRenamed("post_id", "root_post_id")
    content = posts.where(F.col("project_keyword") == project).select(F.col("post_id").alias("root_post_id"), F.col("content_score").cast("double").alias("_content"))
    scored = roots.where(~F.col("is_root_reply")).join(reach, "root_post_id", "left").join(content, "root_post_id", "left")
    value = F.coalesce("smart_reach", F.lit(0.0)) * (F.coalesce("_content", F.lit(float(DEFAULT_CONTENT))) / 100.0)
    scored = scored.withColumn("_value", value)
    if cap.posts:
        bucket = Window.partitionBy("root_user_id", "_bucket").orderBy(F.desc("_value"), "root_post_id")
        scored = scored.withColumn("_bucket", cap_bucket("root_tweet_created_at", cap.period, cap.anchor))
        scored = scored.withColumn("_rank", F.row_number().over(bucket)).where(F.col("_rank") <= cap.posts)
    # values have at most four decimals (cents times whole percents), so they add up exactly
    totals = scored.groupBy("root_user_id").agg(F.sum(round_n("_value", 4).cast("decimal(20,4)")).cast("double").alias("_points"), F.count(F.lit(1)).alias("_posts"))
    named = users.select(F.col("x_id").alias("root_user_id"), "display_name", "avatar_url", "score")
    full = counts.join(totals, "root_user_id", "left").join(named, "root_user_id", "left").where(F.col("root_username") != project)
    if exclude:
        full = full.where(~F.col("root_user_id").isin(list(exclude)))
    if only:
        full = full.where(F.col("root_user_id").isin(list(only)))
    weight = user_weight("score")
    points = F.coalesce("_points", F.lit(0.0)) + F.coalesce("_posts", F.lit(0)) * weight + F.col("_replies") * weight / 100.0
    board = full.select(
        F.col("root_user_id").alias("x_user_id"), F.col("root_username").alias("x_username"), F.coalesce("display_name", F.lit("")).alias("x_display_name"),
        F.col("avatar_url").alias("x_avatar_url"), round_n(points, 3).alias("influence_score"),
    )
    total = board.agg(F.sum(F.col("influence_score").cast("decimal(20,3)")).cast("double").alias("_all"))
    board = board.crossJoin(F.broadcast(total))  # one row
    share = F.when(F.col("_all") == 0, 0.0).otherwise(round_n(F.col("influence_score") * 100.0 / F.col("_all"), 2))
    board = board.withColumn("influence_percent", share).drop("_all").orderBy(F.desc_nulls_last("influence_score"), "x_user_id")
    return board if rows is None else board.limit(rows)


def private_leaderboard(engagement: DataFrame, posts: DataFrame, users: DataFrame, scores: DataFrame, project: str, start: int, end: int, cap: Cap | None = None, exclude: Sequence[str] | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """The board of an allow-list; pass the cap of the ``private`` board."""
    return leaderboard(engagement, posts, users, scores, project, start, end, cap, exclude, only)


#: The spans, in days, that boards are kept for.
SPANS = {"24h": 1, "7d": 7, "30d": 30, "3m": 90, "6m": 180, "1y": 365}


def leaderboards(engagement: DataFrame, posts: DataFrame, users: DataFrame, scores: DataFrame, project: str, end: int, cap: Cap | None = None, spans: Sequence[str] = tuple(SPANS)) -> DataFrame:
    """One board for each span that ends at ``end``, with the column ``span``."""
    boards = [leaderboard(engagement, posts, users, scores, project, end - SPANS[s] * 86400, end, cap).withColumn("span", F.lit(s)) for s in spans]
    out = boards[0]
    for b in boards[1:]:
        out = out.unionByName(b)
    return out
