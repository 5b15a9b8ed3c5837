"""Decay scoring of replies with window functions only.

A replier's replies in time order lose weight while earlier ones are active: an entry is active for
``reset`` after its time, bounds excluded. Sorted by (time, id) the expired entries are a prefix, so
every active quantity is "all before" minus "all expired", and a product of multipliers is a power
of two running counts. One shuffle on the replier serves all windows.
"""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numeric import round_n
from plumbline.functions.time import micros

THIRTY_DAYS = timedelta(days=30)
#: Multipliers by decay type, and the floor as a share of the base score.
LOCAL, GLOBAL, FLOOR = 0.5, 0.9, 0.01

COLUMNS = [
    "reply_post_id", "replier_x_id", "original_post_id", "original_author_x_id", "post_created_at", "replier_base_score", "effective_score",
    "contribution_score", "reply_number", "local_reply_count", "decay_type",
]


def replies_to(posts: DataFrame, scope: str = "project", how: str = "inner", new: Column | None = None) -> DataFrame:
    """Replies with their parent's author, without scores. how ``left`` keeps replies to unknown parents. new: a condition on a
    post; ``_new`` says whether it holds for the reply, and ``_new_parent`` for the parent (null: an unknown parent)."""
    keys = ["project_keyword"] if scope == "project" else []
    mark = lambda name: [] if new is None else [F.coalesce(new, F.lit(False)).alias(name)]
    replies = posts.where("replied_post_id is not null").select(
        *keys, F.col("post_id").alias("reply_post_id"), F.col("user_x_id").alias("replier_x_id"), F.col("replied_post_id").alias("original_post_id"), "post_created_at", *mark("_new")
    )
    parents = posts.select(*keys, F.col("post_id").alias("original_post_id"), F.col("user_x_id").alias("original_author_x_id"), *mark("_new_parent"))
    return replies.join(parents, [*keys, "original_post_id"], how)


def base_scores(users: DataFrame) -> DataFrame:
    return users.select(F.col("x_id").alias("replier_x_id"), F.col("score").cast("double").alias("replier_base_score"))


def reply_source(posts: DataFrame, users: DataFrame, scope: str = "project") -> DataFrame:
    """Replies with their parent's author and the replier's score. Replies whose parent or replier is unknown go.

    scope ``project``: the parent has to be of the same project; ``global``: project_keyword is not read.
    """
    return replies_to(posts, scope).join(base_scores(users), "replier_x_id")


def power(base: float, count: Column) -> Column:
    """``base`` to a whole number, from a list of literals: Java's pow and that of C differ in the last bit (at 0.9 to the 4th),
    and it decides which way 950.00 * 0.9^4 is rounded. Past the list's end products of scores of up to 10^10 round to 0."""
    last = math.ceil(math.log(1e-13) / math.log(base)) if 0 < base < 1 else 0
    if not 0 < last <= 5000:
        return F.pow(F.lit(base), count.cast("double"))
    return F.get(F.array(*[F.lit(base**k) for k in range(last + 1)]), F.least(count, F.lit(last)).cast("int"))


def decay(
    replies: DataFrame, scope: str = "project", reset: timedelta = THIRTY_DAYS, new_author: float | None = None, active_multipliers: bool = False
) -> DataFrame:
    """Score every row of ``replies`` (see ``reply_source``).

    new_author: the multiplier of a non-first reply to an author without active entries. Default: 0.9 in
    project scope (type GLOBAL_DECAY), 1.0 in global scope (type NEW_AUTHOR); 0.9 in global scope is the
    stricter rule that incremental global runs may use. active_multipliers adds the multipliers that are
    active after the reply, its own last, in order of (time, id); a row holds one window length of its replier, so it is off by default.

    A tail is scored from what is stored before it: rows whose ``_stored`` column holds a decay type keep that type, count
    for the others, and aren't returned; ``_older`` says how many replies of the replier come before the rows that are given.
    A tail needs all rows of its replier from one window length before its first row on.
    """
    if scope not in ("project", "global"):
        raise ValueError(f"unknown scope: {scope}")
    other = new_author if new_author is not None else GLOBAL if scope == "project" else 1.0
    keys = ["project_keyword", "replier_x_id"] if scope == "project" else ["replier_x_id"]
    span = int(reset / timedelta(microseconds=1))

    rows = replies.withColumn("_t", micros("post_created_at"))
    tail = "_stored" in rows.columns
    # the replier comes first, as sorts compare the first bytes of the first key, and few projects differ
    replier = keys[::-1]
    by_row = Window.partitionBy(*replier).orderBy("_t", "reply_post_id")
    expired = Window.partitionBy(*replier).orderBy("_t").rangeBetween(Window.unboundedPreceding, -span)
    author_row = Window.partitionBy(*replier, "original_author_x_id").orderBy("_t", "reply_post_id")
    author_expired = Window.partitionBy(*replier, "original_author_x_id").orderBy("_t").rangeBetween(Window.unboundedPreceding, -span)
    one = F.lit(1)
    rows = rows.withColumns(
        {
            "_row": F.row_number().over(by_row),
            "_gone": F.count(one).over(expired),
            "local_reply_count": (F.row_number().over(author_row) - F.count(one).over(author_expired)).cast("int"),
        }
    )
    active = F.col("_row") - 1 - F.col("_gone")
    far = "GLOBAL_DECAY" if other != 1.0 else "NEW_AUTHOR"
    kind = F.when(active == 0, "FIRST_REPLY").when(F.col("local_reply_count") > 1, "LOCAL_DECAY").otherwise(far)
    rows = rows.withColumn("decay_type", F.coalesce("_stored", kind) if tail else kind)
    rows = rows.withColumn("reply_number", (F.col("_row") + F.coalesce("_older", F.lit(0))).cast("int") if tail else F.col("_row"))
    rows = rows.withColumn("_m", F.when(F.col("decay_type") == "LOCAL_DECAY", LOCAL).when(F.col("decay_type") == far, other).otherwise(1.0))

    def active_count(multiplier: float) -> Column:
        hit = F.when(F.col("_m") == multiplier, 1).otherwise(0)
        before = F.sum(hit).over(by_row.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(before, F.lit(0)) - F.coalesce(F.sum(hit).over(expired), F.lit(0))

    weight = power(LOCAL, active_count(LOCAL))
    if other not in (1.0, LOCAL):
        weight = weight * power(other, active_count(other))
    base = F.col("replier_base_score")
    floor = round_n(base * FLOOR, 2)
    rows = rows.withColumn("effective_score", F.greatest(round_n(base * weight, 2), floor))
    decayed = F.greatest(round_n(F.col("effective_score") * F.col("_m"), 2), floor)
    rows = rows.withColumn("contribution_score", F.when(F.col("_m") == 1.0, F.col("effective_score")).otherwise(decayed))
    extra = []
    if active_multipliers:
        # one window length, strictly bounded; its rows of the same time with a later id are behind the reply's own place
        frame = Window.partitionBy(*keys).orderBy("_t").rangeBetween(1 - span, 0)
        entries = F.array_sort(F.collect_list(F.struct("_t", "reply_post_id", "_m")).over(frame))
        rows = rows.withColumn("active_multipliers", F.slice(F.transform(entries, lambda e: e["_m"]), 1, (F.col("_row") - F.col("_gone")).cast("int")))
        extra = ["active_multipliers"]
    if tail:
        rows = rows.where("_stored is null")
    return rows.select(*keys[:-1], *COLUMNS, *extra)


def decay_scores(posts: DataFrame, users: DataFrame, scope: str = "project", **rule) -> DataFrame:
    """All projects (or the whole network) in one job."""
    return decay(reply_source(posts, users, scope), scope, **rule)


def inspect(scores: DataFrame) -> DataFrame:
    """Rows and contribution statistics by decay type."""
    c = F.col("contribution_score")
    return scores.groupBy("decay_type").agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("min_score"), F.max(c).alias("max_score"), (F.sum(c.cast("decimal(18,2)")).cast("double") / F.count(c)).alias("mean_score"))
