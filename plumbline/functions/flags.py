"""The four quality flags that post-level results carry, in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Replies from which the like/reply ratio counts, its bounds, the impression/reach
#: bounds, and the author score above which the wider bound holds.
MIN_REPLIES, LOW_LIKES, HIGH_LIKES = 10, 1.7, 20
LOW_IMPRESSIONS, HIGH_IMPRESSIONS, HIGH_IMPRESSIONS_STRONG, STRONG_AUTHOR = 1, 5, 15, 2000


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def with_flags(df: DataFrame, replies: str, like_reply: str, impression_reach: str, author_score: str) -> DataFrame:
    """``df`` with the farming and botting flags of both ratios; a null ratio raises none."""
    enough = F.col(replies) >= MIN_REPLIES
    bound = F.when(F.col(author_score) > STRONG_AUTHOR, HIGH_IMPRESSIONS_STRONG).otherwise(HIGH_IMPRESSIONS)
    return df.withColumns(
        {
            "like_reply_engagement_farming_flag": _sure(enough & (F.col(like_reply) < LOW_LIKES)),
            "like_reply_botting_flag": _sure(enough & (F.col(like_reply) > HIGH_LIKES)),
            "impression_unique_reach_engagement_farming_flag": _sure(F.col(impression_reach) < LOW_IMPRESSIONS),
            "impression_unique_reach_botting_flag": _sure(F.col(impression_reach) > bound),
        }
    )


FLAGS = [
    "like_reply_engagement_farming_flag",
    "like_reply_botting_flag",
    "impression_unique_reach_engagement_farming_flag",
    "impression_unique_reach_botting_flag",
]
