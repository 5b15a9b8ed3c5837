"""Rendezvous sharding: each record goes to the shard with the highest weighted hash of its key.

With weights w the score of a shard is w / -ln(u), u a hash of (key, shard) in (0, 1); the highest
score wins. A shard's share is its weight's. One more shard takes records only into itself, and a
removed one gives only its own away. The choice needs no shuffle; slots inside the shards do, on ids
and sizes only: records are ranked in small hash buckets, whose counts are then summed up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import unit_hash

SEED = "shard"
BUCKET_DIGITS = 3


def shard_of(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """The number of the winning shard, ``first`` for the first weight. A null key counts as an empty one."""
    text = key.cast("string")
    scores = []
    for n, w in enumerate(weights, first):
        if not w > 0:
            raise ValueError("weights must be positive")
        u = unit_hash(text, F.lit(str(n)), seed=SEED)
        scores.append(F.struct((F.lit(float(w)) / -F.log(u)).alias("score"), u.alias("u"), F.lit(-n).alias("n")))
    return -(F.greatest(*scores)["n"] if len(scores) > 1 else scores[0]["n"])


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id") -> DataFrame:
    """Adds ``shard`` to ``docs`` (a column of that name is replaced); repeated keys share a shard."""
    return docs.withColumn("shard", shard_of(F.col(key), weights).cast("int"))


def slots(placed: DataFrame, tie: Sequence[str], key: str = "doc_id") -> DataFrame:
    """Adds ``slot`` to rows of (shard, ``key``, ...): 0, 1, ... in each shard, by the hash of the key,
    the key, then the columns ``tie`` (nulls first). Rows equal in all of these get neighbouring slots.

    No task sees a whole shard: the hash's leading digits make 4096 buckets of each, rows are ranked
    in their bucket, and a bucket starts where the counts of those before it end.
    """
    mark = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    placed = placed.withColumn("_mark", mark).withColumn("_bucket", F.substring("_mark", 1, BUCKET_DIGITS))
    inside = Window.partitionBy("shard", "_bucket").orderBy("_mark", key, *tie)
    counts = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = placed.withColumn("_rank", F.row_number().over(inside))
    joined = ranked.join(starts, ["shard", "_bucket"])
    return joined.withColumn("slot", (F.col("_start") + F.col("_rank") - 1).cast("long")).drop("_mark", "_bucket", "_rank", "_start")


def manifest(docs: DataFrame, weights: Sequence[float], grown: float = 1.0) -> DataFrame:
    """One row of each row of ``docs``: doc_id, size (UTF-8 bytes of the text plus 8; null text: 8),
    text_crc32 (null for a null text), shard, slot, and grown_shard, the shard if one of weight ``grown``
    came on top. Ids and sizes are shuffled, texts aren't. Empty table: empty result."""
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    placed = assign(narrow, weights)
    u_new = shard_of(F.col("doc_id"), [*weights, grown]).cast("int")
    placed = placed.withColumn("grown_shard", u_new)
    return slots(placed, ["text_crc32", "size"])
