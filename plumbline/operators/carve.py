"""Rows of a table that aren't among those of another one, by several columns and with SQL's rule for nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Keys among which rows are dealt that are compared by no column.
SPREAD = 64


def _mask(columns: list[str]) -> Column:
    """Which of the columns are null, as bits."""
    bits = [F.when(F.col(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(columns)]
    return sum(bits[1:], bits[0])


def _key(mine: Column, other: Column, columns: list[str]) -> list[Column]:
    """The values that both sides have. What is null on either side may equal anything, so it isn't compared."""
    shared = mine.bitwiseOR(other)
    return [F.when(shared.bitwiseAND(F.lit(1 << k)) == 0, F.col(c)).alias(f"_k{k}") for k, c in enumerate(columns)]


def not_in(rows: DataFrame, others: DataFrame, columns: list[str]) -> DataFrame:
    """``(columns) NOT IN (SELECT columns FROM others)``: the rows for which no row of ``others`` may be equal.

    Two rows may be equal if no column has two different values; a null has none. So a row of nulls alone stays only if
    ``others`` is empty, a row of nulls alone in ``others`` leaves nothing, and an empty ``others`` leaves everything.
    Repeated rows of ``rows`` stay as often as they are there. Other columns of either side, clashing names too, don't matter.

    Spark's own form of this for several columns is a nested loop. Here the distinct keys of both sides meet once for
    each pair of null patterns, over equal values of the columns that neither pattern lacks: a copy of a key for each
    pattern that the other side has, 2^k at most for k columns. Pairs of patterns that lack every column would meet at one
    key, so they are dealt to ``SPREAD`` of them. The whole rows are shuffled once, against the keys that go.
    """
    if not columns:
        raise ValueError("no columns to compare")
    if len(columns) > 6:
        raise ValueError("a key of over six columns has too many null patterns")
    patterns = F.array(*[F.lit(k) for k in range(1 << len(columns))])
    keys = [f"_k{k}" for k in range(len(columns))]
    mine, theirs = rows.select(*columns).distinct().withColumn("_left", _mask(columns)), others.select(*columns).distinct().withColumn("_right", _mask(columns))
    lefts, rights = F.broadcast(mine.select("_left").distinct()), F.broadcast(theirs.select("_right").distinct())  # 2^k rows at most
    here = mine.withColumn("_right", F.explode(patterns)).join(rights, "_right", "left_semi")
    there = theirs.withColumn("_left", F.explode(patterns)).join(lefts, "_left", "left_semi")
    nothing = F.col("_left").bitwiseOR(F.col("_right")) == (1 << len(columns)) - 1
    there = there.select("_left", "_right", *_key(F.col("_right"), F.col("_left"), columns)).distinct()
    there = there.withColumn("_part", F.explode(F.when(nothing, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))))
    part = F.when(nothing, F.pmod(F.xxhash64(*columns), F.lit(SPREAD)).cast("int")).otherwise(0).alias("_part")
    here = here.select("_left", "_right", part, *_key(F.col("_left"), F.col("_right"), columns), *[F.col(c).alias(f"_v{k}") for k, c in enumerate(columns)])
    on = [here[c].eqNullSafe(there[c]) for c in ("_left", "_right", "_part", *keys)]
    gone = here.join(there, on, "left_semi").select(*[f"_v{k}" for k in range(len(columns))]).distinct()
    return rows.join(gone, [rows[c].eqNullSafe(gone[f"_v{k}"]) for k, c in enumerate(columns)], "left_anti")


def latest(posts: DataFrame, n: int) -> DataFrame:
    """Keys of the ``n`` latest posts, ties to larger ids: the rows that a test table leaves for a later run."""
    return posts.select("post_created_at", "post_id").orderBy(F.desc("post_created_at"), F.desc("post_id")).limit(n)
