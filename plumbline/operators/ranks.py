"""Row numbers over a whole table, without a window that has no partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.ingest import cut

ROW_BITS = 33  # of monotonically_increasing_id: the partition above, the row in it below


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with each row's place in ``order``, from 1. The order has to be total, as rows that are equal in it may be
    numbered differently each time.

    Rows are dealt to tasks by ranges of the order and sorted there; that is written once, so that the ranges stay what
    they are. A row's number is its place in its range and the rows of the ranges before, of which there are as many as tasks.
    """
    at = F.monotonically_increasing_id()
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at))
    part, row = F.shiftright("_at", ROW_BITS), F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    counts = sorted((r["p"], r["count"]) for r in ranged.groupBy(part.alias("p")).count().collect())  # one a task
    before, ahead = {}, 0
    for p, n in counts:
        before[p] = ahead
        ahead += n
    if not before:
        return df.withColumn(name, F.lit(0).cast("int"))
    # a list by partition number: some have no rows
    offsets = F.array(*[F.lit(before.get(p, 0)).cast("long") for p in range(max(before) + 1)])
    return ranged.withColumn(name, (F.get(offsets, part.cast("int")) + row + 1).cast("int")).drop("_at")
