"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source with target share w of ``total`` rows and n rows of its own has the mean repetition rate
w * total / n. Each document's count is the Poisson quantile of a hash of its id, so reruns and other
partitionings give the same counts. Documents are exploded by their count and sent to random places
of the whole output by a hash of (id, copy).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import fresh, unit_hash

PIECE = 32.0  # a larger mean is drawn as the sum of equal parts, each small enough for exp(-mean)
SMALL = 500  # sources up to which the table of rates is broadcast: under 2 KB each


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, total: int | None = None) -> DataFrame:
    """(source, rate): mean repetitions of a document of each source, so that the expected rows of the
    sources stand as ``weights`` and add up to ``total`` (default: the rows of ``docs``).

    Without ``weights`` all sources count alike, null being one. With them a source that isn't named gets 0.
    """
    rows = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        rows = rows.withColumn("w", F.lit(1.0))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]) if weights else None
        rows = rows.withColumn("w", F.coalesce(F.element_at(named, F.col("source")), F.lit(0.0)) if weights else F.lit(0.0))
    sums = rows.agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w"))
    goal = F.col("all_n") if total is None else F.lit(total)
    rate = F.when(F.col("all_w") > 0, F.col("w") / F.col("all_w") * goal / F.col("n")).otherwise(0.0)
    return rows.join(F.broadcast(sums)).select("source", rate.alias("rate"))  # sums is one row


def _cdf(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... of a Poisson variable, until what is left is far below one hash in 2^48."""
    steps = F.sequence(F.lit(1), F.ceil(mean + F.lit(12.0) * F.sqrt(mean) + F.lit(20.0)).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def add(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), F.array_append(s["c"], F.element_at(s["c"], -1) + p).alias("c"))

    return F.aggregate(steps, start, add, lambda s: s["c"])


def replicate(
    docs: DataFrame, weights: Mapping[str, float] | None = None, total: int | None = None, seed: str = "mix", extra: bool = True
) -> DataFrame:
    """Each row of ``docs`` as often as its draw says, in random order over all partitions.

    Adds ``_copy`` (1 to the draw), ``_copies`` (the draw) and ``_place`` (the random key of the order), in
    place of columns of these names; extra=False: adds nothing, and columns of any names pass through.
    Rows with one doc_id are drawn alike; a null doc_id counts as an empty one. The text may be null.
    Other columns pass through. Empty table: empty result.
    """
    table = rates(docs, weights, total).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE).cast("int")))
    source, name = fresh(docs, "_source"), fresh(docs, "_law")
    table = table.select(F.col("source").alias(source), F.struct("parts", _cdf(F.col("rate") / F.col("parts")).alias("cdf")).alias(name))
    if table.select(source).limit(SMALL + 1).count() <= SMALL:
        table = F.broadcast(table)
    columns = docs.columns
    if extra:
        copies_, copy_, place_ = "_copies", "_copy", "_place"
        docs = docs.drop(copies_, copy_, place_)
    else:
        copies_, copy_, place_ = (fresh(docs, c) for c in ("_copies", "_copy", "_place"))
    drawn = docs.join(table, docs["source"].eqNullSafe(table[source])).drop(source)
    key = F.col("doc_id").cast("string")
    law = F.col(name)

    def draw(u: Column) -> Column:
        return F.size(F.filter(law["cdf"], lambda c: c < u))

    many = F.aggregate(
        F.sequence(F.lit(1), law["parts"]), F.lit(0), lambda n, k: n + draw(unit_hash(key, k.cast("string"), seed=seed))
    )
    drawn = drawn.withColumn(copies_, many).drop(name).where(F.col(copies_) > 0)
    copies = drawn.withColumn(copy_, F.explode(F.sequence(F.lit(1), F.col(copies_))))
    placed = copies.withColumn(place_, unit_hash(key, F.col(copy_).cast("string"), seed=f"{seed}-place"))
    mixed = placed.repartition(place_).sortWithinPartitions(place_)
    return mixed if extra else mixed.select(columns)
