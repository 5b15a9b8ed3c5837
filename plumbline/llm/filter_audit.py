"""How filters interact: what each of them removes at each step of every order in which they can be applied.

Which filters a document fails is one number, a mask with a bit for each filter. Documents are counted by part and mask,
32 cells a part, and everything else follows from the cells. The orders are visited by adjacent transpositions
(Steinhaus, Johnson and Trotter): each differs from the one before by one swap of neighbours, which changes what is
removed at these two steps and nothing else, so only they are counted again; Shapley sums grow along the walk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
#: The bounds of the failure conditions.
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
BLANKS, CAPITALS, SIGNS = r"[\x20\x09-\x0D]+", "[A-Z]", "[#$%&*|]"


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: whether a text, of whole words between blanks, fails A (few words), B (few distinct words), C (many
    capitals) or D (signs)."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, CAPITALS, ""))
    fails = [n < MIN_WORDS, distinct * 100 < n * DISTINCT_PERCENT, capitals * 100 > F.length(text) * CAPITAL_PERCENT, text.rlike(SIGNS)]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by the filters that they fail, and how many of them are labelled so.

    Rows that are alike are counted before they travel, so a text or an id that many rows share is one row a task.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), text_mask(text).alias("mask"))
    rows = read.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    least = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = rows.join(least.withColumn("first", F.lit(True)), ["doc_id", "digest"], "left")
    # ids of all texts that are copies of one with a smaller id; a row without an id is a copy of none
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    marked = first.withColumn("mask", F.col("mask") + F.when(copy, 16).otherwise(0))
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    judged = marked.join(known, "doc_id", "left")
    hit = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c)
    return judged.groupBy("part", "mask").agg(F.sum("n").alias("n"), hit("good"), hit("toxic"))


def swaps(n: int) -> Iterator[int]:
    """The places k such that swapping k and k + 1, one after the other, visits all orders of ``n`` things once."""
    place, way = list(range(n)), [-1] * n  # of each thing
    at = list(range(n))  # what stands where
    while True:
        movable = [x for x in range(n) if 0 <= place[x] + way[x] < n and at[place[x] + way[x]] < x]
        if not movable:
            return
        x = max(movable)
        y = at[place[x] + way[x]]
        yield min(place[x], place[y])
        place[x], place[y] = place[y], place[x]
        at[place[x]], at[place[y]] = x, y
        for z in range(x + 1, n):
            way[z] = -way[z]


def walk(counts: np.ndarray) -> list[tuple]:
    """counts: masks x (n, good, toxic) of one part. Returns (order, step, kept, removed, redundant, unique fails, good lost, toxic
    lost, shapley) for every order and step."""
    size = len(FILTERS)
    masks = np.arange(1 << size)
    failing = [int(counts[masks >> f & 1 == 1, 0].sum()) for f in range(size)]
    alone = [int(counts[1 << f, 0]) for f in range(size)]

    def removed(f: int, before: int) -> np.ndarray:
        """What ``f`` takes of that which passes all filters in ``before``."""
        return counts[(masks & before == 0) & (masks >> f & 1 == 1)].sum(axis=0)

    order = list(range(size))
    taken = [removed(f, (1 << f) - 1) for f in order]
    orders, shapley = [], np.zeros(size, np.int64)

    def visit() -> None:
        orders.append((list(order), [t.copy() for t in taken]))
        for f, t in zip(order, taken, strict=True):
            shapley[f] += t[0]

    visit()
    for k in swaps(size):
        order[k], order[k + 1] = order[k + 1], order[k]
        before = sum(1 << f for f in order[:k])
        taken[k], taken[k + 1] = removed(order[k], before), removed(order[k + 1], before | 1 << order[k])
        visit()
    out = []
    for order, taken in orders:
        left, name = int(counts[:, 0].sum()), "".join(FILTERS[f] for f in order)
        for step, (f, t) in enumerate(zip(order, taken, strict=True), 1):
            gone, good, toxic = (int(v) for v in t)
            left -= gone
            out.append((name, step, left, gone, failing[f] - gone, alone[f], good, toxic, int(shapley[f])))
    return out


COLUMNS = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _walks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for r in batch.itertuples(index=False):
            counts = np.zeros((1 << len(FILTERS), 3), np.int64)
            for c in r.cells:
                counts[c["mask"]] = c["n"], c["good"], c["toxic"]
            done = pd.DataFrame(walk(counts), columns=COLUMNS)
            done.insert(0, "part", r.part)
            yield done


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (a lang; null is the empty string), order of the five filters and step.

    kept, removed: documents after and at this step; redundant: those that fail its filter and were removed earlier;
    unique_fails: those that fail no other; good_lost, toxic_lost: those removed here that are labelled so; shapley:
    what its filter removes, summed over all orders.

    A null text is an empty one, and such texts are copies of one another. Repeated rows are documents of their own; rows
    that share doc_id and text aren't copies of each other, as neither has the smaller id. Rows without doc_id are no
    copies, make none, and have no label. If a document has several labels, one that says so is enough; null labels say
    nothing. An empty table has no parts and gives no rows. Other columns aren't read.
    """
    found = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS[2:])
    return found.mapInPandas(_walks, schema)
