"""Whitening of embeddings by a tiled covariance.

Components become whole numbers, so that equal vectors are equal and sums are exact. The distinct vectors are packed into
row-blocks, each cut into column blocks of ``tile`` dimensions. The column blocks of a row-block meet on its number, every
pair of them is multiplied, and the products are summed by the tile of the matrix that they belong to: no task holds
more of the matrix than the tiles it works on, and none holds more rows than a block. The sums are put together and
decomposed once; rows are then projected where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 31)  # components times SCALE are held to +-LARGEST, so that n * x stays a long
TILE, CELLS = 64, 1 << 18  # dimensions of a tile; numbers of a row-block's column block at most (2 MB)
HELD = 64  # tiles whose sums a task keeps at once
LEAST = 1e-12  # components whose eigenvalue is a smaller share of the largest are no directions of the data


def whole(vector: Column) -> Column:
    """The components as longs, floor(64 * c) + 1000000."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT)


def finite(vector: Column) -> Column:
    """True for a vector that is there and whose components all are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums by dimension of a task's rows, as one row a dimension."""
    n, total = 0, None
    for batch in batches:
        if len(batch):
            x = np.array(batch["x"].tolist(), np.int64)
            n, total = n + len(x), x.sum(axis=0) if total is None else total + x.sum(axis=0)
    if n:
        yield pd.DataFrame({"dim": np.arange(len(total), dtype=np.int32), "n": n, "total": total})


def _column_blocks(n: int, total: np.ndarray, tile: int):
    """For mapInPandas on fit rows: a row for each column block of each row-block, centred before anything is multiplied."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = max(1, CELLS // tile)
        base, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for at in range(0, len(batch), rows):
                x = np.array(batch["x"].iloc[at : at + rows].tolist(), np.int64)
                centred = (n * x - total).astype(np.float64) / n
                parts = [np.ascontiguousarray(centred[:, c : c + tile]).tobytes() for c in range(0, len(total), tile)]
                yield pd.DataFrame({"row_block": base + made, "col": np.arange(len(parts), dtype=np.int32), "rows": len(x), "data": parts})
                made += 1

    return run


def _multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Products of pairs of column blocks, summed by tile as long as few tiles are held."""
    held: dict[tuple[int, int], np.ndarray] = {}

    def out() -> pd.DataFrame:
        tiles = sorted(held)
        return pd.DataFrame({"i": [t[0] for t in tiles], "j": [t[1] for t in tiles], "width": [held[t].shape[1] for t in tiles], "data": [held[t].tobytes() for t in tiles]})

    for batch in batches:
        for r in batch.itertuples(index=False):
            left = np.frombuffer(r.left, np.float64).reshape(r.rows, -1)
            right = np.frombuffer(r.right, np.float64).reshape(r.rows, -1)
            key = (r.i, r.j)
            held[key] = held[key] + left.T @ right if key in held else left.T @ right
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas on products in order of their tile: one row a tile. One tile is held at a time."""
    key, total, width = None, None, 0
    for batch in batches:
        for r in batch.itertuples(index=False):
            data = np.frombuffer(r.data, np.float64)
            if key == (r.i, r.j):
                total = total + data
                continue
            if key is not None:
                yield pd.DataFrame({"i": [key[0]], "j": [key[1]], "width": [width], "data": [total.tobytes()]})
            key, total, width = (r.i, r.j), data, r.width
    if key is not None:
        yield pd.DataFrame({"i": [key[0]], "j": [key[1]], "width": [width], "data": [total.tobytes()]})


def second_moments(fit: DataFrame, n: int, total: np.ndarray, tile: int = TILE) -> np.ndarray:
    """The covariance (divisor ``n``) of the rows ``x`` of ``fit``, whose sums by dimension are ``total``. The matrix comes to the
    driver tile by tile: its size is set by the dimensions, not by the rows."""
    blocks = cut(fit.select("x").mapInPandas(_column_blocks(n, total, tile), "row_block long, col int, rows int, data binary"))
    left = blocks.select("row_block", "rows", F.col("col").alias("i"), F.col("data").alias("left"))
    right = blocks.select("row_block", F.col("col").alias("j"), F.col("data").alias("right"))
    met = left.join(right, "row_block").where("i <= j").select("i", "j", "rows", "left", "right")
    schema = "i int, j int, width int, data binary"
    products = met.mapInPandas(_multiply, schema)
    summed = products.repartition("i", "j").sortWithinPartitions("i", "j").mapInPandas(_add_up, schema)
    out = np.zeros((len(total), len(total)))
    for r in summed.toLocalIterator():
        data = np.frombuffer(r["data"], np.float64).reshape(-1, r["width"]) / n
        a, b = r["i"] * tile, r["j"] * tile
        out[a : a + data.shape[0], b : b + data.shape[1]] = data
        out[b : b + data.shape[1], a : a + data.shape[0]] = data.T
    return out


def _project(n: int, total: np.ndarray, turn: np.ndarray, exact: bool):
    """For mapInPandas on (id, x): whitened coordinates, and the sum of squares of n * x - S if asked for."""
    bound = float(2**62)

    def deviation(v: np.ndarray) -> list:
        if (np.square(v.astype(np.float64)).sum(axis=1) < bound).all():
            return (v * v).sum(axis=1).tolist()
        sums = [sum(int(c) * int(c) for c in row) for row in v]
        return [s if s < 1 << 63 else None for s in sums]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.iloc[at : at + 2048]
                v = n * np.array(part["x"].tolist(), np.int64) - total
                out = pd.DataFrame({"vec_id": part["vec_id"], "coords": list((v.astype(np.float64) / n) @ turn)})
                if exact:
                    out["deviation"] = pd.array(deviation(v), dtype="Int64")
                yield out

    return run


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums and sums of products of a task's whitened coordinates, one small matrix a task."""
    n, s, p = 0, 0.0, 0.0
    for batch in batches:
        if len(batch):
            w = np.array(batch["coords"].tolist(), np.float64)
            n, s, p = n + len(w), s + w.sum(axis=0), p + w.T @ w
    if n:
        k = len(s)
        yield pd.DataFrame({"a": np.repeat(np.arange(k + 1), k), "b": np.tile(np.arange(k), k + 1), "v": np.concatenate([p.ravel(), s])})


def whiten(vectors: DataFrame, components: int = 16, tile: int = TILE) -> DataFrame:
    """The rows of ``vectors`` (vec_id, embedding) on their leading principal components, scaled to unit variance.

    Returns vec_id, component (from 1, by falling eigenvalue), n (distinct vectors, the list that everything is fitted
    on), deviation, whitened, explained and identity_error, as many rows a vector as there are components.

    Vectors that are null or hold null or non-finite components are left out. So are empty ones, and those whose size
    isn't the commonest (the largest of equally common ones): they have no place in the same space. Repeated rows have
    rows of their own each and count once in the fit; a null or repeated vec_id is returned as it is. Components of 2^25
    and more count as 2^25. A component without variance (an eigenvalue under 10^-12 of the largest) isn't returned, so
    equal vectors only, and an empty table, give an empty result. A deviation too large for a long is null. Signs are such that
    the largest entry of a component is positive. Other columns aren't read.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    good = vectors.select("vec_id", "embedding").where(finite(F.col("embedding")) & (F.size("embedding") > 0))
    sizes = good.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    rows = good.where(F.size("embedding") == sizes[0]["size"]).select("vec_id", whole(F.col("embedding")).alias("x"))
    fit = cut(rows.select("x").distinct())
    sums = fit.mapInPandas(_sums, "dim int, n long, total long").groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect()
    n, total = sums[0]["n"], np.array([r["total"] for r in sums], np.int64)
    covariance = second_moments(fit, n, total, tile)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    kept = values > max(values[0], 0.0) * LEAST
    values, axes = values[kept], axes[:, kept]
    if not len(values):
        return spark.createDataFrame([], schema)
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    turn = axes / np.sqrt(values)

    fitted = fit.select(F.lit(0).alias("vec_id"), "x").mapInPandas(_project(n, total, turn, False), "vec_id long, coords array<double>")
    parts = fitted.mapInPandas(_moments, "a int, b int, v double").groupBy("a", "b").agg(F.sum("v").alias("v")).collect()  # components squared
    k = len(values)
    sums = np.zeros((k + 1, k))
    for r in parts:
        sums[r["a"], r["b"]] = r["v"]
    mean = sums[k] / n
    error = float(np.abs(sums[:k] / n - np.outer(mean, mean) - np.eye(k)).max())

    shares = (values / np.trace(covariance)).tolist()
    done = rows.mapInPandas(_project(n, total, turn, True), "vec_id long, coords array<double>, deviation long")
    each = done.select("vec_id", "deviation", F.posexplode("coords").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*[F.lit(s) for s in shares]), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
