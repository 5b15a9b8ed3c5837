"""Embedding near-dedup by an epsilon grid order join.

Vectors are scaled to length 1, where cosine >= c means a distance of at most eps = sqrt(2 - 2c), and
turned onto principal axes, which changes no distance. Sorted by their grid cells (side eps) on the
leading axes they form one sequence. The sequence is stored in blocks with the box of their leading
coordinates. Intervals of blocks that meet or touch in a cell of the first axes are joined first, then blocks of
the intervals that are near enough, then halves of blocks, recursively; whatever is provably more than eps apart is skipped (Boehm,
Braunmueller, Krebs and Kriegel, "Epsilon Grid Order", 2001). What is left is compared in double precision.

Equal vectors are one class with a weight and a number, which stands for the vector from there on. A pair of blocks
gives a count and a root a vector, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut
from plumbline.llm.graph import components

LEAF = 128
CELLS = 1 << 21  # numbers that a block holds at most: 16 MB
GRID = 3  # leading axes whose cells are keys of the interval join


def usable(vector: Column) -> Column:
    """True for a vector with finite components that aren't all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def _scaled(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of extreme components neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, size: int, rows: int, axes: int, sample: int = 20_000) -> np.ndarray:
    """size x axes: the leading principal axes of vectors of that size, of which there are ``rows``. They are fitted on about
    ``sample`` of them (a stated bound), those of the smallest hashes: axes decide how much is skipped, not what is found."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            if len(batch):
                x = _scaled(batch["embedding"])
                total += x.T @ x
        yield pd.DataFrame({"part": [total.tobytes()]})

    if not size:
        return np.eye(size)[:, :axes]
    share = int(min(1.0, sample / max(1, rows)) * (1 << 30))
    chosen = vectors.where((F.size("embedding") == size) & (F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < share))
    parts = chosen.select("embedding").repartition(4).mapInPandas(part, "part binary").collect()  # four matrices
    total = sum(np.frombuffer(r["part"]).reshape(size, size) for r in parts)
    return np.linalg.eigh(total)[1][:, ::-1][:, :axes].copy()


def _on_axes(x: np.ndarray, turn: np.ndarray, axes: int) -> np.ndarray:
    """Leading coordinates; vectors of another size are projected onto their first components instead."""
    out = x @ turn if x.shape[1] == len(turn) else x[:, :axes]
    return np.pad(out, ((0, 0), (0, axes - out.shape[1])))


def _cells(turn: np.ndarray, axes: int, eps: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            cells = np.zeros((len(batch), axes), np.int32)
            sizes = batch["embedding"].map(len).to_numpy()
            for size in np.unique(sizes):
                at = sizes == size
                cells[at] = np.floor(_on_axes(_scaled(batch["embedding"][at]), turn, axes) / eps)
            out = batch.assign(size=sizes.astype(np.int32))
            for k in range(axes):
                out[f"c{k}"] = cells[:, k]
            yield out

    return run


def _blocks(turn: np.ndarray, axes: int, most: int, per_interval: int, kind: str):
    """For mapInPandas on the sorted sequence: one row a block, of one label and vector size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = TaskContext.get().partitionId() << 32
        made = 0

        def block(part: pd.DataFrame) -> dict:
            nonlocal made
            x = np.array(part["embedding"].tolist(), np.float64)
            leading = _on_axes(_scaled(part["embedding"]), turn, axes)
            row = {
                "block": base + made, "interval": base + made // per_interval, "label": int(part["label"].iloc[0]), "size": int(part["size"].iloc[0]),
                "node": part["node"].to_numpy(np.int64).tobytes(), "weight": part["weight"].to_numpy(np.int64).tobytes(), "vectors": x.astype(kind).tobytes(),
                "lo": leading.min(0).tolist(), "hi": leading.max(0).tolist(),
            }
            made += 1
            return row

        held: pd.DataFrame | None = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch])
            out = []
            turns = np.flatnonzero((held["label"].diff().to_numpy()[1:] != 0) | (held["size"].diff().to_numpy()[1:] != 0)) + 1
            at = 0
            for end in [*turns, len(held)]:
                rows = max(1, min(most, CELLS // max(1, int(held["size"].iloc[at])))) if at < len(held) else most
                while end - at >= rows or (end < len(held) and end > at):
                    out.append(block(held.iloc[at : min(at + rows, end)]))
                    at = min(at + rows, end)
            held = held.iloc[at:]
            if out:
                yield pd.DataFrame(out)
        if held is not None and len(held):
            yield pd.DataFrame([block(held)])

    return run


def _apart(lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> float:
    gap = np.maximum(0.0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float(gap @ gap)


def near_pairs(x: np.ndarray, y: np.ndarray, at_x: np.ndarray, at_y: np.ndarray, cosine: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors with x . y >= cosine, by recursive halving of both sequences. same: each pair once."""
    eps2 = (2 - 2 * cosine) * (1 + 1e-9) + 1e-12
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d or (same and c < a):
            continue
        p, q = at_x[a:b], at_y[c:d]
        if _apart(p.min(0), p.max(0), q.min(0), q.max(0)) > eps2:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            dots = x[a:b] @ y[c:d].T
            i, j = np.nonzero(dots >= cosine - 1e-9)
            i, j = i + a, j + c
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        half = LEAF * max(1, -(-max(b - a, d - c) // (2 * LEAF)))
        for m in {a, min(a + half, b)}:
            for n in {c, min(c + half, d)}:
                todo.append((m, min(m + half, b), n, min(n + half, d)))


def exact(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Whether the cosine of each row pair reaches the bound, straight from the given components."""
    a, b = (v / np.abs(v).max(axis=1, keepdims=True) for v in (a, b))
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))) >= cosine


def _compare(turn: np.ndarray, axes: int, cosine: float, kind: str):
    """For mapInPandas on rows (a, b, side, node, weight, vectors) in order: one row where a block meets itself, else two."""

    def load(r) -> tuple[np.ndarray, ...]:
        node = np.frombuffer(r.node, np.int64)
        raw = np.frombuffer(r.vectors, kind).astype(np.float64).reshape(len(node), -1)
        x = raw / np.abs(raw).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        return node, np.frombuffer(r.weight, np.int64), raw, x, _on_axes(x, turn, axes)

    def met(first, second) -> pd.DataFrame | None:
        same = second is None
        node_a, weight_a, raw_a, x, at_x = load(first)
        node_b, weight_b, raw_b, y, at_y = (node_a, weight_a, raw_a, x, at_x) if same else load(second)
        shift = 0 if same else len(x)
        n = shift + len(y)
        links, label = np.zeros(n, np.int64), np.arange(n)
        for i, j in near_pairs(x, y, at_x, at_y, cosine, same):
            ok = exact(raw_a[i], raw_b[j], cosine)
            i, j = i[ok], j[ok]
            np.add.at(links, i, weight_b[j])
            np.add.at(links, j + shift, weight_a[i])
            label = _joined(label, i, j + shift)
        node = node_a if same else np.concatenate([node_a, node_b])
        got = links > 0
        return pd.DataFrame({"node": node[got], "links": links[got], "root": node[label[got]]}) if got.any() else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = None
        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.a == r.b:
                    found = met(r, None)
                elif r.side == 0:
                    first, found = r, None
                else:
                    found, first = met(first, r), None
                if found is not None:
                    yield found

    return run


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while (open_ := label[a] != label[b]).any():
        x, y = label[a[open_]], label[b[open_]]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up
    return label


def link(vectors: DataFrame, cosine: float = 0.98, axes: int = 6, block_rows: int = 4096, per_interval: int = 4) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``, which needs vec_id, embedding and label.

    Two rows are linked if their labels are equal and not null, their vectors have one size and their cosine is
    at least ``cosine``. Vectors that are null, empty, all zero, or hold null or non-finite components link with
    nothing. n_links counts the other rows linked directly, component_id is the smallest vec_id reachable, kept
    says whether that is the row's own. Repeated rows are rows of their own and link each other, and so are rows
    that share a vec_id only. A row without vec_id links like others; component_id is null where no row with an id
    is reached. Blocks hold ``block_rows`` vectors, fewer of long ones. Empty table: empty result. Other columns
    are not read.
    """
    if not 0.0 < cosine <= 1.0:
        raise ValueError("cosine must be over 0 and at most 1")
    eps = math.sqrt(max(2 - 2 * cosine, 1e-12))
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    type_, kind = ("array<float>", "f4") if single else ("array<double>", "f8")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast(type_))
    good = rows.where(F.col("label").isNotNull() & usable(F.col("embedding")))
    # 128 bits of hash stand for a vector and its label: the vectors themselves are no join key
    marked = good.select("vec_id", "label", "embedding", F.xxhash64("label", "embedding").alias("h"), F.xxhash64(F.lit("second"), "label", "embedding").alias("g"))
    classes = marked.groupBy("h", "g").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
    sizes = good.groupBy(F.size("embedding").alias("s")).count().orderBy(F.desc("count"), "s").limit(1).collect()
    turn = principal_axes(good, sizes[0]["s"] if sizes else 0, sizes[0]["count"] if sizes else 0, axes)

    cells = [f"c{k}" for k in range(axes)]
    schema = f"label long, embedding {type_}, node long, weight long, size int" + "".join(f", {c} int" for c in cells)
    placed = classes.select("label", "embedding", "node", "weight").mapInPandas(_cells(turn, axes, eps), schema)
    order = ["label", "size", *cells, "node"]
    sequence = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("label", "embedding", "node", "weight", "size")
    schema = "block long, interval long, label long, size int, node binary, weight binary, vectors binary, lo array<double>, hi array<double>"
    blocks = cut(sequence.mapInPandas(_blocks(turn, axes, block_rows, per_interval, kind), schema))

    boxes = blocks.select("block", "interval", "label", "size", "lo", "hi")
    ends = [f(F.col(c)[k]).alias(f"{c}{k}") for c, f in (("lo", F.min), ("hi", F.max)) for k in range(axes)]
    wide = boxes.groupBy("interval", "label", "size").agg(*ends)
    wide = cut(wide.select("interval", "label", "size", *[F.array(*[f"{c}{k}" for k in range(axes)]).alias(c) for c in ("lo", "hi")]))
    limit = (2 - 2 * cosine) * (1 + 1e-9) + 1e-12

    def near(a: str, b: str) -> Column:
        gaps = [F.greatest(F.lit(0.0), F.col(f"{a}.lo")[k] - F.col(f"{b}.hi")[k], F.col(f"{b}.lo")[k] - F.col(f"{a}.hi")[k]) for k in range(axes)]
        return sum((g * g for g in gaps), F.lit(0.0)) <= limit

    def in_cells(more: int) -> DataFrame:
        """An interval in each cell of the leading axes that its box meets, and ``more`` to either side."""
        out = wide
        for k in range(min(GRID, axes)):
            low, high = (F.floor(F.col(c)[k] / F.lit(eps * (1 + 1e-9))) for c in ("lo", "hi"))
            out = out.withColumn(f"g{k}", F.explode(F.sequence(low - more, high + more)))
        return out

    # whatever is within eps of a box lies in its cells or beside them
    grid = ["label", "size", *[f"g{k}" for k in range(min(GRID, axes))]]
    x, y = (in_cells(more).select(*[F.col(c).alias(f"{side}_{c}") if c not in grid else F.col(c) for c in (*grid, "interval", "lo", "hi")]) for side, more in (("x", 1), ("y", 0)))
    met = x.join(y, grid).where("x_interval <= y_interval")
    met = met.select("label", "size", F.col("x_interval").alias("p"), F.col("y_interval").alias("q"), F.struct(F.col("x_lo").alias("lo"), F.col("x_hi").alias("hi")).alias("x"), F.struct(F.col("y_lo").alias("lo"), F.col("y_hi").alias("hi")).alias("y"))
    pairs = cut(met.where(near("x", "y")).select("label", "size", "p", "q").distinct())
    first = pairs.alias("i").join(boxes.alias("x"), (F.col("i.p") == F.col("x.interval")) & (F.col("i.label") == F.col("x.label")) & (F.col("i.size") == F.col("x.size")))
    first = first.select("i.*", F.struct("x.block", "x.lo", "x.hi").alias("x"))
    second = first.alias("i").join(boxes.alias("y"), (F.col("i.q") == F.col("y.interval")) & (F.col("i.label") == F.col("y.label")) & (F.col("i.size") == F.col("y.size")))
    second = second.select("i.x", F.struct("y.block", "y.lo", "y.hi").alias("y")).where((F.col("x.block") <= F.col("y.block")) & near("x", "y"))
    chosen = second.select(F.col("x.block").alias("a"), F.col("y.block").alias("b"))
    side = lambda k, of: F.struct(F.lit(k).alias("side"), F.col(of).alias("block"))
    sides = chosen.select("a", "b", F.inline(F.when(F.col("a") == F.col("b"), F.array(side(0, "a"))).otherwise(F.array(side(0, "a"), side(1, "b")))))

    # each block goes once to where its pairs are made, and from there to its pairs
    sent = blocks.select("block", "node", "weight", "vectors").join(cut(sides), "block").drop("block")
    together = sent.repartition("a", "b").sortWithinPartitions("a", "b", "side").select("a", "b", "side", "node", "weight", "vectors")
    found = cut(together.mapInPandas(_compare(turn, axes, cosine, kind), "node long, links long, root long"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.select("h", "g", "node", "least", "weight").join(counts, "node", "left").join(components(found.select("node", "root")), "node", "left")
    known = known.select("h", "g", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("root"))
    known = known.join(known.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("h", "g", "n_links", "component_id")
    lone = rows.where(~(F.col("label").isNotNull() & usable(F.col("embedding")))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = marked.select("vec_id", "h", "g").join(cut(known), ["h", "g"]).select("vec_id", "n_links", "component_id")
    return out.unionByName(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
