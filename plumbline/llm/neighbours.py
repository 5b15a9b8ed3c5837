"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample of vectors is split into balanced parts with few edges between them; a small network
learns to tell from a vector in which parts its neighbours lie (Dong, Indyk, Razenshteyn and Wagner, "Learning Space
Partitions for Nearest Neighbor Search", 2020). It puts every vector into its most probable part, and sends a query to
the most probable parts, as many as make up a share of probability. The share is measured on vectors of the sample that
neither graph nor network have seen: with it, ``recall`` of their true neighbours are in the parts that they are sent to.

The search itself is over all vectors. Those of a part are stored in blocks and the blocks in segments; blocks of queries
meet segments of the parts they are sent to, and a task keeps the best few of each query while it reads a segment.
Equal vectors are one class with its smallest ids, so that a vector that many rows have is compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut
from plumbline.llm.embeddings import usable

SAMPLE, PER_PART = 16_384, 128  # vectors that the index is fitted on at most; of them by part
DEGREE, HIDDEN, ROUNDS, HELD_OUT = 10, 128, 40, 8  # neighbours in the graph; units; passes; one in so many calibrates
BLOCK, SEGMENT = 4096, 64  # vectors of a block, blocks of a segment
CELLS = 1 << 20  # numbers of a block at most (8 MB)
CHUNK = 256  # queries that are compared with a block at once


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, which changes no digit, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row pair, in doubles; rows are ``scaled``."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# ---- the graph and its parts -------------------------------------------------------------------


def neighbour_graph(spark, x: np.ndarray, k: int) -> np.ndarray:
    """rows x k: the nearest others of each row of ``x``, nearest first. Blocks of rows are tasks."""
    shared = spark.sparkContext.broadcast(x)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in batch["id"]:
                all_ = shared.value
                dots = all_[start : start + 512] @ all_.T
                at = np.arange(len(dots))
                dots[at, at + start] = -np.inf
                best = np.argpartition(-dots, k - 1, axis=1)[:, :k] if k < len(all_) else np.argsort(-dots, axis=1)[:, :k]
                order = np.argsort(-np.take_along_axis(dots, best, 1), axis=1, kind="stable")
                yield pd.DataFrame({"start": [start], "near": [np.take_along_axis(best, order, 1).astype(np.int32).tobytes()]})

    k = min(k, len(x) - 1)
    starts = spark.range(0, len(x), 512, numPartitions=max(1, -(-len(x) // 512)))
    rows = sorted(starts.mapInPandas(near, "start long, near binary").collect())
    shared.unpersist()
    return np.concatenate([np.frombuffer(r["near"], np.int32).reshape(-1, k) for r in rows])


def bisect(src: np.ndarray, dst: np.ndarray, n: int, share: float, rng: np.random.Generator) -> np.ndarray:
    """Sides of ``n`` nodes, ``share`` of them on side 0, with few edges (given in both directions) between the sides: a split
    along the slowest mode of a random walk, bettered by swapping nodes that gain."""
    small = max(1, min(n - 1, round(n * share)))
    degree = np.maximum(np.bincount(src, minlength=n), 1)
    v = rng.normal(size=n)
    for _ in range(60):
        v -= (v * degree).sum() / degree.sum()
        v = 0.5 * v + 0.5 * np.bincount(src, v[dst], n) / degree
        v /= max(np.abs(v).max(), 1e-300)
    side = np.ones(n, np.int8)
    side[np.argsort(v, kind="stable")[:small]] = 0
    cut_edges = (side[src] != side[dst]).sum()
    for _ in range(20):
        away = np.bincount(src, side[src] != side[dst], n)
        gain = 2 * away - np.bincount(src, minlength=n)
        a, b = (np.flatnonzero(side == s) for s in (0, 1))
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        m = int((gain[a[:m]] + gain[b[:m]] > 0).sum())
        while m:
            tried = side.copy()
            tried[a[:m]], tried[b[:m]] = 1, 0
            crossing = (tried[src] != tried[dst]).sum()
            if crossing < cut_edges:
                break
            m //= 2
        if not m:
            return side
        side, cut_edges = tried, crossing
    return side


def balanced_parts(near: np.ndarray, parts: int, seed: int = 1) -> np.ndarray:
    """The part of each node of the graph ``near`` (rows x k), by recursive bisection; sizes differ by rounding only."""
    rng = np.random.default_rng(seed)
    n, k = near.shape
    src = np.concatenate([np.repeat(np.arange(n), k), near.ravel()])
    dst = np.concatenate([near.ravel(), np.repeat(np.arange(n), k)])
    out = np.zeros(n, np.int32)
    todo = [(np.arange(n), src, dst, 0, parts)]
    while todo:
        nodes, s, d, first, count = todo.pop()
        if count == 1 or len(nodes) < 2:
            out[nodes] = first
            continue
        left = count // 2
        side = bisect(s, d, len(nodes), left / count, rng)
        number = np.zeros(len(nodes), np.int64)
        for here, at, parts_here in ((0, first, left), (1, first + left, count - left)):
            chosen = side == here
            number[chosen] = np.arange(chosen.sum())
            inside = (side[s] == here) & (side[d] == here)
            todo.append((nodes[chosen], number[s[inside]], number[d[inside]], at, parts_here))
    return out


# ---- the classifier ----------------------------------------------------------------------------


@dataclass
class Router:
    """A network of one hidden layer from unit vectors of ``size`` to probabilities of parts; queries take the most probable
    parts until those ahead make up ``mass``."""

    size: int
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    mass: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.layers
        z = np.maximum(x @ w + b, 0) @ v + c
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts by falling probability, and the probability of those ahead of each."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        sorted_ = np.take_along_axis(p, order, 1)
        return order, np.cumsum(sorted_, axis=1) - sorted_


def train(x: np.ndarray, wanted: np.ndarray, seed: int = 1) -> Router:
    """Fit the network to ``wanted`` (rows x parts, shares of a vector's neighbours) by Adam on cross-entropy."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], wanted.shape[1]
    layers = [rng.normal(size=(d, HIDDEN)) * np.sqrt(2.0), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts)]
    first, second, step = [np.zeros_like(a) for a in layers], [np.zeros_like(a) for a in layers], 0
    for epoch in range(ROUNDS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            chosen = order[at : at + 256]
            w, b, v, c = layers
            a = x[chosen]
            h = np.maximum(a @ w + b, 0)
            z = h @ v + c
            z = np.exp(z - z.max(axis=1, keepdims=True))
            e = (z / z.sum(axis=1, keepdims=True) - wanted[chosen]) / len(chosen)
            back = (e @ v.T) * (h > 0)
            step += 1
            rate = 0.01 * (1 - epoch / ROUNDS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in enumerate((a.T @ back, back.sum(0), h.T @ e, e.sum(0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return Router(d, tuple(layers))


def fit(spark, x: np.ndarray, parts: int, k: int, recall: float) -> Router:
    """A router for the unit vectors ``x`` (a sample, in random order) into ``parts`` parts, calibrated for ``recall`` of ``k`` neighbours."""
    n = len(x)
    held = np.arange(n) % HELD_OUT == 0
    if parts < 2 or n < 4 * HELD_OUT:
        router = Router(x.shape[1], (np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)))
        return router
    seen = x[~held]
    near = neighbour_graph(spark, seen, DEGREE)
    part = balanced_parts(near, parts)
    wanted = np.zeros((len(seen), parts))
    rows = np.arange(len(seen))
    wanted[rows, part] = 1
    for column in near.T:
        np.add.at(wanted, (rows, part[column]), 1)
    router = train(seen, wanted / wanted.sum(axis=1, keepdims=True))
    truth = neighbour_graph(spark, x, k)[held]
    at = router.probabilities(x).argmax(axis=1)
    order, ahead = router.ranked(x[held])
    place = np.argsort(order, axis=1)  # of each part
    needed = np.take_along_axis(ahead, np.take_along_axis(place, at[truth], 1), 1)
    router.mass = float(np.quantile(needed, recall, method="higher"))
    return router


# ---- the search --------------------------------------------------------------------------------


def _route(router: Router):
    """For mapInPandas: the part of each class and, for queries, the parts they are sent to. Vectors of another size have a
    part of their own by size, and are searched whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["embedding"].map(len).to_numpy()
            part, probes = -sizes.astype(np.int64), [[-int(s)] if q else [] for s, q in zip(sizes, batch["asks"], strict=True)]
            at = np.flatnonzero(sizes == router.size)
            for some in (at[k : k + 2048] for k in range(0, len(at), 2048)):
                order, ahead = router.ranked(unit(np.array(batch["embedding"].iloc[some].tolist(), np.float64)))
                part[some] = order[:, 0]
                for i, o, a in zip(some, order, ahead, strict=True):
                    if probes[i]:
                        probes[i] = o[a <= router.mass].tolist()
            yield pd.DataFrame({"part": part, "probes": probes, "node": batch["node"], "embedding": batch["embedding"], "ids": batch["ids"]})

    return run


def _blocks(kind: str, most: int, ids: int):
    """For mapInPandas on rows in order of (part, node): one row a block, of one part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, made = TaskContext.get().partitionId() << 32, 0
        held: pd.DataFrame | None = None

        def block(rows: pd.DataFrame) -> dict:
            nonlocal made
            listed = rows["ids"].tolist() if ids else []
            table = np.zeros((len(listed), ids + 1), np.int64)  # how many, and these
            for line, values in zip(table, listed, strict=True):
                line[0], line[1 : len(values) + 1] = len(values), values
            made += 1
            return {
                "part": int(rows["part"].iloc[0]), "block": base + made - 1, "segment": base + (made - 1) // SEGMENT, "node": rows["node"].to_numpy(np.int64).tobytes(),
                "ids": table.tobytes(), "vectors": np.array(rows["embedding"].tolist(), kind).tobytes(),
            }

        for batch in batches:
            held = batch if held is None else pd.concat([held, batch])
            part, out, at = held["part"].to_numpy(), [], 0
            turns = np.flatnonzero(part[1:] != part[:-1]) + 1
            for end in [*turns, len(held)]:
                if at < end:
                    full = max(1, min(most, CELLS // max(1, len(held["embedding"].iloc[at]))))
                    while end - at >= full or (end < len(held) and end > at):
                        out.append(block(held.iloc[at : min(at + full, end)]))
                        at = min(at + full, end)
            held = held.iloc[at:]
            if out:
                yield pd.DataFrame(out)
        if held is not None and len(held):
            yield pd.DataFrame([block(held)])

    return run


def _best(query: np.ndarray, id_: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The ``most`` best rows of each query: by falling score, then id."""
    order = np.lexsort((id_, -score, query))
    query, id_, score = query[order], id_[order], score[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    return query[rank < most], id_[rank < most], score[rank < most]


def _compare(kind: str, most: int):
    """For mapInPandas on rows (part, queries, segment, side, block, node, ids, vectors) in order: a block of queries, then the
    blocks of a segment. Gives the ``most`` best of each query in the segment."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def load(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            node = np.frombuffer(r.node, np.int64)
            raw = scaled(np.frombuffer(r.vectors, kind).astype(np.float64).reshape(len(node), -1))
            return node, raw, raw / np.linalg.norm(raw, axis=1, keepdims=True)

        node = raw = x = None
        found: tuple[np.ndarray, ...] | None = None

        def done() -> pd.DataFrame:
            return pd.DataFrame({"node": node[found[0]], "vec_id": found[1], "score": found[2]})

        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.side == 0:
                    if found is not None:
                        yield done()
                    node, raw, x = load(r)
                    found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
                    bound = np.full(len(node), -np.inf)
                    continue
                _, other, y = load(r)
                table = np.frombuffer(r.ids, np.int64).reshape(len(y), -1)
                for a in range(0, len(x), CHUNK):
                    dots = x[a : a + CHUNK] @ y.T
                    least = np.maximum(bound[a : a + CHUNK], np.partition(dots, -most, axis=1)[:, -most] if dots.shape[1] > most else -np.inf)
                    i, j = np.nonzero(dots >= least[:, None] - 1e-9)
                    if not len(i):
                        continue
                    score = cosines(raw[i + a], other[j])
                    count = table[j, 0]
                    line, at = np.repeat(np.arange(len(j)), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    new = _best(i[line] + a, table[j[line], at + 1], score[line], most)
                    mine = (found[0] >= a) & (found[0] < a + CHUNK)
                    merged = _best(*(np.concatenate([f[mine], g]) for f, g in zip(found, new, strict=True)), most)
                    found = tuple(np.concatenate([f[~mine], g]) for f, g in zip(found, merged, strict=True))
                    full = np.bincount(merged[0], minlength=len(node)) == most
                    last = np.full(len(node), np.inf)
                    np.minimum.at(last, merged[0], merged[2])
                    bound = np.where(full, last, bound)
        if found is not None:
            yield done()

    return run


def search(vectors: DataFrame, asks: Column, k: int = 5, recall: float = 0.98, sample: int = SAMPLE, block_rows: int = BLOCK) -> DataFrame:
    """The ``k`` nearest of each row of ``vectors`` (vec_id, embedding) for which ``asks`` is true: query_id, rank (from 1), vec_id
    and score, the cosine of the given vectors in double precision. Ties go to the smaller vec_id.

    All rows are candidates but the query's own. Vectors that are null, empty, all zero, or hold null or non-finite
    components take no part, and neither do rows without vec_id; a condition that is null asks for nothing. Vectors of
    different sizes have no cosine: sizes other than the commonest are searched whole. Rows that share vec_id and vector are one row;
    rows that share only vec_id are queries of their own, and none finds a row of its id. A query with fewer candidates gets
    them all. Empty table, or no query: empty result. Extra columns aren't read, but by the condition.

    The index is fitted on about ``sample`` vectors (a stated bound), those of the smallest hashes: one part for each 128 of
    them, and as many parts searched as give ``recall`` on vectors held out. All vectors are indexed.
    """
    spark = vectors.sparkSession
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    type_, kind = ("array<float>", "f4") if single else ("array<double>", "f8")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(type_), F.coalesce(asks, F.lit(False)).alias("asks"))
    good = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    # 128 bits of hash stand for a vector
    marked = good.select("vec_id", "embedding", "asks", F.xxhash64("embedding").alias("h"), F.xxhash64(F.lit("second"), "embedding").alias("g"))
    nth = F.row_number().over(Window.partitionBy("h", "g").orderBy("vec_id"))
    # the smallest ids of a class; each task keeps that many before rows travel
    least = marked.select("h", "g", "vec_id").distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
    least = least.groupBy("h", "g").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = marked.groupBy("h", "g").agg(F.first("embedding").alias("embedding"), F.max("asks").alias("asks")).join(least, ["h", "g"])
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))

    sizes = classes.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size, count = (sizes[0]["size"], sizes[0]["count"]) if sizes else (0, 0)
    share = int(min(1.0, sample / max(1, count)) * (1 << 30))
    chosen = classes.where((F.size("embedding") == size) & (F.pmod(F.xxhash64("h", "g"), F.lit(1 << 30)) < share))
    picked = chosen.select("embedding").orderBy(F.xxhash64("h", "g"), "h", "g").toPandas()  # about ``sample`` rows
    x = unit(np.array(picked["embedding"].tolist(), np.float64)) if len(picked) else np.zeros((0, size))
    router = fit(spark, x, len(x) // PER_PART, k, recall)

    schema = f"part long, probes array<long>, node long, embedding {type_}, ids array<long>"
    placed = cut(classes.select("node", "embedding", "asks", "ids").mapInPandas(_route(router), schema))
    order = ["part", "node"]
    packed = "part long, block long, segment long, node binary, ids binary, vectors binary"
    stored = placed.select("part", "node", "embedding", "ids").repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = cut(stored.mapInPandas(_blocks(kind, block_rows, k + 1), packed))
    sent = placed.select(F.explode("probes").alias("part"), "node", "embedding", F.lit(None).cast("array<long>").alias("ids"))
    asked = cut(sent.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_blocks(kind, block_rows, 0), packed))

    # numbers of blocks only: which queries meet which segments
    meet = cut(asked.select("part", F.col("block").alias("queries")).join(blocks.select("part", "segment").distinct(), "part"))
    columns = ["part", "queries", "segment", "side", "block", "node", "ids", "vectors"]
    left = asked.withColumnRenamed("block", "queries").drop("segment").join(meet, ["part", "queries"]).withColumns({"side": F.lit(0), "block": F.lit(0).cast("long")}).select(columns)
    right = blocks.join(meet, ["part", "segment"]).withColumn("side", F.lit(1)).select(columns)
    key = ["part", "queries", "segment"]
    together = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "side", "block")
    found = together.mapInPandas(_compare(kind, k + 1), "node long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("place", place).where(F.col("place") <= k + 1)
    best = cut(found.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best")))

    known = classes.where("asks").select("h", "g", "node").join(best, "node").select("h", "g", "best")
    queries = marked.where("asks").select(F.col("vec_id").alias("query_id"), "h", "g").distinct().join(known, ["h", "g"])
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return queries.select("query_id", F.posexplode(others).alias("at", "other")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("other.vec_id").alias("vec_id"), F.col("other.score").alias("score"))
