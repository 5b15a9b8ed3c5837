"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are made per document in Arrow batches. Documents of equal fingerprints become
one class before anything is compared. Classes meet in blocks that share a key; inside a block
the fingerprints' bits are stored as planes (one row a bit, one lane a pair), distances of 64
pairs a word are updated with carry-save adders, and words in which every lane is past the
radius are dropped. A block hands on a spanning forest of its links, never all its pairs.

Two ways to choose the blocks:

* ``pigeonhole``: fingerprints of 64 bits at ``radius`` bits. The bits are cut into
  ``radius + 3`` fields; two fingerprints within the radius agree on at least 3 of them, so
  every choice of 3 fields is a key. Exact: no link is lost.
* ``minwise``: wide fingerprints at a shingle similarity. Keys are bands of min-wise hashes of
  the shingles. Recall of the keys at the threshold is 1 - (1 - s^rows)^bands. The bits only choose
  candidates: the shingle sets go to the blocks too, and each pair is checked on them.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import cut, fresh
from plumbline.llm.graph import components

SEED = 42


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of the space-joined ``words``-word shingles, repeats included. A-Z is lower-cased;
    words are split at ASCII white space. Fewer words: one shingle of them all; none: empty."""
    parts = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    runs = [parts[i:] for i in range(min(words, len(parts)))]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(s), SEED) for s in zip(*runs, strict=False)), np.uint64)


def majority(hashes: np.ndarray) -> int:
    """64 bits, each 1 if set in over half of ``hashes``; 0 if there are none."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) >> 14)):  # very long texts: bounded memory
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def _mixed(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Another well-mixed 64-bit hash of each (the finaliser of SplitMix64)."""
    z = hashes + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


@F.pandas_udf(T.LongType())
def _one_word(texts: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([_signed(majority(shingle_hashes(t, w))) for t, w in zip(texts, words, strict=True)], dtype="int64")


def fingerprint(text: Column | str, words: int = 3) -> Column:
    """The 64-bit SimHash of each text as a long; null or blank text: 0."""
    return _one_word(text, F.lit(words))


def _minwise(words: int, rows: int, bands: int):
    """A digest of the shingle set, its size and its keys."""

    @F.pandas_udf("same binary, size long, keys array<long>")
    def run(texts: pd.Series) -> pd.DataFrame:
        same, size, keys = [], [], []
        for t in texts:
            u = np.unique(shingle_hashes(t, words))
            same.append(xxhash.xxh3_128_digest(u.tobytes()))
            size.append(len(u))
            if len(u):
                least = np.array([_mixed(u, 101 + k).min() for k in range(rows * bands)]).reshape(bands, rows)
                keys.append([_signed(xxhash.xxh64_intdigest(bytes([b]) + x.tobytes())) for b, x in enumerate(least)])
            else:
                keys.append([0])
        return pd.DataFrame({"same": same, "size": size, "keys": keys})

    return run


def _wide(width: int, words: int):
    """The sorted shingle set and its fingerprint; a repeated line weighs no more in the bits than in the set."""

    @F.pandas_udf("bits binary, shingles binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        sets = [np.unique(shingle_hashes(t, words)) for t in texts]
        bits = [b"".join(majority(_mixed(u, k) if k else u).to_bytes(8, "big") for k in range(width)) for u in sets]
        return pd.DataFrame({"bits": bits, "shingles": [u.tobytes() for u in sets]})

    return run


# ---- comparison inside a block -------------------------------------------------------------

LANES = 1 << 16  # pairs whose planes are held at a time
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def within(columns: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs (i[k], j[k]) differ in at most ``radius`` bits. columns: bytes of the fingerprints x items.

    Each pair is a lane of 64-bit words. A byte column gives eight bit planes of differences at a time. A pair's
    distance is kept bit-sliced in ``counter``, which starts at 2^k - 1 - radius, so a carry out of the top slice
    means "past the radius" and sticks. Words in which every lane is past it are dropped.
    """
    slices = max(1, radius.bit_length())
    start = (1 << slices) - 1 - radius
    found = np.zeros(len(i), bool)
    for at in range(0, len(i), LANES):
        a, b = i[at : at + LANES], j[at : at + LANES]
        n = len(a)
        size = -(-n // 64) * 64
        a, b = (np.concatenate([x, np.full(size - n, x[0])]).reshape(-1, 64) for x in (a, b))
        words = np.arange(len(a))
        counter = [np.full(len(a), FULL if start >> s & 1 else 0, np.uint64) for s in range(slices)]
        over = np.zeros(len(a), np.uint64)
        for column in columns:
            bits = np.unpackbits(column[a.ravel()] ^ column[b.ravel()]).reshape(-1, 8)
            planes = np.packbits(np.ascontiguousarray(bits.T), axis=1).view(np.uint64)
            for x, y in zip(planes[::2], planes[1::2], strict=True):
                low = counter[0]  # a full adder takes two planes at once
                carry = (low & x) | (low & y) | (x & y)
                counter[0] = low ^ x ^ y
                for s in range(1, slices):
                    counter[s], carry = counter[s] ^ carry, counter[s] & carry
                over |= carry
            alive = over != FULL
            if not alive.all():
                words, a, b, over = words[alive], a[alive], b[alive], over[alive]
                counter = [c[alive] for c in counter]
                if not len(words):
                    break
        if len(words):
            near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1)
            lanes = (words[:, None] * 64 + np.arange(64))[near.astype(bool)]
            found[at + lanes[lanes < n]] = True
    return found


def _root(label: np.ndarray) -> np.ndarray:
    while not np.array_equal(up := label[label], label):
        label = up
    return label


def alike(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs (i[k], j[k]) of the sorted ``sets`` have a Jaccard similarity of at least ``similarity``."""
    found = np.zeros(len(i), bool)
    for k, (a, b) in enumerate(zip(i, j, strict=True)):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) >= similarity * max(len(x), len(y)):
            both = len(np.intersect1d(x, y, assume_unique=True))
            found[k] = both >= similarity * (len(x) + len(y) - both)
    return found


def _forest(keys: np.ndarray, columns: np.ndarray, radius: int, sets: list[np.ndarray] | None = None, similarity: float = 0.0) -> np.ndarray:
    """A root for each row: rows joined by a chain of links inside equal keys get the same root.
    With ``sets``, a pair within the radius is a link only if its sets are ``alike`` too.

    keys: sorted. All pairs (r, r + d) of a shift d are compared at once; pairs that already have
    one root aren't compared again, so a dense group costs little more than its size.
    """
    n = len(keys)
    label = np.arange(n)
    left = np.flatnonzero(keys[1:] == keys[:-1])
    d = 1
    while len(left):
        todo = left[label[left] != label[left + d]]
        near = todo[within(columns, todo, todo + d, radius)] if len(todo) else todo
        if sets is not None:
            near = near[alike(sets, near, near + d, similarity)]
        if len(near):
            label = _joined(label, near, near + d)
        d += 1
        left = left[left + d < n]
        left = left[keys[left] == keys[left + d]]
        if d % 64 == 0 and len(left):  # blocks that are one group already need no further look
            last = np.searchsorted(keys, keys[left], "right") - 1
            first = np.searchsorted(keys, keys[left], "left")
            edge = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
            left = left[edge[first] != edge[last]]
    return label


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        x, y = label[a], label[b]
        if not (open_ := x != y).any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        label = _root(label)


def _links(width: int, radius: int, similarity: float | None = None):
    """For mapInPandas on rows (key, node, bits) sorted by key within each partition; with shingles if ``similarity`` is given."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        columns = np.ascontiguousarray(np.frombuffer(b"".join(rows["bits"]), np.uint8).reshape(len(rows), width * 8).T)
        node = rows["node"].to_numpy()
        sets = None if similarity is None else [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        root = node[_forest(rows["key"].to_numpy(), columns, radius, sets, similarity or 0.0)]
        return pd.DataFrame({"a": node, "b": root})[node != root]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = batch["key"].iloc[-1]
            if held and held[-1]["key"].iloc[-1] == last and batch["key"].iloc[0] == last:
                held.append(batch)  # one key goes on
                continue
            cut_at = int((batch["key"] != last).sum())
            if held or cut_at:
                yield solve(pd.concat([*held, batch.iloc[:cut_at]]))
            held = [batch.iloc[cut_at:]]
        if held:
            yield solve(pd.concat(held))

    return run


def _packed(bits: list[Column]) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(b), 16, "0") for b in bits]))


def link(keyed: DataFrame, prints: DataFrame, width: int, radius: int, block_rows: int = 50_000, similarity: float | None = None) -> DataFrame:
    """keyed: (key long, node long); prints: (node, bits binary of 8 * width bytes). Returns links (a, b) that join
    the same nodes as all links of at most ``radius`` bits between nodes of equal keys do. With ``similarity``, prints
    also hold ``shingles``, and only pairs of that Jaccard similarity are links: it is checked before a pair joins
    anything. A column ``weight`` of keyed says how many rows a node counts for.

    Fingerprints are only sent to blocks of two and more. A block of more than ``block_rows`` is dealt into parts of
    about that size twice, by two hashes of the node. Every part of one dealing shares nodes with every part of the
    other, so a group that fills the block is joined by that, with each of its rows sent twice. The rows that are not in
    the block's largest group by then meet each other and that group, part by part; only pairs inside it are left out.
    """
    if "weight" not in keyed.columns:
        keyed = keyed.withColumn("weight", F.lit(1))
    shared = keyed.groupBy("key").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    shared = cut(shared.select("key", F.ceil(F.col("n") / F.lit(float(block_rows))).cast("int").alias("parts")))
    met = keyed.join(shared, "key")

    def solved(blocks: DataFrame) -> DataFrame:
        rows = blocks.join(prints, "node").repartition("key").sortWithinPartitions("key", "node")
        columns = ["key", "node", "bits"] if similarity is None else ["key", "node", "bits", "shingles"]
        return rows.select(*columns).mapInPandas(_links(width, radius, similarity), "a long, b long")

    def part(dealing: int) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(dealing)), F.col("parts")).cast("int")

    own = [F.xxhash64("key", F.lit(k), part(k)) for k in (0, 1)]
    once = F.when(F.col("parts") == 1, F.array("key")).otherwise(F.array(*own))
    found = solved(met.select(F.explode(once).alias("key"), "node"))
    if shared.where("parts > 1").isEmpty():
        return found

    found = cut(found)
    joined = components(found)
    large = met.where("parts > 1").join(joined, "node", "left").select("key", "node", "weight", F.coalesce("component", "node").alias("group"))
    large = cut(large)
    groups = large.groupBy("key", "group").agg(F.sum("weight").alias("n"))
    sums = groups.groupBy("key").agg(F.max_by("group", F.struct("n", "group")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n"))
    sums = sums.where("n > n_main").select("key", "main", *[F.ceil(n / F.lit(float(block_rows))).cast("int").alias(c) for c, n in (("p", F.col("n_main")), ("q", F.col("n") - F.col("n_main")))])
    # written before it is joined: two plain shuffles are what adaptive execution can split at a large block
    left = large.join(cut(sums), "key")
    of_main, of_rest = (F.pmod(F.xxhash64("node", F.lit(2)), F.col(c)).cast("int") for c in ("p", "q"))

    def meeting(kind: int, x: Column, y: Column) -> Column:
        return F.xxhash64("key", F.lit(kind), x, y)

    with_main = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda k: meeting(2, of_rest, k))
    with_rest = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda k: meeting(3, F.least(of_rest, k), F.greatest(of_rest, k)))
    from_main = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda k: meeting(2, k, of_main))
    places = F.when(F.col("group") == F.col("main"), from_main).otherwise(F.concat(with_main, with_rest))
    return found.union(solved(left.select(F.explode(places).alias("key"), "node")))


def pigeonhole_keys(bits: Column, radius: int) -> Column:
    """An array of keys, of which two fingerprints within ``radius`` bits share at least one."""
    fields = radius + 3
    edges = [round(64 * k / fields) for k in range(fields + 1)]
    keys = []
    for n, chosen in enumerate(itertools.combinations(range(fields), 3)):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        keys.append(F.xxhash64(F.lit(n), bits.bitwiseAND(F.lit(_signed(mask)))))
    return F.array(*keys)


def components_by_fingerprint(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, ``fingerprint`` (long) and ``component_id`` of every row of ``docs``, which needs doc_id and text.

    Two documents are linked if their 64-bit fingerprints differ in at most ``radius`` bits;
    component_id is the smallest doc_id reachable over links, itself included. Null or blank
    texts have fingerprint 0 and are linked like any other. Repeated rows get one component.
    Rows without doc_id link like others; where only such rows are reached, component_id is null.
    Empty table: empty result. Other columns are not read.
    """
    # fingerprints are made once: both uses read what was written
    marked = cut(docs.select("doc_id", fingerprint("text", words).alias("fingerprint")))
    # documents of one fingerprint are one node, named by it
    classes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    nodes = classes.select(F.col("fingerprint").alias("node"))
    keyed = nodes.select(F.explode(pigeonhole_keys(F.col("node"), radius)).alias("key"), "node")
    found = components(link(keyed, nodes.select("node", _packed([F.col("node")]).alias("bits")), 1, radius))
    rooted = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.join(least, "root").select("fingerprint", "component_id"), "fingerprint").select("doc_id", "fingerprint", "component_id")


def near_dedup(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, width: int = 8, rows: int = 3, bands: int = 12, slack: float = 0.03,
    block_rows: int = 1024,
) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the smallest doc_id; all columns stay.

    Two documents are linked if their sets of ``words``-word shingles have a Jaccard similarity of at least
    ``similarity``. Candidates are pairs that meet in a band and whose fingerprints (``width`` * 64 bits of the set, each
    shingle counted once) differ in no more bits than sets of ``similarity`` are expected to (angle of the cosine
    2s / (1 + s)), plus a share ``slack`` of them, about two standard deviations; each is then checked on the shingles.
    So no pair below ``similarity`` is linked, of pairs at the threshold about 97 % are, 0.05 above it practically all.
    The groups are the components of these links. Null and blank texts are copies of each other. Rows without doc_id
    all stay. Rows that share a doc_id but not their text are documents of their own; of rows that share both, one
    stays (the first by its other columns). Empty table: empty result.
    """
    radius = int(64 * width * (math.acos(2 * similarity / (1 + similarity)) / math.pi + slack))
    mark = F.xxhash64("text").alias("mark")
    texts = docs.where("doc_id is not null").select("doc_id", "text")
    marked = texts.select("doc_id", mark, _minwise(words, rows, bands)("text").alias("m")).select("doc_id", "mark", "m.*")
    # documents of one shingle set are one class, and their keys are equal too; it is named once, as it is written
    classes = marked.groupBy("same").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.min("size").alias("size"), F.min("keys").alias("keys"))
    classes = cut(classes.drop("same").withColumn("node", F.monotonically_increasing_id()))
    weight = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(4096.0)).cast("int")).alias("weight")
    keyed = classes.select(F.explode("keys").alias("key"), "node", weight)
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    keyed = cut(keyed.join(shared, "key", "left_semi"))
    # only documents that share a key are read again and get bits and sets
    named = classes.select("node", "first.*").join(keyed.select("node").distinct(), "node", "left_semi")
    met = texts.withColumn("mark", mark).join(named, ["doc_id", "mark"]).dropDuplicates(["node"])
    prints = cut(met.select("node", _wide(width, words)("text").alias("w")).select("node", "w.*"))
    moved = components(link(keyed, prints, width, radius, block_rows, similarity))
    rooted = classes.select("node", "first").join(moved, "node", "left")
    kept = rooted.groupBy(F.coalesce("component", "node").alias("root")).agg(F.min("first").alias("f")).select("f.*")
    return one_of_each(docs, kept).unionByName(docs.where("doc_id is null"))


def one_of_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` (doc_id, mark: xxhash64 of the text) names, once each; of several rows with
    one id and text, the first by the other columns. Only such rows are grouped, the others pass through the join."""
    mark, whole = fresh(docs, "_mark"), fresh(docs, "_whole")
    marked = docs.where("doc_id is not null").withColumn(mark, F.xxhash64("text"))
    often = marked.groupBy("doc_id", mark).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    kept = kept.withColumnRenamed("mark", mark)
    keys = ["doc_id", mark]
    repeated = cut(kept.join(often, keys, "left_semi"))
    single = marked.join(cut(kept.join(repeated, keys, "left_anti")), keys, "left_semi").select(docs.columns)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}) if others else F.lit("")
    first = marked.join(repeated, keys, "left_semi").groupBy(*keys).agg(F.min_by(F.struct(*docs.columns), order).alias(whole))
    return single.unionByName(first.select(f"{whole}.*"))
