"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Every word n-gram of every training text is tested against a Bloom filter of the benchmark's n-grams,
   which has at least 16 bits for each of them, up to ``MAX_BITS``; what passes by chance falls out in the
   join. Seeds that lie close together in a text are one passage, cut out with as many words around it as
   the longest item has. Passages of the same words are one, however many documents hold them.
2. The seeds are counted over distinct passages, and passages meet items over them. Of neighbouring seeds that a
   passage shares with one item (``window`` places to either side) those are used that are at most ``common`` times
   as frequent as the rarest of them. So each passage keeps the rarest seeds of each item, whatever other passages
   hold and whatever other items it holds seeds of; a common phrase beside rarer ones of its item seeds nothing.
3. What has a seed left is aligned. Pairs that share too few words to reach the threshold go, the others
   are aligned word by word (match +2, other word -1, gap -1). The score is the best local alignment over
   that of the whole item with itself.

Texts are not shuffled, only the passages around hits.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut

WORD = re.compile(r"\w+")
MATCH, OTHER, GAP = 2, -1, -1
PASSAGE = ["doc_id", "first_word", "passage", "words", "hits"]
CHARACTERS = 2_000_000  # of passages that a worker holds before it hands them on
MAX_BITS = 30  # a filter of 128 MB at most; a larger benchmark lets more pass by chance, and loses nothing


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class _Known(dict):
    """Word -> hash, filled as words are asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class Hasher:
    """Word hashes, remembered up to a bound, and the hashes of word n-grams made of them."""

    def __init__(self):
        self.known = _Known()

    def words(self, words: list[str]) -> np.ndarray:
        if len(self.known) > 500_000:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    @staticmethod
    def grams(h: np.ndarray, n: int) -> np.ndarray:
        """One hash of each run of n words, given the words' hashes."""
        out = np.zeros(max(0, len(h) - n + 1), np.uint64)
        for k in range(n):
            out = (out ^ h[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out


def _bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Three places in a filter of 2^bits bits for each hash."""
    mask = np.uint64((1 << bits) - 1)
    second = hashes * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(17)
    return np.stack([hashes & mask, hashes >> np.uint64(64 - bits), second & mask])


def _filter_of(grams: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of the seeds: a few tasks make one each, which are or-ed one by one."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        set_ = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            places = _bit_places(batch["seed"].to_numpy(np.int64).view(np.uint64), bits).ravel()
            np.bitwise_or.at(set_, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
        yield pd.DataFrame({"part": [set_.tobytes()]})

    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in grams.select("seed").coalesce(4).mapInPandas(part, "part binary").toLocalIterator():
        out |= np.frombuffer(row["part"], np.uint8)
    return out


def _item_seeds(n: int):
    """(item, seed, n_words) of every n-gram of the items; of an item of fewer words, one seed of all of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"], strict=True):
                words = words_of(text)
                if words:
                    rows += [(item, g, len(words)) for g in hasher.grams(hasher.words(words), min(n, len(words))).view(np.int64).tolist()]
            yield pd.DataFrame(rows, columns=["item", "seed", "n_words"])

    return run


def _passages(shared, sizes: list[int], bits: int, around: int):
    """For mapInPandas on (doc_id, text): the passages with hits, (doc_id, first_word, passage, words, hits).
    sizes: the numbers of words that seeds have; hits: place in the text and seed, in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flat, hasher = shared.value, Hasher()
        mask = np.uint64((1 << bits) - 1)
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                if held > CHARACTERS:
                    yield pd.DataFrame(rows, columns=PASSAGE)
                    rows, held = [], 0
                words = words_of(text)
                hashes = hasher.words(words)
                found = []
                for size in sizes:
                    grams = hasher.grams(hashes, size)
                    low = grams & mask
                    maybe = np.flatnonzero(flat[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1)
                    if len(maybe):
                        places = _bit_places(grams[maybe], bits)
                        maybe = maybe[(flat[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1).all(axis=0)]
                        found += zip(maybe.tolist(), grams[maybe].view(np.int64).tolist(), strict=True)
                if not found:
                    continue
                found.sort()
                at = np.array([a for a, _ in found])
                edges = [0, *(np.flatnonzero(np.diff(at) > around) + 1).tolist(), len(at)]
                for a, b in zip(edges, edges[1:], strict=False):
                    first = max(0, int(at[a]) - around)
                    part = " ".join(words[first : int(at[b - 1]) + max(sizes) + around])
                    held += len(part)
                    rows.append((doc, first, xxhash.xxh3_128_hexdigest(part.encode("utf-8", "surrogatepass")), part, [{"at": p - first, "seed": s} for p, s in found[a:b]]))
            yield pd.DataFrame(rows, columns=PASSAGE)

    return run


def align(passage: list[str], item: list[str]) -> tuple[int, int, int]:
    """Smith-Waterman over words: (score, start, end) of the best local alignment, in words of the passage.

    Row by row over the item; gaps along the passage are a running maximum, so numpy does a whole row at once.
    """
    codes: dict[str, int] = {}
    a = np.array([codes.setdefault(w, len(codes)) for w in passage])
    b = [codes.get(w, -1) for w in item]
    if not len(a) or not b:
        return 0, 0, 0
    m = len(a)
    ramp = np.arange(m + 1)
    score = np.zeros(m + 1, np.int64)
    start = ramp.copy()
    best = (0, 0, 0)
    for w in b:
        diagonal = score[:-1] + np.where(a == w, MATCH, OTHER)
        up = score[1:] + GAP
        here = np.zeros(m + 1, np.int64)
        here[1:] = np.maximum(0, np.maximum(diagonal, up))
        origin = ramp.copy()
        origin[1:] = np.where(here[1:] == 0, ramp[1:], np.where(diagonal >= up, start[:-1], start[1:]))
        lifted = here - GAP * ramp  # a gap of g words costs g, so the best left neighbour is a running maximum
        top = np.maximum.accumulate(lifted)
        came = np.maximum.accumulate(np.where(lifted == top, ramp, 0))
        score = top + GAP * ramp
        start = np.where(score > 0, origin[came], ramp)
        if (k := int(score.argmax())) and score[k] > best[0]:
            best = (int(score[k]), int(start[k]), k)
    return best


def may_reach(passage: Counter, item: list[str], threshold: float) -> bool:
    """False if the two share too few words for an alignment of that score: each match takes one word of either."""
    return sum((passage & Counter(item)).values()) >= threshold * len(item)


def _aligned(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for passage, part in batch.groupby("passage", sort=False):
                words = part["words"].iloc[0].split(" ")
                counts = Counter(words)
                for item, text in zip(part["item"], part["text"], strict=True):
                    item_words = words_of(text)
                    if may_reach(counts, item_words, threshold):
                        got, a, b = align(words, item_words)
                        rows.append((passage, item, got / (MATCH * len(item_words)), a, b))
            yield pd.DataFrame(rows, columns=["passage", "item_id", "score", "start", "end"])

    return run


def matches(docs: DataFrame, items: DataFrame, n: int = 3, window: int = 4, common: float = 4.0, threshold: float = 0.5) -> DataFrame:
    """Leaks of ``items`` (item_id, text) in ``docs`` (doc_id, text): one row of each (doc_id, item_id)
    whose best alignment scores at least ``threshold``, with score (0 to 1), start_word, end_word and
    n_items, the number of items with the same words. Of alignments with equal scores the first counts.

    Words are runs of letters, digits and underscores in lower case, whatever stands between them. Items of
    equal text count as one, the smallest item_id. Items and documents without a word, and null texts, match
    nothing; items without item_id are left out, unless one of the same text has one. An item of ``n`` words or more is found where ``n`` of its words in a row are unchanged; one of
    fewer words, where all of them stand in a row. Rows without doc_id are left out; repeated rows give one
    result. Other columns are not read. Empty tables give an empty result.
    """
    items = items.where("text is not null").groupBy("text").agg(F.min("item_id").alias("item"), F.count(F.lit(1)).alias("n_items"))
    items = cut(items.where("item is not null"))
    grams = cut(items.select("item", "text").mapInPandas(_item_seeds(n), "item long, seed long, n_words int").distinct())
    of = grams.agg(F.count(F.lit(1)).alias("grams"), F.max("n_words").alias("longest"), F.collect_set(F.least("n_words", F.lit(n))).alias("sizes")).first()
    bits = min(MAX_BITS, max(16, math.ceil(math.log2(16 * max(1, of["grams"])))))
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(grams, bits))  # 2^bits bits
    around = 2 * (of["longest"] or 0) + n
    schema = "doc_id long, first_word long, passage string, words string, hits array<struct<at:int,seed:long>>"
    found = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    found = cut(found.mapInPandas(_passages(shared, sorted(of["sizes"]), bits, around), schema))
    passages = found.select("passage", "words", "hits").dropDuplicates(["passage"])

    # written before they are joined: two plain shuffles are what adaptive execution can split at a frequent seed
    hits = cut(passages.select("passage", F.inline("hits")).join(cut(grams.select("seed").distinct()), "seed", "left_semi"))
    seen = cut(hits.select("passage", "seed").distinct().groupBy("seed").agg(F.count(F.lit(1)).alias("seen")))
    # rarity is by passage and item: seeds of one item never hide those of another
    near = Window.partitionBy("passage", "item").orderBy("at").rangeBetween(1 - window, window - 1)  # as many rows as a passage has words
    shares = hits.join(seen, "seed").join(grams.select("item", "seed"), "seed")
    met = cut(shares.withColumn("_least", F.min("seen").over(near)).where(F.col("seen") <= common * F.col("_least")).select("passage", "item").distinct())
    pairs = met.join(items.select("item", "text"), "item").join(passages.select("passage", "words"), "passage")
    scored = pairs.select("passage", "words", "item", "text").mapInPandas(_aligned(threshold), "passage string, item_id long, score double, start long, end long")
    scored = scored.where(F.col("score") >= threshold)

    places = found.select("doc_id", "passage", "first_word").distinct()
    leaks = places.join(scored, "passage").select("doc_id", "item_id", "score", (F.col("first_word") + F.col("start")).alias("start_word"), (F.col("first_word") + F.col("end")).alias("end_word"))
    best = F.max_by(F.struct("score", "start_word", "end_word"), F.struct("score", -F.col("start_word"), -F.col("end_word"))).alias("b")
    leaks = leaks.groupBy("doc_id", "item_id").agg(best)
    sizes = items.select(F.col("item").alias("item_id"), "n_items")
    return leaks.join(sizes, "item_id").select("doc_id", "item_id", "b.score", "b.start_word", "b.end_word", "n_items")


def remove(docs: DataFrame, items: DataFrame, **how: float) -> DataFrame:
    """``docs`` without the documents in which ``matches`` finds a leak; all columns stay. Rows without doc_id stay."""
    leaky = matches(docs, items, **how).select(F.col("doc_id")).distinct()
    return docs.join(leaky, "doc_id", "left_anti").select(docs.columns)
