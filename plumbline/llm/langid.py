"""Word-first language identification.

A known word is scored by its log frequency in each language. A word that was not learned falls
back to its longest character n-grams that were, one length shorter at a time.

The model is fitted on a sample of about ``max_docs`` labelled documents (a stated bound), a like share of every
language. Words and n-grams that stand in it twice or more are learned, whatever their number; counting runs on
Spark, and what is learned is broadcast as sorted arrays of hashes, one entry for each (n-gram, language) that was
seen. Prediction reads every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut, fresh

WORD = re.compile(r"[^\W\d_]+")
LENGTHS = (5, 4, 3, 2, 1)
UNDETERMINED = "und"
GROUP_CHARS = 1_000_000  # texts whose words a worker holds at once
GROUP_WORDS = 10_000  # words whose n-grams a worker holds at once


def words_of(text: str | None) -> Counter:
    """Lower-cased runs of letters, with counts. The words of a long text are never a list."""
    if not text:
        return Counter()
    text = text.lower()
    return Counter(WORD.findall(text) if len(text) < GROUP_CHARS else (m.group() for m in WORD.finditer(text)))


def groups_of(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """``texts`` in order, in groups of about ``GROUP_CHARS`` characters; a longer text ends its group."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    yield group


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of the word with an edge mark on either side; single letters have no mark."""
    word = word if n == 1 else f"^{word}$"
    return [word[k : k + n] for k in range(len(word) - n + 1)]


class Tables:
    """Log probabilities of n-grams by language, kept sparse: sorted hashes, and for each the languages that have it."""

    def __init__(self, rows: Iterable[tuple[int, int, int, int]], langs: int):
        """rows: (kind, hash of the n-gram, language, count); kind 0 is whole words, n the n-grams of that length."""
        rows = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.langs, self.kinds = langs, {}
        for kind in (0, *LENGTHS):
            part = rows[rows[:, 0] == kind]
            hashes, first = np.unique(part[:, 1], return_index=True)
            sums = np.bincount(part[:, 2], part[:, 3], langs)
            whole = sums + 0.5 * (len(hashes) + 1)
            logs = np.log((part[:, 3] + 0.5) / whole[part[:, 2]])
            self.kinds[kind] = hashes, np.append(first, len(part)), part[:, 2].astype(np.int32), logs, np.log(0.5 / whole)

        self.known: _Rows | None = None  # words that a worker has met; it keeps them from task to task

    @classmethod
    def of_arrays(cls, langs: int, kinds: dict) -> Tables:
        out = cls.__new__(cls)
        out.langs, out.kinds, out.known = langs, kinds, None
        return out

    def of(self, words: list[str]) -> np.ndarray:
        """A row a word: a learned word's own values, else the mean over its longest n-grams that were learned, else zeros."""
        out = np.zeros((len(words), self.langs))
        left = range(len(words))
        for kind in (0, *LENGTHS):
            hashes, first, lang, logs, unseen = self.kinds[kind]
            if not len(hashes) or not len(left):
                continue
            pieces = [(k, g) for k in left for g in (grams_of(words[k], kind) if kind else [words[k]])]
            wanted = np.fromiter((gram_hash(g) for _, g in pieces), np.int64, len(pieces))
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            hit = hashes[at] == wanted
            owner = np.fromiter((k for k, _ in pieces), np.int64, len(pieces))[hit]
            found, inverse = np.unique(at[hit], return_inverse=True)
            sizes = first[found + 1] - first[found]
            row = np.repeat(np.arange(len(found)), sizes)
            place = np.arange(len(row)) + np.repeat(first[found] - np.cumsum(sizes) + sizes, sizes)
            dense = np.tile(unseen, (len(found), 1))
            dense[row, lang[place]] = logs[place]
            np.add.at(out, owner, dense[inverse])
            number = np.bincount(owner, minlength=len(words))
            done = number > 0
            out[done] /= number[done, None]
            left = [k for k in left if not done[k]]
        return out


def gram_hash(gram: str) -> int:
    h = xxhash.xxh64_intdigest(gram.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


class _Rows(dict):
    """Word -> row of ``logs``, where its log likelihoods by language stand; filled as words are asked for."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.most = min(300_000, max(1000, 20_000_000 // max(1, tables.langs)))
        self.logs = np.zeros((self.most, tables.langs))

    def add(self, words: list[str]) -> None:
        """Learn the rows of words, at most as many as the table holds."""
        new = [w for w in dict.fromkeys(words) if w not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            new = list(dict.fromkeys(words))
        for at in range(0, len(new), GROUP_WORDS):
            part, start = new[at : at + GROUP_WORDS], len(self)
            self.logs[start : start + len(part)] = self.tables.of(part)
            self.update(zip(part, range(start, start + len(part)), strict=True))

    def parts(self, words: Counter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of all words and how often each stands, as many at a time as the table holds."""
        names = iter(words)
        while part := list(islice(names, self.most)):
            self.add(part)
            number = np.fromiter(map(words.__getitem__, part), float, len(part))
            yield self.logs[np.fromiter(map(self.__getitem__, part), np.int64, len(part))], number


class Model:
    """langs: sorted; tables: what was learned of their words and n-grams."""

    def __init__(self, langs: list[str], tables: Tables):
        self.langs, self.tables = langs, tables
        if tables.known is None:
            tables.known = _Rows(tables)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language (first by name of equals), and the mean posterior it has over the words."""
        return self.judge(words_of(text))

    def predict_all(self, texts: Iterable[str | None]) -> list[tuple[str, float]]:
        """``predict`` of many texts; the words that are new are looked up together."""
        found = []
        for group in groups_of(texts):
            counted = [words_of(t) for t in group]
            words = list(dict.fromkeys(chain.from_iterable(counted)))
            if self.langs and len(words) <= self.tables.known.most:
                self.tables.known.add(words)
            found += map(self.judge, counted)
        return found

    def judge(self, words: Counter) -> tuple[str, float]:
        if not self.langs or not any(c.isalpha() for w in words for c in w):  # signs such as ² stand in words, but aren't letters
            return UNDETERMINED, 0.0
        total, odds = np.zeros(len(self.langs)), np.zeros(len(self.langs))
        for logs, number in self.tables.known.parts(words):
            total += number @ logs
            p = np.exp(logs - logs.max(axis=1, keepdims=True))
            odds += number @ (p / p.sum(axis=1, keepdims=True))
        best = int(np.argmax(total))
        return self.langs[best], float(min(1.0, odds[best] / words.total()))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            found.setdefault(lang, Counter()).update(words_of(text))
        out = [(lang, 0, gram_hash(w), n) for lang, words in found.items() for w, n in words.items()]
        for lang, words in found.items():
            for size in LENGTHS:
                grams: Counter = Counter()
                for w, n in words.items():
                    for g in grams_of(w, size):
                        grams[g] += n
                out += [(lang, size, gram_hash(g), n) for g, n in grams.items()]
        yield pd.DataFrame(out, columns=["lang", "kind", "gram", "n"])


def fit(labelled: DataFrame, max_docs: int = 8000) -> Model:
    """Learn from ``labelled`` (doc_id, text, lang). Rows with null doc_id, text or lang teach nothing.

    Every language may give about ``max_docs`` over their number, one at least; of a language that has more, the rows
    with the smallest hashes of doc_id are read. A language of which no row is read is not learned. Words and n-grams
    that stand twice or more in what is read are learned. No rows: a model that answers ``und``.
    """
    labelled = labelled.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    number = sizes.agg(F.count(F.lit(1)).alias("langs"))  # one row
    share = F.least(F.lit(1.0), F.greatest(F.lit(1.0), F.lit(float(max_docs)) / F.col("langs")) / F.col("n"))
    # a language with most of the rows is met in 32 places
    places = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("_place")
    shares = cut(sizes.crossJoin(F.broadcast(number)).select("lang", (share * float(1 << 30)).alias("below"), places))
    # chosen by id and language alone; what is chosen is as bounded as the sample, so texts aren't shuffled
    mark = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("langid")), F.lit(1 << 30))
    ids = labelled.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(32)).cast("int").alias("_place"))
    chosen = ids.join(shares, ["lang", "_place"]).where(mark < F.col("below")).select(F.col("doc_id").alias("_doc"), F.col("lang").alias("_of")).distinct()
    part = labelled.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_doc")) & (F.col("lang") == F.col("_of")))
    counts = part.select("lang", "text").mapInPandas(_count, "lang string, kind int, gram long, n long")
    counts = counts.groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n"))
    often = F.sum("n").over(Window.partitionBy("kind", "gram"))
    kept = counts.withColumn("all", often).where(F.col("all") >= 2).select("kind", "gram", "lang", "n").toArrow()  # bounded by the sample
    langs = sorted(set(kept["lang"].to_pylist()))
    place = {lang: k for k, lang in enumerate(langs)}
    rows = zip(kept["kind"].to_pylist(), kept["gram"].to_pylist(), (place[x] for x in kept["lang"].to_pylist()), kept["n"].to_pylist(), strict=True)
    return Model(langs, Tables(rows, len(langs)))


_last: list = []


def _held(value: tuple[list[str], dict]) -> Model:
    """A worker's model, kept as long as it gets the same broadcast."""
    if not _last or _last[0] is not value:
        _last[:] = [value, Model(value[0], Tables.of_arrays(len(value[0]), value[1]))]
    return _last[1]


def predict(docs: DataFrame, model: Model, text: Column | str = "text", into: str = "_lang") -> DataFrame:
    """``docs`` with a struct column ``into`` (lang, score). Null texts and texts without a letter: ``und``, 0."""
    # plain arrays, bounded by the sample that they were fitted on
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.tables.kinds))

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        found = _held(shared.value)
        for texts in batches:
            yield pd.DataFrame(found.predict_all(texts), columns=["lang", "score"])

    return docs.withColumn(into, run(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows that are kept from learning: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, into: str = "_lang", **bounds: int) -> DataFrame:
    """Learn from the rows of ``docs`` that aren't held out and predict all. Adds a struct ``into``
    (lang, score), in place of a column of that name; doc_id, lang and any other column never enter a prediction. Repeated rows get equal
    answers; extra columns pass through; an empty table gives an empty one."""
    return predict(docs, fit(docs.where(~held_out()), **bounds), into=into)


def keep_identified(docs: DataFrame, min_score: float = 0.3, **bounds: int) -> DataFrame:
    """``docs`` without the rows whose text has no language or one that scores under ``min_score``."""
    into = fresh(docs, "_lang")
    found = identify(docs, into, **bounds)
    return found.where((F.col(f"{into}.lang") != UNDETERMINED) & (F.col(f"{into}.score") >= min_score)).select(docs.columns)
