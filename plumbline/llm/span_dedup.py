"""Substring dedup over sliding sentence spans.

Every run of ``run`` consecutive sentences is hashed (96 bits), and so is every single sentence of
``long_words`` words, which can be a passage of its own. The hashes are joined over the whole corpus, and
every sentence that a span covers which stood somewhere before is covered; the first place (smallest
doc_id, then position) stays. As all runs have one length, a repeated block of that many sentences or more
is covered whole, short sentences at its ends included. Covered stretches of fewer than ``min_words`` words
in all are left in the text; that is decided after the join, so it doesn't change what is found.

What is shuffled of the corpus is 20 bytes a span, and the texts once, to be cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut, fresh

END = re.compile(r"(?<=[.!?…。!?])\s+|(?<=[。!?])(?=\S)|\n+")
UNSPACED = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]")  # written without blanks: two signs count as a word


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each sentence: up to a stop with white space after it, a full-width stop, or a line end. Blank ones don't count."""
    out, at = [], 0
    for m in END.finditer(text or ""):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text or "")))
    return [(a, b) for a, b in out if text and text[a:b].strip()]


def words_of(sentence: str) -> int:
    """Words of a sentence with single blanks; of scripts without blanks two signs count as one."""
    return sentence.count(" ") + 1 + (0 if sentence.isascii() else len(UNSPACED.findall(sentence)) // 2)


def normal(text: str, bounds: list[tuple[int, int]]) -> list[str]:
    """The sentences as they are compared: in lower case with single blanks."""
    return [" ".join(text[a:b].lower().split()) for a, b in bounds]


def spans(text: str, run: int, long_words: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, last sentence, hash) of every run of ``run`` sentences and every sentence of ``long_words`` words."""
    parts = [p.encode("utf-8", "surrogatepass") for p in normal(text, sentences(text))]
    found = [(k, k + run - 1) for k in range(len(parts) - run + 1)]
    if run > 1:
        found += [(k, k) for k, p in enumerate(parts) if words_of(p.decode("utf-8", "surrogatepass")) >= long_words]
    return [(a, b, xxhash.xxh3_128_digest(b"\n".join(parts[a : b + 1]))) for a, b in found]


def _hashed(run: int, long_words: int):
    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            docs, first, length, marks = [], [], [], []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                for a, b, h in spans(text, run, long_words):
                    docs.append(doc)
                    first.append(a)
                    length.append(b - a + 1)
                    marks.append(h)
            h = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
            yield pd.DataFrame({"doc_id": np.array(docs, np.int64), "at": np.array(first, np.int32), "n": np.array(length, np.int32), "h": h[:, 0], "g": (h[:, 1] >> 32).astype(np.int32)})

    return go


def _cut(min_words: int):
    """The text without the sentences of the repeated spans, and what was cut as character ranges."""

    def run(texts: pd.Series, repeats: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found in zip(texts, repeats, strict=True):
            bounds = sentences(text)
            gone = np.zeros(len(bounds) + 1, np.int64)
            for r in () if found is None else found:
                gone[r["at"]] += 1
                gone[r["at"] + r["n"]] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            stretches = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2).tolist()
            stretches = [(a, b) for a, b in stretches if sum(map(words_of, normal(text, bounds[a:b]))) >= min_words]
            if not stretches:
                rows.append((text, len(bounds), 0, [], []))
                continue
            kept, ranges, at = [], [], 0
            for a, b in stretches:
                start, end = bounds[a][0] if a else 0, bounds[b][0] if b < len(bounds) else len(text)
                kept.append(text[at:start])
                ranges.append({"start": start, "end": end})
                at = end
            kept.append(text[at:])
            first = {int(r["first_doc_id"]) for r in found if any(a <= r["at"] < b for a, b in stretches)}
            rows.append(("".join(kept), len(bounds), sum(b - a for a, b in stretches), ranges, sorted(first)))
        return pd.DataFrame(rows, columns=["kept_text", "n_sentences", "n_removed", "removed", "first_doc_ids"])

    return run


def repeats(docs: DataFrame, run: int = 2, long_words: int = 25) -> DataFrame:
    """(doc_id, at, n, first_doc_id): the spans of ``n`` sentences from sentence ``at`` on that aren't the first of
    their kind, with the document that holds the first."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    found = texts.mapInPandas(_hashed(run, long_words), "doc_id long, at int, n int, h long, g int")
    first = found.groupBy("h", "g").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max(F.struct("doc_id", "at")).alias("last"))
    # written before it is joined: two plain shuffles are what adaptive execution can split at a frequent span
    often = cut(first.where(F.col("first") != F.col("last")).select("h", "g", "first"))
    later = found.join(often, ["h", "g"]).where(F.struct("doc_id", "at") != F.col("first"))
    return later.select("doc_id", "at", "n", F.col("first.doc_id").alias("first_doc_id"))


def dedup(docs: DataFrame, run: int = 2, min_words: int = 12, long_words: int = 25) -> DataFrame:
    """``docs`` with kept_text, n_sentences, n_removed, removed (character ranges of the text) and first_doc_ids
    (where the removed spans stay); columns of these names are replaced.

    Rows without doc_id keep their text and take no part. Rows that share a doc_id count as one document, so
    they don't repeat each other. Null texts stay null, with 0 sentences; texts shorter than a span, and the
    empty one, stay as they are. Of spans that stand twice in one document the first stays too. Sentences are
    compared in lower case with single spaces. A document's repeats come together in one row: at most two for
    each of its sentences, so the list is as long as its text. Empty table: empty result.
    """
    docs = docs.drop("kept_text", "n_sentences", "n_removed", "removed", "first_doc_ids")
    doc, spans_, out = (fresh(docs, c) for c in ("_doc", "_spans", "_cut"))
    by_doc = repeats(docs, run, long_words).groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set(F.struct("at", "n", "first_doc_id")).alias(spans_))
    met = docs.join(by_doc, docs["doc_id"] == by_doc[doc], "left").drop(doc)
    without = F.pandas_udf(_cut(min_words), "kept_text string, n_sentences int, n_removed int, removed array<struct<start:int,end:int>>, first_doc_ids array<long>")
    return met.withColumn(out, without("text", spans_)).select(*docs.columns, f"{out}.*")
