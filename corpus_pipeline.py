"""A training corpus from ``documents``: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes what the one before it kept, written as Parquet and read again. Every stage takes an empty table,
null and empty texts, null and repeated doc_ids, and further columns of any name, which it passes through.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, langid, mixing, sharding, simhash
from plumbline.llm.common import removed, shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SHARDS = [1.0] * 24


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language. Those without letters (null and empty texts too) go, and those
    without a clear language. Repeated rows have one answer, so all of them stay or go; so do rows without doc_id."""
    return langid.keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more. The smallest doc_id
    stays. Null and empty texts are copies of each other; rows without doc_id all stay; rows that share doc_id and text
    are one document, rows that share only doc_id aren't."""
    return simhash.near_dedup(docs, words=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item, edited or not. All rows of a doc_id of which one holds a
    passage go. Null and empty texts and rows without doc_id stay. Without items all stay."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source as large as the others on average; documents repeat or go by their Poisson counts. A null source
    counts as one. Rows of one doc_id are drawn alike, and so are all rows without one."""
    return mixing.replicate(docs, extra=False)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, in place of a column of that name. Rows of one doc_id share a shard, and so do
    all rows without one."""
    return sharding.assign(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

#: Languages, fingerprints and alignments aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage returns is written to the shared folder before the next reads it, and
    removed when the next one's result is written; the last of these folders is there as long as the result may be read."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
            docs = written(spark, docs, path)
            if before is not None:
                removed(spark, before)
            before = path
    return docs


def written(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """``docs`` as a Parquet table in the shared folder, read again."""
    docs.write.parquet(path)
    return spark.read.parquet(path)
