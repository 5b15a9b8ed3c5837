"""Continuous versions: decay scores of arriving replies, and hourly bursts of arriving engagements."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from plumbline.functions.time import micros
from plumbline.operators.decay import COLUMNS, GLOBAL, LOCAL, THIRTY_DAYS
from plumbline.operators.ledger import score_new

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Replier(StatefulProcessor):
    """The entries of a replier that may still be active, and how many replies came. Times are microseconds."""

    def __init__(self, columns: list[str], span: int, other: float, far: str):
        self.columns, self.span, self.other, self.far = columns, span, other, far

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getListState("entries", "t long, author string, multiplier double")
        self.number = handle.getValueState("number", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["post_created_at", "reply_post_id"]).to_dict("records")
        stored = list(self.entries.get())
        horizon = timerValues.getCurrentWatermarkInMs() * 1000 - self.span
        history = [e for e in stored if e[0] > horizon]
        number = self.number.get()[0] if self.number.exists() else 0
        done = score_new(history, new, number, self.span, self.other, self.far)
        kinds = {"FIRST_REPLY": 1.0, "LOCAL_DECAY": LOCAL}
        added = [(int(r["post_created_at"]), r["original_author_x_id"], kinds.get(r["decay_type"], self.other)) for r in done]
        if len(history) < len(stored):
            self.entries.put(history + added)
        else:
            self.entries.appendList(added)
        self.number.update((number + len(new),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        latest = max(e[0] for e in [*history, *added])
        self.handle.registerTimer(-(-(latest + self.span) // 1000))
        yield pd.DataFrame(done, columns=self.columns)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.entries.clear()
        return iter(())

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """State of lists and timers needs the RocksDB store, which also keeps it out of the heap."""
    spark.conf.set(PROVIDER, ROCKSDB)


def score_stream(replies: DataFrame, scope: str = "project", reset: timedelta = THIRTY_DAYS, new_author: float | None = None, late: str = "1 day") -> DataFrame:
    """Score a stream of replies (see ``reply_source``) once, as they arrive, in time order within a batch.

    Rows that are ``late`` or less behind the latest time seen are scored against what is known then, and rows sent before
    are never revised; later ones are dropped (their number is in the query's progress). For results that late rows
    revise, use the refresh plans.

    State of a replier: the entries that a reply on time may still find active, and the number of replies. New entries
    are appended; the list is written anew only when some have expired. A timer clears the entries of a replier who has been silent until
    nothing of it can be active, so that only the number stays: one long for each replier. Sets the session's state store
    to RocksDB (``use_rocksdb``).
    """
    use_rocksdb(replies.sparkSession)
    other = new_author if new_author is not None else GLOBAL if scope == "project" else 1.0
    far = "GLOBAL_DECAY" if other != 1.0 else "NEW_AUTHOR"
    keys = ["project_keyword", "replier_x_id"] if scope == "project" else ["replier_x_id"]
    columns = [*keys[:-1], *COLUMNS]
    types = {"post_created_at": "long", "replier_base_score": "double", "effective_score": "double", "contribution_score": "double", "reply_number": "long", "local_reply_count": "int"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)
    names = [c for c in columns if c in replies.columns and c != "post_created_at"]

    timed = replies.withColumn("_seen", F.col("post_created_at").cast("timestamp")).withWatermark("_seen", late)
    rows = timed.select(*names, micros("post_created_at").alias("post_created_at"), "_seen")
    processor = _Replier(columns, int(reset / timedelta(microseconds=1)), other, far)
    scored = rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "EventTime")
    return scored.withColumn("post_created_at", F.timestamp_micros("post_created_at"))


def burst_stream(engagements: DataFrame, late: str = "1 hour") -> DataFrame:
    """Engagements of each root post by clock hour, sent once the watermark has passed the hour."""
    times = engagements.withColumn("engaged_at", F.col("engaged_tweet_created_at").cast("timestamp")).withWatermark("engaged_at", late)
    return times.groupBy("root_post_id", F.window("engaged_at", "1 hour").alias("hour")).agg(F.count(F.lit(1)).alias("engagements")).select("root_post_id", F.col("hour.start").alias("hour_start"), "engagements")
