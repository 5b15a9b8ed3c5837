"""Runs of the scorers: full builds, incremental refreshes, write-once appends, and all scopes one after the other."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import ledger
from plumbline.operators.decay import THIRTY_DAYS, decay_scores, reply_source
from plumbline.plans.refresh import changed_parts, dirty_repliers, replier_keys, rescored
from plumbline.sources.store import RunLog, VersionedTable


def month_and_bucket(time: str, key: str, buckets: int) -> Column:
    """The month of ``time`` and one of ``buckets`` by the hash of ``key``, as 202406-3."""
    month = (F.year(time) * 100 + F.month(time)).cast("string")
    return F.concat_ws("-", F.coalesce(month, F.lit("none")), F.pmod(F.xxhash64(key), F.lit(buckets)))


def ingest_time(df: DataFrame) -> datetime | None:
    """The latest creation or update in a table."""
    times = [F.max(c).alias(c) for c in ("created_at", "updated_at") if c in df.columns]
    return max((t for t in df.agg(*times).first() if t is not None), default=None)


class ScoreRunner:
    """Keeps the decay scores of one scope under ``root``, in parts by month and replier (``buckets`` a month)."""

    def __init__(
        self, spark: SparkSession, root: str, scope: str = "project", reset: timedelta = THIRTY_DAYS, new_author: float | None = None, name: str | None = None, buckets: int = 16
    ):
        self.spark, self.scope = spark, scope
        self.rule = {"reset": reset, "new_author": new_author}
        self.table = VersionedTable(spark, root, name or scope.upper(), month_and_bucket("post_created_at", "replier_x_id", buckets))
        self.log = RunLog(spark, root)

    def _run(self, kind: str, work: Callable[[str], tuple[int, int | None]]) -> str:
        run_id = f"{datetime.now():%Y%m%d%H%M%S}-{uuid.uuid4().hex[:6]}"
        self.log.write(run_id, self.table.scope, "running", kind)
        try:
            rows, dirty = work(run_id)
        except Exception as e:
            self.log.write(run_id, self.table.scope, "failed", kind, str(e))
            raise
        self.log.write(run_id, self.table.scope, "done", kind, "" if dirty is None else f"{dirty} repliers", rows)
        return run_id

    def full(self, posts: DataFrame, users: DataFrame) -> str:
        """Score everything."""

        def work(run_id: str) -> tuple[int, None]:
            marks = ingest_time(posts), ingest_time(users)
            return self.table.publish(decay_scores(posts, users, self.scope, **self.rule), *marks, run_id, None), None

        return self._run("full", work)

    def incremental(self, posts: DataFrame, users: DataFrame) -> str:
        """Rescore the repliers that late rows touch; the first run is a full build, a run without news writes nothing."""
        state = self.table.state()
        if state is None:
            return self.full(posts, users)

        def work(run_id: str) -> tuple[int, int]:
            since, users_since, keys = state["since"], state["users_since"], replier_keys(self.scope)
            # planned once: keys and new scores are kept for what follows (and made again if an executor is lost)
            dirty = dirty_repliers(posts, users, since, self.scope, users_since).select(*keys).persist()
            anew = rescored(posts, users, dirty, self.scope, **self.rule).persist()
            try:
                n = dirty.count()
                if not n:
                    return state["rows"], 0
                old = self.table.read().join(dirty, keys, "left_semi").select(anew.columns)
                parts = [r["part"] for r in changed_parts(old, anew, self.table.part).collect()]  # months times buckets at most
                kept = self.table.read(parts).join(dirty, keys, "left_anti").select(anew.columns)
                new = kept.unionByName(anew.where(self.table.part.isin(parts)))
                return self.table.publish(new, ingest_time(posts), ingest_time(users), run_id, n, after=state["version"], parts=parts), n
            finally:
                anew.unpersist()
                dirty.unpersist()

        return self._run("incremental", work)

    def append(self, posts: DataFrame, users: DataFrame) -> str:
        """Write-once: score the replies that have no score from the stored history, and keep all stored rows."""
        state = self.table.state()
        if state is None:
            return self.full(posts, users)

        def work(run_id: str) -> tuple[int, None]:
            stored = self.table.read()
            other = self.rule["new_author"] if self.rule["new_author"] is not None else 0.9
            new = ledger.append_new(reply_source(posts, users, self.scope), stored, self.scope, self.rule["reset"], other)
            return self.table.publish(new, ingest_time(posts), ingest_time(users), run_id, None, after=state["version"], add=True), None

        return self._run("append", work)


def run_all(jobs: dict[str, Callable[[], object]], spark: SparkSession | None = None, timeout: float | None = None) -> dict[str, str]:
    """Run named jobs one after the other; one that fails doesn't stop the rest. Returns ``done`` or the error by name.

    With a session and a ``timeout`` in seconds, the Spark jobs of one that takes longer are cancelled, so it fails.
    """
    out = {}
    for name, job in jobs.items():
        timer = None
        if spark is not None and timeout is not None:
            group = f"{name}-{uuid.uuid4().hex[:6]}"
            spark.sparkContext.setJobGroup(group, name, interruptOnCancel=True)
            timer = threading.Timer(timeout, spark.sparkContext.cancelJobGroup, [group])
            timer.start()
        try:
            job()
            out[name] = "done"
        except Exception as e:  # reported, and raised by the caller if it wants to
            out[name] = f"failed: {e}"
        finally:
            if timer is not None:
                timer.cancel()
                spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out
