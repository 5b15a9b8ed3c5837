"""Base tables laid out by the day or month in which their rows came, so that what is new is found by reading only that."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.time import micros

DAY = "ingest_day"
CODEC = "zstd"  # of tables on the way and kept ones, whose size is what they cost


def came(df: DataFrame) -> Column:
    """When a row was created or last updated."""
    times = [F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at") if c in df.columns]
    return F.greatest(*times) if len(times) > 1 else times[0]


class IngestTable:
    """Rows of ``keys``, appended as they come under ``path``; a changed row comes again and its latest version counts
    (of versions of one time, any one of those that are equal in it; they should not differ). Rows without a time of
    creation are kept with the first day and are never new. every: ``day``, or ``month`` for folders named by its first day."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], every: str = "day"):
        if every not in ("day", "month"):
            raise ValueError(f"unknown period: {every}")
        self.spark, self.path, self.schema, self.keys, self.every = spark, path.rstrip("/"), schema, keys, every

    def add(self, rows: DataFrame) -> None:
        day = came(rows).cast("date") if self.every == "day" else F.trunc(came(rows).cast("date"), "month")
        day = F.coalesce(day, F.lit("0001-01-01").cast("date"))
        laid = rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).withColumn(DAY, day)
        laid.hint("rebalance", DAY).write.option("compression", CODEC).mode("append").partitionBy(DAY).parquet(self.path)

    def _days(self) -> dict[date, str]:
        """The days that there are, from one listing of the folder."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return {date.fromisoformat(n.split("=", 1)[1]): f"{self.path}/{n}" for n in names if n.startswith(f"{DAY}=")}

    def _rows(self, days: dict[date, str]) -> DataFrame:
        schema = StructType([*self.schema.fields]).add(DAY, "date")
        if not days:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*[days[d] for d in sorted(days)])

    def latest(self) -> datetime | None:
        """The time at which the last row came; only the rows of the last folder are read."""
        days = self._days()
        rows = self._rows({d: p for d, p in days.items() if d == max(days)})
        return rows.agg(F.max(came(rows))).first()[0] if days else None

    def since(self, after: datetime | None, until: datetime | None, columns: list[str] | None = None) -> DataFrame:
        """The latest versions of the rows that came after ``after`` and by ``until``, or of some of their columns; others don't
        travel. Folders of other days aren't opened."""
        low, high = after.date() if after else date.min, until.date() if until else date.max
        low = low.replace(day=1) if self.every == "month" else low
        rows = self._rows({d: p for d, p in self._days().items() if low <= d <= high})
        if after is not None:
            rows = rows.where((F.col(DAY) >= F.lit(low)) & (came(rows) > F.lit(after)))
        if until is not None:
            rows = rows.where((F.col(DAY) <= F.lit(high)) & F.coalesce(came(rows) <= F.lit(until), F.lit(True)))
        return self._current(rows, columns or self.schema.names)

    def _current(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """One row a key. Versions are compared where they lie before they travel, and keys travel once."""
        rest = [c for c in columns if c not in self.keys]
        whole = F.struct(F.lit(0).alias("_"), *rest).alias("row")
        kept = rows.select(*self.keys, micros(came(rows)).alias("_t"), whole).groupBy(*self.keys)
        latest = kept.agg(F.max_by("row", F.coalesce("_t", F.lit(0))).alias("row"))
        return latest.select([c if c in self.keys else F.col("row")[c].alias(c) for c in columns])


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which driver and executors share. Without that setting one on this machine is
    taken, if Spark runs on this machine alone; on a cluster that is an error."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch(spark: SparkSession) -> str:
    """The name of a new folder for tables on the way, in the shared folder."""
    return f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in a new folder of the shared one: narrower than ``cut``, and columns that aren't needed aren't read."""
    path = scratch(df.sparkSession)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` as written to the shared folder; its lineage ends there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
