"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from what was written.

    The folder is the session's own (``spark.checkpoint.dir``). One on this machine is made only where none is set
    and Spark runs on this machine alone, as in tests; on a cluster a missing folder is an error, since executors
    can't read each other's disks.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, for what is written on the way."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            master = context.master
            if master != "local" and not master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp()
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that was written on the way, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def unit_hash(*parts: Column | str, seed: str) -> Column:
    """A number in (0, 1) with 48 random bits, fixed by ``parts`` and ``seed``; plain SQL can compute it too."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
