"""Result tables in a database over JDBC: made if absent, loaded through a staging table, swapped in one transaction.

Executors write the staging table over their own connections; only definitions, a count and the swap go over the
driver's. The JDBC driver has to be on the class path of the driver and the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from plumbline.sources.ingest import scratch
from plumbline.sources.store import SinkError, reconcile, write_parts

ROW = "load_row"
#: Lookups on score tables: one index each.
SCORE_INDEXES = {
    "project": [["project_keyword", "original_author_x_id"], ["project_keyword", "replier_x_id"], ["original_post_id"], ["post_created_at"], ["reply_post_id"]],
    "global": [["original_author_x_id"], ["original_post_id"], ["post_created_at"], ["replier_x_id"], ["reply_post_id"]],
}


@contextmanager
def connected(spark: SparkSession, url: str, **options: str) -> Iterator[JavaObject]:
    """A connection of the driver, in a transaction that is committed at the end or taken back on an error."""
    properties = spark._jvm.java.util.Properties()
    for key, value in options.items():
        properties.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def execute(connection: JavaObject, *statements: str) -> int:
    """Run statements; the rows that the last one changed."""
    n = 0
    for statement in statements:
        s = connection.createStatement()
        try:
            n = s.executeUpdate(statement)
        finally:
            s.close()
    return n


def _names(connection: JavaObject, columns: list[str]) -> str:
    quote = connection.getMetaData().getIdentifierQuoteString().strip()
    return ", ".join(f"{quote}{c}{quote}" for c in columns)


def table_exists(spark: SparkSession, url: str, table: str, **options: str) -> bool:
    try:
        with connected(spark, url, **options) as c:
            s = c.createStatement()
            s.executeQuery(f"select 1 from {table} where 1 = 0").close()
            s.close()
    except Py4JJavaError as e:
        if (e.java_exception.getSQLState() or "")[:2] == "42":  # no such table
            return False
        raise
    return True


def ensure_table(spark: SparkSession, url: str, table: str, schema: StructType, indexes: list[list[str]] | None = None, text: str | None = "varchar(255)", **options: str) -> bool:
    """Make a table of these columns, with an index for each list of columns, if it isn't there. text: the type of strings,
    as databases don't index texts of any length (None: the database's own). A table that is there stays as it is. True if it was made."""
    if table_exists(spark, url, table, **options):
        return False
    types = ", ".join(f"`{f.name}` {text}" for f in schema if text and isinstance(f.dataType, StringType))
    made = spark.createDataFrame([], schema).write.format("jdbc").options(url=url, dbtable=table, **options)
    if types:
        made = made.option("createTableColumnTypes", types)
    made.mode("ignore").save()
    for k, columns in enumerate(indexes or []):  # one at a time: some databases take one change of definitions in a transaction
        with connected(spark, url, **options) as c:
            execute(c, f"create index {table.replace('.', '_')}_i{k} on {table} ({_names(c, columns)})")
    return True


def _send(df: DataFrame, url: str, table: str, batch: int, connections: int, **options: str) -> None:
    writer = df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), numPartitions=str(connections), **options)
    writer.mode("append").save()


def load(
    df: DataFrame, url: str, table: str, replace: str | None = "1 = 1", batch: int = 4000, connections: int = 16, tries: int = 3, indexes: list[list[str]] | None = None, text: str = "varchar(255)",
    **options: str,
) -> int:
    """Put the rows of ``df`` in place of those that meet ``replace`` (SQL of the database; default: all; None: add to them).

    Rows are written to the shared folder and counted, then go to a staging table, over at most ``connections``
    connections, in pages of ``batch``. Each has a number under a unique index there, so a task that is repeated after its
    rows were committed fails instead of doubling them. What was counted has to be there. A load that fails is begun anew
    with another staging table, ``tries`` times in all, from the rows written. The swap is one transaction: readers see the
    old rows or the new ones, and after an error the old ones. Columns follow the table that is there (``reconcile``); an
    absent table is made first (``ensure_table``). Returns the rows loaded.
    """
    spark = df.sparkSession
    if ROW in df.columns:
        raise SinkError(f"{ROW} is a column of staging tables")
    if tries < 1:
        raise ValueError("at least one try is needed")
    ensure_table(spark, url, table, df.schema, indexes, text, **options)
    wanted = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().schema
    folder = scratch(spark)
    try:
        n = write_parts(reconcile(df, wanted), folder)
        rows = spark.read.schema(wanted).parquet(folder)
        for _ in range(tries):
            staging = f"{table}_{uuid.uuid4().hex[:12]}"
            try:
                _load_once(rows, n, url, table, staging, replace, batch, connections, **options)
                return n
            except (PySparkException, Py4JJavaError, SinkError) as e:
                last = e
            finally:
                if table_exists(spark, url, staging, **options):
                    with connected(spark, url, **options) as c:
                        execute(c, f"drop table {staging}")
        raise SinkError(f"{table} wasn't loaded in {tries} tries; its rows are as before") from last
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _load_once(rows: DataFrame, n: int, url: str, table: str, staging: str, replace: str | None, batch: int, connections: int, **options: str) -> None:
    spark = rows.sparkSession
    # fewer tasks first: numbers are given by the tasks that send
    numbered = rows.coalesce(connections).withColumn(ROW, F.monotonically_increasing_id())
    ensure_table(spark, url, staging, numbered.schema, text=None, **options)  # as the database types them: nulls are sent so
    with connected(spark, url, **options) as c:
        execute(c, f"create unique index {staging.replace('.', '_')}_u on {staging} ({_names(c, [ROW])})")
    _send(numbered, url, staging, batch, connections, **options)
    there = spark.read.format("jdbc").options(url=url, query=f"select count(*) as n from {staging}", **options).load().first()[0]
    if there != n:
        raise SinkError(f"{n} rows were sent to {staging} and {there} are there")
    with connected(spark, url, **options) as c:
        names = _names(c, rows.columns)
        gone = [] if replace is None else [f"delete from {table} where {replace}"]
        execute(c, *gone, f"insert into {table} ({names}) select {names} from {staging}")
