"""Tables in a database that comes with Spark: made, loaded, read by ranges, and left as they were when a load fails."""

import pytest
from helpers import post, tables, user
from pyspark.sql import functions as F

from plumbline.operators.decay import decay_scores
from plumbline.sources import database
from plumbline.sources.store import SinkError, read_jdbc


@pytest.fixture
def url(spark, tmp_path):
    return f"jdbc:derby:{tmp_path}/db;create=true"


def back(spark, url, table):
    return spark.read.format("jdbc").options(url=url, dbtable=table).load()


def staging_tables(spark, url):
    query = "select tablename from sys.systables where tabletype = 'T'"
    return [r[0] for r in spark.read.format("jdbc").options(url=url, query=query).load().collect()]


def test_scores_go_in_and_come_back_over_several_connections(spark, url):
    rows = [post(f"root{k}", f"a{k}", -1) for k in range(4)] + [post(f"q{k:03}", f"u{k % 3}", k * 0.7, replied=f"root{k * 5 % 4}") for k in range(90)]
    scores = decay_scores(*tables(spark, rows, [user(f"u{k}", 20 + k) for k in range(3)]))
    assert database.load(scores, url, "scores", connections=4, indexes=database.SCORE_INDEXES["project"]) == 90
    read = read_jdbc(spark, url, "scores", "reply_number", 1, 31, 4)
    assert read.rdd.getNumPartitions() == 4
    columns = scores.columns
    want = scores.withColumn("post_created_at", F.col("post_created_at").cast("timestamp"))
    got = read.withColumn("post_created_at", F.col("post_created_at").cast("timestamp"))
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert staging_tables(spark, url) == ["SCORES"]
    indexes = spark.read.format("jdbc").options(url=url, query="select conglomeratename from sys.sysconglomerates where isindex").load()
    assert {f"SCORES_I{k}" for k in range(5)} <= {r[0] for r in indexes.collect()}


def test_some_rows_are_replaced_or_added(spark, url):
    df = spark.createDataFrame([("p", 1), ("p", 2), ("q", 3)], "project string, n int")
    assert database.load(df, url, "t") == 3
    assert database.load(spark.createDataFrame([("p", 9)], df.schema), url, "t", replace="\"project\" = 'p'") == 1
    assert database.load(spark.createDataFrame([(7, "extra")], "n int, other string"), url, "t", replace=None) == 1  # a column less, one more
    assert sorted(map(tuple, back(spark, url, "t").collect()), key=str) == sorted([("p", 9), ("q", 3), (None, 7)], key=str)
    assert database.load(df.limit(0), url, "t") == 0
    assert back(spark, url, "t").count() == 0


def test_a_failed_load_leaves_the_rows(spark, url):
    df = spark.range(20).selectExpr("cast(id as int) as n")
    database.load(df, url, "t")
    bad = df.repartition(4).select(F.when(F.col("n") == 17, F.raise_error(F.lit("no")).cast("int")).otherwise(F.col("n") + 100).alias("n"))
    with pytest.raises(Exception, match="no"):
        database.load(bad, url, "t", tries=2)
    assert {r[0] for r in back(spark, url, "t").collect()} == set(range(20))
    assert staging_tables(spark, url) == ["T"]


def test_a_failed_swap_leaves_the_rows(spark, url):
    df = spark.range(5).selectExpr("cast(id as int) as n")
    database.load(df, url, "t")
    with database.connected(spark, url) as c:
        database.execute(c, 'alter table t add constraint small check ("n" < 50)')
    with pytest.raises(SinkError):
        database.load(df.selectExpr("n + 48 as n"), url, "t", tries=1)
    assert {r[0] for r in back(spark, url, "t").collect()} == set(range(5))
    assert staging_tables(spark, url) == ["T"]


def test_rows_that_are_sent_twice_are_not_doubled(spark, url, monkeypatch):
    sent, once = [], database._send

    def twice_at_first(df, *args, **options):
        once(df, *args, **options)
        sent.append(args[1])
        if len(sent) == 1:
            once(df, *args, **options)

    monkeypatch.setattr(database, "_send", twice_at_first)
    df = spark.createDataFrame([(1,), (1,), (2,)], "n int")
    assert database.load(df, url, "t") == 3
    assert len(sent) == len(set(sent)) == 2
    assert sorted(r[0] for r in back(spark, url, "t").collect()) == [1, 1, 2]
    assert staging_tables(spark, url) == ["T"]


def test_a_table_that_is_there_stays(spark, url):
    schema = spark.createDataFrame([], "a string, b int").schema
    assert database.ensure_table(spark, url, "t", schema, [["a"], ["a", "b"]])
    assert not database.ensure_table(spark, url, "t", schema, [["a"]])
    assert not database.table_exists(spark, url, "other")
    with pytest.raises(SinkError):
        database.load(spark.createDataFrame([(1,)], "load_row int"), url, "t")
