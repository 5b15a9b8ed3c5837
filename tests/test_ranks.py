import random

from pyspark.sql import functions as F

from plumbline.operators.ranks import numbered


def test_numbers_over_a_whole_table(spark):
    rng = random.Random(1)
    rows = [(rng.choice([0.0, 1.5, None, float(k)]), f"u{k:03}") for k in range(500)]
    df = spark.createDataFrame(rows, "score double, id string").repartition(7)
    got = numbered(df, [F.desc("score"), F.col("id")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0.0), r[1]))
    assert [(r["score"], r["id"]) for r in got.orderBy("rank").collect()] == want
    assert [r["rank"] for r in got.orderBy("rank").collect()] == list(range(1, 501))


def test_no_task_numbers_more_than_a_share(spark):
    df = spark.range(20000).select((F.col("id") % 3 == 0).cast("int").alias("tie"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbered(df, [F.col("tie"), F.col("id")])  # one value holds two thirds of the rows
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    most = max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    assert got.rdd.getNumPartitions() > 1 and most < 10000


def test_an_empty_table(spark):
    assert numbered(spark.createDataFrame([], "a int"), [F.col("a")]).columns == ["a", "rank"]
