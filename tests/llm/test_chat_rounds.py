import pytest

from plumbline.llm import chat

CALL = "conv_id long, id string, depends_on array<string>"


@pytest.fixture
def written(monkeypatch):
    """Counts the tables that are written on the way."""
    made, cut = [], chat.cut
    monkeypatch.setattr(chat, "cut", lambda df: made.append(1) or cut(df))
    return made


def test_a_round_of_calls_with_several_dependencies_writes_one_table(spark, written):
    depth = 6
    calls = [(1, "a0", []), (1, "b0", [])] + [(1, f"{x}{k}", [f"a{k - 1}", f"b{k - 1}"]) for k in range(1, depth + 1) for x in "ab"]
    found = {(r["id"], r["level"]) for r in chat._levels(spark.createDataFrame(calls, CALL)).collect()}
    assert found == {(c[1], int(c[1][1:])) for c in calls}
    assert len(written) <= depth + 4  # dependencies, calls without any, chains, and a last round that finds none


def test_a_circle_ends_the_rounds_of_chains(spark, written):
    calls = [(1, f"c{k}", [f"c{(k + 1) % 40}"]) for k in range(40)] + [(1, "a", []), (1, "b", ["a"])]
    found = {(r["id"], r["level"]) for r in chat._levels(spark.createDataFrame(calls, CALL)).collect()}
    assert found == {("a", 0), ("b", 1)}
    assert len(written) <= 6


def test_the_session_can_still_be_sent_to_tasks(spark):
    """Spark's forests do that; a session that has made an Observation can't be."""
    from pyspark.sql import SparkSession

    own = spark.newSession()
    SparkSession._instantiatedSession, before = own, SparkSession._instantiatedSession
    try:
        chat._levels(own.createDataFrame([(1, "a", []), (1, "b", ["a"])], CALL)).collect()
        bytes_ = spark._jvm.org.apache.spark.util.Utils.serialize(own._jsparkSession)
    finally:
        SparkSession._instantiatedSession = before
    assert len(bytes_) > 0
