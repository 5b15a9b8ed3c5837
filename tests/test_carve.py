"""NOT IN over several columns against SQL's rule, row by row."""

import random

import pytest

from plumbline.operators.carve import latest, not_in

SCHEMA = "a string, b int, extra string"


def may_be_equal(x, y):
    return all(p is None or q is None or p == q for p, q in zip(x, y, strict=True))


def expected(rows, others):
    return sorted((r for r in rows if not any(may_be_equal(r[:2], o[:2]) for o in others)), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_nulls_on_either_side(spark, seed):
    rng = random.Random(seed)

    def table(n, nulls):
        def pick(values):
            return None if rng.random() < nulls else rng.choice(values)

        return [(pick("pqrstuvw"), pick(list(range(9))), rng.choice("xy")) for _ in range(n)]

    rows, others = table(120, 0.2), table(6 + 8 * seed, 0.15 if seed % 2 else 0.0)
    got = not_in(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(others, SCHEMA), ["a", "b"])
    assert got.columns == ["a", "b", "extra"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows, others)


@pytest.mark.parametrize("others", [[], [(None, None, "z")], [("p", None, "z")], [(None, 1, "z")], [("p", 1, "z"), ("p", 1, "z")]])
def test_edges(spark, others):
    rows = [("p", 1, "x"), ("p", 1, "x"), ("p", 2, "x"), ("q", 1, "x"), (None, 1, "x"), ("p", None, "x"), (None, None, "x"), ("", 0, None)]
    left, right = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(others, SCHEMA)
    assert sorted((tuple(r) for r in not_in(left, right, ["a", "b"]).collect()), key=str) == expected(rows, others)
    assert not_in(left.limit(0), right, ["a", "b"]).count() == 0


def test_no_nested_loop_and_three_columns(spark):
    rows = [("p", 1, None), ("p", 1, "x"), ("q", None, "y"), (None, 3, "z")]
    others = [("p", None, "x"), ("q", 2, "w")]
    got = not_in(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(others, SCHEMA), ["a", "b", "extra"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([("q", None, "y"), (None, 3, "z")], key=str)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_latest_rows_are_left_out(spark):
    posts = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 0)], "post_id string, t int").selectExpr("post_id", "timestamp_seconds(t) as post_created_at")
    assert {r["post_id"] for r in not_in(posts, latest(posts, 2), ["post_created_at", "post_id"]).collect()} == {"a", "d"}
    assert not_in(posts, latest(posts, 9), ["post_created_at", "post_id"]).count() == 0


@pytest.mark.parametrize("others", [[(None, None, "z")], [("p1", 1, "z"), (None, 2, "z")]])
def test_no_key_holds_most_copies(spark, others, monkeypatch):
    """Copies of rows for null patterns that the other side lacks, or that leave nothing to compare, would meet at a few keys."""
    sizes = []
    join = type(spark.range(1)).join

    def seen(self, other, on=None, how=None):
        if how == "left_semi" and "_v0" in self.columns:
            keys = [c for c in self.columns if not c.startswith("_v")]
            counts = [r["count"] for r in self.groupBy(*keys).count().collect()]
            sizes.append((sum(counts), max(counts)))
        return join(self, other, on, how)

    monkeypatch.setattr(type(spark.range(1)), "join", seen)
    n = 3000
    rows = spark.range(n).selectExpr("concat('p', id) as a", "cast(id as int) as b", "'x' as extra")
    got = not_in(rows, spark.createDataFrame(others, SCHEMA), ["a", "b"]).count()
    assert got == (0 if others[0][0] is None else n - 2)
    [(copies, largest)] = sizes
    assert copies <= n * len(others) and largest <= n / 20
