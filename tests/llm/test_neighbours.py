import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import neighbours
from plumbline.llm.queries import op13_learned_partitions

ROW = "vec_id long, embedding array<float>, label int"


def brute(rows, asks, k=5):
    """{query: [(id, score)]} over all pairs."""
    good = [(i, np.array(np.array(e, np.float32), np.float64)) for i, e in rows if i is not None and e is not None and len(e) and all(c is not None and np.isfinite(c) for c in e) and any(e)]
    out = {}
    for q, a in good:
        if asks(q):
            score = lambda b: float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)))  # noqa: E731, B023
            near = sorted(((-score(b), i) for i, b in good if i != q and len(b) == len(a)))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def results(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def recall(got, want):
    """Found neighbours of the true ones, and scores that are right for all that was found."""
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in want.items())
    return hits / sum(map(len, want.values()))


def check(spark, rows, asks, condition, least=0.9, **settings):
    want = brute(rows, asks)
    got = results(neighbours.search(spark.createDataFrame([(i, e, 1) for i, e in rows], ROW), condition, **settings))
    assert set(got) == {q for q, near in want.items() if near}
    vectors = {i: np.array(np.array(e, np.float32), np.float64) for i, e in rows if e is not None and i is not None and None not in e}
    for q, near in got.items():
        assert len(near) == len(want[q]) and near == sorted(near, key=lambda n: (-n[1], n[0])) and q not in {i for i, _ in near}
        for i, s in near:
            a, b = vectors[q], vectors[i]
            assert s == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-14)
    assert recall(got, want) >= least
    return got, want


def clustered(seed, n, size=16, centres=30):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(centres, size))
    return [(int(i), (at[rng.integers(centres)] + 0.4 * rng.normal(size=size)).tolist()) for i in rng.permutation(n)]


@pytest.mark.parametrize("block", [64, 4096])
def test_recall_and_order_in_clusters(spark, block, monkeypatch):
    monkeypatch.setattr(neighbours, "SEGMENT", 2)
    rows = clustered(1, 1500)
    got, want = check(spark, rows, lambda i: i % 50 == 0, F.col("vec_id") % 50 == 0, block_rows=block)
    assert len(got) == 30


def test_few_parts_are_searched_where_there_are_clusters(spark):
    x = neighbours.unit(np.array([e for _, e in clustered(2, 3000, centres=40)]))
    router = neighbours.fit(spark, x, 20, 5, 0.98)
    _, ahead = router.ranked(x[:500])
    assert (ahead <= router.mass).sum(axis=1).mean() < 7
    sizes = np.bincount(router.probabilities(x).argmax(axis=1), minlength=20)
    assert sizes.max() < 4 * len(x) / 20


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(3)
    group = np.repeat(np.arange(4), 50)
    near = np.array([rng.choice(np.flatnonzero((group == g) & (np.arange(200) != i)), 6, replace=False) for i, g in enumerate(group)])
    part = neighbours.balanced_parts(near, 4)
    assert np.bincount(part).tolist() == [50] * 4
    assert np.mean(part[np.repeat(np.arange(200), 6)] == part[near.ravel()]) > 0.95
    assert sorted(np.bincount(neighbours.balanced_parts(near, 3))) == [66, 67, 67]


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(400)]
    same = rows[10][1]
    rows += [(1000 + k, same) for k in range(200)]  # a third of all rows are one vector
    rows += [(3000, [2 * c for c in same]), (3050, [4 * c for c in same])]  # other vectors with the same cosine
    rows += [(4000, None), (4050, [0.0] * 8), (4100, [float("nan")] * 8), (4150, [None] + [1.0] * 7), (4200, []), (4250, [float("inf")] * 8), (None, same)]
    rows += [(5000, [1.0, 0.0]), (5050, [1.0, 1.0]), (5001, [0.0, 1.0]), (6000, [1.0, 2.0, 3.0]), (6050, [1e-30] * 8), (6100, [1e30] * 8)]
    got, want = check(spark, rows, lambda i: i % 50 == 0, F.col("vec_id") % 50 == 0)
    for q in (1000, 1050, 3000, 3050, 5000, 5050):
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    assert 6000 not in got


def test_small_and_empty_tables(spark):
    assert neighbours.search(spark.createDataFrame([], ROW), F.col("vec_id") % 50 == 0).isEmpty()
    check(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])], lambda i: i == 0, F.col("vec_id") == 0)
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.1], 2)], ROW).selectExpr("*", "7 as node", "8 as part", "9 as rank")
    assert results(neighbours.search(df, F.col("label") == 1)) == {1: [(2, pytest.approx(0.5 / np.sqrt(0.26)))]}


def test_query_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = results(op13_learned_partitions(spark, sf)), brute(rows, lambda i: i % 50 == 0)
    assert set(got) == set(want) and recall(got, want) >= 0.9
