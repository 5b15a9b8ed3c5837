import math

import numpy as np
import pytest

from plumbline.llm import embeddings

ROW = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    ids = [r[0] for r in rows]
    ok = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    x = [np.array(np.array(r[1], np.float32), np.float64) if o else None for r, o in zip(rows, ok, strict=True)]
    near = [[i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] / (np.sqrt(x[i] @ x[i]) * np.sqrt(x[j] @ x[j])) >= cosine for j in range(len(rows))] for i in range(len(rows))]
    low = list(ids)
    while True:
        new = [min([low[i], *(low[j] for j in range(len(rows)) if near[i][j])]) for i in range(len(rows))]
        if new == low:
            return {ids[i]: (sum(near[i]), low[i], ids[i] == low[i]) for i in range(len(rows))}
        low = new


def clustered(seed, n, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        base = rng.normal(size=size)
        for _ in range(rng.integers(1, 6)):
            rows.append((0, (base + rng.normal(size=size) * rng.choice([0.02, 0.12, 0.2])).tolist(), int(k % 3)))
    order = rng.permutation(len(rows))
    return [(int(i) * 3 + 1, e, label) for i, (_, e, label) in zip(order, rows, strict=True)]


@pytest.mark.parametrize("block", [8, 1024])
def test_links_match_brute_force(spark, block):
    rows = clustered(1, 60)
    rows += [(5001, rows[0][1], rows[0][2]), (5002, rows[0][1], rows[0][2] + 1), (5003, rows[0][1], None), (5004, [0.0] * 16, 0), (5005, None, 0), (5006, [float("nan")] * 16, 0), (5007, [1.0, 2.0], 0), (5008, [2.0, 4.0], 0), (5009, [], 0), (5010, [1.0, None], 0), (5011, [float("inf"), 1.0], 0)]
    found = embeddings.link(spark.createDataFrame(rows, ROW), block_rows=block, per_interval=2).collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert got == brute(rows)
    assert sum(v[0] for v in got.values()) > 50


def test_empty_table_and_extra_columns(spark):
    assert embeddings.link(spark.createDataFrame([], ROW)).isEmpty()
    df = spark.createDataFrame([(1, [1.0, 0.0], 3, "a"), (2, [1.0, 0.001], 3, "b"), (2, [1.0, 0.001], 3, "b")], ROW + ", node string")
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embeddings.link(df).collect()) == [(1, 2, 1), (2, 2, 1), (2, 2, 1)]


def test_rows_without_an_id(spark):
    df = spark.createDataFrame([(4, [1.0, 0.0], 3), (None, [1.0, 0.0], 3), (None, [0.0, 1.0], 3)], ROW)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.link(df).collect()), key=str)
    assert got == sorted([(4, 1, 4, True), (None, 1, 4, True), (None, 0, None, True)], key=str)


def test_an_id_on_two_vectors_stays_two_rows_and_doubles_keep_their_bits(spark):
    rows = [(5, [1.0, 0.0, 0.0], 1), (5, [0.0, 1.0, 0.0], 1), (7, [0.0, 1.0, 1e-9], 1), (None, [0.0, 0.0, 1.0], 1), (None, [0.0, 1e-3, 1.0], 1)]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
        got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in embeddings.link(df).collect()), key=str)
        assert got == sorted([(5, 0, 5), (5, 1, 5), (7, 1, 5), (None, 1, None), (None, 1, None)], key=str)
    edge = [(1, [1.0, 0.0], 1), (2, [0.98, math.sqrt(1 - 0.98**2) + 1e-13], 1), (3, [0.98, math.sqrt(1 - 0.98**2) - 1e-13], 1)]
    got = {r["vec_id"]: r["n_links"] for r in embeddings.link(spark.createDataFrame(edge, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: 1, 2: 1, 3: 2}


def test_recursion_skips_nothing_near():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 8))
    x[::2] = x[1::2] + rng.normal(size=(350, 8)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x[np.lexsort(np.floor(x[:, :3] / 0.2).T[::-1])]
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.98, 1)), strict=True)}
    got = {(a, b) for i, j in embeddings.near_pairs(x, x, x[:, :3], x[:, :3], 0.98, True) for a, b in zip(i, j, strict=True)}
    assert got == want
