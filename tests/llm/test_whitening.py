import math
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import whitening
from plumbline.llm.queries import op11_tiled_whitening

ROW = "vec_id long, embedding array<double>, label int"


def brute(rows, components=16):
    """{vec_id: ([whitened], deviation)}, shares and n, straight from the definition, on exact integers."""
    good = [(i, e) for i, e in rows if e is not None and len(e) and all(c is not None and math.isfinite(c) for c in e)]
    size = max(Counter(len(e) for _, e in good).items(), key=lambda s: (s[1], s[0]))[0]
    good = [(i, tuple(math.floor(64 * c) + 1000000 for c in e)) for i, e in good if len(e) == size]
    fit = sorted({x for _, x in good})
    n, sums = len(fit), [sum(x[k] for x in fit) for k in range(size)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    ok = values > values[0] * 1e-12
    values, axes = values[ok], axes[:, ok]
    out = []
    for i, x in good:
        d = np.array([(n * c - s) / n for c, s in zip(x, sums, strict=True)])
        out.append((i, (d @ axes) / np.sqrt(values), sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))))
    return out, values / np.trace(v), n


def check(found, rows, components=16):
    want, shares, n = brute(rows, components)
    got = {}
    for r in found.collect():
        assert r["n"] == n and abs(r["identity_error"]) < 1e-6
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-9)
        got.setdefault(r["vec_id"], []).append((r["component"], r["whitened"], r["deviation"]))
    assert sum(map(len, got.values())) == len(want) * len(shares)
    signs = {}
    for i, coords, deviation in want:
        mine = sorted(got[i])[:: len(got[i]) // len(shares)]
        assert [c for c, _, _ in mine] == list(range(1, len(shares) + 1)) and {d for _, _, d in mine} == {deviation}
        for c, w, _ in mine:
            if abs(coords[c - 1]) > 1e-3:
                s = signs.setdefault(c, np.sign(w) * np.sign(coords[c - 1]))
                assert s * w == pytest.approx(coords[c - 1], abs=1e-6)
    return got


@pytest.mark.parametrize("tile", [3, 8, 64])
def test_whitening_matches_the_definition(spark, tile):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(20, 20)) * np.linspace(3, 0.2, 20)
    rows = [(k, (rng.normal(size=20) @ mix).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(150)]  # one vector holds a third of all rows
    rows += [(2000, None), (2001, [float("nan")] * 20), (2002, [None] + [0.0] * 19), (2003, [float("inf")] * 20), (2004, [1.0, 2.0]), (2005, [])]
    df = spark.createDataFrame([(i, e, 1) for i, e in rows], ROW).repartition(5)
    got = check(whitening.whiten(df, tile=tile), rows)
    assert {i for i in got if i >= 2000} == set()


def test_fewer_dimensions_than_components_and_flat_ones(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [*rng.normal(size=3).tolist(), 0.5]) for k in range(40)]
    got = check(whitening.whiten(spark.createDataFrame([(i, e, 1) for i, e in rows], ROW)), rows)
    assert {len(v) for v in got.values()} == {3}


def test_odd_tables(spark):
    assert whitening.whiten(spark.createDataFrame([], ROW)).isEmpty()
    same = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], ROW)
    assert whitening.whiten(same).isEmpty()
    rows = [(1, [1e30, 0.0], 1), (None, [0.0, 1.0], 2), (3, [5.0, 1.0], 2), (3, [5.0, 1.0], 2)]
    found = whitening.whiten(spark.createDataFrame(rows, ROW).selectExpr("*", "1 as component", "2 as n")).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in found) == [(False, 1, 1), (False, 3, 1), (False, 3, 1), (True, 0, 1)]
    assert {r["deviation"] for r in found if r["vec_id"] == 1} == {None} and {r["n"] for r in found} == {3}


def test_query_on_the_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op11_tiled_whitening(spark, sf), rows)
