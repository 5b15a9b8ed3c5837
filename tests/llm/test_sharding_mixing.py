import math
from collections import Counter

from plumbline.llm import mixing, sharding

DOC = "doc_id long, text string, source string"


def docs(spark, n=3000):
    return spark.createDataFrame([(k, f"text {k}", f"s{0 if k % 3 == 0 else k % 7}") for k in range(n)], DOC)


def test_shards_are_even_and_growth_moves_rows_only_into_the_new_one(spark):
    rows = sharding.manifest(docs(spark), [1.0] * 24).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) < 2 * min(sizes.values())
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {24} and 60 < len(moved) < 190
    again = {r["doc_id"]: r["shard"] for r in sharding.manifest(docs(spark), [1.0] * 25).collect()}
    assert again == {r["doc_id"]: r["grown_shard"] for r in rows}


def test_slots_are_gapless_in_the_stated_order(spark):
    rows = sharding.manifest(docs(spark), [1.0] * 5).collect()
    for shard in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_weights_are_shares(spark):
    counts = Counter(r["shard"] for r in sharding.assign(docs(spark), [1.0, 3.0]).collect())
    assert 0.72 < counts[1] / 3000 < 0.78


def test_nulls_repeats_ties_and_empty_tables(spark):
    rows = [(1, "a", "s"), (1, "a", "s"), (None, "b", None), (None, None, None), (2, "", "s"), (3, "é" * 100_000, "s")]
    df = spark.createDataFrame([(*r, 9) for r in rows], DOC + ", shard int")
    found = sharding.manifest(df, [1.0] * 3).collect()
    assert len(found) == 6
    assert sorted(r["size"] for r in found) == [8, 8, 9, 9, 9, 200_008]
    assert [r["text_crc32"] for r in found if r["size"] == 8 and r["doc_id"] is None] == [None]
    assert len({r["shard"] for r in found if r["doc_id"] == 1}) == 1 and len({r["shard"] for r in found if r["doc_id"] is None}) == 1
    assert len({(r["shard"], r["slot"]) for r in found}) == 6
    assert sharding.manifest(spark.createDataFrame([], DOC), [1.0] * 3).isEmpty()
    assert sharding.assign(df, [1.0]).columns == df.columns


def poisson_quantile(u, mean):
    k, p = 0, math.exp(-mean)
    total = p
    while total < u:
        k += 1
        p *= mean / k
        total += p
    return k


def unit(text):
    from hashlib import md5

    return (int(md5(text.encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)


def test_counts_are_the_quantiles_of_the_hashes(spark):
    table = docs(spark)
    rate = {r["source"]: r["rate"] for r in mixing.rates(table).collect()}
    assert abs(sum(rate[f"s{0 if k % 3 == 0 else k % 7}"] for k in range(3000)) - 3000) < 1e-6
    got = Counter(r["doc_id"] for r in mixing.replicate(table).collect())
    want = {k: poisson_quantile(unit(f"mix:{k}:1"), rate[f"s{0 if k % 3 == 0 else k % 7}"]) for k in range(3000)}
    assert got == {k: n for k, n in want.items() if n}


def test_weights_total_and_large_rates(spark):
    table = docs(spark, 700)
    counts = Counter(r["source"] for r in mixing.replicate(table, {"s1": 3.0, "s2": 1.0}, total=40_000).collect())
    assert set(counts) == {"s1", "s2"} and 0.73 < counts["s1"] / 40_000 < 0.77 and 0.23 < counts["s2"] / 40_000 < 0.27


def test_copies_are_spread_over_all_partitions(spark):
    df = mixing.replicate(docs(spark, 500), {"s1": 1.0}, total=5000)
    assert df.rdd.getNumPartitions() >= 1
    places = [r["_place"] for r in df.where("doc_id = 1").collect()]
    assert len(set(places)) == len(places) and max(places) > 0.6 and min(places) < 0.4


def test_nulls_repeats_and_empty_tables_mix(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "", "s", 2), (1, "", "s", 2), (2, "x", None, 3)], DOC + ", rate int")
    got = mixing.replicate(df, total=400)
    assert [c for c in got.columns if not c.startswith("_")] == df.columns
    counts = Counter((r["doc_id"], r["source"]) for r in got.collect())
    assert 300 < sum(counts.values()) < 500 and counts[1, "s"] % 2 == 0
    assert mixing.replicate(spark.createDataFrame([], DOC)).isEmpty()
    assert mixing.replicate(df, {}).isEmpty()
