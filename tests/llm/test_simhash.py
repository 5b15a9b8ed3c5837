import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plumbline.llm import graph, simhash

DOC = "doc_id long, text string"


def brute_fingerprint(text, n):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=3):
    low = dict(zip(ids, ids, strict=True))
    while True:
        new = {a: min(low[b] for b, q in zip(ids, prints, strict=True) if (p ^ q).bit_count() <= radius) for a, p in zip(ids, prints, strict=True)}
        if new == low:
            return low
        low = new


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "a b c a b c a b c", "É é\x0bx\x1cy z w q", "x" * 50_000, "a b " * 20_000])
def test_fingerprint(spark, text):
    got = spark.createDataFrame([(1, text)], DOC).select(simhash.fingerprint("text", 3).alias("f")).first()["f"]
    assert got % (1 << 64) == brute_fingerprint(text, 3)


def test_bit_sliced_distances_match_plain_ones():
    rng = np.random.default_rng(1)
    for radius, bits in ((0, 64), (1, 64), (3, 64), (7, 128), (41, 256)):
        planes = rng.integers(0, 2, (bits, 200)).astype(np.uint8)
        planes[:, 100:] = planes[:, :100]
        for k in range(100, 200):
            planes[rng.choice(bits, rng.integers(0, 2 * radius + 2), replace=False), k] ^= 1
        i, j = np.concatenate([np.arange(100), rng.integers(0, 200, 3000)]), np.concatenate([np.arange(100) + 100, rng.integers(0, 200, 3000)])
        assert (simhash.within(np.packbits(planes, axis=0), i, j, radius) == ((planes[:, i] != planes[:, j]).sum(0) <= radius)).all()


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(300)])
    docs = []
    for k in range(40):
        base = list(words[rng.integers(0, 300, 250)])
        docs.append(" ".join(base))
        for _ in range(4):
            edited = list(base)
            for at in rng.integers(0, 250, 1 + k % 3):
                edited[at] = "changed"
            docs.append(" ".join(edited))
    docs += [None, "", "  ", docs[0], "short"]
    rows = [(1000 - k, t) for k, t in enumerate(docs)]
    found = simhash.components_by_fingerprint(spark.createDataFrame(rows, DOC)).collect()
    prints = [brute_fingerprint(t, 3) for _, t in rows]
    assert {r["doc_id"]: r["component_id"] for r in found} == brute_components([d for d, _ in rows], prints)
    assert {r["doc_id"]: r["fingerprint"] % (1 << 64) for r in found} == dict(zip([d for d, _ in rows], prints, strict=True))


def test_pigeonhole_keys_lose_no_pair(spark):
    rng = np.random.default_rng(9)
    a = rng.integers(-(2**63), 2**63, 200)
    rows = [(int(x), int(x ^ sum(1 << int(b) for b in rng.choice(63, 3, replace=False)))) for x in a]
    df = spark.createDataFrame(rows, "x long, y long")
    shared = df.selectExpr("*").select(simhash.pigeonhole_keys(df.x, 3).alias("p"), simhash.pigeonhole_keys(df.y, 3).alias("q"))
    assert shared.where("not arrays_overlap(p, q)").isEmpty()


def test_a_dense_group_gives_a_forest(spark):
    keys = np.zeros(3000, np.int64)
    planes = np.zeros((64, 3000), np.uint8)
    planes[0, ::2] = 1
    assert set(simhash._forest(keys, np.packbits(planes, axis=0), 3)) == {0}


def test_empty_table_nulls_repeats_and_extra_columns(spark):
    schema = DOC + ", key int, node string, fingerprint string"
    assert simhash.components_by_fingerprint(spark.createDataFrame([], schema)).isEmpty()
    assert simhash.near_dedup(spark.createDataFrame([], schema)).isEmpty()
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(5, text, 1, "a", "x"), (5, text, 1, "a", "x"), (2, text, 2, "b", "y"), (None, text, 3, "c", "z"), (9, None, 4, "d", "w"), (8, "", 4, "d", "w")]
    docs = spark.createDataFrame(rows, schema)
    found = [(r["doc_id"], r["component_id"]) for r in simhash.components_by_fingerprint(docs).collect()]
    assert sorted(found, key=str) == sorted([(5, 2), (5, 2), (2, 2), (None, 2), (9, 8), (8, 8)], key=str)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 8, None]


def test_near_dedup_keeps_one_of_each_group(spark):
    rng = np.random.default_rng(2)
    texts = {}
    for k in range(30):
        base = [f"t{x}" for x in rng.integers(0, 5000, 200)]
        near = list(base)
        for at in rng.choice(200, 3, replace=False):
            near[at] = "edit"
        texts[10 * k + 1], texts[10 * k], texts[10 * k + 2] = " ".join(base), " ".join(near), " ".join(base)
    kept = simhash.near_dedup(spark.createDataFrame(list(texts.items()), DOC)).collect()
    assert sorted(r["doc_id"] for r in kept) == [10 * k for k in range(30)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(3, 3)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(101, 141)} | {k: 7 for k in range(8, 60)}


def test_parts_of_a_large_block_all_meet(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 256, 8, np.uint8)
    rows = []
    for k in range(60):
        bits = np.unpackbits(base if k < 30 else 255 - base)
        bits[rng.choice(64, rng.integers(0, 3), replace=False)] ^= 1
        rows.append((7, k, bytearray(np.packbits(bits).tobytes())))
    keyed = spark.createDataFrame([r[:2] for r in rows], "key long, node long")
    prints = spark.createDataFrame([r[1:] for r in rows], "node long, bits binary")
    plain = {r["node"]: r["component"] for r in graph.components(simhash.link(keyed, prints, 1, 3)).collect()}
    dealt = {r["node"]: r["component"] for r in graph.components(simhash.link(keyed, prints, 1, 3, block_rows=7)).collect()}
    assert plain == dealt and set(plain.values()) == {0, 30}


def test_a_large_block_loses_no_link_of_a_chain_or_a_straggler(spark):
    chain = [(1 << 3 * k) - 1 for k in range(20)]  # three bits from one to the next, six and more else
    group = [(1 << 63) ^ (1 << 40) ^ (1 << k) for k in range(40)]  # two bits from each other
    straggler = [(1 << 63) ^ (1 << 40) ^ (1 << 5) ^ (0b111 << 50)]  # three bits from one of the group
    values = chain + group + straggler
    rows = [(9, k, bytearray(v.to_bytes(8, "big"))) for k, v in enumerate(values)]
    keyed = spark.createDataFrame([r[:2] for r in rows], "key long, node long")
    prints = spark.createDataFrame([r[1:] for r in rows], "node long, bits binary")
    want = {d: c for d, c in brute_components(list(range(len(values))), values).items() if d != c}
    dealt = graph.components(simhash.link(keyed, prints, 1, 3, block_rows=6)).collect()
    assert {r["node"]: r["component"] for r in dealt} == want


def test_repeated_lines_weigh_no_more_than_in_the_set(spark):
    rng = np.random.default_rng(12)
    base = " ".join(f"t{x}" for x in rng.integers(0, 5000, 400))
    line = "\n" + " ".join(f"r{x}" for x in rng.integers(0, 5000, 20))
    other = [" ".join(f"{c}{x}" for x in rng.integers(0, 5000, 40)) + line * 60 for c in "uv"]  # set similarity under 0.3
    rows = [(1, base), (2, base + line * 60), (3, other[0]), (4, other[1])]
    assert sorted(r["doc_id"] for r in simhash.near_dedup(spark.createDataFrame(rows, DOC)).collect()) == [1, 3, 4]


def test_only_pairs_of_the_stated_similarity_are_linked(spark):
    rng = np.random.default_rng(21)
    rows, want = [], set()
    for k in range(60):
        base = [f"t{x}" for x in rng.integers(0, 100_000, 300)]
        near = list(base)
        for at in range(5, 5 + 8 * (10 if k % 3 == 0 else 4), 8):  # J about 0.71 or 0.87
            near[at] = "edit"
        a, b = ({tuple(w[i : i + 5]) for i in range(296)} for w in (base, near))
        similarity = len(a & b) / len(a | b)
        assert not 0.78 < similarity < 0.82
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
        want |= {2 * k} if similarity >= 0.8 else {2 * k, 2 * k + 1}
    assert {r["doc_id"] for r in simhash.near_dedup(spark.createDataFrame(rows, DOC)).collect()} == want


def test_rows_that_share_an_id_lose_no_text_of_their_own(spark):
    rng = np.random.default_rng(31)
    a, b, c = (" ".join(f"{x}{n}" for n in rng.integers(0, 5000, 80)) for x in "abc")
    schema = "doc_id long, text string, source string, more map<string,int>"
    rows = [(1, a, "s", None), (1, b, "s", {"k": 1}), (2, b, "t", None), (3, c, "z", None), (3, c, "y", {"k": 2}), (3, c, "y", {"k": 2}), (4, None, None, None), (4, "", None, None), (None, a, None, None)]
    got = sorted(((r["doc_id"], r["text"], r["source"]) for r in simhash.near_dedup(spark.createDataFrame(rows, schema)).collect()), key=str)
    empty = [r for r in got if r[0] == 4]
    assert len(empty) == 1 and sorted(r for r in got if r[0] != 4 and r[0] is not None) == sorted([(1, a, "s"), (1, b, "s"), (3, c, "y")]) and (None, a, None) in got
    assert len(got) == 5
    again = simhash.near_dedup(spark.createDataFrame(rows[::-1], schema).repartition(3)).collect()
    assert sorted(((r["doc_id"], r["text"], r["source"]) for r in again), key=str) == got


def test_a_chain_through_rows_without_an_id_holds(spark, monkeypatch):
    values = {f"t{k}": (1 << 3 * k) - 1 for k in range(6)}  # three bits from one to the next
    monkeypatch.setattr(simhash, "fingerprint", lambda text, words: F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col(text)))
    rows = [(9, "t0"), (None, "t1"), (None, "t2"), (4, "t3"), (None, "t5")]
    got = [(r["doc_id"], r["component_id"]) for r in simhash.components_by_fingerprint(spark.createDataFrame(rows, DOC)).collect()]
    assert sorted(got, key=str) == sorted([(9, 4), (None, 4), (None, 4), (4, 4), (None, None)], key=str)
