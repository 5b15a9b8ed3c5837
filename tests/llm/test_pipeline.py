import importlib
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest

from plumbline.llm import decontaminate, sharding, simhash

REPO = Path(corpus_pipeline.__file__).parent
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def passage(seed, n, vocabulary="xyz"):
    rng = random.Random(seed)
    return " ".join(rng.choice(vocabulary) + "".join(rng.choices("aeioulnrst", k=6)) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    items = [(k, passage(9000 + k, 30)) for k in range(4)]
    rows = []
    for k in range(200):
        rows.append((k, passage(k, 80), "aa", f"s{min(k % 10, 3)}"))
    for k in range(20):  # near copies of the first twenty
        words = rows[k][1].split()
        words[7] = "edited"
        rows.append((1000 + k, " ".join(words), "aa", "s1"))
    for k in range(10):
        rows.append((2000 + k, passage(5000 + k, 60) + " " + items[k % 4][1], "aa", "s2"))
    rows += [(3000, "", "aa", "s1"), (3001, None, "aa", "s1"), (3002, "12 34 !!", None, None)]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOC).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_each_stage_does_its_part_and_keeps_the_columns(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(spark, stage(spark, docs, folder), str(tmp_path / name))
        assert docs.columns == columns or name == "sharding"
        ids.append(Counter(r["doc_id"] for r in docs.collect()))
    language, near, clean, mixed, sharded = ids
    assert set(language) == {*range(200), *range(1000, 1020), *range(2000, 2010)}
    assert set(near) == {*range(200), *range(2000, 2010)} and set(clean) == set(range(200)) and max(clean.values()) == 1
    assert set(mixed) <= set(clean) and sharded == mixed
    per_source = Counter()
    for r in docs.collect():
        per_source[r["source"]] += 1
    assert all(30 < n < 75 for n in per_source.values())
    assert docs.columns == [*columns, "shard"]
    expected = {r["doc_id"]: r["shard"] for r in sharding.assign(docs.drop("shard"), corpus_pipeline.SHARDS).collect()}
    assert all(expected[r["doc_id"]] == r["shard"] for r in docs.collect())


def test_run_gives_what_the_stages_give(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(spark, stage(spark, docs, folder), str(tmp_path / name))
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, docs.collect()))


def test_near_dups_and_leaks_agree_with_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 3000")
    texts = {r["doc_id"]: r["text"].split() for r in docs.collect()}
    sets = {d: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for d, w in texts.items()}
    close = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    kept = {r["doc_id"] for r in simhash.near_dedup(docs).collect()}
    assert len(close) == 20 and kept == set(sets) - {b for _, b in close}
    items = {r["item_id"]: r["text"].split() for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    want = {(d, i) for d, w in texts.items() for i, t in items.items() if decontaminate.align(w, t)[0] >= 0.5 * 2 * len(t)}
    found = decontaminate.matches(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_empty_documents_go_through(spark, folder, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()


def test_odd_rows_and_clashing_columns_go_through(spark, folder, tmp_path):
    names = ["shard", "_copy", "_copies", "_place", "_mark", "_whole", "mark", "passage", "n_items"]
    schema = DOC + "".join(f", {n} string" for n in names)
    text = passage(1, 60)
    rows = [(1, text, "aa", "s", 5), (1, text, "aa", "s", 5), (1, passage(2, 60), "aa", "s", 5), (None, passage(3, 60), None, None, None), (None, passage(3, 60), None, None, None), (7, None, None, "s", None), (8, "", "aa", "s", 0), (9, passage(4, 9000), "aa", "t", 1)]
    rows += [(100 + k, passage(50 + k, 40), "aa", "s", 1) for k in range(30)]
    spark.createDataFrame([(*r, *[f"{n}{r[0]}" for n in names]) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = corpus_pipeline.written(spark, stage(spark, docs, str(tmp_path)), f"{tmp_path}/{name}")
        kept = docs.select("doc_id", "text", *names[k == 4 :]).collect()
        assert kept and all(r[n] == f"{n}{r['doc_id']}" for r in kept for n in names[k == 4 :])
        if name == "language_id":
            assert {r["doc_id"] for r in kept} == {r[0] for r in rows} - {7, 8}
        if name == "simhash_dedup":  # of three rows of one id two texts stay; rows without an id all stay
            assert Counter(r["doc_id"] for r in kept)[1] == 2 and Counter(r["doc_id"] for r in kept)[None] == 2 and docs.count() == before - 1
        if name == "decontamination":
            assert docs.count() == before


def test_folders_of_earlier_stages_are_removed(spark, folder):
    corpus_pipeline.run(spark, folder).count()
    shared = corpus_pipeline.shared_folder(spark).removeprefix("file:")
    first = {p.name for p in Path(shared).glob("stage-*")}
    corpus_pipeline.run(spark, folder).count()
    assert len({p.name for p in Path(shared).glob("stage-*")} - first) == 1


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace as fake

    from plumbline.llm.common import shared_folder

    context = fake(getCheckpointDir=lambda: None, master="spark://there:7077", setCheckpointDir=lambda p: pytest.fail(p))
    with pytest.raises(RuntimeError):
        shared_folder(fake(sparkContext=context, conf=fake(get=lambda k, d: None)))


def test_the_rest_works_without_this_subpackage(tmp_path):
    for p in ("__spark_entry__.py", "plumbline"):
        (tmp_path / p).symlink_to(REPO / p) if p.endswith(".py") else None
    target = tmp_path / "plumbline"
    target.mkdir()
    for p in (REPO / "plumbline").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (target / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_every_query_is_registered():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_columns_of_any_name_pass_through(spark, folder):
    from plumbline.llm import langid, mixing, quality, span_dedup

    names = ["_lang", "_stats", "_law", "_source", "_doc", "_spans", "_cut", "component", "node", "bits", "seed"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    for n in names:
        docs = docs.selectExpr("*", f"concat('{n}', doc_id) as {n}")
    model = quality.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality"))
    results = [
        langid.keep_identified(docs), simhash.near_dedup(docs), decontaminate.remove(docs, spark.read.parquet(f"{folder}/benchmark.parquet")),
        mixing.replicate(docs), sharding.assign(docs, [1.0] * 3), span_dedup.dedup(docs), quality.score(docs, model),
    ]
    for found in results:
        rows = found.select("doc_id", *names).collect()
        assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)
