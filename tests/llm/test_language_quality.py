import math
import random
import re
import unicodedata
import zlib
from collections import Counter

from plumbline.llm import langid, quality

SOUNDS = {"aa": "ka lo mi nu ra so ti", "bb": "str ght ing ous ple ver", "cc": "ço ñi él ü ßa ìn"}


def sentence(lang, rng, n=20):
    parts = SOUNDS[lang].split()
    common = parts[:3]
    return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choices(parts, k=3)) for _ in range(n))


def documents(n=240):
    rng = random.Random(2)
    return [(k, sentence(lang := sorted(SOUNDS)[k % 3], rng), lang) for k in range(n)]


def test_held_out_rows_are_identified_and_teach_nothing(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.identify(df).select("doc_id", "lang", "_lang.*", langid.held_out().alias("h")).toDF("doc_id", "lang", "pred", "score", "h").collect()
    assert {r["doc_id"] for r in found if r["h"]} == {k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    assert sum(r["pred"] == r["lang"] for r in found if r["h"]) >= 0.97 * sum(r["h"] for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    other = df.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 'zz' else lang end as lang")
    again = {r["doc_id"]: r["_lang"]["lang"] for r in langid.identify(other).collect()}
    assert again == {r["doc_id"]: r["pred"] for r in found}


def test_backoff_by_length():
    h = langid.gram_hash
    rows = [(0, h("word"), 0, 9), (0, h("other"), 1, 9), (3, h("^qa"), 1, 5), (3, h("zzz"), 0, 5), (1, h("z"), 0, 4), (1, h("z"), 1, 1), (1, h("y"), 1, 3)]
    model = langid.Model(["x", "y"], langid.Tables(rows, 2))
    assert model.predict("Word word!")[0] == "x" and model.predict("qaaa")[0] == "y" and model.predict("zz")[0] == "x"
    assert model.predict("123 ...") == model.predict("x² ½"[1:]) == ("und", 0.0) and model.predict(None) == ("und", 0.0) and model.predict("日本")[1] == 0.5


def brute_language(rows, texts):
    """Words first, then shorter and shorter n-grams, with plain dictionaries over all labelled rows."""
    counts = {n: {} for n in range(6)}
    langs = sorted({lang for _, _, lang in rows})
    pieces = lambda w, n: [w] if n == 0 else list(w) if n == 1 else [f"^{w}$"[k : k + n] for k in range(len(w) + 3 - n)]
    for _, text, lang in rows:
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            for n in counts:
                for g in pieces(w, n):
                    counts[n].setdefault(g, Counter())[lang] += 1
    counts = {n: {g: c for g, c in grams.items() if sum(c.values()) >= 2} for n, grams in counts.items()}
    sums = {n: {x: sum(c[x] for c in grams.values()) for x in langs} for n, grams in counts.items()}

    def logs(w):
        for n in (0, 5, 4, 3, 2, 1):
            known = [g for g in pieces(w, n) if g in counts[n]]
            if known:
                return [sum(math.log((counts[n][g][x] + 0.5) / (sums[n][x] + 0.5 * (len(counts[n]) + 1))) for g in known) / len(known) for x in langs]
        return [0.0] * len(langs)

    out = []
    for text in texts:
        table = [logs(w) for w in re.findall(r"[^\W\d_]+", text.lower())]
        total = [sum(c) for c in zip(*table, strict=True)]
        best = total.index(max(total))
        out.append((langs[best], sum(math.exp(r[best]) / sum(map(math.exp, r)) for r in table) / len(table)))
    return out


def test_predictions_match_brute_force(spark):
    rng = random.Random(9)
    rows = documents(120)
    mixed = [(500 + k, sentence("aa", rng, 4) + " " + sentence("cc", rng, 3) + f" q{k}ß xyzzy", None) for k in range(20)]
    df = spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string")
    taught = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    want = brute_language(taught, [t for _, t, _ in rows + mixed])
    got = {r["doc_id"]: r["_lang"] for r in langid.identify(df).collect()}
    for (doc, _, _), (lang, score) in zip(rows + mixed, want, strict=True):
        assert got[doc]["lang"] == lang and math.isclose(got[doc]["score"], score, rel_tol=1e-9)


def test_groups_of_texts_and_words_change_nothing(monkeypatch):
    rng = random.Random(3)
    texts = [sentence(lang, rng) for lang in SOUNDS for _ in range(9)] + [None, "", "ka lo " * 50]
    rows = [(n, langid.gram_hash(g), k, 3) for k, lang in enumerate(SOUNDS) for n in langid.LENGTHS for g in {g for w in SOUNDS[lang].split() for g in langid.grams_of(w, n)}]
    model = langid.Model(sorted(SOUNDS), langid.Tables(rows, 3))
    want = model.predict_all(texts)
    monkeypatch.setattr(langid, "GROUP_CHARS", 70)
    monkeypatch.setattr(langid, "GROUP_WORDS", 3)
    assert [t for group in langid.groups_of(texts) for t in group] == texts
    again = langid.Model(sorted(SOUNDS), langid.Tables(rows, 3)).predict_all(texts)
    assert [lang for lang, _ in again] == [lang for lang, _ in want]
    assert all(math.isclose(a, b, rel_tol=1e-12) for (_, a), (_, b) in zip(again, want, strict=True))


def test_a_rare_language_keeps_its_share_of_the_sample(spark):
    rng = random.Random(4)
    rows = [(k, sentence("aa", rng), "aa") for k in range(900)] + [(2000 + k, sentence("cc", rng), "cc") for k in range(6)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_docs=60)
    assert model.langs == ["aa", "cc"] and model.predict(sentence("cc", rng))[0] == "cc" and model.predict(sentence("aa", rng))[0] == "aa"


def test_repeated_rows_get_equal_languages(spark):
    df = spark.createDataFrame(documents(60) * 2, "doc_id long, text string, lang string")
    got = {}
    for r in langid.identify(df).collect():
        assert got.setdefault(r["doc_id"], r["_lang"]) == r["_lang"]


def test_language_nulls_empty_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, score double"
    df = spark.createDataFrame([(*r, 1.0) for r in documents(90)] + [(900, None, "aa", 0.0), (901, "", None, 0.0), (None, "ka lo mi", None, 0.0), (902, "?! 12", None, 0.0), (903, "ka lo " * 40_000, None, 0.0)], schema)
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= {903, None} and kept.where("doc_id in (900, 901, 902)").isEmpty()
    assert langid.identify(spark.createDataFrame([], schema)).isEmpty()
    assert {r["_lang"]["lang"] for r in langid.identify(df.where("lang is null")).collect()} == {"und"}


def labelled(n=360):
    rng = random.Random(7)
    rows = []
    for k in range(n):
        text = sentence("aa", rng, rng.randint(5, 60))
        bad = k % 3 == 0
        rows.append((k, text.upper() if bad and k % 2 else " ".join(w + "%%%" for w in text.split()) if bad else text, 0 if bad else 1))
    return rows


def test_rules_separate_held_out_rows(spark):
    rows = labelled()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    truth = {r[0]: r[2] for r in rows}
    found = quality.score(docs, model).select("doc_id", "_score", quality.held_out().alias("h")).collect()
    held = [r for r in found if r["h"]]
    assert {r["doc_id"] for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 3 == 1}
    assert sum((r["_score"] >= 0.5) == (truth[r["doc_id"]] == 1) for r in held) >= 0.97 * len(held)
    assert 0 < len(model.weights) < 100


def test_paths_of_a_printed_forest():
    text = "Forest\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 1.5)\n     If (feature 1 <= 2.0)\n      Predict: 0.0\n     Else (feature 1 > 2.0)\n      Predict: 1.0\n    Else (feature 0 > 1.5)\n     If (feature 0 <= 3.0)\n      Predict: 1.0\n"
    assert set(quality.paths(text, ["a", "b"])) == {
        (("a", "<=", 1.5),), (("a", "<=", 1.5), ("b", "<=", 2.0)), (("a", "<=", 1.5), ("b", ">", 2.0)), (("a", ">", 1.5),), (("a", "<=", 3.0), ("a", ">", 1.5)),
    }


def test_quality_nulls_one_class_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 2.0), (None, "a b", 2.0), (3, "Word. " * 30_000, 2.0), (3, "Word. " * 30_000, 2.0)], "doc_id long, text string, upper double")
    one = spark.createDataFrame([(0, 1), (2, 1), (3, None), (None, 0)], "doc_id long, quality int")
    model = quality.fit(docs, one)
    found = quality.score(docs, model)
    assert found.columns == [*docs.columns, "_score"] and {round(r["_score"], 6) for r in found.collect()} in ({0.75}, {0.5})
    assert quality.score(docs.limit(0), model).isEmpty()
    assert [r["_score"] for r in quality.score(docs.limit(1), quality.fit(docs, one.limit(0))).collect()] == [0.5]


def brute_statistics(text):
    chars, words, lines = max(len(text), 1), re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ").split(" "), text.split("\n")
    share = lambda keep: sum(1 for c in text if keep(c)) / chars
    kind = lambda c: unicodedata.category(c)
    return {
        "log_chars": math.log(chars + 1), "log_words": math.log(len(words) + 1), "word_length": chars / len(words), "upper": share(lambda c: kind(c) == "Lu"),
        "digits": share(lambda c: c in "0123456789"), "ends": share(lambda c: c in ".,;:?"),
        "marks": share(lambda c: kind(c)[0] not in "LM" and c not in "0123456789 \t\n\x0b\f\r.,;:?"), "new_words": len(set(words)) / len(words),
        "new_lines": len(set(lines)) / len(lines), "line_length": math.log(chars / len(lines) + 1),
    }


def test_scores_match_the_rules_read_by_hand(spark):
    rows = labelled()
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, ""), (901, "Été 12, ÀB?!\n\nx x\tx %%%"), (902, " ")], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"))
    assert model.weights
    for r in quality.score(docs, model).collect():
        stats = brute_statistics(r["text"])
        total = model.intercept + sum(w for rule, w in model.weights.items() if all((stats[n] <= at) == (op == "<=") for n, op, at in rule))
        assert math.isclose(r["_score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9), r["text"][:40]


def test_conflicting_labels_and_texts_of_one_id_give_one_model(spark):
    rows = labelled(120)
    docs = [r[:2] for r in rows] + [(rows[0][0], "QQQ 12 %%%"), (rows[0][0], "zz")]
    labels = [(r[0], r[2]) for r in rows] + [(rows[5][0], 1 - rows[5][2])]
    models = [
        quality.fit(spark.createDataFrame(d, "doc_id long, text string").repartition(n), spark.createDataFrame(x, "doc_id long, quality int"))
        for d, x, n in ((docs, labels, 2), (docs[::-1], labels[::-1], 3))
    ]
    assert models[0].weights == models[1].weights and models[0].intercept == models[1].intercept
