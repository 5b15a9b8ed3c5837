import random

import pytest

from plumbline.llm import queries
from plumbline.llm import span_dedup as s

DOC = "doc_id long, text string"


def sentence(seed, n=12):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(9000)}" for _ in range(n)) + "."


STOP = ".!?"


def split(text):
    """Sentences, written out apart from the operator: (text, words) up to a stop before a blank, or a line end."""
    out, at = [], 0
    for k, c in enumerate(text):
        stop = c in STOP and k + 1 < len(text) and text[k + 1].isspace()
        if stop or c == "\n" or k == len(text) - 1:
            part = " ".join(text[at : k + 1].lower().split())
            if part:
                out.append((part, len(part.split())))
            at = k + 1
    return out


def brute(docs, run, min_words, long_words):
    """Every run of ``run`` sentences and every long sentence, hashed in order; covered stretches that are long enough, by document."""
    first, out = {}, {d: set() for d, _ in docs}
    for d, text in sorted((x for x in docs if x[0] is not None and x[1] is not None), key=lambda x: x[0]):
        parts = split(text)
        covered = set()
        for k in range(len(parts)):
            for n in (run, 1):
                if k + n > len(parts) or (n == 1 and run > 1 and parts[k][1] < long_words):
                    continue
                key = tuple(p for p, _ in parts[k : k + n])
                if first.setdefault(key, (d, k)) != (d, k):
                    covered |= set(range(k, k + n))
        stretch = []
        for k in range(len(parts) + 1):
            if k in covered:
                stretch.append(k)
            elif stretch:
                if sum(parts[j][1] for j in stretch) >= min_words:
                    out[d] |= set(stretch)
                stretch = []
    return out


@pytest.mark.parametrize(("run", "min_words", "long_words"), [(2, 12, 25), (3, 0, 10), (2, 20, 30)])
def test_removals_match_brute_force(spark, run, min_words, long_words):
    rng = random.Random(1)
    shared = [[sentence(100 * k + j, rng.choice([1, 3, 12, 26])) for j in range(rng.randint(1, 6))] for k in range(8)]
    docs = []
    for d in range(80):
        parts = [sentence(10_000 + 50 * d + j, rng.randint(1, 15)) for j in range(6)]
        if d % 2:
            parts[3:3] = rng.choice(shared)
        docs.append((d, ("\n" if d % 3 else " ").join(parts)))
    want = brute(docs, run, min_words, long_words)
    got = {r["doc_id"]: r for r in s.dedup(spark.createDataFrame(docs, DOC), run, min_words, long_words).collect()}
    assert {d: len(v) for d, v in want.items()} == {d: r["n_removed"] for d, r in got.items()} and any(want.values())
    for d, text in docs:
        left = [p for k, (p, _) in enumerate(split(text)) if k not in want[d]]
        assert [p for p, _ in split(got[d]["kept_text"])] == left
        gone = "".join(text[r["start"] : r["end"]] for r in got[d]["removed"])
        assert len(gone) + len(got[d]["kept_text"]) == len(text)
        assert bool(got[d]["first_doc_ids"]) == bool(want[d]) and all(f <= d for f in got[d]["first_doc_ids"])


def test_the_first_place_stays_and_case_and_blanks_dont_matter(spark):
    a, b = sentence(1), sentence(2)
    docs = [(3, f"{a} {b} Own end."), (1, f"Own start. {a}   {b.upper()}"), (2, f"{a} {a} {b} {a} {b}")]
    got = {r["doc_id"]: r["kept_text"] for r in s.dedup(spark.createDataFrame(docs, DOC)).collect()}
    assert got[1] == docs[1][1] and got[3] == "Own end." and got[2] == f"{a} "


def test_nulls_repeats_empty_and_long_texts(spark):
    text = f"{sentence(5)} {sentence(6)}"
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (None, text, "y"), (2, None, "z"), (3, "", "z"), (4, "one", "z"), (5, "a b c. " * 30_000, "z")], DOC + ", removed string")
    got = s.dedup(docs).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and all(r["kept_text"] == text for r in got if r["doc_id"] in (1, None))
    assert (by[2]["kept_text"], by[2]["n_sentences"], by[3]["kept_text"], by[4]["kept_text"]) == (None, 0, "", "one")
    assert by[5]["n_sentences"] == 30_000 and by[5]["n_removed"] == 29_999
    assert s.dedup(spark.createDataFrame([], DOC)).isEmpty()


def test_a_repeated_block_is_covered_whole(spark):
    def removed(lengths, **how):
        whole = " ".join(sentence(70 + k, n) for k, n in enumerate(lengths))
        docs = [(d, f"{sentence(d, 22)} {whole} {sentence(d + 1, 18)}") for d in (1, 5)]
        return [r["n_removed"] for r in s.dedup(spark.createDataFrame(docs, DOC), **how).orderBy("doc_id").collect()]

    for lengths in ([1, 14, 1, 2], [15, 15, 3], [12, 12, 1], [1, 12, 12, 1, 1], [4, 4, 4], [31]):
        assert removed(lengths) == [0, len(lengths)], lengths
    assert removed([5, 3]) == [0, 0] and removed([20]) == [0, 0] and removed([5, 3], min_words=0) == [0, 2]
    wide = "今日は天気が良いですと彼は言った。明日も天気が良いでしょうと彼女は答えた。"
    got = s.dedup(spark.createDataFrame([(1, wide + "違う文。"), (2, "別の始まり。" + wide)], DOC)).orderBy("doc_id").collect()
    assert [(r["n_removed"], r["kept_text"]) for r in got] == [(0, wide + "違う文。"), (2, "別の始まり。")]


def test_the_query_returns_every_document(spark, tmp_path):
    text = f"{sentence(5)} {sentence(6)}"
    docs = [(1, text), (2, text), (3, sentence(7)), (4, ""), (5, None), (None, text)]
    spark.createDataFrame(docs, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_removed"], r["kept_chars"]) for r in queries.op2_span_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (0, len(text)), 2: (2, 0), 3: (0, len(docs[2][1])), 4: (0, 0), 5: (0, None), None: (0, len(text))}
