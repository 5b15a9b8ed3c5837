import random
import re
from collections import Counter

from plumbline.llm import decontaminate as d

DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def smith_waterman(a, b):
    h = [[0] * (len(a) + 1) for _ in range(len(b) + 1)]
    for r in range(1, len(b) + 1):
        for c in range(1, len(a) + 1):
            h[r][c] = max(0, h[r - 1][c - 1] + (2 if a[c - 1] == b[r - 1] else -1), h[r - 1][c] - 1, h[r][c - 1] - 1)
    return max(map(max, h))


def test_alignment_matches_the_plain_recurrence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = rng.choices("abcd", k=rng.randint(1, 25)), rng.choices("abcd", k=rng.randint(1, 12))
        score, start, end = d.align(a, b)
        assert score == smith_waterman(a, b)
        assert score == 0 or smith_waterman(a[start:end], b) == score


def make(n, seed):
    rng = random.Random(seed)
    return " ".join(f"v{rng.randrange(4000)}" for _ in range(n))


def test_copies_edits_and_clean_texts(spark):
    item = make(40, 1)
    words = item.split()
    edited = [w if k % 6 else "other" for k, w in enumerate(words)]
    dropped = [w for k, w in enumerate(words) if k % 9]
    docs = [
        (1, make(100, 2) + " " + item.upper() + ". " + make(50, 3)), (2, make(30, 4) + " " + " ".join(edited)), (3, " ".join(dropped) + " " + make(300, 5)),
        (4, make(200, 6)), (5, " ".join(words[:9]) + " " + make(80, 7)),
    ]
    found = {r["doc_id"]: r for r in d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame([(7, item), (8, make(40, 9))], ITEM)).collect()}
    assert set(found) == {1, 2, 3}
    assert (found[1]["item_id"], found[1]["score"], found[1]["start_word"], found[1]["end_word"]) == (7, 1.0, 100, 140)
    assert 0.5 <= found[2]["score"] < 1 and 0.5 <= found[3]["score"] < 1


def test_results_equal_brute_force_over_all_pairs(spark):
    rng = random.Random(8)
    items = [(k, make(rng.randint(12, 40), 100 + k)) for k in range(8)]
    docs = []
    for k in range(40):
        parts = [make(60, 500 + k)]
        for _, text in rng.sample(items, k % 3):
            words = text.split()
            for at in rng.sample(range(len(words)), len(words) // 8):
                words[at] = "x"
            parts += [" ".join(words), make(20, 900 + k)]
        docs.append((k, " ".join(parts)))
    want = {(i, j): s for i, t in docs for j, u in items if (s := smith_waterman(t.split(), u.split()) / (2 * len(u.split()))) >= 0.5}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()}
    assert got == want


def edited(words, every, start=0):
    return [w if k % every != start else "other" for k, w in enumerate(words)]


def test_brute_force_over_signs_between_words_and_short_items(spark):
    rng = random.Random(11)
    joins = [" ", ".", "-", ", ", "(", " = ", "/"]
    items = [(k, joins[k % 7].join(make(rng.choice([1, 2, 3, 5, 9, 40]), 300 + k).split())) for k in range(24)]
    docs = []
    for k in range(60):
        parts = [make(rng.randint(0, 80), 700 + k)]
        for _, text in rng.sample(items, k % 4):
            words = edited(decontaminate_words(text), rng.choice([4, 5, 50]), 3)
            parts += [rng.choice(joins).join(words), make(25, 1200 + k)]
        docs.append((k, " ".join(parts)))
    want = {}
    for i, t in docs:
        for j, u in items:
            a, b = decontaminate_words(t), decontaminate_words(u)
            runs = {tuple(b[k : k + min(3, len(b))]) for k in range(len(b) - min(3, len(b)) + 1)}
            seeded = any(tuple(a[k : k + min(3, len(b))]) in runs for k in range(len(a)))
            if seeded and (s := smith_waterman(a, b) / (2 * len(b))) >= 0.5:
                want[i, j] = s
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()}
    assert got == want and {len(decontaminate_words(u)) for j, u in items if any(j == b for _, b in want)} >= {1, 2, 3, 5, 9, 40}


def decontaminate_words(text):
    return re.findall(r"\w+", text.lower())


def test_words_joined_by_dots_and_edited_are_found(spark):
    words = make(40, 77).split()
    middle = words[:8] + [w if k % 3 else "other" for k, w in enumerate(words[8:32])] + words[32:]
    docs = [(1, make(30, 5) + " " + ".".join(middle) + " end"), (2, make(60, 6))]
    found = d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame([(3, ".".join(words))], ITEM)).collect()
    assert [(r["doc_id"], r["score"] >= 0.6) for r in found] == [(1, True)]


def test_many_documents_with_one_edit_are_all_found(spark):
    words = make(20, 13).split()
    changed = [w if k not in (4, 9, 14, 17) else "other" for k, w in enumerate(words)]
    docs = [(0, make(20, 2) + " " + " ".join(words))] + [(k, make(20, 50 + k) + " " + " ".join(changed) + " " + make(20, 150 + k)) for k in range(1, 60)]
    got = {r["doc_id"] for r in d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame([(1, " ".join(words))], ITEM)).collect()}
    assert got == set(range(60))


def test_the_word_bound_never_hides_an_alignment():
    rng = random.Random(3)
    for _ in range(300):
        a, b = rng.choices("abcdef", k=rng.randint(1, 20)), rng.choices("abcdef", k=rng.randint(1, 10))
        if smith_waterman(a, b) >= 0.5 * 2 * len(b):
            assert d.may_reach(Counter(a), b, 0.5)


def test_a_passage_shared_by_most_documents_is_found_in_all(spark):
    item = make(30, 1)
    docs = [(k, make(20, 50 + k) + " " + item) for k in range(120)]
    assert d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame([(1, item)], ITEM)).count() == 120


def test_nulls_repeats_empty_tables_and_extra_columns(spark):
    item = make(20, 3)
    docs = spark.createDataFrame([(1, item, 0), (1, item, 0), (None, item, 1), (2, None, 1), (3, "", 2), (4, "word " * 30_000 + item, 3)], DOC + ", score int")
    items = spark.createDataFrame([(5, item), (6, item), (None, "a b c d e"), (7, None), (8, "")], ITEM)
    got = d.matches(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_items"]) for r in got) == [(1, 5, 2), (4, 5, 2)]
    left = d.remove(docs, items)
    assert left.columns == docs.columns and sorted((r["doc_id"] for r in left.collect()), key=str) == [2, 3, None]
    empty = spark.createDataFrame([], ITEM)
    assert d.matches(docs, empty).isEmpty() and d.remove(docs, empty).count() == 6
    assert d.matches(spark.createDataFrame([], DOC), items).isEmpty()


def test_a_lone_edited_copy_among_exact_ones_keeps_its_seeds(spark):
    item = make(30, 1)
    edited = [w if k % 5 != 4 else "y" for k, w in enumerate(item.split())]  # runs of four words are left
    docs = [(k, make(20, 50 + k) + " " + item) for k in range(40)] + [(99, make(40, 7) + " " + " ".join(edited))]
    found = {r["doc_id"] for r in d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame([(1, item)], ITEM)).collect()}
    assert found == {*range(40), 99}


def test_rarer_seeds_of_another_item_hide_no_leak(spark):
    items = spark.createDataFrame([(1, "a b c d"), (2, "c d e f g h")], ITEM)
    docs = [(k, f"x{k} a b c d y{k}") for k in range(12)] + [(50, "a b c d e f g h")]
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in d.matches(spark.createDataFrame(docs, DOC), items).collect()}
    assert found[50, 1] == 1.0 and found[50, 2] == 1.0 and {(k, 1) for k in range(12)} <= set(found)
    first = "solve the following equation for the unknown value now"
    items = spark.createDataFrame([(1, first), (2, "unknown value now equals seven times pi over two plus one")], ITEM)
    edit = "solve the zed equation for foo unknown value now"
    docs = [(k, f"p{k} q{k} {edit} r{k}") for k in range(12)] + [(50, edit + " equals seven")]
    kept = d.remove(spark.createDataFrame(docs, DOC), items)
    assert kept.isEmpty()


def test_items_that_overlap_equal_brute_force_over_any_three_words(spark):
    rng = random.Random(12)
    items = [(k, " ".join(f"w{rng.randrange(12)}" for _ in range(rng.randint(3, 9)))) for k in range(15)]
    docs = []
    for k in range(60):
        parts = []
        for _ in range(3):
            words = rng.choice(items)[1].split()
            parts += [w if rng.random() > 0.2 else f"w{rng.randrange(12)}" for w in words] + [f"n{k}"] * rng.randrange(3)
        docs.append((k, " ".join(parts)))
    grams = lambda t: {tuple(t[i : i + 3]) for i in range(len(t) - 2)}
    by_text = {t: i for i, t in sorted(items, reverse=True)}
    want = {(i, j) for i, t in docs for u, j in by_text.items() if grams(t.split()) & grams(u.split()) and smith_waterman(t.split(), u.split()) >= len(u.split())}
    got = {(r["doc_id"], r["item_id"]) for r in d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), common=1e12).collect()}
    assert got == want
    rare = {(r["doc_id"], r["item_id"]) for r in d.matches(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()}
    assert rare <= want and len(rare) > 0.95 * len(want)
