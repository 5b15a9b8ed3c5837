import itertools
import random
import re

import duckdb

from plumbline.llm import filter_audit, oracles, queries

DOC = "doc_id long, text string, lang string"
LABEL = "doc_id long, quality int, toxic int"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        *("A" if len(words) < 200 else ""), *("B" if 100 * len(set(words)) < 50 * len(words) else ""),
        *("C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""), *("D" if re.search("[#$%&*|]", text) else ""),
    }


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, lang in docs:
        text = text or ""
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        rows.append((i, lang or "", fails(text) | ({"E"} if copy else set())))
    out = {}
    for part in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == part]
        total = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[2]], [r for r in left if f not in r[2]]
                total[f] += len(gone)
                steps.append(("".join(order), step, f, len(left), len(gone), sum(f in r[2] for r in mine) - len(gone), sum(r[2] == {f} for r in mine), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)))
        out |= {(part, o, s): (*rest, total[f]) for o, s, f, *rest in steps}
    return out


def found(spark, docs, labels):
    got = filter_audit.audit(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABEL)).collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filter_audit.COLUMNS[2:]) for r in got}
    assert len(out) == len(got)
    return out


def test_every_order_by_single_swaps():
    order, seen = list("ABCDE"), {"ABCDE"}
    for k in filter_audit.swaps(5):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.add("".join(order))
    assert len(seen) == 120 and len(list(filter_audit.swaps(5))) == 119


def test_audit_matches_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["one", "Two", "été", "#x", f"w{rng.randrange(400)}", " wide", "😀"]) for _ in range(rng.choice([0, 3, 199, 200, 201, 250]))) for _ in range(30)]
    texts += [" ".join(f"w{k}" for k in range(n)) + end for n in (199, 200) for end in ("", "\n", " ABCDEF G" * 6)] + ["", None, "a\x0bb\x0cc", "a " * 100_000]
    docs = [(k, rng.choice(texts), rng.choice(["en", "fr", None, "", "xx"])) for k in rng.sample(range(1000), 120)]
    docs += [(2000 + k, texts[0], "en") for k in range(60)] + [(5, "the same", "en"), (5, "the same", "fr"), (5, "other", "fr"), (None, "the same", "en"), (None, None, None)]
    labels = [(d[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in docs[:90]] + [(docs[0][0], 1, 1), (None, 1, 1), (99999, 1, 1)]
    assert found(spark, docs, labels) == brute(docs, labels)


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, [], []) == {}
    assert found(spark, [(1, "x", "en")], []) == brute([(1, "x", "en")], [])
    docs = spark.createDataFrame([(1, "x", "en", 7, 8, 9)], DOC + ", part int, mask int, good int")
    got = filter_audit.audit(docs, spark.createDataFrame([(1, 1, 0, "z")], LABEL + ", digest string")).collect()
    assert len(got) == 600 and {r["good_lost"] for r in got if r["removed"]} == {1}


def test_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    want = con.execute(oracles.SQL["op12_filter_audit"])
    columns = [c[0] for c in want.description]
    got = queries.op12_filter_audit(spark, sf)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(want.fetchall())
