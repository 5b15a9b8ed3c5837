import hashlib
import json
import math
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from plumbline.llm import chat, queries, secrets

MESSAGE = "conv_id long, turn long, role string, text string"


def call(id_, name="search", args=None, deps=None):
    return {"id": id_, "name": name, "arguments": {"query": "q"} if args is None else args, **({"depends_on": deps} if deps else {})}


def assistant(*calls, content=None):
    return json.dumps({"content": content, "tool_calls": list(calls)})


def result(id_, content="done"):
    return json.dumps({"tool_call_id": id_, "content": content})


def lines(spark, rows):
    found = chat.format_messages(spark.createDataFrame(rows, MESSAGE)).orderBy("conv_id", "order_turn", "order_level", "turn").collect()
    return [(r, json.loads(r["line"])) for r in found]


def test_calls_are_linked_ordered_and_checked(spark):
    rows = [
        (1, 0, "user", "Hi \"you\"\nthere"),
        (1, 1, "tool", result("b", "early")),
        (1, 2, "assistant", assistant(call("c", deps=["b"]), call("b", deps=["a"]), call("a", args={"query": "x", "limit": 2}), call("z", "search", {"limit": "many", "more": 1}), call("w", "nope"), content="look")),
        (1, 3, "tool", result("a", "first")),
        (1, 4, "tool", result("unknown")),
    ]
    found = lines(spark, rows)
    assert [(r["turn"], r["order_turn"]) for r, _ in found] == [(0, 0), (2, 2), (1, 2), (3, 3), (4, 4)]
    r, line = found[1]
    assert (r["n_calls"], r["n_answered"], r["n_invalid"]) == (5, 2, 2)
    assert [(c["id"], c["level"]) for c in line["tool_calls"]] == [("a", 0), ("z", 0), ("w", 0), ("b", 1), ("c", 2)]
    faults = {c["id"]: c["faults"] for c in line["tool_calls"]}
    assert faults["z"] == ["limit: not of type integer", "more: not in the schema", "query: missing"] and faults["w"] == ["unknown tool nope"] and faults["a"] == []
    assert found[2][1]["name"] == "search" and found[2][0]["linked"] and found[4][0]["linked"] is False
    assert found[0][1] == {"content": 'Hi "you"\nthere', "conv_id": 1, "role": "user", "turn": 0}


def test_lines_are_canonical(spark):
    messy = '{"tool_calls": [{"name": "run_code", "id": "i", "arguments": {"source": "s", "language": "l", "timeout": 1.5}}]}'
    (_, line), = lines(spark, [(2, 0, "assistant", messy)])
    raw = chat.format_messages(spark.createDataFrame([(2, 0, "assistant", messy)], MESSAGE)).first()["line"]
    assert raw == json.dumps(line, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert list(line["tool_calls"][0]["arguments"]) == ["language", "source", "timeout"]


def test_cycles_and_repeated_ids(spark):
    rows = [(3, 0, "assistant", assistant(call("a", deps=["b"]), call("b", deps=["a"]), call("c"), call("c")))]
    (r, line), = lines(spark, rows)
    got = sorted((c["id"], c["level"], tuple(c["faults"])) for c in line["tool_calls"])
    assert got == [("a", -1, ("depends_on: cycle",)), ("b", -1, ("depends_on: cycle",)), ("c", -1, ("id: used before",)), ("c", 0, ())]
    assert r["n_invalid"] == 3


def test_a_long_chain_of_calls(spark):
    rows = [(4, 0, "assistant", assistant(*[call(f"k{n}", deps=[f"k{n - 1}"] if n else None) for n in range(6)]))]
    (_, line), = lines(spark, rows)
    assert [(c["id"], c["level"]) for c in line["tool_calls"]] == [(f"k{n}", n) for n in range(6)]


def test_other_keys_large_numbers_and_leading_blanks(spark):
    texts = [
        ("assistant", ' \n{"reasoning": {"z": 1, "a": [2, {"d": 1, "c": null}]}, "tool_calls": [{"type": "function", "id": "i", "name": "search", "arguments": {"query": "q", "limit": 100000000000000000000}}], "role": "other", "turn": 99}'),
        ("tool", '{"tool_call_id": "i", "content": [{"type": "text", "text": "x"}], "name": "mine", "is_error": false}'), ("tool", '{"tool_call_id": "j", "content": "y", "name": "mine"}'),
        ("assistant", '{"tool_calls": [{"id": "k", "name": "search", "arguments": "{\\"limit\\": 1.5, \\"query\\": \\"q\\"}"}], "content": "c"}'), ("assistant", '{"a": 1, "a": 2, "tool_calls": []}'),
    ]
    found = lines(spark, [(1, k, role, text) for k, (role, text) in enumerate(texts)])
    call_, linked, lone, own, twice = (line for _, line in sorted(found, key=lambda f: f[0]["turn"]))
    assert call_["reasoning"] == {"a": [2, {"c": None, "d": 1}], "z": 1} and call_["role"] == "assistant" and call_["turn"] == 0
    assert call_["tool_calls"][0]["arguments"]["limit"] == 10**20 and call_["tool_calls"][0]["faults"] == [] and call_["tool_calls"][0]["type"] == "function"
    assert (linked["name"], linked["content"], linked["is_error"]) == ("search", [{"text": "x", "type": "text"}], False) and lone["name"] == "mine"
    assert own["tool_calls"][0]["arguments"] == {"limit": 1.5, "query": "q"} and own["tool_calls"][0]["faults"] == ["limit: not of type integer"]
    assert twice["content"] == texts[4][1]
    for r, line in found:
        assert r["line"] == json.dumps(line, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_levels_of_chains_trees_and_circles_match_brute_force(spark):
    rng = random.Random(8)
    deps = {f"k{n}": [f"k{n - 1}"] if n else [] for n in range(120)}  # one long chain
    for n in range(120, 240):
        deps[f"k{n}"] = [f"k{rng.randrange(n)}" for _ in range(rng.choice([0, 1, 1, 2, 3]))]
    deps |= {"x": ["y"], "y": ["z"], "z": ["x"], "behind": ["k3", "x"], "further": ["behind"], "lost": ["nowhere"]}
    level = {}
    while True:
        new = {i: max((level[d] + 1 for d in ds if d in deps), default=0) for i, ds in deps.items() if i not in level and all(d in level for d in ds if d in deps)}
        if not new:
            break
        level |= new
    calls = spark.createDataFrame([(1, i, ds) for i, ds in deps.items()], "conv_id long, id string, depends_on array<string>")
    assert {r["id"]: r["level"] for r in chat._levels(calls).collect()} == level and level["k119"] == 119 and "behind" not in level


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_the_query_matches_its_sql(spark):
    at = "/root/testdata/sf0.001"
    df = queries.op3_chat_format(spark, at)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{at}/conversations.parquet'")
    want = con.execute(queries.oracle_sql()["op3_chat_format"])
    columns = [c[0] for c in want.description]
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(want.fetchall())
    assert df.where("n_calls > 0").count() > 0 and df.where("linked").count() > 0 and df.where("not linked").count() > 0


def test_nulls_repeats_broken_json_and_empty_tables(spark):
    rows = [(None, None, None, None), (5, 0, "user", "{not json"), (5, 0, "user", "{not json"), (5, 1, "user", ""), (5, 2, "tool", '{"x": 1}'), (None, 3, "assistant", assistant(call("a"))), (6, 0, "user", "long " * 50_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], MESSAGE + ", line int")
    found = chat.format_messages(df).collect()
    assert len(found) == 7 and sorted(r["line"] for r in found)[-1] == "{}"
    assert [json.loads(r["line"])["content"] for r in found if r["turn"] == 0 and r["conv_id"] == 5] == ["{not json"] * 2
    assert chat.format_messages(df.limit(0)).isEmpty()


@pytest.fixture(scope="module")
def known(spark):
    words = "some plain words that stand in every text like pencil window garden answer printer river mountain station".split()
    rows = [(k, " ".join(words[k % 3 :]) + ".") for k in range(30)]
    return secrets.learn(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.fixture(scope="module")
def model(spark, known):
    return secrets.fit(secrets.labelled_findings(spark, known, 4000), known)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_secrets_are_told_from_look_alikes(spark, known, model):
    key, token = "AKIA" + "Q7ZP2M9XK4TD8WLA", "0cab398dc11d1a2a11dc6572c8df8bd228c864f3"
    digest = hashlib.sha1(b"x").hexdigest()
    late = "QzXwVbKjHgTfRdPm" * 20 + "7"
    rows = [
        (1, f"The rest is {key} and so on"), (2, f'set token = "{token}" there'), (3, f"see commit {digest} for it"), (4, "mail someone.long77@example.com or https://example.org/page/123456"),
        (5, None), (6, ""), (7, "only words that are very longindeed"), (None, f"password=9{token[:15]} x"), (8, "pad " * 50_000 + f"password={token[:18]} end"),
        (9, "password: AbCdEfGhIjKlMnOpQr and more"), (10, "password=Xk9#mP2$vL7&qR4! and more"), (11, f"secret={late} end"), (12, "x😀" * 40_000 + "y7" * 40_000),
    ]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    found = secrets.scan(docs, model, known).collect()
    good = {(r["doc_id"], r["sha256"]) for r in found if r["is_secret"]}
    wanted = {(1, sha(key)), (2, sha(token)), (9, sha("AbCdEfGhIjKlMnOpQr")), (10, sha("Xk9#mP2$vL7&qR4!")), (11, sha(late))}
    assert wanted <= good and not {3, 4, 7} & {d for d, _ in good}
    assert {None, 8} <= {d for d, _ in good} and any(r["doc_id"] == 12 and r["length"] == 80_000 for r in found)
    texts = dict(rows)
    for r in found:
        assert sha(texts[r["doc_id"]][r["start"] : r["start"] + r["length"]]) == r["sha256"] or r["doc_id"] == 12
    assert secrets.scan(docs.limit(0), model, known).isEmpty()
    twice = secrets.scan(docs.union(docs), model, known).collect()
    assert sorted(map(str, twice)) == sorted(map(str, found * 2))


def brute_candidates(text):
    """Runs of non-separators with a digit or a change of case, and values after a keyword: scanned sign by sign."""
    out, at = [], 0
    separator = lambda c: c.isspace() or c in "\"'`()[]{}<>,;|=:" or ord(c) > 0xFFFF
    while at < len(text):
        m = re.search(rf"(?i)(?:{secrets.FOR})[A-Za-z0-9_-]{{0,20}}[\"']?[ \t]{{0,3}}[:=]{{1,2}}[ \t]{{0,3}}[\"']?$", text[max(0, at - 80) : at])
        if m and text[at - 1] in "\"'":
            closed = re.match(rf"[^\s{text[at - 1]}]{{6,}}(?={text[at - 1]})", text[at:])
            if closed:
                out.append((at, closed[0]))
                at += len(closed[0])
                continue
        if m and text[at - 1] in ":=\"' \t" and not (text[at].isspace() or text[at] in "\"'`=:"):
            end = at
            while end < len(text) and not text[end].isspace() and text[end] not in "\"'`":
                end += 1
            while end > at and text[end - 1] in ".,;:)]}>":
                end -= 1
            if end - at >= 6:
                out.append((at, text[at:end]))
                at = end
                continue
        if not separator(text[at]) and (at == 0 or separator(text[at - 1])):
            end = at
            while end < len(text) and not separator(text[end]):
                end += 1
            run = text[at:end]
            if re.search("[0-9]|[a-z][A-Z]", run):
                run = run.rstrip(".!?")
                if len(run) >= 8:
                    pad = re.match("={0,2}", text[at + len(run) :])[0] if at + len(run) == end else ""
                    out.append((at, run + pad))
                    at += len(run + pad)
                    continue
        at += 1
    return out


def test_candidates_match_brute_force(spark):
    rng = random.Random(5)
    parts = ["password", "token", " ", " = ", ": ", "=", '"', "'", "abcDefgh", "x9y8z7w6v5", "plainwords", "Pa$$w0rd!", "https://site.org/a1b2c3d4", "a.b@c.d12", ", ", ".", "\n", "apiKeyName", "short1", "==", "été99été", "(", ")"]
    rows = [(k, "".join(rng.choices(parts, k=rng.randint(1, 14)))) for k in range(400)]
    got = {k: [] for k, _ in rows}
    for r in secrets.candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r["doc_id"]].append((r["start"], r["found"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: brute_candidates(t) for k, t in rows}


def test_quoted_values_are_whole_and_pass_is_a_keyword(spark):
    cases = {
        'token = "p,w;x|1)2]" end': ["p,w;x|1)2]"], "secret: 'a\"b=c:d;e.'.": ['a"b=c:d;e.'], "DB_PASS=hunter2!": ["hunter2!"], "db-pass: \"=:abc.)\"": ["=:abc.)"], 'pwd="open,ended;value) ': ["open,ended;value"],
        'token="two words,here" x': [], "bypass=northern compass: westward passenger=somebody": [], 'pass = "short"': [], "The pass: northern": ["northern"],
    }
    rows = list(enumerate(cases))
    got = {k: [] for k, _ in rows}
    for r in secrets.candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r["doc_id"]].append(r["found"])
    assert {text: got[k] for k, text in rows} == cases


def test_the_forest_generalises_to_formats_it_has_not_seen(spark, known):
    findings = secrets.labelled_findings(spark, known, 4000)
    model = secrets.fit(findings.where(~findings.format.isin(*secrets.HELD_OUT)), known)
    judged = model.transform(secrets._assembled(findings.where(findings.format.isin(*secrets.HELD_OUT)), known))
    by_label = {r["label"]: r["a"] for r in judged.groupBy("label").agg({"_c": "avg"}).withColumnRenamed("avg(_c)", "a").collect()}
    assert by_label[1.0] > 0.9 and by_label[0.0] < 0.1


def test_dictionary_and_letter_pairs_are_counted(spark):
    rows = [(1, "cab cab CAB, cab cab. dot"), (2, None), (3, ""), (4, "cab dot dot dot dot é")]
    known = secrets.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["word"] for r in known.words.collect()) == ["cab", "dot"]
    a, b, c = (ord(x) - 96 for x in "abc")
    assert known.pairs[c * 27 + a] == pytest.approx(math.log((6 + 0.5) / (6 + 13.5))) and known.pairs[a * 27 + c] == pytest.approx(math.log(0.5 / (6 + 13.5))) and known.pairs[0] == 0
    assert secrets.learn(spark.createDataFrame([], "doc_id long, text string")).words.isEmpty()
