"""One query an operator, with production parameters over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import chat, decontaminate, embeddings, filter_audit, langid, mixing, neighbours, oracles, quality, secrets, sharding, simhash, span_dedup, whitening
from plumbline.llm.common import cut, table

SHARDS = [1.0] * 24


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what it loses, where that stays, and the length and checksum of the text it keeps."""
    found = span_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.crc32(F.col("kept_text").cast("binary")).alias("kept_crc32")
    return found.select("doc_id", "n_sentences", "n_removed", "removed", "first_doc_ids", F.length("kept_text").alias("kept_chars"), digest)


#: Arguments and what is wrong with them, by tool; {q} stands for the message's first words as JSON. Keys aren't in order.
ARGUMENTS: dict[str, list[tuple[str, list[str]]]] = {
    "search": [
        ('{{"query": {q}, "limit": 3}}', []), ('{{"more": 1, "limit": "many"}}', ["limit: not of type integer", "more: not in the schema", "query: missing"]),
        ('{{ "query":{q}, "limit":100000000000000000000 }}', []), ('{{"query": 7.5}}', ["query: not of type string"]),
    ],
    "calculator": [('{{"expression": {q}}}', []), ("{{}}", ["expression: missing"]), ("[1, 2]", ["arguments: not an object"]), ('{{"expression": null}}', ["expression: not of type string"])],
    "get_weather": [
        ('{{"unit": "C", "city": {q}}}', []), ('{{"city": {{"b": 1, "a": [true, null]}}}}', ["city: not of type string"]), ('{{"city": {q}, "unit": false}}', ["unit: not of type string"]), ('{{"city": {q}}}', []),
    ],
    "run_code": [
        ('{{"source": {q}, "language": "py", "timeout": 2}}', []), ('{{"timeout": 1.5, "source": {q}, "language": "py"}}', []), ('{{"timeout": "x", "language": 1}}', ["language: not of type string", "source: missing", "timeout: not of type number"]),
        ('{{"source": {q}}}', ["language: missing"]),
    ],
    "lookup": [('{{"query": {q}}}', ["unknown tool lookup"]), ("{{}}", ["unknown tool lookup"]), ('{{"z": 1, "y": 2}}', ["unknown tool lookup"]), ("3", ["arguments: not an object", "unknown tool lookup"])],
}


def _digit(at: int, *parts: Column) -> Column:
    """A number from 0 to 255 out of the hash of ``parts``."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 2 * at + 1, 2), 16, 10).cast("int")


def with_tool_calls(messages: DataFrame) -> DataFrame:
    """``messages`` with tool calls in the assistants' texts and messages of results, all fixed by hashes of conv_id and turn.

    Seven of eight assistant turns call one or two tools, with right and wrong arguments, dependencies on earlier and later
    calls (some in circles), repeated and missing ids; four of five calls get a result, one turn later or earlier.
    """
    c, t = F.col("conv_id"), F.col("turn")
    rows = messages.select("conv_id", "turn", "role", "text")
    n = F.when(_digit(0, c, t) % 8 == 0, 0).otherwise(_digit(0, c, t) % 2 + 1)
    asking = rows.where("role = 'assistant'").withColumn("n", n)
    calls = asking.where("n > 0").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    d = lambda at: _digit(at, c, t, F.col("j"))
    name = F.get(F.array(*[F.lit(k) for k in ARGUMENTS]), d(1) % len(ARGUMENTS))
    id_ = F.when(d(2) % 13 == 0, "shared").when(d(2) % 13 == 1, None).otherwise(F.concat(F.lit("c"), t, F.lit("-"), F.col("j")))
    deps = (
        F.when(d(3) % 6 == 3, F.array(F.concat(F.lit("c"), t + 2, F.lit("-0"))))
        .when(d(3) % 6 == 4, F.array(F.concat(F.lit("c"), t - 2, F.lit("-0")), F.concat(F.lit("c"), t - 4, F.lit("-0"))))
        .when((d(3) % 6).isin(1, 2), F.array(F.concat(F.lit("c"), t - 2, F.lit("-0"))))
        .when((d(3) % 6 == 5) & (F.col("j") == 1), F.array(F.concat(F.lit("c"), t, F.lit("-0"))))
    )
    q = chat.quoted(F.substring("text", 1, 9))
    shapes = F.array(*[F.array(*[F.format_string(a.replace("%", "%%").replace("{q}", "%s").replace("{{", "{").replace("}}", "}"), *[q] * a.count("{q}")) for a, _ in kinds]) for kinds in ARGUMENTS.values()])
    args = F.get(F.get(shapes, d(1) % len(ARGUMENTS)), d(4) % 4)
    calls = calls.withColumns({"name": name, "id": id_, "deps": deps, "args": args, "answer": d(5)})
    made = F.concat(
        F.lit('{"type":"function","name":'), chat.quoted(F.col("name")), F.when(F.col("id").isNotNull(), F.concat(F.lit(',"id":'), chat.quoted(F.col("id")))).otherwise(""),
        F.lit(',"arguments":'), F.col("args"), F.when(F.col("deps").isNotNull(), F.concat(F.lit(',"depends_on":'), F.to_json("deps"))).otherwise(""), F.lit("}"),
    )
    listed = calls.groupBy("conv_id", "turn").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("j", made.alias("m")))), lambda x: x["m"]), ", ").alias("calls"))
    head = F.concat(F.when(_digit(6, c, t) % 2 == 0, "\n ").otherwise(""), F.lit("{"), F.when(_digit(7, c, t) % 3 == 0, F.lit('"reasoning": {"b": 2, "a": 1}, ')).otherwise(""))
    text = F.concat(head, F.lit('"tool_calls": ['), F.col("calls"), F.lit('], "content": '), chat.quoted(F.col("text")), F.lit("}"))
    spoken = rows.join(listed, ["conv_id", "turn"], "left").select("conv_id", "turn", "role", F.when((F.col("role") == "assistant") & F.col("calls").isNotNull(), text).otherwise(F.col("text")).alias("text"))
    a = F.col("answer")
    to = F.when(a % 11 == 0, "nope").otherwise(F.coalesce("id", F.lit("none")))
    answered = calls.where(a % 5 != 0).select(
        "conv_id", (t + F.when(a % 7 == 1, -1).otherwise(1)).alias("turn"), F.lit("tool").alias("role"),
        F.concat(F.lit('{"content": '), chat.quoted(F.concat(F.lit("result of "), "name")), F.lit(', "tool_call_id": '), chat.quoted(to), F.lit(', "name": "given"}')).alias("text"),
    )
    return spoken.unionByName(answered)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's conversations hold no calls, so each gets some, by hashes, before all are formatted."""
    return chat.format_messages(cut(with_tool_calls(table(spark, sf_dir, "conversations"))))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components_by_fingerprint(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op6_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.manifest(table(spark, sf_dir, "documents"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = secrets.learn(docs)
    return secrets.scan(docs, secrets.fit(secrets.labelled_findings(spark, known), known), known)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", langid.held_out().alias("held_out"), F.col("_lang.lang").alias("lang_pred"), F.col("_lang.score").alias("score"))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.replicate(table(spark, sf_dir, "documents"))
    digest = F.crc32(F.col("text").cast("binary")).alias("text_crc32")
    return found.select("doc_id", "source", F.col("_copy").alias("copy"), F.col("_copies").alias("copies"), F.col("_place").alias("place"), F.length("text").alias("n_chars"), digest)


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", quality.held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def op11_tiled_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 50 == 0, k=5)


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_decontaminate, op2_span_dedup, op3_chat_format, op4_simhash_dedup, op5_epsilon_grid, op6_rendezvous_shards,
    op7_secret_forest, op8_language_id, op9_poisson_mix, op10_rule_ensemble, op11_tiled_whitening, op12_filter_audit, op13_learned_partitions,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_format": oracles.chat(ARGUMENTS)} | oracles.SQL
