"""Chat formatting with linked tool calls, in DataFrame operations only.

A message's text may be a JSON object: an assistant's with ``tool_calls`` (each with id, name, arguments
and, if it needs earlier results, depends_on, a list of ids), or a tool's with ``tool_call_id``. Any other
text is plain content. Calls and results are hash-joined by (conv_id, id). Calls are levelled
topologically: a call stands after the calls it depends on. Arguments are checked against the schemas of
the tools. Each message becomes one line of canonical JSON: keys sorted at every depth, no blanks, no nulls at
the top. What else a message or a call says is kept under its own keys.

Lines, not whole conversations, are the rows, so the longest conversation needs no more memory than a
message; sorting by (conv_id, order_turn, order_level, turn) gives the conversation.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut

#: A tool's parameters: name -> (JSON type, required). Types: string, integer, number, boolean, object, array.
Schema = Mapping[str, tuple[str, bool]]

#: Production schemas. Tools that aren't listed are reported as unknown.
SCHEMAS: dict[str, Schema] = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "calculator": {"expression": ("string", True)},
    "get_weather": {"city": ("string", True), "unit": ("string", False)},
    "run_code": {"language": ("string", True), "source": ("string", True), "timeout": ("number", False)},
}

#: Keys of a line that are made here, and keys of a call.
LINE_KEYS = ("content", "conv_id", "name", "role", "tool_call_id", "tool_calls", "turn")
CALL_KEYS = ("arguments", "depends_on", "faults", "id", "level", "name")


def _json_type(value: Column) -> Column:
    """The JSON type of a variant. Whole numbers of up to 38 digits are integers."""
    kind = F.schema_of_variant(value)
    return (
        F.when((kind == "BIGINT") | kind.rlike("^DECIMAL.[0-9]+,0"), "integer")
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "number")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise("null")
    )


def quoted(text: Column) -> Column:
    """A string as JSON; null stays null."""
    whole = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(whole, F.lit(2), F.length(whole) - 2))


def _object(known: dict[str, Column], others: Column) -> Column:
    """A JSON object with sorted keys from JSON texts by key (nulls are left out) and an array of further (key, json)."""
    made = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("json")) for k, v in known.items()])
    pairs = F.array_sort(F.filter(F.concat(made, others), lambda p: p["json"].isNotNull()))
    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda p: F.concat(quoted(p["key"]), F.lit(":"), p["json"])), ","), F.lit("}"))


def _others(of: Column, but: tuple[str, ...]) -> Column:
    """(key, json) of the entries of a map of variants under keys that aren't in ``but``; variants print with sorted keys."""
    entries = F.filter(F.map_entries(of), lambda e: ~e["key"].isin(*but) & e["value"].isNotNull())
    pairs = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), F.to_json(e["value"]).alias("json")))
    return F.filter(pairs, lambda p: p["json"] != "null")


NONE = "cast(array() as array<struct<key:string,json:string>>)"


def _text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, id, level): 0 for a call that depends on no other, else one more than the deepest it depends on.

    Chains of calls with one dependency each are followed by pointer doubling, so they cost the logarithm of their
    length; what is left are calls with several dependencies, which are peeled off round by round. Calls on a cycle,
    or behind one, are left out. Ids that no call has don't count. A round is one table that is written and one count of
    whether another round is needed, so the driver plans and runs few jobs.
    """
    key = ["conv_id", "id"]
    each = Window.partitionBy(*key)  # dependencies of one call
    ids = calls.select(*key)
    needs = calls.select(*key, F.explode("depends_on").alias("dep")).distinct()
    needs = needs.join(ids.withColumnRenamed("id", "dep"), ["conv_id", "dep"])
    needs = cut(needs.withColumn("n", F.count(F.lit(1)).over(each)))
    single = needs.where("n = 1").select(*key, F.col("dep").alias("to"))
    roots = cut(ids.join(needs, key, "left_anti").withColumn("level", F.lit(0)))

    # every single call: the nearest call on its way that isn't single, and how far it is
    ends = single.select("conv_id", F.col("id").alias("to"), F.lit(True).alias("open"))
    way = single.join(ends, ["conv_id", "to"], "left").select(*key, "to", F.lit(1).alias("far"), F.coalesce("open", F.lit(False)).alias("open"))
    way, seen = _counted(way, open=F.col("open"))
    while seen["open"]:
        onward = way.select("conv_id", F.col("id").alias("to"), F.col("to").alias("_to"), F.col("far").alias("_far"), F.col("open").alias("_open"))
        moved = way.where("open").join(onward, ["conv_id", "to"]).select(*key, F.col("_to").alias("to"), (F.col("far") + F.col("_far")).alias("far"), F.col("_open").alias("open"), F.lit(True).alias("moved"))
        way, seen = _counted(way.where("not open").withColumn("moved", F.lit(False)).union(moved), open=F.col("open"), ended=F.col("moved") & ~F.col("open"))
        way = way.drop("moved")
        if not seen["ended"]:
            break  # the next call before an end would have met it: what is still open runs in a circle
    way = way.where("not open")

    passed = way.select("conv_id", F.col("id").alias("dep"), "to", "far")
    left = needs.where("n > 1").join(passed, ["conv_id", "dep"], "left").select(
        *key, "n", F.coalesce("to", "dep").alias("to"), F.coalesce("far", F.lit(0)).alias("far"), F.lit(None).cast("int").alias("at")
    )
    done, ready = [roots], roots
    while True:
        met = left.join(ready.select("conv_id", F.col("id").alias("to"), F.col("level").alias("_level")), ["conv_id", "to"], "left")
        met = met.select(*key, "n", "to", "far", F.coalesce("at", F.col("_level") + F.col("far")).alias("at"))
        met = met.withColumn("level", F.when(F.count("at").over(each) == F.col("n"), F.max("at").over(each) + 1))
        met, seen = _counted(met, ready=F.col("level").isNotNull())
        if not seen["ready"]:
            break
        ready, left = met.where("level is not null").select(*key, "level").distinct(), met.where("level is null").drop("level")
        done.append(ready)
    known = reduce(DataFrame.union, done)
    behind = way.join(known.select("conv_id", F.col("id").alias("to"), "level"), ["conv_id", "to"]).select(*key, (F.col("level") + F.col("far")).alias("level"))
    return known.union(behind)


def _counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, dict[str, int]]:
    """``df`` as ``cut`` gives it, and in how many rows each condition holds. (An Observation would save the query, but a session
    that has made one can't be sent to tasks, and Spark's forests do that.)"""
    out = cut(df)
    return out, out.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()]).first().asDict()


def _listed(spark, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A small table of literals."""
    made = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*made))))


def _faults(calls: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """(conv_id, id, faults): what is wrong with a call's arguments, sorted; calls without a fault are left out."""
    spark = calls.sparkSession
    flat = [(tool, name, kind, need) for tool, params in schemas.items() for name, (kind, need) in params.items()]
    rules = _listed(spark, flat or [("", "", "", False)], ("name", "param", "type", "required"))  # as long as the schemas
    tools = _listed(spark, [(t,) for t in schemas] or [("",)], ("name",))
    args = calls.withColumn("v", F.try_parse_json("arguments"))
    whole = _json_type(F.col("v")) == "object"
    bad = args.where(~F.coalesce(whole, F.lit(False))).select("conv_id", "id", F.lit("arguments: not an object").alias("fault"))
    unknown = args.join(tools, "name", "left_anti").select("conv_id", "id", F.concat(F.lit("unknown tool "), F.coalesce("name", F.lit("null"))).alias("fault"))
    known = args.where(whole).join(tools, "name", "left_semi")
    given = known.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
        "conv_id", "id", "name", F.col("key").alias("param"), _json_type(F.col("value")).alias("got")
    )
    ruled = given.join(rules, ["name", "param"], "left")
    fits = (F.col("type") == F.col("got")) | ((F.col("type") == "number") & (F.col("got") == "integer"))
    wrong = ruled.where(F.col("type").isNull() | ~fits).select(
        "conv_id", "id", F.concat("param", F.when(F.col("type").isNull(), F.lit(": not in the schema")).otherwise(F.concat(F.lit(": not of type "), "type"))).alias("fault")
    )
    must = known.select("conv_id", "id", "name").join(rules.where("required"), "name")
    missing = must.join(given.select("conv_id", "id", "param"), ["conv_id", "id", "param"], "left_anti").select(
        "conv_id", "id", F.concat("param", F.lit(": missing")).alias("fault")
    )
    every = bad.unionByName(unknown).unionByName(wrong).unionByName(missing)
    return every.groupBy("conv_id", "id").agg(F.array_sort(F.collect_set("fault")).alias("faults"))


def format_messages(messages: DataFrame, schemas: Mapping[str, Schema] = SCHEMAS) -> DataFrame:
    """One row of each row of ``messages`` (conv_id, turn, role, text): conv_id, turn, role, n_calls, n_answered
    (calls that have a result), n_invalid (calls with a fault), linked (of a tool's result: its call was found;
    else null), order_turn, order_level and line.

    A result goes after its call even where its turn is earlier. Of several calls with one id in a conversation the
    first (turn, then place) is the one that is linked; the others stay in their lines with a fault. A call on a cycle
    has level -1 and a fault. Messages without conv_id are formatted but not linked; null turns, roles and texts are
    left out of the line. Malformed JSON, and objects that name a key twice, are plain content. Arguments may be an
    object or its JSON text. Numbers of over 38 digits are read as doubles. Of a message's keys those that are made
    here (conv_id, role, turn, and name where its call is known) give way; others stay. Repeated rows give equal
    lines. Empty table: empty result. Other columns are not read.
    """
    messages = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    parsed = F.when(F.col("text").rlike(r"^\s*\{"), F.try_parse_json("text"))
    rows = messages.withColumn("_v", parsed).withColumn("_mark", F.xxhash64("conv_id", "turn", "role", "text"))
    called = F.when(F.col("role") == "assistant", F.try_variant_get("_v", "$.tool_calls", "array<map<string,variant>>"))
    answers = F.when(F.col("role") == "tool", F.try_variant_get("_v", "$.tool_call_id", "string"))
    own = F.try_variant_get("_v", "$", "map<string,variant>")
    extra = F.when(called.isNotNull() | answers.isNotNull(), F.coalesce(_others(own, tuple(k for k in LINE_KEYS if k not in ("content", "name"))), F.expr(NONE)))
    no_deps = F.array().cast("array<string>")

    def call(c: Column) -> Column:
        given = c["arguments"]
        text = F.when(F.schema_of_variant(given) == "STRING", _text_of(given)).otherwise(F.to_json(given))
        deps = F.coalesce(F.try_variant_get(c["depends_on"], "$", "array<string>"), no_deps)
        return F.struct(_text_of(c["id"]).alias("id"), _text_of(c["name"]).alias("name"), text.alias("arguments"), deps.alias("depends_on"), F.coalesce(_others(c, CALL_KEYS), F.expr(NONE)).alias("extra"))

    rows = rows.select("conv_id", "turn", "role", "text", "_mark", extra.alias("_extra"), F.transform(called, call).alias("_called"), answers.alias("_answers"))
    special = cut(rows.where("conv_id is not null and _extra is not null").select("conv_id", "turn", "_mark", "_called", "_answers"))
    listed = special.select("conv_id", "turn", "_mark", F.posexplode("_called").alias("place", "c")).select("conv_id", "turn", "_mark", "place", "c.*").distinct()
    order = Window.partitionBy("conv_id", "id").orderBy("turn", "place", "_mark")
    listed = cut(listed.withColumn("_nth", F.when(F.col("id").isNotNull(), F.row_number().over(order)).otherwise(0)))
    calls = listed.where("_nth = 1")
    results = special.where("_answers is not null").select("conv_id", F.col("_answers").alias("id"), "_mark").distinct()

    answered = results.select("conv_id", "id").distinct().withColumn("answered", F.lit(True))
    full = (
        listed.join(_levels(calls).withColumn("_nth", F.lit(1)), ["conv_id", "id", "_nth"], "left")
        .join(answered.withColumn("_nth", F.lit(1)), ["conv_id", "id", "_nth"], "left")
        .join(_faults(calls, schemas).withColumn("_nth", F.lit(1)), ["conv_id", "id", "_nth"], "left")
    )
    own = F.when(F.col("_nth") == 0, F.lit("id: missing")).when(F.col("_nth") > 1, F.lit("id: used before")).when(F.col("level").isNull(), F.lit("depends_on: cycle"))
    faults = F.concat(F.coalesce("faults", F.array().cast("array<string>")), F.when(own.isNotNull(), F.array(own)).otherwise(F.array().cast("array<string>")))
    full = cut(full.withColumn("faults", faults).withColumn("level", F.coalesce("level", F.lit(-1))).withColumn("answered", F.coalesce("answered", F.lit(False))))
    args = F.coalesce(F.to_json(F.try_parse_json("arguments")), F.when(F.col("arguments").isNotNull(), F.to_json(F.struct(F.col("arguments").alias("text")))))
    known = {
        "arguments": args, "depends_on": F.to_json(F.array_sort("depends_on")), "faults": F.to_json(F.array_sort("faults")), "id": quoted(F.col("id")),
        "level": F.col("level").cast("string"), "name": quoted(F.col("name")),
    }
    # calls of one message, so the list is as long as its text
    item = F.struct("level", "place", _object(known, F.col("extra")).alias("call"), "answered", (F.size("faults") > 0).alias("invalid"))
    by_message = full.groupBy("conv_id", "_mark").agg(F.array_sort(F.collect_list(item)).alias("_calls"), F.max("level").alias("_level"))

    where_call = full.where("_nth = 1").select("conv_id", "id", F.col("turn").alias("_call_turn"), F.col("name").alias("_name"), F.col("level").alias("_call_level"))
    linked = results.join(where_call, ["conv_id", "id"], "left").select(
        "conv_id", "_mark", F.struct("_call_turn", "_name", "_call_level").alias("_to")
    )
    out = rows.join(by_message, ["conv_id", "_mark"], "left").join(linked, ["conv_id", "_mark"], "left")
    is_call, is_result = F.col("_calls").isNotNull(), F.col("_to").isNotNull()
    special_ = is_call | is_result
    others = F.when(special_, F.col("_extra")).otherwise(F.expr(NONE))
    others = F.filter(others, lambda p: (p["key"] != "name") | F.col("_to._name").isNull())
    made = {
        "content": F.when(~special_, quoted(F.col("text"))), "conv_id": F.col("conv_id").cast("string"), "name": quoted(F.col("_to._name")), "role": quoted(F.col("role")),
        "tool_call_id": F.when(is_result, quoted(F.col("_answers"))), "turn": F.col("turn").cast("string"),
        "tool_calls": F.when(is_call, F.concat(F.lit("["), F.array_join(F.transform("_calls", lambda c: c["call"]), ","), F.lit("]"))),
    }
    n = F.coalesce(F.size("_calls"), F.lit(0))
    return out.select(
        "conv_id", "turn", "role",
        F.when(is_call, n).otherwise(0).alias("n_calls"),
        F.when(is_call, F.size(F.filter("_calls", lambda c: c["answered"]))).otherwise(0).alias("n_answered"),
        F.when(is_call, F.size(F.filter("_calls", lambda c: c["invalid"]))).otherwise(0).alias("n_invalid"),
        F.when(is_result, F.col("_to._call_turn").isNotNull()).alias("linked"),
        F.when(is_result, F.greatest("turn", F.col("_to._call_turn"))).otherwise(F.col("turn")).alias("order_turn"),
        F.when(is_result, F.coalesce(F.col("_to._call_level"), F.lit(0)) + 1).otherwise(0).alias("order_level"),
        _object(made, others).alias("line"),
    )
