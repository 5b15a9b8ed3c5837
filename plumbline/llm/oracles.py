"""Plain SQL for the queries that it can express on whole tables."""

from __future__ import annotations

import json

#: CRC-32 of UTF-8 bytes, byte by byte over its table of 256 remainders.
CRC = """
crc_rows(n, c, k) as (
  select i, i, 0 from range(256) t(i)
  union all select n, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from crc_rows where k < 8),
crc as (select list(c order by n) as t from crc_rows where k = 8),
texts as (
  select doc_id, text, source, case when text is not null then coalesce(xor(list_reduce(list_transform(range(strlen(text)), lambda i: cast('0x' || substr(hx, 2 * i + 1, 2) as bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295), 0) end as text_crc32
  from (select doc_id, text, source, hex(encode(text)) as hx from documents) cross join crc)"""


def unit(text: str) -> str:
    return f"((cast('0x' || substr(md5({text}), 1, 12) as bigint) + 0.5e0) / 281474976710656.0e0)"


def best(shards: int) -> str:
    return f"""(select doc_id, arg_max(s, u) as shard from (select doc_id, s, {unit("'shard:' || coalesce(cast(doc_id as varchar), '') || ':' || s")} as u
      from (select distinct doc_id from documents) cross join range({shards}) r(s)) group by 1)"""


def chat(arguments: dict[str, list[tuple[str, list[str]]]]) -> str:
    """Lines of conversations with calls. What the calls are follows from hashes of conv_id and turn; levels by walking
    all ways back, where one as long as the conversation has calls runs in a circle."""

    def digit(at: int, *parts: str) -> str:
        return f"cast('0x' || substr(md5({" || ':' || ".join(parts)}), {2 * at + 1}, 2) as int)"

    def canonical(shape: str) -> str:
        text = json.dumps(json.loads(shape.format(q='"{q}"')), sort_keys=True, separators=(",", ":"))
        return "'" + text.replace('"{q}"', "' || q || '") + "'"

    d = lambda at: digit(at, "conv_id", "turn", "j")
    names = list(arguments)
    shapes = " ".join(f"when name = '{n}' and shape = {k} then {canonical(s)}" for n in names for k, (s, _) in enumerate(arguments[n]))
    faults = " ".join(f"when name = '{n}' and shape = {k} then {sorted(f)}::varchar[]" for n in names for k, (_, f) in enumerate(arguments[n]))
    return f"""
      with recursive asking as (
        select *, case when {digit(0, "conv_id", "turn")} % 8 = 0 then 0 else {digit(0, "conv_id", "turn")} % 2 + 1 end as n from conversations where role = 'assistant'),
      drawn as (select *, {digit(7, "conv_id", "turn")} % 3 = 0 as thinks, to_json(substr(text, 1, 9)) as q from (select *, unnest(range(n)) as j from asking where n > 0)),
      calls as (
        select conv_id, turn, text, thinks, q, j, {names}[{d(1)} % {len(names)} + 1] as name, {d(4)} % 4 as shape, {d(5)} as answer,
               case when {d(2)} % 13 = 0 then 'shared' when {d(2)} % 13 = 1 then null else 'c' || turn || '-' || j end as id,
               case when {d(3)} % 6 = 3 then ['c' || (turn + 2) || '-0'] when {d(3)} % 6 = 4 then list_sort(['c' || (turn - 2) || '-0', 'c' || (turn - 4) || '-0'])
                    when {d(3)} % 6 in (1, 2) then ['c' || (turn - 2) || '-0'] when {d(3)} % 6 = 5 and j = 1 then ['c' || turn || '-0'] else []::varchar[] end as deps
        from drawn),
      numbered as (select *, case when id is null then 0 else row_number() over (partition by conv_id, id order by turn, j) end as nth, count(*) over (partition by conv_id) as many from calls),
      edges as (select x.conv_id, x.id, x.dep from (select distinct conv_id, id, unnest(deps) as dep from numbered where nth = 1) x join numbered y on y.conv_id = x.conv_id and y.id = x.dep and y.nth = 1),
      walk(conv_id, id, here, far) as (
        select conv_id, id, id, 0 from numbered where nth = 1
        union select w.conv_id, w.id, e.dep, w.far + 1 from walk w join edges e on e.conv_id = w.conv_id and e.id = w.here join (select distinct conv_id, many from numbered) m on m.conv_id = w.conv_id where w.far <= m.many),
      depths as (select conv_id, id, max(far) as far from walk group by 1, 2),
      results as (
        select conv_id, turn + case when answer % 7 = 1 then -1 else 1 end as turn, case when answer % 11 = 0 then 'nope' else coalesce(id, 'none') end as id, 'result of ' || name as content
        from calls where answer % 5 <> 0),
      judged as (
        select n.*, case when nth = 1 and far < many then far else -1 end as level,
               case when nth = 0 then ['id: missing'] when nth > 1 then ['id: used before'] else list_sort(list_concat(case {faults} end, case when far >= many then ['depends_on: cycle'] else []::varchar[] end)) end as faults,
               nth = 1 and exists (select 1 from results r where r.conv_id = n.conv_id and r.id = n.id) as answered, case {shapes} end as args
        from numbered n left join depths d on d.conv_id = n.conv_id and d.id = n.id and n.nth = 1),
      said as (
        select conv_id, turn, any_value(text) as text, any_value(thinks) as thinks, count(*) as n_calls, count(case when answered then 1 end) as n_answered, count(case when len(faults) > 0 then 1 end) as n_invalid,
               string_agg('{{"arguments":' || args || ',"depends_on":' || to_json(deps) || ',"faults":' || to_json(faults) || case when id is null then '' else ',"id":' || to_json(id) end
                 || ',"level":' || level || ',"name":' || to_json(name) || ',"type":"function"}}', ',' order by level, j) as calls from judged group by 1, 2)
      select c.conv_id, c.turn, c.role, cast(coalesce(n_calls, 0) as int) as n_calls, cast(coalesce(n_answered, 0) as int) as n_answered, cast(coalesce(n_invalid, 0) as int) as n_invalid,
             cast(null as boolean) as linked, c.turn as order_turn, 0 as order_level,
             '{{"content":' || to_json(c.text) || ',"conv_id":' || c.conv_id || case when s.thinks then ',"reasoning":{{"a":1,"b":2}}' else '' end || ',"role":' || to_json(c.role)
               || case when s.calls is null then '' else ',"tool_calls":[' || s.calls || ']' end || ',"turn":' || c.turn || '}}' as line
      from conversations c left join said s on s.conv_id = c.conv_id and s.turn = c.turn and c.role = 'assistant'
      union all
      select r.conv_id, r.turn, 'tool', 0, 0, 0, j.id is not null, greatest(r.turn, j.turn), cast(coalesce(j.level, 0) + 1 as int),
             '{{"content":' || to_json(r.content) || ',"conv_id":' || r.conv_id || ',"name":' || to_json(coalesce(j.name, 'given')) || ',"role":"tool","tool_call_id":' || to_json(r.id) || ',"turn":' || r.turn || '}}'
      from results r left join judged j on j.conv_id = r.conv_id and j.id = r.id and j.nth = 1"""


def audit() -> str:
    """Every order and step of the five filters, each counted from the documents' sets of failures."""
    texts = "select doc_id, coalesce(text, '') as text, coalesce(lang, '') as part from documents"
    words = "list_filter(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')"
    passes = " and ".join(f"(step <= {k} or not contains(fails, substr(filter_order, {k}, 1)))" for k in range(1, 5))
    return f"""
      with recursive texts as ({texts}),
      firsts as (select text, min(doc_id) as least from texts group by 1),
      known as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by 1),
      judged as (
        select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
               case when len(words) < 200 then 'A' else '' end || case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end
               || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) then 'C' else '' end
               || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end || case when doc_id > least then 'E' else '' end as fails
        from (select t.*, least, {words} as words from texts t join firsts f using (text)) left join known using (doc_id)),
      cells as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from judged group by 1, 2),
      orders(filter_order) as (select '' union all select filter_order || l from orders join (select unnest(['A', 'B', 'C', 'D', 'E']) as l) on not contains(filter_order, l)),
      steps as (select filter_order, s as step, substr(filter_order, s, 1) as f from orders, range(1, 6) r(s) where length(filter_order) = 5),
      removals as (
        select part, filter_order, cast(step as int) as step, f, sum(n) as total, sum(case when contains(fails, f) then n else 0 end) as failing, sum(case when fails = f then n else 0 end) as alone,
               sum(case when contains(fails, f) and {passes} then n else 0 end) as removed, sum(case when contains(fails, f) and {passes} then good else 0 end) as good_lost,
               sum(case when contains(fails, f) and {passes} then toxic else 0 end) as toxic_lost from cells cross join steps group by 1, 2, 3, 4)
      select part, filter_order, step, cast(total - sum(removed) over (partition by part, filter_order order by step) as bigint) as kept, cast(removed as bigint) as removed,
             cast(failing - removed as bigint) as redundant, cast(alone as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
             cast(sum(removed) over (partition by part, f) as bigint) as shapley from removals"""


SQL = {
    "op12_filter_audit": audit(),
    "op5_epsilon_grid": """
      with recursive good as (
        select vec_id, label, cast(embedding as double[]) as e from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
      links as (select x.vec_id as a, y.vec_id as b from good x join good y on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e) and list_cosine_similarity(x.e, y.e) >= 0.98),
      reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on l.a = r.b)
      select vec_id, n_links, component_id, vec_id = component_id as kept from (
        select vec_id, (select count(*) from links where a = vec_id) as n_links, (select min(b) from reach where a = vec_id) as component_id from embeddings)""",
    "op6_rendezvous_shards": f"""
      with recursive {CRC}
      select doc_id, size, text_crc32, 'key' as law, cast(shard as int) as shard, row_number() over (partition by shard order by mark, doc_id, text_crc32 nulls first, size) - 1 as slot, cast(grown as int) as grown_shard
      from (select t.doc_id, coalesce(strlen(text), 0) + 8 as size, text_crc32, b.shard, g.shard as grown, md5(coalesce(cast(t.doc_id as varchar), '')) as mark
            from texts t join {best(24)} b on b.doc_id is not distinct from t.doc_id join {best(25)} g on g.doc_id is not distinct from t.doc_id)""",
    "op9_poisson_mix": f"""
      with recursive {CRC},
      sizes as (select source, count(*) as n from documents group by 1),
      rates as (select source, 1.0e0 / (select count(*) from sizes) * (select count(*) from documents) / n as rate from sizes),
      laws as (select source, greatest(1, cast(ceil(rate / 32.0e0) as int)) as parts, rate / greatest(1, cast(ceil(rate / 32.0e0) as int)) as mean from rates),
      cdf(source, mean, k, p, c) as (
        select source, mean, 0, exp(-mean), exp(-mean) from laws
        union all select source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) from cdf where k < ceil(mean + 12 * sqrt(mean) + 20)),
      lists as (select source, list(c order by k) as cs from cdf group by 1),
      drawn as (
        select doc_id, source, text, text_crc32, cast(sum(len(list_filter(cs, lambda c: c < u))) as int) as copies from (
          select row, doc_id, t.source, text, text_crc32, cs, {unit("'mix:' || coalesce(cast(doc_id as varchar), '') || ':' || j")} as u
          from (select *, row_number() over () as row from texts) t join laws l on l.source is not distinct from t.source join lists s on s.source is not distinct from t.source
          cross join lateral (select unnest(range(1, l.parts + 1)) as j))
        group by row, doc_id, source, text, text_crc32)
      select doc_id, source, cast(copy as int) as copy, copies, {unit("'mix-place:' || coalesce(cast(doc_id as varchar), '') || ':' || copy")} as place, length(text) as n_chars, text_crc32
      from (select *, unnest(range(1, copies + 1)) as copy from drawn)""",
}
