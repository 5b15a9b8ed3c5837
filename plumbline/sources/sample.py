"""Domain tables projected from general sales and event tables, so that every operator can run on them.

The projections are plain SQL that Spark and other engines read alike; ``{name}`` stands for a source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LINKS = """
       replied_post_id is not null as is_reply, quoted_post_id is not null as is_quote, retweeted_post_id is not null as is_retweet,
       replied_post_id is null and quoted_post_id is null and retweeted_post_id is null as is_post"""

USERS = """
select 'u' || c_custkey as x_id, c_name as x_username, c_name as display_name, cast(null as string) as avatar_url,
       cast(case when c_custkey % 50 = 0 then 0 else abs(c_acctbal) end as decimal(10,2)) as score, cast('2024-01-01' as timestamp) as created_at
from {customer} where c_custkey % 37 <> 0"""

POSTS = f"""
select *, {LINKS} from (
  select 'o' || o_orderkey as post_id, c_mktsegment as project_keyword, 'u' || o_custkey as user_x_id, 'order ' || o_orderkey as full_text,
         cast(null as string) as retweeted_post_id, cast(null as string) as replied_post_id,
         case when o_orderkey % 5 = 1 then 'o' || (o_orderkey - 1) end as quoted_post_id, 'o' || o_orderkey as root_post_id,
         cast(floor(o_totalprice / 100) as int) as view_count, cast(o_orderkey % 11 as int) as reply_count, cast(o_orderkey % 7 as int) as retweet_count,
         cast(o_orderkey % 3 as int) as quote_count, cast(o_orderkey % 97 as int) as favorite_count,
         case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 101 as decimal(5,2)) end as content_score,
         o_orderdate as post_created_at, o_orderdate as created_at, o_orderdate as updated_at
  from {{orders}} join {{customer}} on o_custkey = c_custkey
  union all
  select 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, c_mktsegment, 'u' || l_suppkey, 'line of ' || l_orderkey,
         cast(null as string), 'o' || l_orderkey, cast(null as string), 'o' || l_orderkey,
         cast(min(l_quantity) as int), 0, 0, 0, cast(l_partkey % 5 as int), cast(null as decimal(5,2)), min(l_shipdate), min(l_shipdate), min(l_shipdate)
  from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{customer}} on o_custkey = c_custkey
  group by l_orderkey, l_linenumber, l_partkey, l_suppkey, c_mktsegment) p"""

_EVENT = """
  select 'e' || event_id as post_id, 'u' || user_id as user_x_id, 'event ' || event_id as full_text,
         case when event_id >= 100 and event_type = 'error' then {target} end as retweeted_post_id,
         case when event_id >= 100 and event_type in ('click', 'view', 'signup') then {target} end as replied_post_id,
         case when event_id >= 100 and event_type = 'purchase' then {target} end as quoted_post_id,
         case when event_id < 100 then 'e' || event_id else {target} end as root_post_id,
         cast(event_id % 1000 as int) as view_count, cast(event_id % 5 as int) as reply_count, cast(event_id % 6 as int) as retweet_count,
         cast(event_id % 4 as int) as quote_count, cast(event_id % 23 as int) as favorite_count, ts as post_created_at, ts as created_at,
         case when event_id % 11 = 0 then null else ts end as updated_at
  from {{events}}""".replace("{target}", "'e' || cast(substring(props, 7, length(props) - 7) as int)").replace("{{", "{").replace("}}", "}")

USER_POSTS = f"select *, {LINKS} from ({_EVENT}) p"

NUCLEUS_POSTS = f"""
select *, {LINKS} from (
  select *, cast(substring(post_id, 2) as bigint) % 3 <> 0 as is_reply_fetched, 'network' as project_keyword from ({_EVENT}) a
  union all
  select post_id, user_x_id, full_text, retweeted_post_id, replied_post_id, quoted_post_id, root_post_id, view_count + 7, reply_count, retweet_count, quote_count,
         favorite_count + 1, post_created_at, created_at + interval '1' day, updated_at + interval '1' day, true, 'network' from ({_EVENT}) b where view_count % 2 = 0) p"""

SQL = {"users": USERS, "posts": POSTS, "user_posts": USER_POSTS, "nucleus_posts": NUCLEUS_POSTS}
TABLES = ("customer", "orders", "lineitem", "events")

#: Lines meet their order's customer. Spark joins as it is written: orders meet customers first, so that lines travel once and not three times.
WRITTEN = "{lineitem} join {orders} on l_orderkey = o_orderkey join {customer} on o_custkey = c_custkey"
NESTED = "{lineitem} join ({orders} join {customer} on o_custkey = c_custkey) on l_orderkey = o_orderkey"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table; only the source columns it uses are read."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in SQL[name]}
    return spark.sql(SQL[name].replace(WRITTEN, NESTED), **used)


def portable(name: str) -> str:
    """The same projection over tables that go by their own names."""
    text = SQL[name]
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text
