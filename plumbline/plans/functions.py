"""The read-backs as SQL table functions over the views of ``catalog``, which call one another.

Ranges are inclusive and in epoch seconds (session time zone UTC, as everywhere), a null bound is open. Lists that are null
or empty don't restrict. With constant arguments Spark puts these into the body, so filters reach the scans of the views.
"""

from __future__ import annotations

from plumbline.functions.flags import FLAGS, HIGH_IMPRESSIONS, HIGH_IMPRESSIONS_STRONG, HIGH_LIKES, LOW_IMPRESSIONS, LOW_LIKES, MIN_REPLIES, STRONG_AUTHOR
from plumbline.operators.leaderboard import DEFAULT_CAP, DEFAULT_CONTENT, DEFAULT_PERIOD, DEFAULT_SCORE, ROWS
from plumbline.operators.metrics import EARLY, MIN_FLAGS, MIN_POSTS, SLOPE, SPIKE, VARIABILITY

RANGE = "start_ts bigint, end_ts bigint"
PROJECT = f"{RANGE}, project string"


FUNCTIONS: dict[str, str] = {}
BODIES: dict[str, str] = {}


def define(name: str, parameters: str, body: str) -> None:
    BODIES[name] = body
    FUNCTIONS[name] = f"create or replace temporary function {name}({parameters}) returns table return {body}"


def inlined(name: str) -> str:
    """The body of a function with the same parameters. Spark takes arguments that aren't constants on the inner side of outer
    joins only so, and a function's own parameters aren't constants in its body."""
    return f"({BODIES[name]})"


def instant(epoch: str) -> str:
    return f"cast(timestamp_seconds({epoch}) as timestamp_ntz)"


def inside(when: str) -> str:
    return f"(start_ts is null or {when} >= {instant('start_ts')}) and (end_ts is null or {when} <= {instant('end_ts')})"


def rn(x: str, digits: int) -> str:
    """Half-up rounding by the same operations as ``functions.numeric.round_n``."""
    scale = f"1{'0' * digits}.0D"
    return f"(cast(floor(cast({x} as double) * {scale} + 0.5D) as double) / {scale})"


def div(top: str, bottom: str, digits: int) -> str:
    return f"case when cast({bottom} as double) <> 0 then {rn(f'cast({top} as double) / cast({bottom} as double)', digits)} end"


def esum(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(18,2))) as double)"


def mean6(x: str) -> str:
    return f"(cast(sum(floor(({x}) * 1000000.0D + 0.5D)) as double) / cast(count({x}) as double) / 1000000.0D)"


def listed(ids: str, x: str) -> str:
    return f"(coalesce(cardinality({ids}), 0) = 0 or array_contains({ids}, {x}))"


def flags(replies: str, author: str) -> str:
    tests = [
        f"{replies} >= {MIN_REPLIES} and like_reply_ratio < {LOW_LIKES}D", f"{replies} >= {MIN_REPLIES} and like_reply_ratio > {HIGH_LIKES}",
        f"impression_to_unique_reach_ratio < {LOW_IMPRESSIONS}",
        f"impression_to_unique_reach_ratio > case when {author} > {STRONG_AUTHOR} then {HIGH_IMPRESSIONS_STRONG} else {HIGH_IMPRESSIONS} end",
    ]
    return ", ".join(f"coalesce({t}, false) as {f}" for t, f in zip(tests, FLAGS, strict=True))


OWN = "(is_post or (is_quote and not is_reply))"
NAMED = "root_post_id, root_user_id, root_username"
CLUSTERED = "root_post_id, root_user_id, root_username, root_tweet_created_at, total_engagements, burst_concentration, duration_days_p90, cross_post_overlap, coordinated_burst, farming_score"

# ---- features ----------------------------------------------------------------------------------

define("engagement_clustering", PROJECT, f"select {CLUSTERED} from features where project_keyword = project and {inside('root_tweet_created_at')}")
define(
    "user_post_engagement_clustering", "target_user string default null, start_ts bigint default null, end_ts bigint default null",
    f"select {CLUSTERED} from user_features where (target_user is null or root_user_id = target_user) and {inside('root_tweet_created_at')}",
)

# ---- what the metrics share --------------------------------------------------------------------


def first_contributions(scores: str, where: str) -> str:
    return f"""select original_post_id as post_id, replier_x_id, min_by(contribution_score, struct(post_created_at, reply_post_id)) as contribution_score
      from {scores} where replier_x_id <> original_author_x_id and {where} group by 1, 2"""


def smart_reach(scores: str, where: str) -> str:
    return f"select post_id, {esum('contribution_score')} as smart_reach from ({first_contributions(scores, where)}) group by post_id"


define("project_smart_reach", PROJECT, smart_reach("contribution_scores", f"project_keyword = project and {inside('post_created_at')}"))
define("network_smart_reach", RANGE, smart_reach("global_contribution_scores", inside("post_created_at")))
define(
    "project_engagers", f"{PROJECT}, replies_only boolean",
    f"""select {NAMED}, engaged_user_id, max(engaged_user_score) as score, max(root_favorite_count) as likes, sum(case when is_engaged_reply then 1 else 0 end) as replies
    from engagement where project_keyword = project and {inside('engaged_tweet_created_at')} and {inside('root_tweet_created_at')} and not is_root_reply
      and root_user_id <> engaged_user_id and (is_engaged_reply or not replies_only) group by {NAMED}, engaged_user_id""",
)


def per_post(pairs: str, extra: str = "") -> str:
    return f"""select root_post_id as post_id, root_user_id as handle, root_username as username, count(*) as unique_engagers, {esum('score')} as post_unique_reach,
      cast(max(likes) as int) as total_likes, sum(replies) as total_replies{extra} from {pairs} group by {NAMED}"""


def ratios(source: str) -> str:
    """``source`` has what ``per_post`` gives and view_count."""
    return f"""select *, cast(view_count as bigint) as total_impressions, {div('view_count', 'post_unique_reach', 2)} as impression_to_unique_reach_ratio,
      {div('post_unique_reach', 'view_count', 4)} as reach_to_impression_ratio, {div('total_likes', 'total_replies', 2)} as like_reply_ratio,
      {div('post_unique_reach', 'unique_engagers', 2)} as unique_engager_scores_to_count_ratio from ({source})"""


POST_COLUMNS = """post_id, handle, username, post_unique_reach, total_impressions, total_likes, total_replies, unique_engagers, smart_reach,
  like_reply_ratio, impression_to_unique_reach_ratio, unique_engager_scores_to_count_ratio"""
RATIO_COLUMNS = """post_id, handle, username, post_unique_reach, total_impressions, reach_to_impression_ratio, total_likes, total_replies,
  like_reply_ratio, unique_engagers, unique_engager_scores_to_count_ratio"""


def flagged(source: str, reach: str) -> str:
    return f"""select {POST_COLUMNS}, {flags('total_replies', 'author_score')} from (
      select r.*, s.smart_reach, cast(u.score as double) as author_score from ({ratios(source)}) r left join {reach} s on s.post_id = r.post_id left join users u on u.x_id = r.handle)"""


# ---- project metrics ---------------------------------------------------------------------------

define(
    "project_posts_reached", f"{PROJECT}, replies_only boolean",
    f"""select m.*, v.view_count from ({per_post('project_engagers(start_ts, end_ts, project, replies_only)')}) m
    join (select post_id, view_count from posts where project_keyword = project) v on v.post_id = m.post_id""",
)
define("post_level_metrics", PROJECT, flagged("select * from project_posts_reached(start_ts, end_ts, project, true)", "project_smart_reach(start_ts, end_ts, project)"))
define(
    "single_post_smart_reach", "target_post string, project string, start_ts bigint default null, end_ts bigint default null",
    f"""select post_id, handle, username, post_unique_reach, smart_reach, like_reply_ratio, impression_to_unique_reach_ratio, unique_engager_scores_to_count_ratio, {', '.join(FLAGS)}
    from post_level_metrics(start_ts, end_ts, project) where post_id = target_post""",
)
define("post_engagement_ratios", PROJECT, f"select {RATIO_COLUMNS} from ({ratios('select * from project_posts_reached(start_ts, end_ts, project, false)')})")
define(
    "account_reach", RANGE,
    f"""select root_user_id, {esum('score')} as account_unique_reach from (
      select p.user_x_id as root_user_id, e.user_x_id, max(cast(u.score as double)) as score
      from (select post_id, user_x_id from user_posts where {OWN} and {inside('post_created_at')}) p
      join (select replied_post_id, user_x_id from user_posts where {inside('post_created_at')}) e on e.replied_post_id = p.post_id
      join users u on u.x_id = e.user_x_id where e.user_x_id <> p.user_x_id group by 1, 2) group by 1""",
)
define(
    "keyword_reach", f"{PROJECT}, replies_only boolean",
    f"""select root_user_id, root_username, coalesce({esum('score')}, 0D) as keyword_unique_reach from (
      select root_user_id, root_username, engaged_user_id, max(score) as score from project_engagers(start_ts, end_ts, project, replies_only) group by 1, 2, 3) group by 1, 2""",
)
define(
    "account_level_metrics", PROJECT,
    f"""select *, {div('account_unique_reach', 'keyword_unique_reach', 2)} as account_keyword_unique_reach_ratio from (
      select k.root_user_id as handle, k.root_username as username, cast(u.score as double) as score, coalesce(c.post_count, 0) as post_count, coalesce(c.smart_reach, 0D) as smart_reach,
        {rn('coalesce(c.smart_reach, 0D) + coalesce(c.post_count, 0) * coalesce(cast(u.score as double), 0D)', 3)} as influence_score, k.keyword_unique_reach,
        coalesce(a.account_unique_reach, 0D) as account_unique_reach
      from keyword_reach(start_ts, end_ts, project, true) k left join account_reach(start_ts, end_ts) a on a.root_user_id = k.root_user_id
      left join (select v.handle, count(*) as post_count, coalesce({esum('s.smart_reach')}, 0D) as smart_reach
                 from (select distinct post_id, handle from project_posts_reached(start_ts, end_ts, project, true)) v
                 left join project_smart_reach(start_ts, end_ts, project) s on s.post_id = v.post_id group by v.handle) c on c.handle = k.root_user_id
      left join users u on u.x_id = k.root_user_id)""",
)
define(
    "account_keyword_unique_reach_ratio", PROJECT,
    f"""select *, {div('account_unique_reach', 'keyword_unique_reach', 2)} as account_keyword_unique_reach_ratio from (
      select k.root_user_id as handle, k.root_username as username, k.keyword_unique_reach, coalesce(a.account_unique_reach, 0D) as account_unique_reach
      from keyword_reach(start_ts, end_ts, project, false) k left join account_reach(start_ts, end_ts) a on a.root_user_id = k.root_user_id)""",
)

# ---- growth ------------------------------------------------------------------------------------

GROWN = "handle, username, root_post_id, root_tweet_created_at, post_sequence_number"


def growth(posts: str, pairs: str) -> str:
    """posts: a query with the columns of posts; pairs: (root_post_id, engaged_user_id, score)."""
    return f"""select *, sum(new_audience_count) over so_far as cumulative_new_audience_count,
        cast(sum(cast(expansion_unique_reach as decimal(18,2))) over so_far as double) as cumulative_expansion_unique_reach from (
      select {GROWN}, count(engaged_user_id) as total_engagements, {esum('score')} as post_unique_reach, {esum('case when fresh then score else 0D end')} as expansion_unique_reach,
        count(case when fresh then 1 end) as new_audience_count from (
        select r.*, p.engaged_user_id, p.score,
          p.engaged_user_id is not null and r.post_sequence_number = min(r.post_sequence_number) over (partition by r.handle, p.engaged_user_id) as fresh
        from (select o.user_x_id as handle, u.x_username as username, o.post_id as root_post_id, o.post_created_at as root_tweet_created_at,
                cast(row_number() over (partition by o.user_x_id order by o.post_created_at, o.post_id) as bigint) as post_sequence_number
              from ({posts}) o left join users u on u.x_id = o.user_x_id) r
        left join ({pairs}) p on p.root_post_id = r.root_post_id) group by {GROWN})
      window so_far as (partition by handle order by post_sequence_number)"""


def growth_flags(source: str) -> str:
    names = ("esr_flag", "gs_flag", "gv_flag", "msr_flag")
    tests = (f"early_spike_ratio > {EARLY}D", f"growth_slope < {SLOPE}D * avg_expansion", f"growth_variability > {VARIABILITY} * avg_expansion", f"max_spike_ratio > {SPIKE}")
    return f"""select *, case when farming_score >= {MIN_FLAGS} then 'potential_engagement_farming' else 'organic' end as farming_flag from (
      select *, {' + '.join(names)} as farming_score from (
        select *, {', '.join(f'case when {t} then 1 else 0 end as {n}' for t, n in zip(tests, names, strict=True))} from (
          select handle, username, total_posts, final_cumulative_reach, early / nullif(final_cumulative_reach, 0D) as early_spike_ratio, growth_slope, avg_expansion, growth_variability,
            top / nullif(avg_expansion, 0D) as max_spike_ratio from (
            select handle, username, count(*) as total_posts, max(cumulative_expansion_unique_reach) as final_cumulative_reach,
              {esum('case when post_sequence_number <= 2 then expansion_unique_reach else 0D end')} as early, regr_slope(cumulative_expansion_unique_reach, post_sequence_number) as growth_slope,
              {esum('expansion_unique_reach')} / count(expansion_unique_reach) as avg_expansion, stddev_samp(expansion_unique_reach) as growth_variability, max(expansion_unique_reach) as top
            from {source} group by handle, username having count(*) >= {MIN_POSTS}))))"""


define(
    "unique_reach_increase", PROJECT,
    growth(
        f"select * from posts where project_keyword = project and user_x_id <> '' and {OWN} and {inside('post_created_at')}",
        f"""select root_post_id, engaged_user_id, max(engaged_user_score) as score from engagement where project_keyword = project and is_engaged_reply
          and {inside('engaged_tweet_created_at')} and engaged_user_id <> root_user_id group by 1, 2""",
    ),
)
define(
    "global_unique_reach_increase", RANGE,
    growth(
        f"select * from user_posts where {OWN} and {inside('post_created_at')}",
        f"""select e.replied_post_id as root_post_id, e.user_x_id as engaged_user_id, max(cast(s.score as double)) as score
          from (select replied_post_id, user_x_id from user_posts where replied_post_id is not null and {inside('post_created_at')}) e
          join (select post_id, user_x_id from user_posts where {OWN} and {inside('post_created_at')}) p on p.post_id = e.replied_post_id
          left join users s on s.x_id = e.user_x_id where e.user_x_id <> p.user_x_id group by 1, 2""",
    ),
)
define("unique_reach_increase_flags", PROJECT, growth_flags(inlined("unique_reach_increase")))
define("global_unique_reach_increase_flags", RANGE, growth_flags(inlined("global_unique_reach_increase")))

# ---- the whole network -------------------------------------------------------------------------

define(
    "thread_engagers", RANGE,
    f"""select p.post_id as root_post_id, p.user_x_id as root_user_id, r.x_username as root_username, e.user_x_id as engaged_user_id, max(cast(u.score as double)) as score,
      min_by(e.favorite_count, struct(e.post_created_at, e.post_id)) as likes, count(*) as replies, max(p.view_count) as view_count
    from (select * from user_posts where is_reply and not is_retweet and not is_quote and {inside('post_created_at')}) e
    join (select * from user_posts where is_post and not is_retweet and not is_quote and {inside('post_created_at')}) p on p.post_id = e.root_post_id
    join users r on r.x_id = p.user_x_id join users u on u.x_id = e.user_x_id where p.user_x_id <> e.user_x_id group by 1, 2, 3, 4""",
)
define("global_post_level_metrics", RANGE, flagged(per_post("thread_engagers(start_ts, end_ts)", ", max(view_count) as view_count"), "network_smart_reach(start_ts, end_ts)"))
define(
    "global_account_level_metrics", RANGE,
    f"""select r.handle, u.x_username as username, cast(u.score as double) as score, c.post_count, c.smart_reach,
      {rn('c.smart_reach + c.post_count * coalesce(cast(u.score as double), 0D)', 3)} as influence_score, r.account_unique_reach
    from (select root_user_id as handle, {esum('score')} as account_unique_reach from (
            select root_user_id, engaged_user_id, max(score) as score from thread_engagers(start_ts, end_ts) group by 1, 2) group by 1) r
    join (select v.root_user_id as handle, count(*) as post_count, coalesce({esum('s.smart_reach')}, 0D) as smart_reach
          from (select distinct root_user_id, root_post_id from thread_engagers(start_ts, end_ts)) v
          left join network_smart_reach(start_ts, end_ts) s on s.post_id = v.root_post_id group by 1) c on c.handle = r.handle
    left join users u on u.x_id = r.handle""",
)
define(
    "reply_engagers", RANGE,
    f"""select p.post_id as root_post_id, p.user_x_id as root_user_id, r.x_username as root_username, e.user_x_id as engaged_user_id, max(cast(u.score as double)) as score,
      max(p.favorite_count) as likes, count(*) as replies, max(p.view_count) as view_count
    from (select * from user_posts where {OWN} and {inside('post_created_at')}) p
    join (select replied_post_id, user_x_id from user_posts where {inside('post_created_at')}) e on e.replied_post_id = p.post_id
    left join users r on r.x_id = p.user_x_id left join users u on u.x_id = e.user_x_id where e.user_x_id <> p.user_x_id group by 1, 2, 3, 4""",
)
define("global_post_engagement_ratios", RANGE, f"select {RATIO_COLUMNS} from ({ratios(per_post('reply_engagers(start_ts, end_ts)', ', max(view_count) as view_count'))})")

# ---- leaderboards ------------------------------------------------------------------------------

#: A post's bucket by period, from the anchor on or by calendar; as ``functions.time.cap_bucket``.
BUCKET = f"""case when cap.period not in ('day', 'week', 'month') then 0
    when cap.anchor is not null then floor((unix_micros(cast(root_tweet_created_at as timestamp)) - unix_micros(cast(cap.anchor as timestamp)))
                                           / (case cap.period when 'day' then 1D when 'week' then 7D else 30D end * 86400000000D))
    when cap.period = 'day' then unix_date(cast(root_tweet_created_at as date))
    when cap.period = 'week' then floor((unix_date(cast(root_tweet_created_at as date)) + 4) / 7D)
    else year(root_tweet_created_at) * 12 + month(root_tweet_created_at) end"""

define(
    "cap_of", "project string, board string",
    f"""select coalesce(cap.post_cap, {DEFAULT_CAP}) as posts, coalesce(nullif(cap.cap_period, ''), '{DEFAULT_PERIOD}') as period, coalesce(cap.cap_start_date, cap.project_start_date) as anchor
    from (select max(struct(post_cap, cap_period, cap_start_date, project_start_date)) as cap from post_caps where project_keyword = project and leaderboard_type = board)""",
)
define(
    "board_of", f"{PROJECT}, board string, exclude array<string>, only array<string>",
    f"""with roots as (
      select distinct root_post_id, root_user_id, root_username, root_tweet_created_at, is_root_reply from engagement
      where project_keyword = project and {inside('root_tweet_created_at')} and root_user_id <> ''),
    valued as (
      select r.root_user_id, r.root_post_id, r.root_tweet_created_at, coalesce(s.smart_reach, 0D) * (coalesce(p.content, {DEFAULT_CONTENT}D) / 100D) as value from roots r
      left join project_smart_reach(start_ts, end_ts, project) s on s.post_id = r.root_post_id
      left join (select post_id, cast(content_score as double) as content from posts where project_keyword = project) p on p.post_id = r.root_post_id where not r.is_root_reply),
    placed as (
      select v.*, cap.posts, row_number() over (partition by root_user_id, {BUCKET} order by value desc, root_post_id) as place from valued v cross join cap_of(project, board) cap),
    points as (
      select root_user_id, cast(sum(cast({rn('value', 4)} as decimal(20,4))) as double) as points, count(*) as n from placed where posts = 0 or place <= posts group by 1),
    scored as (
      select c.root_user_id as x_user_id, c.root_username as x_username, coalesce(u.display_name, '') as x_display_name, u.avatar_url as x_avatar_url,
        {rn(f"coalesce(t.points, 0D) + coalesce(t.n, 0) * coalesce(nullif(cast(u.score as double), 0D), {DEFAULT_SCORE}D) + c.replies * coalesce(nullif(cast(u.score as double), 0D), {DEFAULT_SCORE}D) / 100D", 3)} as influence_score
      from (select root_user_id, root_username, count(case when is_root_reply then 1 end) as replies from roots group by 1, 2) c
      left join points t on t.root_user_id = c.root_user_id left join users u on u.x_id = c.root_user_id
      where c.root_username <> project and (coalesce(cardinality(exclude), 0) = 0 or not array_contains(exclude, c.root_user_id)) and {listed('only', 'c.root_user_id')})
    select s.*, case when total = 0 then 0D else {rn('influence_score * 100D / total', 2)} end as influence_percent
    from scored s cross join (select cast(sum(cast(influence_score as decimal(20,3))) as double) as total from scored)
    order by influence_score desc nulls last, x_user_id limit {ROWS}""",
)
define("leaderboard", PROJECT, "select * from board_of(start_ts, end_ts, project, 'global', cast(null as array<string>), cast(null as array<string>))")
define(
    "private_leaderboard", f"{PROJECT}, exclude array<string> default null, only array<string> default null",
    "select * from board_of(start_ts, end_ts, project, 'private', exclude, only)",
)

# ---- analytics of a project --------------------------------------------------------------------

REPLY_KINDS = {"post": "is_post", "quote_post": "is_quote and not is_reply", "replies": "is_reply"}


def kinds(prefix: str = "") -> str:
    """Counts and views of posts, pure quotes and replies."""
    counts = [f"count(case when {c} then 1 end) as {prefix}{k if k == 'replies' else k}_count" for k, c in REPLY_KINDS.items()]
    views = [f"sum(case when {c} then coalesce(cast(view_count as bigint), 0) else 0 end) as {prefix}{k}_view_count" for k, c in REPLY_KINDS.items()]
    return ", ".join(counts + views)


def own_sum(column: str) -> str:
    return f"sum(case when {OWN} then coalesce(cast({column} as bigint), 0) else 0 end)"


WEIGHT = f"coalesce(nullif(x_score, 0D), {DEFAULT_SCORE}D)"

define(
    "project_totals", f"{PROJECT}, only array<string> default null",
    f"""select count(b.user_x_id) as total_unique_engaged_users, coalesce(sum(post_count), 0) as total_post_count, coalesce(sum(quote_post_count), 0) as total_quote_post_count,
      coalesce(sum(replies_count), 0) as total_replies_count, coalesce(sum(post_view_count), 0) as total_post_view_count, coalesce(sum(quote_post_view_count), 0) as total_quote_post_view_count,
      coalesce(sum(replies_view_count), 0) as total_replies_view_count, coalesce({esum('u.score')}, 0D) as community_score,
      coalesce(sum(post_view_count + quote_post_view_count + replies_view_count), 0) as total_view_count
    from (select user_x_id, {kinds()} from posts where project_keyword = project and {inside('post_created_at')} and {listed('only', 'user_x_id')} group by 1) b
    left join users u on u.x_id = b.user_x_id""",
)
#: Users are numbered in steps of the logarithm of their score: a step's rows by a window, the rows of the steps above from a
#: table that has a row a step, so of bounded size. Users of one score are one task's sort.
define(
    "project_users", f"{PROJECT}, only array<string> default null",
    f"""with stats as (
      select p.user_x_id as x_id, {own_sum('favorite_count')} as likes, {own_sum('retweet_count')} as retweets, {kinds()},
        avg(case when {OWN} then cast(content_score as double) end) as content, {mean6(f'case when {OWN} then f.duration_days_p90 end')} as p90
      from (select * from posts where project_keyword = project and {inside('post_created_at')} and {listed('only', 'user_x_id')}) p
      left join (select root_post_id, duration_days_p90 from features where project_keyword = project) f on f.root_post_id = p.post_id group by 1),
    known as (select s.*, coalesce(u.x_username, '') as x_username, coalesce(cast(u.score as double), 0D) as x_score from stats s left join users u on u.x_id = s.x_id),
    met as (
      select e.root_user_id, e.root_post_id, e.engaged_user_id, e.score, e.replies as n from project_engagers(start_ts, end_ts, project, true) e left semi join stats s on s.x_id = e.root_user_id),
    reached as (
      select root_user_id, count(*) as unique_engager, {esum('score')} as unique_reach, {esum('reach')} as reach, sum(n) as received, percentile(score, 0.5) as middle, {esum('score')} / count(score) as mean
      from (select root_user_id, engaged_user_id, max(score) as score, {esum('score')} as reach, sum(n) as n from met group by 1, 2) group by 1),
    pointed as (
      select root_user_id, {esum('smart_reach')} as smart_reach, cast(sum(cast({rn('smart_reach * (coalesce(content, 100D) / 100D)', 4)} as decimal(20,4))) as double) as points from (
        select v.root_user_id, s.smart_reach, p.content from (select distinct root_user_id, root_post_id from met) v join project_smart_reach(start_ts, end_ts, project) s on s.post_id = v.root_post_id
        join (select post_id, cast(content_score as double) as content from posts where project_keyword = project) p on p.post_id = v.root_post_id) group by 1),
    scored as (
      select k.x_id, x_username, x_score, likes + retweets + coalesce(received, 0) as engagements, likes, coalesce(received, 0) as replies, retweets,
        coalesce({div('likes', 'coalesce(received, 0)', 2)}, 0D) as like_to_reply_ratio, post_count, quote_post_count, replies_count, post_view_count, quote_post_view_count as quote_view_count,
        replies_view_count, coalesce(unique_engager, 0) as unique_engager, {rn('middle', 2)} as median_unique_engagers_score, {rn('mean', 2)} as average_unique_engagers_score, unique_reach, reach,
        coalesce(t.smart_reach, 0D) as smart_reach, {rn('content', 2)} as average_content_score, {rn('p90', 2)} as average_p90,
        {rn(f'coalesce(points, 0D) + (post_count + quote_post_count) * {WEIGHT} + replies_count * {WEIGHT} / 100D', 3)} as influence_score
      from known k left join reached r on r.root_user_id = k.x_id left join pointed t on t.root_user_id = k.x_id),
    stepped as (select *, cast(floor(ln(greatest(influence_score, 0D) + 0.001D) * 64D) as int) as step from scored),
    above as (select step, sum(n) over (order by step desc rows between unbounded preceding and current row) - n as ahead from (select step, count(*) as n from stepped group by 1))
    select s.* except (step), cast(a.ahead + row_number() over (partition by s.step order by s.influence_score desc, s.x_id) as int) as rank from stepped s join above a on a.step = s.step""",
)

#: What each sort key orders users by; another key means posts.
SORTS = {
    "MOST_VIEWS": "post_view_count + quote_view_count", "UNIQUE_ENGAGERS": "unique_engager", "UNIQUE_REACH": "unique_reach", "REACH": "reach",
    "ENGAGEMENTS": "engagements + replies", "INFLUENCE_SCORE": "influence_score", "SMART_REACH": "smart_reach",
}
ITEM = """struct(x_id, x_username, x_score, engagements, likes, replies, retweets, like_to_reply_ratio, struct(post_count, quote_post_count, replies_count) as contributions,
  struct(post_view_count, quote_view_count as quote_post_view_count, replies_view_count) as views, unique_engager as unique_engagers_count, median_unique_engagers_score,
  average_unique_engagers_score, average_content_score, average_p90, unique_reach, reach, smart_reach, influence_score, rank)"""

define(
    "project_analytics", f"{PROJECT}, sort_key string default 'MOST_POSTS', only array<string> default null",
    f"""select t.*, sort_key as sort_key, coalesce(l.json, '[]') as project_analytics from project_totals(start_ts, end_ts, project, only) t cross join (
      select to_json(transform(array_sort(collect_list(struct(place, item))), x -> x.item), map('ignoreNullFields', 'false')) as json from (
        select {ITEM} as item, row_number() over (order by case sort_key {' '.join(f"when '{k}' then cast({v} as double)" for k, v in SORTS.items())}
          else cast(post_count + quote_post_count as double) end desc nulls last, rank) as place from {inlined('project_users')}) where place <= {ROWS}) l""",
)

MEASURES = "burst_concentration, duration_days_p90, cross_post_overlap, coordinated_burst"
define(
    "project_user_posts", f"target_user string, {PROJECT}",
    f"""select post_id, handle, username, content, content_score, total_impressions, total_likes, total_replies, unique_engagers, post_unique_reach, smart_reach, like_reply_ratio,
      impression_to_unique_reach_ratio, unique_engager_scores_to_count_ratio, {MEASURES}, {flags('total_replies', 'author_score')} from (
      select *, {div('total_likes', 'total_replies', 2)} as like_reply_ratio, {div('view_count', 'post_unique_reach', 2)} as impression_to_unique_reach_ratio,
        {div('post_unique_reach', 'unique_engagers', 2)} as unique_engager_scores_to_count_ratio from (
        select p.post_id, p.user_x_id as handle, u.x_username as username, p.full_text as content, cast(p.content_score as double) as content_score, p.view_count, coalesce(p.view_count, 0) as total_impressions,
          coalesce(p.favorite_count, 0) as total_likes, coalesce(e.total_replies, 0) as total_replies, coalesce(e.unique_engagers, 0) as unique_engagers, e.post_unique_reach, s.smart_reach, {MEASURES},
          cast(u.score as double) as author_score
        from (select * from posts where user_x_id = target_user and project_keyword = project and {OWN} and {inside('post_created_at')}) p
        left join (select root_post_id, count(*) as unique_engagers, {esum('score')} as post_unique_reach, sum(n) as total_replies from (
            select root_post_id, engaged_user_id, max(engaged_user_score) as score, count(*) as n from engagement where project_keyword = project and root_user_id = target_user and is_engaged_reply
              and {inside('engaged_tweet_created_at')} and engaged_user_id <> target_user group by 1, 2) group by 1) e on e.root_post_id = p.post_id
        left join project_smart_reach(start_ts, end_ts, project) s on s.post_id = p.post_id
        left join (select root_post_id, {MEASURES} from features where project_keyword = project and root_user_id = target_user) f on f.root_post_id = p.post_id
        left join (select * from users where x_id = target_user) u on u.x_id = p.user_x_id))""",
)

# ---- analytics of users ------------------------------------------------------------------------

HALF_OPEN = f"post_created_at >= {instant('start_ts')} and post_created_at < {instant('end_ts')}"
define(
    "user_posts_analytics", f"target_user string, {RANGE}",
    f"""select post_id, handle, username, content, likes_count, replies_count, quotes_count, retweets_count, impressions, {MEASURES}, reach, unique_reach, engagements, self_replies_count, like_reply_ratio,
      impression_to_unique_reach_ratio, post_type, smart_reach, unique_engagers, unique_engager_scores_to_count_ratio, {flags('replies_count', 'author_score')} from (
      select *, likes_count + replies_count + retweets_count as engagements, {div('likes_count', 'replies_count', 2)} as like_reply_ratio,
        {div('impressions', 'unique_reach', 4)} as impression_to_unique_reach_ratio, {div('unique_reach', 'unique_engagers', 2)} as unique_engager_scores_to_count_ratio from (
        select p.post_id, p.user_x_id as handle, u.x_username as username, p.full_text as content, p.favorite_count as likes_count, coalesce(e.others, 0) as replies_count, p.quote_count as quotes_count,
          p.retweet_count as retweets_count, cast(p.view_count as bigint) as impressions, {MEASURES}, coalesce(e.reach, 0D) as reach, coalesce(e.unique_reach, 0D) as unique_reach,
          coalesce(e.own, 0) as self_replies_count, case when p.retweeted_post_id is not null then 'retweet' when p.replied_post_id is not null and p.quoted_post_id is not null then 'quoted_reply'
            when p.replied_post_id is not null then 'reply' when p.quoted_post_id is not null then 'quote' else 'post' end as post_type,
          coalesce(s.smart_reach, 0D) as smart_reach, coalesce(e.unique_engagers, 0) as unique_engagers, cast(u.score as double) as author_score
        from (select * from user_posts where user_x_id = target_user and {HALF_OPEN} and (post_id = root_post_id or root_post_id is null) and (is_post or is_quote) and not is_reply and not is_retweet) p
        left join (select replied_post_id, sum(case when other then n else 0 end) as others, sum(case when other then 0 else n end) as own, count(case when other then 1 end) as unique_engagers,
            {esum('case when other then score * n end')} as reach, {esum('case when other then score end')} as unique_reach from (
            select r.replied_post_id, r.user_x_id <> target_user as other, r.user_x_id, count(*) as n, max(coalesce(cast(v.score as double), 0D)) as score
            from (select replied_post_id, user_x_id from user_posts where {HALF_OPEN} and replied_post_id is not null) r
            left semi join (select post_id from user_posts where user_x_id = target_user) m on m.post_id = r.replied_post_id
            left join users v on v.x_id = r.user_x_id group by 1, 2, 3) group by 1) e on e.replied_post_id = p.post_id
        left join ({smart_reach('global_contribution_scores', f'original_author_x_id = target_user and {HALF_OPEN}')}) s on s.post_id = p.post_id
        left join (select root_post_id, {MEASURES} from user_features where root_user_id = target_user) f on f.root_post_id = p.post_id
        left join (select * from users where x_id = target_user) u on u.x_id = p.user_x_id))""",
)


def incoming(own: str) -> str:
    """What replies to or quotes the posts of ``own``, a row for each target: two equi-joins, as in ``operators.analytics``."""
    cols = "e.post_id, e.user_x_id as engager, e.replied_post_id, o.post_id as target, o.user_x_id as author"
    return f"""select c.*, coalesce(cast(u.score as double), 0D) as score from (
        select {cols} from user_posts e join {own} o on e.replied_post_id = o.post_id
        union all select {cols} from (select * from user_posts where quoted_post_id is not null and (replied_post_id is null or replied_post_id <> quoted_post_id)) e
          join {own} o on e.quoted_post_id = o.post_id) c left join users u on u.x_id = c.engager"""


LATEST = "select * from (select *, row_number() over (partition by user_x_id order by post_created_at desc, post_id) as place from user_posts where {}) where per_user is null or place <= per_user"
KEPT_SUMS = f"""sum(coalesce(cast(favorite_count as bigint), 0)) as likes, sum(coalesce(cast(retweet_count as bigint), 0)) as retweets, min(post_created_at) as first_post_date,
  max(post_created_at) as last_post_date, {rn(mean6('duration_days_p90'), 2)} as average_p90"""


def views_of(condition: str) -> str:
    return f"sum(case when {condition} then coalesce(cast(view_count as bigint), 0) else 0 end)"


define(
    "all_users_analytics", "per_user int default null",
    f"""with own as ({LATEST.format('(is_post or is_quote) and not is_reply and not is_retweet')}),
    stats as (
      select o.user_x_id as x_id, {views_of('is_post')} as total_post_view_count, {views_of('is_quote')} as total_quote_post_view_count, count(case when is_post then 1 end) as total_post_count,
        count(case when is_quote then 1 end) as total_quote_post_count, {KEPT_SUMS} from own o left join user_features f on f.root_post_id = o.post_id group by 1),
    came as (select author, target, engager, max(score) as score, count(*) as n from ({incoming('own')}) group by 1, 2, 3),
    pairs as (select author, engager, author <> engager as other, max(score) as score, {esum('score')} as reach, sum(n) as n from came group by 1, 2, 3),
    back as (
      select author, sum(case when other then n else 0 end) as replies, sum(case when other then 0 else n end) as self_replies, count(case when other then 1 end) as engagers,
        {esum('case when other then reach end')} as reach, {esum('case when other then score end')} as unique_reach, percentile(case when other then score end, 0.5) as middle,
        {esum('case when other then score end')} / count(case when other then score end) as mean from pairs group by 1),
    smart as (
      select v.author, {esum('s.contribution_score')} as smart_reach from (select distinct author, target from came where author <> engager) v
      join ({first_contributions('global_contribution_scores', 'true')}) s on s.post_id = v.target group by 1)
    select s.x_id, coalesce(u.x_username, '') as x_username, coalesce(cast(u.score as double), 0D) as x_score, coalesce(b.engagers, 0) as total_unique_engaged_users, total_post_count, total_quote_post_count,
      total_post_view_count, total_quote_post_view_count, total_post_view_count + total_quote_post_view_count as total_view_count, likes + retweets + coalesce(b.replies, 0) as engagements, likes,
      coalesce(b.replies, 0) as replies, retweets, coalesce({div('likes', 'coalesce(b.replies, 0)', 2)}, 0D) as like_to_reply_ratio, coalesce(b.reach, 0D) as reach,
      coalesce(b.unique_reach, 0D) as unique_reach, average_p90, first_post_date, last_post_date, coalesce(b.self_replies, 0) as self_replies, coalesce(m.smart_reach, 0D) as smart_reach,
      coalesce(b.engagers, 0) as unique_engagers_count, {rn('coalesce(b.middle, 0D)', 2)} as median_unique_engagers_score, {rn('coalesce(b.mean, 0D)', 2)} as average_unique_engagers_score
    from stats s left join back b on b.author = s.x_id left join smart m on m.author = s.x_id left join users u on u.x_id = s.x_id""",
)
define(
    "user_analytics", "target_user string, per_user int default null",
    f"""with own as ({LATEST.format(f'user_x_id = target_user and {OWN}')}),
    stats as (
      select o.user_x_id as x_id, count(case when is_post then 1 end) as total_post_count, count(case when is_quote and not is_reply then 1 end) as total_quote_post_count,
        {views_of('is_post')} as total_post_view_count, {views_of('is_quote and not is_reply')} as total_quote_post_view_count, {KEPT_SUMS}
      from own o left join (select * from user_features where root_user_id = target_user) f on f.root_post_id = o.post_id group by 1),
    came as (select post_id, engager, coalesce(replied_post_id, target) as target, max(score) as score from ({incoming('own')}) group by 1, 2, 3),
    pairs as (
      select engager <> target_user as other, engager, max(score) as score, {esum('score')} as reach, sum(n) as n from (
        select target, engager, max(score) as score, count(*) as n from came group by 1, 2) group by 1, 2),
    back as (
      select count(case when other then 1 end) as engagers, coalesce(sum(case when other then n else 0 end), 0) as replies, coalesce(sum(case when other then 0 else n end), 0) as self_replies,
        coalesce({esum('case when other then reach end')}, 0D) as reach, coalesce({esum('case when other then score end')}, 0D) as unique_reach from pairs)
    select engagers as total_unique_engaged_users, total_post_count, total_quote_post_count, total_post_view_count, total_quote_post_view_count,
      total_post_view_count + total_quote_post_view_count as total_view_count, s.x_id, coalesce(u.x_username, '') as x_username, coalesce(cast(u.score as double), 0D) as x_score,
      likes + retweets + replies as engagements, likes, replies, retweets, coalesce({div('likes', 'replies', 2)}, 0D) as like_to_reply_ratio, reach, unique_reach, first_post_date, last_post_date,
      self_replies, average_p90 from stats s cross join back b left join (select * from users where x_id = target_user) u on u.x_id = s.x_id""",
)

NEWEST = "order by updated_at desc nulls first, created_at desc, view_count desc, favorite_count desc"
define(
    "user_engagement_quality", "ids array<string>, per_user int default 50",
    f"""with own as (
      select post_id as root_post_id, user_x_id as handle, favorite_count as total_likes, view_count from (
        select *, row_number() over (partition by user_x_id order by post_created_at desc, post_id) as place from (
          select *, row_number() over (partition by post_id, user_x_id {NEWEST}) as version from nucleus_posts where array_contains(ids, user_x_id) and {OWN} and is_reply_fetched)
        where version = 1) where place <= per_user),
    engaged as (
      select replied_post_id, user_x_id, is_reply from (
        select e.*, row_number() over (partition by e.post_id {NEWEST}) as version from nucleus_posts e left semi join own o on o.root_post_id = e.replied_post_id) where version = 1),
    pairs as (
      select o.root_post_id, o.handle, e.user_x_id as engager, max(cast(u.score as double)) as score, count(case when e.is_reply then 1 end) as n
      from own o join engaged e on e.replied_post_id = o.root_post_id left join users u on u.x_id = e.user_x_id where e.user_x_id <> o.handle group by 1, 2, 3),
    reached as (select handle, {esum('score')} as unique_reach from (select handle, engager, max(score) as score from pairs group by 1, 2) group by 1),
    judged as (
      select handle, {flags('total_replies', 'author_score')} from (
        select o.handle, p.total_replies, {div('o.total_likes', 'p.total_replies', 2)} as like_reply_ratio, {div('o.view_count', 'p.post_unique_reach', 2)} as impression_to_unique_reach_ratio,
          coalesce(cast(u.score as double), 0D) as author_score
        from own o left join (select root_post_id, coalesce({esum('score')}, 0D) as post_unique_reach, sum(n) as total_replies from pairs group by 1) p on p.root_post_id = o.root_post_id
        left join users u on u.x_id = o.handle)),
    counted as (
      select handle, count(case when {FLAGS[0]} or {FLAGS[2]} then 1 end) as farmed, count(case when {FLAGS[1]} or {FLAGS[3]} then 1 end) as botted, count(*) as total_posts from judged group by 1)
    select u.x_id as handle, coalesce(u.x_username, '') as username, coalesce(cast(u.score as double), 0D) as score, coalesce(r.unique_reach, 0D) as unique_reach,
      coalesce(c.farmed, 0) as engagement_flag_count, coalesce(c.botted, 0) as botting_flag_count, coalesce(c.total_posts, 0) as total_posts
    from users u left join counted c on c.handle = u.x_id left join reached r on r.handle = u.x_id where array_contains(ids, u.x_id)""",
)


def listed_posts(source: str, name: str, keyword: str, status: str) -> str:
    return f"""select p.post_id, p.user_x_id, {keyword} as project_keyword, '{name}' as source_table, p.favorite_count, p.view_count, p.post_created_at, p.is_post, p.is_quote, p.is_reply, p.updated_at,
        case when p.is_post then 'post' when p.is_quote and not p.is_reply then 'quote' when p.is_reply then 'reply' end as post_type, {status} as status
      from {source} p cross join (select max(case when start_ts > 0 then start_ts end) as since, max(case when end_ts > 0 then end_ts end) as until from projects where project_name = project) d
      where coalesce(source, 'project_post') = '{name}' and array_contains(ids, p.user_x_id) and not p.is_reply and not p.is_retweet
        and (d.since is null or p.post_created_at >= {instant('d.since')}) and (d.until is null or p.post_created_at <= {instant('d.until')})
        {'' if name == 'user_post' else 'and (project is null or p.project_keyword = project)'}"""


NONE = "cast(null as string)"
define(
    "posts_from_users", "ids array<string>, project string default null, source string default null, as_of date default current_date()",
    f"""{listed_posts('posts', 'project_post', 'p.project_keyword', "case when datediff(as_of, cast(p.created_at as date)) >= 2 then 'tracked' else 'Under Review' end")}
    union all {listed_posts('user_posts', 'user_post', NONE, NONE)}
    union all {listed_posts('nucleus_posts', 'nucleus_post', 'p.project_keyword', NONE)}""",
)
