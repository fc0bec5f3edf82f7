"""The same queries as SQL for an independent engine, to compare results with."""

from __future__ import annotations

from clickloom.operators.sessions import DETAIL_COLUMNS
from clickloom.plans.registry import (
    EXTRACT_SEED,
    EXTRACT_TOTAL,
    LATE_SLICE_DAYS,
    OVERLAP_DAY,
    PAGE_FLOW,
    PICKY,
    SOME_DAYS,
    SPLIT_DAY,
    STREAM_SLICES,
    WATERMARK,
)
from clickloom.operators.sliding import SLIDE_SECONDS, WINDOW_SECONDS
from clickloom.schemas import STEP_BUCKETS, VISIT_BUCKETS
from clickloom.sources.fixtures import AD_THRESHOLD, FIRST_DAY, LAST_DAY

_TIME, _DATE = "'%Y-%m-%d %H:%M:%S'", "'%Y-%m-%d'"

_ACTIONS = """
raw_events as (
  select ts, user_id, event_type, cast(json_extract_string(props, '$.k') as bigint) as k,
    cast(floor(epoch(ts)) as bigint) as ep,
    case user_id % 3 when 0 then 1 when 1 then 7 else 30 end as period,
    case user_id % 3 when 0 then 40 when 1 then 400 else 2000 end as speed
  from events),
blocked as (select *, ep // (86400 * period) as block from raw_events),
actions as (
  select cast(ts as date) as date, user_id, concat(user_id, '_', period, '_', block) as session_id,
    k % 10 as page_id,
    block * 86400 * period + (user_id % 24) * 3600 + (ep - block * 86400 * period) // speed as acted_at,
    case when event_type = 'view' then concat('kw', k % 10) end as search_keyword,
    case when event_type = 'click' then k end as click_category_id,
    case when event_type = 'click' then k * 3 % 100 end as click_product_id,
    case when event_type = 'signup' then [k, (k + 7) % 100] end as order_categories,
    case when event_type = 'signup' then [k * 3 % 100, (k + 11) % 100] end as order_products,
    case when event_type = 'purchase' then [k, (k + 7) % 100] end as pay_categories,
    case when event_type = 'purchase' then [k * 3 % 100, (k + 11) % 100] end as pay_products
  from blocked),
users as (
  select c_custkey as user_id, c_custkey * 7 % 60 as age, c_mktsegment as professional, n_name as city,
    case when c_custkey % 2 = 0 then 'male' else 'female' end as sex
  from customer join nation on c_nationkey = n_nationkey)"""

_DETAIL = f"""
  user_id, session_id, page_id, strftime(make_timestamp(acted_at * 1000000), {_TIME}) as action_time, search_keyword,
  click_category_id, click_product_id,
  array_to_string(order_categories, ',') as order_category_ids,
  array_to_string(order_products, ',') as order_product_ids,
  array_to_string(pay_categories, ',') as pay_category_ids,
  array_to_string(pay_products, ',') as pay_product_ids"""

# the text log adds parts that do not read after each list; they are left out again
_TEXT_LISTS = """array_to_string(order_categories, ',') as order_category_ids,
  array_to_string(order_products, ',') as order_product_ids, array_to_string(pay_categories, ',') as pay_category_ids,
  array_to_string(pay_products, ',') as pay_product_ids"""

_DETAILS = f"select {_DETAIL} from actions"
_DETAIL_TEXT = ", ".join(f"coalesce(cast({name} as varchar), '')" for name in DETAIL_COLUMNS)
_RATIO_TEXT = ", ".join(
    f"coalesce(cast(cast(round({kind}_length_{b}_ratio * 100) as bigint) as varchar), '')"
    for kind, buckets in (("visit", VISIT_BUCKETS), ("step", STEP_BUCKETS))
    for b in buckets
)

_SETS = """
    array_to_string(list_sort(list(distinct search_keyword) filter (search_keyword is not null)), ',')
      as search_keywords,
    array_to_string(list_sort(list(distinct click_category_id) filter (click_category_id is not null)), ',')
      as click_category_ids"""


def _quoted(values: tuple[object, ...]) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


_SESSIONS = f"""{_ACTIONS},
rolled as (
  select session_id, arg_min(user_id, acted_at) as user_id, min(acted_at) as first_at, max(acted_at) as last_at,
    count(*) as step_length, max(acted_at) - min(acted_at) as visit_length,
    bool_or(coalesce(search_keyword in ({_quoted(PICKY.keywords)}), false)) as keyword_hit,
    bool_or(coalesce(click_category_id in ({_quoted(PICKY.category_ids)}), false)) as category_hit
  from actions group by session_id),
sessions as (select * from rolled join users using (user_id)),
picky as (
  select * from sessions where age between {PICKY.start_age} and {PICKY.end_age}
    and professional in ({_quoted(PICKY.professionals)}) and city in ({_quoted(PICKY.cities)})
    and sex = '{PICKY.sex}' and keyword_hit and category_hit)"""

_FACTS = f"""session_id, user_id,
  strftime(make_timestamp(first_at * 1000000), {_TIME}) as start_time,
  strftime(make_timestamp(last_at * 1000000), {_TIME}) as end_time,
  step_length, visit_length, age, professional, city, sex"""

_VISIT = dict(
    zip(
        VISIT_BUCKETS,
        (
            "between 1 and 3",
            "between 4 and 6",
            "between 7 and 9",
            "between 10 and 30",
            "between 31 and 60",
            "between 61 and 180",
            "between 181 and 600",
            "between 601 and 1800",
            "> 1800",
        ),
    )
)
_STEP = dict(
    zip(
        STEP_BUCKETS,
        ("between 1 and 3", "between 4 and 6", "between 7 and 9", "between 10 and 30", "between 31 and 60", "> 60"),
    )
)


def _histogram(source: str) -> str:
    tests = [("visit_length", b, t) for b, t in _VISIT.items()] + [("step_length", b, t) for b, t in _STEP.items()]
    counts = ",\n  ".join(f"count(*) filter ({column} {test}) as {column}_{b}" for column, b, test in tests)
    return f"select count(*) as session_count,\n  {counts}\nfrom {source}"


def _shares(source: str) -> str:
    """Ratios rounded half up, in whole-number arithmetic."""
    names = [f"visit_length_{b}" for b in VISIT_BUCKETS] + [f"step_length_{b}" for b in STEP_BUCKETS]
    ratios = ",\n  ".join(
        f"((200 * {n} + session_count) // (2 * nullif(session_count, 0))) / 100.0 as {n}_ratio" for n in names
    )
    return f"select session_count,\n  {ratios}\nfrom ({_histogram(source)})"


def _pairs(source: str, name: str = "pairs") -> str:
    return f"""{name} as (
  select session_id, category_id, count(*) filter (kind = 'click') as click_count,
    count(*) filter (kind = 'order') as order_count, count(*) filter (kind = 'pay') as pay_count
  from (
    select session_id, click_category_id as category_id, 'click' as kind from actions
      where click_category_id is not null
    union all select session_id, unnest(order_categories), 'order' from actions
    union all select session_id, unnest(pay_categories), 'pay' from actions)
  where session_id in (select session_id from {source})
  group by session_id, category_id)"""


_TOP = """
hot as (
  select category_id, cast(sum(click_count) as bigint) as click_count,
    cast(sum(order_count) as bigint) as order_count, cast(sum(pay_count) as bigint) as pay_count
  from pairs group by category_id),
hottest as (select * from hot order by click_count desc, order_count desc, pay_count desc, category_id limit 10),
ranked as (
  select category_id, session_id, click_count,
    row_number() over (partition by category_id order by click_count desc, session_id) as place
  from pairs where click_count > 0 and category_id in (select category_id from hottest)),
busiest as (select category_id, session_id, click_count from ranked where place <= 10)"""

_CATEGORIES = f"{_SESSIONS},\n{_pairs('sessions')},{_TOP}"


def _extract(source: str, prefix: str = "") -> str:
    return f"""
{prefix}started as (
  select session_id, first_at, cast(make_timestamp(first_at * 1000000) as date) as date,
    cast(extract(hour from make_timestamp(first_at * 1000000)) as int) as hour
  from {source}),
{prefix}hours as (select date, hour, count(*) as hour_sessions from {prefix}started group by date, hour),
{prefix}day_hours as (
  select *, cast(sum(hour_sessions) over (partition by date) as bigint) as day_sessions,
    {EXTRACT_TOTAL} // (select count(distinct date) from {prefix}hours) as per_day
  from {prefix}hours),
{prefix}quotas as (
  select date, hour, hour_sessions, day_sessions, least(hour_sessions,
    cast(floor(cast(hour_sessions as double) / cast(day_sessions as double) * per_day) as bigint)) as quota
  from {prefix}day_hours),
{prefix}drawn as (
  select session_id, first_at, date, hour, row_number() over (
    partition by date, hour order by md5(concat('{EXTRACT_SEED}:', session_id)), session_id) as place
  from {prefix}started),
{prefix}extracted as (
  select session_id, first_at from {prefix}drawn join {prefix}quotas using (date, hour) where place <= quota)"""


_EXTRACT = f"{_SESSIONS},{_extract('sessions')}"

_CLICKS = """
clicks as (
  select make_timestamp((epoch_us(ts) // 1000) * 1000) as click_time, cast(ts as date) as date,
    replace(r_name, ' ', '_') as province, replace(n_name, ' ', '_') as city, user_id,
    cast(json_extract_string(props, '$.k') as bigint) % 7 as ad_id
  from events join customer on c_custkey = user_id
    join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)"""

_ALLOWED = f"""{_CLICKS},
user_counts as (select date, user_id, ad_id, count(*) as click_count from clicks group by all),
blacklist as (select distinct user_id from user_counts where click_count >= {AD_THRESHOLD}),
allowed as (select * from clicks where user_id not in (select user_id from blacklist))"""

_TOP_ADS = """
select date, province, ad_id, click_count from (
  select *, row_number() over (partition by date, province order by click_count desc, ad_id) as place
  from (select date, province, ad_id, count(*) as click_count from {0} group by all))
where place <= 3"""

_DAY = f"strftime(date, {_DATE}) as date"

_TREND = f"""select strftime(click_time, {_DATE}) as date, strftime(click_time, '%H') as hour,
  strftime(click_time, '%M') as minute, ad_id, count(*) as click_count"""

# Clicks of a window of time up to each moment at which a pane of clicks comes in or goes out.
_SLIDING = f"""{_CLICKS},
panes as (
  select ad_id, epoch_ms(click_time) // 1000 // {SLIDE_SECONDS} * {SLIDE_SECONDS} as pane, count(*) as n
  from clicks group by all),
points as (
  select ad_id, pane + {SLIDE_SECONDS} as moment, n, n as change from panes union all
  select ad_id, pane + {SLIDE_SECONDS + WINDOW_SECONDS}, 0, -n from panes),
moments as (select ad_id, moment, sum(n) as n, sum(change) as change from points group by all),
sliding as (
  select ad_id, moment, change, sum(n) over (partition by ad_id order by moment
    range between {WINDOW_SECONDS - SLIDE_SECONDS} preceding and current row) as click_count from moments)
select ad_id, strftime(make_timestamp(moment * 1000000), {_TIME}) as window_end, cast(click_count as bigint) as click_count
from sliding where change <> 0"""

# What arrives when, and the watermark that the earlier arrivals have set.
_LATE = f"""{_CLICKS},
arrived as (
  select click_time, date,
    date_diff('day', date '2024-01-01', date) // {LATE_SLICE_DAYS} + if(user_id % 5 = 0, 1, 0) as slice from clicks),
marks as (
  select slice, max(max(click_time)) over (order by slice rows between unbounded preceding and 1 preceding)
    - interval '{WATERMARK}' as mark from arrived group by slice),
judged as (
  select date, mark is null or date_trunc('minute', click_time) + interval 1 minute > mark as in_time
  from arrived join marks using (slice))"""

_OLD_NEW = f"""{_CLICKS},
old as (
  select date, province, city, ad_id, count(*) as click_count from clicks where date < '{SPLIT_DAY}' group by all),
new as (
  select date, province, city, ad_id, count(*) * 10 as click_count from clicks
  where date >= '{OVERLAP_DAY}' group by all)"""

# A user is banned by the first slice that brings some (date, ad) to the threshold; later slices' clicks are dropped.
_REPLAY = f"""{_CLICKS},
sliced as (select *, cast(extract(hour from click_time) as int) // {24 // STREAM_SLICES} as slice from clicks),
running as (
  select user_id, slice,
    sum(count(*)) over (partition by date, user_id, ad_id order by slice) as so_far
  from sliced group by date, user_id, ad_id, slice),
bans as (select user_id, min(slice) as banned_in from running where so_far >= {AD_THRESHOLD} group by user_id),
kept as (
  select s.* from sliced s left join bans b on s.user_id = b.user_id
  where b.user_id is null or s.slice <= b.banned_in)"""

_TASK = f"""{_SESSIONS},
wanted as (select * from sessions where age between 5 and 55),
{_pairs('wanted')},{_TOP},{_extract('wanted')}"""


def oracle_sql() -> dict[str, str]:
    return {
        "action_scan": f"""with {_ACTIONS}
select {_DAY}, user_id % 10 as city_id, {_DETAIL} from actions
where date between '{SOME_DAYS.start_date}' and '{SOME_DAYS.end_date}'""",
        "page_conversion": f"""with {_ACTIONS},
moves as (select page_id, lead(page_id) over (partition by session_id order by acted_at, page_id) as next_page from actions),
steps as (select unnest([{_quoted(tuple(range(1, len(PAGE_FLOW))))}]) as step, unnest([{_quoted(PAGE_FLOW[:-1])}]) as page_id,
  unnest([{_quoted(PAGE_FLOW[1:])}]) as next_page),
counted as (
  select step, page_id, next_page,
    (select count(*) from moves m where m.page_id = s.page_id and m.next_page = s.next_page) as jumps
  from steps s),
based as (select *, coalesce(lag(jumps) over (order by step),
  (select count(*) from actions where page_id = {PAGE_FLOW[0]})) as base from counted)
select step, page_id, next_page, jumps, base, round(jumps / nullif(base, 0), 4) as rate from based""",
        "action_scan_text": f"""with {_ACTIONS}
select {_DAY}, user_id % 10 as city_id, user_id, session_id, page_id,
  case when page_id <> 7 then strftime(make_timestamp(acted_at * 1000000), {_TIME}) end as action_time, search_keyword,
  click_category_id, click_product_id, {_TEXT_LISTS}
from actions where date between '{SOME_DAYS.start_date}' and '{SOME_DAYS.end_date}'""",
        "session_rollup": f"""with {_SESSIONS},
sets as (select session_id, {_SETS} from actions group by session_id)
select {_FACTS}, coalesce(search_keywords, '') as search_keywords,
  coalesce(click_category_ids, '') as click_category_ids
from sessions join sets using (session_id)""",
        "session_filter": f"with {_SESSIONS} select {_FACTS} from picky",
        "session_histogram": f"with {_SESSIONS} {_histogram('sessions')}",
        "session_aggr_stat": f"with {_SESSIONS} {_shares('sessions')}",
        "session_aggr_stat_filtered": f"with {_SESSIONS} {_shares('picky')}",
        "session_detail_filtered": f"""with {_SESSIONS}
select {_DETAIL} from actions where session_id in (select session_id from picky)""",
        "category_counts": f"with {_CATEGORIES} select * from hot",
        "category_session_clicks": f"""with {_CATEGORIES}
select category_id, session_id, click_count from pairs where click_count > 0""",
        "top10_category": f"with {_CATEGORIES} select * from hottest",
        "top10_session": f"with {_CATEGORIES} select * from busiest",
        "top10_session_detail": f"""with {_CATEGORIES}
select {_DETAIL} from actions where session_id in (select session_id from busiest)""",
        "session_hour_counts": f"with {_EXTRACT} select {_DAY}, hour, hour_sessions from hours",
        "session_quota": f"with {_EXTRACT} select {_DAY}, hour, hour_sessions, day_sessions, quota from quotas",
        "session_random_extract": f"""with {_EXTRACT},
sets as (select session_id, {_SETS} from actions group by session_id)
select session_id, strftime(make_timestamp(first_at * 1000000), {_TIME}) as start_time,
  coalesce(search_keywords, '') as search_keywords, coalesce(click_category_ids, '') as click_category_ids
from extracted join sets using (session_id)""",
        "extract_detail": f"""with {_EXTRACT}
select {_DETAIL} from actions where session_id in (select session_id from extracted)""",
        "session_task": f"""with {_TASK},
sets as (select session_id, {_SETS} from actions group by session_id),
content as (
  select 'session_aggr_stat' as table_name, concat_ws('|', session_count, {_RATIO_TEXT}) as content
  from ({_shares('wanted')})
  union all select 'top10_category', concat_ws('|', category_id, click_count, order_count, pay_count) from hottest
  union all select 'top10_session', concat_ws('|', category_id, session_id, click_count) from busiest
  union all select 'session_random_extract', concat_ws('|', session_id,
    strftime(make_timestamp(first_at * 1000000), {_TIME}), coalesce(search_keywords, ''),
    coalesce(click_category_ids, '')) from extracted join sets using (session_id)
  union all select 'session_detail', concat_ws('|', 'extract', {_DETAIL_TEXT}) from ({_DETAILS})
    where session_id in (select session_id from extracted)
  union all select 'session_detail', concat_ws('|', 'top10', {_DETAIL_TEXT}) from ({_DETAILS})
    where session_id in (select session_id from busiest))
select table_name, content, count(*) as rows from content group by all""",
        "ad_log_parse": f"""with {_CLICKS}
select strftime(click_time, {_TIME}) as click_time, {_DAY}, province, city, user_id, ad_id from clicks""",
        "ad_user_click_count": f"with {_ALLOWED} select {_DAY}, user_id, ad_id, click_count from user_counts",
        "ad_blacklist": f"with {_ALLOWED} select user_id from blacklist",
        "ad_filtered_clicks": f"""with {_ALLOWED}
select strftime(click_time, {_TIME}) as click_time, {_DAY}, province, city, user_id, ad_id from allowed""",
        "ad_stat": f"""with {_ALLOWED}
select {_DAY}, province, city, ad_id, count(*) as click_count from allowed group by all""",
        "ad_province_click_count": f"""with {_ALLOWED}
select {_DAY}, province, ad_id, count(*) as click_count from allowed group by all""",
        "ad_province_top3": f"""with {_ALLOWED}
select {_DAY}, province, ad_id, click_count from ({_TOP_ADS.format('allowed')})""",
        "ad_click_trend": f"with {_CLICKS} {_TREND} from clicks group by all",
        "ad_trend_last_hour": f"""with {_CLICKS} {_TREND} from clicks
where date_trunc('minute', click_time) >=
  (select date_trunc('minute', max(click_time)) - interval 59 minutes from clicks)
group by all""",
        "ad_click_sliding": f"with {_SLIDING}",
        "ad_stream_sliding": f"with {_SLIDING}",
        "ad_stream_late": f"""with {_LATE}
select {_DAY}, count(*) as arrived, count(*) filter (in_time) as counted, count(*) filter (not in_time) as late
from judged group by date""",
        "ad_log_quality": f"""with {_CLICKS},
kinds as (select (user_id + epoch_ms(click_time)) % 17 as kind from clicks)
select reason, count(*) filter (list_contains(kinds, kind)) as lines
from kinds, (values ('all', range(17)), ('empty', [4, 5]), ('short', [0]), ('time', [1]), ('user', [2]), ('ad', [3])) r(reason, kinds)
group by reason""",
        "ad_time_keys": f"""with {_CLICKS}
select strftime(click_time, '%Y%m%d') as date_key, strftime(click_time, '%Y%m%d%H%M') as minute_key, {_DAY},
  true as same, count(*) as click_count from clicks group by all""",
        "ad_upsert_stored": f"""with {_OLD_NEW},
again as (select * from old where date >= '{OVERLAP_DAY}')
select {_DAY}, province, city, ad_id, click_count from again
union all
select {_DAY}, province, city, ad_id, cast(sum(click_count) as bigint) as click_count
from (select * from old union all select * from new) b
where not exists (
  select 1 from again where again.date = b.date and again.province = b.province
    and again.city = b.city and again.ad_id = b.ad_id)
group by all""",
        "ad_upsert_replace": f"""with {_OLD_NEW}
select {_DAY}, province, city, ad_id, click_count from (
  select * from new union all
  select * from old where not exists (
    select 1 from new where new.date = old.date and new.province = old.province
      and new.city = old.city and new.ad_id = old.ad_id))""",
        "ad_upsert_accumulate": f"""with {_OLD_NEW}
select {_DAY}, province, city, ad_id, cast(sum(click_count) as bigint) as click_count
from (select * from old union all select * from new) group by all""",
        "ad_stream_tables": f"""with {_REPLAY}
select 'ad_user_click_count' as table_name, concat_ws('|', strftime(date, {_DATE}), user_id, ad_id) as row_key,
  count(*) as click_count from kept group by all
union all
select 'ad_stat', concat_ws('|', strftime(date, {_DATE}), province, city, ad_id), count(*) from kept group by all
union all
select 'ad_province_top3', concat_ws('|', strftime(date, {_DATE}), province, ad_id), click_count
from ({_TOP_ADS.format('kept')})
union all
select 'ad_blacklist', cast(user_id as varchar), null from bans""",
        "ad_stream_trend": f"with {_CLICKS} {_TREND} from clicks group by all",
        "ad_stream_running_stat": f"""with {_CLICKS}
select {_DAY}, province, city, ad_id, count(*) as click_count from clicks group by all""",
    }
