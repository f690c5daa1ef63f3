"""DuckDB SQL giving the same rows as each registered query.

Run on the same parquet tables (registered as views by name). Column names
match the Spark queries exactly.
"""

from __future__ import annotations

# Every shape the queries render is the event's own time, but for event_id % 7
# = 0, which is in no accepted layout.
_HOUR = "cast(hour(case when event_id % 7 = 0 then null else ts end) as int)"

_OUTLIERS = """
with st as (
  select user_id as u, avg(value) as m, stddev_samp(value) as s
  from events group by user_id
)
select user_id as caller_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as call_timestamp,
       value as duration_sec,
       cast(printf('%.2f', m) as double) as user_mean_duration,
       cast(printf('%.2f', s) as double) as user_stddev
from events join st on user_id = u
where s > 0 and abs(value - m) > 3 * s
"""

_TOP_ORDERS_ROWS = "least(100, (select count(distinct o_custkey) from orders))"

# Jobs run on the CDR CSV derived from ``events`` (see plans/cdr_runs.py).
_CDR = """cdr as (
  select 'USER_' || user_id as caller_id, value as duration_sec,
         event_type as tower_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as call_timestamp,
         ts, value as charge_amount
  from events
)"""

_CDR_TOP = f"""
with {_CDR}
select caller_id, cast(sum(cast(charge_amount as decimal(18,2))) as double) as total_spend
from cdr group by caller_id
order by total_spend desc nulls last, caller_id limit 100
"""

_CDR_HEATMAP = """
select event_type as tower_id, cast(hour(ts) as int) as hour_of_day, count(*) as call_count
from events group by 1, 2
"""

_CDR_ANOMALIES = f"""
with {_CDR},
st as (
  select caller_id as c, avg(duration_sec) as m, stddev_samp(duration_sec) as s
  from cdr group by caller_id
)
select caller_id, call_timestamp, cast(trunc(duration_sec) as bigint) as duration_sec,
       cast(printf('%.2f', m) as double) as user_mean_duration, cast(printf('%.2f', s) as double) as user_stddev
from cdr join st on caller_id = c
where s > 0 and abs(duration_sec - m) > 3 * s
"""

_CDR_REVENUE = """
select cast(sum(cast(value as decimal(18,2))) as double) as total_revenue from events
"""

_CDR_MANIFESTS = f"""
with counts as (
  select 'top_callers_by_spend' as job_name, least(100, (select count(distinct user_id) from events)) as n
  union all
  select 'tower_utilization_heatmap', (select count(*) from ({_CDR_HEATMAP}))
  union all
  select 'anomalous_call_detection', (select count(*) from ({_CDR_ANOMALIES}))
  union all
  select 'revenue_reconciliation', 1
)
select job_name, 'r0' as run_id, (select count(*) from events) as input_record_count,
       n as output_record_count, 'SUCCESS' as status, n as actual_rows, true as ok
from counts
"""

# DuckDB has no CRC-32 function: the standard bitwise CRC-32 (reflected
# polynomial 0xEDB88320 = 3988292384, initial value and final xor
# 0xFFFFFFFF) folded over the key's bytes. Keys are decimal digits, so
# ascii() gives the UTF-8 bytes.
_CRC_BUCKET = """cast(xor(list_reduce(
      list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))),
      lambda c, x: list_reduce(range(8), lambda r, j: xor(r >> 1, 3988292384 & -(r & 1)), xor(c, x)),
      4294967295::BIGINT), 4294967295) % 20 as int) as bucket"""

_KEY_BUCKET = f"""
with k as (select event_id, user_id, cast(user_id as varchar) as s from events)
select event_id, user_id as caller_id, {_CRC_BUCKET}
from k
"""

ORACLE_SQL: dict[str, str] = {
    "top_spend": """
select o_custkey as caller_id,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_spend
from orders group by o_custkey
order by total_spend desc nulls last, caller_id limit 100
""",
    "top_spend_lineitem": """
select l_suppkey as caller_id,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total_spend
from lineitem group by l_suppkey
order by total_spend desc nulls last, caller_id limit 100
""",
    "usage_heatmap": """
select event_type as tower_id, cast(hour(ts) as int) as hour_of_day, count(*) as call_count
from events where ts is not null group by 1, 2
""",
    "outlier_events": _OUTLIERS,
    "outlier_events_split": _OUTLIERS,
    "outlier_events_shuffle": _OUTLIERS,
    "revenue_total": """
select cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_revenue from orders
""",
    "revenue_lineitem": """
select cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total_revenue from lineitem
""",
    "heavy_hitters": """
select user_id as caller_id, count(*) as n from events group by user_id having count(*) > 80
""",
    "heavy_hitters_sketch": """
select user_id as caller_id, count(*) as n from events group by user_id having count(*) > 80
""",
    "group_stats": """
select user_id as caller_id, count(*) as n,
       round(avg(value), 6) as mean, round(stddev_samp(value), 6) as stddev
from events group by user_id
""",
    "heavy_group_stats": """
select user_id as caller_id, round(avg(value), 6) as mean,
       round(coalesce(stddev_samp(value), 0.0), 6) as stddev
from events group by user_id having count(*) > 80
""",
    "stats_lookup": """
with h as (
  select user_id as u, avg(value) as m from events group by user_id having count(*) > 80
)
select event_id, u is not null as is_heavy, round(coalesce(m, 0.0), 6) as mean
from events left join h on user_id = u
""",
    "parsed_hour": f"""
select event_id, {_HOUR} as hour_of_day from events
""",
    "parsed_heatmap": f"""
select event_type as tower_id, {_HOUR} as hour_of_day, count(*) as call_count
from events where event_id % 7 <> 0 and ts is not null group by 1, 2
""",
    "typed_projection": """
select user_id as caller_id, cast(floor(value) as int) as duration_sec,
       cast(value as float) as charge_amount
from events
""",
    "input_rowcount": "select count(*) as input_record_count from events",
    "rejected_rows": """
select count(*) as input_record_count, count(*) filter (where event_id % 7 = 0) as rejected_record_count from events
""",
    "revenue_fractional": """
select cast(sum(cast(value / 8 as decimal(38,6))) as double) as total_revenue from events
""",
    "top_spend_fractional": """
select user_id as caller_id, cast(sum(cast(value / 8 as decimal(38,6))) as double) as total_spend
from events group by user_id order by total_spend desc nulls last, caller_id limit 100
""",
    "csv_null_keys": """
select case user_id % 4 when 0 then null when 1 then 'NULL' when 2 then 'a' || chr(10) || 'b' else '' end as caller_id,
       cast(sum(cast(value as decimal(18,2))) as double) as total_spend
from events group by 1
""",
    "failed_run": """
select 'revenue_reconciliation' as job_name, 'r0' as run_id, (select count(*) from events) as input_record_count,
       output_record_count, status, 1 as actual_rows, false as ok
from (values (1, 'SUCCESS'), (0, 'FAILURE')) as attempts(output_record_count, status)
""",
    "published_versions": """
select 'r0' as run_id, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total_revenue,
       1 as actual_rows, true as ok, 1 as killed_attempts
from lineitem
""",
    "part_check": """
select 'lines' as job_name, 'r0' as run_id, count(*) as recorded_rows, count(*) as found_rows, 1 as same_bytes, 1 as ok
from orders
""",
    "csv_roundtrip": """
select o_custkey as caller_id,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_spend
from orders group by o_custkey
order by total_spend desc nulls last, caller_id limit 100
""",
    "run_manifest": f"""
select 'top_callers_by_spend' as job_name, 'r0' as run_id,
       (select count(*) from orders) as input_record_count,
       {_TOP_ORDERS_ROWS} as output_record_count, 'SUCCESS' as status
""",
    "manifest_check": f"""
select 'top_callers_by_spend' as job_name, 'r0' as run_id,
       {_TOP_ORDERS_ROWS} as expected_rows, {_TOP_ORDERS_ROWS} as actual_rows, true as ok
""",
    "key_bucket": _KEY_BUCKET,
    "key_partition": f"select *, bucket as partition from ({_KEY_BUCKET})",
    "key_spread": f"""
with k as (select case when event_id % 2 = 0 then -1 else user_id end as caller_id from events),
n as (select caller_id, cast(caller_id as varchar) as s, count(*) as n from k group by caller_id)
select caller_id, bucket, n, case when n > 500 then (n + 499) // 500 else 1 end as partitions,
       case when n <= 500 then bucket end as first_level
from (select caller_id, n, {_CRC_BUCKET} from n)
""",
    "job_top_callers": _CDR_TOP,
    "job_tower_heatmap": _CDR_HEATMAP,
    "job_anomalous_calls": _CDR_ANOMALIES,
    "job_anomalous_calls_split": _CDR_ANOMALIES,
    "job_revenue_recon": _CDR_REVENUE,
    "job_manifests": _CDR_MANIFESTS,
    "kept_rejects": """
with r as (
  select 'USER_' || user_id as caller_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as timestamp,
         length('USER_' || user_id) % 2 = 0 as worded, event_type, value
  from events
)
select caller_id, timestamp, case when worded then value || ' EUR' end as raw_charge, count(*) over () as counted
from r where worded or event_type = 'view'
""",
    "stream_top_callers": _CDR_TOP,
    "stream_tower_heatmap": _CDR_HEATMAP,
    "stream_revenue_recon": _CDR_REVENUE,
}
