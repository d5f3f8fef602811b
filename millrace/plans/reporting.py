"""Queries of the report sections (R11-R23)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import reports as ops
from millrace.operators import runlog
from millrace.plans import fixtures as fx
from millrace.plans.anomalies import _ROW_TOTALS, _row_totals
from millrace.plans.journals import _BATCHES, LOADS, NOW, _exchange_log, load_snapshots
from millrace.plans.registry import query

DAY = dt.date(2024, 1, 20)

_CATALOGUE = """cat as (select distinct user_id as wf, 'hr.cat_' || (user_id % 5) as category, 'wf_' || user_id as name, case when user_id % 2 = 0 then 'HR' else 'X' end as wf_profile,
  user_id % 4 <> 0 as scheduled, user_id % 7 = 0 as deleted, (user_id % 3 + 1) * 86400 as interval_s from events)"""


def _catalogue(t):
    return t.events.select("user_id").distinct().selectExpr(
        "user_id as id", "concat('hr.cat_', user_id % 5) as category", "concat('wf_', user_id) as name", "if(user_id % 2 = 0, 'HR', 'X') as profile",
        "user_id % 4 <> 0 as scheduled", "user_id % 7 = 0 as deleted", "'s' as wf_sched", "'c' as connected", "(user_id % 3 + 1) * 86400 as wf_interval_s",
    )


def _loads(t):
    return runlog.latest_loads(load_snapshots(t))


@query(
    "R11_status_board",
    f"""with {LOADS}, {_CATALOGUE}, r as (select split_part(category, '.', 2) as category, wf_id, alive, res, epoch(timestamp '2024-01-31') - epoch(status_dttm) as age, interval_s
          from loads join cat on wf = wf_id where not deleted and (status_dttm >= timestamp '2024-01-28' or alive = 'ACTIVE')),
        b as (select category, grouping(category) as is_total,
          count(distinct case when alive = 'ACTIVE' then wf_id end) as active, count(distinct case when alive = 'COMPLETED' then wf_id end) as completed,
          count(distinct case when res > 0 then wf_id end) as cnt_ok, count(distinct case when res = 0 then wf_id end) as cnt_no, count(distinct case when res < 0 then wf_id end) as cnt_err,
          count(distinct case when alive in ('ACTIVE', 'COMPLETED') then wf_id end) - count(distinct case when alive = 'COMPLETED' then wf_id end) as waited,
          count(distinct case when alive = 'ACTIVE' and age between interval_s and interval_s * 2 then wf_id end) as delayed,
          count(distinct case when alive = 'ACTIVE' and age > interval_s * 2 then wf_id end) as expired from r group by rollup(category))
        select category, cast(is_total as int) as is_total, nullif(active, 0) as active, nullif(completed, 0) as completed, nullif(cnt_ok, 0) as cnt_ok, nullif(cnt_no, 0) as cnt_no,
          nullif(cnt_err, 0) as cnt_err, nullif(waited, 0) as waited, nullif(delayed, 0) as delayed, nullif(expired, 0) as expired from b""",
)
def status_board(t):
    return ops.status_board(_loads(t), _catalogue(t), dt.datetime(2024, 1, 28), NOW)


_PIVOT = "count(*) as wf_cnt, cast(sum(duration_s) as bigint) as sum_s, min(duration_s) as min_s, max(duration_s) as max_s, round(avg(duration_s), 3) as avg_s, " + ", ".join(
    f"nullif(count(*) filter (res = {code}), 0) as {name}" for code, name in ops.OUTCOMES.items()
)
_DAY_RUNS = "day_runs as (select * from runs where start_ts >= timestamp '2024-01-20' and start_ts < timestamp '2024-01-21')"


def _day_runs(t):
    return ops.within(fx.runs(t), "start_ts", dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 21))


@query("R12_outcome_pivot", fx.with_sql(fx.RUNS) + f"select res, category, 'wf' as wf_prefix, {_PIVOT} from runs group by 1, 2")
def outcome_pivot(t):
    return ops.outcome_pivot(fx.runs(t))


@query(
    "R12_outcome_pivot_with_total",
    fx.with_sql(fx.RUNS, _DAY_RUNS) + f"select category, cast(grouping(category) as int) as is_total, {_PIVOT} from day_runs group by grouping sets ((category), ())",
)
def outcome_total(t):
    return ops.outcome_pivot(_day_runs(t), ["category"], total=True)


_CELLS = ", ".join(
    f"coalesce(max(case when m = {m} then n end), 0) as cnt_{m:02d}, round(coalesce(max(case when m = {m} then rate end), 0), 2) as rate_{m:02d}" for m in range(0, 60, 10)
)


@query(
    "R13_concurrency_load",
    fx.with_sql(fx.RUNS)
    + f"""select cast(hour(d) as int) as hour, {_CELLS} from (
          select d, minute(d) as m, count(distinct workflow) as n, sum(epoch(least(end_ts, d + interval 10 minute)) - epoch(greatest(start_ts, d))) / (600 * 4) as rate
          from (select unnest(generate_series(timestamp '2024-01-20', timestamp '2024-01-20 23:59:00', interval 10 minute)) as d) s
          left join (select workflow, to_timestamp(floor(epoch(start_ts)))::timestamp as start_ts, to_timestamp(floor(epoch(end_ts)))::timestamp as end_ts from runs) r
            on r.start_ts < d + interval 10 minute and r.end_ts > d group by 1) group by 1""",
)
def concurrency_load(t):
    return ops.concurrency_load(fx.runs(t), DAY, 4)


@query(
    "R14_failures_with_last_success",
    fx.with_sql(fx.RUNS)
    + """select run_id, r.workflow, res, last_ok from runs r left join (select workflow, max(start_ts) as last_ok from runs where res = 1 and category <> 'cat_3' group by 1) o
         on o.workflow = r.workflow where res not in (1, 0) and category <> 'cat_3' and end_ts >= timestamp '2024-01-20'""",
)
def failures(t):
    out = ops.failures_with_last_success(fx.runs(t), ~F.col("res").isin(1, 0), dt.datetime(2024, 1, 20), skip_category="cat_3")
    return out.select("run_id", "workflow", "res", "last_ok")


@query(
    "R14_no_data_with_last_success",
    fx.with_sql(fx.RUNS)
    + """select run_id, r.workflow, last_ok from runs r left join (select workflow, max(start_ts) as last_ok from runs where res = 1 group by 1) o on o.workflow = r.workflow
         where res = 0 and end_ts >= timestamp '2024-01-20'""",
)
def no_data(t):
    out = ops.failures_with_last_success(fx.runs(t), F.col("res") == 0, dt.datetime(2024, 1, 20))
    return out.select("run_id", "workflow", "last_ok")


@query(
    "R15_long_runs",
    fx.with_sql(fx.RUNS)
    + "select run_id, duration_s from runs where res = 1 and duration_s >= 1800 and end_ts >= timestamp '2024-01-20'",
)
def long_runs(t):
    return ops.long_runs(fx.runs(t), dt.datetime(2024, 1, 20)).select("run_id", "duration_s")


@query(
    "R15_runs_of_category",
    fx.with_sql(fx.RUNS) + "select run_id, end_ts from runs where res = 1 and category = 'cat_2' and end_ts >= timestamp '2024-01-20'",
)
def runs_of(t):
    return ops.runs_of(fx.runs(t), dt.datetime(2024, 1, 20), 1, "cat_2").select("run_id", "end_ts")


@query(
    "R16_error_rollup",
    """with e as (select event_id, ts, 'o' || (user_id % 6) as obj, event_type as msg from events where event_type in ('error', 'click') and ts >= timestamp '2024-01-19' and ts < timestamp '2024-01-21')
       select 'log' as src, date_trunc('second', ts) as first_dt, date_trunc('second', ts) + to_hours(1) as last_dt, event_id % 9 as cnt, obj, msg from e where event_id % 4 = 0
       union all select 'tbl', min(ts), max(ts), count(*), obj, msg from e where event_id % 4 <> 0 group by obj, msg""",
)
def error_rollup(t):
    at = "date_format(timestampadd(HOUR, {h}, ts), 'yyyy-MM-dd HH:mm:ss')"
    done = f"to_json(named_struct('obj', concat('o', user_id % 6), 'msg', event_type, 'first', {at.format(h=0)}, 'last', {at.format(h=1)}, 'cnt', event_id % 9))"
    raw = "to_json(named_struct('obj', concat('o', user_id % 6), 'msg', event_type))"
    log = t.events.selectExpr(
        "ts", "case when event_type in ('error', 'click') then 'error' else 'end' end as action", f"case when event_id % 4 = 0 then {done} else {raw} end as message"
    )
    return ops.error_rollup(log, dt.datetime(2024, 1, 19), dt.datetime(2024, 1, 21))


@query(
    "R17_stuck_loads",
    f"""with {LOADS}, {_CATALOGUE} select id, status_dttm, cast(epoch(timestamp '2024-01-31') - epoch(status_dttm) as bigint) as status_s, status || ': {{"res":' || res || '}}' as status_info, wf_id, name
        from loads join cat on wf = wf_id where alive = 'ACTIVE' and wf_profile = 'HR' and (epoch(timestamp '2024-01-31') - epoch(start_dttm) > interval_s or status not in ('EVENT-WAIT', 'TIME-WAIT'))""",
)
def stuck(t):
    out = ops.stuck_loads(_loads(t), _catalogue(t), NOW, "hr", "HR")
    return out.select("id", "status_dttm", "status_s", "status_info", "wf_id", "name")


@query(
    "R17_error_loads",
    f"""with {LOADS}, {_CATALOGUE} select id, alive, status_dttm, wf_id, name from loads join cat on wf = wf_id where status = 'ERROR' and category = 'hr.cat_2'
        and (epoch(timestamp '2024-01-31') - epoch(end_dttm) < 86400 or (alive = 'ACTIVE' and epoch(timestamp '2024-01-31') - epoch(status_dttm) < 30 * 86400))""",
)
def error_loads(t):
    return ops.error_loads(_loads(t), _catalogue(t), "hr.cat_2", NOW).select("id", "alive", "status_dttm", "wf_id", "name")


@query("R17_active_loads", f"with {LOADS}, {_CATALOGUE} select id, status, name from loads join cat on wf = wf_id where alive = 'ACTIVE' and category like 'hr%'")
def active_loads(t):
    return ops.active_loads(_loads(t), _catalogue(t), "hr").select("id", "status", "name")


@query("R17_not_scheduled", f"with {_CATALOGUE} select wf as id, category from cat where not scheduled and not deleted and category like 'hr%' and category <> 'hr.cat_1'")
def not_scheduled(t):
    return ops.not_scheduled(_catalogue(t), "hr", "hr.cat_1").select("id", "category")


@query(
    "R18_status_timeline",
    f"""with {LOADS}, {_CATALOGUE}, steps as (select id, start_dttm as d, 'START' as s, 1 as k from loads union all select id, began, 'RUNNING', 2 from loads
          union all select id, start_dttm + to_minutes(wait_min) + to_minutes(id % 50), raw_status, 3 from loads),
        numbered as (select id, d, s, row_number() over (partition by id order by d, s) as nn from steps)
        select n.id, name, cast(nn as int) as nn, d as status_dttm, s as status from numbered n join loads l on l.id = n.id join cat on wf = wf_id
        where alive <> 'ACTIVE' and category like 'hr%' and cast(l.status_dttm as date) = date '2024-01-20'""",
)
def timeline(t):
    return ops.status_timeline(_loads(t), _catalogue(t), DAY, "hr").select("id", "name", "nn", "status_dttm", "status")


_LOAD_TIMES = """select l.id, alive, status_dttm, cast(wait_min * 60 as bigint) as wait_s, cast(epoch(status_dttm) - epoch(began) as bigint) as run_s, status, wf_id, wf_name, keys_cnt, completed
  from loads l left join (select wf_name, id, count(*) as keys_cnt, min(cast(completed as int)) = 1 as completed from batches group by 1, 2) x on x.id = l.id"""


def _exchange_ids(t):
    return runlog.exchange_ids(runlog.exchange_batches(_exchange_log(t)), _loads(t), NOW)


def _times(t, errors):
    out = ops.load_times(_loads(t), _catalogue(t), _exchange_ids(t), "hr.cat_2", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 21), errors)
    return out.select("id", "alive", "status_dttm", "wait_s", "run_s", "status", "wf_id", "wf_name", "keys_cnt", "completed")


def _times_sql(where):
    return f"""with {_BATCHES}, {LOADS}, {_CATALOGUE}, w as ({_LOAD_TIMES})
      select w.* from w join cat on wf = wf_id where category = 'hr.cat_2' and status_dttm between timestamp '2024-01-05' and timestamp '2024-01-21' and {where}
      qualify dense_rank() over (partition by wf_id order by w.id desc) = 1"""


@query("R19_load_times", _times_sql("status not in ('EVENT-WAIT', 'TIME-WAIT', 'ABORTED') and alive <> 'ACTIVE'"))
def load_times(t):
    return _times(t, False)


@query("R19_load_errors", _times_sql("(status in ('ABORTED', 'ERROR', 'ERRORCHECK') or alive = 'ABORTED')"))
def load_errors(t):
    return _times(t, True)


@query(
    "R19_exchange_times",
    f"""with {_BATCHES}, {LOADS}, g as (select wf_name, id, max(ts) as ts, count(*) as keys_cnt from batches group by 1, 2)
        select g.wf_name, g.id, g.ts, keys_cnt, cast(wait_min * 60 as bigint) as wait_s, cast(epoch(status_dttm) - epoch(began) as bigint) as run_s
        from g left join loads l on l.id = g.id where g.ts >= timestamp '2024-01-20'
        qualify row_number() over (partition by g.wf_name order by g.ts desc) = 1""",
)
def exchange_times(t):
    out = ops.exchange_times(_exchange_ids(t), _loads(t), dt.datetime(2024, 1, 20))
    return out.select("wf_name", "id", "ts", "keys_cnt", "wait_s", "run_s")


@query(
    "R20_latest_actions",
    fx.with_sql(fx.RUNS)
    + """select workflow, 'start' as start_action, end_action, run_id, start_ts from runs where start_ts > timestamp '2024-01-05' and workflow like 'wf_1%'
         qualify row_number() over (partition by workflow, end_action order by start_ts desc, run_id desc) = 1""",
)
def latest_actions(t):
    journal = fx.runs(t).withColumn("start_action", F.lit("start"))
    out = ops.latest_actions(journal, dt.datetime(2024, 1, 5), "wf_1")
    return out.select("workflow", "start_action", "end_action", "run_id", "start_ts")


def _keyed_journal(t):
    """Key dates that stay put for several days: date rounded down to a step of the object's own size."""
    return t.events.selectExpr(
        "concat('tb_', user_id) as object", "ts",
        "date_add(date '2024-01-01', cast(floor(datediff(cast(ts as date), date '2024-01-01') / (user_id % 12 + 1)) * (user_id % 12 + 1) as int)) as key_date",
        "cast(floor(datediff(cast(ts as date), date '2024-01-01') / (user_id % 7 + 1)) as bigint) as rows_count",
    )


_KEYED = """j as (select 'tb_' || user_id as object, ts, cast(ts as date) as day,
  date '2024-01-01' + cast(floor((cast(ts as date) - date '2024-01-01') / (user_id % 12 + 1)) * (user_id % 12 + 1) as int) as key_date,
  cast(floor((cast(ts as date) - date '2024-01-01') / (user_id % 7 + 1)) as bigint) as rows_count from events where ts > timestamp '2024-01-02')"""


def _repeat_sql(source, value, longer, listed=False):
    texts = "string_agg(distinct t, '; ' order by t)" if listed else "null"
    return fx.with_sql(_KEYED) + f"""select object, {value}, {"texts as rows_counts," if listed else ""} ts, last_day, key_from, cast(days as int) as days, cnt, cnt_uniq, cnt - cnt_uniq as not_uniq, round((cnt - days) / (cnt_uniq - 1), 1) as avg_uniq,
      max_days, round(days * (cnt_uniq - 1) / (cnt - days), 1) as ratio from (
      select m.*, len(list_filter(keys, lambda k: k > coalesce(nxt, lo - 1))) as days, list_min(list_filter(keys, lambda k: k > coalesce(nxt, lo - 1))) as key_from from (
        select *, row_number() over w as rn, lead(last_day) over w as nxt, cast(sum(n) over o as bigint) as cnt, cast(max(len(keys)) over o as int) as max_days, count({value}) over o as cnt_uniq from (
          select object, {value}, list(day) as keys, min(day) as lo, max(day) as last_day, max(ts) as ts, count(*) as n, {texts} as texts
            from (select *, replace(format('{{:,}}', rows_count), ',', ' ') as t from ({source})) group by 1, 2)
        window w as (partition by object order by last_day desc), o as (partition by object)) m
      where len(keys) > 1 and rn = 1 and ts >= timestamp '2024-01-28') where days > 1 and cnt_uniq > 1 {longer}"""


@query(
    "R21_repeated_key_dates",
    _repeat_sql("select * from j qualify row_number() over (partition by object, day order by key_date desc, ts desc) = 1", "key_date", "", listed=True),
)
def repeated_key_dates(t):
    return ops.repeated_key_dates(_keyed_journal(t), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 30))


@query(
    "R22_repeated_row_counts",
    _repeat_sql(
        "select object, ts, key_date as day, rows_count from j qualify row_number() over (partition by object, key_date order by ts desc) = 1",
        "rows_count",
        "and days > (cnt - days) / (cnt_uniq - 1)",
    ),
)
def repeated_row_counts(t):
    return ops.repeated_row_counts(_keyed_journal(t), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 30))


def _view(t):
    return _row_totals(t).select(
        F.concat(F.lit("tb_"), "user_id").alias("object"), "ts", "key_date", "log_id", F.coalesce("ztest", F.lit(True)).alias("ztest_ok")
    )


@query(
    "R23_latest_failures",
    fx.with_sql(_ROW_TOTALS)
    + """select 'tb_' || user_id as object, ts, log_id from (select * from totals qualify row_number() over (partition by user_id order by ts desc) = 1)
         where not coalesce(ztest, true) and epoch(timestamp '2024-01-31') - epoch(ts) <= 96 * 3600""",
)
def latest_failures(t):
    return ops.latest_failures(_view(t), NOW, 96).select("object", "ts", "log_id")


@query(
    "R23_failure_details",
    fx.with_sql(_ROW_TOTALS)
    + """, head as (select user_id as u, row_number() over (order by last desc, 'tb_' || user_id) as n from (select user_id, max(ts) as last from totals where not coalesce(ztest, true) and ts >= timestamp '2024-01-20' group by 1)
           order by last desc, 'tb_' || user_id)
         select cast(n as int) as n, 'tb_' || user_id as object, log_id, cast(nn as int) as nn from (select h.n, t.*, dense_rank() over (partition by user_id order by ts desc) as nn from totals t join head h on h.u = t.user_id)""",
)
def failure_details(t):
    return ops.failure_details(_view(t), dt.datetime(2024, 1, 20)).select("n", "object", "log_id", "nn")
