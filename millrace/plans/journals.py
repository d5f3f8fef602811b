"""Queries of run logs, API snapshots and exchange batches (R1-R10, R24-R28)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.parsing import json_field
from millrace.operators import anomaly
from millrace.operators import runlog as ops
from millrace.plans import fixtures as fx
from millrace.plans.registry import query

NOW = dt.datetime(2024, 1, 31)
_CALL = "concat('PL/pgSQL function stg.pr_', event_id % 5, '(text) line ', event_id % 90, ' at EXECUTE')"
_SQL = "concat('SQL statement \"select_', event_id % 3, ' from t\"')"


@query(
    "R1_pair_runs",
    fx.with_sql(fx.RUN_LOG)
    + """select a.id as beg_id, a.ts as beg_ts, a.action as beg_action, a.workflow as wf, date_trunc('second', a.ts) as ready,
           cast(0 as bigint) as wait_s, cast(epoch(b.ts) - epoch(a.ts) as bigint) as duration_s, b.id as end_id, b.ts as end_ts, b.action as end_action,
           b.msg, cast(a.extra as varchar) as extra, cast(b.lid as varchar) as lid from run_log a left join run_log b on a.id = b.parent where a.parent is null""",
)
def pair_runs(t):
    out = ops.pair_runs(fx.run_log(t))
    return out.select(
        "beg_id", "beg_ts", "beg_action", "wf", "ready", "wait_s", "duration_s", "end_id", "end_ts", "end_action", "msg",
        json_field("beg_msg", "extra").alias("extra"), json_field("end_msg", "lid").alias("lid"),
    )


@query(
    "R2_run_journal",
    f"""with {fx.RUN_LOG}, {fx.z_table_sql()},
       st as (select id as log_id, lid % 1000 as rw_cnt, ts as data_max from run_log where parent is not null and lid % 3 <> 0),
       zd as (select id as log_id, ts, workflow as object, lid % 61 / 10.0 - 3 as zscore, cast(ts as date) as key_date, lid % 13 as std, lid % 7 as avg from run_log where parent is not null and lid % 2 = 0),
       cf as (select distinct workflow as object, case when cast(substr(workflow, 4) as int) % 2 = 0 then -1.0 end as lo from run_log where cast(substr(workflow, 4) as int) % 3 = 0)
       select a.id as start_id, a.workflow, b.id as end_id, b.action as end_action, cast(epoch(b.ts) - epoch(a.ts) as bigint) as duration_s, rw_cnt as rows_count,
         round(z.zscore, 6) as zscore, z.zscore between coalesce(lo, -3) and 3 as ztest_ok, case when cf.object is not null then z.key_date = date '2024-01-10' end as is_except,
         coalesce(cast(round(p_value * 2 * 100) as int), 0) as confidence, round(std / nullif(avg, 0), 6) as stable
       from run_log a left join run_log b on a.id = b.parent left join st on st.log_id = b.id left join zd z on z.log_id = b.id
       left join ztable p on p.zscore = cast(round(abs(z.zscore), 1) as decimal(3,1)) left join cf on cf.object = z.object where a.parent is null""",
)
def run_journal(t):
    log = fx.run_log(t)
    named = log.withColumn("message", F.when(F.col("parent").isNull(), F.col("workflow")).otherwise(F.col("message")))
    ends = log.where("parent is not null").withColumn("lid", json_field("message", "lid").cast("bigint"))
    stats = ends.where("lid % 3 <> 0").selectExpr("id as log_id", "lid % 1000 as rw_cnt", "ts as data_max")
    newest = ends.where("lid % 2 = 0").selectExpr(
        "id as log_id", "ts", "workflow as object", "cast(lid % 61 as double) / 10 - 3 as zscore", "cast(ts as date) as key_date", "lid % 13 as std", "lid % 7 as avg"
    )
    older = newest.withColumns({"ts": F.expr("timestampadd(DAY, -1, ts)"), "zscore": F.lit(99.0)})
    config = log.select("workflow").distinct().where("cast(substr(workflow, 4) as int) % 3 = 0").selectExpr(
        "workflow as object", "case when cast(substr(workflow, 4) as int) % 2 = 0 then '{\"min\": -1.0}' end as z_cfg", "array(date '2024-01-10') as z_except"
    )
    out = ops.run_journal(named, stats, newest.unionByName(older), config)
    return out.select(
        "start_id", "workflow", "end_id", "end_action", "duration_s", "rows_count", F.round("zscore", 6).alias("zscore"), "ztest_ok", "is_except",
        "confidence", F.round("stable", 6).alias("stable"),
    )


@query(
    "R3_error_chains",
    """with e as (select event_id, 'stg.pr_' || (event_id % 5) as f, 'select_' || (event_id % 3) as q, event_id % 4 as k from events where event_type = 'error')
       select event_id as log_id, case k when 0 then f when 1 then q end as last_call, case k when 0 then f || '->' || f when 1 then 'srv.main->' || f || '->' || q when 2 then 'srv.main' end as calls from e""",
)
def error_chains(t):
    main = "PL/pgSQL function srv.main(json) line 7 at assignment"
    context = f"""case event_id % 4 when 0 then concat_ws(char(10), {_CALL}, {_CALL}) when 1 then concat_ws(char(10), {_SQL}, {_CALL}, '{main}')
      when 2 then concat_ws(char(10), 'no call here', '{main}') end"""
    errors = t.events.where("event_type = 'error'").select(F.col("event_id").alias("log_id"), F.expr(context).alias("context"))
    return ops.error_chains(errors).drop("context")


# --- API snapshots: two versions per load, one load per event ---------------------------------

_ALIVE = "case event_id % 4 when 0 then 'ACTIVE' when 2 then 'ABORTED' else 'COMPLETED' end"
_STATUS = "case event_id % 5 when 0 then 'EVENT-WAIT' when 2 then 'ERROR' when 3 then 'RUNNING' else 'SUCCESS' end"
_RES = "case event_id % 3 when 0 then 1 when 1 then 0 else -9 end"


def load_snapshots(t):
    def at(minutes):
        return f"date_format(timestampadd(MINUTE, cast({minutes} as int), ts), 'yyyy-MM-dd HH:mm:ss')"

    steps = f"""array(named_struct('effective_from', {at('event_id % 20 + event_id % 50')}, 'status', {_STATUS}, 'log', 'last'),
      named_struct('effective_from', {at('0')}, 'status', 'START', 'log', 'first'), named_struct('effective_from', {at('event_id % 20')}, 'status', 'RUNNING', 'log', 'run'))"""
    msg = f"""to_json(named_struct('alive', {{alive}}, 'auto', 'true', 'start_dttm', {at('0')}, 'end_dttm', {at('60 + event_id % 50')}, 'profile', 'HR', 'wf_id', user_id,
      'status', {{status}}, 'status_log', to_json(named_struct('res', {_RES})), 'loading_status', {steps}))"""
    new = t.events.selectExpr(
        "event_id as id", "'loading' as obj", "'/loading' as url", "timestampadd(HOUR, 1, ts) as ts", f"{msg.format(alive=_ALIVE, status=_STATUS)} as msg"
    )
    old = t.events.selectExpr("event_id as id", "'loading' as obj", "'/loading' as url", "ts", f"{msg.format(alive=chr(39) + 'ACTIVE' + chr(39), status=chr(39) + 'START' + chr(39))} as msg")
    return new.unionByName(old)


LOADS = f"""loads as (select event_id as id, ts + to_hours(1) as ts, {_ALIVE} as alive, user_id as wf_id, date_trunc('second', ts) as start_dttm,
  date_trunc('second', ts) + to_minutes(60 + event_id % 50) as end_dttm,
  case when {_ALIVE} = 'ABORTED' then date_trunc('second', ts) + to_minutes(60 + event_id % 50) else date_trunc('second', ts) + to_minutes(event_id % 20 + event_id % 50) end as status_dttm,
  case when {_ALIVE} = 'ABORTED' then 'ABORTED' else {_STATUS} end as status, {_STATUS} as raw_status, {_RES} as res, event_id % 20 as wait_min,
  date_trunc('second', ts) + to_minutes(event_id % 20) as began from events)"""


@query(
    "R4_latest_snapshots",
    "select event_id as id, '/loading' as url, ts + to_hours(1) as ts from events",
)
def latest_snapshots(t):
    return ops.latest_snapshots(load_snapshots(t)).select("id", "url", "ts")


@query(
    "R4_last_message",
    "select 'wf_' || user_id as workflow, max_by(event_type, event_id) as message from events where event_type <> 'error' group by 1",
)
def last_message(t):
    runs = fx.runs(t).select("workflow", F.col("run_id").alias("start_id"), "end_action", "message")
    return ops.last_message(runs, "end")


@query(
    "R5_latest_entities",
    """select c_custkey as id, c_name as name, '/p/' || c_nationkey as path, c_mktsegment as storage, cast(c_nationkey as bigint) as parentid from customer""",
)
def latest_entities(t):
    msg = "to_json(named_struct('name', {name}, 'path', concat('/p/', c_nationkey), 'storage', c_mktsegment, 'parentId', c_nationkey))"
    rows = [
        t.customer.selectExpr("c_custkey as id", f"timestamp '{ts}' as ts", "'entity' as obj", "concat('/entity/', c_custkey) as url", f"{msg.format(name=name)} as msg")
        for ts, name in (("2024-01-01 00:00:00", "'old'"), ("2024-01-02 00:00:00", "c_name"))
    ]
    out = ops.latest_entities(rows[0].unionByName(rows[1]))
    return out.select("id", "name", "path", "storage", "parentid")


@query(
    "R6_latest_loads",
    f"with {LOADS} select id, ts, alive, wf_id, start_dttm, end_dttm, status_dttm, status from loads",
)
def latest_loads(t):
    out = ops.latest_loads(load_snapshots(t))
    return out.select("id", "ts", "alive", "wf_id", "start_dttm", "end_dttm", "status_dttm", "status")


def _api(t):
    """Workflow answers of both shapes, entity lists, statistics and loads."""
    users = t.events.groupBy("user_id").agg(F.min("event_id").alias("e"), F.max("event_id").alias("m"))
    body = """named_struct('id', user_id, 'name', concat('wf_', user_id, {tag}), 'category', concat(case when user_id % 10 = 9 then 'zz' else 'hr' end, '.cat_', user_id % 5),
      'profile', 'HR', 'scheduled', user_id % 4 <> 0, 'deleted', user_id % 7 = 0, 'singleLoading', true, 'engine', 'x', 'type', 'principal', 'eventAwaitStrategy', 'and',
      'statusNotifications', 'n', 'wf_time_sched', named_struct('sched', 'daily'), 'wf_event_sched', if(user_id % 3 = 0, array(
        named_struct('active', 'true', 'profile', 'HR', 'stat_id', '5', 'entity_id', cast(user_id as string)),
        named_struct('active', 'true', 'profile', 'HR', 'stat_id', '5', 'entity_id', cast(user_id + 1000000 as string)),
        named_struct('active', 'false', 'profile', 'HR', 'stat_id', '6', 'entity_id', '1')), null),
      'param', array(named_struct('param', 'wf_interval', 'prior_value', concat(user_id % 3 + 1, ' days')), named_struct('param', 'cost', 'prior_value', '$5')))"""
    ext = "to_json(named_struct('wf', {b}, 'connectedEntities', array(user_id + 1, user_id + 2), 'connectedStats', array()))"
    load = "to_json(named_struct('workflow', {b}))"
    two = [
        users.where(where).selectExpr(
            "user_id as id" if url else "m as id", "'wf' as obj" if url else "'load' as obj", f"timestamp '{ts}' as ts",
            "'/wf/extended' as url" if url else "concat('/loading/', m) as url", f"{(ext if url else load).format(b=body.format(tag=tag))} as msg",
        )
        for where, url, ts, tag in (
            ("user_id % 2 = 0", True, "2024-01-01 00:00:00", "'_old'"),
            ("user_id % 2 = 0", True, "2024-01-02 00:00:00", "''"),
            ("user_id % 4 <> 1", False, "2024-01-01 12:00:00", "'_l'"),
        )
    ]
    entity = users.selectExpr(
        "user_id + 1 as id", "'entity' as obj", "timestamp '2024-01-01 00:00:00' as ts", "concat('/entity/wf/', user_id) as url",
        "to_json(named_struct('name', concat('ent', user_id))) as msg",
    )
    stat = users.selectExpr(
        "e as id", "'statval' as obj", "timestamp '2024-01-01 00:00:00' as ts", "'/statval' as url",
        "to_json(named_struct('entity_id', cast(user_id as string), 'stat_id', '5', 'profile', 'HR')) as msg",
    )
    every = load_snapshots(t).select("id", "obj", "ts", "url", "msg")
    for frame in (*two, entity, stat):
        every = every.unionByName(frame.select("id", "obj", "ts", "url", "msg"))
    return every


@query(
    "R7_workflow_catalogue",
    """with u as (select user_id, min(event_id) as e from events group by 1),
       ends as (select user_id, date_trunc('second', ts) + to_minutes(60 + event_id % 50) as fin from events where event_id in (select e from u)),
       c as (select u.user_id as id, e, u.user_id % 2 = 0 as ext from u where (u.user_id % 2 = 0 or u.user_id % 4 <> 1) and u.user_id % 10 <> 9)
       select c.id, case when ext then 'wf_' || c.id else 'wf_' || c.id || '_l' end as name, 'hr.cat_' || (c.id % 5) as category, c.id % 4 <> 0 as scheduled, c.id % 7 = 0 as deleted,
         case when ext then (c.id + 1) || ': ' || 'ent' || c.id || ', ' || (c.id + 2) || ': ' || case when c.id + 1 in (select user_id from u) then 'ent' || (c.id + 1) else '' end
           else (c.id + 1) || ': ent' || c.id end as connected,
         case when c.id % 3 = 0 then 'and: HR [5] {' || (c.id + 1000000) || ' (), ' || c.id || ' (' || strftime(fin, '%Y-%m-%d %H:%M:%S') || ')}' else 'sched: daily' end as wf_sched,
         'wf_interval: ' || (c.id % 3 + 1) || ' days; cost: %5' as param, (c.id % 3 + 1) * 86400 as wf_interval_s
       from c join ends on ends.user_id = c.id""",
)
def workflow_catalogue(t):
    out = ops.workflow_catalogue(_api(t), "hr")
    return out.select("id", "name", "category", "scheduled", "deleted", "connected", "wf_sched", "param", "wf_interval_s")


# --- exchange ---------------------------------------------------------------------------------

_XLOG = """xlog as (select event_id % 500 as id, ts, 'x_' || (user_id % 3) as wf_name, strftime(ts, '%Y-%m-%d') as wf_key, cast(user_id % 2 as bigint) as cnt,
  case when event_id % 9 = 0 then null else cast(user_id % 4 as bigint) end as sum_len, 60 * (event_id % 3) as time_s from events)"""
_BATCHES = f"""{_XLOG}, batches as (select wf_name, id, wf_key, min(cnt) as cnt, min(sum_len) as sum_len, cast(sum(time_s) as bigint) as time_s, min(ts) as ts,
  count(*) = 2 and max(cnt) = min(cnt) and max(sum_len) is not distinct from min(sum_len) as completed,
  case when count(*) <> 2 then count(*) end as n_note from xlog group by 1, 2, 3)"""
_STATE = f"""{LOADS}, states as (select id as lid, status_dttm, alive, status from loads),
  retry_of as (select b.*, alive, status, status_dttm, (case when alive <> 'ACTIVE' then alive end in ('COMPLETED', 'ABORTED') and (status <> 'SUCCESS' or not completed))
    or (not completed and ts < timestamp '2024-01-31' - interval 30 minute) as retry from batches b left join states on lid = id)"""


def _exchange_log(t):
    return t.events.selectExpr(
        "event_id % 500 as id", "ts", "concat('x_', user_id % 3) as wf_name", "date_format(ts, 'yyyy-MM-dd') as wf_key",
        "to_json(named_struct('type', 'OUT', 'cnt', user_id % 2, 'sum_len', case when event_id % 9 = 0 then null else user_id % 4 end, 'time', concat('00:0', event_id % 3, ':00'))) as wf_data",
    )


@query("R8_exchange_batches", f"with {_BATCHES} select * from batches")
def exchange_batches(t):
    out = ops.exchange_batches(_exchange_log(t))
    return out.select(
        "wf_name", "id", "wf_key", "cnt", "sum_len", "time_s", "ts", "completed", json_field("wf_data", "count").cast("bigint").alias("n_note")
    )


def _exchange(t):
    return ops.exchange_batches(_exchange_log(t)), ops.latest_loads(load_snapshots(t))


@query(
    "R9_exchange_ids",
    f"""with {_BATCHES}, {LOADS}, g as (select wf_name, id, min(cast(completed as int)) = 1 as completed, max(ts) as ts, count(wf_key) as keys_cnt, cast(sum(cnt) as bigint) as cnt,
          cast(sum(sum_len) as bigint) as sum_len, max(time_s) as time_s from batches group by 1, 2)
        select wf_name, g.id, completed, g.ts, keys_cnt, cnt, sum_len, time_s, alive, status,
          (case when alive <> 'ACTIVE' then alive end in ('COMPLETED', 'ABORTED') and (status <> 'SUCCESS' or not completed)) or (not completed and g.ts < timestamp '2024-01-31' - interval 30 minute) as retry
        from g left join loads l on l.id = g.id""",
)
def exchange_ids(t):
    out = ops.exchange_ids(*_exchange(t), NOW)
    return out.drop("status_dttm", "auto", "status_log")


@query(
    "R9_attempts",
    f"with {_BATCHES} select wf_name, id, wf_key, max(ts) as ts from batches where wf_key is not null group by 1, 2, 3",
)
def attempts(t):
    return ops.attempts(ops.exchange_batches(_exchange_log(t)))


@query(
    "R10_exchange_keys",
    f"""with {_BATCHES}, {_STATE},
        best as (select * from retry_of where completed or retry is not null qualify row_number() over (partition by wf_name, wf_key order by id desc) = 1),
        n as (select wf_name, wf_key, count(*) as ids_cnt, min(id) as first_id from batches group by 1, 2)
        select b.wf_name, b.wf_key, completed, retry, ts as last_ts, id as last_id, first_id, ids_cnt, cnt, alive, status from best b join n on n.wf_name = b.wf_name and n.wf_key = b.wf_key""",
)
def exchange_keys(t):
    out = ops.exchange_keys(*_exchange(t), NOW)
    return out.select(
        "wf_name", "wf_key", "completed", "retry", "last_ts", "last_id", "first_id", "ids_cnt", "cnt", "alive", "status"
    )


# --- delivery, retention, outcome ---------------------------------------------------------------

_MAIL = """mail as (select 3 * event_id + 3 as id, cast(null as bigint) as parent, ts, 'rep_' || (user_id % 4) as action from events
  union all select 3 * event_id + 4, 3 * event_id + 3, ts + to_minutes(2), 'end' from events where event_id % 5 <> 0
  union all select 3 * event_id + 5, 3 * event_id + 3, ts + to_minutes(event_id % 30), 'send' from events where event_id % 3 = 0)"""


def _mail(t):
    a = t.events.selectExpr("3 * event_id + 3 as id", "cast(null as bigint) as parent", "ts", "concat('rep_', user_id % 4) as action")
    b = t.events.where("event_id % 5 <> 0").selectExpr("3 * event_id + 4 as id", "3 * event_id + 3 as parent", "timestampadd(MINUTE, 2, ts) as ts", "'end' as action")
    c = t.events.where("event_id % 3 = 0").selectExpr(
        "3 * event_id + 5 as id", "3 * event_id + 3 as parent", "timestampadd(MINUTE, cast(event_id % 30 as int), ts) as ts", "'send' as action"
    )
    return a.unionByName(b).unionByName(c)


@query(
    "R24_delivery_state",
    fx.with_sql(_MAIL)
    + """select a.id, a.parent, a.ts, a.action, coalesce(a.parent, a.id) as head, b.ts is not null as is_end, c.ts is not null as is_send, cast(epoch(c.ts) - epoch(a.ts) as bigint) as send_s
         from mail a left join mail b on b.parent = coalesce(a.parent, a.id) and b.action = 'end' left join mail c on c.parent = coalesce(a.parent, a.id) and c.action = 'send'""",
)
def delivery_state(t):
    return ops.delivery_state(_mail(t))


@query("R24_unsent_finished", "select 3 * event_id + 3 as id, ts, 'rep_' || (user_id % 4) as action from events where event_id % 5 <> 0 and event_id % 3 <> 0")
def unsent(t):
    return ops.unsent_finished(_mail(t))


@query(
    "R25_retained",
    fx.with_sql(fx.RUN_LOG)
    + """select id, parent, ts, action from run_log where id not in (select unnest([a.id, b.id]) from run_log a join run_log b on a.id = b.parent
         where a.ts < timestamp '2024-01-15' and b.action in ('end'))""",
)
def retained(t):
    return ops.retained(fx.run_log(t), dt.datetime(2024, 1, 15), ["end"]).select("id", "parent", "ts", "action")


@query(
    "R26_repeated_executions",
    """with r as (select event_id, user_id, cast(ts as date) as ready from events)
       select event_id, user_id, ready from r where (user_id, ready) in (select (user_id, ready) from r group by user_id, ready having count(*) > 1)""",
)
def repeated(t):
    runs = t.events.selectExpr("event_id", "user_id", "cast(ts as date) as ready")
    return ops.repeated_executions(runs, "user_id", "ready")


@query(
    "R27_staleness",
    """with m as (select max(ts) as m from events) select 'a' as feed, m as max_ts, cast(case when epoch(timestamp '2024-01-31') - epoch(m) < 120 then 1 when epoch(timestamp '2024-01-31') - epoch(m) < 90000 then 0 else -1 end as int) as res from m
       union all select 'b', m, cast(case when epoch(timestamp '2024-01-31') - epoch(m) < 120 then 1 else -3 end as int) from m""",
)
def staleness(t):
    a = ops.staleness(t.events, "ts", NOW, 120, 90000).select(F.lit("a").alias("feed"), "*")
    return a.unionByName(ops.staleness(t.events, "ts", NOW, 120, None, -3).select(F.lit("b").alias("feed"), "*"))


@query(
    "R28_outcome_code",
    """select event_id, cast([1, 1, 0, -1, -3, -2, -4, -5, -8, -9, 7, -6, -9][event_id % 13 + 1] as int) as code from events""",
)
def outcome_code(t):
    texts = [
        "", "Ok loaded", "No New data", "EMPTY src", "expire 3", "x query_canceled or statement_timeout", "Uniq check errors = 3", "Ztest error {}",
        "PXF server error 500", "oops", '{"result": 7, "res": 1}', '{"res": "-6"}', '{"other": 1}',
    ]
    arr = F.array(*[F.lit(x) for x in texts])
    rows = t.events.select("event_id", F.get(arr, (F.col("event_id") % 13).cast("int")).alias("text"))
    return rows.select("event_id", ops.outcome_code("text").alias("code"))
