"""Frames that Spark derives from the given tables, each with the same rule as SQL text.

Every rule covers the whole table.  Integer arithmetic is written so that both engines agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.ordered import previous_row
from millrace.operators.anomaly import z_table_rows
from millrace.plans.registry import Tables

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "price", "o_orderdate", "o_orderpriority"]


def _orders(t: Tables, status: str = "o_orderstatus") -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey",
        "o_custkey",
        f"{status} as o_orderstatus",
        "cast(o_totalprice as decimal(15,2)) as price",
        "cast(o_orderdate as date) as o_orderdate",
        "o_orderpriority",
    )


_ORDERS_SQL = """select o_orderkey, o_custkey, {status} as o_orderstatus, cast(o_totalprice as decimal(15,2)) as price,
  cast(o_orderdate as date) as o_orderdate, o_orderpriority"""
_CHANGED = "case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end"


def orders_old(t: Tables) -> DataFrame:
    return _orders(t).where("o_orderkey % 3 <> 0").withColumn("load_date", F.lit("2024-01-01").cast("date"))


def orders_new(t: Tables) -> DataFrame:
    return _orders(t, _CHANGED).where("o_orderkey % 2 = 0").withColumn("load_date", F.lit("2024-01-08").cast("date"))


ORDERS_OLD = f"""orders_old as ({_ORDERS_SQL.format(status='o_orderstatus')}, date '2024-01-01' as load_date
  from orders where o_orderkey % 3 <> 0)"""
ORDERS_NEW = f"""orders_new as ({_ORDERS_SQL.format(status=_CHANGED)}, date '2024-01-08' as load_date
  from orders where o_orderkey % 2 = 0)"""


def hash_sql(columns: list[str]) -> str:
    """The default row hash as DuckDB SQL."""
    parts = ", ".join(f"coalesce(cast({c} as varchar), chr(2))" for c in columns)
    return f"md5(concat_ws(chr(1), {parts}))"


def orders_text(t: Tables) -> DataFrame:
    """Every column as text with blanks and empty dates injected; ctl_loading is a batch number."""
    return t.orders.selectExpr(
        "concat(date_format(o_orderdate, 'yyyyMMdd'), '101500') as hexportid",
        "concat('P', date_format(o_orderdate, 'yyyyMMdd')) as hexpperio",
        "case when o_orderkey % 7 = 0 then '' when o_orderkey % 11 = 0 then ' ' else cast(o_custkey as string) end as cust",
        "case when o_orderkey % 13 = 0 then '00000000' else date_format(o_orderdate, 'yyyyMMdd') end as odate",
        "case when o_orderkey % 4 = 0 then 'X' when o_orderkey % 4 = 1 then '1' else '0' end as flag",
        "case when o_orderkey % 11 = 0 then '' else o_orderpriority end as priority",
        "o_orderkey",
        "o_orderkey % 50 as ctl_loading",
    )


ORDERS_TEXT = """orders_text as (select strftime(o_orderdate, '%Y%m%d') || '101500' as hexportid,
  'P' || strftime(o_orderdate, '%Y%m%d') as hexpperio,
  case when o_orderkey % 7 = 0 then '' when o_orderkey % 11 = 0 then ' ' else cast(o_custkey as varchar) end as cust,
  case when o_orderkey % 13 = 0 then '00000000' else strftime(o_orderdate, '%Y%m%d') end as odate,
  case when o_orderkey % 4 = 0 then 'X' when o_orderkey % 4 = 1 then '1' else '0' end as flag,
  case when o_orderkey % 11 = 0 then '' else o_orderpriority end as priority,
  o_orderkey, o_orderkey % 50 as ctl_loading from orders)"""


def part_nulls(t: Tables) -> DataFrame:
    return t.part.withColumn(
        "p_brand", F.expr("case p_partkey % 10 when 0 then null when 1 then '' when 2 then ' ' else p_brand end")
    )


PART_NULLS = """part_nulls as (select * replace (
  case p_partkey % 10 when 0 then null when 1 then '' when 2 then ' ' else p_brand end as p_brand) from part)"""


def daily_counts(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))


DAILY_COUNTS = "daily_counts as (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2)"


def z_table_sql() -> str:
    rows = ", ".join(f"({z}, {p})" for z, p in z_table_rows())
    return f"ztable as (select cast(z as decimal(3,1)) as zscore, cast(p as decimal(6,5)) as p_value from (values {rows}) v(z, p))"


def intervals(t: Tables, overlaps: bool = True) -> DataFrame:
    """Per user: each event starts an interval that ends the day before the next event."""
    events = t.events.select("user_id", "event_id", "event_type", "ts")
    linked = previous_row(events, ["user_id"], ["ts", "event_id"], {"next_ts": "ts"}, F.date_trunc("hour", "ts"), ahead=True)
    ends = linked.selectExpr(
        "user_id",
        "event_id",
        "event_type",
        "cast(ts as date) as date_start",
        "coalesce(date_sub(cast(next_ts as date), 1), date '9999-12-31') as date_finish",
    )
    kept = ends.where("date_start <= date_finish")
    if not overlaps:
        return kept
    longer = F.when(
        (F.col("user_id") % 10 == 0) & (F.col("date_finish") < F.lit("9999-01-01").cast("date")),
        F.date_add("date_finish", 3),
    ).otherwise(F.col("date_finish"))
    return kept.withColumn("date_finish", longer)


def intervals_sql(overlaps: bool = True) -> str:
    finish = (
        "case when user_id % 10 = 0 and date_finish < date '9999-01-01' then date_finish + 3 else date_finish end"
        if overlaps
        else "date_finish"
    )
    return f"""intervals as (select user_id, event_id, event_type, date_start, {finish} as date_finish from (
  select user_id, event_id, event_type, cast(ts as date) as date_start,
    coalesce(cast(lead(ts) over (partition by user_id order by ts, event_id) as date) - 1, date '9999-12-31') as date_finish
  from events) where date_start <= date_finish)"""


def run_log(t: Tables) -> DataFrame:
    """Start and end rows of simulated runs: one run per event, workflow = user."""
    start = t.events.selectExpr(
        "2 * event_id + 1 as id",
        "cast(null as bigint) as parent",
        "ts",
        "'start' as action",
        "concat('wf_', user_id) as workflow",
        "to_json(named_struct('wf', concat('wf_', user_id), 'wf_id', user_id, 'ready', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'extra', event_id % 7)) as message",
    )
    end = t.events.selectExpr(
        "2 * event_id + 2 as id",
        "2 * event_id + 1 as parent",
        "timestampadd(MINUTE, cast(event_id % 90 as int), ts) as ts",
        "case when event_type = 'error' then 'error' else 'end' end as action",
        "concat('wf_', user_id) as workflow",
        "to_json(named_struct('res', case event_type when 'error' then -9 when 'view' then 0 else 1 end, 'lid', event_id, 'msg', event_type)) as message",
    )
    return start.unionByName(end)


RUN_LOG = """run_log as (
  select 2 * event_id + 1 as id, cast(null as bigint) as parent, ts, 'start' as action, 'wf_' || user_id as workflow,
    null as res, cast(null as bigint) as lid, null as msg, user_id as wf_id, event_id % 7 as extra from events
  union all
  select 2 * event_id + 2, 2 * event_id + 1, ts + to_minutes(event_id % 90),
    case when event_type = 'error' then 'error' else 'end' end, 'wf_' || user_id,
    case event_type when 'error' then -9 when 'view' then 0 else 1 end, event_id, event_type, null, null from events)"""


def runs(t: Tables) -> DataFrame:
    """Paired runs: one row per event."""
    return t.events.selectExpr(
        "2 * event_id + 1 as run_id",
        "user_id as wf_id",
        "concat('wf_', user_id) as workflow",
        "concat('cat_', user_id % 5) as category",
        "case when event_type = 'error' then 'error' else 'end' end as end_action",
        "case event_type when 'error' then -9 when 'view' then 0 when 'signup' then -1 else 1 end as res",
        "ts as start_ts",
        "timestampadd(MINUTE, cast(event_id % 90 as int), ts) as end_ts",
        "event_id % 90 * 60 as duration_s",
        "event_type as message",
    )


RUNS = """runs as (select 2 * event_id + 1 as run_id, user_id as wf_id, 'wf_' || user_id as workflow, 'cat_' || (user_id % 5) as category,
  case when event_type = 'error' then 'error' else 'end' end as end_action,
  case event_type when 'error' then -9 when 'view' then 0 when 'signup' then -1 else 1 end as res,
  ts as start_ts, ts + to_minutes(event_id % 90) as end_ts, event_id % 90 * 60 as duration_s, event_type as message from events)"""


def with_sql(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"
