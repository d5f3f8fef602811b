"""Queries of the loaders (L)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import newest_per_key, row_hash
from millrace.functions.marks import stored_edge
from millrace.operators import loads as ops
from millrace.operators.anomaly import daily_points
from millrace.plans import fixtures as fx
from millrace.plans.registry import query
from millrace.sources.ingest import backfill_mark, typed_ingest

HASHED = ["o_orderkey", "o_custkey", "o_orderstatus", "price", "o_orderdate", "o_orderpriority"]
_COLS = ", ".join(HASHED)


@query("L1_truncate_load", fx.with_sql(fx.ORDERS_NEW) + "select distinct o_custkey, o_orderstatus from orders_new")
def truncate_load(t):
    config = ops.LoadConfig("TRUNCATE", fields=["o_custkey", "o_orderstatus"], distinct=True)
    return ops.configured_load(fx.orders_new(t), fx.orders_old(t), config)


@query(
    "L2_update_load",
    fx.with_sql(fx.ORDERS_OLD, fx.ORDERS_NEW)
    + """select * from orders_old where o_orderkey not in (select o_orderkey from orders_new)
         union all select * from orders_new""",
)
def update_load(t):
    return ops.configured_load(fx.orders_new(t), fx.orders_old(t), ops.LoadConfig("UPDATE", key="o_orderkey"))


@query(
    "L3_insert_load",
    fx.with_sql(fx.ORDERS_OLD, fx.ORDERS_NEW) + "select * from orders_old union all select * from orders_new",
)
def insert_load(t):
    config = ops.LoadConfig("INSERT", source_sql="select * from {source} where o_orderkey >= 0")
    return ops.configured_load(fx.orders_new(t), fx.orders_old(t), config)


@query(
    "L4_except_load",
    fx.with_sql(fx.ORDERS_OLD, fx.ORDERS_NEW)
    + f"""select {_COLS} from orders_old union all
          (select {_COLS} from orders_new except select {_COLS} from orders_old)""",
)
def except_load(t):
    config = ops.LoadConfig("EXCEPT", fields=HASHED)
    return ops.configured_load(fx.orders_new(t), fx.orders_old(t).select(*HASHED), config)


def _history(t):
    old = fx.orders_old(t)
    return old.withColumn("mod_date", F.col("load_date")).withColumn("hash", row_hash(HASHED))


_HASH = fx.hash_sql(HASHED)
_MERGE = fx.with_sql(
    fx.ORDERS_OLD,
    fx.ORDERS_NEW,
    f"""both_sides as (select *, load_date as mod_date, {_HASH} as hash from
        (select * from orders_old union all select * from orders_new))""",
) + f"""select {_COLS}, load_date, hash, mod_date from (
  select * exclude (mod_date), min(mod_date) over (partition by o_orderkey, hash) as mod_date,
    row_number() over (partition by o_orderkey, hash order by load_date desc nulls first) as rn from both_sides) where rn = 1"""


@query("L5_row_hash_history_merge", _MERGE)
def history_merge(t):
    batch = fx.orders_new(t).withColumn("mod_date", F.col("load_date"))
    return ops.hash_history_merge(batch, _history(t), ["o_orderkey"], ["load_date"])


@query("L5_touch_only_matching_merge", _MERGE)
def delta_merge(t):
    batch = fx.orders_new(t).withColumn("mod_date", F.col("load_date"))
    return ops.hash_history_merge(batch, _history(t), ["o_orderkey"], ["load_date"], touch_only_matching=True)


@query("L6_raw_to_history", _MERGE)
def raw_to_history(t):
    return ops.raw_to_history(fx.orders_new(t), _history(t), ["o_orderkey"], "load_date")


_WITH_END = fx.with_sql(f"merged as ({_MERGE})") + """select *,
  lead(mod_date) over (partition by o_orderkey order by mod_date, hash) - 1 as valid_to from merged"""


@query("L7_stage_to_history", _WITH_END)
def stage_to_history(t):
    return ops.raw_to_history(fx.orders_new(t), _history(t), ["o_orderkey"], "load_date", add_valid_to=True)


def _snapshot(df, day):
    return df.select(
        "o_orderkey",
        F.trunc("o_orderdate", "MM").alias("report_date"),
        "o_orderstatus",
        "price",
        F.date_add(F.lit(day), (F.col("o_orderkey") % 3).cast("int")).alias("actual_date"),
        (F.col("o_orderkey") % 7).alias("ctl_loading"),
        "load_date",
    ).withColumns({"hash": row_hash(["o_orderkey", "o_orderstatus", "price"]), "mod_date": F.col("actual_date")})


_SNAP_SQL = """{name} as (select *, {hash} as hash, actual_date as mod_date from (
  select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as report_date, o_orderstatus, price,
    date '{day}' + cast(o_orderkey % 3 as int) as actual_date, o_orderkey % 7 as ctl_loading, load_date from {src}))"""
_SNAP_HASH = fx.hash_sql(["o_orderkey", "o_orderstatus", "price"])


@query(
    "L8_snapshot_replace",
    fx.with_sql(
        fx.ORDERS_OLD,
        fx.ORDERS_NEW,
        _SNAP_SQL.format(name="old_s", hash=_SNAP_HASH, day="2024-01-01", src="orders_old"),
        _SNAP_SQL.format(name="new_s", hash=_SNAP_HASH, day="2024-01-08", src="orders_new"),
        """staged as (select * from new_s union all
          select o.* from old_s o where exists (select 1 from new_s n where n.o_orderkey = o.o_orderkey and n.report_date = o.report_date))""",
        """ranked as (select *, row_number() over (partition by o_orderkey, report_date order by actual_date desc, ctl_loading desc, load_date desc) as rn,
             min(mod_date) over (partition by o_orderkey, report_date, hash) as first_seen,
             max(actual_date) over (partition by report_date) as top from staged)""",
    )
    + """select o_orderkey, report_date, o_orderstatus, price, actual_date, ctl_loading, load_date, hash, first_seen as mod_date
         from ranked where rn = 1 and actual_date = top
         union all select o_orderkey, report_date, o_orderstatus, price, actual_date, ctl_loading, load_date, hash, mod_date
         from old_s where report_date not in (select report_date from staged)""",
)
def snapshot_replace(t):
    new = _snapshot(fx.orders_new(t), dt.date(2024, 1, 8))
    old = _snapshot(fx.orders_old(t), dt.date(2024, 1, 1))
    return ops.snapshot_replace(new, old, ["o_orderkey", "report_date"], "report_date")


def _mart_template(stamp):
    def build(rows):
        grouped = rows.groupBy(F.col("o_custkey"), F.trunc("o_orderdate", "MM").alias("report_date")).agg(
            F.count(F.lit(1)).alias("orders_cnt"), F.sum("price").alias("revenue"), F.max("actual_date").alias("actual_date")
        )
        return grouped.withColumns(
            {
                "load_date": F.lit(stamp).cast("date"),
                "hash": row_hash(["o_custkey", "report_date", "orders_cnt", "revenue"]),
                "mod_date": F.lit(stamp).cast("date"),
            }
        )

    return build


_MART_SQL = """select o_custkey, cast(date_trunc('month', o_orderdate) as date) as report_date, count(*) as orders_cnt,
  sum(price) as revenue, max(actual_date) as actual_date, date '{day}' as load_date, date '{day}' as mod_date from {src} group by 1, 2"""


def _refresh_sql(test):
    tables = fx.with_sql(
        fx.ORDERS_OLD,
        "src as (select *, o_orderdate + 10 as actual_date from orders_old)",
        f"mart as (select *, {fx.hash_sql(['o_custkey', 'report_date', 'orders_cnt', 'revenue'])} as hash from ("
        + _MART_SQL.format(day="2024-01-01", src="src where actual_date <= date '2000-06-20'")
        + "))",
        f"changed as (select *, {fx.hash_sql(['o_custkey', 'report_date', 'orders_cnt', 'revenue'])} as hash from ("
        + _MART_SQL.format(day="2024-01-08", src=f"src where actual_date {test} (select max(actual_date) from mart)")
        + "))",
        """staged as (select * from changed union all select m.* from mart m where exists
             (select 1 from changed c where c.o_custkey = m.o_custkey and c.report_date = m.report_date))""",
        """ranked as (select *, row_number() over (partition by o_custkey, report_date order by actual_date desc, load_date desc) as rn,
             min(mod_date) over (partition by o_custkey, report_date, hash) as first_seen from staged)""",
    )
    return tables + """select o_custkey, report_date, orders_cnt, revenue, actual_date, load_date, first_seen as mod_date from ranked where rn = 1
         union all select o_custkey, report_date, orders_cnt, revenue, actual_date, load_date, mod_date from mart
         where report_date not in (select report_date from staged)"""


@query("L9_mart_refresh", _refresh_sql(">="))
def mart_refresh(t):
    return _refreshed(t, inclusive=True)


@query("L9_mart_refresh_strict", _refresh_sql(">"))
def mart_refresh_strict(t):
    """Only the slices after the watermark."""
    return _refreshed(t, inclusive=False)


def _refreshed(t, inclusive):
    source = fx.orders_old(t).withColumn("actual_date", F.date_add("o_orderdate", 10))
    mart = _mart_template("2024-01-01")(source.where("actual_date <= date '2000-06-20'"))
    out = ops.refresh_mart(
        source, mart, _mart_template("2024-01-08"), ["o_custkey", "report_date"], "report_date", limiter=None, inclusive=inclusive
    )
    return out.drop("hash")


_REFRESH_SCORES_SQL = (
    fx.with_sql(
        fx.z_table_sql(),
        fx.ORDERS_OLD,
        "src as (select *, o_orderdate + 10 as actual_date from orders_old)",
        f"refreshed as ({_refresh_sql('>=')})",
        f"mart as ({_MART_SQL.format(day='2024-01-01', src="src where actual_date <= date '2000-06-20'")})",
        """touched as (select cast(date_trunc('month', min(o_orderdate)) as date) as lo, cast(date_trunc('month', max(o_orderdate)) as date) as hi
             from src where actual_date >= (select max(actual_date) from mart))""",
        """pts as (select report_date as day, 2 as calc, count(*) as v from refreshed, touched where report_date between lo and hi group by 1
             union all select report_date, 1, count(*) from mart group by 1)""",
        "newest as (select * from pts qualify row_number() over (partition by day order by calc desc) = 1)",
        "sc as (select day, v, avg(v) over () as a, stddev_pop(v) over () as s from newest)",
        "zz as (select *, (v - a) / coalesce(nullif(s, 0), 1) as z0 from sc)",
    )
    + """select 'mart' as object, day as date_field_value, v as field_value, round(a, 6) as avg_value, round(s, 6) as stddev_value,
         round(z0, 6) as zscore, round(100 * cast(coalesce(2 * z.p_value, 0) as double), 4) as confidence_percentage
         from touched, zz left join ztable z on z.zscore = abs(cast(z0 as decimal(12,1))) where day between lo and hi"""
)


@query("L9_refresh_scores", _REFRESH_SCORES_SQL)
def refresh_scores(t):
    """The refresh as a whole: changed slices, merge, and the test of the counts of the touched months against those stored before."""
    source = fx.orders_old(t).withColumn("actual_date", F.date_add("o_orderdate", 10))
    mart = _mart_template("2024-01-01")(source.where("actual_date <= date '2000-06-20'"))
    refreshed = ops.refresh_mart(source, mart, _mart_template("2024-01-08"), ["o_custkey", "report_date"], "report_date", limiter=None)
    changed = ops.changed_slices(source, mart, "actual_date").withColumn("report_date", F.trunc("o_orderdate", "MM"))
    stored = daily_points(mart, F.lit("mart"), "report_date", "count(1)", dt.datetime(2024, 1, 1))
    return ops.refresh_scores(refreshed, changed, stored, "mart", "report_date", dt.datetime(2024, 1, 8))


@query(
    "L10_append_above_mark",
    """select o_orderkey, o_custkey, cast(o_totalprice as decimal(15,2)) as price from orders
       where o_orderkey > (select max(o_orderkey) from orders where o_orderdate < date '1997-01-01') and o_orderstatus <> 'P'""",
)
def append_above_mark(t):
    target = t.orders.where("o_orderdate < date '1997-01-01'").selectExpr(
        "o_orderkey", "o_custkey", "cast(o_totalprice as decimal(15,2)) as price"
    )
    source = t.orders.withColumnRenamed("o_totalprice", "price")
    return ops.append_above_mark(source, target, "o_orderkey", "o_orderstatus <> 'P'")


@query(
    "L10_append_above_stored_mark",
    "select o_orderkey as c_custkey, o_totalprice as c_acctbal from orders where o_orderkey > (select max(c_custkey) from customer)",
)
def append_above_stored_mark(t):
    """The largest key of the target comes from the footers of its files."""
    target = t.customer.select("c_custkey", "c_acctbal")
    source = t.orders.selectExpr("o_orderkey as c_custkey", "o_totalprice as c_acctbal")
    return ops.append_above_mark(source, target, "c_custkey", mark=stored_edge(t.spark, f"{t.sf_dir}/customer.parquet", "c_custkey"))


def _ended_runs(t):
    return fx.run_log(t).where("parent is not null").select(
        "workflow", F.col("parent").alias("start_id"), F.col("action").alias("end_action"), "message"
    )


def _all_runs(t):
    """Every seventh event is a run of its own workflow: with lid, with a date only, without either, or failed."""
    message = "case event_id % 4 when 0 then concat('{\"lid\": ', event_id, '}') when 1 then '{\"dt\": \"2024-01-05 00:00:00\"}' when 2 then 'loaded' end"
    return t.events.selectExpr(
        "concat('wf_', user_id % 7) as workflow", "event_id as start_id",
        "case when event_type = 'error' then 'error' else 'end' end as end_action", f"{message} as message",
    )


@query(
    "L11_load_from_run_log",
    """with last as (select max_by(event_id, event_id) as lid from events where user_id = 7 and event_type <> 'error')
       select event_id, user_id, event_type from events where event_id > (select coalesce(lid, -1) from last)""",
)
def load_from_run_log(t):
    target = t.events.where("event_type = 'signup'")
    rows = ops.load_from_run_log(t.events, _ended_runs(t), "wf_7", target, "event_id")
    return rows.select("event_id", "user_id", "event_type")


@query(
    "L11_resume_marks",
    """with w as (select unnest(range(9)) as k), top as (select k, (select max(event_id) from events where event_type = 'signup' and user_id % 9 = k) as m from w),
       run as (select user_id % 7 as k, max(event_id) as id from events where event_type <> 'error' group by 1)
       select 'wf_' || top.k as workflow, cast(coalesce(case when id % 4 = 0 then id when id % 4 = 1 then -1 else m end, -1) as bigint) as mark
       from top left join run on run.k = top.k""",
)
def resume_marks(t):
    """Nine workflows: the newest run has a lid, only a date or neither; two have never run."""
    runs, frames = _all_runs(t), []
    for k in range(9):
        target = t.events.where(f"event_type = 'signup' and user_id % 9 = {k}")
        frames.append(ops.resume_mark(runs, f"wf_{k}", target, "event_id").select(F.lit(f"wf_{k}").alias("workflow"), "mark"))
    return reduce(DataFrame.union, frames)


@query(
    "L12_resume_key",
    """with hit as (select count(*) > 0 as yes from events where event_type = 'error' and user_id % 2 = 0 and user_id % 5 = 2)
       select yes as rolled_back, case when yes then (select coalesce(min(event_id), 0) from events where event_type = 'click')
         else (select coalesce(max(event_id), 0) from events where event_type = 'view') end as lid from hit""",
)
def resume_key(t):
    errors = t.events.select(
        F.col("event_id").alias("start_id"),
        F.when(F.col("event_type") == "error", "error").otherwise("end").alias("end_action"),
        F.when(F.col("user_id") % 2 == 0, "Ztest error No").otherwise("other").alias("message"),
        F.to_json(F.struct(F.concat(F.lit("stg.tb_"), F.col("user_id") % 5).alias("object"))).alias("detail"),
    )
    raw = t.events.where("event_type = 'click'")
    target = t.events.where("event_type = 'view'")
    return ops.resume_key(errors, "stg.tb_2", raw, target, "event_id")


@query(
    "L13_full_reload_unknown_rows",
    fx.with_sql(fx.ORDERS_OLD, fx.ORDERS_NEW)
    + f"select {_COLS} from orders_new n where not exists (select 1 from orders_old o where "
    + " and ".join(f"o.{c} = n.{c}" for c in HASHED)
    + ")",
)
def unknown_rows(t):
    return ops.unknown_rows(fx.orders_new(t).select(*HASHED), fx.orders_old(t).select(*HASHED))


_SAME = " and ".join(f"o.{c} = n.{c}" for c in HASHED)


@query(
    "L13_full_reload",
    fx.with_sql(fx.ORDERS_OLD, fx.ORDERS_NEW)
    + f""", fresh as (select count(*) as k from orders_new n where not exists (select 1 from orders_old o where {_SAME})),
         gone as (select count(*) as k from orders_old n where not exists (select 1 from orders_new o where {_SAME}))
       select 'new batch' as load, case when k > 0 then 'Ok' else 'No New data' end as status, {_COLS} from orders_new, fresh where k > 0
       union all select 'new batch', 'No New data', {_COLS} from orders_old, fresh where k = 0
       union all select 'same batch', 'No New data', {_COLS} from orders_old
       union all select 'with deletes', case when fresh.k + gone.k > 0 then 'Ok' else 'No New data' end, {_COLS} from orders_new, fresh, gone where fresh.k + gone.k > 0
       union all select 'no batch', 'No data', {_COLS} from orders_old""",
)
def full_reload(t):
    """Status and new content for a new batch, the same batch, a batch checked for deletes, and none."""
    old, new = fx.orders_old(t).select(*HASHED), fx.orders_new(t).select(*HASHED)
    loads = {
        "new batch": ops.full_reload_if_changed(new, old),
        "same batch": ops.full_reload_if_changed(old, old),
        "with deletes": ops.full_reload_if_changed(new, old, detect_deletes=True),
        "no batch": ops.full_reload_if_changed(new, old, where="o_orderkey < 0"),
    }
    return reduce(DataFrame.union, [df.select(F.lit(name).alias("load"), F.lit(status).alias("status"), *HASHED) for name, (status, df) in loads.items()])


@query(
    "L14_reload_status",
    """with d as (select o_orderkey, cast(o_orderdate as date) as o_orderdate from orders)
       select 'newer' as load, 'Ok' as status, * from d where o_orderdate > date '1995-12-31' and exists (select 1 from d where o_orderdate > date '1995-12-31')
       union all select 'none newer', 'No New data', * from d
       union all select 'no data', 'No data', * from d""",
)
def reload_status(t):
    days = t.orders.selectExpr("o_orderkey", "cast(o_orderdate as date) as o_orderdate")
    before = days.where("o_orderdate <= date '1995-12-31'")
    # The target's newest day is the last of 1995, whichever orders it holds.
    before = before.unionByName(before.limit(1).selectExpr("o_orderkey", "date '1995-12-31' as o_orderdate"))
    loads = {"newer": (days, before), "none newer": (days, days), "no data": (days.where("o_orderkey < 0"), days)}
    frames = []
    for name, (raw, target) in loads.items():
        status, out = ops.reload_newer(raw, target, "o_orderdate")
        frames.append(out.select(F.lit(name).alias("load"), F.lit(status).alias("status"), "*"))
    return reduce(DataFrame.union, frames)


@query(
    "L14_reload_newer",
    """select o_orderkey, cast(o_orderdate as date) as o_orderdate from orders where cast(o_orderdate as date) >
       (select max(cast(o_orderdate as date)) from orders where cast(o_orderdate as date) <= date '1999-12-31')""",
)
def reload_newer(t):
    days = t.orders.selectExpr("o_orderkey", "cast(o_orderdate as date) as o_orderdate")
    target = days.where("o_orderdate <= date '1999-12-31'")
    return ops.newer_rows(days, target, "o_orderdate")


TYPED = T.StructType(
    [
        T.StructField("export_ts", T.TimestampType()),
        T.StructField("period", T.DateType()),
        T.StructField("cust", T.LongType()),
        T.StructField("odate", T.DateType()),
        T.StructField("flag", T.BooleanType()),
        T.StructField("priority", T.StringType()),
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("ctl_loading", T.LongType()),
    ]
)
_TYPED_SQL = fx.with_sql(fx.ORDERS_TEXT) + """select strptime(hexportid, '%Y%m%d%H%M%S') as export_ts,
  cast(strptime(right(hexpperio, 8), '%Y%m%d') as date) as period,
  cast(nullif(nullif(cust, ''), ' ') as bigint) as cust,
  cast(strptime(case when odate in ('', ' ', '00000000', '0000-00-00') then null else odate end, '%Y%m%d') as date) as odate,
  flag in ('X', '1') as flag, nullif(nullif(priority, ''), ' ') as priority, o_orderkey, {batch} as ctl_loading
  from orders_text where ctl_loading {test}"""


@query("L15_typed_ingest", _TYPED_SQL.format(batch="ctl_loading", test="> 20"))
def typed_ingest_query(t):
    raw = fx.orders_text(t)
    return typed_ingest([raw.where("o_orderkey % 2 = 0"), raw.where("o_orderkey % 2 <> 0")], TYPED, above=20)


@query("L16_backfill_ingest", _TYPED_SQL.format(batch="-ctl_loading", test=">= 29"))
def backfill_ingest(t):
    mark = backfill_mark(t.orders, -30)
    return typed_ingest(fx.orders_text(t), TYPED, above=mark, inclusive=True, backfill=True)


@query(
    "L17_date_range_replace",
    """with batch as (select o_orderkey, cast(o_orderdate as date) as day_part, case when o_orderkey % 9 = 0 then -1 else o_custkey end as epk,
         cast(o_orderdate as date) + cast(o_orderkey % 4 as int) as valid_from from orders
         where o_orderdate >= timestamp '1998-03-01' and o_orderdate < timestamp '1998-06-01'),
       target as (select o_orderkey, cast(o_orderdate as date) as day_part, o_custkey as epk, cast(o_orderdate as date) as valid_from
         from orders where o_orderkey % 3 <> 0)
       select * from target where day_part not between (select min(day_part) from batch) and (select max(day_part) from batch)
       union all select * from batch where day_part < valid_from and epk <> -1""",
)
def date_range_replace(t):
    days = "cast(o_orderdate as date)"
    batch = t.orders.where(
        "o_orderdate >= timestamp '1998-03-01' and o_orderdate < timestamp '1998-06-01'"
    ).selectExpr(
        "o_orderkey", f"{days} as day_part", "case when o_orderkey % 9 = 0 then -1 else o_custkey end as epk",
        f"date_add({days}, cast(o_orderkey % 4 as int)) as valid_from",
    )
    target = t.orders.where("o_orderkey % 3 <> 0").selectExpr(
        "o_orderkey", f"{days} as day_part", "o_custkey as epk", f"{days} as valid_from"
    )
    return ops.date_range_replace(batch, target, "day_part", "valid_from", "epk")


@query(
    "L18_rename_and_cast",
    fx.with_sql(fx.ORDERS_TEXT)
    + """select try_cast(nullif(trim(cust), '') as bigint) as customer_id,
           cast(o_orderkey as varchar) as order_no, cast(d as date) as order_day
         from (select *, strptime(odate2, '%Y-%m-%d') as d from (select *, substr(hexportid, 1, 4) || '-' || substr(hexportid, 5, 2) || '-' || substr(hexportid, 7, 2) as odate2 from orders_text))""",
)
def rename_and_cast(t):
    raw = fx.orders_text(t).withColumn(
        "hdate", F.concat_ws("-", F.substring("hexportid", 1, 4), F.substring("hexportid", 5, 2), F.expr("substring(hexportid, 7, 2) || ' rest'"))
    )
    return ops.rename_and_cast(
        raw, {"customer_id": ("cust", "bigint"), "order_no": ("o_orderkey", "string"), "order_day": ("hdate", "date")}
    )


@query(
    "L19_poll_marks",
    """with e as (select max(event_id) as n, max(event_id) filter (user_id < 20) as o from events),
         d as (select max(cast(o_orderdate as date)) as n, max(cast(o_orderdate as date)) filter (o_custkey % 3 = 0) as o from orders),
         s as (select max(ts) as n, max(ts) filter (user_id < 20) as o from events)
       select 'events' as source, 'event_id' as field, 'bigint' as type, cast(o as varchar) as old_value, cast(n as varchar) as new_value, n > o as changed from e
       union all select 'orders', 'o_orderkey', 'bigint', cast(max(o_orderkey) as varchar), cast(max(o_orderkey) as varchar), false from orders
       union all select 'part', 'p_partkey', 'bigint', null, cast(max(p_partkey) as varchar), true from part
       union all select 'orders', 'day', 'date', cast(o as varchar), cast(n as varchar), n > o from d
       union all select 'events', 'second', 'timestamp', strftime(date_trunc('second', o), '%Y-%m-%d %H:%M:%S'), strftime(date_trunc('second', n), '%Y-%m-%d %H:%M:%S'),
         date_trunc('second', n) > date_trunc('second', o) from s""",
)
def poll_marks(t):
    """Marks of whole numbers, a date and a timestamp; one source has none yet."""
    seconds = t.events.select("user_id", "event_id", F.date_trunc("second", "ts").alias("second"))
    days = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))

    def seen(df, source, field):
        value = F.col(field).cast("string").alias("value")
        return df.select(F.lit(source).alias("source"), F.lit(field).alias("field"), value, F.col(field).cast("timestamp").cast("bigint").alias("ts"))

    def seen_number(df, source, field):
        return df.select(F.lit(source).alias("source"), F.lit(field).alias("field"), F.col(field).cast("string").alias("value"), F.col(field).alias("ts"))

    marks = [
        seen_number(seconds.where("user_id < 20"), "events", "event_id"), seen_number(days, "orders", "o_orderkey"),
        seen(days.where("o_custkey % 3 = 0"), "orders", "day"), seen(seconds.where("user_id < 20"), "events", "second"),
    ]
    polled = [("events", "event_id", seconds), ("orders", "o_orderkey", days), ("part", "p_partkey", t.part), ("orders", "day", days), ("events", "second", seconds)]
    return ops.poll_marks(reduce(DataFrame.union, marks), polled)


@query(
    "L20_append_changed_versions",
    """with e as (select case when event_id % 11 <> 0 then user_id end as id, event_type as msg, ts, event_id from events),
       stored as (select id, msg from e where ts < timestamp '2024-01-20' and id is not null qualify row_number() over (partition by id order by ts desc, msg desc) = 1),
       incoming as (select id, msg, event_id from e where ts >= timestamp '2024-01-20'
         qualify row_number() over (partition by id order by ts desc, event_id desc) <= 1 or id is null)
       select i.id, i.msg from incoming i left join stored s on s.id = i.id and s.msg = i.msg
       where (s.id is null and i.id is not null) or i.event_id % 13 = 0""",
)
def append_changed_versions(t):
    """Rows without id are skipped, rows marked as information always come through."""
    named = F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("id")
    ev = t.events.select(named, "ts", F.col("event_type").alias("msg"), "event_id")
    stored = ev.where("ts < timestamp '2024-01-20'").drop("event_id")
    new = ev.where("ts >= timestamp '2024-01-20'")
    incoming = newest_per_key(new.where("id is not null"), ["id"], ["ts", "event_id"]).select("id", "msg", "event_id")
    incoming = incoming.unionByName(new.where("id is null").select("id", "msg", "event_id"))
    return ops.append_changed_versions(incoming, stored, ["id"], "msg", "ts", F.col("event_id") % 13 == 0).select("id", "msg")


@query(
    "L21_incremental_extract",
    """with d as (select ts, cast(ts as date) as day, event_id, user_id from events),
       flow(flow, last) as (values ('never', null), ('earlier', date '2024-01-24'), ('yesterday', date '2024-01-29'), ('today', date '2024-01-30')),
       dates as (select distinct flow, day from d, flow where last is null or ts > cast(last as timestamp) or ts > timestamp '2024-01-29'
          union select flow, day from flow, (values (date '2024-01-03'), (date '2024-01-05')) as retry(day))
       select flow, strftime(day, '%Y%m%d') as increment_key, event_id, user_id from d join dates using (day)""",
)
def incremental_extract(t):
    """Flows that never confirmed, confirmed some days ago, yesterday and today."""
    rows = t.events.select("ts", "event_id", "user_id")
    days = t.events.select(F.col("ts").cast("date").alias("day")).distinct()
    retry = days.where("day in (date '2024-01-03', date '2024-01-05')")
    frames = []
    for flow, last in (("never", "1999-01-01"), ("earlier", "2024-01-24"), ("yesterday", "2024-01-29"), ("today", "2024-01-30")):
        confirmed = days.where(F.col("day") <= F.lit(last).cast("date"))
        out = ops.incremental_extract(rows, "ts", confirmed, retry, dt.date(2024, 1, 30))
        frames.append(out.select(F.lit(flow).alias("flow"), "*"))
    return reduce(DataFrame.union, frames).select(
        "flow",
        "increment_key",
        F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object("payload", "$.user_id").cast("bigint").alias("user_id"),
    )
