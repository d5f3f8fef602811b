"""Queries of the z-test family (Z)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import anomaly as ops
from millrace.plans import fixtures as fx
from millrace.plans.registry import query

DAY = dt.date(2024, 1, 20)
TODAY = dt.date(2024, 2, 1)
_P = "coalesce(2 * z.p_value, 0)"


def _z_sql(points, lo, hi, extra=""):
    return f"""with {fx.z_table_sql()}, pts as ({points}),
      st as (select avg(value) as a, stddev_pop(value) as s from pts),
      sc as (select pts.*, a, s, (value - a) / coalesce(nullif(s, 0), 1) as zz from pts, st where day = date '{hi}')
      select {extra} day as date_field_value, round(value, 6) as field_value, date '{lo}' as date_from, date '{hi}' as date_to,
        round(a, 6) as avg_value, round(s, 6) as stddev_value, round(zz, 6) as zscore, round(100 * cast({_P} as double), 4) as confidence_percentage
      from sc left join ztable z on z.zscore = abs(cast(zz as decimal(12,1)))"""


@query(
    "Z1_z_of_date",
    _z_sql(
        "select cast(ts as date) as day, cast(count(*) as double) as value from events where cast(ts as date) between date '2024-01-06' and date '2024-01-20' group by 1",
        "2024-01-06",
        "2024-01-20",
    ),
)
def z_of_date(t):
    return ops.z_of_date(t.events, "count(*)", "ts", DAY, "week", 2)


@query(
    "Z1_z_of_plain_values",
    _z_sql(
        "select distinct cast(ts as date) as day, cast(user_id as double) as value from events where cast(ts as date) between date '2024-01-19' and date '2024-01-20'",
        "2024-01-19",
        "2024-01-20",
    ),
)
def z_of_plain_values(t):
    return ops.z_of_date(t.events, "user_id", "ts", DAY, "day", 1)


@query(
    "Z2_max_z_of_means",
    """with m as (select cast(ts as date) as day, avg(value) as v from events group by 1),
       st as (select avg(v) as a, stddev_pop(v) as s from m)
       select round(max(abs(v - a) / coalesce(nullif(s, 0), 1)), 4) as max_z from m, st where day between date '2024-01-13' and date '2024-01-20'""",
)
def max_z(t):
    return ops.max_z_of_means(t.events, "value", "ts", DAY, "week", 1)


@query(
    "Z3_z_of_helper",
    _z_sql(
        "select cast(ts as date) as day, cast(count(distinct user_id) as double) as value from events where cast(ts as date) between date '2024-01-10' and date '2024-01-20' group by 1",
        "2024-01-10",
        "2024-01-20",
        "'stg.users' as object_name,",
    ),
)
def z_of_helper(t):
    return ops.z_of_helper(t.events, "count(distinct user_id)", "ts", DAY, "day", 10, "stg.users")


def _rolling_inputs(t):
    fresh = ops.daily_points(t.events.where("ts >= timestamp '2024-01-15'"), F.col("event_type"), "ts", "count(*)", dt.datetime(2024, 2, 2))
    stored = ops.daily_points(
        t.events.where("ts < timestamp '2024-01-20'"), F.col("event_type"), "ts", "count(*) * 2 + 1", dt.datetime(2024, 2, 1)
    )
    return fresh, stored


def _rolling_sql(days, lo, hi):
    return f"""with {fx.z_table_sql()},
      pts as (select event_type, cast(ts as date) as day, 2 as calc, count(*) as v from events where ts >= timestamp '2024-01-15' group by 1, 2
        union all select event_type, cast(ts as date), 1, count(*) * 2 + 1 from events where ts < timestamp '2024-01-20' group by 1, 2),
      newest as (select * from pts qualify row_number() over (partition by event_type, day order by calc desc) = 1),
      rolled as (select a.event_type, a.day, cast(sum(b.v) as bigint) as v from newest a join newest b
        on a.event_type = b.event_type and b.day between a.day - {days} and a.day group by 1, 2),
      sc as (select *, avg(v) over w as a, stddev_pop(v) over w as s from rolled window w as (partition by event_type)),
      zz as (select *, (v - a) / coalesce(nullif(s, 0), 1) as zscore0 from sc)
      select event_type as object, day as date_field_value, v as field_value, round(a, 6) as avg_value, round(s, 6) as stddev_value,
        round(zscore0, 6) as zscore, round(100 * cast({_P} as double), 4) as confidence_percentage
      from zz left join ztable z on z.zscore = abs(cast(zscore0 as decimal(12,1))) where day between date '{lo}' and date '{hi}'"""


@query("Z4_rolling_z", _rolling_sql(3, "2024-01-05", "2024-01-28"))
def rolling_z(t):
    fresh, stored = _rolling_inputs(t)
    return ops.rolling_z(fresh, stored, dt.date(2024, 1, 5), dt.date(2024, 1, 28), 3)


@query("Z5_daily_z_range", _rolling_sql(0, "2024-01-10", "2024-01-20"))
def daily_z_range(t):
    fresh, stored = _rolling_inputs(t)
    return ops.rolling_z(fresh, stored, dt.date(2024, 1, 10), dt.date(2024, 1, 20), 0)


def _row_totals(t):
    """Per user and day the running row count, as a loader that appends would report it."""
    from pyspark.sql import Window

    days = t.events.groupBy("user_id", F.col("ts").cast("date").alias("key_date")).agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("log_id"), F.max("ts").alias("ts")
    )
    w = Window.partitionBy("user_id").orderBy("key_date")
    return days.withColumns(
        {
            "rows_count": 100 + F.sum("n").over(w),
            "value": F.when(F.lag("n").over(w).isNotNull(), F.col("n")),
            "ztest": F.when(F.col("log_id") % 11 == 0, F.lit(False)).when(F.col("log_id") % 7 == 0, F.lit(None)).otherwise(F.lit(True)),
        }
    )


_ROW_TOTALS = """days as (select user_id, cast(ts as date) as key_date, count(*) as n, max(event_id) as log_id, max(ts) as ts from events group by 1, 2),
  totals as (select *, cast(100 + sum(n) over w as bigint) as rows_count, case when lag(n) over w is not null then n end as value,
    case when log_id % 11 = 0 then false when log_id % 7 = 0 then null else true end as ztest from days window w as (partition by user_id order by key_date))"""


def _verdict_inputs(t):
    totals = _row_totals(t).withColumn("object", F.concat(F.lit("tb_"), "user_id"))
    hist = totals.where("key_date < date '2024-01-27'").select(
        "object", "key_date", "rows_count", "value", "ztest", "ts", "log_id",
        *[F.lit(v).cast("bigint").alias(c) for c, v in (("avg", 1), ("std", 2), ("cnt", 3), ("min", 4), ("max", 5))],
    )
    last = totals.groupBy("object").agg(
        F.max(F.struct("key_date", "rows_count", "log_id", "ts")).alias("l"), F.max("user_id").alias("user_id")
    )
    cand = last.select(
        "object",
        F.array(F.lit(None).cast("date"), F.lit(dt.date(2024, 3, 1)), F.col("l.key_date")).alias("key_dates"),
        "l.rows_count",
        "l.log_id",
        "l.ts",
    )
    config = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where("user_id % 3 = 0").select(
        F.concat(F.lit("tb_"), "user_id").alias("object"),
        (F.col("user_id") % 30 != 0).alias("active"),
        (F.col("user_id") % 2 == 0).alias("rollback"),
        F.expr(
            """case user_id % 4 when 0 then '{"dots": 5, "max": 1}' when 1 then '{"interval": "3 days", "min": 1}'
               when 2 then '{"zfr": -0.5, "zto": 0.5, "skip": false}' else '{"beg": "2024-01-04", "hist": 110, "end": "2024-01-28"}' end"""
        ).alias("z_cfg"),
        F.expr("case when user_id % 5 = 0 then array(date '2024-01-12', date '2024-01-30') end").alias("z_except"),
        F.expr("case when user_id % 7 = 0 then array(date '2024-01-11', date '2024-01-30') end").alias("z_error"),
    )
    return cand, hist, config


_SETTINGS = """cfg as (select distinct user_id, user_id % 30 <> 0 as active, user_id % 2 = 0 as back,
             case user_id % 4 when 0 then 5 else 90 end as dots, case user_id % 4 when 0 then 1 end as cmax,
             case user_id % 4 when 1 then 3 else 1 end as iv, case user_id % 4 when 1 then 1 end as cmin,
             case user_id % 4 when 2 then -0.5 end as zfr, case user_id % 4 when 2 then 0.5 end as zto,
             case user_id % 4 when 2 then false else true end as skip, case user_id % 4 when 3 then date '2024-01-04' end as beg,
             case user_id % 4 when 3 then 110 end as hist, case user_id % 4 when 3 then date '2024-01-28' end as fin,
             case when user_id % 5 = 0 then [date '2024-01-12', date '2024-01-30'] else [] end as z_except,
             case when user_id % 7 = 0 then [date '2024-01-11', date '2024-01-30'] else [] end as z_error
           from events where user_id % 3 = 0)"""

_VERDICT_SQL = (
    fx.with_sql(
        _ROW_TOTALS,
        _SETTINGS,
        """cand as (select t.user_id, t.key_date as kd, t.rows_count as rc, t.log_id as lid, coalesce(c.dots, 90) as dots, c.cmax, coalesce(c.iv, 1) as iv, c.cmin,
             c.zfr, c.zto, coalesce(c.skip, true) as skip, c.beg, c.hist, c.fin, coalesce(c.z_except, []) as z_except, coalesce(c.z_error, []) as z_error, c.back,
             case when t.rows_count <= c.hist then c.hist else 9000000000000000000 end as rmax, case when t.rows_count > c.hist then c.hist + 1 else 0 end as rmin
           from (select * from totals qualify row_number() over (partition by user_id order by key_date desc) = 1) t
           left join cfg c on c.user_id = t.user_id where coalesce(c.active, true))""",
        """h as (select t.key_date, t.rows_count, t.value, t.ztest, t.ts, t.log_id, c.* from totals t join cand c on t.user_id = c.user_id
           where t.key_date < date '2024-01-27' and not list_contains(z_error, t.key_date) and t.key_date >= coalesce(beg, date '1900-01-01')
             and t.rows_count between rmin and rmax)""",
        """lst as (select user_id, key_date as lkd, rows_count as lrc from h where key_date <= kd - cast(iv as int)
             and (value is null or (not (skip and value = 0) and value between coalesce(cmin, -9000000000000000000) and coalesce(cmax, 9000000000000000000)))
           qualify row_number() over (partition by user_id order by key_date desc, ztest desc nulls first, ts desc, log_id desc) = 1)""",
        """base as (select user_id, value from (select *, row_number() over (partition by user_id order by key_date desc) as n from h
             where key_date < kd and not (skip and value = 0) and value between coalesce(cmin, -9000000000000000000) and coalesce(cmax, 9000000000000000000)
               and (coalesce(ztest, true) or list_contains(z_except, key_date))) where n <= dots)""",
        """linked as (select c.*, lkd, lrc, lkd is not null as has, kd - lkd as dif, cast(trunc((rc - lrc) / (kd - lkd)) as bigint) as val from cand c left join lst l on l.user_id = c.user_id)""",
        """stats as (select user_id, avg(value) as a, stddev_pop(value) as s, count(value) as n, min(value) as mn, max(value) as mx from
             (select user_id, value from base union all select user_id, val from linked where has) group by 1)""",
        """sc as (select l.*, a, s, n, mn, mx, (val - a) / coalesce(nullif(s, 0), 1) as z, s / nullif(a, 0) as stb from linked l left join stats st on st.user_id = l.user_id and has)""",
        """jd as (select *, case when list_contains(z_except, kd) then true when list_contains(z_error, kd) then false when kd > fin then null when kd < beg then null
             when not has then true when val < cmin then false when val > cmax then false
             when abs(stb) < 0.01 and z between coalesce(zfr, -10) and coalesce(zto, 10) then true
             when z between coalesce(zfr, -5) and coalesce(zto, 5) then true else false end as ok from sc)""",
    )
    + """select round(z, 6) as zscore, 'tb_' || user_id as object, kd as key_date, rc as rows_count, cast(dif as int) as key_diff, val as value,
         case when ok = false and has then 1 else cast(round(round(a, 9)) as bigint) end as avg, case when ok = false and has then 2 else cast(round(round(s, 9)) as bigint) end as std,
         case when ok = false and has then 3 else n end as cnt, case when ok = false and has then 4 else mn end as min,
         case when ok = false and has then 5 else mx end as max, lid as log_id, ok as ztest, back from jd"""
)


@query("Z6_growth_verdicts", _VERDICT_SQL)
def growth_verdicts(t):
    out = ops.growth_verdicts(*_verdict_inputs(t), TODAY)
    return out.withColumn("zscore", F.round("zscore", 6)).drop("msg", "stable", "ts")


@query(
    "Z10_rejected_loads",
    f"select object, log_id, key_date from ({_VERDICT_SQL}) where ztest = false and back",
)
def rejected(t):
    return ops.rejected_loads(ops.growth_verdicts(*_verdict_inputs(t), TODAY)).drop("error")


# One step per load of an object; the points of the object known so far travel with it as a list.
_RECALC_SQL = f"""with recursive {_ROW_TOTALS}, {_SETTINGS},
  known as (select user_id, list(struct_pack(kd := key_date, nz := ztest is null, zt := ztest, ts := ts, lid := log_id, rc := rows_count, val := cast(value as bigint),
      a := cast(1 as bigint), s := cast(2 as bigint), n := cast(3 as bigint), mn := cast(4 as bigint), mx := cast(5 as bigint))) as pts
    from totals where ts < timestamp '2024-01-15' group by 1),
  loads as (select t.user_id, row_number() over (partition by t.user_id order by log_id) as k, log_id + 10000000 as lid, key_date as kd, rows_count as rc, ts,
      coalesce(dots, 90) as dots, coalesce(cmin, -9000000000000000000) as low, coalesce(cmax, 9000000000000000000) as high, coalesce(iv, 1) as iv,
      coalesce(zfr, -10) as z1, coalesce(zto, 10) as z2, coalesce(zfr, -5) as z3, coalesce(zto, 5) as z4, coalesce(skip, true) as skip,
      coalesce(beg, date '1900-01-01') as beg, fin, coalesce(z_except, []) as z_except, coalesce(z_error, []) as z_error,
      case when rows_count <= hist then hist else 9000000000000000000 end as rmax, case when rows_count > hist then hist + 1 else 0 end as rmin
    from totals t left join cfg c on c.user_id = t.user_id where ts >= timestamp '2024-01-15' and rows_count <> 0 and coalesce(active, true)),
  steps as (
    select distinct l.user_id, cast(0 as bigint) as k, known.pts, cast(null as double) as zz, cast(null as bigint) as dif, cast(null as varchar) as msg
    from loads l left join known on known.user_id = l.user_id
    union all
    select user_id, k, list_append(coalesce(pts, []), struct_pack(kd := kd, nz := ok is null, zt := ok, ts := ts, lid := lid, rc := rc, val := val,
        a := case when keep then lst.a else cast(round(round(a, 9)) as bigint) end, s := case when keep then lst.s else cast(round(round(s, 9)) as bigint) end,
        n := case when keep then lst.n else cast(len(sample) as bigint) end, mn := case when keep then lst.mn else list_min(sample) end,
        mx := case when keep then lst.mx else list_max(sample) end)) as pts, z, dif, msg
    from (select *, coalesce(ok = false and has, false) as keep from (
      select *, case when msg[1:2] = 'Ok' then true when msg[1:2] = 'No' then false end as ok from (
        select *, case when list_contains(z_except, kd) then 'Ok z_except' when list_contains(z_error, kd) then 'No z_error' when kd > fin then 'Key_date > end'
            when kd < beg then 'Key_date < beg' when not has then 'Ok first' when val < low then 'No < min' when val > high then 'No > max'
            when abs(s / nullif(a, 0)) < 0.01 and z between z1 and z2 then 'Ok' when z between z3 and z4 then 'Ok' else 'No' end as msg
        from (select *, (val - a) / coalesce(nullif(s, 0), 1) as z from (
          select *, list_avg(sample) as a, list_aggregate(sample, 'stddev_pop') as s from (
            select *, case when has then list_append(list_transform(list_slice(base, 1, dots), lambda p: p.val), val) end as sample from (
              select *, lst is not null as has, cast(kd - lst.kd as bigint) as dif, cast(trunc((rc - lst.rc) / (kd - lst.kd)) as bigint) as val,
                  list_filter(hits, lambda p, i: i = 1 or hits[i - 1].kd <> p.kd) as base from (
                select *, list_filter(able, lambda p: p.kd <= kd - cast(iv as int) and (p.val is null or (not (skip and p.val = 0) and p.val between low and high)))[1] as lst,
                    list_filter(able, lambda p: p.val is not null and not (skip and p.val = 0) and p.val between low and high
                      and (coalesce(p.zt, true) or list_contains(z_except, p.kd))) as hits from (
                  select l.*, pts, list_reverse_sort(list_filter(coalesce(pts, []), lambda p: p.kd < l.kd and not list_contains(l.z_error, p.kd) and p.kd >= l.beg
                    and p.rc between l.rmin and l.rmax)) as able from steps join loads l on l.user_id = steps.user_id and l.k = steps.k + 1)))))))))
  )
  select round(zz, 6) as zscore, p.ts as ts, 'tb_' || user_id as object, p.kd as key_date, p.rc as rows_count, cast(dif as int) as key_diff, p.val as value, p.a as avg,
    p.s as std, p.n as cnt, p.mn as min, p.mx as max, p.lid as log_id, p.zt as ztest, msg from (select *, pts[len(pts)] as p from steps where k > 0)"""


def _recalc_inputs(t):
    _, hist, config = _verdict_inputs(t)
    loads = _row_totals(t).select(
        (F.col("log_id") + 10_000_000).alias("log_id"),
        F.concat(F.lit("tb_"), "user_id").alias("object"),
        F.array("key_date").alias("key_dates"),
        "rows_count",
        "ts",
    )
    return loads, hist, config, dt.datetime(2024, 1, 15), TODAY


@query("Z7_recalculate", _RECALC_SQL)
def recalculate(t):
    return ops.recalculate(*_recalc_inputs(t)).withColumn("zscore", F.round("zscore", 6))


@query("Z7_recalculate_by_steps", _RECALC_SQL)
def recalculate_by_steps(t):
    return ops.recalculate_by_steps(*_recalc_inputs(t)).withColumn("zscore", F.round("zscore", 6))


_CONFIG_SQL = """cfg as (select 'tb_' || user_id as object, user_id % 4 <> 0 as active, user_id % 2 = 0 as rollback, cast(null as varchar) as z_cfg,
  [date '2024-01-02', date '2024-01-01'] as z_except, cast([] as date[]) as z_error from (select distinct user_id from events) where user_id % 3 <> 0)"""


def _config(t):
    return t.events.select("user_id").distinct().where("user_id % 3 <> 0").selectExpr(
        "concat('tb_', user_id) as object", "user_id % 4 <> 0 as active", "user_id % 2 = 0 as rollback", "cast(null as string) as z_cfg",
        "array(date '2024-01-02', date '2024-01-01') as z_except", "cast(array() as array<date>) as z_error",
    )


@query(
    "Z8_upsert_config",
    fx.with_sql(
        _CONFIG_SQL,
        "upd as (select 'tb_' || user_id as object, case when user_id % 5 = 0 then true end as active, cast(null as boolean) as rollback, '{\"dots\": 9}' as z_cfg from (select distinct user_id from events) where user_id % 2 = 0)",
    )
    + """select coalesce(c.object, u.object) as object, case when u.object is null then c.active else coalesce(u.active, c.active, true) end as active,
         case when u.object is null then c.rollback else coalesce(c.rollback, false) end as rollback, coalesce(u.z_cfg, c.z_cfg) as z_cfg,
         array_to_string(coalesce(c.z_except, []), ',') as z_except from cfg c full outer join upd u on c.object = u.object""",
)
def upsert_config(t):
    updates = t.events.select("user_id").distinct().where("user_id % 2 = 0").selectExpr(
        "concat('tb_', user_id) as object", "case when user_id % 5 = 0 then true end as active", "cast(null as boolean) as rollback",
        "'{\"dots\": 9}' as z_cfg", "cast(null as array<date>) as z_except", "cast(null as array<date>) as z_error",
    )
    out = ops.upsert_config(_config(t), updates)
    return out.select("object", "active", "rollback", "z_cfg", F.concat_ws(",", F.col("z_except").cast("array<string>")).alias("z_except"))


_UPDATES = """select concat('tb_', user_id) as object, event_id as seq, case event_id % 5 when 0 then true when 1 then false end as active,
  case event_id % 7 when 0 then true when 1 then false end as rollback, case when event_id % 4 <> 0 then concat('{"dots": ', event_id % 9, '}') end as z_cfg
  from events where user_id % 2 = 0 and event_id % 13 < 4"""


@query(
    "Z8_upsert_in_order",
    fx.with_sql(
        _CONFIG_SQL,
        f"upd as ({_UPDATES})",
        """new as (select object, arg_max(active, seq) filter (active is not null) as active, arg_max(rollback, seq) filter (rollback is not null) as rollback,
             arg_max(z_cfg, seq) filter (z_cfg is not null) as z_cfg from upd group by 1)""",
    )
    + """select coalesce(c.object, n.object) as object, case when n.object is null then c.active else coalesce(n.active, c.active, true) end as active,
         case when n.object is null then c.rollback else coalesce(n.rollback, c.rollback, false) end as rollback, coalesce(n.z_cfg, c.z_cfg) as z_cfg
         from cfg c full outer join new n on c.object = n.object""",
)
def upsert_in_order(t):
    updates = t.events.selectExpr("user_id", "event_id").where("user_id % 2 = 0 and event_id % 13 < 4").selectExpr(
        "concat('tb_', user_id) as object", "event_id as seq", "case event_id % 5 when 0 then true when 1 then false end as active",
        "case event_id % 7 when 0 then true when 1 then false end as rollback",
        "case when event_id % 4 <> 0 then concat('{\"dots\": ', event_id % 9, '}') end as z_cfg",
        "cast(null as array<date>) as z_except", "cast(null as array<date>) as z_error",
    )
    return ops.upsert_config(_config(t), updates, "seq").select("object", "active", "rollback", "z_cfg")


@query(
    "Z8_toggle_dates",
    fx.with_sql(_CONFIG_SQL)
    + """select object, case when cast(substr(object, 4) as int) % 5 = 0 then '2024-03-01,2024-01-01' when cast(substr(object, 4) as int) % 5 = 1 then '2024-02-01,2024-01-02,2024-01-01'
           else '2024-01-02,2024-01-01' end as z_except from cfg""",
)
def toggle_dates(t):
    users = t.events.select("user_id").distinct()
    days = "case user_id % 5 when 0 then array(date '2024-01-02', date '2024-03-01') when 1 then array(date '2024-02-01') else array(date '2024-02-05', date '2024-02-05') end"
    changes = users.where("user_id % 5 < 3").selectExpr("concat('tb_', user_id) as object", f"explode({days}) as day")
    out = ops.toggle_dates(_config(t), changes, "z_except")
    return out.select("object", F.concat_ws(",", F.col("z_except").cast("array<string>")).alias("z_except"))


@query(
    "Z9_verdict_view",
    fx.with_sql(_ROW_TOTALS, _CONFIG_SQL.replace("[date '2024-01-02', date '2024-01-01']", "[date '2024-01-12', date '2024-01-11']"))
    + """select 'tb_' || user_id as object, key_date, coalesce(ztest, rows_count / 40.0 - 4 between -5 and 5) as ztest_ok,
           list_contains(z_except, key_date) as is_except, list_contains(z_error, key_date) as is_error,
           coalesce(cast(round(100 - 2 * abs(rows_count / 40.0 - 4)) as int), 0) as confidence, round(n / nullif(rows_count, 0), 6) as stable, rollback as error
         from totals left join cfg on cfg.object = 'tb_' || user_id and active""",
)
def verdict_view(t):
    data = _row_totals(t).select(
        "ts", F.concat(F.lit("tb_"), "user_id").alias("object"), "key_date", "rows_count", "value", "ztest", "log_id",
        (F.col("rows_count") / F.lit(40.0) - 4).alias("zscore"), F.lit(1).alias("key_diff"), F.col("rows_count").alias("avg"),
        F.col("n").alias("std"), F.lit(1).alias("cnt"), F.lit(0).alias("min"), F.lit(9).alias("max"),
    )
    config = _config(t).withColumn("z_except", F.expr("array(date '2024-01-12', date '2024-01-11')"))
    view = ops.verdict_view(data, config)
    return view.select(
        "object", "key_date", "ztest_ok", "is_except", "is_error", "confidence", F.round("stable", 6).alias("stable"), "error"
    )
