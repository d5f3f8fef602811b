"""Queries of the data-quality metrics (Q)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.periods import interval_start, interval_start_sql
from millrace.operators import quality as ops
from millrace.operators.quality import Period, Rule, VolumeCheck
from millrace.plans import fixtures as fx
from millrace.plans.registry import query

DAY = dt.date(2024, 1, 20)
SHIP = dt.date(1998, 6, 30)


@query(
    "Q0_interval_start",
    """with d as (select distinct cast(o_orderdate as date) as day, cast(o_orderkey % 3 as int) as qty, u.unit
         from orders, (values ('year'), ('quarter'), ('month'), ('month_ld'), ('month_fd'), ('week'), ('day'), ('other')) u(unit))
       select day, qty, unit, cast(case unit when 'year' then day - to_months(12 * qty) when 'quarter' then day - to_months(4 * qty)
         when 'month' then day - to_months(qty) when 'month_ld' then last_day(cast(day - to_months(qty) as date))
         when 'month_fd' then date_trunc('month', day - to_months(qty)) when 'week' then day - 7 * qty when 'day' then day - qty end as date) as start from d""",
)
def interval_starts(t):
    units = F.array(*[F.lit(u) for u in ("year", "quarter", "month", "month_ld", "month_fd", "week", "day", "other")])
    days = t.orders.selectExpr("cast(o_orderdate as date) as day", "cast(o_orderkey % 3 as int) as qty").distinct()
    return days.withColumn("unit", F.explode(units)).selectExpr(
        "day", "qty", "unit", f"{interval_start_sql('day', 'unit', 'qty')} as start"
    )


@query(
    "Q1_aggregate_drift",
    """with a as (select sum(l_quantity) as v from lineitem where cast(l_shipdate as date) = date '1998-06-30'),
       b as (select sum(l_quantity) as v from lineitem where cast(l_shipdate as date) = date '1998-05-30')
       select round((coalesce(b.v, 0) - a.v) / nullif(a.v, 0), 5) as pct from a, b""",
)
def aggregate_drift(t):
    return ops.aggregate_drift(t.lineitem, "l_shipdate", "sum(l_quantity)", SHIP, "month", 1)


@query(
    "Q2_grouped_drift",
    """with a as (select l_returnflag as g, sum(l_quantity) as v from lineitem where cast(l_shipdate as date) = date '1998-06-30' group by 1),
       b as (select l_returnflag as g, sum(l_quantity) as v from lineitem where cast(l_shipdate as date) = date '1998-06-23' group by 1)
       select round(max((coalesce(b.v, 0) - a.v) / nullif(a.v, 0)), 5) as pct from a join b on a.g = b.g""",
)
def grouped_drift(t):
    return ops.grouped_drift(t.lineitem, "l_shipdate", "l_returnflag", "sum(l_quantity)", SHIP, "week", 1)


@query(
    "Q3_freshness",
    """with m as (select max(cast(ts as date)) as d from events)
       select 'day' as unit, d as max_date, cast(date '2024-05-02' - d as double) as date_diff from m
       union all select 'week', d, round((date '2024-05-02' - d) / 7, 6) from m
       union all select 'month', d, cast(5 - month(d) as double) from m
       union all select unit, d, round((12 * (2024 - year(d)) + 5 - month(d) + case when day(d) = 2 then 0 else (2 - day(d)) / 31.0 end) / k, 6)
         from m, (values ('quarter', 4), ('year', 12)) as u(unit, k)""",
)
def freshness(t):
    at = dt.date(2024, 5, 2)
    frames = [ops.freshness(t.events, "ts", at, u).select(F.lit(u).alias("unit"), "*") for u in ("day", "week", "month", "quarter", "year")]
    return reduce(DataFrame.unionByName, frames)


@query(
    "Q4_non_null_ratio",
    fx.with_sql(
        "e as (select ts, case when event_id % 10 = 0 then null when event_id % 10 = 1 then '' else event_type end as kind, value from events)"
    )
    + """select 'kind' as column_name, round(count(nullif(kind, '')) / count(*), 6) as nonnull_ratio from e
         where cast(ts as date) between date '2024-01-13' and date '2024-01-20'
         union all select 'value', round(count(value) / count(*), 6) from e where cast(ts as date) between date '2024-01-13' and date '2024-01-20'""",
)
def non_null_ratio(t):
    kind = F.when(F.col("event_id") % 10 == 0, None).when(F.col("event_id") % 10 == 1, "").otherwise(F.col("event_type"))
    return ops.non_null_ratio(t.events.withColumn("kind", kind), ["kind", "value"], "ts", dt.date(2024, 1, 13), DAY)


@query(
    "Q5_out_of_range",
    "select count(*) as cnt_not_in_range from lineitem where l_quantity not between 5 and 45",
)
def out_of_range(t):
    return ops.out_of_range(t.lineitem, "l_quantity", "int", "5", "45")


_ODD_DATES = "cast(case when event_id % 100 = 0 then date '1969-12-31' when event_id % 101 = 0 then date '2100-01-02' else cast(ts as date) end as date)"


@query(
    "Q6_insane_dates",
    f"""select count(*) as cnt_not_in_range from (select {_ODD_DATES} as d from events)
        where d not between date '1970-01-01' and date '2100-01-01'""",
)
def insane_dates(t):
    return ops.insane_dates(t.events.selectExpr(f"{_ODD_DATES} as d"), "d")


def _psi_categ_sql(column, table, date, b, t):
    side = "(select cast({c} as varchar) as val, count(*) / sum(count(*)) over () as pct from {tb} where cast({d} as date) between date '{lo}' and date '{hi}' group by 1)"
    bench = side.format(c=column, tb=table, d=date, lo=b[0], hi=b[1])
    target = side.format(c=column, tb=table, d=date, lo=t[0], hi=t[1])
    return f"""select round(abs(sum((coalesce(b.pct, 0) - coalesce(t.pct, 0)) *
      ln(coalesce(nullif(coalesce(b.pct, 0), 0), 1e-4) / coalesce(nullif(coalesce(t.pct, 0), 0), 1e-4)))), 4) as psi
      from {bench} b full outer join {target} t on coalesce(b.val, 'xxx') = coalesce(t.val, 'xxx')"""


@query("Q7_stability_categorical", _psi_categ_sql("event_type", "events", "ts", ("2024-01-03", "2024-01-10"), ("2024-01-13", "2024-01-20")))
def stability_categorical(t):
    return ops.stability_categorical(
        t.events, "event_type", "ts", Period.ending(dt.date(2024, 1, 10), "week", 1), Period.ending(DAY, "week", 1)
    )


@query(
    "Q7_stability_long_values",
    _psi_categ_sql("repeat('x', 150) || event_type || user_id % 50", "events", "ts", ("2024-01-03", "2024-01-10"), ("2024-01-13", "2024-01-20")),
)
def stability_long_values(t):
    """Categories that differ only after 150 equal characters."""
    rows = t.events.selectExpr("ts", "concat(repeat('x', 150), event_type, user_id % 50) as category")
    return ops.stability_categorical(rows, "category", "ts", Period.ending(dt.date(2024, 1, 10), "week", 1), Period.ending(DAY, "week", 1))


def _psi_cont_sql(value, table, date, b, t):
    def side(lo, hi):
        return f"""(select decile, min(val) as lbound, max(val) as own_max, count(*) as qty, count(*) / sum(count(*)) over () as pct from (
          select {value} as val, (rank() over (order by {value} nulls last)) * 10 // count({value}) over () as decile
          from {table} where cast({date} as date) between date '{lo}' and date '{hi}') group by 1)"""

    return f"""with x as (select cast(b.decile as varchar) as group_cd, cast(b.lbound as double) as lbound,
        cast(case when b.decile <= 0 then b.own_max else coalesce(lead(b.lbound) over (order by b.decile), 24) end as double) as ubound,
        b.pct as pct_bench, t.pct as pct_target, (b.pct - t.pct) * ln(b.pct / t.pct) as psi
        from {side(*b)} b left join {side(*t)} t on b.decile = t.decile)
      select case when grouping(group_cd) = 1 then '9999' else group_cd end as group_cd, lbound, ubound,
        round(pct_bench, 6) as pct_bench, round(pct_target, 6) as pct_target, round(sum(psi), 4) as psi
      from x group by grouping sets ((group_cd, lbound, ubound, pct_bench, pct_target), ())"""


@query("Q8_stability_continuous", _psi_cont_sql("l_extendedprice", "lineitem", "l_shipdate", ("1997-06-30", "1998-06-30"), ("1998-06-30", "1999-06-30")))
def stability_continuous(t):
    return ops.stability_continuous(
        t.lineitem, "l_extendedprice", "l_shipdate", Period.ending(SHIP, "year", 1), Period.ending(dt.date(1999, 6, 30), "year", 1)
    )


@query("Q8_stability_with_ties_and_nulls", _psi_cont_sql("nullif(l_quantity, 7)", "lineitem", "l_shipdate", ("1998-02-28", "1998-06-30"), ("1998-06-30", "1998-10-30")))
def stability_ties(t):
    rows = t.lineitem.withColumn("l_quantity", F.expr("nullif(l_quantity, 7)"))
    return ops.stability_continuous(
        rows, "l_quantity", "l_shipdate", Period(dt.date(1998, 2, 28), SHIP), Period(SHIP, dt.date(1998, 10, 30)), buckets=16
    )


@query("Q9_stability_date", _psi_cont_sql("(cast(o_orderdate as date) - date '2000-01-01')", "orders", "o_orderdate", ("1997-06-30", "1998-06-30"), ("1998-05-30", "1998-09-30")))
def stability_date(t):
    return ops.stability_date(
        t.orders, "o_orderdate", "o_orderdate", Period.ending(SHIP, "year", 1), Period.ending(dt.date(1998, 9, 30), "quarter", 1)
    )


@query(
    "Q10_sql_metric",
    "select cast(count(distinct user_id) as double) as calc_value from events where cast(ts as date) between date '2024-01-13' and date '2024-01-20'",
)
def sql_metric(t):
    sql = "select cast(count(distinct user_id) as double) from {e}"
    return ops.sql_metric(t.spark, sql, {"e": t.events}, "ts", DAY, "week", 1)


@query(
    "Q11_period_volume",
    """with c as (select cast(l_shipdate as date) as rd, count(*) as cnt from lineitem
         where cast(l_shipdate as date) in (date '1998-06-30', date '1998-05-31', date '1998-04-30') group by 1),
       v as (select (select cnt from c where rd = date '1998-06-30') as n, (select cnt from c where rd = date '1998-05-31') as p,
         (select avg(cnt) from c where rd < date '1998-06-30') as a)
       select 'nonnull_volume' as metric, 'lineitem' as tbl, 'l_quantity' as fn,
         cast(case when coalesce(n / a, n / p) between 0.5 and 1.5 then 1 else 0 end as int) as res,
         date '1998-06-30' as dt, n as val2chk, round(n / p, 6) as ratio_1, round(n / a, 6) as ratio_3, cast(null as varchar) as error from v""",
)
def period_volume(t):
    check = VolumeCheck("lineitem", "l_quantity", "l_shipdate", low=0.5, high=1.5)
    return ops.period_volume(t.lineitem, [check], dt.date(1998, 7, 15))


CHECKS = [
    VolumeCheck("lineitem", "l_quantity", "l_shipdate", low=0.5, high=1.5),
    VolumeCheck("lineitem", "l_tax", "l_shipdate", low=0.5, high=1.5),
    VolumeCheck("lineitem", "l_discount", "l_shipdate", low=5.0, high=9.0),
    VolumeCheck("orders", "o_totalprice", "o_orderdate", low=0.1, high=9.0),
    VolumeCheck("events", "value", "ts", low=0.1, high=9.0),
    VolumeCheck("orders", "no_such_column", "o_orderdate", low=0.1, high=9.0),
    VolumeCheck("part", "p_size", "p_size", low=0.1, high=9.0, active=False),
    VolumeCheck("orders", "o_totalprice", "o_orderdate", metric="aggregate_drift", low=-0.5, high=0.5),
    VolumeCheck("lineitem", "l_shipdate", "l_shipdate", metric="freshness", unit="day", low=-9999, high=0),
    VolumeCheck("lineitem", "l_tax", "l_shipdate", metric="nonnull_ratio", low=1.0, high=1.0),
    VolumeCheck("lineitem", "l_quantity", "l_shipdate", metric="out_of_range", low=0, high=0, params={"low": 1, "high": 10}),
    VolumeCheck("lineitem", "l_returnflag", "l_shipdate", metric="stability_categorical", low=0, high=0.5),
    VolumeCheck("lineitem", "l_discount", "l_shipdate", metric="out_of_range", low=0, high=0, params={"kind": "no such type", "low": 1, "high": 10}),
    VolumeCheck("lineitem", "l_discount", "l_shipdate", metric="no_such_metric"),
]


def _suite(t):
    tables = {"lineitem": t.lineitem, "orders": t.orders, "events": t.events, "part": t.part}
    return ops.check_suite(t.spark, CHECKS, tables, dt.date(1998, 7, 15))


def _vol_sql(table, field, date, lo, hi):
    return f"""select 'nonnull_volume' as metric, '{table}' as tbl, '{field}' as fn,
      cast(case when n is null then -1 when coalesce(n / a, n / p) between {lo} and {hi} then 1 else 0 end as int) as res, date '1998-06-30' as dt from (
      select count({field}) filter (cast({date} as date) = date '1998-05-31') as p,
        nullif(count({field}) filter (cast({date} as date) = date '1998-06-30'), 0) as n,
        count({field}) filter (cast({date} as date) in (date '1998-04-30', date '1998-05-31')) / 2 as a from {table})"""


_END, _BEFORE = dt.date(1998, 6, 30), interval_start(dt.date(1998, 6, 30), "month", 1)
_SHIFT = Period.ending(_BEFORE - dt.timedelta(days=1), "month", 1)


def _metric_sql(metric, table, field, value, low, high, end="date '1998-06-30'"):
    return f"""select '{metric}', '{table}', '{field}', cast(case when v is null then -1 when v between {low} and {high} then 1 else 0 end as int), {end}
      from (select ({value}) as v)"""


_SUITE_SQL = "suite as (" + " union all ".join(
    [_vol_sql(c.table, c.field, c.date_column, c.low, c.high) for c in CHECKS[:5]]
    + [
        "select 'nonnull_volume', 'orders', 'no_such_column', -99, null",
        "select 'out_of_range', 'lineitem', 'l_discount', -99, null",
        "select 'no_such_metric', 'lineitem', 'l_discount', -99, null",
        _metric_sql("aggregate_drift", "orders", "o_totalprice", f"""select round((coalesce(sum(o_totalprice) filter (cast(o_orderdate as date) = date '{_BEFORE}'), 0)
          - sum(o_totalprice) filter (cast(o_orderdate as date) = date '{_END}')) / nullif(sum(o_totalprice) filter (cast(o_orderdate as date) = date '{_END}'), 0), 5) from orders""", -0.5, 0.5),
        _metric_sql("freshness", "lineitem", "l_shipdate", "select date '1998-07-14' - max(cast(l_shipdate as date)) from lineitem", -9999, 0, "date '1998-07-14'"),
        _metric_sql("nonnull_ratio", "lineitem", "l_tax", f"""select round(count(nullif(cast(l_tax as varchar), '')) / nullif(count(*), 0), 6) from lineitem
          where cast(l_shipdate as date) between date '{_BEFORE}' and date '{_END}'""", 1, 1),
        _metric_sql("out_of_range", "lineitem", "l_quantity", "select count(*) filter (not l_quantity between 1 and 10) from lineitem", 0, 0),
        _metric_sql("stability_categorical", "lineitem", "l_returnflag", _psi_categ_sql(
            "l_returnflag", "lineitem", "l_shipdate", (str(_SHIFT.first), str(_SHIFT.last)), (str(_BEFORE), str(_END))), 0, 0.5),
    ]
) + ")"


@query("Q12_check_suite", fx.with_sql(_SUITE_SQL) + "select * from suite")
def check_suite(t):
    return _suite(t).select("metric", "tbl", "fn", "res", "dt")


@query(
    "Q12_suite_summary",
    fx.with_sql(_SUITE_SQL)
    + """select 'True ' || count(*) filter (res > 0) || ', False ' || count(*) filter (res = 0) || ', Error ' || count(*) filter (res < 0) as msg,
         min(res) as worst, count(*) as cnt, count(distinct tbl) as tbl_cnt, count(distinct fn) as fn_cnt, count(distinct dt) as dt_cnt,
         count(distinct metric) as mt_cnt, case when min(res) < 0 then 'Error' when min(res) > 0 then 'True' else 'False' end as verdict,
         cast(case when min(res) > 0 then 1 else -1 end as int) as res from suite""",
)
def suite_summary(t):
    return ops.suite_summary(_suite(t))


@query(
    "Q12_suite_report",
    fx.with_sql(_SUITE_SQL)
    + """select metric, tbl, res, dt, cast(count(*) as int) as features, string_agg(fn, ', ' order by fn) as feature
         from suite group by metric, tbl, res, dt, case when res > 0 then '' else fn end""",
)
def suite_report(t):
    return ops.suite_report(_suite(t)).drop("msg")


@query(
    "Q12_suite_stability_and_sql",
    "with p as (select psi from ("
    + _psi_cont_sql("(cast(o_orderdate as date) - date '2000-01-01')", "orders", "o_orderdate", ("1998-03-29", "1998-05-29"), ("1998-05-30", "1998-06-30"))
    + """) where group_cd = '9999'),
       v as (select 'stability_date' as metric, 'o_orderdate' as fn, cast(psi as double) as value, 0 as low, 0.25 as high from p
         union all select 'sql_metric', 'o_custkey', cast(count(distinct o_custkey) as double), 1, 20 from orders
         where cast(o_orderdate as date) between date '1998-05-30' and date '1998-06-30')
       select metric, 'orders' as tbl, fn, cast(case when value is null then -1 when value between low and high then 1 else 0 end as int) as res,
         date '1998-06-30' as dt, round(value, 6) as ratio_1 from v""",
)
def suite_stability_and_sql(t):
    checks = [
        VolumeCheck("orders", "o_orderdate", "o_orderdate", low=0, high=0.25, metric="stability_date", params={"bench_units": 2}),
        VolumeCheck("orders", "o_custkey", "o_orderdate", low=1, high=20, metric="sql_metric",
                    params={"sql": "select cast(count(distinct o_custkey) as double) from {t}"}),
    ]
    out = ops.check_suite(t.spark, checks, {"orders": t.orders}, dt.date(1998, 7, 15))
    return out.select("metric", "tbl", "fn", "res", "dt", "ratio_1")


@query(
    "Q13_stability_suite",
    "select 'r_type' as rule_name, 'stab_categ' as rule_type, psi from ("
    + _psi_categ_sql("event_type", "events", "ts", ("2023-12-15", "2024-01-15"), ("2023-12-30", "2024-01-30"))
    + ") union all select 'r_value', 'stab_cont', psi from ("
    + _psi_cont_sql("value", "e", "ts", ("2023-12-15", "2024-01-15"), ("2023-12-30", "2024-01-30")).replace(
        "with x as", "with e as (select * from events), x as"
    )
    + ") where group_cd = '9999'",
)
def stability_suite(t):
    rules = [
        Rule("r_type", "stab_categ", "stg.events", "event_type", "ts"),
        Rule("r_value", "stab_cont", "stg.events", "value", "ts"),
        Rule("r_off", "stab_cont", "stg.events", "value", "ts", on=False),
    ]
    stage = t.events.where("cast(ts as date) <= date '2024-01-15'")
    return ops.stability_suite(stage, t.events, rules, "stg.events", read_from=t.events)


@query(
    "Q14_freshness_fill_suite",
    """select 'r_fresh' as rule_name, 'max_date' as rule_type, cast(date '2024-03-01' - max(cast(ts as date)) as double) as value from events
       union all select 'r_fill', 'nonnull_ratio', round(count(nullif(event_type, '')) / count(*), 6) from events""",
)
def freshness_fill(t):
    rules = [
        Rule("r_fresh", "max_date", "stg.events", "ts"),
        Rule("r_fill", "nonnull_ratio", "stg.events", "event_type", "ts"),
        Rule("r_other", "max_date", "stg.orders", "o_orderdate"),
    ]
    return ops.freshness_fill_suite(t.events, rules, "stg.events", dt.date(2024, 3, 1))


def _rules(t):
    return t.events.groupBy("user_id").agg(F.min("event_id").alias("e")).selectExpr(
        "concat('rule_', user_id) as rule_name", "concat('tb_', user_id % 9) as rule_table_name", "'value' as rule_field_name",
        "case user_id % 2 when 0 then 'max_date' else 'nonnull_ratio' end as rule_type_cd", "cast(50 as double) as rule_upper_value",
    )


_RULES_SQL = """rules as (select distinct 'rule_' || user_id as rule_name, 'tb_' || (user_id % 9) as rule_table_name, 'value' as rule_field_name,
  case user_id % 2 when 0 then 'max_date' else 'nonnull_ratio' end as rule_type_cd, cast(50 as double) as rule_upper_value from events)"""
_METRIC = "select 'rule_' || user_id as rule_name, ts as calc_dt, cast(ts as date) as load_dt, case when event_id % 9 = 0 then null else round(value, 2) end as value, event_id from events"


def _metrics(t):
    every = t.events.selectExpr(
        "concat('rule_', user_id) as rule_name", "ts as calc_dt", "cast(ts as date) as load_dt",
        "case when event_id % 9 = 0 then null else round(value, 2) end as value", "user_id",
    )
    return {
        "max_date": every.where("user_id % 2 = 0").drop("user_id"),
        "nonnull_ratio": every.where("user_id % 2 = 1").drop("user_id"),
    }


_STATUS_SQL = f"""metric as ({_METRIC}),
  latest as (select * from metric qualify row_number() over (partition by rule_name order by calc_dt desc, load_dt desc, value desc nulls first) = 1),
  status as (select distinct r.rule_name, rule_table_name, rule_field_name, rule_type_cd, rule_upper_value as control_value, value as actual_value,
    cast(case when value is null then 0 when rule_type_cd = 'nonnull_ratio' and value >= rule_upper_value then 1
      when rule_type_cd = 'max_date' and value <= rule_upper_value then 1 else 0 end as int) as is_passed, load_dt
    from rules r join latest l on r.rule_name = l.rule_name)"""


@query("Q15_status_mart", fx.with_sql(_RULES_SQL, _STATUS_SQL) + "select * from status")
def status_mart(t):
    return ops.status_mart(_rules(t), _metrics(t))


@query(
    "Q16_status_history",
    fx.with_sql(
        _RULES_SQL,
        _STATUS_SQL,
        """hist as (select rule_name, rule_table_name, rule_field_name, rule_type_cd, control_value, actual_value, is_passed, load_dt,
             date '2024-01-01' as effective_from, case when rule_table_name in ('tb_1', 'tb_2') then date '2024-01-05' else date '9999-12-31' end as effective_to from status)""",
    )
    + """select h.* replace (case when h.actual_value is null then 0 else h.is_passed end as is_passed,
           case when h.effective_to = date '9999-12-31' and h.rule_table_name <> 'tb_3' then date '2024-02-01' else h.effective_to end as effective_to) from hist h
         union all select *, date '2024-02-01', date '9999-12-31' from status where rule_table_name <> 'tb_3'""",
)
def status_history(t):
    status = ops.status_mart(_rules(t), _metrics(t))
    closed = F.col("rule_table_name").isin("tb_1", "tb_2")
    hist = status.withColumns(
        {
            "effective_from": F.lit(dt.date(2024, 1, 1)),
            "effective_to": F.when(closed, F.lit(dt.date(2024, 1, 5))).otherwise(F.lit(ops.OPEN_END)),
        }
    )
    return ops.status_history(hist, status.where("rule_table_name <> 'tb_3'"), dt.date(2024, 2, 1))


@query(
    "Q17_validity_gaps",
    fx.with_sql(fx.intervals_sql())
    + """select count(*) as cnt from (select *, coalesce(lag(date_finish) over (partition by user_id order by date_finish, date_start, event_id), date_start) as p from intervals)
         where date_start <> p and date_start - 1 <> p""",
)
def validity_gaps(t):
    return ops.validity_gap_count(fx.intervals(t), ["user_id"], "date_start", "date_finish", ["date_start", "event_id"])


@query(
    "Q18_key_and_volume_status",
    """select 'orders' as object_name, 'OK' as count_status, 'OK' as pk_status from (select count(*) as c from orders) where c > 0
       union all select 'lineitem', 'OK (' || count(*) || ')', case when count(*) > count(distinct (l_orderkey, l_linenumber)) then 'ERROR' else 'OK' end from lineitem
       union all select 'events', case when max(n) > 300 then 'ERROR' else 'OK' end, 'ERROR' from (select count(*) as n from events group by cast(ts as date))""",
)
def key_and_volume(t):
    a = ops.key_and_volume_status(t.orders, "orders", ["o_orderkey"], 100000, "o_orderdate")
    b = ops.key_and_volume_status(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"], 10**12)
    days = t.events.withColumn("day", F.to_date("ts"))
    c = ops.key_and_volume_status(days, "events", ["user_id"], 300, "day")
    return a.unionByName(b).unionByName(c)


@query(
    "Q19_last_delta_percent",
    """with c as (select cast(ts as date) as d, count(*) as n from events group by 1 order by 1 desc limit 2)
       select round((max_by(n, d) - min_by(n, d)) / min_by(n, d) * 100, 6) as delta from c""",
)
def last_delta(t):
    return ops.last_delta_percent(t.events.withColumn("day", F.to_date("ts")), "day")


@query(
    "Q20_monthly_coverage",
    """select cast(date_trunc('month', o_orderdate) as date) as dt, count(*) as cnt, count(distinct cast(o_orderdate as date)) as cnt_dt,
         round(count(distinct epoch(o_orderdate) // 600) / count(distinct cast(o_orderdate as date)) / 24 / 6, 6) as slot_share,
         count(distinct o_custkey) as cnt_snd, count(distinct o_custkey % 100) as cnt_snd_id,
         round(count(distinct o_custkey % 100) / count(distinct o_custkey), 6) as dq_snd,
         count(distinct o_custkey) - count(distinct o_custkey % 100) as cnt_snd_null,
         count(distinct o_orderpriority) as cnt_rcv, count(distinct o_orderstatus) as cnt_rcv_id,
         round(count(distinct o_orderstatus) / count(distinct o_orderpriority), 6) as dq_rcv,
         count(distinct o_orderpriority) - count(distinct o_orderstatus) as cnt_rcv_null from orders group by 1""",
)
def monthly_coverage(t):
    rows = t.orders.withColumn("cust100", F.col("o_custkey") % 100)
    return ops.monthly_coverage(rows, "o_orderdate", "o_custkey", "cust100", "o_orderpriority", "o_orderstatus")


@query(
    "Q21_check_log",
    fx.with_sql(fx.RUN_LOG)
    + """select a.id, a.ts, a.action as metric, a.workflow as tbl, cast(a.extra as varchar) as params,
         cast(epoch(b.ts) - epoch(a.ts) as bigint) as duration_s, b.action as res_msg from run_log a join run_log b on a.id = b.parent""",
)
def check_log(t):
    log = fx.run_log(t).withColumn(
        "message",
        F.when(
            F.col("parent").isNull(),
            F.to_json(F.struct(F.get_json_object("message", "$.wf").alias("tbl"), F.get_json_object("message", "$.extra").alias("params"))),
        ).otherwise(F.col("message")),
    )
    return ops.check_log(log).drop("msg")
