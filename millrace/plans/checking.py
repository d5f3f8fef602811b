"""Queries of the checks, profiles and reconciliations (C)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.parsing import FALSE_WORDS, TRUE_WORDS
from millrace.operators import checks as ops
from millrace.plans import fixtures as fx
from millrace.plans.registry import query


@query(
    "C1_null_counts",
    fx.with_sql(fx.PART_NULLS)
    + " union all ".join(
        f"select '{c}' as column_name, count(*) filter (nullif(nullif(cast({c} as varchar), ''), ' ') is null) as null_cnt from part_nulls"
        for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    ),
)
def null_counts(t):
    return ops.null_counts(fx.part_nulls(t))


_DUP_SQL = (
    fx.with_sql(
        fx.intervals_sql(),
        "cd as (select date_start as d from intervals union select date_finish from intervals)",
        "hit as (select d, user_id, count(*) as c from cd join intervals on d between date_start and date_finish group by 1, 2 having count(*) > 1)",
    )
    + "select user_id, cast(sum(c) as bigint) as cnt from hit group by 1"
)


@query("C2_temporal_duplicates", _DUP_SQL)
def temporal_duplicates(t):
    return ops.temporal_duplicates(fx.intervals(t), ["user_id"], "date_start", "date_finish")


@query("C2_uniqueness_verdict", f"select count(*) as err, 'Uniq check errors = ' || count(*) as msg from ({_DUP_SQL})")
def uniqueness_verdict(t):
    return ops.uniqueness_verdict(ops.temporal_duplicates(fx.intervals(t), ["user_id"], "date_start", "date_finish"))


_BGN = "case when event_id % 5 = 0 then null else date_start end as bgn"
_FIN = "case when date_finish > date '9000-01-01' then null else date_finish end as fin"


@query(
    "C3_mapping_duplicates",
    fx.with_sql(
        fx.intervals_sql(),
        f"m as (select user_id, {_BGN}, {_FIN} from intervals)",
        "cd as (select bgn as d from m union select fin from m union select date '2024-02-10')",
    )
    + """select distinct user_id from (select d, user_id from cd join m on d between coalesce(bgn, date '2000-01-01') and coalesce(fin, date '2024-02-10')
         group by 1, 2 having count(*) > 1)""",
)
def mapping_duplicates(t):
    m = fx.intervals(t).selectExpr("user_id", _BGN, _FIN)
    return ops.mapping_duplicates(m, "user_id", "bgn", "fin", dt.date(2024, 2, 10))


@query(
    "C4_change_status",
    """with cur as (select o_orderpriority as object, cast(max(cast(o_orderdate as date)) as varchar) as value, count(*) as cnt from orders group by 1
         union all select '9-NONE', 'x', 0),
       acc as (select o_orderpriority as object, cast(case when left(o_orderpriority, 1) in ('1', '2') then max(cast(o_orderdate as date)) else min(cast(o_orderdate as date)) end as varchar) as value,
         case when left(o_orderpriority, 1) = '2' then timestamp '2024-01-01' else timestamp '2024-02-01' end as ts from orders group by 1)
       select c.object, cast(case when cnt = 0 then -1 when c.value = a.value and ts >= timestamp '2024-01-15' then 0 when c.value = a.value then -2 else 1 end as int) as res,
         case when cnt = 0 then 'Empty' when c.value = a.value and ts >= timestamp '2024-01-15' then 'No new' when c.value = a.value then 'Expire' else 'Ok' end as msg,
         ts as last, cnt from cur c left join acc a on a.object = c.object""",
)
def change_status(t):
    days = t.orders.withColumn("d", F.to_date("o_orderdate"))
    top = days.groupBy(F.col("o_orderpriority").alias("object")).agg(
        F.max("d").cast("string").alias("value"), F.count(F.lit(1)).alias("cnt"), F.min("d").cast("string").alias("low")
    )
    none = top.agg(F.lit("9-NONE").alias("object"), F.lit("x").alias("value"), F.lit(0).cast("bigint").alias("cnt"))
    head = F.left("object", F.lit(1))
    accepted = top.select(
        "object",
        F.when(head.isin("1", "2"), F.col("value")).otherwise(F.col("low")).alias("value"),
        F.when(head == "2", F.lit(dt.datetime(2024, 1, 1))).otherwise(F.lit(dt.datetime(2024, 2, 1))).alias("ts"),
    )
    return ops.change_status(top.drop("low").unionByName(none), accepted, dt.datetime(2024, 1, 15))


_STORED = [*fx.ORDER_COLUMNS, "load_date"]
_PARTS = """select {by} count(*) as cnt, bit_xor(h) as x, cast(sum(h % 1000000007) as bigint) as s from
  (select *, cast('0x' || left({hash}, 15) as bigint) as h from {table}) {group}"""
_CONTENT = "md5(concat_ws('|', coalesce(x, 0), coalesce(s, 0), cnt))"


def _parts_sql(table, columns, by=None, group="group by 1"):
    return _PARTS.format(by=f"{by}," if by else "", hash=fx.hash_sql(columns), table=table, group=group if by else "")


@query(
    "C4_fingerprint_ranges",
    fx.with_sql(fx.ORDERS_OLD)
    + f"""select {_CONTENT} as hash, cnt, lmin, lmax, kmin, kmax from ({_parts_sql("orders_old", _STORED)}),
          (select cast(min(load_date) as varchar) as lmin, cast(max(load_date) as varchar) as lmax, cast(min(o_orderdate) as varchar) as kmin,
             cast(max(o_orderdate) as varchar) as kmax from orders_old)""",
)
def fingerprint_ranges(t):
    return ops.fingerprint(fx.orders_old(t), key="o_orderdate")


@query(
    "C4_merged_fingerprint",
    fx.with_sql(fx.ORDERS_OLD) + f"select {_CONTENT} as hash, cnt from ({_parts_sql('orders_old', _STORED)})",
)
def merged_fingerprint(t):
    parts = ops.partition_fingerprints(fx.orders_old(t), ["o_orderpriority"])
    return ops.merged_fingerprint(parts).select("hash", "cnt")


_TOUCHED = "o_orderkey % 3 <> 0 and not (o_orderpriority = '4-NOT SPECIFIED' and o_orderkey % 64 = 1) and o_orderpriority <> '5-LOW'"


@query(
    "C4_changed_partitions",
    fx.with_sql(
        fx.ORDERS_OLD,
        f"touched as (select * from orders_old where {_TOUCHED})",
        f"old as ({_parts_sql('orders_old', _STORED, 'o_orderpriority')})",
        f"now as ({_parts_sql('touched', _STORED, 'o_orderpriority')})",
    )
    + """select coalesce(now.o_orderpriority, old.o_orderpriority) as o_orderpriority, case when old.cnt is null then 'new' when now.cnt is null then 'gone' else 'changed' end as change,
         now.cnt as cnt, old.cnt as old_cnt from now full outer join old on now.o_orderpriority = old.o_orderpriority
         where now.cnt is distinct from old.cnt or now.x is distinct from old.x or now.s is distinct from old.s""",
)
def changed_partitions(t):
    old = fx.orders_old(t)
    by = ["o_orderpriority"]
    return ops.changed_partitions(ops.partition_fingerprints(old.where(_TOUCHED), by), ops.partition_fingerprints(old, by), by)


@query(
    "C5_load_statistics",
    """select 'stg.orders' as wf_obj, count(*) as rw_cnt, min(o_orderdate) as data_min, max(o_orderdate) as data_max, cast(null as timestamp) as load_min,
         cast(null as timestamp) as load_max, cast(min(o_orderkey) as varchar) as key_min, cast(max(o_orderkey) as varchar) as key_max from orders""",
)
def load_statistics(t):
    return ops.load_statistics(t.orders, "stg.orders", period="o_orderdate", key="o_orderkey")


_WORDS = ", ".join(f"'{w}'" for w in (*TRUE_WORDS, *FALSE_WORDS))


def _profile_sql(table, num, column, kind, numeric):
    low, high = ("cast(min({c}) as varchar)", "cast(max({c}) as varchar)") if numeric else ("min(cast({c} as varchar))", "max(cast({c} as varchar))")
    return f"""select {num} as fld_num, '{column}' as fld_name, '{kind}' as fld_type, count(*) as dist_cnt, cast(sum(case when v is null then n else 0 end) as bigint) as null_cnt,
      cast(sum(n) as bigint) as cnt, min(n) as min_cnt, max(n) as max_cnt, cast(round(avg(n)) as bigint) as avg_cnt, cast(min(length(v)) as int) as min_len, cast(max(length(v)) as int) as max_len,
      cast(round(avg(length(v))) as int) as avg_len, cast(round(stddev(length(v))) as int) as std_len, cast(min(octet_length(encode(v))) as int) as min_size,
      cast(round(avg(octet_length(encode(v)))) as int) as avg_size, cast(max(octet_length(encode(v))) as int) as max_size,
      count(*) filter (lower(trim(v)) in ({_WORDS})) as cnt_bool, count(*) filter (regexp_full_match(v, '\\d{{4,6}}')) as cnt_dt,
      count(*) filter (regexp_full_match(v, '\\d+')) as cnt_int, count(try_cast(nullif(trim(v), '') as double)) as cnt_float,
      count(*) filter (regexp_full_match(lower(v), '[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}')) as cnt_uuid, count(*) filter (v like '[%]' or v like '{{%}}') as cnt_array,
      count(*) filter (regexp_full_match(v, '\\d+([.]\\d+)?')) as cnt_json, count(*) = count(v) as is_not_null, count(*) = sum(n) as is_uniq,
      (select {low.format(c=column)} from {table}) as min,
      (select {high.format(c=column)} from {table}) as max
      from (select cast({column} as varchar) as v, count(*) as n from {table} group by 1)"""


@query(
    "C6_profile_columns",
    fx.with_sql(fx.PART_NULLS)
    + " union all ".join(
        _profile_sql("part_nulls", i, c, k, num)
        for i, (c, k, num) in enumerate(
            [("p_partkey", "bigint", True), ("p_name", "string", False), ("p_brand", "string", False), ("p_type", "string", False), ("p_size", "int", True), ("p_retailprice", "double", True)], 1
        )
    ),
)
def profile(t):
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    return ops.profile_columns(fx.part_nulls(t), columns).drop("fld_stat")


@query(
    "C6_inferred_classes",
    """select 'o_orderkey' as fld_name, 'int' as fld_stat union all select 'o_orderdate', 'datetime' union all select 'o_orderpriority', cast(null as varchar)
       union all select 'flag', 'bool' union all select 'pair', 'two' union all select 'nothing', 'null' union all select 'price', 'float' from orders limit 7""",
)
def inferred_classes(t):
    rows = t.orders.selectExpr(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderkey % 2 = 0 as flag", "concat('p', o_orderkey % 2) as pair",
        "cast(null as string) as nothing", "cast(o_totalprice as decimal(15,2)) as price",
    )
    return ops.profile_columns(rows).select("fld_name", "fld_stat")


_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()


@query(
    "C7_skew_statistics",
    """with u as (select l_suppkey, count(*) as n, sum(size) as size from (select l_suppkey, list_sum([coalesce(octet_length(encode(cast(c as varchar))), 0) for c in
         [{texts}]]) as size from lineitem) group by 1)
       select 'lineitem' as tbl, count(*) as segments, cast(sum(n) as bigint) as sum, min(n) as min, max(n) as max, cast(round(avg(n)) as bigint) as avg,
         cast(round(stddev(n)) as bigint) as std, round(round(stddev(n)) / nullif(round(avg(n)), 0), 6) as skew, round(1 - min(n) / avg(n), 6) as min_rate,
         round(max(n) / avg(n) - 1, 6) as max_rate, cast(sum(size) as bigint) as data_size from u""".replace(
        "{texts}", ", ".join(f"cast({c} as varchar)" for c in _LINEITEM)
    ),
)
def skew(t):
    return ops.skew_statistics(t.lineitem.select(*_LINEITEM), "lineitem", ["l_suppkey"])


@query(
    "C8_stale_statistics",
    """with tb as (select distinct user_id as tbl from events union select distinct user_id + 100000 from events where user_id < 10),
       l as (select user_id as tbl, max(ts) as last_ts from events where user_id % 7 <> 0 group by 1)
       select tb.tbl, last_ts from tb left join l on l.tbl = tb.tbl where last_ts is null or last_ts < timestamp '2024-01-31' - interval 2 day""",
)
def stale(t):
    users = t.events.select(F.col("user_id").alias("tbl"))
    tables = users.union(users.where("tbl < 10").select(F.col("tbl") + 100000)).distinct()
    log = t.events.where("user_id % 7 <> 0").select(F.col("user_id").alias("tbl"), "ts")
    return ops.stale_statistics(tables, log, dt.datetime(2024, 1, 31), 2)


@query(
    "C9_archive_completeness",
    """with f as (select cast(ts as date) as export_time, user_id % 3 as s, event_id % 3 + 1 as part, count(*) as cnt,
           count(*) + case when day(cast(ts as date)) % 4 = 0 and user_id % 3 = 0 then 1 else 0 end as announced from events group by 1, 2, 3, day(cast(ts as date)) % 4 = 0 and user_id % 3 = 0),
       g as (select export_time, s, count(distinct part) as parts, sum(cnt) as c, sum(announced) as a from f group by 1, 2)
       select day(export_time) as ctl_loading, export_time, 'src' || s as srs, parts = case when day(export_time) % 5 = 0 then 4 else 3 end as arch_ok,
         cast(case when day(export_time) % 5 = 0 then 4 else 3 end as int) as arch_cnt, c = a as cnt_ok, cast(a as bigint) as row_cnt,
         parts = case when day(export_time) % 5 = 0 then 4 else 3 end and c = a as ok from g""",
)
def archives(t):
    e = t.events.selectExpr("cast(ts as date) as export_time", "user_id % 3 as s", "event_id % 3 + 1 as part")
    sizes = e.groupBy("export_time", "s", "part").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "export_time as d", "s as s2", "part as p2",
        "n + case when day(export_time) % 4 = 0 and s = 0 then 1 else 0 end as announced",
    )
    named = e.join(sizes, (F.col("export_time") == F.col("d")) & (F.col("s") == F.col("s2")) & (F.col("part") == F.col("p2"))).selectExpr(
        "day(export_time) as ctl_loading",
        "export_time",
        "concat('EXPORT__src', s, '_', date_format(export_time, 'yyyyMMdd'), '_101500_', part, '_', case when day(export_time) % 5 = 0 then 4 else 3 end, '_', announced, '.csv.zip') as archive_name",
    )
    return ops.archive_completeness(named, "ctl_loading", "export_time", "archive_name", "EXPORT__")


@query(
    "C10_count_mismatches",
    """with g as (select cast(ts as date) as d, count(*) as n from events where day(ts) % 9 <> 0 group by 1),
       w as (select cast(ts as date) as d, count(*) + case when day(cast(ts as date)) % 6 = 0 then 5 else 0 end as c from events group by 1)
       select coalesce(w.d, g.d) as day, coalesce(c, 0) as cnt, coalesce(n, 0) as d_cnt from g full outer join w on g.d = w.d
       where c <> n or (n is null and c is not null)""",
)
def mismatches(t):
    e = t.events.withColumn("d", F.to_date("ts"))
    expected = e.groupBy("d").agg(F.count(F.lit(1)).alias("n")).selectExpr("d as wd", "n + case when day(d) % 6 = 0 then 5 else 0 end as c")
    return ops.count_mismatches(e.where("day(ts) % 9 <> 0"), "d", expected, "wd", "c")


_RULES = [
    ops.DateRule("events", "max(cast(ts as date))", ">=", "date '2024-01-20'"),
    ops.DateRule("events", "min(cast(ts as date))", ">=", "date '2024-01-15'", "event_type = 'click'"),
    ops.DateRule("orders", "max(cast(o_orderdate as date))", ">", "date '2001-01-01'"),
]
_RULES_SQL = " union all ".join(
    f"select {r.date} {r.operation} ({r.condition}) as res, '{r.table}' as tbl, {r.date} as bdate, '{r.operation} ' || $${r.condition}$$ as msg from {r.table} where {r.where}"
    for r in _RULES
)


@query("C11_business_dates", _RULES_SQL)
def business_dates(t):
    return ops.business_dates({"events": t.events, "orders": t.orders}, _RULES)


@query(
    "C11_business_date_verdict",
    f"select cast(-3 as int) as res, 'Error' as msg, bdate as min_bd, msg as rule from ({_RULES_SQL}) r order by r.res, bdate limit 1",
)
def business_date_verdict(t):
    return ops.business_date_verdict(ops.business_dates({"events": t.events, "orders": t.orders}, _RULES))


@query(
    "C12_dangling_references",
    """with w as (select distinct 'wf_' || user_id as wf_name, user_id from events),
       r as (select 'wf_waits' as rel_type, wf_name, unnest(['wf_' || (user_id + 1), 'wf_' || (user_id + 3)]) as wf from w
         union all select 'wf_relations', wf_name, unnest(['wf_' || (user_id * 2)]) from w)
       select * from r where wf not in (select wf_name from w)""",
)
def dangling(t):
    w = t.events.select("user_id").distinct().selectExpr(
        "concat('wf_', user_id) as wf_name",
        "array(concat('wf_', user_id + 1), concat('wf_', user_id + 3)) as wf_waits",
        "array(concat('wf_', user_id * 2)) as wf_relations",
    )
    return ops.dangling_references(w, "wf_name", ["wf_waits", "wf_relations"])


@query(
    "C13_range_bucket_frequency",
    """with b as (select o_orderkey % 4 as u, o_orderkey as id, cast(o_orderdate as date) as d, ntile(40) over (partition by o_orderkey % 4 order by o_orderkey) as n from orders),
       c as (select u, n, min(id) as mn, max(id) as mx, count(*) as cnt, count(distinct d) as days from b group by 1, 2),
       m as (select cast(n as int) as n, min(mn) as min, max(mx) as mx, cast(sum(cnt) as bigint) as sum, cast(round(avg(days)) as bigint) as dt_cnt from c group by 1),
       e as (select n, min, coalesce(lead(min) over (order by min), max(mx) over () + 1) as max, sum, dt_cnt from m)
       select n, min, max, sum, max - min as diff, dt_cnt, sum // dt_cnt as avg, cast(round(min, -2) as bigint) as rmin, cast(round(max, -2) as bigint) as rmax,
         cast(round(max, -2) - round(min, -2) as bigint) as rdiff from e""",
)
def bucket_frequency(t):
    rows = t.orders.withColumn("d", F.to_date("o_orderdate"))
    return ops.range_bucket_frequency(rows, F.col("o_orderkey") % 4, "o_orderkey", "d")


@query(
    "C14_most_frequent_name",
    """with txt as (select event_id, case event_id % 11 when 0 then null when 1 then 'nan' when 2 then 'группа (коды 10-)' when 3 then 'группа (коды 10-14)'
           when 4 then '12' when 5 then 'группа (коды 90-99)' when 6 then 'группа (коды 100-105)' when 7 then 'группа (коды 1-' || (100000 + user_id) || ')'
           when 8 then 'группа (коды 1000 - 1999)' else cast(20 + event_id % 9 as varchar) end as val from events),
       dict as (select p_partkey as code, p_brand as name, count(*) as n from part group by 1, 2),
       rg as (select event_id, val, try_cast(case when val like '%-%' then regexp_extract(val, 'коды\\s*(\\d+)\\s*-', 1) else val end as int) as lo,
           try_cast(case when val like '%-%' then coalesce(nullif(regexp_extract(val, 'коды\\s*\\d+\\s*-\\s*(\\d+)', 1), ''), regexp_extract(val, 'коды\\s*(\\d+)\\s*-', 1))
             else val end as int) as hi from txt),
       fr as (select lo, hi, name, sum(n) as n from (select distinct lo, hi from rg) r join dict on code between lo and hi group by 1, 2, 3),
       best as (select lo, hi, name from fr qualify row_number() over (partition by lo, hi order by n desc, name) = 1)
       select event_id, val, coalesce(name, '') as main_name from rg left join best b on b.lo = rg.lo and b.hi = rg.hi""",
)
def frequent_name(t):
    rows = t.events.selectExpr(
        "event_id",
        "case event_id % 11 when 0 then null when 1 then 'nan' when 2 then 'группа (коды 10-)' when 3 then 'группа (коды 10-14)' when 4 then '12' "
        "when 5 then 'группа (коды 90-99)' when 6 then 'группа (коды 100-105)' when 7 then concat('группа (коды 1-', 100000 + user_id, ')') "
        "when 8 then 'группа (коды 1000 - 1999)' else cast(20 + event_id % 9 as string) end as val",
    )
    dictionary = t.part.selectExpr("p_partkey as code", "p_brand as name")
    return ops.most_frequent_name(rows, "event_id", "val", dictionary, "code", "name")


@query(
    "C15_field_mapping",
    fx.with_sql(fx.ORDERS_TEXT)
    + """select v.*, case v.column_name when 'cust' then (select count(*) from orders_text where cust is not null and try_cast(nullif(trim(cust), '') as bigint) is null)
           when 'missing' then null else 0 end as lost_values
         from (values ('o_orderkey', 'bigint', 'o_orderkey', 'bigint', true), ('cust', 'bigint', 'cust', 'string', false),
           ('order_flag', 'string', 'flag', 'string', true), ('missing', 'string', null, null, false)) v(column_name, data_type, source_column_name, source_data_type, same_type)""",
)
def field_mapping(t):
    target = t.orders.selectExpr("o_orderkey", "o_custkey as cust", "o_orderstatus as order_flag", "o_orderpriority as missing")
    source = fx.orders_text(t).select("o_orderkey", "cust", "flag")
    return ops.field_mapping(source, target, {"order_flag": "flag"})
