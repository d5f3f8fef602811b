"""Queries of hierarchies, interval joins and calendars (T)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import temporal as ops
from millrace.plans import fixtures as fx
from millrace.plans.registry import query

FIRST, LAST = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
TURN_FIRST, TURN_LAST = dt.date(2024, 12, 29), dt.date(2025, 1, 3)
_OPEN = "9999-12-31"


def _edges(t):
    """root 1 -> region -> nation -> customer, valid from 2024; some customers end early or join late."""
    always = [F.lit(dt.date(2024, 1, 1)).alias("date_start"), F.lit(ops.OPEN_END).alias("date_finish")]
    region = t.region.select((100 + F.col("r_regionkey")).cast("bigint").alias("child"), F.lit(1).cast("bigint").alias("parent"), *always)
    nation = t.nation.select(
        (1000 + F.col("n_nationkey")).cast("bigint").alias("child"), (100 + F.col("n_regionkey")).cast("bigint").alias("parent"),
        F.expr("case when n_nationkey % 4 = 0 then date '2024-01-13' else date '2024-01-01' end").alias("date_start"),
        F.expr("case when n_nationkey % 5 = 0 then date '2024-01-17' else date '9999-12-31' end").alias("date_finish"),
    )
    customer = t.customer.selectExpr(
        "100000 + c_custkey as child", "cast(1000 + c_nationkey as bigint) as parent",
        "case when c_custkey % 7 = 0 then date '2024-01-17' else date '2024-01-01' end as date_start",
        "case when c_custkey % 10 = 0 then date '2024-01-15' else date '9999-12-31' end as date_finish",
    ).where("date_start <= date_finish")
    return region.unionByName(nation).unionByName(customer)


_EDGES = """edges as (select 100 + r_regionkey as child, 1 as parent, date '2024-01-01' as s, date '9999-12-31' as e from region
  union all select 1000 + n_nationkey, 100 + n_regionkey, case when n_nationkey % 4 = 0 then date '2024-01-13' else date '2024-01-01' end,
    case when n_nationkey % 5 = 0 then date '2024-01-17' else date '9999-12-31' end from nation
  union all select * from (select 100000 + c_custkey, 1000 + c_nationkey, case when c_custkey % 7 = 0 then date '2024-01-17' else date '2024-01-01' end as s,
    case when c_custkey % 10 = 0 then date '2024-01-15' else date '9999-12-31' end as e from customer) where s <= e)"""
_TREE = f"""with recursive days as (select cast(unnest(generate_series(date '2024-01-10', date '2024-01-20', interval 1 day)) as date) as d), {_EDGES},
  tree as (select d, child, parent, 1 as lvl, s, e, [child] as ids, [s] as ss, [e] as es from edges, days where parent = 1 and d between s and e
    union all select t.d, x.child, x.parent, t.lvl + 1, x.s, x.e, list_append(ids, x.child), list_append(ss, x.s), list_append(es, x.e)
    from tree t join edges x on x.parent = t.child and t.d between x.s and x.e and (t.s = x.s or (t.s < x.e and x.s < t.e)))
"""


def _paths(t):
    roots = t.region.agg(F.lit(1).cast("bigint").alias("root"))
    return ops.tree_paths(_edges(t), roots)


@query(
    "T1_daily_tree",
    _TREE
    + "select d as cal_date, cast(child as bigint) as org_id, cast(parent as bigint) as parent_org_id, lvl, s as date_start, e as date_finish from tree",
)
def daily_tree(t):
    return ops.daily_tree(_paths(t), FIRST, LAST)


@query(
    "T1_deep_tree",
    """with recursive step as (select greatest(max(p_partkey) // 20, 1) as n from part),
       edges as (select p_partkey + 1 as child, greatest(p_partkey + 1 - n, 0) as parent, date '2024-01-01' + cast(p_partkey % 3 as int) as s from part, step),
       tree as (select child, parent, 1 as lvl, s, s as vf from edges where parent = 0
         union all select x.child, x.parent, t.lvl + 1, x.s, greatest(t.vf, x.s) from tree t join edges x on x.parent = t.child)
       select cast(d as date) as cal_date, child as org_id, parent as parent_org_id, lvl, s as date_start, date '9999-12-31' as date_finish
       from tree, unnest(generate_series(date '2024-01-02', date '2024-01-04', interval 1 day)) as days(d) where d >= vf""",
)
def deep_tree(t):
    """A forest of chains of about twenty levels, whatever the number of parts."""
    step = t.part.agg(F.greatest(F.floor(F.max("p_partkey") / 20), F.lit(1)).cast("bigint")).scalar()
    edges = t.part.select(
        (F.col("p_partkey") + 1).alias("child"), F.greatest(F.col("p_partkey") + 1 - step, F.lit(0)).cast("bigint").alias("parent"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("p_partkey") % 3).cast("int")).alias("date_start"), F.lit(ops.OPEN_END).alias("date_finish"),
    )
    roots = t.part.agg(F.lit(0).cast("bigint").alias("root"))
    return ops.daily_tree(ops.tree_paths(edges, roots), dt.date(2024, 1, 2), dt.date(2024, 1, 4))


_LEVELS = ", ".join(
    f"cast(ids[{k}] as bigint) as lvl_{k}_org_id, ss[{k}] as lvl_{k}_date_start, es[{k}] as lvl_{k}_date_end" for k in range(1, 17)
)
_SHIFTED = ", ".join(
    f"cast(ids[{k}] as bigint) as lvl_{k + 1}_org_id, ss[{k}] as lvl_{k + 1}_date_start, es[{k}] as lvl_{k + 1}_date_end" for k in range(1, 17)
)


@query(
    "T2_flat_levels",
    _TREE + f"select distinct d as cal_date, cast(child as bigint) as org_id, lvl as org_id_lvl, cast(1 as bigint) as lvl_0_org_id, {_LEVELS} from tree",
)
def flat_levels(t):
    return ops.flat_levels(_paths(t), FIRST, LAST)


@query(
    "T3_published_levels",
    _TREE.replace("2024-01-10", "2024-12-29").replace("2024-01-20", "2025-01-03")
    + f"""select distinct case when d < date '2025-01-01' then date '2024-01-31' else date '2025-02-01' end as load_date, d as cal_date,
      cast(child as bigint) as org_id, lvl as org_id_lvl, cast(1 as bigint) as lvl_1_org_id, {_SHIFTED} from tree""".replace("\n", " "),
)
def published_levels(t):
    """The table as of January 2024 over the turn of the year, with the year 2025 rebuilt later."""
    flat = ops.flat_levels(_paths(t), TURN_FIRST, TURN_LAST)
    older = ops.published_levels(flat, dt.date(2024, 1, 31))
    return ops.replace_year(older, ops.published_levels(flat, dt.date(2025, 2, 1)), 2025)


def _movements(t):
    return t.events.selectExpr(
        "user_id as i_pernr", "cast(ts as date) as action_date", "event_type as action_type", "concat('m', event_id % 4) as action_reason", "event_id as org_id"
    )


def _relations(t):
    spans = fx.intervals(t, overlaps=False)
    base = spans.selectExpr(
        "user_id", "1 + event_id % 1500 as pos", "date_start", "date_finish"
    )
    a = base.selectExpr("pos as id_object", "user_id as id_connection_object", "'A008' as connection_type", "date_start", "date_finish")
    b = t.part.selectExpr("p_partkey as id_object", "p_partkey + 200000 as id_connection_object", "'B007' as connection_type", *_DATED)
    c = t.part.where("p_size > 25").selectExpr(
        "p_partkey as id_object", "p_partkey + 100000 as id_connection_object", "'BZ71' as connection_type", *_DATED
    )
    return a.unionByName(b).unionByName(c)


_DATED = [
    "date_add(date '2024-01-01', cast(p_partkey % 25 as int)) as date_start",
    "date_add(date '2024-01-01', cast(p_partkey % 25 + p_size as int)) as date_finish",
]
_DATED_SQL = "date '2024-01-01' + cast(p_partkey % 25 as int) as date_start, date '2024-01-01' + cast(p_partkey % 25 + p_size as int) as date_finish"


@query(
    "T4_movement_detail",
    fx.with_sql(
        fx.intervals_sql(overlaps=False),
        "mv as (select user_id as i_pernr, cast(ts as date) as d, event_type as atype, 'm' || (event_id % 4) as ar, event_id as org_id from events)",
        "pp as (select 1 + event_id % 1500 as pos, user_id as per, date_start as s, date_finish as e from intervals)",
        f"pj as (select p_partkey as pos, p_partkey + 200000 as job, date_start as s, date_finish as e from (select *, {_DATED_SQL} from part))",
        f"pe as (select p_partkey as pos, p_partkey + 100000 as et, date_start as s, date_finish as e from (select *, {_DATED_SQL} from part where p_size > 25))",
        "lagged as (select *, lag(org_id) over (partition by i_pernr order by d, atype, ar, org_id) as prev from mv)",
    )
    + """select m.d as cal_date, m.i_pernr, m.atype as code_movement_type, m.ar as movement_motiv, cast(case when atype = 'signup' and ar = 'm1' then 1 else 0 end as int) as permanent_movement,
         a.pos as pos_id, nullif(oa.pos, a.pos) as old_pos_id, j.job as job_code, nullif(oj.job, j.job) as old_job_code, t.et as et_pos_id, nullif(ot.et, t.et) as old_et_pos_id,
         m.org_id, nullif(m.prev, m.org_id) as old_org_id
       from lagged m left join pp a on a.per = m.i_pernr and m.d between a.s and a.e left join pj j on j.pos = a.pos and m.d between j.s and j.e
       left join pe t on t.pos = a.pos and m.d between t.s and t.e left join pp oa on oa.per = m.i_pernr and m.d - 1 between oa.s and oa.e
       left join pj oj on oj.pos = oa.pos and m.d - 1 between oj.s and oj.e left join pe ot on ot.pos = oa.pos and m.d - 1 between ot.s and ot.e""",
)
def movement_detail(t):
    moves = _movements(t)
    permanent = moves.where("action_type = 'signup' and action_reason = 'm1'").selectExpr(
        "action_type as code_movement_type", "action_reason as movement_motive", "1 as permanent_movement"
    )
    # The relations of the fixture have one value a day by construction, so nothing is checked.
    return ops.movement_detail(moves, _relations(t), permanent.distinct(), exclusive=True)


_ACTIONS = "case event_id % 5 when 0 then 'S4' when 1 then 'S2' when 2 then 'S1' when 3 then 'S2' else 'S3' end"
_PAIRS = f"""base as (select user_id, case when a = 'S4' then d - 1 else d end as d, a from (select user_id, cast(ts as date) as d, {_ACTIONS} as a from events)),
  acts as (select * from base union all select user_id, d + 1, 'S3' from base where a = 'S4'),
  pairs as (select user_id, d, row_number() over (partition by user_id order by d, a) + case when a in ('S1', 'S3') then 1 else 0 end as p from acts),
  terms as (select distinct user_id, min(d) as date_start, case when count(*) = 2 then max(d) else date '9999-12-31' end as date_finish from pairs where p <> 1 group by user_id, p)"""


def _terms(t):
    rows = t.events.selectExpr("user_id", "cast(ts as date) as d", f"{_ACTIONS} as a")
    return ops.events_to_intervals(rows, "user_id", "d", "a")


@query("T5_events_to_intervals", fx.with_sql(_PAIRS) + "select * from terms")
def events_to_intervals(t):
    return _terms(t)


@query(
    "T6_interval_enrichment",
    fx.with_sql(
        _PAIRS,
        fx.intervals_sql(overlaps=False),
        "reports as (select event_id, user_id, cast(ts as date) as report_date, event_id % 25 as nation from events)",
    )
    + """select r.event_id, r.user_id, r.report_date, r.nation, t.date_start, t.date_finish, i.event_type as state, i.event_id as state_id, n.n_name as nation_name
         from terms t join reports r on r.user_id = t.user_id and r.report_date between t.date_start and t.date_finish
         left join intervals i on i.user_id = r.user_id and r.report_date between i.date_start and i.date_finish
         left join nation n on n.n_nationkey = r.nation""",
)
def enrichment(t):
    reports = t.events.selectExpr(
        "event_id", "user_id", "cast(ts as date) as report_date", "event_id % 25 as nation"
    )
    taken = {"state": "event_type", "state_id": "event_id"}
    states = ops.Dictionary(fx.intervals(t, overlaps=False), {"user_id": "user_id"}, taken, "date_start", "date_finish", exclusive=True)
    names = ops.Dictionary(t.nation, {"nation": "n_nationkey"}, {"nation_name": "n_name"})
    return ops.enrich_intervals(_terms(t), reports, "user_id", "report_date", [states, names])


@query(
    "T7_calendar",
    """select 'day' as step, cast(unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as timestamp) as slot from events
       union all select 'month', cast(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)) as timestamp) from orders
       union all select '10 minutes', unnest(generate_series(time_bucket(interval 10 minute, min(ts)), time_bucket(interval 10 minute, max(ts)), interval 10 minute)) from events""",
)
def calendars(t):
    frames = [
        ops.calendar(src, col, step).select(F.lit(step).alias("step"), F.col("slot").cast("timestamp").alias("slot"))
        for src, col, step in ((t.events, "ts", "day"), (t.orders, "o_orderdate", "month"), (t.events, "ts", "10 minutes"))
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])
