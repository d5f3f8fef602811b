"""Queries of the table-wide cleaning jobs (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import cleaning as ops
from millrace.plans import fixtures as fx
from millrace.plans.registry import query

_MIXED = """event_id, case event_id % 5 when 0 then '' when 1 then 'abc' when 2 then concat('', event_id) when 3 then concat(' ', user_id, ' ') else concat(event_id, '.5') end as num,
  case event_id % 4 when 0 then 'yes' when 1 then 'off' when 2 then 'maybe' else '' end as flag,
  case event_id % 3 when 0 then '2024-01-05 10:00:00' when 1 then '2024-13-45' else '' end as stamp,
  case when event_id % 2 = 0 then '00000000-0000-0000-0000-00000000000A' else 'not-a-uuid' end as ident"""
_CASTS = {"num": "bigint", "flag": "boolean", "stamp": "timestamp", "ident": "uuid"}


def _quarantine(t):
    return ops.cast_with_quarantine(t.events.selectExpr(*_split(_MIXED)), _CASTS)


def _split(text):
    from millrace.operators.checks import _split_list

    return _split_list(text)


@query(
    "X1_cast_clean",
    f"""select event_id, case when event_id % 5 in (2, 3) then try_cast(trim(num) as bigint) end as num, case flag when 'yes' then true when 'off' then false end as flag,
        case when event_id % 3 = 0 then timestamp '2024-01-05 10:00:00' end as stamp, case when event_id % 2 = 0 then lower(ident) end as ident from (select {_MIXED} from events)""",
)
def cast_clean(t):
    return _quarantine(t)[0]


@query(
    "X1_cast_rejects",
    """select event_id, array_to_string(list_filter([case when event_id % 5 in (1, 4) then 'num' end, case when event_id % 4 = 2 then 'flag' end,
         case when event_id % 3 = 1 then 'stamp' end, case when event_id % 2 = 1 then 'ident' end], lambda x: x is not null), ',') as failed from events
       where event_id % 5 in (1, 4) or event_id % 4 = 2 or event_id % 3 = 1 or event_id % 2 = 1""",
)
def cast_rejects(t):
    return _quarantine(t)[1].select("event_id", F.concat_ws(",", "failed_columns").alias("failed"))


@query(
    "X1_cast_failures",
    """select 'num' as column_name, count(*) filter (event_id % 5 in (1, 4)) as failures from events union all select 'flag', count(*) filter (event_id % 4 = 2) from events
       union all select 'stamp', count(*) filter (event_id % 3 = 1) from events union all select 'ident', count(*) filter (event_id % 2 = 1) from events""",
)
def cast_failures(t):
    return _quarantine(t)[2]


@query(
    "X2_normalise_columns",
    """select event_id, case event_id % 4 when 0 then event_type || '|' || user_id when 1 then event_type || '|b c' when 2 then 'a,b|' || user_id end as arr,
         case event_id % 3 when 0 then '{"a": ' || user_id || '}' when 1 then '{"a": "' || event_type || '"}' end as js from events""",
)
def normalise(t):
    rows = t.events.selectExpr(
        "event_id",
        """case event_id % 4 when 0 then concat('{', event_type, ',', user_id, '}') when 1 then concat('[', event_type, ', b c]') when 2 then concat('{"a,b","', user_id, '"}') else 'oops' end as arr""",
        """case event_id % 3 when 0 then concat('{"a": ', user_id, '}') when 1 then concat("{'a': '", event_type, "'}") else '{broken' end as js""",
    )
    out = ops.normalise_columns(rows, ["arr"], ["js"])
    return out.withColumn("arr", F.when(F.col("arr").isNotNull(), F.concat_ws("|", "arr")))




def _repaired(t):
    backslash = "char(92)"
    text = f"""case event_id % 6 when 0 then concat('{{"k":"', event_type, '"}}') when 1 then concat('{{"k":"v', {backslash}, "'", user_id, '"}}')
      when 2 then concat('{{"k":"v', user_id, ',"m":"1"}}') when 3 then concat('{{"n":,"k":"', user_id, '"}}')
      when 4 then concat('{{"k":"a", b', user_id, '"}}') else concat('no json ', user_id) end"""
    return ops.repair_json(t.events.select("event_id", F.expr(text).alias("raw")), "raw")


_REPAIRED = """select event_id, case event_id % 6 when 0 then '{"k":"' || event_type || '"}' when 1 then '{"k":"v' || user_id || '"}' when 2 then '{"k":"v' || user_id || '","m":"1"}'
  when 3 then '{"n":"","k":"' || user_id || '"}' when 4 then '{"k":"a b' || user_id || '"}' end as repaired,
  case event_id % 6 when 0 then 'as is' when 1 then 'escapes' when 2 then 'quote closed' when 3 then 'value inserted' when 4 then 'quote closed, strings joined' end as stage from events"""


@query("X3_repair_json", _REPAIRED)
def repair(t):
    return _repaired(t).drop("raw")


@query("X3_repair_totals", f"select coalesce(stage, 'failed') as stage, count(*) as cnt from ({_REPAIRED}) group by 1")
def repair_totals(t):
    return ops.repair_totals(_repaired(t))


@query(
    "X4_standardise_text",
    """select doc_id, md5(case when regexp_matches(lower(text), '[a-zа-я0-9]') then trim(trim(text, ' '), chr(9)) end) as text_md5,
         case when doc_id % 9 = 0 then null else lang end as lang from documents""",
)
def standardise(t):
    rows = t.documents.select(
        "doc_id", "text", F.when(F.col("doc_id") % 9 == 0, " -- ").otherwise(F.concat(F.lit("  "), "lang", F.lit("\t"))).alias("lang")
    )
    return ops.standardise_text(rows).select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query(
    "X5_pseudonymise",
    "select c_custkey, md5(unhex(sha256('pepper' || c_name))) as c_name, md5(unhex(sha256('pepper' || c_nationkey))) as c_nationkey from customer",
)
def pseudonymise(t):
    return ops.pseudonymise(t.customer.select("c_custkey", "c_name", "c_nationkey"), ["c_name", "c_nationkey"], "pepper")
