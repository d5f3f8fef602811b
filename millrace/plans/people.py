"""Queries of identity resolution and duplicate removal (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import identity as ops
from millrace.plans import fixtures as fx
from millrace.plans.registry import query

_USER = """case when turn = 0 and conv_id % 2 = 0 then concat('search_', 1000 + conv_id % 300)
  when turn = 1 then concat('00000000-0000-0000-0000-0000000000', 10 + conv_id % 40)
  when turn = 2 then concat('emp', 1000 + conv_id % 50) else concat('guest', conv_id % 10) end"""
_PAYVAL = """case when turn = 2 and conv_id % 6 = 0 then concat('', 1000 + conv_id % 50) when conv_id % 6 = 1 then 'x12' when conv_id % 6 = 2 then '99'
  when conv_id % 6 = 3 then '' else concat('', 1000 + conv_id % 10) end"""
_KEY = "case when turn = 3 then 'other' else 'employeeId' end"


def _log(t):
    return t.conversations.selectExpr("conv_id * 100 + turn as id", "conv_id div 2 as sessionid", f"{_USER} as user_text")


def _payload(t):
    return t.conversations.selectExpr("conv_id * 100 + turn as ai_id", f"{_KEY} as payload_key", f"{_PAYVAL} as payload_value")


def _seed(t):
    return t.conversations.where("turn = 1 and conv_id % 5 = 0").selectExpr(
        "conv_id * 100 + turn as ai_id", "cast(case when conv_id % 10 = 0 then 5 else 1000 + conv_id % 40 end as int) as i_pernr", "'seed' as kind"
    )


_UUID = "regexp_full_match(user_text, '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}')"
_STEPS = [
    f"log as (select conv_id * 100 + turn as id, conv_id // 2 as sessionid, {_USER} as user_text from conversations)",
    f"pay as (select conv_id * 100 + turn as ai_id, {_KEY} as k, {_PAYVAL} as v from conversations)",
    "r0 as (select conv_id * 100 + turn as ai_id, cast(1000 + conv_id % 40 as int) as i_pernr, 'seed' as kind from conversations where turn = 1 and conv_id % 5 = 0 and conv_id % 10 <> 0)",
    "s2 as (select id as ai_id, cast(substr(user_text, 8) as int) as i_pernr, 'search' as kind from log where regexp_full_match(user_text, 'search_[0-9]{4,7}'))",
    "r2 as (select * from r0 union all select * from s2)",
    "s3 as (select ai_id, cast(v as int) as i_pernr, 'employeeid' as kind from pay where k = 'employeeId' and regexp_full_match(v, '[0-9]+') and cast(v as int) between 1000 and 9999999)",
    "r3 as (select * from r2 union all select * from s3)",
    f"""s4 as (select l.id as ai_id, g.i_pernr, 'sessionid' as kind from log l join (select sessionid, max(i_pernr) as i_pernr from log join r3 on id = ai_id where {_UUID}
          group by 1 having count(distinct i_pernr) = 1) g on g.sessionid = l.sessionid where l.id not in (select ai_id from r3))""",
    "r4 as (select * from r3 union all select * from s4)",
    f"""s5 as (select l.id as ai_id, g.i_pernr, 'uuid_userid' as kind from log l join (select user_text, max(i_pernr) as i_pernr from log join r4 on id = ai_id where {_UUID}
          group by 1 having count(distinct i_pernr) = 1) g on g.user_text = l.user_text where l.id not in (select ai_id from r4))""",
    "r5 as (select * from r4 union all select * from s5)",
    """s6 as (select l.id as ai_id, g.i_pernr, 'i_pernr' as kind from log l join (select distinct user_text, i_pernr from log join r5 on id = ai_id
          where regexp_full_match(user_text, '[a-z_A-Z]*[0-9]{4,7}') and cast(regexp_extract(user_text, '([0-9]+)$', 1) as int) = i_pernr) g on g.user_text = l.user_text
          where l.id not in (select ai_id from r5))""",
    "r6 as (select * from r5 union all select * from s6)",
    f"""s7 as (select l.id as ai_id, g.i_pernr, 'userid' as kind from log l join (select user_text, max(i_pernr) as i_pernr from log join r6 on id = ai_id where not {_UUID}
          group by 1 having count(distinct i_pernr) = 1 and count(distinct sessionid) >= 3) g on g.user_text = l.user_text where l.id not in (select ai_id from r6))""",
    "r7 as (select * from r6 union all select * from s7)",
    "s8 as (select ai_id, max(i_pernr) as i_pernr, case when count(distinct i_pernr) = 1 then 'true' else 'false' end as kind from r7 group by 1)",
]


def _sql(last: str) -> str:
    return "with " + ",\n".join(_STEPS) + f" select * from {last}"


def _known(t, upto: int):
    """Resolved ids after the stages up to number ``upto`` (the first stage is the range check)."""
    return ops.resolved_until(_log(t), _payload(t), _seed(t), upto - 1)


@query("I1_drop_out_of_range", _sql("r0"))
def out_of_range(t):
    return ops.drop_out_of_range(_seed(t))


@query("I2_from_search_user", _sql("s2"))
def search_user(t):
    return ops.from_search_user(_log(t), _known(t, 1))


@query("I3_from_payload", _sql("s3"))
def payload(t):
    return ops.from_payload(_payload(t), _known(t, 2))


@query("I4_by_session", _sql("s4"))
def by_session(t):
    return ops.by_session(_log(t), _known(t, 3))


@query("I5_by_uuid_user", _sql("s5"))
def by_uuid_user(t):
    return ops.by_uuid_user(_log(t), _known(t, 4))


@query("I6_by_suffix", _sql("s6"))
def by_suffix(t):
    return ops.by_suffix(_log(t), _known(t, 5))


def _resolved(t):
    return ops.resolve(_log(t), _payload(t), _seed(t))


@query("I7_by_plain_user", _sql("s7"))
def by_plain_user(t):
    return _resolved(t).where("kind = 'userid'")


@query("I8_consensus", _sql("s8"))
def consensus(t):
    return _resolved(t).where("kind in ('true', 'false')")


_COPIES = """copies as (select event_id as id, user_id, event_type, cast(ts as date) as data_date, event_id % 4 as messageid from events
  union all select event_id + 1000000, user_id, event_type, cast(ts as date) + cast(event_id % 3 as int), event_id % 4 from events where event_id % 7 = 0)"""
_DUPLICATES = """dups as (select distinct max(id) as id from (select *, md5(user_id || event_type || messageid) as k, unnest([data_date, data_date + 1]) as w from copies) group by w, k having count(*) > 1)"""


def _copies(t):
    e = t.events.selectExpr(
        "event_id as id", "user_id", "event_type", "cast(ts as date) as data_date", "event_id % 4 as messageid"
    )
    more = t.events.where("event_id % 7 = 0").selectExpr(
        "event_id + 1000000 as id", "user_id", "event_type", "date_add(cast(ts as date), cast(event_id % 3 as int)) as data_date", "event_id % 4 as messageid"
    )
    return e.unionByName(more)


def _duplicates(t):
    return ops.sliding_duplicates(_copies(t), ops.natural_key(["user_id", "event_type", "messageid"]), "data_date", "id")


@query("I9_sliding_duplicates", fx.with_sql(_COPIES, _DUPLICATES) + "select * from dups")
def sliding_duplicates(t):
    return _duplicates(t)


@query(
    "I10_cascade_delete",
    fx.with_sql(_COPIES, _DUPLICATES)
    + """select 'log' as tbl, id as ref from copies where id not in (select id from dups)
         union all select 'pairs', id from copies where id not in (select id from dups) and id - 1 not in (select id from dups)""",
)
def cascade_delete(t):
    log = _copies(t)
    pairs = log.select("id", (F.col("id") - 1).alias("previous_id"))
    out = ops.cascade_delete(_duplicates(t), "id", {"log": (log, ["id"]), "pairs": (pairs, ["id", "previous_id"])})
    frames = [df.select(F.lit(name).alias("tbl"), F.col("id").alias("ref")) for name, df in out.items()]
    return frames[0].unionByName(frames[1])
