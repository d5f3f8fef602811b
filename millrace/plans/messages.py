"""Queries of the JSON event operators (J)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.parsing import json_field
from millrace.operators import events as ops
from millrace.plans.registry import query

_TYPES = ", ".join(f"'{x}'" for x in ops.EVENT_TYPES)
_SCHEMA = """concat('{{"name":"', upper({t}), '","fields":[{{"name":"event_type"}},{{"name":"message_id"}},{{"name":"message_serial_number"}},{{"name":"user_id"}}]}}')"""
_USERS = """case when event_id % 3 = 0 then '[]' else concat('[{"user_id":"', user_id, '","last_name":"L', event_id % 11, '"},{"user_id":"', user_id + 1, '"}]') end"""
# Whole numbers and decimals with some values that are no number.
_WHOLE = "case when event_id % {m} = 0 then 'none' else concat(event_id * {m}, '') end"
_PART = "case when event_id % {m} = 0 then '' else concat('0.', event_id % 90 + {m}) end"
_NUMBER = {f: (_PART if f in ops.DECIMAL_FIELDS else _WHOLE).format(m=k) for k, f in enumerate((*ops.INTEGER_FIELDS, *ops.DECIMAL_FIELDS), start=3)}
_NUMBERS = "'\"', " + ", ".join(f"',\"{f}\":\"', {e}, '\"'" for f, e in _NUMBER.items() if f != "message_serial_number")
_PAYLOAD = f"""concat('{{"event_type":"', event_type, '","message_id":"', event_id, '","message_serial_number":"', case when event_id % 13 = 0 then 'x' else concat(event_id % 100, '') end,
  '","user_id":"', user_id, {_NUMBERS}, ',"user_info":', {_USERS}, '}}')"""
FIELDS = ["event_type", "message_id", "message_serial_number", "user_id", "user_info"]
NUMBERS = [f for f in (*ops.INTEGER_FIELDS, *ops.DECIMAL_FIELDS) if f != "message_serial_number"]


def _elements(t):
    named = t.events.withColumn("type", F.expr(f"element_at(array({_TYPES}), cast(event_id % 18 as int) + 1)"))
    return named.selectExpr(
        "event_id", "concat('f_', event_id div 20) as file_name", "event_id div 20 as file_no", "type",
        f"{_SCHEMA.format(t='type')} as schema", f"{_PAYLOAD} as payload",
    )


_ELEMENTS = f"""elements as (select event_id, 'f_' || (event_id // 20) as file_name, event_id // 20 as file_no, type,
  {_SCHEMA.format(t='type')} as schema, {_PAYLOAD} as payload from (select *, [{_TYPES}][event_id % 18 + 1] as type from events))"""


def _files(t):
    """Files of at most twenty envelopes."""
    body = F.concat(F.lit('{"schema":'), F.col("schema"), F.lit(',"payload":'), F.col("payload"), F.lit("}"))
    return (
        _elements(t)
        .groupBy("file_name", "file_no")
        .agg(F.concat_ws(",", F.sort_array(F.collect_list(body))).alias("all"))
        .select(
            "file_name",
            F.concat(F.lit('{"data":['), F.col("all"), F.lit("]}")).alias("json_text"),
            F.expr("timestampadd(HOUR, cast(file_no % 10 as int), timestamp '2024-02-01 00:00:00')").alias("add_dtts"),
            (F.col("file_no") % 5 == 0).alias("is_parsed"),
        )
    )


def _messages(t):
    return _elements(t).select(
        F.lit(dt.date(2024, 2, 1)).alias("load_date"), "file_name", F.upper("type").alias("schema_name"), "event_id",
        F.md5(F.concat(F.col("event_id").cast("string"), F.col("payload"))).alias("hash"),
        F.col("payload").alias("payload_json"), F.expr("case when event_id % 4 = 0 then 1 when event_id % 4 = 1 then 0 end").alias("is_parsed"),
    )


@query(
    "J1_explode_envelopes",
    f"""with {_ELEMENTS} select distinct file_name, type as schema_name, md5(schema) as schema_version_md5, cast(event_id as varchar) as message_id,
        md5(event_id || payload) as hash, payload as payload_json from elements where file_no % 5 <> 0""",
)
def explode_envelopes(t):
    return ops.explode_envelopes(_files(t))


@query(
    "J2_new_schema_versions",
    f"""with {_ELEMENTS}, known as (select distinct type, md5(schema) as m from elements where event_id % 18 % 3 = 0)
        select distinct type as schema_name, cast(case when type like 'c%' then 8 else 1 end as int) as schema_version_num, md5(schema) as schema_version_md5, schema as schema_json,
          date '2024-02-02' as schema_actual_date_from, cast(1 as int) as schema_is_used
        from elements where file_no % 10 = 9 and md5(schema) not in (select m from known)""",
)
def new_schema_versions(t):
    e = _elements(t)
    known = e.where("event_id % 18 % 3 = 0").select(
        F.col("type").alias("schema_name"), F.lit(3).alias("schema_version_num"), F.md5("schema").alias("schema_version_md5")
    )
    older = e.where("type like 'c%'").select(
        F.col("type").alias("schema_name"), F.lit(7).alias("schema_version_num"), F.lit("older").alias("schema_version_md5")
    )
    return ops.new_schema_versions(_files(t), known.unionByName(older).distinct(), dt.date(2024, 2, 2))


_SHRED_COLUMNS = """file_name, md5(event_id || payload) as hash, event_type, cast(event_id as varchar) as message_id,
  case when event_id % 13 = 0 then null else event_id % 100 end as message_serial_number, cast(user_id as varchar) as user_id"""


_NUMBERS_SQL = ", ".join(f"try_cast({_NUMBER[f]} as {'decimal(38,18)' if f in ops.DECIMAL_FIELDS else 'bigint'}) as {f}" for f in NUMBERS)


@query(
    "J3_shred_event_types",
    f"""with {_ELEMENTS} select type as schema_name, {_SHRED_COLUMNS}, {_NUMBERS_SQL} from (select e.*, v.event_type, v.user_id from elements e join events v on v.event_id = e.event_id)
        where event_id % 4 <> 0 and type <> '{ops.NESTED_EVENT}'""",
)
def shred_event_types(t):
    """All types but the nested one, read and parsed once."""
    routed = ops.route(_messages(t), [x for x in ops.EVENT_TYPES if x != ops.NESTED_EVENT])
    return ops.routed_fields(routed, ["event_type", "message_id", "message_serial_number", "user_id", *NUMBERS]).drop("load_date")


@query(
    "J3_shred_all",
    f"""with {_ELEMENTS} select type as schema_name, count(*) as messages, count(distinct event_id) as ids, sum(try_cast({_NUMBER['sl_sec_max']} as bigint)) as total
        from elements where event_id % 4 <> 0 and (type <> '{ops.NESTED_EVENT}' or event_id % 3 <> 0) group by type""",
)
def shred_all(t):
    """One frame per type through one stored pass; the nested type counts messages with elements."""
    registry = {name: [*FIELDS, "sl_sec_max"] for name in ops.EVENT_TYPES}
    frames = [
        df.select("message_id", "sl_sec_max").distinct().agg(F.count("*").alias("messages"), F.count_distinct("message_id").alias("ids"), F.sum("sl_sec_max").alias("total"))
        .select(F.lit(name).alias("schema_name"), "*")
        for name, df in ops.shred_all(_messages(t), registry).items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query(
    "J3_route",
    f"""with {_ELEMENTS} select type as schema_name, file_name, md5(event_id || payload) as hash, cast(event_id as varchar) as message_id, cast(16 as int) as fields
        from elements where event_id % 4 <> 0""",
)
def route(t):
    out = ops.route(_messages(t))
    return out.select("schema_name", "file_name", "hash", F.col("fields")["message_id"].alias("message_id"), F.size("fields").alias("fields"))


@query(
    "J3_registry_fields",
    f"""with {_ELEMENTS}, f as (select distinct type from elements)
        select type as schema_name, 'event_type,message_id,message_serial_number,user_id' as fields from f""",
)
def registry_fields(t):
    registry = _elements(t).select(
        F.col("type").alias("schema_name"), F.lit(1).alias("schema_version_num"), F.col("schema").alias("schema_json")
    )
    found = ops.registry_fields(registry)
    names = F.create_map(*[x for k, v in found.items() for x in (F.lit(k), F.lit(",".join(v)))])
    return registry.select("schema_name").distinct().select("schema_name", names[F.col("schema_name")].alias("fields"))


@query(
    "J4_shred_nested",
    f"""with {_ELEMENTS}, m as (select e.*, v.user_id, v.event_type from elements e join events v on v.event_id = e.event_id
          where e.event_id % 4 <> 0 and type = '{ops.NESTED_EVENT}' and e.event_id % 3 <> 0)
        select file_name, cast(event_id as varchar) as message_id, event_type, cast(user_id as varchar) as user_id, 'L' || (event_id % 11) as last_name from m
        union all select file_name, cast(event_id as varchar), event_type, cast(user_id + 1 as varchar), null from m""",
)
def shred_nested(t):
    messages = _messages(t)
    out = ops.shred_nested(messages, FIELDS)
    return out.select("file_name", "message_id", "event_type", "user_id", "last_name")


@query(
    "J5_mark_parsed",
    f"""with {_ELEMENTS} select event_id, file_name, cast(case when event_id % 4 = 0 or (event_id % 4 <> 0 and (type <> '{ops.NESTED_EVENT}' or event_id % 3 <> 0)) then 1
          when event_id % 4 = 1 then 0 end as int) as is_parsed from elements""",
)
def mark_parsed(t):
    messages = _messages(t)
    targets = ops.shred_all(messages, {name: FIELDS for name in ops.EVENT_TYPES})
    return ops.mark_parsed(messages, list(targets.values())).select("event_id", "file_name", "is_parsed")


def _parsed_by_file(t):
    flags = F.expr("case when event_id div 20 % 3 = 0 then 1 when event_id % 7 = 0 then null else 1 end")
    return _messages(t).withColumn("is_parsed", flags)


@query(
    "J6_mark_files",
    f"""with {_ELEMENTS} select file_name, file_no % 5 = 0 or count(*) filter (file_no % 3 <> 0 and event_id % 7 = 0) = 0 as is_parsed from elements group by 1, file_no""",
)
def mark_files(t):
    return ops.mark_files(_files(t), _parsed_by_file(t)).select("file_name", "is_parsed")


@query(
    "J7_prefixed_parameters",
    """select event_id, 'wf_name' as param, event_type as value from events union all select event_id, 'wf_prev', 'p' || user_id from events""",
)
def prefixed_parameters(t):
    text = """concat('[{"param":"wf_id","value":"', event_id, '"},{"param":"wf_name","value":"', event_type, '","prior_value":"z"},{"param":"wf_prev","prior_value":"p', user_id, '"},{"param":"other","value":"1"}]')"""
    rows = t.events.select("event_id", F.expr(text).alias("params"))
    return rows.select("event_id", F.inline(ops.prefixed_parameters(F.col("params"))))


@query(
    "J7_api_snapshots",
    """select 'u' || (event_id % 3) as url, case event_id % 3 when 0 then 'tmpl' when 1 then 'statval' else 'wf' end as obj,
         case event_id % 3 when 0 then null when 1 then user_id else event_id end as id, event_type as kind from events""",
)
def api_snapshots(t):
    body = """concat(case when event_id % 2 = 0 then '[' else '' end, '{"id":', event_id, ',"loading_id":', user_id, ',"kind":"', event_type, '"}', case when event_id % 2 = 0 then ',5]' else '' end)"""
    rows = t.events.selectExpr(
        "concat('u', event_id % 3) as url", "case event_id % 3 when 0 then 'tmpl' when 1 then 'statval' else 'wf' end as obj", f"{body} as body"
    )
    out = ops.api_snapshots(rows, {"tmpl": None, "statval": "$.loading_id"})
    return out.select("url", "obj", "id", json_field("msg", "kind").alias("kind"))
