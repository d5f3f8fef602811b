"""JSON event envelopes: explode, schema registry, shredding by event type, parsed flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import keep_matching
from millrace.functions.lineage import cut_lineage
from millrace.functions.parsing import json_field

ELEMENT = "array<struct<schema string, payload string>>"
NESTED_EVENT, NESTED_FIELD = "bulkagentservices_events", "user_info"  # fixed values

# Names of the known event types.
EVENT_TYPES = (
    "newcall_events", "partylist_events", "agent_events", "workitem_events", "interactionrouter_events", "agentservices_events",
    "workflowprocess_events", "finishcall_events", "servicedata_events", "transcribe_events", "capacitychange_events", "services_events",
    "records_events", "content_events", "bulkagentservices_events", "massattempts_events", "updateplatform_events", "smsgatewayevent",
)
# Fields that are not text.
INTEGER_FIELDS = (
    "message_serial_number", "proficiency_level", "sl_sec_max", "sl_target", "sl_max_sec", "sl_plan_perc", "treshhold",
    "avail_agent_capacity", "attempt_count",
)
DECIMAL_FIELDS = ("emotions_positive", "emotions_neutral", "emotions_negative")
# Fields of one element of the nested array.
NESTED_FIELDS = (
    "user_id", "last_name", "first_name", "patronymic", "employee_id", "tenant_user_id", "proficiency_level", "connection_type",
    "interaction_search_tactic",
)


def field_type(name: str) -> str:
    """Type rule of a payload field: a few are numbers, the rest is text."""
    if name in INTEGER_FIELDS:
        return "bigint"
    return "decimal(38,18)" if name in DECIMAL_FIELDS else "string"


def registry_fields(registry: DataFrame) -> dict[str, list[str]]:
    """{event type: fields} from the newest schema text of every type.

    The schema names its fields in ``fields`` (objects with ``name`` or ``field``) or as keys of
    ``properties``.  One schema text per type reaches the driver."""
    newest = registry.groupBy("schema_name").agg(F.max_by("schema_json", "schema_version_num").alias("s"))
    listed = F.from_json(json_field("s", "fields"), "array<struct<name string, field string>>")
    names = F.coalesce(
        F.transform(listed, lambda x: F.coalesce(x["name"], x["field"])), F.json_object_keys(json_field("s", "properties"))
    )
    return {r[0]: list(r[1] or ()) for r in newest.select("schema_name", names).collect()}


def payload_fields(messages: DataFrame, most: int = 10_000) -> dict[str, list[str]]:
    """{event type: fields} seen in the payloads: distinct keys, found by one aggregate.

    Keys made from data would not end: more than ``most`` of them are an error."""
    keys = messages.select(F.lower("schema_name").alias("t"), F.explode(F.json_object_keys("payload_json")).alias("k")).distinct()
    found = keys.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"the payloads have more than {most} different fields")
    out: dict[str, list[str]] = {}
    for r in sorted(found):
        out.setdefault(r["t"], []).append(r["k"])
    return out


# --- envelopes -----------------------------------------------------------------------------


def explode_envelopes(files: DataFrame) -> DataFrame:
    """Each element of ``data[]`` of the unparsed files: schema name and md5, message id, row hash, payload.

    ``files``: file_name, json_text, is_parsed.  Works on a stream as well, except for the
    de-duplication, which a stream does by watermark."""
    return envelope_rows(files).distinct()


def envelope_rows(files: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The exploded elements before de-duplication; ``keep`` carries file columns along."""
    unparsed = files.where(~F.coalesce(F.col("is_parsed").cast("boolean"), F.lit(False)))
    elements = F.from_json(json_field("json_text", "data"), ELEMENT)
    rows = unparsed.select("file_name", *keep, F.explode(elements).alias("e")).select("file_name", *keep, "e.schema", "e.payload")
    message_id = json_field("payload", "message_id")
    return rows.select(
        "file_name",
        *keep,
        F.lower(json_field("schema", "name")).alias("schema_name"),
        F.md5("schema").alias("schema_version_md5"),
        message_id.alias("message_id"),
        F.md5(F.concat_ws("", message_id, F.col("payload"))).alias("hash"),
        F.col("payload").alias("payload_json"),
    )


def new_schema_versions(files: DataFrame, registry: DataFrame, as_of) -> DataFrame:
    """Schema texts of the newest file that the registry does not know, numbered after its versions.

    ``files``: json_text, add_dtts.  ``registry``: schema_name, schema_version_num, schema_version_md5."""
    newest = files.agg(F.max("add_dtts")).scalar()
    elements = F.from_json(json_field("json_text", "data"), ELEMENT)
    found = (
        files.where(F.col("add_dtts") == newest)
        .select(F.explode(elements).alias("e"))
        .select(F.col("e.schema").alias("schema_json"))
        .distinct()
        .select(
            F.lower(json_field("schema_json", "name")).alias("schema_name"),
            F.md5("schema_json").alias("schema_version_md5"),
            "schema_json",
        )
    )
    known = registry.select(F.col("schema_version_md5").alias("_md5")).distinct()
    fresh = found.join(known, F.col("schema_version_md5") == F.col("_md5"), "left_anti")
    tops = registry.groupBy(F.col("schema_name").alias("_name")).agg(F.max("schema_version_num").alias("_top"))
    # A schema has few versions: the window holds the new texts of one schema name.
    nth = F.row_number().over(Window.partitionBy("schema_name").orderBy("schema_version_md5"))
    return fresh.join(tops, F.col("schema_name") == F.col("_name"), "left").select(
        "schema_name",
        (F.coalesce("_top", F.lit(0)) + nth).cast("int").alias("schema_version_num"),
        "schema_version_md5",
        "schema_json",
        F.lit(as_of).cast("date").alias("schema_actual_date_from"),
        F.lit(1).alias("schema_is_used"),
    )


# --- shredding -----------------------------------------------------------------------------


def unparsed(messages: DataFrame) -> DataFrame:
    return messages.where(F.coalesce(F.col("is_parsed").cast("int"), F.lit(0)) == 0)


def shred(messages: DataFrame, event_type: str, fields: Sequence[str]) -> DataFrame:
    """Unparsed messages of one event type as typed columns; one ``from_json`` per message.

    load_date, file_name and hash come first.  ``fields`` comes from the schema registry (or from the
    payloads).  A value that does not fit its type gives NULL."""
    text_schema = ", ".join(f"`{f}` string" for f in fields)
    rows = unparsed(messages).where(F.lower("schema_name") == event_type)
    parsed = rows.select("load_date", "file_name", "hash", F.from_json("payload_json", text_schema).alias("p"))
    return parsed.select("load_date", "file_name", "hash", *[_typed(F.col("p"), f) for f in fields])


def _typed(parsed: Column, name: str) -> Column:
    return _typed_value(parsed.getField(name), name)


def _typed_value(value: Column, name: str) -> Column:
    kind = field_type(name)
    return (value if kind == "string" else value.try_cast(kind)).alias(name)


def shred_all(messages: DataFrame, registry: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One frame per event type of the registry; the nested type is exploded.

    The messages are read and parsed once (``route``); the types are taken from the stored result."""
    known = {t: fields for t, fields in registry.items() if t in EVENT_TYPES}
    routed = cut_lineage(route(messages, list(known)))
    return {t: routed_nested(routed, fields) if t == NESTED_EVENT else routed_fields(routed, fields, t) for t, fields in known.items()}


def route(messages: DataFrame, event_types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """All known event types in one pass: schema_name, keys and a map of the payload's fields.

    One scan and one parse serve every target; written partitioned by schema_name it splits the sinks."""
    rows = unparsed(messages).where(F.lower("schema_name").isin(*event_types))
    return rows.select(
        F.lower("schema_name").alias("schema_name"),
        "load_date",
        "file_name",
        "hash",
        F.from_json("payload_json", "map<string,string>").alias("fields"),
    )


def routed_fields(routed: DataFrame, fields: Sequence[str], event_type: str | None = None) -> DataFrame:
    """Typed columns from the map of ``route``, of one event type or (with schema_name) of all."""
    columns = [_typed_value(F.col("fields")[f], f) for f in fields]
    if event_type is None:
        return routed.select("schema_name", "load_date", "file_name", "hash", *columns)
    return routed.where(F.col("schema_name") == event_type).select("load_date", "file_name", "hash", *columns)


def shred_nested(
    messages: DataFrame,
    fields: Sequence[str],
    event_type: str = NESTED_EVENT,
    nested: str = NESTED_FIELD,
    nested_fields: Sequence[str] = NESTED_FIELDS,
) -> DataFrame:
    """As ``shred``, with one row per element of the nested array beside the envelope columns.

    A message with an empty array yields no row here; ``mark_routed`` still counts it."""
    return _exploded(shred(messages, event_type, [f for f in fields if f not in nested_fields]), nested, nested_fields)


def routed_nested(
    routed: DataFrame,
    fields: Sequence[str],
    event_type: str = NESTED_EVENT,
    nested: str = NESTED_FIELD,
    nested_fields: Sequence[str] = NESTED_FIELDS,
) -> DataFrame:
    """As ``shred_nested`` from the result of ``route``."""
    return _exploded(routed_fields(routed, [f for f in fields if f not in nested_fields], event_type), nested, nested_fields)


def _exploded(outer: DataFrame, nested: str, nested_fields: Sequence[str]) -> DataFrame:
    element = "array<struct<" + ", ".join(f"`{f}`: string" for f in nested_fields) + ">>"
    exploded = outer.withColumn("_u", F.explode(F.from_json(nested, element)))
    return exploded.select(*outer.columns, *[F.col("_u").getField(f).alias(f) for f in nested_fields])


# --- flags ---------------------------------------------------------------------------------


def mark_parsed(messages: DataFrame, targets: Sequence[DataFrame]) -> DataFrame:
    """Set is_parsed = 1 on messages whose (hash, file) occurs in any target."""
    keys = reduce(DataFrame.unionByName, [t.select("hash", "file_name") for t in targets]).distinct()
    found = keys.select(F.col("hash").alias("_h"), F.col("file_name").alias("_f"))
    joined = messages.join(found, (F.col("hash") == F.col("_h")) & (F.col("file_name") == F.col("_f")), "left")
    flag = F.when(F.col("_h").isNotNull(), F.lit(1)).otherwise(F.col("is_parsed").cast("int"))
    return joined.withColumn("is_parsed", flag).select(*messages.columns)


def mark_routed(messages: DataFrame, event_types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """As ``mark_parsed`` for messages just shredded: every message of a known type counts, also one
    whose nested array is empty."""
    known = F.lower("schema_name").isin(*event_types)
    return messages.withColumn("is_parsed", F.when(known, F.lit(1)).otherwise(F.col("is_parsed").cast("int")))


def complete_files(messages: DataFrame) -> DataFrame:
    """Files all of whose messages are parsed."""
    flags = messages.groupBy("file_name").agg(F.min(F.coalesce(F.col("is_parsed").cast("int"), F.lit(0))).alias("is_parsed"))
    return flags.where("is_parsed = 1").select("file_name")


def mark_files(files: DataFrame, messages: DataFrame) -> DataFrame:
    """Set is_parsed on the complete files."""
    done = keep_matching(files, complete_files(messages), ["file_name"]).select(F.col("file_name").alias("_f")).distinct()
    joined = files.join(done, F.col("file_name") == F.col("_f"), "left")
    return joined.withColumn("is_parsed", F.col("_f").isNotNull() | F.coalesce(F.col("is_parsed").cast("boolean"), F.lit(False))).select(*files.columns)


def prefixed_parameters(params: Column, prefix: str = "wf", but: Sequence[str] = ("wf_id",)) -> Column:
    """From ``[{param, value, prior_value}]`` the pairs whose name starts with ``prefix``, except ``but``;
    the value falls back to the prior one.  Result: array of (param, value)."""
    parsed = F.from_json(params, "array<struct<param string, value string, prior_value string>>")
    kept = F.filter(parsed, lambda p: p["param"].startswith(prefix) & ~p["param"].isin(*but))
    return F.transform(
        kept, lambda p: F.struct(p["param"].alias("param"), F.coalesce(p["value"], p["prior_value"]).alias("value"))
    )


def api_snapshots(messages: DataFrame, id_path: Mapping[str, str | None]) -> DataFrame:
    """Elements of the JSON arrays of API answers with their derived id.

    ``messages``: url, obj, body.  An object body counts as a one-element array.  ``id_path`` names the
    JSON path of the id per object kind (``None`` = no id); other kinds use ``$.id``."""
    body = F.trim("body")
    as_array = F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    rows = messages.select("url", "obj", F.explode(F.from_json(as_array, "array<string>")).alias("value"))
    rows = rows.where(F.trim("value").startswith("{"))
    ident = F.get_json_object("value", "$.id")
    for kind, path in id_path.items():
        own = F.get_json_object("value", path) if path else F.lit(None)
        ident = F.when(F.col("obj") == kind, own).otherwise(ident)
    return rows.select("url", "obj", ident.try_cast("bigint").alias("id"), F.col("value").alias("msg"))
