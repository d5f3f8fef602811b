"""Run logs, API snapshots and exchange batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import newest_per_key
from millrace.functions.lineage import new_folder, store_rows
from millrace.functions.parsing import extract, json_field, safe_cast
from millrace.operators.anomaly import with_p_value

START_KEYS = ("wf", "swf", "ready", "td")  # fixed values: fields taken out of a start message
END_KEYS = ("wf", "swf", "reselt", "msg")  # fixed values: fields taken out of an end message
CALL_KINDS = ("pgSQL function", "SQL statement", "External table")  # fixed values
FINISHED = ("COMPLETED", "ABORTED")  # fixed values
RETRY_MINUTES = 30  # fixed value
# Phrases of a result text and their codes, in the order they are tried.
RESULT_HEADS = (("ok ", 1), ("no ", 0), ("empty ", -1), ("expire ", -3))
RESULT_PHRASES = (
    ("query_canceled or statement_timeout", -2),
    ("uniq check error", -4),
    ("ztest error", -5),
    ("pxf server error", -8),
)


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def interval_seconds(text: Column) -> Column:
    """Seconds of an interval text such as ``2 days``, ``1 week 03:00:00`` or ``90 min``."""
    value = F.lower(text)
    units = (("week", 604800), ("day", 86400), ("hour", 3600), ("min", 60), ("sec", 1), ("mon", 2592000))
    total = F.lit(0).cast("bigint")
    for unit, factor in units:
        total = total + F.coalesce(extract(value, rf"(\d+)\s*{unit}").cast("bigint"), F.lit(0)) * factor
    for group, factor in ((1, 3600), (2, 60), (3, 1)):
        total = total + F.coalesce(extract(value, r"(\d+):(\d+):(\d+)", group).cast("bigint"), F.lit(0)) * factor
    return F.when(text.isNotNull(), total)


def _rest(fields: Column, known: Sequence[str]) -> Column:
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*known))
    return F.when(F.size(kept) > 0, F.to_json(kept))


def pair_runs(log: DataFrame) -> DataFrame:
    """Start rows with their end row: waiting time and duration in seconds, JSON fields, leftover keys.

    ``log``: id, parent, ts, action, message (JSON, parsed once).  A start without end stays, with NULL
    end columns."""
    fields = F.from_json("message", "map<string,string>")
    a = log.where("parent is null").select(
        F.col("id").alias("beg_id"), F.col("ts").alias("beg_ts"), F.col("action").alias("beg_action"), fields.alias("_a")
    )
    b = log.where("parent is not null").select(
        F.col("parent").alias("_parent"), F.col("id").alias("end_id"), F.col("ts").alias("end_ts"),
        F.col("action").alias("end_action"), fields.alias("_b"),
    )
    ready = F.col("_a")["ready"].try_cast("timestamp")
    return a.join(b, F.col("beg_id") == F.col("_parent"), "left").select(
        "beg_id", "beg_ts", "beg_action",
        F.col("_a")["swf"].alias("swf"),
        F.col("_a")["wf"].alias("wf"),
        F.col("_a")["td"].try_cast("int").alias("td"),
        ready.alias("ready"),
        (F.unix_timestamp("beg_ts") - F.unix_timestamp(ready)).alias("wait_s"),
        _rest(F.col("_a"), START_KEYS).alias("beg_msg"),
        seconds_between("end_ts", "beg_ts").alias("duration_s"),
        "end_id", "end_ts", "end_action",
        F.col("_b")["reselt"].alias("reselt"),
        F.col("_b")["msg"].alias("msg"),
        _rest(F.col("_b"), END_KEYS).alias("end_msg"),
    )


def run_journal(log: DataFrame, stats: DataFrame, verdicts: DataFrame, config: DataFrame) -> DataFrame:
    """Runs with load statistics, the newest verdict of each run, p-value and configuration flags.

    ``log``: id, parent, ts, action, message.  ``stats``: log_id, rw_cnt and the period, load and key
    columns.  ``verdicts``: log_id, ts, object, zscore, key_date, avg, std ...  ``config``: object, z_cfg, z_except."""
    a = log.where(F.coalesce("parent", F.lit(0)) == 0).select(
        F.col("id").alias("start_id"), F.col("ts").alias("start_ts"), F.col("action").alias("start_action"), F.col("message").alias("workflow")
    )
    b = log.where(F.coalesce("parent", F.lit(0)) != 0).select(
        F.col("parent").alias("_parent"), F.col("id").alias("end_id"), F.col("ts").alias("end_ts"),
        F.col("action").alias("end_action"), F.col("message"),
    )
    s = stats.withColumnsRenamed({"log_id": "_stat_id", "rw_cnt": "rows_count"}).drop("wf_obj")
    z = newest_per_key(verdicts, ["log_id"], ["ts"]).select(
        F.col("log_id").alias("_z_id"), F.col("object").alias("_object"),
        *[c for c in ("zscore", "key_date", "key_diff", "value", "avg", "std", "cnt", "min", "max") if c in verdicts.columns],
    )
    c = config.select(F.col("object").alias("_c_object"), "z_cfg", "z_except")
    joined = (
        a.join(b, F.col("start_id") == F.col("_parent"), "left")
        .join(s, F.col("end_id") == F.col("_stat_id"), "left")
        .join(z, F.col("end_id") == F.col("_z_id"), "left")
    )
    scored = with_p_value(joined).join(c, F.col("_object") == F.col("_c_object"), "left")
    low = F.coalesce(json_field("z_cfg", "min").try_cast("double"), F.lit(-3.0))
    high = F.coalesce(json_field("z_cfg", "max").try_cast("double"), F.lit(3.0))
    return scored.withColumns(
        {
            "duration_s": seconds_between("end_ts", "start_ts"),
            "ztest_ok": F.col("zscore").between(low, high),
            "is_except": F.array_contains("z_except", F.col("key_date")),
            "confidence": F.coalesce(F.round(F.col("p_value") * 100).cast("int"), F.lit(0)),
            "stable": F.col("std") / F.nullif(F.col("avg"), F.lit(0)),
        }
    ).drop("_parent", "_stat_id", "_z_id", "_object", "_c_object", "z_cfg", "z_except", "p_value")


def error_chains(errors: DataFrame, context: str = "context") -> DataFrame:
    """Add ``last_call`` and ``calls`` (a->b->c, outermost first) read from the stack text.

    The lines stay in one array per row, so nothing is exploded or shuffled."""
    lines = F.split(F.col(context), "\n")
    parsed = F.transform(
        lines,
        lambda line, i: F.struct(
            i.alias("i"),
            F.regexp_extract(line, r"(\w+ \w+) ", 1).alias("kind"),
            F.nullif(F.regexp_extract(line, r'\w+ \w+ "?([\.\w]+)', 1), F.lit("")).alias("name"),
        ),
    )
    calls = F.filter(parsed, lambda x: x["kind"].isin(*CALL_KINDS))
    names = F.filter(F.transform(F.reverse("_calls"), lambda x: x["name"]), lambda n: n.isNotNull())
    first = F.get("_calls", F.lit(0))
    return (
        errors.withColumn("_calls", calls)
        .withColumns(
            {
                "last_call": F.when(first["i"] == 0, first["name"]),
                "calls": F.when(F.size("_calls") > 0, F.concat_ws("->", names)),
            }
        )
        .drop("_calls")
    )


# --- API snapshots ---------------------------------------------------------------------------


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """Newest version per (id, obj, url)."""
    return newest_per_key(snapshots, ["id", "obj", "url"], ["ts"])


def last_message(runs: DataFrame, end_action: str) -> DataFrame:
    """Message of the newest run per workflow that ended with ``end_action``."""
    return runs.where(F.col("end_action") == end_action).groupBy("workflow").agg(F.max_by("message", "start_id").alias("message"))


def latest_entities(snapshots: DataFrame) -> DataFrame:
    """Newest attributes per entity."""
    last = newest_per_key(snapshots.where("obj = 'entity'").select("id", "ts", "url", "msg"), ["id"], ["ts"])
    return last.select(
        "id", "ts", "url",
        *[json_field("msg", f).alias(f) for f in ("name", "path", "storage")],
        json_field("msg", "parentId").try_cast("bigint").alias("parentid"),
        "msg",
    )


STATUS_LIST = "array<struct<effective_from string, status string, log string>>"
LOAD_FIELDS = (
    "alive string, auto string, start_dttm string, end_dttm string, profile string, wf_id string, status string, status_log string, "
    f"loading_status {STATUS_LIST}"
)


def statuses(msg: Column | str) -> Column:
    return F.from_json(json_field(msg, "loading_status"), STATUS_LIST)


def latest_loads(snapshots: DataFrame) -> DataFrame:
    """Newest state per load.  An aborted load has status ABORTED as of its end; otherwise the status
    counts from the newest ``effective_from`` in the status list."""
    last = newest_per_key(snapshots.where("obj = 'loading'").select("id", "ts", "url", "msg"), ["id"], ["ts"])
    parsed = last.withColumn("p", F.from_json("msg", LOAD_FIELDS))
    aborted = F.col("p.alive") == "ABORTED"
    end = F.col("p.end_dttm").try_cast("timestamp")
    newest = F.array_max(F.transform("p.loading_status", lambda s: s["effective_from"])).try_cast("timestamp")
    return parsed.select(
        "id", "ts", "url",
        F.col("p.alive").alias("alive"),
        F.col("p.auto").alias("auto"),
        F.col("p.start_dttm").try_cast("timestamp").alias("start_dttm"),
        end.alias("end_dttm"),
        F.col("p.profile").alias("profile"),
        F.col("p.wf_id").try_cast("bigint").alias("wf_id"),
        F.when(aborted, end).otherwise(newest).alias("status_dttm"),
        F.when(aborted, "ABORTED").otherwise(F.col("p.status")).alias("status"),
        F.col("p.status_log").alias("status_log"),
        "msg",
    )


CATALOGUE_FIELDS = (
    "profile", "category", "name", "scheduled", "deleted", "singleLoading", "engine", "type", "eventAwaitStrategy", "wf_event_sched", "wf_time_sched",
    "param", "statusNotifications",
)


def _newest_answers(snapshots: DataFrame, category_prefix: str) -> DataFrame:
    """What the workflow catalogue needs of the snapshots: the newest answer per (kind, key), from one scan and one aggregate.

    Kinds: ``wf`` per workflow of both shapes, ``link`` per (workflow, time, entity) of the entity lists with their number
    ``n``, ``stat`` per (entity, statistic, profile), ``load`` and ``entity`` per id.  A NULL time counts as newest; url,
    connections, text and id break ties.  Stored once, because every branch reads it; it holds a row per key, not per snapshot.
    """
    url, msg, types = F.col("url"), F.col("msg"), {f.name: f.dataType for f in snapshots.schema}
    shape_1, shape_2 = F.get_json_object(msg, "$.wf"), F.get_json_object(msg, "$.workflow")
    fields = {
        "kind": "string", "id": "bigint", "ref": "bigint", "e": "string", "s": "string", "p": "string", "at": types["ts"],
        "ts": types["ts"], "url": "string", "connected_ids": "string", "msg": "string", "loading_id": "bigint",
    }

    def item(kind: str, **values: Column) -> Column:
        known = {"kind": F.lit(kind), **values}
        return F.struct(*[known.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields.items()])

    def ours(text: Column) -> Column:
        return json_field(text, "category").startswith(category_prefix)

    obj, ts, own = F.col("obj"), F.col("ts"), F.col("id")
    is_load = url.rlike(r"/loading/\d+")
    items = F.array(
        F.when((url == "/wf/extended") & ours(shape_1),
               item("wf", id=own, ts=ts, url=url, connected_ids=F.get_json_object(msg, "$.connectedEntities"), msg=shape_1)),
        F.when(is_load & ours(shape_2), item("wf", id=json_field(shape_2, "id").try_cast("bigint"), ts=ts, url=url, msg=shape_2)),
        F.when(url.rlike(r"/entity/wf/\d+") & ts.isNotNull() & own.isNotNull(),
               item("link", id=extract(url, r"/entity/wf/(\d+)").cast("bigint"), ref=own, at=ts)),
        F.when(obj == "statval", item("stat", **{k: json_field(msg, n) for k, n in (("e", "entity_id"), ("s", "stat_id"), ("p", "profile"))}, ts=ts, loading_id=own)),
        F.when(obj == "loading", item("load", id=own, ts=ts, url=url, msg=F.from_json(msg, "end_dttm string")["end_dttm"])),
        F.when(obj == "entity", item("entity", id=own, ts=ts, url=url, msg=json_field(msg, "name"))),
    )
    keys = ["kind", "id", "ref", "e", "s", "p", "at"]
    rest = [n for n in fields if n not in keys]
    rows = snapshots.select(F.inline(F.filter(items, lambda x: x.isNotNull())))
    newest = rows.groupBy(*keys).agg(F.max(F.struct(F.col("ts").isNull().alias("_null"), *rest)).alias("_row"), F.count(F.lit(1)).alias("n"))
    return store_rows(newest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest], "n"), new_folder(snapshots.sparkSession))


def workflow_catalogue(snapshots: DataFrame, category_prefix: str) -> DataFrame:
    """Workflows from the two API shapes (newest wins) with schedule, parameters and connections.

    Shape 1: url ``/wf/extended`` with ``wf`` and ``connectedEntities``.  Shape 2: url ``/loading/<n>`` with
    ``workflow``; its connections come from the newest ``/entity/wf/<id>`` answer.  Active event
    conditions are joined to the newest statistic and its load.  The snapshots are read once."""
    known = _newest_answers(snapshots, category_prefix)

    def kind(name: str) -> DataFrame:
        return known.where(F.col("kind") == name)

    wf = kind("wf").select("id", "ts", "url", "connected_ids", "msg", F.json_tuple("msg", *CATALOGUE_FIELDS).alias(*[f"_{f}" for f in CATALOGUE_FIELDS]))

    conditions = F.from_json("_wf_event_sched", "array<struct<active string, profile string, stat_id string, entity_id string>>")
    active = wf.select("id", F.explode(conditions).alias("c")).where(F.col("c.active").try_cast("boolean")).select(
        "id", F.col("c.profile").alias("profile"), F.col("c.stat_id").alias("stat_id"), F.col("c.entity_id").alias("entity_id")
    )
    stat = kind("stat").select(F.col("e").alias("_e"), F.col("s").alias("_s"), F.col("p").alias("_p"), "loading_id")
    loads = kind("load").select(F.col("id").alias("_lid"), F.col("msg").try_cast("timestamp").alias("end_dttm"))
    events = (
        active.join(stat, (F.col("entity_id") == F.col("_e")) & (F.col("stat_id") == F.col("_s")) & (F.col("profile") == F.col("_p")), "left")
        .join(loads, F.col("loading_id") == F.col("_lid"), "left")
    )
    when_text = F.coalesce(F.date_format("end_dttm", "yyyy-MM-dd HH:mm:ss"), F.col("loading_id").cast("string"), F.lit(""))
    item = F.struct(
        F.col("end_dttm").isNotNull().alias("a"), "end_dttm", F.col("loading_id").isNotNull().alias("b"), "loading_id", "entity_id",
        F.concat("entity_id", F.lit(" ("), when_text).alias("text"),
    )
    per_stat = events.groupBy("id", "profile", "stat_id").agg(F.sort_array(F.collect_list(item)).alias("_items"))
    text = F.concat("profile", F.lit(" ["), "stat_id", F.lit("] {"), F.array_join(F.transform("_items", lambda x: x["text"]), "), "), F.lit(")}"))
    schedule = per_stat.groupBy(F.col("id").alias("_sid")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("profile", "stat_id", text.alias("t")))), lambda x: x["t"]), ", ").alias("_sched")
    )

    # Entities in the order of the list in shape 1, by id in shape 2.
    is_first = F.col("url") == "/wf/extended"
    listed = wf.where(is_first).select("id", F.posexplode(F.from_json("connected_ids", "array<bigint>")).alias("_pos", "_ref"))
    links = kind("link").select(F.col("id").alias("_wf"), "ref", "at", "n")
    last = links.groupBy(F.col("_wf").alias("_lwf")).agg(F.max("at").alias("_last"))
    current = links.join(last, (F.col("_wf") == F.col("_lwf")) & (F.col("at") == F.col("_last"))).select("_wf", F.explode(F.expr("array_repeat(ref, int(n))")).alias("_ref"))
    answered = wf.where(~is_first).join(current, F.col("id") == F.col("_wf")).select("id", F.col("_ref").alias("_pos"), "_ref")
    entities = kind("entity").select(F.col("id").alias("_eid"), F.col("msg").alias("_ename"))
    name = F.concat(F.col("_ref").cast("string"), F.lit(": "), F.coalesce("_ename", F.lit("")))
    linked = (
        listed.select("id", F.col("_pos").cast("bigint").alias("_pos"), "_ref").unionByName(answered)
        .join(entities, F.col("_ref") == F.col("_eid"), "left")
        .groupBy(F.col("id").alias("_cid"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_pos", name.alias("t")))), lambda x: x["t"]), ", ").alias("connected"))
    )
    params = F.from_json("_param", "array<struct<param string, prior_value string>>")
    interval = F.get(F.filter(params, lambda p: p["param"] == "wf_interval"), F.lit(0)).getField("prior_value")
    strategy = F.col("_eventAwaitStrategy")
    return (
        wf.join(schedule, F.col("id") == F.col("_sid"), "left")
        .join(linked, F.col("id") == F.col("_cid"), "left")
        .select(
            "id", "ts", "url",
            *[F.col(f"_{f}").alias(f) for f in ("profile", "category", "name")],
            *[F.col(f"_{f}").try_cast("boolean").alias(f.lower()) for f in ("scheduled", "deleted", "singleLoading")],
            *[F.col(f"_{f}").alias(f) for f in ("engine", "type")],
            "connected",
            strategy.alias("eventawaitstrategy"),
            F.coalesce(
                F.concat(strategy, F.lit(": "), "_sched"),
                F.concat(F.lit("sched: "), F.coalesce(json_field("_wf_time_sched", "sched"), F.lit(""))),
            ).alias("wf_sched"),
            F.array_join(
                F.transform(params, lambda p: F.concat(p["param"], F.lit(": "), F.coalesce(F.replace(p["prior_value"], F.lit("$"), F.lit("%")), F.lit("")))), "; "
            ).alias("param"),
            F.col("_statusNotifications").alias("statusnotifications"),
            F.coalesce(interval_seconds(interval), F.lit(86400)).alias("wf_interval_s"),
        )
    )


# --- exchange batches ------------------------------------------------------------------------


def exchange_batches(log: DataFrame) -> DataFrame:
    """Per (workflow, batch, key, type): complete when exactly two confirmations agree on count and
    lengths; ``wf_data`` lists the differences as JSON.  ``time_s`` is the summed time.

    ``log``: id, ts, wf_name, wf_key, wf_data (JSON)."""
    numbers = ("cnt", "sum_len", "min_len", "max_len")
    parsed = log.withColumn("p", F.from_json("wf_data", "type string, cnt bigint, sum_len bigint, min_len bigint, max_len bigint, time string"))
    rows = parsed.select(
        "wf_name", "id", "wf_key", "ts", F.col("p.type").alias("type"),
        *[F.col(f"p.{n}").alias(n) for n in numbers],
        interval_seconds(F.col("p.time")).alias("time_s"),
    )
    grouped = rows.groupBy("wf_name", "id", "wf_key", "type").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.min(n).alias(n) for n in numbers],
        *[F.max(n).alias(f"_max_{n}") for n in numbers],
        F.sum("time_s").alias("time_s"),
        F.min("ts").alias("ts"),
        F.max("ts").alias("_max_ts"),
    )
    complete = (F.col("_n") == 2) & (F.col("_max_cnt") == F.col("cnt"))
    for n in numbers[1:]:
        complete = complete & F.col(f"_max_{n}").eqNullSafe(F.col(n))
    notes = F.to_json(
        F.struct(
            F.date_format("_max_ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
            "type",
            F.when(F.col("_n") != 2, F.col("_n")).alias("count"),
            *[F.when(~F.col(f"_max_{n}").eqNullSafe(F.col(n)), F.col(f"_max_{n}")).alias(n) for n in numbers],
        )
    )
    return grouped.select(
        "wf_name", "id", "wf_key", "type", *numbers, "time_s", "ts", complete.alias("completed"), notes.alias("wf_data")
    )


def _retry(as_of) -> Column:
    finished = F.when(F.col("alive") != "ACTIVE", F.col("alive")).isin(*FINISHED)
    failed = (F.col("status") != "SUCCESS") | ~F.col("completed")
    late = F.col("ts") < F.lit(as_of).cast("timestamp") - F.make_interval(mins=F.lit(RETRY_MINUTES))
    return (finished & failed) | (~F.col("completed") & late)


def _load_state(loads: DataFrame) -> DataFrame:
    return loads.select(
        F.col("id").alias("_lid"), "status_dttm", F.col("auto").try_cast("boolean").alias("auto"), "alive", "status", "status_log"
    )


def exchange_ids(batches: DataFrame, loads: DataFrame, as_of) -> DataFrame:
    """Per (workflow, batch): totals, load state and whether to retry: finished but unsuccessful or incomplete,
    or still incomplete after thirty minutes.  Its keys are the rows of ``attempts``."""
    totals = batches.groupBy("wf_name", "id").agg(
        (F.min(F.col("completed").cast("int")) == 1).alias("completed"),
        F.max("ts").alias("ts"),
        F.count("wf_key").alias("keys_cnt"),
        F.sum("cnt").alias("cnt"),
        F.sum("sum_len").alias("sum_len"),
        F.max("time_s").alias("time_s"),
    )
    joined = totals.join(_load_state(loads), F.col("id") == F.col("_lid"), "left").drop("_lid")
    return joined.withColumn("retry", _retry(as_of))


def attempts(batches: DataFrame) -> DataFrame:
    """One row per (workflow, batch, key), with the newest time: the keys of a batch and the attempts of a key."""
    return batches.where(F.col("wf_key").isNotNull()).groupBy("wf_name", "id", "wf_key").agg(F.max("ts").alias("ts"))


def exchange_keys(batches: DataFrame, loads: DataFrame, as_of) -> DataFrame:
    """Per (workflow, key): the newest attempt that is complete or decided, with the number of attempts (the rows of ``attempts``)."""
    last = newest_per_key(batches, ["wf_name", "id", "wf_key"], ["ts"])
    log = last.join(_load_state(loads), F.col("id") == F.col("_lid"), "left").drop("_lid").withColumn("retry", _retry(as_of))
    decided = newest_per_key(
        log.where(F.col("completed") | F.col("retry").isNotNull()).drop("wf_data", "type"), ["wf_name", "wf_key"], ["id"]
    )
    counted = last.groupBy(F.col("wf_name").alias("_w"), F.col("wf_key").alias("_k")).agg(
        F.count(F.lit(1)).alias("ids_cnt"), F.min("id").alias("first_id")
    )
    return decided.join(counted, (F.col("wf_name") == F.col("_w")) & (F.col("wf_key") == F.col("_k"))).select(
        "wf_name", "wf_key", "completed", "retry", F.col("ts").alias("last_ts"), F.col("id").alias("last_id"), "first_id", "ids_cnt",
        "cnt", "sum_len", "time_s", "status_dttm", "auto", "alive", "status", "status_log",
    )


# --- delivery, retention, outcome ------------------------------------------------------------


def delivery_state(log: DataFrame) -> DataFrame:
    """Per log row of a report: end and send flags and the delay until it was sent.

    ``log``: id, parent, ts, action.  The rows of a report share ``coalesce(parent, id)``."""
    head = F.coalesce(F.nullif("parent", F.lit(0)), F.col("id")).alias("head")
    rows = log.select("id", F.nullif("parent", F.lit(0)).alias("parent"), "ts", "action", head)
    marks = (
        log.where(F.col("action").isin("end", "send") & (F.coalesce("parent", F.lit(0)) != 0))
        .groupBy(F.col("parent").alias("_head"))
        .agg(F.min(F.when(F.col("action") == "end", F.col("ts"))).alias("_end"), F.min(F.when(F.col("action") == "send", F.col("ts"))).alias("_send"))
    )
    return rows.join(marks, F.col("head") == F.col("_head"), "left").select(
        "id", "parent", "ts", "action", "head",
        F.col("_end").isNotNull().alias("is_end"),
        F.col("_send").isNotNull().alias("is_send"),
        seconds_between("_send", "ts").alias("send_s"),
    )


def unsent_finished(log: DataFrame) -> DataFrame:
    """Reports that have ended but were not sent, oldest first."""
    state = delivery_state(log)
    return state.where(F.col("parent").isNull() & F.col("is_end") & ~F.col("is_send")).select("id", "ts", "action")


def retained(log: DataFrame, before, end_actions: Sequence[str]) -> DataFrame:
    """Log without the paired rows that started before a date and ended with one of the actions."""
    runs = log.where("parent is null").select(F.col("id").alias("_beg"), F.col("ts").alias("_ts"))
    ends = log.where(F.col("parent").isNotNull() & F.col("action").isin(*end_actions)).select(
        F.col("parent").alias("_parent"), F.col("id").alias("_end")
    )
    old = runs.where(F.col("_ts") < F.lit(before).cast("timestamp")).join(ends, F.col("_beg") == F.col("_parent"))
    gone = old.select(F.explode(F.array("_beg", "_end")).alias("_gone")).distinct()
    return log.join(gone, F.col("id") == F.col("_gone"), "left_anti")


def repeated_executions(runs: DataFrame, workflow: str = "workflow", ready: str = "ready") -> DataFrame:
    """Executed runs of a workflow and ready time that occur more than once."""
    many = runs.groupBy(F.col(workflow).alias("_w"), F.col(ready).alias("_r")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return runs.join(many, (F.col(workflow) == F.col("_w")) & (F.col(ready) == F.col("_r")), "left_semi")


def staleness(df: DataFrame, ts: str, as_of, fresh_s: int = 120, late_s: int | None = 600, worst: int = -1) -> DataFrame:
    """Grade of a feed by its newest timestamp: 1 fresh, 0 late, ``worst`` beyond (or without rows)."""
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.max(ts))
    grade = F.when(age < fresh_s, 1)
    if late_s is not None:
        grade = grade.when(age < late_s, 0)
    return df.agg(F.max(ts).alias("max_ts"), grade.otherwise(worst).alias("res"))


def outcome_code(text: Column | str) -> Column:
    """Code of a free-text or JSON result: 1 ok, 0 no data, -1 empty, -2 cancelled, -3 expired, -4 not unique,
    -5 anomaly, -8 source error, else -9; a JSON ``result`` or ``res`` overrides."""
    c = F.col(text) if isinstance(text, str) else text
    low = F.lower(c)
    head = F.concat(low, F.lit(" "))
    code = F.when(head == " ", 1)
    for text_head, value in RESULT_HEADS:
        code = code.when(head.startswith(text_head), value)
    for phrase, value in RESULT_PHRASES:
        code = code.when(low.contains(phrase), value)
    code = code.otherwise(-9)
    own = [safe_cast(json_field(c, name), "int") for name in ("result", "res")]
    return F.coalesce(*own, code)
