"""Report sections over paired runs, load states and verdicts.

Runs: run_id, workflow, category, start_ts, end_ts, res, duration_s, message ...
Reports list rows of a day or a week; a rank column is added only under a row limit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import newest_per_key
from millrace.functions.parsing import extract, json_field
from millrace.operators.runlog import seconds_between, statuses

WAITING = ("EVENT-WAIT", "TIME-WAIT")  # fixed values
# Result code and the name of its column.
OUTCOMES = {
    1: "cnt_ok", 0: "cnt_no_data", -1: "cnt_empty", -2: "cnt_canceled", -3: "cnt_expired", -4: "cnt_uniq",
    -5: "cnt_ztest", -7: "cnt_ctl_err", -8: "cnt_pxf_err", -9: "cnt_error",
}
LONG_RUN_S = 1800  # fixed value
SLOT_S = 600  # fixed value


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def within(rows: DataFrame, column: str, first, last) -> DataFrame:
    """Rows with ``first <= column < last``."""
    return rows.where((F.col(column) >= _ts(first)) & (F.col(column) < _ts(last)))


def listed(rows: DataFrame, order: Sequence[Column], top: int | None = None) -> DataFrame:
    """Sorted rows; with ``top`` only the first ones, numbered in ``n``."""
    if top is None:
        return rows.orderBy(*order)
    head = rows.orderBy(*order).limit(top)
    return head.withColumn("n", F.row_number().over(Window.orderBy(*order)))  # at most ``top`` rows


def status_board(loads: DataFrame, catalogue: DataFrame, since, as_of) -> DataFrame:
    """Per category and in total: distinct workflows active, completed, ok, without data and failed, waiting,
    delayed (one to two own intervals) and expired (more than two).

    Flags are aggregated per (category, workflow) first, so counting distinct workflows is a plain sum."""
    wf = catalogue.where(~F.col("deleted")).select(F.col("id").alias("_wf"), "category", "wf_interval_s")
    rows = loads.where((F.col("status_dttm") >= _ts(since)) | (F.col("alive") == "ACTIVE")).join(wf, F.col("wf_id") == F.col("_wf"))
    age = F.unix_timestamp(_ts(as_of)) - F.unix_timestamp("status_dttm")
    res = json_field("status_log", "res").try_cast("int")
    active, completed = F.col("alive") == "ACTIVE", F.col("alive") == "COMPLETED"
    flags = {
        "active": active,
        "completed": completed,
        "cnt_ok": res > 0,
        "cnt_no": res == 0,
        "cnt_err": res < 0,
        "_seen": active | completed,
        "delayed": active & age.between(F.col("wf_interval_s"), F.col("wf_interval_s") * 2),
        "expired": active & (age > F.col("wf_interval_s") * 2),
    }
    per_wf = rows.groupBy("category", "wf_id").agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in flags.items()]
    )
    board = per_wf.withColumn("category", F.split_part("category", F.lit("."), F.lit(2))).rollup("category").agg(
        F.grouping("category").alias("is_total"), *[F.sum(n).alias(n) for n in flags]
    )
    zero = F.lit(0).cast("bigint")
    return board.select(
        F.when(F.col("is_total") == 0, F.col("category")).alias("category"),
        F.col("is_total").cast("int").alias("is_total"),
        *[F.nullif(F.col(n), zero).alias(n) for n in ("active", "completed", "cnt_ok", "cnt_no", "cnt_err")],
        F.nullif(F.col("_seen") - F.col("completed"), zero).alias("waited"),
        F.nullif(F.col("delayed"), zero).alias("delayed"),
        F.nullif(F.col("expired"), zero).alias("expired"),
    )


def outcome_pivot(runs: DataFrame, by: Sequence[str] = ("res", "category", "wf_prefix"), total: bool = False) -> DataFrame:
    """Counts by result code and durations per group; ``total`` adds one row over everything (is_total = 1)."""
    rows = runs.withColumn("wf_prefix", extract(F.lower("workflow"), "([a-zA-Z0-9]+)_")).where("wf_prefix is not null")
    zero = F.lit(0).cast("bigint")
    aggs = [
        F.count(F.lit(1)).alias("wf_cnt"),
        F.sum("duration_s").alias("sum_s"),
        F.min("duration_s").alias("min_s"),
        F.max("duration_s").alias("max_s"),
        F.round(F.avg("duration_s"), 3).alias("avg_s"),
        *[F.nullif(F.count_if(F.col("res") == code), zero).alias(name) for code, name in OUTCOMES.items()],
    ]
    if not total:
        return rows.groupBy(*by).agg(*aggs)
    # The total row groups by a constant key of its own, not by the codes counted above.
    keyed = rows.withColumns({f"_g_{c}": F.col(c) for c in by})
    names = [f"_g_{c}" for c in by]
    sets = keyed.groupingSets([names, []], *names).agg(F.grouping(names[0]).cast("int").alias("is_total"), *aggs)
    return sets.withColumnsRenamed(dict(zip(names, by, strict=True)))


def concurrency_load(runs: DataFrame, day: dt.date, capacity: int, key: str = "workflow") -> DataFrame:
    """Hour by ten-minute slot: distinct running workflows and busy share of ``capacity``.

    A sweep over the slots of the day: a run adds its full slots where it starts and takes them away after its last one,
    what it misses of the two end slots is taken off there.  So a run is four edges, however long it is.  A workflow
    counts once a slot: its runs, at most one per start slot after the first aggregate, are merged into stretches.
    """
    start, end = F.lit(dt.datetime.combine(day, dt.time())), F.lit(dt.datetime.combine(day + dt.timedelta(days=1), dt.time()))
    first, last = F.unix_timestamp(start.cast("timestamp")), F.unix_timestamp(end.cast("timestamp"))
    beg, fin = F.unix_timestamp("start_ts"), F.unix_timestamp("end_ts")
    low = F.floor(F.greatest(beg, first) / SLOT_S) * SLOT_S
    high = F.floor((F.least(fin, last) - 1) / SLOT_S) * SLOT_S
    touched = runs.where(F.col("end_ts").isNotNull() & (beg < last) & (fin > first)).select(
        F.col(key).alias("_key"), beg.alias("_b"), fin.alias("_f"), low.alias("_lo"), F.greatest(low, high).alias("_hi")
    ).where("_f > _lo")

    def edge(at, step, here):
        return F.struct(at.alias("_s"), step.alias("step"), here.alias("here"))

    none, slot = F.lit(0).cast("bigint"), F.lit(SLOT_S).cast("bigint")
    lo, hi = F.col("_lo"), F.col("_hi")
    early, late = F.greatest("_b", lo) - lo, hi + slot - F.least(F.col("_f"), hi + slot)
    edges = F.array(edge(lo, slot, -early), edge(hi, none, -late), edge(hi + slot, -slot, none))
    busy = touched.select(F.explode(edges).alias("e")).groupBy("e._s").agg(F.sum("e.step").alias("step"), F.sum("e.here").alias("here"))

    reach = touched.where("_key is not null").groupBy("_key", "_lo").agg(F.max("_hi").alias("_hi"))  # at most 144 rows a workflow
    before = Window.partitionBy("_key").orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest("_lo", F.coalesce(F.max("_hi").over(before) + slot, F.lit(0)))
    fresh = reach.withColumn("_from", covered).where("_from <= _hi")
    stretches = fresh.select(F.explode(F.array(edge(F.col("_from"), F.lit(1), F.lit(0)), edge(hi + slot, F.lit(-1), F.lit(0)))).alias("e"))
    running = stretches.groupBy("e._s").agg(F.sum("e.step").alias("_count"))

    slots = runs.sparkSession.range(24 * 3600 // SLOT_S).select((first + F.col("id") * SLOT_S).alias("_s"))
    upto = Window.orderBy("_s")  # the slots of one day

    def total(name):
        return F.coalesce(F.sum(name).over(upto), F.lit(0))

    per_slot = slots.join(busy, "_s", "left").join(running, "_s", "left").select(
        "_s", total("_count").alias("_wf"), (total("step") + F.coalesce("here", F.lit(0))).alias("_busy")
    )
    offset = F.col("_s") - first
    cells = per_slot.select(
        F.expr("0").alias("_zero"), F.floor(offset / 3600).cast("int").alias("hour"), (offset % 3600 / 60).cast("int").alias("_m"),
        "_wf", (F.col("_busy") / (SLOT_S * capacity)).alias("_rate"),
    )
    hours = runs.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    wide = hours.join(cells, "hour", "left").groupBy("hour").agg(
        *[
            expr
            for m in range(0, 60, 10)
            for expr in (
                F.max(F.when(F.col("_m") == m, F.col("_wf")).otherwise(0)).alias(f"cnt_{m:02d}"),
                F.round(F.max(F.when(F.col("_m") == m, F.col("_rate")).otherwise(0.0)), 2).alias(f"rate_{m:02d}"),
            )
        ]
    )
    return wide


def failures_with_last_success(runs: DataFrame, bad: Column, last_run_from=None, last_run_to=None, skip_category: str | None = None) -> DataFrame:
    """Runs matching ``bad`` with the start of the newest successful run of the same workflow."""
    rows = runs if skip_category is None else runs.where(F.col("category") != skip_category)
    last_ok = rows.where("res = 1").groupBy(F.col("workflow").alias("_w")).agg(F.max("start_ts").alias("last_ok"))
    failed = rows.where(bad)
    if last_run_from is not None:
        failed = failed.where(F.col("end_ts") >= _ts(last_run_from))
    if last_run_to is not None:
        failed = failed.where(F.col("end_ts") <= _ts(last_run_to))
    return failed.join(last_ok, F.col("workflow") == F.col("_w"), "left").drop("_w")


def long_runs(runs: DataFrame, since, at_least_s: int = LONG_RUN_S, top: int | None = None) -> DataFrame:
    """Successful runs of at least half an hour, longest first."""
    rows = runs.where((F.col("res") == 1) & (F.col("duration_s") >= at_least_s) & (F.col("end_ts") >= _ts(since)))
    return listed(rows, [F.col("duration_s").desc(), F.col("run_id")], top)


def runs_of(runs: DataFrame, since, res: int | None = None, category: str | None = None, top: int | None = None) -> DataFrame:
    """Runs ended since a time by result and category, newest first."""
    rows = runs.where(F.col("end_ts") >= _ts(since))
    if res is not None:
        rows = rows.where(F.col("res") == res)
    if category is not None:
        rows = rows.where(F.col("category") == category)
    return listed(rows, [F.col("end_ts").desc(), F.col("run_id")], top)


def error_rollup(log: DataFrame, first, last) -> DataFrame:
    """Errors already aggregated in the log and raw errors grouped by (object, message).

    ``log``: ts, action, message (JSON with obj, msg and, when aggregated, first, last, cnt)."""
    errors = within(log.where("action = 'error'"), "ts", first, last)
    began = json_field("message", "first")
    fields = [json_field("message", n).alias(n) for n in ("obj", "msg")]
    done = errors.where(began.isNotNull()).select(
        F.lit("log").alias("src"), began.try_cast("timestamp").alias("first_dt"), json_field("message", "last").try_cast("timestamp").alias("last_dt"),
        json_field("message", "cnt").try_cast("bigint").alias("cnt"), *fields,
    )
    raw = errors.where(began.isNull()).groupBy(*fields).agg(
        F.min("ts").cast("timestamp").alias("first_dt"), F.max("ts").cast("timestamp").alias("last_dt"), F.count(F.lit(1)).alias("cnt")
    )
    return done.unionByName(raw.select(F.lit("tbl").alias("src"), "first_dt", "last_dt", "cnt", "obj", "msg"))


def _with_catalogue(loads: DataFrame, catalogue: DataFrame) -> DataFrame:
    wf = catalogue.select(
        F.col("id").alias("_wf"), "category", "name", F.col("profile").alias("wf_profile"), "scheduled", "wf_sched", "connected", "wf_interval_s"
    )
    return loads.join(wf, F.col("wf_id") == F.col("_wf"), "left").drop("_wf")


def stuck_loads(loads: DataFrame, catalogue: DataFrame, as_of, category_prefix: str, profile: str | None = None) -> DataFrame:
    """Active loads older than their own interval or in a state other than waiting."""
    rows = _with_catalogue(loads, catalogue).where((F.col("alive") == "ACTIVE") & F.col("category").startswith(category_prefix))
    if profile is not None:
        rows = rows.where(F.col("wf_profile") == profile)
    age = F.unix_timestamp(_ts(as_of)) - F.unix_timestamp("start_dttm")
    old = (age > F.col("wf_interval_s")) | ~F.col("status").isin(*WAITING)
    return rows.where(old).select(
        "id", "auto", "status_dttm", (F.unix_timestamp(_ts(as_of)) - F.unix_timestamp("status_dttm")).alias("status_s"),
        F.concat("status", F.lit(": "), F.coalesce("status_log", F.lit(""))).alias("status_info"), "wf_id",
        F.split_part("category", F.lit("."), F.lit(2)).alias("category"), "name", "wf_sched",
    )


def error_loads(loads: DataFrame, catalogue: DataFrame, category: str, as_of) -> DataFrame:
    """Loads in error that ended within a day or are active with a status younger than a month."""
    now = F.unix_timestamp(_ts(as_of))
    recent = (now - F.unix_timestamp("end_dttm") < 86400) | (
        (F.col("alive") == "ACTIVE") & (now - F.unix_timestamp("status_dttm") < 30 * 86400)
    )
    rows = _with_catalogue(loads, catalogue).where((F.col("status") == "ERROR") & (F.col("category") == category) & recent)
    return rows.select("id", "auto", "alive", "status_dttm", "status", "wf_id", "category", "name")


def active_loads(loads: DataFrame, catalogue: DataFrame, category_prefix: str) -> DataFrame:
    """All active loads of a category."""
    return _with_catalogue(loads, catalogue).where((F.col("alive") == "ACTIVE") & F.col("category").startswith(category_prefix))


def not_scheduled(catalogue: DataFrame, category_prefix: str, archive: str) -> DataFrame:
    """Existing workflows without schedule, except the archive category."""
    return catalogue.where(
        ~F.col("scheduled") & ~F.col("deleted") & F.col("category").startswith(category_prefix) & (F.col("category") != archive)
    )


def status_timeline(loads: DataFrame, catalogue: DataFrame, day: dt.date, category_prefix: str) -> DataFrame:
    """Every status change of the loads that finished on a day, numbered within the load.

    The status list of a load is sorted in place; there is no window over loads."""
    rows = _with_catalogue(loads, catalogue).where(
        (F.col("alive") != "ACTIVE") & F.col("category").startswith(category_prefix) & (F.to_date("status_dttm") == F.lit(day))
    )
    steps = F.sort_array(statuses("msg"))
    return rows.select("id", "alive", "profile", "wf_id", "name", F.posexplode(steps).alias("_pos", "_s")).select(
        "id", "alive", "profile", "wf_id", "name", (F.col("_pos") + 1).alias("nn"),
        F.col("_s.effective_from").try_cast("timestamp").alias("status_dttm"), F.col("_s.status").alias("status"), F.col("_s.log").alias("log"),
    )


def _waits(rows: DataFrame) -> DataFrame:
    running = F.filter(statuses("msg"), lambda s: s["status"] == "RUNNING")
    began = F.array_min(F.transform(running, lambda s: s["effective_from"])).try_cast("timestamp")
    return rows.withColumn("_began", began).withColumns(
        {"wait_s": seconds_between("_began", "start_dttm"), "run_s": seconds_between("status_dttm", "_began")}
    ).drop("_began")


def load_times(
    loads: DataFrame, catalogue: DataFrame, exchange: DataFrame, category: str, first, last, errors: bool = False
) -> DataFrame:
    """Newest load per workflow with waiting and running time and its exchange batch.

    Waiting runs from the load's start to the first RUNNING status, running from there to the last
    status.  ``errors`` lists failed loads instead of finished ones.  A load that several exchange
    workflows (``wf_name``) served has a row for each of them."""
    if errors:
        wanted = F.col("status").isin("ABORTED", "ERROR", "ERRORCHECK") | (F.col("alive") == "ABORTED")
    else:
        wanted = ~F.col("status").isin(*WAITING, "ABORTED") & (F.col("alive") != "ACTIVE")
    rows = _with_catalogue(loads, catalogue).where(
        wanted & (F.col("category") == category) & F.col("status_dttm").between(_ts(first), _ts(last))
    )
    newest = newest_per_key(_waits(rows), ["wf_id"], ["id"])
    x = exchange.select(F.col("id").alias("_x"), "wf_name", "keys_cnt", F.col("cnt").alias("rows_count"), "sum_len", "time_s", "completed", "retry")
    return newest.join(x, F.col("id") == F.col("_x"), "left").select(
        "id", "auto", "alive", "status_dttm", "wait_s", "run_s", "status", "wf_id", "category", "name", "scheduled",
        "wf_name", "keys_cnt", "rows_count", "sum_len", "time_s", "completed", "retry",
    )


def exchange_times(exchange: DataFrame, loads: DataFrame, since, errors: bool = False) -> DataFrame:
    """Exchange batches with the times of their load: the newest per workflow, or all failed ones."""
    rows = exchange.where(F.col("ts") >= _ts(since))
    if errors:
        rows = rows.where(~F.col("completed") | F.col("retry"))
    else:
        rows = newest_per_key(rows, ["wf_name"], ["ts"])
    times = _waits(loads).select(F.col("id").alias("_l"), "wait_s", "run_s")
    return rows.join(times, F.col("id") == F.col("_l"), "left").drop("_l")


def latest_actions(journal: DataFrame, since, prefix: str) -> DataFrame:
    """Newest run per (workflow, start action, end action) of the workflows with a name prefix."""
    rows = journal.where((F.col("start_ts") > _ts(since)) & F.col("workflow").startswith(prefix))
    return newest_per_key(rows, ["workflow", "start_action", "end_action"], ["start_ts"])


# --- data that stopped moving ----------------------------------------------------------------


def repeated_key_dates(journal: DataFrame, since, as_of) -> DataFrame:
    """Objects whose newest key date has been loaded on several days.

    ``journal``: object, ts, key_date, rows_count.  One row per (object, load day) keeps the newest key date;
    per object and key date the load days after the last day of the previous key date are counted.  ``rows_counts``
    lists the different row counts of these days as text, thousands apart, in text order."""
    rows = journal.where(F.col("ts") > _ts(since)).select("object", "ts", F.to_date("ts").alias("day"), "key_date", "rows_count")
    daily = newest_per_key(rows, ["object", "day"], ["key_date", "ts"])
    return _repeats(daily, "key_date", "day", as_of, False, listed="rows_count")


def repeated_row_counts(journal: DataFrame, since, as_of) -> DataFrame:
    """The same on row counts per key date; only when longer than the usual spacing."""
    rows = journal.where((F.col("ts") > _ts(since)) & F.col("key_date").isNotNull()).select("object", "ts", F.col("key_date").alias("day"), "rows_count")
    daily = newest_per_key(rows, ["object", "day"], ["ts"])
    return _repeats(daily, "rows_count", "day", as_of, True)


def _repeats(daily: DataFrame, value: str, day: str, as_of, only_longer: bool, listed: str | None = None) -> DataFrame:
    # One row per object and day: the windows below hold the days of one object.
    texts = []
    if listed:
        spaced = F.translate(F.format_number(F.col(listed).cast("bigint"), 0), ",", " ")
        texts = [F.array_join(F.array_sort(F.collect_set(spaced)), "; ").alias(f"{listed}s")]
    groups = daily.groupBy("object", value).agg(
        F.sort_array(F.collect_list(day), asc=False).alias("keys"),
        F.min(day).alias("_min"),
        F.max(day).alias("_max"),
        F.max("ts").alias("ts"),
        F.count(F.lit(1)).alias("_rows"),
        *texts,
    )
    by_object = Window.partitionBy("object")
    order = by_object.orderBy(F.col("_max").desc())
    marked = groups.select(
        "*",
        F.row_number().over(order).alias("_rn"),
        F.lead("_max").over(order).alias("_next"),
        F.sum("_rows").over(by_object).alias("cnt"),
        F.max(F.size("keys")).over(by_object).alias("max_days"),
        F.count(value).over(by_object).alias("cnt_uniq"),
    )
    since = F.date_sub(F.to_date(_ts(as_of) - F.make_interval(hours=F.lit(6))), 1)
    newest = marked.where((F.size("keys") > 1) & (F.col("_rn") == 1) & (F.col("ts") >= since))
    fresh = F.filter("keys", lambda k: k > F.coalesce(F.col("_next"), F.date_sub("_min", 1)))
    counted = newest.withColumns({"days": F.size(fresh), "key_from": F.array_min(fresh)}).where("days > 1 and cnt_uniq > 1")
    usual = (F.col("cnt") - F.col("days")) / (F.col("cnt_uniq") - 1)
    if only_longer:
        counted = counted.where(F.col("days") > usual)
    return counted.select(
        "object", value, "ts", F.col("_max").alias("last_day"), "key_from", "days", "cnt", "cnt_uniq",
        (F.col("cnt") - F.col("cnt_uniq")).alias("not_uniq"), F.round(usual, 1).alias("avg_uniq"), "max_days",
        F.round(F.col("days") * (F.col("cnt_uniq") - 1) / F.nullif(F.col("cnt") - F.col("days"), F.lit(0)), 1).alias("ratio"),
        *([f"{listed}s"] if listed else []),
    )


# --- verdict lists ---------------------------------------------------------------------------


def latest_failures(view: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Objects whose newest verdict failed within the last hours."""
    last = newest_per_key(view, ["object"], ["ts"])
    young = F.unix_timestamp(_ts(as_of)) - F.unix_timestamp("ts") <= hours * 3600
    return last.where(~F.col("ztest_ok") & young)


def failure_details(view: DataFrame, since, objects: int | None = None, points: int | None = None) -> DataFrame:
    """The failed objects, the most recent first (``n``), each with its points, the newest first (``nn``).

    ``objects`` and ``points`` limit the report when they are given."""
    failed = view.where(~F.col("ztest_ok") & (F.col("ts") >= _ts(since)))
    head = failed.groupBy(F.col("object").alias("_o")).agg(F.max("ts").alias("last"))
    if objects is not None:
        head = head.orderBy(F.col("last").desc(), "_o").limit(objects)
    # One row per failed object: a count of those before it, by a join of days and a window within each day.
    head = head.withColumn("_day", F.to_date("last"))
    later = Window.orderBy(F.col("_day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    days = head.groupBy("_day").agg(F.count(F.lit(1)).alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(later), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("_day").orderBy(F.col("last").desc(), "_o"))
    head = head.withColumn("_in", within).join(days.drop("_k"), "_day").withColumn("n", (F.col("_before") + F.col("_in")).cast("int"))
    rows = view.join(head.drop("_day", "_in", "_before"), F.col("object") == F.col("_o")).drop("_o")
    nth = F.dense_rank().over(Window.partitionBy("object").orderBy(F.col("ts").desc()))
    rows = rows.withColumn("nn", nth)
    return rows if points is None else rows.where(F.col("nn") <= points)
