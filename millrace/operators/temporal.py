"""Validity-dated hierarchies, interval joins and calendars."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from millrace.functions.lineage import cut_lineage, new_folder, store_rows
from millrace.functions.ordered import previous_row

LEVELS = 16  # fixed value: level columns of the flat table
OPEN_END = dt.date(9999, 12, 31)  # fixed value
HIRE, LEAVE = ("S1", "S3"), ("S2", "S4")  # fixed values: action codes
REHIRE, AGAIN = "S4", "S3"  # fixed values: a rehire counts as leaving the day before and starting again


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """SQL OVERLAPS of two periods: half-open, equal starts always overlap."""
    return F.when(s1 == s2, F.lit(True)).otherwise((s1 < e2) & (s2 < e1))


# --- hierarchies ---------------------------------------------------------------------------


def tree_paths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Every path below the roots with the days on which all of its edges are valid.

    ``edges``: child, parent, date_start, date_finish.  ``roots``: one column ``root``.  Output:
    org_id, parent_org_id, lvl, date_start, date_finish (of the last edge), valid_from, valid_to (of the
    whole path), lvl_0_org_id and ``path``, one (id, s, e) struct per level.

    Chains of edges are doubled: those of 2^k edges are joined with themselves, and below those that end at a root, so a
    tree of depth n takes about log2(n) rounds, once for all days.  Each round is a reliable checkpoint, computed once and
    safe from a lost executor.  An edge must overlap its parent edge; a node that occurs on its own path is not followed,
    so a cycle ends; paths without limit of length.
    """
    link = F.struct(F.col("child").alias("id"), F.col("date_start").alias("s"), F.col("date_finish").alias("e"))
    open_ = cut_lineage(
        edges.select(
            F.col("child").alias("org_id"), F.col("parent").alias("parent_org_id"), "date_start", "date_finish",
            F.col("date_start").alias("valid_from"), F.col("date_finish").alias("valid_to"),
            F.col("parent").alias("_top"), F.array(link).alias("path"),
        )
    )
    wanted = roots.select(F.col("root").alias("_root")).distinct()
    done = [open_.join(wanted, F.col("_top") == F.col("_root"), "left_semi")]
    while True:
        rooted = _chained(open_, reduce(DataFrame.unionByName, done)).where(~F.exists("path", lambda x: x["id"] == F.col("_top")) | _root_loop())
        longer = cut_lineage(_chained(open_, open_))
        done.append(cut_lineage(rooted))
        if longer.isEmpty():
            break
        open_ = longer
    every = reduce(DataFrame.unionByName, done)
    return every.select(
        "org_id", "parent_org_id", F.size("path").alias("lvl"), "date_start", "date_finish", "valid_from", "valid_to",
        F.col("_top").alias("lvl_0_org_id"), "path",
    )


def _root_loop() -> Column:
    """The root is on the path only as its first node, by an edge to itself."""
    return (F.get("path", F.lit(0)).getField("id") == F.col("_top")) & (F.size(F.filter("path", lambda x: x["id"] == F.col("_top"))) == 1)


def _chained(lower: DataFrame, upper: DataFrame) -> DataFrame:
    """Every ``lower`` chain hung on the ``upper`` ones that end at the node it starts from."""
    above = upper.select(
        F.col("org_id").alias("_node"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), F.col("_top").alias("_above"),
        F.col("date_start").alias("_s"), F.col("date_finish").alias("_e"), F.col("path").alias("_path"),
    )
    head = F.get("path", F.lit(0))

    def ids(path):
        return F.transform(path, lambda x: x["id"])

    fits = (
        (F.col("_top") == F.col("_node"))
        & overlaps(F.col("_s"), F.col("_e"), head.getField("s"), head.getField("e"))
        & (F.greatest("valid_from", "_from") <= F.least("valid_to", "_to"))
        & ~F.arrays_overlap(ids("_path"), ids("path"))
    )
    return lower.join(above, fits).select(
        "org_id", "parent_org_id", "date_start", "date_finish",
        F.greatest("valid_from", "_from").alias("valid_from"), F.least("valid_to", "_to").alias("valid_to"),
        F.col("_above").alias("_top"), F.concat("_path", "path").alias("path"),
    )


def _days(first: dt.date, last: dt.date) -> Column:
    return F.sequence(F.greatest("valid_from", F.lit(first)), F.least("valid_to", F.lit(last)))


def _inside(paths: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return paths.where((F.col("valid_from") <= F.lit(last)) & (F.col("valid_to") >= F.lit(first)))


def daily_tree(paths: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """(day, node, parent, level, validity) for every day of the range."""
    return _inside(paths, first, last).select(
        F.explode(_days(first, last)).alias("cal_date"), "org_id", "parent_org_id", "lvl", "date_start", "date_finish"
    )


def flat_levels(paths: DataFrame, first: dt.date, last: dt.date, depth: int = LEVELS) -> DataFrame:
    """One row per day and path prefix with the node and validity of every level.

    A path with more than ``depth`` levels is an error: none is cut.  Equal paths have equal validity, so they are made distinct before the days are exploded."""
    columns = [
        F.get("path", F.lit(k - 1)).getField(part).alias(f"lvl_{k}_{name}")
        for k in range(1, depth + 1)
        for part, name in (("id", "org_id"), ("s", "date_start"), ("e", "date_end"))
    ]
    longest = _inside(paths, first, last).agg(F.max(F.size("path"))).first()[0] or 0
    if longest > depth:
        raise ValueError(f"paths have {longest} levels, the table only {depth}")
    distinct = _inside(paths, first, last).select("lvl_0_org_id", "path", "valid_from", "valid_to").distinct()
    last_node = F.element_at("path", -1).getField("id")
    return distinct.select(
        F.explode(_days(first, last)).alias("cal_date"),
        last_node.alias("org_id"),
        F.size("path").alias("org_id_lvl"),
        "lvl_0_org_id",
        *columns,
    )


def published_levels(flat: DataFrame, load_date: dt.date) -> DataFrame:
    """Level numbers shifted by one (the root becomes level 1, without validity), with a load date."""
    depth = sum(c.endswith("_date_start") for c in flat.columns)
    columns = [F.col("lvl_0_org_id").alias("lvl_1_org_id")]
    for k in range(1, depth + 1):
        for part in ("org_id", "date_start", "date_end"):
            columns.append(F.col(f"lvl_{k}_{part}").alias(f"lvl_{k + 1}_{part}"))
    return flat.select(F.lit(load_date).alias("load_date"), "cal_date", "org_id", "org_id_lvl", *columns)


def replace_year(published: DataFrame, rebuilt: DataFrame, year: int) -> DataFrame:
    """Published table with one calendar year taken from ``rebuilt``."""
    kept = published.where(F.year("cal_date") != year)
    return kept.unionByName(rebuilt.where(F.year("cal_date") == year))


# --- interval joins ------------------------------------------------------------------------


def interval_join(
    rows: DataFrame,
    periods: DataFrame,
    keys: Mapping[str, str],
    day: Column,
    start: str,
    end: str,
    span: tuple[Column, Column],
    how: str = "left",
) -> DataFrame:
    """Join rows to the periods of their key that contain ``day``.

    ``span`` (``day_span``) bounds the days of ``rows``.  Periods are clipped to it and cut by calendar year, and
    the year joins the key: a key with very many rows and very many periods is spread over its years
    and compares a row only with the periods of that year (at most one per day where they do not overlap).
    """
    low, high = span
    cut = periods.where((F.col(start) <= high) & (F.col(end) >= low)).withColumn(
        "_year",
        F.explode(F.sequence(F.year(F.greatest(F.col(start), low)), F.year(F.least(F.col(end), high)))),
    )
    condition = (F.col("_day_year") == F.col("_year")) & F.col("_day").between(F.col(start), F.col(end))
    for mine, theirs in keys.items():
        condition = condition & (F.col(mine) == F.col(theirs))
    dated = rows.withColumn("_day", day).withColumn("_day_year", F.year("_day"))
    return dated.join(cut, condition, how).drop("_day", "_day_year", "_year")


def day_span(rows: DataFrame, day: str, back: int = 0) -> tuple[Column, Column]:
    """First (minus ``back`` days) and last day of ``rows``; reads one column, two dates reach the driver."""
    low, high = rows.agg(F.min(day).cast("date"), F.max(day).cast("date")).first()
    if low is None:
        low = high = OPEN_END
    return F.lit(low - dt.timedelta(days=back)), F.lit(high)


@dataclass(frozen=True)
class Timeline:
    """Periods ``start`` to ``end`` (dates, both included) of ``keys``, with the values to take {new name: column}.

    ``exclusive`` states whether the periods of a key have no day in common; None leaves it to ``exclusive_periods``.
    """

    frame: DataFrame
    keys: Sequence[str]
    take: Mapping[str, str]
    start: str
    end: str
    exclusive: bool | None = None


def exclusive_periods(sides: Sequence[Timeline]) -> list[bool]:
    """For each side: whether no day of a key lies in two of its periods; sides that are not dated by dates give False.

    One job for all sides that do not state it.  Periods are reduced to one row per (key, start), so a window holds at most one row per
    day of a key; one row per side reaches the driver.
    """
    dated = [isinstance(s.frame.schema[c].dataType, DateType) for s in sides for c in (s.start, s.end)]
    usable = [i for i, s in enumerate(sides) if s.exclusive is not False and dated[2 * i] and dated[2 * i + 1]]
    faults = []
    for i in (i for i in usable if sides[i].exclusive is None):
        side, own = sides[i], [f"_k{j}" for j in range(len(sides[i].keys))]
        periods = _periods(side, own).select(*own, "_at", F.col(side.end).alias("_to"))
        starts = periods.groupBy(*own, "_at").agg(F.max("_to").alias("_to"), F.count(F.lit(1)).alias("_n"))
        earlier = F.lag("_to").over(Window.partitionBy(*own).orderBy("_at"))
        fault = starts.select(((F.col("_n") > 1) | F.coalesce(earlier >= F.col("_at"), F.lit(False))).alias("_fault"))
        faults.append(fault.agg(F.lit(i).alias("_side"), F.coalesce(F.max("_fault"), F.lit(False)).alias("_fault")))
    found = {r["_side"] for r in reduce(DataFrame.unionByName, faults).where("_fault").collect()} if faults else set()
    return [i in usable and i not in found for i in range(len(sides))]


def _periods(side: Timeline, own: Sequence[str]) -> DataFrame:
    """The periods of a side that can hold a day of a key, with the key columns named ``own`` and the start ``_at``."""
    named = {n: F.col(k) for n, k in zip(own, side.keys)}
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in side.keys])
    return side.frame.where(known & (F.col(side.start) <= F.col(side.end))).withColumns({**named, "_at": F.col(side.start)})


def values_on_days(asks: DataFrame, keys: Sequence[str], day: str, sides: Sequence[Timeline]) -> DataFrame:
    """One row per distinct (``keys``, ``day``) of ``asks``: what every side holds for the key on that day, NULL if nothing.

    The sides have no overlaps (``exclusive_periods``).  Asked days and period starts of all sides are put in one
    order per key and the newest period is carried forward, so they are shuffled once whatever their number.  A key
    holds at most one row per day and side here, however many rows ask.  NULL keys and days are left out.
    """
    own = [f"_k{j}" for j in range(len(keys))]
    asked = asks.select(*[F.col(k).alias(n) for k, n in zip(keys, own)], F.col(day).cast("date").alias("_at"))
    merged = asked.na.drop().distinct().withColumn("_asked", F.lit(True))
    for i, side in enumerate(sides):
        values = [F.col(c).alias(f"v{j}") for j, c in enumerate(side.take.values())]
        period = F.struct(F.col(side.end).alias("to"), *values).alias(f"_p{i}")
        merged = merged.unionByName(_periods(side, own).select(*own, "_at", period), allowMissingColumns=True)
    # A period that starts on the asked day is a peer of the asking row, so it counts.
    until = Window.partitionBy(*own).orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    newest = {f"_p{i}": F.last(f"_p{i}", ignorenulls=True).over(until) for i in range(len(sides))}
    found = merged.withColumns(newest).where("_asked")
    return found.select(
        *[F.col(n).alias(k) for n, k in zip(own, keys)],
        F.col("_at").alias(day),
        *[
            F.when(F.col("_at") <= F.col(f"_p{i}")["to"], F.col(f"_p{i}")[f"v{j}"]).alias(name)
            for i, side in enumerate(sides)
            for j, name in enumerate(side.take)
        ],
    )


def timeline_join(
    rows: DataFrame, keys: Sequence[str], day: str, sides: Sequence[Timeline], asks: DataFrame | None = None
) -> DataFrame:
    """Left join of ``rows`` to sides without overlaps: the rows are shuffled once, by (``keys``, ``day``), for all sides.

    ``asks``: a frame with the same keys and days that is cheaper to read, the rows themselves by default.
    """
    answers = values_on_days(rows if asks is None else asks, keys, day, sides)
    return _add_answers(rows, answers, dict(zip(keys, keys)), day, day, {n: n for s in sides for n in s.take})


def _add_answers(
    rows: DataFrame, answers: DataFrame, keys: Mapping[str, str], day: str, answer_day: str, names: Mapping[str, str]
) -> DataFrame:
    own = {theirs: f"_a{j}" for j, theirs in enumerate(keys.values())}
    side = answers.select(
        *[F.col(c).alias(n) for c, n in own.items()], F.col(answer_day).alias("_aday"), *[F.col(c).alias(n) for c, n in names.items()]
    )
    match = F.col(day).cast("date") == F.col("_aday")
    for mine, theirs in keys.items():
        match = match & (F.col(mine) == F.col(own[theirs]))
    return rows.join(side, match, "left").drop("_aday", *own.values())


@dataclass(frozen=True)
class RelationKinds:
    """Relation codes of the edge list."""

    person_position: str = "A008"
    position_job: str = "B007"
    position_reference: str = "BZ71"


def movement_detail(
    movements: DataFrame,
    edges: DataFrame,
    permanent: DataFrame,
    kinds: RelationKinds | None = None,
    exclusive: bool | None = None,
) -> DataFrame:
    """Position, job and reference position on the day of each movement and the day before.

    ``movements``: i_pernr, action_date, action_type, action_reason, org_id.  ``edges``: id_object,
    id_connection_object, connection_type, date_start, date_finish.  ``permanent``: code_movement_type,
    movement_motive, permanent_movement.  An old value equal to the current one is NULL.
    ``exclusive`` states whether an object has at most one relation of a kind on a day; None has it checked.
    """
    kinds = kinds or RelationKinds()

    def history(kind: str, name: str, key: str, value: str) -> Timeline:
        return Timeline(edges.where(F.col("connection_type") == kind), [key], {name: value}, "date_start", "date_finish", exclusive)

    position = history(kinds.person_position, "pp_value", "id_connection_object", "id_object")
    job = history(kinds.position_job, "pj_value", "id_object", "id_connection_object")
    reference = history(kinds.position_reference, "pe_value", "id_object", "id_connection_object")
    alone = exclusive_periods([position, job, reference])

    # All values depend on person and day alone, so they are looked up once per person and day.
    now = F.col("action_date").cast("date")
    days = movements.select(F.col("i_pernr").alias("_person"), now.alias("_now"), F.date_sub(now, 1).alias("_before")).distinct()
    span = None if all(alone) else day_span(movements, "action_date", back=1)
    days = store_rows(_on_both_days(days, "_person", "_person", [position], alone[:1], span), new_folder(days.sparkSession))
    days = _on_both_days(days, "pp_value", "oldpp_value", [job, reference], alone[1:], span)

    tie = ["action_date", "action_type", "action_reason", "org_id"]
    rows = previous_row(movements, ["i_pernr"], tie, {"_previous_org": "org_id"}, F.col("action_date"))
    flags = permanent.select(
        F.col("code_movement_type").alias("_code"), F.col("movement_motive").alias("_motive"), "permanent_movement"
    )
    rows = rows.join(flags, (F.col("action_type") == F.col("_code")) & (F.col("action_reason") == F.col("_motive")), "left")
    rows = rows.join(days, (F.col("i_pernr") == F.col("_person")) & (now == F.col("_now")), "left")

    def old(name):
        return F.nullif(F.col(f"old{name}_value"), F.col(f"{name}_value"))

    return rows.select(
        F.col("action_date").alias("cal_date"),
        "i_pernr",
        F.col("action_type").alias("code_movement_type"),
        F.col("action_reason").alias("movement_motiv"),
        F.coalesce("permanent_movement", F.lit(0)).alias("permanent_movement"),
        F.col("pp_value").alias("pos_id"),
        old("pp").alias("old_pos_id"),
        F.col("pj_value").alias("job_code"),
        old("pj").alias("old_job_code"),
        F.col("pe_value").alias("et_pos_id"),
        old("pe").alias("old_et_pos_id"),
        "org_id",
        F.nullif(F.col("_previous_org"), F.col("org_id")).alias("old_org_id"),
    )


def _on_both_days(
    days: DataFrame,
    key: str,
    old_key: str,
    sides: Sequence[Timeline],
    exclusive: Sequence[bool],
    span: tuple[Column, Column] | None,
) -> DataFrame:
    """Add the values of ``sides`` for (``key``, _now), and for (``old_key``, _before) under names that start with old."""
    merged = [s for s, alone in zip(sides, exclusive) if alone]
    asked = (("", key, "_now"), ("old", old_key, "_before"))
    out = days
    if merged:
        both = F.array(*[F.struct(F.col(k).alias("_key"), F.col(d).alias("_day")) for _, k, d in asked])
        answers = values_on_days(days.select(F.inline(both)), ["_key"], "_day", merged)
        for prefix, k, d in asked:
            names = {n: f"{prefix}{n}" for s in merged for n in s.take}
            out = _add_answers(out, answers, {k: "_key"}, d, "_day", names)
    for side in (s for s, alone in zip(sides, exclusive) if not alone):
        for prefix, k, d in asked:
            values = [F.col(c).alias(f"{prefix}{n}") for n, c in side.take.items()]
            periods = side.frame.select(
                F.col(side.keys[0]).alias("_pkey"), F.col(side.start).alias("_pfrom"), F.col(side.end).alias("_pto"), *values
            )
            out = interval_join(out, periods, {k: "_pkey"}, F.col(d), "_pfrom", "_pto", span).drop("_pkey", "_pfrom", "_pto")
    return out


def events_to_intervals(
    movements: DataFrame,
    key: str,
    day: str,
    action: str,
    hire: Sequence[str] = HIRE,
    leave: Sequence[str] = LEAVE,
    rehire: str = REHIRE,
    again: str = AGAIN,
) -> DataFrame:
    """Hire and leave actions to (key, date_start, date_finish).

    A rehire ends the day before and starts a synthetic hire on its own day.  In date order the n-th
    action belongs to pair n (a leave) or n + 1 (a hire); pair 1 has no start and is dropped; an open
    pair ends on 9999-12-31.
    """
    on, what = F.col(day).cast("date"), F.col(action)

    def act(d, a):
        return F.struct(d.alias("_d"), a.alias("_a"))

    split = F.array(act(F.date_sub(on, 1), what), act(on, F.lit(again)))
    base = movements.select(key, F.inline(F.when(what == rehire, split).otherwise(F.array(act(on, what)))))
    # Equal actions of one day are counted together and spread again: the order is total, and the
    # window holds a few rows per day of a key, however many rows the key has.
    every = base.groupBy(key, "_d", "_a").agg(F.count(F.lit(1)).alias("_n"))
    ranked = every.withColumn("_upto", F.sum("_n").over(Window.partitionBy(key).orderBy("_d", "_a")))
    each = ranked.withColumn("_i", F.explode(F.sequence(F.col("_upto") - F.col("_n") + 1, F.col("_upto"))))
    pair = F.when(F.col("_a").isin(*hire), F.col("_i") + 1).when(F.col("_a").isin(*leave), F.col("_i"))
    grouped = each.withColumn("_pair", pair).where("_pair <> 1").groupBy(key, "_pair").agg(
        F.min("_d").alias("date_start"), F.max("_d").alias("_last"), F.count(F.lit(1)).alias("_rows")
    )
    finish = F.when(F.col("_rows") == 2, F.col("_last")).otherwise(F.lit(OPEN_END))
    return grouped.select(key, "date_start", finish.alias("date_finish")).distinct()


@dataclass(frozen=True)
class Dictionary:
    """A validity-dated (or plain) dictionary: join keys {row column: dictionary column} and the
    columns to add {new name: dictionary column}."""

    frame: DataFrame
    keys: Mapping[str, str]
    take: Mapping[str, str]
    start: str | None = None
    end: str | None = None
    exclusive: bool | None = None  # as in Timeline


def enrich_intervals(
    intervals: DataFrame, reports: DataFrame, key: str, report_day: str, dictionaries: Sequence[Dictionary]
) -> DataFrame:
    """Report rows that fall inside an interval of their key, with the dictionary values of the day.

    Dated dictionaries without overlaps that follow each other with the same key share one timeline; those with
    overlaps give a row per period that holds the day.
    """
    span = day_span(reports, report_day)
    periods = intervals.select(F.col(key).alias("_ikey"), "date_start", "date_finish")
    rows = interval_join(reports, periods, {key: "_ikey"}, F.col(report_day), "date_start", "date_finish", span, "inner")
    rows = rows.drop("_ikey")
    dated = [d for d in dictionaries if d.start]
    lines = [Timeline(d.frame, list(d.keys.values()), d.take, d.start, d.end, d.exclusive) for d in dated]
    alone = {id(d): line for d, line, ok in zip(dated, lines, exclusive_periods(lines)) if ok}
    for keys, group in groupby(dictionaries, lambda d: tuple(d.keys) if id(d) in alone else None):
        if keys:
            asks = reports if set(keys) <= set(reports.columns) else None
            rows = timeline_join(rows, keys, report_day, [alone[id(d)] for d in group], asks)
            continue
        for d in group:
            rows = _add_dictionary(rows, d, report_day, span)
    return rows


def _add_dictionary(rows: DataFrame, d: Dictionary, report_day: str, span: tuple[Column, Column]) -> DataFrame:
    names = {mine: f"_k{j}" for j, mine in enumerate(d.keys)}
    columns = [F.col(theirs).alias(names[mine]) for mine, theirs in d.keys.items()]
    columns += [F.col(source).alias(new) for new, source in d.take.items()]
    if d.start:
        side = d.frame.select(*columns, F.col(d.start).alias("_from"), F.col(d.end).alias("_to"))
        joined = interval_join(rows, side, names, F.col(report_day), "_from", "_to", span).drop("_from", "_to")
    else:
        match = reduce(lambda a, b: a & b, [F.col(mine) == F.col(n) for mine, n in names.items()])
        joined = rows.join(d.frame.select(*columns), match, "left")
    return joined.drop(*names.values())


# --- calendars -----------------------------------------------------------------------------

_STEPS = {"day": "interval 1 day", "month": "interval 1 month", "10 minutes": "interval 10 minutes"}


def calendar(rows: DataFrame, column: str, step: str = "day") -> DataFrame:
    """Every day, month start or ten-minute slot between the first and the last value of a column."""
    first, last = F.min(column), F.max(column)
    if step == "10 minutes":
        low, high = (F.timestamp_seconds(F.floor(F.unix_timestamp(x) / 600) * 600) for x in (first, last))
    elif step == "month":
        low, high = F.trunc(first, "MM"), F.trunc(last, "MM")
    else:
        low, high = first.cast("date"), last.cast("date")
    return rows.agg(F.sequence(low, high, F.expr(_STEPS[step])).alias("_all")).select(F.explode("_all").alias("slot"))
