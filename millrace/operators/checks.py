"""Profiling, uniqueness, change detection and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import keep_matching, newest_per_key, row_hash
from millrace.functions.lineage import cut_lineage, new_folder, store_rows
from millrace.functions.ordered import quantile_chunk, running
from millrace.functions.parsing import extract, is_json, safe_cast

FAR_PAST, FAR_FUTURE = "2000-01-01", "9999-12-31"  # fixed values: open ends of a mapping
KEY_DATE, LOAD_DATE, PERIOD_DATE = "actual_date", "load_date", "report_date"  # fixed column names
# Fixed pattern after the prefix: source, date, time, part number, number of parts, row count.
ARCHIVE_TAIL = r"([\w|\d]+)_\d{8}_\d{6}_(\d+)_(\d+)_(\d+)\.csv\.zip$"


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column, unpivoted; empty and one-blank texts count as null.  One scan."""
    counts = []
    for f in df.schema.fields:
        value = F.col(f.name)
        missing = value.isNull()
        if isinstance(f.dataType, T.StringType):
            missing = missing | value.isin("", " ")
        counts.append(F.count_if(missing).alias(f.name))
    wide = df.agg(*counts)
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_cnt")) for c in df.columns]))
    return wide.select(pairs)


# --- temporal uniqueness -------------------------------------------------------------------


def overlapping_keys(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Keys with two intervals (closed ends) that share a day.

    A key has such a pair exactly when two intervals start together, or some interval starts at or before
    the largest end of those that start earlier.  Intervals are first reduced to one row per (key,
    start), so the window holds at most one row per start date, however many rows a key has.
    """
    starts = df.where(F.col(start) <= F.col(end)).groupBy(*keys, F.col(start).alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.max(end).alias("_e")
    )
    earlier = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    swept = starts.withColumn("_reach", F.max("_e").over(earlier))
    return swept.where((F.col("_n") > 1) | (F.col("_s") <= F.col("_reach"))).select(*keys).distinct()


def temporal_duplicates(
    df: DataFrame, keys: Sequence[str], start: str, end: str, top: int | None = None
) -> DataFrame:
    """Offending keys with cnt = rows valid, summed over the boundary dates on which the key has more than one.

    Only the offending keys enter the sweep: +1 at a start, -1 after an end, added up per (key, date) and
    then along the dates of the key (one row per date).  The boundary dates inside a segment are the
    difference of two date ranks, so dates never meet rows.
    """
    # Few keys offend; they are stored once because the sweep reads them several times.
    offenders = cut_lineage(overlapping_keys(df, keys, start, end))
    bad = keep_matching(df.where(F.col(start) <= F.col(end)), offenders, keys)
    edges = F.array(
        F.struct(F.col(start).cast("date").alias("_d"), F.lit(1).alias("_step")),
        F.struct(F.date_add(F.col(end), 1).alias("_d"), F.lit(-1).alias("_step")),
    )
    steps = bad.select(*keys, F.inline(edges)).groupBy(*keys, "_d").agg(F.sum("_step").alias("_step"))
    along = Window.partitionBy(*keys).orderBy("_d")
    segments = steps.select(
        *keys, "_d", F.sum("_step").over(along).alias("_level"), F.lead("_d").over(along).alias("_next")
    ).where("_level > 1 and _next is not null")
    ranks = cut_lineage(_boundary_ranks(df, start, end))
    low = ranks.select(F.col("_p").alias("_d"), F.col("_r").alias("_lo"))
    high = ranks.select(F.col("_p").alias("_next"), F.col("_r").alias("_hi"))
    counted = segments.join(low, "_d").join(high, "_next").where("_hi > _lo")
    total = F.sum(F.col("_level") * (F.col("_hi") - F.col("_lo"))).cast("bigint")
    out = counted.groupBy(*keys).agg(total.alias("cnt"))
    return out.orderBy(F.col("cnt").desc(), *keys).limit(top) if top else out


def _boundary_ranks(df: DataFrame, start: str, end: str) -> DataFrame:
    """Per date: how many boundary dates lie before it.  One row per calendar day at most."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    marks = F.array(
        F.struct(first.alias("_p"), F.lit(1).alias("_is")),
        F.struct(last.alias("_p"), F.lit(1).alias("_is")),
        F.struct(F.date_add(last, 1).alias("_p"), F.lit(0).alias("_is")),
    )
    dates = df.select(F.inline(marks)).groupBy("_p").agg(F.max("_is").alias("_is")).where("_p is not null")
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # bounded by the calendar
    return dates.select("_p", F.coalesce(F.sum("_is").over(earlier), F.lit(0)).alias("_r"))


def uniqueness_verdict(duplicates: DataFrame) -> DataFrame:
    """Number of offending keys (all of them, not only the listed ones) and a message."""
    n = F.count(F.lit(1))
    return duplicates.agg(
        n.alias("err"),
        F.when(n > 0, F.concat(F.lit("Uniq check errors = "), n.cast("string"))).otherwise("Uniq Ok").alias("msg"),
    )


def mapping_duplicates(df: DataFrame, key: str, start: str, end: str, as_of) -> DataFrame:
    """Mapping keys with more than one row valid on a boundary date; open ends are defaulted."""
    bounded = df.select(
        key,
        F.coalesce(start, F.lit(FAR_PAST).cast("date")).alias("_s"),
        F.coalesce(end, F.lit(as_of).cast("date")).alias("_e"),
    )
    return overlapping_keys(bounded, [key], "_s", "_e")


# --- change detection and statistics -------------------------------------------------------


def fingerprint(df: DataFrame, period: str | None = None, load: str | None = None, key: str | None = None) -> DataFrame:
    """Order-free content hash, row count and min/max of the period, load and key dates; one pass.

    The date columns are found by name when not given.  Row hashes are combined by xor and by sum, so equal rows do not
    cancel out; it is the hash that :func:`merged_fingerprint` makes from the parts of a table."""
    found = _date_columns(df, period, load, key)
    out = df.agg(*_content(df.columns), *_ranges(found))
    return out.select(_content_hash().alias("hash"), "cnt", *[f"{role}{side}" for role in found for side in ("min", "max")])


def partition_fingerprints(df: DataFrame, by: Sequence[str], load: str | None = None, key: str | None = None) -> DataFrame:
    """One row per partition (columns ``by``): ``cnt``, the xor ``x`` and sum ``s`` of row hashes, min/max of the dates found.

    The rows are small enough to be stored beside a table; they merge to its fingerprint and show which partitions changed.
    A partial aggregate runs before the shuffle, so a partition with a third of all rows sends one row per map task."""
    found = _date_columns(df, None, load, key)
    return df.groupBy(*by).agg(*_content(df.columns), *_ranges(found))


def merged_fingerprint(parts: DataFrame) -> DataFrame:
    """Fingerprint of the whole table from its partitions."""
    ranges = [F.min(c).alias(c) if c.endswith("min") else F.max(c).alias(c) for c in parts.columns if c in _RANGES]
    out = parts.agg(F.sum("cnt").alias("cnt"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"), *ranges)
    return out.select(_content_hash().alias("hash"), F.coalesce("cnt", F.lit(0)).alias("cnt"), *[c for c in out.columns if c in _RANGES])


def changed_partitions(current: DataFrame, accepted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partitions that differ between two tables of partition fingerprints: ``by``, ``change`` (new, gone, changed), both counts."""
    now = current.select(*by, F.struct("cnt", "x", "s").alias("_now"))
    old = accepted.select(*[F.col(c).alias(f"_{c}") for c in by], F.struct("cnt", "x", "s").alias("_old"))
    same_key = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    both = now.join(old, same_key, "full_outer").where(~F.col("_now").eqNullSafe(F.col("_old")))
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_now").isNull(), "gone").otherwise("changed")
    keys = [F.when(F.col("_now").isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in by]
    return both.select(*keys, change.alias("change"), F.col("_now.cnt").alias("cnt"), F.col("_old.cnt").alias("old_cnt"))


_ROLES = {"r": PERIOD_DATE, "l": LOAD_DATE, "k": KEY_DATE}
_RANGES = {f"{role}{side}" for role in _ROLES for side in ("min", "max")}


def _date_columns(df: DataFrame, *given: str | None) -> dict[str, str]:
    found = {}
    for (role, name), column in zip(_ROLES.items(), given, strict=True):
        column = column or (name if name in df.columns and _is_date(df, name) else None)
        if column:
            found[role] = column
    return found


def _content(columns: Sequence[str]) -> list[Column]:
    # 60 bits of the MD5 of the column texts: any engine, and a re-typed copy, gives the same value.
    h = F.conv(F.substring(row_hash(columns), 1, 15), 16, 10).cast("bigint")
    return [F.count(F.lit(1)).alias("cnt"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(1_000_000_007))).alias("s")]


def _content_hash() -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit(0)).cast("string") for c in ("x", "s", "cnt")]))


def _ranges(found: dict[str, str]) -> list[Column]:
    return [f(c).cast("string").alias(f"{role}{side}") for role, c in found.items() for side, f in (("min", F.min), ("max", F.max))]


def _is_date(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))


def custom_fingerprint(df: DataFrame, select: str) -> DataFrame:
    """Fingerprint given as a list of aggregate expressions."""
    return df.selectExpr(select) if "," not in select else df.agg(*[F.expr(e) for e in _split_list(select)])


def _split_list(text: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    return [*parts, text[start:]]


def change_status(current: DataFrame, accepted: DataFrame, expire, empty_ok: bool = False) -> DataFrame:
    """Compare a fingerprint row with the newest accepted one of the same object.

    ``current``: object, value (text), cnt.  ``accepted``: object, value, ts.
    res: 1 Ok (changed), 0 No new, -2 Expire (unchanged and last accepted before ``expire``), -1 Empty."""
    last = newest_per_key(accepted.select("object", "ts", "value"), ["object"], ["ts"]).select(
        F.col("object").alias("_o"), F.col("value").alias("_v"), F.col("ts").alias("last")
    )
    joined = current.join(last, F.col("object") == F.col("_o"), "left")
    empty = (F.coalesce("cnt", F.lit(0)) == 0) & F.lit(not empty_ok)
    same = F.col("value") == F.col("_v")
    fresh = F.col("last") >= F.lit(expire)
    return joined.select(
        "object",
        F.when(empty, -1).when(same & fresh, 0).when(same, -2).otherwise(1).alias("res"),
        F.when(empty, "Empty").when(same & fresh, "No new").when(same, "Expire").otherwise("Ok").alias("msg"),
        "last",
        "cnt",
    )


def load_statistics(
    df: DataFrame, name: str, period: str | None = None, load: str | None = None, key: str | None = None
) -> DataFrame:
    """Row count and min/max of the period, load and key columns in one pass."""
    aggs = [F.count(F.lit(1)).alias("rw_cnt")]
    for label, column in (("data", period), ("load", load), ("key", key)):
        source = F.col(column) if column else F.lit(None)
        kind = "string" if label == "key" else "timestamp"
        aggs += [F.min(source).cast(kind).alias(f"{label}_min"), F.max(source).cast(kind).alias(f"{label}_max")]
    return df.agg(*aggs).select(F.lit(name).alias("wf_obj"), "*")


# --- profiler ------------------------------------------------------------------------------

_CASTS = (
    ("cnt_bool", "boolean"),
    ("cnt_dt", "timestamp"),
    ("cnt_int", "bigint"),
    ("cnt_float", "double"),
    ("cnt_uuid", "uuid"),
)


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: distinct, null and total counts, frequencies, lengths, min/max as text,
    how many distinct values can be cast, and the inferred class.

    The frame is unpivoted to (column, value) and pre-aggregated, so a value that fills a
    third of a column costs one row per map task, and casts run once per distinct value.
    """
    columns = list(columns or df.columns)
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [
        F.struct(
            F.lit(i + 1).alias("fld_num"),
            F.lit(c).alias("fld_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("fld_type"),
            F.col(c).cast("string").alias("v"),
            (F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")).alias("d"),
        )
        for i, c in enumerate(columns)
    ]
    pairs = df.select(F.inline(F.array(*text)))
    per_value = pairs.groupBy("fld_num", "fld_name", "fld_type", "v").agg(F.count(F.lit(1)).alias("n"), F.first("d").alias("d"))
    v, length = F.col("v"), F.length("v")
    is_array = F.coalesce(F.from_json(_brackets(v), "array<string>"), F.from_json(v, "array<string>")).isNotNull()
    stats = per_value.groupBy("fld_num", "fld_name", "fld_type").agg(
        F.count(F.lit(1)).alias("dist_cnt"),
        F.coalesce(F.sum(F.when(v.isNull(), F.col("n"))), F.lit(0)).alias("null_cnt"),
        F.sum("n").alias("cnt"),
        F.min("n").alias("min_cnt"),
        F.max("n").alias("max_cnt"),
        F.round(F.avg("n")).cast("bigint").alias("avg_cnt"),
        F.min(length).alias("min_len"),
        F.round(F.avg(length)).cast("int").alias("avg_len"),
        F.round(F.stddev(length)).cast("int").alias("std_len"),
        F.max(length).alias("max_len"),
        F.min(F.octet_length(v)).alias("min_size"),
        F.round(F.avg(F.octet_length(v))).cast("int").alias("avg_size"),
        F.max(F.octet_length(v)).alias("max_size"),
        F.min("v").alias("_min_text"),
        F.max("v").alias("_max_text"),
        F.min_by("v", "d").alias("_min_num"),
        F.max_by("v", "d").alias("_max_num"),
        *[F.count(safe_cast("v", kind)).alias(name) for name, kind in _CASTS],
        F.count_if(is_array).alias("cnt_array"),
        F.count_if(F.coalesce(is_json(v), F.lit(False))).alias("cnt_json"),
    )
    full = stats.withColumns(
        {
            "is_not_null": F.col("null_cnt") == 0,
            "is_uniq": F.col("dist_cnt") == F.col("cnt"),
            "min": F.coalesce("_min_num", "_min_text"),
            "max": F.coalesce("_max_num", "_max_text"),
        }
    ).drop("_min_num", "_min_text", "_max_num", "_max_text")
    return full.withColumn("fld_stat", _inferred_class())


def _brackets(v: Column) -> Column:
    return F.translate(v, "{}", "[]")


def _inferred_class() -> Column:
    dist, filled = F.col("dist_cnt"), F.col("is_not_null")
    gap = F.when(filled, 0).otherwise(1)
    rules = [  # fixed values: names and order of the classes
        (F.col("null_cnt") == F.col("cnt"), "null"),
        (dist == F.col("cnt_bool") + gap, "bool"),
        ((dist == 1) & filled, "one"),
        ((dist == 2) & ~filled, "one + null"),
        ((dist == 2) & filled, "two"),
        ((dist == 3) & ~filled, "two + null"),
        (dist == F.col("cnt_dt") + gap, "datetime"),
        (dist == F.col("cnt_int") + gap, "int"),
        (dist == F.col("cnt_float") + gap, "float"),
        (dist == F.col("cnt_uuid") + gap, "uuid"),
        (dist == F.col("cnt_array") + gap, "array"),
        (dist == F.col("cnt_json") + gap, "json"),
    ]
    out = F.when(rules[0][0], rules[0][1])
    for condition, name in rules[1:]:
        out = out.when(condition, name)
    return out


# --- skew ----------------------------------------------------------------------------------


def skew_statistics(df: DataFrame, name: str, by: Sequence[str] | None = None) -> DataFrame:
    """Rows per distribution unit (key value, or Spark partition): count, sum, min, max, avg, deviation, skew."""
    unit = [F.col(c) for c in by] if by else [F.spark_partition_id().alias("_part")]
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns])
    per_unit = df.groupBy(*unit).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size"))
    avg, std = F.avg("n"), F.stddev("n")
    return per_unit.agg(
        F.lit(name).alias("tbl"),
        F.count(F.lit(1)).alias("segments"),
        F.sum("n").alias("sum"),
        F.min("n").alias("min"),
        F.max("n").alias("max"),
        F.round(avg).cast("bigint").alias("avg"),
        F.round(std).cast("bigint").alias("std"),
        F.round(F.round(std) / F.nullif(F.round(avg), F.lit(0.0)), 6).alias("skew"),
        F.round(1 - F.min("n") / avg, 6).alias("min_rate"),
        F.round(F.max("n") / avg - 1, 6).alias("max_rate"),
        F.sum("size").alias("data_size"),
    )


def stale_statistics(tables: DataFrame, log: DataFrame, as_of, days: int, limit: int | None = None) -> DataFrame:
    """Tables measured longer than ``days`` ago or never; never-measured first."""
    last = log.groupBy(F.col("tbl").alias("_t")).agg(F.max("ts").alias("last_ts"))
    old = F.col("last_ts").isNull() | (F.col("last_ts") < F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days)))
    out = tables.join(last, F.col("tbl") == F.col("_t"), "left").where(old).drop("_t")
    return out.orderBy(F.col("last_ts").asc_nulls_first(), "tbl").limit(limit) if limit else out


# --- reconciliation ------------------------------------------------------------------------


def archive_completeness(df: DataFrame, batch: str, exported: str, archive: str, prefix: str) -> DataFrame:
    """Per (batch, export time, source): all archive parts present, and rows loaded = rows announced.

    The file name is ``prefix`` followed by source, date, time, part number, number of parts and row count."""
    pattern = f"^{prefix}{ARCHIVE_TAIL}"
    per_file = df.groupBy(batch, exported, archive).agg(F.count(F.lit(1)).alias("cnt"))
    parsed = per_file.select(
        batch,
        exported,
        extract(archive, pattern, 1).alias("srs"),
        extract(archive, pattern, 2).cast("int").alias("arch_num"),
        extract(archive, pattern, 3).cast("int").alias("arch_cnt"),
        extract(archive, pattern, 4).cast("bigint").alias("row_cnt"),
        "cnt",
    )
    out = parsed.groupBy(batch, exported, "srs").agg(
        (F.countDistinct("arch_num") == F.max("arch_cnt")).alias("arch_ok"),
        F.max("arch_cnt").alias("arch_cnt"),
        (F.sum("cnt") == F.sum("row_cnt")).alias("cnt_ok"),
        F.sum("row_cnt").alias("row_cnt"),
    )
    return out.withColumn("ok", F.col("arch_ok") & F.col("cnt_ok"))


def archive_gate(completeness: DataFrame, batch: str, exported: str, either: bool = True) -> DataFrame:
    """The newest batch with a reject flag: either check failed, or (as recorded) both."""
    bad = ~F.col("arch_ok") | ~F.col("cnt_ok") if either else ~F.col("arch_ok") & ~F.col("cnt_ok")
    newest = completeness.orderBy(F.col(batch).desc(), F.col(exported).desc(), F.col("srs").desc()).limit(1)
    return newest.withColumn("rejected", bad)


def count_mismatches(loaded: DataFrame, day: str, expected: DataFrame, expected_day: str, expected_cnt: str) -> DataFrame:
    """Dates whose loaded row count differs from the announced one, and dates not loaded at all."""
    got = loaded.groupBy(F.col(day).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    want = expected.select(F.col(expected_day).alias("_w"), F.col(expected_cnt).alias("_c"))
    joined = got.join(want, F.col("_d") == F.col("_w"), "full_outer")
    differs = (F.col("_c") != F.col("_n")) | (F.col("_n").isNull() & F.col("_c").isNotNull())
    return joined.where(differs).select(
        F.coalesce("_w", "_d").alias("day"),
        F.coalesce("_c", F.lit(0)).alias("cnt"),
        F.coalesce("_n", F.lit(0)).alias("d_cnt"),
    )


@dataclass(frozen=True)
class DateRule:
    """Business-date rule: (date expression) (operation) (condition) over a table."""

    table: str
    date: str
    operation: str
    condition: str
    where: str = "true"


def business_dates(tables: dict[str, DataFrame], rules: Sequence[DateRule]) -> DataFrame:
    """One row per rule: result, table, date, operation and condition."""
    frames = []
    for r in rules:
        rows = tables[r.table].where(r.where).agg(F.expr(r.date).alias("bdate"))
        frames.append(
            rows.select(
                F.expr(f"bdate {r.operation} ({r.condition})").alias("res"),
                F.lit(r.table).alias("tbl"),
                "bdate",
                F.lit(f"{r.operation} {r.condition}").alias("msg"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def business_date_verdict(rows: DataFrame, last_min_date=None) -> DataFrame:
    """The worst row decides: -3 Error when a rule fails, 0 No new when the smallest date has not
    moved since the last accepted check, 1 Ok otherwise."""
    worst = rows.orderBy(F.col("res").asc_nulls_last(), F.col("bdate").asc_nulls_last(), "msg").limit(1)
    same = F.col("bdate") == F.lit(last_min_date).cast("date")
    return worst.select(
        F.when(~F.col("res"), -3).when(same, 0).otherwise(1).alias("res"),
        F.when(~F.col("res"), "Error").when(same, "No new").otherwise("Ok").alias("msg"),
        F.col("bdate").alias("min_bd"),
        F.col("msg").alias("rule"),
    )


def dangling_references(df: DataFrame, name: str, relations: Sequence[str], ident: Sequence[str] = ()) -> DataFrame:
    """Elements of the array columns ``relations`` that name no existing row, by relation kind."""
    known = df.select(F.col(name).alias("_known")).distinct()
    frames = [
        df.select(F.lit(r).alias("rel_type"), *ident, name, F.explode(r).alias("wf")).distinct() for r in relations
    ]
    every = reduce(DataFrame.unionByName, frames)
    return every.join(known, F.col("wf") == F.col("_known"), "left_anti")


def range_bucket_frequency(
    df: DataFrame, unit: Column, value: str, day: str, n: int = 40, digits: int = -2, buckets: int = 1024
) -> DataFrame:
    """Key-range buckets: ntile per distribution unit, then per bucket number min, max, rows and days
    with the next bucket's lower bound; bounds rounded to ``digits``.

    ntile(n) of the i-th of m rows follows from i and m, and i comes from counts of distinct values in chunks
    of about equal size, so a unit with very many rows is not sorted in one task.  The source is read once; the counts per day
    and per value are stored, and one join gives sizes and days of the tiles.
    """
    spark = df.sparkSession
    per_day = store_rows(
        df.where(F.col(value).isNotNull())
        .groupBy(unit.alias("_u"), F.col(value).cast("bigint").alias("_v"), F.col(day).alias("_day"))
        .agg(F.count(F.lit(1)).alias("_c")),
        new_folder(spark),
    )
    per_value = store_rows(per_day.groupBy("_u", "_v").agg(F.sum("_c").alias("_c")), new_folder(spark))
    ranked = running(per_value, ["_u"], ["_v"], {"_upto": ("sum", "_c")}, quantile_chunk(per_value, "_v", buckets))
    totals = per_value.groupBy(F.col("_u").alias("_tu")).agg(F.sum("_c").alias("_m"))
    joined = ranked.join(totals, F.col("_u").eqNullSafe(F.col("_tu")))
    first, last = F.col("_upto") - F.col("_c") + 1, F.col("_upto")
    spread = joined.withColumn("_n", F.explode(F.sequence(_tile(first, n), _tile(last, n))))
    inside = F.least(last, _tile_end(F.col("_n"), n)) - F.greatest(first, _tile_end(F.col("_n") - 1, n) + 1) + 1
    sized = spread.select("_u", "_v", "_n", inside.alias("_rows"))
    by_day = sized.join(per_day.select(F.col("_u").alias("_du"), F.col("_v").alias("_dv"), "_day", "_c"), F.col("_u").eqNullSafe(F.col("_du")) & (F.col("_v") == F.col("_dv")))
    # Of the days of a value only its first carries the value's rows, so they count once.
    once = F.row_number().over(Window.partitionBy("_u", "_v", "_n").orderBy("_day")) == 1
    of_day = by_day.withColumn("_rows", F.when(once, F.col("_rows"))).groupBy("_u", "_n", "_day").agg(
        F.min("_v").alias("min"), F.max("_v").alias("max"), F.sum("_rows").alias("cnt")
    )
    tiles = of_day.groupBy("_u", "_n").agg(F.min("min").alias("min"), F.max("max").alias("max"), F.sum("cnt").alias("cnt"), F.count("_day").alias("days"))
    merged = tiles.groupBy(F.col("_n").cast("int").alias("n")).agg(
        F.min("min").alias("min"), F.max("max").alias("_max"), F.sum("cnt").cast("bigint").alias("sum"), F.round(F.avg("days")).cast("bigint").alias("dt_cnt")
    )
    order = Window.orderBy("min")  # n rows
    bounded = merged.withColumn("max", F.coalesce(F.lead("min").over(order), F.max("_max").over(Window.partitionBy()) + 1))
    return bounded.select(
        "n", "min", "max", "sum", (F.col("max") - F.col("min")).alias("diff"), "dt_cnt",
        F.round(F.expr("sum div dt_cnt")).cast("bigint").alias("avg"),
        F.round("min", digits).cast("bigint").alias("rmin"), F.round("max", digits).cast("bigint").alias("rmax"),
        (F.round("max", digits) - F.round("min", digits)).cast("bigint").alias("rdiff"),
    )


def _tile(i: Column, n: int) -> Column:
    """ntile number of the i-th of ``_m`` rows: the first m % n tiles hold one row more."""
    small, extra = F.expr(f"_m div {n}"), F.col("_m") % n
    head = extra * (small + 1)
    return F.when(i <= head, F.ceil(i / (small + 1))).otherwise(extra + F.ceil((i - head) / F.greatest(small, F.lit(1)))).cast("bigint")


def _tile_end(k: Column, n: int) -> Column:
    small, extra = F.expr(f"_m div {n}"), F.col("_m") % n
    return k * small + F.least(k, extra)


def most_frequent_name(df: DataFrame, row_id: str, text: str, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Most frequent dictionary name in the code range named by a text such as ``... коды 10-12)``.

    '' when there is none, for NULL and for 'nan'.  A range without an end is its first code; a text without
    a dash is a code itself.  The dictionary is counted by name in blocks of 1, 2, 4, ... codes; each distinct range,
    cut to the codes of the dictionary, is made of at most two blocks of each width, so a range meets a name a few times
    however many codes it spans."""
    value = F.col(text)
    low_text = F.when(value.contains("-"), F.regexp_extract(value, _CODES, 1)).otherwise(F.trim(value))
    high_text = F.when(value.contains("-"), F.coalesce(F.nullif(F.regexp_extract(value, _CODES, 2), F.lit("")), low_text)).otherwise(low_text)
    ranges = df.select(row_id, text, low_text.try_cast("int").alias("_lo"), high_text.try_cast("int").alias("_hi"))
    counts = dictionary.groupBy(F.col(code).cast("int").alias("_dc"), F.col(name).alias("_name")).agg(F.count(F.lit(1)).alias("_n"))
    first, last = dictionary.agg(F.min(F.col(code).cast("int")), F.max(F.col(code).cast("int"))).first()
    first, last = (0, -1) if first is None else (first, last)
    # Codes count from the first of the dictionary; a range ends before _r.
    met = (F.col("_lo") <= F.col("_hi")) & (F.col("_hi") >= first) & (F.col("_lo") <= last)
    start, end = F.lit(first).cast("bigint"), F.lit(last).cast("bigint")
    cut = ranges.withColumns({"_l": F.when(met, F.greatest("_lo", start) - start), "_r": F.when(met, F.least("_hi", end) - start + 1)})
    # Texts repeat, so the dictionary is searched once per distinct range.
    wanted = cut.where("_l is not null").select("_l", "_r").distinct()
    widths = F.explode(F.sequence(F.lit(0), F.lit(max(0, last - first).bit_length()))).alias("_w")  # powers of two
    inner = wanted.select("_l", "_r", widths).selectExpr("_l", "_r", "_w", "shiftright(_l + shiftleft(1L, _w) - 1, _w) as _a", "shiftright(_r, _w) as _z").where("_a < _z")
    # Of the whole blocks a to z - 1 of a width, all but an odd first and an even last one belong to blocks of twice the width.
    ends = F.array(F.when(F.col("_a") % 2 == 1, F.col("_a")), F.when(F.col("_z") % 2 == 1, F.col("_z") - 1))
    pieces = inner.select("_l", "_r", "_w", F.explode(F.array_compact(ends)).alias("_b"))
    known = counts.where("_dc is not null").select((F.col("_dc") - start).alias("_place"), "_name", "_n", widths)
    blocks = known.groupBy(F.col("_w").alias("_bw"), F.expr("shiftright(_place, _w)").alias("_bb"), "_name").agg(F.sum("_n").alias("_n"))
    joined = pieces.join(blocks, (F.col("_b") == F.col("_bb")) & (F.col("_w") == F.col("_bw")))
    freq = joined.groupBy("_l", "_r", "_name").agg(F.sum("_n").alias("_n"))
    best = freq.groupBy(F.col("_l").alias("_bl"), F.col("_r").alias("_br")).agg(F.min_by("_name", F.struct(-F.col("_n"), F.col("_name"))).alias("_best"))
    found = cut.join(best, (F.col("_l") == F.col("_bl")) & (F.col("_r") == F.col("_br")), "left")
    return found.select(row_id, text, F.coalesce("_best", F.lit("")).alias("main_name"))


_CODES = r"коды\s*(\d+)\s*-\s*(\d*)"


def field_mapping(source: DataFrame, target: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Source-to-target comparison: one row per column pair with both types, whether they agree, and
    how many filled source values the target type cannot hold (NULL for a column without partner).

    The counts come from one scan of the source."""
    renames = renames or {}
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    pairs = [(f.name, f.dataType.simpleString(), renames.get(f.name, f.name)) for f in target.schema.fields]
    matched = {s for _, _, s in pairs}
    lost = {
        s: F.count_if(F.col(s).isNotNull() & F.col(s).try_cast(kind).isNull()).alias(f"_lost{i}")
        for i, (_, kind, s) in enumerate(pairs)
        if s in kinds
    }
    rows = [
        _mapping_row(name, kind, s if s in kinds else None, kinds.get(s), f"_lost{i}" if s in kinds else None)
        for i, (name, kind, s) in enumerate(pairs)
    ] + [_mapping_row(None, None, s, k, None) for s, k in kinds.items() if s not in matched]
    return source.agg(*lost.values()).select(F.inline(F.array(*rows)))


def _mapping_row(name, kind, source_name, source_kind, lost) -> Column:
    return F.struct(
        F.lit(name).cast("string").alias("column_name"),
        F.lit(kind).cast("string").alias("data_type"),
        F.lit(source_name).cast("string").alias("source_column_name"),
        F.lit(source_kind).cast("string").alias("source_data_type"),
        F.lit(kind is not None and kind == source_kind).alias("same_type"),
        (F.col(lost) if lost else F.lit(None).cast("bigint")).alias("lost_values"),
    )
