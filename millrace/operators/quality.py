"""Data-quality metrics: each returns a one-row frame (or one row per bin, date or rule)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.keys import newest_per_key
from millrace.functions.marks import on_days
from millrace.functions.ordered import preceding_counts, previous_row
from millrace.functions.periods import add_months, interval_start

ZERO_SHARE = 1e-4  # fixed value
DAY_ZERO = dt.date(2000, 1, 1)  # fixed value: date bounds count days from here
LAST_BOUND = 24.0  # fixed value: upper bound of the last bin
DATE_SANITY = (dt.date(1970, 1, 1), dt.date(2100, 1, 1))  # fixed values
MISSING_FRESHNESS = 9999  # fixed value
OPEN_END = dt.date(9999, 12, 31)  # fixed value


def _day(column: str) -> Column:
    return F.col(column).cast("date")


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def aggregate_drift(
    df: DataFrame, date_column: str, aggregate: str, day: dt.date, unit: str, quantity: int
) -> DataFrame:
    """(aggregate on the earlier date - aggregate on ``day``) / aggregate on ``day``; one scan.

    ``aggregate`` is any SQL aggregate.  Growth gives a negative value."""
    earlier = interval_start(day, unit, quantity)
    by_day = (
        df.where(on_days(F.col(date_column), [day, earlier]))
        .groupBy(_day(date_column).alias("_day"))
        .agg(F.expr(aggregate).cast("double").alias("_value"))
    )
    now = F.max(F.when(F.col("_day") == F.lit(day), F.col("_value")))
    then = F.max(F.when(F.col("_day") == F.lit(earlier), F.col("_value")))
    return by_day.agg(F.round((F.coalesce(then, F.lit(0.0)) - now) / F.nullif(now, F.lit(0.0)), 5).alias("pct"))


def grouped_drift(
    df: DataFrame, date_column: str, group: str, aggregate: str, day: dt.date, unit: str, quantity: int
) -> DataFrame:
    """Largest drift over the groups that occur on both dates."""
    earlier = interval_start(day, unit, quantity)
    by_day = (
        df.where(on_days(F.col(date_column), [day, earlier]) & F.expr(group).isNotNull())
        .groupBy(F.expr(group).alias("_group"), _day(date_column).alias("_day"))
        .agg(F.expr(aggregate).cast("double").alias("_value"))
    )
    on_now, on_then = F.col("_day") == F.lit(day), F.col("_day") == F.lit(earlier)
    both = (
        by_day.groupBy("_group")
        .agg(
            F.max(F.when(on_now, F.col("_value"))).alias("now"),
            F.max(F.when(on_then, F.col("_value"))).alias("then"),
            F.countDistinct("_day").alias("days"),
        )
        .where("days = 2")
    )
    drift = (F.coalesce("then", F.lit(0.0)) - F.col("now")) / F.nullif(F.col("now"), F.lit(0.0))
    return both.agg(F.round(F.max(drift), 5).alias("pct"))


def freshness(
    df: DataFrame, column: str, control: dt.date, unit: str, full_months: bool = False
) -> DataFrame:
    """How far the newest date lies behind ``control``.

    ``month`` compares calendar months and ignores the year unless ``full_months``; ``quarter``
    divides the months by four."""
    newest = F.max(_day(column))
    return df.agg(newest.alias("max_date"), _lag_behind(newest, control, unit, full_months).alias("date_diff"))


def _lag_behind(newest: Column, control: dt.date, unit: str, full_months: bool = False) -> Column:
    at = F.lit(control)
    months = F.months_between(at, newest)
    match unit:
        case "year":
            gap = months / 12
        case "quarter":
            gap = months / 4
        case "month":
            gap = F.floor(months) if full_months else F.month(at) - F.month(newest)
        case "week":
            gap = F.datediff(at, newest) / 7
        case "day":
            gap = F.datediff(at, newest)
        case _:
            raise ValueError(f"unknown unit {unit}")
    return F.round(gap.cast("double"), 6)


def non_null_ratio(
    df: DataFrame, columns: Sequence[str], date_column: str, first: dt.date | Column, last: dt.date | Column
) -> DataFrame:
    """Share of filled values per column in a date range; empty text counts as null.

    All columns come from one scan, unpivoted to (column_name, nonnull_ratio)."""
    rows = df.where(_day(date_column).between(_lit(first), _lit(last)))
    counted = rows.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(_filled(F.col(c))).alias(f"_c{i}") for i, c in enumerate(columns)],
    )
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("_c")) for i, c in enumerate(columns)]))
    return counted.select("_n", pairs).select(
        "column_name", F.round(F.col("_c") / F.nullif(F.col("_n"), F.lit(0)), 6).alias("nonnull_ratio")
    )


def _filled(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit(""))


def out_of_range(df: DataFrame, column: str, kind: str, low, high) -> DataFrame:
    """Number of values outside [low, high]; NULLs are not counted."""
    return df.agg(_outside(F.col(column), kind, low, high).alias("cnt_not_in_range"))


def _outside(value: Column, kind: str, low, high) -> Column:
    return F.count_if(~value.between(F.lit(low).cast(kind), F.lit(high).cast(kind)))


def insane_dates(df: DataFrame, column: str) -> DataFrame:
    """Number of dates outside 1970-01-01 ... 2100-01-01."""
    return out_of_range(df, column, "date", *DATE_SANITY)


@dataclass(frozen=True)
class Period:
    """Closed date range; the bounds may be dates or columns (scalar sub-queries)."""

    first: dt.date | Column
    last: dt.date | Column

    @staticmethod
    def ending(day: dt.date, unit: str, quantity: int) -> "Period":
        return Period(interval_start(day, unit, quantity), day)

    def holds(self, column: Column) -> Column:
        return column.between(_lit(self.first), _lit(self.last))


def _in_periods(source, value, date_column, bench, target, target_source, target_date_column):
    """Rows (val, b, t): the value and whether it lies in the benchmark and in the target period.

    Both periods of one table come from one scan."""
    day = F.col(date_column).cast("date")
    if target_source is None:
        in_b, in_t = bench.holds(day), target.holds(day)
        return source.where(in_b | in_t).select(value.alias("val"), in_b.alias("b"), in_t.alias("t"))
    other = F.col(target_date_column or date_column).cast("date")
    b = source.where(bench.holds(day)).select(value.alias("val"), F.lit(True).alias("b"), F.lit(False).alias("t"))
    t = target_source.where(target.holds(other)).select(value.alias("val"), F.lit(False).alias("b"), F.lit(True).alias("t"))
    return b.unionAll(t)


def _period_counts(*where):
    """One row per distinct value with its count in either period (cb, ct)."""
    return _in_periods(*where).groupBy("val").agg(F.count_if("b").alias("cb"), F.count_if("t").alias("ct"))


def _psi_term(b: Column, t: Column) -> Column:
    def filled(share):
        return F.coalesce(F.nullif(share, F.lit(0.0)), F.lit(ZERO_SHARE))

    return (b - t) * F.ln(filled(b) / filled(t))


def stability_categorical(
    source: DataFrame,
    column: str,
    date_column: str,
    bench: Period,
    target: Period,
    target_source: DataFrame | None = None,
    target_date_column: str | None = None,
) -> DataFrame:
    """Population stability of a category between two periods: abs(sum((b - t) ln(b / t))).

    A missing share counts as 1e-4 inside the logarithm; a NULL category matches the text ``xxx``."""
    value = F.col(column).cast("string")
    rows = _in_periods(source, value, date_column, bench, target, target_source, target_date_column)
    filled = F.col("val").isNotNull()
    counts = rows.groupBy(F.coalesce("val", F.lit("xxx")).alias("key")).agg(
        *[F.count_if(F.col(side) & ~filled).alias(f"{side}_null") for side in ("b", "t")],
        *[F.count_if(F.col(side) & filled).alias(f"{side}_text") for side in ("b", "t")],
    )
    # A key is one category, except that NULL and the text xxx meet under the same key.
    listed = {}
    for side in ("b", "t"):
        some = F.filter(F.array(f"{side}_null", f"{side}_text"), lambda n: n > 0)
        listed[side] = F.when(F.size(some) > 0, some).otherwise(F.array(F.lit(0).cast("bigint")))
    lists = counts.select(listed["b"].alias("lb"), listed["t"].alias("lt"), (F.col("b_null") + F.col("b_text")).alias("tb"), (F.col("t_null") + F.col("t_text")).alias("tt"))
    every_b = lists.select("*", F.posexplode("lb").alias("i", "b"))
    pairs = every_b.select("i", "b", "tb", "tt", F.posexplode("lt").alias("j", "t"))
    # One aggregate: with the totals B and T taken out of the logarithms, the sum needs no second pass.
    b, t, eps = F.col("b"), F.col("t"), F.ln(F.lit(ZERO_SHARE))
    both, only_b, only_t = (b > 0) & (t > 0), (b > 0) & (t == 0), (b == 0) & (t > 0)
    once = (F.col("i") == 0) & (F.col("j") == 0)

    def total(condition, x):
        return F.coalesce(F.sum(F.when(condition, x)), F.lit(0.0))

    sums = pairs.agg(
        total(both, b * (F.ln(b) - F.ln(t))).alias("b_log"), total(both, t * (F.ln(b) - F.ln(t))).alias("t_log"),
        total(both, b).alias("b_both"), total(both, t).alias("t_both"),
        total(only_b, b * (F.ln(b) - eps)).alias("b_only_log"), total(only_b, b).alias("b_only"),
        total(only_t, t * (eps - F.ln(t))).alias("t_only_log"), total(only_t, t).alias("t_only"),
        F.nullif(total(once, F.col("tb")), F.lit(0.0)).alias("B"), F.nullif(total(once, F.col("tt")), F.lit(0.0)).alias("T"),
    )
    psi = F.expr(
        """coalesce((b_log + b_only_log) / B, 0) - coalesce((t_log + t_only_log) / T, 0)
         + coalesce((ln(T) - ln(B)) * (b_both / B - t_both / T), 0) - coalesce(ln(B) * b_only / B, 0) - coalesce(ln(T) * t_only / T, 0)"""
    )
    return sums.select(F.round(F.abs(psi), 4).alias("psi"))


def stability_continuous(
    source: DataFrame,
    column: str,
    date_column: str,
    bench: Period,
    target: Period,
    target_source: DataFrame | None = None,
    target_date_column: str | None = None,
    smooth_missing: bool = False,
    last_bound: float | None = LAST_BOUND,
    as_days: bool = False,
    buckets: int = 1024,
) -> DataFrame:
    """Population stability over ten rank bins: one row per benchmark bin and a total row.

    bin = rank * 10 div (number of non-null values), so bins run from 0 to 10 and NULLs, ranked
    last, fall into the last bin or above.  A bin missing in the target drops out of the sum unless
    ``smooth_missing``.  The total row has group_cd '9999'.  ``last_bound=None`` closes the last bin
    at its own maximum.
    """
    value = F.datediff(F.col(column).cast("date"), F.lit(DAY_ZERO)) if as_days else F.col(column)
    counts = _period_counts(source, value, date_column, bench, target, target_source, target_date_column)
    ranked = preceding_counts(counts, "val", ["cb", "ct"], buckets)
    n, nulls = ranked.totals, ranked.nulls
    binned = ranked.rows.withColumns(
        {f"bin_{c}": F.floor((F.col(f"{c}_before") + 1) * 10 / F.nullif(F.lit(n[c]), F.lit(0))) for c in ("cb", "ct")}
    )
    b = binned.where("cb > 0").groupBy(F.col("bin_cb").alias("decile")).agg(
        F.min("val").cast("double").alias("lbound"), F.max("val").cast("double").alias("own_max"), F.sum("cb").alias("qty")
    )
    t = binned.where("ct > 0").groupBy(F.col("bin_ct").alias("t_decile")).agg(F.sum("ct").alias("t_qty"))
    rows_b, rows_t = n["cb"] + nulls["cb"], n["ct"] + nulls["ct"]
    joined = b.join(t, F.col("decile") == F.col("t_decile"), "left").select(
        "decile",
        "lbound",
        "own_max",
        (F.col("qty") / F.lit(rows_b)).alias("pct_bench"),
        (F.col("t_qty") / F.lit(rows_t)).alias("pct_target"),
    )
    share = F.coalesce("pct_target", F.lit(0.0)) if smooth_missing else F.col("pct_target")
    following = F.lead("lbound").over(Window.orderBy("decile"))  # one row per bin
    last = F.col("own_max") if last_bound is None else F.lit(float(last_bound))
    rows = joined.select(
        F.col("decile").cast("string").alias("group_cd"),
        F.when(F.col("decile") <= 0, F.col("own_max")).otherwise(F.coalesce(following, last)).alias("ubound"),
        "lbound",
        "pct_bench",
        "pct_target",
        _psi_term(F.col("pct_bench"), share).alias("psi"),
    )
    graded = rows.groupingSets(
        [["group_cd", "lbound", "ubound", "pct_bench", "pct_target"], []],
        "group_cd", "lbound", "ubound", "pct_bench", "pct_target",
    ).agg(F.grouping("group_cd").alias("_total"), F.sum("psi").alias("psi"))
    return graded.select(
        F.when(F.col("_total") == 1, F.lit("9999")).otherwise(F.col("group_cd")).alias("group_cd"),
        "lbound",
        "ubound",
        F.round("pct_bench", 6).alias("pct_bench"),
        F.round("pct_target", 6).alias("pct_target"),
        F.round("psi", 4).alias("psi"),
    )


def stability_date(source, column, date_column, bench, target, **options) -> DataFrame:
    """As ``stability_continuous`` over a date column; bounds are days since 2000-01-01."""
    return stability_continuous(source, column, date_column, bench, target, as_days=True, **options)


def sql_metric(
    spark: SparkSession,
    sql: str,
    frames: Mapping[str, DataFrame],
    date_column: str | None = None,
    day: dt.date | None = None,
    unit: str | None = None,
    quantity: int | None = None,
) -> DataFrame:
    """Scalar user query over ``{name}`` frames; with ``day`` a date-range predicate is appended."""
    if day is None:
        return spark.sql(sql, **frames).toDF("calc_value")
    text = f"{sql} where cast({date_column} as date) between :first and :last"
    bounds = {"first": interval_start(day, unit, quantity), "last": day}
    return spark.sql(text, args=bounds, **frames).toDF("calc_value")


# --- period volume and the check suite -------------------------------------------------


def _truncate(day: dt.date, unit: str) -> dt.date:
    match unit:
        case "year":
            return day.replace(month=1, day=1)
        case "quarter":
            return day.replace(month=3 * ((day.month - 1) // 3) + 1, day=1)
        case "month":
            return day.replace(day=1)
        case "week":
            return day - dt.timedelta(days=day.weekday())
    return day


def volume_dates(as_of: dt.date, unit: str = "month", offset: int = -1) -> tuple[dt.date, dt.date, dt.date]:
    """The checked period end and the two period ends before it."""
    end = _truncate(as_of + dt.timedelta(days=offset + 1), unit) - dt.timedelta(days=1)
    start = end + dt.timedelta(days=1)
    calendar = {"year": 12, "quarter": 3, "month": 1}
    if unit in calendar:
        back = [add_months(start, -calendar[unit] * k) for k in (1, 2)]
    else:
        step = 7 if unit == "week" else 1
        back = [start - dt.timedelta(days=step * k) for k in (1, 2)]
    return end, *[b - dt.timedelta(days=1) for b in back]


@dataclass(frozen=True)
class VolumeCheck:
    """Check of one field at the period end by the metric of that name, the volume against earlier period ends by default."""

    table: str
    field: str
    date_column: str
    unit: str = "month"
    low: float | None = None
    high: float | None = None
    offset: int = -1
    metric: str = "nonnull_volume"
    active: bool = True
    params: Mapping[str, object] = field(default_factory=dict)


VERDICT_SCHEMA = "metric string, tbl string, fn string, res int, dt date, val2chk bigint, ratio_1 double, ratio_3 double, error string"


def period_volume(df: DataFrame, checks: Sequence[VolumeCheck], as_of: dt.date) -> DataFrame:
    """Verdict rows of checks that share a table, date column, unit and offset; one scan for all.

    res is 1 or 0 (ratio inside or outside the bounds) and -1 when the period end has no rows."""
    first = checks[0]
    end, prev, prev2 = volume_dates(as_of, first.unit, first.offset)
    day = _quoted(first.date_column).cast("date")
    counted = (
        df.where(on_days(_quoted(first.date_column), [end, prev, prev2]))
        .groupBy(day.alias("rd"))
        .agg(F.count(F.lit(1)).alias("_all"), *[F.count(_quoted(c.field)).alias(f"c{i}") for i, c in enumerate(checks)])
    )
    on_end, on_prev = F.col("rd") == F.lit(end), F.col("rd") == F.lit(prev)
    wide = counted.agg(
        F.max(F.when(on_end, F.lit(1))).alias("seen"),
        *[F.max(F.when(on_end, F.col(f"c{i}"))).alias(f"n{i}") for i in range(len(checks))],
        *[F.max(F.when(on_prev, F.col(f"c{i}"))).alias(f"p{i}") for i in range(len(checks))],
        *[F.avg(F.when(~on_end, F.col(f"c{i}"))).alias(f"a{i}") for i in range(len(checks))],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.metric).alias("metric"),
                F.lit(c.table).alias("tbl"),
                F.lit(c.field).alias("fn"),
                F.lit(c.low).cast("double").alias("low"),
                F.lit(c.high).cast("double").alias("high"),
                F.col(f"n{i}").alias("n"),
                F.col(f"p{i}").alias("p"),
                F.col(f"a{i}").alias("a"),
            )
            for i, c in enumerate(checks)
        ]
    )
    ratio_1 = F.nullif(F.col("n") / F.nullif(F.col("p"), F.lit(0)), F.lit(0.0))
    ratio_3 = F.nullif(F.col("n") / F.nullif(F.col("a"), F.lit(0.0)), F.lit(0.0))
    inside = F.coalesce(ratio_3, ratio_1).between(F.col("low"), F.col("high"))
    return wide.select("seen", F.inline(rows)).select(
        "metric",
        "tbl",
        "fn",
        F.when(F.col("seen").isNull(), F.lit(-1)).when(inside, F.lit(1)).otherwise(F.lit(0)).alias("res"),
        F.lit(end).alias("dt"),
        F.when(F.col("seen").isNotNull(), F.col("n")).alias("val2chk"),
        F.round(ratio_1, 6).alias("ratio_1"),
        F.round(ratio_3, 6).alias("ratio_3"),
        F.when(F.col("seen").isNull(), F.lit("Empty data")).alias("error"),
    )


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _psi(function, **options):
    """Stability of a field over the period that ends at the check date against the period before it.

    The parameters ``target_units`` and ``bench_units`` of a check give the lengths in its unit, one by default."""

    def metric(df: DataFrame, c: VolumeCheck, end: dt.date) -> DataFrame:
        target = Period.ending(end, c.unit, c.params.get("target_units", 1))
        bench = Period.ending(target.first - dt.timedelta(days=1), c.unit, c.params.get("bench_units", 1))
        out = function(df, c.field, c.date_column, bench, target, **options)
        return out.where("group_cd = '9999'").select("psi") if "group_cd" in out.columns else out.select("psi")

    return metric


#: Metrics by name: each gives one value of a field at a date, judged by the bounds of the check.
METRICS: dict[str, Callable[[DataFrame, VolumeCheck, dt.date], DataFrame]] = {
    "aggregate_drift": lambda df, c, end: aggregate_drift(df, c.date_column, c.params.get("aggregate", f"sum({c.field})"), end, c.unit, 1),
    "grouped_drift": lambda df, c, end: grouped_drift(df, c.date_column, c.field, c.params.get("aggregate", "count(1)"), end, c.unit, 1),
    "freshness": lambda df, c, end: freshness(df, c.field, end, c.unit).select("date_diff"),
    "nonnull_ratio": lambda df, c, end: non_null_ratio(df, [c.field], c.date_column, interval_start(end, c.unit, 1), end).select("nonnull_ratio"),
    "out_of_range": lambda df, c, end: out_of_range(df, c.field, c.params.get("kind", "double"), c.params["low"], c.params["high"]),
    "insane_dates": lambda df, c, end: insane_dates(df, c.field),
    "stability_categorical": _psi(lambda *a, **o: stability_categorical(*a, **o)),
    "stability_continuous": _psi(lambda *a, **o: stability_continuous(*a, **o)),
    "stability_date": _psi(stability_date),
    # The text of the check reads the table as {t}.
    "sql_metric": lambda df, c, end: sql_metric(df.sparkSession, c.params["sql"], {"t": df}, c.date_column, end, c.unit, c.params.get("target_units", 1)),
}


@dataclass(frozen=True)
class RowMetric:
    """A metric that is one expression of aggregates over rows, so that many of them share a scan.

    ``ranges`` are the closed date ranges whose rows it needs, none for the whole table; the aggregates keep to them."""

    value: Column
    ranges: tuple[tuple[dt.date, dt.date], ...] = ()


def _drift(c: VolumeCheck, end: dt.date) -> RowMetric | None:
    text = c.params.get("aggregate", f"sum({c.field})")
    if not re.fullmatch(r"\s*\w+\((?!\s*distinct\b)[^()]*\)\s*", text, re.IGNORECASE):
        return None  # only a plain aggregate call takes a filter
    earlier, name = interval_start(end, c.unit, 1), "`" + c.date_column.replace("`", "``") + "`"
    now, then = (F.expr(f"{text} filter (where cast({name} as date) = date '{d}')").cast("double") for d in (end, earlier))
    drift = (F.coalesce(then, F.lit(0.0)) - now) / F.nullif(now, F.lit(0.0))
    return RowMetric(F.round(drift, 5), ((end, end), (earlier, earlier)))


def _filled_share(c: VolumeCheck, end: dt.date) -> RowMetric:
    first = interval_start(end, c.unit, 1)
    inside = _quoted(c.date_column).cast("date").between(F.lit(first), F.lit(end))
    share = F.count_if(inside & _filled(_quoted(c.field)).isNotNull()) / F.nullif(F.count_if(inside), F.lit(0))
    return RowMetric(F.round(share, 6), ((first, end),))


#: The metrics of METRICS that need no grouping of their own; None sends a check to METRICS.
ROW_METRICS: dict[str, Callable[[VolumeCheck, dt.date], RowMetric | None]] = {
    "aggregate_drift": _drift,
    "nonnull_ratio": _filled_share,
    "freshness": lambda c, end: RowMetric(_lag_behind(F.max(_quoted(c.field).cast("date")), end, c.unit)),
    "out_of_range": lambda c, end: RowMetric(_outside(_quoted(c.field), c.params.get("kind", "double"), c.params["low"], c.params["high"])),
    "insane_dates": lambda c, end: RowMetric(_outside(_quoted(c.field), "date", *DATE_SANITY)),
}


def _row_metric(check: VolumeCheck, as_of: dt.date) -> RowMetric | None:
    found = ROW_METRICS.get(check.metric)
    return found(check, volume_dates(as_of, check.unit, check.offset)[0]) if found else None


def row_verdicts(df: DataFrame, checks: Sequence[VolumeCheck], as_of: dt.date) -> DataFrame:
    """Verdict rows of checks by metrics of ROW_METRICS on one table and date column; one scan and one aggregate for all."""
    metrics = [_row_metric(c, as_of) for c in checks]
    ranges = sorted({r for m in metrics for r in m.ranges})
    if all(m.ranges for m in metrics):
        day = _quoted(checks[0].date_column).cast("date")
        df = df.where(reduce(lambda a, b: a | b, [day.between(F.lit(first), F.lit(last)) for first, last in ranges]))
    wide = df.agg(*[m.value.cast("double").alias(f"v{i}") for i, m in enumerate(metrics)])
    rows = [_found(c, as_of, F.col(f"v{i}")) for i, c in enumerate(checks)]
    return _judged(wide.select(F.inline(F.array(*rows))))


def _found(check: VolumeCheck, as_of: dt.date, value: Column) -> Column:
    return F.struct(
        F.lit(check.metric).alias("metric"),
        F.lit(check.table).alias("tbl"),
        F.lit(check.field).alias("fn"),
        F.lit(check.low).cast("double").alias("low"),
        F.lit(check.high).cast("double").alias("high"),
        F.lit(volume_dates(as_of, check.unit, check.offset)[0]).alias("dt"),
        value.alias("value"),
    )


def _judged(found: DataFrame) -> DataFrame:
    inside = F.col("value").between(F.col("low"), F.col("high"))
    return found.select(
        "metric",
        "tbl",
        "fn",
        F.when(F.col("value").isNull(), F.lit(-1)).when(inside, F.lit(1)).otherwise(F.lit(0)).alias("res"),
        "dt",
        F.lit(None).cast("bigint").alias("val2chk"),
        F.round("value", 6).alias("ratio_1"),
        F.lit(None).cast("double").alias("ratio_3"),
        F.when(F.col("value").isNull(), F.lit("Empty data")).alias("error"),
    )


def metric_verdict(df: DataFrame, check: VolumeCheck, as_of: dt.date) -> DataFrame:
    """Verdict row of one check by a metric of METRICS: 1 or 0 (value inside or outside the bounds), -1 without a value."""
    end = volume_dates(as_of, check.unit, check.offset)[0]
    out = METRICS[check.metric](df, check, end)
    found = out.agg(F.max(out.columns[-1]).cast("double").alias("value"))
    return _judged(found.select(F.inline(F.array(_found(check, as_of, F.col("value"))))))


def check_suite(
    spark: SparkSession,
    checks: Sequence[VolumeCheck],
    tables: Mapping[str, DataFrame],
    as_of: dt.date,
    metric_mask: str = "%",
    table_mask: str = "%",
) -> DataFrame:
    """One verdict row per active check under the masks.

    Volume checks on the same table and period share a scan.  Metrics of ROW_METRICS share one scan per table for
    all that keep to date ranges, and one for all that read the whole table; other metrics are found by name and
    run alone.  A check that cannot be analysed gives res -99 and does not touch the others."""
    chosen = [c for c in checks if c.active and _like(c.metric, metric_mask) and _like(c.table, table_mask)]
    groups: dict[tuple, list[VolumeCheck]] = {}
    shared: dict[tuple, list[VolumeCheck]] = {}
    frames, failed = [], []

    def fail(c: VolumeCheck, text: str) -> None:
        failed.append((c.metric, c.table, c.field, -99, None, None, None, None, text))

    for c in chosen:
        known = tables.get(c.table)
        if known is None or c.field not in known.columns or c.date_column not in known.columns:
            fail(c, "unknown table or column")
        elif c.metric == "nonnull_volume":
            groups.setdefault((c.table, c.date_column, c.unit, c.offset), []).append(c)
        elif c.metric not in METRICS:
            fail(c, "unknown metric")
        elif metric := _shareable(c, as_of):
            shared.setdefault((c.table, c.date_column if metric.ranges else None), []).append(c)
        else:
            _analysed(frames, [c], lambda part: metric_verdict(tables[part[0].table], part[0], as_of), fail)
    for (table, *_), members in groups.items():
        _analysed(frames, members, lambda part, table=table: period_volume(tables[table], part, as_of), fail)
    for (table, _), members in shared.items():
        _analysed(frames, members, lambda part, table=table: row_verdicts(tables[table], part, as_of), fail)
    if failed or not frames:
        frames.append(spark.createDataFrame(failed, VERDICT_SCHEMA))
    return reduce(DataFrame.unionByName, frames)


def _shareable(check: VolumeCheck, as_of: dt.date) -> RowMetric | None:
    """The check as a row metric; a faulty one gives None, so that it runs, and fails, alone."""
    try:
        return _row_metric(check, as_of)
    except (AnalysisException, KeyError):
        return None


def _analysed(frames: list[DataFrame], part: list[VolumeCheck], build, fail) -> None:
    """Add the verdicts of ``part``; if they cannot be analysed together, check by check."""
    try:
        frames.append(build(part))
    except (AnalysisException, KeyError) as error:
        if len(part) == 1:
            fail(part[0], str(error))
            return
        for c in part:
            _analysed(frames, [c], build, fail)


def _like(text: str, mask: str) -> bool:
    return fnmatchcase(text, mask.replace("%", "*").replace("_", "?"))


def suite_summary(verdicts: DataFrame) -> DataFrame:
    """Overall verdict: the worst result decides, the code is 1 only for True."""
    word = F.when(F.col("res") > 0, "True").when(F.col("res") == 0, "False").otherwise("Error")
    worst = F.min("res")
    return verdicts.agg(
        F.concat_ws(
            ", ",
            *[
                F.when(F.count_if(word == w) > 0, F.concat(F.lit(f"{w} "), F.count_if(word == w).cast("string")))
                for w in ("True", "False", "Error")
            ],
        ).alias("msg"),
        worst.alias("worst"),
        F.count(F.lit(1)).alias("cnt"),
        F.countDistinct("tbl").alias("tbl_cnt"),
        F.countDistinct("fn").alias("fn_cnt"),
        F.countDistinct("dt").alias("dt_cnt"),
        F.countDistinct("metric").alias("mt_cnt"),
        F.when(worst < 0, "Error").when(worst > 0, "True").otherwise("False").alias("verdict"),
        F.when(worst > 0, F.lit(1)).otherwise(F.lit(-1)).alias("res"),
    )


def suite_report(verdicts: DataFrame, only_err: bool = False, merge_ok: bool = True) -> DataFrame:
    """Grouped detail: one row per (metric, table, result, date, message) with its number of features and their list."""
    msg = F.to_json(F.struct("res", "dt", "val2chk", "ratio_1", "ratio_3", "error"))
    if merge_ok:
        msg = F.when(F.col("res") > 0, F.to_json(F.struct(F.lit(1).alias("res"), "dt"))).otherwise(msg)
    grouped = (
        verdicts.withColumn("msg", msg)
        .groupBy("metric", "tbl", "res", "dt", "msg")
        .agg(F.sort_array(F.collect_set("fn")).alias("fns"))
    )
    rows = grouped.select("metric", "tbl", "res", "dt", "msg", F.size("fns").alias("features"), F.concat_ws(", ", "fns").alias("feature"))
    return rows.where("res <= 0") if only_err else rows


# --- rule-driven suites -----------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One row of the rule table."""

    name: str
    kind: str
    table: str
    field: str
    date_column: str | None = None
    on: bool = True
    extra: dict = field(default_factory=dict)


_STABILITY: dict[str, Callable[..., DataFrame]] = {
    "continuous stability": stability_continuous,
    "stab_cont": stability_continuous,
    "category stability": stability_categorical,
    "stab_categ": stability_categorical,
    "date stability": stability_date,
    "stab_date": stability_date,
}


def stability_suite(
    stage: DataFrame, raw: DataFrame, rules: Sequence[Rule], table: str, read_from: DataFrame | None = None
) -> DataFrame:
    """Stability of every active rule of ``table``: benchmark = month up to the newest stage date,
    target = month up to the newest raw date, both read from the stage table (or ``read_from``)."""
    rows = stage if read_from is None else read_from
    newest: dict[str, list[dt.date]] = {}  # one date per date column and table reaches the driver
    frames = []
    for rule in rules:
        if not rule.on or rule.table != table or rule.kind not in _STABILITY:
            continue
        if rule.date_column not in newest:
            newest[rule.date_column] = [df.agg(F.max(_day(rule.date_column))).first()[0] for df in (stage, raw)]
        bench, target = (Period.ending(day, "month", 1) for day in newest[rule.date_column])
        result = _STABILITY[rule.kind](rows, rule.field, rule.date_column, bench, target)
        if "group_cd" in result.columns:
            result = result.where("group_cd = '9999'").select("psi")
        frames.append(result.select(F.lit(rule.name).alias("rule_name"), F.lit(rule.kind).alias("rule_type"), "psi"))
    return reduce(DataFrame.unionByName, frames)


def freshness_fill_suite(stage: DataFrame, rules: Sequence[Rule], table: str, as_of: dt.date) -> DataFrame:
    """Freshness in days and ten-year fill ratio of every active rule of ``table``, one scan each kind."""
    mine = [r for r in rules if r.on and r.table == table]
    frames = []
    for rule in (r for r in mine if r.kind == "max_date"):
        gap = freshness(stage, rule.field, as_of, "day")
        frames.append(gap.select(F.lit(rule.name).alias("rule_name"), F.lit("max_date").alias("rule_type"), F.col("date_diff").alias("value")))
    by_date: dict[str, list[Rule]] = {}
    for rule in (r for r in mine if r.kind == "nonnull_ratio"):
        by_date.setdefault(rule.date_column, []).append(rule)
    for date_column, group in by_date.items():
        ratios = non_null_ratio(stage, [r.field for r in group], date_column, interval_start(as_of, "year", 10), as_of)
        name = F.create_map(*[x for r in group for x in (F.lit(r.field), F.lit(r.name))])
        frames.append(ratios.select(name[F.col("column_name")].alias("rule_name"), F.lit("nonnull_ratio").alias("rule_type"), F.col("nonnull_ratio").alias("value")))
    return reduce(DataFrame.unionByName, frames)


STATUS_COLUMNS = (
    "rule_name", "rule_table_name", "rule_field_name", "rule_type_cd", "control_value", "actual_value", "is_passed", "load_dt",
)


def status_mart(rules: DataFrame, metrics: Mapping[str, DataFrame]) -> DataFrame:
    """Newest result per rule of every metric kind with its pass flag; a distinct union.

    ``metrics`` maps a kind to (rule_name, load_dt, value, calc_dt).  A fill ratio passes at or above
    the threshold, the other kinds at or below it; a missing value fails."""
    frames = []
    for kind, results in metrics.items():
        latest = newest_per_key(results.select("rule_name", "calc_dt", "load_dt", "value"), ["rule_name"], ["calc_dt"])
        frames.append(latest.select("rule_name", "load_dt", F.col("value").alias("actual_value"), F.lit(kind).alias("_kind")))
    every = reduce(DataFrame.unionByName, frames)
    limit = F.col("rule_upper_value")
    passed = F.when(F.col("_kind") == "nonnull_ratio", F.col("actual_value") >= limit).otherwise(F.col("actual_value") <= limit)
    return (
        rules.join(every, "rule_name")
        .select(
            "rule_name", "rule_table_name", "rule_field_name", "rule_type_cd",
            limit.alias("control_value"), "actual_value",
            F.when(F.col("actual_value").isNull(), 0).when(passed | limit.isNull(), 1).otherwise(0).alias("is_passed"),
            "load_dt",
        )
        .distinct()
    )


def status_history(history: DataFrame, status: DataFrame, as_of: dt.date) -> DataFrame:
    """Close the open rows of the re-evaluated rules at ``as_of`` and append new open rows."""
    evaluated = status.select(F.col("rule_name").alias("_rule")).distinct()
    marked = history.join(evaluated, F.col("rule_name") == F.col("_rule"), "left")
    closing = F.col("_rule").isNotNull() & (F.col("effective_to") == F.lit(OPEN_END))
    kept = marked.select(
        *[c for c in history.columns if c not in ("effective_to", "is_passed")],
        F.when(F.col("actual_value").isNull(), 0).otherwise(F.col("is_passed")).alias("is_passed"),
        F.when(closing, F.lit(as_of)).otherwise(F.col("effective_to")).alias("effective_to"),
    )
    fresh = status.select(*STATUS_COLUMNS, F.lit(as_of).alias("effective_from"), F.lit(OPEN_END).alias("effective_to"))
    return kept.unionByName(fresh.select(*kept.columns))


def validity_gaps(
    df: DataFrame, keys: Sequence[str], start: str, end: str, tie: Sequence[str] = (), chunk: Column | None = None
) -> DataFrame:
    """Rows of an interval history that start neither on the previous end nor on the day after it."""
    chunk = F.col(end) if chunk is None else chunk
    linked = previous_row(df, keys, [end, *tie], {"_previous_end": end}, chunk)
    gap = F.coalesce("_previous_end", start)
    return linked.where((F.col(start) != gap) & (F.date_sub(F.col(start), 1) != gap)).drop("_previous_end")


def validity_gap_count(df: DataFrame, keys: Sequence[str], start: str, end: str, tie: Sequence[str] = ()) -> DataFrame:
    return validity_gaps(df, keys, start, end, tie).agg(F.count(F.lit(1)).alias("cnt"))


def key_and_volume_status(
    df: DataFrame, name: str, key: Sequence[str], max_count: int | None = None, date_column: str | None = None
) -> DataFrame:
    """OK/ERROR for duplicate keys and for the row cap (per date, or in total without a date)."""
    duplicates = df.groupBy(*key).count().where("count > 1").limit(1).agg(F.count(F.lit(1))).scalar()
    pk = F.when(duplicates > 0, "ERROR").otherwise("OK")
    if max_count is None:
        volume = F.lit(None).cast("string")
    elif date_column is not None:
        over = df.groupBy(date_column).count().where(F.col("count") > max_count).limit(1).agg(F.count(F.lit(1))).scalar()
        volume = F.when(over > 0, "ERROR").otherwise("OK")
    else:
        total = df.agg(F.count(F.lit(1))).scalar()
        volume = F.when(total < max_count, F.concat(F.lit("OK ("), total.cast("string"), F.lit(")"))).otherwise(
            F.concat(F.lit("ERROR ("), total.cast("string"), F.lit(")"))
        )
    one = df.sparkSession.range(1)
    return one.select(F.lit(name).alias("object_name"), volume.alias("count_status"), pk.alias("pk_status"))


def last_delta_percent(df: DataFrame, date_column: str) -> DataFrame:
    """Change of the row count between the last two distinct dates, in percent."""
    per_day = df.where(F.col(date_column).isNotNull()).groupBy(F.col(date_column).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    last_two = per_day.orderBy(F.col("d").desc()).limit(2)
    last = F.max_by("n", "d")
    prev = F.when(F.count(F.lit(1)) == 2, F.min_by("n", "d"))
    return last_two.agg(F.round((last - prev) / prev * 100, 6).alias("delta"))


def monthly_coverage(
    df: DataFrame, ts: str, sender: str, sender_id: str, receiver: str, receiver_id: str
) -> DataFrame:
    """Per month: rows, active days, share of ten-minute slots with data and mapping shares."""
    out = df.groupBy(F.trunc(ts, "MM").alias("dt")).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.countDistinct(F.to_date(ts)).alias("cnt_dt"),
        F.countDistinct(F.floor(F.unix_timestamp(ts) / 600)).alias("_slots"),
        F.countDistinct(sender).alias("cnt_snd"),
        F.countDistinct(sender_id).alias("cnt_snd_id"),
        F.countDistinct(receiver).alias("cnt_rcv"),
        F.countDistinct(receiver_id).alias("cnt_rcv_id"),
    )

    def share(a, b):
        return F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 6)

    return out.select(
        "dt",
        "cnt",
        "cnt_dt",
        F.round(F.col("_slots") / F.col("cnt_dt") / 24 / 6, 6).alias("slot_share"),
        "cnt_snd",
        "cnt_snd_id",
        share("cnt_snd_id", "cnt_snd").alias("dq_snd"),
        (F.col("cnt_snd") - F.col("cnt_snd_id")).alias("cnt_snd_null"),
        "cnt_rcv",
        "cnt_rcv_id",
        share("cnt_rcv_id", "cnt_rcv").alias("dq_rcv"),
        (F.col("cnt_rcv") - F.col("cnt_rcv_id")).alias("cnt_rcv_null"),
    )


def check_log(log: DataFrame) -> DataFrame:
    """Start rows of the check log with their end row: duration in seconds, result and message."""
    a, b = log.alias("a"), log.where("parent is not null").alias("b")
    return a.join(b, F.col("a.id") == F.col("b.parent")).select(
        F.col("a.id").alias("id"),
        F.col("a.ts").alias("ts"),
        F.col("a.action").alias("metric"),
        F.get_json_object("a.message", "$.tbl").alias("tbl"),
        F.get_json_object("a.message", "$.params").alias("params"),
        (F.unix_timestamp("b.ts") - F.unix_timestamp("a.ts")).alias("duration_s"),
        F.col("b.action").alias("res_msg"),
        F.col("b.message").alias("msg"),
    )
