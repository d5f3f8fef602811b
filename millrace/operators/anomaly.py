"""Z-test family: scores of daily values, row-growth verdicts, their configuration and view."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import newest_per_key
from millrace.functions.lineage import new_folder, store_rows
from millrace.functions.parsing import json_field
from millrace.functions.periods import interval_start

DOTS = 90  # fixed value: length of the growth baseline
WIDE, NORMAL = 10.0, 5.0  # fixed values: accepted |z| of a steady and of any other series
STEADY = 0.01  # fixed value: |std / avg| below which a series is steady
FIRST_DAY = dt.date(1900, 1, 1)  # fixed value
ROLLBACK_PREFIX = "Ztest error"


def z_table_rows(top: int = 40) -> list[tuple[float, float]]:
    """(z, one-sided tail probability) for z = 0.0, 0.1 ... rounded to five digits."""
    return [(i / 10, round(math.erfc(i / 10 / math.sqrt(2)) / 2, 5)) for i in range(top + 1)]


def with_p_value(df: DataFrame, z: str = "zscore", name: str = "p_value") -> DataFrame:
    """Two-sided p of |z| rounded to 0.1, as the lookup table has it; 0 beyond the table."""
    tails = F.array(*[F.lit(p) for _, p in z_table_rows()])
    place = F.round(F.abs(F.round(F.col(z).cast("double"), 1)) * 10).try_cast("int")
    return df.withColumn(name, F.coalesce(2 * F.get(tails, place), F.lit(0.0)))


def _score(value: Column, avg: Column, std: Column) -> Column:
    return (value - avg) / F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0))


def _daily(df: DataFrame, date_column: str, value: str) -> DataFrame:
    """(day, value): grouped when ``value`` is an aggregate expression, the rows themselves otherwise."""
    day = F.col(date_column).cast("date").alias("day")
    if "(" in value:
        return df.groupBy(day).agg(F.expr(value).cast("double").alias("value"))
    return df.select(day, F.col(value).cast("double").alias("value"))


def z_of_date(
    df: DataFrame,
    value: str,
    date_column: str,
    day: dt.date,
    unit: str,
    quantity: int,
    distinct_points: bool = True,
    report_as: str | None = None,
) -> DataFrame:
    """Score of one date within the window that ends on it.

    Plain values count once per (date, value) unless ``distinct_points`` is off."""
    first = interval_start(day, unit, quantity)
    on = F.col(date_column).cast("date")
    points = _daily(df.where(on.between(F.lit(first), F.lit(day))), date_column, value)
    avg, std = F.avg("value").alias("avg"), F.stddev_pop("value").alias("std")
    if "(" in value:
        # One point per date: the score needs a single pass.
        of_day = F.max(F.when(F.col("day") == F.lit(day), F.struct("day", "value"))).alias("p")
        scored = points.agg(avg, std, of_day).where("p is not null").select("avg", "std", "p.*")
    else:
        points = points.distinct() if distinct_points else points
        stats = points.agg(F.struct(avg, std)).scalar()
        scored = points.where(F.col("day") == F.lit(day)).select("*", stats.getField("avg").alias("avg"), stats.getField("std").alias("std"))
    out = with_p_value(scored.withColumn("zscore", _score(F.col("value"), F.col("avg"), F.col("std"))))
    return out.select(
        *([F.lit(report_as).alias("object_name")] if report_as else []),
        F.col("day").alias("date_field_value"),
        F.round("value", 6).alias("field_value"),
        F.lit(first).alias("date_from"),
        F.lit(day).alias("date_to"),
        F.round("avg", 6).alias("avg_value"),
        F.round("std", 6).alias("stddev_value"),
        F.round("zscore", 6).alias("zscore"),
        F.round(100 * F.col("p_value"), 4).alias("confidence_percentage"),
    )


def z_of_helper(df, value, date_column, day, unit, quantity, report_as) -> DataFrame:
    """As ``z_of_date`` over a helper table, reported under another object's name."""
    return z_of_date(df, value, date_column, day, unit, quantity, False, report_as)


def max_z_of_means(df: DataFrame, column: str, date_column: str, day: dt.date, unit: str, quantity: int) -> DataFrame:
    """Largest |z| of the daily means in the window; mean and deviation over all dates."""
    first = interval_start(day, unit, quantity)
    means = df.groupBy(F.col(date_column).cast("date").alias("day")).agg(F.avg(column).alias("value"))
    inside = F.when(F.col("day").between(F.lit(first), F.lit(day)), F.col("value"))
    # The largest |z| belongs to the smallest or the largest mean of the window, so one pass is enough.
    stats = means.agg(
        F.avg("value").alias("avg"), F.stddev_pop("value").alias("std"), F.min(inside).alias("low"), F.max(inside).alias("high")
    )
    far = F.greatest(*[F.abs(_score(F.col(c), F.col("avg"), F.col("std"))) for c in ("low", "high")])
    return stats.select(F.round(far, 4).alias("max_z"))


def rolling_z(
    fresh: DataFrame,
    stored: DataFrame,
    start: dt.date,
    end: dt.date,
    days: int,
) -> DataFrame:
    """Scores over a date range with a rolling sum of ``days`` days, all objects at once.

    Both inputs are (object, day, calc_dt, value), already one row per day and calculation; the
    newest calculation of a day wins.  Mean and deviation run over every known day."""
    points = fresh.select("object", "day", "calc_dt", "value").unionByName(
        stored.select("object", "day", "calc_dt", "value")
    )
    points = newest_per_key(points, ["object", "day"], ["calc_dt"])
    number = F.datediff("day", F.lit(dt.date(1970, 1, 1)))
    frame = Window.partitionBy("object").orderBy("_n").rangeBetween(-days, 0)
    rolled = points.withColumn("_n", number).withColumn("rolled", F.sum("value").over(frame))
    every = Window.partitionBy("object")
    scored = rolled.select(
        "object",
        "day",
        "rolled",
        F.avg("rolled").over(every).alias("avg"),
        F.stddev_pop("rolled").over(every).alias("std"),
    ).withColumn("zscore", _score(F.col("rolled"), F.col("avg"), F.col("std")))
    inside = with_p_value(scored.where(F.col("day").between(F.lit(start), F.lit(end))))
    return inside.select(
        "object",
        F.col("day").alias("date_field_value"),
        F.col("rolled").alias("field_value"),
        F.round("avg", 6).alias("avg_value"),
        F.round("std", 6).alias("stddev_value"),
        F.round("zscore", 6).alias("zscore"),
        F.round(100 * F.col("p_value"), 4).alias("confidence_percentage"),
    )


def daily_points(df: DataFrame, object_column: Column, date_column: str, value: str, calc_dt) -> DataFrame:
    """(object, day, calc_dt, value) input of ``rolling_z`` from raw rows."""
    return (
        df.groupBy(object_column.alias("object"), F.col(date_column).cast("date").alias("day"))
        .agg(F.expr(value).alias("value"))
        .select("object", "day", F.lit(calc_dt).alias("calc_dt"), "value")
    )


# --- row-growth verdicts ------------------------------------------------------------------

CONFIG_SCHEMA = "object string, active boolean, rollback boolean, z_cfg string, z_except array<date>, z_error array<date>"


def _settings(config: DataFrame) -> DataFrame:
    def number(name):
        return json_field("z_cfg", name).try_cast("bigint")

    none = F.array().cast("array<date>")
    return config.select(
        F.col("object").alias("_object"),
        "active",
        F.col("rollback").alias("back"),
        F.coalesce("z_except", none).alias("z_except"),
        F.coalesce("z_error", none).alias("z_error"),
        number("key").cast("int").alias("cfg_key"),
        number("hist").alias("hist"),
        number("min").alias("cfg_min"),
        number("max").alias("cfg_max"),
        json_field("z_cfg", "interval").alias("cfg_interval"),
        json_field("z_cfg", "skip").try_cast("boolean").alias("skip"),
        json_field("z_cfg", "beg").try_cast("date").alias("beg"),
        json_field("z_cfg", "end").try_cast("date").alias("end_day"),
        number("dots").alias("dots"),
        json_field("z_cfg", "zfr").try_cast("double").alias("zfr"),
        json_field("z_cfg", "zto").try_cast("double").alias("zto"),
    )


def choose_key_date(key_dates: str | Column, position: Column, as_of) -> Column:
    """The configured position, else the first non-null date not after today; at most today."""
    dates = F.col(key_dates) if isinstance(key_dates, str) else key_dates
    today = F.lit(as_of).cast("date")
    first = F.get(F.filter(dates, lambda d: d.isNotNull() & (d <= today)), F.lit(0))
    picked = F.when(
        position.isNull() | (F.size(dates) < position),
        F.coalesce(first, F.get(dates, F.size(dates) - 1)),
    ).otherwise(F.get(dates, position - 1))
    return F.least(picked, today)


def _candidates(loads: DataFrame, config: DataFrame, key_dates: str | Column, as_of) -> DataFrame:
    """Loads with the settings of their object and their key date; loads of inactive objects are left out."""
    none = F.array().cast("array<date>")
    joined = loads.join(_settings(config), F.col("object") == F.col("_object"), "left").where(F.coalesce("active", F.lit(True)))
    return joined.withColumns(
        {
            "key_date": choose_key_date(key_dates, F.col("cfg_key"), as_of),
            "z_except": F.coalesce("z_except", none),
            "z_error": F.coalesce("z_error", none),
        }
    ).drop("_object", "active", "cfg_key", "key_dates")


STATS = ("avg", "std", "cnt", "min", "max")
LIMITS = ("z_except", "z_error", "skip", "beg", "cfg_min", "cfg_max")


def _marked(points: DataFrame) -> DataFrame:
    """Add what a judged load may serve later ones as: ``last`` (the load to compare with) and ``base`` (a baseline value), NULL if
    it may not.  Both start with the rank among the loads of one key date, so the largest counts.  Needs the columns ``LIMITS``."""
    low = F.coalesce("cfg_min", F.lit(-(2**63 - 1)))
    high = F.coalesce("cfg_max", F.lit(2**63 - 1))
    good = ~(F.coalesce("skip", F.lit(True)) & (F.col("value") == 0)) & F.col("value").between(low, high)
    usable = ~F.array_contains("z_error", F.col("key_date")) & (F.col("key_date") >= F.coalesce("beg", F.lit(FIRST_DAY)))
    passed = F.coalesce("ztest", F.lit(True)) | F.array_contains("z_except", F.col("key_date"))
    rank = [F.col("ztest").isNull().alias("n"), F.col("ztest").alias("z"), F.col("ts").alias("t"), F.col("log_id").alias("l")]
    return points.withColumns(
        {
            "last": F.when(usable & (F.col("value").isNull() | good), F.struct(*rank, "key_date", "rows_count", *STATS)),
            "base": F.when(usable & good & passed, F.struct(*rank, "value")),
        }
    )


def _before(key: str) -> Column:
    return F.col(key) - F.coalesce("cfg_interval", F.lit("1 day")).cast("interval")


def _baseline(best: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per candidate the newest ``last`` and the moments of its newest ``dots`` baseline values; ``best`` has one row per key date."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col("key_date").desc())
    near = F.count("base").over(newest_first) <= F.coalesce("dots", F.lit(DOTS))
    used = F.when(F.col("_near"), F.col("base.value"))
    return best.withColumn("_near", near).groupBy(*[F.col(k).alias(f"_b_{k}") for k in keys]).agg(
        F.max_by("last", F.when(F.col("last").isNotNull(), F.col("key_date"))).alias("lst"),
        F.count(used).alias("_n"), F.sum(used.cast("double")).alias("_sum"), F.var_pop(used).alias("_var"),
        F.min(used).alias("_low"), F.max(used).alias("_high"),
    )


def _decided(cand: DataFrame, baseline: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates with score, statistics, verdict and message.  The candidate's own value counts among those of the baseline."""
    linked = cand.join(baseline, [F.col(k) == F.col(f"_b_{k}") for k in keys], "left").drop(*[f"_b_{k}" for k in keys])
    linked = linked.withColumn("key_diff", F.datediff("key_date", "lst.key_date"))
    linked = linked.withColumn("value", F.expr("(rows_count - lst.rows_count) div key_diff"))
    has, value, key_date = F.col("lst").isNotNull(), F.col("value"), F.col("key_date")
    count = F.col("_n") + value.isNotNull().cast("bigint")
    size = F.nullif(count, F.lit(0))
    apart = value - F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))
    # Variance of a set and one more value, from the moments of the set.
    squares = F.coalesce(F.col("_var") * F.col("_n"), F.lit(0.0)) + F.coalesce(apart * apart * F.col("_n") / size, F.lit(0.0))
    moments = {
        "avg": (F.coalesce("_sum", F.lit(0.0)) + F.coalesce(value, F.lit(0))) / size,
        "std": F.sqrt(squares / size),
        "cnt": count,
        "min": F.least("_low", value),
        "max": F.greatest("_high", value),
    }
    scored = linked.withColumns({name: F.when(has, c) for name, c in moments.items()}).withColumns(
        {
            "zscore": _score(value, F.col("avg"), F.col("std")),
            "stable": F.col("std") / F.nullif(F.col("avg"), F.lit(0.0)),
        }
    )
    z = F.col("zscore")
    within = [z.between(F.coalesce("zfr", F.lit(-k)), F.coalesce("zto", F.lit(k))) for k in (WIDE, NORMAL)]
    steps = [
        (F.array_contains("z_except", key_date), "Ok z_except", True),
        (F.array_contains("z_error", key_date), "No z_error", False),
        (key_date > F.col("end_day"), "Key_date > end", None),
        (key_date < F.col("beg"), "Key_date < beg", None),
        (~has, "Ok first", True),
        (value < F.col("cfg_min"), "No < min", False),
        (value > F.col("cfg_max"), "No > max", False),
        ((F.abs("stable") < STEADY) & within[0], "Ok", True),
        (within[1], "Ok", True),
    ]
    verdict, message = None, None
    for condition, text, ok in steps:
        flag = F.lit(ok).cast("boolean")
        verdict = F.when(condition, flag) if verdict is None else verdict.when(condition, flag)
        message = F.when(condition, text) if message is None else message.when(condition, text)
    judged = scored.withColumn("ztest", verdict.otherwise(F.lit(False))).withColumn("msg", message.otherwise("No"))
    restore = (F.col("ztest") == F.lit(False)) & has

    def kept(name):
        now = F.round(F.round(F.col(name), 9)).cast("bigint")  # binary noise must not decide a half
        return F.when(restore, F.col(f"lst.{name}").cast("bigint")).otherwise(now)

    return judged.withColumns({c: kept(c) for c in STATS})


def growth_verdicts(candidates: DataFrame, history: DataFrame, config: DataFrame, as_of) -> DataFrame:
    """Verdict on the row growth of every candidate load.

    ``candidates``: object, key_dates array<date>, rows_count, log_id, ts, one row per object.
    ``history``: object, key_date, rows_count, value, ztest boolean, ts, log_id and the stored
    avg, std, cnt, min, max.  Objects whose config is inactive are left out.

    The history is read once: a partial aggregate finds the best rows of every (object, date), the windows and
    the statistics run over one row per date.
    """
    cand = _candidates(candidates, config, "key_dates", as_of)
    limits = cand.select(
        F.col("object").alias("_o"), F.col("key_date").alias("_key"), "cfg_interval", "dots", *LIMITS,
        F.when(F.col("rows_count") <= F.col("hist"), F.col("hist")).otherwise(F.lit(2**63 - 1)).alias("row_max"),
        F.when(F.col("rows_count") > F.col("hist"), F.col("hist") + 1).otherwise(F.lit(0)).alias("row_min"),
    )
    rows = history.select("object", "key_date", "rows_count", "value", "ztest", "ts", "log_id", *STATS).join(
        limits, F.col("object") == F.col("_o")
    )
    near = rows.where(F.col("rows_count").between(F.col("row_min"), F.col("row_max")) & ((F.col("key_date") < F.col("_key")) | (F.col("key_date") <= _before("_key"))))
    marked = _marked(near).withColumns(
        {
            "last": F.when(F.col("key_date") <= _before("_key"), F.col("last")),
            "base": F.when(F.col("key_date") < F.col("_key"), F.col("base")),
        }
    ).where("last is not null or base is not null")
    best = marked.groupBy("object", "key_date", "dots").agg(F.max("last").alias("last"), F.max("base").alias("base"))
    judged = _decided(cand, _baseline(best, ["object"]), ["object"])
    return judged.select(
        "zscore", "ts", "object", "key_date", "rows_count", "key_diff", "value", *STATS,
        F.abs("log_id").alias("log_id"), "ztest", "back", "msg", "stable",
    )


def rejected_loads(verdicts: DataFrame) -> DataFrame:
    """Loads that must not be published: failed the test and configured for rollback."""
    return verdicts.where((F.col("ztest") == F.lit(False)) & F.col("back")).select(
        "object", "log_id", "key_date", F.concat(F.lit(f"{ROLLBACK_PREFIX} "), "msg").alias("error")
    )


def accepted(verdicts: DataFrame) -> bool:
    """Gate of a publish step: True when no load is rejected (an action that stops at the first)."""
    return rejected_loads(verdicts).isEmpty()


# --- recalculation -------------------------------------------------------------------------

VERDICT_SCHEMA = (
    "zscore double, ts timestamp, object string, key_date date, rows_count bigint, key_diff int, value bigint, "
    "avg bigint, std bigint, cnt bigint, min bigint, max bigint, log_id bigint, ztest boolean, msg string"
)


def recalculate(loads: DataFrame, history: DataFrame, config: DataFrame, since, as_of) -> DataFrame:
    """Re-judge the loads from ``since`` on in log order; every verdict feeds the next baseline.

    ``loads``: log_id, object, key_dates array<date>, rows_count, ts.  History rows before ``since``
    seed the state, later ones are dropped.  Rows of an object stream through one task in order;
    the state holds the rows of every key date.  History rows without a key date can be no baseline.
    For many objects with few loads each; ``recalculate_by_steps`` returns the same and splits an object with very many loads.
    """
    cfg = _settings(config)
    old = history.where((F.col("ts") < F.lit(since)) & F.col("key_date").isNotNull()).select(
        "object", F.lit(0).alias("step"), "log_id", "ts", "key_date", "rows_count", "value", "ztest", "avg", "std", "cnt", "min", "max",
    )
    judged = old.select(F.col("log_id").alias("_seen")).distinct()
    new = (
        loads.where((F.col("ts") >= F.lit(since)) & (F.col("rows_count") != 0))
        .join(judged, F.col("log_id") == F.col("_seen"), "left_anti")
        .join(cfg.select(F.col("_object").alias("_c"), "cfg_key"), F.col("object") == F.col("_c"), "left")
        .select(
            "object", F.lit(1).alias("step"), "log_id", "ts",
            choose_key_date(F.array_append("key_dates", F.to_date("ts")), F.col("cfg_key"), as_of).alias("key_date"),
            "rows_count",
            *[F.lit(None).cast(t).alias(n) for n, t in (("value", "bigint"), ("ztest", "boolean"), ("avg", "bigint"), ("std", "bigint"), ("cnt", "bigint"), ("min", "bigint"), ("max", "bigint"))],
        )
    )
    keyed = old.unionByName(new).join(cfg, F.col("object") == F.col("_object"), "left").where(
        F.coalesce("active", F.lit(True))
    )
    days = F.regexp_extract(F.col("cfg_interval"), r"(\d+)", 1).try_cast("int")
    ready = keyed.withColumn("gap_days", F.coalesce(days, F.lit(1))).drop("_object", "active", "back", "cfg_key", "cfg_interval")
    ordered = ready.repartition("object").sortWithinPartitions("object", "step", "log_id")
    return ordered.mapInPandas(_judge_in_order, VERDICT_SCHEMA)


def _judge_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    current, points = None, {}
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.object != current:
                current, points = row.object, {}
            if row.step == 0:
                _remember(points, row.key_date, (row.ztest, row.ts, row.log_id), row)
                continue
            verdict = _judge(row, points)
            out.append(verdict)
            _remember(points, row.key_date, (verdict["ztest"], row.ts, row.log_id), SimpleNamespace(**verdict))
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in VERDICT_SCHEMA.split(", ")])
        for c in ("key_diff", "value", "avg", "std", "cnt", "min", "max"):
            frame[c] = frame[c].astype("Int64")
        yield frame


def _remember(points, key_date, rank, row) -> None:
    points.setdefault(key_date, []).append((_rank(rank), row))


def _rank(rank):
    ztest, ts, log_id = rank
    missing = ztest is None or pd.isna(ztest)
    return (missing, False if missing else bool(ztest), ts, log_id)


def _judge(row, points) -> dict:
    def given(x):
        return x is not None and not (pd.api.types.is_scalar(x) and pd.isna(x))

    errors = set(row.z_error) if row.z_error is not None else set()
    excepts = set(row.z_except) if row.z_except is not None else set()
    skip = bool(row.skip) if given(row.skip) else True
    beg = row.beg if given(row.beg) else FIRST_DAY
    hist = row.hist if given(row.hist) else None
    row_max = hist if hist is not None and row.rows_count <= hist else float("inf")
    row_min = hist + 1 if hist is not None and row.rows_count > hist else 0
    low = row.cfg_min if given(row.cfg_min) else -float("inf")
    high = row.cfg_max if given(row.cfg_max) else float("inf")

    def usable(p):
        return p.key_date not in errors and p.key_date >= beg and row_min <= p.rows_count <= row_max

    def good_value(p):
        return given(p.value) and not (skip and p.value == 0) and low <= p.value <= high

    last_day = row.key_date - dt.timedelta(days=int(row.gap_days))
    last, base = None, []
    dots = int(row.dots) if given(row.dots) else DOTS
    for day in sorted(points, reverse=True):
        if day >= row.key_date:
            continue
        ranked = sorted(points[day], key=lambda p: p[0], reverse=True)
        if last is None and day <= last_day:
            last = next((p for _, p in ranked if usable(p) and (not given(p.value) or good_value(p))), None)
        if len(base) < dots:
            hit = next(
                (p for r, p in ranked if usable(p) and good_value(p) and (r[0] or r[1] or day in excepts)), None
            )
            if hit is not None:
                base.append(int(hit.value))
        elif last is not None:
            break
    out = dict.fromkeys(c.split()[0] for c in VERDICT_SCHEMA.split(", "))
    out.update(ts=row.ts, object=row.object, key_date=row.key_date, rows_count=row.rows_count, log_id=abs(row.log_id))
    z = stable = value = None
    if last is not None:
        gap = (row.key_date - last.key_date).days
        delta = int(row.rows_count) - int(last.rows_count)
        value = abs(delta) // gap * (1 if delta >= 0 else -1)
        sample = [*base, value]
        avg = sum(sample) / len(sample)
        std = math.sqrt(sum((x - avg) ** 2 for x in sample) / len(sample))
        z = (value - avg) / (std or 1.0)
        stable = std / avg if avg else None
        out.update(key_diff=gap, value=value, zscore=z, avg=_half_up(avg), std=_half_up(std), cnt=len(sample), min=min(sample), max=max(sample))

    def within(k):
        return (row.zfr if given(row.zfr) else -k) <= z <= (row.zto if given(row.zto) else k)

    if row.key_date in excepts:
        ok, msg = True, "Ok z_except"
    elif row.key_date in errors:
        ok, msg = False, "No z_error"
    elif given(row.end_day) and row.key_date > row.end_day:
        ok, msg = None, "Key_date > end"
    elif row.key_date < beg:
        ok, msg = None, "Key_date < beg"
    elif last is None:
        ok, msg = True, "Ok first"
    elif value < low:
        ok, msg = False, "No < min"
    elif value > high:
        ok, msg = False, "No > max"
    elif (stable is not None and abs(stable) < STEADY and within(WIDE)) or within(NORMAL):
        ok, msg = True, "Ok"
    else:
        ok, msg = False, "No"
    if ok is False and last is not None:
        out.update({c: (int(getattr(last, c)) if given(getattr(last, c)) else None) for c in ("avg", "std", "cnt", "min", "max")})
    out.update(ztest=ok, msg=msg)
    return out


def _half_up(x: float) -> int:
    return int(math.floor(round(abs(x), 9) + 0.5)) * (1 if x >= 0 else -1)


VERDICT = ("zscore", "ts", "object", "key_date", "rows_count", "key_diff", "value", *STATS, "log_id", "ztest", "msg")


def recalculate_by_steps(loads: DataFrame, history: DataFrame, config: DataFrame, since, as_of) -> DataFrame:
    """Re-judge the loads from ``since`` on in log order; every verdict feeds the next baseline.

    ``loads``: log_id, object, key_dates array<date>, rows_count, ts.  History rows before ``since``
    seed the state, later ones are dropped, as in ``recalculate``, with the same result.

    A load is compared with loads of earlier key dates that come before it in the log.  So the n-th key dates of all objects
    are judged together, in as many steps as an object has key dates, however many loads a date has.
    Each step is one plan without Python and is stored; it costs some seconds whatever its size.
    """
    spark = loads.sparkSession
    number = ("log_id", "rows_count", "value", *STATS)
    old = history.where((F.col("ts") < F.lit(since)) & F.col("key_date").isNotNull()).select(
        "object", "key_date", "ts", "ztest", *[F.col(c).cast("bigint").alias(c) for c in number]
    )
    judged = old.select(F.col("log_id").alias("_seen")).distinct()
    new = (
        loads.where((F.col("ts") >= F.lit(since)) & (F.col("rows_count") != 0))
        .join(judged, F.col("log_id") == F.col("_seen"), "left_anti")
        .select("object", "ts", F.col("log_id").cast("bigint").alias("log_id"), F.col("rows_count").cast("bigint").alias("rows_count"),
                F.array_append("key_dates", F.to_date("ts")).alias("key_dates"))
    )
    cand = _candidates(new, config, "key_dates", as_of).withColumn("side", _side())
    dates = cand.select(F.col("object").alias("_o"), F.col("key_date").alias("_d")).distinct()
    every = Window.partitionBy("_o")
    dates = dates.withColumns({"_step": F.row_number().over(every.orderBy("_d")), "_steps": F.count(F.lit(1)).over(every)})
    cand = store_rows(cand.join(dates, (F.col("object") == F.col("_o")) & (F.col("key_date") == F.col("_d"))).drop("_o", "_d"), new_folder(spark))
    limits = cand.groupBy(F.col("object").alias("_o")).agg(*[F.first(c).alias(c) for c in (*LIMITS, "hist", "_steps")])
    seeds = _marked(old.join(limits, F.col("object") == F.col("_o")).withColumn("side", _side()))
    # One row per object, key date and side of the row limit, before everything in the log.
    seeds = (
        seeds.where("rows_count >= 0 and (last is not null or base is not null)")
        .groupBy("object", "key_date", "side", "_steps")
        .agg(F.max("last").alias("last"), F.max("base").alias("base"))
    )
    folder = new_folder(spark)
    steps = cand.agg(F.max("_step")).first()[0] or 0
    known = _judged_step(cand.where("false"), None).withColumn("_seed", F.lit(False))
    state = store_rows(known.unionByName(seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True), folder)
    for step in range(1, steps + 1):
        judged = _judged_step(cand.where(F.col("_step") == step), state.where(F.col("_steps") >= step))
        state = store_rows(judged.withColumn("_seed", F.lit(False)), folder)
    return state.where(~F.col("_seed")).withColumn("log_id", F.abs("log_id")).select(*VERDICT)


def _side() -> Column:
    """1 up to the row limit ``hist``, 2 above it, 0 without one: a load is only compared with loads of its side."""
    return F.when(F.col("hist").isNull(), 0).when(F.col("rows_count") <= F.col("hist"), 1).otherwise(2)


def _judged_step(cand: DataFrame, state: DataFrame | None) -> DataFrame:
    """Verdicts of candidates that do not feed each other, with their own ``last`` and ``base``.

    Each candidate asks every earlier key date of its object once; the answer is the largest mark before it in the log, found by
    one running maximum per (object, key date, side), so no load meets all loads of its object.
    """
    keys = ["object", "side", "log_id"]
    if state is None:
        none = _marked(cand.withColumns({"value": F.lit(None).cast("bigint"), "ztest": F.lit(None).cast("boolean")} | {c: F.lit(None).cast("bigint") for c in STATS}))
        best = none.select(*keys, "key_date", "dots", "last", "base")
        return _marked(_decided(cand, _baseline(best, keys), keys)).select(*VERDICT, "side", "_steps", "last", "base")
    marks = state.where("_seed or (rows_count >= 0 and (last is not null or base is not null))").select(
        "object", "side", "key_date", F.when(~F.col("_seed"), F.col("log_id")).alias("_log"), "last", "base"
    )
    known = marks.select(F.col("object").alias("_o"), F.col("side").alias("_s"), F.col("key_date").alias("_d")).distinct()
    asks = cand.select(*keys, "key_date", _before("key_date").alias("_until"), "dots").distinct().join(
        known, (F.col("object") == F.col("_o")) & (F.col("side") == F.col("_s")) & (F.col("_d") < F.col("key_date"))
    ).select("object", "side", F.col("_d").alias("key_date"), "log_id", F.col("log_id").alias("_log"), "_until", "dots", F.lit(0).alias("_place"))
    both = marks.withColumn("_place", F.lit(1)).unionByName(asks, allowMissingColumns=True)
    so_far = Window.partitionBy("object", "key_date", "side").orderBy(F.col("_log").asc_nulls_first(), "_place").rowsBetween(Window.unboundedPreceding, 0)
    best = both.select(*both.columns[:4], "log_id", "_until", "dots", "_place", F.max("last").over(so_far).alias("last"), F.max("base").over(so_far).alias("base"))
    best = best.where("_place = 0").withColumn("last", F.when(F.col("key_date") <= F.col("_until"), F.col("last")))
    return _marked(_decided(cand, _baseline(best, keys), keys)).select(*VERDICT, "side", "_steps", "last", "base")


# --- configuration and view ----------------------------------------------------------------


def upsert_config(config: DataFrame, updates: DataFrame, order: str | None = None) -> DataFrame:
    """Merge settings by object; a NULL in ``updates`` keeps the old value.

    Of several updates of one object the last one by the column ``order`` that gives a setting counts for it, as if they
    were applied one after the other.  Without ``order`` an object must be updated once only; of more the largest value counts.
    """
    settings = [c for c in updates.columns if c not in ("object", order)]

    def newest(c):
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))) if order else F.max(c)

    new = updates.groupBy(F.col("object").alias("_n_object")).agg(*[newest(c).alias(f"_n_{c}") for c in settings])
    joined = config.join(new, F.col("object") == F.col("_n_object"), "full_outer")
    defaults = {
        "active": F.lit(True),
        "rollback": F.lit(False),
        "z_cfg": F.lit(None).cast("string"),
        "z_except": F.array().cast("array<date>"),
        "z_error": F.array().cast("array<date>"),
    }
    merged = [F.coalesce("object", "_n_object").alias("object")]
    for c, default in defaults.items():
        value = F.coalesce(F.col(f"_n_{c}"), F.col(c))
        merged.append(F.when(F.col("_n_object").isNull(), F.col(c)).otherwise(F.coalesce(value, default)).alias(c))
    return joined.select(*merged)


def toggle_dates(config: DataFrame, changes: DataFrame, column: str) -> DataFrame:
    """Add the dates of ``changes`` (object, day) to an array column, or remove those that are present.

    A date that is changed an even number of times stays as it is.  The arrays stay distinct, newest first."""
    odd = changes.groupBy(F.col("object").alias("_o"), "day").agg(F.count(F.lit(1)).alias("_n")).where("_n % 2 = 1")
    hit = odd.groupBy("_o").agg(F.collect_set("day").alias("_days"))
    dates = F.coalesce(F.col(column), F.array().cast("array<date>"))
    flipped = F.array_union(F.array_except(dates, F.col("_days")), F.array_except(F.col("_days"), dates))
    joined = config.join(hit, F.col("object") == F.col("_o"), "left")
    value = F.when(F.col("_days").isNotNull(), F.sort_array(flipped, asc=False)).otherwise(F.col(column))
    return joined.withColumn(column, value).select(*config.columns)


def verdict_view(data: DataFrame, config: DataFrame) -> DataFrame:
    """Stored verdicts with the active settings: effective ok flag, membership, confidence, stability."""
    cfg = config.where("active").select(
        F.col("object").alias("_o"), F.col("rollback").alias("error"), "z_cfg", "z_except", "z_error"
    )
    low = F.coalesce(json_field("z_cfg", "zfr").try_cast("double"), F.lit(-NORMAL))
    high = F.coalesce(json_field("z_cfg", "zto").try_cast("double"), F.lit(NORMAL))
    joined = data.join(cfg, F.col("object") == F.col("_o"), "left")
    return joined.select(
        "ts",
        "object",
        F.coalesce("ztest", F.col("zscore").between(low, high)).alias("ztest_ok"),
        F.array_contains("z_except", F.col("key_date")).alias("is_except"),
        F.array_contains("z_error", F.col("key_date")).alias("is_error"),
        F.coalesce(F.round(100 - 2 * F.abs("zscore")).cast("int"), F.lit(0)).alias("confidence"),
        (F.col("std") / F.nullif(F.col("avg"), F.lit(0))).alias("stable"),
        "zscore", "key_date", "rows_count", "key_diff", "value", "avg", "std", "cnt", "min", "max", "log_id", "error",
    )


def failing_rows(view: DataFrame, objects: Sequence[str] | None = None) -> DataFrame:
    """Rows of the view that fail the test."""
    rows = view.where((F.col("ztest_ok") == F.lit(False)) & ~F.coalesce("is_except", F.lit(False)))
    return rows.where(F.col("object").isin(*objects)) if objects else rows
