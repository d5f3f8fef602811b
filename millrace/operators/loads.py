"""Loaders: every function returns the new content of the target (or the rows to append)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import drop_matching, keep_matching, newest_per_key, row_hash
from millrace.functions.lineage import cut_lineage
from millrace.functions.marks import above, edge, span
from millrace.functions.ordered import previous_row
from millrace.functions.parsing import json_field
from millrace.operators.anomaly import daily_points, rolling_z


@dataclass(frozen=True)
class LoadConfig:
    """One row of the load configuration."""

    mode: str  # TRUNCATE, UPDATE, INSERT or EXCEPT
    key: str | None = None
    fields: Sequence[str] | None = None  # select expressions over the source
    distinct: bool = False
    source_sql: str | None = None  # sub-query over {source}
    except_fields: Sequence[str] | None = None


def configured_load(source: DataFrame, target: DataFrame, config: LoadConfig) -> DataFrame:
    """New target content under the configured mode."""
    rows = configured_rows(source, config)
    match config.mode.upper():
        case "TRUNCATE":
            return rows
        case "UPDATE":
            return replace_keys(rows, target, source, config.key)
        case "INSERT":
            return target.unionByName(rows)
        case "EXCEPT":
            return target.unionByName(new_rows_only(rows, target, config.except_fields))
    raise ValueError(f"unknown load mode {config.mode}")


def configured_rows(source: DataFrame, config: LoadConfig) -> DataFrame:
    """Sub-query, projection and distinct of the configuration over the source."""
    rows = source
    if config.source_sql:
        rows = source.sparkSession.sql(config.source_sql, source=source)
    if config.fields:
        rows = rows.selectExpr(*config.fields)
    return rows.distinct() if config.distinct else rows


def rows_to_append(source: DataFrame, target: DataFrame, config: LoadConfig) -> DataFrame:
    """Only the rows that an INSERT or EXCEPT load adds, for a sink that appends."""
    rows = configured_rows(source, config)
    if config.mode.upper() == "INSERT":
        return rows
    if config.mode.upper() == "EXCEPT":
        return new_rows_only(rows, target, config.except_fields)
    raise ValueError(f"mode {config.mode} rewrites the target")


def replace_keys(rows: DataFrame, target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Drop target rows whose key occurs in the source, then add ``rows``.

    The keys are reduced to a distinct set before the join, and a NULL key never matches.
    """
    keys = source.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    kept = target.join(keys, F.col(key) == F.col("_key"), "left_anti")
    return kept.unionByName(rows)


def new_rows_only(rows: DataFrame, target: DataFrame, except_fields: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows that the target does not hold yet."""
    side = target.selectExpr(*except_fields) if except_fields else target.select(*rows.columns)
    return rows.subtract(side)


def hash_history_merge(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    technical: Sequence[str] = ("load_date",),
    mod_date: str = "mod_date",
    hash_name: str = "hash",
    compat_hash: bool = False,
    touch_only_matching: bool = False,
) -> DataFrame:
    """Row-hash history: one row per (key, hash), newest by ``order``, with the first-seen date.

    ``new`` has no hash; it is computed over everything but order, technical and date columns.
    With ``touch_only_matching`` unmatched old rows pass through without entering the
    aggregate: if the batch is small Spark broadcasts its keys and the history is not shuffled.
    """
    skip = {mod_date, hash_name, *technical, *order}
    hashed = [c for c in new.columns if c not in skip]
    batch = new.withColumn(hash_name, row_hash(hashed, compat_hash))
    return _first_seen_merge(batch, old, keys, order, mod_date, hash_name, touch_only_matching)


def _first_seen_merge(batch, old, keys, order, mod_date, hash_name, touch_only_matching):
    identity = [*keys, hash_name]
    before = old.select(*batch.columns)
    if not touch_only_matching:
        both = batch.unionByName(before)
        return newest_per_key(both, identity, order, {mod_date: F.min(mod_date)})
    both = batch.unionByName(keep_matching(before, batch, identity))
    merged = newest_per_key(both, identity, order, {mod_date: F.min(mod_date)})
    return merged.unionByName(drop_matching(before, batch, identity))


def raw_to_history(
    raw: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    key_date: str,
    not_hashed: Sequence[str] = (),
    compat_hash: bool = False,
    add_valid_to: bool = False,
) -> DataFrame:
    """Merge a raw (or stage) table into its version history.

    ``mod_date`` of a version is the first ``key_date`` it was seen on; the stored row is the
    one with the newest ``key_date``.  ``add_valid_to`` adds the day before the next version.
    """
    skip = {key_date, "mod_date", "hash", *not_hashed}
    hashed = [c for c in raw.columns if c not in skip]
    batch = raw.withColumn("mod_date", F.col(key_date)).withColumn("hash", row_hash(hashed, compat_hash))
    order = [key_date, *[c for c in not_hashed if c != key_date]]
    merged = _first_seen_merge(batch, history, keys, order, "mod_date", "hash", False)
    if not add_valid_to:
        return merged
    linked = previous_row(merged, keys, ["mod_date", "hash"], {"_next": "mod_date"}, F.to_date("mod_date"), ahead=True)
    return linked.withColumn("valid_to", F.date_sub("_next", 1)).drop("_next")


def snapshot_replace(
    new: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    partition_column: str,
    order: Sequence[str] = ("actual_date", "ctl_loading", "load_date"),
    limiter: tuple[str, str] | None = ("report_date", "actual_date"),
) -> DataFrame:
    """Replace whole partition values by the newest row per key, keeping first-seen dates.

    ``new`` and ``target`` carry ``hash`` and ``mod_date``.  Old rows with a matching key take
    part in the choice; all target rows of an affected partition value go away, so a key
    that the batch does not hold vanishes from it.  ``limiter=(g, d)`` keeps only rows at the
    largest ``d`` of each ``g``.
    """
    return target_without(new, target, keys, partition_column).unionByName(
        snapshot_rows(new, target, keys, partition_column, order, limiter)
    )


def snapshot_rows(
    new: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    partition_column: str,
    order: Sequence[str] = ("actual_date", "ctl_loading", "load_date"),
    limiter: tuple[str, str] | None = ("report_date", "actual_date"),
) -> DataFrame:
    """The rows a snapshot replace inserts: the content of the affected partition values.

    With the partition column among the keys only the target partitions that the batch names are read (beyond
    ``PRUNED`` of them those between its first and last value), and ``replace_partitions`` can publish this
    frame alone."""
    old = target
    if partition_column in keys:
        old = target.where(_partitions_of(new, partition_column))
    staged = new.unionByName(keep_matching(old, new, keys).select(*new.columns))
    versions = newest_per_key(staged, [*keys, "hash"], order, {"mod_date": F.min("mod_date")})
    rows = newest_per_key(versions, keys, order).select(*new.columns)
    if limiter is None:
        return rows
    group, day = limiter
    tops = staged.groupBy(F.col(group).alias("_g")).agg(F.max(day).alias("_d"))
    return rows.join(tops, (F.col(group) == F.col("_g")) & (F.col(day) == F.col("_d")), "left_semi")


PRUNED = 1000


def _partitions_of(new: DataFrame, column: str) -> Column:
    """Literal filter on the partitions of a batch; it only spares reading, the join by keys decides."""
    named = [r[0] for r in new.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).distinct().limit(PRUNED + 1).collect()]
    if len(named) <= PRUNED:
        return F.col(column).isin([F.lit(v).cast(new.schema[column].dataType) for v in named]) | F.col(column).isNull()
    low, high = span(new, column)
    return F.col(column).between(low, high) | F.col(column).isNull()


def target_without(new, target, keys, partition_column) -> DataFrame:
    """Target rows outside the partition values that a snapshot replace rewrites."""
    touched = new.select(partition_column)
    if partition_column not in keys:
        touched = touched.unionByName(keep_matching(target, new, keys).select(partition_column))
    values = touched.where(F.col(partition_column).isNotNull()).distinct()
    values = values.withColumnRenamed(partition_column, "_value")
    return target.join(values, F.col(partition_column) == F.col("_value"), "left_anti")


def refresh_mart(
    source: DataFrame,
    mart: DataFrame,
    template: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    partition_column: str,
    watermark: str = "actual_date",
    inclusive: bool = True,
    order: Sequence[str] = ("actual_date", "load_date"),
    limiter: tuple[str, str] | None = ("report_date", "actual_date"),
) -> DataFrame:
    """Re-run ``template`` on the source slices at or after the mart's watermark and merge them.

    All changed days go through one plan; there is no loop over days.
    """
    changed = changed_slices(source, mart, watermark, inclusive)
    # The rendered slices are read by the key match, the merge and the partition list: store them once.
    return snapshot_replace(cut_lineage(template(changed)), mart, keys, partition_column, order, limiter)


def refresh_scores(
    refreshed: DataFrame, changed: DataFrame, stored: DataFrame, object_name: str, partition_column: str, calc_dt
) -> DataFrame:
    """Closing test of a mart refresh: scores of the mart's daily row counts between the first and the last value of
    ``partition_column`` in the changed source rows.  ``stored`` holds earlier counts (object, day, calc_dt, value); mean and
    deviation run over all known days.  No changed rows, no scores."""
    low, high = changed.agg(F.min(partition_column).cast("date"), F.max(partition_column).cast("date")).first()
    touched = refreshed.where(F.col(partition_column).cast("date").between(F.lit(low).cast("date"), F.lit(high).cast("date")))
    fresh = daily_points(touched, F.lit(object_name), partition_column, "count(1)", calc_dt)
    return rolling_z(fresh, stored.where(F.col("object") == object_name), low, high, 0)


def changed_slices(
    source: DataFrame, mart: DataFrame, watermark: str, inclusive: bool = True, mark: Column | None = None
) -> DataFrame:
    """Source rows at or after the largest watermark of the mart (all rows if it is empty).

    ``mark``: that watermark if it is known, as ``marks.stored_edge`` reads it from the files of a stored mart."""
    return above(source, watermark, edge(mart, watermark) if mark is None else mark, inclusive)


def cast_to(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns of ``like`` taken from ``df`` with the types of ``like``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def append_above_mark(
    source: DataFrame, target: DataFrame, key: str, where: Column | str | None = None, mark: Column | None = None
) -> DataFrame:
    """Source rows with a key above the target's largest (``mark`` if it is known), cast to the target's types."""
    rows = above(source, key, edge(target, key) if mark is None else mark)
    if where is not None:
        rows = rows.where(where)
    return cast_to(rows, target)


def resume_mark(runs: DataFrame, workflow: str, target: DataFrame, key: str) -> DataFrame:
    """Where to resume: the ``lid`` in the message of the newest successful run, or -1 if that message only has
    a date; the target's largest key when there is no such run or its message has neither; -1 for an empty target.
    ``runs`` has workflow, start_id, end_action, message."""
    last = runs.where((F.col("workflow") == workflow) & (F.col("end_action") == "end")).agg(
        F.max_by(
            F.struct(json_field("message", "lid").try_cast("bigint").alias("lid"), json_field("message", "dt").try_cast("timestamp").alias("dt")),
            "start_id",
        ).alias("run")
    )
    top = target.agg(F.max(key).cast("bigint")).scalar()
    told = F.col("run.lid").isNotNull() | F.col("run.dt").isNotNull()
    return last.select(F.coalesce(F.when(told, F.col("run.lid")).otherwise(top), F.lit(-1)).alias("mark"))


def load_from_run_log(source: DataFrame, runs: DataFrame, workflow: str, target: DataFrame, key: str) -> DataFrame:
    """Source rows above the resume mark of the run log."""
    mark = resume_mark(runs, workflow, target, key).first()["mark"]
    return above(source, key, F.lit(mark))


def resume_key(
    errors: DataFrame, table: str, raw: DataFrame, target: DataFrame, key: str
) -> DataFrame:
    """One row (rolled_back, lid): after an anomaly rollback of ``table`` restart from the raw
    layer's smallest key, otherwise from the target's largest.

    ``errors`` has start_id, end_action, message and detail (JSON text with ``object``)."""
    named = F.coalesce(json_field("detail", "object"), F.col("message"))
    hit = errors.where(
        (named == table) & (F.col("end_action") == "error") & F.col("message").startswith("Ztest error")
    ).agg((F.count(F.lit(1)) > 0).alias("rolled_back"))
    low = raw.agg(F.coalesce(F.min(key), F.lit(0)).cast("bigint")).scalar()
    top = target.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()
    return hit.select("rolled_back", F.when(F.col("rolled_back"), low).otherwise(top).alias("lid"))


def full_reload_if_changed(
    source: DataFrame, target: DataFrame, where: Column | str | None = None, detect_deletes: bool = False
) -> tuple[str, DataFrame]:
    """('Ok', new content) if some incoming row is unknown to the target, else ('No New data', target).

    Runs one probe that stops at the first unknown row."""
    rows = cast_to(source, target)
    if where is not None:
        rows = rows.where(where)
    if rows.isEmpty():
        return "No data", target
    changed = not unknown_rows(rows, target).isEmpty()
    if not changed and detect_deletes:
        changed = not unknown_rows(target, rows).isEmpty()
    return ("Ok", rows) if changed else ("No New data", target)


def unknown_rows(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows whose hash the target does not hold."""
    held = target.select(row_hash(rows.columns).alias("_held")).distinct()
    return rows.withColumn("_hash", row_hash(rows.columns)).join(
        held, F.col("_hash") == F.col("_held"), "left_anti"
    ).drop("_hash")


def reload_newer(raw: DataFrame, target: DataFrame, key: str | None = None) -> tuple[str, DataFrame]:
    """Replace the target by the raw rows newer than its largest key.

    Status is 'No data', 'No New data' or 'Ok'; only the increment is kept."""
    if raw.isEmpty():
        return "No data", target
    rows = newer_rows(raw, target, key)
    if rows.isEmpty():
        return "No New data", target
    return "Ok", cast_to(rows, target)


def newer_rows(raw: DataFrame, target: DataFrame, key: str | None = None, mark: Column | None = None) -> DataFrame:
    """Rows of ``raw`` with a key above the target's largest (``mark`` if it is known); all rows without a key."""
    return raw if key is None else above(raw, key, edge(target, key) if mark is None else mark)


def date_range_replace(
    batch: DataFrame, target: DataFrame, day: str, valid_from: str | None = None, id_column: str | None = None
) -> DataFrame:
    """Drop the target rows between the batch's first and last day, then add the batch.

    Batch rows need ``day < valid_from`` and an id other than -1."""
    rows = batch
    if valid_from:
        rows = rows.where(F.col(day) < F.col(valid_from))
    if id_column:
        rows = rows.where(F.col(id_column) != -1)
    low, high = span(batch, day)
    kept = target
    if low is not None:
        kept = target.where((F.col(day) < low) | (F.col(day) > high) | F.col(day).isNull())
    return kept.unionByName(rows.select(*target.columns))


def rename_and_cast(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Projection load: {target: (source, type)}; a date is taken from the first ten characters."""
    out = []
    for target, (source, kind) in mapping.items():
        value = F.col(source)
        if kind == "date":
            value = F.try_to_date(F.left(value.cast("string"), F.lit(10)), "yyyy-MM-dd")
        else:
            value = value.try_cast(kind)
        out.append(value.alias(target))
    return df.select(*out)


def poll_marks(marks: DataFrame, sources: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Newest value per (source, field) against the last one seen, both as text, with the type of the field.

    ``marks`` (source, field, value, ts) is the append-only log of seen values, kept as text; a value is
    compared in the type of its field.  Output: old and new value and whether it moved.  One mark per polled
    source reaches the driver, and only rows above it are scanned."""
    seen = newest_per_key(marks.select("source", "field", "ts", "value"), ["source", "field"], ["ts"])
    polled = [(F.col("source") == name) & (F.col("field") == field) for name, field, _ in sources]
    last = {(r["source"], r["field"]): r["value"] for r in seen.where(reduce(lambda a, b: a | b, polled)).collect()}
    frames = []
    for name, field, df in sources:
        old, kind = last.get((name, field)), df.schema[field].dataType
        moved = above(df, field, None if old is None else F.lit(old).cast(kind)).agg(F.max(field).cast("string").alias("new_value"))
        frames.append(
            moved.select(
                F.lit(name).alias("source"), F.lit(field).alias("field"), F.lit(kind.simpleString()).alias("type"),
                F.lit(old).cast("string").alias("old_value"), "new_value",
            )
        )
    return reduce(DataFrame.union, frames).select(
        "source",
        "field",
        "type",
        "old_value",
        F.coalesce("new_value", "old_value").alias("new_value"),
        F.col("new_value").isNotNull().alias("changed"),
    )


def append_changed_versions(
    incoming: DataFrame, stored: DataFrame, keys: Sequence[str], value: str, ts: str, always: Column | None = None
) -> DataFrame:
    """Incoming rows whose value differs from the newest stored version of the key.

    Rows with a NULL key are skipped; rows for which ``always`` holds are appended whatever is stored."""
    latest = newest_per_key(stored.select(*keys, ts, value), keys, [ts]).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col(value).alias("_v")
    )
    same = F.col(value) == F.col("_v")
    named = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
        named = named & F.col(k).isNotNull()
    if always is None:
        return incoming.where(named).join(latest, same, "left_anti")
    free = F.coalesce(always, F.lit(False))
    changed = incoming.where(named & ~free).join(latest, same, "left_anti")
    return changed.unionByName(incoming.where(free))


def incremental_extract(
    rows: DataFrame,
    ts: str,
    confirmed: DataFrame,
    retry: DataFrame,
    as_of,
    max_dates: int | None = None,
) -> DataFrame:
    """Rows of the dates still to be exported, each as JSON with its increment key.

    Dates are those of rows later than midnight of the last confirmed date, or later than yesterday's midnight;
    all dates when nothing is confirmed; plus the dates in ``retry`` (column day).  With ``max_dates`` the
    first of them in date order go out in this batch, the others in the next one."""
    last = confirmed.agg(F.max("day").cast("date").cast("timestamp")).scalar()
    day = F.col(ts).cast("date")
    yesterday = F.date_sub(F.lit(as_of).cast("date"), 1).cast("timestamp")
    fresh = rows.where(last.isNull() | (F.col(ts) > last) | (F.col(ts) > yesterday)).select(day.alias("_day"))
    dates = fresh.distinct().union(retry.select(F.col("day").cast("date").alias("_day"))).distinct()
    if max_dates is not None:
        dates = dates.orderBy("_day").limit(max_dates)
    return rows.join(dates, day == F.col("_day"), "left_semi").select(
        F.date_format(day, "yyyyMMdd").alias("increment_key"),
        F.to_json(F.struct(*rows.columns)).alias("payload"),
    )
