"""Typed ingest of raw text exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.marks import span

EMPTY_DATES = ("", " ", "00000000", "0000-00-00")  # fixed values
TRUE_FLAGS = ("X", "1")  # fixed values
EXPORT_ID, PERIOD, BATCH_ID = "hexportid", "hexpperio", "ctl_loading"  # fixed column names


def read_export(spark: SparkSession, path: str, kind: str, schema: T.StructType, **options) -> DataFrame:
    """Raw export files (parquet, csv, json, orc, text) with a declared schema, never inferred."""
    return spark.read.format(kind).schema(schema).options(**options).load(path)


def typed_column(
    source: T.StructField, target: T.StructField, export_id: str = EXPORT_ID, period: str = PERIOD
) -> Column:
    """Cast rule of one column, chosen by its name and the two types."""
    value = F.col(source.name)
    is_text = isinstance(source.dataType, T.StringType)
    to_date = isinstance(target.dataType, T.DateType)
    if source.name == export_id:
        text = F.nullif(F.nullif(value, F.lit("")), F.lit("0"))
        out = F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))
    elif source.name == period and to_date:
        out = F.try_to_date(F.right(value, F.lit(8)), "yyyyMMdd")
    elif is_text and to_date:
        text = F.when(~value.isin(*EMPTY_DATES), value)
        out = F.coalesce(F.try_to_date(text, "yyyyMMdd"), text.try_cast("date"))
    elif is_text and isinstance(target.dataType, T.BooleanType):
        out = value.isin(*TRUE_FLAGS)
    elif is_text:
        out = F.when(~value.isin("", " "), value)
        if not isinstance(target.dataType, T.StringType):
            return F.trim(out).try_cast(target.dataType).alias(target.name)
    else:
        out = value
    return out.cast(target.dataType).alias(target.name)


def typed_ingest(
    sources: DataFrame | Sequence[DataFrame],
    target: T.StructType,
    above: int | Column | None = None,
    batch_id: str = BATCH_ID,
    inclusive: bool = False,
    backfill: bool = False,
) -> DataFrame:
    """Raw text frames to the target schema, matched by position; rows above the watermark only.

    The watermark is tested on the raw batch id, so it reaches the scan.  ``backfill`` negates the
    batch id, so backfilled rows sort below live ones.
    """
    frames = [sources] if isinstance(sources, DataFrame) else list(sources)
    out = []
    for df in frames:
        rows = df
        if above is not None:
            mark = above if isinstance(above, Column) else F.lit(above)
            rows = df.where(F.col(batch_id) >= mark if inclusive else F.col(batch_id) > mark)
        columns = [
            (-F.col(s.name)).cast(t.dataType).alias(t.name) if backfill and s.name == batch_id else typed_column(s, t)
            for s, t in zip(df.schema.fields, target.fields, strict=True)
        ]
        out.append(rows.select(*columns))
    return reduce(DataFrame.unionByName, out)


def backfill_mark(target: DataFrame, from_id: int | None, batch_id: str = BATCH_ID) -> Column:
    """Inclusive watermark of a restart: None = the target's largest id, -1 = below its smallest
    (negated) id, less than -1 = that id from the raw side, otherwise ``from_id`` itself."""
    if from_id is None:
        high = span(target, batch_id)[1]
        return F.lit(0) if high is None else high
    if from_id == -1:
        low = span(target, batch_id)[0]
        return F.lit(0) if low is None else -low
    return F.lit(-from_id - 1 if from_id < -1 else from_id - 1)
