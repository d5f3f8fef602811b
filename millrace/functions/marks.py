"""Watermarks as literals, so that they reach the scan (row-group and partition pruning)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType


def span(df: DataFrame, column: str) -> tuple[Column | None, Column | None]:
    """Smallest and largest value of a column as typed literals, None for an empty frame.

    One row reaches the driver.  The values travel as text, so the time zone of the Python process
    plays no part."""
    kind = df.schema[column].dataType
    row = df.agg(F.min(column).cast("string"), F.max(column).cast("string")).first()
    return tuple(None if text is None else F.lit(text).cast(kind) for text in row)


def edge(df: DataFrame, column: str) -> Column | None:
    """Largest value of a column as a typed literal, None for an empty frame."""
    return span(df, column)[1]


def stored_span(spark: SparkSession, path: str, columns: Iterable[str]) -> tuple[int, dict[str, tuple[Column | None, Column | None]]]:
    """Number of rows of a Parquet table and the smallest and largest value of ``columns`` as typed literals.

    Whole numbers, dates and booleans come from the statistics in the file footers, without reading rows.  Footers
    hold texts cut short, times in forms that the reader does not aggregate, and no NaN: such columns are scanned,
    and so are files that carry no statistics."""
    table = footer_session(spark).read.parquet(path)
    kinds = {c: table.schema[c].dataType for c in columns}
    noted = [c for c, kind in kinds.items() if isinstance(kind, (IntegralType, DateType, BooleanType))]
    try:
        rows, found = _bounds(table, noted)
        others = [c for c in kinds if c not in noted]
        scanned = _bounds(spark.read.parquet(path), others)[1] if others else {}
        return rows, _literals({**found, **scanned}, kinds)
    except (PySparkException, Py4JJavaError):  # no statistics in some file
        rows, found = _bounds(spark.read.parquet(path), list(kinds))
        return rows, _literals(found, kinds)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet reader answers bare aggregates from file footers; ``spark`` keeps its own settings."""
    footers = spark.newSession()
    footers.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers


def bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``rows`` and, as text, ``low<i>`` and ``high<i>`` of the i-th column."""
    # Bare aggregates, cast afterwards: a cast inside would keep them from the footers.
    bare = [f(F.col(c)).alias(f"{side}{i}") for i, c in enumerate(columns) for side, f in (("low", F.min), ("high", F.max))]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *bare)
    return row.select("rows", *[F.col(c).cast("string").alias(c) for c in row.columns[1:]])


def _bounds(df: DataFrame, columns: list[str]) -> tuple[int, dict[str, tuple]]:
    row = bounds(df, columns).first()
    # Pushed counts are summed, which gives NULL for a folder without files.
    return row["rows"] or 0, {c: (row[f"low{i}"], row[f"high{i}"]) for i, c in enumerate(columns)}


def _literals(found: dict[str, tuple], kinds: dict) -> dict[str, tuple[Column | None, Column | None]]:
    return {c: tuple(None if text is None else F.lit(text).cast(kinds[c]) for text in found[c]) for c in kinds}


def stored_edge(spark: SparkSession, path: str, column: str) -> Column | None:
    """Largest value of a column of a Parquet table as a typed literal, None for an empty table; see ``stored_span``."""
    return stored_span(spark, path, [column])[1][column][1]


def above(df: DataFrame, column: str, mark: Column | None, inclusive: bool = False) -> DataFrame:
    """Rows above (or at) a mark; all rows when there is no mark."""
    if mark is None:
        return df
    return df.where(F.col(column) >= mark if inclusive else F.col(column) > mark)


def on_days(column: Column, days: Iterable[dt.date | None]) -> Column:
    """The day of ``column`` is one of ``days``, written as ranges that a scan can use."""
    day = column.cast("date")
    ranges = [day.between(F.lit(d), F.lit(d)) for d in days if d is not None]
    return reduce(lambda a, b: a | b, ranges)
