"""Row hashes, null-safe joins and newest-row aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELD_SEPARATOR = "\u0001"
NULL_MARKER = "\u0002"


def row_hash(columns: Iterable[Column | str], compat: bool = False) -> Column:
    """md5 over the text of ``columns``.

    The default separates fields and marks NULLs, so ('1', '23') and ('12', '3') differ.
    ``compat=True`` concatenates without separator and drops NULLs.
    """
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    if compat:
        return F.md5(F.concat_ws("", *texts))
    return F.md5(F.concat_ws(FIELD_SEPARATOR, *[F.coalesce(t, F.lit(NULL_MARKER)) for t in texts]))


def newest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: dict[str, Column] | None = None
) -> DataFrame:
    """One row per key: the newest by ``order``, plus the aggregates in ``carry``.

    A NULL counts as newest; the other columns break ties.  The whole row is one struct that starts with
    its ordering, so ``max`` picks it without a second copy of the ordering, and a partial aggregate
    runs before the shuffle: a key that holds a large share of the rows sends one row per map task.
    """
    carry = carry or {}
    rest = [c for c in df.columns if c not in keys and c not in order and c not in carry]
    position = [p for c in order if c not in keys for p in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    aggs = [F.max(F.struct(*position, *rest)).alias("_newest")] if position or rest else []
    aggs += [expr.alias(f"_carry_{name}") for name, expr in carry.items()]
    grouped = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    out = []
    for c in df.columns:
        if c in carry:
            out.append(F.col(f"_carry_{c}").alias(c))
        elif c in keys:
            out.append(F.col(c))
        else:
            out.append(F.col(f"_newest.{c}").alias(c))
    out += [F.col(f"_carry_{c}").alias(c) for c in carry if c not in df.columns]
    return grouped.select(*out)


def keep_matching(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (NULL keys match)."""
    return _key_filter(df, other, keys, "left_semi")


def drop_matching(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other`` (NULL keys match)."""
    return _key_filter(df, other, keys, "left_anti")


def _key_filter(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    wanted = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(wanted, condition, how)
