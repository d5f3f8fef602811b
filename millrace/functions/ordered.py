"""Order-dependent values without sending one key, or all rows, to a single task.

The per-key helpers cut every key into chunks (a monotone expression of the order, such as the day).  A
window runs inside (key, chunk).  What a chunk needs from its neighbours is one pre-aggregated row per
(key, chunk); it joins the chunk as an extra row, so the data is shuffled once and never joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.lineage import cut_lineage


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: dict[str, str],
    chunk: Column,
    ahead: bool = False,
) -> DataFrame:
    """Add ``fields`` {new name: source column} from the previous row of the key (next if ``ahead``).

    ``order`` must be unique within a key; ``chunk`` must not decrease along it.
    """
    row = F.struct(*dict.fromkeys(fields.values()))
    step, edge_of = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    cut = df.withColumn("_chunk", chunk)
    edges = cut.groupBy(*keys, "_chunk").agg(edge_of(row, F.struct(*order)).alias("_row"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    edges = edges.withColumn("_row", step("_row").over(across)).where("_row is not null")
    # The neighbour's edge row sorts before the chunk (after it when looking ahead).
    extra = edges.withColumn("_place", F.lit(2 if ahead else 0))
    both = cut.withColumns({"_row": row, "_place": F.lit(1)}).unionByName(extra, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_place", *order)
    found = both.withColumn("_found", step("_row").over(inside)).where("_place = 1")
    return found.select(*df.columns, *[F.col("_found").getField(src).alias(name) for name, src in fields.items()])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: dict[str, tuple[str, str]],
    chunk: Column,
    before_only: bool = False,
) -> DataFrame:
    """Running aggregates along ``order`` per key: {name: (kind, column)}, kind sum, max or count.

    ``before_only`` leaves the row itself out.
    """
    values = {
        f"_v_{name}": F.when(F.col(c).isNotNull(), F.lit(1)).cast("bigint") if kind == "count" else F.col(c)
        for name, (kind, c) in aggregates.items()
    }
    pick = {name: F.max if kind == "max" else F.sum for name, (kind, _) in aggregates.items()}
    cut = df.withColumns({"_chunk": chunk, **values})
    totals = cut.groupBy(*keys, "_chunk").agg(*[pick[n](f"_v_{n}").alias(f"_v_{n}") for n in aggregates])
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    extra = totals.withColumns({f"_v_{n}": pick[n](f"_v_{n}").over(across) for n in aggregates}).withColumn("_place", F.lit(0))
    both = cut.withColumn("_place", F.lit(1)).unionByName(extra, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_place", *order)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1 if before_only else 0)
    out = {n: pick[n](f"_v_{n}").over(inside) for n in aggregates}
    out = {n: F.coalesce(v, F.lit(0)) if aggregates[n][0] == "count" else v for n, v in out.items()}
    return both.withColumns(out).where("_place = 1").select(*df.columns, *aggregates)


@dataclass(frozen=True)
class RankedCounts:
    """``rows`` with a ``<weight>_before`` column per weight; ``totals`` over non-null values."""

    rows: DataFrame
    totals: dict[str, int]
    nulls: dict[str, int]


def quantile_chunk(df: DataFrame, value: str, buckets: int = 1024) -> Column:
    """A chunk number that does not decrease along ``value`` and splits the rows of ``df`` about evenly (one pass over ``df``)."""
    side = max(2, isqrt(buckets))
    splits = _splits(df, value, side)
    return _bucket_of(value, splits, side, df.schema[value].dataType.simpleString())


def _splits(df: DataFrame, value: str, side: int) -> list:
    points = [i / (side * side) for i in range(1, side * side)]
    return sorted(set(df.agg(F.percentile_approx(value, points, 10 * side * side)).first()[0] or ()))


def preceding_counts(counts: DataFrame, value: str, weights: Sequence[str], buckets: int = 1024) -> RankedCounts:
    """For one row per distinct ``value``: the sum of each weight over all smaller values, exactly.

    ``counts`` is checkpointed, because three passes read it: approximate quantiles cut the values
    into about equal buckets, one aggregate totals the buckets (at most ``buckets`` + 1 rows reach the
    driver), and a window inside each bucket finishes the sums.  NULL values rank after all others.
    """
    side = max(2, isqrt(buckets))
    stored = cut_lineage(counts)
    splits = _splits(stored, value, side)
    cut = stored.withColumn("_bucket", _bucket_of(value, splits, side, stored.schema[value].dataType.simpleString()))
    totals = {
        r["_bucket"]: r for r in cut.groupBy("_bucket").agg(*[F.sum(w).alias(w) for w in weights]).collect()
    }
    null_row = totals.pop(None, None)
    offsets = {w: [0] * (len(splits) + 2) for w in weights}
    for w in weights:
        for b in range(len(splits) + 1):
            offsets[w][b + 1] = offsets[w][b] + (totals[b][w] if b in totals else 0)
    overall = {w: offsets[w][-1] for w in weights}
    inside = Window.partitionBy("_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    before = {
        f"{w}_before": F.when(F.col(value).isNull(), F.lit(overall[w])).otherwise(
            F.coalesce(F.sum(w).over(inside), F.lit(0)) + F.get(_literal_array(offsets[w], "bigint"), F.col("_bucket"))
        )
        for w in weights
    }
    rows = cut.withColumns(before).drop("_bucket")
    return RankedCounts(rows, overall, {w: null_row[w] if null_row else 0 for w in weights})


def _bucket_of(value: str, splits: list, side: int, kind: str) -> Column:
    """Number of splits below the value, found in two steps of about ``side`` comparisons."""
    if not splits:
        return F.when(F.col(value).isNotNull(), F.lit(0))
    every = _literal_array(splits, kind)
    heads = _literal_array(splits[side - 1 :: side], kind)
    coarse = F.size(F.filter(heads, lambda s: s < F.col(value)))
    group = F.slice(every, coarse * side + 1, F.lit(side))
    found = coarse * side + F.size(F.filter(group, lambda s: s < F.col(value)))
    return F.when(F.col(value).isNotNull(), F.least(found, F.lit(len(splits))))


def _literal_array(values: list, kind: str) -> Column:
    """Constant array; one text literal instead of one expression per element."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")
