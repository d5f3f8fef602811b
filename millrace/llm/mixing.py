"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; the documents of a source share one expected number of copies,
target / size of the source.  Its whole part is taken by all of them.  The fractional parts are rounded in pairs: a
random amount of word mass moves from one document to the other until one of the two probabilities is 0 or 1, so each
document keeps its probability and the words of the pair stay what they were.  Groups of bounded size do this on their
own and leave one undecided document each; these meet in a tree of further groups until one is left per source, which
is rounded on its own.  The words of a source so miss the target by less than one document.

All random numbers are hashes of the two documents, groups are made by hash and sorted, so reruns agree however the
table is cut into partitions.

Defined cases: sources are ordered by code point, null last, and weigh as ``weights`` says, over and over; a null text
has size 0; documents of size 0 take nothing; a source of size 0 has target 0; repeated rows are mixed one by one;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.storage import stored

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
PER_GROUP = 2048
FAN_IN = 256
SEED = 20240607


def _row_hash(text_col: str, source_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(source_col).cast("string")).alias("_th")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, hash of text and source, source and size in words of every row."""
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row_hash(text_col, source_col), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            counts = [len(t.encode("utf-8", "surrogatepass").split()) if t else 0 for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64())], names=["doc_id", "_th", "source", "size"])

    return kept.mapInArrow(run, "doc_id long, _th long, source string, size long")


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, docs, source_size and target: one row per source.

    The targets share the sum of all sizes by weight; none exceeds ``max_copies`` times its source's size.  In the
    order of cap per weight the capped sources come first, so one running sum finds them all.  The windows run over
    one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    nth = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
    order = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    per = per.withColumn("full", F.col("cap") * weight_left <= left * F.col("w"))
    capped = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(whole)
    free = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(whole)
    share = (F.sum("source_size").over(whole) - capped) * F.col("w") / F.when(free > 0, free)
    return per.select("source", "docs", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(share).alias("target"))


def _chance(*parts) -> float:
    return xxhash.xxh64_intdigest(repr(parts), SEED) / 2.0**64


def pivot(one: tuple, other: tuple, chance: float) -> tuple[float, float]:
    """New probabilities of two (probability, size) documents; one of them is 0 or 1 and the word mass is kept."""
    (p, a), (q, b) = one, other
    up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
    if chance * (up + down) < down:  # mass moves to the first with chance down / (up + down): probabilities keep their mean
        return (1.0, min(1.0, max(0.0, q - up / b))) if (1 - p) * a <= q * b else (p + up / a, 0.0)
    return (0.0, min(1.0, max(0.0, q + down / b))) if p * a <= (1 - q) * b else (p - down / a, 1.0)


_STATE = "doc_id long, _th long, source string, size long, source_size long, target double, whole long, p double, grp long"


def _pair_up(last: bool):
    """Round the probabilities of one group; one document may stay undecided unless it is the last one of its source."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("_th", "ascending")])
        ids, hashes = table.column("doc_id").to_pylist(), table.column("_th").to_pylist()
        size, p = table.column("size").to_pylist(), table.column("p").to_pylist()
        held = None
        for i in sorted(range(len(p)), key=lambda i: _chance(ids[i], hashes[i])):
            if not 0.0 < p[i] < 1.0:
                continue
            if held is not None:
                p[held], p[i] = pivot((p[held], size[held]), (p[i], size[i]), _chance(ids[held], hashes[held], ids[i], hashes[i]))
            held = i if 0.0 < p[i] < 1.0 else held if held is not None and 0.0 < p[held] < 1.0 else None
        if last and held is not None:
            p[held] = float(_chance(ids[held], hashes[held], "last") < p[held])
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))

    return run


def mix(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES, per_group: int = PER_GROUP) -> DataFrame:
    """doc_id, _th, size, source, source_size, target, ``copies`` and ``taken`` words for every row of :func:`sizes`."""
    per = stored(targets(sized, weights, max_copies))
    right = per.select(F.col("source").alias("_source"), "docs", "source_size", "target")
    rows = sized.join(right, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    expected = F.when(F.col("size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0)
    whole = F.floor(expected).cast("long")
    groups = F.greatest(F.lit(1), F.ceil(F.col("docs") / per_group))
    rows = rows.withColumns({"whole": whole, "p": expected - whole, "grp": F.pmod(F.xxhash64("doc_id", "_th"), groups).cast("long")})
    names = [c.split()[0] for c in _STATE.split(", ")]
    state = rows.select(*names)
    most = per.agg(F.max("docs")).first()[0] or 1
    groups_left = max(1, -(-most // per_group))
    done = None
    while True:
        state = stored(state.groupBy("source", "grp").applyInArrow(_pair_up(groups_left == 1), _STATE))
        open_rows = (F.col("p") > 0) & (F.col("p") < 1)
        settled = state if groups_left == 1 else state.where(~open_rows)
        done = settled if done is None else done.union(settled)
        if groups_left == 1:
            copies = F.col("whole") + F.round("p").cast("long")
            return done.select("doc_id", "_th", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
        groups_left = -(-groups_left // FAN_IN)
        state = state.where(open_rows).withColumn("grp", F.floor(F.col("grp") / FAN_IN).cast("long"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document with the words that the mix takes of it."""
    mixed = mix(stored(sizes(docs, id_col, text_col, source_col)), weights, max_copies)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The mixed table itself: every row as often as the mix takes it.

    Rows of the same id, text and source are one document that stands for the copies of all of them.
    """
    mixed = mix(stored(sizes(docs, id_col, text_col, source_col)), weights, max_copies)
    keys = [F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("_th")]
    copies = mixed.groupBy(*keys).agg(F.sum("copies").alias("copies"))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("_id")
    keyed = docs.select(F.struct("*").alias("row"), key, _row_hash(text_col, source_col))
    once = W.partitionBy("_id", "_th").orderBy("_th")
    joined = keyed.join(copies, ["_id", "_th"]).withColumn("nth", F.row_number().over(once)).where("nth = 1")
    again = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return joined.select("row", again.alias("again")).select("row.*")
