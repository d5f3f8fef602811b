"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has one bit per position of the 64-bit hashes of the word shingles of a text: set if it is set in more
than half of them.  Two fingerprints that differ in at most ``2 * h`` bits have a point that differs from each in at
most ``h``; so every distinct fingerprint emits all its variants within ``h`` bits, and fingerprints that meet on a
variant are the colliding pairs.  All that meet on one variant lie within ``2 * h`` bits of each other, so linking
each of them to the smallest one keeps every component; the bit distance of each link is verified all the same.

A variant can meet only fingerprints of its own ball (65 for ``h`` = 1), so no bucket grows with the data, and equal
fingerprints are one node however many documents share it.

Defined cases: a null or empty text has no words and fingerprint zero, which links like any other; fewer words than a
shingle make one shingle of all words; repeated rows each get a result row; a component whose ids are all null has a
null ``component_id``; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from xxhash import xxh64_intdigest

from millrace.llm.components import connected
from millrace.llm.storage import row_key, stored

SEED = 42
BITS = 64
_CHUNK = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    """Fingerprint of one text as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(spans), _CHUNK):
        part = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in spans[at : at + _CHUNK]], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(spans), bitorder="little").tobytes(), "little")


def fingerprints(rows: DataFrame, carry: list[str], text_col: str = "text", width: int = 3) -> DataFrame:
    """The ``carry`` columns and ``fp``, the fingerprint as a signed long."""
    kept = rows.select(*carry, F.col(text_col).alias("_text"))

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch.column(len(carry)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(found.view(np.int64))], names=[*carry, "fp"])

    return kept.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in kept.dtypes[: len(carry)]) + ", fp long")


def _masks(half: int) -> np.ndarray:
    return np.array([sum(1 << b for b in bits) for k in range(half + 1) for bits in combinations(range(BITS), k)], np.uint64)


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints of ``fps`` (column ``fp``, no repeats) within ``max_bits`` bits.

    The links keep the components of the full relation; ``max_bits`` has to be even.
    """
    if max_bits % 2 or max_bits < 0:
        raise ValueError("max_bits has to be even")
    masks = _masks(max_bits // 2)

    def balls(batches):
        for batch in batches:
            all_fp = np.asarray(batch.column(0)).astype(np.int64).view(np.uint64)
            step = max(1, (1 << 18) // len(masks))
            for at in range(0, len(all_fp), step):
                fp = all_fp[at : at + step]
                variants = (fp[:, None] ^ masks[None, :]).ravel()
                yield pa.RecordBatch.from_pydict({"variant": variants.view(np.int64), "fp": np.repeat(fp, len(masks)).view(np.int64)})

    met = fps.select("fp").mapInArrow(balls, "variant long, fp long")
    met = met.withColumn("least", F.min("fp").over(W.partitionBy("variant")))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= max_bits
    return met.where((F.col("least") != F.col("fp")) & close).select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def classes(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fp, root): one row per distinct fingerprint with the smallest fingerprint of its component."""
    distinct = stored(fps.select("fp").distinct())
    roots = connected(links(distinct, max_bits))
    joined = distinct.join(roots, F.col("fp") == F.col("node"), "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def hex_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` and ``component_id``, the smallest id reachable over links."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t"))
    found = stored(fingerprints(rows, ["doc_id"], "_t", width))
    smallest = found.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    placed = stored(classes(found, max_bits).join(smallest, "fp"))
    by_root = stored(placed.groupBy("root").agg(F.min("first_id").alias("component_id")))
    by_fp = placed.join(by_root, "root").select(F.col("fp").alias("_fp"), "component_id")
    joined = found.join(by_fp, F.col("fp") == F.col("_fp"))
    return joined.select("doc_id", hex_text(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """Rows of ``docs`` with one row left per component: the smallest id, then the smallest text hash."""
    keyed = docs.select(F.struct("*").alias("row"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    found = stored(fingerprints(keyed, ["_id", "_th"], "text", width))
    first = found.groupBy("fp").agg(F.min(F.struct("_id", "_th")).alias("first"))
    keep = classes(found, max_bits).join(first, "fp").groupBy("root").agg(F.min("first").alias("first"))
    keep = keep.select(F.col("first._id").alias("_id"), F.col("first._th").alias("_th"))
    once = W.partitionBy("_id", "_th").orderBy("_th")  # repeated rows: one of them
    left = keyed.drop("text").join(keep, ["_id", "_th"], "left_semi").withColumn("nth", F.row_number().over(once))
    return left.where("nth = 1").select("row.*")
