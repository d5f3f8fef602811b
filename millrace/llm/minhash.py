"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

A text is the set of its distinct word shingles.  One hash per shingle serves all bins of the sketch: its top bits name
the bin, a bin keeps its least hash.  An empty bin takes the value of another one, which it looks for in a random order
of its own that is the same for every text; so each bin agrees with the chance of the similarity, for short texts too.
Bands of bins are buckets; at a similarity of 0.8 a pair meets in none of them with a chance of about 5e-8.

Texts with equal sets are one node, however many rows share it.  The members of a bucket are compared with its centre
only, the one of smallest id: a star, whose links are confirmed on the full sets.  What is then still in several
components is compared further, across components only, in rounds: all pairs of a bucket of at most ``SMALL`` members;
a larger bucket gets another star each round, and so do the deeper buckets that it is cut into by more bins a band.
The pairs stay in proportion to the members of buckets.  A link between two members of a large bucket is missed if, in
all buckets that they share, no centre leads to it; the README has measured figures against all pairs of all buckets.

Sets hold 64-bit hashes of shingles; sets are told apart by 128 bits of hash.

Defined cases: a null text or one without words has an empty set and is linked with nothing; fewer words than a shingle
make one shingle of all words; repeated rows each get a result row; null ids are ignored in ``component_id``, which is
null where all ids of a component are; ``kept`` compares null ids as equal; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_intdigest

from millrace.llm.components import connected
from millrace.llm.storage import drop_stored, row_key, stored

BANDS = 32
ROWS = 4
BINS = BANDS * ROWS
SMALL = 16
DEPTHS = (4, 8, 16)  # bins a band by which open buckets are looked at again
ROUNDS = 3
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_rng = np.random.default_rng(20240917)
_DONORS = np.stack([np.concatenate([[b], _rng.permutation(np.delete(np.arange(BINS), b))]) for b in range(BINS)])
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_BAND_SEED = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, width: int = 4) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    width = min(width, len(words))
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, width, np.uint64)
    for k in range(width):
        mixed = mixed * _STEP + hashes[k : k + n]
    return np.unique(_mixed(mixed))


def bins_of(hashes: np.ndarray) -> np.ndarray:
    """The densified sketch of a non-empty sorted set."""
    bins = (hashes >> _SHIFT).astype(np.int64)
    first = np.concatenate([[True], bins[1:] != bins[:-1]])
    sketch, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    sketch[bins[first]], filled[bins[first]] = hashes[first], True
    return sketch if filled.all() else sketch[_DONORS[np.arange(BINS), filled[_DONORS].argmax(axis=1)]]


def buckets_of(hashes: np.ndarray, depth: int = ROWS) -> np.ndarray:
    """One bucket number per band; bands deeper than ``ROWS`` go on into the bins of the next ones."""
    at = (np.arange(BANDS)[:, None] * ROWS + np.arange(depth)) % BINS
    bands, mixed = bins_of(hashes)[at], _BAND_SEED.copy()
    for k in range(depth):
        mixed = mixed * _STEP + _mixed(bands[:, k])
    return _mixed(mixed).view(np.int64)


def sketches(rows: DataFrame, carry: list[str], text_col: str, width: int) -> DataFrame:
    """The ``carry`` columns, the size of the set, its name in two longs (null for an empty set) and its buckets."""
    kept = rows.select(*carry, F.col(text_col).alias("_text"))

    def run(batches):
        for batch in batches:
            sizes, high, low, buckets = [], [], [], []
            for text in batch.column(len(carry)).to_pylist():
                found = shingle_set(text, width)
                sizes.append(len(found))
                name = xxh3_128_intdigest(found.tobytes()).to_bytes(16, "little") if len(found) else None
                high.append(name and int.from_bytes(name[8:], "little", signed=True))
                low.append(name and int.from_bytes(name[:8], "little", signed=True))
                buckets.append(buckets_of(found) if name else None)
            made = [pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], *made], names=[*carry, "n", "hi", "lo", "buckets"])

    carried = ", ".join(f"{c} {t}" for c, t in kept.dtypes[: len(carry)])
    return kept.mapInArrow(run, f"{carried}, n long, hi long, lo long, buckets array<long>")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, shingles) from (node, _t)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [shingle_set(t, width).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles array<long>")


def _sizes_fit(one: Column, other: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity at all."""
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("_a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("_b"), F.col("shingles").alias("of_b"))
    both = pairs.join(right, F.col("b") == F.col("_b")).join(left, F.col("a") == F.col("_a"))
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.size("of_a") + F.size("of_b") - common
    return both.where(common * 100 >= union * percent).select("a", "b")


def _members(sets: DataFrame) -> DataFrame:
    """(node, n, bucket) of all buckets of (node, shingles) at all depths."""

    def run(batches):
        for batch in batches:
            sizes, buckets = [], []
            for row in batch.column(1):
                found = np.asarray(row.values).view(np.uint64)
                sizes.append(len(found))
                buckets.append(np.concatenate([buckets_of(found, depth) for depth in DEPTHS]))
            made = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, names=["node", "n", "buckets"])

    return sets.mapInArrow(run, "node long, n long, buckets array<long>").select("node", "n", F.explode("buckets").alias("bucket"))


def _roots(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(node, root) of all nodes (node, n, buckets) that are not the smallest of their component.

    ``sets_of`` gives (node, shingles) for a table of nodes.
    """
    members = nodes.select("node", "n", "first_id", F.explode("buckets").alias("bucket"))
    centre = F.min(F.struct("first_id", "node", "n")).alias("centre")
    shared = members.groupBy("bucket").agg(F.count("*").alias("size"), centre).where("size > 1")
    shared = stored(shared.select(F.col("bucket").alias("_bucket"), "centre"))
    met = stored(members.join(shared, F.col("bucket") == F.col("_bucket")).select("centre", "node", "n"))
    drop_stored(shared)
    star = met.where((F.col("node") != F.col("centre.node")) & _sizes_fit(F.col("n"), F.col("centre.n"), percent))
    tried = stored(_pairs(star, F.col("centre.node"), F.col("node")).distinct())
    sets = still = stored(sets_of(met.select("node").distinct()))
    roots = connected(_confirmed(tried, sets, percent))
    for nth in range(ROUNDS):
        several = _open_buckets(still, roots, nth)
        new = stored(_across(several, percent).join(tried, ["a", "b"], "left_anti"))
        links = stored(_confirmed(new, sets, percent))
        if links.isEmpty():
            break
        roots = connected(links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        tried = tried.union(new)
        still = sets.join(several.select("node").distinct(), "node", "left_semi")
    return roots


def _pairs(rows: DataFrame, one: Column, other: Column) -> DataFrame:
    return rows.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))


def _open_buckets(sets: DataFrame, roots: DataFrame, nth: int) -> DataFrame:
    """Members of the buckets that hold several components, each with a centre that differs from round to round."""
    labels = roots.select(F.col("node").alias("_node"), "root")
    members = _members(sets).join(labels, F.col("node") == F.col("_node"), "left")
    members = stored(members.select("bucket", "node", "n", F.coalesce("root", "node").alias("root")))
    centre = F.min(F.struct(F.xxhash64("node", F.lit(nth)), "node", "n", "root")).alias("centre")
    several = members.groupBy("bucket").agg(F.count("*").alias("size"), centre, F.min("root").alias("least"), F.max("root").alias("most"))
    several = stored(several.where("least < most").select(F.col("bucket").alias("_bucket"), "size", "centre"))
    several = stored(members.join(several, F.col("bucket") == F.col("_bucket")).drop("_bucket"))
    drop_stored(members)
    return several


def _across(several: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) from different components: all of a small bucket, those with the centre of a large one."""
    small = several.where(F.col("size") <= SMALL)
    other = small.select(F.col("bucket").alias("_bucket"), F.col("node").alias("b"), F.col("n").alias("_n"), F.col("root").alias("_root"))
    apart = (F.col("bucket") == F.col("_bucket")) & (F.col("node") < F.col("b")) & (F.col("root") != F.col("_root"))
    pairs = small.join(other, apart & _sizes_fit(F.col("n"), F.col("_n"), percent)).select(F.col("node").alias("a"), "b")
    centre = F.col("centre")
    star = several.where((F.col("size") > SMALL) & (F.col("root") != centre["root"]) & _sizes_fit(F.col("n"), centre["n"], percent))
    return pairs.union(_pairs(star, centre["node"], F.col("node"))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents whose sets have at least ``percent`` hundredths of their union in common are linked; ``component_id`` is the
    smallest id reachable.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_key(id_col, text_col), F.col(text_col).alias("_t"))
    found = stored(sketches(rows, ["doc_id", "_id", "_th"], "_t", width))
    first = [F.min("doc_id").alias("first_id"), F.min(F.struct("_id", "_th")).alias("row"), F.first("n").alias("n"), F.first("buckets").alias("buckets")]
    nodes = found.where("n > 0").groupBy("hi", "lo").agg(*first)
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()))

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Sets of the wanted nodes, made from the text of one row each."""
        at = nodes.join(wanted, "node", "left_semi").select("node", F.col("row._id").alias("_i"), F.col("row._th").alias("_h"))
        theirs = rows.join(at, (F.col("_id") == F.col("_i")) & (F.col("_th") == F.col("_h"))).select("node", "_t")
        return _sets(theirs, width).groupBy("node").agg(F.first("shingles").alias("shingles"))

    roots = _roots(nodes, sets_of, percent)
    placed = nodes.join(roots.select(F.col("node").alias("_node"), "root"), F.col("node") == F.col("_node"), "left")
    placed = stored(placed.select("hi", "lo", "first_id", F.coalesce("root", "node").alias("root")))
    by_root = stored(placed.groupBy("root").agg(F.min("first_id").alias("component_id")))
    by_set = placed.join(by_root, "root").select("hi", "lo", "component_id")
    linked = found.where("n > 0").join(by_set, ["hi", "lo"]).select("doc_id", "n", "component_id")
    alone = found.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    every = linked.union(alone)
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
