"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too.  The start of every such string is
a suffix; all suffixes of a corpus cannot meet in one sort, so they are dealt out by content first.  Each window of
``LENGTH`` bytes has an anchor, the gram of ``GRAM`` bytes with the least hash inside it (the leftmost of equals).
Equal windows have the same anchor at the same place, and consecutive windows with one anchor form a run.

1. Runs are counted by (anchor, bytes of the whole run).  A run that occurs twice is repeated as a whole, a run whose
   anchor occurs nowhere else is not, and neither needs its text looked at again.
2. What is left are anchors with several different runs, one representative each.  Here the suffixes that start at the
   anchors are sorted by a merge sort whose comparisons find the longest common extension by binary search over prefix
   polynomial hashes, a logarithmic number of steps each; so are the reversed texts before the anchors.  Neighbours'
   extensions are verified on the bytes; if a hash was wrong, the block is sorted anew by its bytes.  Two windows are
   equal if their runs stand in one class of the left order and in one class of the right order.
3. Anchors with more than ``BLOCK`` runs are sorted in blocks.  The windows that one block cannot decide are merged with
   those of the other blocks by two hashes of their bytes.

Prefix hashes are polynomials modulo 2**64; runs and merged windows are compared by a second, different hash as well.

Defined cases: a null or empty text has no bytes; texts shorter than ``LENGTH`` lose nothing; repeated rows repeat each
other; null ids stay null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import cmp_to_key, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from millrace.llm.storage import forget_shuffles, stored

LENGTH = 400
GRAM = 100
BLOCK = 8192
_LEADS = 64
CHUNK = 1 << 22
_NO_ID = -(2**63)
_POSITION_BITS = 24
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _power_table(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(16, (n - 1).bit_length()))[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of (byte + 1) * base ** place over the first i bytes, modulo 2 ** 64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, len(data)), out=out[1:])
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first and last window start, place of the anchor, hash of the anchor."""
    n = len(data) - length + 1
    h = prefix_hashes(data)
    grams = _mixed((h[gram:] - h[:-gram]) * _power_table(_BASE_INVERSE, len(data) - gram + 1))
    low = np.uint64((1 << _POSITION_BITS) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    wide = length - gram + 1
    padded = np.concatenate([keys, np.full(-len(keys) % wide, 2**64 - 1, np.uint64)]).reshape(-1, wide)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[wide - 1 : wide - 1 + n])
    change = np.concatenate([[True], least[1:] != least[:-1]])
    first = np.flatnonzero(change)
    last = np.append(first[1:], n) - 1
    anchor = (least[first] & low).astype(np.int64)
    return first, last, anchor, grams[anchor]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _document_runs(raw: bytes, length: int, gram: int):
    """(start, windows, anchor offset, anchor hash, run hash) of the runs of one text; long texts go in overlapping chunks."""
    for at in range(0, max(1, len(raw) - length + 1), CHUNK):
        part = raw[at : at + CHUNK + length - 1]
        if len(part) < length:
            continue
        first, last, anchor, hashes = runs(np.frombuffer(part, np.uint8), length, gram)
        for s, e, a, h in zip(first.tolist(), last.tolist(), anchor.tolist(), hashes.view(np.int64).tolist(), strict=True):
            yield at + s, e - s + 1, a - s, h, _signed(xxh3_64_intdigest(part[s : e + length], a - s))


_RUN = "_id long, _th long, start long, windows int, offset int, anchor long, run long"


def document_runs(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Runs of all rows (``_id``, ``_th``, ``text``)."""

    def go(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        names = [c.split()[0] for c in _RUN.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for i, th, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                out.extend((i, th, *run) for run in _document_runs(raw, length, gram))
                if len(out) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return rows.select("_id", "_th", "text").mapInArrow(go, _RUN)


def common_prefix(one: array, other: array) -> int:
    """Longest common extension of two texts, given their prefix hashes."""
    low, high = 0, min(len(one), len(other)) - 1
    while low < high:
        middle = (low + high + 1) >> 1
        if one[middle] == other[middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _true_prefix(one: bytes, other: bytes) -> int:
    n = min(len(one), len(other))
    differ = np.flatnonzero(np.frombuffer(one, np.uint8, n) != np.frombuffer(other, np.uint8, n))
    return int(differ[0]) if len(differ) else n


def sorted_with_extensions(texts: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Order of the texts and the longest common extension of each with the one before it (0 for the first)."""
    hashes = [array("Q", prefix_hashes(np.frombuffer(t, np.uint8)).tobytes()) for t in texts]

    def compare(a: int, b: int) -> int:
        n = common_prefix(hashes[a], hashes[b])
        one, other = texts[a][n : n + 1], texts[b][n : n + 1]
        return (one > other) - (one < other)

    order = sorted(range(len(texts)), key=cmp_to_key(compare))  # a merge sort
    found = [0, *(common_prefix(hashes[a], hashes[b]) for a, b in zip(order, order[1:], strict=False))]
    pairs = zip(order, order[1:], found[1:], strict=False)
    if not all(texts[a][:n] == texts[b][:n] and texts[a][: n + 1] <= texts[b][: n + 1] for a, b, n in pairs):
        order = sorted(range(len(texts)), key=texts.__getitem__)
        found = [0, *(_true_prefix(texts[a], texts[b]) for a, b in zip(order, order[1:], strict=False))]
    return order, np.array(found, np.int64)


class Block:
    """Sorted runs of one anchor; tells which windows are equal, lead by lead (a lead: bytes of a window before the anchor)."""

    def __init__(self, texts: list[bytes], offsets: list[int], windows: list[int], length: int):
        self.length = length
        self.high = np.array(offsets)
        self.low = self.high - np.array(windows) + 1
        self.right_order, self.right = sorted_with_extensions([t[a:] for t, a in zip(texts, offsets, strict=True)])
        self.left_order, self.left = sorted_with_extensions([t[:a][::-1] for t, a in zip(texts, offsets, strict=True)])

    def classes(self, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, valid) by run and lead: runs of one class have equal windows there, if valid says that they have one."""
        valid = (leads >= self.low[:, None]) & (leads <= self.high[:, None])
        classes = np.empty((len(self.high), len(leads)), np.int64)
        classes[self.right_order] = np.cumsum(self.right[:, None] < (self.length - leads)[None, :], axis=0)
        lefts = np.empty_like(classes)
        lefts[self.left_order] = np.cumsum(self.left[:, None] < leads[None, :], axis=0)
        return classes + lefts * (len(self.high) + 1), valid


def repeated_windows(classes: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Windows whose class another run of the block has too."""
    marked = np.where(valid, classes, -1 - np.arange(len(classes))[:, None])
    order = np.argsort(marked, axis=0, kind="stable")
    in_order = np.take_along_axis(marked, order, axis=0)
    same = in_order[1:] == in_order[:-1]
    twice = np.zeros(marked.shape, bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.empty_like(twice)
    np.put_along_axis(out, order, twice, axis=0)
    return out


def _stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


_PART = "anchor long, block long, blocks long, _id long, _th long, start long, windows int, offset int, twice boolean, bytes binary"
_FOUND = "_id long, _th long, b long, e long, h1 long, h2 long, wanted boolean"


def _judge_block(rows: list[dict], length: int):
    """Removed stretches of the runs of one block, and for blocks of a split anchor the windows left to the merge."""
    block = Block([r["bytes"] for r in rows], [r["offset"] for r in rows], [r["windows"] for r in rows], length)
    least, most = int(block.low.min()), int(block.high.max())
    merge = rows[0]["blocks"] > 1
    twice = np.zeros((len(rows), most - least + 1), bool)
    for j in range(least, most + 1, _LEADS):
        leads = np.arange(j, min(j + _LEADS, most + 1))
        classes, valid = block.classes(leads)
        found = repeated_windows(classes, valid) & valid
        twice[:, leads - least] = found
        if not merge:
            continue
        told: set[tuple[int, int]] = set()
        for m, k in zip(*(x.tolist() for x in np.nonzero(valid)), strict=True):
            row = rows[m]
            if found[m, k]:
                if (k, classes[m, k]) in told:
                    continue
                told.add((k, classes[m, k]))
            at = row["offset"] - j - k
            window = row["bytes"][at : at + length]
            h1, h2 = _signed(xxh3_64_intdigest(window, 1)), _signed(xxh3_64_intdigest(window, 2))
            yield row["_id"], row["_th"], row["start"] + at, row["start"] + at + length, h1, h2, not (row["twice"] or found[m, k])
    for m, row in enumerate(rows):
        if not row["twice"]:
            anchor = row["start"] + row["offset"]
            for a, b in _stretches(twice[m]):
                yield row["_id"], row["_th"], anchor - least - b, anchor - least - a + length, None, None, False


def _judge_blocks(length: int):
    """Over rows sorted by (anchor, block): one block at a time."""

    def go(batches):
        kinds = (pa.int64(),) * 6 + (pa.bool_(),)
        names = [c.split()[0] for c in _FOUND.split(", ")]
        held: list[dict] = []
        out: list[tuple] = []

        def table():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (held[0]["anchor"], held[0]["block"]) != (row["anchor"], row["block"]):
                    out.extend(_judge_block(held, length))
                    held = []
                    if len(out) > 50_000:
                        yield table()
                        out = []
                held.append(row)
        if held:
            out.extend(_judge_block(held, length))
        if out:
            yield table()

    return go


def repeated_stretches(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, per_block: int = BLOCK) -> DataFrame:
    """(_id, _th, b, e): stretches of repeated bytes, overlapping ones included, of ``rows`` (``_id``, ``_th``, ``text``)."""
    found = document_runs(rows, length, gram)
    first = F.min(F.struct("_id", "_th", "start", "windows", "offset")).alias("first")
    counted = stored(found.groupBy("anchor", "run").agg(F.count("*").alias("n"), first))
    forget_shuffles(rows.sparkSession)
    kinds = stored(counted.groupBy(F.col("anchor").alias("_anchor")).agg(F.count("*").alias("kinds")).where("kinds > 1"))
    whole = counted.where("n > 1").select(F.col("anchor").alias("_anchor"), F.col("run").alias("_run"))
    again = found.join(whole, (F.col("anchor") == F.col("_anchor")) & (F.col("run") == F.col("_run")), "left_semi")
    again = again.select("_id", "_th", F.col("start").alias("b"), (F.col("start") + F.col("windows") + (length - 1)).alias("e"))

    split = F.greatest(F.lit(1), F.ceil(F.col("kinds") / per_block)).cast("long")
    mixed = counted.join(kinds, F.col("anchor") == F.col("_anchor")).select("anchor", "run", "n", "first.*", split.alias("blocks"))
    block = F.pmod(F.xxhash64("run"), F.col("blocks")).alias("block")
    parts = F.collect_list(F.struct("anchor", block, "blocks", "start", "windows", "offset", (F.col("n") > 1).alias("twice")))
    wanted = mixed.groupBy(F.col("_id").alias("_wid"), F.col("_th").alias("_wth")).agg(parts.alias("parts"))
    with_text = rows.join(wanted, (F.col("_id") == F.col("_wid")) & (F.col("_th") == F.col("_wth"))).select("_id", "_th", "text", "parts")

    def cut(batches):
        kinds_ = (pa.int64(),) * 6 + (pa.int32(), pa.int32(), pa.bool_(), pa.binary())
        names = [c.split()[0] for c in _PART.split(", ")]
        for batch in batches:
            for i, th, text, some in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                out = [
                    (p["anchor"], p["block"], p["blocks"], i, th, p["start"], p["windows"], p["offset"], p["twice"], raw[p["start"] : p["start"] + p["windows"] + length - 1])
                    for p in some
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds_, strict=True)], names=names)

    dealt = with_text.mapInArrow(cut, _PART).repartition("anchor", "block").sortWithinPartitions("anchor", "block", "_id", "_th", "start")
    judged = stored(dealt.mapInArrow(_judge_blocks(length), _FOUND))
    forget_shuffles(rows.sparkSession)
    merged = judged.where("h1 is not null")
    shared = merged.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    late = merged.where("wanted").join(shared, ["h1", "h2"], "left_semi")
    out = ["_id", "_th", "b", "e"]
    return again.union(judged.where("h1 is null").select(*out)).union(late.select(*out))


def merge_stretches(stretches, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal stretches of the union."""
    out: list[list[int]] = []
    for b, e in sorted(stretches):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [(b, min(e, n_bytes)) for b, e in out]


def without(raw: bytes, gone: list[tuple[int, int]]) -> bytes:
    cuts = [0, *(x for pair in gone for x in pair), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, per_block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and the hash of the bytes left."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("text"))
    gone = repeated_stretches(rows, length, gram, per_block=per_block)
    per = gone.groupBy(F.col("_id").alias("_gid"), F.col("_th").alias("_gth")).agg(F.collect_list(F.struct("b", "e")).alias("gone"))
    joined = rows.join(per, (F.col("_id") == F.col("_gid")) & (F.col("_th") == F.col("_gth")), "left").select("_id", "text", "gone")

    def go(batches):
        for batch in batches:
            out = []
            for i, text, some in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                spans = merge_stretches(((g["b"], g["e"]) for g in some or ()), len(raw))
                kept = without(raw, spans)
                out.append((None if i == _NO_ID else i, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(),) * 4 + (pa.string(),)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(go, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
