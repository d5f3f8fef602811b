"""Exact top-k search by inner product over a bit-sliced index.

Vectors become whole numbers, floor(256 * x).  A block of rows is stored as bitmaps: one per attribute and bit, with
the lowest ``DROPPED`` bits left out.  The score of a query against all rows of a block is built by bitmap arithmetic:
each attribute is multiplied by the query's number by adding its bitmaps shifted, and all bitmaps of equal weight go
through carry-save adders until one bitmap per bit of the score is left.  The k-th best quantised score is then found
from the most significant bitmap downward.  The bits left out can move a score by a known amount only; the rows whose
quantised score comes within that amount of the k-th best are the boundary rows, and these alone are scored exactly.

Each cell of (block of rows, block of queries) is one unit of work with a fixed number of rows on either side; the best
k of each cell are merged per query.  The query set is the rows whose id is divisible by ``query_step``.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part; a missing trailing
component counts as 0; equal (id, vector) rows count once; a row without id can be found, after all others of the same
score, and asks nothing; a query with fewer than k other rows gets them all; extra columns are ignored.  Scores have
to fit into a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

K = 5
SCALE = 256
DROPPED = 2
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 512
_NO_ID = 2**63 - 1
_FULL = np.uint64(2**64 - 1)


def quantised(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as whole numbers, shorter rows filled with 0."""
    parts = [np.floor(np.array(v, np.float64) * SCALE).astype(np.int64) for v in column.to_pylist()]
    width = max(map(len, parts), default=0)
    out = np.zeros((len(parts), width), np.int64)
    for row, part in zip(out, parts, strict=True):
        row[: len(part)] = part
    return out


def _bitmap(flags: np.ndarray) -> np.ndarray:
    """Flags along the last axis packed into 64-bit words."""
    pad = -flags.shape[-1] % 64
    if pad:
        flags = np.concatenate([flags, np.zeros((*flags.shape[:-1], pad), bool)], axis=-1)
    return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)


def add_bitmaps(pending: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of bitmaps; ``pending[w]`` holds stacks of bitmaps of weight 2 ** w, the result one bitmap per bit."""
    out, w = [], 0
    while w < len(pending):
        x = np.concatenate(pending[w]) if pending[w] else None
        carries = []
        while x is not None and len(x) > 2:
            t = len(x) // 3
            a, b, c = x[:t], x[t : 2 * t], x[2 * t : 3 * t]
            ab = a ^ b
            carries.append((a & b) | (ab & c))
            x = np.concatenate([ab ^ c, x[3 * t :]])
        if x is not None and len(x) == 2:
            carries.append((x[:1] & x[1:]))
            x = x[:1] ^ x[1:]
        out.append(x[0] if x is not None else None)
        if carries:
            if w + 1 == len(pending):
                pending.append([])
            pending[w + 1] = pending[w + 1] + carries
        w += 1
    return out


class BitSlicedBlock:
    """Bitmaps over the rows of one block."""

    def __init__(self, rows: np.ndarray, dropped: int = DROPPED):
        self.rows, self.dropped = rows, dropped
        lifted = (rows - rows.min(axis=0)) >> dropped if len(rows) else rows
        self.bits = max(1, int(lifted.max(initial=0)).bit_length())
        each = (lifted.T[:, None, :] >> np.arange(self.bits)[None, :, None]) & 1
        self.slices = _bitmap(each.astype(bool))  # attribute, bit, words
        self.present = _bitmap(np.ones(len(rows), bool))

    def _weighted(self, digits: np.ndarray, width: int) -> list[list[np.ndarray]]:
        pending: list[list[np.ndarray]] = [[] for _ in range(width)]
        for w in range(int(digits.max(initial=0)).bit_length()):
            used = np.flatnonzero((digits >> w) & 1)
            if len(used):
                for b in range(self.bits):
                    pending[w + b].append(self.slices[used, b])
        return pending

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Bitmaps of the quantised scores, all raised by the same constant so that none is negative."""
        size, sign = np.abs(query), query < 0
        half = size >> 1
        three = size + half
        plus, minus = three & (half ^ three), half & (half ^ three)  # signed digits, few of them set
        plus, minus = np.where(sign, minus, plus), np.where(sign, plus, minus)
        width = int(max(plus.max(initial=0), minus.max(initial=0))).bit_length() + self.bits + 1
        taken = add_bitmaps(self._weighted(minus, width))
        given = self._weighted(plus, max(width, len(taken)))
        words = len(self.present)
        for w in range(len(given)):  # minus x is its complement, up to a constant
            bits = taken[w] if w < len(taken) else None
            given[w].append((np.full(words, _FULL) if bits is None else ~bits)[None, :])
        return [np.zeros(words, np.uint64) if x is None else x for x in add_bitmaps(given)]

    def best(self, query: np.ndarray, k: int, without: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and exact scores of all rows that may be among the k best, ``without`` some rows."""
        present = self.present.copy()
        for r in without.tolist():
            present[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        wide = np.zeros(self.rows.shape[1], np.int64)
        wide[: min(len(query), len(wide))] = query[: len(wide)]
        boundary = present
        if int(np.bitwise_count(present).sum()) > k:
            slices = self.scores(wide)
            equal, value, left = present, 0, k
            for w in range(len(slices) - 1, -1, -1):
                high = equal & slices[w]
                n = int(np.bitwise_count(high).sum())
                if n >= left:
                    equal, value = high, value | 1 << w
                else:
                    left, equal = left - n, equal & ~slices[w]
            slack = -(-((1 << self.dropped) - 1) * int(np.abs(wide).sum()) >> self.dropped) if self.dropped else 0
            boundary = self._at_least(slices, present, value - abs(slack) - 1)
        at = np.flatnonzero(np.unpackbits(boundary.view(np.uint8), bitorder="little"))
        return at, self.rows[at] @ wide

    @staticmethod
    def _at_least(slices: list[np.ndarray], present: np.ndarray, least: int) -> np.ndarray:
        if least <= 0:
            return present
        above, equal = np.zeros_like(present), present
        for w in range(len(slices) - 1, -1, -1):
            if least >> w & 1:
                equal = equal & slices[w]
            else:
                above, equal = above | (equal & slices[w]), equal & ~slices[w]
        return above | equal


def _cell(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if len(rows) and len(queries):
            ids = rows.column("vec_id").to_numpy()
            block = BitSlicedBlock(quantised(rows.column("vec")))
            own: dict[int, list[int]] = {}
            for r, i in enumerate(ids.tolist()):
                own.setdefault(i, []).append(r)
            asked = zip(queries.column("vec_id").to_pylist(), queries.column("qh").to_pylist(), quantised(queries.column("vec")), strict=True)
            for query_id, qh, query in asked:
                at, scores = block.best(query, k, np.array(own.get(query_id, []), np.int64))
                order = np.lexsort((ids[at], -scores))[:k]
                out[0].extend([query_id] * len(order))
                out[1].extend([qh] * len(order))
                out[2].extend(ids[at][order].tolist())
                out[3].extend(scores[order].tolist())
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("query_id", "qh", "vec_id", "score"), out, strict=True)})

    return run


def search(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, query_step: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row whose id is divisible by ``query_step``."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = given.where(F.col("vec").isNotNull() & ~bad).distinct()
    queries = rows.where((F.col("vec_id") != _NO_ID) & (F.col("vec_id") % query_step == 0)).withColumn("qh", F.xxhash64("vec"))
    n_rows, n_queries = rows.agg(F.count("*"), F.count_if((F.col("vec_id") != _NO_ID) & (F.col("vec_id") % query_step == 0))).first()
    n_blocks, n_sets = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))

    def cells(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64("vec_id", "vec"), F.lit(n_own)))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))))

    left = cells(rows, "block", n_blocks, "set", n_sets).groupBy("block", "set")
    right = cells(queries, "set", n_sets, "block", n_blocks).groupBy("block", "set")
    found = left.cogroup(right).applyInArrow(_cell(k), "query_id long, qh long, vec_id long, score long")
    order = W.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(F.col("vec_id") != _NO_ID, F.col("vec_id")).alias("vec_id"), "score")
