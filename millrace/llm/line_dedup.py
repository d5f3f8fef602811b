"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

The index holds three tables: ``postings`` (which document holds which line), ``refs`` (per line the number of
documents and the smallest id, the owner) and ``filters`` (per shard and batch a cuckoo filter over the lines first
seen in that batch).  A batch is counted on its own; its distinct lines are then put to the filters of their shard.
What no filter knows is new and is written without looking anything up; only the rest is joined with ``refs``, which
decides exactly.  Deleting documents takes their postings out, counts the touched lines anew, and frees the filter
slots of lines that nobody holds any more, so the index is what it would be had they never come.

A line that a large share of all documents holds is one row per map task before it is shuffled; spreading a decision
back to its documents is an equi join.

A line's key is the line stripped of ASCII white space with A-Z lower-cased; lines are compared by a 128-bit hash of
the key.  Only keys of at least ``MIN_CHARS`` code points count.

Defined cases: a null text is one empty line and stays null; a null id ranks behind all ids; rows that share an id are
one document; repeated lines inside one document do not make a line repeated; extra columns are passed through.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_intdigest

from millrace.llm import cuckoo
from millrace.llm.storage import stored

BLANK = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
KEYS_PER_SHARD = 4096
_LAST = 2**63 - 1
_LOW = 2**64 - 1


def line_key(line: str) -> tuple[int, int] | None:
    """Two signed 64-bit halves of the key's hash; None for lines that are too short to count."""
    kept = line.strip(BLANK)
    if len(kept) < MIN_CHARS:
        return None
    digest = xxh3_128_intdigest(kept.encode("utf-8", "surrogatepass").lower())
    high, low = digest >> 64, digest & _LOW
    return high - (1 << 64) if high >> 63 else high, low - (1 << 64) if low >> 63 else low


def document_id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, k1, k2): every distinct line key of every row."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    rows += [(doc, *k) for k in {line_key(line) for line in text.split("\n")} if k]
            for at in range(0, len(rows), 100_000):
                cols = zip(*rows[at : at + 100_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc", "k1", "k2"])

    return docs.select(document_id(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(run, "doc long, k1 long, k2 long")


@dataclass(frozen=True)
class LineIndex:
    postings: DataFrame
    refs: DataFrame  # k1, k2, refs, owner, generation: several rows for a key that came in several batches
    filters: DataFrame  # shard, generation, cells
    shared: DataFrame  # k1, k2 of lines that more than one document held at some time
    shards: int
    generation: int

    def _shard(self) -> Column:
        return F.pmod(F.col("k1"), F.lit(self.shards)).cast("long")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index with the documents of one more batch."""
        came = stored(postings(docs, id_col, text_col))
        counted = stored(_count(came))
        generation = self.generation + 1
        screened = _screen(counted.withColumn("shard", self._shard()), self.filters)
        known = self.refs.select("k1", "k2").distinct()
        held = stored(screened.where("maybe").select("k1", "k2").join(known, ["k1", "k2"], "left_semi"))
        fresh = counted.join(held, ["k1", "k2"], "left_anti").withColumn("shard", self._shard())
        filters = stored(_build_filters(fresh, generation))
        return replace(
            self,
            postings=self.postings.union(came),
            refs=self.refs.union(counted.withColumn("generation", F.lit(generation))),
            filters=self.filters.union(filters),
            shared=self.shared.union(counted.where("refs > 1").select("k1", "k2")).union(held),
            generation=generation,
        )

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose id is in the one column of ``ids``."""
        gone = ids.select(document_id(ids.columns[0]).alias("doc")).distinct()
        touched = stored(self.postings.join(gone, "doc", "left_semi").select("k1", "k2").distinct())
        left = stored(self.postings.join(gone, "doc", "left_anti"))
        first = self.refs.groupBy("k1", "k2").agg(F.min("generation").alias("generation"))
        recount = stored(_count(left.join(touched, ["k1", "k2"], "left_semi")).join(first, ["k1", "k2"]))
        refs = stored(self.refs.join(touched, ["k1", "k2"], "left_anti").unionByName(recount))
        empty = touched.join(recount, ["k1", "k2"], "left_anti").join(first, ["k1", "k2"])
        filters = stored(_free_slots(empty.withColumn("shard", self._shard()), self.filters))
        return replace(self, postings=left, refs=refs, filters=filters)

    def repeated(self) -> DataFrame:
        """(k1, k2, owner) of the lines that at least two documents hold."""
        exact = self.refs.join(self.shared.distinct(), ["k1", "k2"], "left_semi")
        total = exact.groupBy("k1", "k2").agg(F.sum("refs").alias("refs"), F.min("owner").alias("owner"))
        return total.where("refs > 1").select("k1", "k2", "owner")

    def dropped(self) -> DataFrame:
        """(doc, keys): the line keys that a document loses; never more than it has lines.

        The repeated lines are written first: a join of two plain shuffles is one that Spark can split at a hot line.
        """
        lost = self.postings.join(stored(self.repeated()), ["k1", "k2"]).where("doc <> owner")
        return lost.groupBy("doc").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))


def _count(rows: DataFrame) -> DataFrame:
    return rows.groupBy("k1", "k2").agg(F.count("*").alias("refs"), F.min("doc").alias("owner"))


def empty_index(like: DataFrame, shards: int) -> LineIndex:
    spark = like.sparkSession
    none = lambda schema: spark.createDataFrame([], schema)
    return LineIndex(
        none("doc long, k1 long, k2 long"),
        none("k1 long, k2 long, refs long, owner long, generation int"),
        none("shard long, generation int, cells binary"),
        none("k1 long, k2 long"),
        shards,
        0,
    )


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table.column("k1").to_numpy().view(np.uint64), table.column("k2").to_numpy().view(np.uint64)


def _cells(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint16).reshape(-1, cuckoo.SLOTS)


def _screen(keys: DataFrame, filters: DataFrame) -> DataFrame:
    """k1, k2 and ``maybe``: whether a filter of the key's shard knows it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        k1, k2 = _keys(left)
        hit = np.zeros(len(k1), bool)
        for blob in right.column("cells").to_pylist():
            hit |= cuckoo.contains(_cells(blob), k1, k2)
        return pa.table({"k1": left.column("k1"), "k2": left.column("k2"), "maybe": pa.array(hit)})

    return keys.select("shard", "k1", "k2").groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(run, "k1 long, k2 long, maybe boolean")


def _build_filters(fresh: DataFrame, generation: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        cells = cuckoo.build(*_keys(table))
        return pa.table({"shard": table.column("shard")[:1], "generation": pa.array([generation], pa.int32()), "cells": pa.array([cells.tobytes()], pa.binary())})

    return fresh.select("shard", "k1", "k2").groupBy("shard").applyInArrow(run, "shard long, generation int, cells binary")


def _free_slots(keys: DataFrame, filters: DataFrame) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cells = []
        made = left.column("generation").to_numpy()
        for generation, blob in zip(right.column("generation").to_pylist(), right.column("cells").to_pylist(), strict=True):
            k1, k2 = _keys(left.filter(pa.array(made == generation))) if len(made) else (np.zeros(0, np.uint64),) * 2
            cells.append(cuckoo.remove(_cells(blob), k1, k2).tobytes())
        return right.set_column(right.schema.get_field_index("cells"), "cells", pa.array(cells, pa.binary()))

    kept = keys.select("shard", "k1", "k2", "generation")
    return kept.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(run, "shard long, generation int, cells binary")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> LineIndex:
    """Index of all documents, put in by ``batches`` inserts that together hold every row."""
    n_lines = docs.agg(F.sum(F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    index = empty_index(docs, max(1, -(-int(n_lines) // KEYS_PER_SHARD)))
    turn = F.pmod(F.xxhash64(document_id(id_col)), F.lit(batches))
    for k in range(batches):
        index = index.insert(docs.where(turn == k), id_col, text_col)
    return index


def rewrite(text: str | None, lost: set[tuple[int, int]]) -> tuple[int, int, str]:
    """(lines, dropped lines, kept lines joined) of one text."""
    lines = (text or "").split("\n")
    if not lost:
        return len(lines), 0, text or ""
    kept = [line for line in lines if line_key(line) not in lost]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def _with_lost(rows: DataFrame, index: LineIndex) -> DataFrame:
    """``rows`` (with the column ``_owner``) and the keys that each loses."""
    lost = index.dropped().select(F.col("doc").alias("_doc"), F.col("keys").alias("_lost"))
    return rows.join(lost, F.col("_owner") == F.col("_doc"), "left").drop("_owner", "_doc")


def _lost_set(value) -> set[tuple[int, int]]:
    return {(k["k1"], k["k2"]) for k in value} if value else set()


def dedup_lines(docs: DataFrame, index: LineIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that the index calls repeated left out, except at their owner; null texts stay null."""
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(*[docs[f"`{c}`"] for c in others], F.lit(True).alias("_row")).alias("_rest")
    rows = docs.select(rest, docs[f"`{text_col}`"].alias("_text"), document_id(id_col).alias("_owner"))

    def run(batches):
        for batch in batches:
            texts = [
                rewrite(t, _lost_set(lost))[2] if t is not None and lost else t
                for t, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["_rest", "_text"])

    joined = _with_lost(rows, index)
    done = joined.mapInArrow(run, T.StructType([joined.schema["_rest"], T.StructField("_text", T.StringType())]))
    return done.select(*[F.col("_text").alias(c) if c == text_col else F.col("_rest").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and the hash of what is kept."""
    index = build_index(docs, id_col, text_col, batches)

    def run(parts):
        for batch in parts:
            out = []
            for text, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n, gone, kept = rewrite(text, _lost_set(lost))
                out.append((n, gone, hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()))
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols, kinds)], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), document_id(id_col).alias("_owner"))
    return _with_lost(rows, index).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
