"""Best-fit packing of token pieces into sequences, certified by dual-feasible-function bounds.

Documents become pieces of at most ``capacity`` tokens.  Groups of pieces are packed on their own by best-fit
decreasing.  For each group, dual feasible functions over the histogram of lengths give a lower bound on its number of
sequences; a group that reaches it is certified, no order of its pieces does better.  The least filled sequences of
every group that has gaps go to the next round, where best-fit decreasing runs again; the new sequences count only if they
are fewer, and sequences that are not sent on stay as they are.  First a group sends in proportion to its waste, the
sequences it uses beyond its tokens, and what is sent is dealt out to as many groups as hold ``PER_GROUP`` pieces each;
a certified group has waste too if other pieces would fill its gaps.  Once a round saves less than a sequence per group,
each sends ``SPARE`` sequences, and ``FAN_IN`` groups meet until one is left.  So no exchange grows with the data.

Defined cases: a null or empty text is the end token alone; repeated rows are packed one by one; null ids stay null.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import stored

CAPACITY = 2048
PER_GROUP = 16_384
SPARE = 16
FAN_IN = 16
WIDE_ROUNDS = 64  # the number of a round has seven bits
END = 0

# Texts that both tokenizer libraries split alike: Latin letters, and no text that names the special token.
_OTHER = re.compile(r"[^\x00-ɏ]|<\|endoftext\|>")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


@lru_cache(maxsize=4)
def _encoder(vocabulary: str):
    """Function from a text to its token ids.

    The merges are those of ``<vocabulary>.json``; the faster library reads the same vocabulary as ranks and is used
    where its rules for splitting a text are the same.
    """
    import base64
    import os

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if _OTHER.search(text):
            return np.array(slow.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        return fast.encode_to_numpy(text).astype("<u4")

    return encode


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k", capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of all documents: only documents over ``capacity`` tokens are cut, their first piece takes the rest."""

    def run(batches):
        encode = _encoder(vocabulary)
        for batch in batches:
            ids_out, rows = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text), np.uint32(END)).astype("<u4") if text else np.array([END], "<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    ids_out.append(doc_id)
                    rows.append((k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids_out, pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each length.  Bins are filed by the room left; one number's bits tell which rooms exist."""
    bins = np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    present, opened = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = present >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = rooms[room].pop()
            if not rooms[room]:
                present &= ~(1 << room)
        else:
            room, number, opened = capacity, opened, opened + 1
        bins[i] = number
        if left := room - size:
            rooms[left].append(number)
            present |= 1 << left
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of bins that dual feasible functions prove for these lengths."""
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    mass = counts * sizes
    best = -(-int(mass.sum()) // capacity)
    # Above capacity - cut a length counts as a whole bin, below cut as nothing.
    n_from = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    mass_below = np.concatenate([[0], np.cumsum(mass)])
    for cut in range(1, capacity // 2 + 1):
        large = int(n_from[capacity - cut + 1])
        middle = int(mass_below[capacity - cut + 1] - mass_below[cut])
        best = max(best, large - (-middle // capacity))
    # Rounding down to k-ths of a bin; exact multiples of 1 / (k + 1) keep their size.
    for k in range(1, 51):
        scaled = sizes * (k + 1)
        exact = scaled % capacity == 0
        value = np.where(exact, scaled * k, (scaled // capacity) * (k + 1) * capacity)  # in units of k * (k + 1) * capacity
        best = max(best, -(-int((counts * value).sum()) // (k * (k + 1) * capacity)))
    return best


def _number(round_no: int, group: int, bins: np.ndarray) -> np.ndarray:
    return (np.int64(round_no) << np.int64(56)) + (np.int64(group) << np.int64(24)) + bins


def _round(round_no: int, capacity: int, wide: bool):
    """Pack one group; ``open`` marks the pieces of the sequences that go to the next round."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("sequence_id", "ascending")])
        lengths = table.column("length").to_numpy()
        group = table.column("grp")[0].as_py()
        before = table.column("sequence_id").to_numpy(zero_copy_only=False)
        bins = best_fit_decreasing(lengths, capacity)
        n_bins = int(bins.max()) + 1
        bound = lower_bound(lengths, capacity)
        if round_no and n_bins >= len(np.unique(before)):  # no gain: the sequences stay as they came
            names, bins = np.unique(before, return_inverse=True)
            n_bins, offset = len(names), table.column("offset").to_numpy()
        else:
            names = _number(round_no, group, np.arange(n_bins, dtype=np.int64))
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(lengths[order])
            start = np.searchsorted(bins[order], np.arange(n_bins))
            offset = np.empty(len(bins), np.int64)
            offset[order] = ends - lengths[order] - (ends - lengths[order])[start][bins[order]]
        fill = np.bincount(bins, weights=lengths, minlength=n_bins).astype(np.int64)
        waste = n_bins - -(-int(lengths.sum()) // capacity)
        gaps = np.argsort(fill, kind="stable")[: SPARE * (1 + waste) if wide else SPARE]
        to_next = np.zeros(n_bins, bool)
        to_next[gaps[fill[gaps] < capacity]] = True
        done = {"sequence_id": names[bins], "offset": offset, "open": to_next[bins], "certified": np.full(len(bins), n_bins == bound)}
        for name, values in done.items():
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(values))
        return table

    return run


_STATE = PACKED + ", grp long, open boolean, certified boolean"


def pack(items: DataFrame, capacity: int = CAPACITY, per_group: int = PER_GROUP) -> DataFrame:
    """``items`` (columns of PIECES) with ``sequence_id`` and ``offset``."""
    total = items.count()
    groups = max(1, -(-total // per_group))
    fresh = {"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "open": F.lit(True), "certified": F.lit(False)}
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("long")
    names = [c.split()[0] for c in _STATE.split(", ")]
    state = items.withColumns({**fresh, "grp": spread}).select(*names)
    done, round_no, wide, before = None, 0, groups > 1, None
    while True:
        state = stored(state.groupBy("grp").applyInArrow(_round(round_no, capacity, wide), _STATE))
        used = state.agg(F.count_distinct("sequence_id")).first()[0] if wide else None
        if before is not None and before - used < groups:
            wide = False
        settled = state if groups == 1 else state.where("not open")
        done = settled if done is None else done.union(settled)
        if groups == 1:
            return done.select(*(c.split()[0] for c in PACKED.split(", ")))
        state, round_no, before = state.where("open"), round_no + 1, None
        if wide and round_no < WIDE_ROUNDS:
            sent = state.agg(F.count("*").alias("n"), F.count_distinct("sequence_id").alias("used")).first()
            groups, before = max(1, -(-sent["n"] // per_group)), sent["used"]
            state = state.withColumn("grp", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).cast("long"))
        else:
            wide, groups = False, -(-groups // FAN_IN)
            state = state.withColumn("grp", F.floor(F.col("grp") / FAN_IN).cast("long"))


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences used, sequences proved necessary); the histogram has at most ``capacity`` rows."""
    used = packed.agg(F.count_distinct("sequence_id")).first()[0]
    counts = np.zeros(capacity + 1, np.int64)
    for row in packed.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return used, lower_bound(np.repeat(np.arange(capacity + 1), counts), capacity) if used else 0


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k", capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(pieces(docs, id_col, text_col, vocabulary, capacity)), capacity)
