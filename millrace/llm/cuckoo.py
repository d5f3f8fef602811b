"""A cuckoo filter over pairs of 64-bit hashes, filled in bulk."""

from __future__ import annotations

import numpy as np

SLOTS = 4
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _marks(k1: np.ndarray, k2: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint (1..65535) and first bucket."""
    mark = (k2.astype(np.uint64) >> np.uint64(16)) % np.uint64(65535) + np.uint64(1)
    first = ((k1.astype(np.uint64) * _GOLD) >> np.uint64(20)) & np.uint64(buckets - 1)
    return mark.astype(np.uint16), first.astype(np.int64)


def _other(bucket: np.ndarray, mark: np.ndarray, buckets: int) -> np.ndarray:
    jump = ((mark.astype(np.uint64) * _GOLD) >> np.uint64(24)) & np.uint64(buckets - 1)
    return bucket ^ jump.astype(np.int64)


def build(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Filter that holds all given (distinct) keys; shape (buckets, SLOTS), 0 is a free slot."""
    buckets = 1
    while buckets * SLOTS * 0.8 < len(k1):
        buckets *= 2
    while True:
        table = _fill(k1, k2, buckets)
        if table is not None:
            return table
        buckets *= 2


def _fill(k1: np.ndarray, k2: np.ndarray, buckets: int, rounds: int = 400) -> np.ndarray | None:
    table = np.zeros((buckets, SLOTS), np.uint16)
    mark, bucket = _marks(k1, k2, buckets)
    rng = np.random.default_rng(len(k1))
    for turn in range(rounds):
        if not len(mark):
            return table
        order = np.argsort(bucket, kind="stable")
        mark, bucket = mark[order], bucket[order]
        starts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1])
        rank = np.arange(len(bucket)) - np.repeat(starts, np.diff(np.append(starts, len(bucket))))
        free = table[bucket] == 0
        fits = rank < free.sum(axis=1)
        slot = np.argmax(np.cumsum(free, axis=1) == (rank + 1)[:, None], axis=1)
        table[bucket[fits], slot[fits]] = mark[fits]
        mark, bucket, rank = mark[~fits], bucket[~fits], rank[~fits]
        if turn % 2:  # both buckets tried: the first one waiting at a bucket takes a slot, its holder moves on
            lead = np.concatenate([[True], bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, bool)
            slot = rng.integers(0, SLOTS, len(bucket))[lead]
            pushed = table[bucket[lead], slot]
            table[bucket[lead], slot] = mark[lead]
            mark = mark.copy()
            mark[lead] = pushed
        bucket = _other(bucket, mark, buckets)
    return None


def contains(table: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """False means that a key was never put in; true may rarely be wrong."""
    mark, first = _marks(k1, k2, len(table))
    hit = (table[first] == mark[:, None]).any(axis=1)
    return hit | (table[_other(first, mark, len(table))] == mark[:, None]).any(axis=1)


def remove(table: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """The filter without keys that it holds; one slot is freed per key."""
    table = table.copy()
    mark, first = _marks(k1, k2, len(table))
    second = _other(first, mark, len(table))
    for m, a, b in zip(mark.tolist(), first.tolist(), second.tolist(), strict=True):
        for bucket in (a, b):
            at = np.flatnonzero(table[bucket] == m)
            if len(at):
                table[bucket, at[0]] = 0
                break
    return table
