"""Exact per-text counts used by the quality rules; plain functions on one text."""

from __future__ import annotations

import re
from functools import cached_property

import numpy as np

SYMBOLS = re.compile(r"[#*$%&|<>]")
_CONT = bytes(range(0x80, 0xC0))
_WINDOW = 8
_rng = np.random.default_rng(20240607)
_WEIGHTS = (_rng.integers(0, 2**63, _WINDOW, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def repeated_window_words(ids: np.ndarray, width: int = _WINDOW) -> int:
    """Number of positions covered by ``width``-windows that occur at least twice, the first occurrence included.

    Windows are sorted by a 64-bit hash; neighbours with equal hashes count as equal only if their ids are equal.
    """
    n = len(ids) - width + 1
    if n < 2:
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(ids, width)
    hashes = np.zeros(n, np.uint64)
    for k in range(width):
        hashes += ids[k : k + n].astype(np.uint64) * _WEIGHTS[k % _WINDOW]
    hashes ^= hashes >> np.uint64(32)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    at = np.flatnonzero(same)
    equal = (windows[order[at]] == windows[order[at + 1]]).all(axis=1)
    if not equal.all():  # a collision: compare the windows of the runs concerned themselves
        seen: dict[bytes, list[int]] = {}
        for i in np.unique(np.concatenate([order[at], order[at + 1]])):
            seen.setdefault(windows[i].tobytes(), []).append(int(i))
        starts = np.array([i for group in seen.values() if len(group) > 1 for i in group], dtype=np.int64)
    else:
        starts = np.unique(np.concatenate([order[at], order[at + 1]]))
    if not len(starts):
        return 0
    edge = np.zeros(len(ids) + 1, np.int32)
    edge[starts] += 1
    np.subtract.at(edge, starts + width, 1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


class TextView:
    """One text with counts computed on first use, so that a rule that is never reached costs nothing."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).translate(None, _CONT))

    @cached_property
    def n_symbols(self) -> int:
        return len(SYMBOLS.findall(self.text))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines that hold a word."""
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        if self.n_words <= _WINDOW:
            return 0
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in self.words), np.int64, self.n_words)
        return repeated_window_words(ids)

    @cached_property
    def letters(self) -> int:
        """ASCII letters and bytes of other scripts."""
        return len(_LETTER.findall(self.raw))

    @cached_property
    def n_alpha_words(self) -> int:
        return sum(1 for w in self.words if _LETTER.search(w))

    @cached_property
    def n_digits(self) -> int:
        return len(_DIGIT.findall(self.raw))


_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_DIGIT = re.compile(rb"[0-9]")
