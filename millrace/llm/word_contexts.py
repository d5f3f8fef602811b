"""Language model whose contexts are the words before, with the hash classes of ``lm_scoring`` between them and the root.

A token is drawn from the restaurant of the word before it.  The parent of that restaurant is the one of the word's
class, whose parent is the root.  A table of a word's restaurant is a customer of its class, a table of a class is a
customer of the root.

Pairs of words are counted per task and dealt by the word before into buckets, each within one class; a bucket is one
row of bytes, so the restaurants of a word are together.  A sweep brings every bucket the probabilities its class has
for the words in it, draws the tables of all pairs, and sends their sums to the rows of the words, where the tables of
the classes and of the root are drawn as in ``lm_scoring``.  Words are drawn at once, given the sums of the sweep
before.  After ``BURN_IN`` sweeps the predictive probabilities of ``KEEP`` states are averaged.

Pairs that came once have one table whatever is drawn, so only the others are swept.  ``score_documents`` scores the rows it
learns from: their texts are read once, the buckets keep which texts ask for a pair, and send sums by text.

For scoring other rows, a block asks each word once for its classes and each bucket once for its distinct pairs; the answers to
pairs come back in the order in which they were asked for.  Pairs of a bucket are told apart by 64-bit hashes.

Defined cases are those of ``lm_scoring``; a word that was not seen before another leaves all to its class.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import lm_scoring as lm
from millrace.llm import pitman_yor as py
from millrace.llm.lm_scoring import BLOCK_CHARS, BURN_IN, CONTEXTS, END, KEEP, SEED, Numbered, Setting, Sums, _binary, _bytes, _context
from millrace.llm.storage import block_count, drop_stored, forget_shuffles, stored

BUCKET_CHARS = 48_000_000
UNIT_TOKENS = 2_000_000
WORD_PARTS = 4  # per bucket of characters
ROUNDS = 4
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _bucket(hashes: np.ndarray, parts: int) -> np.ndarray:
    return _context(hashes) * parts + ((hashes.view(np.uint64) >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)


def _key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    mixed = (before.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ word.view(np.uint64)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _one(values: np.ndarray) -> pa.Array:
    """One row of bytes."""
    return pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())


def _cells(table: pa.Table, column: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in table.column(column)]


def _whole(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *_cells(table, column, kind)])


def _pairs_of(numbered: Numbered, place: np.ndarray, start: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all tokens, text after text, the places of the word before and of the word."""
    words = place[np.concatenate([np.zeros(0, np.int32), *numbered.ids])]
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum([0, *map(len, numbered.ids[:-1])])] = start
    return before, words


def _cut(b: np.ndarray) -> list[tuple[int, int]]:
    """Ends of the runs of equal values."""
    cuts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else np.zeros(1, np.int64)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


_END = np.array([lm.xxh64_intdigest(END)], np.uint64).view(np.int64)


def _small(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, each in as many bytes as the largest needs, compressed."""
    if not len(values):
        return b""
    data = values.astype(np.min_scalar_type(int(values.max()))).tobytes()
    return bytes([len(data) // len(values)]) + len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _large(data: bytes, kind=np.int64) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    return np.frombuffer(pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), codec="zstd"), f"<u{data[0]}").astype(kind)


def _row(schema: str, **cells) -> pa.RecordBatch:
    """One row; bytes of arrays as they are, of lists by ``_small``, what is not given is null."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names = [x.split() for x in schema.split(", ")]
    plain = {k: v.tobytes() if isinstance(v, np.ndarray) else _small(v[0]) if isinstance(v, list) else v for k, v in cells.items()}
    return pa.RecordBatch.from_arrays([pa.array([plain.get(name)], kinds[kind]) for name, kind in names], names=[name for name, _ in names])


def _starts(*sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(sorted_values[0]), bool)
    new[:1] = True
    for x in sorted_values:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _lengths(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n)).astype(np.int64)


#: What a unit of texts sends to a bucket: its words before (v) with the numbers of their pairs (n), its words (w), and
#: per pair the place of its word (at) and its count in training (c).  For scoring also the number of texts of a pair (m),
#: and per pair and text the text's place in the unit (doc) and the count there (k).  The ids of the unit's texts go, as
#: ``v``, into a row below zero, with marks for nulls as ``n``.
_COUNTS = "b int, unit long, v binary, n binary, w binary, at binary, c binary, m binary, doc binary, k binary"


def bucket_counts(docs: DataFrame, parts: int, texts: bool = False) -> DataFrame:
    """Pairs of neighbouring words with their counts in the training rows, one row per bucket and unit.

    With ``texts`` pairs of all rows are sent, each with the texts it comes in."""

    def counted(seen: Numbered, ids: list, task: int, unit: int):
        hashes = seen.hashes()
        n, d = len(hashes), len(ids)
        by_bucket, by_hash = np.lexsort((hashes, _bucket(hashes, parts))), np.argsort(hashes)
        first, second = np.empty(n, np.int64), np.empty(n, np.int64)
        first[by_bucket] = second[by_hash] = np.arange(n)
        number, sizes, end = np.concatenate(seen.ids), [len(x) for x in seen.ids], seen.number[END]
        seen.ids.clear()
        seen.number.clear()
        keys = np.empty(len(number), np.int64)  # made and sorted in place, as a unit's tokens are many
        keys[1:] = first[number[:-1]]
        keys[np.cumsum([0, *sizes[:-1]])] = first[end]
        keys *= n
        keys += second[number]
        del number
        if texts:
            keys *= d
            keys += np.repeat(np.arange(d, dtype=np.int32), sizes)
        keys.sort()
        start = _starts(keys)
        k, keys = _lengths(start, len(keys)).astype(np.int32), keys[start]
        doc = (keys % d).astype(np.int32) if texts else None
        if texts:
            keys //= d
        start = _starts(keys)
        train = np.array([not lm.is_held_out(x) for x in ids])
        c = np.add.reduceat(k * train[doc], start) if texts else k
        m, edge = _lengths(start, len(keys)), np.append(start, len(keys))
        keys = keys[start]
        v, w = keys // n, keys % n
        of_first, of_second = hashes[by_bucket], hashes[by_hash]
        b = _bucket(of_first, parts)[v]
        for low, high in _cut(b):
            runs = _starts(v[low:high])
            some, at = np.unique(w[low:high], return_inverse=True)
            kept = {"m": [m[low:high]], "doc": [doc[edge[low] : edge[high]]], "k": [k[edge[low] : edge[high]]]} if texts else {}
            yield _row(
                _COUNTS, b=int(b[low]), unit=unit, v=of_first[v[low:high][runs]], n=[_lengths(runs, high - low)], w=of_second[some], at=[at], c=[c[low:high]], **kept
            )
        if texts:
            yield _row(_COUNTS, b=-1 - task, unit=unit, v=np.array([x or 0 for x in ids], np.int64), n=[np.array([x is None for x in ids])])

    def go(batches):
        task = TaskContext.get().partitionId()
        unit, seen, ids = task << 24, Numbered(), []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if texts or not lm.is_held_out(doc_id):
                    seen.add(text)
                    ids.append(doc_id)
                if len(seen.number) > lm._FLUSH_WORDS or seen.n_tokens > UNIT_TOKENS:
                    yield from counted(seen, ids, task, unit)
                    unit, seen, ids = unit + 1, Numbered(), []
        if ids:
            yield from counted(seen, ids, task, unit)

    return docs.select("doc_id", "text").mapInArrow(go, _COUNTS)


#: A bucket: its words before (v) with the numbers of their pairs (n), sorted; per pair the word and its customers; and sums.
#: For scoring, pairs that are not in training (xv, xw), which of all pairs are (trained), and per unit that asks (units)
#: how many pairs (sizes), by their places among all pairs (ref, as differences), with the m, doc and k of ``_COUNTS``.
#: A row below zero has the ids of a unit's texts as ``xv`` and its marks for nulls as ``trained``.
_PAIRS = (
    "b int, unit long, v binary, n binary, w binary, c binary, n_tokens long, once long, twice long, "
    "xv binary, xw binary, trained binary, units binary, sizes binary, ref binary, m binary, doc binary, k binary"
)


def buckets(counts: DataFrame) -> DataFrame:
    """The pairs of each bucket with their counts in training, and where the units ask for them."""

    def go(table: pa.Table) -> pa.Table:
        b = table.column("b")[0].as_py()
        if b < 0:
            rows = zip(*(table.column(x).to_pylist() for x in ("unit", "v", "n")), strict=True)
            return pa.Table.from_batches([_row(_PAIRS, b=b, unit=unit, xv=v, trained=n) for unit, v, n in rows])
        vs, ws = _cells(table, "v", np.int64), _cells(table, "w", np.int64)
        before, words = np.unique(np.concatenate(vs)), np.unique(np.concatenate(ws))
        keys = []
        for v, w, n, at in zip(vs, ws, table.column("n").to_pylist(), table.column("at").to_pylist(), strict=True):
            keys.append(np.repeat(np.searchsorted(before, v), _large(n)) * len(words) + np.searchsorted(words, w)[_large(at)])
        sizes = np.array([len(x) for x in keys])
        pairs, ref = np.unique(np.concatenate(keys), return_inverse=True)
        keys.clear()
        c = np.bincount(ref, np.concatenate([_large(x, np.int32) for x in table.column("c").to_pylist()]), len(pairs)).astype(np.int64)
        trained = c > 0
        v, w, c = before[pairs // len(words)], words[pairs % len(words)], c[trained]
        kept = {}
        if table.column("m").null_count < table.num_rows:
            first = np.cumsum(sizes) - sizes
            begin = ref[first]
            ref[1:] = np.diff(ref)
            ref[first] = begin
            of_texts = {x: _small(np.concatenate([_large(y, np.int32) for y in table.column(x).to_pylist()])) for x in ("m", "doc", "k")}
            units = table.column("unit").to_numpy().astype(np.int64)
            kept = {"xv": v[~trained], "xw": w[~trained], "trained": [trained], "units": units, "sizes": [sizes], "ref": _small(ref), **of_texts}
        del ref
        v, w = v[trained], w[trained]
        start = _starts(v)
        sums = {"n_tokens": int(c.sum()), "once": int((c == 1).sum()), "twice": int((c == 2).sum())}
        return pa.Table.from_batches([_row(_PAIRS, b=b, v=v[start], n=_lengths(start, len(v)), w=w, c=c.astype("<i4"), **sums, **kept)])

    return counts.groupBy("b").applyInArrow(go, _PAIRS)


#: Pairs that came twice or more in a bucket; those that came once have one table and need no sweep.  Per word before that has
#: such pairs: how many (n), its customers (total), its pairs that came once (ones); the pairs as in ``_BUCKET``.
_HEAVY = "b int, n binary, total binary, ones binary, w binary, c binary, t binary, kept binary, back binary"


def heavy_pairs(state: DataFrame) -> DataFrame:
    """The seating before the first sweep: one table per pair."""

    def go(batches):
        for row in _rows(batches):
            n, w, c = _cells(row, "n", np.int64)[0], _cells(row, "w", np.int64)[0], _cells(row, "c", "<i4")[0].astype(np.int64)
            at = np.repeat(np.arange(len(n)), n)
            many = np.flatnonzero(c > 1)
            size = np.bincount(at[many], minlength=len(n))
            has = np.flatnonzero(size)
            if len(has):
                total, ones = np.bincount(at, c, len(n)).astype(np.int64)[has], np.bincount(at[c == 1], minlength=len(n))[has]
                t = np.ones(len(many), "<i4")
                yield _row(_HEAVY, b=row.column("b")[0].as_py(), n=size[has], total=total, ones=ones, w=w[many], c=c[many].astype("<i4"), t=t, kept=0 * t, back=t[:0])

    return state.select("b", "n", "w", "c").mapInArrow(go, _HEAVY)


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield pa.Table.from_batches([batch.slice(k, 1)])
    pa.default_memory_pool().release_unused()


@dataclass
class _Heavy:
    """A row of ``_HEAVY`` as arrays; ``at`` is the word before of a pair."""

    table: pa.Table

    def __post_init__(self):
        self.b = self.table.column("b")[0].as_py()
        self.n, self.total, self.ones, self.w = (_cells(self.table, k, np.int64)[0] for k in ("n", "total", "ones", "w"))
        self.c, self.t, self.kept = (_cells(self.table, k, "<i4")[0].astype(np.int64) for k in ("c", "t", "kept"))
        self.back = _cells(self.table, "back", "<i4")[0].reshape(len(self.n), -1)
        self.at = np.repeat(np.arange(len(self.n)), self.n)
        self.tables = np.bincount(self.at, self.t, len(self.n)).astype(np.int64) + self.ones

    def with_columns(self, **new: np.ndarray) -> pa.Table:
        names = self.table.column_names
        return pa.table([_one(new[k].astype("<i4")) if k in new else self.table.column(k).combine_chunks() for k in names], names=names)


def _by_part(w: np.ndarray, word_parts: int):
    """Places of the words of each part of the words."""
    part = ((w.view(np.uint64) >> np.uint64(4)) % np.uint64(word_parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    for low, high in _cut(part[order]):
        yield int(part[order[low]]), order[low:high]


#: Words of a class in a bucket: their pairs, pairs that came once, and tokens.
_FIRST = "k int, u int, w binary, pairs binary, ones binary, total binary"
#: A part of the words: the words (wh) with the numbers of their classes (n), sorted, their tokens and tables at the root;
#: per word and class the class (u), its pairs that came once, its customers and tables; and c, t and root_t of the kept states.
#: Classes, and words, that only texts kept out of training ask for have no customers.
_WORDS = "k int, wh binary, n binary, total binary, root_t binary, u binary, ones binary, c binary, t binary, cs binary, ts binary, roots binary"


def first_words(state: DataFrame, parts: int, word_parts: int) -> DataFrame:
    """The words before the first sweep: one table per word and class."""

    def send(batches):
        for row in _rows(batches):
            w, c = _cells(row, "w", np.int64)[0], _cells(row, "c", "<i4")[0].astype(np.int64)
            more = _whole(row.filter(pa.compute.is_valid(row.column("xw"))), "xw", np.int64)
            words, place = np.unique(np.concatenate([w, more]), return_inverse=True)
            place = place[: len(w)]
            pairs, ones, total = (np.bincount(place, x, len(words)).astype(np.int64) for x in (c > 0, c == 1, c))
            for k, at in _by_part(words, word_parts):
                yield _row(_FIRST, k=k, u=row.column("b")[0].as_py() // parts, w=words[at], pairs=[pairs[at]], ones=[ones[at]], total=[total[at]])

    def go(table: pa.Table) -> pa.Table:
        ws = _cells(table, "w", np.int64)
        w, u = np.concatenate(ws), np.repeat(table.column("u").to_numpy(), [len(x) for x in ws])
        sums = [np.concatenate([_large(x) for x in table.column(name).to_pylist()]) for name in ("pairs", "ones", "total")]
        order = np.lexsort((u, w))
        w, u = w[order], u[order]
        start = _starts(w, u)
        pairs, ones, total = (np.add.reduceat(x[order], start) for x in sums)
        w, u = w[start], u[start]
        of_word = _starts(w)
        t = (pairs > 0).astype("<i4")
        cells = {"total": np.add.reduceat(total, of_word), "root_t": (np.add.reduceat(t, of_word) > 0).astype("<i4"), "u": u.astype(np.uint8), "ones": ones.astype("<i4")}
        none = np.zeros(0, "<i4")
        return pa.Table.from_batches([_row(_WORDS, k=table.column("k")[0].as_py(), wh=w[of_word], n=_lengths(of_word, len(w)), **cells, c=pairs.astype("<i4"), t=t, cs=none, ts=none, roots=none)])

    return state.select("b", "w", "c", "xw").mapInArrow(send, _FIRST).groupBy("k").applyInArrow(go, _WORDS)


@dataclass
class _Seats:
    """Words with their classes, as ``lm_scoring._Rows`` has them; ``row`` is the word of a pair."""

    n: np.ndarray
    u: np.ndarray
    c: np.ndarray
    t: np.ndarray
    root_t: np.ndarray

    def __post_init__(self):
        self.row = np.repeat(np.arange(len(self.n)), self.n)
        self.root_c = self.sums(self.t)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, values, len(self.n)).astype(np.int64)


class _Words:
    """A row of ``_WORDS`` as arrays."""

    def __init__(self, table: pa.Table):
        self.table, self.k = table, table.column("k")[0].as_py()
        self.wh, self.n, self.total = (_cells(table, x, np.int64)[0] for x in ("wh", "n", "total"))
        self.u = _cells(table, "u", np.uint8)[0]
        self.ones, self.c, self.t, self.root_t = (_cells(table, x, "<i4")[0].astype(np.int64) for x in ("ones", "c", "t", "root_t"))
        self.all = _Seats(self.n, self.u, self.c, self.t, self.root_t)

    def past(self) -> list[_Seats]:
        """The kept states."""
        cs, ts, roots = (_cells(self.table, x, "<i4")[0].astype(np.int64) for x in ("cs", "ts", "roots"))
        cs, ts, roots = cs.reshape(-1, len(self.c)), ts.reshape(-1, len(self.c)), roots.reshape(-1, len(self.n))
        return [_Seats(self.n, self.u, c, t, root_t) for c, t, root_t in zip(cs, ts, roots, strict=True)]

    def trained(self, c: np.ndarray):
        """Parts of the words of training, each with its places among words and pairs, without classes that have no customers."""
        pairs = np.flatnonzero(self.c)
        n = np.bincount(self.all.row[pairs], minlength=len(self.n))
        words = np.flatnonzero(n)
        edge = np.concatenate([[0], np.cumsum(n[words])])
        for low in range(0, len(words), _DRAWN):
            word = words[low : low + _DRAWN]
            pair = pairs[edge[low] : edge[low + len(word)]]
            yield word, pair, _Seats(n[word], self.u[pair], c[pair], self.t[pair], self.root_t[word])


_DRAWN = 10_000  # words drawn from one stream of random numbers


def _trained(batch: pa.RecordBatch):
    for row in _rows([batch]):
        x = _Words(row)
        for _, _, seats in x.trained(x.c):
            yield seats


def customers(heavy: DataFrame, parts: int, word_parts: int) -> DataFrame:
    """(k, u, w, n): tables of the words of a bucket, over the pairs that came twice or more."""

    def go(batches):
        for x in map(_Heavy, _rows(batches)):
            words, place = np.unique(x.w, return_inverse=True)
            n = np.bincount(place, x.t, len(words)).astype(np.int64)
            for k, at in _by_part(words, word_parts):
                yield _row("k int, u int, w binary, n binary", k=k, u=x.b // parts, w=words[at], n=[n[at]])

    return heavy.mapInArrow(go, "k int, u int, w binary, n binary")


def _class_p(x: _Seats, setting: Setting, sums: Sums) -> tuple[np.ndarray, np.ndarray]:
    """Of some words: the root's probabilities by word, and those of the classes by pair."""
    root = setting.root(sums, x.root_c, x.root_t)
    return root, (x.c - setting.d * x.t) / (setting.strength + setting.customers[x.u]) + setting.back(sums)[x.u] * root[x.row]


def _to_buckets(said: DataFrame, parts: int, *columns: str) -> DataFrame:
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    return said.select("u", part.alias("part"), *columns).select((F.col("u") * parts + F.col("part")).cast("int").alias("b"), *columns)


def _by_class(u: np.ndarray, places: np.ndarray):
    order = places[np.argsort(u[places], kind="stable")]
    for low, high in _cut(u[order]):
        yield int(u[order[low]]), order[low:high]


def told(words: DataFrame, setting: Setting, sums: Sums, parts: int) -> DataFrame:
    """(b, w, p): what the class of a bucket says of the words of pairs that came twice or more, some words a row."""

    def go(batches):
        for x in map(_Words, _rows(batches)):
            p = _class_p(x.all, setting, sums)[1].astype("<f4")
            for u, at in _by_class(x.u, np.flatnonzero(x.c > x.ones)):
                yield _row("u int, w binary, p binary", u=u, w=x.wh[x.all.row[at]], p=p[at])

    return _to_buckets(words.mapInArrow(go, "u int, w binary, p binary"), parts, "w", "p")


def _parent(x: _Heavy, said: pa.Table) -> np.ndarray:
    """The class's probability of the word of each pair."""
    w, p = _whole(said, "w", np.int64), _whole(said, "p", "<f4")
    order = np.argsort(w)
    return p[order][np.searchsorted(w[order], x.w)].astype(np.float64)


def _best_strength(state: DataFrame, heavy: DataFrame, said: DataFrame, d: float) -> float:
    """Strength of the words' restaurants that predicts every token best from all the others.

    What the classes say of pairs that came once is the same for all strengths and left out."""

    def once(batches):
        sums = np.zeros(len(lm.STRENGTHS))
        for row in _rows(batches):
            n, c = _cells(row, "n", np.int64)[0], _cells(row, "c", "<i4")[0].astype(np.int64)
            at = np.repeat(np.arange(len(n)), n)
            total, ones = np.bincount(at, c, len(n)), np.bincount(at[c == 1], minlength=len(n))
            has = np.flatnonzero(ones)
            one = np.ones(len(has))
            sums += [(ones[has] * py.left_out_log(one, total[has], n[has], one, d, s)).sum() for s in lm.STRENGTHS]
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(sums)), "s": sums})

    def go(left: pa.Table, right: pa.Table) -> pa.Table:
        sums = np.zeros(len(lm.STRENGTHS))
        if left.num_rows:
            x = _Heavy(left)
            p, total, n = _parent(x, right), x.total[x.at], (x.n + x.ones)[x.at]
            sums += [py.left_out_log(x.c, total, n, p, d, s).sum() for s in lm.STRENGTHS]
        return pa.table({"k": np.arange(len(sums)), "s": sums})

    parts = [state.select("n", "c").mapInArrow(once, "k long, s double"), heavy.groupBy("b").cogroup(said.groupBy("b")).applyInArrow(go, "k long, s double")]
    rows = parts[0].union(parts[1]).groupBy("k").agg(F.sum("s").alias("s")).collect()
    return lm.STRENGTHS[max(rows, key=lambda r: r["s"])["k"]] if rows else lm.STRENGTHS[0]


def _pair_sweep(heavy: DataFrame, said: DataFrame, d: float, strength: float, turn: int, keep: bool) -> DataFrame:
    """Take down the present seating if it is kept, then draw the tables of the pairs anew."""

    def go(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left
        x = _Heavy(left)
        kept = {"kept": x.kept + x.t, "back": np.column_stack([x.back, x.tables])} if keep else {}
        rng = np.random.default_rng([SEED, turn, x.b])
        t = py.draw_tables(x.c, d, strength + d * (x.tables[x.at] - x.t), np.log(_parent(x, right)), rng)
        return x.with_columns(t=t, **kept)

    return heavy.groupBy("b").cogroup(said.groupBy("b")).applyInArrow(go, _HEAVY)


def _class_sweep(words: DataFrame, fresh: DataFrame, setting: Setting, sums: Sums, turn: int, keep: bool) -> DataFrame:
    """The same for classes and root; ``fresh`` has the new tables of the pairs."""

    def go(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left
        x = _Words(left)
        c = x.ones.copy()
        ws = _cells(right, "w", np.int64)
        if ws:
            u = np.repeat(right.column("u").to_numpy(), [len(w) for w in ws])
            at = np.searchsorted(x.all.row * CONTEXTS + x.u, np.searchsorted(x.wh, np.concatenate(ws)) * CONTEXTS + u)
            c += np.bincount(at, np.concatenate([_large(n) for n in right.column("n").to_pylist()]), len(c)).astype(np.int64)
        new = {"c": c, "t": x.t.copy(), "root_t": x.root_t.copy()}
        for word, pair, old in x.trained(x.c):
            root = _class_p(old, setting, sums)[0]
            rng = np.random.default_rng([SEED, turn, abs(int(x.wh[word[0]])), len(word)])
            new["t"][pair] = py.draw_tables(c[pair], setting.d, setting.strength + setting.d * (sums.tables[old.u] - old.t), np.log(root)[old.row], rng)
            strength = setting.root_strength + setting.root_d * (sums.root_tables - old.root_t)
            new["root_t"][word] = py.draw_tables(old.sums(new["t"][pair]), setting.root_d, strength, np.full(len(word), -np.log(setting.n_words + 1)), rng)
        if keep:
            new |= {past: np.concatenate([_cells(left, past, "<i4")[0], now]) for past, now in (("cs", x.c), ("ts", x.t), ("roots", x.root_t))}
        names = left.column_names
        return pa.table([_one(new[name].astype("<i4")) if name in new else left.column(name).combine_chunks() for name in names], names=names)

    return words.groupBy("k").cogroup(fresh.groupBy("k")).applyInArrow(go, _WORDS)


@dataclass
class _Learned:
    heavy: DataFrame
    words: DataFrame  # with all kept states but the last, which is c, t and root_t
    states: list[tuple[Setting, Sums]]  # the kept ones
    n_tokens: int
    n_words: int
    d: float
    strength: float

    def classes(self, x: _Words) -> tuple[np.ndarray, np.ndarray]:
        """In the kept states, the root's probabilities by word and those of the classes by pair."""
        both = [_class_p(seats, setting, sums) for seats, (setting, sums) in zip([*x.past(), x.all], self.states, strict=True)]
        return np.column_stack([root for root, _ in both]).astype("<f4"), np.column_stack([p for _, p in both]).astype("<f4")

    def plain(self) -> _Learned:
        """Without the tables, to be sent to tasks."""
        return replace(self, heavy=None, words=None)


def _setting(words: DataFrame, setting: Setting | None) -> tuple[Setting, Sums]:
    found = lm._totals(words, _trained)
    root_tables, n_words, once, twice, root_once, root_twice = (int(x) for x in found["few"])
    sums = Sums(found["tables"], root_tables)
    if setting is not None:
        return replace(setting, customers=found["customers"]), sums
    d, root_d = py.discount(once, twice), py.discount(root_once, root_twice)
    strength = lm._strength(words, found["customers"], found["tables"], d, n_words, _trained)

    def widths(batches):
        n = np.zeros(CONTEXTS + 1, np.int64)
        for x in (x for batch in batches for x in _trained(batch)):
            n += np.bincount(x.n, minlength=CONTEXTS + 1)
        yield pa.RecordBatch.from_pydict({"c": np.flatnonzero(n), "n": n[n > 0]})

    rows = words.mapInArrow(widths, "c long, n long").groupBy("c").agg(F.sum("n")).orderBy("c").collect()  # at most CONTEXTS rows
    root_strength = lm._best_root_strength(*(np.array([r[k] for r in rows], np.float64) for k in (0, 1)), root_d, n_words)
    return Setting(found["customers"], n_words, d, strength, root_d, root_strength), sums


def _learn(state: DataFrame, parts: int, word_parts: int, burn_in: int, keep: int) -> _Learned:
    spark = state.sparkSession
    n_tokens, once, twice = (int(x or 0) for x in state.agg(F.sum("n_tokens"), F.sum("once"), F.sum("twice")).first())
    heavy = stored(heavy_pairs(state))
    words = stored(first_words(state, parts, word_parts))
    forget_shuffles(spark)
    setting, sums = _setting(words, None)
    d = py.discount(once, twice)
    strength = _best_strength(state, heavy, told(words, setting, sums, parts), d)
    states = []
    for turn in range(burn_in + keep):
        kept = turn >= burn_in
        if kept:
            states.append((setting, sums))
        if turn == burn_in + keep - 1:
            break
        new = stored(_pair_sweep(heavy, told(words, setting, sums, parts), d, strength, turn, kept))
        drop_stored(heavy)
        heavy = new
        swept = stored(_class_sweep(words, customers(heavy, parts, word_parts), setting, sums, turn, kept))
        drop_stored(words)
        words = swept
        setting, sums = _setting(words, setting)
        forget_shuffles(spark)
    return _Learned(heavy, words, states, n_tokens, setting.n_words, d, strength)


@dataclass
class _Seating:
    """The pairs of a bucket with their tables, all kept states taken together, and of its words before the tables in each."""

    v: np.ndarray
    n: np.ndarray
    w: np.ndarray
    c: np.ndarray
    t: np.ndarray
    kept: np.ndarray
    back: np.ndarray  # in the last state too

    @classmethod
    def of(cls, row: pa.Table, heavy: pa.Table, keep: int) -> _Seating:
        v, n, w = (_cells(row, k, np.int64)[0] for k in ("v", "n", "w"))
        c = _cells(row, "c", "<i4")[0].astype(np.int64)
        t, kept, back = np.ones(len(c), np.int64), np.full(len(c), keep - 1), np.repeat(n[:, None], keep, axis=1)
        if heavy.num_rows:
            x, many = _Heavy(heavy), c > 1
            t[many], kept[many] = x.t, x.kept
            back[np.unique(np.repeat(np.arange(len(n)), n)[many])] = np.column_stack([x.back, x.tables])
        return cls(v, n, w, c, t, kept, back)


#: A bucket of a model: words before (v) with the numbers of their pairs (n), sorted; per pair the word, customers, tables, and
#: tables over the kept states but the last; per word before its tables in these (back, K - 1 numbers each).
_BUCKET = "b int, v binary, n binary, w binary, c binary, t binary, kept binary, back binary"


@dataclass
class _Bucket:
    """A bucket's row as arrays; ``at`` is the word before of a pair."""

    table: pa.Table

    def __post_init__(self):
        self.b = self.table.column("b")[0].as_py()
        self.v, self.n, self.w = (_cells(self.table, k, np.int64)[0] for k in ("v", "n", "w"))
        self.c, self.t, self.kept = (_cells(self.table, k, "<i4")[0].astype(np.int64) for k in ("c", "t", "kept"))
        self.back = _cells(self.table, "back", "<i4")[0].reshape(len(self.v), -1)
        self.at = np.repeat(np.arange(len(self.n)), self.n)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, values, len(self.n)).astype(np.int64)


@dataclass
class Model:
    buckets: DataFrame  # with all kept states but the last, which is ``t``
    words: DataFrame  # wh, c, roots, pairs: a byte for the class and its probabilities in the kept states
    n_tokens: int
    n_words: int
    d: float
    strength: float
    back: np.ndarray  # kept state, class: share of the root
    unknown: np.ndarray  # by kept state: the root's probability of a word that was not seen
    parts: int


def _model_words(learned: _Learned, words: DataFrame) -> DataFrame:
    keep = len(learned.states)

    def go(batches):
        for x in map(_Words, _rows(batches)):
            root, p = learned.classes(x)
            pairs = np.column_stack([x.u, p.view(np.uint8).reshape(len(p), 4 * keep)])
            for low in range(0, len(x.n), 100_000):
                part = slice(low, low + 100_000)
                rows = x.all.row[np.searchsorted(x.all.row, low) : np.searchsorted(x.all.row, low + 100_000)]
                cells = pairs[np.searchsorted(x.all.row, low) :][: len(rows)]
                arrays = [pa.array(x.wh[part]), pa.array(x.total[part]), *(pa.array(q) for q in np.ascontiguousarray(root[part].T))]
                yield pa.RecordBatch.from_arrays([*arrays, _binary(cells.ravel(), (1 + 4 * keep) * x.n[part])], names=["wh", "c", *lm._roots(keep), "pairs"])

    return words.mapInArrow(go, "wh long, c long, " + "".join(f"{q} float, " for q in lm._roots(keep)) + "pairs binary")


def learn(docs: DataFrame, burn_in: int = BURN_IN, keep: int = KEEP, chars_per_bucket: int = BUCKET_CHARS) -> Model:
    """Model of the training rows of ``docs`` (doc_id, text)."""
    blocks = block_count(docs, chars_per_block=chars_per_bucket)
    parts = -(-blocks // CONTEXTS)
    state = stored(buckets(bucket_counts(docs, parts)))
    learned = _learn(state, parts, WORD_PARTS * blocks, burn_in, keep)

    def seated(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _Seating.of(left, right, keep)
        cells = {k: getattr(x, k).astype("<i4") for k in ("c", "t", "kept")}
        return pa.Table.from_batches([_row(_BUCKET, b=left.column("b")[0].as_py(), v=x.v, n=x.n, w=x.w, **cells, back=np.ascontiguousarray(x.back[:, :-1].astype("<i4")))])

    rows = stored(state.select("b", "v", "n", "w", "c").groupBy("b").cogroup(learned.heavy.groupBy("b")).applyInArrow(seated, _BUCKET))
    table = stored(_model_words(learned.plain(), learned.words))
    for spent in (state, learned.heavy, learned.words):
        drop_stored(spent)
    forget_shuffles(docs.sparkSession)
    back, unknown = [s.back(sums) for s, sums in learned.states], [s.root(sums, 0, 0) for s, sums in learned.states]
    return Model(rows, table, learned.n_tokens, learned.n_words, learned.d, learned.strength, np.array(back), np.array(unknown), parts)


def _order(numbered: Numbered, parts: int):
    """Distinct words by hash, and for all tokens the place of the pair among the distinct pairs by bucket, word before and word."""
    hashes = numbered.hashes()
    distinct, place = np.unique(hashes, return_inverse=True)
    n = len(distinct)
    before, words = _pairs_of(numbered, place, int(np.searchsorted(distinct, _END[0])), n)
    keys, token = np.unique(before * n + words, return_inverse=True)
    v, w = keys // n, keys % n
    b = _bucket(distinct, parts)[v]
    order = np.argsort(b, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return distinct, v[order], w[order], b[order], rank[token]


def _asked_pairs(parts: int):
    """Per block and bucket: the words before, how many pairs each has, and the pairs' hashes."""

    def go(batches):
        seen: dict[int, Numbered] = {}
        for batch in batches:
            for text, block in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                seen.setdefault(block, Numbered()).add(text)
        while seen:
            block, numbered = seen.popitem()
            distinct, v, w, b, _ = _order(numbered, parts)
            for low, high in _cut(b):
                places, n = np.unique(v[low:high], return_counts=True)
                key = _key(distinct[v[low:high]], distinct[w[low:high]])
                arrays = [pa.array([b[low]], pa.int32()), pa.array([block], pa.int32()), _one(distinct[places]), _one(n.astype("<i4")), _one(key)]
                yield pa.RecordBatch.from_arrays(arrays, names=["b", "block", "v", "n", "keys"])

    return go


def _answer_pairs(model: Model):
    """What each pair is worth on its own, and per word before what it leaves to its class in the kept states."""
    d, s, keep = model.d, model.strength, len(model.unknown)

    def go(left: pa.Table, right: pa.Table) -> pa.Table:
        known, worth = np.zeros(0, np.uint64), np.zeros(0, np.float32)
        words, shares = np.zeros(0, np.int64), np.zeros((0, keep), np.float32)
        if left.num_rows:
            x = _Bucket(left)
            total = s + x.sums(x.c)
            key = _key(x.v[x.at], x.w)
            order = np.argsort(key)
            known, worth = key[order], ((x.c - d * (x.kept + x.t) / keep) / total[x.at])[order].astype(np.float32)
            words, shares = x.v, ((s + d * np.column_stack([x.back, x.sums(x.t)])) / total[:, None]).astype(np.float32)
        out_p, out_share = [], []
        for v, keys in zip(_cells(right, "v", np.int64), _cells(right, "keys", np.uint64), strict=True):
            p, share = np.zeros(len(keys), "<f4"), np.ones((len(v), keep), "<f4")
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                p = np.where(known[at] == keys, worth[at], p).astype("<f4")
                at = np.minimum(np.searchsorted(words, v), len(words) - 1)
                share = np.where((words[at] == v)[:, None], shares[at], share).astype("<f4")
            out_p.append(p.tobytes())
            out_share.append(share.tobytes())
        return pa.table({"b": right.column("b"), "block": right.column("block"), "worth": pa.array(out_p, pa.binary()), "shares": pa.array(out_share, pa.binary())})

    return go


def _answered(width: int):
    """Of each word only the classes that were asked for; the last two columns are the mask and the pairs."""

    def go(batches):
        for batch in batches:
            mask = batch.column(batch.num_columns - 2).to_numpy().view(np.uint64)
            data, size = _bytes(batch.column(batch.num_columns - 1))
            pairs, row = data.reshape(-1, width), np.repeat(np.arange(len(size)), size // width)
            wanted = (mask[row] >> pairs[:, 0].astype(np.uint64)) & np.uint64(1) > 0
            left = _binary(pairs[wanted].ravel(), width * np.bincount(row[wanted], minlength=len(size)))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], left], names=[*names[:-2], names[-1]])

    return go


def score(docs: DataFrame, model: Model, chars_per_block: int = BLOCK_CHARS, spent: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and log10 probabilities of its tokens.

    With ``spent`` the tables of the model are deleted once they have answered."""
    blocks = block_count(docs, chars_per_block=chars_per_block)
    block = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int")
    dealt = docs.select("doc_id", "text", block.alias("block")).repartition(blocks, "block")
    parts, n, base_total = model.parts, model.n_tokens, model.n_tokens + model.n_words + 1
    back, unknown, keep = model.back, model.unknown, len(model.unknown)
    roots, width = lm._roots(keep), 1 + 4 * keep
    floats = "".join(f"{q} float, " for q in roots)

    # The answers are stored one kind after the other, so that what was moved for one is off the disks before the next.
    asked = dealt.mapInArrow(lm._asked, "block int, place int, h long, mask long")
    found = asked.join(model.words.hint("shuffle_hash"), F.col("h") == F.col("wh")).select("block", "place", "c", *roots, "mask", "pairs")
    by_word = stored(found.mapInArrow(_answered(width), f"block int, place int, c long, {floats}pairs binary"))
    if spent:
        drop_stored(model.words)
    forget_shuffles(docs.sparkSession)
    pairs = dealt.mapInArrow(_asked_pairs(parts), "b int, block int, v binary, n binary, keys binary")
    by_pair = stored(model.buckets.groupBy("b").cogroup(pairs.groupBy("b")).applyInArrow(_answer_pairs(model), "b int, block int, worth binary, shares binary"))
    if spent:
        drop_stored(model.buckets)
    forget_shuffles(docs.sparkSession)
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("b", "int"), ("worth", "binary"), ("shares", "binary"))]
    blank = [F.lit(None).cast(kind).alias(name) for name, kind in (("place", "int"), ("c", "long"), *((q, "float") for q in roots), ("pairs", "binary"))]
    answers = by_word.select("*", *none).unionByName(by_pair.select("*", *blank))

    def sums(texts: pa.Table, answers: pa.Table) -> pa.Table:
        numbered = Numbered()
        for text in texts.column("text").to_pylist():
            numbered.add(text)
        distinct, v, w, b, token = _order(numbered, parts)
        of_words = answers.filter(pa.compute.is_valid(answers.column("place")))
        of_pairs = answers.filter(pa.compute.is_valid(answers.column("b"))).sort_by("b")
        at = of_words.column("place").to_numpy().astype(np.int64)
        c = np.zeros(len(distinct), np.int64)
        root = np.tile(unknown.astype("<f4"), (len(distinct), 1))
        classes = _context(distinct)[v]
        known = np.full((len(distinct) * CONTEXTS, keep), np.nan, "<f4")  # dense by word and class of the block
        if len(at):
            c[at] = of_words.column("c").to_numpy()
            root[at] = np.column_stack([of_words.column(q).to_numpy() for q in roots])
            data, size = _bytes(of_words.column("pairs").combine_chunks())
            rows = data.reshape(-1, width)
            known[np.repeat(at, size // width) * CONTEXTS + rows[:, 0]] = np.ascontiguousarray(rows[:, 1:]).view("<f4")
        p = np.zeros(len(v))
        for nth, (low, high) in enumerate(_cut(b)):
            worth = np.frombuffer(of_pairs.column("worth")[nth].as_buffer(), "<f4")
            shares = np.frombuffer(of_pairs.column("shares")[nth].as_buffer(), "<f4").reshape(-1, keep)
            mine = np.cumsum(np.concatenate([[0], v[low + 1 : high] != v[low : high - 1]]))
            here = known[w[low:high] * CONTEXTS + classes[low:high]].astype(np.float64)
            less = back[:, classes[low:high]].T * root[w[low:high]]
            p[low:high] = worth + (shares[mine] * np.where(np.isnan(here), less, here)).mean(axis=1)
        words = w[token]
        ends = np.cumsum([len(k) for k in numbered.ids])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        ids = texts.column("doc_id").to_pylist()
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()),
            "held_out": pa.array(map(lm.is_held_out, ids), pa.bool_()),
            "n_tokens": pa.array(ends - starts),
            "n_known": pa.array(np.add.reduceat((c[words] > 0).astype(np.int64), starts)),
            "train_tokens": pa.array([n] * len(ids), pa.int64()),
            "base_score": pa.array(np.add.reduceat(np.log10((c + 1) / base_total)[words], starts)),
            "score": pa.array(np.add.reduceat(np.log10(np.maximum(p, 1e-300))[token], starts)),
        })

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sums, _SCORES)


def _spoken(learned: _Learned, words: DataFrame, parts: int) -> DataFrame:
    """(b, w, total, p): of all words that are asked for in a class, their tokens and what the class says in the kept states."""
    schema = "u int, w binary, total binary, p binary"

    def go(batches):
        for x in map(_Words, _rows(batches)):
            p = learned.classes(x)[1]
            for u, at in _by_class(x.u, np.arange(len(x.u))):
                row = x.all.row[at]
                yield _row(schema, u=u, w=x.wh[row], total=[x.total[row]], p=p[at])

    return _to_buckets(words.mapInArrow(go, schema), parts, "w", "total", "p")


#: Per unit, for each of its texts in turn: log10 probabilities and counts of the tokens that some buckets have.
_SUMS = "unit long, score binary, base binary, n_known binary, n_tokens binary"


def _text_sums(learned: _Learned):
    keep, base_total = len(learned.states), learned.n_tokens + learned.n_words + 1

    def go(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([_row(_SUMS).slice(0, 0)])
        row = pa.compute.is_valid(right.column("p"))
        x, said = _Seating.of(left, right.filter(pa.compute.invert(row)), keep), right.filter(row)
        known = _whole(said, "w", np.int64)
        order = np.argsort(known)
        known = known[order]
        p_class = _whole(said, "p", "<f4").reshape(-1, keep)[order]
        tokens = np.concatenate([_large(y) for y in said.column("total").to_pylist()])[order]
        at = np.repeat(np.arange(len(x.n)), x.n)
        total = learned.strength + np.bincount(at, x.c, len(x.n)).astype(np.int64)
        worth = ((x.c - learned.d * (x.kept + x.t) / keep) / total[at]).astype("<f4")
        shares = ((learned.strength + learned.d * x.back) / total[:, None]).astype("<f4")
        xv, xw = _cells(left, "xv", np.int64)[0], _cells(left, "xw", np.int64)[0]
        trained = _large(left.column("trained")[0].as_py()) > 0
        word, p = np.empty(len(trained), np.int64), np.empty(len(trained))
        word[trained], word[~trained] = np.searchsorted(known, x.w), np.searchsorted(known, xw)
        p[trained] = worth + sum(shares[at, j] * p_class[word[trained], j].astype(np.float64) for j in range(keep)) / keep
        del at, worth
        share = np.ones((len(xv), keep), "<f4")
        if len(x.v):
            near = np.minimum(np.searchsorted(x.v, xv), len(x.v) - 1)
            share = np.where((x.v[near] == xv)[:, None], shares[near], share)
        p[~trained] = sum(share[:, j] * p_class[word[~trained], j].astype(np.float64) for j in range(keep)) / keep
        log_p, c = np.log10(np.maximum(p, 1e-300)), tokens[word]
        del p, word, x
        base = np.log10((c + 1) / base_total)
        sizes, m = (_large(left.column(y)[0].as_py()) for y in ("sizes", "m"))
        ref, doc, k = (_large(left.column(y)[0].as_py(), np.int32) for y in ("ref", "doc", "k"))
        ends, entries = np.cumsum(sizes), np.concatenate([[0], np.cumsum(m)])
        out = []
        for unit, low, high in zip(_cells(left, "units", np.int64)[0].tolist(), ends - sizes, ends, strict=True):
            pair = np.repeat(np.cumsum(ref[low:high]), m[low:high])
            texts, times = doc[entries[low] : entries[high]], k[entries[low] : entries[high]]
            sums = [np.bincount(texts, y * times) for y in (log_p[pair], base[pair], c[pair] > 0, 1)]
            out.append(_row(_SUMS, unit=unit, score=sums[0], base=sums[1], n_known=[sums[2].astype(np.int64)], n_tokens=[sums[3].astype(np.int64)]))
        return pa.Table.from_batches(out)

    return go


def _added(table: pa.Table) -> dict[str, np.ndarray]:
    """The sums of a unit's texts over all rows."""
    read = {"score": lambda x: np.frombuffer(x), "base": lambda x: np.frombuffer(x), "n_known": _large, "n_tokens": _large}
    out = {}
    for name, of in read.items():
        cells = [of(x) for x in table.column(name).to_pylist() if x is not None]
        out[name] = np.zeros(max(map(len, cells)), cells[0].dtype)
        for x in cells:
            out[name][: len(x)] += x
    return out


def _add(table: pa.Table) -> pa.Table:
    sums = _added(table)
    return pa.Table.from_batches([_row(_SUMS, unit=table.column("unit")[0].as_py(), score=sums["score"], base=sums["base"], n_known=[sums["n_known"]], n_tokens=[sums["n_tokens"]])])


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", burn_in: int = BURN_IN, keep: int = KEEP) -> DataFrame:
    """``learn`` and ``score`` on the same rows, whose texts are read once: the buckets keep which texts ask for a pair."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    blocks = block_count(rows, chars_per_block=BUCKET_CHARS)
    parts = -(-blocks // CONTEXTS)
    turn_of = F.pmod(F.col("b"), F.lit(ROUNDS))
    both = stored(buckets(bucket_counts(rows, parts, texts=True)).withColumn("turn", turn_of), partition_by=["turn"])
    forget_shuffles(spark)
    state, ids = both.where("b >= 0"), stored(both.where("b < 0").select("unit", "xv", "trained"))
    learned = _learn(state, parts, WORD_PARTS * blocks, burn_in, keep)
    plain, n, sums = learned.plain(), learned.n_tokens, None
    for turn in range(ROUNDS):  # what moves for some buckets is off the disks before the next ones come
        mine = turn_of == turn
        model = learned.heavy.where(mine).unionByName(_spoken(plain, learned.words, parts).where(mine), allowMissingColumns=True)
        some = state.where(F.col("turn") == turn).drop("turn").groupBy("b").cogroup(model.groupBy("b")).applyInArrow(_text_sums(plain), _SUMS)
        done = stored(some.groupBy("unit").applyInArrow(_add, _SUMS))
        sums = done if sums is None else sums.unionByName(done)
        forget_shuffles(spark)
    for spent in (both, learned.heavy, learned.words):
        drop_stored(spent)

    def texts(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, null = _cells(left, "xv", np.int64)[0], _large(left.column("trained")[0].as_py())
        ids = [None if no else x for x, no in zip(ids.tolist(), null, strict=True)]
        sums = _added(right)
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()),
            "held_out": pa.array(map(lm.is_held_out, ids), pa.bool_()),
            "n_tokens": pa.array(sums["n_tokens"]),
            "n_known": pa.array(sums["n_known"]),
            "train_tokens": pa.array([n] * len(ids), pa.int64()),
            "base_score": pa.array(sums["base"]),
            "score": pa.array(sums["score"]),
        })

    return ids.groupBy("unit").cogroup(sums.groupBy("unit")).applyInArrow(texts, _SCORES)
