"""Scoring texts with a hierarchical Pitman-Yor language model learned from the corpus.

The tokens of a text are its lower-cased words and its end.  A token is drawn from the restaurant of its context, the
class of the token before it; all context restaurants share one parent, whose own parent is the uniform choice among
the words seen in training and one more token for all others.  Contexts are ``CONTEXTS`` classes by hash, so the number
of restaurants does not grow with the corpus, while what is counted in them does.

A Gibbs sweep draws the number of tables of every word in every context, which are the customers of the parent, then
the tables of the parent (``pitman_yor``).  One row holds a word with all its contexts, so a sweep is a map over rows
and a few sums; words are drawn at once, given the sums of the sweep before.  Discounts come from counts of counts, strengths
are those of a grid that predict left-out tokens best.  After ``BURN_IN`` sweeps the predictive probabilities of
``KEEP`` sweeps are averaged.

For scoring, texts are dealt into blocks by hash.  Each block asks once for each of its distinct words, with the
contexts it needs; the answers come back to the block, and the sums of a text are made where the text is.  Words are
told apart by 64-bit hashes.

Defined cases: a null text is empty and has one token, its end; a null id is learned from; repeated rows count as often
as they come; without training tokens every token is unknown; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from millrace.llm import pitman_yor as py
from millrace.llm.storage import block_count, drop_stored, forget_shuffles, stored

BURN_IN = 2
KEEP = 2
CONTEXTS = 64  # a context is one bit of a long
SEED = 11
END = b""
BLOCK_CHARS = 16_000_000
_FLUSH_WORDS = 400_000
_FLUSH_TOKENS = 6_000_000


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Numbered:
    """Texts as numbers of words, each token with its context; words are numbered as they come."""

    def __init__(self):
        self.number = _Numbers()
        self.ids: list[np.ndarray] = []
        self.n_tokens = 0

    def add(self, text: str | None) -> None:
        words = tokens(text)
        self.ids.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        self.n_tokens += len(words)

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxh64_intdigest, self.number), np.uint64, len(self.number)).view(np.int64)

    def keys(self, hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """place of the word * CONTEXTS + context, of all tokens, text after text; a text starts in the context of an end."""
        if not self.ids:
            return np.zeros(0, np.int64)
        words = np.concatenate(self.ids)
        kinds = _context(hashes)
        out = place[words] * CONTEXTS
        before = np.empty(len(words), np.int64)
        before[1:] = kinds[words[:-1]]
        before[np.cumsum([0, *map(len, self.ids[:-1])])] = _context(np.array([xxh64_intdigest(END)], np.uint64).view(np.int64))[0]
        out += before
        return out


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and the length of each row."""
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[cuts[0] : cuts[-1]], np.diff(cuts).astype(np.int64)


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    cuts = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=cuts[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])


def _context(hashes: np.ndarray) -> np.ndarray:
    return ((hashes.view(np.uint64) >> np.uint64(40)) % np.uint64(CONTEXTS)).astype(np.int64)


def pair_counts(docs: DataFrame) -> DataFrame:
    """(wh, pairs): how often a word comes in a context, over the training rows of ``docs`` (doc_id, text), summed per task.

    A row is a word with five bytes per pair: its context and its count, which a task keeps below ``_FLUSH_TOKENS``."""

    def go(batches):
        seen = Numbered()

        def counted():
            hashes = seen.hashes()
            keys = seen.keys(hashes, np.arange(len(hashes)))
            for low in range(0, len(hashes), 100_000):  # some words at a time: the counts are dense
                inside = keys[(keys >= low * CONTEXTS) & (keys < (low + 100_000) * CONTEXTS)] - low * CONTEXTS
                c = np.bincount(inside, minlength=1)
                part = np.flatnonzero(c)
                words, n = np.unique(part // CONTEXTS, return_counts=True)
                pairs = np.empty((len(part), 5), np.uint8)
                pairs[:, 0] = part % CONTEXTS
                pairs[:, 1:] = c[part].astype("<u4").view(np.uint8).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[words + low]), _binary(pairs.ravel(), 5 * n)], names=["wh", "pairs"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not is_held_out(doc_id):
                    seen.add(text)
                if len(seen.number) > _FLUSH_WORDS or seen.n_tokens > _FLUSH_TOKENS:
                    yield from counted()
                    seen = Numbered()
        yield from counted()

    return docs.select("doc_id", "text").mapInArrow(go, "wh long, pairs binary")


def _words(batches):
    """One row per word from rows sorted by word: its contexts with their sums; the last word of a batch may go on."""
    names = [c.split()[0] for c in _STATE.split(", ")]

    def rows(wh: np.ndarray, u: np.ndarray, c: np.ndarray):
        first = np.flatnonzero(np.concatenate([[True], wh[1:] != wh[:-1]]))
        n, ones = np.diff(np.append(first, len(wh))), np.ones(len(wh), np.int64)
        pairs = [_binary(v.view(np.uint8), 8 * n) for v in (c, ones, ones - 1)]
        none = _binary(np.zeros(0, np.uint8), np.zeros(len(n), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(wh[first]), _binary(u.astype(np.uint8), n), *pairs, pa.array(ones[: len(n)]), none], names=names)

    held = tuple(np.zeros(0, np.int64) for _ in range(3))
    for batch in batches:
        data, size = _bytes(batch.column(1))
        pairs = data.reshape(-1, 5)
        new = np.repeat(batch.column(0).to_numpy(), size // 5), pairs[:, 0].astype(np.int64), np.ascontiguousarray(pairs[:, 1:]).view("<u4").ravel().astype(np.int64)
        wh, u, c = (np.concatenate([h, x]) for h, x in zip(held, new, strict=True))
        order = np.lexsort((u, wh))
        wh, u, c = wh[order], u[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], (wh[1:] != wh[:-1]) | (u[1:] != u[:-1])])) if len(wh) else np.zeros(0, np.int64)
        wh, u, c = wh[first], u[first], np.add.reduceat(c, first) if len(first) else c
        done = np.searchsorted(wh, wh[-1]) if len(wh) else 0
        if done:
            yield rows(wh[:done], u[:done], c[:done])
        held = wh[done:], u[done:], c[done:]  # one word, at most CONTEXTS rows
    if len(held[0]):
        yield rows(*held)


def word_rows(counts: DataFrame) -> DataFrame:
    """The state before the first sweep from :func:`pair_counts`: one table per word and context."""
    return counts.repartition("wh").sortWithinPartitions("wh").mapInArrow(_words, _STATE)


@dataclass
class Sums:
    """Tables by context and of the parent, after a sweep; customers of the parent are all tables of the contexts."""

    tables: np.ndarray
    root_tables: int

    @property
    def root_customers(self) -> int:
        return int(self.tables.sum())


@dataclass
class Setting:
    """What the sweeps are given: customers by context, words, discounts and strengths of contexts and parent."""

    customers: np.ndarray
    n_words: int
    d: float
    strength: float
    root_d: float
    root_strength: float

    def root(self, sums: Sums, customers, tables):
        """Parent's probability of words with so many customers and tables there."""
        rest = (self.root_strength + self.root_d * sums.root_tables) / (self.n_words + 1)
        return (customers - self.root_d * tables + rest) / (self.root_strength + sums.root_customers)

    def back(self, sums: Sums) -> np.ndarray:
        """By context: the share that goes to the parent."""
        return (self.strength + self.d * sums.tables) / (self.strength + self.customers)


#: A word and, as bytes: its contexts, customers, tables and tables over the kept sweeps; the parent's tables, and its
#: probabilities in the kept sweeps.
_STATE = "wh long, us binary, cs binary, ts binary, kept binary, root_t long, root_p binary"


@dataclass
class _Rows:
    """One batch of the state as arrays over all (word, context) pairs; ``row`` is the word of a pair."""

    batch: pa.RecordBatch

    def __post_init__(self):
        self.u, self.n = _bytes(self.batch.column(1))
        self.row = np.repeat(np.arange(len(self.n)), self.n)
        self.c, self.t, self.kept = (_bytes(self.batch.column(k))[0].view(np.int64) for k in (2, 3, 4))
        self.root_t = self.batch.column(5).to_numpy()
        self.root_c = self.sums(self.t)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, values, len(self.n)).astype(np.int64)

    def pairs(self, values: np.ndarray) -> pa.Array:
        return _binary(values.astype(np.int64).view(np.uint8), 8 * self.n)

    def root_p(self, now: np.ndarray) -> np.ndarray:
        """The parent's probabilities of the kept sweeps with those of now, one row per word."""
        before = _bytes(self.batch.column(6))[0].view(np.float64)
        return np.column_stack([before.reshape(len(self.n), -1), now]) if len(before) else now[:, None]


def _sweep(state: DataFrame, setting: Setting, sums: Sums, turn: int, keep: bool) -> DataFrame:
    """Take down the present seating if it is kept, then draw all tables anew."""

    def go(batches):
        for batch in batches:
            x = _Rows(batch)
            here = setting.root(sums, x.root_c, x.root_t)
            kept, root_p = batch.column(4), batch.column(6)
            if keep:
                told = x.root_p(here)
                kept, root_p = x.pairs(x.kept + x.t), _binary(told.view(np.uint8).ravel(), np.full(len(x.n), 8 * told.shape[1]))
            first = batch.column(0)[0].as_py() if len(x.n) else 0
            rng = np.random.default_rng([SEED, turn, abs(first), len(x.n)])
            strength = setting.strength + setting.d * (sums.tables[x.u] - x.t)
            t = py.draw_tables(x.c, setting.d, strength, np.log(here)[x.row], rng)
            strength = setting.root_strength + setting.root_d * (sums.root_tables - x.root_t)
            root_t = py.draw_tables(x.sums(t), setting.root_d, strength, np.full(len(x.n), -math.log(setting.n_words + 1)), rng)
            arrays = [batch.column(0), batch.column(1), batch.column(2), x.pairs(t), kept, pa.array(root_t), root_p]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return state.mapInArrow(go, _STATE)


def _seated(state: DataFrame) -> Sums:
    """Tables by context and of the parent; one row per context reaches the driver."""

    def go(batches):
        sums = np.zeros(CONTEXTS + 1, np.int64)
        for batch in batches:
            u, t = _bytes(batch.column(0))[0], _bytes(batch.column(1))[0].view(np.int64)
            sums[:-1] += np.bincount(u, t, CONTEXTS).astype(np.int64)
            sums[-1] += batch.column(2).to_numpy().sum()
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(sums)), "n": sums})

    rows = state.select("us", "ts", "root_t").mapInArrow(go, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    found = {r["k"]: r["n"] for r in rows}
    return Sums(np.array([found.get(k, 0) for k in range(CONTEXTS)], np.int64), found.get(CONTEXTS, 0))


def _one_rows(batch: pa.RecordBatch):
    yield _Rows(batch)


def _totals(state: DataFrame, parts=_one_rows) -> dict[str, np.ndarray]:
    """Sums over the state, one row per context and kind of sum: customers, tables, the parent's tables and words, and
    how many pairs have one and two customers, and words one and two contexts (``few``).  ``parts`` reads a batch."""

    def go(batches):
        customers, tables, few = np.zeros(CONTEXTS, np.int64), np.zeros(CONTEXTS, np.int64), np.zeros(6, np.int64)
        for x in (x for batch in batches for x in parts(batch)):
            customers += np.bincount(x.u, x.c, CONTEXTS).astype(np.int64)
            tables += np.bincount(x.u, x.t, CONTEXTS).astype(np.int64)
            few += [x.root_t.sum(), len(x.n), (x.c == 1).sum(), (x.c == 2).sum(), (x.n == 1).sum(), (x.n == 2).sum()]
        sums = np.concatenate([customers, tables, few])
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(sums)), "n": sums})

    rows = state.mapInArrow(go, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(2 * CONTEXTS + 6, np.int64)
    for r in rows:
        out[r["k"]] = r["n"]
    return {"customers": out[:CONTEXTS], "tables": out[CONTEXTS : 2 * CONTEXTS], "few": out[2 * CONTEXTS :]}


STRENGTHS = tuple(10.0**k for k in range(8))
ROOT_STRENGTHS = (0.001, 0.01, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0)  # per word


def _strength(state: DataFrame, customers: np.ndarray, dishes: np.ndarray, d: float, n_words: int, parts=_one_rows) -> float:
    """Strength of the contexts that predicts every token best from all the others."""
    total = int(customers.sum())

    def go(batches):
        sums = np.zeros(len(STRENGTHS))
        for x in (x for batch in batches for x in parts(batch)):
            parent = ((x.sums(x.c) + 1) / (total + n_words + 1))[x.row]
            # Pairs seen once differ by their context and their parent only, so they are summed by context.
            once = np.bincount(x.u[x.c == 1], minlength=CONTEXTS)
            more = np.flatnonzero(x.c > 1)
            c, u, p = x.c[more], x.u[more], parent[more]
            alike = [(once * py.left_out_log(np.ones(CONTEXTS), customers, dishes, np.ones(CONTEXTS), d, s))[once > 0].sum() for s in STRENGTHS]
            sums += np.log(parent[x.c == 1]).sum() + alike
            sums += [py.left_out_log(c, customers[u], dishes[u], p, d, s).sum() for s in STRENGTHS]
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(STRENGTHS)), "s": sums})

    rows = state.mapInArrow(go, "k long, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    return STRENGTHS[max(rows, key=lambda r: r["s"])["k"]] if rows else STRENGTHS[0]


def _root_strength(state: DataFrame, d: float, n_words: int) -> float:
    """The same for the parent, whose dishes start with one customer per context."""
    rows = state.groupBy(F.octet_length("us").alias("c")).count().collect()  # at most CONTEXTS rows
    return _best_root_strength(*(np.array([r[k] for r in rows], np.float64) for k in (0, 1)), d, n_words)


def _best_root_strength(c: np.ndarray, n: np.ndarray, d: float, n_words: int) -> float:
    """The same from the numbers ``n`` of words with ``c`` contexts."""
    total = float((c * n).sum())

    def predicted(s: float) -> float:
        return float((n * py.left_out_log(c, np.full(len(c), total), np.full(len(c), float(n_words)), np.full(len(c), 1 / (n_words + 1)), d, s)).sum())

    return max((s * max(1, n_words) for s in ROOT_STRENGTHS), key=predicted)


@dataclass
class Model:
    table: DataFrame  # the rows of ``_packed``
    n_tokens: int
    n_words: int
    own: np.ndarray  # by context: what one customer is worth
    back: np.ndarray  # kept sweep, context: share of the parent
    unknown: np.ndarray  # by kept sweep: parent's probability of a word that was not seen


def learn(docs: DataFrame, burn_in: int = BURN_IN, keep: int = KEEP) -> Model:
    """Model of the training rows of ``docs`` (doc_id, text)."""
    state = stored(word_rows(pair_counts(docs)))
    forget_shuffles(docs.sparkSession)
    first = _totals(state)
    root_tables, n_words, once, twice, root_once, root_twice = (int(x) for x in first["few"])
    customers, tables = first["customers"], first["tables"]
    d, root_d = py.discount(once, twice), py.discount(root_once, root_twice)
    setting = Setting(customers, n_words, d, _strength(state, customers, tables, d, n_words), root_d, _root_strength(state, root_d, n_words))
    sums, back, unknown = Sums(tables, root_tables), [], []
    for turn in range(burn_in + keep):
        if turn >= burn_in:
            back.append(setting.back(sums))
            unknown.append(setting.root(sums, 0, 0))
        if turn == burn_in + keep - 1:
            break
        new = stored(_sweep(state, setting, sums, turn, turn >= burn_in))
        drop_stored(state)
        state, sums = new, _seated(new)
    own = 1 / (setting.strength + customers)
    table = _packed(state, setting, sums, keep)
    return Model(table, int(customers.sum()), n_words, own, np.array(back), np.array(unknown))


def _pairs(u: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """Five bytes a pair: its context, and its customers less discounted tables."""
    out = np.empty((len(u), 5), np.uint8)
    out[:, 0] = u
    out[:, 1:] = worth.astype("<f4").view(np.uint8).reshape(-1, 4)
    return out


def _roots(kept: int) -> list[str]:
    """Columns of the parent's probability in the kept sweeps."""
    return [f"q{k}" for k in range(kept)]


def _packed(state: DataFrame, setting: Setting, sums: Sums, keep: int) -> DataFrame:
    """Rows of the model with the last kept sweep: a word, its customers, the parent's probabilities, its pairs as bytes."""

    def go(batches):
        for batch in batches:
            x = _Rows(batch)
            pairs = _pairs(x.u, x.c - setting.d * (x.kept + x.t) / keep)
            root = x.root_p(setting.root(sums, x.root_c, x.root_t)).astype(np.float32)
            arrays = [batch.column(0), pa.array(x.sums(x.c)), *(pa.array(q) for q in np.ascontiguousarray(root.T)), _binary(pairs.ravel(), 5 * x.n)]
            yield pa.RecordBatch.from_arrays(arrays, names=["wh", "c", *_roots(keep), "pairs"])

    return state.mapInArrow(go, "wh long, c long, " + "".join(f"{q} float, " for q in _roots(keep)) + "pairs binary")


def _asked(batches):
    """Per block its distinct words, numbered by the order of their hashes, and the contexts each stands in."""
    seen: dict[int, Numbered] = {}
    for batch in batches:
        for text, block in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            seen.setdefault(block, Numbered()).add(text)
    while seen:
        block, numbered = seen.popitem()
        hashes = numbered.hashes()
        distinct, place = np.unique(hashes, return_inverse=True)
        stands = np.zeros(len(distinct) * CONTEXTS, bool)
        stands[numbered.keys(hashes, place)] = True
        masks = np.packbits(stands, bitorder="little").view("<i8")
        for at in range(0, len(distinct), 100_000):
            part = slice(at, min(len(distinct), at + 100_000))
            n = part.stop - at
            yield pa.RecordBatch.from_pydict(
                {"block": np.full(n, block, np.int32), "place": np.arange(at, part.stop, dtype=np.int32), "h": distinct[part], "mask": masks[part]}
            )


def _answered(batches):
    """Of each word only the contexts that were asked for; the last two columns are the mask and the pairs."""
    for batch in batches:
        mask = batch.column(batch.num_columns - 2).to_numpy().view(np.uint64)
        data, size = _bytes(batch.column(batch.num_columns - 1))
        pairs, row = data.reshape(-1, 5), np.repeat(np.arange(len(size)), size // 5)
        wanted = (mask[row] >> pairs[:, 0].astype(np.uint64)) & np.uint64(1) > 0
        left = _binary(pairs[wanted].ravel(), 5 * np.bincount(row[wanted], minlength=len(size)))
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], left], names=[*names[:-2], names[-1]])


def score(docs: DataFrame, model: Model, chars_per_block: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and log10 probabilities of its tokens."""
    blocks = block_count(docs, chars_per_block=chars_per_block)
    block = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int")
    dealt = docs.select("doc_id", "text", block.alias("block")).repartition(blocks, "block")
    asked = dealt.mapInArrow(_asked, "block int, place int, h long, mask long")
    roots = _roots(len(model.unknown))
    found = asked.join(model.table.hint("shuffle_hash"), F.col("h") == F.col("wh")).select("block", "place", "c", *roots, "mask", "pairs")
    answers = found.mapInArrow(_answered, "block int, place int, c long, " + "".join(f"{q} float, " for q in roots) + "pairs binary")
    n, base_total = model.n_tokens, model.n_tokens + model.n_words + 1
    own, back, unknown = model.own, model.back, model.unknown

    def sums(texts: pa.Table, answers: pa.Table) -> pa.Table:
        numbered = Numbered()
        for text in texts.column("text").to_pylist():
            numbered.add(text)
        hashes = numbered.hashes()
        distinct, place = np.unique(hashes, return_inverse=True)
        keys = numbered.keys(hashes, place)
        at = answers.column("place").to_numpy()
        c = np.zeros(len(distinct), np.int64)
        parent = np.tile(unknown.astype("<f4"), (len(distinct), 1))
        known = np.zeros(len(distinct) * CONTEXTS, "<f4")  # dense by word and context of the block
        if len(at):
            c[at] = answers.column("c").to_numpy()
            parent[at] = np.column_stack([answers.column(q).to_numpy() for q in roots])
            data, size = _bytes(answers.column("pairs").combine_chunks())
            pairs = data.reshape(-1, 5)
            known[np.repeat(at.astype(np.int64), size // 5) * CONTEXTS + pairs[:, 0]] = np.ascontiguousarray(pairs[:, 1:]).view("<f4").ravel()
        words, contexts = keys // CONTEXTS, keys % CONTEXTS
        p = known[keys] * own[contexts]
        for k in range(len(unknown)):
            p += back[k][contexts] * parent[words, k] / len(unknown)
        ends = np.cumsum([len(k) for k in numbered.ids])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        ids = texts.column("doc_id").to_pylist()
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()),
            "held_out": pa.array(map(is_held_out, ids), pa.bool_()),
            "n_tokens": pa.array(ends - starts),
            "n_known": pa.array(np.add.reduceat((c[words] > 0).astype(np.int64), starts)),
            "train_tokens": pa.array([n] * len(ids), pa.int64()),
            "base_score": pa.array(np.add.reduceat(np.log10((c + 1) / base_total)[words], starts)),
            "score": pa.array(np.add.reduceat(np.log10(np.maximum(p, 1e-300)), starts)),
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sums, schema)


def perplexity(scored: DataFrame, held_out: bool = True) -> float:
    """Perplexity per token of the held-out (or the training) rows."""
    row = scored.where(F.col("held_out") == held_out).agg(F.sum("score").alias("s"), F.sum("n_tokens").alias("n")).first()
    return 10 ** (-row["s"] / row["n"]) if row["n"] else float("nan")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", burn_in: int = BURN_IN, keep: int = KEEP) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return score(rows, learn(rows, burn_in, keep))
