"""Target-distribution importance resampling over hashed word features, read off an Aho-Corasick dictionary.

The distinct words of a block of texts, each between two delimiters, are the keys of an automaton; the payload of a word
is its CRC-32 and its length in bytes.  One scan of a text emits the payloads of its words in order.  The CRC of a run of
words follows from adjacent payloads alone (the CRC of a text moved on by the length of the next one), so features of any
run length are hashed without their text being put together.  A block is bounded by words, whatever the corpus holds.

Buckets of all features are counted per task and summed, for the corpus and for the target; the log ratio of the two
shares is the gain of a bucket, the floored mean of gains over a text its weight.  Gumbel noise from a hash of the id is
added, and the highest scores are drawn: sampling without replacement in proportion to the weights.  Ranks come from one
range-partitioned sort of ids and scores, so equal scores are spread over tasks too.

Defined cases: a null text has no words; a text without features has weight 0; a null id counts as the empty text in the
noise and ranks after all ids; repeated rows are rows of their own, whose ranks follow each other; empty tables give no
rows, an empty target gives gains from the corpus alone; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.storage import stored

BLOCK_WORDS = 200_000
_POLYNOMIAL = np.uint32(0xEDB88320)
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Bytes of a text to its normal form: A-Z lower-cased, letters, digits and all beyond ASCII kept, the rest one delimiter.
_NORMAL = bytes(c if c in _WORD_BYTES or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


@cache
def _moved(length: int) -> np.ndarray:
    """What a CRC's single bits become when ``length`` zero bytes follow."""
    if length == 0:
        return np.uint32(1) << np.arange(32, dtype=np.uint32)
    if length == 1:
        bits = _moved(0)
        for _ in range(8):
            bits = (bits >> np.uint32(1)) ^ np.where(bits & np.uint32(1), _POLYNOMIAL, np.uint32(0))
        return bits
    return _apply(_moved(length - length // 2), _moved(length // 2))


def _apply(bits: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    out = np.zeros(len(crcs), np.uint32)
    for k in range(32):
        out ^= np.where(crcs >> np.uint32(k) & np.uint32(1), bits[k], np.uint32(0))
    return out


def _joined(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of texts put together: those of the second ones have ``lengths`` bytes."""
    out = np.empty(len(first), np.uint32)
    for length in np.unique(lengths).tolist():
        at = lengths == length
        out[at] = _apply(_moved(length), first[at])
    return out ^ second


def dictionary(words: Iterable[bytes]) -> ahocorasick.Automaton:
    """Automaton of the distinct ``words`` between delimiters, with payload (length << 32) + CRC-32."""
    automaton = ahocorasick.Automaton()
    for word in set(words):
        automaton.add_word(f" {word.decode('utf-8', 'surrogatepass')} ", len(word) << 32 | zlib.crc32(word))
    automaton.make_automaton()
    return automaton


def payloads(texts: Iterable[str | None], block_words: int = BLOCK_WORDS) -> Iterator[np.ndarray]:
    """Payloads of the words of each text, in order; one dictionary per ``block_words`` words, a text may span several."""
    parts: list[list[np.ndarray]] = []
    block: list[tuple[int, list[bytes]]] = []
    held = 0

    def scan():
        known = dictionary(w for _, words in block for w in words)
        for nth, words in block:
            line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
            parts[nth].append(np.fromiter((payload for _, payload in known.iter(line)), np.int64, len(words)))
        block.clear()

    for nth, text in enumerate(texts):
        parts.append([])
        words = words_of(text)
        for at in range(0, len(words), block_words):
            piece = words[at : at + block_words]
            if held + len(piece) > block_words and block:
                scan()
                held = 0
            block.append((nth, piece))
            held += len(piece)
    if block:
        scan()
    for found in parts:
        yield np.concatenate(found) if found else np.empty(0, np.int64)


def features(found: np.ndarray, longest: int, buckets: int) -> np.ndarray:
    """Buckets of all runs of 1 to ``longest`` words of one text, from the payloads of its words."""
    crcs, lengths = (found & 0xFFFFFFFF).astype(np.uint32), found >> 32
    out, runs = [crcs], crcs
    if longest > 1 and len(found) > 1:
        spaced = _joined(np.full(len(crcs), zlib.crc32(b" "), np.uint32), crcs, lengths)  # a space before each word
        for k in range(1, min(longest, len(found))):
            runs = _joined(runs[:-1], spaced[k:], lengths[k:] + 1)
            out.append(runs)
    return (np.concatenate(out) % np.uint32(buckets)).astype(np.uint32)


def feature_table(rows: DataFrame, carry: list[str], text_col: str, longest: int, buckets: int) -> DataFrame:
    """The ``carry`` columns, ``n_words`` and ``features``, the buckets as little-endian numbers of 2 or 4 bytes."""
    kept, kind = rows.select(*carry, F.col(text_col).alias("_text")), _kind(buckets)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = list(payloads(part.column(len(carry)).to_pylist()))
                made = [
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([features(f, longest, buckets).astype(kind).tobytes() for f in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carry)], *made], names=[*carry, "n_words", "features"])

    return kept.mapInArrow(run, ", ".join([*(f"{c} {t}" for c, t in kept.dtypes[: len(carry)]), "n_words long, features binary"]))


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(table: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket: one row per task and bucket is shuffled, ``buckets`` rows reach the driver."""
    kind = _kind(buckets)

    def run(batches):
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column(0):
                held += np.bincount(np.frombuffer(row.as_py(), kind), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int64()), "n": pa.array(held[some], pa.int64())})

    out = np.zeros(buckets, np.int64)
    for bucket, n in table.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares per bucket, floored."""
    t_all, s_all, size = float(target.sum()), float(corpus.sum()), len(corpus)
    ratio = [(t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)) for t, s in zip(target.tolist(), corpus.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weighed(table: DataFrame, carry: list[str], gain: np.ndarray) -> DataFrame:
    """The ``carry`` columns, ``n_features`` and ``weight``, the floored mean of gains."""
    kind = _kind(len(gain))

    def run(batches):
        for batch in batches:
            found = [np.frombuffer(x, kind) for x in batch.column(len(carry)).to_pylist()]
            weights = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in found]
            made = [pa.array([len(f) for f in found], pa.int64()), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], *made], names=[*carry, "n_features", "weight"])

    kept = table.select(*carry, "features")
    return kept.mapInArrow(run, ", ".join([*(f"{c} {t}" for c, t in kept.dtypes[: len(carry)]), "n_features long, weight long"]))


def noise(id_col: Column, seed: str) -> Column:
    """Gumbel noise in thousandths, from the hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("long").cast("double") + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, from 1 by ``order``; equal rows are spread over tasks by a number of their own."""
    numbered = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    spread = numbered.repartitionByRange(*order, F.col("_row").asc()).sortWithinPartitions(*order, F.col("_row").asc())
    spread = stored(spread.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = spread.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))  # one row per partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(sizes.select("_part", before.alias("_before")))
    place = F.col("_before") + F.col("_at") - F.shiftleft("_part", 33) + 1
    return spread.join(starts, part == F.col("_part")).select(*rows.columns, place.alias("place"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: str = "2024",
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``.

    ``percent`` hundredths of the documents with at least ``least_words`` words are drawn, those of the highest scores; the
    others have no rank.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t"))
    table = stored(feature_table(rows, ["doc_id"], "_t", longest, buckets))
    wanted = feature_table(target.select(F.col(target_text_col).alias("_t")), [], "_t", longest, buckets)
    gain = gains(bucket_counts(wanted, buckets), bucket_counts(table, buckets))
    scored = weighed(table, ["doc_id", "n_words"], gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = scored.withColumn("fits", F.col("n_words") >= least_words)
    order = [F.col("fits").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    placed = ranked(scored, order)
    drawn = table.where(F.col("n_words") >= least_words).count() * percent // 100
    rank = F.when(F.col("fits") & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def oracle() -> str:
    """DuckDB SQL for the query's rows: unigrams, CRC-32 by table."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
    return rf"""
    with tab as (
        select list(list_reduce(list_prepend(b, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as tab
        from (select unnest(range(256)) as b)
    ), doc as (select doc_id, row_number() over () as nth, text from documents
    ), dw as (select nth, {words} as w from doc
    ), bw as (select {words} as w from benchmark
    ), known as (select distinct w from (select w from dw union all select w from bw)
    ), bytes as (
        select w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), (2 * i + 1)::int, 2))::bigint) as bs from known
    ), hashed as (
        select w, xor(list_reduce(list_prepend(4294967295, bs), lambda c, b: xor(c >> 8, tab[((xor(c, b)) & 255) + 1])), 4294967295) % 10000 as bucket
        from bytes, tab
    ), s as (select bucket, count(*) as n from dw join hashed using (w) group by bucket
    ), t as (select bucket, count(*) as n from bw join hashed using (w) group by bucket
    ), sums as (select (select coalesce(sum(n), 0) from s)::double as s_all, (select coalesce(sum(n), 0) from t)::double as t_all
    ), gain as (
        select s.bucket, floor(1000 * ln((coalesce(t.n, 0)::double + 1) * (s_all + 10000) / ((s.n::double + 1) * (t_all + 10000)))) as g
        from s left join t using (bucket), sums
    ), weighed as (
        select nth, count(*) as n_features, floor(sum(g) / count(*)) as weight from dw join hashed using (w) join gain using (bucket) group by nth
    ), scored as (
        select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0)::bigint as weight,
            (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
                / 4294967296::double))))::bigint as score
        from doc left join weighed using (nth)
    ), placed as (
        select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last) as place,
            (count(*) filter (n_features >= 20) over ()) * 10 // 100 as drawn
        from scored
    )
    select doc_id, n_features, weight, score, case when n_features >= 20 and place <= drawn then place end as rank from placed
    """
