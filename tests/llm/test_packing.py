"""Packing: token ids against the tokenizer itself, valid sequences, bounds against exhaustive packing."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import packing
from tests.llm.helpers import documents, prose, with_clashes

SLOW = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*SLOW.encode(text or "", add_special_tokens=False).ids, 0]


def odd_texts():
    rng = random.Random(8)
    parts = ["it's", "I'LL", " ", "  ", "\n\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "²½", "9000", "_", "--", "é", "ß", "Ā", "ɏ", "ɐ", "中文", "🙂", "़", "<|endoftext|>", "the", "'s", " "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(400)]


def test_ids_are_those_of_the_tokenizer():
    encode = packing._encoder("byte_bpe_50k")
    for text in odd_texts() + prose(50, 3) + ["a" * 3000, " " * 500, "\n" * 300, "ab " * 900]:
        assert encode(text).tolist() + [0] == ids_of(text), repr(text)


def check(rows, texts_by_id, capacity):
    """Pieces cover the documents, sequences are gapless and not overfull."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, pieces in by_doc.items():
        ids = np.array(ids_of(texts_by_id[doc_id]), "<u4")
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert pieces[0]["start"] == 0 and sum(r["length"] for r in pieces) == len(ids)
        assert len(pieces) == -(-len(ids) // capacity) and all(r["length"] == capacity for r in pieces[1:])
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    return len(sequences)


def test_query(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    packed = QUERIES["op4_best_fit_packing"](spark, sf_dir)
    rows = packed.collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    used, bound = packing.certificate(packed)
    assert check(rows, texts, 2048) == used <= bound + 1


def test_small_capacity_and_many_groups(spark):
    texts = dict(enumerate(prose(400, 11, words=40) + ["", None, "x" * 2000] + odd_texts()[:50]))
    docs = with_clashes(documents(spark, list(texts.values()), list(texts)))
    pieces = packing.stored(packing.pieces(docs, capacity=64))
    packed = packing.pack(pieces, capacity=64, per_group=20)
    rows = packed.collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    used, bound = packing.certificate(packed, 64)
    assert check(rows, texts, 64) == used
    alone = packing.pack(pieces, capacity=64, per_group=10**6).agg(F.count_distinct("sequence_id")).first()[0]
    assert bound <= alone <= used <= bound * 1.05 + 1


def test_groups_exchange_all_they_waste(spark):
    """Groups that hold long or short pieces only: each is certified, together they need a third less."""
    rows = spark.range(1200).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.col("id").alias("ids_crc32"))
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(6)).cast("long")
    pieces = rows.withColumn("length", F.when(group < 3, 40).otherwise(24).cast("long")).select("doc_id", "piece", "start", "length", "ids_crc32")
    packed = packing.pack(pieces, capacity=64, per_group=200)
    used, bound = packing.certificate(packed, 64)
    assert packed.count() == 1200 and packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 64").count() == 0
    assert bound <= used <= bound * 1.05


def test_repeated_rows_null_ids_and_empty(spark):
    docs = documents(spark, ["same text"] * 4 + [None], [1, 1, 1, None, None])
    rows = packing.pack_documents(docs).collect()
    assert len(rows) == 5 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 5
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert packing.pack_documents(docs.limit(0)).collect() == []


def fewest_bins(lengths, capacity):
    """By trying: put each length into every open bin or a new one."""
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + lengths[k] <= capacity:
                place(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1 :]])
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_bounds_and_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 12, 30])
    lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
    best = fewest_bins(lengths, capacity)
    given = np.array(lengths, np.int64)
    assert packing.lower_bound(given, capacity) <= best
    bins = packing.best_fit_decreasing(given, capacity)
    assert max(np.bincount(bins, given)) <= capacity and best <= bins.max() + 1 <= -(-11 * best // 9) + 1


def test_bound_sees_large_pieces():
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert packing.lower_bound(np.array([4, 4, 4, 4, 4]), 10) == 3
    assert packing.lower_bound(np.array([], np.int64), 10) == 0


def test_best_fit_takes_the_tightest_bin():
    lengths = np.array([7, 5, 3, 2, 3], np.int64)
    bins = packing.best_fit_decreasing(lengths, 10)
    assert len(set(bins.tolist())) == 2
    assert all(sum(lengths[bins == b]) == 10 for b in set(bins.tolist()))
    assert list(itertools.chain(packing.best_fit_decreasing(np.array([], np.int64), 10))) == []
