"""Importance resampling against plain counting; payloads and composed CRCs against hashes of the joined text."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import importance
from tests.llm.helpers import documents, prose, rows_of, with_clashes
from tests.oracle import compare


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_features(text, longest, buckets):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i : i + n]).encode("utf-8", "surrogatepass")) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, longest=1, buckets=10_000, percent=10, least=20, seed="2024"):
    found = [plain_features(t, longest, buckets) for _, t in rows]
    s = Counter(b for f in found for b in f)
    t = Counter(b for x in target for b in plain_features(x, longest, buckets))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    out = []
    for (i, text), f in zip(rows, found, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(text))])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_payloads_are_crc_and_length():
    rng = random.Random(1)
    texts = prose(30, 1) + ["", None, "a-b_c D", "ÀB é x", "x" * 5000, "İ ſ \ud800 q", "one two " * 50]
    for block in (1, 7, 10_000):
        for text, found in zip(texts, importance.payloads(texts, block), strict=True):
            words = [w.encode("utf-8", "surrogatepass") for w in plain_words(text)]
            assert [(p >> 32, p & 0xFFFFFFFF) for p in found.tolist()] == [(len(w), zlib.crc32(w)) for w in words]
    rng.shuffle(texts)
    for text, found in zip(texts, importance.payloads(texts), strict=True):
        for longest in (1, 2, 4):
            assert importance.features(found, longest, 997).tolist() == plain_features(text, longest, 997)


@pytest.mark.parametrize(("longest", "buckets"), [(1, 10_000), (3, 70_000)])
def test_against_plain(spark, longest, buckets):
    texts = prose(120, 3) + ["", None, "!!", "ABC def " * 30, "ABC def " * 30]
    ids = [997 * i % 1000 for i in range(len(texts))]
    target = prose(5, 4) + [None, ""]
    docs, wanted = with_clashes(documents(spark, texts, ids)), documents(spark, target)
    got = importance.resample(docs, wanted, longest=longest, buckets=buckets, percent=30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows_of(got) == plain(list(zip(ids, texts, strict=True)), target, longest, buckets, 30)


def test_query_against_sql(spark, duck, sf_dir):
    from millrace.llm.queries import ORACLES, QUERIES

    assert compare(spark, duck, QUERIES["op12_target_resampling"], ORACLES["op12_target_resampling"], sf_dir) == ""


def test_equal_rows_without_id(spark):
    """A third of the rows have no id and one text: equal scores, ranks that follow each other."""
    texts = prose(60, 5, words=90) + ["the same words again and again " * 5] * 30
    ids = list(range(60)) + [None] * 30
    got = importance.resample(documents(spark, texts, ids), documents(spark, prose(3, 6)), percent=100)
    assert rows_of(got) == plain(list(zip(ids, texts, strict=True)), prose(3, 6), percent=100)
    ranks = [r.rank for r in got.collect() if r.rank]
    assert sorted(ranks) == list(range(1, len(ranks) + 1))


def test_empty_tables(spark):
    none = documents(spark, [])
    assert importance.resample(none, documents(spark, ["a b"])).collect() == []
    texts = prose(20, 7)
    assert rows_of(importance.resample(documents(spark, texts), none)) == plain(list(enumerate(texts)), [])


def test_counts_are_exact_over_tasks(spark):
    texts = prose(50, 9)
    table = importance.feature_table(documents(spark, texts).selectExpr("text as _t"), [], "_t", 2, 500)
    want = Counter(b for t in texts for b in plain_features(t, 2, 500))
    assert importance.bucket_counts(table, 500).tolist() == [want[b] for b in range(500)]
    assert np.array_equal(importance.gains(np.zeros(3), np.zeros(3)), np.zeros(3))
