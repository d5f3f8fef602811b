"""Substring dedup against counting every string."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import suffix_dedup as sd
from tests.llm.helpers import documents, rows_of, with_clashes


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[k : k + length] for r in raws for k in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for k in range(len(r) - length + 1):
            if counts[r[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, alphabet, n=60):
    rng = random.Random(seed)
    own = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [own(rng.randint(15, 70)) for _ in range(5)]
    texts = []
    for _ in range(n):
        t = "".join(rng.choice([own(rng.randint(0, 40)), rng.choice(passages)[rng.randint(0, 6) :]]) for _ in range(rng.randint(0, 4)))
        texts.append(t)
    return texts + [texts[1], texts[2][3:], passages[0], "", None]


@pytest.mark.parametrize("seed, alphabet, per_block", [(1, "ab", 128), (2, "abcdefghij", 128), (3, "abcdefghij", 2), (4, "aé🙂", 3), (5, "a", 4), (6, "ab ", 1)])
def test_against_brute_force(spark, seed, alphabet, per_block):
    texts = corpus(seed, alphabet)
    docs = with_clashes(documents(spark, texts))
    got = {r[0]: tuple(r)[1:] for r in sd.report(docs, length=20, gram=5, per_block=per_block).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 20)


def test_chunks_of_long_texts(spark, monkeypatch):
    texts = corpus(9, "abcd", 12)
    joined = ["".join(t or "" for t in texts), "".join(t or "" for t in texts[::-1])]
    whole = plain(joined, 20)
    rows = [list(sd._document_runs(t.encode(), 20, 5)) for t in joined]
    monkeypatch.setattr(sd, "CHUNK", 64)
    cut = [list(sd._document_runs(t.encode(), 20, 5)) for t in joined]
    for a, b in zip(rows, cut, strict=True):  # every window is in one run, whatever the chunks
        windows = lambda some: sorted(s + k for s, n, *_ in some for k in range(n))
        assert windows(a) == windows(b)
    assert [tuple(r)[1:] for r in rows_of(sd.report(documents(spark, joined), length=20, gram=5))] == whole


def test_wrong_hashes_are_found(monkeypatch):
    monkeypatch.setattr(sd, "prefix_hashes", lambda data: np.zeros(len(data) + 1, np.uint64))  # all texts look alike
    texts = [b"abcx", b"abcd", b"ab", b"b", b"abcd", b""]
    order, common = sd.sorted_with_extensions(texts)
    assert [texts[i] for i in order] == sorted(texts) and common.tolist() == [0, 0, 2, 4, 3, 0]


def test_sort_and_extensions():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(80)]
    order, common = sd.sorted_with_extensions(texts)
    assert [texts[i] for i in order] == sorted(texts)
    for k in range(1, len(order)):
        a, b = texts[order[k - 1]], texts[order[k]]
        n = common[k]
        assert a[:n] == b[:n] and a[n : n + 1] != b[n : n + 1] or a == b == a[:n]


def test_query_on_real_length(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    counts = Counter()
    for t in texts.values():
        raw = t.encode()
        counts.update(hash(raw[k : k + 400]) for k in range(len(raw) - 399))
    for r in QUERIES["op6_suffix_array_dedup"](spark, sf_dir).collect():
        raw = texts[r["doc_id"]].encode()
        gone = np.zeros(len(raw) + 1, np.int64)
        for k in range(len(raw) - 399):
            if counts[hash(raw[k : k + 400])] > 1:
                gone[k] += 1
                gone[k + 400] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        assert (r["n_bytes"], r["n_removed"], r["kept_sha256"]) == (len(raw), int(mask.sum()), hashlib.sha256(kept).hexdigest())


def test_repeated_rows_null_ids_and_empty(spark):
    text = "0123456789" * 3 + "abcdefghij" * 3
    docs = documents(spark, [text, text, "x" + text, None, text], [1, 1, None, None, 4])
    got = rows_of(sd.report(docs, length=25, gram=6))
    assert [r[2] for r in got] == [60, 60, 60, 0, 60]
    assert sd.report(docs.limit(0)).collect() == []
