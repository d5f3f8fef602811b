"""SimHash against fingerprints and links made the plain way."""

import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from millrace.llm import components, simhash
from tests.llm.helpers import documents, prose, rows_of, with_clashes


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: 32 for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, max_bits=2):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fp = np.array(fps, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= max_bits) + i + 1:
            parent[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        least.setdefault(find(i), []).append(d)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(ids))]


def variants(n, seed):
    rng = random.Random(seed)
    base = prose(6, seed, words=90)
    out = []
    for _ in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(["x", "Ä", "QQ"])
        out.append(rng.choice([" ", "\n", "\x0b "]).join(words))
    return out


def test_against_brute_force(spark):
    texts = variants(150, 1) + prose(40, 2) + ["", None, "  ", "one", "One", "one two", "İ ſ K", "a b c"]
    ids = [997 * i % 1000 for i in range(len(texts))]
    docs = with_clashes(documents(spark, texts, ids))
    fps = [plain_fingerprint(t) for t in texts]
    want = sorted(zip(ids, [f"{f:016x}" for f in fps], plain_components(ids, fps), strict=True))
    assert [tuple(r) for r in sorted(simhash.near_duplicates(docs).collect())] == want


def test_query_against_brute_force(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    ids, fps = [r[0] for r in rows], [plain_fingerprint(r[1]) for r in rows]
    want = sorted(zip(ids, [f"{f:016x}" for f in fps], plain_components(ids, fps), strict=True))
    assert sorted(tuple(r) for r in QUERIES["op2_simhash_near_dedup"](spark, sf_dir).collect()) == want


def test_long_text_is_chunked(monkeypatch):
    text = " ".join(prose(1, 9, words=5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_links_keep_components(spark, max_bits):
    rng = random.Random(max_bits)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(3):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    found = {r["fp"] % (1 << 64): r["root"] for r in simhash.classes(spark.createDataFrame(signed, "fp long"), max_bits).collect()}
    want = plain_components(list(range(len(fps))), fps, max_bits)
    groups = lambda labels: sorted(tuple(i for i, x in enumerate(labels) if x == y) for y in set(labels))
    assert groups([found[f] for f in fps]) == groups(want)


def test_repeated_rows_null_ids_and_empty(spark):
    docs = documents(spark, ["a b c d"] * 3 + [None, None], [5, 5, 2, None, None])
    got = rows_of(simhash.near_duplicates(docs))
    assert [r[2] for r in got] == [2, 2, 2, None, None]
    kept = simhash.keep_one(with_clashes(docs))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == [(2, "a b c d"), (None, None)]
    assert kept.columns == with_clashes(docs).columns
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(7000, 6000), (7, 7)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "x long, y long").repartition(7)
    roots = {r["node"]: r["root"] for r in components.connected(df).collect()}
    assert {roots[i] for i in range(1, 301)} == {0}
    assert {roots[i] for i in range(1001, 1400)} == {1000}
    assert roots[7000] == 6000
