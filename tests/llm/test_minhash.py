"""MinHash near-duplicates against plain sets and all pairs."""

import random

import numpy as np
import pytest

from millrace.llm import minhash
from tests.llm.helpers import documents, prose, rows_of, with_clashes


def plain_set(text, width=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: 32 for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain(ids, texts, percent=80):
    """(doc_id, n_shingles, component_id, kept) from all pairs of sets."""
    sets, parent = [plain_set(t) for t in texts], list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, one in enumerate(sets):
        for j in range(i):
            if one and sets[j] and 100 * min(len(one), len(sets[j])) >= percent * max(len(one), len(sets[j])):
                common = len(one & sets[j])
                if 100 * common >= percent * (len(one) + len(sets[j]) - common):
                    parent[find(j)] = find(i)
    least = {}
    for i, d in enumerate(ids):
        least.setdefault(find(i), []).append(d)
    out = []
    for i, d in enumerate(ids):
        component = min((x for x in least[find(i)] if x is not None), default=None) if sets[i] else d
        out.append((d, len(sets[i]), component, d == component))
    return sorted(out, key=repr)


def edited(base, seed, edits):
    rng, words = random.Random(seed), base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
    return rng.choice([" ", "\n", "\x0b "]).join(words)


def test_against_all_pairs(spark):
    base = [" ".join(f"{k}x{i}" for i in range(120)) for k in range(4)]
    texts = [edited(base[s % 4], s, s % 7) for s in range(160)] + prose(30, 2)
    texts += ["", None, " \t", "one", "One", "one two", "a b c", "a b c d", "a b c d e", "A b c d e f", "İ ſ K x y"]
    ids = [997 * i % 1000 for i in range(len(texts))]
    got = minhash.near_duplicates(with_clashes(documents(spark, texts, ids)))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert rows_of(got) == plain(ids, texts)


def test_query_against_all_pairs(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op13_minhash_near_dedup"](spark, sf_dir)) == plain([r[0] for r in rows], [r[1] for r in rows])


def test_links_that_the_first_star_misses(spark):
    """A chain whose ends are far apart: each text is near to the next one only, whatever the centre of a bucket is."""
    words = [f"v{i}" for i in range(300)]
    texts = [" ".join([f"n{j}" for j in range(4 * k)] + words[4 * k :]) for k in range(24)]
    ids = list(range(24))
    random.Random(3).shuffle(ids)
    assert rows_of(minhash.near_duplicates(documents(spark, texts, ids))) == plain(ids, texts)


def test_odd_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = text + " z"
    third = [None] * 40  # rows without id
    ids = [5, 5, None, 3, None, None, 9] + third
    texts = [text, text, near, near, "", "only without id", None] + ["the same text of rows without id"] * 40
    got = minhash.near_duplicates(documents(spark, texts, ids))
    assert rows_of(got) == plain_null_safe(ids, texts)


def plain_null_safe(ids, texts):
    return sorted(((d, n, c, d == c) for d, n, c, _ in plain(ids, texts)), key=repr)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []
    assert rows_of(minhash.near_duplicates(documents(spark, ["", None]))) == [(0, 0, 0, True), (1, 0, 1, True)]


@pytest.mark.parametrize("n", [1, 4, 5, 40, 3000])
def test_bins_agree_with_the_similarity(n):
    """Sketches of sets with similarity near 0.8 agree in about that share of their bins, for small sets too."""
    rng = np.random.default_rng(n)
    shares = []
    for _ in range(150):
        pool = rng.integers(0, 2**64, n + max(1, n // 4), dtype=np.uint64)
        one, other = np.unique(pool[:n]), np.unique(pool)
        shares.append((minhash.bins_of(one) == minhash.bins_of(other)).mean())
    assert abs(np.mean(shares) - n / (n + max(1, n // 4))) < 0.05


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(200_000))
    got = rows_of(minhash.near_duplicates(documents(spark, [text, text + " end", "w0 w1 w2 w3"])))
    assert got == [(0, 199_997, 0, True), (1, 199_998, 0, False), (2, 1, 2, True)]
