"""Mixing: targets against plain resharing, means of the pivotal step, stable and near its targets."""

import random

import pytest

from millrace.llm import mixing
from tests.llm.helpers import documents, prose, rows_of, with_clashes


def plain_targets(sizes, max_copies=3):
    """Share by weight, cap, reshare the excess until nothing is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(max_copies * sizes[s] for s in capped)
        shares = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if shares[s] > max_copies * sizes[s]}
        if not above:
            return {s: max_copies * sizes[s] if s in capped else shares[s] for s in order}
        capped |= above


def corpus(spark, seed, n=600):
    rng = random.Random(seed)
    texts = prose(n, seed) + ["", None, "  \n"]
    names = ["big"] * 6 + ["a", "B", "é", None, "tiny"]
    return documents(spark, texts, sources=[rng.choice(names) if i % 40 else "rare" for i in range(len(texts))])


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_words(spark, seed):
    docs = corpus(spark, seed)
    sizes, longest = {}, {}
    for r in docs.collect():
        n = len((r["text"] or "").split())
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        longest[r["source"]] = max(longest.get(r["source"], 0), n)
    want = plain_targets(sizes)
    mixed = mixing.mix(mixing.sizes(with_clashes(docs)), per_group=32).collect()
    assert len(mixed) == docs.count()
    taken = {}
    for r in mixed:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        share = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert r["size"] == 0 or int(share) <= r["copies"] <= int(share) + 1
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, words in taken.items():
        assert abs(words - want[s]) <= longest[s] + 1e-6


def test_reruns_agree_on_other_partitions(spark):
    docs = corpus(spark, 3)
    one = mixing.mix_documents(docs)
    other = mixing.mix_documents(docs.repartition(11))
    assert rows_of(one) == rows_of(other)


def test_pivot_keeps_mass_and_mean():
    rng = random.Random(1)
    for _ in range(200):
        p, q, a, b = rng.uniform(0.01, 0.99), rng.uniform(0.01, 0.99), rng.randint(1, 50), rng.randint(1, 50)
        up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
        first, second = mixing.pivot((p, a), (q, b), 0.0), mixing.pivot((p, a), (q, b), 1 - 1e-12)
        for x, y in (first, second):
            assert x * a + y * b == pytest.approx(p * a + q * b)
            assert {x, y} & {0.0, 1.0} and 0 <= x <= 1 and 0 <= y <= 1
        chance = down / (up + down)
        assert chance * first[0] + (1 - chance) * second[0] == pytest.approx(p)


def test_mean_copies_follow_the_share(spark):
    docs = documents(spark, ["w " * 10] * 900, sources=["a"] * 450 + ["b"] * 450)
    mixed = mixing.mix(mixing.sizes(docs), per_group=64).collect()
    by = {s: sum(r["copies"] for r in mixed if r["source"] == s) for s in "ab"}
    assert by["a"] == pytest.approx(300, abs=1) and by["b"] == pytest.approx(600, abs=1)


def test_repeat_rows(spark):
    docs = with_clashes(corpus(spark, 5, 200))
    expected = {}
    for r in mixing.mix_documents(docs).collect():
        expected[r["doc_id"]] = r["copies"]
    again = mixing.repeat_rows(docs)
    assert again.columns == docs.columns
    got = {}
    for r in again.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {d: n for d, n in expected.items() if n}


def test_empty_repeated_and_null(spark):
    docs = documents(spark, [None, "a b", "a b", None], [None, 1, 1, 3], [None, "s", "s", "t"])
    rows = mixing.mix_documents(docs).collect()
    assert sum(r["taken"] for r in rows) == 4 and len(rows) == 4
    assert mixing.repeat_rows(docs).count() == 2
    assert mixing.mix_documents(docs.limit(0)).collect() == []
    assert {r["target"] for r in mixing.mix_documents(documents(spark, ["", None])).collect()} == {0.0}
