"""Language model: base score against plain counting, a proper distribution, the sampler against the exact law."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lm_scoring as lm
from millrace.llm import pitman_yor as py
from tests.llm.helpers import documents, prose, with_clashes


def plain_tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c for c in text or "")
    return [w for w in low.split(" ") if w] + ["</end>"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_against_plain_counts(spark):
    texts = prose(150, 4) + ["", None, "Unknown WORDS only", "a " * 30_000]
    ids = [*range(150), 1000, None, 3, None]
    counts = Counter(w for i, t in zip(ids, texts, strict=True) if not held(i) for w in plain_tokens(t))
    total = sum(counts.values())
    rows = lm.score_documents(with_clashes(documents(spark, texts, ids))).collect()
    assert len(rows) == len(texts)
    want = sorted(
        (str(i), held(i), len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in w), 6))
        for i, t in zip(ids, texts, strict=True)
        for w in [plain_tokens(t)]
    )
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert got == want


def probability(model, words):
    """(word hash, context) -> probability, from the rows of the model; None stands for words that were not seen."""
    rows = {}
    for r in words:
        pairs = np.frombuffer(bytes(r["pairs"]), np.uint8).reshape(-1, 5)
        worth = np.ascontiguousarray(pairs[:, 1:]).view("<f4").ravel().astype(float)
        rows[r["wh"]] = r["c"], np.array([r[q] for q in lm._roots(len(model.unknown))]), dict(zip(pairs[:, 0].tolist(), worth.tolist(), strict=True))

    def p(wh, u):
        _, parent, worth = rows.get(wh, (0, model.unknown, {}))
        return worth.get(u, 0.0) * model.own[u] + float(np.mean(model.back[:, u] * parent))

    return p, sum(r[0] for r in rows.values())


def test_probabilities_sum_to_one_and_score_sums_logs(spark):
    texts = prose(120, 6) + ["zq xj"]
    docs = documents(spark, texts).select("doc_id", "text")
    model = lm.learn(docs)
    words = model.table.collect()
    p, total = probability(model, words)
    for u in range(lm.CONTEXTS):
        assert math.fsum(p(r["wh"], u) for r in words) + p(None, u) == pytest.approx(1, abs=1e-6)
    assert total == model.n_tokens
    kind = lambda w: int(lm._context(np.array([lm.xxh64_intdigest(w)], np.uint64).view(np.int64))[0])
    for r in lm.score(docs, model).collect():
        tokens = lm.tokens(texts[r["doc_id"]])
        before = [lm.END, *tokens[:-1]]
        want = sum(math.log10(p(np.uint64(lm.xxh64_intdigest(w)).astype(np.int64).item(), kind(b))) for w, b in zip(tokens, before, strict=True))
        assert r["score"] == pytest.approx(want, rel=1e-6)


def test_partitions_and_flushes_do_not_change_counts(spark):
    docs = documents(spark, prose(60, 8)).select("doc_id", "text")
    rows = lambda df: sorted((r["wh"], bytes(r["us"]), bytes(r["cs"])) for r in lm.word_rows(lm.pair_counts(df)).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        small = rows(docs.repartition(40))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    whole = rows(docs.coalesce(1))
    assert small == whole and len({r[0] for r in whole}) == len(whole)


def test_blocks_do_not_change_scores(spark):
    docs = documents(spark, prose(80, 7)).select("doc_id", "text")
    model = lm.learn(docs)
    score = lambda chars: sorted((r["doc_id"], round(r["score"], 9)) for r in lm.score(docs, model, chars).collect())
    assert score(500) == score(10**9)


def test_held_out_text_is_better_than_the_base(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    rows = QUERIES["op10_lm_scoring"](spark, sf_dir).collect()
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    plain = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    junk = spark.createDataFrame([(r["doc_id"], "zq xj " * 40) for r in out], "doc_id long, text string")
    model = lm.learn(plain)
    assert lm.perplexity(lm.score(junk, model)) > lm.perplexity(lm.score(plain, model))


def test_empty_and_untrained(spark):
    docs = documents(spark, ["some words", None], [None, 5])
    assert lm.score_documents(docs.limit(0)).collect() == []
    only_held = [i for i in range(100) if held(i)][:2]
    rows = lm.score_documents(documents(spark, ["a b", ""], only_held)).collect()
    assert {(r["held_out"], r["n_known"], r["train_tokens"]) for r in rows} == {(True, 0, 0)} and all(math.isfinite(r["score"]) for r in rows)


def exact_law(c, d, strength, parent):
    logs = py.log_stirling(d, max(py.EXACT, c))[c, 1 : c + 1] + np.cumsum(np.log(strength + d * np.arange(c))) + np.arange(1, c + 1) * np.log(parent)
    law = np.exp(logs - logs.max())
    return law / law.sum()


def crp_law(c, d, strength, parent):
    """By summing over the sequences of customers: a new table or one of the old ones."""
    law = {(0, 0): 1.0}
    for n in range(c):
        new: dict = {}
        for (_, t), w in law.items():
            new[n + 1, t + 1] = new.get((n + 1, t + 1), 0) + w * (strength + d * t) * parent
            if t:
                new[n + 1, t] = new.get((n + 1, t), 0) + w * (n - d * t)
        law = new
    total = sum(law.values())
    return np.array([law.get((c, t), 0) / total for t in range(1, c + 1)])


@pytest.mark.parametrize("c, d, strength, parent", [(2, 0.5, 1.0, 0.1), (7, 0.3, 4.0, 0.4), (40, 0.8, 30.0, 0.01)])
def test_law_and_sampler(c, d, strength, parent):
    law = exact_law(c, d, strength, parent)
    assert law == pytest.approx(crp_law(c, d, strength, parent), abs=1e-12)
    n = 20_000
    drawn = py.draw_tables(np.full(n, c), d, np.full(n, strength), np.full(n, np.log(parent)), np.random.default_rng(1))
    assert np.abs(np.bincount(drawn, minlength=c + 1)[1:] / n - law).max() < 0.015


@pytest.mark.parametrize("c, d, strength, parent", [(300, 0.5, 10.0, 0.01), (500, 0.7, 1000.0, 0.001), (400, 0.3, 5.0, 0.5), (600, 0.8, 1e5, 1e-3), (200, 0.5, 1.0, 1e-6)])
def test_many_customers(c, d, strength, parent):
    law, t = exact_law(c, d, strength, parent), np.arange(1, c + 1)
    mean, spread = (law * t).sum(), math.sqrt((law * t * t).sum() - (law * t).sum() ** 2)
    n = 4000
    drawn = py.draw_tables(np.full(n, c), d, np.full(n, strength), np.full(n, np.log(parent)), np.random.default_rng(2))
    assert drawn.mean() == pytest.approx(mean, rel=0.05, abs=0.05) and drawn.std() == pytest.approx(spread, rel=0.1, abs=0.05)
