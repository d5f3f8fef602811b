"""Language model with a restaurant per word: evidence is kept per pair of words, and probabilities are proper."""

import math
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lm_scoring as lm
from millrace.llm import word_contexts as wc
from millrace.llm.queries import QUERIES
from tests.llm.helpers import documents, prose, with_clashes
from tests.llm.test_lm_scoring import held, plain_tokens


def wh(word):
    return np.array([lm.xxh64_intdigest(word)], np.uint64).view(np.int64)


def test_words_of_one_class_do_not_share_evidence(spark):
    kinds = {}
    for k in range(500):
        kinds.setdefault(int(lm._context(wh(f"a{k}".encode()))[0]), []).append(f"a{k}")
    one, two = next(x for x in kinds.values() if len(x) > 1)[:2]
    ids = [i for i in range(400) if not held(i)]
    texts = [f"{one} x" if i % 2 else f"{two} y" for i in ids]
    docs = documents(spark, texts, ids)
    asked = [i for i in range(1000, 1100) if held(i)][:2]
    rows = QUERIES["op10_lm_scoring"].__globals__["word_contexts"].score_documents(docs.union(documents(spark, [f"{one} x", f"{one} y"], asked))).collect()
    got = {r["doc_id"]: r["score"] for r in rows}
    assert got[asked[0]] > got[asked[1]] + 1


def test_counts_per_pair(spark):
    texts = prose(60, 8)
    docs = documents(spark, texts).select("doc_id", "text").repartition(7)
    want = Counter()
    for i, t in enumerate(texts):
        words = lm.tokens(t)
        if not held(i):
            want.update((int(wh(a)[0]), int(wh(b)[0])) for a, b in zip([lm.END, *words[:-1]], words, strict=True))
    got = Counter()
    for r in wc.buckets(wc.bucket_counts(docs, 3)).collect():
        v, n, w, c = (np.frombuffer(bytes(r[k]), t) for k, t in (("v", np.int64), ("n", np.int64), ("w", np.int64), ("c", "<i4")))
        assert set(wc._bucket(v, 3)) == {r["b"]}
        for a, b, k in zip(np.repeat(v, n), w, c, strict=True):
            assert (int(a), int(b)) not in got
            got[int(a), int(b)] = int(k)
    assert got == want


@pytest.mark.parametrize("chars", [10**9, 100])
def test_probabilities_sum_to_one(spark, chars):
    texts = prose(80, 6)
    docs = documents(spark, texts).select("doc_id", "text")
    model = wc.learn(docs, chars_per_bucket=chars)
    assert (model.parts > 1) == (chars == 100)
    train = Counter(w for i, t in enumerate(texts) if not held(i) for w in lm.tokens(t))
    before = [w.decode() for w, _ in train.most_common(3) if w] + ["zqxj"]
    base = [i for i in range(10**6, 10**6 + 40)]
    # A text "v w" scores p(v | end) p(w | v) p(end | w); all but p(w | v) is taken from the texts "v" and "w".
    words = [w.decode() for w in train if w] + ["qqzz"]
    given = [f"{v} {w}" for v in before for w in words] + words + before + [""]
    got = {}
    for r in wc.score(documents(spark, given, range(base[0], base[0] + len(given))).select("doc_id", "text"), model).collect():
        got[given[r["doc_id"] - base[0]]] = r["score"]
    start = {w: got_w for w, got_w in got.items()}
    # p(v w) = s(v) e(w) p(w | v) with s(v) e(v) = p("v"); sum over w of p(v w) / e(w) / s(v) = 1 - p(end | v).
    total, table = model.n_tokens, {}
    for r in model.words.collect():
        table[r["wh"]] = r
    assert sum(r["c"] for r in table.values()) == total == sum(train.values())
    rows = {r["b"]: r for r in model.buckets.collect()}
    keep = len(model.unknown)

    def p(v, w):
        u = int(lm._context(wh(v))[0])
        r = table.get(int(wh(w)[0]))
        root = np.array([r[q] for q in lm._roots(keep)]) if r else model.unknown
        out = model.back[:, u] * root
        if r:
            pairs = np.frombuffer(bytes(r["pairs"]), np.uint8).reshape(-1, 1 + 4 * keep)
            for x in pairs[pairs[:, 0] == u]:
                out = np.frombuffer(x[1:].tobytes(), "<f4").astype(float)
        b = rows.get(int(wc._bucket(wh(v), model.parts)[0]))
        vs = np.frombuffer(bytes(b["v"]), np.int64) if b else np.zeros(0, np.int64)
        if not (vs == wh(v)).any():
            return out.mean()
        k = int(np.flatnonzero(vs == wh(v))[0])
        n, ws = np.frombuffer(bytes(b["n"]), np.int64), np.frombuffer(bytes(b["w"]), np.int64)
        part = slice(n[:k].sum(), n[: k + 1].sum())
        c, t, kept = (np.frombuffer(bytes(b[x]), "<i4")[part].astype(float) for x in ("c", "t", "kept"))
        tables = np.append(np.frombuffer(bytes(b["back"]), "<i4").reshape(len(vs), -1)[k], t.sum())
        own = ((c - model.d * (kept + t) / keep) * (ws[part] == wh(w))).sum()
        return (own + ((model.strength + model.d * tables) * out).mean()) / (model.strength + c.sum())

    for v in [b"", *(x.encode() for x in before)]:
        assert math.fsum(p(v, w) for w in train) + p(v, b"qqzz") == pytest.approx(1, abs=1e-5)
    for text in [*given[:: max(1, len(given) // 40)], ""]:
        tokens = lm.tokens(text)
        assert start[text] == pytest.approx(sum(math.log10(p(a, w)) for a, w in zip([lm.END, *tokens[:-1]], tokens, strict=True)), rel=1e-5)


def test_plain_counts_and_odd_rows(spark):
    texts = prose(60, 4) + ["", None, "Unknown WORDS only", "a " * 3000]
    ids = [*range(60), 1000, None, 3, None]
    counts = Counter(w for i, t in zip(ids, texts, strict=True) if not held(i) for w in plain_tokens(t))
    total = sum(counts.values())
    rows = wc.score_documents(with_clashes(documents(spark, texts, ids))).collect()
    want = sorted((str(i), len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in w), 6)) for i, t in zip(ids, texts, strict=True) for w in [plain_tokens(t)])
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == want
    assert wc.score_documents(documents(spark, ["a"]).limit(0)).collect() == []
    only_held = [i for i in range(100) if held(i)][:2]
    assert all(math.isfinite(r["score"]) for r in wc.score_documents(documents(spark, ["a b", ""], only_held)).collect())


def test_more_sweeps_change_little(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    few, many = (lm.perplexity(wc.score_documents(docs, burn_in=burn_in, keep=keep)) for burn_in, keep in ((wc.BURN_IN, wc.KEEP), (6, 1)))
    assert few <= many * 1.005


def test_the_blocks_are_scored_from_stored_answers(spark):
    """The texts and the answers are all that the last step moves; the tables of the model are gone by then."""
    docs = documents(spark, ["one two three", "two three", None] * 5, range(15)).select("doc_id", "text")
    model = wc.learn(docs)
    scored = wc.score(docs, model, spent=True)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 + plan.count("REPARTITION_BY_COL")
    assert "Join" not in plan
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        model.words.collect()
    again = wc.score(docs, wc.learn(docs))
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, again.collect()))


def test_texts_read_once_score_as_under_a_model(spark):
    """Scores of the corpus itself are those of the model on the same rows; only pairs that came twice are swept."""
    texts = prose(70, 9) + ["never heard of", "", None, "never seen x1 x2"]
    ids = [*range(70), *[i for i in range(1000, 1100) if held(i)][:2], None, 2000]
    docs = documents(spark, texts, ids).select("doc_id", "text").repartition(3)
    once = sorted(map(tuple, wc.score_documents(docs).collect()), key=str)
    under = sorted(map(tuple, wc.score(docs, wc.learn(docs)).collect()), key=str)
    assert [r[:5] for r in once] == [r[:5] for r in under]
    assert [x for r in once for x in r[5:]] == pytest.approx([x for r in under for x in r[5:]], rel=1e-6)
    state = wc.buckets(wc.bucket_counts(docs, 1, texts=True)).where("b >= 0")
    total = sum((np.frombuffer(bytes(r["c"]), "<i4") > 1).sum() for r in state.collect())
    swept = [np.frombuffer(bytes(r["c"]), "<i4") for r in wc.heavy_pairs(state).collect()]
    assert min(x.min() for x in swept) > 1 and sum(map(len, swept)) == total
