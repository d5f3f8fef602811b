"""Top-k search against sorting all inner products."""

import numpy as np
import pytest

from millrace.llm import topk


def brute(rows, k, step):
    out = {}
    whole = {(i, tuple(v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    numbers = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in whole]
    for q, a in numbers:
        if q is None or q % step:
            continue
        found = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in numbers if i != q]
        out.setdefault(q, []).append(sorted(found, key=lambda f: (f[0], f[1] is None, f[1] or 0))[:k])
    return out


def search(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block string")
    got = {}
    for r in sorted(topk.search(df, **kw).collect()):
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    return got


@pytest.mark.parametrize("scale", [0.3, 4.0])
def test_against_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, scale, 9).astype(np.float32).tolist(), "x") for i in range(300)]
    rows += [(1000 + i, rows[7][1], "x") for i in range(20)]  # ties
    want = {q: w[0] for q, w in brute([r[:2] for r in rows], 5, 10).items()}
    assert search(spark, rows, query_step=10) == want


def test_odd_rows(spark):
    ok = [0.5, -0.25]
    rows = [(0, ok, "x"), (50, [0.1, 0.1], None), (50, [0.1, 0.1], "x"), (1, None, "x"), (2, [None, 1.0], "x"), (3, [float("nan"), 1.0], "x")]
    rows += [(4, [float("inf"), 1.0], "x"), (5, ok, "x"), (None, ok, "x"), (6, [0.5], "x")]
    got = search(spark, rows)
    assert [v for _, v in got[0]] == [5, None, 6, 50]
    assert [v for _, v in got[50]] == [6, 0, 5, None]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(empty).collect() == []


def test_bit_slices_add_up():
    rng = np.random.default_rng(5)
    rows = rng.integers(-150, 150, (200, 12))
    block = topk.BitSlicedBlock(rows, dropped=0)
    for query in rng.integers(-150, 150, (20, 12)):
        slices = block.scores(query)
        bits = np.stack([np.unpackbits(s.view(np.uint8), bitorder="little")[:200] for s in slices]).astype(np.int64)
        raised = (bits << np.arange(len(slices))[:, None]).sum(axis=0)
        exact = rows @ query
        assert (raised - raised[0] == exact - exact[0]).all()


@pytest.mark.parametrize("dropped", [0, 1, 2, 4])
def test_boundary_rows_hold_the_best(dropped):
    rng = np.random.default_rng(dropped)
    rows = rng.integers(-90, 90, (500, 8))
    block = topk.BitSlicedBlock(rows, dropped=dropped)
    for q in range(20):
        at, scores = block.best(rows[q], 5, np.array([q]))
        exact = rows @ rows[q]
        exact[q] = -(10**9)
        assert sorted(scores)[-5:] == sorted(exact)[-5:]
        assert set(np.flatnonzero(exact >= np.sort(exact)[-5])) <= set(at)


def test_query_matches_sql(spark, duck, sf_dir):
    from millrace.llm.queries import ORACLES, QUERIES
    from tests.oracle import compare

    assert compare(spark, duck, QUERIES["op1_topk_search"], ORACLES["op1_topk_search"], sf_dir) == ""
