"""Line dedup against plain counting, and an index that forgets."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import cuckoo
from millrace.llm import line_dedup as ld
from tests.llm.helpers import documents, rows_of, with_clashes


def plain_key(line):
    kept = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in kept) if len(kept) >= 10 else None


def plain(docs):
    """docs: (id, text) -> rows of the report; a null id ranks last."""
    holders = {}
    rank = lambda i: 2**63 - 1 if i is None else i
    for i, t in docs:
        for line in (t or "").split("\n"):
            if (k := plain_key(line)) is not None:
                holders.setdefault(k, set()).add(rank(i))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if (k := plain_key(x)) is None or len(holders[k]) < 2 or min(holders[k]) == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def texts(n, seed):
    rng = random.Random(seed)
    pool = [f"{rng.choice(['Shared', 'shared', ' SHARED'])} line number {rng.randint(1, 40)}{rng.choice(['', ' ', chr(13)])}" for _ in range(80)]
    pool += ["short", "", "   ", "ÄÖÜ ÄÖÜ ÄÖÜ", "äöü ÄÖÜ ÄÖÜ", "exactly10!", "nine char", "İstanbul line"]
    return ["\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own line {rng.random()}" for _ in range(rng.randint(1, 9))) for _ in range(n)]


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_report(spark, batches):
    given = texts(150, batches) + ["", None, "hot line of everyone"] + ["hot line of everyone\nx"] * 60
    ids = [(7 * i) % 997 for i in range(len(given) - 2)] + [None, None]
    docs = with_clashes(documents(spark, given, ids))
    assert rows_of(ld.report(docs, batches=batches)) == plain(list(zip(ids, given, strict=True)))


def test_rows_of_one_id_are_one_document(spark):
    given = [(1, "a line that is long"), (1, "a line that is long"), (2, "A LINE that is long\nx")]
    docs = documents(spark, [t for _, t in given], [i for i, _ in given])
    assert [r[2] for r in rows_of(ld.report(docs))] == [0, 0, 1]


def test_deleted_documents_leave_no_trace(spark):
    given = list(enumerate(texts(120, 5)))
    one, two = given[::2], given[1::2]
    frame = lambda rows: documents(spark, [t for _, t in rows], [i for i, _ in rows])
    index = ld.empty_index(frame(one), 3).insert(frame(one)).insert(frame(two))
    first_half = [(i,) for i, _ in two]
    left = index.delete(spark.createDataFrame(first_half, "doc_id long"))
    assert rows_of(left.postings) == rows_of(ld.postings(frame(one)))
    lost = {r["doc"]: {(k["k1"], k["k2"]) for k in r["keys"]} for r in left.dropped().collect()}
    fresh = {r["doc"]: {(k["k1"], k["k2"]) for k in r["keys"]} for r in ld.build_index(frame(one)).dropped().collect()}
    assert lost == fresh
    again = left.insert(frame(two))
    clean = sorted((r["doc_id"], r["text"]) for r in ld.dedup_lines(frame(given), again).collect())
    want = sorted((r["doc_id"], r["text"]) for r in ld.dedup_lines(frame(given), index).collect())
    assert clean == want != sorted(given)
    # Filter slots of lines that are gone are free: what is left is what the first batch filled.
    cells = lambda i: sum(int((np.frombuffer(r["cells"], np.uint16) > 0).sum()) for r in i.filters.collect())
    assert cells(left) == ld.postings(frame(one)).select("k1", "k2").distinct().count()


def test_dedup_keeps_columns_and_nulls(spark):
    docs = with_clashes(documents(spark, ["the same long line", None, "the same long line\nrest", ""], [3, 2, 9, 1]))
    done = ld.dedup_lines(docs, ld.build_index(docs))
    assert done.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in done.collect()) == [(1, ""), (2, None), (3, "the same long line"), (9, "rest")]
    empty = docs.limit(0)
    assert ld.report(empty).collect() == [] and ld.dedup_lines(empty, ld.build_index(empty)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 5, 9, 100, 5000])
def test_cuckoo_filter(n):
    rng = np.random.default_rng(n)
    k1, k2 = (rng.integers(0, 2**63, n, dtype=np.uint64) for _ in range(2))
    table = cuckoo.build(k1, k2)
    assert int((table > 0).sum()) == n and cuckoo.contains(table, k1, k2).all()
    o1, o2 = (rng.integers(0, 2**63, 20_000, dtype=np.uint64) for _ in range(2))
    assert cuckoo.contains(table, o1, o2).mean() < 0.001
    half = n // 2
    left = cuckoo.remove(table, k1[:half], k2[:half])
    assert int((left > 0).sum()) == n - half and cuckoo.contains(left, k1[half:], k2[half:]).all()


def test_query_matches_sql(spark, duck, sf_dir):
    from millrace.llm.queries import ORACLES, QUERIES
    from tests.oracle import compare

    assert compare(spark, duck, QUERIES["op3_line_dedup"], ORACLES["op3_line_dedup"], sf_dir) == ""
