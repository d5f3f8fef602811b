"""Quality rules against plain counting."""

import random

import numpy as np

from millrace.llm import quality_rules as q
from millrace.llm import textstats
from tests.llm.helpers import documents, prose, rows_of, with_clashes


def plain(text):
    spaced = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "")
    words = [w for w in spaced.split(" ") if w]
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def texts():
    rng = random.Random(4)
    out = prose(60, 5, words=90)
    for _ in range(40):
        part = " ".join(rng.choice("abc") for _ in range(rng.randint(8, 30)))
        out.append(rng.choice([" ", "\n", "\r\n"]).join([part] * rng.randint(1, 4)) + rng.choice(["", " | #", "\n\n \n"]))
    return out + ["", None, " \n\t", "é" * 30, "word " * 25, "a b c d e f g h a b c d e f g h", "\n".join(["same line here"] * 5), "   x"]


def test_counts(spark):
    given = texts()
    got = {r["doc_id"]: r for r in q.judge(with_clashes(documents(spark, given))).collect()}
    for i, t in enumerate(given):
        want = plain(t)
        assert tuple(got[i][1:6]) == want, t
        assert got[i]["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_hash_collisions_are_verified(monkeypatch):
    monkeypatch.setattr(textstats, "_WEIGHTS", np.zeros(8, np.uint64))  # every window has the same hash
    for t in texts():
        assert textstats.TextView(t).n_repeat_words == plain(t)[4]


def test_order_changes_cost_not_verdict(spark):
    rules = q.BASE + q.METHOD
    measured = {r.name: (0.1, 1.0) for r in rules} | {"symbols": (0.5, 0.1), "letters": (0.0, 0.01)}
    ordered = q.cascade_order(rules, measured)
    assert ordered[0].name == "symbols" and ordered[-1].name == "letters"
    for t in texts():
        verdicts = {q.verdict(textstats.TextView(t), o) is None for o in (rules, ordered, ordered[::-1])}
        assert len(verdicts) == 1


def test_later_counts_are_not_made():
    view = textstats.TextView("too short")
    assert q.verdict(view, q.BASE + q.METHOD) == "words"
    assert "n_repeat_words" not in vars(view)


def test_keep_good_keeps_columns_and_rows(spark):
    docs = with_clashes(documents(spark, texts() + texts()[:5], sources=None))
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    want = [r for r in rows_of(docs) if all(not rule.rejects(textstats.TextView(r[1])) for rule in q.BASE + q.METHOD)]
    assert rows_of(kept) == want
    assert q.keep_good(docs.limit(0)).collect() == []


def test_measure_covers_every_rule(spark):
    found = q.measure(documents(spark, texts() * 30), q.METHOD, sample_rows=500)
    assert set(found) == {r.name for r in q.METHOD} and any(rate > 0 for rate, _ in found.values())


def test_query_matches_sql(spark, duck, sf_dir):
    from millrace.llm.queries import ORACLES, QUERIES
    from tests.oracle import compare

    assert compare(spark, duck, QUERIES["op8_quality_rules"], ORACLES["op8_quality_rules"], sf_dir) == ""
