"""Secret scans: the SQL counterpart covers the query; here plain scanning of odd texts and the ledger."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from millrace.llm import secret_scan as ss
from millrace.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import documents, with_clashes
from tests.oracle import compare


def plain(text):
    spans = []
    for k, rule in enumerate(ss.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.least:
                spans.append((m.start(), k, m.end(), rule.kind))
    spans.sort()
    kinds = [r.kind for r in ss.BASE_RULES]
    told = lambda some: ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in some)
    base = [s for s in spans if s[3] in kinds]
    return *(sum(s[3] == k for s in spans) for k in kinds), hashlib.sha256(told(base).encode()).hexdigest(), told(spans)


def odd_texts():
    rng = random.Random(2)
    parts = ["token", "TOKEN", "Api_Key", "apikey", "passwd", " = ", ":", "=", '"', "'", " ", "\n", "secret: abcdefgh", "abcd", "AKIA", "AKIAABCDEFGHIJKL", "AKIA12", "é🙂", "0123456789abcdef" * 2,
             "deadbeef", "ſecret=12345678", "ghp_" + "a" * 36, "xoxb-1234567890-a", "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefghij", "password=password=secret12", "K"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(250)]


def test_odd_texts(spark):
    given = odd_texts() + ["", None, "token=abc token=abcdefgh", "x" * 90_000 + "token=12345678" * 500]
    docs = with_clashes(documents(spark, given))
    got = {r[0]: tuple(r)[1:] for r in ss.report(docs).collect()}
    assert len(got) == len(given)
    for i, t in enumerate(given):
        assert got[i] == plain(t), t


def test_query_matches_sql(spark, duck, sf_dir):
    assert compare(spark, duck, QUERIES["op9_secret_scans"], ORACLES["op9_secret_scans"], sf_dir) == ""


def test_ledger_scans_only_what_is_new(spark):
    old = documents(spark, ["token=abcdefgh", "nothing", "token=abcdefgh"])
    ledger, _ = ss.update_ledger(old)
    ledger = ss.stored(ledger)
    assert ledger.count() == 2 * len(ss.RULES)
    both = old.union(documents(spark, ["AKIAABCDEFGHIJKL", "nothing"], [10, 11]))
    new, paths = ss.update_ledger(both, ledger=ledger)
    assert new.select("blob").distinct().count() == 1 and paths.count() == 5
    assert sorted(tuple(r) for r in ss.report(both, ledger=ledger).collect()) == sorted(tuple(r) for r in ss.report(both).collect())
    # A new version of one rule scans all blobs again, for that rule only.
    changed = tuple(ss.SecretRule(r.kind, r.pattern, r.group, 4, 2) if r.kind == "assign" else r for r in ss.RULES)
    new, _ = ss.update_ledger(old, changed, ledger)
    assert {(r["kind"], r["version"]) for r in new.collect()} == {("assign", 2)} and new.count() == 2
    found = ss.findings(ledger.unionByName(new), changed).select(F.explode("spans")).count()
    assert found == 1


def test_repeated_rows_null_ids_and_empty(spark):
    docs = documents(spark, ["token=abcdefgh"] * 4 + [None], [1, 1, None, 2, None])
    assert sorted(((r["doc_id"], r["n_assign"]) for r in ss.report(docs).collect()), key=repr) == [(1, 1), (1, 1), (2, 1), (None, 0), (None, 1)]
    assert ss.report(docs.limit(0)).collect() == []


def test_equal_rows_are_scanned_once(spark):
    text = "token=abcdefgh and password: 12345678"
    given = [text, text, text + "!", text + "!"]
    rows = ss.report(documents(spark, given, [1, 1, None, None])).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == sorted(((i, *plain(t)) for i, t in zip([1, 1, None, None], given, strict=True)), key=repr)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op9_secret_scans"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD|CartesianProduct|NestedLoop", plan)
