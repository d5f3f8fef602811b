"""URL rules: the SQL counterpart covers the query; here the odd cases and other rules."""

import random
import re

import pytest

from millrace.llm import url_filter as uf
from millrace.llm.queries import ORACLES, QUERIES
from tests.oracle import compare

PAGES = "page_id long, url string, html string"


def frame(spark, urls, ids=None):
    return spark.createDataFrame([(i, u, "x") for i, u in zip(ids or range(len(urls)), urls, strict=True)], PAGES).repartition(3)


def plain(url, hosts, patterns):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    head = re.match(r"[^/?#]*", rest)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in head)
    path = re.match(r"[^?#]*", rest[len(head) :])[0]
    fits = [r for r in hosts if ("." + host).endswith("." + r.host) and path.startswith(r.path)] if url else []
    if fits:
        best = min(fits, key=lambda r: (-len(r.text), r.text))
        return host, path, best.text, best.verdict
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    return host, path, None, "block" if any(re.search(p.pattern, low) for p in patterns) else "allow"


ODD = [
    "http://a.ORG/", "http://org", "http://example.org/es/x", "HTTPS://www.example.org/en/123?x=1", "ftp://notexample.org/es/", "http://a.com/fr/",
    "http://a.com/de", "http://a.com/de/#x", "//a.com/fr/", "a.com/fr/", "", None, "://org/", "x://://org/", "http://spam-farm1.net/", "http://www.spam-farm.net/a",
    "http://x.net/spam-farm.", "http://SPAM-FARM.net:80/", "http://free-bets.org/", "http://casino.net", "http://casinos.net/", "http://a.net/?affiliate_id=7",
    "http://a.net/WP-Login.php", "http://a.net/ " + "y" * 50_000, "http://ex\nample.org/es/", "http://é.org/es/", "http://a.org?x=http://spam-farm.net/",
]


def check(spark, urls, hosts=uf.HOST_RULES, patterns=uf.PATTERN_RULES):
    got = {r["page_id"]: tuple(r)[1:] for r in uf.judge(frame(spark, urls), uf.rule_table(spark, hosts, patterns)).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == plain(u, hosts, patterns), u


def test_odd_urls(spark):
    check(spark, ODD)


def test_query_matches_sql(spark, duck, sf_dir):
    assert compare(spark, duck, QUERIES["op5_url_filters"], ORACLES["op5_url_filters"], sf_dir) == ""


def test_many_rules(spark):
    hosts = [uf.HostRule(f"h{i}.net", f"/p{i % 7}", ("allow", "block")[i % 2]) for i in range(60)] + [uf.HostRule("net", "/p1", "block"), uf.HostRule("h3.net", "", "allow")]
    patterns = [uf.PatternRule(f"bad{i}[.]", (f"bad{i}",)) for i in range(0)] + [uf.PatternRule("q=[0-9]{3}", ("q",)), uf.PatternRule("zz", ())]
    check(spark, [f"http://www.h{i % 70}.net/p{i % 9}/x?{'q=123' if i % 5 else 'zzz'}" for i in range(300)], hosts, patterns)


def test_a_match_may_go_on_behind_its_pattern(spark):
    check(spark, ["http://a.net/wp-login.php5", "http://wp.net/login/wp-login"] + ["http://wp.net/login"] * 5)


@pytest.mark.parametrize("rule", uf.PATTERN_RULES, ids=lambda r: r.pattern)
def test_every_match_holds_all_literals(rule):
    rng = random.Random(5)
    word = "/wp-login.php" if "wp-login" in rule.pattern else "affiliate_id=" if "affiliate" in rule.pattern else re.search(r"[)][?](.*)[[]", rule.pattern)[1]
    around = ["a", "z9", "5", ".", "-", "/", "?", "&", ":", "_", "http://", "://", ""]
    matches = 0
    for _ in range(4000):
        url = "".join([*rng.choices(around, k=3), word, *rng.choices(around, k=2)])
        if re.search(rule.pattern, url):
            matches += 1
            assert set(rule.literals) <= set(re.findall("[a-z0-9]+", url)), url
    assert matches > 20


def test_each_rule_is_filed_under_its_rarest_token(spark):
    urls = frame(spark, ["http://spam.net/"] * 5 + ["http://farm.net/", "http://spam-farm.net/"])
    rules = uf.rule_table(spark, (uf.HostRule("farm.net", "/", "block"),), (uf.PatternRule("spam-farm", ("spam", "farm")),))
    index = {r["rule"]: r["token"] for r in uf.token_index(rules, urls).collect()}
    assert index == {"farm.net/": "farm", "spam-farm": "farm"}


@pytest.mark.parametrize("rule, want", [(uf.HostRule("example.org", "/en/1", "x"), ["example", "org", "en"]), (uf.HostRule("com", "/fr/", "x"), ["com", "fr"]), (uf.HostRule("a.b", "", "x"), ["a", "b"])])
def test_tokens_of_host_rules(rule, want):
    assert rule.tokens() == want


def test_repeated_rows_null_ids_and_empty(spark):
    df = frame(spark, ["http://a.org/"] * 3 + [None, None], [1, 1, None, 2, None])
    assert sorted((r["page_id"] or 0, r["verdict"], r["rule"] or "") for r in uf.judge(df).collect()) == [(0, "allow", ""), (0, "allow", "org/"), (1, "allow", "org/"), (1, "allow", "org/"), (2, "allow", "")]
    assert uf.judge(df.limit(0)).collect() == []
    assert uf.judge(df.withColumnsRenamed({"html": "token"})).count() == 5


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op5_url_filters"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD|CartesianProduct|NestedLoop", plan)
