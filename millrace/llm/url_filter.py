"""URL filtering by host and path rules and by pattern rules, found through their rarest literal token.

A URL is cut into tokens (runs of a-z and 0-9 of the lower-cased URL).  Every rule names tokens that any URL it fits
must hold, and is filed under the one that is rarest among the URLs at hand.  The tokens of a URL fetch the rules filed
under them; only these candidates are tried: a host and path rule by comparing text, a pattern rule by its regular
expression.  A rule that names no token is filed under the empty token, which every URL has.

The longest fitting host and path rule decides.  Where none fits, a URL that any pattern rule matches is blocked and
every other one is allowed.

Everything is a DataFrame expression or an equi join; whether the rules are broadcast is left to Spark's size check.

Defined cases: a null URL or one without ``://`` has an empty host and path, and fits no host rule; of rules with
equal length the first in alphabetical order decides; repeated rows each get a result row; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def tokens(self) -> list[str]:
        """Tokens that a fitting URL holds; a path may go on, so a token at its end is not among them."""
        return re.findall("[a-z0-9]+", self.host) + re.findall("[a-z0-9]+(?=[^a-z0-9])", self.path.lower())


@dataclass(frozen=True)
class PatternRule:
    """``pattern`` is searched in the lower-cased URL; ``literals`` are tokens that every match implies."""

    pattern: str
    literals: tuple[str, ...]


# The rules of the query.
HOST_RULES = (
    HostRule("org", "/", "allow"),
    HostRule("example.org", "/es/", "block"),
    HostRule("example.org", "/en/1", "block"),
    HostRule("com", "/fr/", "allow"),
    HostRule("com", "/de/", "block"),
)
_IN_HOST = "^[^/?#]*://([^/?#]*[.-])?{}[.:-]"
PATTERN_RULES = (
    PatternRule(_IN_HOST.format("spam-farm"), ("spam", "farm")),
    PatternRule(_IN_HOST.format("link-farm"), ("link", "farm")),
    PatternRule(_IN_HOST.format("free-bets"), ("free", "bets")),
    PatternRule(_IN_HOST.format("online-casino"), ("online", "casino")),
    PatternRule(_IN_HOST.format("casino"), ("casino",)),
    PatternRule(_IN_HOST.format("poker"), ("poker",)),
    PatternRule(_IN_HOST.format("viagra"), ("viagra",)),
    PatternRule(_IN_HOST.format("cheap-pills"), ("cheap", "pills")),
    PatternRule(_IN_HOST.format("payday-loans"), ("payday", "loans")),
    PatternRule(_IN_HOST.format("porn"), ("porn",)),
    PatternRule(_IN_HOST.format("xxx"), ("xxx",)),
    PatternRule("/wp-login[.]php", ("wp", "login")),  # "php" may go on
    PatternRule("[?&]affiliate_id=[0-9]", ("affiliate", "id")),
)


def rule_table(spark: SparkSession, hosts: Sequence[HostRule] = HOST_RULES, patterns: Sequence[PatternRule] = PATTERN_RULES) -> DataFrame:
    """rule, host, path, verdict, pattern, tokens; ``pattern`` is null for host rules, ``host`` for pattern rules."""

    def row(rule, host, path, verdict, pattern, tokens):
        texts = {"rule": rule, "host": host, "path": path, "verdict": verdict, "pattern": pattern}
        named = [F.lit(v).cast("string").alias(k) for k, v in texts.items()]
        return F.struct(*named, F.array(*map(F.lit, sorted(set(tokens)))).cast("array<string>").alias("tokens"))

    rows = [row(r.text, r.host, r.path, r.verdict, None, r.tokens()) for r in hosts]
    rows += [row(r.pattern, None, None, "block", r.pattern, r.literals) for r in patterns]
    return spark.range(1).select(F.inline(F.array(*rows)))


def tokens(url: Column) -> Column:
    """Distinct tokens; every URL also has the empty one."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), "[^a-z0-9]+")))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def token_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``rules`` with ``token``, the rarest of their tokens among the URLs (column ``url``)."""
    wanted = rules.select(F.col("rule"), F.col("pattern"), F.explode_outer("tokens").alias("token")).withColumn("token", F.coalesce("token", F.lit("")))
    asked = wanted.select("token").distinct()
    seen = urls.select(F.explode(tokens(F.col("url"))).alias("token")).join(asked, "token", "left_semi").groupBy("token").count()
    rarest = wanted.join(seen, "token", "left").groupBy("rule", "pattern").agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token"))["token"].alias("token"))
    right = rarest.withColumnsRenamed({"rule": "_rule", "pattern": "_pattern"})
    return rules.join(right, (F.col("rule") == F.col("_rule")) & F.col("pattern").eqNullSafe(F.col("_pattern"))).drop("_rule", "_pattern", "tokens")


def judge(pages: DataFrame, rules: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    rules = rule_table(pages.sparkSession) if rules is None else rules
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    index = token_index(rules, urls).withColumnsRenamed({c: f"_{c}" for c in ("rule", "host", "path", "verdict", "pattern")})
    distinct = urls.select("url").distinct()
    host, path = host_and_path(F.col("url"))
    parts = distinct.withColumns({"host": host, "path": path})
    tried = parts.withColumn("token", F.explode(tokens(F.col("url")))).join(index, "token")
    host_fits = F.endswith(F.concat(F.lit("."), F.col("host")), F.concat(F.lit("."), F.col("_host"))) & F.startswith("path", F.col("_path"))
    lowered = F.translate(F.col("url"), UPPER, LOWER)
    fits = tried.where(F.when(F.col("_pattern").isNull(), host_fits).otherwise(F.regexp_like(lowered, F.col("_pattern"))))
    named = F.col("_pattern").isNull()
    first = F.min(F.when(named, F.struct((-F.length("_rule")).alias("l"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))))
    found = fits.groupBy(F.col("url").alias("_url")).agg(first.alias("best"), F.bool_or(~named).alias("matched"))
    joined = urls.join(found, F.col("url").eqNullSafe(F.col("_url")), "left")
    verdict = F.coalesce(F.col("best.verdict"), F.when(F.col("matched"), "block"), F.lit("allow"))
    return joined.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), F.col("best.rule").alias("rule"), verdict.alias("verdict"))


def oracle() -> str:
    """DuckDB text of the same verdicts, every rule tried on every URL."""
    quoted = ", ".join("'" + r.pattern + "'" for r in PATTERN_RULES)
    hosts = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in HOST_RULES)
    return f"""
    with page as (
        select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
    ), part as (
        select page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') as host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from page
    ), rules(h, p, v) as (values {hosts}), best as (
        select url, first(h || p order by length(h || p) desc, h || p) as rule, first(v order by length(h || p) desc, h || p) as v
        from (select distinct url, host, path from part) join rules on ends_with('.' || host, '.' || h) and starts_with(path, p) group by url
    )
    select page_id, host, path, rule, coalesce(v, case when exists(
        select 1 from (select unnest([{quoted}]) as pattern) where regexp_matches(translate(part.url, '{UPPER}', '{LOWER}'), pattern)) then 'block' else 'allow' end) as verdict
    from part left join best on part.url is not distinct from best.url
    """
