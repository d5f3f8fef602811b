"""Secret scanning over an incremental blob ledger.

Every version of a text is a blob, named by its SHA-256.  The ledger says which (blob, rule version) pairs have been
scanned and what was found.  A run scans only pairs that are not in the ledger, one text per blob however many paths
hold it, and joins the findings of all blobs back to all paths.

Scanning is made of SQL functions: where a rule matches, ``split`` gives the texts between the matches and
``regexp_extract_all`` the matches; a running sum over their lengths gives the places.  Matches of a rule are leftmost
and do not overlap; those that are too short are dropped after they have taken their place.

Defined cases: a null text is the empty blob; null ids are kept; repeated rows each get a result row; places are code
points, ends exclusive; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.storage import stored

BLANK_ID = -(2**63)


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern`` whose group ``group`` has at least ``least`` code points; ``version`` names the rule's text."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# Kinds and patterns; the first three are the base kinds.
BASE_RULES = (
    SecretRule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    SecretRule("access", "AKIA[A-Z0-9]+", 0, 16),
    SecretRule("hex", "[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    SecretRule("private_key", "-----BEGIN ([A-Z]+ ){0,3}PRIVATE KEY-----"),
    SecretRule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    SecretRule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    SecretRule("stripe", "sk_live_[A-Za-z0-9]+", 0, 24),
    SecretRule("google", "AIza[A-Za-z0-9_-]+", 0, 39),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


def blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def unseen(paths: DataFrame, rules: Sequence[SecretRule], ledger: DataFrame | None) -> DataFrame:
    """(blob, first, asked): blobs with rule versions to scan, ``first`` the smallest id of the rows that hold it."""
    blobs = paths.groupBy("blob").agg(F.min("id").alias("first"))
    named = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    if ledger is None:
        return blobs.withColumn("asked", F.transform(named, lambda r: r["kind"]))
    pairs = blobs.withColumn("r", F.explode(named)).select("blob", "first", "r.kind", "r.version")
    left = pairs.join(ledger.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
    return left.groupBy("blob").agg(F.min("first").alias("first"), F.collect_list("kind").alias("asked"))


def scan(texts: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """(blob, kind, start, end) of the matches in ``texts`` (blob, text, asked)."""

    def matches(rule: SecretRule) -> Column:
        pattern, text = F.lit(rule.pattern), F.col("text")
        gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
        lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
        judged = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
        found = F.array_contains("asked", rule.kind) & F.regexp_like(text, pattern)
        parts = F.arrays_zip(gaps.alias("gap"), lengths.alias("len"), judged.alias("judged"))
        return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"), F.when(found, parts).alias("parts"))

    each = texts.select("blob", F.explode(F.array(*map(matches, rules))).alias("m")).where("m.parts is not null")
    rows = each.select("blob", "m.kind", "m.least", F.posexplode("m.parts").alias("nth", "p"))
    order = W.partitionBy("blob", "kind").orderBy("nth").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("p.gap") + F.coalesce("p.len", F.lit(0))).over(order)
    placed = rows.select("blob", "kind", "least", "p.len", "p.judged", end.alias("end"))
    return placed.where("judged >= least").select("blob", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def update_ledger(docs: DataFrame, rules: Sequence[SecretRule] = RULES, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(ledger rows of this run, paths).

    A ledger row is blob, kind, version and ``spans``, an array of (start, end); pairs without findings have an empty
    one, so that they are not scanned again.  The rows of this run are added to the ledger by its owner.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(BLANK_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = rows.withColumn("blob", blob(F.col("text")))
    paths = hashed.select("id", "blob")
    todo = stored(unseen(paths, rules, ledger))
    right = todo.select(F.col("blob").alias("_blob"), F.col("first").alias("_first"), "asked")
    texts = hashed.join(right, (F.col("blob") == F.col("_blob")) & (F.col("id") == F.col("_first"))).select("blob", "text", "asked")
    one = texts.dropDuplicates(["blob"])  # the smallest id may come more than once
    spans = stored(scan(one, rules).groupBy("blob", "kind").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")))
    asked = todo.select("blob", F.explode("asked").alias("kind"))
    versions = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    new = asked.join(spans, ["blob", "kind"], "left").select("blob", "kind", versions[F.col("kind")].alias("version"), F.coalesce("spans", none).alias("spans"))
    return new, paths


def findings(ledger: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """(blob, kinds, spans): per blob with findings its spans of the current rule versions, by start, then kind as listed."""
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    versions = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    current = ledger.where((F.col("version") == versions[F.col("kind")]) & (F.size("spans") > 0))
    one = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[F.col("kind")].alias("nth"), s["end"].alias("end"), F.col("kind").alias("kind")))
    return current.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list(one))).alias("spans"))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[SecretRule] = RULES, base: Sequence[SecretRule] = BASE_RULES) -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, ``base_sha256`` and ``spans``."""
    new, paths = update_ledger(docs, rules, ledger)
    whole = new if ledger is None else ledger.unionByName(new)
    found = stored(findings(whole, rules))  # a join of two plain shuffles can be split at a blob of many paths
    joined = paths.join(found, "blob", "left")
    spans = F.coalesce("spans", F.array().cast(dict(found.dtypes)["spans"]))
    kinds = [r.kind for r in base]
    based = F.filter(spans, lambda s: s["kind"].isin(kinds))
    counts = [F.size(F.filter(spans, _of_kind(k))).cast("long").alias(f"n_{k}") for k in kinds]
    doc_id = F.when(F.col("id") != BLANK_ID, F.col("id")).alias("doc_id")
    return joined.select(doc_id, *counts, F.sha2(_joined(based).cast("binary"), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def oracle() -> str:
    """DuckDB text of the same report; letters of either case are written out."""

    def either_case(pattern: str) -> str:
        head = pattern.partition(")")[0] + ")"
        if not pattern.startswith("(?i:"):
            return pattern
        spelled = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in head[4:])
        return spelled + pattern[len(head) + 1 :]

    def one(k: int, rule: SecretRule) -> str:
        pattern = either_case(rule.pattern).replace("'", "''")
        return f"""
        select doc_id, '{rule.kind}' as kind, {k} as nth, gap_and_all - len as b, gap_and_all as e from (
            select doc_id, g.len, g.judged, sum(g.gap + g.len) over (partition by doc_id order by g.i) as gap_and_all from (
                select doc_id, unnest(list_transform(range(len(m)), lambda i: {{
                    'i': i, 'gap': length(gaps[i + 1]), 'len': length(m[i + 1]), 'judged': length(j[i + 1])}})) as g
                from (select doc_id, string_split_regex(text, '{pattern}') as gaps,
                    regexp_extract_all(text, '{pattern}') as m, regexp_extract_all(text, '{pattern}', {rule.group}) as j
                    from documents where regexp_matches(text, '{pattern}')))) where judged >= {rule.least}"""

    listed = " union all ".join(one(k, r) for k, r in enumerate(RULES))
    kinds = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in BASE_RULES)
    text = "kind || ':' || b::bigint || ':' || e::bigint"
    return f"""
    with span as ({listed})
    select documents.doc_id, {counts},
        sha256(coalesce(string_agg({text}, ',' order by b, nth) filter (kind in ({kinds})), '')) as base_sha256,
        coalesce(string_agg({text}, ',' order by b, nth), '') as spans
    from documents left join span on documents.doc_id = span.doc_id group by documents.doc_id
    """
