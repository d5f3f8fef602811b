"""The named queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from millrace.llm import conversations, importance, line_dedup, minhash, mixing, packing, quality_rules, secret_scan, simhash, suffix_dedup, topk, url_filter, word_contexts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def file_it(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return file_it


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_quality_rules", quality_rules.oracle())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op7_source_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


@query(
    "op3_line_dedup",
    r"""
    with line as (
        select doc_id, coalesce(doc_id, 9223372036854775807) as owner_id, line.i as i, line.x as x
        from (select doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: {'i': i, 'x': x})) as line from documents)
    ), keyed as (
        select *, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from line
    ), shared as (
        select k, min(owner_id) as keeper from keyed where length(k) >= 10 group by k having count(distinct owner_id) > 1
    ), judged as (
        select keyed.*, shared.keeper is not null and shared.keeper <> owner_id as gone from keyed left join shared using (k)
    )
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
        sha256(coalesce(string_agg(x, chr(10) order by i) filter (not gone), '')) as kept_sha256
    from judged group by doc_id
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query("op5_url_filters", url_filter.oracle())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query("op9_secret_scans", secret_scan.oracle())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query(
    "op1_topk_search",
    """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), pair as (
        select a.vec_id as query_id, b.vec_id as vec_id,
            list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::bigint as score
        from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
    )
    select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
    from pair qualify rank <= 5
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


@query("op6_suffix_array_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


@query("op10_lm_scoring")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_contexts.score_documents(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair", conversations.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(table(spark, sf_dir, "conversations"))


@query("op12_target_resampling", importance.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_minhash_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
