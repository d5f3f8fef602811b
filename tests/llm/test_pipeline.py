"""The five stages: what each does to its own input, and the whole against plain versions of all but the mix."""

import corpus_pipeline
from millrace.llm import line_dedup, packing, quality_rules, simhash
from millrace.llm.textstats import TextView
from tests.llm.helpers import documents, prose, with_clashes
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_simhash import plain_components, plain_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, sf_dir))
        out = after.collect()
        if name != "best_fit_packing":
            assert after.columns == COLUMNS
        if name == "quality_rules":
            good = {i for i, t in rows.items() if quality_rules.verdict(TextView(t), quality_rules.BASE + quality_rules.METHOD) is None}
            assert {r["doc_id"] for r in out} == good and len(good) < len(rows)
        if name == "line_dedup":
            assert {r["doc_id"] for r in out} == set(rows)
            want = {r[0]: r for r in plain_lines(list(rows.items()))}
            assert all(line_dedup.hashlib.sha256(r["text"].encode()).hexdigest() == want[r["doc_id"]][3] for r in out)
            assert all(r["n_chars"] == len(r["text"]) for r in out)
        if name == "simhash_near_dedup":
            ids = sorted(rows)
            least = plain_components(ids, [plain_fingerprint(rows[i]) for i in ids])
            assert sorted(r["doc_id"] for r in out) == sorted(set(least)) and len(out) < len(rows)
        if name == "source_mixing":
            assert {r["doc_id"]: r["text"] for r in out}.items() <= rows.items()
            assert len(out) > len({r["doc_id"] for r in out})
        if name == "best_fit_packing":
            copies = {}
            for r in docs.collect():
                copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
            firsts = [r["doc_id"] for r in out if r["piece"] == 0]
            assert {i: firsts.count(i) for i in copies} == copies
            used, bound = packing.certificate(after)
            assert used <= bound + 1
        rows = {r["doc_id"]: r["text"] for r in out} if name != "best_fit_packing" else rows
        docs = after


def test_run_agrees_with_itself(spark, sf_dir):
    one, other = (sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, sf_dir).collect()) for _ in range(2))
    assert one == other


def test_odd_rows_go_through(spark, tmp_path):
    texts = [None, "", "short", *prose(40, 3, words=80), "a long text of many words that repeats itself " * 3000]
    docs = with_clashes(documents(spark, texts + texts[5:9], [None, None, 1, *range(2, len(texts) - 1), 5, 5, 6, 7], [None] * 4 + ["s"] * (len(texts))))
    table = docs
    for _, stage in corpus_pipeline.STAGES:
        assert corpus_pipeline.stored(stage(spark, docs.limit(0), "")).collect() == []
        table = corpus_pipeline.stored(stage(spark, table, ""))
    assert table.count() > 0
    assert simhash.keep_one(docs).columns == docs.columns
