"""Quality rules as a short-circuit cascade.

Each rule rejects a text or lets it pass.  On a bounded sample every rule is run on every text, which gives its
rejection rate and its cost in seconds.  Over all texts the rules then run in the order of rejections per second, and
the first rejection ends the work on a text: counts that only later rules need are never computed.

A text is kept if no rule rejects it, so the order changes the cost and never the verdict.

Defined cases: a null text counts as empty; repeated rows are judged one by one; columns beside the text are passed
through untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textstats import TextView

SAMPLE_ROWS = 256
SAMPLE_CHARS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a :class:`TextView` and is true for a text that has to go."""

    name: str
    rejects: Callable[[TextView], bool]


def too_few_words(t: TextView) -> bool:
    return t.n_words < 20


def too_many_repeats(t: TextView) -> bool:
    return 100 * t.n_repeat_words > 30 * t.n_words


def too_many_symbols(t: TextView) -> bool:
    return 10 * t.n_symbols > t.n_words


def odd_word_length(t: TextView) -> bool:
    return not 2 * t.n_words <= t.word_chars <= 15 * t.n_words


def too_few_letters(t: TextView) -> bool:
    return 10 * t.n_alpha_words < 7 * t.n_words


def too_many_duplicate_lines(t: TextView) -> bool:
    return 2 * t.n_dup_lines > len(t.lines)


BASE = (Rule("words", too_few_words), Rule("repeats", too_many_repeats))
METHOD = (
    Rule("symbols", too_many_symbols),
    Rule("word_length", odd_word_length),
    Rule("letters", too_few_letters),
    Rule("duplicate_lines", too_many_duplicate_lines),
)


def measure(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """(rejection rate, seconds per text) of each rule on ``sample_rows`` texts of at most ``SAMPLE_CHARS`` characters.

    Only as many partitions are read as it takes to find them; they decide the order of the rules and nothing else."""
    sample = docs.select(F.col(text_col).alias("t")).where(F.coalesce(F.length("t"), F.lit(0)) <= SAMPLE_CHARS).limit(sample_rows).collect()
    hits, spent = dict.fromkeys((r.name for r in rules), 0), dict.fromkeys((r.name for r in rules), 0.0)
    for row in sample:
        for rule in rules:
            view = TextView(row["t"])  # a fresh view: no rule gains from another one's counts
            began = time.perf_counter()
            hits[rule.name] += rule.rejects(view)
            spent[rule.name] += time.perf_counter() - began
    n = max(1, len(sample))
    return {rule.name: (hits[rule.name] / n, spent[rule.name] / n) for rule in rules}


def cascade_order(rules: Sequence[Rule], measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per second first; ties keep the given order."""
    return sorted(rules, key=lambda r: -measured[r.name][0] / max(measured[r.name][1], 1e-9))


def verdict(view: TextView, ordered: Sequence[Rule]) -> str | None:
    """Name of the first rule that rejects the text, else None."""
    return next((rule.name for rule in ordered if rule.rejects(view)), None)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = BASE + METHOD, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with all their columns."""
    ordered = cascade_order(rules, measure(docs, rules, text_col, sample_rows))
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([verdict(TextView(t), ordered) is None for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: the counts, ``base_failed`` and ``kept``.

    The counts are asked for whatever the verdict, so the base rules cost nothing more; the cascade over the other
    rules runs for documents that pass them.
    """
    ordered = cascade_order(METHOD, measure(docs, METHOD, text_col, sample_rows))

    def run(batches):
        for batch in batches:
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            out: dict[str, list] = {n: [] for n in (*names, "base_failed", "kept")}
            for text in batch.column(1).to_pylist():
                view = TextView(text)
                for n in names:
                    out[n].append(getattr(view, n))
                failed = any(rule.rejects(view) for rule in BASE)
                out["base_failed"].append(failed)
                out["kept"].append(not failed and verdict(view, ordered) is None)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out.values())], names=[batch.schema.names[0], *out])

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    )


def oracle() -> str:
    """DuckDB text of :func:`judge` with all rules tried on every text."""
    word, blank = "[^\\x20\\x09-\\x0D]+", "[\\x20\\x09-\\x0D]"
    return f"""
    with t as (
        select row_number() over () as r, doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{word}') as w,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '{blank}', '', 'g') <> '') as lines from documents
    ), win as (
        select r, unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: {{'i': i, 'x': array_to_string(w[i:i + 7], ' ')}})) as s from t where len(w) >= 9
    ), hit as (
        select r, s.i as i from win qualify count(*) over (partition by r, s.x) > 1
    ), cover as (
        select r, count(distinct k) as n from (select r, unnest(range(i, i + 8)) as k from hit) group by r
    ), counted as (
        select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
            len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(cover.n, 0) as n_repeat_words, len(lines) as n_lines,
            len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) as n_alpha
        from t left join cover using (r)
    ), judged as (
        select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and 10 * n_symbols <= n_words and word_chars between 2 * n_words and 15 * n_words
            and 10 * n_alpha >= 7 * n_words and 2 * n_dup_lines <= n_lines as kept
    from judged
    """
