"""Table-wide cleaning: casts with quarantine, array and JSON repair, text standardisation, hashing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.parsing import is_json, safe_cast

LETTER_OR_DIGIT = "[a-zа-я0-9]"  # fixed pattern, on lower-cased text
FOREIGN_CODE_POINTS = "[\u03e8-\u040f\u0452-\ud6d8]"  # fixed pattern: 1000-1039 and 1106-55000


def cast_with_quarantine(df: DataFrame, casts: Mapping[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, rejects, counts): the frame with cast columns (NULL on failure), the rows with a
    failed value and its column names, and the failures per column."""
    tried = {c: safe_cast(c, kind) for c, kind in casts.items()}
    failed = {c: F.col(c).isNotNull() & (F.col(c).cast("string") != "") & tried[c].isNull() for c in casts}
    clean = df.select(*[tried[c].alias(c) if c in casts else F.col(c) for c in df.columns])
    names = F.filter(F.array(*[F.when(f, F.lit(c)) for c, f in failed.items()]), lambda x: x.isNotNull())
    rejects = df.withColumn("failed_columns", names).where(F.size("failed_columns") > 0)
    wide = df.agg(*[F.count_if(f).alias(c) for c, f in failed.items()])
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in casts]))
    return clean, rejects, wide.select(pairs)


def to_array(c: Column) -> Column:
    """Array of texts from ``{a,b}`` or, with swapped brackets as a second attempt, ``[a,b]``.

    Quoted elements may hold commas; an unquoted NULL is a null element."""
    text = F.trim(c)
    bracketed = text.rlike(r"^\{.*\}$") | text.rlike(r"^\[.*\]$")
    body = F.substring(text, F.lit(2), F.length(text) - 2)
    quoted = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>")
    words = F.transform(F.split(body, ","), lambda x: F.when(F.upper(F.trim(x)) != "NULL", F.trim(x)))
    plain = F.when(F.trim(body) == "", F.array().cast("array<string>")).when(~body.contains('"'), words)
    return F.when(bracketed, F.coalesce(F.when(body.contains('"'), quoted), plain))


def to_json_text(c: Column) -> Column:
    """The text when it is valid JSON, else the text with single quotes turned to double ones when that is."""
    swapped = F.translate(c, "'\"", "\"'")
    return F.when(is_json(c), c).when(is_json(swapped), swapped)


def normalise_columns(df: DataFrame, arrays: Sequence[str] = (), jsons: Sequence[str] = ()) -> DataFrame:
    """Array and JSON text columns parsed, with the bracket or quote swap as a second attempt."""
    new = {c: to_array(F.col(c)) for c in arrays} | {c: to_json_text(F.col(c)) for c in jsons}
    return df.withColumns(new)


def repair_stages(c: Column) -> list[tuple[str, Column]]:
    """Candidate texts of the JSON repair in the order they are tried; each covers the whole text."""
    # The replacement pairs and the patterns.
    escapes = c
    for old, new in (("\\\\", "\\"), ("\\'", ""), ("\\\\о", "\\\\nо"), ("\\\\\\", "\\\\")):
        escapes = F.replace(escapes, F.lit(old), F.lit(new))
    known = F.regexp_replace(c, FOREIGN_CODE_POINTS, "")
    empty = (F.lit('":",'), F.lit('":"",'))
    closed = F.replace(F.regexp_replace(known, r'(:\s*"[^"}]+)(,|\})', r'$1"$2'), *empty)
    filled = F.replace(F.regexp_replace(known, r'(":)\s*([,}])', r'$1""$2'), *empty)
    return [
        ("as is", c),
        ("escapes", escapes),
        ("quote closed", closed),
        ("value inserted", filled),
        ("quote closed, strings joined", F.regexp_replace(closed, r'",\s*(?!")', " ")),
        ("value inserted, strings joined", F.regexp_replace(filled, r'",\s*(?!")', " ")),
    ]


def repair_json(df: DataFrame, column: str) -> DataFrame:
    """Add ``repaired`` and ``stage``: the first stage whose text is valid JSON; NULL when none is.

    A stage is built and parsed only for texts that all stages before it left broken."""
    chosen = F.lit(None).cast("struct<repaired:string,stage:string>")
    for name, text in reversed(repair_stages(F.col(column))):
        chosen = F.when(F.coalesce(is_json(text), F.lit(False)), F.struct(text.alias("repaired"), F.lit(name).alias("stage"))).otherwise(chosen)
    return df.withColumn("_r", chosen).select(*df.columns, F.col("_r.repaired").alias("repaired"), F.col("_r.stage").alias("stage"))


def repair_totals(repaired: DataFrame) -> DataFrame:
    """Rows per repair stage; 'failed' where no stage helped."""
    return repaired.groupBy(F.coalesce("stage", F.lit("failed")).alias("stage")).agg(F.count(F.lit(1)).alias("cnt"))


def standard_text(c: Column, trimmed: bool = True) -> Column:
    """Spaces, then tabs trimmed; NULL when there is no letter (Latin, Cyrillic) or digit."""
    value = F.trim(F.trim(c), F.lit("\t")) if trimmed else c
    return F.when(F.lower(c).rlike(LETTER_OR_DIGIT), value)


def standardise_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``standard_text`` over the given (default: all) text columns."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: standard_text(F.col(c)) for c in columns})


def pseudonymise(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Deterministic ids: md5 of the salted SHA-256 bytes; NULL stays NULL."""
    return df.withColumns(
        {c: F.md5(F.unhex(F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256))) for c in columns}
    )
