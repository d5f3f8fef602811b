"""Safe casts, JSON and text helpers; NULL on failure, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID_PATTERN = "^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"
SCALAR_JSON = r"^\s*(\".*\"|-?[0-9][-+.0-9eE]*|true|false|null)\s*$"
TRUE_WORDS = ("t", "true", "y", "yes", "on", "1")  # fixed values
FALSE_WORDS = ("f", "false", "n", "no", "off", "0")  # fixed values


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(c: Column | str, name: str) -> Column:
    """Top-level field of a JSON text as text; NULL if the text is no JSON object."""
    return F.get_json_object(_col(c), f"$.{name}")


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``, NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def is_json(c: Column | str) -> Column:
    """True for a valid JSON text (object, array or scalar), false otherwise, NULL for NULL.

    Reading the outer keys (or counting the elements) rejects most broken texts cheaply; only what
    passes is parsed in full, because a failing full parse costs an exception per row."""
    c = _col(c)
    start = F.substring(F.ltrim(c), 1, 1)
    plausible = (
        F.when(start == "{", F.json_object_keys(c).isNotNull())
        .when(start == "[", F.json_array_length(c).isNotNull())
        .otherwise(c.rlike(SCALAR_JSON))
    )
    return F.when(c.isNotNull(), F.when(plausible, F.try_parse_json(c).isNotNull()).otherwise(F.lit(False)))


def safe_cast(c: Column | str, kind: str) -> Column:
    """Cast of a text; empty text and unparsable text give NULL."""
    value = F.nullif(_col(c).cast("string"), F.lit(""))
    match kind:
        case "uuid":
            return F.when(F.trim(value).rlike(UUID_PATTERN), F.lower(F.trim(value)))
        case "boolean":
            word = F.lower(F.trim(value))
            return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))
        case "text" | "string":
            return value
        case "json":
            return F.when(is_json(value), value)
    return F.trim(value).try_cast(kind)
