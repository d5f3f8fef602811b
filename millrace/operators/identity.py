"""Identity resolution in stages, duplicate detection and cascading removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.lineage import cut_lineage
from millrace.functions.parsing import extract, safe_cast

LOWEST, TOO_HIGH = 1000, 10**7  # fixed values: ids are in [1000, 10^7)
SEARCH_USER = "^search_[0-9]{4,7}$"  # fixed pattern
SUFFIXED_USER = "^[a-z_A-Z]*[0-9]{4,7}$"  # fixed pattern
UUID_USER = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"  # fixed pattern
PAYLOAD_KEY = "employeeId"  # fixed value
MIN_SESSIONS = 3  # fixed value

RESOLVED = ("ai_id", "i_pernr", "kind")


def in_range(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return (c >= LOWEST) & (c < TOO_HIGH)


def drop_out_of_range(resolved: DataFrame) -> DataFrame:
    """Remove ids outside [1000, 10^7)."""
    return resolved.where(in_range("i_pernr"))


def _not_in(rows: DataFrame, resolved: DataFrame, kind: str | None = None) -> DataFrame:
    done = resolved if kind is None else resolved.where(F.col("kind") == kind)
    done = done.select(F.col("ai_id").alias("_done")).distinct()
    return rows.join(done, F.col("ai_id") == F.col("_done"), "left_anti")


def from_search_user(log: DataFrame, resolved: DataFrame) -> DataFrame:
    """Id embedded in a user text ``search_<4-7 digits>``, not resolved by this stage before."""
    rows = log.where(F.col("user_text").rlike(SEARCH_USER)).select(
        F.col("id").alias("ai_id"), extract("user_text", r"search_(\d+)").cast("int").alias("i_pernr"), F.lit("search").alias("kind")
    )
    return _not_in(rows, resolved, "search")


def from_payload(payload: DataFrame, resolved: DataFrame, key: str = PAYLOAD_KEY) -> DataFrame:
    """Id from a key-value payload, safely cast and in range."""
    rows = payload.where(F.col("payload_key") == key).select(
        "ai_id", safe_cast("payload_value", "int").alias("i_pernr"), F.lit("employeeid").alias("kind")
    )
    return _not_in(rows.where(in_range("i_pernr")), resolved, "employeeid")


def _one_id_per(pairs: DataFrame, group: str, *more: Column) -> DataFrame:
    """(group, id) of the groups with exactly one distinct id; a partial aggregate, so a hot
    session or user costs one row per map task."""
    stats = pairs.groupBy(group).agg(
        F.min("i_pernr").alias("_lo"), F.max("i_pernr").alias("i_pernr"), *more
    )
    return stats.where(F.col("_lo") == F.col("i_pernr")).drop("_lo")


def _known(log: DataFrame, resolved: DataFrame) -> DataFrame:
    return log.join(resolved.select(F.col("ai_id").alias("_ai"), "i_pernr", "kind"), F.col("id") == F.col("_ai")).drop("_ai")


def _spread(log: DataFrame, found: DataFrame, group: str, resolved: DataFrame, kind: str) -> DataFrame:
    key = found.select(F.col(group).alias("_g"), "i_pernr")
    rows = log.select(F.col("id").alias("ai_id"), group).join(key, F.col(group) == F.col("_g"))
    return _not_in(rows.select("ai_id", "i_pernr", F.lit(kind).alias("kind")), resolved)


def by_session(log: DataFrame, resolved: DataFrame) -> DataFrame:
    """Propagate within a session whose uuid users have exactly one id."""
    pairs = _known(log, resolved).where(F.col("user_text").rlike(UUID_USER))
    return _spread(log, _one_id_per(pairs, "sessionid"), "sessionid", resolved, "sessionid")


def by_uuid_user(log: DataFrame, resolved: DataFrame) -> DataFrame:
    """Propagate within a uuid user that has exactly one id."""
    pairs = _known(log, resolved).where(F.col("user_text").rlike(UUID_USER))
    return _spread(log, _one_id_per(pairs, "user_text"), "user_text", resolved, "uuid_userid")


def by_suffix(log: DataFrame, resolved: DataFrame) -> DataFrame:
    """Propagate where the numeric suffix of the user text equals an id already seen for that user."""
    pairs = _known(log, resolved).where(F.col("user_text").rlike(SUFFIXED_USER))
    hit = pairs.where(extract("user_text", "^[a-z_A-Z]*([0-9]{4,7})$").cast("int") == F.col("i_pernr"))
    return _spread(log, hit.select("user_text", "i_pernr").distinct(), "user_text", resolved, "i_pernr")


def by_plain_user(log: DataFrame, resolved: DataFrame, min_sessions: int = MIN_SESSIONS) -> DataFrame:
    """Propagate within a non-uuid user with one id over at least ``min_sessions`` sessions."""
    pairs = _known(log, resolved.where("kind <> 'true'")).where(~F.col("user_text").rlike(UUID_USER))
    found = _one_id_per(pairs, "user_text", F.countDistinct("sessionid").alias("_sessions"))
    return _spread(log, found.where(F.col("_sessions") >= min_sessions), "user_text", resolved, "userid")


def consensus(resolved: DataFrame) -> DataFrame:
    """Per message: kind 'true' with one distinct id, 'false' with several; the largest id is kept."""
    stats = resolved.where("kind not in ('true', 'false')").groupBy("ai_id").agg(
        F.min("i_pernr").alias("_lo"), F.max("i_pernr").alias("i_pernr")
    )
    return stats.select("ai_id", "i_pernr", F.when(F.col("_lo") == F.col("i_pernr"), "true").otherwise("false").alias("kind"))


def resolved_until(log: DataFrame, payload: DataFrame, resolved: DataFrame, stages: int = 6) -> DataFrame:
    """Ids known after the first ``stages`` stages; each skips the messages resolved by the earlier ones.

    Every stage is written to a reliable checkpoint, because all later stages read it."""
    known = drop_out_of_range(resolved.where("kind not in ('true', 'false')")).select(*RESOLVED)
    steps = [
        lambda k: from_search_user(log, k),
        lambda k: from_payload(payload, k),
        lambda k: by_session(log, k),
        lambda k: by_uuid_user(log, k),
        lambda k: by_suffix(log, k),
        lambda k: by_plain_user(log, k),
    ]
    for step in steps[:stages]:
        known = known.unionByName(cut_lineage(step(known).select(*RESOLVED)))
    return known


def resolve(log: DataFrame, payload: DataFrame, resolved: DataFrame) -> DataFrame:
    """All stages in order and the consensus of each message."""
    known = resolved_until(log, payload, resolved)
    return known.unionByName(consensus(known))


# --- duplicates ----------------------------------------------------------------------------


def natural_key(columns: Sequence[str]) -> Column:
    """md5 of the concatenated key texts, NULL as empty."""
    return F.md5(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def sliding_duplicates(
    log: DataFrame, key: Column, day: str, ident: str, first=None, last=None, keep: str = "all_but_max"
) -> DataFrame:
    """Ids of duplicates within a day and the day before.

    Each row belongs to two windows (its day and the next).  Per window and key with more than one row
    the largest id is a duplicate; with ``keep='first'`` every id but the smallest is.  The rows are
    exploded to their two windows and aggregated, so there is no loop over days.
    """
    windows = log.select(
        F.col(ident).alias("_id"), key.alias("_key"), F.explode(F.array(F.col(day), F.date_add(day, 1))).alias("_w")
    )
    if first is not None:
        windows = windows.where(F.col("_w") >= F.lit(first))
    if last is not None:
        windows = windows.where(F.col("_w") <= F.lit(last))
    groups = windows.groupBy("_w", "_key").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_max"), F.min("_id").alias("_min"))
    repeated = groups.where("_n > 1")
    if keep == "first":
        hit = windows.join(
            repeated.select(F.col("_w").alias("_rw"), F.col("_key").alias("_rk"), "_min"),
            (F.col("_w") == F.col("_rw")) & (F.col("_key") == F.col("_rk")) & (F.col("_id") > F.col("_min")),
        )
        return hit.select(F.col("_id").alias(ident)).distinct()
    return repeated.select(F.col("_max").alias(ident)).distinct()


def cascade_delete(
    duplicates: DataFrame, ident: str, tables: dict[str, tuple[DataFrame, Sequence[str]]]
) -> dict[str, DataFrame]:
    """Each table without the rows that reference a duplicate in any of its key columns.

    The ids are written once; every anti join reads them."""
    gone = cut_lineage(duplicates.select(F.col(ident).alias("_gone")).distinct())
    out = {}
    for name, (df, columns) in tables.items():
        for c in columns:
            df = df.join(gone, F.col(c) == F.col("_gone"), "left_anti")
        out[name] = df
    return out
