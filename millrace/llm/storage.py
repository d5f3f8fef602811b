"""Intermediate tables in the shared folder of the session, and row keys that survive null and repeated ids."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.lineage import ensure_checkpoint_dir


def stored(df: DataFrame, rows_per_file: int = 0, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back: computed once, safe from lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path, partitionBy=list(partition_by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored`, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if "/table-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Ask the driver to collect its garbage, so that shuffle files that nothing refers to any more leave the executors' disks
    now and not at the next collection; for the end of a step that has moved much data.

    What the first round unlinks, the second one finds; the cleaner works beside them."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def release(spark: SparkSession) -> None:
    """Delete all tables that :func:`stored` has left in the shared folder; for the end of a job, when its results are written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        if status.getPath().getName().startswith("table-"):
            fs.delete(status.getPath(), True)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two key columns ``_id`` and ``_th``: the id (null as -1) and a hash of the text.

    Rows that share both hold the same text, so whatever is derived from the text alone or from its
    occurrences holds for each of them.
    """
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"),
    ]


def block_count(docs: DataFrame, text_col: str = "text", chars_per_block: int = 24_000_000) -> int:
    """Number of blocks so that one holds about ``chars_per_block`` characters (one pass over the lengths)."""
    total = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    return max(1, -(-int(total) // chars_per_block))
