"""Publishing: write a new version of a table, then switch to it.

Parquet cannot be overwritten while a query reads it, so a full rewrite goes to a folder of its own and a small
pointer file, created only once per version, names it.  A write that dies leaves a folder that nothing points to and
does not hinder the next one; of two writers of the same version the second one fails.  Partitioned tables may replace
single partition values.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.anomaly import accepted

POINTER = "_current"


def _pointers(spark: SparkSession, path: str):
    """File system, and the pointer files by version."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(folder) if fs.exists(folder) else []
    return fs, {int(s.getPath().getName()[1:]): s.getPath() for s in found if s.getPath().getName()[1:].isdigit()}


def _pointed(fs, pointer) -> list[str]:
    """Folder and batch that a pointer file names; none if its writer died between creating and filling it."""
    stream = fs.open(pointer)
    try:
        line = stream.readLine()
    finally:
        stream.close()
    return line.split("\t") if line else []


def _published(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Newest version with a folder, and what its pointer says."""
    fs, pointers = _pointers(spark, path)
    for version in sorted(pointers, reverse=True):
        if named := _pointed(fs, pointers[version]):
            return version, named
    return 0, []


def current_version(spark: SparkSession, path: str) -> int:
    """Number of the published version, 0 when there is none."""
    return _published(spark, path)[0]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The published version of a table."""
    version, named = _published(spark, path)
    if not version:
        raise FileNotFoundError(f"no published version under {path}")
    return spark.read.parquet(f"{path}/{named[0]}")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), file_rows: int | None = None, batch: int | None = None) -> str:
    """Write ``df`` as the next version and switch to it; earlier versions stay readable.

    With ``batch`` (the number of a micro-batch) a batch that has been published is not published again."""
    spark = df.sparkSession
    version, named = _published(spark, path)
    if batch is not None and len(named) > 1 and int(named[1]) >= batch:
        return f"{path}/{named[0]}"
    fs, pointers = _pointers(spark, path)
    following = max(pointers, default=0) + 1
    folder = f"v{following}-{uuid.uuid4().hex[:12]}"
    writer = (balanced(df, partition_by) if partition_by else df).write.option("compression", "zstd")
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("errorifexists").parquet(f"{path}/{folder}")
    pointer = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}/v{following}")
    stream = fs.create(pointer, False)  # fails if another writer has published this version
    try:
        stream.writeBytes(folder if batch is None else f"{folder}\t{batch}")
    finally:
        stream.close()
    return f"{path}/{folder}"


def publish_if_accepted(df: DataFrame, verdicts: DataFrame, path: str, **options) -> str | None:
    """Publish unless a rollback-configured anomaly test failed; None when the load is rejected."""
    return publish(df, path, **options) if accepted(verdicts) else None


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a plain parquet folder."""
    writer = df.write.mode("append").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partition values that ``df`` holds."""
    (
        balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Cluster rows by partition value before a write; adaptive execution splits a value that holds a
    large share of the rows and merges small ones, so files come out even."""
    return df.hint("rebalance", *partition_by)
