"""Incremental loads as streams that stop when the available input is consumed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.events import envelope_rows
from millrace.operators.identity import natural_key


def read_files(spark: SparkSession, path: str, kind: str, schema: T.StructType | str, files_per_batch: int | None = None) -> DataFrame:
    """File stream with a declared schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(kind).load(path)


def append_available(stream: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append the new rows of a stream to a parquet folder and stop.

    The checkpoint plays the part of the high-water mark: every input file is read exactly once."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start()


def merge_available(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every non-empty micro-batch to ``merge(batch, batch_id)``, which publishes a new version, and stop.

    ``batch_id`` lets the merge recognise a batch that is replayed after a failure.  The batch is kept
    while it is merged, so that a stateful stream is evaluated once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                merge(batch, batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_first_copies(stream: DataFrame, target: str, checkpoint: str, key: Sequence[str] | Column, order: str) -> StreamingQuery:
    """Append the rows of a stream whose natural key the target does not hold, and stop.

    Of equal keys in one micro-batch the row with the smallest ``order`` stays.  The target itself is the memory, so
    a copy is recognised however late it comes, and no late row is lost.  Every micro-batch writes its own partition
    ``batch``; a replayed one writes it again."""
    hashed = key if isinstance(key, Column) else natural_key(key)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, batch.columns
        first = batch.groupBy(hashed.alias("_key")).agg(F.min(F.struct(F.col(order).alias("_order"), *columns)).alias("_row"))
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            held = spark.read.parquet(target).where(F.col("batch") != batch_id).select(F.col("_key").alias("_held")).distinct()
            first = first.join(held, F.col("_key") == F.col("_held"), "left_anti")
        rows = first.select("_key", *[F.col("_row").getField(c).alias(c) for c in columns])
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/batch={batch_id}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_copies(spark: SparkSession, target: str) -> DataFrame:
    """The rows that :func:`append_first_copies` has kept."""
    return spark.read.parquet(target).drop("_key", "batch")


def stream_envelopes(files: DataFrame, arrived: str) -> DataFrame:
    """Exploded envelopes of a file stream; ``append_first_copies`` by ENVELOPE_KEY drops repeated messages.

    ``files``: file_name, json_text, is_parsed and the arrival timestamp."""
    return envelope_rows(files, keep=[arrived])


ENVELOPE_KEY = ("file_name", "hash")


def stream_above_mark(stream: DataFrame, key: str, mark, where: Column | None = None) -> DataFrame:
    """Rows above a fixed start mark (the target's largest key when the stream is set up)."""
    rows = stream if mark is None else stream.where(F.col(key) > F.lit(mark))
    return rows if where is None else rows.where(where)
