"""Cutting long lineages on storage that survives the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local master,
    where driver and tasks share one disk, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint of ``df``: computed once now, read from shared storage by every later use."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def new_folder(spark: SparkSession) -> str:
    """Path of a folder for stored steps; it lies in the session's checkpoint folder and goes with it."""
    return f"{ensure_checkpoint_dir(spark)}/steps-{uuid.uuid4().hex}"


def store_rows(df: DataFrame, folder: str) -> DataFrame:
    """Add the rows of ``df`` to the Parquet files of ``folder``; returns all its rows.

    Unlike a checkpoint it is computed once, has a known size, and steps added one by one remain a single scan.
    """
    df.write.mode("append").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
