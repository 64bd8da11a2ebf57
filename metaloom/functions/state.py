"""Cutting plans and keeping tables between steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, which ``spark.checkpoint.dir`` names."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read back from a table in the checkpoint folder.

    The plan starts anew there, the table survives the loss of executors, and later steps read only the
    columns that they need, with known sizes. The folder's owner clears it between runs.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
