"""Reading change notifications, as a stream or as a bounded table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_change_log(spark: SparkSession, options: dict, streaming: bool = True) -> DataFrame:
    """UTF-8 notifications in ``value``, and the place of each in the log in ``position``.

    A position is text that sorts like the log: topic, partition and offset, or time of writing, file and row for parquet files.
    Text files have none (null); their messages are told apart by what they say.

    ``options`` has ``topic`` and Kafka options (``kafka.bootstrap.servers``, ...), or ``path`` for a folder
    of parquet or text files (``format``), where ``column`` names the text column. A stream from Kafka starts at the latest offsets unless
    told otherwise; its position is kept in the checkpoint of the query that reads it.
    """
    options = dict(options)
    reader = spark.readStream if streaming else spark.read
    if "topic" in options:
        options["subscribe"] = options.pop("topic")
        options.setdefault("startingOffsets", "latest" if streaming else "earliest")
        raw = reader.format("kafka").options(**options).load()
        place = F.format_string("%s:%010d:%020d", "topic", "partition", "offset")
        return raw.select(F.col("value").cast("string").alias("value"), place.alias("position"))
    path, fmt, column = options.pop("path"), options.pop("format", "parquet"), options.pop("column", "value")
    raw = reader.schema(f"`{column}` string").format(fmt).options(**options).load(path)
    place = F.lit(None).cast("string")
    if fmt == "parquet":
        written = F.unix_micros("_metadata.file_modification_time")
        place = F.format_string("%020d:%s:%020d", written, "_metadata.file_path", "_metadata.row_index")
    return raw.select(F.col(column).alias("value"), place.alias("position"))


def source_collection(spark: SparkSession, path_or_rows, schema: str) -> DataFrame:
    """Bounded source with an explicit schema: a parquet path, or rows given in a test."""
    if isinstance(path_or_rows, str):
        return spark.read.schema(schema).parquet(path_or_rows)
    return spark.createDataFrame(path_or_rows, schema)
