"""Helpers of the operators: choosing columns, reading Arrow batches, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.functions.state import checkpoint_dir, cut

__all__ = ["blanks_out", "checkpoint_dir", "count_words", "cut", "drop", "joined_by_row", "kept_by", "pick", "table", "utf8", "word_array"]

#: The white space that parts words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"


def drop(*tables: DataFrame) -> None:
    """Remove tables that ``cut`` wrote, and the shuffle files of plans that nothing refers to any more.

    Only for tables whose every use has been written itself: what is left must not need them, also when executors are lost.
    """
    for df in tables:
        jvm, files = df.sparkSession._jvm, df.inputFiles()
        if files:
            folder = jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
        jvm.System.gc()  # Spark removes shuffle files when their plans are collected


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names.

    Columns are found by exact spelling and position, so others may clash with them in any way,
    even by having the same name but for case.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{names.index(source)}").alias(name) for name, source in columns.items()])


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def blanks_out(text: Column) -> Column:
    """The text without white space."""
    return F.translate(text, WHITE, "")


def word_array(text: Column) -> Column:
    """The words of a text, in order: runs of anything but white space. Null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.array_remove(F.split(spaced, " "), "")


def count_words(text: Column) -> Column:
    return F.size(word_array(text)).cast("bigint")


def kept_by(df: DataFrame, column: str, prepare: Callable[[], Callable[[list[bytes | None]], list[bool]]]) -> DataFrame:
    """The rows that a function of one text column keeps, with all columns as they were, whatever their names.

    ``prepare`` is called once a task and gives the function, which answers for a batch of texts.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    source = f"c{names.index(column)}"
    schema = T.StructType([*plain.schema.fields, T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = None
        for batch in batches:
            decide = decide or prepare()
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decide(utf8(part, source)), pa.bool_())], names=schema.names)

    return plain.mapInArrow(run, schema).where("kept").drop("kept").toDF(*names)


def joined_by_row(df: DataFrame, id_col: str, text_col: str, chosen: DataFrame) -> tuple[DataFrame, list[str]]:
    """One row of each (id, hash of id and text) that ``chosen`` (doc_id, spot, ...) lists, with the rest of its columns.

    Returns columns c0, c1, ... for those of ``df``, then those of ``chosen``, and the names of ``df``. Rows equal in id and
    text count as one.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    own_id, own_text = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text_col)}")
    plain = plain.withColumn("at", F.xxhash64(own_id, own_text))
    chosen = chosen.withColumnRenamed("doc_id", "of")
    joined = plain.join(chosen, (F.col("at") == F.col("spot")) & own_id.eqNullSafe(F.col("of")))
    return joined.dropDuplicates(["at", f"c{names.index(id_col)}"]), names
