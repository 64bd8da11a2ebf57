"""Versions by event day, with retention that drops whole days.

root/data/day=YYYY-MM-DD/     versions of a day
root/carried/upto=YYYY-MM-DD/ the last version of each guid before a day, from the days that were dropped

A strict as-of lookup at any time that is still kept needs, besides the days kept, the last version of each guid before them.
Retention reads the days that go, and what was carried before, to find these; it reads no row of a day that stays, and only
the list of days decides what stays. The table after retention is the carried versions and the days from the cut on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class DayStore:
    """Rows with a ``guid`` and a time in ms, by day."""

    root: str
    schema: T.StructType
    time_col: str = "msg_creation_time"

    def append(self, rows: DataFrame) -> None:
        day = F.date_format(F.timestamp_millis(self.time_col), "yyyy-MM-dd")
        dealt = rows.select(*self.schema.fieldNames()).withColumn("day", day)
        dealt.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(f"{self.root}/data")

    def days(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType([*self.schema.fields, T.StructField("day", T.StringType())])).parquet(f"{self.root}/data")

    def carried(self, spark: SparkSession, upto: str | None) -> DataFrame:
        if upto is None:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.root}/carried/upto={upto}")

    def cut_day(self, spark: SparkSession) -> str | None:
        """The first day kept; null before any retention."""
        try:
            known = spark.read.schema(T.StructType([*self.schema.fields, T.StructField("upto", T.StringType())])).parquet(f"{self.root}/carried")
        except AnalysisException:  # nothing was dropped yet
            return None
        return known.agg(F.max("upto")).first()[0]

    def drop_before(self, spark: SparkSession, day: str) -> list[str]:
        """Drop the days before one; returns them. Their files are no longer part of the table and may be removed."""
        last = self.cut_day(spark)
        if last is not None and last >= day:
            return []
        rows = self.days(spark).filter((F.col("day") < day) & (F.col("day") >= (last or "")))  # whole partitions
        gone = sorted(r[0] for r in rows.select("day").distinct().collect())
        old = rows.select(*self.schema.fieldNames()).unionByName(self.carried(spark, last))
        rest = [c for c in self.schema.fieldNames() if c != "guid"]
        newest = old.groupBy("guid").agg(F.max_by(F.struct(*rest), self.time_col).alias("_last"))
        kept = newest.select(*[F.col("guid") if c == "guid" else F.col(f"_last.{c}").alias(c) for c in self.schema.fieldNames()])
        kept.write.mode("overwrite").parquet(f"{self.root}/carried/upto={day}")
        return gone

    def read(self, spark: SparkSession) -> DataFrame:
        """The table: the days kept and what is carried."""
        last = self.cut_day(spark)
        rows = self.days(spark)
        if last is not None:
            rows = rows.filter(F.col("day") >= last)
        return rows.select(*self.schema.fieldNames()).unionByName(self.carried(spark, last))
