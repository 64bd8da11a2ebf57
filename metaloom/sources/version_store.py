"""The version history as sorted runs with filters, merged level by level.

Each batch adds a run: its versions in hash buckets of the guid, sorted by guid in each. Of every file the run keeps the least
and greatest guid and time and a Bloom filter of its guids. A lookup asks these filters first and opens only files that can
hold one of its guids. Once a level has ``fan`` runs they are merged into one of the next level, so the number of runs grows with
the logarithm of the number of batches, and each version is rewritten that often.

root/run-R-<attempt>/data/bucket=B/   body, doc_id, event_time, msg_creation_time, guid, batch
root/run-R-<attempt>/filters/         a row per piece of a bucket's Bloom filter
root/manifest/batch=N/                the runs that make up the history after batch N: (run, level)

A filter has 32768 bits a piece, and as many pieces as give some ten bits a guid; a guid belongs to one piece and sets four
bits in it, which lets some 2% of absent guids pass. A version that came again replaces the one of the batch before.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.functions.state import cut
from metaloom.schemas import ENTITY_VERSION

PIECE_BITS, GUIDS_A_PIECE, PROBES = 32_768, 3_000, 4
_ROW = f"{ENTITY_VERSION}, guid string, batch bigint"
_FILTER = ("run string, bucket int, pieces int, piece int, bits binary, least_guid string, greatest_guid string, "
           "least_time bigint, greatest_time bigint")
COLUMNS = ["body", "doc_id", "event_time", "msg_creation_time"]


def _piece(guid: str, pieces: str):
    return F.expr(f"CAST(pmod(xxhash64({guid}, 1), {pieces}) AS INT)")


def _probe(guid: str, k: int):
    return F.expr(f"pmod(xxhash64({guid}, {k + 2}), {PIECE_BITS}L)")


def _bit_set(bits: str, at: Column) -> Column:
    """Whether a bit of a bitmap, as ``bitmap_construct_agg`` makes it, is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0


@dataclass(frozen=True)
class VersionStore:
    root: str
    buckets: int = 16
    fan: int = 4

    def _bucket(self, guid: str = "guid"):
        return F.pmod(F.xxhash64(guid), F.lit(self.buckets)).cast("int")

    def runs(self, spark: SparkSession, batch: int | None) -> list[tuple[str, int]]:
        """(folder, level) of the runs after a batch, oldest first; none before the first one."""
        if batch is None or batch < 0:
            return []
        rows = spark.read.schema("place int, run string, level int").parquet(f"{self.root}/manifest/batch={batch}").collect()
        return [(r["run"], r["level"]) for r in sorted(rows, key=lambda r: r["place"])]

    def _write_run(self, rows: DataFrame, name: str) -> str:
        """Write rows (with ``guid`` and ``batch``) as a run, with its filters."""
        run = f"{self.root}/run-{name}-{uuid.uuid4()}"
        dealt = rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").sortWithinPartitions("bucket", "guid", "msg_creation_time")
        dealt.write.partitionBy("bucket").parquet(f"{run}/data")
        written = rows.sparkSession.read.schema(f"{_ROW}, bucket int").parquet(f"{run}/data")
        sizes = written.groupBy("bucket").agg(
            F.ceil(F.approx_count_distinct("guid") / GUIDS_A_PIECE).cast("int").alias("pieces"), F.min("guid").alias("least_guid"),
            F.max("guid").alias("greatest_guid"), F.min("msg_creation_time").alias("least_time"),
            F.max("msg_creation_time").alias("greatest_time"))
        placed = written.select("bucket", "guid").distinct().join(sizes, "bucket").withColumn("piece", _piece("guid", "pieces"))
        probes = placed.select("*", F.explode(F.array(*[_probe("guid", k) for k in range(PROBES)])).alias("at"))
        filters = probes.groupBy("bucket", "pieces", "piece", "least_guid", "greatest_guid", "least_time", "greatest_time").agg(
            F.expr("bitmap_construct_agg(at)").alias("bits"))
        fields = [f.split()[0] for f in _FILTER.split(", ")]
        filters.withColumn("run", F.lit(run)).select(*fields).coalesce(1).write.parquet(f"{run}/filters")
        return run

    def _rows(self, spark: SparkSession, runs: list[str]) -> DataFrame:
        if not runs:
            return spark.createDataFrame([], _ROW)
        return spark.read.schema(_ROW).option("recursiveFileLookup", True).parquet(*[f"{r}/data" for r in runs])

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        """One row per doc_id: the one of the latest batch."""
        rest = [c for c in rows.columns if c != "doc_id"]
        last = rows.groupBy("doc_id").agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
        return last.select(*[F.col(c) if c == "doc_id" else F.col(f"_last.{c}").alias(c) for c in rows.columns])

    def append(self, fresh: DataFrame, batch: int) -> list[tuple[str, int]]:
        """The history after a batch that adds versions, one per doc_id; levels that are full are merged."""
        spark = fresh.sparkSession
        runs = self.runs(spark, batch - 1)
        rows = fresh.select(*COLUMNS, F.col("body.guid").alias("guid"), F.lit(batch).cast("bigint").alias("batch"))
        if not rows.isEmpty():
            runs.append((self._write_run(rows, str(batch)), 0))
        level = 0
        while sum(own == level for _, own in runs) >= self.fan:
            full = [run for run, own in runs if own == level]
            merged = self._write_run(self._newest(self._rows(spark, full)), f"{batch}.{level + 1}")
            at = next(k for k, (_, own) in enumerate(runs) if own == level)
            runs = [r for r in runs if r[1] != level]
            runs.insert(at, (merged, level + 1))
            level += 1
        known = spark.createDataFrame([(k, run, own) for k, (run, own) in enumerate(runs)], "place int, run string, level int")
        known.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/batch={batch}")
        return runs

    def read(self, spark: SparkSession, batch: int | None) -> DataFrame:
        """The whole history after a batch."""
        return self._newest(self._rows(spark, [run for run, _ in self.runs(spark, batch)])).select(*COLUMNS)

    def files(self, asked: DataFrame, batch: int | None) -> list[str]:
        """Folders of the buckets that can hold a version, earlier than the latest time asked for, of one of the guids.

        ``asked`` has ``guid`` and ``before`` (ms). There are at most as many as runs times buckets.
        """
        spark = asked.sparkSession
        runs = [run for run, _ in self.runs(spark, batch)]
        if not runs:
            return []
        filters = spark.read.schema(_FILTER).parquet(*[f"{run}/filters" for run in runs])
        wanted = asked.groupBy("guid").agg(F.max("before").alias("before")).withColumn("bucket", self._bucket())
        near = wanted.join(filters, "bucket").filter(
            (F.col("piece") == _piece("guid", "pieces")) & F.col("guid").between(F.col("least_guid"), F.col("greatest_guid"))
            & (F.col("least_time") < F.col("before")))
        for k in range(PROBES):
            near = near.filter(_bit_set("bits", _probe("guid", k)))
        return [f"{r['run']}/data/bucket={r['bucket']}" for r in near.select("run", "bucket").distinct().orderBy("run", "bucket").collect()]

    def lookup(self, asked: DataFrame, batch: int | None) -> DataFrame:
        """The versions of the guids asked for (``guid``, ``before``), from the files that can hold one before that time.

        Enough for a strict as-of lookup: what is left out are versions of other guids, and files that are too late.
        """
        spark, asked = asked.sparkSession, cut(asked.select("guid", "before"))
        paths = self.files(asked, batch)
        if not paths:
            return spark.createDataFrame([], ENTITY_VERSION)
        rows = spark.read.schema(_ROW).parquet(*paths).join(asked.select("guid").distinct(), "guid", "left_semi")
        return self._newest(rows).select(*COLUMNS)
