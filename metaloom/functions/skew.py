"""Settings that every job should run with; all can be set at run time.

Aggregates combine on the map side and adaptive execution splits an oversized join partition, so hot keys need
nothing more there. The one place where all rows of a key had to meet, the as-of lookup, deals them out by range.

Lists are put together from sorted rows: the hash aggregate gives up after 128 keys and then sorts serialized lists. Shuffles
begin with many pieces, which adaptive execution joins as far as they are small, so that a piece fits in a task's memory
at any size. Tables between steps are compressed with Zstandard. They are read in small pieces, too: a message or a document
takes some sixty times its compressed size in memory, and sorts and shuffles of what one task reads must not spill.
"""

from __future__ import annotations

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark) -> None:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
