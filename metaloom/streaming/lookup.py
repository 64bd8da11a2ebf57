"""The previous-version lookup as a join of two streams.

Messages wait in the state of the join until every version that could be theirs has had its time: versions may arrive after
the messages that need them. A message is joined with all earlier versions of its entity within ``reach``, and the newest of
them is its previous version. Once the watermark is ``reach`` past a message, its answer comes out: with a version
(resolved), or without one (expired). A message that is not out yet is pending, and is nowhere but in the state.

State is bounded by time: versions and answers are kept for ``reach`` plus ``wait``, messages for ``wait``. With RocksDB it is
on the executors' disks and in the checkpoint, not in their memory. This finds versions that are so new that no batch has
written them yet; a previous version that is older than ``reach`` is not found here but by ``version_store``, which looks
up histories of any age.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.operators.versions import previous_version_create_bypass, previous_version_missing

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of queries that start after this is kept by RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stream_previous_versions(messages: DataFrame, versions: DataFrame, wait: str = "30 seconds", reach: str = "5 minutes") -> DataFrame:
    """Parsed messages (a stream) with their previous version among the versions (a stream); answers come in append mode.

    Copies of a message (same entity, time, position and text) give one answer. Creations get no version, as in the batch
    lookup, and others that have none get its error.
    """
    asked = messages.withColumn("_at", F.timestamp_millis("msg_creation_time")).withWatermark("_at", wait)
    known = versions.select(
        F.col("body.guid").alias("_guid"), F.timestamp_millis(F.col("body.updateTime")).alias("_time"), F.col("body").alias("_body"),
    ).withWatermark("_time", wait)
    earlier = F.expr(f"entity.guid = _guid AND _time < _at AND _time >= _at - INTERVAL {reach}")
    joined = asked.join(known, earlier, "leftOuter")
    # The state of a message is one version: the newest so far.
    newest = F.max_by("_body", F.struct("_time", F.to_json("_body"))).alias("previous_version")
    rest = [c for c in messages.columns]
    answers = joined.groupBy("_at", F.col("entity.guid").alias("_of"), F.xxhash64("position", "digest", "value").alias("_which")).agg(
        newest, F.first(F.struct(*rest)).alias("_message"))
    found = answers.select("_message.*", "previous_version")
    return previous_version_missing(previous_version_create_bypass(found))
