"""The jobs as streaming queries.

State lives in tables under one shared folder:

versions/           the history as sorted runs with filters (``version_store``)
documents/          the document table in buckets of the guid (``keyed_store``)
postings/           the inverted index of the documents, in buckets of the guid that is held (``postings``)
pending/batch=N     messages that still wait for a previous version after batch N
errors/batch=N      dead letters of batch N
error_counts/batch=N    how many there are by stage and kind, counted while they were written
changes/batch=N     changed documents of batch N, wave by wave, as (key, value) text

Batch N reads the state of batch N - 1 and writes a version N of its own, so a batch that is run again after a failure
gives the same state. What a batch reads and writes follows the batch: the buckets of the documents that it can touch, of
the index entries of their guids, and the history files that can hold its guids. Old pending folders may be removed.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from metaloom.functions.state import cut
from metaloom.operators.diff import determine_changes
from metaloom.operators.validate import enriched, split_main_errors
from metaloom.operators.versions import entity_versions, previous_version_wait, versions_dedupe, with_versions
from metaloom.plans.fold import fold_near
from metaloom.schemas import HIERARCHY_RULES
from metaloom.sources.keyed_store import KeyedStore
from metaloom.sources.postings import document_changes, document_store, posting_changes, posting_store, postings, working_guids
from metaloom.sources.sinks import counted, counts_of, dead_letter, sink_document_upserts, sink_entity_versions
from metaloom.sources.version_store import VersionStore


@dataclass
class Catalog:
    """Where the state is, and the tables that notifications are looked up in; read anew for each batch."""

    root: str
    current: Callable[[SparkSession], DataFrame]
    types: Callable[[SparkSession], DataFrame]
    mode: str = "latest"
    max_wait_ms: int = 30_000
    rules: list = field(default_factory=lambda: HIERARCHY_RULES)
    clock: Callable[[], int] = lambda: int(time.time() * 1000)
    buckets: int = 64

    @property
    def store(self) -> KeyedStore:
        return document_store(f"{self.root}/documents", self.buckets)

    @property
    def index(self) -> KeyedStore:
        return posting_store(f"{self.root}/postings", self.buckets)

    @property
    def history(self) -> VersionStore:
        return VersionStore(f"{self.root}/versions")

    def load(self, documents: DataFrame) -> None:
        """Start from a document table instead of an empty one, before the first batch."""
        self.store.create(documents, -1)
        self.index.create(postings(documents), -1)

    def folder(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(self.folder(table, batch))

    def documents(self, spark: SparkSession, batch: int) -> DataFrame:
        """The document table after a batch; empty, or what was loaded, before the first one."""
        return self.store.read(spark, self.store.last(spark, batch))

    def versions(self, spark: SparkSession, batch: int) -> DataFrame:
        """The history after a batch."""
        return self.history.read(spark, batch)

    def write_errors(self, letters: DataFrame, batch: int) -> None:
        """Dead letters of a batch, and their counts."""
        seen = Observation()
        self.write(counted(letters, seen), "errors", batch)
        self.write(counts_of(letters.sparkSession, seen), "error_counts", batch)

    def errors(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/errors")

    def error_counts(self, spark: SparkSession) -> DataFrame:
        """(stage, kind, rows, batch) of all batches so far."""
        return spark.read.schema("stage string, kind string, rows bigint, batch bigint").parquet(f"{self.root}/error_counts")


def _log(batch: DataFrame) -> DataFrame:
    """Text and, if the source has them, positions."""
    return batch.select(*[c for c in ("value", "position") if c in batch.columns])


def publish_batch(batch: DataFrame, number: int, catalog: Catalog) -> None:
    """Add the versions of one micro-batch, and the text to publish for them."""
    spark = batch.sparkSession
    checked = cut(enriched(_log(batch), catalog.current(spark), catalog.types(spark), catalog.mode))
    main, failed = split_main_errors(checked)
    fresh = versions_dedupe(entity_versions(main)).select("body", "doc_id", "event_time", "msg_creation_time")
    fresh = cut(fresh)
    catalog.write(sink_entity_versions(fresh), "changes", number)
    catalog.write_errors(dead_letter(failed), number)
    catalog.history.append(fresh, number)


def synchronize_batch(batch: DataFrame, number: int, catalog: Catalog) -> None:
    """Bring history and documents up to date with one micro-batch."""
    spark = batch.sparkSession
    now = catalog.clock()
    checked = cut(enriched(_log(batch), catalog.current(spark), catalog.types(spark), catalog.mode))
    main, failed = split_main_errors(checked)
    fresh = cut(versions_dedupe(entity_versions(main)).select("body", "doc_id", "event_time", "msg_creation_time"))
    waiting = main.withColumn("first_seen", F.lit(now))
    if number > 0:
        waiting = waiting.unionByName(
            spark.read.schema(waiting.schema).parquet(catalog.folder("pending", number - 1)))
    waiting = cut(waiting)
    asked = waiting.select(F.col("entity.guid").alias("guid"), F.col("msg_creation_time").alias("before"))
    history = with_versions(catalog.history.lookup(asked, number - 1), fresh)
    resolved, pending, expired = previous_version_wait(waiting, history, now, catalog.max_wait_ms)
    changes, undetermined = determine_changes(resolved.drop("first_seen"))

    published: list[DataFrame] = []
    base, index_base = catalog.store.last(spark, number - 1), catalog.index.last(spark, number - 1)
    before, after, rejected = fold_near(
        changes, lambda changed, refs: catalog.store.read_keys(base, working_guids(catalog.index, index_base, changed, refs)),
        catalog.rules,
        on_wave=lambda flat: published.append(sink_document_upserts(flat).withColumn("wave", F.lit(len(published)))))
    edited = cut(document_changes(before, after).withColumn("batch", F.lit(number)))
    moved = posting_changes(before.join(edited.select("guid"), "guid", "left_semi"), edited.filter("NOT deleted"))

    catalog.write(pending.select(*waiting.columns), "pending", number)
    catalog.write_errors(dead_letter(failed, expired, undetermined, rejected), number)
    if published:
        out = published[0]
        for more in published[1:]:
            out = out.unionByName(more)
        catalog.write(out, "changes", number)
    catalog.history.append(fresh, number)
    catalog.index.apply(moved.withColumn("batch", F.lit(number)), "batch", index_base, number)
    catalog.store.apply(edited, "batch", base, number)


def _start(raw: DataFrame, step, catalog: Catalog, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        raw.writeStream.foreachBatch(lambda batch, number: step(batch, number, catalog))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def stream_publish_state(raw: DataFrame, catalog: Catalog, checkpoint: str, **trigger) -> StreamingQuery:
    """Run the version job on a stream of notifications (column ``value``)."""
    return _start(raw, publish_batch, catalog, checkpoint, trigger or {"availableNow": True})


def stream_synchronize(raw: DataFrame, catalog: Catalog, checkpoint: str, **trigger) -> StreamingQuery:
    """Run the document job on a stream of notifications (column ``value``)."""
    return _start(raw, synchronize_batch, catalog, checkpoint, trigger or {"availableNow": True})
