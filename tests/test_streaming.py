"""Streams give what the same log gives in one batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from metaloom.operators.versions import versions_dedupe
from metaloom.plans.jobs import Tables, changes_of, word_count
from metaloom.plans.fold import fold
from metaloom.schemas import DOCUMENT, ENTITY_VERSION
from metaloom.sources.change_log import source_change_log
from metaloom.sources.sample_catalog import history_of, registered_types
from metaloom.sources.postings import postings
from metaloom.streaming.jobs import Catalog, stream_publish_state, stream_synchronize, synchronize_batch
from tests.build import ent, note, refs

DOMAIN, ENTITY = "m4i_data_domain", "m4i_data_entity"
LOG = [
    [note("CREATE", ent("d", DOMAIN, {"name": "domain"}), 1), note("CREATE", ent("n", ENTITY, {"name": "n"}), 2),
     '{"hello": "world"}'],
    [note("UPDATE", ent("d", DOMAIN, {"name": "domain", "dataEntity": [{"guid": "n"}]},
                        {"dataEntity": refs("n", type_name=ENTITY)}), 3),
     note("UPDATE", ent("never", ENTITY, {"name": "x"}), 4)],
    [note("UPDATE", ent("d", DOMAIN, {"name": "renamed", "dataEntity": [{"guid": "n"}]},
                        {"dataEntity": refs("n", type_name=ENTITY)}), 5), note("CREATE", ent("z", ENTITY), 6)],
    [note("DELETE", ent("z", ENTITY), 7)],
]


@pytest.fixture
def landed(spark, tmp_path):
    """A folder with one file per micro-batch."""
    for rows in LOG:
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(
            str(tmp_path / "log"))
    return tmp_path


def catalog(spark, tmp_path, log):
    return Catalog(str(tmp_path / "state"), lambda s: history_of(log), registered_types, mode="as_of", max_wait_ms=-1)


def test_synchronize_stream_equals_batch(spark, landed):
    log = source_change_log(spark, {"path": str(landed / "log"), "format": "text"}, streaming=False)
    tables = Tables(history_of(log), registered_types(spark), None, spark.createDataFrame([], DOCUMENT), "as_of")
    changes, _, batch_errors = changes_of(log, tables)
    want = sorted(map(str, fold(changes, tables.documents)[0].collect()))

    state = catalog(spark, landed, log)
    raw = source_change_log(spark, {"path": str(landed / "log"), "format": "text", "maxFilesPerTrigger": "1"})
    query = stream_synchronize(raw, state, str(landed / "check"))
    query.awaitTermination(600)
    assert query.exception() is None
    last = query.lastProgress["batchId"]
    documents = state.documents(spark, last)
    assert sorted(map(str, documents.collect())) == want
    rows = {r["guid"]: r for r in documents.collect()}
    assert set(rows) == {"d", "n"} and rows["n"]["breadcrumbname"] == ["renamed"]
    assert sorted(r["kind"] for r in state.errors(spark).collect()) == sorted(
        r["kind"] for r in batch_errors.collect()) == ["no_previous_version", "validation"]


def test_a_batch_that_runs_again_gives_the_same_state(spark, tmp_path):
    """Two batches, the second twice; it rewrites the buckets of what it touches alone."""
    lines = [r for rows in LOG for r in rows]
    log = spark.createDataFrame([(r,) for r in lines], "value string")
    state = catalog(spark, tmp_path, log)
    parts = [spark.createDataFrame([(r,) for r in rows], "value string") for rows in (LOG[0] + LOG[1], LOG[2])]
    synchronize_batch(parts[0], 0, state)
    first = state.store.manifest(spark, 0)
    seen = []
    for _ in range(2):
        synchronize_batch(parts[1], 1, state)
        seen.append((sorted(map(str, state.documents(spark, 1).collect())), sorted(map(str, state.versions(spark, 1).select("doc_id").collect())),
                     sorted(map(str, state.index.read(spark, 1).collect()))))
    assert seen[0] == seen[1] and len(seen[0][0]) == 3
    assert sorted(map(str, postings(state.documents(spark, 1)).collect())) == seen[0][2]
    second = state.store.manifest(spark, 1)
    changed = {b for b in {*first, *second} if first.get(b) != second.get(b)}
    assert changed <= set(state.store.touched(spark.createDataFrame([("d",), ("n",), ("z",)], "guid string")))
    counts = {(r.stage, r.kind): r.rows for r in state.error_counts(spark).filter("batch = 0").collect()}
    kept = state.errors(spark).filter("batch = 0").groupBy("stage", "kind").count().collect()
    assert counts == {(r.stage, r.kind): r["count"] for r in kept} and len(counts) == 2


def test_publish_stream(spark, landed):
    log = source_change_log(spark, {"path": str(landed / "log"), "format": "text"}, streaming=False)
    state = catalog(spark, landed, log)
    raw = source_change_log(spark, {"path": str(landed / "log"), "format": "text"})
    query = stream_publish_state(raw, state, str(landed / "check"))
    query.awaitTermination(300)
    assert query.exception() is None
    got = sorted(r["doc_id"] for r in state.versions(spark, query.lastProgress["batchId"]).collect())
    assert got == ["d_1", "d_3", "d_5", "n_2", "never_4", "z_6", "z_7"]


def test_versions_are_deduplicated_on_a_stream(spark, landed):
    log = source_change_log(spark, {"path": str(landed / "log"), "format": "text"}, streaming=False)
    history_of(log).unionByName(history_of(log)).write.parquet(str(landed / "twice"))
    stream = spark.readStream.schema(ENTITY_VERSION).parquet(str(landed / "twice"))
    query = versions_dedupe(stream).writeStream.format("memory").queryName("deduped").trigger(
        availableNow=True).option("checkpointLocation", str(landed / "dedupe")).start()
    query.awaitTermination(300)
    assert spark.table("deduped").count() == 7


def test_word_count_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("to be\tor  not",), ("to be be",)], "text string").write.parquet(str(tmp_path / "lines"))
    counts = word_count(spark.readStream.schema("text string").parquet(str(tmp_path / "lines")))
    query = counts.writeStream.outputMode("complete").format("memory").queryName("words").trigger(
        availableNow=True).option("checkpointLocation", str(tmp_path / "words")).start()
    query.awaitTermination(300)
    assert {r["word"]: r["count"] for r in spark.table("words").collect()} == {"to": 2, "be": 3, "or": 1, "not": 1}
    assert spark.table("words").filter(F.col("word") == "").count() == 0
