"""Queries over maintained state: bucketed documents, their inverted index, the version history, days, paths, import order."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from metaloom.functions.state import checkpoint_dir, cut
from metaloom.operators import created, validate, versions
from metaloom.operators.hierarchy import canonical_breadcrumbs
from metaloom.operators.link_edges import apply_link_edits, edges_of, link_lists
from metaloom.operators.versions import previous_version_asof
from metaloom.plans.event_queries import (
    _LOOKUP, CUR, EV, PREV, history, previous_rows, raw, valid_messages, validated, with_previous,
)
from metaloom.plans.registry import ORACLES, query
from metaloom.plans.star_queries import _FLAT, PATHS, after_deletions, arrived, link_rows, path_rows, star_sql
from metaloom.schemas import DOCUMENT_COLUMNS
from metaloom.sources.day_store import DayStore
from metaloom.sources.index_rules import import_levels
from metaloom.sources.postings import document_store, documents_below, posting_changes, posting_store, postings
from metaloom.sources.sample_catalog import Star, current_entities, registered_types, renames, table
from metaloom.sources.sinks import (
    apply_document_changes, counted, counts_of, dead_letter, parse_document_changes, sink_document_upserts,
)
from metaloom.sources.version_store import VersionStore
from metaloom.streaming.publish import file_topic, ledger, publish_changes, read_file_topic


def root(spark, kind: str) -> str:
    """A folder of its own for a store."""
    return f"{checkpoint_dir(spark)}/{kind}-{uuid.uuid4()}"


def _edited(spark, sf) -> DataFrame:
    """Documents that the deletions change, and those that they remove."""
    flat = cut(after_deletions(spark, sf).withColumn("batch", F.lit(1)))
    return flat.select(*DOCUMENT_COLUMNS, "deleted", "batch")


# --------------------------------------------------------------------------- documents and their index
@query("bucketed_documents", f"""WITH {_FLAT}
SELECT guid, name, array_to_string(pg, '/') AS path FROM nodes WHERE guid NOT IN (SELECT guid FROM flat)
UNION ALL SELECT guid, name, array_to_string(pg, '/') FROM flat WHERE NOT deleted""")
def q_bucketed_documents(spark, sf):
    """The document table after deletions, with only the buckets of changed documents rewritten."""
    store = document_store(root(spark, "documents"))
    store.create(Star(spark, sf).documents())
    store.apply(_edited(spark, sf), "batch", 0, 1)
    return store.read(spark, 1).select("guid", "name", F.array_join("breadcrumbguid", "/").alias("path"))


def _index(spark, sf):
    """The index of all documents (version 0), and after the deletions (version 1)."""
    docs, store = Star(spark, sf).documents(), posting_store(root(spark, "postings"))
    store.create(postings(docs, store))
    edited = _edited(spark, sf)
    before = docs.join(edited.select("guid"), "guid", "left_semi")
    store.apply(posting_changes(before, edited.filter("NOT deleted")).withColumn("batch", F.lit(1)), "batch", 0, 1)
    return store


@query("maintained_postings", f"""WITH {_FLAT},
after AS (SELECT guid, pg FROM nodes WHERE guid NOT IN (SELECT guid FROM flat) UNION ALL SELECT guid, pg FROM flat WHERE NOT deleted)
SELECT DISTINCT unnest(pg) AS guid, guid AS doc, 'breadcrumb' AS field FROM after
UNION ALL SELECT DISTINCT guid, doc, field FROM lk WHERE doc IN (SELECT guid FROM after) AND guid NOT IN (SELECT guid FROM del)""")
def q_maintained_postings(spark, sf):
    """The index kept up to date from the documents that changed, not built anew."""
    return _index(spark, sf).read(spark, 1).select("guid", "doc", "field")


@query("scan_postings_by_ancestor", f"""WITH {star_sql()}
SELECT a.guid AS doc, ren.guid, CAST(list_position(a.pg, ren.guid) - 1 AS INTEGER) AS pos FROM nodes a
  JOIN (SELECT 'N' || n_nationkey AS guid FROM nation UNION ALL SELECT 'C' || c_custkey FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'P' || p_partkey FROM part WHERE p_size = 50) ren ON list_contains(a.pg, ren.guid)""")
def q_scan_postings_by_ancestor(spark, sf):
    """Documents below renamed entities, from the buckets of these entities alone."""
    store = posting_store(root(spark, "postings"))
    store.create(postings(Star(spark, sf).documents(), store))
    return documents_below(store, 0, renames(spark, sf).select("guid"))


# --------------------------------------------------------------------------- versions
@query("previous_version_from_store", f"""WITH {EV}, {PREV}
SELECT guid, ms AS msg_creation_time, op AS operation, pms AS previous_time, pk AS previous_k FROM prev""")
def q_previous_version_from_store(spark, sf):
    """The as-of lookup over a history that came in six batches."""
    messages = valid_messages(spark, sf)
    fresh = cut(history(messages).withColumn("part", F.expr("CAST(pmod(msg_creation_time DIV 1000, 6) AS INT)")))
    store = VersionStore(root(spark, "versions"))
    for batch in range(6):
        store.append(fresh.filter(F.col("part") == batch), batch)
    asked = messages.select(F.col("entity.guid").alias("guid"), F.col("msg_creation_time").alias("before"))
    return previous_rows(previous_version_asof(messages, store.lookup(asked, 5)))


@query("retention_by_day", """WITH v AS (
  SELECT 'C' || o_custkey AS guid, epoch_us(o_orderdate) // 1000 AS msg_creation_time, o_orderkey FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
SELECT * FROM v WHERE msg_creation_time >= epoch_us(DATE '1996-01-01') // 1000
UNION ALL SELECT * FROM (SELECT * FROM v WHERE msg_creation_time < epoch_us(DATE '1996-01-01') // 1000
  QUALIFY row_number() OVER (PARTITION BY guid ORDER BY msg_creation_time DESC) = 1)""")
def q_retention_by_day(spark, sf):
    """Whole days go, in two steps; the last version of each guid before them stays for as-of lookups."""
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("C"), "o_custkey").alias("guid"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("msg_creation_time"),
        "o_orderkey")
    versions = orders.groupBy("guid", "msg_creation_time").agg(F.max("o_orderkey").alias("o_orderkey"))
    store = DayStore(root(spark, "days"), versions.schema)
    store.append(versions)
    store.drop_before(spark, "1994-07-01")
    store.drop_before(spark, "1996-01-01")
    return store.read(spark)


# --------------------------------------------------------------------------- hierarchy
@query("canonical_breadcrumbs", """WITH RECURSIVE parent AS (
  SELECT 'R' || r_regionkey AS guid, r_name AS name, 'm4i_system' AS typ, CAST(NULL AS VARCHAR) AS up FROM region
  UNION ALL SELECT 'N' || n_nationkey, n_name, 'm4i_collection', 'R' || n_regionkey FROM nation
  UNION ALL SELECT 'C' || c_custkey, c_name, 'm4i_dataset', 'N' || c_nationkey FROM customer
  UNION ALL SELECT 'O' || o_orderkey, 'Order ' || o_orderkey, 'm4i_field', 'C' || o_custkey FROM orders
  UNION ALL SELECT 'P' || p_partkey, p_name, 'm4i_data_attribute', NULL FROM part
  UNION ALL SELECT 'S' || s_suppkey, s_name, 'm4i_person', NULL FROM supplier),
way AS (
  SELECT guid, name, typ, CAST([] AS VARCHAR[]) AS pg, CAST([] AS VARCHAR[]) AS pn, CAST([] AS VARCHAR[]) AS pt FROM parent WHERE up IS NULL
  UNION ALL SELECT p.guid, p.name, p.typ, list_append(way.pg, way.guid), list_append(way.pn, way.name), list_append(way.pt, way.typ)
  FROM parent p JOIN way ON p.up = way.guid)
SELECT """ + PATHS + " FROM way")
def q_canonical_breadcrumbs(spark, sf):
    """Paths of all documents from the parents alone; the paths that the documents had are wrong."""
    docs = Star(spark, sf).documents()
    stale = F.array(F.lit("stale"))
    wrong = docs.withColumns({f"breadcrumb{p}": stale for p in ("guid", "name", "type")})
    return path_rows(canonical_breadcrumbs(wrong)[0])


@query("import_levels", f"""WITH RECURSIVE {star_sql()},
needs AS (SELECT b AS guid, a AS needs FROM edge WHERE left(a, 1) <> 'S'),
reach AS (SELECT guid, 0 AS level FROM nodes
  UNION SELECT needs.guid, level + 1 FROM reach JOIN needs ON reach.guid = needs.needs)
SELECT guid, CAST(max(level) AS INTEGER) AS level FROM reach GROUP BY guid""")
def q_import_levels(spark, sf):
    """Customers before their orders, orders before their parts, regions before nations."""
    star = Star(spark, sf)
    order = F.when(F.col("doc").startswith("R") & F.col("guid").startswith("N"), 1).when(
        F.col("doc").startswith("C") & F.col("guid").startswith("O"), 1).when(
        F.col("doc").startswith("O") & F.col("guid").startswith("P"), 1)
    edges = star.links().filter(order.isNotNull()).select("guid", F.col("doc").alias("needs"))
    return import_levels(star.nodes().select("guid"), edges)[0]


# --------------------------------------------------------------------------- links as edges
@query("link_documents_as_edges", ORACLES["link_documents"])
def q_link_documents_as_edges(spark, sf):
    """The links that new orders, suppliers and regions bring, as rows; lists are put together in the end."""
    base, pairs = arrived(spark, sf)
    edits = cut(created.link_documents(pairs))
    after = apply_link_edits(edges_of(base), edits, 1)
    return link_rows(link_lists(after.join(edits.select("doc").distinct(), "doc", "left_semi")))


# --------------------------------------------------------------------------- publishing, counting
@query("publish_in_order", f"""WITH {_FLAT}
SELECT guid, name, array_to_string(pg, '/') AS path, (SELECT count(*) FROM flat) AS offsets FROM nodes WHERE guid NOT IN (SELECT guid FROM flat)
UNION ALL SELECT guid, name, array_to_string(pg, '/'), (SELECT count(*) FROM flat) FROM flat WHERE NOT deleted""")
def q_publish_in_order(spark, sf):
    """The document table of a reader of the topic, after two batches, of which the first was sent twice."""
    state, topic = root(spark, "state"), root(spark, "topic")
    flat = sink_document_upserts(cut(after_deletions(spark, sf))).withColumn("wave", F.lit(0))
    half = F.pmod(F.xxhash64("key"), F.lit(2))
    for batch in (0, 1):
        flat.filter(half == batch).write.parquet(f"{state}/changes/batch={batch}")
    send = file_topic(topic)

    def stop(rows, batch):
        send(rows, batch)
        raise InterruptedError("stopped before the ledger was written")

    try:
        publish_changes(spark, state, stop, 1)
    except InterruptedError:
        pass
    publish_changes(spark, state, send, 1)
    messages = read_file_topic(spark, topic)
    changes, _ = parse_document_changes(messages, "offset")
    docs = apply_document_changes(Star(spark, sf).documents(), changes, "guid", "offset")
    offsets = messages.agg(F.countDistinct("offset").alias("offsets")).join(ledger(spark, state).agg(F.max("next").alias("next")), F.col("offsets") == F.col("next"))
    return docs.select("guid", "name", F.array_join("breadcrumbguid", "/").alias("path")).join(F.broadcast(offsets.select("offsets")))


@query("dead_letter_counts", f"""WITH {EV}, {CUR}, {PREV}, e AS (
  SELECT {_LOOKUP} AS kind, ms FROM en e LEFT JOIN cur c ON e.guid = c.guid
  UNION ALL SELECT 'no_previous_version', ms FROM prev WHERE op <> 'ENTITY_CREATE' AND pms IS NULL)
SELECT CASE kind WHEN 'no_previous_version' THEN 'previous_version' WHEN 'unknown_type' THEN 'lookup'
    WHEN 'lookup_failed' THEN 'lookup' ELSE 'validate' END AS stage, kind, count(*) AS rows
FROM e WHERE kind IS NOT NULL GROUP BY ALL""")
def q_dead_letter_counts(spark, sf):
    """How many messages failed, by stage and kind, counted while the dead letters were written."""
    checked = validate.enriched(raw(spark, sf), current_entities(validated(spark, sf)), registered_types(spark))
    looked_up = versions.previous_version_missing(with_previous(spark, sf))
    seen = Observation()
    cut(counted(dead_letter(checked, looked_up), seen))
    return counts_of(spark, seen)
