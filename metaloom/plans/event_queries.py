"""Queries over the change log: sources, validation, versions, diffs and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.functions.attributes import entity, ref, text
from metaloom.functions.state import cut
from metaloom.operators import diff, validate, versions
from metaloom.plans.jobs import Tables, job_publish_state, typed_rows_to_string, word_count
from metaloom.plans.registry import query
from metaloom.schemas import RELATIONSHIPS
from metaloom.sources import index_rules, sinks
from metaloom.sources.change_log import source_change_log, source_collection
from metaloom.sources.documents import scan_index_sample
from metaloom.sources.sample_catalog import (
    USER_TYPES,
    current_entities,
    notifications,
    quoted,
    registered_types,
    staged,
    table,
)

_TYPES = "[" + ",".join(f"'{t}'" for t in USER_TYPES) + "]"

# The change log as rows: one per event, with everything the notification text says.
EV = f"""
ev AS (
  SELECT event_id, 'U' || user_id AS guid, epoch_us(ts) // 1000 AS ms,
    CASE event_type WHEN 'signup' THEN 'ENTITY_CREATE' WHEN 'purchase' THEN 'ENTITY_DELETE'
      WHEN 'error' THEN 'CLASSIFICATION_ADD' ELSE 'ENTITY_UPDATE' END AS op,
    ({_TYPES})[CAST(user_id % {len(USER_TYPES)} + 1 AS INTEGER)] AS typ,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, value AS val,
    NOT (event_type = 'error' AND value > 30) AS has_entity
  FROM events),
en AS (
  SELECT *, CASE WHEN has_entity THEN guid END AS g, CASE WHEN has_entity THEN typ END AS t,
    'n' || (k // 10) AS name,
    CASE WHEN k % 3 = 0 THEN 'null' WHEN k % 3 = 2 THEN '"a' || (k % 7) || '"' END AS alias,
    CASE WHEN val > 30 THEN '"d' || CAST(floor(val) AS BIGINT) || '"' END AS def,
    ['U' || (k * 7 % 100), 'U' || (k * 13 % 100)] AS ra,
    CASE WHEN k % 2 = 0 THEN ['U' || k] ELSE CAST([] AS VARCHAR[]) END AS rb
  FROM ev),
valid AS (
  SELECT * FROM en WHERE has_entity AND typ <> 'm4i_source' AND op <> 'CLASSIFICATION_ADD')
"""

CUR = """
last_op AS (SELECT guid, arg_max(op, ms) AS lop, arg_max(typ, ms) AS ctyp, arg_max(k, ms) AS ck FROM valid GROUP BY guid),
cur AS (SELECT * FROM last_op WHERE lop <> 'ENTITY_DELETE')
"""

PREV = """
prev AS (
  SELECT m.*, v.ms AS pms, v.k AS pk, v.alias AS palias, v.def AS pdef, v.name AS pname, v.ra AS pra, v.rb AS prb
  FROM valid m ASOF LEFT JOIN valid v ON m.guid = v.guid AND m.ms > v.ms)
"""


def attr(name: str, column: str = "entity") -> Column:
    return text(F.col(f"{column}.attributes"), name)


def guid_list(column: str, attribute: str) -> Column:
    refs = F.try_element_at(F.col(column), F.lit(attribute))
    return F.array_join(F.transform(refs, lambda r: r["guid"]), ",")


def raw(spark, sf) -> DataFrame:
    """The log as it arrives."""
    return staged(spark, sf, "notifications", lambda: notifications(spark, sf))


def parsed(spark, sf) -> DataFrame:
    return staged(spark, sf, "parsed", lambda: validate.parse_notifications(raw(spark, sf)))


def validated(spark, sf) -> DataFrame:
    """Parsed messages after the checks that need no lookup."""
    checked = parsed(spark, sf)
    for stage in (validate.reject_missing_entity, validate.filter_ignored_types, validate.filter_operations):
        checked = stage(checked)
    return checked


def valid_messages(spark, sf) -> DataFrame:
    return validate.split_main_errors(validated(spark, sf))[0]


def history(messages: DataFrame) -> DataFrame:
    return versions.versions_dedupe(versions.entity_versions(messages))


def known_versions(spark, sf) -> DataFrame:
    """The history of all valid messages, put together once: lookups read its times, then the bodies of the answers."""
    return staged(spark, sf, "history", lambda: history(valid_messages(spark, sf)))


def with_asof(spark, sf) -> DataFrame:
    return versions.previous_version_asof(valid_messages(spark, sf), known_versions(spark, sf))


def with_previous(spark, sf) -> DataFrame:
    """Messages with their previous version, the input of the diffs."""
    return staged(spark, sf, "with_previous", lambda: versions.previous_version_create_bypass(with_asof(spark, sf)))


def outcome(df: DataFrame) -> DataFrame:
    """One row per message with the kind of its error."""
    return df.select("msg_creation_time", "operation", F.col("entity.guid").alias("guid"),
                     F.col("error.kind").alias("error_kind"))


# --------------------------------------------------------------------------- sources
@query("source_change_log", "SELECT props AS value FROM events")
def q_source_change_log(spark, sf):
    return source_change_log(spark, {"path": f"{sf}/events.parquet", "column": "props"}, streaming=False).select("value")


@query("source_collection", "SELECT event_id, event_type, value FROM events")
def q_source_collection(spark, sf):
    return source_collection(spark, f"{sf}/events.parquet", "event_id bigint, event_type string, value double")


@query("scan_index_sample", "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 10")
def q_scan_index_sample(spark, sf):
    return scan_index_sample(table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), 10, "doc_id")


# --------------------------------------------------------------------------- validation
@query("parse_notifications", f"""WITH {EV}
SELECT ms AS msg_creation_time, ms AS event_time, op AS operation, g AS guid, t AS type_name,
  CASE WHEN has_entity THEN name END AS name, CASE WHEN has_entity THEN CAST(k AS VARCHAR) END AS k,
  CASE WHEN has_entity THEN alias END AS alias, CASE WHEN has_entity THEN def END AS definition,
  CASE WHEN has_entity THEN '{{"y":[1,2],"z":1}}' END AS tags,
  CASE WHEN has_entity THEN array_to_string(ra, ',') END AS rel_a,
  CASE WHEN has_entity THEN array_to_string(rb, ',') END AS rel_b, CAST(NULL AS VARCHAR) AS error_kind
FROM en
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'validation' FROM events""")
def q_parse_notifications(spark, sf):
    # The properties of the events are JSON too, but no notifications.
    text_rows = raw(spark, sf).select("value").unionByName(table(spark, sf, "events").select(F.col("props").alias("value")))
    raw_attr = F.col("entity.attributes")
    return validate.parse_notifications(text_rows).select(
        "msg_creation_time", "event_time", "operation", F.col("entity.guid").alias("guid"),
        F.col("entity.typeName").alias("type_name"), attr("name").alias("name"),
        *[F.try_element_at(raw_attr, F.lit(a)).alias(a) for a in ("k", "alias", "definition", "tags")],
        guid_list("entity.relationshipAttributes", "relA").alias("rel_a"),
        guid_list("entity.relationshipAttributes", "relB").alias("rel_b"),
        F.col("error.kind").alias("error_kind"),
    )


@query("reject_missing_entity", f"""WITH {EV}
SELECT ms AS msg_creation_time, op AS operation, g AS guid, CASE WHEN NOT has_entity THEN 'missing_entity' END AS error_kind
FROM en""")
def q_reject_missing_entity(spark, sf):
    return outcome(validate.reject_missing_entity(parsed(spark, sf)))


@query("filter_ignored_types", f"""WITH {EV}
SELECT ms AS msg_creation_time, op AS operation, g AS guid, CASE WHEN t = 'm4i_source' THEN 'ignored_type' END AS error_kind
FROM en""")
def q_filter_ignored_types(spark, sf):
    return outcome(validate.filter_ignored_types(parsed(spark, sf)))


@query("filter_operations", f"""WITH {EV}
SELECT ms AS msg_creation_time, op AS operation, g AS guid,
  CASE WHEN op = 'CLASSIFICATION_ADD' THEN 'ignored_operation' END AS error_kind
FROM en""")
def q_filter_operations(spark, sf):
    return outcome(validate.filter_operations(parsed(spark, sf)))


_VALIDATION = """CASE WHEN NOT has_entity THEN 'missing_entity' WHEN typ = 'm4i_source' THEN 'ignored_type'
    WHEN op = 'CLASSIFICATION_ADD' THEN 'ignored_operation' END"""
_LOOKUP = f"""COALESCE({_VALIDATION}, CASE WHEN op = 'ENTITY_DELETE' THEN NULL WHEN typ = 'unregistered_type'
    THEN 'unknown_type' WHEN ck IS NULL THEN 'lookup_failed' END)"""


@query("enrich_current_entity", f"""WITH {EV}, {CUR}
SELECT e.ms AS msg_creation_time, e.op AS operation, e.g AS guid,
  CASE WHEN {_VALIDATION} IS NULL AND op <> 'ENTITY_DELETE' THEN ck IS NOT NULL END AS looked_up,
  CASE WHEN NOT has_entity THEN NULL WHEN {_VALIDATION} IS NULL AND op <> 'ENTITY_DELETE' THEN COALESCE(ck, k)
    ELSE k END AS k
FROM en e LEFT JOIN cur c ON e.guid = c.guid""")
def q_enrich_current_entity(spark, sf):
    messages = validated(spark, sf)
    return validate.enrich_current_entity(messages, current_entities(messages)).select(
        "msg_creation_time", "operation", F.col("entity.guid").alias("guid"), "looked_up",
        attr("k").cast("bigint").alias("k"))


@query("reject_unknown_type", f"""WITH {EV}
SELECT ms AS msg_creation_time, op AS operation, g AS guid,
  COALESCE({_VALIDATION}, CASE WHEN op <> 'ENTITY_DELETE' AND typ = 'unregistered_type' THEN 'unknown_type' END) AS error_kind
FROM en""")
def q_reject_unknown_type(spark, sf):
    return outcome(validate.reject_unknown_type(validated(spark, sf), registered_types(spark)))


@query("reject_lookup_failure", f"""WITH {EV}, {CUR}
SELECT ms AS msg_creation_time, op AS operation, g AS guid, {_LOOKUP} AS error_kind
FROM en e LEFT JOIN cur c ON e.guid = c.guid""")
def q_reject_lookup_failure(spark, sf):
    current = current_entities(validated(spark, sf))
    return outcome(validate.enriched(raw(spark, sf), current, registered_types(spark)))


@query("split_main_errors", f"""WITH {EV}, {CUR}
SELECT ms AS msg_creation_time, op AS operation, {_LOOKUP} IS NULL AS main
FROM en e LEFT JOIN cur c ON e.guid = c.guid""")
def q_split_main_errors(spark, sf):
    current = current_entities(validated(spark, sf))
    main, errors = validate.split_main_errors(
        validate.enriched(raw(spark, sf), current, registered_types(spark)))
    columns = ["msg_creation_time", "operation"]
    return main.select(*columns, F.lit(True).alias("main")).unionByName(
        errors.select(*columns, F.lit(False).alias("main")))


# --------------------------------------------------------------------------- versions
@query("entity_versions", f"""WITH {EV}
SELECT guid || '_' || ms AS doc_id, guid, ms AS update_time, ms AS event_time, ms AS msg_creation_time, k FROM valid""")
def q_entity_versions(spark, sf):
    return versions.entity_versions(valid_messages(spark, sf)).select(
        "doc_id", "body.guid", F.col("body.updateTime").alias("update_time"), "event_time", "msg_creation_time",
        attr("k", "body").cast("bigint").alias("k"))


@query("versions_reject_missing_entity", f"""WITH {EV}
SELECT ms AS msg_creation_time, op AS operation, g AS guid, CASE WHEN NOT has_entity THEN 'missing_entity' END AS error_kind
FROM en""")
def q_versions_reject_missing_entity(spark, sf):
    return outcome(versions.versions_reject_missing_entity(parsed(spark, sf)))


@query("versions_dedupe", f"""WITH {EV} SELECT DISTINCT guid || '_' || ms AS doc_id, k FROM valid""")
def q_versions_dedupe(spark, sf):
    written = versions.entity_versions(valid_messages(spark, sf))
    return versions.versions_dedupe(written.unionByName(written)).select(
        "doc_id", attr("k", "body").cast("bigint").alias("k"))


def previous_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("entity.guid").alias("guid"), "msg_creation_time", "operation",
        F.col("previous_version.updateTime").alias("previous_time"),
        attr("k", "previous_version").cast("bigint").alias("previous_k"))


@query("previous_version_asof", f"""WITH {EV}, {PREV}
SELECT guid, ms AS msg_creation_time, op AS operation, pms AS previous_time, pk AS previous_k FROM prev""")
def q_previous_version_asof(spark, sf):
    return previous_rows(with_asof(spark, sf))


@query("previous_version_create_bypass", f"""WITH {EV}, {PREV}
SELECT guid, ms AS msg_creation_time, op AS operation, CASE WHEN op <> 'ENTITY_CREATE' THEN pms END AS previous_time,
  CASE WHEN op <> 'ENTITY_CREATE' THEN pk END AS previous_k FROM prev""")
def q_previous_version_create_bypass(spark, sf):
    return previous_rows(versions.previous_version_create_bypass(with_asof(spark, sf)))


@query("previous_version_missing", f"""WITH {EV}, {PREV}
SELECT ms AS msg_creation_time, op AS operation, guid,
  CASE WHEN op <> 'ENTITY_CREATE' AND pms IS NULL THEN 'no_previous_version' END AS error_kind FROM prev""")
def q_previous_version_missing(spark, sf):
    return outcome(versions.previous_version_missing(with_previous(spark, sf)))


@query("previous_version_reject_missing_entity", f"""WITH {EV}
SELECT ms AS msg_creation_time, op AS operation, g AS guid, CASE WHEN NOT has_entity THEN 'missing_entity' END AS error_kind
FROM en""")
def q_previous_version_reject_missing_entity(spark, sf):
    return outcome(versions.previous_version_reject_missing_entity(parsed(spark, sf)))


NOW_MS = 1_706_000_000_000
MAX_WAIT_MS = 86_400_000


@query("previous_version_wait", f"""WITH {EV}, created AS (SELECT * FROM valid WHERE op = 'ENTITY_CREATE'),
found AS (SELECT m.*, v.ms AS pms FROM valid m ASOF LEFT JOIN created v ON m.guid = v.guid AND m.ms > v.ms)
SELECT guid, ms AS msg_creation_time, CASE WHEN op = 'ENTITY_CREATE' OR pms IS NOT NULL THEN 'resolved'
  WHEN {NOW_MS} - ms > {MAX_WAIT_MS} THEN 'expired' ELSE 'pending' END AS state FROM found""")
def q_previous_version_wait(spark, sf):
    # So far only the versions of creates are visible.
    messages = valid_messages(spark, sf)
    visible = versions.entity_versions(messages.filter("operation = 'ENTITY_CREATE'"))
    pending = messages.withColumn("first_seen", F.col("msg_creation_time"))
    parts = versions.previous_version_wait(pending, visible, NOW_MS, MAX_WAIT_MS)
    rows = [
        df.select(F.col("entity.guid").alias("guid"), "msg_creation_time", F.lit(state).alias("state"))
        for df, state in zip(parts, ("resolved", "pending", "expired"))
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("publish_state_facade", f"""WITH {EV}, {PREV}
SELECT guid, ms AS msg_creation_time, CASE WHEN op <> 'ENTITY_CREATE' THEN pms END AS previous_time,
  CASE WHEN op <> 'ENTITY_CREATE' AND pms IS NULL THEN 'no_previous_version' END AS error_kind FROM prev""")
def q_publish_state_facade(spark, sf):
    return versions.publish_state_facade(valid_messages(spark, sf), known_versions(spark, sf)).select(
        F.col("entity.guid").alias("guid"), "msg_creation_time",
        F.col("previous_version.updateTime").alias("previous_time"), F.col("error.kind").alias("error_kind"))


# --------------------------------------------------------------------------- diffs
@query("dispatch_operation", f"""WITH {EV}
SELECT ms AS msg_creation_time, op AS operation, g AS guid,
  CASE WHEN op = 'CLASSIFICATION_ADD' THEN 'not_implemented' END AS error_kind FROM en""")
def q_dispatch_operation(spark, sf):
    return outcome(diff.dispatch_operation(parsed(spark, sf)))


def change_rows(df: DataFrame, *columns: Column) -> DataFrame:
    return df.select("guid", F.col("ord.ms").alias("ms"), *columns)


def joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


_KEYS = """array_to_string(list_filter(['name', 'k', CASE WHEN {p}alias IS NOT NULL THEN 'alias' END,
  CASE WHEN {p}def IS NOT NULL THEN 'definition' END, 'tags'{more}], lambda x: x IS NOT NULL), ',')"""


@query("diff_create", f"""WITH {EV}
SELECT guid, ms, 'EntityCreated' AS event_type, {_KEYS.format(p='', more='')} AS inserted_attributes,
  array_to_string(ra, ',') AS rel_a, array_to_string(rb, ',') AS rel_b, guid AS new_guid, CAST(NULL AS VARCHAR) AS old_guid
FROM valid WHERE op = 'ENTITY_CREATE'""")
def q_diff_create(spark, sf):
    return change_rows(
        diff.diff_create(valid_messages(spark, sf)), F.col("event_type"), joined("inserted_attributes"),
        guid_list("inserted_relationships", "relA").alias("rel_a"),
        guid_list("inserted_relationships", "relB").alias("rel_b"),
        F.col("new_value.guid").alias("new_guid"), F.col("old_value.guid").alias("old_guid"))


_UNMAPPED = ", 'unmappedAttributes'"


@query("diff_delete", f"""WITH {EV}
SELECT guid, ms, 'EntityDeleted' AS event_type, {_KEYS.format(p='', more=_UNMAPPED)} AS deleted_attributes,
  array_to_string(ra, ',') AS rel_a, array_to_string(rb, ',') AS rel_b, CAST(NULL AS VARCHAR) AS new_guid, guid AS old_guid
FROM valid WHERE op = 'ENTITY_DELETE'""")
def q_diff_delete(spark, sf):
    return change_rows(
        diff.diff_delete(valid_messages(spark, sf)), F.col("event_type"), joined("deleted_attributes"),
        guid_list("deleted_relationships", "relA").alias("rel_a"),
        guid_list("deleted_relationships", "relB").alias("rel_b"),
        F.col("new_value.guid").alias("new_guid"), F.col("old_value.guid").alias("old_guid"))


def _picked(*cases: tuple[str, str]) -> str:
    items = ", ".join(f"CASE WHEN {condition} THEN '{key}' END" for key, condition in cases)
    return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ',')"


_INS = _picked(("alias", "alias IS NOT NULL AND palias IS NULL"), ("definition", "def IS NOT NULL AND pdef IS NULL"))
_DEL = _picked(("alias", "alias IS NULL AND palias IS NOT NULL"), ("definition", "def IS NULL AND pdef IS NOT NULL"))
_CHG = _picked(("name", "name <> pname"), ("k", "k <> pk"), ("alias", "alias <> palias"), ("definition", "def <> pdef"))
ATTR_DIFF = f"""
upd AS (SELECT * FROM prev WHERE op = 'ENTITY_UPDATE' AND pms IS NOT NULL),
adiff AS (SELECT guid, ms, {_INS} AS inserted_attributes, {_CHG} AS changed_attributes, {_DEL} AS deleted_attributes,
    k, pk FROM upd),
attr_changes AS (SELECT * FROM adiff WHERE inserted_attributes <> '' OR changed_attributes <> '' OR deleted_attributes <> '')
"""


@query("diff_attributes", f"""WITH {EV}, {PREV}, {ATTR_DIFF}
SELECT guid, ms, inserted_attributes, changed_attributes, deleted_attributes, k AS new_k, pk AS old_k FROM attr_changes""")
def q_diff_attributes(spark, sf):
    return change_rows(
        diff.diff_attributes(with_previous(spark, sf)), joined("inserted_attributes"), joined("changed_attributes"),
        joined("deleted_attributes"), attr("k", "new_value").cast("bigint").alias("new_k"),
        attr("k", "old_value").cast("bigint").alias("old_k"))


def _fresh(refs: str, pool: str) -> str:
    return f"""CASE WHEN len({refs}) > 0 THEN
      array_to_string(list_filter({refs}, lambda x: NOT list_contains({pool}, x)), ',') END"""


REL_DIFF = f"""
rupd AS (SELECT *, list_concat(ra, rb) AS pool, list_concat(pra, prb) AS ppool FROM prev
  WHERE op = 'ENTITY_UPDATE' AND pms IS NOT NULL),
rdiff AS (SELECT guid, ms, {_fresh('ra', 'ppool')} AS inserted_a, {_fresh('rb', 'ppool')} AS inserted_b,
    {_fresh('pra', 'pool')} AS deleted_a, {_fresh('prb', 'pool')} AS deleted_b FROM rupd),
rel_changes AS (SELECT * FROM rdiff WHERE COALESCE(inserted_a, '') <> '' OR COALESCE(inserted_b, '') <> ''
    OR COALESCE(deleted_a, '') <> '' OR COALESCE(deleted_b, '') <> '')
"""


@query("diff_relationships", f"""WITH {EV}, {PREV}, {REL_DIFF} SELECT * FROM rel_changes""")
def q_diff_relationships(spark, sf):
    return change_rows(
        diff.diff_relationships(with_previous(spark, sf)),
        guid_list("inserted_relationships", "relA").alias("inserted_a"),
        guid_list("inserted_relationships", "relB").alias("inserted_b"),
        guid_list("deleted_relationships", "relA").alias("deleted_a"),
        guid_list("deleted_relationships", "relB").alias("deleted_b"))


@query("diff_update", f"""WITH {EV}, {PREV}, {ATTR_DIFF}, {REL_DIFF}
SELECT guid, ms, 0 AS seq, 'EntityAttributeAudit' AS event_type FROM attr_changes
UNION ALL SELECT guid, ms, 1, 'EntityRelationshipAudit' FROM rel_changes""")
def q_diff_update(spark, sf):
    return change_rows(
        diff.diff_update(with_previous(spark, sf)), F.col("ord.seq").alias("seq"), F.col("event_type"))


@query("diff_errors", f"""WITH {EV}, p AS (
  SELECT m.*, v.ms AS pms FROM en m ASOF LEFT JOIN valid v ON m.guid = v.guid AND m.ms > v.ms)
SELECT ms AS msg_creation_time, op AS operation, g AS guid,
  CASE WHEN NOT has_entity OR (op = 'ENTITY_UPDATE' AND pms IS NULL) THEN 'value_error' END AS error_kind FROM p""")
def q_diff_errors(spark, sf):
    everything = validated(spark, sf)
    messages = versions.previous_version_asof(
        everything.drop("error"), history(everything.filter(F.col("error").isNull())))
    return outcome(diff.diff_errors(versions.previous_version_create_bypass(messages)))


@query("entity_message", f"""WITH {EV}
SELECT guid || '_' || ms || '_' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '_0' AS change_id, guid, typ AS type_name, op AS original_event_type,
  'EntityAttributeAudit' AS event_type, true AS direct_change, ms / 1000.0 AS msg_creation_time,
  '' AS inserted_attributes, CAST(0 AS INTEGER) AS changed_relationships FROM valid""")
def q_entity_message(spark, sf):
    return diff.entity_message(valid_messages(spark, sf), diff.ATTRIBUTE_AUDIT).select(
        "change_id", "guid", "type_name", "original_event_type", "event_type", "direct_change", "msg_creation_time",
        joined("inserted_attributes"), F.size("changed_relationships").alias("changed_relationships"))


@query("explode_changes", f"""WITH {EV}, {PREV}, {ATTR_DIFF}, {REL_DIFF}
SELECT guid, ms, 0 AS seq, 'EntityAttributeAudit' AS event_type FROM attr_changes
UNION ALL SELECT guid, ms, 1, 'EntityRelationshipAudit' FROM rel_changes
UNION ALL SELECT guid, ms, 0, 'EntityCreated' FROM prev WHERE op = 'ENTITY_CREATE'
UNION ALL SELECT guid, ms, 0, 'EntityDeleted' FROM prev WHERE op = 'ENTITY_DELETE'""")
def q_explode_changes(spark, sf):
    return change_rows(
        diff.explode_changes(with_previous(spark, sf)), F.col("ord.seq").alias("seq"), F.col("event_type"))


# --------------------------------------------------------------------------- sinks and index rules
def payload(name: str) -> Column:
    return F.get_json_object("value", f"$.value.{name}")


@query("sink_entity_versions", f"""WITH {EV}
SELECT guid || '_' || ms AS id, guid, typ AS type_name, ms AS update_time, CAST(k AS VARCHAR) AS k,
  CAST(NULL AS VARCHAR) AS event_time, true AS key_is_value FROM valid""")
def q_sink_entity_versions(spark, sf):
    out = sinks.sink_entity_versions(versions.entity_versions(valid_messages(spark, sf)))
    return out.select(
        F.get_json_object("key", "$.id").alias("id"), payload("guid").alias("guid"),
        payload("typeName").alias("type_name"), payload("updateTime").cast("bigint").alias("update_time"),
        payload("attributes.k").alias("k"), payload("event_time").alias("event_time"),
        (F.col("key") == F.col("value")).alias("key_is_value"))


@query("job_publish_state", f"""WITH {EV}, {CUR}
SELECT e.guid || '_' || ms AS id, e.guid, ms AS update_time,
  CAST(CASE WHEN op = 'ENTITY_DELETE' THEN k ELSE ck END AS VARCHAR) AS k
FROM en e LEFT JOIN cur c ON e.guid = c.guid WHERE {_LOOKUP} IS NULL""")
def q_job_publish_state(spark, sf):
    current = current_entities(validated(spark, sf))
    out = job_publish_state(raw(spark, sf), Tables(current, registered_types(spark)))
    return out.select(
        F.get_json_object("key", "$.id").alias("id"), payload("guid").alias("guid"),
        payload("updateTime").cast("bigint").alias("update_time"), payload("attributes.k").alias("k"))


def accounts(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@query("apply_document_changes", """
WITH c AS (SELECT user_id AS id, arg_max(event_type, event_id) AS name, arg_max(event_type = 'purchase', event_id) AS gone
  FROM events GROUP BY user_id)
SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT id FROM c)
UNION ALL SELECT id, name FROM c WHERE NOT gone""")
def q_apply_document_changes(spark, sf):
    changes = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("name"), "event_id",
        (F.col("event_type") == "purchase").alias("deleted"))
    return sinks.apply_document_changes(accounts(spark, sf), changes, "id", "event_id")


@query("sink_keyed_rows", """
WITH c AS (SELECT user_id AS id, arg_max(event_type, event_id) AS name FROM events GROUP BY user_id)
SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT id FROM c)
UNION ALL SELECT id, name FROM c""")
def q_sink_keyed_rows(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("name"), "event_id")
    return sinks.sink_keyed_rows(accounts(spark, sf), rows, "id", "event_id")


@query("dead_letter", f"""WITH {EV}, {CUR}, {PREV}, e AS (
  SELECT {_LOOKUP} AS kind, ms FROM en e LEFT JOIN cur c ON e.guid = c.guid
  UNION ALL SELECT 'no_previous_version', ms FROM prev WHERE op <> 'ENTITY_CREATE' AND pms IS NULL)
SELECT CASE kind WHEN 'no_previous_version' THEN 'previous_version' WHEN 'unknown_type' THEN 'lookup'
    WHEN 'lookup_failed' THEN 'lookup' ELSE 'validate' END AS stage, kind, ms AS msg_creation_time, true AS has_payload
FROM e WHERE kind IS NOT NULL""")
def q_dead_letter(spark, sf):
    current = current_entities(validated(spark, sf))
    checked = validate.enriched(raw(spark, sf), current, registered_types(spark))
    looked_up = versions.previous_version_missing(with_previous(spark, sf))
    return sinks.dead_letter(checked, looked_up).select(
        "stage", "kind", "msg_creation_time", F.col("payload").isNotNull().alias("has_payload"))


@query("typed_index_projection", """
SELECT epoch_us(ts) // 1000 AS ms, CAST(event_id AS INTEGER) AS id, event_type AS msg FROM events
UNION ALL SELECT epoch_us(ts) // 1000, NULL, props FROM events
UNION ALL SELECT NULL, CAST(user_id AS INTEGER), event_type FROM events""")
def q_typed_index_projection(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))

    def rows(stamp, ident, msg):
        return e.select(stamp.cast("string").alias("@timestamp"), F.col(ident).cast("string").alias("id"),
                        F.col(msg).alias("msg"))

    stored = (
        rows(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), "event_id", "event_type")
        .unionByName(rows(F.unix_millis("ts"), "event_type", "props"))
        .unionByName(rows(F.col("event_type"), "user_id", "event_type"))
    )
    return index_rules.typed_index_projection(stored).select(F.unix_millis("@timestamp").alias("ms"), "id", "msg")


@query("flatten_envelope", """
SELECT CAST(event_id AS VARCHAR) AS id, '{"id":"' || event_id || '","value":' || props || '}' AS msg FROM events""")
def q_flatten_envelope(spark, sf):
    messages = table(spark, sf, "events").select(
        F.concat(F.lit('{"id":"'), "event_id", F.lit('","value":'), "props", F.lit("}")).alias("value"))
    return index_rules.flatten_envelope(messages)


RETENTION_NOW = 912_470_400_000  # 1998-12-01


@query("retention_delete", f"""
SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS msg_creation_time FROM orders
WHERE epoch_us(o_orderdate) // 1000 >= {RETENTION_NOW} - 735 * CAST(86400000 AS BIGINT)""")
def q_retention_delete(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("msg_creation_time"))
    return index_rules.retention_delete(orders, RETENTION_NOW)


@query("export_entities_by_name", """
WITH chosen AS (SELECT c_custkey FROM customer WHERE contains(c_name, '7')),
o AS (SELECT o_orderkey FROM orders JOIN chosen ON o_custkey = c_custkey)
SELECT 'C' || c_custkey AS guid, 'm4i_dataset' AS type_name FROM chosen
UNION SELECT 'O' || o_orderkey, 'm4i_field' FROM o
UNION SELECT 'P' || l_partkey, 'm4i_data_attribute' FROM lineitem JOIN o ON l_orderkey = o_orderkey""")
def q_export_entities_by_name(spark, sf):
    customer, orders, part, lineitem = (table(spark, sf, n) for n in ("customer", "orders", "part", "lineitem"))

    def key(prefix, column):
        return F.concat(F.lit(prefix), F.col(column))

    def bodies(df, prefix, column, type_name, name, relations):
        guid = key(prefix, column)
        return df.select(entity(guid, F.lit(type_name), F.create_map(F.lit("qualifiedName"), quoted(name)),
                                relations).alias("body"))

    def relations(column, type_name):
        refs = F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda g: ref(g, type_name))
        return F.create_map(F.lit("related"), refs).cast(RELATIONSHIPS)

    of_customer = orders.groupBy("o_custkey").agg(F.collect_list(key("O", "o_orderkey")).alias("to"))
    of_order = lineitem.groupBy("l_orderkey").agg(F.collect_set(key("P", "l_partkey")).alias("to"))
    entities = (
        bodies(customer.join(of_customer, F.col("c_custkey") == F.col("o_custkey"), "left"), "C", "c_custkey",
               "m4i_dataset", F.col("c_name"), relations("to", "m4i_field"))
        .unionByName(bodies(orders.join(of_order, F.col("o_orderkey") == F.col("l_orderkey"), "left"), "O",
                            "o_orderkey", "m4i_field", F.col("o_orderstatus"), relations("to", "m4i_data_attribute")))
        .unionByName(bodies(part, "P", "p_partkey", "m4i_data_attribute", F.col("p_name"), F.create_map()))
    )
    out = index_rules.export_entities_by_name(cut(entities), ["m4i_dataset"], "7", full=True)
    return out.select(F.col("body.guid").alias("guid"), F.col("body.typeName").alias("type_name"))


# --------------------------------------------------------------------------- examples
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query("word_count", f"""
SELECT word, COUNT(*) AS count FROM (SELECT unnest(string_split_regex(text, '{_SPACE}')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def q_word_count(spark, sf):
    return word_count(table(spark, sf, "documents"))


@query("typed_rows_to_string", """
SELECT '{"name":"' || event_type || '","value":' || user_id || '}' AS value FROM events""")
def q_typed_rows_to_string(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("name"), F.col("user_id").cast("int").alias("value"))
    return typed_rows_to_string(rows)
