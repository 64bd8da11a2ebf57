"""Queries over the star schema as search documents: scans, lookups, and document maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.functions.state import cut
from metaloom.operators import attribute_audit, created, deleted, relationship_audit
from metaloom.operators.edits import apply_edits, union
from metaloom.plans import fold
from metaloom.plans.jobs import Tables, job_synchronize_app_search
from metaloom.plans.registry import query
from metaloom.schemas import DOCUMENT, LINK_FIELDS
from metaloom.sources import documents, sinks
from metaloom.sources.sample_catalog import (
    Star,
    arrivals,
    change,
    deletions,
    gains,
    history_of,
    losses,
    new_regions,
    registered_types,
    renames,
    returns,
    splits,
    staged,
    star_log,
    table,
)


# --------------------------------------------------------------------------- SQL building blocks
def star_sql(open_orders: bool = True, suppliers: bool = True, regions: bool = True) -> str:
    """CTEs ``nodes`` (guid, typename, name, pg, pn, pt) and ``lk`` (doc, field, guid, name)."""
    orders = "SELECT * FROM orders" + ("" if open_orders else " WHERE o_orderstatus <> 'O'")
    none = "CAST([] AS VARCHAR[])"
    root = (
        "['R' || r_regionkey] AS pg, [r_name] AS pn, ['m4i_system'] AS pt" if regions
        else f"{none} AS pg, {none} AS pn, {none} AS pt"
    )
    out = f"""
ord AS ({orders}),
nat AS (SELECT n_nationkey, 'N' || n_nationkey AS guid, n_name AS name, {root}
  FROM nation JOIN region ON n_regionkey = r_regionkey),
cus AS (SELECT c_custkey, 'C' || c_custkey AS guid, c_name AS name, list_append(pg, nat.guid) AS pg,
  list_append(pn, nat.name) AS pn, list_append(pt, 'm4i_collection') AS pt
  FROM customer JOIN nat ON c_nationkey = n_nationkey),
fld AS (SELECT o_orderkey, 'O' || o_orderkey AS guid, 'Order ' || o_orderkey AS name,
  list_append(pg, cus.guid) AS pg, list_append(pn, cus.name) AS pn, list_append(pt, 'm4i_dataset') AS pt
  FROM ord JOIN cus ON o_custkey = c_custkey),
nodes AS (
  SELECT guid, 'm4i_collection' AS typename, name, pg, pn, pt FROM nat
  UNION ALL SELECT guid, 'm4i_dataset', name, pg, pn, pt FROM cus
  UNION ALL SELECT guid, 'm4i_field', name, pg, pn, pt FROM fld
  UNION ALL SELECT 'P' || p_partkey, 'm4i_data_attribute', p_name, {none}, {none}, {none} FROM part
"""
    if suppliers:
        out += f"  UNION ALL SELECT 'S' || s_suppkey, 'm4i_person', s_name, {none}, {none}, {none} FROM supplier\n"
    if regions:
        out += f"  UNION ALL SELECT 'R' || r_regionkey, 'm4i_system', r_name, {none}, {none}, {none} FROM region\n"
    out += """),
edge AS (
  SELECT 'C' || o_custkey AS a, 'O' || o_orderkey AS b FROM ord
  UNION ALL SELECT DISTINCT 'O' || l_orderkey, 'P' || l_partkey FROM lineitem JOIN ord ON l_orderkey = o_orderkey
"""
    if suppliers:
        out += "  UNION ALL SELECT DISTINCT 'S' || l_suppkey, 'P' || l_partkey FROM lineitem\n"
    if regions:
        out += "  UNION ALL SELECT 'R' || n_regionkey, 'N' || n_nationkey FROM nation\n"
    return out + """),
tf(typ, field) AS (VALUES """ + ", ".join(f"('{t}', '{f}')" for t, f in LINK_FIELDS.items()) + """),
both_ways AS (SELECT a, b FROM edge UNION ALL SELECT b, a FROM edge),
lk AS (SELECT a AS doc, field, b AS guid, name FROM both_ways JOIN nodes ON b = guid JOIN tf ON typ = typename)
"""


DEL_SQL = """
del AS (
  SELECT 'R' || r_regionkey AS guid, 'm4i_system' AS typ FROM region WHERE r_name = 'ASIA'
  UNION ALL SELECT 'N' || n_nationkey, 'm4i_collection' FROM nation
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)
  UNION ALL SELECT 'C' || c_custkey, 'm4i_dataset' FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'P' || p_partkey, 'm4i_data_attribute' FROM part WHERE p_size = 50
  UNION ALL SELECT 'S' || s_suppkey, 'm4i_person' FROM supplier WHERE s_acctbal < 0)
"""
REN_SQL = """
ren AS (
  SELECT 'N' || n_nationkey AS guid, 'm4i_collection' AS typ, n_name || ' of ' || r_name AS new_name,
    CAST(NULL AS VARCHAR) AS new_definition FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'C' || c_custkey, 'm4i_dataset', c_name || ' (overdrawn)', c_mktsegment FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'P' || p_partkey, 'm4i_data_attribute', p_name || ' XL', NULL FROM part WHERE p_size = 50)
"""
URGENT = "SELECT 'C' || o_custkey AS owner, o_custkey, 'O' || o_orderkey AS moved FROM orders WHERE o_orderpriority = '1-URGENT'"

PATHS = """guid, array_to_string(pg, '/') AS path, array_to_string(pn, '/') AS names, array_to_string(pt, '/') AS types"""


# --------------------------------------------------------------------------- result shapes
def path_rows(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        "guid", F.array_join("breadcrumbguid", "/").alias("path"), F.array_join("breadcrumbname", "/").alias("names"),
        F.array_join("breadcrumbtype", "/").alias("types"), *more)


#: What edits of the hierarchy read and change, and what edits of links do besides.
PLACE = ("guid", "parentguid", "breadcrumbguid", "breadcrumbname", "breadcrumbtype")
LINKED = (*PLACE, *[c for f in LINK_FIELDS.values() for c in (f, f + "guid")])


def link_rows(docs: DataFrame) -> DataFrame:
    """One row per document and link list that is not empty."""
    lists = F.array(*[
        F.struct(F.lit(f).alias("field"), F.array_join(f + "guid", ",").alias("guids"),
                 F.array_join(f, ",").alias("names"))
        for f in LINK_FIELDS.values()
    ])
    return docs.select("guid", F.inline(lists)).filter(F.col("guids") != "")


def link_sql(source: str, order: str = "guid") -> str:
    return f"""SELECT doc AS guid, field, string_agg(guid, ',' ORDER BY {order}) AS guids,
  string_agg(name, ',' ORDER BY {order}) AS names FROM {source} GROUP BY doc, field"""


# --------------------------------------------------------------------------- scans and lookups
def gone(spark, sf) -> DataFrame:
    return deletions(spark, sf).select("guid", "type_name")


@query("scan_documents_by_ancestor", f"""WITH {star_sql()}, {DEL_SQL}
SELECT guid, name FROM nodes WHERE guid IN (
  SELECT n.guid FROM (SELECT guid, unnest(pg) AS a FROM nodes) n JOIN del ON n.a = del.guid)""")
def q_scan_documents_by_ancestor(spark, sf):
    return documents.scan_documents_by_ancestor(Star(spark, sf).documents(), gone(spark, sf)).select("guid", "name")


@query("scan_documents_by_link", f"""WITH {star_sql()}, {DEL_SQL}
SELECT guid, name FROM nodes WHERE guid IN (
  SELECT doc FROM lk JOIN del ON lk.guid = del.guid JOIN tf ON tf.typ = del.typ AND tf.field = lk.field)""")
def q_scan_documents_by_link(spark, sf):
    return documents.scan_documents_by_link(Star(spark, sf).documents(), gone(spark, sf)).select("guid", "name")


@query("lookup_document_by_guid", """
SELECT g AS guid, s_name AS name, CASE WHEN s_suppkey IS NULL THEN 'document_not_found' END AS error_kind
FROM (SELECT DISTINCT user_id, 'S' || user_id AS g FROM events) LEFT JOIN supplier ON user_id = s_suppkey""")
def q_lookup_document_by_guid(spark, sf):
    guids = table(spark, sf, "events").select(F.concat(F.lit("S"), "user_id").alias("guid"))
    found, missing = documents.lookup_document_by_guid(Star(spark, sf).documents(), guids)
    return found.select("guid", "name", F.lit(None).cast("string").alias("error_kind")).unionByName(
        missing.select("guid", F.lit(None).cast("string").alias("name"), F.col("error.kind").alias("error_kind")))


@query("lookup_related_documents", """
WITH asked AS (SELECT event_id, user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events),
one AS (SELECT event_id, unnest([user_id, k]) AS key FROM asked),
hit AS (SELECT DISTINCT event_id, key FROM one JOIN supplier ON key = s_suppkey),
full_ids AS (SELECT event_id FROM hit GROUP BY event_id HAVING count(*) = 2)
SELECT event_id AS change_id, 'S' || key AS guid, 'partial' AS policy FROM hit
UNION ALL SELECT event_id, 'S' || key, 'strict' FROM hit WHERE event_id IN (SELECT event_id FROM full_ids)
UNION ALL SELECT event_id, NULL, 'incomplete' FROM asked WHERE event_id NOT IN (SELECT event_id FROM full_ids)""")
def q_lookup_related_documents(spark, sf):
    docs = Star(spark, sf).documents()
    k = F.get_json_object("props", "$.k")
    asked = table(spark, sf, "events").select(
        F.col("event_id").alias("change_id"),
        F.array(F.concat(F.lit("S"), "user_id"), F.concat(F.lit("S"), k)).alias("guids"))
    partial, incomplete = documents.lookup_related_documents(docs, asked, "partial")
    strict, _ = documents.lookup_related_documents(docs, asked, "strict")
    return union(
        partial.select("change_id", "guid", F.lit("partial").alias("policy")),
        strict.select("change_id", "guid", F.lit("strict").alias("policy")),
        incomplete.select("change_id", F.lit(None).cast("string").alias("guid"), F.lit("incomplete").alias("policy")),
    )


# --------------------------------------------------------------------------- created entities
def before_arrivals(spark, sf) -> DataFrame:
    return Star(spark, sf, open_orders=False, suppliers=False).documents()


ARRIVED = star_sql(open_orders=False, suppliers=False) + """,
sup AS (SELECT 'S' || s_suppkey AS guid, s_acctbal >= 0 AS solvent, s_name FROM supplier),
made AS (
  SELECT 'O' || o_orderkey AS guid, 'm4i_field' AS typename, 'Order ' || o_orderkey AS name, o_orderpriority AS qualified,
    '' AS definition, CAST(NULL AS VARCHAR) AS email FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT guid, 'm4i_person', CASE WHEN solvent THEN s_name ELSE guid END, guid,
    CASE WHEN NOT solvent THEN '' END, CASE WHEN solvent THEN lower(s_name) || '@example.org' END FROM sup),
new_refs AS (
  SELECT 'O' || o_orderkey AS guid, 'C' || o_custkey AS ref FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT DISTINCT 'O' || l_orderkey, 'P' || l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'O'
  UNION ALL SELECT DISTINCT 'S' || l_suppkey, 'P' || l_partkey FROM lineitem)
"""


@query("create_document", f"""WITH {ARRIVED}
SELECT guid, guid AS id, typename, name, qualified, definition, typename AS supertypes, email, CAST(0 AS DOUBLE) AS score,
  CAST(0 AS INTEGER) AS depth, CAST(NULL AS VARCHAR) AS parentguid FROM made""")
def q_create_document(spark, sf):
    return created.create_document(arrivals(spark, sf)).select(
        "guid", "id", "typename", "name", F.col("referenceablequalifiedname").alias("qualified"), "definition",
        F.array_join("supertypenames", ",").alias("supertypes"), "email", F.col("dqscore_overall").alias("score"),
        F.size("breadcrumbguid").alias("depth"), "parentguid")


@query("create_person_email", f"""WITH {ARRIVED} SELECT guid, email FROM made WHERE email IS NOT NULL""")
def q_create_person_email(spark, sf):
    return created.create_person_email(arrivals(spark, sf)).select("guid", "email")


@query("create_filter_relationships", f"""WITH {ARRIVED} SELECT guid, ref FROM new_refs
UNION ALL SELECT guid, 'X' || substr(guid, 2) FROM sup""")
def q_create_filter_relationships(spark, sf):
    return created.create_filter_relationships(arrivals(spark, sf)).select("guid", "ref")


def arrived(spark, sf):
    changes = arrivals(spark, sf)
    base = created.with_created(before_arrivals(spark, sf), created.create_document(changes))
    return base, cut(created.link_pairs(created.create_filter_relationships(changes), base))


@query("link_documents", f"""WITH {ARRIVED},
pair AS (SELECT guid AS doc, ref AS guid FROM new_refs UNION ALL SELECT ref, guid FROM new_refs),
everyone AS (SELECT guid, typename, name FROM nodes UNION ALL SELECT guid, typename, name FROM made),
entry AS (
  SELECT doc, field, guid, name, 0 AS fresh FROM lk WHERE doc IN (SELECT doc FROM pair)
  UNION ALL SELECT doc, field, guid, name, 1 FROM pair JOIN everyone USING (guid) JOIN tf ON typ = typename)
{link_sql('entry', 'fresh, guid')}""")
def q_link_documents(spark, sf):
    base, pairs = arrived(spark, sf)
    return link_rows(apply_edits(base.select(*LINKED), created.link_documents(pairs)))


@query("create_breadcrumb_from_parent", f"""WITH {star_sql()}
SELECT {PATHS}, pg[len(pg)] AS parentguid FROM nodes WHERE guid IN (
  SELECT 'O' || o_orderkey FROM orders WHERE o_orderstatus = 'O')""")
def q_create_breadcrumb_from_parent(spark, sf):
    base, pairs = arrived(spark, sf)
    return path_rows(apply_edits(base.select(*PLACE), created.create_breadcrumb_from_parent(pairs, base)), "parentguid")


def region_parts(spark, sf):
    changes, docs = new_regions(spark, sf), Star(spark, sf, regions=False).documents()
    documents_made = created.create_document(changes)
    base = created.with_created(docs, documents_made)
    refs = created.create_filter_relationships(changes)
    pairs = cut(created.link_pairs(refs, base))
    paths = created.created_paths(refs, documents_made, created.create_breadcrumb_from_parent(pairs, base))
    return docs, base, refs, pairs, paths


@query("attach_children", f"""WITH {star_sql()}
SELECT {PATHS}, pg[len(pg)] AS parentguid FROM nodes WHERE typename = 'm4i_collection'""")
def q_attach_children(spark, sf):
    _, base, _, pairs, paths = region_parts(spark, sf)
    return path_rows(apply_edits(base.select(*PLACE), created.attach_children(pairs, paths)), "parentguid")


@query("attach_descendants", f"""WITH {star_sql()}
SELECT {PATHS}, pg[len(pg)] AS parentguid FROM nodes WHERE typename IN ('m4i_dataset', 'm4i_field')""")
def q_attach_descendants(spark, sf):
    docs, base, refs, _, paths = region_parts(spark, sf)
    return path_rows(apply_edits(base.select(*PLACE), created.attach_descendants(refs, docs, paths)), "parentguid")


# --------------------------------------------------------------------------- attribute changes
@query("update_attributes", f"""WITH {star_sql()}, {REN_SQL}
SELECT guid, new_name AS name, new_definition AS definition FROM ren JOIN nodes USING (guid)""")
def q_update_attributes(spark, sf):
    changes, docs = renames(spark, sf), Star(spark, sf).documents()
    edits = fold.message_atomicity(
        attribute_audit.update_attributes(changes), attribute_audit.attribute_errors(changes, docs))
    return apply_edits(docs, edits).select("guid", "name", "definition")


@query("rename_in_breadcrumbs", f"""WITH {star_sql()}, {REN_SQL},
step AS (SELECT guid, unnest(pg) AS g, unnest(pn) AS n, unnest(range(len(pg))) AS i FROM nodes),
renamed AS (SELECT step.guid, string_agg(COALESCE(new_name, n), '/' ORDER BY i) AS names, bool_or(new_name IS NOT NULL) AS hit
  FROM step LEFT JOIN ren ON step.g = ren.guid GROUP BY step.guid)
SELECT guid, array_to_string(pg, '/') AS path, names, array_to_string(pt, '/') AS types FROM renamed JOIN nodes USING (guid)
WHERE hit""")
def q_rename_in_breadcrumbs(spark, sf):
    docs = Star(spark, sf).documents()
    return path_rows(apply_edits(docs.select(*PLACE), attribute_audit.rename_in_breadcrumbs(renames(spark, sf), docs)))


@query("rename_in_links", f"""WITH {star_sql()}, {REN_SQL},
hit AS (SELECT DISTINCT doc FROM lk JOIN ren ON lk.guid = ren.guid JOIN tf ON tf.typ = ren.typ AND tf.field = lk.field),
entry AS (SELECT doc, field, lk.guid, COALESCE(new_name, name) AS name FROM lk LEFT JOIN ren USING (guid)
  WHERE doc IN (SELECT doc FROM hit))
{link_sql('entry')}""")
def q_rename_in_links(spark, sf):
    docs = Star(spark, sf).documents()
    return link_rows(apply_edits(docs.select(*LINKED), attribute_audit.rename_in_links(renames(spark, sf), docs)))


# --------------------------------------------------------------------------- deleted entities
_CUT = f"""{star_sql()}, {DEL_SQL},
cut AS (SELECT n.guid, max(i) AS p FROM (SELECT guid, unnest(pg) AS g, unnest(range(1, len(pg) + 1)) AS i FROM nodes) n
  JOIN del ON n.g = del.guid GROUP BY n.guid),
trimmed AS (SELECT guid, pg[p + 1:] AS pg, pn[p + 1:] AS pn, pt[p + 1:] AS pt, pg[len(pg)] AS parentguid
  FROM cut JOIN nodes USING (guid))"""


@query("delete_truncate_breadcrumbs", f"""WITH {_CUT}
SELECT {PATHS}, parentguid, pg[len(pg)] AS fixed_parent FROM trimmed""")
def q_delete_truncate_breadcrumbs(spark, sf):
    truncated = deleted.delete_truncate_breadcrumbs(deletions(spark, sf), Star(spark, sf).documents().select(*PLACE))
    fixed = F.get("breadcrumbguid", F.size("breadcrumbguid") - 1)
    return path_rows(truncated.withColumn("fixed_parent", fixed), "parentguid", "fixed_parent")


@query("delete_unlink", f"""WITH {star_sql()}, {DEL_SQL},
hit AS (SELECT DISTINCT doc FROM lk JOIN del ON lk.guid = del.guid JOIN tf ON tf.typ = del.typ AND tf.field = lk.field),
entry AS (SELECT * FROM lk WHERE doc IN (SELECT doc FROM hit) AND guid NOT IN (SELECT guid FROM del))
{link_sql('entry')}""")
def q_delete_unlink(spark, sf):
    docs = Star(spark, sf).documents()
    return link_rows(apply_edits(docs.select(*LINKED), deleted.delete_unlink(deletions(spark, sf), docs)))


@query("tombstone", f"""WITH {DEL_SQL} SELECT guid, CAST(NULL AS VARCHAR) AS document FROM del""")
def q_tombstone(spark, sf):
    return deleted.tombstone(deletions(spark, sf)).select("guid", F.lit(None).cast("string").alias("document"))


def after_deletions(spark, sf) -> DataFrame:
    docs = Star(spark, sf).documents()
    edits, tombstones, errors = deleted.entity_deleted(deletions(spark, sf), docs)
    return fold.flatten_documents(docs, fold.message_atomicity(edits, errors), tombstones)


_FLAT = f"""{_CUT},
linked AS (SELECT DISTINCT doc AS guid FROM lk JOIN del ON lk.guid = del.guid JOIN tf ON tf.typ = del.typ AND tf.field = lk.field),
touched AS (SELECT guid FROM cut UNION SELECT guid FROM linked),
flat AS (
  SELECT n.guid, n.name, COALESCE(t.pg, n.pg) AS pg, false AS deleted FROM touched JOIN nodes n USING (guid)
    LEFT JOIN trimmed t USING (guid) WHERE guid NOT IN (SELECT guid FROM del)
  UNION ALL SELECT guid, NULL, NULL, true FROM del)"""


@query("flatten_documents", f"""WITH {_FLAT}
SELECT guid, name, array_to_string(pg, '/') AS path, deleted FROM flat""")
def q_flatten_documents(spark, sf):
    return after_deletions(spark, sf).select(
        "guid", "name", F.array_join("breadcrumbguid", "/").alias("path"), "deleted")


@query("sink_document_upserts", f"""WITH {_FLAT}
SELECT guid AS id, CASE WHEN NOT deleted THEN guid END AS guid, name,
  CASE WHEN NOT deleted THEN '[' || array_to_string(list_transform(pg, lambda g: '"' || g || '"'), ',') || ']' END AS path,
  deleted AS no_value, true AS key_is_value FROM flat""")
def q_sink_document_upserts(spark, sf):
    out = sinks.sink_document_upserts(after_deletions(spark, sf))
    # The text of a document is read once for all that is asked of it.
    read = out.select(
        F.get_json_object("key", "$.id").alias("id"), (F.col("key") == F.col("value")).alias("key_is_value"),
        F.from_json("value", "value struct<guid:string,name:string,breadcrumbguid:string>")["value"].alias("document"))
    return read.select(
        "id", "document.guid", "document.name", F.col("document.breadcrumbguid").alias("path"),
        F.col("document").isNull().alias("no_value"), "key_is_value")


@query("apply_published_documents", f"""WITH {_FLAT}
SELECT guid, name, array_to_string(pg, '/') AS path FROM nodes WHERE guid NOT IN (SELECT guid FROM flat)
UNION ALL SELECT guid, name, array_to_string(pg, '/') FROM flat WHERE NOT deleted""")
def q_apply_published_documents(spark, sf):
    """The document table kept up to date from the text that was published for a topic."""
    published = sinks.sink_document_upserts(after_deletions(spark, sf)).withColumn("offset", F.lit(1))
    changes, _ = sinks.parse_document_changes(published, "offset")  # what a sink wrote is readable
    docs = sinks.apply_document_changes(Star(spark, sf).documents(), changes, "guid", "offset")
    return docs.select("guid", "name", F.array_join("breadcrumbguid", "/").alias("path"))


# --------------------------------------------------------------------------- relationship changes
LOST = f"urgent AS ({URGENT})"


@query("audit_noop_guard", f"""WITH {LOST}
SELECT DISTINCT owner || '_1000_1' AS change_id FROM urgent
UNION ALL SELECT DISTINCT 'C' || c_custkey || '_3000_1' FROM urgent JOIN customer ON c_custkey = o_custkey + 1""")
def q_audit_noop_guard(spark, sf):
    # Attribute changes have no relationship maps, so all of them are held back.
    everything = union(losses(spark, sf), gains(spark, sf), renames(spark, sf))
    return relationship_audit.audit_noop_guard(everything).select("change_id")


@query("audit_child_side_filter", f"""WITH {LOST}
SELECT owner AS guid, moved AS ref, 'deleted' AS side FROM urgent
UNION ALL SELECT DISTINCT owner, 'X' || o_custkey, 'deleted' FROM urgent JOIN customer ON c_custkey = o_custkey
  WHERE c_acctbal < 0
UNION ALL SELECT 'C' || c_custkey, moved, 'inserted' FROM urgent JOIN customer ON c_custkey = o_custkey + 1
UNION ALL SELECT DISTINCT 'C' || c_custkey, 'X' || c_custkey, 'inserted' FROM urgent JOIN customer
  ON c_custkey = o_custkey + 1 WHERE c_acctbal < 0
UNION ALL SELECT DISTINCT 'O' || l_orderkey, 'P' || l_partkey, 'deleted' FROM lineitem WHERE l_returnflag = 'R'""")
def q_audit_child_side_filter(spark, sf):
    parts = [(losses, "deleted"), (gains, "inserted"), (returns, "deleted")]
    return union(*[
        relationship_audit.audit_child_side_filter(make(spark, sf), side).select(
            "guid", "ref", F.lit(side).alias("side"))
        for make, side in parts
    ])


def lost_refs(changes, docs):
    lost = relationship_audit.audit_child_side_filter(changes, "deleted")
    return lost, cut(created.link_pairs(lost, docs))


@query("audit_unlink", f"""WITH {star_sql()}, {LOST},
back AS (SELECT DISTINCT 'O' || l_orderkey AS a, 'P' || l_partkey AS b FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT owner, moved FROM urgent),
removed AS (SELECT a AS doc, b AS guid FROM back UNION ALL SELECT b, a FROM back),
entry AS (SELECT * FROM lk WHERE doc IN (SELECT doc FROM removed)
  AND NOT EXISTS (SELECT 1 FROM removed r WHERE r.doc = lk.doc AND r.guid = lk.guid))
{link_sql('entry')}""")
def q_audit_unlink(spark, sf):
    docs = Star(spark, sf).documents()
    lost, pairs = lost_refs(losses(spark, sf).unionByName(returns(spark, sf)), docs)
    return link_rows(apply_edits(docs.select(*LINKED), relationship_audit.audit_unlink(pairs)))


@query("audit_reset_root_breadcrumb", f"""WITH {LOST}
SELECT DISTINCT owner AS guid, '' AS path, '' AS names, '' AS types, CAST(NULL AS VARCHAR) AS parentguid
FROM urgent JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < 0""")
def q_audit_reset_root_breadcrumb(spark, sf):
    edits = relationship_audit.audit_reset_root_breadcrumb(losses(spark, sf))
    return path_rows(apply_edits(Star(spark, sf).documents().select(*PLACE), edits), "parentguid")


@query("audit_detach_children", f"""WITH {LOST}
SELECT moved AS guid, '' AS path, '' AS names, '' AS types, CAST(NULL AS VARCHAR) AS parentguid FROM urgent""")
def q_audit_detach_children(spark, sf):
    lost = relationship_audit.audit_child_side_filter(losses(spark, sf), "deleted")
    return path_rows(
        apply_edits(Star(spark, sf).documents().select(*PLACE), relationship_audit.audit_detach_children(lost)), "parentguid")


@query("audit_detach_descendants", f"""WITH {star_sql(regions=False)}
SELECT {PATHS}, pg[len(pg)] AS parentguid FROM nodes WHERE typename IN ('m4i_dataset', 'm4i_field')""")
def q_audit_detach_descendants(spark, sf):
    docs = Star(spark, sf).documents()
    lost = relationship_audit.audit_child_side_filter(splits(spark, sf), "deleted")
    return path_rows(apply_edits(docs.select(*PLACE), relationship_audit.audit_detach_descendants(lost, docs)), "parentguid")


GAINED = f"""{star_sql()}, {LOST},
taken AS (SELECT 'C' || c_custkey AS doc, moved FROM urgent JOIN customer ON c_custkey = o_custkey + 1 WHERE c_acctbal >= 0)"""


@query("audit_insert", f"""WITH {GAINED},
more AS (SELECT doc, moved AS guid, 1 AS fresh FROM taken UNION ALL SELECT moved, doc, 1 FROM taken),
entry AS (SELECT doc, guid, 0 AS fresh FROM lk WHERE field IN ('derivedfield', 'deriveddataset') UNION ALL SELECT * FROM more),
lists AS (SELECT doc, string_agg(guid, ',' ORDER BY fresh, guid) AS linked FROM entry
  WHERE doc IN (SELECT doc FROM more) GROUP BY doc),
place AS (SELECT moved AS guid, list_append(c.pg, c.guid) AS pg, list_append(c.pn, c.name) AS pn FROM taken
  JOIN cus c ON taken.doc = c.guid)
SELECT n.guid, array_to_string(COALESCE(p.pg, n.pg), '/') AS path, array_to_string(COALESCE(p.pn, n.pn), '/') AS names,
  array_to_string(n.pt, '/') AS types, COALESCE(p.pg, n.pg)[len(n.pg)] AS parentguid, linked
FROM lists JOIN nodes n ON n.guid = lists.doc LEFT JOIN place p ON p.guid = n.guid""")
def q_audit_insert(spark, sf):
    changes, docs = gains(spark, sf), Star(spark, sf).documents()
    refs = cut(relationship_audit.audit_child_side_filter(changes, "inserted"))
    pairs = cut(created.link_pairs(refs, docs))
    lost, lost_pairs = lost_refs(changes, docs)
    edits = fold.message_atomicity(
        relationship_audit.audit_insert(changes, refs, pairs, docs),
        relationship_audit.audit_errors(changes, lost, lost_pairs, docs))
    after = apply_edits(docs.select(*LINKED), edits).withColumn(
        "linked", F.array_join(F.concat("derivedfieldguid", "deriveddatasetguid"), ","))
    return path_rows(after, "parentguid", "linked")


@query("audit_delete_partial", f"""WITH {LOST}
SELECT owner || '_1000_1' AS change_id, moved AS guid FROM urgent
UNION ALL SELECT DISTINCT owner || '_1000_1', 'incomplete' FROM urgent JOIN customer ON c_custkey = o_custkey
  WHERE c_acctbal < 0""")
def q_audit_delete_partial(spark, sf):
    found, incomplete = relationship_audit.audit_delete_partial(losses(spark, sf), Star(spark, sf).documents())
    return found.select("change_id", "guid").unionByName(
        incomplete.select("change_id", F.lit("incomplete").alias("guid")))


@query("audit_finalize_parent", f"""WITH {star_sql()}, {LOST}
SELECT DISTINCT c.guid, CASE WHEN c_acctbal >= 0 THEN pg[len(pg)] END AS parentguid
FROM urgent JOIN customer ON c_custkey = o_custkey JOIN cus c ON c.guid = owner""")
def q_audit_finalize_parent(spark, sf):
    changes, docs = losses(spark, sf), Star(spark, sf).documents()
    _, pairs = lost_refs(changes, docs)
    edits = cut(relationship_audit.audit_unlink(pairs).unionByName(
        relationship_audit.audit_reset_root_breadcrumb(changes)))
    final = relationship_audit.audit_finalize_parent(changes, edits)
    after = apply_edits(docs.select("typename", *LINKED), edits.unionByName(final))
    return after.filter(F.col("typename") == "m4i_dataset").select("guid", "parentguid")


@query("message_atomicity", f"""WITH {LOST},
made AS (SELECT 'C' || c_custkey AS owner_now, moved FROM urgent JOIN customer ON c_custkey = o_custkey + 1 WHERE c_acctbal >= 0)
SELECT owner_now || '_3000_1' AS change_id, owner_now AS doc, 'derivedfield' AS field, moved AS guid FROM made
UNION ALL SELECT owner_now || '_3000_1', moved, 'deriveddataset', owner_now FROM made""")
def q_message_atomicity(spark, sf):
    changes, docs = gains(spark, sf), Star(spark, sf).documents()
    edits, errors = relationship_audit.relationship_audit(changes, docs)
    return fold.message_atomicity(edits, errors).filter("kind = 'link'").select("change_id", "doc", "field", "guid")




@query("dispatch_change", f"""WITH {star_sql()}, {DEL_SQL}, {REN_SQL},
step AS (SELECT guid, unnest(pg) AS g FROM nodes)
SELECT 'attr' AS kind, guid AS doc, 'name' AS field, CAST(NULL AS VARCHAR) AS guid, new_name AS value FROM ren
UNION ALL SELECT 'attr', guid, 'definition', NULL, new_definition FROM ren WHERE new_definition IS NOT NULL
UNION ALL SELECT 'crumb_name', step.guid, NULL, g, new_name FROM step JOIN ren ON g = ren.guid
UNION ALL SELECT 'relink', doc, lk.field, lk.guid, new_name FROM lk JOIN ren ON lk.guid = ren.guid
UNION ALL SELECT 'crumb_cut', step.guid, NULL, g, NULL FROM step JOIN del ON g = del.guid
UNION ALL SELECT 'unlink', doc, lk.field, lk.guid, NULL FROM lk JOIN del ON lk.guid = del.guid
UNION ALL SELECT 'tombstone', guid, NULL, NULL, NULL FROM del
UNION ALL SELECT DISTINCT 'document_not_found', 'U' || user_id || '_5000_0', NULL, NULL, NULL FROM events
UNION ALL SELECT 'name_missing', 'S' || s_suppkey || '_4000_0', NULL, NULL, NULL FROM supplier WHERE s_acctbal < 0
UNION ALL SELECT 'not_implemented', 'O' || o_orderkey || '_1_0', NULL, NULL, NULL FROM orders""")
def q_dispatch_change(spark, sf):
    """All edits, tombstones and errors of mixed changes, row by row."""
    unknown = change(table(spark, sf, "orders"), "EntityMoved", F.concat(F.lit("O"), "o_orderkey"), "m4i_field", 1)
    changes = union(renames(spark, sf), deletions(spark, sf), unknown)
    _, edits, tombstones, errors = fold.dispatch_change(changes, Star(spark, sf).documents())
    none = F.lit(None).cast("string")
    return union(
        edits.select("kind", "doc", "field", "guid", "value"),
        tombstones.select(F.lit("tombstone").alias("kind"), F.col("guid").alias("doc"), none.alias("field"), none.alias("guid"), none.alias("value")),
        errors.select(F.col("error.kind").alias("kind"), F.col("change_id").alias("doc"), none.alias("field"), none.alias("guid"), none.alias("value")))


# --------------------------------------------------------------------------- the whole job
@query("job_synchronize_app_search", f"""WITH {LOST},
who AS (SELECT c_custkey, 'C' || c_custkey AS guid, c_name AS name, c_acctbal < 0 AS gone FROM customer),
owner AS (
  SELECT 'O' || o_orderkey AS guid, 'Order ' || o_orderkey AS name, h.guid AS cguid, h.name AS cname, u.moved IS NULL AS own,
    CASE WHEN u.moved IS NULL THEN 'C' || orders.o_custkey ELSE h.guid END AS parentguid
  FROM orders LEFT JOIN urgent u ON 'O' || o_orderkey = u.moved
  LEFT JOIN who h ON NOT h.gone AND h.c_custkey = CASE WHEN u.moved IS NULL THEN orders.o_custkey ELSE orders.o_custkey + 1 END),
live_part AS (SELECT 'P' || p_partkey AS guid, p_name AS name FROM part WHERE p_size <> 50),
op AS (SELECT DISTINCT 'O' || l_orderkey AS o, 'P' || l_partkey AS p FROM lineitem),
op_o AS (SELECT o, string_agg(p, ',' ORDER BY p) AS parts FROM op JOIN live_part ON p = guid GROUP BY o),
op_p AS (SELECT p, string_agg(o, ',' ORDER BY o) AS fields FROM op GROUP BY p),
c_f AS (SELECT cguid, string_agg(guid, ',' ORDER BY own DESC, guid) AS fields FROM owner WHERE cguid IS NOT NULL GROUP BY cguid)
SELECT guid, 'm4i_field' AS typename, name, COALESCE(cguid, '') AS path, COALESCE(cname, '') AS names, parentguid,
  COALESCE(cguid, '') AS datasets, '' AS fields, COALESCE(parts, '') AS parts FROM owner LEFT JOIN op_o ON o = guid
UNION ALL SELECT guid, 'm4i_data_attribute', name, '', '', NULL, '', COALESCE(fields, ''), '' FROM live_part
  LEFT JOIN op_p ON p = guid
UNION ALL SELECT guid, 'm4i_dataset', name, '', '', NULL, '', COALESCE(fields, ''), '' FROM who
  LEFT JOIN c_f ON cguid = guid WHERE NOT gone""")
def q_job_synchronize_app_search(spark, sf):
    raw = staged(spark, sf, "star_log", lambda: star_log(spark, sf))
    history = staged(spark, sf, "star_history", lambda: history_of(raw))
    empty = spark.createDataFrame([], DOCUMENT)
    tables = Tables(history, registered_types(spark), None, empty, "as_of")
    docs, _, _ = job_synchronize_app_search(raw, tables)
    return docs.select(
        "guid", "typename", "name", F.array_join("breadcrumbguid", "/").alias("path"),
        F.array_join("breadcrumbname", "/").alias("names"), "parentguid",
        *[F.array_join(f + "guid", ",").alias(a) for f, a in
          (("deriveddataset", "datasets"), ("derivedfield", "fields"), ("deriveddataattribute", "parts"))])
