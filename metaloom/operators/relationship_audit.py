"""Relationship changes: links in both directions, and the hierarchy as seen from the parent's side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.functions.attributes import guids_of, relatives
from metaloom.functions.state import cut
from metaloom.operators.created import (
    attach_children,
    attach_descendants,
    descendants,
    flagged_refs,
    link_documents,
    link_pairs,
    unlink_documents,
)
from metaloom.operators.edits import edit, path_of, union
from metaloom.operators.validate import error
from metaloom.schemas import HIERARCHY_RULES, PATH
from metaloom.sources.documents import lookup_related_documents

SIDES = {"deleted": "old_value", "inserted": "new_value"}


def audit_noop_guard(changes: DataFrame) -> DataFrame:
    """Changes with at least one relationship attribute; lists may be empty."""
    size = F.coalesce(F.size("inserted_relationships"), F.lit(0)) + F.coalesce(
        F.size("deleted_relationships"), F.lit(0)
    )
    return changes.filter(size > 0)


def requested(side: str, rules=HIERARCHY_RULES) -> Column:
    """Guids on one side of a change, without the parents of the entity. Repeats are kept."""
    parents = relatives(SIDES[side], "parent", rules)
    return F.filter(guids_of(F.col(f"{side}_relationships")), lambda g: ~F.array_contains(parents, g))


def audit_child_side_filter(changes: DataFrame, side: str, rules=HIERARCHY_RULES) -> DataFrame:
    """References to follow, as of ``flagged_refs``. Those to parents are left to the parent's own event."""
    entity = SIDES[side]
    return flagged_refs(
        changes.filter(F.col(entity).isNotNull()), requested(side, rules), relatives(entity, "child", rules),
        relatives(entity, "parent", rules))


def audit_unlink(pairs: DataFrame) -> DataFrame:
    """Edits that remove the links of deleted references, both ways. References without a document are skipped."""
    return unlink_documents(pairs)


def resets(rules=HIERARCHY_RULES) -> Column:
    """A change that deletes references of an entity without parents puts it at the root."""
    return F.coalesce(
        F.col("old_value").isNotNull()
        & (F.size(relatives("old_value", "parent", rules)) == 0)
        & (F.size(requested("deleted", rules)) > 0),
        F.lit(False),
    )


def audit_reset_root_breadcrumb(changes: DataFrame, rules=HIERARCHY_RULES) -> DataFrame:
    return edit(changes.filter(resets(rules)), "reset", doc="guid")


def audit_detach_children(lost: DataFrame) -> DataFrame:
    """Edits that keep, of the breadcrumb of each lost child, what comes after the document."""
    return edit(lost.filter("child"), "detach", doc="ref", guid="guid")


def audit_detach_descendants(lost: DataFrame, docs: DataFrame) -> DataFrame:
    """The same for the documents below a lost child."""
    return edit(descendants(lost, docs), "detach", doc="doc", guid="guid")


def _paths(changes: DataFrame, docs: DataFrame, rules) -> DataFrame:
    """(change_id, path) for what comes below the document, after a possible reset."""
    own = F.array(F.struct(F.col("guid"), F.col("name"), F.col("typename").alias("type"))).cast(PATH)
    documents = docs.select("guid", path_of().alias("_path"), own.alias("_own"))
    return (
        changes.withColumn("_reset", resets(rules)).select("change_id", "guid", "_reset").join(documents, "guid")
        .select("change_id", F.when(F.col("_reset"), F.col("_own")).otherwise(F.concat("_path", "_own")).alias("path"))
    )


def audit_insert(changes: DataFrame, refs: DataFrame, pairs: DataFrame, docs: DataFrame, rules=HIERARCHY_RULES
                 ) -> DataFrame:
    """Edits for inserted references: links both ways, and children with all below them move under the document."""
    paths = _paths(changes, docs, rules)
    return union(link_documents(pairs), attach_children(pairs, paths), attach_descendants(refs, docs, paths))


def audit_delete_partial(changes: DataFrame, docs: DataFrame, rules=HIERARCHY_RULES) -> tuple[DataFrame, DataFrame]:
    """(documents found, incomplete lookups) for deleted references; an incomplete lookup is not an error here."""
    asked = changes.filter(F.col("old_value").isNotNull()).select(
        "change_id", requested("deleted", rules).alias("guids")
    )
    return lookup_related_documents(docs, asked, "partial")


def audit_finalize_parent(changes: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits that set the parent to the last ancestor, for documents that their own change has edited."""
    own = edits.filter(F.col("kind").isin("link", "unlink", "reset")).select("change_id", F.col("doc").alias("guid")).distinct()
    return edit(changes.join(own, ["change_id", "guid"], "left_semi"), "finalize", doc="guid")


def audit_errors(changes: DataFrame, lost: DataFrame, lost_pairs: DataFrame, docs: DataFrame, rules=HIERARCHY_RULES
                 ) -> DataFrame:
    """Changes that cannot be applied. ``lost`` are the deleted references, ``lost_pairs`` those with documents."""
    known = docs.select(F.col("guid").alias("_doc"))
    checked = changes.join(known, F.col("guid") == F.col("_doc"), "left")
    guid = F.col("guid")
    missing_entity = (F.col("deleted_relationships").isNotNull() & F.col("old_value").isNull()) | (
        F.col("inserted_relationships").isNotNull() & F.col("new_value").isNull()
    )
    problem = F.when(
        F.col("_doc").isNull(),
        error("relationships", "document_not_found", F.concat(F.lit("document not found for entity "), guid)),
    ).when(
        missing_entity,
        error("relationships", "entity_missing", F.concat(F.lit("Entity data not provided for entity "), guid)),
    )
    basic = checked.filter(F.col("_doc").isNull() | missing_entity).select("change_id", problem.alias("error"))

    # Inserted references must all have a document; for deleted ones only children must.
    asked = changes.filter(F.col("new_value").isNotNull()).select(
        "change_id", requested("inserted", rules).alias("guids")
    )
    _, incomplete = lookup_related_documents(docs, asked, "strict")
    children = lost.filter("child")
    unknown = children.join(lost_pairs.select("change_id", "ref"), ["change_id", "ref"], "left_anti").select(
        "change_id", error("relationships", "child_not_found", "a lost child has no linked document").alias("error"))
    holding = docs.select(F.col("guid").alias("ref"), F.col("breadcrumbguid").alias("_path"))
    astray = children.join(holding, "ref").filter(~F.array_contains("_path", F.col("guid"))).select(
        "change_id", error("relationships", "not_an_ancestor", "a lost child is not below the document").alias("error"))
    found = union(basic, incomplete.select("change_id", "error"), unknown, astray)
    first = found.groupBy("change_id").agg(F.min("error").alias("error"))
    return first.join(changes.select("change_id", "msg_creation_time"), "change_id").select(
        "change_id", "msg_creation_time", "error")


def audit_refs(changes: DataFrame, rules=HIERARCHY_RULES) -> DataFrame:
    """References of both sides, with ``side``."""
    return union(*[audit_child_side_filter(changes, side, rules).withColumn("side", F.lit(side)) for side in SIDES])


def relationship_audit(changes: DataFrame, docs: DataFrame, rules=HIERARCHY_RULES, refs: DataFrame | None = None
                       ) -> tuple[DataFrame, DataFrame]:
    """(edits, errors) of a set of relationship changes; ``refs`` are their references, if known already."""
    active = audit_noop_guard(changes)
    refs = cut(audit_refs(active, rules)) if refs is None else refs
    pairs = cut(link_pairs(refs, docs))
    lost, new = (refs.filter(F.col("side") == side) for side in SIDES)
    lost_pairs, new_pairs = (pairs.filter(F.col("side") == side) for side in SIDES)
    edits = cut(union(
        audit_unlink(lost_pairs),
        audit_reset_root_breadcrumb(active, rules),
        audit_detach_children(lost),
        audit_detach_descendants(lost, docs),
        audit_insert(active, new, new_pairs, docs, rules),
    ))
    return union(edits, audit_finalize_parent(active, edits)), audit_errors(active, lost, lost_pairs, docs, rules)
