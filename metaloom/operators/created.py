"""Search documents of created entities: the document, its links and its place in the hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.functions.attributes import all_refs, each, relatives, text
from metaloom.functions.state import cut
from metaloom.operators.edits import edit, path_through, union
from metaloom.schemas import CREATE_BLACKLIST, DOCUMENT, HIERARCHY_RULES, LISTS, PATH, PERSON_TYPE, SCORES
from metaloom.sources.documents import ancestors, link_field


def _attribute(name: str, default: Column) -> Column:
    """Attribute value, or a default when the key is missing; a null value stays null."""
    attributes = F.col("new_value.attributes")
    present = F.coalesce(F.map_contains_key(attributes, name), F.lit(False))
    return F.when(present, text(attributes, name)).otherwise(default)


def create_document(changes: DataFrame) -> DataFrame:
    """The new document of each created entity; the last one, if an entity is created twice."""
    created = changes.filter(F.col("new_value").isNotNull())
    guid, type_name = F.col("new_value.guid"), F.col("new_value.typeName")
    qualified = _attribute("qualifiedName", guid)
    own = {
        "guid": guid,
        "typename": type_name,
        "referenceablequalifiedname": qualified,
        "name": _attribute("name", qualified),
        "definition": _attribute("definition", F.lit("")),
        "email": F.when(type_name == PERSON_TYPE, _attribute("email", F.lit(None).cast("string"))),
    }
    # Only what differs between documents is shuffled; the rest of a document follows from it.
    rows = created.select("ord", F.struct(*[c.alias(n) for n, c in own.items()]).alias("doc"))
    last = rows.groupBy(F.col("doc.guid").alias("_guid")).agg(F.max_by("doc", "ord").alias("doc"))
    values = {
        **{n: F.col(f"doc.{n}") for n in own},
        "id": F.col("doc.guid"),
        "supertypenames": F.array("doc.typename"),
        **{c: F.lit(0.0) for c in SCORES},
    }
    for c in LISTS:
        values.setdefault(c, F.array().cast("array<string>"))
    return last.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DOCUMENT])


def create_person_email(changes: DataFrame) -> DataFrame:
    """(guid, email) of created persons that have the attribute."""
    has = F.coalesce(F.map_contains_key("new_value.attributes", "email"), F.lit(False))
    return changes.filter((F.col("new_value.typeName") == PERSON_TYPE) & has).select(
        "change_id", F.col("new_value.guid").alias("guid"), text(F.col("new_value.attributes"), "email").alias("email")
    )


def flagged_refs(df: DataFrame, refs: Column, children: Column, parents: Column) -> DataFrame:
    """(change_id, ord, guid, ref, child, parent): each guid in ``refs`` once.

    ``child`` tells whether it is among the children of the entity, ``parent`` whether it is its first parent.
    """
    df = df.select("change_id", "ord", "guid", refs.alias("_refs"), children.alias("_children"),
                   F.get(parents, 0).alias("_parent"))
    marked = F.concat(
        F.transform(F.array_intersect("_refs", "_children"), lambda g: F.struct(g.alias("ref"), F.lit(True).alias("child"))),
        F.transform(F.array_except("_refs", "_children"), lambda g: F.struct(g.alias("ref"), F.lit(False).alias("child"))),
    )
    return df.select("change_id", "ord", "guid", "_parent", F.inline(marked)).select(
        "change_id", "ord", "guid", "ref", "child", F.coalesce(F.col("ref") == F.col("_parent"), F.lit(False)).alias("parent"))


def create_filter_relationships(changes: DataFrame, rules=HIERARCHY_RULES) -> DataFrame:
    """References of created entities that may become links, as of ``flagged_refs``; parents are included."""
    allowed = F.filter(
        all_refs(F.col("inserted_relationships")),
        lambda r: r["guid"].isNotNull() & F.coalesce(~r["typeName"].isin(CREATE_BLACKLIST), F.lit(True)),
    )
    return flagged_refs(
        changes.filter(F.col("new_value").isNotNull()), each(allowed, "guid"), relatives("new_value", "child", rules),
        relatives("new_value", "parent", rules))


def with_created(docs: DataFrame, created: DataFrame) -> DataFrame:
    """Documents with the new ones in place of old ones of the same guid."""
    return docs.join(created.select("guid"), "guid", "left_anti").unionByName(created)


def link_pairs(refs: DataFrame, docs: DataFrame) -> DataFrame:
    """References whose both documents exist and have linkable types, with the type field and name of both."""
    mine = docs.select(
        F.col("guid"), F.col("name").alias("doc_name"), link_field("typename").alias("doc_field"),
    ).filter(F.col("doc_field").isNotNull())
    theirs = mine.toDF("ref", "ref_name", "ref_field")
    return refs.join(theirs, "ref").join(mine, "guid")


def _both_ways(pairs: DataFrame) -> DataFrame:
    there = pairs.select("change_id", "ord", F.col("guid").alias("doc"), F.col("ref_field").alias("field"),
                         F.col("ref").alias("guid"), F.col("ref_name").alias("value"))
    back = pairs.select("change_id", "ord", F.col("ref").alias("doc"), F.col("doc_field").alias("field"),
                        F.col("guid"), F.col("doc_name").alias("value"))
    return there.unionByName(back)


def link_documents(pairs: DataFrame) -> DataFrame:
    """Edits that link both documents of each pair to each other; a link that is there already stays as it is."""
    return edit(_both_ways(pairs), "link", doc="doc", field="field", guid="guid", value="value")


def unlink_documents(pairs: DataFrame) -> DataFrame:
    """Edits that remove the links of each pair, both ways; one that is not there is no loss."""
    return edit(_both_ways(pairs), "unlink", doc="doc", field="field", guid="guid")


def create_breadcrumb_from_parent(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Edits that put a created document under its first parent, if that one got linked."""
    parents = docs.select(F.col("guid").alias("ref"), path_through().alias("path"))
    return edit(pairs.filter("parent").join(parents, "ref"), "attach", doc="guid", guid="ref", path="path")


def attach_children(pairs: DataFrame, paths: DataFrame) -> DataFrame:
    """Edits that move linked children under their document. ``paths`` is (change_id, path)."""
    return edit(pairs.filter("child").join(paths, "change_id"), "attach", doc="ref", guid="guid", path="path")


def descendants(refs: DataFrame, docs: DataFrame) -> DataFrame:
    """(change_id, ord, guid, doc): documents below a child, other than children of the same change."""
    children = refs.filter("child").select("change_id", "ord", "guid", "ref")
    below = ancestors(docs).select("doc", F.col("guid").alias("ref"))
    found = below.join(children, "ref").select("change_id", "ord", "guid", "doc").distinct()
    return found.join(children.select("change_id", F.col("ref").alias("doc")), ["change_id", "doc"], "left_anti")


def attach_descendants(refs: DataFrame, docs: DataFrame, paths: DataFrame) -> DataFrame:
    """Edits that put the path of the document in front of the breadcrumbs below its new children."""
    found = descendants(refs, docs).join(paths, "change_id")
    return edit(found, "prepend", doc="doc", guid="guid", path="path")


def created_paths(refs: DataFrame, created: DataFrame, placed: DataFrame) -> DataFrame:
    """(change_id, path) for what comes below a created document; ``placed`` are its attach edits."""
    own = F.array(F.struct(F.col("guid"), F.col("name"), F.col("typename").alias("type"))).cast(PATH)
    parents = refs.filter("child").select("change_id", "guid").distinct()
    joined = parents.join(created.select("guid", own.alias("_own")), "guid").join(
        placed.select("change_id", "path"), "change_id", "left")
    return joined.select("change_id", F.coalesce(F.concat("path", "_own"), F.col("_own")).alias("path"))


def created_errors(changes: DataFrame) -> DataFrame:
    from metaloom.operators.validate import error

    return changes.filter(F.col("new_value").isNull()).select(
        "change_id", "msg_creation_time", error("created", "entity_missing", F.concat(
            F.lit("Entity data not provided for entity "), F.col("guid"))).alias("error")
    )


def entity_created(changes: DataFrame, docs: DataFrame, rules=HIERARCHY_RULES, refs: DataFrame | None = None
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with the new ones in place, edits, errors) of a set of created entities.

    ``refs`` are their references, if they are known already.
    """
    ok = changes.filter(F.col("new_value").isNotNull())
    created = cut(create_document(ok))
    base = with_created(docs, created)
    refs = cut(create_filter_relationships(ok, rules)) if refs is None else refs
    pairs = cut(link_pairs(refs, base))
    placed = create_breadcrumb_from_parent(pairs, base)
    paths = created_paths(refs, created, placed)
    edits = union(
        edit(ok, "touch", doc="guid"),
        link_documents(pairs),
        placed,
        attach_children(pairs, paths),
        attach_descendants(refs, docs, paths),
    )
    return base, edits, created_errors(changes)
