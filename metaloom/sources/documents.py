"""Scans and lookups over the table of search documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.operators.validate import error
from metaloom.schemas import LINK_FIELDS


def link_field(type_column: str) -> Column:
    """Link field that holds entities of a type; null for types that are not linked."""
    cases = " ".join(f"WHEN '{name}' THEN '{field}'" for name, field in LINK_FIELDS.items())
    return F.expr(f"CASE {type_column} {cases} END")


def ancestors(docs: DataFrame, *more: str) -> DataFrame:
    """Inverted index of the breadcrumbs: (doc, guid, pos), the first position of each guid."""
    exploded = docs.select(
        F.col("guid").alias("doc"), "breadcrumbguid", *more, F.posexplode("breadcrumbguid").alias("pos", "ancestor")
    )
    return exploded.filter(F.array_position("breadcrumbguid", F.col("ancestor")) == F.col("pos") + 1).select(
        "doc", F.col("ancestor").alias("guid"), "pos", *more
    )


def links(docs: DataFrame, names: bool = True) -> DataFrame:
    """Inverted index of the link lists: (doc, field, pos, guid, name); without ``names``, these are not read."""
    lists = ", ".join(
        f"transform({f}guid, (g, i) -> named_struct('field', '{f}', 'pos', i, 'guid', g"
        + (f", 'name', get({f}, i)))" if names else "))")
        for f in LINK_FIELDS.values()
    )
    return docs.select(F.col("guid").alias("doc"), F.expr(f"inline(concat({lists}))"))


def scan_documents_by_ancestor(docs: DataFrame, guids: DataFrame) -> DataFrame:
    """Documents whose breadcrumb holds any of the guids, each once."""
    hits = ancestors(docs).join(guids.select("guid").distinct(), "guid", "left_semi").select("doc").distinct()
    return docs.join(hits.withColumnRenamed("doc", "guid"), "guid", "left_semi")


def holders(docs: DataFrame, guids_with_type: DataFrame) -> DataFrame:
    """(doc, field, guid, pos) of each document that links to a guid of the given type; first positions."""
    wanted = guids_with_type.select("guid", link_field("type_name").alias("field")).filter(
        F.col("field").isNotNull()
    )
    return (
        links(docs)
        .join(wanted.distinct(), ["guid", "field"], "left_semi")
        .groupBy("doc", "field", "guid")
        .agg(F.min("pos").alias("pos"))
    )


def scan_documents_by_link(docs: DataFrame, guids_with_type: DataFrame) -> DataFrame:
    """Documents that link to any of the (guid, type_name) pairs in the list for that type."""
    hits = holders(docs, guids_with_type).select(F.col("doc").alias("guid")).distinct()
    return docs.join(hits, "guid", "left_semi")


def lookup_document_by_guid(docs: DataFrame, guids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents found, errors for guids that have none)."""
    wanted = guids.select("guid").distinct()
    found = docs.join(wanted, "guid", "left_semi")
    missing = wanted.join(docs.select("guid"), "guid", "left_anti").withColumn(
        "error", error("lookup", "document_not_found", F.concat(F.lit("document not found for entity "), F.col("guid")))
    )
    return found, missing


def lookup_related_documents(docs: DataFrame, requested: DataFrame, policy: str = "strict",
                             distinct: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents for the requested guids of each change, plus errors.

    ``requested`` has ``change_id`` and the list ``guids``. The lookup is complete when as many documents
    were found as guids were asked for; a guid asked for twice counts twice unless ``distinct``. Changes
    with an incomplete lookup are in the errors; with ``policy='strict'`` their documents are left out,
    with ``'partial'`` they stay.
    """
    asked = requested.filter(F.size("guids") > 0).select("change_id", F.explode("guids").alias("guid"))
    # Dealt by change once, for the pairs and for all counts of a change; documents meet each guid once, however often it is asked for.
    pairs = asked.repartition("change_id").groupBy("change_id", "guid").agg(F.count(F.lit(1)).alias("times"))
    wanted = asked.select("guid").distinct()
    known = docs.select("guid").join(wanted, "guid", "left_semi").withColumn("known", F.lit(True))
    checked = pairs.join(known, "guid", "left")
    counted = checked.groupBy("change_id").agg(
        (F.count("guid") if distinct else F.sum("times")).alias("requested"), F.count("known").alias("found")
    )
    errors = (
        counted.filter(F.col("requested") != F.col("found"))
        .withColumn("error", error("lookup", "related_documents_missing",
                                   "Some related documents were not found in the index."))
    )
    found = checked.filter("known").select("change_id", "guid")
    if policy == "strict":
        found = found.join(errors.select("change_id"), "change_id", "left_anti")
    return found, errors


def scan_index_sample(df: DataFrame, n: int = 10, order_by: str | None = None) -> DataFrame:
    """First page of a match-all search; with ``order_by`` it is the same page every time."""
    return (df.orderBy(order_by) if order_by else df).limit(n)
