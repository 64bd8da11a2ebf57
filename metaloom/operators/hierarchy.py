"""Canonical breadcrumbs: every path built anew from the parent pointers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.functions.state import cut
from metaloom.operators.validate import error
from metaloom.schemas import DOCUMENT_COLUMNS, PATH


def canonical_paths(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(guid, path) from root to direct parent of each document, and (guid, error) of those that have none.

    Pointer doubling: a document knows a stretch of its ancestors, and the first of them knows the stretch before it. Joining
    the two doubles the stretch, so a depth of d takes log2(d) joins; finished documents leave the left side. A stretch that
    holds a guid twice, or the document itself, has gone round a cycle: such documents are errors, and so are those below
    them. So is a parent that is no document, for the documents below it.
    """
    own = docs.select("guid", "parentguid", F.struct("guid", "name", F.col("typename").alias("type")).alias("self"))
    up = own.select(F.col("guid").alias("parentguid"), F.col("self").alias("above"), F.lit(True).alias("found"))
    start = own.join(up, "parentguid", "left")
    missing = F.col("parentguid").isNotNull() & F.col("found").isNull()
    known = cut(start.select(
        "guid", F.when(F.col("above").isNull(), F.array()).otherwise(F.array("above")).cast(PATH).alias("path"),
        F.when(missing, "parent_missing").when(F.col("parentguid") == F.col("guid"), "cycle").alias("failed"),
        F.col("parentguid").isNull().alias("whole")))
    while True:
        open_ = known.filter("NOT whole AND failed IS NULL")
        if open_.isEmpty():
            break
        before = known.select(
            F.get("path", F.lit(0))["guid"].alias("_first"), "guid", "path", "failed", "whole").select(
            F.col("guid").alias("head"), F.col("path").alias("more"), F.col("failed").alias("bad"), F.col("whole").alias("done"))
        joined = open_.withColumn("head", F.get("path", F.lit(0))["guid"]).join(before, "head")
        longer = F.concat("more", "path")
        guids = F.transform(longer, lambda s: s["guid"])
        round_ = F.array_contains(guids, F.col("guid")) | (F.size(F.array_distinct(guids)) < F.size(guids))
        moved = joined.select(
            "guid", F.when(F.col("bad").isNull() & ~round_, longer).otherwise(F.array().cast(PATH)).alias("path"),
            F.coalesce("bad", F.when(round_, "cycle")).alias("failed"), F.col("done").alias("whole"))
        known = cut(known.filter("whole OR failed IS NOT NULL").unionByName(moved))
    messages = F.when(F.col("failed") == "cycle", "the parents of this document go round in a cycle").otherwise(
        "an ancestor of this document does not exist")
    failed = known.filter("failed IS NOT NULL").select(
        "guid", error("canonical", "cycle", messages).withField("kind", F.col("failed")).alias("error"))
    return known.filter("failed IS NULL").select("guid", "path"), failed


def canonical_breadcrumbs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents with breadcrumbs rebuilt from their parents, and errors; documents in error stay as they are."""
    paths, failed = canonical_paths(docs)
    joined = docs.join(paths, "guid", "left")
    parts = {f"breadcrumb{p}": F.coalesce(F.col(f"path.{p}"), F.col(f"breadcrumb{p}")) for p in ("guid", "name", "type")}
    return joined.withColumns(parts).select(*DOCUMENT_COLUMNS), failed
