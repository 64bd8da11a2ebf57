"""Steps that large tables need: what is shuffled, sorted and read, and how often."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from metaloom.functions.packing import pack, unpack
from metaloom.functions.skew import SETTINGS
from metaloom.operators.created import create_document
from metaloom.operators.edits import apply_edits
from metaloom.operators.link_edges import apply_link_edits, edges_of
from metaloom.plans.event_queries import with_asof
from metaloom.plans.star_queries import PLACE, q_sink_document_upserts
from metaloom.schemas import LINK_FIELDS
from metaloom.sources.documents import lookup_related_documents
from metaloom.sources.keyed_store import KeyedStore
from metaloom.sources.postings import document_store, posting_changes, posting_store, postings
from metaloom.sources.sample_catalog import Star, listed
from metaloom.sources.sinks import apply_document_changes
from metaloom.streaming.publish import numbered
from tests.build import changes, created, doc, docs

FIELD = list(LINK_FIELDS.values())[0]


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def kept(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.schema(df.schema).parquet(str(path))


def link_edits(spark, *rows):
    order = F.struct(F.lit(1).cast("bigint").alias("ms"), F.lit("").alias("pos"), F.lit("g").alias("guid"), F.lit(0).alias("seq"), F.lit("").alias("digest"))
    df = spark.createDataFrame(list(rows), "doc string, kind string, field string, guid string, value string")
    return df.select("doc", F.lit("c").alias("change_id"), order.alias("ord"), "kind", "field", "guid", F.lit(None).cast("int").alias("pos"), "value",
                     F.lit(None).cast("array<struct<guid:string,name:string,type:string>>").alias("path"))


def test_links_meet_their_edits_in_one_reading(spark, tmp_path):
    edges = kept(spark, edges_of(docs(spark, doc("a", **{FIELD + "guid": ["x", "y", "x", None], FIELD: ["X", "Y", "X2", "N"]}))), tmp_path / "edges")
    edits = link_edits(spark, ("a", "unlink", FIELD, "x", None), ("a", "relink", FIELD, "y", "Y2"), ("a", "link", FIELD, "z", "Z"),
                       ("a", "unlink", FIELD, None, None), ("a", "link", FIELD, None, "M"), ("b", "unlink", FIELD, "q", None))
    after = apply_link_edits(edges, kept(spark, edits, tmp_path / "edits"), 1)
    assert sorted((r.doc, r.guid or "", r.name) for r in after.collect()) == [
        ("a", "", "M"), ("a", "", "N"), ("a", "x", "X2"), ("a", "y", "Y2"), ("a", "z", "Z")]
    assert len(re.findall(r"FileScan|Scan parquet", plan(after))) == 2


def test_a_link_that_is_removed_and_made_again_moves_to_the_end(spark):
    edges = edges_of(docs(spark, doc("a", **{FIELD + "guid": ["x", "y"], FIELD: ["X", "Y"]})))
    after = apply_link_edits(edges, link_edits(spark, ("a", "unlink", FIELD, "x", None), ("a", "link", FIELD, "x", "New")), 1)
    assert [(r.guid, r.name) for r in after.orderBy("place").collect()] == [("y", "Y"), ("x", "New")]


def test_changes_of_the_index_read_each_side_once(spark, tmp_path):
    before = kept(spark, docs(spark, doc("a", path=[("p", "P", "t"), ("q", "Q", "t")], **{FIELD + "guid": ["x"], FIELD: ["X"]}), doc("b", path=[("p", "P", "t")])), tmp_path / "before")
    after = kept(spark, docs(spark, doc("a", path=[("q", "Q", "t")], **{FIELD + "guid": ["x", "y"], FIELD: ["X", "Y"]}), doc("b", path=[("p", "P", "t")])), tmp_path / "after")
    found = posting_changes(before, after)
    assert sorted((r.guid, r.doc, r.field, r.pos, r.deleted) for r in found.collect()) == [
        ("p", "a", "breadcrumb", 0, True), ("q", "a", "breadcrumb", 0, False), ("y", "a", FIELD, 1, False)]
    assert len(re.findall(r"FileScan|Scan parquet", plan(found))) <= 4  # breadcrumbs and links of two tables


def test_published_rows_are_sorted_once(spark):
    rows = spark.createDataFrame([(f"k{i}", "v", 0) for i in range(9)], "key string, value string, wave int")
    assert "Window" not in plan(numbered(rows, 0)[0])


def test_edits_of_places_need_no_other_columns(spark):
    base = docs(spark, doc("a", path=[("p", "P", "t")], parent="p")).select(*PLACE)
    moved = apply_edits(base, link_edits(spark, ("a", "reset", None, None, None)))
    assert [(r.guid, r.parentguid, r.breadcrumbguid) for r in moved.collect()] == [("a", None, [])]
    assert set(moved.columns) == set(PLACE)


def test_created_documents_shuffle_what_differs(spark):
    made = create_document(changes(spark, created("a", attributes={"name": "A"}, ms=1), created("a", attributes={"name": "B"}, ms=2)))
    assert [(r.guid, r.id, r.name, r.dqscore_overall, r.derivedfield) for r in made.collect()] == [("a", "a", "B", 0.0, [])]
    assert "dqscore_overall" not in "".join(x for x in plan(made).splitlines() if "max_by" in x)


def test_lookups_are_dealt_by_change_once(spark):
    asked = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "a"]), (3, [])], "change_id int, guids array<string>")
    found, failed = lookup_related_documents(docs(spark, doc("a"), doc("b")), asked, "partial")
    assert sorted(tuple(r) for r in found.select("change_id", "guid").collect()) == [(1, "a"), (1, "b"), (2, "a")]
    assert [r.change_id for r in failed.collect()] == [2] and "REPARTITION_BY_COL" in plan(found)


def test_lists_are_not_put_together_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, "b", "B"), (1, "a", "A"), (2, "c", "C")], "k int, guid string, name string")
    out = listed(rows, "k", FIELD)
    assert {r.k: [tuple(e) for e in r[f"_{FIELD}"]] for r in out.collect()} == {1: [("a", "A"), ("b", "B")], 2: [("c", "C")]}
    assert "ObjectHashAggregate" not in plan(out) and SETTINGS["spark.sql.execution.useObjectHashAggregateExec"] == "false"


def test_guids_of_links_are_made_after_the_shuffle(spark):
    rows = spark.createDataFrame([(1, 12, "B"), (1, 9, "A")], "k int, p int, n string")
    out = listed(rows, "k", FIELD, F.concat(F.lit("P"), "p"), F.col("n"))
    assert [[tuple(e) for e in r[f"_{FIELD}"]] for r in out.collect()] == [[("P12", "B"), ("P9", "A")]]
    text = plan(out)
    assert "concat(P" in text[: text.index("Exchange")] and "concat(P" not in text[text.index("Exchange") :]


def test_documents_of_a_type_are_dealt_by_its_key(spark, sf):
    assert "ObjectHashAggregate" not in plan(Star(spark, sf)._documents())


def test_a_published_text_is_read_once(spark, sf):
    assert plan(q_sink_document_upserts(spark, sf)).count("get_json_object(value") == 0


def test_the_history_is_put_together_once_and_read_in_small_pieces(spark, sf, monkeypatch):
    from metaloom.plans import event_queries

    given = []
    monkeypatch.setattr(event_queries.versions, "previous_version_asof", lambda messages, history: given.append(plan(history)) or messages)
    with_asof(spark, sf)
    assert "Aggregate" not in given[0] and "Exchange" not in given[0]
    assert SETTINGS["spark.sql.files.maxPartitionBytes"] == "16m"


ODD = {FIELD + "guid": ["x", 'q"\\', None, "", "\n\u00e9\U0001f600"], FIELD: ["X", None, "\t", "[],null", "\u0001"]}


def test_packed_documents_come_back_as_they_were(spark):
    table = docs(spark, doc("a", path=[("p", "P", "t")], parent="p", **ODD), doc("b"), doc('c"')).withColumn(
        "derivedsystem", F.when(F.col("guid") != "b", F.col("derivedsystem"))).withColumn("score", F.lit(float("nan")))
    there = pack(table, "guid")
    assert set(there.columns) == {"guid", "_packed", "score", *[f.name for f in table.schema if f.dataType.simpleString() == "double"]}
    assert sorted(map(repr, unpack(there, table.schema, "guid").collect())) == sorted(map(repr, table.collect()))


def test_documents_meet_their_edits_packed(spark, tmp_path):
    table = kept(spark, docs(spark, doc("a", path=[("p", "P", "t")], parent="p", **ODD)), tmp_path / "table")
    after = apply_edits(table, kept(spark, link_edits(spark, ("a", "link", FIELD, "z", "Z")), tmp_path / "edits"))
    row = after.collect()[0]
    assert (row[FIELD + "guid"], row[FIELD], row.breadcrumbname) == ([*ODD[FIELD + "guid"], "z"], [*ODD[FIELD], "Z"], ["P"])
    assert "_packed" in plan(after)


def test_rows_of_the_index_are_dealt_once(spark, tmp_path):
    table = kept(spark, docs(spark, doc("a", path=[("p", "P", "t")], **{FIELD + "guid": ["x", "y", "x"], FIELD: ["X", "Y", "X"]})), tmp_path / "table")
    found = postings(table, posting_store(str(tmp_path / "index"), 4))
    assert sorted((r.guid, r.field, r.pos) for r in found.collect()) == sorted([("p", "breadcrumb", 0), ("x", FIELD, 0), ("y", FIELD, 1)])
    assert plan(found).count("Exchange hashpartitioning") == 2  # one of breadcrumbs, one of links


def test_changes_of_a_store_meet_its_rows_once(spark, tmp_path, monkeypatch):
    store, written = document_store(str(tmp_path), 4), []
    store.create(docs(spark, doc("a", **ODD), doc("b"), doc("c")))
    write = KeyedStore._write
    monkeypatch.setattr(KeyedStore, "_write", lambda self, rows, version: written.append(plan(rows)) or write(self, rows, version))
    edits = docs(spark, doc("a", path=[("p", "P", "t")], **ODD), doc("b"), doc("d")).withColumn("deleted", F.col("guid") == "b").withColumn("n", F.lit(1))
    store.apply(edits, "n", 0, 1)
    rows = {r.guid: r for r in store.read(spark, 1).collect()}
    assert set(rows) == {"a", "c", "d"} and rows["a"].breadcrumbguid == ["p"] and rows["a"][FIELD] == ODD[FIELD]
    assert written[0].count("Exchange hashpartitioning") == 1


def test_changes_of_a_table_deal_only_what_is_asked_for(spark, tmp_path):
    table = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old"), (None, 3, "old")], "k string, v int, other string")
    rows = [("a", 5, "x", 2, False), ("a", 6, "x", 1, False), ("b", 7, "x", 1, True), ("c", 8, "x", None, False), ("c", 9, "x", 0, False),
            ("d", 10, "x", None, False), (None, 11, "x", 1, False)]
    new = kept(spark, spark.createDataFrame(rows, "k string, v int, other string, n int, deleted boolean"), tmp_path / "new")
    after = apply_document_changes(table, new, "k", "n").select("k", "v")
    assert sorted((r.k or "", r.v) for r in after.collect()) == [("", 3), ("", 11), ("a", 5), ("c", 9)]
    assert all("other" not in x for x in re.findall(r"ReadSchema: (\S+)", plan(after)))
