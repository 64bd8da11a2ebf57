"""Maintained state: what a batch reads and writes follows the batch, and the result is that of doing it all anew."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.operators.hierarchy import canonical_breadcrumbs, canonical_paths
from metaloom.operators.versions import previous_version_asof
from metaloom.plans.fold import change_refs, working_set
from metaloom.schemas import ENTITY_VERSION
from metaloom.sources.day_store import DayStore
from metaloom.sources.index_rules import import_in_order, import_levels
from metaloom.sources.keyed_store import KeyedStore
from metaloom.sources.postings import document_store, documents_below, documents_holding, posting_changes, posting_store, postings, working_guids
from metaloom.sources.version_store import VersionStore
from tests.build import changes, deleted, doc, docs, ent, messages, note, refs, renamed

ROWS = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
CHANGES = "k string, v bigint, n int, deleted boolean"


def files(folder) -> list[str]:
    return sorted(str(p) for p in Path(folder).rglob("part-*.parquet"))


# --------------------------------------------------------------------------- keyed store
def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    store = KeyedStore(str(tmp_path), ROWS, ("k",), 16)
    store.create(spark.range(500).selectExpr("CAST(id AS STRING) AS k", "id AS v"))
    first = files(tmp_path / "data")
    assert len(first) == 16
    edits = [("3", 33, 1, False), ("3", 34, 2, False), ("4", None, 1, True), ("new", 1, 1, False), ("gone", None, 1, True)]
    touched = store.apply(spark.createDataFrame(edits, CHANGES), "n", 0, 1)
    later = files(tmp_path / "data")
    assert len(later) - len(first) == len(touched) <= 4 and set(first) <= set(later)
    want = {str(i): i for i in range(500) if i != 4} | {"3": 34, "new": 1}
    assert {r.k: r.v for r in store.read(spark, 1).collect()} == want
    assert store.read(spark, 1).count() == len(want)
    assert {r.k: r.v for r in store.read(spark, 0).collect()} == {str(i): i for i in range(500)}  # the old version stays
    old, new = store.manifest(spark, 0), store.manifest(spark, 1)
    assert {b for b in old if old[b] != new.get(b)} == set(touched)


def test_a_lookup_opens_only_its_buckets(spark, tmp_path):
    store = KeyedStore(str(tmp_path), ROWS, ("k",), 32)
    store.create(spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "id AS v"))
    asked = spark.createDataFrame([("5",), ("77",), ("none",)], "k string")
    found = store.read_keys(0, asked)
    assert sorted(r.v for r in found.collect()) == [5, 77]
    assert len(store.read(spark, 0, store.touched(asked)).inputFiles()) <= 3


def test_a_step_that_runs_again_gives_the_same(spark, tmp_path):
    store = KeyedStore(str(tmp_path), ROWS, ("k",), 8)
    assert store.last(spark, 10) is None and store.read(spark, None).count() == 0
    edit = spark.createDataFrame([("a", 1, 1, False), ("b", 2, 1, False)], CHANGES)
    assert store.apply(edit, "n", None, 0) == store.apply(edit, "n", None, 0)
    for _ in range(2):
        store.apply(spark.createDataFrame([("a", None, 1, True)], CHANGES), "n", 0, 1)
    assert [tuple(r) for r in store.read(spark, 1).collect()] == [("b", 2)]
    assert store.apply(spark.createDataFrame([], CHANGES), "n", 1, 2) == []
    store.apply(spark.createDataFrame([("b", None, 1, True)], CHANGES), "n", 2, 3)
    assert store.read(spark, 3).count() == 0 and store.last(spark, 2) == 2 and store.last(spark, 99) == 3


def test_random_changes_equal_a_dictionary(spark, tmp_path):
    rng, store, want = random.Random(1), KeyedStore(str(tmp_path), ROWS, ("k",), 8), {}
    base = None
    for version in range(4):
        rows = [(str(rng.randrange(60)), rng.randrange(1000), n, rng.random() < 0.3) for n in range(40)]
        for k, v, _, gone in rows:
            want.pop(k, None) if gone else want.__setitem__(k, v)
        store.apply(spark.createDataFrame(rows, CHANGES), "n", base, version)
        base = version
    assert {r.k: r.v for r in store.read(spark, base).collect()} == want


# --------------------------------------------------------------------------- postings
SYSTEM, COLLECTION = ("s", "s", "m4i_system"), ("c", "c", "m4i_collection")
TABLE = [
    doc("s", "m4i_system"), doc("c", "m4i_collection", path=[SYSTEM], parent="s"), doc("d", "m4i_dataset", path=[SYSTEM, COLLECTION], parent="c"),
    doc("p", "m4i_person", derivedsystemguid=["s", "t", "s"], derivedsystem=["s", "t", "s"]), doc("x", "m4i_dataset", path=[("y", "y", "m4i_system")]),
]


def rows_of(df):
    return sorted(map(tuple, df.select("guid", "doc", "field", "pos").collect()))


def test_postings_follow_the_documents(spark, tmp_path):
    before = docs(spark, *TABLE)
    store = posting_store(str(tmp_path), 16)
    store.create(postings(before))
    assert rows_of(store.read(spark, 0)) == sorted([
        ("s", "c", "breadcrumb", 0), ("s", "d", "breadcrumb", 0), ("c", "d", "breadcrumb", 1), ("y", "x", "breadcrumb", 0),
        ("s", "p", "derivedsystem", 0), ("t", "p", "derivedsystem", 1)])
    changed = [doc("d", "m4i_dataset", path=[COLLECTION], parent="c"), doc("p", "m4i_person", derivedsystemguid=["t"], derivedsystem=["t"]),
               doc("new", "m4i_dataset", path=[COLLECTION])]
    old = before.filter(F.col("guid").isin("d", "p", "x"))  # x is deleted
    moved = posting_changes(old, docs(spark, *changed)).withColumn("n", F.lit(1))
    touched = store.apply(moved, "n", 0, 1)
    after = docs(spark, *[d for d in TABLE if d[0] not in ("d", "p", "x")], *changed)
    assert rows_of(store.read(spark, 1)) == rows_of(postings(after))
    assert set(touched) == set(store.touched(spark.createDataFrame([(g,) for g in "scyt"], "guid string")))


def test_scans_and_working_set_from_the_index(spark, tmp_path):
    table = docs(spark, *TABLE, *[doc(f"z{i}", "m4i_dataset", path=[("y", "y", "m4i_system")]) for i in range(60)])
    store = posting_store(str(tmp_path), 64)
    store.create(postings(table))
    guids = spark.createDataFrame([("s", "m4i_system"), ("nobody", "m4i_system")], "guid string, type_name string")
    assert {r.doc for r in documents_below(store, 0, guids).collect()} == {"c", "d"}
    assert [tuple(r) for r in documents_holding(store, 0, guids).collect()] == [("p", "derivedsystem", "s", 0)]
    rows = changes(spark, renamed("s", "t", "m4i_system", 1), deleted("c", "m4i_collection", 2))
    found = working_guids(store, 0, rows, change_refs(rows))
    want = working_set(rows, change_refs(rows), table)
    assert {r.guid for r in found.collect()} == {r.guid for r in want.collect()} == {"s", "c", "d", "p"}
    opened = store.read(spark, 0, store.touched(rows.select("guid"))).inputFiles()
    assert len(opened) <= 2


def test_documents_keep_all_their_columns(spark, tmp_path):
    store = document_store(str(tmp_path), 4)
    store.create(docs(spark, *TABLE))
    assert sorted(map(str, store.read(spark, 0).collect())) == sorted(map(str, docs(spark, *TABLE).collect()))


# --------------------------------------------------------------------------- versions
def versions_of(spark, pairs):
    rows = [(ent(g, attributes={"at": str(t)}), g, t) for g, t in pairs]
    from metaloom.operators.versions import entity_versions

    return entity_versions(messages(spark, *[note("UPDATE", e, t) for e, _, t in rows])).select("body", "doc_id", "event_time", "msg_creation_time")


def test_history_in_runs_gives_the_same_lookup(spark, tmp_path):
    rng = random.Random(3)
    store, everything = VersionStore(str(tmp_path), buckets=4, fan=3), []
    for batch in range(7):
        pairs = sorted({(f"g{rng.randrange(12)}", rng.randrange(100)) for _ in range(6)})
        everything += pairs
        store.append(versions_of(spark, pairs), batch)
    assert sorted(r.doc_id for r in store.read(spark, 6).collect()) == sorted({f"{g}_{t}" for g, t in everything})
    assert len(store.runs(spark, 6)) <= 4 and [level for _, level in store.runs(spark, 6)] == sorted([level for _, level in store.runs(spark, 6)], reverse=True)
    asked = messages(spark, *[note("UPDATE", ent(f"g{i}"), t) for i in range(14) for t in (1, 40, 77, 200)])
    keys = asked.select(F.col("entity.guid").alias("guid"), F.col("msg_creation_time").alias("before"))
    result = lambda history: sorted((r.entity.guid, r.msg_creation_time, r.previous_version and r.previous_version.updateTime)
                                    for r in previous_version_asof(asked, history).collect())
    want = sorted((f"g{i}", t, max((u for g, u in everything if g == f"g{i}" and u < t), default=None)) for i in range(14) for t in (1, 40, 77, 200))
    assert result(store.lookup(keys, 6)) == want


def test_a_lookup_opens_only_files_that_can_hold_its_guids(spark, tmp_path):
    store = VersionStore(str(tmp_path), buckets=8, fan=100)
    for batch in range(3):
        store.append(versions_of(spark, [(f"b{batch}_{i}", 10 * batch + 5) for i in range(120)]), batch)
    asked = lambda *rows: spark.createDataFrame(list(rows), "guid string, before bigint")
    total = len(files(tmp_path)) - len(list(Path(tmp_path).glob("run-*/filters/part-*"))) - len(list(Path(tmp_path).glob("manifest/*/part-*")))
    assert total == 24
    assert len(store.files(asked(("b1_7", 99)), 2)) == 1
    assert store.files(asked(("b1_7", 15)), 2) == []  # nothing in that file is as old
    assert len(store.files(asked(("b0_1", 99), ("b2_1", 99)), 2)) == 2
    absent = store.files(asked(*[(f"b1_{i}x", 99) for i in range(200)]), 2)
    assert len(absent) <= 8  # a few by chance, of 24
    assert store.files(asked(("b1_7", 99)), 0) == [] and store.files(asked(("b1_7", 99)), None) == []


def test_a_filter_of_many_pieces(spark, tmp_path):
    store = VersionStore(str(tmp_path), buckets=1)
    body = versions_of(spark, [("a", 1)]).first()["body"]
    one = spark.createDataFrame([(body, "x", 1, 1)], ENTITY_VERSION)
    many = one.crossJoin(spark.range(20_000)).select(
        F.col("body").withField("guid", F.concat(F.lit("g"), "id")).alias("body"), F.concat(F.lit("g"), "id").alias("doc_id"), "event_time", "msg_creation_time")
    store.append(many, 0)
    run = store.runs(spark, 0)[0][0]
    assert spark.read.parquet(f"{run}/filters").count() >= 6
    assert len(store.files(spark.createDataFrame([("g19999", 5)], "guid string, before bigint"), 0)) == 1
    passed = sum(bool(store.files(spark.createDataFrame([(f"h{i}", 5)], "guid string, before bigint"), 0)) for i in range(12))
    assert passed <= 3
    assert store.lookup(spark.createDataFrame([("g5", 5), ("h5", 5)], "guid string, before bigint"), 0).count() == 1


def test_a_version_that_comes_again_replaces(spark, tmp_path):
    store = VersionStore(str(tmp_path), buckets=2, fan=2)
    for batch, mark in enumerate(("old", "mid", "new")):
        fresh = versions_of(spark, [("a", 5), (f"only{batch}", 7)]).withColumn("event_time", F.lit(len(mark) + batch).cast("bigint"))
        store.append(fresh, batch)
        store.append(fresh, batch)  # run again
    got = {r.doc_id: r.event_time for r in store.read(spark, 2).collect()}
    assert got == {"a_5": 5, "only0_7": 3, "only1_7": 4, "only2_7": 5}


# --------------------------------------------------------------------------- days
def test_days_that_stay_are_not_read(spark, tmp_path):
    day = 86_400_000
    store = DayStore(str(tmp_path), T.StructType([T.StructField("guid", T.StringType()), T.StructField("msg_creation_time", T.LongType())]))
    store.append(spark.createDataFrame([("a", day), ("a", 2 * day), ("b", day + 5), ("a", 4 * day), ("c", 5 * day)], store.schema))
    later = [p for p in files(tmp_path / "data") if "day=1970-01-05" in p or "day=1970-01-06" in p]
    for p in later:
        Path(p).write_bytes(b"not a parquet file")  # whoever reads it fails
    assert store.drop_before(spark, "1970-01-05") == ["1970-01-02", "1970-01-03"]
    assert store.drop_before(spark, "1970-01-04") == []
    assert sorted(map(tuple, store.carried(spark, "1970-01-05").collect())) == [("a", 2 * day), ("b", day + 5)]


def test_retention_keeps_what_lookups_need(spark, tmp_path):
    day = 86_400_000
    store = DayStore(str(tmp_path), T.StructType([T.StructField("guid", T.StringType()), T.StructField("msg_creation_time", T.LongType())]))
    rows = [(f"g{i % 5}", i * day // 3) for i in range(60)]
    store.append(spark.createDataFrame(rows, store.schema))
    for cut_at in ("1970-01-05", "1970-01-11"):
        store.drop_before(spark, cut_at)
    kept = sorted(map(tuple, store.read(spark).collect()))
    for t in range(10 * day, 20 * day, day // 2):
        for g in range(5):
            newest = lambda some: max((u for n, u in some if n == f"g{g}" and u < t), default=None)
            assert newest(kept) == newest(rows)


# --------------------------------------------------------------------------- hierarchy
def chain(spark, parents):
    return docs(spark, *[doc(g, "m4i_dataset", parent=p) for g, p in parents.items()])


def test_a_chain_of_a_thousand(spark):
    parents = {f"n{i}": f"n{i - 1}" if i else None for i in range(1000)}
    found, failed = canonical_breadcrumbs(chain(spark, parents))
    sizes = {r.guid: (r.breadcrumbguid[:1], r.breadcrumbguid[-1:], len(r.breadcrumbguid)) for r in found.collect()}
    assert sizes == {f"n{i}": (["n0"] if i else [], [f"n{i - 1}"] if i else [], i) for i in range(1000)} and failed.count() == 0


def test_cycles_and_lost_parents_are_errors(spark):
    parents = {"a": "b", "b": "c", "c": "a", "under": "a", "self": "self", "orphan": "nobody", "below": "orphan", "root": None, "child": "root"}
    paths, failed = canonical_paths(chain(spark, parents))
    assert {r.guid: [s.guid for s in r.path] for r in paths.collect()} == {"root": [], "child": ["root"]}
    assert {r.guid: r.error.kind for r in failed.collect()} == {
        "a": "cycle", "b": "cycle", "c": "cycle", "under": "cycle", "self": "cycle", "orphan": "parent_missing", "below": "parent_missing"}
    after, _ = canonical_breadcrumbs(chain(spark, parents))
    assert after.count() == len(parents)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests(spark, seed):
    rng, parents = random.Random(seed), {}
    for i in range(150):
        parents[f"n{i}"] = f"n{rng.randrange(i)}" if i and rng.random() < 0.9 else None

    def way(g):
        return [] if parents[g] is None else [*way(parents[g]), parents[g]]

    assert {r.guid: [s.guid for s in r.path] for r in canonical_paths(chain(spark, parents))[0].collect()} == {g: way(g) for g in parents}


def test_import_levels_and_cycles(spark):
    guids = spark.createDataFrame([(g,) for g in "abcdefg"], "guid string")
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("d", "out"), ("e", "f"), ("f", "e"), ("g", "e"), ("g", "a")], "guid string, needs string")
    levels, failed = import_levels(guids, edges)
    assert {r.guid: r.level for r in levels.collect()} == {"a": 0, "b": 1, "c": 2, "d": 0}
    assert {r.guid: r.error.kind for r in failed.collect()} == {"e": "cycle", "f": "cycle", "g": "cycle"}


def test_import_in_order_leaves_out_what_is_there(spark):
    bodies = [ent("child", "m4i_dataset", {}, {"up": refs("parent")}), ent("parent", "m4i_collection"), ent("old", "m4i_dataset")]
    exported = versions_from(spark, bodies)
    there = exported.filter("doc_id LIKE 'old%'")
    found, failed = import_in_order(there, exported)
    assert {r.body.guid: r.level for r in found.collect()} == {"parent": 0, "child": 1} and failed.count() == 0


def versions_from(spark, bodies):
    from metaloom.operators.versions import entity_versions

    return entity_versions(messages(spark, *[note("UPDATE", b, 5) for b in bodies])).drop("position")
