"""Validation, versions and diffs on small inputs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from metaloom.operators import diff, validate, versions
from metaloom.operators.validate import parse_notifications
from metaloom.schemas import ENTITY
from metaloom.sources import index_rules
from metaloom.sources.change_log import source_change_log
from tests.build import ent, messages, note, pair, refs


def kinds(df):
    return sorted(str(r[0]) for r in df.select("error.kind").collect())


def test_text_of_another_shape_is_a_validation_error(spark):
    checked = messages(spark, '{"hello": "world"}', "not json", note("CREATE", ent("1")))
    assert kinds(checked) == ["None", "validation", "validation"]


def test_error_kind_follows_the_order_of_checks(spark):
    raw = spark.createDataFrame([(n,) for n in [
        note("CREATE", None), note("CREATE", ent("1", "m4i_source")), note("CLASSIFY", ent("2", "m4i_source")),
        note("CLASSIFY", ent("3")), note("CREATE", ent("4"))]], "value string")
    assert kinds(validate.validated(raw)) == [
        "None", "ignored_operation", "ignored_type", "ignored_type", "missing_entity"]


def test_enrichment_replaces_the_entity_of_creates_and_updates(spark):
    raw = [note("CREATE", ent("1")), note("DELETE", ent("2", attributes={"a": 1})), note("UPDATE", ent("3"))]
    current = messages(spark, note("CREATE", ent("1", attributes={"hello": "world"}))).select(
        F.col("entity").alias("body"))
    found = validate.reject_lookup_failure(validate.enrich_current_entity(messages(spark, *raw), current))
    rows = {r["entity"]["guid"]: r for r in found.collect()}
    assert rows["1"]["entity"]["attributes"] == {"hello": '"world"'} and rows["1"]["error"] is None
    assert rows["2"]["entity"]["attributes"] == {"a": "1"} and rows["2"]["error"] is None
    assert rows["3"]["error"]["kind"] == "lookup_failed"


def test_version_takes_the_creation_time_of_the_message(spark):
    row = versions.entity_versions(messages(spark, note("DELETE", ent("1"), ms=7))).first()
    assert (row["doc_id"], row["body"]["updateTime"]) == ("1_7", 7)


def test_previous_version_is_strictly_older(spark):
    log = messages(spark, note("CREATE", ent("1"), 5), note("UPDATE", ent("1"), 5), note("UPDATE", ent("1"), 6),
                   note("DELETE", ent("2"), 9))
    history = versions.versions_dedupe(versions.entity_versions(log))
    out = versions.publish_state_facade(log, history).collect()
    got = sorted(((r["entity"]["guid"], r["operation"], r["previous_version"] and r["previous_version"]["updateTime"],
                  r["error"] and r["error"]["kind"]) for r in out), key=str)
    assert got == [("1", "ENTITY_CREATE", None, None), ("1", "ENTITY_UPDATE", 5, None),
                   ("1", "ENTITY_UPDATE", None, "no_previous_version"),
                   ("2", "ENTITY_DELETE", None, "no_previous_version")]


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_previous_version_of_an_entity_that_holds_most_rows(spark, partitions):
    """One entity within a second: its times are dealt to many pieces, with the same answers."""
    rng = random.Random(partitions)
    log = [(rng.choice(["hot"] * 5 + ["a", "b"]), rng.randrange(300)) for _ in range(400)]
    versions_at = sorted({(rng.choice(["hot", "hot", "a"]), rng.randrange(300)) for _ in range(60)})
    asked = messages(spark, *[note("UPDATE", ent(g), t) for g, t in log])
    history = versions.entity_versions(messages(spark, *[note("UPDATE", ent(g), t) for g, t in versions_at]))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        for strict in (True, False):
            out = versions.as_of(asked, history, strict=strict).collect()
            assert len(out) == len(log)
            for r in out:
                g, t = r["entity"]["guid"], r["msg_creation_time"]
                older = [v for h, v in versions_at if h == g and (v < t or (not strict and v == t))]
                got = r["previous_version"]
                assert (got and got["updateTime"]) == (max(older) if older else None)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_no_body_below_the_window_of_the_lookup(spark, monkeypatch):
    monkeypatch.setattr(versions, "cut", lambda df: df)
    asked = messages(spark, note("UPDATE", ent("1"), 5))
    history = versions.entity_versions(messages(spark, note("CREATE", ent("1"), 4)))
    plan = versions.as_of(asked, history)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window" in line]
    assert windows and not any("body" in line or "attributes" in line for line in windows)


def test_the_last_version_of_an_id_stays(spark):
    rows = [(note("UPDATE", ent("1", attributes={"k": k}), 5), f"{p:03d}") for k, p in (("first", 1), ("last", 7), ("middle", 4))]
    for order in (rows, rows[::-1]):
        log = parse_notifications(spark.createDataFrame(order, "value string, position string"))
        kept = versions.versions_dedupe(versions.entity_versions(log)).collect()
        assert [(r["doc_id"], r["body"]["attributes"]["k"]) for r in kept] == [("1_5", '"last"')]
    before = versions.entity_versions(messages(spark, note("UPDATE", ent("1", attributes={"k": "old"}), 5), note("UPDATE", ent("2"), 6)))
    columns = ["body", "doc_id", "event_time", "msg_creation_time"]
    both = versions.with_versions(before.select(*columns), versions.versions_dedupe(versions.entity_versions(log)).select(*columns)).collect()
    assert sorted((r["doc_id"], r["body"]["attributes"].get("k")) for r in both) == [("1_5", '"last"'), ("2_6", None)]


def test_numbers_of_one_value_are_equal(spark):
    text = lambda n: note("UPDATE", ent("1", attributes={"n": "@", "deep": {"x": ["#", "1.0"]}})).replace('"@"', n).replace('"#"', n)
    got = {n: messages(spark, text(n)).first()["entity"]["attributes"] for n in ("1", "1.0", "1e0", "1.00", "10e-1")}
    assert all(a == {"n": "1", "deep": '{"x":[1,"1.0"]}'} for a in got.values())
    other = {n: messages(spark, text(n)).first()["entity"]["attributes"]["n"] for n in ("1.5", "10", "1e3", "1e8", "100000000.0", "-0.0")}
    assert other == {"1.5": "1.5", "10": "10", "1e3": "1000", "1e8": "100000000", "100000000.0": "100000000", "-0.0": "0"}


def test_changes_of_one_time_have_ids_of_their_own(spark):
    log = parse_notifications(spark.createDataFrame(
        [(note("CREATE", ent("1"), 5), "a"), (note("CREATE", ent("1"), 5), "b"), (note("CREATE", ent("1"), 5), "b")], "value string, position string"))
    rows = diff.diff_create(log.withColumn("previous_version", F.lit(None).cast(ENTITY))).collect()
    assert sorted(r["change_id"] for r in rows) == ["1_5_a_0", "1_5_b_0", "1_5_b_0"] and {r["ord"]["pos"] for r in rows} == {"a", "b"}
    unplaced = messages(spark, note("CREATE", ent("1"), 5), note("CREATE", ent("1"), 5), note("CREATE", ent("1", attributes={"a": 1}), 5))
    rows = unplaced.collect()
    assert {r["position"] for r in rows} == {""} and len({r["digest"] for r in rows}) == 2


def test_without_positions_one_time_is_ordered_by_guid(spark):
    log = messages(spark, *[note("CREATE", ent(g), 5) for g in "dbca"]).withColumn("previous_version", F.lit(None).cast(ENTITY))
    rows = diff.diff_create(log).orderBy("ord").collect()
    assert [r["guid"] for r in rows] == list("abcd") and len({r["change_id"] for r in rows}) == 4


def test_files_written_later_come_later_whatever_their_names(spark, tmp_path):
    import os

    for k, name in enumerate(("z", "a")):
        spark.createDataFrame([(f"m{k}",)], "text string").coalesce(1).write.parquet(str(tmp_path / name))
        part = next((tmp_path / name).glob("part-*.parquet"))
        target = tmp_path / "log" / f"{name}.parquet"
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(part.read_bytes())
        os.utime(target, (1_000_000 + k, 1_000_000 + k))
    rows = source_change_log(spark, {"path": str(tmp_path / "log"), "column": "text"}, streaming=False).orderBy("position").collect()
    assert [r["value"] for r in rows] == ["m0", "m1"]


def test_positions_sort_like_the_log(spark, tmp_path):
    spark.range(0, 30).selectExpr("'m' || id AS text").coalesce(1).write.parquet(str(tmp_path / "log"))
    rows = source_change_log(spark, {"path": str(tmp_path / "log"), "column": "text"}, streaming=False).orderBy("position").collect()
    assert [r["value"] for r in rows] == [f"m{i}" for i in range(30)] and len({r["position"] for r in rows}) == 30


def test_export_follows_a_long_chain(spark):
    bodies = [ent(f"e{i}", "m4i_dataset", {"qualifiedName": "start" if i == 0 else f"n{i}"}, {"next": refs(f"e{i + 1}")} if i < 13 else {}) for i in range(14)]
    entities = messages(spark, *[note("UPDATE", b) for b in [*bodies, ent("apart", "m4i_dataset", {"qualifiedName": "x"})]]).select(F.col("entity").alias("body"))
    found = index_rules.export_entities_by_name(entities, ["m4i_dataset"], "start", full=True).collect()
    assert {r["body"]["guid"] for r in found} == {f"e{i}" for i in range(14)}


def test_import_keeps_versions_that_are_there(spark):
    have = versions.entity_versions(messages(spark, note("UPDATE", ent("1", attributes={"k": "mine"}), 5))).drop("position")
    came = versions.entity_versions(messages(spark, note("UPDATE", ent("1", attributes={"k": "theirs"}), 5), note("UPDATE", ent("2"), 6))).drop("position")
    got = index_rules.import_entities(have, came).collect()
    assert sorted((r["doc_id"], r["body"]["attributes"].get("k")) for r in got) == [("1_5", '"mine"'), ("2_6", None)]


def test_waiting_messages_resolve_stay_or_expire(spark):
    waiting = messages(spark, note("UPDATE", ent("1"), 50), note("UPDATE", ent("2"), 60), note("UPDATE", ent("3"), 99))
    history = versions.entity_versions(messages(spark, note("CREATE", ent("1"), 10)))
    parts = versions.previous_version_wait(
        waiting.withColumn("first_seen", F.col("msg_creation_time")), history, now_ms=100, max_wait_ms=30)
    assert [[r["entity"]["guid"] for r in p.collect()] for p in parts] == [["1"], ["3"], ["2"]]


def change(df):
    return [r.asDict(recursive=True) for r in df.orderBy("ord").collect()]


def test_create_lists_null_valued_attributes_but_not_the_unmapped_one(spark):
    log = messages(spark, note("CREATE", ent("1", attributes={"a": None, "b": 1, "unmappedAttributes": {}},
                                             relationships={"r": refs("2"), "none": None})))
    [row] = change(diff.diff_create(log))
    assert row["inserted_attributes"] == ["a", "b"] and row["event_type"] == "EntityCreated"
    assert [x["guid"] for x in row["inserted_relationships"]["r"]] == ["2"]


def test_delete_lists_everything(spark):
    log = messages(spark, note("DELETE", ent("1", attributes={"attr1": "x", "attr2": "y", "unmappedAttributes": {}},
                                             relationships={"relation1": refs("12345", "23456")})))
    [row] = change(diff.diff_delete(log))
    assert row["deleted_attributes"] == ["attr1", "attr2", "unmappedAttributes"]
    assert [x["guid"] for x in row["deleted_relationships"]["relation1"]] == ["12345", "23456"]


def test_equal_versions_give_no_rows(spark):
    same = ent("1", attributes={"a": 1, "m": {"x": 1, "y": 2}}, relationships={"r": refs("2")})
    moved = ent("1", attributes={"m": {"y": 2, "x": 1}, "a": 1}, relationships={"q": refs("2")})
    assert change(diff.diff_update(pair(spark, same, same))) == []
    # A guid that moves from one relationship attribute to another is no change.
    assert change(diff.diff_update(pair(spark, same, moved))) == []


def test_attribute_diff(spark):
    [row] = change(diff.diff_update(pair(
        spark, ent("1", attributes={"attr1": "test", "gone": None, "n": "1"}),
        ent("1", attributes={"attr1": "new_value", "attr2": "value", "n": 1}))))
    assert (row["inserted_attributes"], row["changed_attributes"], row["deleted_attributes"]) == (
        ["attr2"], ["attr1", "n"], ["gone"])


def test_relationship_diff_keeps_empty_lists(spark):
    [row] = change(diff.diff_update(pair(
        spark, ent("1", relationships={"relation1": refs("12345"), "empty": []}),
        ent("1", relationships={"relation1": refs("12345", "23456"), "empty": []}))))
    assert {k: [x["guid"] for x in v] for k, v in row["inserted_relationships"].items()} == {"relation1": ["23456"]}
    assert {k: [x["guid"] for x in v] for k, v in row["deleted_relationships"].items()} == {"relation1": []}


def test_attribute_row_comes_before_relationship_row(spark):
    rows = change(diff.diff_update(pair(
        spark, ent("1", attributes={"a": 1}, relationships={"relation1": refs("12345")}),
        ent("1", attributes={"a": 2}, relationships={"relation1": refs("23456")}))))
    assert [r["event_type"] for r in rows] == ["EntityAttributeAudit", "EntityRelationshipAudit"]


def test_errors_of_the_diff(spark):
    log = messages(spark, note("UPDATE", None), note("CLASSIFICATION_ADD", ent("1"))).withColumn(
        "previous_version", F.lit(None).cast("struct<guid:string>"))
    tagged = diff.dispatch_operation(log).transform(diff.diff_errors)
    assert kinds(tagged) == ["not_implemented", "value_error"]
