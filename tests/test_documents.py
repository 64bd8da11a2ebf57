"""Document maintenance on small inputs."""

from __future__ import annotations

from metaloom.operators import attribute_audit, created as created_ops, deleted as deleted_ops
from metaloom.operators.edits import apply_edits
from metaloom.plans.fold import dispatch_change, flatten_documents, fold, message_atomicity
from metaloom.sources import sinks
from metaloom.sources.documents import lookup_related_documents
from tests.build import audited, by_guid, changes, created, deleted, doc, docs, ent, refs, renamed

DOMAIN, ENTITY, ATTRIBUTE, PERSON = "m4i_data_domain", "m4i_data_entity", "m4i_data_attribute", "m4i_person"


def step(guid, type_name=ENTITY, name=None):
    return (guid, name or guid, type_name)


def run(spark, table, *rows):
    """(documents that changed, error kinds) after changes that do not conflict."""
    base, edits, gone, errors = dispatch_change(changes(spark, *rows), table)
    flat = flatten_documents(base, message_atomicity(edits, errors), message_atomicity(gone, errors))
    return by_guid(flat), sorted(r["error"]["kind"] for r in errors.collect())


def ids(*guids):
    return [{"guid": g} for g in guids]


def test_created_document_and_its_defaults(spark):
    table = docs(spark)
    got, errors = run(
        spark, table, created("1234", attributes={"qualifiedName": "1234-test", "name": "test"}),
        created("2", attributes={"qualifiedName": "q"}), created("3", attributes={"name": None}),
        created("4", PERSON, attributes={"name": "p", "email": "p@example.org"}),
        {**created("5"), "new_value": None})
    assert errors == ["entity_missing"]
    assert (got["1234"]["id"], got["1234"]["name"], got["1234"]["referenceablequalifiedname"]) == (
        "1234", "test", "1234-test")
    assert got["1234"]["definition"] == "" and got["1234"]["supertypenames"] == [ENTITY]
    assert got["2"]["name"] == "q" and got["3"]["name"] is None and got["3"]["referenceablequalifiedname"] == "3"
    assert got["4"]["email"] == "p@example.org" and "5" not in got


def test_created_below_its_parent(spark):
    table = docs(spark, doc("2222", DOMAIN, path=[step("5678", DOMAIN)], parent="5678"))
    got, _ = run(spark, table, created("1111", attributes={"name": "e", "dataDomain": ids("2222")},
                                       relationships={"dataDomain": refs("2222", type_name=DOMAIN)}))
    assert got["1111"]["breadcrumbguid"] == ["5678", "2222"] and got["1111"]["parentguid"] == "2222"
    assert got["1111"]["deriveddatadomainguid"] == ["2222"] and got["2222"]["deriveddataentityguid"] == ["1111"]
    assert got["2222"]["deriveddataentity"] == ["e"] and got["2222"]["parentguid"] == "5678"


def test_created_between_parent_and_children(spark):
    table = docs(
        spark, doc("2222", DOMAIN), doc("3333", ATTRIBUTE), doc("4444", "m4i_field", path=[step("3333", ATTRIBUTE)]))
    got, _ = run(spark, table, created(
        "1111", attributes={"name": "e", "dataDomain": ids("2222"), "attributes": ids("3333")},
        relationships={"dataDomain": refs("2222", type_name=DOMAIN), "attributes": refs("3333", type_name=ATTRIBUTE)}))
    assert got["1111"]["breadcrumbguid"] == ["2222"] and got["2222"]["breadcrumbguid"] == []
    assert got["3333"]["breadcrumbguid"] == ["2222", "1111"] and got["3333"]["parentguid"] == "1111"
    assert got["4444"]["breadcrumbguid"] == ["2222", "1111", "3333"] and got["4444"]["parentguid"] == "3333"
    assert got["4444"]["breadcrumbname"] == ["2222", "e", "3333"]


def test_unlinkable_and_blacklisted_references(spark):
    table = docs(spark, doc("q", "m4i_data_quality"), doc("x", "something_else"), doc("p", PERSON))
    got, errors = run(spark, table, created("1", relationships={
        "a": refs("q", type_name="m4i_data_quality"), "b": refs("x", type_name="something_else"),
        "c": refs("p", type_name=PERSON), "d": refs("missing"), "e": None}))
    assert errors == [] and set(got) == {"1", "p"} and got["1"]["derivedpersonguid"] == ["p"]


def test_update_attributes(spark):
    table = docs(spark, doc("1", name="old"))
    got, errors = run(spark, table, renamed("1", "new", inserted=["definition"], definition="d", other="x"))
    assert errors == [] and (got["1"]["name"], got["1"]["definition"]) == ("new", "d")
    assert run(spark, table, renamed("1", "new", changed=["other"])) == ({}, [])


def test_rename_in_breadcrumbs(spark):
    table = docs(
        spark, doc("1234", name="old"), doc("2345", path=[step("1234")]), doc("same", path=[step("1234", name="new")]),
        doc("bad", path=[step("1234")], breadcrumbname=["a", "b"]), doc("other", path=[step("5678")]),
        doc("twice", path=[step("1234"), step("9"), step("1234")]))
    edits = attribute_audit.rename_in_breadcrumbs(changes(spark, renamed("1234", "new")), table)
    got = by_guid(apply_edits(table, edits))
    assert {g: d["breadcrumbname"] for g, d in got.items()} == {"2345": ["new"], "twice": ["new", "9", "1234"]}


def test_rename_in_links_emits_unchanged_documents_too(spark):
    table = docs(
        spark, doc("1234"), doc("2345", deriveddataentityguid=["1234"], deriveddataentity=["old"]),
        doc("3", deriveddataentityguid=["0", "1234"], deriveddataentity=["x", "new"]),
        doc("4", derivedpersonguid=["1234"], derivedperson=["old"]))
    edits = attribute_audit.rename_in_links(changes(spark, renamed("1234", "new")), table)
    got = by_guid(apply_edits(table, edits))
    assert {g: d["deriveddataentity"] for g, d in got.items()} == {"2345": ["new"], "3": ["x", "new"]}


def test_failed_rename_changes_nothing(spark):
    table = docs(spark, doc("1"), doc("2", path=[step("1")]))
    got, errors = run(
        spark, table, renamed("1", None), {**renamed("1", "x", ms=2), "new_value": None}, renamed("9", "x"),
        {**renamed("1", "x", ms=3), "new_value": ent("1")})
    assert got == {} and errors == ["attribute_missing", "document_not_found", "entity_missing", "name_missing"]


def test_delete_cuts_breadcrumbs_after_the_entity(spark):
    table = docs(
        spark, doc("a", path=[step("1234"), step("3456")], parent="3456"),
        doc("b", path=[step("1234"), step("3456"), step("7")], parent="7"),
        doc("bad", path=[step("1234")], breadcrumbtype=[]))
    got = by_guid(deleted_ops.delete_truncate_breadcrumbs(changes(spark, deleted("1234")), table))
    assert {g: d["breadcrumbguid"] for g, d in got.items()} == {"a": ["3456"], "b": ["3456", "7"]}
    got = by_guid(deleted_ops.delete_truncate_breadcrumbs(changes(spark, deleted("1234"), deleted("3456")), table))
    assert {g: d["breadcrumbguid"] for g, d in got.items()} == {"a": [], "b": ["7"]}
    assert got["a"]["parentguid"] == "3456"
    fixed = deleted_ops.delete_truncate_breadcrumbs(changes(spark, deleted("3456")), table, fix_parent=True)
    assert {g: d["parentguid"] for g, d in by_guid(fixed).items()} == {"a": None, "b": "7"}


def test_delete_unlinks_and_leaves_a_tombstone(spark):
    table = docs(spark, doc("1234"), doc("h", deriveddataentityguid=["1234", "3456", "1234"],
                                         deriveddataentity=["A", "B", "C"]))
    got, _ = run(spark, table, deleted("1234"), {**deleted("9"), "old_value": None})
    assert got["1234"]["deleted"] and got["1234"]["typename"] is None
    assert (got["h"]["deriveddataentityguid"], got["h"]["deriveddataentity"]) == (["3456", "1234"], ["B", "C"])


def family(spark):
    return docs(
        spark, doc("d", DOMAIN, deriveddataentityguid=["e"], deriveddataentity=["e"]),
        doc("e", ENTITY, path=[step("d", DOMAIN)], parent="d", deriveddatadomainguid=["d"], deriveddatadomain=["d"]),
        doc("f", ATTRIBUTE, path=[step("d", DOMAIN), step("e")], parent="e"), doc("n", ENTITY), doc("m", DOMAIN),
        doc("below", ATTRIBUTE, path=[step("n")], parent="n"))


def test_audit_inserts_children_from_the_parent_side(spark):
    got, errors = run(spark, family(spark), audited(
        "m", DOMAIN, inserted={"dataEntity": refs("n", type_name=ENTITY)}, new={"dataEntity": ids("n")}))
    assert errors == []
    assert got["m"]["deriveddataentityguid"] == ["n"] and got["n"]["deriveddatadomainguid"] == ["m"]
    assert (got["n"]["breadcrumbguid"], got["n"]["parentguid"]) == (["m"], "m")
    assert (got["below"]["breadcrumbguid"], got["below"]["parentguid"]) == (["m", "n"], "n")
    # The same event seen from the child does nothing: the reference is its parent.
    assert run(spark, family(spark), audited(
        "n", ENTITY, inserted={"dataDomain": refs("m", type_name=DOMAIN)}, new={"dataDomain": ids("m")})) == ({}, [])


def test_audit_detaches_lost_children(spark):
    got, errors = run(spark, family(spark), audited(
        "d", DOMAIN, deleted={"dataEntity": refs("e", type_name=ENTITY)}, old={"dataEntity": ids("e")}))
    assert errors == []
    assert got["d"]["deriveddataentityguid"] == got["d"]["deriveddataentity"] == []
    assert got["e"]["deriveddatadomainguid"] == [] and got["e"]["breadcrumbguid"] == []
    assert got["e"]["parentguid"] is None
    assert (got["f"]["breadcrumbguid"], got["f"]["parentguid"]) == (["e"], "e")


def test_moving_a_child_one_level_up_in_one_event(spark):
    table = docs(
        spark, doc("g", DOMAIN), doc("c1", ENTITY, path=[step("g", DOMAIN)], parent="g"),
        doc("c2", ENTITY, path=[step("g", DOMAIN), step("c1")], parent="c1"),
        doc("x", ATTRIBUTE, path=[step("g", DOMAIN), step("c1"), step("c2")], parent="c2"))
    got, _ = run(spark, table, audited(
        "g", DOMAIN, deleted={"dataEntity": refs("c1", type_name=ENTITY)}, old={"dataEntity": ids("c1")},
        inserted={"dataEntity": refs("c2", type_name=ENTITY)}, new={"dataEntity": ids("c2")}))
    assert got["c1"]["breadcrumbguid"] == [] and got["c2"]["breadcrumbguid"] == ["g"]
    # What is below loses "g" with the old child and gets it back with the new one, so it stays as it was.
    assert "x" not in got


def test_missing_references_fail_an_insert_but_not_a_delete(spark):
    insert = audited("m", DOMAIN, inserted={"dataEntity": refs("n", "nowhere", type_name=ENTITY)},
                     new={"dataEntity": ids("n")})
    assert run(spark, family(spark), insert) == ({}, ["related_documents_missing"])
    delete = audited("d", DOMAIN, deleted={"dataEntity": refs("e", "nowhere", type_name=ENTITY)},
                     old={"dataEntity": ids("e")})
    got, errors = run(spark, family(spark), delete)
    assert errors == [] and got["e"]["breadcrumbguid"] == []
    lost_child = audited("d", DOMAIN, deleted={"dataEntity": refs("nowhere", type_name=ENTITY)},
                         old={"dataEntity": ids("nowhere")})
    assert run(spark, family(spark), lost_child) == ({}, ["child_not_found"])


def test_a_guid_asked_for_twice_counts_as_missing(spark):
    asked = spark.createDataFrame([("c", ["n", "n"]), ("e", [])], "change_id string, guids array<string>")
    found, errors = lookup_related_documents(family(spark), asked, "partial")
    assert [r["guid"] for r in found.collect()] == ["n"] and errors.count() == 1
    assert lookup_related_documents(family(spark), asked, "strict")[0].count() == 0
    assert lookup_related_documents(family(spark), asked, "strict", distinct=True)[1].count() == 0


def test_unknown_events_are_errors(spark):
    _, failed = fold(changes(spark, {**deleted("n"), "event_type": "EntityMoved"}), family(spark))
    assert [r["error"]["kind"] for r in failed.collect()] == ["not_implemented"]


def test_email_of_persons_only(spark):
    rows = changes(spark, created("1", PERSON, attributes={"email": "a"}), created("2", attributes={"email": "b"}),
                   created("3", PERSON))
    assert [(r["guid"], r["email"]) for r in created_ops.create_person_email(rows).collect()] == [("1", "a")]


def test_damaged_messages_are_dead_letters(spark):
    whole = '{"id":"%s","value":{"guid":"%s","name":"n","typename":"t"}}'
    rows = [
        ('{"id":"1"}', whole % (1, 1)), ('{"id":"2"}', None), ('{"id":"3"}', '{"id":"3","value":null}'),
        ('{"id":"4"}', '{"id":"4","value":{"guid":"4","na'), ('{"id":"5"}', '{"id":"5","value":nu'), ('{"id":"6"}', '{"id":"6"}'),
        ('{"id":"7"}', ""), ('{"id":"8"}', '{"id":"8","value":null}}x'), ('{"id":"9"}', '{"id":"9","value":{"guid":"9","breadcrumbguid":5}}'),
        ('{"id":"10"}', "null"), ('{"id":"11"}', "[]"), ('{"id', whole % (12, 12)), (None, whole % (13, 13)), ('{"x":1}', None), ("{", None)]
    messages = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "key string, value string, offset int")
    got, failed = sinks.parse_document_changes(messages, "offset")
    assert sorted((r.guid, r.name, r.deleted, r.offset) for r in got.collect()) == [("1", "n", False, 0), ("2", None, True, 1), ("3", None, True, 2)]
    letters = sinks.dead_letter(failed).collect()
    assert sorted((r.kind, r.payload or "") for r in letters) == sorted(
        [("unreadable_value", v) for _, v in rows[3:11]] + [("unreadable_key", v or k or "") for k, v in rows[11:]])
    assert {r.stage for r in letters} == {"publish"}
