"""Small inputs for tests."""

from __future__ import annotations

import json

from metaloom.operators.validate import parse_notifications
from metaloom.schemas import DOCUMENT, LISTS, SCORES


def refs(*guids, type_name="m4i_field"):
    return [{"guid": g, "typeName": type_name} for g in guids]


def ent(guid, type_name="m4i_data_entity", attributes=None, relationships=None):
    return {"guid": guid, "typeName": type_name, "attributes": attributes or {},
            "relationshipAttributes": relationships or {}}


def note(operation, entity, ms=1000):
    return json.dumps({"msgCreationTime": ms, "message": {
        "eventTime": ms, "operationType": f"ENTITY_{operation}", "type": "ENTITY_NOTIFICATION_V2", "entity": entity}})


def messages(spark, *notes):
    return parse_notifications(spark.createDataFrame([(n,) for n in notes], "value string"))


def pair(spark, before, now):
    """One update message with its previous version."""
    from pyspark.sql import functions as F

    old = messages(spark, note("UPDATE", before)).select(F.col("entity").alias("previous_version"))
    return messages(spark, note("UPDATE", now)).join(old)


def doc(guid, type_name="m4i_data_entity", name=None, path=(), parent=None, **lists):
    """``path`` is a list of (guid, name, type)."""
    row = {c: [] for c in LISTS}
    row.update({c: 0.0 for c in SCORES})
    row.update(guid=guid, id=guid, typename=type_name, name=name or guid, referenceablequalifiedname=guid,
               supertypenames=[type_name], parentguid=parent, breadcrumbguid=[p[0] for p in path],
               breadcrumbname=[p[1] for p in path], breadcrumbtype=[p[2] for p in path])
    row.update(lists)
    return tuple(row.get(f.name) for f in DOCUMENT)


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOCUMENT)


def by_guid(df):
    return {r["guid"]: r.asDict() for r in df.collect()}


def changes(spark, *rows):
    """Change rows from dicts; ``ms`` orders them."""
    from pyspark.sql import functions as F

    from metaloom.schemas import CHANGE_COLUMNS, ENTITY, ORDER, RELATIONSHIPS

    types = {"ord": ORDER, "inserted_attributes": "array<string>", "changed_attributes": "array<string>",
             "deleted_attributes": "array<string>", "inserted_relationships": RELATIONSHIPS,
             "changed_relationships": RELATIONSHIPS, "deleted_relationships": RELATIONSHIPS,
             "direct_change": "boolean", "msg_creation_time": "double", "old_value": ENTITY, "new_value": ENTITY}
    schema = "struct<" + ",".join(f"{c}:{types.get(c, 'string')}" for c in CHANGE_COLUMNS) + ">"

    def full(row):
        out = {"inserted_attributes": [], "changed_attributes": [], "deleted_attributes": [],
               "inserted_relationships": {}, "changed_relationships": {}, "deleted_relationships": {},
               "direct_change": True, **row}
        ms, seq = out.pop("ms", 1), out.pop("seq", 0)
        pos = out.pop("pos", "")
        out["ord"] = {"ms": ms, "pos": pos, "guid": out["guid"], "seq": seq, "digest": ""}
        out["change_id"] = f"{out['guid']}_{ms}_{pos}_{seq}"
        out["msg_creation_time"] = ms / 1000
        for side in ("old_value", "new_value"):
            if out.get(side):
                attributes = {k: json.dumps(v, separators=(",", ":")) for k, v in out[side]["attributes"].items()}
                out[side] = {**out[side], "attributes": attributes}
        return json.dumps(out)

    text = spark.createDataFrame([(full(r),) for r in rows], "j string")
    return text.select(F.from_json("j", schema).alias("c")).select("c.*")


def created(guid, type_name="m4i_data_entity", ms=1, attributes=None, relationships=None):
    return {"guid": guid, "type_name": type_name, "event_type": "EntityCreated", "ms": ms,
            "inserted_relationships": relationships or {},
            "new_value": ent(guid, type_name, attributes, relationships)}


def deleted(guid, type_name="m4i_data_entity", ms=1):
    return {"guid": guid, "type_name": type_name, "event_type": "EntityDeleted", "ms": ms,
            "old_value": ent(guid, type_name)}


def renamed(guid, name, type_name="m4i_data_entity", ms=1, inserted=(), changed=("name",), **more):
    return {"guid": guid, "type_name": type_name, "event_type": "EntityAttributeAudit", "ms": ms,
            "inserted_attributes": list(inserted), "changed_attributes": list(changed),
            "new_value": ent(guid, type_name, {"name": name, **more})}


def audited(guid, type_name, ms=1, seq=1, inserted=None, deleted=None, old=None, new=None):
    return {"guid": guid, "type_name": type_name, "event_type": "EntityRelationshipAudit", "ms": ms, "seq": seq,
            "inserted_relationships": inserted or {}, "deleted_relationships": deleted or {},
            "old_value": ent(guid, type_name, old), "new_value": ent(guid, type_name, new)}
