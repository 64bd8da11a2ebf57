"""What changes do to documents, one change at a time and in plain Python: the yardstick for the fold."""

from __future__ import annotations

from metaloom.schemas import CREATE_BLACKLIST, DOCUMENT_ATTRIBUTES, HIERARCHY_RULES, LINK_FIELDS


class Failed(Exception):
    pass


def relatives(entity, role):
    names = [a for t, a, r in HIERARCHY_RULES if t == entity["typeName"] and r == role]
    return [r["guid"] for n in names for r in entity["attributes"].get(n) or []]


def index_of(path, guid):
    return next((i for i, step in enumerate(path) if step[0] == guid), None)


def link(one, other):
    entries = one["links"][LINK_FIELDS[other["type"]]]
    if all(g != other["guid"] for g, _ in entries):
        entries.append((other["guid"], other["name"]))


def unlink(one, other):
    entries = one["links"][LINK_FIELDS[other["type"]]]
    hit = next((i for i, (g, _) in enumerate(entries) if g == other["guid"]), None)
    if hit is not None:
        del entries[hit]


def linkable(a, b):
    return a["type"] in LINK_FIELDS and b["type"] in LINK_FIELDS


def last(path):
    return path[-1][0] if path else None


def created(table, change):
    entity = change["new_value"]
    if entity is None:
        raise Failed
    guid, attributes = entity["guid"], entity["attributes"]
    qualified = attributes.get("qualifiedName", guid)
    below_now = {g: [s[0] for s in d["path"]] for g, d in table.items()}
    document = table[guid] = {
        "guid": guid, "type": entity["typeName"], "name": attributes.get("name", qualified), "path": [],
        "parent": None, "definition": attributes.get("definition", ""),
        "email": attributes.get("email") if entity["typeName"] == "m4i_person" else None,
        "links": {f: [] for f in LINK_FIELDS.values()}}
    refs = {r["guid"] for rs in change["inserted_relationships"].values() for r in rs or []
            if r["typeName"] not in CREATE_BLACKLIST}
    linked = {g for g in refs if g in table and linkable(document, table[g])}
    for g in sorted(linked):
        link(document, table[g])
        link(table[g], document)
    parents = relatives(entity, "parent")
    if parents and parents[0] in linked:
        parent = table[parents[0]]
        document["path"] = parent["path"] + [(parent["guid"], parent["name"], parent["type"])]
        document["parent"] = parent["guid"]
    attach(table, document, set(relatives(entity, "child")) & refs, linked, below_now)


def attach(table, document, children, linked, below):
    head = document["path"] + [(document["guid"], document["name"], document["type"])]
    for g in children & linked:
        if index_of(table[g]["path"], document["guid"]) is None:
            table[g]["path"], table[g]["parent"] = list(head), document["guid"]
    for g, ancestors in below.items():
        if g not in children and children & set(ancestors) and index_of(table[g]["path"], document["guid"]) is None:
            table[g]["path"] = head + table[g]["path"]
            table[g]["parent"] = last(table[g]["path"])


def attributes(table, change):
    touched = set(change["inserted_attributes"]) | set(change["changed_attributes"])
    wanted = [a for a in DOCUMENT_ATTRIBUTES if a in touched]
    if not wanted:
        return
    entity, guid = change["new_value"], change["guid"]
    if entity is None or guid not in table or any(a not in entity["attributes"] for a in wanted):
        raise Failed
    if "name" in wanted and entity["attributes"]["name"] is None:
        raise Failed
    for a in wanted:
        table[guid][a] = entity["attributes"][a]
    if "name" in wanted:
        name, field = entity["attributes"]["name"], LINK_FIELDS.get(entity["typeName"])
        for d in table.values():
            i = index_of(d["path"], guid)
            if i is not None:
                d["path"][i] = (guid, name, d["path"][i][2])
            if field:
                hit = next((i for i, (g, _) in enumerate(d["links"][field]) if g == guid), None)
                if hit is not None:
                    d["links"][field][hit] = (guid, name)


def deleted(table, change):
    entity = change["old_value"]
    if entity is None:
        raise Failed
    guid, field = entity["guid"], LINK_FIELDS.get(entity["typeName"])
    for d in table.values():
        i = index_of(d["path"], guid)
        if i is not None:
            d["path"] = d["path"][i + 1:]
        if field:
            unlink(d, {"guid": guid, "type": entity["typeName"]})
    table.pop(guid, None)


def audited(table, change):
    lost_map, new_map = change["deleted_relationships"], change["inserted_relationships"]
    if not lost_map and not new_map:
        return
    if change["guid"] not in table or change["old_value"] is None or change["new_value"] is None:
        raise Failed
    document = table[change["guid"]]
    below = {g: [s[0] for s in d["path"]] for g, d in table.items()}
    edited = False

    def followed(relations, entity):
        parents = relatives(entity, "parent")
        return [r["guid"] for rs in relations.values() for r in rs or [] if r["guid"] not in parents]

    lost = followed(lost_map, change["old_value"])
    if lost:
        linked = {g for g in lost if g in table and linkable(document, table[g])}
        for g in linked:
            unlink(document, table[g])
            unlink(table[g], document)
            edited = True
        if not relatives(change["old_value"], "parent"):
            document["path"], document["parent"], edited = [], None, True
        children = set(relatives(change["old_value"], "child")) & set(lost)
        if not children <= linked or any(document["guid"] not in below[g] for g in children):
            raise Failed
        for g, ancestors in below.items():
            if g in children or children & set(ancestors):
                i = index_of(table[g]["path"], document["guid"])
                if i is not None:
                    table[g]["path"] = table[g]["path"][i + 1:]
                    table[g]["parent"] = last(table[g]["path"])
    new = followed(new_map, change["new_value"])
    if new:
        if len({g for g in new if g in table}) != len(new):
            raise Failed
        linked = {g for g in new if linkable(document, table[g])}
        for g in sorted(linked):
            link(document, table[g])
            link(table[g], document)
            edited = True
        attach(table, document, set(relatives(change["new_value"], "child")) & set(new), linked, below)
    if edited:
        document["parent"] = last(document["path"])


HANDLERS = {"EntityCreated": created, "EntityAttributeAudit": attributes, "EntityDeleted": deleted,
            "EntityRelationshipAudit": audited}


def apply_all(changes):
    """(documents, number of failed changes) of changes in their order, on an empty table."""
    from copy import deepcopy

    table, failed = {}, 0
    for change in sorted(changes, key=lambda c: (c["ms"], c.get("pos", ""), c["guid"], c.get("seq", 0))):
        trial = deepcopy(table)
        row = {"inserted_attributes": [], "changed_attributes": [], "inserted_relationships": {},
               "deleted_relationships": {}, "old_value": None, "new_value": None, **change}
        try:
            HANDLERS[change["event_type"]](trial, row)
            table = trial
        except Failed:
            failed += 1
    return table, failed
