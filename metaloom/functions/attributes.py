"""Column expressions over entities and their open attribute bag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metaloom.schemas import ENTITY, HIERARCHY_RULES, REF, RELATIONSHIPS, fields_of


#: A string, or a whole number that is written as a fraction.
_STRING_OR_NUMBER = r'("(?:[^"\\]|\\.)*")|(-?[0-9]+)\.0+(?![0-9eE.])'


def canonical(values: Column) -> Column:
    """Map of variants -> map of canonical JSON text. Numbers of one value have one text, at any depth.

    A whole number read as a double loses its zeros (``1e0`` prints as ``1.0``). Inside objects and lists, doubles from
    ten million on still print with an exponent.
    """
    def one(_, v):
        number = F.try_variant_get(v, "$", "double")
        whole = (F.schema_of_variant(v) == "DOUBLE") & (number == F.floor(number)) & (F.abs(number) < 1e15)
        return F.when(whole, number.cast("bigint").cast("string")).otherwise(
            F.regexp_replace(F.to_json(v), _STRING_OR_NUMBER, "$1$2"))

    return F.transform_values(values, one)


def text(attributes: Column, name: str) -> Column:
    """Attribute value as text; null when the key is missing or its value is null."""
    return F.try_variant_get(F.try_parse_json(F.try_element_at(attributes, F.lit(name))), "$", "string")


def relatives(entity: str, role: str, rules=HIERARCHY_RULES) -> Column:
    """Guids of the parents (``role='parent'``) or children of the entity in a column, in list order."""
    branches: dict[str, list[str]] = {}
    for type_name, attribute, kind in rules:
        if kind == role:
            value = f"from_json(try_element_at({entity}.attributes, '{attribute}'), 'array<struct<guid:string>>').guid"
            branches.setdefault(type_name, []).append(f"coalesce({value}, array())")
    cases = " ".join(f"WHEN '{t}' THEN concat({', '.join(lists)})" for t, lists in branches.items())
    none = "CAST(array() AS ARRAY<STRING>)"
    found = f"CASE {entity}.typeName {cases} ELSE {none} END" if cases else none
    return F.expr(f"filter(coalesce({found}, {none}), g -> g IS NOT NULL)")


def each(structs, field: str) -> Column:
    """One field of every struct in a list."""
    return F.transform(structs, lambda s: s[field])


def without_empty(relationships: Column) -> Column:
    """Relationship map without null or empty lists."""
    return F.map_filter(relationships, lambda _, v: F.coalesce(F.size(v), F.lit(0)) > 0)


def all_refs(relationships: Column) -> Column:
    """References of all relationship attributes in one list; null lists count as empty."""
    lists = F.filter(F.map_values(relationships), lambda v: v.isNotNull())
    return F.coalesce(F.flatten(lists), F.array().cast(f"array<{REF}>"))


def guids_of(relationships: Column) -> Column:
    return F.filter(F.transform(all_refs(relationships), lambda r: r["guid"]), lambda g: g.isNotNull())


def ref(guid: Column, type_name) -> Column:
    type_name = F.lit(type_name) if isinstance(type_name, str) else type_name
    return F.struct(
        guid.alias("guid"),
        type_name.alias("typeName"),
        F.lit(None).cast("string").alias("relationshipGuid"),
        F.lit(None).cast("map<string,string>").alias("uniqueAttributes"),
    )


def entity(guid: Column, type_name: Column, attributes: Column, relationships: Column, **more: Column) -> Column:
    """Entity struct with the named fields filled in and all others null."""
    given = {
        "guid": guid,
        "typeName": type_name,
        "attributes": attributes,
        "relationshipAttributes": relationships.cast(RELATIONSHIPS),
        **more,
    }
    return F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields_of(ENTITY)])
