"""Primitive edits of search documents, and their set-based application.

Operators do not change documents. They emit edit rows - which document, what kind of edit, on which
list entry - and ``apply_edits`` brings all edits of a document together and applies them at once.

kind        meaning
attr        set the scalar ``field`` to ``value``
touch       emit the document, change nothing
link        append (``guid``, ``value``) to the link list ``field``, unless ``guid`` is in it
relink      set the name of the first entry ``guid`` of the link list ``field``
unlink      drop the first entry ``guid`` of the link list ``field``
crumb_name  set the name of ancestor ``guid`` in the breadcrumb
crumb_cut   keep the breadcrumb after ancestor ``guid``; the parent stays as it is
reset       empty breadcrumb, no parent
detach      keep the breadcrumb after ancestor ``guid``; the parent is the last one left
attach      the breadcrumb becomes ``path``, which ends in the parent ``guid``
prepend     put ``path``, which ends in ``guid``, in front of the breadcrumb
finalize    the parent is the last ancestor

``attach`` and ``prepend`` do nothing when ``guid`` is in the breadcrumb already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.functions.packing import pack, unpack
from metaloom.schemas import DOCUMENT_ATTRIBUTES, DOCUMENT_COLUMNS, EDIT, LINK_FIELDS, ORDER, PATH, fields_of

_ALWAYS = ["attr", "touch", "link", "relink", "unlink", "reset"]


def edit(df: DataFrame, kind: str, **columns) -> DataFrame:
    """Edit rows of one kind. ``df`` has ``change_id`` and ``ord``; columns are names or expressions."""
    given = {"kind": F.lit(kind), "change_id": F.col("change_id"), "ord": F.col("ord"),
             **{k: F.col(v) if isinstance(v, str) else v for k, v in columns.items()}}
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields_of(EDIT)])


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def path_of(prefix: str = "") -> Column:
    """Breadcrumb of a document as a list of (guid, name, type)."""
    guids, names, types = (F.col(f"{prefix}breadcrumb{p}") for p in ("guid", "name", "type"))
    return F.transform(
        guids,
        lambda g, i: F.struct(g.alias("guid"), F.get(names, i).alias("name"), F.get(types, i).alias("type")),
    ).cast(PATH)


def path_through(prefix: str = "") -> Column:
    """Breadcrumb for the children of a document: its own one and the document itself."""
    own = F.struct(
        F.col(f"{prefix}guid").alias("guid"), F.col(f"{prefix}name").alias("name"),
        F.col(f"{prefix}typename").alias("type"),
    )
    return F.concat(path_of(prefix), F.array(own).cast(PATH))


def merge_edits(edits: DataFrame) -> DataFrame:
    """One row per document with its list of edits, ``_e``.

    Repeated edits of one entry are reduced first, on the map side: the last one wins, and removing an entry
    wins over renaming it. What is left per document is at most one edit per list entry or attribute, so
    the list is no longer than the document. These rows are then dealt by document as they are.
    """
    slot = F.when(F.col("kind").isin("relink", "unlink"), "entry").otherwise(F.col("kind"))
    single = edits.groupBy("doc", slot.alias("slot"), "field", "guid").agg(
        F.max_by(F.struct("kind", "pos", "value", "path"), F.struct(F.col("kind") == "unlink", "ord")).alias("last"),
        F.min("ord").alias("ord"),
    )
    return single.repartition("doc").groupBy("doc").agg(
        F.collect_list(F.struct("last.kind", "field", "guid", "ord", "last.pos", "last.value", "last.path")).alias("_e")
    )


def _links_after(field: str) -> Column:
    """The entries (guid, name) of one link list after its edits; null when there are none.

    Sorted by guid, an edit stands right before the first entry that it is about, and a new link right after the
    last entry that could make it needless, so each decides by its neighbour: a long list costs n log n.
    """
    item = f"named_struct('guid', {{}}, 'kind', {{}}, 'pos', {{}}, 'ord', CAST({{}} AS {ORDER}), 'name', {{}})"
    of = f"filter(_e, e -> e.field = '{field}' AND e.kind IN ({{}}))"
    return F.expr(f"""
      CASE WHEN exists(_e, e -> e.field = '{field}' AND e.kind IN ('link', 'relink', 'unlink')) THEN
        array_sort(filter(flatten(transform(
          array(array_sort(concat(
            transform({of.format("'relink'")}, e -> {item.format('e.guid', 0, '-1', 'NULL', 'e.value')}),
            transform({of.format("'unlink'")}, e -> {item.format('e.guid', 1, '-1', 'NULL', 'NULL')}),
            transform({field}guid, (g, i) -> {item.format('g', 2, 'i', 'NULL', f'get({field}, i)')}),
            transform({of.format("'link'")}, e -> {item.format('e.guid', 3, '-1', 'e.ord', 'e.value')})))),
          s -> transform(s, (x, i) -> CASE
            WHEN x.kind < 2 THEN NULL
            WHEN x.kind = 2 AND coalesce(get(s, i - 1).guid = x.guid AND get(s, i - 1).kind = 1, false) THEN NULL
            WHEN x.kind = 3 AND coalesce(get(s, i - 1).guid = x.guid AND get(s, i - 1).kind = 2
              AND NOT coalesce(get(s, i - 2).guid = x.guid AND get(s, i - 2).kind = 1, false), false) THEN NULL
            ELSE named_struct('fresh', x.kind = 3, 'pos', x.pos, 'ord', x.ord, 'guid', x.guid, 'name',
              IF(x.kind = 2 AND coalesce(get(s, i - 1).guid = x.guid AND get(s, i - 1).kind = 0, false),
                 get(s, i - 1).name, x.name)) END))), x -> x IS NOT NULL)) END""")


def _has(kind: str) -> str:
    return f"exists(_e, e -> e.kind = '{kind}')"


def _of(kind: str) -> str:
    return f"filter(_e, e -> e.kind = '{kind}')"


_CRUMBS = ["breadcrumbguid", "breadcrumbname", "breadcrumbtype"]
_LAST = "get(breadcrumbguid, size(breadcrumbguid) - 1)"


def _set(df: DataFrame, **columns: str) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in columns.items()})


def _keep_after(df: DataFrame, position: str, **more: str) -> DataFrame:
    """Keep what comes after a 1-based position of the breadcrumb; 0 keeps everything."""
    df = _set(df, _at=f"CAST(coalesce({position}, 0) AS INT)")
    return _set(
        df, **{c: f"IF(_at > 0, slice({c}, _at + 1, greatest(size({c}) - _at, 0)), {c})" for c in _CRUMBS}, **more)


def _rightmost(kind: str) -> str:
    return f"array_max(transform({_of(kind)}, e -> array_position(breadcrumbguid, e.guid)))"


def slots(edits: DataFrame) -> set[tuple[str, str | None]]:
    """The kinds of edits that occur, with their fields: a few dozen at most."""
    return {(r["kind"], r["field"]) for r in edits.select("kind", "field").distinct().collect()}


def apply_edits(docs: DataFrame, edits: DataFrame, present: set[tuple[str, str | None]] | None = None) -> DataFrame:
    """The documents that the edits touch, after the edits.

    ``docs`` needs its guid, parent and breadcrumb; of the other columns, the result has those that are there.
    ``present`` are the edits' ``slots`` or more; what is not among them is left out of the plan.
    """
    def occurs(*kinds: str, field: str | None = None) -> bool:
        return present is None or any(k in kinds and field in (None, f) for k, f in present)

    columns = [c for c in DOCUMENT_COLUMNS if c in docs.columns]
    lists = [f for f in LINK_FIELDS.values() if f in columns and occurs("link", "relink", "unlink", field=f)]
    # Documents meet their edits packed, so that what is dealt and sorted is small.
    docs = docs.select(*columns)
    df = unpack(pack(docs, "guid").join(merge_edits(edits).withColumnRenamed("doc", "guid"), "guid"), docs.schema, "guid")
    df = df.withColumns({f"_{f}": _links_after(f) for f in lists})
    edited = {
        **{
            a: f"IF(exists(_e, e -> e.kind = 'attr' AND e.field = '{a}'), "
               f"get(filter(_e, e -> e.kind = 'attr' AND e.field = '{a}'), 0).value, {a})"
            for a in DOCUMENT_ATTRIBUTES if a in columns and occurs("attr", field=a)
        },
        **{f + "guid": f"coalesce(_{f}.guid, {f}guid)" for f in lists},
        **{f: f"coalesce(_{f}.name, {f})" for f in lists},
    }
    # The many columns that are done travel as one, so that each of the next steps copies few columns.
    done = [c for c in columns if c not in (*_CRUMBS, "parentguid")]
    df = df.select(
        "_e", "parentguid", *_CRUMBS,
        F.struct("parentguid", "breadcrumbguid", "breadcrumbname").alias("_before"),
        F.struct(*[F.expr(edited.get(c, c)).alias(c) for c in done]).alias("_done"),
        *([F.expr(f"map_from_entries(transform({_of('crumb_name')}, e -> struct(e.guid, e.value)))").alias("_names")]
          if occurs("crumb_name") else []),
    )
    if occurs("crumb_name"):
        df = _set(df, breadcrumbname="""
      CASE WHEN size(_names) > 0 AND size(breadcrumbguid) = size(breadcrumbname) THEN transform(breadcrumbname, (n, i) ->
        IF(array_position(breadcrumbguid, get(breadcrumbguid, i)) = i + 1,
           coalesce(try_element_at(_names, get(breadcrumbguid, i)), n), n)) ELSE breadcrumbname END""")
    # Cutting at several ancestors one after the other leaves what follows the rightmost of them.
    if occurs("crumb_cut"):
        df = _keep_after(df, f"""
      CASE WHEN size(breadcrumbguid) = size(breadcrumbname) AND size(breadcrumbguid) = size(breadcrumbtype)
      THEN {_rightmost('crumb_cut')} END""")
    if occurs("reset"):
        df = _set(
            df, **{c: f"IF({_has('reset')}, CAST(array() AS ARRAY<STRING>), {c})" for c in _CRUMBS},
            parentguid=f"IF({_has('reset')}, NULL, parentguid)")
    if occurs("detach"):
        df = _set(_keep_after(df, _rightmost("detach")), parentguid=f"IF(_at > 0, {_LAST}, parentguid)")
    for kind in [k for k in ("attach", "prepend") if occurs(k)]:
        first = f"get({_of(kind)}, 0)"
        df = _set(df, _a=f"IF({_has(kind)} AND NOT array_contains(breadcrumbguid, {first}.guid), {first}.path, NULL)")
        rest = {"attach": "CAST(array() AS ARRAY<STRING>)", "prepend": "breadcrumb{}"}[kind]
        df = _set(df, **{
            f"breadcrumb{part}": f"IF(_a IS NULL, breadcrumb{part}, concat(_a.{part}, {rest.format(part)}))"
            for part in ("guid", "name", "type")
        })
        df = _set(df, parentguid=f"IF(_a IS NULL, parentguid, {_LAST})")
    if occurs("finalize"):
        df = _set(df, parentguid=f"IF({_has('finalize')}, {_LAST}, parentguid)")
    always = ", ".join(f"'{k}'" for k in _ALWAYS)
    emitted = f"exists(_e, e -> e.kind IN ({always})) OR NOT (_before <=> struct(parentguid, breadcrumbguid, breadcrumbname))"
    # One-element inline: a plain filter would be pushed below all of the above, with a copy of it.
    after = [F.col(f"_done.{c}").alias(c) if c in done else F.col(c) for c in columns]
    out = df.select(F.inline(F.array(F.struct(*after, F.expr(emitted).alias("_emitted")))))
    return out.filter("_emitted").drop("_emitted")
