"""The driver's tables seen as a metadata catalog: a change log, search documents and change rows.

``events`` is the change log of one entity per user. The star schema is a hierarchy: region (system) >
nation (collection) > customer (dataset) > order (field), with parts (data attributes) linked to orders
and suppliers (persons) linked to parts. Whole tables are used throughout.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.functions.attributes import each, entity, ref
from metaloom.functions.state import cut
from metaloom.operators.edits import union
from metaloom.schemas import (
    ATTRIBUTE_AUDIT,
    CHANGE_COLUMNS,
    CREATED,
    DELETED,
    DOCUMENT,
    ENTITY,
    LINK_FIELDS,
    LISTS,
    ORDER,
    PATH,
    RELATIONSHIP_AUDIT,
    RELATIONSHIPS,
    SCORES,
)

# Types of the users' entities, by user number; the last two are an ignored and an unregistered type.
USER_TYPES = [*LINK_FIELDS, "m4i_source", "unregistered_type"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_STAGED: dict[tuple, DataFrame] = {}


def staged(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """An input table of the catalog, written once per application: the state that operators start from."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STAGED:
        _STAGED[key] = cut(build())
    return _STAGED[key]


def forget() -> None:
    """Forget what was staged; the next query that needs it builds it anew."""
    _STAGED.clear()


# --------------------------------------------------------------------------- change log
def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("U"), F.col("user_id")).alias("guid"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.when(kind == "signup", "ENTITY_CREATE").when(kind == "purchase", "ENTITY_DELETE")
        .when(kind == "error", "CLASSIFICATION_ADD").otherwise("ENTITY_UPDATE").alias("operation"),
        F.element_at(F.array(*[F.lit(t) for t in USER_TYPES]), (F.col("user_id") % len(USER_TYPES) + 1).cast("int"))
        .alias("type_name"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        "value",
        (~((kind == "error") & (F.col("value") > 30))).alias("has_entity"),
    )


def _json_entity() -> Column:
    k = F.col("k")
    alias = F.when(k % 3 == 0, F.lit('"alias":null,')).when(k % 3 == 1, F.lit("")).otherwise(
        F.concat(F.lit('"alias":"a'), (k % 7).cast("string"), F.lit('",')))
    definition = F.when(F.col("value") > 30, F.concat(
        F.lit('"definition":"d'), F.floor("value").cast("string"), F.lit('",'))).otherwise(F.lit(""))
    tags = F.when(k % 2 == 0, '{"z":1,"y":[1, 2]}').otherwise('{"y":[1,2],"z":1}')
    attributes = F.concat(
        F.lit('{"name":"n'), F.floor(k / 10).cast("string"), F.lit('","k":'), k.cast("string"), F.lit(","), alias,
        definition, F.lit('"tags":'), tags, F.lit(',"unmappedAttributes":{}}'),
    )

    def reference(n: Column) -> Column:
        return F.concat(F.lit('{"guid":"U'), n.cast("string"), F.lit('","typeName":"m4i_person"}'))

    relations = F.concat(
        F.lit('{"relA":['), reference(k * 7 % 100), F.lit(","), reference(k * 13 % 100), F.lit('],"relB":['),
        F.when(k % 2 == 0, reference(k)).otherwise(F.lit("")), F.lit('],"relC":null}'),
    )
    return F.concat(
        F.lit('{"guid":"'), F.col("guid"), F.lit('","typeName":"'), F.col("type_name"), F.lit('","attributes":'),
        attributes, F.lit(',"relationshipAttributes":'), relations, F.lit(',"status":"ACTIVE","version":0}'),
    )


def notifications(spark: SparkSession, sf: str) -> DataFrame:
    """Notification text in ``value``, one per event, and its ``position``."""
    found = F.when(F.col("has_entity"), _json_entity()).otherwise(F.lit("null"))
    ms = F.col("ms").cast("string")
    return event_rows(spark, sf).select(
        F.concat(
            F.lit('{"version":{"version":"1.0.0","versionParts":[1]},"msgCompressionKind":"NONE","msgSplitIdx":1,'
                  '"msgSplitCount":1,"msgSourceIp":"10.0.0.1","msgCreatedBy":"catalog","msgCreationTime":'), ms,
            F.lit(',"spooled":false,"message":{"eventTime":'), ms, F.lit(',"operationType":"'), F.col("operation"),
            F.lit('","type":"ENTITY_NOTIFICATION_V2","entity":'), found, F.lit("}}"),
        ).alias("value"),
        F.format_string("%012d", "event_id").alias("position"),
    )


def current_entities(messages: DataFrame) -> DataFrame:
    """(body): the entity of the latest create or update of each guid, unless a delete came later."""
    last = messages.filter(F.col("error").isNull()).groupBy("entity.guid").agg(
        F.max_by(F.struct("operation", "entity"), F.struct("msg_creation_time", "position")).alias("last")
    )
    return last.filter(F.col("last.operation") != "ENTITY_DELETE").select(F.col("last.entity").alias("body"))


def registered_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in USER_TYPES[:-1]], "type_name string")


# --------------------------------------------------------------------------- documents
def listed(rows: DataFrame, key: str, field: str, guid: Column | None = None, name: Column | None = None) -> DataFrame:
    """(key, field): the entries (guid, name) of each key as one list in order; ``rows`` has these or what they are made of.

    The rows are dealt by key as they are: lists do not get smaller when they are put together in pieces first.
    """
    entry = F.struct((F.col("guid") if guid is None else guid).alias("guid"), (F.col("name") if name is None else name).alias("name"))
    return rows.repartition(key).groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias(f"_{field}"))


def assemble_documents(nodes: DataFrame, key: str, *lists: DataFrame) -> DataFrame:
    """Search documents of one type from rows (key, guid, typename, name, path) and their ``listed`` links by key."""
    joined, known = nodes, set()
    for links in lists:
        own = links.withColumnRenamed(links.columns[0], "_key")
        joined = joined.join(own, F.col(key) == F.col("_key"), "left").drop("_key")
        known.add(links.columns[1])
    empty = F.array().cast("array<string>")
    values: dict[str, Column] = {c: F.lit(0.0) for c in SCORES}
    values.update({c: empty for c in LISTS})
    for f in LINK_FIELDS.values():
        if f"_{f}" in known:
            values[f + "guid"] = F.coalesce(each(f"_{f}", "guid"), empty)
            values[f] = F.coalesce(each(f"_{f}", "name"), empty)
    for part in ("guid", "name", "type"):
        values[f"breadcrumb{part}"] = each("path", part)
    values["supertypenames"] = F.array("typename")
    values["parentguid"] = F.get("path", F.size("path") - 1)["guid"]
    for c in ("guid", "typename", "name"):
        values[c] = F.col(c)
    values["id"] = values["referenceablequalifiedname"] = F.col("guid")
    return joined.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DOCUMENT])


def _key(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column))


def _step(prefix: str, key: str, name, type_name: str) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    return F.struct(_key(prefix, key).alias("guid"), name.alias("name"), F.lit(type_name).alias("type"))


def order_name() -> Column:
    return F.concat(F.lit("Order "), F.col("o_orderkey"))


# Prefix of the guids, key, and type of each table's documents.
_TYPES = {
    "region": ("R", "r_regionkey", "m4i_system"), "nation": ("N", "n_nationkey", "m4i_collection"),
    "customer": ("C", "c_custkey", "m4i_dataset"), "orders": ("O", "o_orderkey", "m4i_field"),
    "part": ("P", "p_partkey", "m4i_data_attribute"), "supplier": ("S", "s_suppkey", "m4i_person"),
}


def _guid(name: str) -> Column:
    return _key(*_TYPES[name][:2])


def _name(name: str) -> Column:
    return order_name() if name == "orders" else F.col(f"{name[0]}_name")


class Star:
    """The star schema as documents. Open orders, suppliers or regions can be left out, to be created later."""

    def __init__(self, spark: SparkSession, sf: str, open_orders=True, suppliers=True, regions=True):
        self.spark, self.sf = spark, sf
        self.t = {n: table(spark, sf, n) for n in ("region", "nation", "customer", "orders", "supplier", "part",
                                                   "lineitem")}
        self.open_orders, self.suppliers, self.regions = open_orders, suppliers, regions
        if not open_orders:
            self.t["orders"] = self.t["orders"].filter(F.col("o_orderstatus") != "O")

    def nodes_by_type(self) -> dict[str, DataFrame]:
        """The documents of each table without their links: its key, guid, typename, name and path."""
        t = self.t
        none = F.array().cast(PATH)
        region = t["region"].select(
            "r_regionkey", _key("R", "r_regionkey").alias("guid"), F.lit("m4i_system").alias("typename"),
            F.col("r_name").alias("name"), none.alias("path"))
        root = F.array(_step("R", "r_regionkey", "r_name", "m4i_system")) if self.regions else none
        nation = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", _key("N", "n_nationkey").alias("guid"), F.lit("m4i_collection").alias("typename"),
            F.col("n_name").alias("name"), root.cast(PATH).alias("path"))
        above = nation.select(
            "n_nationkey",
            F.concat("path", F.array(F.struct("guid", "name", F.col("typename").alias("type")))).alias("path"))
        customer = t["customer"].join(above, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "c_custkey", _key("C", "c_custkey").alias("guid"), F.lit("m4i_dataset").alias("typename"),
            F.col("c_name").alias("name"), "path")
        above = customer.select(
            "c_custkey",
            F.concat("path", F.array(F.struct("guid", "name", F.col("typename").alias("type")))).alias("path"))
        order = t["orders"].join(above, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey", _key("O", "o_orderkey").alias("guid"), F.lit("m4i_field").alias("typename"),
            order_name().alias("name"), "path")
        supplier = t["supplier"].select(
            "s_suppkey", _key("S", "s_suppkey").alias("guid"), F.lit("m4i_person").alias("typename"),
            F.col("s_name").alias("name"), none.alias("path"))
        part = t["part"].select(
            "p_partkey", _key("P", "p_partkey").alias("guid"), F.lit("m4i_data_attribute").alias("typename"),
            F.col("p_name").alias("name"), none.alias("path"))
        parts = {"nation": nation, "customer": customer, "orders": order, "part": part}
        if self.regions:
            parts["region"] = region
        if self.suppliers:
            parts["supplier"] = supplier
        return parts

    def nodes(self) -> DataFrame:
        return union(*[df.select("guid", "typename", "name", "path") for df in self.nodes_by_type().values()])

    def pairs(self) -> list[tuple[DataFrame, str, str]]:
        """(pairs, table, table): the linked rows of two tables, with the keys and names that their documents have.

        Each table meets the pairs where they are dealt by its key; what has to be told apart is dealt once for that, too.
        """
        t = self.t
        orders, part = t["orders"].select("o_orderkey", "o_custkey"), t["part"].select("p_partkey", "p_name")
        bought = t["lineitem"].select("l_orderkey", "l_partkey").repartition("l_orderkey").distinct()
        out = [
            (t["orders"].select("o_orderkey", "o_custkey").repartition("o_custkey")
             .join(t["customer"].select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")), "orders", "customer"),
            (bought.join(orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).repartition("l_partkey")
             .join(part, F.col("l_partkey") == F.col("p_partkey")), "orders", "part"),
        ]
        if self.regions:
            out.append((t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")), "nation", "region"))
        if self.suppliers:
            supplied = t["lineitem"].select("l_suppkey", "l_partkey").repartition("l_suppkey").distinct()
            out.append((supplied.join(t["supplier"].select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
                        .repartition("l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")), "supplier", "part"))
        return out

    def links(self) -> DataFrame:
        """(doc, field, guid, name) of all links, both ways."""
        def row(a: str, b: str) -> Column:
            return F.struct(_guid(a).alias("doc"), F.lit(LINK_FIELDS[_TYPES[b][2]]).alias("field"), _guid(b).alias("guid"), _name(b).alias("name"))

        return union(*[df.select(F.inline(F.array(row(a, b), row(b, a)))) for df, a, b in self.pairs()])

    def documents(self) -> DataFrame:
        name = f"documents-{self.open_orders}-{self.suppliers}-{self.regions}"
        return staged(self.spark, self.sf, name, self._documents)

    def _documents(self) -> DataFrame:
        """Type by type: a table's own rows and the links from it are dealt by its key, and meet there."""
        lists: dict[str, list[DataFrame]] = {name: [] for name in _TYPES}
        for df, a, b in self.pairs():
            for x, y in ((a, b), (b, a)):
                # Guids, and the names of orders, are made of keys where the keys have arrived.
                rows = df.select(_TYPES[x][1], _TYPES[y][1], *([] if y == "orders" else [f"{y[0]}_name"]))
                lists[x].append(listed(rows, _TYPES[x][1], LINK_FIELDS[_TYPES[y][2]], _guid(y), _name(y)))
        return union(*[assemble_documents(df, _TYPES[name][1], *lists[name]) for name, df in self.nodes_by_type().items()])


# --------------------------------------------------------------------------- change rows
def _staged_changes(build):
    @wraps(build)
    def get(spark: SparkSession, sf: str) -> DataFrame:
        return staged(spark, sf, build.__name__, lambda: build(spark, sf))

    return get


def change(df: DataFrame, event_type: str, guid: Column, type_name: str, ms, seq: int = 0, **columns: Column
           ) -> DataFrame:
    """Change rows of one kind; what is not given is empty."""
    ms = F.lit(ms) if isinstance(ms, int) else ms
    empty, no_refs = F.array().cast("array<string>"), F.create_map().cast(RELATIONSHIPS)
    nothing = F.lit(None).cast(ENTITY)
    values = {
        "change_id": F.concat_ws("_", guid, ms.cast("string"), F.lit(str(seq))),
        "ord": F.struct(
            ms.cast("bigint").alias("ms"), F.lit("").alias("pos"), guid.alias("guid"), F.lit(seq).alias("seq"),
            F.lit("").alias("digest")).cast(ORDER),
        "type_name": F.lit(type_name),
        "guid": guid,
        "original_event_type": F.lit("ENTITY_UPDATE"),
        "event_type": F.lit(event_type),
        "inserted_attributes": empty, "changed_attributes": empty, "deleted_attributes": empty,
        "inserted_relationships": no_refs, "changed_relationships": no_refs, "deleted_relationships": no_refs,
        "direct_change": F.lit(True),
        "msg_creation_time": ms / F.lit(1000.0),
        "old_value": nothing, "new_value": nothing,
        **columns,
    }
    return df.select(*[values[c].alias(c) for c in CHANGE_COLUMNS])


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def _names(*names: str) -> Column:
    return F.array(*[F.lit(n) for n in names])


@_staged_changes
def renames(spark: SparkSession, sf: str) -> DataFrame:
    """Every nation gets its region in its name; overdrawn customers and the largest parts are renamed.

    Suppliers in debt lose their name, and users have no document: both fail.
    """
    nation, region, customer, part, supplier, events = (
        table(spark, sf, n) for n in ("nation", "region", "customer", "part", "supplier", "events"))

    def renamed(df, prefix, key, type_name, name, ms, definition=None):
        guid = _key(prefix, key)
        pairs = [F.lit("name"), quoted(name)]
        if definition is not None:
            pairs += [F.lit("definition"), quoted(definition)]
        extra = {"inserted_attributes": _names("definition")} if definition is not None else {}
        return change(df, ATTRIBUTE_AUDIT, guid, type_name, ms, changed_attributes=_names("name"),
                      new_value=entity(guid, F.lit(type_name), F.create_map(*pairs), F.create_map()), **extra)

    in_region = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return union(
        renamed(in_region, "N", "n_nationkey", "m4i_collection", F.concat_ws(" of ", "n_name", "r_name"), 1000),
        renamed(customer.filter("c_acctbal < 0"), "C", "c_custkey", "m4i_dataset",
                F.concat("c_name", F.lit(" (overdrawn)")), 2000, F.col("c_mktsegment")),
        renamed(part.filter("p_size = 50"), "P", "p_partkey", "m4i_data_attribute",
                F.concat("p_name", F.lit(" XL")), 3000),
        change(supplier.filter("s_acctbal < 0"), ATTRIBUTE_AUDIT, _key("S", "s_suppkey"), "m4i_person", 4000,
               changed_attributes=_names("name"),
               new_value=entity(_key("S", "s_suppkey"), F.lit("m4i_person"),
                                F.create_map(F.lit("name"), F.lit("null")), F.create_map())),
        renamed(events.select("user_id").distinct(), "U", "user_id", "m4i_person", F.lit("user"), 5000),
    )


@_staged_changes
def deletions(spark: SparkSession, sf: str) -> DataFrame:
    """One region, the nations of suppliers in debt, overdrawn customers, the largest parts, suppliers in debt."""
    nation, region, customer, part, supplier = (
        table(spark, sf, n) for n in ("nation", "region", "customer", "part", "supplier"))
    in_debt = supplier.filter("s_acctbal < 0")

    def gone(df, prefix, key, type_name, ms):
        guid = _key(prefix, key)
        return change(df, DELETED, guid, type_name, ms, original_event_type=F.lit("ENTITY_DELETE"),
                      deleted_attributes=_names("name"),
                      old_value=entity(guid, F.lit(type_name), F.create_map(F.lit("name"), quoted(F.lit("x"))),
                                       F.create_map()))

    return union(
        gone(region.filter("r_name = 'ASIA'"), "R", "r_regionkey", "m4i_system", 1000),
        gone(nation.join(in_debt, F.col("n_nationkey") == F.col("s_nationkey"), "left_semi"), "N", "n_nationkey",
             "m4i_collection", 2000),
        gone(customer.filter("c_acctbal < 0"), "C", "c_custkey", "m4i_dataset", 3000),
        gone(part.filter("p_size = 50"), "P", "p_partkey", "m4i_data_attribute", 4000),
        gone(in_debt, "S", "s_suppkey", "m4i_person", 5000),
    )


def _refs_of(guids: str | Column, type_name: str) -> Column:
    return F.transform(guids, lambda g: ref(g, type_name))


def _ref_json(guids: str | Column, type_name: str) -> Column:
    return F.to_json(F.transform(guids, lambda g: F.struct(g.alias("guid"), F.lit(type_name).alias("typeName"))))


def _urgent(spark: SparkSession, sf: str) -> DataFrame:
    """(owner, moved): urgent orders of each customer."""
    return (
        table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
        .groupBy(F.col("o_custkey").alias("owner")).agg(F.array_sort(F.collect_list(_key("O", "o_orderkey"))).alias("moved"))
    )


@_staged_changes
def losses(spark: SparkSession, sf: str) -> DataFrame:
    """Customers lose their urgent orders.

    Overdrawn customers had no parent any more, and refer to something without a document; the others list
    their parent among the lost references too.
    """
    customer = table(spark, sf, "customer").join(_urgent(spark, sf), F.col("c_custkey") == F.col("owner"))
    guid, parent, none = _key("C", "c_custkey"), F.array(_key("N", "c_nationkey")), F.array().cast("array<string>")
    overdrawn = F.col("c_acctbal") < 0
    in_old = F.when(overdrawn, none).otherwise(parent)
    extra = F.when(overdrawn, F.array(_key("X", "c_custkey"))).otherwise(none)
    old = F.create_map(
        F.lit("fields"), _ref_json("moved", "m4i_field"), F.lit("collections"), _ref_json(in_old, "m4i_collection"))
    return change(
        customer, RELATIONSHIP_AUDIT, guid, "m4i_dataset", 1000, seq=1,
        deleted_relationships=F.create_map(
            F.lit("fields"), _refs_of("moved", "m4i_field"), F.lit("collections"), _refs_of(in_old, "m4i_collection"),
            F.lit("others"), _refs_of(extra, "m4i_person"),
        ).cast(RELATIONSHIPS),
        old_value=entity(guid, F.lit("m4i_dataset"), old, F.create_map()),
        new_value=entity(guid, F.lit("m4i_dataset"), F.create_map(), F.create_map()),
    )


@_staged_changes
def returns(spark: SparkSession, sf: str) -> DataFrame:
    """Orders lose the parts that were returned; their parent is among the lost references."""
    returned = (
        table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_partkey").distinct()
        .groupBy("l_orderkey").agg(F.array_sort(F.collect_list(_key("P", "l_partkey"))).alias("lost"))
    )
    order = table(spark, sf, "orders").join(returned, F.col("o_orderkey") == F.col("l_orderkey"))
    guid = _key("O", "o_orderkey")
    holder = F.array(_key("C", "o_custkey"))
    return change(
        order, RELATIONSHIP_AUDIT, guid, "m4i_field", 2000, seq=1,
        deleted_relationships=F.create_map(
            F.lit("parts"), _refs_of("lost", "m4i_data_attribute"), F.lit("datasets"), _refs_of(holder, "m4i_dataset"),
        ).cast(RELATIONSHIPS),
        old_value=entity(guid, F.lit("m4i_field"),
                         F.create_map(F.lit("datasets"), _ref_json(holder, "m4i_dataset")), F.create_map()),
        new_value=entity(guid, F.lit("m4i_field"), F.create_map(), F.create_map()),
    )


@_staged_changes
def splits(spark: SparkSession, sf: str) -> DataFrame:
    """Every region loses all its nations."""
    region = _with_nations(spark, sf)
    guid = _key("R", "r_regionkey")
    return change(
        region, RELATIONSHIP_AUDIT, guid, "m4i_system", 1000, seq=1,
        deleted_relationships=F.create_map(F.lit("collections"), _refs_of("nations", "m4i_collection"))
        .cast(RELATIONSHIPS),
        old_value=entity(guid, F.lit("m4i_system"), F.create_map(
            F.lit("collections"), _ref_json("nations", "m4i_collection")), F.create_map()),
        new_value=entity(guid, F.lit("m4i_system"), F.create_map(), F.create_map()),
    )


def _with_nations(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").groupBy("n_regionkey").agg(
        F.array_sort(F.collect_list(_key("N", "n_nationkey"))).alias("nations"))
    return table(spark, sf, "region").join(nations, F.col("r_regionkey") == F.col("n_regionkey"))


@_staged_changes
def gains(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer takes over the urgent orders of the customer before.

    Overdrawn customers refer to something without a document as well, so their change fails as a whole.
    """
    before = _urgent(spark, sf).withColumn("c_custkey", F.col("owner") + 1)
    customer = table(spark, sf, "customer").join(before, "c_custkey")
    guid, parent = _key("C", "c_custkey"), F.array(_key("N", "c_nationkey"))
    extra = F.when(F.col("c_acctbal") < 0, F.array(_key("X", "c_custkey"))).otherwise(F.array().cast("array<string>"))
    new = F.create_map(
        F.lit("fields"), _ref_json("moved", "m4i_field"), F.lit("collections"), _ref_json(parent, "m4i_collection"))
    return change(
        customer, RELATIONSHIP_AUDIT, guid, "m4i_dataset", 3000, seq=1,
        inserted_relationships=F.create_map(
            F.lit("fields"), _refs_of("moved", "m4i_field"), F.lit("collections"), _refs_of(parent, "m4i_collection"),
            F.lit("others"), _refs_of(extra, "m4i_person"),
        ).cast(RELATIONSHIPS),
        old_value=entity(guid, F.lit("m4i_dataset"), F.create_map(), F.create_map()),
        new_value=entity(guid, F.lit("m4i_dataset"), new, F.create_map()),
    )


@_staged_changes
def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders and all suppliers are created.

    Suppliers in debt have neither name nor qualified name nor e-mail. Orders refer to a quality record too.
    """
    lineitem = table(spark, sf, "lineitem")
    parts = lineitem.select("l_orderkey", "l_partkey").distinct().groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(_key("P", "l_partkey"))).alias("parts"))
    order = table(spark, sf, "orders").filter("o_orderstatus = 'O'").join(
        parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    none = F.array().cast("array<string>")
    guid, parent = _key("O", "o_orderkey"), F.array(_key("C", "o_custkey"))
    relations = F.create_map(
        F.lit("datasets"), _refs_of(parent, "m4i_dataset"),
        F.lit("parts"), _refs_of(F.coalesce("parts", none), "m4i_data_attribute"),
        F.lit("quality"), _refs_of(F.array(_key("P", "o_custkey")), "m4i_data_quality"),
    ).cast(RELATIONSHIPS)
    orders = change(
        order, CREATED, guid, "m4i_field", 1000, inserted_relationships=relations,
        new_value=entity(guid, F.lit("m4i_field"), F.create_map(
            F.lit("name"), quoted(order_name()), F.lit("qualifiedName"), quoted(F.col("o_orderpriority")),
            F.lit("datasets"), _ref_json(parent, "m4i_dataset")), relations),
    )
    supplied = lineitem.select("l_suppkey", "l_partkey").distinct().groupBy("l_suppkey").agg(
        F.array_sort(F.collect_list(_key("P", "l_partkey"))).alias("parts"))
    supplier = table(spark, sf, "supplier").join(supplied, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    guid = _key("S", "s_suppkey")
    relations = F.create_map(
        F.lit("parts"), _refs_of(F.coalesce("parts", none), "m4i_data_attribute"),
        F.lit("missing"), _refs_of(F.array(_key("X", "s_suppkey")), "m4i_person"),
    ).cast(RELATIONSHIPS)
    attributes = F.when(F.col("s_acctbal") < 0, F.create_map(F.lit("status"), quoted(F.lit("debt")))).otherwise(
        F.create_map(F.lit("name"), quoted(F.col("s_name")), F.lit("definition"), F.lit("null"), F.lit("email"),
                     quoted(F.concat(F.lower("s_name"), F.lit("@example.org")))))
    suppliers = change(
        supplier, CREATED, guid, "m4i_person", 2000, inserted_relationships=relations,
        new_value=entity(guid, F.lit("m4i_person"), attributes, relations),
    )
    return orders.unionByName(suppliers)


@_staged_changes
def new_regions(spark: SparkSession, sf: str) -> DataFrame:
    """All regions are created on top of their nations."""
    region = _with_nations(spark, sf)
    guid = _key("R", "r_regionkey")
    relations = F.create_map(F.lit("collections"), _refs_of("nations", "m4i_collection")).cast(RELATIONSHIPS)
    return change(
        region, CREATED, guid, "m4i_system", 1000, inserted_relationships=relations,
        new_value=entity(guid, F.lit("m4i_system"), F.create_map(
            F.lit("name"), quoted(F.col("r_name")), F.lit("collections"), _ref_json("nations", "m4i_collection")),
            relations),
    )


# --------------------------------------------------------------------------- a life of the star schema
def star_log(spark: SparkSession, sf: str) -> DataFrame:
    """Notification text for a catalog that starts empty.

    Customers and parts are created, then orders under their customers. Overdrawn customers are renamed.
    Customers report their urgent orders, lose them, and take over those of the customer before; overdrawn
    ones also name something that does not exist. In the end overdrawn customers and the largest parts are
    deleted.
    """
    customer, part, orders, lineitem = (table(spark, sf, n) for n in ("customer", "part", "orders", "lineitem"))
    urgent = _urgent(spark, sf).withColumn("c_custkey", F.col("owner")).drop("owner")
    customers = customer.join(urgent, "c_custkey", "left").join(
        urgent.select((F.col("c_custkey") + 1).alias("c_custkey"), F.col("moved").alias("taken")), "c_custkey", "left")
    bought = lineitem.select("l_orderkey", "l_partkey").distinct().groupBy("l_orderkey").agg(
        F.collect_list(_key("P", "l_partkey")).alias("parts"))
    none = F.array().cast("array<string>")
    overdrawn = F.col("c_acctbal") < 0

    def refs(guids: Column, type_name: str) -> Column:
        return F.transform(guids, lambda g: F.struct(g.alias("guid"), F.lit(type_name).alias("typeName")))

    def rows(df: DataFrame, ms: int, operation: str, guid: Column, type_name: str, attributes: dict, relations: dict
             ) -> DataFrame:
        def text_of(fields: dict) -> Column:
            return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])) if fields else F.lit("{}")

        return df.select(F.concat(
            F.lit(f'{{"msgCreationTime":{ms},"message":{{"eventTime":{ms},"operationType":"{operation}",'
                  f'"type":"ENTITY_NOTIFICATION_V2","entity":{{"guid":"'),
            guid, F.lit(f'","typeName":"{type_name}","attributes":'), text_of(attributes),
            F.lit(',"relationshipAttributes":'), text_of(relations), F.lit("}}}"),
        ).alias("value"))

    def of_customers(df, ms, operation, fields=None, others=None):
        renamed = ms >= 4000
        name = F.when(overdrawn & F.lit(renamed), F.concat("c_name", F.lit(" (overdrawn)"))).otherwise(F.col("c_name"))
        attributes = {"name": name, "definition": F.when(overdrawn & F.lit(renamed), F.col("c_mktsegment"))}
        relations = {}
        if fields is not None:
            attributes["fields"] = relations["fields"] = refs(fields, "m4i_field")
            if others is not None:
                relations["others"] = refs(others, "m4i_person")
        return rows(df, ms, operation, _key("C", "c_custkey"), "m4i_dataset", attributes, relations)

    def of_parts(df, ms, operation):
        return rows(df, ms, operation, _key("P", "p_partkey"), "m4i_data_attribute", {"name": F.col("p_name")}, {})

    holder = refs(F.array(_key("C", "o_custkey")), "m4i_dataset")
    owners, takers = customers.filter("moved IS NOT NULL"), customers.filter("taken IS NOT NULL")
    return union(
        of_customers(customers, 1000, "ENTITY_CREATE"),
        of_parts(part, 2000, "ENTITY_CREATE"),
        rows(orders.join(bought, F.col("o_orderkey") == F.col("l_orderkey"), "left"), 3000, "ENTITY_CREATE",
             _key("O", "o_orderkey"), "m4i_field", {"name": order_name(), "datasets": holder},
             {"datasets": holder, "parts": refs(F.coalesce("parts", none), "m4i_data_attribute")}),
        of_customers(customers.filter(overdrawn), 4000, "ENTITY_UPDATE"),
        of_customers(owners, 5000, "ENTITY_UPDATE", F.col("moved")),
        of_customers(owners, 6000, "ENTITY_UPDATE", none),
        of_customers(takers, 7000, "ENTITY_UPDATE", F.col("taken"), F.when(overdrawn, F.array(_key("X", "c_custkey")))),
        of_customers(customers.filter(overdrawn), 8000, "ENTITY_DELETE"),
        of_parts(part.filter("p_size = 50"), 8000, "ENTITY_DELETE"),
    )


def history_of(raw: DataFrame) -> DataFrame:
    """The catalog's own history of the entities in a log, for as-of lookups."""
    from metaloom.operators.validate import split_main_errors, validated
    from metaloom.operators.versions import entity_versions, versions_dedupe

    return versions_dedupe(entity_versions(split_main_errors(validated(raw))[0]))
