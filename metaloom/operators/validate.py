"""Parse, validate, filter and enrich change notifications.

Every stage keeps all rows. A row that fails gets an ``error``; later stages leave such rows alone, and
``split_main_errors`` separates them at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.functions.attributes import canonical
from metaloom.schemas import DELETE, ENTITY, ERROR, IGNORED_TYPES, NOTIFICATION, OPERATIONS, fields_of


def error(stage: str, kind: str, message) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), message.alias("message")).cast(ERROR)


def tag(df: DataFrame, failed: Column, stage: str, kind: str, message) -> DataFrame:
    """Set ``error`` where ``failed`` holds and no earlier stage failed."""
    new = F.when(F.coalesce(failed, F.lit(False)), error(stage, kind, message))
    old = F.col("error") if "error" in df.columns else F.lit(None).cast(ERROR)
    return df.withColumn("error", F.coalesce(old, new))


def _entity(raw: Column) -> Column:
    picked = [
        (canonical(raw[f.name]) if f.name == "attributes" else raw[f.name]).alias(f.name) for f in fields_of(ENTITY)
    ]
    return F.when(raw.isNotNull(), F.struct(*picked))


def parse_notifications(raw: DataFrame) -> DataFrame:
    """JSON text in ``value`` -> one message row; text of another shape gets a validation error.

    ``position`` is where a message stands in the log: it tells messages of one entity and time apart, and
    orders them. A message without one has the empty position and a hash of its text in ``digest``, so that only
    equal messages are the same; the hash tells messages apart, and orders them only where time and guid are equal.
    """
    given = F.col("position") if "position" in raw.columns else F.lit(None).cast("string")
    hashed = F.md5(F.coalesce("value", F.lit("")))
    parsed = raw.select(
        "value", F.coalesce(given, F.lit("")).alias("position"),
        F.when(given.isNull(), hashed).otherwise(F.lit("")).alias("digest"),
        F.from_json("value", NOTIFICATION, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("n"),
    )
    n = F.col("n")
    columns = [
        "value", "position", "digest",
        n["msgCreationTime"].alias("msg_creation_time"),
        n["message"]["eventTime"].alias("event_time"),
        n["message"]["operationType"].alias("operation"),
        n["message"]["type"].alias("message_type"),
        _entity(n["message"]["entity"]).alias("entity"),
        F.struct(
            *[n[f].alias(f) for f in ("version", "msgCompressionKind", "msgSplitIdx", "msgSplitCount", "msgSourceIp",
                                      "msgCreatedBy", "spooled")]
        ).alias("envelope"),
        n["_corrupt"].alias("_corrupt"),
    ]
    # One-element inline: without it, every later filter would be pushed below the parser, with a copy of
    # the parser for each field that it looks at.
    messages = parsed.select(F.inline(F.array(F.struct(*columns))))
    required = ["msg_creation_time", "event_time", "operation", "message_type"]
    bad = F.col("_corrupt").isNotNull()
    for c in required:
        bad = bad | F.col(c).isNull()
    bad = bad | (F.col("entity").isNotNull() & (F.col("entity.guid").isNull() | F.col("entity.typeName").isNull()))
    return tag(messages, bad, "parse", "validation", "notification does not have the expected shape").drop("_corrupt")


def reject_missing_entity(messages: DataFrame) -> DataFrame:
    return tag(messages, F.col("entity").isNull(), "validate", "missing_entity", "No entity found")


def filter_ignored_types(messages: DataFrame, types=IGNORED_TYPES) -> DataFrame:
    return tag(
        messages, F.col("entity.typeName").isin(types), "validate", "ignored_type",
        F.concat(F.lit("Ignoring type: "), F.col("entity.typeName")),
    )


def filter_operations(messages: DataFrame, operations=OPERATIONS) -> DataFrame:
    return tag(
        messages, ~F.col("operation").isin(operations), "validate", "ignored_operation", "Ignoring message type"
    )


def spread(wanted: Column, key: Column) -> Column:
    """Join key: ``key`` where wanted, elsewhere a scattered value that matches nothing."""
    nothing = F.concat(F.lit("\u0000"), F.xxhash64("value", "msg_creation_time").cast("string"))
    return F.when(F.coalesce(wanted, F.lit(False)), key).otherwise(nothing)


def _needs_lookup() -> Column:
    return F.col("error").isNull() & (F.col("operation") != DELETE)


def enrich_current_entity(messages: DataFrame, current: DataFrame, mode: str = "latest") -> DataFrame:
    """Replace the entity of creates and updates by the catalog's full entity; deletes pass unchanged.

    ``current`` holds one ``body`` per (guid, typeName). With ``mode='as_of'`` it is the version history
    instead, and a message sees the newest version not younger than itself, so a replay gives the same
    result. ``looked_up`` tells whether the lookup found something.
    """
    if mode == "as_of":
        from metaloom.operators.versions import as_of

        found = as_of(messages, current, strict=False).withColumn(
            "found", F.when(F.col("previous_version.typeName") == F.col("entity.typeName"), F.col("previous_version"))
        ).drop("previous_version")
    else:
        lookup = current.select(
            F.col("body.guid").alias("_guid"), F.col("body.typeName").alias("_type"), F.col("body").alias("found")
        )
        # Failed rows must not join: they would all meet under the null key.
        # Rows that need no lookup get a key of their own, or all of them would meet under one key.
        keyed = messages.withColumn("_key", spread(_needs_lookup(), F.col("entity.guid")))
        found = keyed.join(
            lookup, (F.col("_key") == F.col("_guid")) & (F.col("entity.typeName") == F.col("_type")), "left"
        ).drop("_guid", "_type", "_key")
    return (
        found.withColumn("looked_up", F.when(_needs_lookup(), F.col("found").isNotNull()))
        .withColumn("entity", F.when(_needs_lookup() & F.col("found").isNotNull(), F.col("found"))
                    .otherwise(F.col("entity")))
        .drop("found")
    )


def reject_unknown_type(messages: DataFrame, types: DataFrame) -> DataFrame:
    """Creates and updates of a type that is not in the type registry (column ``type_name``)."""
    known = types.select(F.col("type_name").alias("_known")).distinct()
    joined = messages.join(known, F.col("entity.typeName") == F.col("_known"), "left")
    return tag(
        joined, (F.col("operation") != DELETE) & F.col("entity").isNotNull() & F.col("_known").isNull(), "lookup",
        "unknown_type", F.concat(F.lit("Unknown entity type: "), F.col("entity.typeName")),
    ).drop("_known")


def reject_lookup_failure(messages: DataFrame) -> DataFrame:
    return tag(
        messages, ~F.col("looked_up"), "lookup", "lookup_failed", "The catalog has no such entity"
    ).drop("looked_up")


def split_main_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col("error").isNull()).drop("error"), df.filter(F.col("error").isNotNull())


def validated(raw: DataFrame) -> DataFrame:
    """All checks that need no lookup, in the order that decides the error kind."""
    return (
        parse_notifications(raw)
        .transform(reject_missing_entity)
        .transform(filter_ignored_types)
        .transform(filter_operations)
    )


def enriched(raw: DataFrame, current: DataFrame, types: DataFrame, mode: str = "latest") -> DataFrame:
    return (
        validated(raw)
        .transform(reject_unknown_type, types)
        .transform(enrich_current_entity, current, mode)
        .transform(reject_lookup_failure)
    )
