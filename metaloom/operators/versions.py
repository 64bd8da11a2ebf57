"""Versioned entity history and the strict as-of lookup of an entity's previous version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.functions.state import cut
from metaloom.operators.validate import spread, tag
from metaloom.schemas import CREATE, DELETE, ENTITY, ERROR


def versions_reject_missing_entity(messages: DataFrame) -> DataFrame:
    return tag(messages, F.col("entity").isNull(), "versions", "missing_entity", "Entity is required for indexing")


def entity_versions(messages: DataFrame) -> DataFrame:
    """Messages -> versions. The update time of the body becomes the creation time of the message."""
    ok = messages.filter(F.col("entity").isNotNull())
    if "error" in messages.columns:
        ok = ok.filter(F.col("error").isNull())
    return ok.select(
        F.col("entity").withField("updateTime", F.col("msg_creation_time")).alias("body"),
        F.concat_ws("_", F.col("entity.guid"), F.col("msg_creation_time")).alias("doc_id"),
        "event_time",
        "msg_creation_time",
        *(["position"] if "position" in messages.columns else []),
    )


def versions_dedupe(versions: DataFrame, watermark: str | None = None) -> DataFrame:
    """One version per doc_id: the last in the log. Without positions, it is the last by event time, then by body text.

    On a stream, ids are remembered for the length of the watermark, and the first to arrive stays.
    """
    if versions.isStreaming:
        timed = versions.withColumn("_t", F.timestamp_millis("msg_creation_time"))
        return timed.withWatermark("_t", watermark or "1 hour").dropDuplicatesWithinWatermark(["doc_id"]).drop("_t")
    place = [F.col("position")] if "position" in versions.columns else []
    rest = [c for c in versions.columns if c != "doc_id"]
    last = versions.groupBy("doc_id").agg(F.max_by(F.struct(*rest), F.struct(*place, "event_time", F.to_json("body"))).alias("_last"))
    return last.select(*[F.col(c) if c == "doc_id" else F.col(f"_last.{c}").alias(c) for c in versions.columns])


def with_versions(history: DataFrame, fresh: DataFrame) -> DataFrame:
    """The history with new versions in it, which replace those of the same doc_id.

    Only the ids of the new ones meet the history, so a large history is not shuffled for a small batch.
    """
    kept = history.join(fresh.select("doc_id"), "doc_id", "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)


def as_of(messages: DataFrame, versions: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``previous_version``: the newest body of the same guid before (strict) or up to the message.

    The lookup depends on (guid, time) only, so it runs over the distinct pairs: copies of a message collapse on
    the map side. The history is cut down to the guids asked for, and only times are sorted. Times are dealt out
    by ranges of (guid, time); a piece of a guid looks inside itself and falls back to the last version of the
    pieces before it, so a guid of any size is spread over tasks. Bodies are fetched for the answers alone, and the
    answers go back to the messages by equi-joins, which adaptive execution can split.
    """
    ok = F.col("entity").isNotNull()
    if "error" in messages.columns:
        ok = ok & F.col("error").isNull()
    asked = messages.filter(ok).select(
        F.col("entity.guid").alias("_guid"), F.col("msg_creation_time").alias("_t")
    ).distinct()
    history = versions.select(F.col("body.guid").alias("_guid"), F.col("body.updateTime").alias("_t"))
    known = history.join(asked.select("_guid").distinct(), "_guid", "left_semi")
    times = asked.withColumn("_ask", F.lit(True)).unionByName(known.withColumn("_ask", F.lit(False)))
    # Written down, as the pieces must be the same for both of their uses.
    dealt = cut(times.repartitionByRange("_guid", "_t").withColumn("_piece", F.spark_partition_id()))
    version = "CASE WHEN NOT _ask THEN _t END"
    upto = "1 PRECEDING" if strict else "CURRENT ROW"
    seen = dealt.withColumn("_prev", F.expr(
        f"max({version}) OVER (PARTITION BY _guid, _piece ORDER BY _t RANGE BETWEEN UNBOUNDED PRECEDING AND {upto})"))
    carried = dealt.groupBy("_guid", "_piece").agg(F.expr(f"max({version})").alias("_last")).withColumn("_carry", F.expr(
        "max(_last) OVER (PARTITION BY _guid ORDER BY _piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
    found = cut(
        seen.filter("_ask").join(carried.drop("_last"), ["_guid", "_piece"])
        .select("_guid", "_t", F.coalesce("_prev", "_carry").alias("_prev")).filter("_prev IS NOT NULL")
    )
    wanted = found.select(F.col("_guid").alias("_of"), F.col("_prev").alias("_at")).distinct()
    bodies = versions.join(wanted, (F.col("body.guid") == F.col("_of")) & (F.col("body.updateTime") == F.col("_at")))
    bodies = bodies.groupBy("_of", "_at").agg(F.max_by("body", F.to_json("body")).alias("previous_version"))
    answers = found.join(bodies, (F.col("_guid") == F.col("_of")) & (F.col("_prev") == F.col("_at")))
    return messages.withColumn("_key", spread(ok, F.col("entity.guid"))).join(
        answers.select("_guid", "_t", "previous_version"),
        (F.col("_key") == F.col("_guid")) & (F.col("msg_creation_time") == F.col("_t")), "left"
    ).drop("_guid", "_t", "_key")


def previous_version_asof(messages: DataFrame, versions: DataFrame) -> DataFrame:
    """The version with the greatest update time strictly before each message."""
    return as_of(messages, versions, strict=True)


def previous_version_create_bypass(messages: DataFrame) -> DataFrame:
    return messages.withColumn(
        "previous_version", F.when(F.col("operation") == CREATE, F.lit(None).cast(ENTITY))
        .otherwise(F.col("previous_version"))
    )


def previous_version_reject_missing_entity(messages: DataFrame) -> DataFrame:
    return tag(messages, F.col("entity").isNull(), "previous_version", "missing_entity",
               "Entity is required for lookup")


def previous_version_missing(messages: DataFrame, delete_requires_previous: bool = True) -> DataFrame:
    """Updates and deletes without a previous version fail; optionally deletes may go on without one."""
    needs = F.col("operation") != CREATE
    if not delete_requires_previous:
        needs = needs & (F.col("operation") != DELETE)
    return tag(
        messages, needs & F.col("previous_version").isNull(), "previous_version", "no_previous_version",
        F.concat(F.lit("No previous version found for entity "), F.col("entity.guid"), F.lit(" at "),
                 F.col("msg_creation_time").cast("string")),
    )


def publish_state_facade(messages: DataFrame, versions: DataFrame, delete_requires_previous: bool = True) -> DataFrame:
    """The whole previous-version stage."""
    return (
        previous_version_reject_missing_entity(messages)
        .transform(previous_version_asof, versions)
        .transform(previous_version_create_bypass)
        .transform(previous_version_missing, delete_requires_previous)
    )


def previous_version_wait(pending: DataFrame, versions: DataFrame, now_ms: int, max_wait_ms: int = 30_000
                          ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Retry messages that wait for a version. ``pending`` has ``first_seen`` (ms).

    Returns (resolved, still pending, expired); expired rows carry the error.
    """
    tried = cut(publish_state_facade(
        pending.drop("error", "previous_version").withColumn("error", F.lit(None).cast(ERROR)), versions
    ))
    unresolved = F.col("error.kind") == "no_previous_version"
    late = F.lit(now_ms) - F.col("first_seen") > F.lit(max_wait_ms)
    resolved = tried.filter(F.col("error").isNull())
    waiting = tried.filter(unresolved & ~late)
    expired = tried.filter(F.col("error").isNotNull() & (~unresolved | late))
    return resolved, waiting, expired
