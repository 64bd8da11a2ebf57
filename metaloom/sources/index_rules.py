"""Rules that index templates and admin tools apply to stored records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.functions.attributes import guids_of, text
from metaloom.functions.state import cut
from metaloom.operators.validate import error
from metaloom.schemas import RETENTION_DAYS

DAY_MS = 86_400_000


def typed_index_projection(df: DataFrame) -> DataFrame:
    """Text columns ``@timestamp``, ``id``, ``msg`` -> timestamp, integer, keyword.

    The timestamp is ISO text or epoch milliseconds.
    """
    stamp = F.col("`@timestamp`")
    return df.select(
        F.coalesce(
            F.timestamp_millis(stamp.try_cast("bigint")),
            F.when(stamp.try_cast("bigint").isNull(), F.try_to_timestamp(stamp)),
        ).alias("@timestamp"),
        F.col("id").try_cast("int").alias("id"),
        F.col("msg").cast("string").alias("msg"),
    )


def flatten_envelope(raw: DataFrame) -> DataFrame:
    """Lift the routing field ``id`` out of a JSON message; keep the whole message as text ``msg``."""
    return raw.select(F.get_json_object("value", "$.id").alias("id"), F.col("value").alias("msg"))


def retention_delete(df: DataFrame, now_ms, days: int = RETENTION_DAYS, time_col: str = "msg_creation_time"
                     ) -> DataFrame:
    """Keep rows that are not older than the retention period."""
    now_ms = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    return df.filter(F.col(time_col) >= now_ms - F.lit(days * DAY_MS))


def export_entities_by_name(entities: DataFrame, types: list[str], contains: str, full: bool = False,
                            attribute: str = "qualifiedName") -> DataFrame:
    """Entities (column ``body``) of the given types whose qualified name contains a text.

    ``full`` adds everything that can be reached over relationships, in as many steps as it takes.
    """
    name = text(F.col("body.attributes"), attribute)
    chosen = entities.filter(F.col("body.typeName").isin(types) & F.contains(name, F.lit(contains)))
    if not full:
        return chosen
    edges = cut(entities.select(
        F.col("body.guid").alias("from"), F.explode(guids_of(F.col("body.relationshipAttributes"))).alias("guid")
    ).distinct())
    reached = frontier = cut(chosen.select(F.col("body.guid").alias("guid")).distinct())
    while not frontier.isEmpty():
        step = edges.join(frontier.withColumnRenamed("guid", "from"), "from", "left_semi").select("guid").distinct()
        frontier = cut(step.join(reached, "guid", "left_anti"))
        reached = cut(reached.unionByName(frontier))
    return entities.join(reached.select(F.col("guid").alias("_guid")), F.col("body.guid") == F.col("_guid"),
                         "left_semi")


def import_entities(versions: DataFrame, exported: DataFrame) -> DataFrame:
    """Load exported versions into a history; a version that is there already stays as it is."""
    new = exported.join(versions.select("doc_id"), "doc_id", "left_anti")
    return versions.unionByName(new.select(*versions.columns))


def import_levels(guids: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((guid, level), (guid, error)): in which order exported entities can be loaded.

    ``edges`` (guid, needs) say what an entity refers to. Level 0 refers to nothing in the set, and each other entity comes one
    level after the last of those it needs. Each round takes off the entities that need nothing any more, so there
    are as many joins as levels. What is left when none can be taken off needs itself by way of others: it is in a
    cycle or after one, and is an error. References out of the set are no obstacle.
    """
    every = cut(guids.select("guid").distinct())
    open_ = edges.select("guid", "needs").distinct().join(every, "guid", "left_semi")
    open_ = cut(open_.join(every.withColumnRenamed("guid", "needs"), "needs", "left_semi").select("guid", "needs"))
    left, levels, level = every, [], 0
    while True:
        free = cut(left.join(open_.select("guid"), "guid", "left_anti"))
        if free.isEmpty():
            break
        levels.append(free.withColumn("level", F.lit(level)))
        left = cut(left.join(free, "guid", "left_anti"))
        open_ = cut(open_.join(free.withColumnRenamed("guid", "needs"), "needs", "left_anti").select("guid", "needs"))
        level += 1
    out = guids.sparkSession.createDataFrame([], "guid string, level int")
    for part in levels:
        out = out.unionByName(part)
    return out, left.withColumn("error", error("import", "cycle", "this entity needs itself by way of others"))


def import_in_order(versions: DataFrame, exported: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(versions to load with their ``level``, errors): of an export, what a history does not have yet.

    Loading level by level never refers to an entity that is still missing.
    """
    new = cut(exported.join(versions.select("doc_id"), "doc_id", "left_anti"))
    edges = new.select(F.col("body.guid").alias("guid"), F.explode(guids_of(F.col("body.relationshipAttributes"))).alias("needs"))
    levels, failed = import_levels(new.select(F.col("body.guid").alias("guid")), edges)
    return new.join(levels, new["body.guid"] == levels["guid"]).drop("guid"), failed
