"""Change events of both systems. Every function takes a batch or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators.latest import latest_per_key

EVENT_SCHEMA = (
    "Timestamp bigint, Object string, Event string, "
    "ObjectId struct<ProjectTypeId: bigint, PhaseId: bigint, SectionSelector: string, "
    "ItemId: string, ProjectId: bigint>, "
    "OrgId bigint, ProjectId bigint, UserId bigint, "
    "Other struct<PhaseName: string, Action: string>"
)
LEAD_EVENT_SCHEMA = "EventType string, LeadId bigint, ContactId bigint, OpportunityId bigint"

# Subscribed (object, event) pairs.
SUBSCRIBED = {
    "Project": ("Created", "PhaseChanged", "Updated"),
    "Form": ("Created", "Updated"),
    "CollectionItem": ("Created", "Deleted", "Updated"),
}

# Lead event type -> (entity, id column).
LEAD_ROUTES = {
    "Lead Edited": ("leaddetail", "LeadId"),
    "Lead Created": ("leaddetail", "LeadId"),
    "Lead Status Changed": ("leaddetail", "LeadId"),
    "Contact Added": ("contact", "ContactId"),
    "Contact Edited": ("contact", "ContactId"),
    "Opportunity Created": ("opportunities", "OpportunityId"),
}


def read_events(
    spark: SparkSession, path: str, schema: str = EVENT_SCHEMA, max_files: int | None = None
) -> DataFrame:
    """A stream of landed JSON events; ``max_files`` bounds what one batch takes."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def parse_events(text: DataFrame, column: str = "value", schema: str = EVENT_SCHEMA) -> DataFrame:
    """Events that arrive as JSON text, as from a message queue."""
    return text.select(F.from_json(column, schema).alias("e")).select("e.*")


def subscribed(events: DataFrame) -> DataFrame:
    """Only the object and event pairs the feed is subscribed to."""
    wanted = F.lit(False)
    for name, kinds in SUBSCRIBED.items():
        wanted = wanted | ((F.col("Object") == name) & F.col("Event").isin(*kinds))
    return events.where(wanted)


def normalise(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One schema for all case-system events.

    A project's own events name it in ``ObjectId`` and concern its core record;
    a phase change and section events name it at the top. ``extra`` columns of
    the input (an arrival number, for instance) are kept.
    """
    is_project = F.col("Object") == "Project"
    is_phase = is_project & (F.col("Event") == "PhaseChanged")
    is_core = is_project & ~is_phase
    body = [c for c in events.columns if c not in extra]
    return events.select(
        F.when(~is_core, F.col("ObjectId.ProjectTypeId")).alias("project_type_id"),
        F.col("OrgId").alias("org_id"),
        F.col("Event").alias("event_name"),
        F.col("Timestamp").alias("event_timestamp"),
        F.col("Object").alias("entity"),
        F.when(is_core, F.col("ObjectId.ProjectId")).otherwise(F.col("ProjectId"))
        .alias("project_id"),
        F.when(is_core, "core").when(~is_phase, F.col("ObjectId.SectionSelector")).alias("section"),
        F.lit(None).cast("bigint").alias("user_id"),
        F.col("ObjectId.ItemId").alias("item_id"),
        F.col("Other.PhaseName").alias("phase"),
        F.to_json(F.struct(*body)).alias("webhook_body"),
        *extra,
    )


def route() -> Column:
    """Where a normalised event goes; null for entities nobody handles."""
    return (
        F.when((F.col("entity") == "Project") & (F.col("event_name") == "PhaseChanged"), "phases")
        .when(F.col("entity") == "Project", "project")
        .when(F.col("entity") == "Form", "form")
        .when(F.col("entity") == "CollectionItem", "collections")
    )


def routed(events: DataFrame) -> DataFrame:
    return events.withColumn("route", route()).where(F.col("route").isNotNull())


def phase_log(events: DataFrame, lateness: str | None = None) -> DataFrame:
    """Phase changes as log rows; the same change seen twice is one row.

    A stream keeps repeats for the reader to merge (``read_phase_log``), so no
    event is ever too late. Where events are late by at most ``lateness``, giving
    it drops repeats in the stream, with state for that long.
    """
    changes = events.where(
        (F.col("entity") == "Project") & (F.col("event_name") == "PhaseChanged")
    ).select(
        "org_id",
        "project_type_id",
        "project_id",
        F.col("event_timestamp").alias("event_ts"),
        "phase",
    )
    if changes.isStreaming and lateness is None:
        return changes
    if changes.isStreaming:
        timed = changes.withColumn("event_time", F.timestamp_millis("event_ts"))
        once = timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(
            ["org_id", "project_type_id", "project_id", "event_ts"]
        )
        return once.drop("event_time")
    keys = ["org_id", "project_type_id", "project_id", "event_ts"]
    return changes.groupBy(*keys).agg(F.max("phase").alias("phase"))


def refresh_keys(events: DataFrame) -> DataFrame:
    """The records that events ask to load again, each once."""
    wanted = routed(events).where(F.col("route") != "phases")
    return wanted.select("route", "org_id", "project_id", "section").distinct()


def with_project_type(events: DataFrame, projects: DataFrame) -> DataFrame:
    """Fill the project type that a project's own events do not carry.

    Only the events without one are joined; the others need no shuffle. Where
    ``projects`` names its tenant (``orgId``), projects match within it.
    """
    names = {"projectId": "project_id", "orgId": "org_id"}
    on = [n for n in names if n in projects.columns]
    known = projects.select(
        *[F.col(n).alias(names[n]) for n in on], F.col("projectTypeId").alias("_known")
    )
    typed = F.col("project_type_id").isNotNull()
    open_events = events.where(~typed).drop("project_type_id")
    filled = open_events.join(known, [names[n] for n in on], "left").withColumnRenamed(
        "_known", "project_type_id"
    )
    return events.where(typed).unionByName(filled)


def latest_events(events: DataFrame, arrival: str) -> DataFrame:
    """Last event of each record by event time, then arrival; late ones lose."""
    keys = ["org_id", "entity", "project_id", "section", "item_id"]
    return latest_per_key(events, keys, ["event_timestamp", arrival])


def route_leads(events: DataFrame) -> DataFrame:
    """Entity and record id of each lead event; unknown types go to ``quarantine``."""
    entity, record = F.lit("quarantine"), F.lit(None).cast("bigint")
    for kind, (target, column) in LEAD_ROUTES.items():
        is_kind = F.col("EventType") == kind
        entity = F.when(is_kind, target).otherwise(entity)
        record = F.when(is_kind, F.col(column)).otherwise(record)
    return events.withColumns({"entity": entity, "record_id": record})
