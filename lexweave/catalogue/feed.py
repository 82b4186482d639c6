"""Change events, as a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.catalogue.base import query
from lexweave.catalogue.scans import EVENT_COLUMNS, EVENT_SQL, run_to_end, write_json
from lexweave.fixtures import ORG, Tables
from lexweave.functions import leads
from lexweave.operators import phases
from lexweave.operators.latest import without_deleted
from lexweave.sinks.tables import read_current, read_phase_log
from lexweave.sources import records
from lexweave.streaming import events as ev
from lexweave.streaming import feed


def normalised(t: Tables) -> DataFrame:
    return ev.normalise(ev.subscribed(t.webhook()), extra=("arrival",))


def phase_log_of(t: Tables) -> DataFrame:
    return ev.phase_log(normalised(t))


query("e1_normalise", EVENT_SQL)(lambda t: normalised(t).select(*EVENT_COLUMNS))

ROUTE = """CASE WHEN entity = 'Project' AND event_name = 'PhaseChanged' THEN 'phases'
      WHEN entity = 'Project' THEN 'project' WHEN entity = 'Form' THEN 'form'
      ELSE 'collections' END"""

for name in ("e2_route", "p24_event_predicate"):
    query(name, f"SELECT event_id AS arrival, project_id, {ROUTE} AS route FROM {{webhook}}")(
        lambda t: ev.routed(normalised(t)).select("arrival", "project_id", "route"))

query("e3_phase_log", """
    SELECT org_id, project_type_id, project_id, event_ts, phase FROM {phase_log}""")(phase_log_of)


@query("e4_entity_refresh", """
    SELECT projectId, type, valueTotal FROM {meds} WHERE projectId IN (
      SELECT project_id FROM {webhook} WHERE entity = 'CollectionItem')""")
def entity_refresh(t: Tables) -> DataFrame:
    """Collection items of the projects that collection events name."""
    keys = ev.refresh_keys(normalised(t)).where("route = 'collections'")
    items = records.collection_items(t.raw_items()).select("projectId", "type", "valueTotal")
    ids = keys.select(F.col("project_id").alias("projectId"))
    return records.with_ids(items, ids, "projectId")


LEAD_SQL = """
    SELECT event_id AS arrival,
      CASE EventType WHEN 'Lead Created' THEN 'leaddetail'
        WHEN 'Lead Status Changed' THEN 'leaddetail' WHEN 'Contact Edited' THEN 'contact'
        WHEN 'Opportunity Created' THEN 'opportunities' ELSE 'quarantine' END AS entity,
      CASE EventType WHEN 'Opportunity Created' THEN user_id * 10 WHEN 'Unknown' THEN NULL
        ELSE user_id END AS record_id
    FROM {lead_event}"""

query("e5_lead_routing", LEAD_SQL)(
    lambda t: ev.route_leads(t.lead_events()).select("arrival", "entity", "record_id"))

query("s23_lead_refresh", """
    SELECT o_orderkey AS Id, o_custkey AS Contact FROM orders WHERE o_orderkey IN (
      SELECT user_id FROM {lead_event} WHERE EventType IN ('Lead Created', 'Lead Status Changed'))
    """)(
    lambda t: leads.lead_detail(records.with_ids(
        t.raw_lead_details(),
        ev.route_leads(t.lead_events()).where("entity = 'leaddetail'")
        .select(F.col("record_id").alias("Id")), "Id")).select("Id", "Contact"))


@query("s23_lead_event_stream", """
    SELECT DISTINCT CASE EventType WHEN 'Contact Edited' THEN 'contact'
        WHEN 'Opportunity Created' THEN 'opportunities' ELSE 'leaddetail' END AS entity,
      CASE EventType WHEN 'Opportunity Created' THEN user_id * 10 ELSE user_id END AS record_id
    FROM {lead_event} WHERE EventType <> 'Unknown'""")
def lead_event_stream(t: Tables) -> DataFrame:
    landing, root, mark = t.scratch("landing"), t.scratch("lead"), t.scratch("checkpoint")
    write_json(t.lead_events().drop("arrival"), landing)
    stream = ev.read_events(t.spark, landing, ev.LEAD_EVENT_SCHEMA)
    run_to_end(feed.LeadFeed(root).start(stream, mark))
    return t.spark.read.parquet(f"{root}/refresh").drop("run", "batch_id").distinct()


def lead_feed(t: Tables, entity: str, raw: DataFrame) -> DataFrame:
    """One entity's store after the lead feed has run over all events."""
    landing, root, mark = t.scratch("landing"), t.scratch("lead"), t.scratch("checkpoint")
    write_json(t.lead_events().drop("arrival"), landing)
    stream = ev.read_events(t.spark, landing, ev.LEAD_EVENT_SCHEMA)

    def load(spark: object, keys: DataFrame) -> DataFrame:
        return leads.TRANSFORMS[entity](raw.join(keys, "Id", "left_semi"))

    run_to_end(feed.LeadFeed(root, {entity: load}, buckets=4).start(stream, mark))
    return read_current(t.spark, f"{root}/{entity}/current").drop("load_id")


query("s23_leaddetail_feed", """
    SELECT o_orderkey AS Id, o_orderstatus AS Status, o_custkey AS Contact FROM orders
    WHERE o_orderkey IN (SELECT user_id FROM {lead_event}
      WHERE EventType IN ('Lead Created', 'Lead Status Changed'))""")(
    lambda t: lead_feed(t, "leaddetail", t.raw_lead_details()).select("Id", "Status", "Contact"))

query("s23_contact_feed", """
    SELECT c_custkey AS Id, split_part(c_name, '#', 1) AS FirstName FROM customer
    WHERE c_custkey IN (SELECT user_id FROM {lead_event} WHERE EventType = 'Contact Edited')""")(
    lambda t: lead_feed(t, "contact", t.raw_lead_contacts()).select("Id", "FirstName"))

query("s23_opportunity_feed", """
    SELECT o_orderkey * 10 AS Id, o_orderkey AS LeadId, o_orderstatus AS LeadStatus FROM orders
    WHERE o_orderkey % 4 <> 0 AND o_orderkey * 10 IN (
      SELECT user_id * 10 FROM {lead_event} WHERE EventType = 'Opportunity Created')""")(
    lambda t: lead_feed(t, "opportunities", t.raw_opportunities()).select("Id", "LeadId", "LeadStatus"))


@query("e6_project_type_fill", """
    SELECT w.event_id AS arrival, w.project_id,
      CASE WHEN w.entity = 'Project' AND w.event_name <> 'PhaseChanged' THEN p.projectTypeId
        ELSE w.ptype END AS project_type_id
    FROM {webhook} w LEFT JOIN {project} p ON w.project_id = p.projectId""")
def project_type_fill(t: Tables) -> DataFrame:
    return ev.with_project_type(normalised(t), t["project"]).select(
        "arrival", "project_id", "project_type_id"
    )


@query("e7_deletes", """
    SELECT l_orderkey AS projectId, l_linenumber AS id, l_returnflag AS type FROM lineitem
    WHERE (l_orderkey, CAST(l_linenumber AS VARCHAR)) NOT IN (
      SELECT (project_id, item) FROM (
        SELECT project_id, CAST(event_id % 7 AS VARCHAR) AS item, event_name,
          row_number() OVER (PARTITION BY project_id, event_id % 7
            ORDER BY ts_ms DESC, event_id DESC) AS rn
        FROM {webhook} WHERE entity = 'CollectionItem')
      WHERE rn = 1 AND event_name = 'Deleted')""")
def deletes(t: Tables) -> DataFrame:
    """Items keyed whole: the same item id of another project or tenant stays."""
    keys = ["org_id", "project_id", "section", "item_id"]
    items = t["meds"].select(
        F.lit(ORG).cast("bigint").alias("org_id"), F.col("projectId").alias("project_id"),
        F.lit("meds").alias("section"), F.col("id").cast("string").alias("item_id"), "id", "type",
    )
    events = normalised(t).where("entity = 'CollectionItem'").withColumn(
        "item_id", (F.col("arrival") % 7).cast("string")
    )
    kept = without_deleted(items, events, keys, ["event_timestamp", "arrival"])
    return kept.select(F.col("project_id").alias("projectId"), "id", "type")


query("e8_subscribed_events", """
    SELECT event_id AS arrival, entity, event_name FROM {webhook}
    WHERE (entity = 'Project' AND event_name IN ('Created', 'PhaseChanged', 'Updated'))
      OR (entity = 'Form' AND event_name IN ('Created', 'Updated'))
      OR (entity = 'CollectionItem' AND event_name IN ('Created', 'Deleted', 'Updated'))""")(
    lambda t: ev.normalise(ev.subscribed(t.webhook()), extra=("arrival",)).select(
        "arrival", "entity", "event_name"))

query("e9_late_events", """
    SELECT entity, project_id, section, event_timestamp, event_name FROM (
      SELECT entity, project_id, event_name, ts_ms AS event_timestamp,
        CASE WHEN entity = 'Project' AND event_name <> 'PhaseChanged' THEN 'core'
          ELSE selector END AS section,
        row_number() OVER (PARTITION BY entity, project_id, event_id % 1000,
          CASE WHEN entity = 'Project' AND event_name <> 'PhaseChanged' THEN 'core'
            ELSE selector END
          ORDER BY ts_ms DESC, event_id DESC) AS rn
      FROM {webhook}) WHERE rn = 1""")(
    lambda t: ev.latest_events(normalised(t), "arrival").select(
        "entity", "project_id", "section", "event_timestamp", "event_name"))

CURRENT_SQL = """
    SELECT org_id, project_id, phase AS current_phase, event_ts AS since_ts FROM (
      SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY event_ts DESC, phase DESC) AS rn
      FROM {phase_log}) WHERE rn = 1"""

query("e10_current_phase", CURRENT_SQL)(lambda t: phases.current_phase(phase_log_of(t)))


@query("e9_late_event_stream", """
    SELECT entity, project_id, section, event_timestamp, event_name FROM (
      SELECT entity, project_id, event_name, ts_ms AS event_timestamp,
        CASE WHEN entity = 'Project' AND event_name <> 'PhaseChanged' THEN 'core'
          ELSE selector END AS section,
        row_number() OVER (PARTITION BY entity, project_id, event_id % 1000,
          CASE WHEN entity = 'Project' AND event_name <> 'PhaseChanged' THEN 'core'
            ELSE selector END
          ORDER BY ts_ms DESC, event_name DESC) AS rn
      FROM {webhook}) WHERE rn = 1""")
def late_event_stream(t: Tables) -> DataFrame:
    """The feed over events that arrive in no order, in several batches."""
    runner = feed.CaseFeed(t.scratch("store"), buckets=4)
    landing = t.scratch("landing")
    t.webhook().drop("arrival").repartition(4, F.xxhash64("Timestamp")).write.json(landing)
    run_to_end(runner.start(ev.read_events(t.spark, landing, max_files=2), t.scratch("checkpoint")))
    return runner.last_events(t.spark).select("entity", "project_id", "section", "event_timestamp", "event_name")


@query("e7_feed_deletes", """
    SELECT l_orderkey AS project_id, l_linenumber AS id, l_returnflag AS type FROM lineitem
    WHERE l_orderkey IN (SELECT project_id FROM {webhook} WHERE entity = 'CollectionItem')
      AND (l_orderkey, CAST(l_linenumber AS VARCHAR)) NOT IN (
        SELECT (project_id, item) FROM (
          SELECT project_id, CAST(event_id % 7 AS VARCHAR) AS item, event_name,
            row_number() OVER (PARTITION BY project_id, event_id % 7
              ORDER BY ts_ms DESC, event_name DESC) AS rn
          FROM {webhook} WHERE entity = 'CollectionItem')
        WHERE rn = 1 AND event_name = 'Deleted')""")
def feed_deletes(t: Tables) -> DataFrame:
    """Sections loaded by the feed, without the items whose last event deletes them."""

    def meds(spark: object, keys: DataFrame) -> DataFrame:
        asked = keys.select(F.col("project_id").alias("projectId")).distinct()
        return t["meds"].join(asked, "projectId", "left_semi").select(
            F.lit(ORG).cast("bigint").alias("org_id"), F.col("projectId").alias("project_id"),
            F.lit("meds").alias("section"), F.lit(1).cast("bigint").alias("project_type_id"), "id", "type",
        )

    landing = t.scratch("landing")
    item = F.col("ObjectId").withField("ItemId", (F.col("arrival") % 7).cast("string"))
    one_section = item.withField("SectionSelector", F.lit("meds"))
    events = t.webhook().where("Object = 'CollectionItem'").withColumn("ObjectId", one_section)
    events.drop("arrival").repartition(4, F.xxhash64("Timestamp")).write.json(landing)
    runner = feed.CaseFeed(t.scratch("store"), {"collections": meds}, buckets=4)
    run_to_end(runner.start(ev.read_events(t.spark, landing, max_files=2), t.scratch("checkpoint")))
    return runner.items(t.spark).select("project_id", "id", "type")


def landed_events(t: Tables, untyped: bool = False) -> DataFrame:
    """A stream over landed JSON events, several files a batch."""
    landing = t.scratch("landing")
    events = t.webhook()
    if untyped:
        bare = F.col("ObjectId").withField("ProjectTypeId", F.lit(None).cast("bigint"))
        third = F.col("arrival") % 3 == 0
        events = events.withColumn("ObjectId", F.when(third, bare).otherwise(F.col("ObjectId")))
    events.drop("arrival").repartition("ProjectId").write.json(landing)
    return ev.read_events(t.spark, landing)


@query("e10_current_phase_stream", CURRENT_SQL)
def current_phase_stream(t: Tables) -> DataFrame:
    out, mark = t.scratch("current"), t.scratch("checkpoint")
    run_to_end(feed.stream_current_phase(landed_events(t), out, mark))
    schema = "org_id bigint, project_id bigint, current_phase string, since_ts bigint"
    return read_current(t.spark, out, T.StructType.fromDDL(schema))


@query("e3_phase_stream", """
    SELECT org_id, project_type_id, project_id, event_ts, phase FROM {phase_log}""")
def phase_stream(t: Tables) -> DataFrame:
    out, mark = t.scratch("phases"), t.scratch("checkpoint")
    run_to_end(feed.stream_phases(landed_events(t), out, mark))
    return read_phase_log(t.spark, out)


@query("e4_feed_stream", """
    SELECT project_id, project_id % 3 + 40 AS project_type_id, type, valueTotal FROM (
      SELECT projectId AS project_id, type, valueTotal FROM {meds}) m
    WHERE project_id IN (SELECT project_id FROM {webhook} WHERE entity = 'CollectionItem')""")
def feed_stream(t: Tables) -> DataFrame:
    """The whole feed: events to refreshed collections in the store.

    The records' project types are not the events', and a third of the events has none.
    The loader reads no more of the landed items than the batch's projects.
    """
    root, mark = t.scratch("store"), t.scratch("checkpoint")

    def meds(spark: object, keys: DataFrame) -> DataFrame:
        asked = keys.select(F.col("project_id").alias("projectId")).distinct()
        return t["meds"].join(asked, "projectId", "left_semi").select(
            F.lit(ORG).cast("bigint").alias("org_id"),
            F.col("projectId").alias("project_id"), F.lit("meds").alias("section"),
            "id", "type", "valueTotal", (F.col("projectId") % 3 + 40).alias("project_type_id"),
        )

    runner = feed.CaseFeed(root, {"collections": meds}, buckets=8)
    run_to_end(runner.start(landed_events(t, untyped=True), mark))
    return read_current(t.spark, f"{root}/collections/current").select(
        "project_id", "project_type_id", "type", "valueTotal"
    )
