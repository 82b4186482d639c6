"""Joins, aggregates, numbering, latest state and the writers built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.catalogue.base import query
from lexweave.catalogue.feed import phase_log_of
from lexweave.catalogue.projections import LINKS_SQL, model
from lexweave.catalogue.scans import project_types, section_metadata
from lexweave.fixtures import ORG, Tables
from lexweave.functions import leads
from lexweave.functions.text import tokens
from lexweave.operators import checks, latest, numbering, phases
from lexweave.plans.history import PhaseHistory
from lexweave.sinks import tables as sinks
from lexweave.sources import records

# Joins --------------------------------------------------------------------


@query("j1_people_type_join", LINKS_SQL)
def people_type_join(t: Tables) -> DataFrame:
    """As the batch job runs it: the dimension is read back as written."""
    contact, root = t["contact"], t.scratch("model")
    path = sinks.write_table(model().people_types(contact), root, "PeopleTypes")
    return model().people_type_links(contact, t.spark.read.parquet(path))


query("j2_types_with_phases", """
    SELECT projectTypeId, typeName AS name, phaseId FROM {phase_dim}""")(
    lambda t: project_types(t).select("projectTypeId", "name", F.explode("phases").alias("p"))
    .select("projectTypeId", "name", "p.phaseId"))


@query("j3_lead_contact_lookup", """
    SELECT o_orderkey AS Id, c_name AS ContactName FROM orders JOIN customer
      ON o_custkey = c_custkey""")
def lead_contact_lookup(t: Tables) -> DataFrame:
    lead = leads.lead_detail(t.raw_lead_details()).select("Id", "Contact")
    contact = t["customer"].select(F.col("c_custkey").alias("Contact"),
                                   F.col("c_name").alias("ContactName"))
    return lead.join(contact, "Contact").select("Id", "ContactName")


@query("j4_project_sections", """
    SELECT p.projectTypeId, p.projectId, p.phaseName, m.type, m.valueTotal FROM {project} p
    JOIN {meds} m ON p.projectId = m.projectId""")
def project_sections(t: Tables) -> DataFrame:
    """The sections of every project, whatever its type."""
    items = t["meds"].select("projectId", "type", "valueTotal")
    chosen = records.projects(t.raw_projects())
    return records.sections_of(chosen, items, ["projectTypeId", "phaseName"])


def named_phases(t: Tables) -> DataFrame:
    """A phase dimension by type whose names are those the events use."""
    return t["phase_dim"].select(
        "projectTypeId", "phaseId",
        F.concat(F.lit("phase_"), (F.col("phaseId") % 10).cast("string")).alias("name"),
    )


PHASE_LINK = """
    FROM {phase_log} l LEFT JOIN {phase_dim} d ON l.project_type_id = d.projectTypeId
      AND l.phase = concat('phase_', CAST(d.phaseId % 10 AS VARCHAR))"""

query("j5_phase_link", f"""
    SELECT l.project_id, l.event_ts, l.phase, d.phaseId AS phase_id {PHASE_LINK}""")(
    lambda t: phases.with_phase_id(phase_log_of(t), named_phases(t)).select(
        "project_id", "event_ts", "phase", "phase_id"))


@query("t11_phase_changes", f"""
    SELECT 101 AS Platform_Org_ID, '101' AS Client_Org_ID,
      CAST(l.project_id AS INT) AS Parent_Case_ID,
      CAST(l.project_id AS INT) AS Case_ID, d.phaseId AS Phase_ID,
      CAST(epoch_ms(l.event_ts) AS DATE) AS Phase_Change_Date, CAST(NULL AS VARCHAR) AS Custom1,
      CAST(NULL AS VARCHAR) AS Custom2, CAST(NULL AS VARCHAR) AS Custom3 {PHASE_LINK}""")
def phase_changes(t: Tables) -> DataFrame:
    names = named_phases(t)
    types = records.project_types(
        names.select("projectTypeId").distinct(), names.withColumn("isPermanent", F.lit(False))
    )
    return model().phase_changes(phase_log_of(t), types)


# Aggregates ---------------------------------------------------------------


@query("a1_distinct_tokens", """
    SELECT DISTINCT token FROM (
      SELECT unnest(string_split(personTypes, '|')) AS token FROM {contact}) WHERE token <> ''""")
def distinct_tokens(t: Tables) -> DataFrame:
    texts = t["contact"].select("personTypes").distinct()
    return texts.select(F.explode(tokens(F.col("personTypes"))).alias("token")).distinct()


query("a2_profile", """
    SELECT 'contact' AS table_name, count(*) AS n_rows, 'personId' AS column_name,
      count(*) - count(personId) AS n_nulls FROM {contact}
    UNION ALL SELECT 'contact', count(*), 'firstName', count(*) - count(firstName) FROM {contact}
    UNION ALL SELECT 'contact', count(*), 'lastName', count(*) - count(lastName) FROM {contact}
    UNION ALL SELECT 'contact', count(*), 'personTypes', count(*) - count(personTypes)
      FROM {contact}""")(lambda t: checks.profile(t["contact"], "contact"))

query("a3_nested_phases", """
    SELECT projectTypeId, CAST(count(*) AS INT) AS n_phases, min(phaseId) AS first_phase,
      max(phaseId) AS last_phase FROM {phase_dim} GROUP BY projectTypeId""")(
    lambda t: project_types(t).select(
        "projectTypeId", F.size("phases").alias("n_phases"),
        F.get("phases", F.lit(0))["phaseId"].alias("first_phase"),
        F.element_at("phases", -1)["phaseId"].alias("last_phase")))

query("a4_field_types", """
    SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN 'Text' WHEN 1 THEN 'Currency' WHEN 2 THEN 'Date'
      WHEN 3 THEN 'Header' ELSE 'PersonLink' END AS customFieldType FROM part""")(
    lambda t: records.section_fields(section_metadata(t)).select("customFieldType").distinct())

# Numbering and latest state -----------------------------------------------

query("w1_surrogate_key", """
    SELECT phaseName, row_number() OVER (ORDER BY phaseName) - 1 AS phase_key
    FROM (SELECT DISTINCT o_orderstatus AS phaseName FROM orders)""")(
    lambda t: numbering.number_in_order(
        t["project"].select("phaseName").distinct(), "phaseName", "phase_key"))



@query("w1_stable_keys", """
    WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 2 = 0),
      b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM a))
    SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS client_number FROM a
    UNION ALL SELECT o_custkey, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY o_custkey) - 1 FROM b""")
def stable_keys(t: Tables) -> DataFrame:
    """Two loads: the second numbers its new clients after those of the first."""
    keys = numbering.KeyMap(t.scratch("clients"), "o_custkey", "client_number")
    keys.load(t["orders"].where("o_orderkey % 2 = 0"))
    return keys.load(t["orders"])


@query("w1_hashed_key", """
    SELECT count(DISTINCT c_name) AS n_values, count(DISTINCT c_name) AS n_keys,
      CAST(0 AS BIGINT) AS n_collisions FROM customer""")
def hashed_key(t: Tables) -> DataFrame:
    """The key without numbering, for large dimensions: distinct, and checked."""
    keyed = numbering.hashed_key(t["customer"].select("c_name"), "c_name", "name_key")
    pairs = keyed.distinct()
    clashes = numbering.key_collisions(pairs, "c_name", "name_key")
    return pairs.agg(
        F.count("c_name").alias("n_values"), F.count_distinct("name_key").alias("n_keys"),
        clashes.agg(F.count(F.lit(1))).scalar().alias("n_collisions"),
    )


LATEST_SQL = """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1"""


def events_slim(t: Tables) -> DataFrame:
    return t["events"].select("user_id", "event_id", "event_type", "value", "ts")


query("w2_latest_per_key", LATEST_SQL)(
    lambda t: latest.latest_per_key(events_slim(t), ["user_id"], ["ts", "event_id"]).drop("ts"))

HISTORY_SQL = """
    SELECT org_id, project_id, event_ts, phase, lag(phase) OVER w AS previous_phase,
      lead(event_ts) OVER w AS next_ts,
      (lead(event_ts) OVER w - event_ts) // 86400000 AS days_in_phase,
      lead(event_ts) OVER w IS NULL AS is_current
    FROM {phase_log} WINDOW w AS (PARTITION BY project_id ORDER BY event_ts, phase)"""

query("w3_phase_history", HISTORY_SQL)(lambda t: phases.phase_history(phase_log_of(t)))


@query("w3_incremental_history", HISTORY_SQL)
def incremental_history(t: Tables) -> DataFrame:
    """Two loads, each with changes before and between those of the other."""
    history, log = PhaseHistory(t.scratch("history"), buckets=4), phase_log_of(t)
    for half in (0, 1):
        history.load(log.where(F.pmod(F.xxhash64("event_ts"), F.lit(2)) == half))
    return history.read(t.spark)


# Sinks --------------------------------------------------------------------


@query("k1_keyed_upsert", LATEST_SQL)
def keyed_upsert(t: Tables) -> DataFrame:
    """Two loads, the newer events first: the older load must not win."""
    path, events = t.scratch("state"), events_slim(t)
    newer = F.col("event_id") % 2 == 1
    for part in (events.where(newer), events.where(~newer)):
        sinks.upsert(part, path, ["user_id"], ["ts", "event_id"], [], buckets=8)
    return sinks.read_current(t.spark, path).drop("ts")


@query("k2_section_replace", """
    SELECT projectId, id, type FROM {meds} WHERE projectId % 5 <> 0
    UNION ALL SELECT projectId, id, 'new' AS type FROM {meds} WHERE projectId % 10 = 0""")
def section_replace(t: Tables) -> DataFrame:
    """Every fifth project is refreshed; half of those have no items any more."""
    path = t.scratch("meds")
    old = t["meds"].select("projectId", "id", "type", F.lit(ORG).alias("org_id"))
    project = t["meds"].select("projectId", F.lit(ORG).alias("org_id")).distinct()
    new = old.where("projectId % 10 = 0").withColumn("type", F.lit("new"))
    sinks.replace_sections(old, path, ["projectId"], project, ["org_id"], 4)
    sinks.replace_sections(
        new, path, ["projectId"], project.where("projectId % 5 = 0"), ["org_id"], 4
    )
    return sinks.read_current(t.spark, path).select("projectId", "id", "type")


@query("k3_entity_overwrite", "SELECT n_nationkey AS Id, n_name AS Name FROM nation")
def entity_overwrite(t: Tables) -> DataFrame:
    path = t.scratch("referrals")
    rows = t.raw_referrals().select("Id", "Name")
    sinks.write_entity(rows.where("Id < 5"), path)
    sinks.write_entity(rows, path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("k4_phase_append", """
    SELECT org_id, project_type_id, project_id, event_ts, phase FROM {phase_log}""")
def phase_append(t: Tables) -> DataFrame:
    """Two batches, the second one twice as after a restart."""
    path, log = t.scratch("phases"), phase_log_of(t)
    even = F.col("event_ts") % 2 == 0
    sinks.append_batch(log.where(even), path, 0)
    sinks.append_batch(log.where(~even), path, 1)
    sinks.append_batch(log.where(~even), path, 1)
    return t.spark.read.parquet(path).drop("run", "batch_id")


@query("k5_table_overwrite", """
    SELECT 101 AS Platform_Org_ID, 101 AS Client_Org_ID, projectId AS Case_ID,
      projectTypeId AS Practice_Type_ID, isArchived AS Is_Archived, incidentDate AS Incident_Date
    FROM {project}""")
def table_overwrite(t: Tables) -> DataFrame:
    path = sinks.write_table(model().cases(t["project"]), t.scratch("model"), "Cases")
    return t.spark.read.parquet(path)


@query("k6_single_file", "SELECT r_regionkey, r_name, 1 AS n_files FROM region")
def single_file(t: Tables) -> DataFrame:
    path = t.scratch("export")
    sinks.export(t["region"], path, files=1)
    written = t.spark.read.parquet(path)
    return written.withColumn("n_files", F.lit(len(written.inputFiles())))
