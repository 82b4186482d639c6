"""What the jobs wrote, table by table, and the snapshot of every entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.catalogue.base import ORACLES, query
from lexweave.catalogue.projections import LINKS_SQL
from lexweave.catalogue.scans import PEOPLE_TYPES_SQL, lead_frames, project_types
from lexweave.config.standard_model import standard_mapping
from lexweave.config.warehouse import warehouse_table
from lexweave.config.whitelists import lead_whitelist
from lexweave.fixtures import ORG, Tables
from lexweave.functions.types import quoted
from lexweave.operators import snapshots
from lexweave.plans import jobs
from lexweave.plans.standard_model import crm_table
from lexweave.sources.files import union_all

# Lead load ----------------------------------------------------------------

LEAD_CONTENTS = {
    "statuses": "SELECT Id, Status, StatusName, Substatuses FROM {statuses}",
    "leadsource": "SELECT n_nationkey AS Id, n_name AS SourceName FROM nation",
    "casetype": """
        SELECT p_partkey AS Id, p_type AS TypeName, p_brand AS TypeNameShort, p_name AS Code,
          p_size % 2 = 0 AS IsMassTort FROM part""",
    "leadrow": "SELECT Id, ContactId, Code, StatusId FROM {leadrow}",
    "leaddetail": """
        SELECT o_orderkey AS Id, o_orderstatus AS Status, o_custkey AS Contact, o_orderkey % 3 AS PracticeArea,
          CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 7 END AS Intake, o_custkey + 1 AS Creator,
          CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey * 10 END AS Opportunity,
          CASE WHEN o_orderkey % 6 <> 0 THEN concat(o_custkey, ',', o_custkey + 1) END AS RelatedContacts,
          CAST(o_orderkey % 7 AS VARCHAR) AS CustomFields FROM orders""",
    "contact": """
        SELECT c_custkey AS Id, split_part(c_name, '#', 1) AS FirstName,
          concat(c_custkey * 2, ',', c_custkey * 2 + 1) AS LeadIds,
          concat(c_custkey % 5, ',', c_custkey % 3) AS CustomFields FROM customer""",
    "opportunities": """
        SELECT o_orderkey * 10 AS Id, o_orderkey AS LeadId, o_orderstatus AS LeadStatus,
          CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('Ann ', o_orderstatus) END AS AssignedTo,
          CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('Ann ', o_orderstatus) END AS ProcessedBy,
          CAST(o_orderkey % 7 AS VARCHAR) AS CustomFields, o_orderstatus = 'F' AS Processed
        FROM orders WHERE o_orderkey % 4 <> 0""",
    "referrals": """
        SELECT n_nationkey AS Id, n_name AS Name, 'firm' AS Type, CAST(n_regionkey AS VARCHAR) AS Code,
          n_regionkey = 1 AS Outgoing FROM nation""",
    "users": """
        SELECT s_suppkey AS Id, split_part(s_name, '#', 1) AS FirstName, split_part(s_name, '#', 2) AS LastName,
          concat(s_name, '@x.org') AS Email, CAST(s_nationkey AS VARCHAR) AS Code, 'staff' AS Roles,
          'read' AS Permissions FROM supplier""",
}


def loaded_lead(t: Tables, entity: str) -> DataFrame:
    """One entity as the historical load wrote it, every column."""
    landed = {entity: t.landed_leads()[entity]}
    paths = jobs.load_leads(landed, lead_whitelist("acme"), t.scratch("lead"))
    stored = t.spark.read.parquet(paths[entity])
    if entity != "leaddetail":
        return stored
    # Lead details keep their custom fields whole; here each is named by its id.
    ids = F.transform("CustomFields", lambda x: x["CustomFieldId"].cast("string"))
    return stored.withColumn("CustomFields", F.concat_ws(",", ids))


for _entity, _sql in LEAD_CONTENTS.items():
    query(f"t14_loaded_{_entity}", _sql)(lambda t, entity=_entity: loaded_lead(t, entity))


# Case load ----------------------------------------------------------------

CASE_TYPES = {
    "contact": {"personId": "Id", "firstName": "Text", "lastName": "Text", "personTypes": "StringList"},
    "project": {"projectId": "Id", "projectTypeId": "Id", "clientId": "Id", "phaseName": "Text",
                "isArchived": "Boolean", "incidentDate": "Date", "hashtags": "StringList"},
    "intake": {"projectId": "ProjectId", "personperformingintake": "ProjectId", "dateofintake": "Date",
               "dateofincident": "IncidentDate", "dUIOrHItAndRun": "Text", "referralfee": "Currency"},
    "casesummary": {"projectId": "ProjectId", "dateOfIncident": "IncidentDate", "attorneysFeesAmount": "decimal",
                    "vIPCase": "Boolean"},
    "meds": {"projectId": "ProjectId", "id": "Id", "type": "Dropdown", "recordsordereddate": "Date",
             "valueTotal": "decimal"},
}

CASE_CONTENTS = {
    "contact": "SELECT CAST(personId AS VARCHAR) AS personId, firstName, lastName, personTypes FROM {contact}",
    "project": """
        SELECT CAST(projectId AS VARCHAR) AS projectId, CAST(projectTypeId AS VARCHAR) AS projectTypeId, phaseName,
          CAST(clientId AS VARCHAR) AS clientId, isArchived, incidentDate, concat(phaseName, '|tag') AS hashtags
        FROM {project}""",
    "intake": """
        SELECT personperformingintake, projectId, dateofintake, dateofincident, dUIOrHItAndRun,
          CAST(referralfee AS VARCHAR) AS referralfee FROM {intake}""",
    "casesummary": """
        SELECT projectId, dateOfIncident, TRY_CAST(attorneysFeesAmount AS DOUBLE) AS attorneysFeesAmount, vIPCase
        FROM {casesummary}""",
    "meds": """
        SELECT projectId, CAST(id AS VARCHAR) AS id, type, recordsordereddate, valueTotal FROM {meds}""",
}


def landed_case(t: Tables, entity: str) -> DataFrame:
    """An entity of the case system as it lands."""
    raw = {"contact": t.raw_contacts, "project": t.raw_projects, "projecttype": lambda: project_types(t)}
    return raw[entity]() if entity in raw else t[entity]


def loaded_case(t: Tables, entity: str) -> DataFrame:
    """One entity as the historical load wrote it, every column."""
    paths = jobs.load_cases({entity: landed_case(t, entity)}, CASE_TYPES, t.scratch("case"))
    return t.spark.read.parquet(paths[entity])


for _entity, _sql in CASE_CONTENTS.items():
    query(f"t15_loaded_{_entity}", _sql)(lambda t, entity=_entity: loaded_case(t, entity))


@query("t15_loaded_projecttype", """
    SELECT projectTypeId, typeName AS name, phaseId, name AS phase, isPermanent FROM {phase_dim}""")
def loaded_project_types(t: Tables) -> DataFrame:
    """Project types keep their phases nested; here each phase is a row."""
    stored = loaded_case(t, "projecttype").select("projectTypeId", "name", F.explode("phases").alias("p"))
    return stored.select("projectTypeId", "name", "p.phaseId", F.col("p.name").alias("phase"), "p.isPermanent")


# Standard model -----------------------------------------------------------

MODEL_TABLES = {
    "PeopleTypes": ("contact", PEOPLE_TYPES_SQL),
    "Peoples": ("contact", ORACLES["t2_people"]),
    "Peoples_PeopleType": ("contact", LINKS_SQL),
    "Cases": ("project", ORACLES["t4_cases"]),
    "PracticeTypes": ("projecttype", ORACLES["t5_practice_types"]),
    "Phases": ("projecttype", ORACLES["t6_phases"]),
    "CaseFigures": ("meds", ORACLES["t7_case_figures"]),
    "IntakeDetails": ("intake", ORACLES["t8_intake_details"]),
    "CaseDetails": ("casesummary", ORACLES["t9_case_details"]),
}


def model_table(t: Tables, name: str) -> DataFrame:
    """A table of the standard model as the run wrote it."""
    entity = MODEL_TABLES[name][0]
    raw = {entity: project_types(t) if entity == "projecttype" else t[entity]}
    paths = jobs.run_standard_model(raw, t.scratch("model"), standard_mapping(ORG))
    return t.spark.read.parquet(paths[name])


for _name, (_entity, _sql) in MODEL_TABLES.items():
    query(f"t16_written_{_name.lower()}", _sql)(lambda t, name=_name: model_table(t, name))


# Opportunities, all declared columns --------------------------------------

OPPORTUNITY = warehouse_table("CRM_Opportunities")
# Per declared type: the value as Spark and as DuckDB give it, from the key and the column's number.
FILLED = {
    "INT": "CAST(o_orderkey * 3 + {n} AS INT)",
    "BOOLEAN": "(o_orderkey + {n}) % 2 = 0",
    "TIMESTAMP": "CAST(o_orderdate AS TIMESTAMP)",
    "VARCHAR(255)": "CASE WHEN (o_orderkey + {n}) % 9 <> 0 THEN concat('v{n}-', CAST(o_orderkey AS VARCHAR(20))) END",
}
OPPORTUNITY_FIELDS = ",\n".join(
    f"{FILLED[kind].format(n=n)} AS {name}"
    for n, (name, kind) in enumerate(column.strip().rsplit(" ", 1) for column in OPPORTUNITY.body.split(","))
)


@query("t12_crm_opportunities_all_columns", f"""
    SELECT 101 AS Platform_Org_ID, 'acme' AS Client_Org_ID, {OPPORTUNITY_FIELDS} FROM orders""")
def opportunities_all_columns(t: Tables) -> DataFrame:
    """Every declared column filled, in the order in which the table declares them."""
    flat = t.spark.sql(f"SELECT {OPPORTUNITY_FIELDS} FROM {{src}}", src=t["orders"])
    shuffled = flat.select(*[quoted(c) for c in sorted(flat.columns)], F.lit("x").alias("undeclared"))
    return crm_table("opportunities", shuffled, ORG, "acme")


# Snapshots ----------------------------------------------------------------

# (system, entity type, name, project type, id column, label column)
SNAPSHOTS = [
    ("case", "core", "Contact", None, "personId", "lastName"),
    ("case", "core", "ProjectType", None, "projectTypeId", "name"),
    ("case", "core", "Project", 3, "projectId", "phaseName"),
    ("case", "form", "Intake", 2, "projectId", "dUIOrHItAndRun"),
    ("case", "collections", "Meds", 3, "projectId", "id"),
    ("lead", "core", "Statuses", None, "Id", "Status"),
    ("lead", "core", "LeadSource", None, "Id", "SourceName"),
    ("lead", "core", "CaseType", None, "Id", "TypeName"),
    ("lead", "core", "LeadRow", None, "Id", "Status"),
    ("lead", "core", "LeadDetail", None, "Id", "Status"),
    ("lead", "core", "Contact", None, "Id", "FirstName"),
    ("lead", "core", "Opportunities", None, "Id", "LeadStatus"),
    ("lead", "core", "Referrals", None, "Id", "Name"),
    ("lead", "core", "Users", None, "Id", "Email"),
]


@query("t13_every_snapshot", """
    WITH s AS (
      (SELECT 'case' AS system, 'Contact' AS entity, personId AS id, lastName AS label FROM {contact} ORDER BY personId LIMIT 1)
      UNION ALL (SELECT 'case', 'ProjectType', projectTypeId, typeName FROM {phase_dim} ORDER BY projectTypeId LIMIT 1)
      UNION ALL (SELECT 'case', 'Project', projectId, phaseName FROM {project} WHERE projectTypeId = 3
        ORDER BY projectId LIMIT 1)
      UNION ALL (SELECT 'case', 'Intake', projectId, dUIOrHItAndRun FROM {intake} WHERE projectId IN (
        SELECT projectId FROM {project} WHERE projectTypeId = 2) ORDER BY projectId LIMIT 1)
      UNION ALL (SELECT 'case', 'Meds', projectId, CAST(id AS VARCHAR) FROM {meds} WHERE projectId IN (
        SELECT projectId FROM {project} WHERE projectTypeId = 3) ORDER BY projectId, id LIMIT 1)
      UNION ALL (SELECT 'lead', 'Statuses', r_regionkey, ['Unused', 'O', 'P', 'F', 'Other'][r_regionkey + 1] FROM region
        ORDER BY r_regionkey LIMIT 1)
      UNION ALL (SELECT 'lead', 'LeadSource', n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 1)
      UNION ALL (SELECT 'lead', 'CaseType', p_partkey, p_type FROM part ORDER BY p_partkey LIMIT 1)
      UNION ALL (SELECT 'lead', 'LeadRow', o_orderkey, 'O' FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 1)
      UNION ALL (SELECT 'lead', 'LeadDetail', o_orderkey, 'O' FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 1)
      UNION ALL (SELECT 'lead', 'Contact', c_custkey, split_part(c_name, '#', 1) FROM customer WHERE c_custkey = (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 <> 0 ORDER BY o_orderkey LIMIT 1))
      UNION ALL (SELECT 'lead', 'Opportunities', o_orderkey * 10, 'O' FROM orders
        WHERE o_orderstatus = 'O' AND o_orderkey % 4 <> 0 ORDER BY o_orderkey LIMIT 1)
      UNION ALL (SELECT 'lead', 'Referrals', n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 1)
      UNION ALL (SELECT 'lead', 'Users', s_suppkey, concat(s_name, '@x.org') FROM supplier ORDER BY s_suppkey LIMIT 1))
    SELECT system, entity, CAST(id AS BIGINT) AS id, label FROM s""")
def every_snapshot(t: Tables) -> DataFrame:
    """The example record of each entity, through each branch of the choice."""
    landed = t.landed_leads()
    frames = {
        "case": {n: t[n] for n in ("contact", "project", "intake", "meds")} | {"projecttype": project_types(t)},
        "lead": {n: landed[n] for n in ("leadsource", "casetype", "referrals", "users")} | lead_frames(t),
    }
    return union_all([
        snapshots.snapshot(frames[system], system, kind, name, project_type).select(
            F.lit(system).alias("system"), F.lit(name).alias("entity"),
            F.col(key).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"))
        for system, kind, name, project_type, key, label in SNAPSHOTS
    ])
