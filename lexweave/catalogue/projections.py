"""Schema selection, mapped projections and the standard-model tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.catalogue.base import query
from lexweave.catalogue.scans import (
    PART_TYPE,
    PEOPLE_TYPES_SQL,
    project_types,
    section_metadata,
)
from lexweave.config.model import ConfigError, Section, TargetField, TargetTable, load_mapping
from lexweave.config.standard_model import standard_mapping
from lexweave.config.whitelists import case_whitelist, lead_whitelist
from lexweave.fixtures import ORG, Tables
from lexweave.functions import flatten, leads
from lexweave.functions.text import bare_selector
from lexweave.functions.types import DISPLAY_TYPES, lake_schema, to_lake
from lexweave.operators.latest import bounded
from lexweave.plans.mapped import build
from lexweave.plans.standard_model import StandardModel
from lexweave.sinks.tables import write_entity
from lexweave.sources import files, records


def model(typed: bool = False) -> StandardModel:
    return StandardModel(standard_mapping(ORG), typed=typed)


def nulls(*names: str) -> str:
    return ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in names)


TENANT = "101 AS Platform_Org_ID, 101 AS Client_Org_ID"
CUSTOM = nulls("Custom1", "Custom2", "Custom3")

# Standard-model tables ----------------------------------------------------

query("t1_people_types", PEOPLE_TYPES_SQL)(lambda t: model().people_types(t["contact"]))

query("t2_people", f"""
    SELECT {TENANT}, personId AS People_ID, firstName AS First_Name, {nulls("Middle_Name")},
      lastName AS Last_Name, {nulls("Date_of_Birth", "Gender")}, {CUSTOM}
    FROM {{contact}}""")(lambda t: model().people(t["contact"]))


LINKS_SQL = f"""
    SELECT p.People_ID, d.People_Type_Id AS People_Type_ID
    FROM (SELECT personId AS People_ID, unnest(string_split(personTypes, '|')) AS People_Type
          FROM {{contact}}) p
    LEFT JOIN ({PEOPLE_TYPES_SQL}) d ON p.People_Type = d.People_Type
    WHERE p.People_Type <> ''"""


@query("t3_people_type_links", LINKS_SQL)
def people_type_links(t: Tables) -> DataFrame:
    contact = t["contact"]
    return model().people_type_links(contact, model().people_types(contact))


query("t4_cases", f"""
    SELECT {TENANT}, projectId AS Case_ID, projectTypeId AS Practice_Type_ID,
      isArchived AS Is_Archived, incidentDate AS Incident_Date
    FROM {{project}}""")(lambda t: model().cases(t["project"]))

query("t5_practice_types", f"""
    SELECT DISTINCT {TENANT}, projectTypeId AS Practice_Type_ID, typeName AS Practice_Type_Name,
      {CUSTOM}
    FROM {{phase_dim}}""")(lambda t: model().practice_types(project_types(t)))

query("t6_phases", f"""
    SELECT {TENANT}, phaseId AS Phase_ID, name AS Phase_Name, projectTypeId AS Practice_Type_ID,
      {nulls("Phase_Order", "Phase_Category", "Phase_Sub_Category")}, {CUSTOM}
    FROM {{phase_dim}}""")(lambda t: model().phases(project_types(t)))

query("t7_case_figures", f"""
    SELECT {TENANT}, projectId AS Parent_Case_ID, projectId AS Case_ID, {nulls("Case_Figure_ID")},
      type AS Figure_Type, recordsordereddate AS Figure_Date, {nulls("Figure_Status")},
      valueTotal AS Value, {CUSTOM}
    FROM {{meds}}""")(lambda t: model().case_figures(t["meds"]))

query("t8_intake_details", f"""
    SELECT {TENANT}, projectId AS Parent_Case_ID, projectId AS Case_ID, projectId AS Intake_ID,
      personperformingintake AS Person_Performing_Intake_ID, {nulls("Intake_Source")},
      dateofintake AS Date_of_Intake, dateofincident AS Date_of_Incident,
      dUIOrHItAndRun AS DUI_or_HitandRun, referralfee AS Referral_Fee,
      {nulls("If_Case_Referred_In", "If_Qualified_Case", "If_VIP_Lead")}, {CUSTOM}
    FROM {{intake}}""")(lambda t: model().intake_details(t["intake"]))

query("t9_case_details", f"""
    SELECT {TENANT}, projectId AS Parent_Case_ID, projectId AS Case_ID,
      {nulls("Case_Type_ID", "Case_Create_Date")}, dateOfIncident AS Date_of_Incident,
      {nulls("Case_Name", "Plaintiff_Full_Name")}, primaryattorney AS Attorney_ID,
      paralegal AS Prelitigation_Paralegal_ID, paralegal AS Litigation_Paralegal_ID,
      caseManager AS CaseManager_ID, cocounsel AS Cocounsel_ID,
      {nulls("Case_Team_ID", "Insurance_ID", "Case_Status_ID", "Case_Marketing_Source",
             "Case_Source_Name")},
      attorneysFeesAmount AS Attorney_Fee_Percentage,
      projectedsettlementdate AS Projected_Settlement_Date,
      projectedsettlementgoal AS Projected_Settlement_Amount,
      settlementdate AS Actual_Settlement_Date, actualsettlementamount AS Actual_Settlement_Amount,
      caseSettledPresuit AS If_Case_Settled_Presuit, vIPCase AS If_VIP_Case,
      {nulls("If_Case_Referred_Out", "Case_Phase_ID")}, {CUSTOM}, {nulls("Custom4", "Custom5")}
    FROM {{casesummary}}""")(lambda t: model().case_details(t["casesummary"]))


@query("t10_mapped_builder", """
    SELECT 101 AS Tenant, projectId AS Matter, phaseName AS Stage, CAST(NULL AS VARCHAR) AS Notes
    FROM {project}""")
def mapped_builder(t: Tables) -> DataFrame:
    """Any table, from a mapping in the config file's own form."""
    def copied(source: str) -> dict:
        return {"type": "data", "source_entity_name": "project", "source_field": source}

    mapping = load_mapping({"org_id": ORG, "tsm": [{"name": "Matters", "fields": [
        {"name": "Tenant", "data_type": "int", "transform": {"type": "org_id"}},
        {"name": "Matter", "data_type": "int", "transform": copied("projectId")},
        {"name": "Stage", "data_type": "string", "transform": copied("phaseName")},
        {"name": "Notes", "data_type": "string"},
    ]}]})
    return build(t["project"], mapping.table("Matters"), mapping.org_id)


# Schema selection ---------------------------------------------------------


@query("p1_contact_schema", "SELECT personId, firstName, lastName, personTypes FROM {contact}")
def contact_schema(t: Tables) -> DataFrame:
    """Every part declares a field of contacts; two of them are on the whitelist."""
    number = F.col("p_partkey")
    known = F.get(F.array(F.lit("firstName"), F.lit("custom.lastName")), number.cast("int"))
    field = F.struct(
        F.coalesce(known, F.concat(F.lit("custom.f"), number)).alias("fieldSelector"),
        F.lit("Text").alias("customFieldType"),
    )
    pages = t["part"].groupBy(F.floor(number / 100)).agg(F.collect_list(field).alias("customFields"))
    meta = records.section_fields(pages)
    section = case_whitelist().section("contact")
    declared = flatten.field_types(meta, "fieldSelector", "customFieldType", section)
    return flatten.flatten(t.raw_contacts(), flatten.contact_types(declared))


@query("p2_section_schema", f"""
    SELECT concat('f', CAST(p_partkey AS VARCHAR)) AS field, {PART_TYPE} AS field_type
    FROM part WHERE p_partkey IN (1, 2, 3, 4, 14)""")
def section_schema(t: Tables) -> DataFrame:
    """The declared fields that the whitelist names, as the metadata types them."""
    section = Section("intake", ("f1", "f2", "f3", "f4", "f14", "f999999999"))
    meta = records.section_fields(section_metadata(t))
    declared = flatten.field_types(meta, "fieldSelector", "customFieldType", section)
    chosen = flatten.selected_types(declared, "projectId")
    name, kind = bare_selector(F.col("fieldSelector")), F.col("customFieldType")
    named = meta.select(name.alias("field"), kind.alias("field_type"))
    return named.where(F.col("field").isin(*chosen))


@query("x2_registered_rule", """
    SELECT l_orderkey AS projectId, concat('<', l_returnflag, '>') AS note FROM lineitem""")
def registered_rule(t: Tables) -> DataFrame:
    """A field type of a practice's own, flattened by its own rule."""
    flatten.register_rule("Bracketed", lambda c, _: F.concat(F.lit("<"), c, F.lit(">")))
    return flatten.flatten(t.raw_people_fields(), {"projectId": "ProjectId", "note": "Bracketed"})


@query("x5_tenant_override", """
    SELECT phaseName AS Stage, projectId AS Case_ID FROM {project}""")
def tenant_override(t: Tables) -> DataFrame:
    """One customer's own table in place of the common one."""
    common = model().mapping
    own = table(data("Stage", "phaseName"), data("Case_ID", "projectId"))
    mapping = common.with_overrides({"Cases": own})
    assert common.table("Cases") != own
    return build(t["project"], mapping.table("Cases"), mapping.org_id)


@query("p25_missing_source", """
    SELECT projectId AS Case_ID, CAST(NULL AS VARCHAR) AS Nickname FROM {project}""")
def missing_source(t: Tables) -> DataFrame:
    """A source field that the records lack is an error, or a null where that is asked for."""
    own = table(data("Case_ID", "projectId"), data("Nickname", "nickname"))
    try:
        build(t["project"], own, ORG)
    except ConfigError:
        return build(t["project"], own, ORG, strict=False)
    raise AssertionError("a missing source field must be an error")


@query("t1_tenant_types", """
    SELECT org AS tenant, token AS People_Type, dense_rank() OVER (ORDER BY org, token) - 1 AS People_Type_Id
    FROM (SELECT DISTINCT personId % 3 AS org, unnest(string_split(personTypes, '|')) AS token
      FROM {contact}) WHERE token <> ''""")
def tenant_types(t: Tables) -> DataFrame:
    """Person types of several tenants in one frame."""
    several = StandardModel(replace(standard_mapping(ORG), org_id=F.col("org")))
    types = several.people_types(t["contact"].withColumn("org", F.col("personId") % 3))
    return types.select(F.col(types.columns[1]).alias("tenant"), "People_Type", "People_Type_Id")


@query("p3_whitelist_schema", """
    SELECT projectId, phaseName, isArchived, incidentDate, clientId, projectTypeId,
      concat(phaseName, '|tag') AS hashtags, 101 AS orgId FROM {project}""")
def whitelist_schema(t: Tables) -> DataFrame:
    types = flatten.whitelist_types(case_whitelist().section("project"), "projectId")
    return flatten.flatten(records.projects(t.raw_projects()), types)


@query("p4_selector_prefix", """
    SELECT concat('f', CAST(p_partkey AS VARCHAR)) AS field FROM part""")
def selector_prefix(t: Tables) -> DataFrame:
    meta = records.section_fields(section_metadata(t))
    return meta.select(bare_selector(F.col("fieldSelector")).alias("field"))


@query("p5_drop_display_types", f"""
    SELECT concat('custom.f', CAST(p_partkey AS VARCHAR)) AS fieldSelector FROM part
    WHERE {PART_TYPE} <> 'Header'""")
def drop_display_types(t: Tables) -> DataFrame:
    meta = records.section_fields(section_metadata(t))
    return meta.where(~F.col("customFieldType").isin(*DISPLAY_TYPES)).select("fieldSelector")


@query("p6_drop_unknown_fields", """
    SELECT l_orderkey AS projectId, l_returnflag AS note FROM lineitem""")
def drop_unknown_fields(t: Tables) -> DataFrame:
    return flatten.flatten(
        t.raw_people_fields(), {"projectId": "ProjectId", "note": "Text", "banner": "Header"}
    )


@query("p7_forced_keys", """
    SELECT personId, personTypes FROM {contact}""")
def forced_keys(t: Tables) -> DataFrame:
    return flatten.flatten(t.raw_contacts(), flatten.contact_types({}))


@query("p8_lead_whitelist", """
    SELECT s_suppkey AS Id, split_part(s_name, '#', 1) AS FirstName,
      split_part(s_name, '#', 2) AS LastName, concat(s_name, '@x.org') AS Email,
      CAST(s_nationkey AS VARCHAR) AS Code, 'staff' AS Roles, 'read' AS Permissions
    FROM supplier""")
def lead_whitelisted(t: Tables) -> DataFrame:
    return leads.whitelisted(t.raw_users(), lead_whitelist().section("users"))


# Mapped projection --------------------------------------------------------


def table(*fields: TargetField) -> TargetTable:
    return TargetTable("T", "project", fields)


def data(name: str, source: str, kind: str = "string") -> TargetField:
    return TargetField(name, kind, source, "data")


query("p9_mapped_rename", "SELECT projectId AS Case_ID, phaseName AS Phase FROM {project}")(
    lambda t: build(t["project"], table(data("Case_ID", "projectId"), data("Phase", "phasename")),
                    ORG))

query("p10_null_fill", """
    SELECT projectId AS Case_ID, CAST(NULL AS DATE) AS Closed, CAST(NULL AS DOUBLE) AS Fee
    FROM {project}""")(
    lambda t: build(t["project"], table(data("Case_ID", "projectId", "int"),
                                        TargetField("Closed", "date"),
                                        TargetField("Fee", "float")), ORG, typed=True))

query("p11_tenant_columns", """
    SELECT projectTypeId AS Client_Org_ID, projectId AS Case_ID FROM {project}""")(
    lambda t: build(t["project"], table(TargetField("Client_Org_ID", "int", kind="org"),
                                        data("Case_ID", "projectId")), F.col("projectTypeId")))


@query("p11_tenant_map", """
    SELECT n_nationkey AS Client_Org_ID, s_suppkey AS Supplier FROM supplier
    JOIN nation ON s_nationkey = n_nationkey""")
def tenant_map(t: Tables) -> DataFrame:
    """Several tenants in one frame: the tenant comes from a map of organisations."""
    key = F.col("n_nationkey")
    orgs = t["nation"].select(key.alias("s_nationkey"), key.alias("org"))
    records_with_org = t["supplier"].join(orgs, "s_nationkey")
    return build(records_with_org, table(TargetField("Client_Org_ID", "int", kind="org"),
                                         data("Supplier", "s_suppkey")), F.col("org"))


@query("p12_target_order", """
    SELECT phaseName AS a, projectId AS b, isArchived AS c, 'a,b,c' AS column_order
    FROM {project}""")
def target_order(t: Tables) -> DataFrame:
    out = build(t["project"], table(data("a", "phaseName"), data("b", "projectId"),
                                    data("c", "isArchived")), ORG)
    return out.withColumn("column_order", F.lit(",".join(out.columns)))


query("p13_fixed_columns", """
    SELECT personId AS People_ID, lastName AS Last_Name FROM {contact}""")(
    lambda t: model().people(t["contact"]).select("People_ID", "Last_Name"))

query("p14_typed_targets", """
    SELECT projectId AS Case_ID, TRY_CAST(attorneysFeesAmount AS DOUBLE) AS Attorney_Fee_Percentage,
      dateOfIncident AS Date_of_Incident, vIPCase AS If_VIP_Case
    FROM {casesummary}""")(
    lambda t: model(typed=True).case_details(t["casesummary"]).select(
        "Case_ID", "Attorney_Fee_Percentage", "Date_of_Incident", "If_VIP_Case"))


@query("p15_ingest_time", f"""
    SELECT {TENANT}, projectId AS Case_ID, projectTypeId AS Practice_Type_ID,
      isArchived AS Is_Archived, incidentDate AS Incident_Date, '2024-05-06' AS ingested_day
    FROM {{project}}""")
def ingest_time(t: Tables) -> DataFrame:
    from datetime import datetime

    stamped = StandardModel(standard_mapping(ORG), ingested_at=datetime(2024, 5, 6, 12))
    day = F.date_format("date_ingested", "yyyy-MM-dd").alias("ingested_day")
    return stamped.cases(t["project"]).select("*", day).drop("date_ingested")


query("p16_projects_of_type", """
    SELECT projectId, projectTypeId, phaseName FROM {project} WHERE projectTypeId = 2""")(
    lambda t: records.projects_of_type(records.projects(t.raw_projects()), 2)
    .select("projectId", "projectTypeId", "phaseName"))

query("p17_bounded_ids", """
    SELECT projectId FROM {project} WHERE projectId <= 10813786 ORDER BY projectId LIMIT 500""")(
    lambda t: bounded(t["project"].select("projectId"), "projectId", 10_813_786, 500))

query("p18_skip_empty_section", """
    SELECT dateofintake, projectId FROM {intake} WHERE projectId % 2 = 0""")(
    lambda t: records.form_records(t["intake"].select(
        "projectId",
        F.when(F.col("projectId") % 2 == 0, F.struct("dateofintake")).alias("section"))))

query("p19_non_null_ids", """
    SELECT DISTINCT o_orderkey * 10 AS Id FROM orders WHERE o_orderkey % 4 <> 0""")(
    lambda t: records.linked_ids(t.raw_lead_details(), "Opportunity"))

query("p20_drop_column", f"""
    SELECT {TENANT}, projectId AS Case_ID, projectTypeId AS Practice_Type_ID, incidentDate AS Incident_Date
    FROM {{project}}""")(
    lambda t: build(t["project"], standard_mapping(ORG).table("Cases").without("IS_ARCHIVED"), ORG))


@query("p21_duplicate_target", """
    SELECT projectId AS Case_ID, referralfee AS Referral_Fee FROM {intake}""")
def duplicate_target(t: Tables) -> DataFrame:
    fee = data("Referral_Fee", "referralfee")
    return build(t["intake"], table(data("Case_ID", "projectId"), fee, fee), ORG)


query("p22_pruned_scan", "SELECT projectId, isArchived FROM {project}")(
    lambda t: t["project"].select("projectId", "isArchived"))


@query("p22_requested_fields", "SELECT projectId, isArchived FROM {project}")
def requested_fields(t: Tables) -> DataFrame:
    """The requested fields are the declared schema; nothing else is read of a stored entity."""
    path = t.scratch("project")
    write_entity(t["project"], path)
    return files.read_folder(t.spark, path, t["project"].select("projectId", "isArchived").schema)


@query("k7_typed_write", """
    SELECT CAST(projectId AS VARCHAR) AS projectId, TRY_CAST(attorneysFeesAmount AS DOUBLE)
      AS attorneysFeesAmount, dateOfIncident, vIPCase FROM {casesummary}""")
def typed_write(t: Tables) -> DataFrame:
    types = {"projectId": "Id", "attorneysFeesAmount": "decimal", "dateOfIncident": "IncidentDate",
             "vIPCase": "Boolean", "absent": "Text", "banner": "Header"}
    flat = flatten.flatten(t["casesummary"], types)
    path = t.scratch("typed")
    to_lake(flat, lake_schema(types)).write.parquet(path)
    return t.spark.read.parquet(path)
