"""Nested-value and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.catalogue.base import query
from lexweave.catalogue.scans import PART_TYPE, project_types, section_metadata
from lexweave.config.model import TargetField, TargetTable
from lexweave.fixtures import ORG, Tables, epoch_millis
from lexweave.functions import flatten, leads, text
from lexweave.functions.types import (
    LAKE_TYPES,
    WAREHOUSE_TYPES,
    by_inferred_type,
    lake_type_of,
    type_column,
)
from lexweave.operators.latest import chunked_ids
from lexweave.operators.numbering import number_in_order
from lexweave.plans.mapped import build
from lexweave.sinks.tables import write_table
from lexweave.sources import records
from lexweave.sources.files import file_path, read_table


def flat(t: Tables, **types: str) -> DataFrame:
    return flatten.flatten(
        t.raw_people_fields(), {"projectId": "ProjectId", "line": "int", **types}
    )


BASE = "l_orderkey AS projectId, l_linenumber AS line"

query("v1_id", f"SELECT {BASE}, l_partkey AS partId, l_suppkey AS scalarId FROM lineitem")(
    lambda t: flat(t, partId="Id", scalarId="Id"))


@query("v1_id_of_variant", """
    SELECT o_orderkey AS projectId,
      CASE WHEN o_orderkey % 3 <> 2 THEN CAST(o_custkey AS VARCHAR) END AS clientId
    FROM orders""")
def id_of_variant(t: Tables) -> DataFrame:
    """A field that is sometimes the id, sometimes an object around it."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    json = F.when(key % 3 == 0, cust).when(
        key % 3 == 1, F.concat(F.lit('{"native":'), cust, F.lit("}")))
    mixed = t["orders"].select(key.alias("projectId"), F.parse_json(json).alias("clientId"))
    return flatten.flatten(mixed, {"projectId": "int", "clientId": "Id"})


query("v2_person_link", f"""
    SELECT {BASE}, CASE WHEN l_linenumber <> 3 THEN l_suppkey END AS adjuster FROM lineitem""")(
    lambda t: flat(t, adjuster="PersonLink"))

query("v3_person_list", f"""
    SELECT {BASE}, CASE WHEN l_linenumber IN (1, 2) THEN ''
      ELSE concat(CAST(l_suppkey AS VARCHAR), '|', CAST(l_partkey AS VARCHAR)) END AS witnesses
    FROM lineitem""")(lambda t: flat(t, witnesses="PersonList"))

query("v4_string_list", f"""
    SELECT {BASE}, CASE WHEN l_linenumber <> 4 THEN l_returnflag || '|' || l_linestatus END AS flags
    FROM lineitem""")(lambda t: flat(t, flags="StringList"))

query("v5_other_list", f"""
    SELECT {BASE}, l_returnflag AS gaps, l_linenumber AS first_number FROM lineitem""")(
    lambda t: flat(t, gaps="MultiSelectList", numbers="Text").select(
        "projectId", "line", "gaps", F.get("numbers", F.lit(0)).alias("first_number")))

query("v6_object", f"""
    SELECT {BASE}, l_quantity AS qty, l_returnflag AS flag FROM lineitem""")(
    lambda t: flat(t, details="object").select("projectId", "line", "details.qty", "details.flag"))

query("v7_scalar", f"SELECT {BASE}, l_returnflag AS note FROM lineitem")(
    lambda t: flat(t, note="Text"))

query("v8_text_record", """
    SELECT l_orderkey AS projectId, concat('{"flag":"', l_returnflag, '"}') AS details,
      CASE WHEN l_linenumber <> 4 THEN l_returnflag || '|' || l_linestatus END AS flags
    FROM lineitem""")(
    lambda t: flatten.as_text_record(
        t.raw_people_fields().withColumn("details", F.struct(F.col("details.flag"))),
        {"projectId": "int", "details": "object", "flags": "StringList"}))

query("v9_metadata_map", f"""
    SELECT concat('f', CAST(p_partkey AS VARCHAR)) AS field, {PART_TYPE} AS field_type
    FROM part""")(
    lambda t: records.section_fields(section_metadata(t)).select(
        text.bare_selector(F.col("fieldSelector")).alias("field"),
        F.col("customFieldType").alias("field_type")))

query("v10_lead_detail_links", """
    SELECT o_orderkey AS Id, o_custkey AS Contact, o_orderkey % 3 AS PracticeArea,
      CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 7 END AS Intake, o_custkey + 1 AS Creator,
      CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey * 10 END AS Opportunity
    FROM orders""")(
    lambda t: leads.lead_detail(t.raw_lead_details()).select(
        "Id", "Contact", "PracticeArea", "Intake", "Creator", "Opportunity"))

query("v11_lead_detail_lists", """
    SELECT o_orderkey AS Id, CASE WHEN o_orderkey % 6 <> 0
      THEN concat(CAST(o_custkey AS VARCHAR), ',', CAST(o_custkey + 1 AS VARCHAR)) END
      AS RelatedContacts
    FROM orders""")(
    lambda t: leads.lead_detail(t.raw_lead_details()).select("Id", "RelatedContacts"))

query("v12_lead_custom_fields", """
    SELECT o_orderkey AS Id, 1 AS n_fields, o_orderkey % 7 AS first_field FROM orders""")(
    lambda t: leads.lead_detail(t.raw_lead_details()).select(
        "Id", F.size("CustomFields").alias("n_fields"),
        F.get("CustomFields", F.lit(0))["CustomFieldId"].alias("first_field")))

query("v13_contact_lists", """
    SELECT c_custkey AS Id, split_part(c_name, '#', 1) AS FirstName,
      concat(CAST(c_custkey * 2 AS VARCHAR), ',', CAST(c_custkey * 2 + 1 AS VARCHAR)) AS LeadIds,
      concat(CAST(c_custkey % 5 AS VARCHAR), ',', CAST(c_custkey % 3 AS VARCHAR)) AS CustomFields
    FROM customer""")(lambda t: leads.contact(t.raw_lead_contacts()))

OPPORTUNITY = "FROM orders WHERE o_orderkey % 4 <> 0"

query("v14_opportunity_custom_fields", f"""
    SELECT o_orderkey * 10 AS Id, CAST(o_orderkey % 7 AS VARCHAR) AS CustomFields {OPPORTUNITY}""")(
    lambda t: leads.opportunity(t.raw_opportunities()).select("Id", "CustomFields"))

query("v15_opportunity_assignee", f"""
    SELECT o_orderkey * 10 AS Id,
      CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('Ann ', o_orderstatus) END AS AssignedTo
    {OPPORTUNITY}""")(
    lambda t: leads.opportunity(t.raw_opportunities()).select("Id", "AssignedTo"))

query("v16_opportunity_processor", f"""
    SELECT o_orderkey * 10 AS Id,
      CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('Ann ', o_orderstatus) END AS ProcessedBy
    {OPPORTUNITY}""")(
    lambda t: leads.opportunity(t.raw_opportunities()).select("Id", "ProcessedBy"))

query("v17_pass_through", "SELECT Id, ContactId, Code, StatusId FROM {leadrow}")(
    lambda t: leads.TRANSFORMS["leadrow"](t["leadrow"]))

query("v18_split", """
    SELECT personId, CAST(len(string_split(personTypes, '|')) AS INT) AS n_parts FROM {contact}""")(
    lambda t: t["contact"].select(
        "personId",
        F.when(F.col("personTypes").isNotNull(), F.size(text.parts(F.col("personTypes"))))
        .alias("n_parts")))

query("v19_explode", """
    SELECT personId, token FROM (
      SELECT personId, unnest(string_split(personTypes, '|')) AS token FROM {contact})
    WHERE token <> ''""")(
    lambda t: t["contact"].select(
        "personId", F.explode(text.tokens(F.col("personTypes"))).alias("token")))

query("v20_exploded_struct", """
    SELECT projectTypeId, phaseId, name, isPermanent FROM {phase_dim}""")(
    lambda t: project_types(t).select("projectTypeId", F.explode("phases").alias("p"))
    .select("projectTypeId", "p.phaseId", "p.name", "p.isPermanent"))

query("v21_tenant_of_url", """
    SELECT c_custkey, lower(c_mktsegment) AS tenant FROM customer""")(
    lambda t: t["customer"].select(
        "c_custkey",
        text.tenant_of_url(F.concat(F.lit("https://"), F.lower("c_mktsegment"),
                                    F.lit(".host.com/a.b"))).alias("tenant")))


@query("v22_uri_parts", """
    SELECT page_id, lower(split_part(split_part(url, '://', 2), '/', 1)) AS bucket,
      concat('k/', CAST(page_id AS VARCHAR), '.parquet') AS key FROM pages""")
def uri_parts(t: Tables) -> DataFrame:
    host = F.lower(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)))
    uri = F.concat(F.lit("s3://"), host, F.lit("/k/"), "page_id", F.lit(".parquet"))
    bucket, key = text.uri_parts(uri)
    return t["pages"].select("page_id", bucket.alias("bucket"), key.alias("key"))


query("v23_type_mapping", """
    SELECT p_partkey, field_type,
      CASE field_type WHEN 'Date' THEN 'date' ELSE 'string' END AS lake_type,
      CAST(NULL AS VARCHAR) AS warehouse_type
    FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Text' WHEN 1 THEN 'Currency'
      WHEN 2 THEN 'Date' WHEN 3 THEN 'Header' ELSE 'PersonLink' END AS field_type FROM part)""")(
    lambda t: t["part"].select(
        "p_partkey",
        F.get(F.array(*map(F.lit, ["Text", "Currency", "Date", "Header", "PersonLink"])),
              (F.col("p_partkey") % 5).cast("int")).alias("field_type"),
    ).withColumns({
        "lake_type": type_column(F.col("field_type"), LAKE_TYPES),
        "warehouse_type": type_column(F.col("field_type"), WAREHOUSE_TYPES),
    }))


@query("v24_inferred_types", """
    SELECT c_custkey, c_name, c_acctbal, 'int,string,int,float,string' AS lake_types
    FROM customer""")
def inferred_types(t: Tables) -> DataFrame:
    c = t["customer"]
    kinds = ",".join(lake_type_of(f.dataType) for f in c.schema.fields)
    return by_inferred_type(c).select(
        "c_custkey", "c_name", "c_acctbal", F.lit(kinds).alias("lake_types"))


query("v25_event_time", """
    SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000 AS back_ms FROM events""")(
    lambda t: t["events"].select("event_id", epoch_millis("ts").alias("ms"))
    .withColumn("back_ms", F.unix_millis(text.event_time(F.col("ms")))))

@query("v26_lower_names", """
    SELECT o_orderkey AS projectId, o_orderstatus AS phaseName, 'practicecases' AS table_name FROM orders""")
def lower_names(t: Tables) -> DataFrame:
    """A table is stored under its lower-cased name and found under any spelling."""
    root = t.scratch("model")
    write_table(t["project"].select("projectId", "phaseName"), root, "PracticeCases")
    folder = F.element_at(F.split(file_path(), "/"), -2)
    return read_table(t.spark, root, "PRACTICECases").withColumn("table_name", folder)

query("v27_id_chunks", """
    SELECT projectId, (row_number() OVER (ORDER BY projectId) - 1) // 10 AS chunk
    FROM {project}""")(
    lambda t: chunked_ids(
        number_in_order(t["project"].select("projectId"), "projectId", "n"), "n", 10
    ).select("projectId", "chunk"))

query("v28_constants", """
    SELECT o_orderkey, 101 AS org, CAST(NULL AS VARCHAR) AS custom, CAST(NULL AS DATE) AS closed
    FROM orders""")(
    lambda t: build(t["orders"], TargetTable("T", "orders", (
        TargetField("o_orderkey", "int", "o_orderkey", "data"), TargetField("org", "int", kind="org"),
        TargetField("custom", "string"), TargetField("closed", "date"))), ORG, typed=True))
