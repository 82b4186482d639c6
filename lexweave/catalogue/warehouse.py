"""Declared tables, constraint checks and warehouse writes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.catalogue.base import query
from lexweave.catalogue.projections import model
from lexweave.config.warehouse import RENAMES, ForeignKey, warehouse_table
from lexweave.fixtures import ORG, Tables
from lexweave.functions import leads
from lexweave.operators import checks
from lexweave.operators.references import References
from lexweave.plans.standard_model import crm_table
from lexweave.sinks import tables as sinks


def conformed_cases(t: Tables) -> DataFrame:
    return checks.conform(
        model().cases(t["project"]), warehouse_table("CMS_Cases"), RENAMES["CMS_Cases"]
    )


CASES_SQL = """
    SELECT 101 AS Platform_Org_ID, '101' AS Client_Org_ID, projectId AS Case_ID,
      projectTypeId AS Practice_Type_ID, isArchived AS Is_Archived,
      incidentDate AS Date_of_Incident FROM {project}"""

query("c1_conform", CASES_SQL)(conformed_cases)


def figures(t: Tables) -> DataFrame:
    """Case figures with gaps, long texts and amounts beyond ``decimal(8,2)``."""
    line = F.col("l_linenumber")
    return t["lineitem"].select(
        F.lit(ORG).alias("Platform_Org_ID"),
        F.lit("101").alias("Client_Org_ID"),
        F.when(line != 1, F.col("l_orderkey")).alias("Parent_Case_ID"),
        F.col("l_orderkey").alias("Case_ID"),
        F.repeat("l_returnflag", line * 60).alias("Figure_Type"),
        F.col("l_shipdate").cast("date").alias("Figure_Date"),
        (F.col("l_extendedprice") * 100).alias("Value"),
    )


query("c2_not_null", """
    SELECT 'CMS_CaseFigures' AS table_name, 'not_null' AS check, c AS column_name, v AS violations
    FROM (SELECT unnest(['Platform_Org_ID', 'Client_Org_ID', 'Parent_Case_ID', 'Case_ID']) AS c,
      unnest([0, 0, count(*) FILTER (l_linenumber = 1), 0]) AS v FROM lineitem)""")(
    lambda t: checks.check_values(figures(t), warehouse_table("CMS_CaseFigures"), ["not_null"]))

query("c6_text_length", """
    SELECT 'CMS_CaseFigures' AS table_name, 'length' AS check, c AS column_name, v AS violations
    FROM (SELECT unnest(['Client_Org_ID', 'Figure_Type']) AS c,
      unnest([0, count(*) FILTER (l_linenumber * 60 > 255)]) AS v FROM lineitem)""")(
    lambda t: checks.check_values(figures(t), warehouse_table("CMS_CaseFigures"), ["length"]))

query("c7_decimal_range", """
    SELECT 'CMS_CaseFigures' AS table_name, 'decimal' AS check, 'Value' AS column_name,
      count(*) FILTER (round(l_extendedprice * 100, 2) >= 1000000) AS violations FROM lineitem""")(
    lambda t: checks.check_values(figures(t), warehouse_table("CMS_CaseFigures"), ["decimal"]))

query("c3_primary_key", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")(
    lambda t: checks.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"]))

query("c4_unique", """
    SELECT name AS Phase_Name, count(*) AS n_rows FROM {phase_dim}
    GROUP BY name HAVING count(*) > 1""")(
    lambda t: checks.duplicate_keys(
        t["phase_dim"].withColumnRenamed("name", "Phase_Name"), ["Phase_Name"]))

def odd_cases(t: Tables) -> DataFrame:
    """Cases with ids above 2^31 and dates that are none."""
    key = F.col("o_orderkey")
    return t["orders"].select(
        F.lit(ORG).alias("Platform_Org_ID"), F.lit("101").alias("Client_Org_ID"),
        (key + F.lit(3_000_000_000)).alias("Case_ID"), (key % 5).alias("Practice_Type_ID"),
        F.when(key % 3 == 0, "maybe").otherwise("true").alias("Is_Archived"),
        F.when(key % 7 == 0, "soon").otherwise("2024-01-31").alias("Date_of_Incident"),
    )


query("c1_wide_ids_and_lost_casts", """
    SELECT o_orderkey + 3000000000 AS Case_ID,
      CASE WHEN o_orderkey % 3 <> 0 THEN true END AS Is_Archived,
      CASE WHEN o_orderkey % 7 <> 0 THEN DATE '2024-01-31' END AS Date_of_Incident
    FROM orders""")(
    lambda t: checks.conform(odd_cases(t), warehouse_table("CMS_Cases")).select(
        "Case_ID", "Is_Archived", "Date_of_Incident"))

query("c1_cast_violations", """
    SELECT 'CMS_Cases' AS table_name, 'cast' AS check, c AS column_name, v AS violations FROM (
      SELECT unnest(['Platform_Org_ID', 'Case_ID', 'Practice_Type_ID', 'Is_Archived', 'Date_of_Incident']) AS c,
        unnest([0, 0, 0, count(*) FILTER (o_orderkey % 3 = 0), count(*) FILTER (o_orderkey % 7 = 0)]) AS v
      FROM orders) WHERE c IN ('Is_Archived', 'Date_of_Incident')""")(
    lambda t: checks.check_values(odd_cases(t), warehouse_table("CMS_Cases"), ["cast"])
    .where(F.col("column_name").isin("Is_Archived", "Date_of_Incident")))

query("c1_rejected_rows", """
    SELECT o_orderkey + 3000000000 AS Case_ID, concat_ws(',',
      CASE WHEN o_orderkey % 3 = 0 THEN 'Is_Archived' END,
      CASE WHEN o_orderkey % 7 = 0 THEN 'Date_of_Incident' END) AS bad
    FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 7 = 0""")(
    lambda t: checks.rejected(odd_cases(t), warehouse_table("CMS_Cases")).select(
        "Case_ID", F.concat_ws(",", "bad_columns").alias("bad")))


@query("c8_column_drift", """
    SELECT 'Date_of_Incident' AS column_name, 'string' AS built, 'date' AS declared, count(*) AS n_values
    FROM orders UNION ALL SELECT 'Is_Archived', 'string', 'boolean', count(*) FROM orders
    UNION ALL SELECT 'Case_ID', 'bigint', 'int', count(*) FROM orders
    UNION ALL SELECT 'Practice_Type_ID', 'bigint', 'int', count(*) FROM orders""")
def column_drift(t: Tables) -> DataFrame:
    """Columns whose built and declared types differ, with the values that this touches."""
    built = odd_cases(t)
    drift = checks.column_drift(built.schema, warehouse_table("CMS_Cases"))
    wanted = ("Date_of_Incident", "Is_Archived", "Case_ID", "Practice_Type_ID")
    rows = [
        F.struct(F.lit(n).alias("column_name"), F.lit(b).alias("built"), F.lit(d).alias("declared"),
                 F.count(F.col(n)).alias("n_values"))
        for n, b, d in drift if n in wanted
    ]
    return built.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


ORDER_KEY = ForeignKey(("l_orderkey",), "orders", ("o_orderkey",))

query("c5_orphans", """
    SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey NOT IN (
      SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""")(
    lambda t: checks.orphans(t["lineitem"], ORDER_KEY, t["orders"].where("o_orderstatus <> 'P'")))

@query("c5_incremental_orphans", """
    SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey NOT IN (
      SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""")
def incremental_orphans(t: Tables) -> DataFrame:
    """Both tables in two loads: items of either come before and after the orders they refer to."""
    state = References(t.scratch("references"), ORDER_KEY)
    orders = t["orders"].where("o_orderstatus <> 'P'")
    for half in (0, 1):
        items = t["lineitem"].where(F.col("l_linenumber") % 2 == half)
        state.load(items, orders.where(F.col("o_orderkey") % 2 == half))
    return state.orphans(t.spark)


@query("j6_composite_orphans", """
    SELECT Parent_Case_ID, Case_ID, count(*) AS n_rows FROM (
      SELECT l_orderkey AS Parent_Case_ID,
        CASE WHEN l_linenumber = 7 THEN l_orderkey + 1 ELSE l_orderkey END AS Case_ID FROM lineitem)
    WHERE NOT EXISTS (SELECT 1 FROM orders
      WHERE o_orderkey = Parent_Case_ID AND o_orderkey = Case_ID)
    GROUP BY Parent_Case_ID, Case_ID""")
def composite_orphans(t: Tables) -> DataFrame:
    """Figures of a case that its parent does not have, by the declared two-column key."""
    case = F.when(F.col("l_linenumber") == 7, F.col("l_orderkey") + 1)
    child = t["lineitem"].select(
        F.col("l_orderkey").alias("Parent_Case_ID"),
        F.coalesce(case, F.col("l_orderkey")).alias("Case_ID"),
    )
    key = warehouse_table("CMS_CaseFigures").references[0]
    return checks.orphans(child, key, model().case_details(t["casesummary"]))


def warehouse_frames(t: Tables) -> dict[str, DataFrame]:
    """Case details with all ten references, and the tables that they name with gaps."""
    key = F.col("o_orderkey")
    people = ("Attorney_ID", "Prelitigation_Paralegal_ID", "Litigation_Paralegal_ID", "CaseManager_ID", "Cocounsel_ID")
    details = t["orders"].select(
        F.lit(ORG).alias("Platform_Org_ID"), F.lit("101").alias("Client_Org_ID"), key.alias("Parent_Case_ID"),
        key.alias("Case_ID"), (key % 11).alias("Case_Type_ID"),
        *[(F.col("o_custkey") + i).alias(c) for i, c in enumerate(people)], (key % 13).alias("Case_Team_ID"),
        (key % 17).alias("Case_Status_ID"), F.when(key % 2 == 0, key % 19).alias("Insurance_ID"),
        (key % 23).alias("Case_Phase_ID"), F.repeat("o_orderpriority", 40).alias("Case_Name"),
        F.col("o_totalprice").alias("Actual_Settlement_Amount"),
    )
    numbers = {"CMS_CaseTypes": "Case_Type_ID", "CMS_Teams": "Team_ID", "CMS_StatusMaster": "Status_ID",
               "CMS_InsuranceMaster": "Insurance_ID", "CMS_Phases": "Phase_ID"}
    parents = {name: t["nation"].where("n_nationkey < 10").select(F.col("n_nationkey").alias(c)) for name, c in numbers.items()}
    parents["CMS_People"] = t["customer"].select(F.col("c_custkey").alias("People_ID"))
    return {"CMS_CaseDetails": details, **parents}


@query("check_case_details_report", """
    WITH d AS (SELECT *, (SELECT max(c_custkey) FROM customer) AS top FROM orders)
    SELECT 'CMS_CaseDetails' AS table_name, unnest(['primary_key', 'length', 'decimal', 'foreign_key',
        'foreign_key', 'foreign_key', 'foreign_key', 'foreign_key', 'foreign_key', 'foreign_key', 'foreign_key',
        'foreign_key', 'foreign_key']) AS check,
      unnest(['Parent_Case_ID,Case_ID', 'Case_Name', 'Actual_Settlement_Amount', 'Case_Type_ID', 'Attorney_ID',
        'Prelitigation_Paralegal_ID', 'Litigation_Paralegal_ID', 'CaseManager_ID', 'Cocounsel_ID', 'Case_Team_ID',
        'Case_Status_ID', 'Insurance_ID', 'Case_Phase_ID']) AS column_name,
      unnest([0, count(*) FILTER (length(o_orderpriority) * 40 > 255),
        count(*) FILTER (round(o_totalprice, 2) >= 1000000), count(*) FILTER (o_orderkey % 11 >= 10),
        count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)),
        count(*) FILTER (o_custkey + 1 NOT IN (SELECT c_custkey FROM customer)),
        count(*) FILTER (o_custkey + 2 NOT IN (SELECT c_custkey FROM customer)),
        count(*) FILTER (o_custkey + 3 NOT IN (SELECT c_custkey FROM customer)),
        count(*) FILTER (o_custkey + 4 NOT IN (SELECT c_custkey FROM customer)),
        count(*) FILTER (o_orderkey % 13 >= 10), count(*) FILTER (o_orderkey % 17 >= 10),
        count(*) FILTER (o_orderkey % 2 = 0 AND o_orderkey % 19 >= 10),
        count(*) FILTER (o_orderkey % 23 >= 10)]) AS violations FROM d""")
def case_details_report(t: Tables) -> DataFrame:
    """Every key and reference of the table with the most of them, in one shuffle."""
    frames = warehouse_frames(t)
    report = checks.check_table(frames["CMS_CaseDetails"], warehouse_table("CMS_CaseDetails"), frames)
    named = F.col("column_name").isin("Case_Name", "Actual_Settlement_Amount")
    return report.where(F.col("check").isin("primary_key", "foreign_key") | (named & (F.col("check") != "cast")))


@query("check_table_report", """
    SELECT 'CMS_Cases' AS table_name, unnest(['not_null', 'not_null', 'not_null', 'not_null',
        'length', 'primary_key', 'foreign_key']) AS check,
      unnest(['Platform_Org_ID', 'Client_Org_ID', 'Case_ID', 'Practice_Type_ID', 'Client_Org_ID',
        'Case_ID', 'Practice_Type_ID']) AS column_name,
      unnest([0, 0, 0, 0, 0, 0, count(*) FILTER (projectTypeId > 3)]) AS violations
    FROM {project}""")
def table_report(t: Tables) -> DataFrame:
    parents = {"CMS_PracticeTypes": t["phase_dim"].where("projectTypeId <= 3").select(
        F.col("projectTypeId").alias("Practice_Type_ID")).distinct()}
    return checks.check_table(conformed_cases(t), warehouse_table("CMS_Cases"), parents)


@query("k8_warehouse_table", CASES_SQL)
def warehouse_write(t: Tables) -> DataFrame:
    name = f"cases_{uuid.uuid4().hex}"
    sinks.warehouse_write(
        conformed_cases(t), name, t.scratch("warehouse"), "Case_ID", ["Case_ID"], buckets=8
    )
    return t.spark.table(name)


@query("k9_warehouse_load", CASES_SQL)
def warehouse_load(t: Tables) -> DataFrame:
    path = t.scratch("warehouse")
    sinks.warehouse_load(
        model().cases(t["project"]), warehouse_table("CMS_Cases"), t.scratch("staging"), path,
        RENAMES["CMS_Cases"],
    )
    return t.spark.read.parquet(path)


# Lead tables --------------------------------------------------------------

TENANT = "101 AS Platform_Org_ID, 'acme' AS Client_Org_ID"

query("t12_crm_users", f"""
    SELECT {TENANT}, s_suppkey AS UserID, split_part(s_name, '#', 1) AS FirstName,
      split_part(s_name, '#', 2) AS LastName, concat(s_name, '@x.org') AS Email,
      CAST(s_nationkey AS VARCHAR) AS Code, 'staff' AS CRM_Roles, 'read' AS CRM_Permissions
    FROM supplier""")(lambda t: crm_table("users", t.raw_users(), ORG, "acme"))

query("t12_crm_referrals", f"""
    SELECT {TENANT}, n_nationkey AS Id, n_name AS Name, 'firm' AS Type,
      CAST(n_regionkey AS VARCHAR) AS Code, n_regionkey = 1 AS Outgoing
    FROM nation""")(lambda t: crm_table("referrals", t.raw_referrals(), ORG, "acme"))

query("t12_crm_status", f"""
    SELECT {TENANT}, Id, Status, StatusName, Substatuses FROM {{statuses}}""")(
    lambda t: crm_table("statuses", t["statuses"], ORG, "acme"))

query("t12_crm_lead_source", f"""
    SELECT {TENANT}, n_nationkey AS Id, n_name AS SourceName FROM nation""")(
    lambda t: crm_table("leadsource", t["nation"].select(
        F.col("n_nationkey").alias("Id"), F.col("n_name").alias("SourceName")), ORG, "acme"))

query("t12_crm_case_type", f"""
    SELECT {TENANT}, p_partkey AS Id, p_type AS TypeName, p_brand AS TypeNameShort,
      p_name AS Code, p_size % 2 = 0 AS IsMassTort, CAST(NULL AS VARCHAR) AS CustomQuestionOrder
    FROM part""")(
    lambda t: crm_table("casetype", t["part"].select(
        F.col("p_partkey").alias("Id"), F.col("p_type").alias("TypeName"),
        F.col("p_brand").alias("TypeNameShort"), F.col("p_name").alias("Code"),
        (F.col("p_size") % 2 == 0).alias("IsMassTort")), ORG, "acme"))

query("t12_crm_opportunities", f"""
    SELECT {TENANT}, o_orderkey * 10 AS Id, o_orderkey AS LeadId,
      o_orderstatus AS LeadStatus, o_orderstatus = 'F' AS Processed,
      CAST(o_orderkey % 7 AS VARCHAR) AS CustomFields,
      CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('Ann ', o_orderstatus) END AS AssignedTo,
      CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('Ann ', o_orderstatus) END AS ProcessedBy,
      CAST(NULL AS VARCHAR) AS Campaign, CAST(NULL AS TIMESTAMP) AS CreatedDate
    FROM orders WHERE o_orderkey % 4 <> 0""")(
    lambda t: crm_table("opportunities", leads.opportunity(t.raw_opportunities()), ORG, "acme")
    .select("Platform_Org_ID", "Client_Org_ID", "Id", "LeadId", "LeadStatus", "Processed",
            "CustomFields", "AssignedTo", "ProcessedBy", "Campaign", "CreatedDate"))
