"""Practice records derived from the test tables.

``VIEWS`` holds the flat views as SQL that Spark and DuckDB read alike; the
functions below build the nested records the source systems would send.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.session import scratch_path

ORG = 101

VIEWS = {
    "contact": """
        SELECT c_custkey AS personId, split_part(c_name, '#', 1) AS firstName,
          split_part(c_name, '#', 2) AS lastName,
          CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ''
            WHEN c_custkey % 3 = 0 THEN concat(c_mktsegment, '|CLIENT')
            ELSE c_mktsegment END AS personTypes
        FROM customer""",
    "project": """
        SELECT o_orderkey AS projectId, CAST(substr(o_orderpriority, 1, 1) AS INT) AS projectTypeId,
          o_orderstatus AS phaseName, o_custkey AS clientId, o_orderstatus = 'F' AS isArchived,
          CAST(o_orderdate AS DATE) AS incidentDate
        FROM orders""",
    "phase_dim": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS projectTypeId,
          substr(o_orderpriority, 3) AS typeName,
          CAST(substr(o_orderpriority, 1, 1) AS INT) * 10
            + CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END AS phaseId,
          o_orderstatus AS name, o_orderstatus = 'F' AS isPermanent
        FROM orders""",
    "meds": """
        SELECT l_orderkey AS projectId, l_linenumber AS id, l_returnflag AS type,
          CAST(l_shipdate AS DATE) AS recordsordereddate, l_extendedprice AS valueTotal
        FROM lineitem""",
    "casesummary": """
        SELECT o_orderkey AS projectId, CAST(o_orderdate AS DATE) AS dateOfIncident,
          o_custkey AS primaryattorney, o_custkey + 1 AS paralegal, o_custkey + 2 AS caseManager,
          CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey + 3 END AS cocounsel,
          CASE WHEN o_orderkey % 11 = 0 THEN 'n/a'
            ELSE concat(CAST(o_orderkey % 100 AS VARCHAR(10)), '.5') END AS attorneysFeesAmount,
          CAST(o_orderdate AS DATE) AS projectedsettlementdate,
          o_totalprice AS projectedsettlementgoal,
          CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS settlementdate,
          CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS actualsettlementamount,
          o_orderstatus = 'P' AS caseSettledPresuit, o_orderkey % 13 = 0 AS vIPCase
        FROM orders""",
    "intake": """
        SELECT o_orderkey AS projectId, o_custkey AS personperformingintake,
          CAST(o_orderdate AS DATE) AS dateofintake, CAST(o_orderdate AS DATE) AS dateofincident,
          o_orderstatus AS dUIOrHItAndRun, o_totalprice AS referralfee
        FROM orders""",
    "statuses": """
        SELECT r_regionkey AS Id, r_name AS Status, concat('status ', r_name) AS StatusName,
          '' AS Substatuses
        FROM region""",
    "leadrow": """
        SELECT o_orderkey AS Id, o_custkey AS ContactId, o_orderstatus AS Code,
          o_orderkey % 5 AS StatusId
        FROM orders""",
}

# The same rows, each dialect with its own time arithmetic.
ORACLE_VIEWS = {
    "webhook": """
        SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, user_id AS project_id,
          user_id % 5 + 1 AS ptype,
          CASE event_type WHEN 'signup' THEN 'Project' WHEN 'purchase' THEN 'Project'
            WHEN 'view' THEN 'Form' ELSE 'CollectionItem' END AS entity,
          CASE event_type WHEN 'signup' THEN 'Created' WHEN 'purchase' THEN 'PhaseChanged'
            WHEN 'view' THEN 'Updated' WHEN 'click' THEN 'Created' ELSE 'Deleted' END AS event_name,
          CASE event_type WHEN 'view' THEN 'intake' WHEN 'signup' THEN NULL
            WHEN 'purchase' THEN NULL ELSE 'meds' END AS selector,
          concat('phase_', CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 6 AS VARCHAR))
            AS phase
        FROM events""",
    "phase_log": """
        SELECT CAST(101 AS BIGINT) AS org_id, ptype AS project_type_id, project_id,
          ts_ms AS event_ts,
          max(phase) AS phase
        FROM {webhook} WHERE entity = 'Project' AND event_name = 'PhaseChanged'
        GROUP BY ptype, project_id, ts_ms""",
    "lead_event": """
        SELECT event_id, user_id,
          CASE event_type WHEN 'signup' THEN 'Lead Created'
            WHEN 'purchase' THEN 'Opportunity Created'
            WHEN 'view' THEN 'Contact Edited' WHEN 'click' THEN 'Lead Status Changed'
            ELSE 'Unknown' END AS EventType
        FROM events""",
    "posts": """
        SELECT CAST(doc_id AS VARCHAR) AS Post_ID,
          TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id % 8760 AS INT)) AS PostDate,
          concat(text, ' #', lang, ' #', source, ' #', lang) AS Caption, source AS Media_Type,
          n_chars % 50 AS Comments, n_chars % 1000 AS Likes
        FROM documents""",
}


def expand(sql: str) -> str:
    """Fill ``{view}`` with the view's query, so oracle SQL reads the tables alone."""
    views = {**VIEWS, **ORACLE_VIEWS}
    while (found := re.search(r"\{(\w+)\}", sql)) is not None:
        sql = sql.replace(found.group(0), f"({views[found.group(1)]})")
    return sql


class Tables:
    """The test tables of one folder, and the records derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self._view(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        table = text.rsplit("FROM", 1)[1].strip()
        return self.spark.sql(text.replace(f"FROM {table}", "FROM {src}"), src=self[table])

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def stream(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        return self.spark.readStream.schema(self[name].schema).parquet(path)

    # Nested records -------------------------------------------------------

    def raw_projects(self) -> DataFrame:
        """Project records as the source sends them: ids wrapped, lists nested."""
        return self["project"].select(
            F.struct(F.col("projectId").alias("native")).alias("projectId"),
            F.struct(F.col("projectTypeId").alias("native")).alias("projectTypeId"),
            "phaseName",
            F.struct(F.col("clientId").alias("native")).alias("clientId"),
            "isArchived",
            "incidentDate",
            F.array("phaseName", F.lit("tag")).alias("hashtags"),
            F.lit(ORG).alias("orgId"),
        )

    def raw_contacts(self) -> DataFrame:
        return self["contact"].select(
            F.struct(F.col("personId").alias("native")).alias("personId"),
            "firstName",
            "lastName",
            F.split("personTypes", "[|]").alias("personTypes"),
            F.array("firstName", "lastName").alias("searchNames"),
        )

    def raw_items(self) -> DataFrame:
        """Collection pages, one item each."""
        return self["meds"].select(
            "projectId",
            F.array(
                F.struct(
                    F.struct(F.col("id").alias("native")).alias("itemId"),
                    F.struct("type", "recordsordereddate", "valueTotal").alias("dataObject"),
                )
            ).alias("items"),
        )

    def raw_people_fields(self) -> DataFrame:
        """Line items as records with one field of each nested kind."""
        person = F.struct(F.col("l_suppkey").alias("id"))
        other = F.struct(F.col("l_partkey").alias("id"))
        return self["lineitem"].select(
            F.col("l_orderkey").alias("projectId"),
            F.col("l_linenumber").alias("line"),
            F.struct(F.col("l_partkey").alias("native")).alias("partId"),
            F.col("l_suppkey").alias("scalarId"),
            F.when(F.col("l_linenumber") != 3, person).alias("adjuster"),
            F.when(F.col("l_linenumber") == 1, F.array().cast("array<struct<id:bigint>>"))
            .when(F.col("l_linenumber") != 2, F.array(person, other)).alias("witnesses"),
            F.when(F.col("l_linenumber") != 4, F.array("l_returnflag", "l_linestatus"))
            .alias("flags"),
            F.array(F.lit(None).cast("string"), F.col("l_returnflag")).alias("gaps"),
            F.array("l_linenumber").alias("numbers"),
            F.struct(F.col("l_quantity").alias("qty"), F.col("l_returnflag").alias("flag"))
            .alias("details"),
            F.col("l_returnflag").alias("note"),
            F.lit("x").alias("banner"),
        )

    def raw_lead_details(self) -> DataFrame:
        o = self["orders"]
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        return o.select(
            key.alias("Id"),
            F.col("o_orderstatus").alias("Status"),
            F.struct(cust.alias("Id"), F.lit("n").alias("Name")).alias("Contact"),
            F.struct((key % 3).alias("Id")).alias("PracticeArea"),
            F.when(key % 2 == 0, F.struct((key + 7).alias("Id"))).alias("Intake"),
            F.struct((cust + 1).alias("Id")).alias("Creator"),
            F.when(key % 4 != 0, F.struct((key * 10).alias("Id"))).alias("Opportunity"),
            F.when(
                key % 6 != 0, F.array(F.struct(cust.alias("Id")), F.struct((cust + 1).alias("Id")))
            ).alias("RelatedContacts"),
            F.array(F.struct((key % 7).alias("CustomFieldId"), F.lit("v").alias("Value")))
            .alias("CustomFields"),
        )

    def raw_lead_contacts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self["customer"].select(
            key.alias("Id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("FirstName"),
            F.array(key * 2, key * 2 + 1).alias("LeadIds"),
            F.array(
                F.struct((key % 5).alias("CustomFieldId")),
                F.struct((key % 3).alias("CustomFieldId")),
            ).alias("CustomFields"),
        )

    def landed_leads(self) -> dict[str, DataFrame]:
        """Every entity of the lead system as it lands."""
        return {
            "statuses": self["statuses"],
            "leadsource": self["nation"].select(
                F.col("n_nationkey").alias("Id"), F.col("n_name").alias("SourceName")),
            "casetype": self["part"].select(
                F.col("p_partkey").alias("Id"), F.col("p_type").alias("TypeName"),
                F.col("p_brand").alias("TypeNameShort"), F.col("p_name").alias("Code"),
                (F.col("p_size") % 2 == 0).alias("IsMassTort")),
            "leadrow": self["leadrow"],
            "leaddetail": self.raw_lead_details(),
            "contact": self.raw_lead_contacts(),
            "opportunities": self.raw_opportunities(),
            "referrals": self.raw_referrals(),
            "users": self.raw_users(),
        }

    def raw_opportunities(self) -> DataFrame:
        key = F.col("o_orderkey")
        clerk = F.struct(
            F.lit("Ann").alias("FirstName"), F.col("o_orderstatus").alias("LastName")
        )
        return self["orders"].where(key % 4 != 0).select(
            (key * 10).alias("Id"),
            key.alias("LeadId"),
            F.col("o_orderstatus").alias("LeadStatus"),
            F.when(key % 3 == 0, F.slice(F.array(clerk), 1, 0)).otherwise(F.array(clerk, clerk))
            .alias("AssignedTo"),
            F.when(key % 5 != 0, clerk).alias("ProcessedBy"),
            F.array(F.struct((key % 7).alias("CustomFieldId"))).alias("CustomFields"),
            (F.col("o_orderstatus") == "F").alias("Processed"),
        )

    def raw_users(self) -> DataFrame:
        return self["supplier"].select(
            F.col("s_suppkey").alias("Id"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("FirstName"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("LastName"),
            F.concat("s_name", F.lit("@x.org")).alias("Email"),
            F.col("s_nationkey").cast("string").alias("Code"),
            F.lit("staff").alias("Roles"),
            F.lit("read").alias("Permissions"),
            F.lit(1).alias("Internal"),
        )

    def raw_referrals(self) -> DataFrame:
        return self["nation"].select(
            F.col("n_nationkey").alias("Id"),
            F.col("n_name").alias("Name"),
            F.lit("firm").alias("Type"),
            F.col("n_regionkey").cast("string").alias("Code"),
            (F.col("n_regionkey") == 1).alias("Outgoing"),
        )

    # Events ----------------------------------------------------------------

    def webhook(self, events: DataFrame | None = None) -> DataFrame:
        """Case-system events as sent, from a batch or a stream of the event table."""
        e = self["events"] if events is None else events
        kind = F.col("event_type")
        entity = (
            F.when(kind.isin("signup", "purchase"), "Project").when(kind == "view", "Form")
            .otherwise("CollectionItem")
        )
        event = (
            F.when(kind == "signup", "Created").when(kind == "purchase", "PhaseChanged")
            .when(kind == "view", "Updated").when(kind == "click", "Created").otherwise("Deleted")
        )
        number = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
        return e.select(
            epoch_millis("ts").alias("Timestamp"),
            entity.alias("Object"),
            event.alias("Event"),
            F.struct(
                (F.col("user_id") % 5 + 1).alias("ProjectTypeId"),
                F.lit(None).cast("bigint").alias("PhaseId"),
                F.when(kind == "view", "intake").when(kind.isin("click", "error"), "meds")
                .alias("SectionSelector"),
                (F.col("event_id") % 1000).cast("string").alias("ItemId"),
                F.col("user_id").alias("ProjectId"),
            ).alias("ObjectId"),
            F.lit(ORG).cast("bigint").alias("OrgId"),
            F.col("user_id").alias("ProjectId"),
            F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("UserId"),
            F.struct(
                F.concat(F.lit("phase_"), (number % 6).cast("string")).alias("PhaseName"),
                F.lit(None).cast("string").alias("Action"),
            ).alias("Other"),
            F.col("event_id").alias("arrival"),
        )

    def lead_events(self, events: DataFrame | None = None) -> DataFrame:
        e = self["events"] if events is None else events
        kind, user = F.col("event_type"), F.col("user_id")
        return e.select(
            F.col("event_id").alias("arrival"),
            F.when(kind == "signup", "Lead Created").when(kind == "purchase", "Opportunity Created")
            .when(kind == "view", "Contact Edited").when(kind == "click", "Lead Status Changed")
            .otherwise("Unknown").alias("EventType"),
            F.when(kind.isin("signup", "click"), user).alias("LeadId"),
            F.when(kind == "view", user).alias("ContactId"),
            F.when(kind == "purchase", user * 10).alias("OpportunityId"),
        )

    def posts(self) -> DataFrame:
        start = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
        hours = (F.col("doc_id") % 8760).cast("int")
        return self["documents"].select(
            F.col("doc_id").cast("string").alias("Post_ID"),
            (start + F.make_dt_interval(F.lit(0), hours)).alias("PostDate"),
            F.concat("text", F.lit(" #"), "lang", F.lit(" #"), "source", F.lit(" #"), "lang")
            .alias("Caption"),
            F.col("source").alias("Media_Type"),
            (F.col("n_chars") % 50).alias("Comments"),
            (F.col("n_chars") % 1000).alias("Likes"),
        )


def epoch_millis(name: str) -> Column:
    """Milliseconds since 1970 of a time without zone, in any session zone."""
    return F.expr(f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', {name})")
