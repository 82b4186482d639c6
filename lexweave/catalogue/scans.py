"""Scans, landed records, snapshots and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.catalogue.base import query
from lexweave.config.standard_model import standard_mapping
from lexweave.fixtures import ORG, Tables
from lexweave.operators import snapshots
from lexweave.plans.standard_model import StandardModel
from lexweave.sinks.tables import write_entity, write_partitioned, write_table
from lexweave.sources import files, records
from lexweave.streaming import pages as paged
from lexweave.streaming.events import normalise, read_events


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def pages_of(df: DataFrame, page: object, column: str) -> DataFrame:
    """Rows packed into pages; a page number covers a bounded id range."""
    return df.groupBy(page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(*df.columns))).alias(column)
    )


def offset_envelopes(t: Tables) -> DataFrame:
    rows = t["project"].select("projectId", "phaseName")
    pages = pages_of(rows, F.floor(F.col("projectId") / 1000), "items")
    return pages.select(
        "items",
        F.lit(True).alias("hasMore"),
        (F.col("page") * 1000).alias("offset"),
        F.lit(1000).alias("limit"),
    )


@query("s1_wildcard_scan", """
    SELECT projectId, CASE WHEN projectTypeId <= 2 THEN isArchived END AS isArchived,
      CASE WHEN projectTypeId > 2 THEN incidentDate END AS incidentDate
    FROM {project}""")
def wildcard_scan(t: Tables) -> DataFrame:
    root = t.scratch("raw")
    p = t["project"]
    low = p.where("projectTypeId <= 2").select("projectId", "isArchived")
    high = p.where("projectTypeId > 2").select("projectId", "incidentDate")
    low.write.parquet(f"{root}/{ORG}/1/a/project.parquet")
    high.write.parquet(f"{root}/{ORG}/3/b/project.parquet")
    merged = files.read_merged(t.spark, f"{root}/{ORG}/*/*/project.parquet")
    return merged.select("projectId", "isArchived", "incidentDate")


@query("s1_mixed_types", """
    SELECT projectId, CAST(projectTypeId AS VARCHAR) AS kind, CASE WHEN projectTypeId > 1 THEN incidentDate END
      AS incidentDate, CAST(clientId AS DOUBLE) AS clientId FROM {project}""")
def mixed_types_scan(t: Tables) -> DataFrame:
    """A raw folder whose files name one column's type in four ways: all rows, in the type that holds them."""
    root, p = t.scratch("raw"), t["project"]
    kinds = {1: ("int", "int"), 2: ("bigint", "double"), 3: ("string", "bigint"), 4: ("smallint", "bigint")}
    for number, (kind, client) in kinds.items():
        part = F.col("projectTypeId") == number if number < 4 else F.col("projectTypeId") >= 4
        late = ["incidentDate"] if number > 1 else []
        p.where(part).select(
            "projectId", F.col("projectTypeId").cast(kind).alias("kind"), F.col("clientId").cast(client).alias("clientId"), *late
        ).write.parquet(f"{root}/{ORG}/18/{number}/project.parquet")
    return files.read_raw(t.spark, root, str(ORG), 18)["project"].select("projectId", "kind", "incidentDate", "clientId")


@query("s1_declared_scan", """
    SELECT projectId, CASE WHEN projectTypeId <= 2 THEN isArchived END AS isArchived
    FROM {project}""")
def declared_scan(t: Tables) -> DataFrame:
    """The same mixed files with a declared schema: no footer pass."""
    root, p = t.scratch("raw"), t["project"]
    wanted = p.select("projectId", "isArchived")
    wanted.where("projectTypeId <= 2").write.parquet(f"{root}/{ORG}/1/a/project.parquet")
    p.where("projectTypeId > 2").select("projectId").write.parquet(
        f"{root}/{ORG}/3/b/project.parquet")
    return files.read_merged(t.spark, f"{root}/{ORG}/*/*/project.parquet", schema=wanted.schema)


@query("s2_folder_scan", "SELECT personId, firstName, lastName, personTypes FROM {contact}")
def folder_scan(t: Tables) -> DataFrame:
    path = t.scratch("contact")
    contact = t["contact"]
    write_entity(contact, path)
    return files.read_folder(t.spark, path, contact.schema)


@query("s3_path_keys", """
    SELECT projectId, '101' AS org_id,
      CASE WHEN projectId % 4 <> 1 THEN CAST(projectTypeId AS BIGINT) END AS project_type_id,
      CASE WHEN projectId % 4 <> 1 THEN projectId END AS project_id,
      CASE projectId % 4 WHEN 0 THEN 'core' WHEN 1 THEN 'core' WHEN 2 THEN 'form' ELSE 'phases' END
        AS section,
      CASE projectId % 4 WHEN 0 THEN 'project' WHEN 1 THEN 'contact' WHEN 2 THEN 'intake'
        ELSE 'phases' END AS entity,
      CASE WHEN projectId % 4 = 3 THEN 1600000000000 + projectId END AS event_ts
    FROM {project}""")
def path_keys(t: Tables) -> DataFrame:
    p = t["project"].withColumn("base", F.concat(F.lit("s3://lake/cms/101/"), "projectTypeId",
                                                 F.lit("/"), "projectId"))
    kind = F.col("projectId") % 4
    path = (
        F.when(kind == 0, F.concat("base", F.lit("/project.parquet")))
        .when(kind == 1, F.lit("s3://lake/cms/101/contact/historical_contacts.parquet"))
        .when(kind == 2, F.concat("base", F.lit("/form/intake.parquet")))
        .otherwise(F.concat("base", F.lit("/phases/"), 1600000000000 + F.col("projectId"),
                            F.lit(".parquet")))
    )
    return p.withColumn("path", path).select(
        "projectId", *[c.alias(n) for n, c in files.case_path_keys(F.col("path")).items()]
    )


@query("s3_partitioned_store", """
    SELECT projectId, phaseName, 101 AS org_id, projectTypeId AS project_type_id FROM {project}
    WHERE projectTypeId = 2""")
def partitioned_store(t: Tables) -> DataFrame:
    """Tenant and type as partition columns: the filter picks folders, not rows."""
    path, p = t.scratch("store"), t["project"]
    keyed = p.select("projectId", "phaseName", F.lit(ORG).alias("org_id"),
                     F.col("projectTypeId").alias("project_type_id"))
    write_partitioned(keyed, path, ["org_id", "project_type_id"])
    return t.spark.read.parquet(path).where("org_id = 101 AND project_type_id = 2")


@query("s3_lead_path_keys", """
    SELECT Id, 'acme' AS org, 'leadrow' AS model, Id AS record_id, false AS is_bulk
    FROM {leadrow}""")
def lead_path_keys(t: Tables) -> DataFrame:
    path = F.concat(F.lit("s3://lake/crm/acme/LeadRow/"), "Id", F.lit(".parquet"))
    rows = t["leadrow"].select("Id", path.alias("path"))
    keys = files.lead_path_keys(F.col("path"))
    return rows.select("Id", *[c.alias(n) for n, c in keys.items()])


@query("s4_offset_pages", "SELECT projectId, phaseName FROM {project}")
def offset_pages(t: Tables) -> DataFrame:
    pages = offset_envelopes(t)
    path = write_json(pages, t.scratch("pages"))
    return records.offset_pages(files.read_json(t.spark, path, pages.schema))


@query("s5_status_pages", "SELECT Id, ContactId, StatusId FROM {leadrow}")
def status_pages(t: Tables) -> DataFrame:
    rows = t["leadrow"].select("Id", "ContactId", "StatusId")
    pages = pages_of(rows, F.floor(F.col("Id") / 1000), "Records")
    # After each page one that came back as nothing, as for an unknown status.
    found = pages.select("Records", F.lit(99).alias("TotalPages"))
    missing = found.select(
        F.when(F.lit(False), F.col("Records")).alias("Records"),
        F.lit(None).cast("int").alias("TotalPages"),
    )
    return records.status_pages(files.union_all([found, missing]))


@query("s5_pages_of_statuses", "SELECT Id, ContactId, StatusId, 'status ' || CAST(StatusId AS VARCHAR) AS status FROM {leadrow}")
def pages_of_statuses(t: Tables) -> DataFrame:
    """Pages of every status in one landing, several records each; records keep the status asked for."""
    rows = t["leadrow"].select("Id", "ContactId", "StatusId", F.concat(F.lit("status "), "StatusId").alias("status"))
    record = F.struct("Id", "ContactId", "StatusId")
    pages = rows.groupBy("status", F.floor(F.col("Id") / 1000).alias("page")).agg(
        F.sort_array(F.collect_list(record)).alias("Records"), F.lit(99).alias("TotalPages"))
    path = write_json(pages, t.scratch("pages"))
    return records.status_pages(files.read_json(t.spark, path, pages.schema)).select("Id", "ContactId", "StatusId", "status")


def landed_pulls(t: Tables, pages: DataFrame, schema: str) -> DataFrame:
    """Pages as a stream over two files at a time, dealt to files without order."""
    landing = t.scratch("landing")
    pages.repartition(4, F.xxhash64("page")).write.json(landing)
    return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).json(landing)


@query("s5_page_stream", "SELECT Id, ContactId, StatusId, CAST(StatusId AS VARCHAR) AS status FROM {leadrow} WHERE StatusId <> 2")
def page_stream(t: Tables) -> DataFrame:
    """Pulls of every status; the last page of one has not landed yet, so none of its records is read."""
    rows = t["leadrow"].select("Id", "ContactId", "StatusId", F.col("StatusId").cast("string").alias("status"))
    numbered = rows.withColumn("page", F.floor(F.col("Id") / 1000) + 1)
    pages = numbered.groupBy("status", "page").agg(
        F.sort_array(F.collect_list(F.struct("Id", "ContactId", "StatusId"))).alias("Records"))
    total = pages.groupBy("status").agg(F.count(F.lit(1)).alias("TotalPages"))
    total = total.withColumn("TotalPages", F.col("TotalPages") + F.when(F.col("status") == "2", 1).otherwise(0))
    landed = pages.join(total, "status").withColumn("pull", F.lit(7))
    stream = landed_pulls(t, landed, (
        "status string, pull long, page long, TotalPages int, Records array<struct<Id:bigint,ContactId:bigint,StatusId:bigint>>"))
    feed = paged.PageFeed(t.scratch("pages"), ["status"], buckets=4)
    run_to_end(feed.start(paged.numbered_pages(stream, ["status"]), t.scratch("checkpoint")))
    return feed.records(t.spark).select("Id", "ContactId", "StatusId", "status")


@query("s4_page_stream", "SELECT projectId, phaseName, 'projects' AS entity FROM {project}")
def offset_page_stream(t: Tables) -> DataFrame:
    """The same for pages by offset, whose last one has no more."""
    rows = t["project"].select("projectId", "phaseName", F.floor(F.col("projectId") / 500).alias("at"))
    pages = rows.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("projectId", "phaseName"))).alias("items"))
    last = pages.agg(F.max("at")).scalar()
    landed = pages.select(
        F.lit("projects").alias("entity"), F.lit(1).alias("pull"), "items", (F.col("at") < last).alias("hasMore"),
        (F.col("at") * 500).alias("offset"), F.lit(500).alias("limit"), F.col("at").alias("page"))
    stream = landed_pulls(t, landed, (
        "entity string, pull long, items array<struct<projectId:bigint,phaseName:string>>, hasMore boolean, offset long, limit long"))
    feed = paged.PageFeed(t.scratch("pages"), ["entity"], buckets=4)
    run_to_end(feed.start(paged.offset_pages(stream, ["entity"]), t.scratch("checkpoint")))
    return feed.records(t.spark).select("projectId", "phaseName", "entity")


def lookup_responses(t: Tables) -> DataFrame:
    """Lookup responses: one entry a row, kept with the type they answer."""
    def entry(df: DataFrame, kind: str, key: str, name: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("lookup_type"),
            F.array(F.struct(F.col(key).cast("bigint").alias("Id"), F.col(name).alias("Name")))
            .alias("entries"),
        )

    return files.union_all([
        entry(t["statuses"], "Statuses", "Id", "Status"),
        entry(t["nation"], "LeadSource", "n_nationkey", "n_name"),
        entry(t["part"], "CaseType", "p_partkey", "p_type"),
    ])


@query("s6_lookup_scan", "SELECT CAST(n_nationkey AS BIGINT) AS Id, n_name AS Name FROM nation")
def lookup_scan(t: Tables) -> DataFrame:
    return records.lookup(lookup_responses(t), "LeadSource")


@query("s7_status_names", "SELECT Status FROM {statuses}")
def status_names(t: Tables) -> DataFrame:
    return records.status_names(t["statuses"])


@query("s8_collection_unwrap",
       "SELECT type, recordsordereddate, valueTotal, projectId, id FROM {meds}")
def collection_unwrap(t: Tables) -> DataFrame:
    return records.collection_items(t.raw_items())


@query("s9_form_unwrap", """
    SELECT personperformingintake, referralfee, projectId FROM {intake}
    WHERE projectId % 3 <> 0""")
def form_unwrap(t: Tables) -> DataFrame:
    section = F.struct("personperformingintake", "referralfee")
    forms = t["intake"].select(
        "projectId", F.when(F.col("projectId") % 3 != 0, section).alias("section")
    )
    return records.form_records(forms)


@query("s10_project_scan",
       "SELECT projectId, projectTypeId, clientId, phaseName, isArchived FROM {project}")
def project_scan(t: Tables) -> DataFrame:
    return records.projects(t.raw_projects()).select(
        "projectId", "projectTypeId", "clientId", "phaseName", "isArchived"
    )


def project_types(t: Tables) -> DataFrame:
    dim = t["phase_dim"]
    types = dim.select(
        F.struct(F.col("projectTypeId").alias("native")).alias("projectTypeId"),
        F.col("typeName").alias("name"),
        F.lit("self").alias("links"),
    ).distinct()
    return records.project_types(types, dim)


@query("s11_project_types", """
    SELECT projectTypeId, min(typeName) AS name, count(*) AS n_phases,
      string_agg(CAST(phaseId AS VARCHAR), ',' ORDER BY phaseId) AS phase_ids
    FROM {phase_dim} GROUP BY projectTypeId""")
def project_type_scan(t: Tables) -> DataFrame:
    ids = F.transform("phases", lambda p: p["phaseId"].cast("string"))
    return project_types(t).select(
        "projectTypeId", "name", F.size("phases").cast("bigint").alias("n_phases"),
        F.array_join(ids, ",").alias("phase_ids"),
    )


@query("s12_contact_scan", "SELECT personId, firstName, lastName FROM {contact}")
def contact_scan(t: Tables) -> DataFrame:
    pages = t.raw_contacts().select(F.array(F.struct("*")).alias("items"))
    return records.contacts(pages).select("personId", "firstName", "lastName")


@query("s13_project_contacts", "SELECT personId, firstName FROM {contact}")
def project_contacts(t: Tables) -> DataFrame:
    wrapped = t["contact"].select(
        F.array(F.struct(F.struct("personId", "firstName").alias("orgContact"))).alias("items")
    )
    return records.project_contacts(wrapped)


def section_metadata(t: Tables) -> DataFrame:
    """One field definition per part: its selector and its declared type."""
    kinds = F.array(*map(F.lit, ["Text", "Currency", "Date", "Header", "PersonLink"]))
    return t["part"].select(
        F.array(
            F.struct(
                F.concat(F.lit("custom.f"), "p_partkey").alias("fieldSelector"),
                F.get(kinds, (F.col("p_partkey") % 5).cast("int")).alias("customFieldType"),
            )
        ).alias("customFields")
    )


PART_TYPE = """CASE p_partkey % 5 WHEN 0 THEN 'Text' WHEN 1 THEN 'Currency' WHEN 2 THEN 'Date'
      WHEN 3 THEN 'Header' ELSE 'PersonLink' END"""


@query("s14_field_metadata", f"""
    SELECT concat('custom.f', CAST(p_partkey AS VARCHAR)) AS fieldSelector,
      {PART_TYPE} AS customFieldType FROM part""")
def field_metadata(t: Tables) -> DataFrame:
    return records.section_fields(section_metadata(t))


@query("s15_section_list", """
    SELECT concat('s', CAST(p_partkey AS VARCHAR)) AS id, p_name AS name,
      p_size % 2 = 0 AS isCollection FROM part""")
def section_list(t: Tables) -> DataFrame:
    pages = t["part"].select(
        F.array(
            F.struct(
                F.concat(F.lit("s"), "p_partkey").alias("sectionSelector"),
                F.col("p_name").alias("name"),
                (F.col("p_size") % 2 == 0).alias("isCollection"),
                F.lit("icon").alias("icon"),
            )
        ).alias("items")
    )
    return records.section_list(pages)


@query("s15_lead_tables", """
    SELECT 'statuses' AS section_name, count(*) AS n_rows FROM region
    UNION ALL SELECT 'leadsource', count(*) FROM nation
    UNION ALL SELECT 'casetype', count(*) FROM part
    UNION ALL SELECT 'leadrow', count(*) FROM orders
    UNION ALL SELECT 'leaddetail', count(*) FROM orders
    UNION ALL SELECT 'contact', count(*) FROM customer
    UNION ALL SELECT 'opportunities', count(*) FROM orders WHERE o_orderkey % 4 <> 0
    UNION ALL SELECT 'referrals', count(*) FROM nation
    UNION ALL SELECT 'users', count(*) FROM supplier""")
def lead_tables(t: Tables) -> DataFrame:
    """The lead system's tables, each with its landed rows."""
    landed = t.landed_leads()
    return files.union_all([
        landed[name].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("section_name"), "n_rows")
        for name in snapshots.LEAD_TABLES
    ])


@query("s16_record_by_id", """
    SELECT Id, ContactId FROM {leadrow}
    WHERE Id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def record_by_id(t: Tables) -> DataFrame:
    ids = t["lineitem"].where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("Id"))
    return records.with_ids(t["leadrow"].select("Id", "ContactId"), ids, "Id")


@query("s17_contact_ids", "SELECT DISTINCT o_custkey AS Id FROM orders")
def contact_ids(t: Tables) -> DataFrame:
    return records.linked_ids(t.raw_lead_details(), "Contact")


@query("s18_opportunity_ids", """
    SELECT o_orderkey * 10 AS Id FROM orders WHERE o_orderkey % 4 <> 0""")
def opportunity_ids(t: Tables) -> DataFrame:
    return records.opportunity_ids(t.raw_lead_details())


@query("s19_lead_ids", "SELECT Id FROM {leadrow}")
def lead_ids(t: Tables) -> DataFrame:
    return records.lead_ids(t["leadrow"])


@query("s20_list_scan", """
    SELECT n_nationkey AS Id, n_name AS Name, 'firm' AS Type, CAST(n_regionkey AS VARCHAR) AS Code,
      n_regionkey = 1 AS Outgoing FROM nation""")
def list_scan(t: Tables) -> DataFrame:
    rows = t.raw_referrals()
    path = write_json(rows, t.scratch("referrals"))
    return files.read_json(t.spark, path, rows.schema)


PEOPLE_TYPES_SQL = """
    SELECT People_Type, 101 AS Platform_Org_ID, 101 AS Client_Org_ID,
      CAST(NULL AS VARCHAR) AS Custom1, CAST(NULL AS VARCHAR) AS Custom2,
      CAST(NULL AS VARCHAR) AS Custom3, CAST(NULL AS VARCHAR) AS People_Sub_Type,
      row_number() OVER (ORDER BY People_Type) - 1 AS People_Type_Id
    FROM (SELECT DISTINCT unnest(string_split(personTypes, '|')) AS People_Type FROM {contact})
    WHERE People_Type <> ''"""


@query("s21_table_read_back", PEOPLE_TYPES_SQL)
def table_read_back(t: Tables) -> DataFrame:
    root = t.scratch("model")
    types = StandardModel(standard_mapping(ORG)).people_types(t["contact"])
    write_table(types, root, "PeopleTypes")
    return files.read_table(t.spark, root, "PeopleTypes")


EVENT_SQL = """
    SELECT CASE WHEN entity = 'Project' AND event_name <> 'PhaseChanged' THEN NULL ELSE ptype END
        AS project_type_id,
      CAST(101 AS BIGINT) AS org_id, event_name, ts_ms AS event_timestamp, entity, project_id,
      CASE WHEN entity = 'Project' AND event_name <> 'PhaseChanged' THEN 'core'
        WHEN entity = 'Project' THEN NULL ELSE selector END AS section
    FROM {webhook}"""

EVENT_COLUMNS = [
    "project_type_id", "org_id", "event_name", "event_timestamp", "entity", "project_id", "section"
]


def run_to_end(query) -> None:
    """Wait for an ``availableNow`` stream."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


@query("s22_event_stream", EVENT_SQL)
def event_stream(t: Tables) -> DataFrame:
    landing, out, mark = t.scratch("landing"), t.scratch("events"), t.scratch("checkpoint")
    write_json(t.webhook().drop("arrival"), landing)
    events = normalise(read_events(t.spark, landing))
    run_to_end(
        events.writeStream.option("checkpointLocation", mark).format("parquet")
        .trigger(availableNow=True).start(out)
    )
    return t.spark.read.parquet(out).select(*EVENT_COLUMNS)


@query("s24_backfill_events", """
    SELECT 1564500130149 AS Timestamp, 'Form' AS Object, 'Updated' AS Event,
      CAST(projectTypeId AS BIGINT) AS projectTypeId, 'intake' AS SectionSelector,
      CAST(101 AS BIGINT) AS OrgId, projectId AS ProjectId, CAST(7 AS BIGINT) AS UserId
    FROM {project} WHERE projectId < 10157655""")
def backfill_events(t: Tables) -> DataFrame:
    projects = records.projects(t.raw_projects())
    events = records.backfill_events(projects, 10_157_655, 1564500130149, 7)
    return events.select(
        "Timestamp", "Object", "Event", F.col("ObjectId.ProjectTypeId").alias("projectTypeId"),
        "ObjectId.SectionSelector", "OrgId", "ProjectId", "UserId",
    )


# Unions -------------------------------------------------------------------


@query("u1_union_all", """
    SELECT projectId, isArchived, incidentDate FROM {project}
    UNION ALL SELECT projectId, NULL, incidentDate FROM {project} WHERE projectTypeId = 1""")
def union_all(t: Tables) -> DataFrame:
    p = t["project"].select("projectId", "isArchived", "incidentDate")
    again = t["project"].where("projectTypeId = 1").select("incidentDate", "projectId")
    return files.union_all([p, again])


@query("u2_union_conflicting_types", """
    SELECT projectId, CASE WHEN projectTypeId <= 2 THEN CAST(projectId AS DOUBLE) END AS amount
    FROM {project}""")
def union_conflicting(t: Tables) -> DataFrame:
    p = t["project"]
    low = p.where("projectTypeId <= 2").select("projectId", F.col("projectId").alias("amount"))
    high = p.where("projectTypeId > 2").select("projectId", F.lit("unknown").alias("amount"))
    return files.union_as([low, high], {"projectId": "bigint", "amount": "double"})


# Snapshots ----------------------------------------------------------------


@query("l1_first_of_type", """
    SELECT projectId, phaseName FROM {project} WHERE projectTypeId = 2
    ORDER BY projectId LIMIT 1""")
def first_of_type(t: Tables) -> DataFrame:
    return snapshots.first_of_type(t["project"].select("projectId", "projectTypeId", "phaseName"), 2
                                   ).drop("projectTypeId")


MED_ORDER = ["projectId", "id", "type", "recordsordereddate", "valueTotal"]


@query("l2_first_with_items", """
    SELECT projectId, id, type, recordsordereddate, valueTotal FROM {meds}
    WHERE projectId IN (SELECT projectId FROM {project} WHERE projectTypeId = 3)
    ORDER BY projectId, id, type, recordsordereddate, valueTotal LIMIT 1""")
def first_with_items(t: Tables) -> DataFrame:
    return snapshots.first_with_items(t["project"], t["meds"], 3, MED_ORDER).select(*MED_ORDER)


def lead_frames(t: Tables) -> dict[str, DataFrame]:
    """Statuses with an id order, and leads that know their status and links."""
    names = {"O": "Open", "P": "Pending", "F": "Final"}
    statuses = t["region"].select(
        F.col("r_regionkey").alias("Id"),
        F.get(F.array(*map(F.lit, ["Unused", *names, "Other"])), "r_regionkey").alias("Status"),
    )
    key = F.col("o_orderkey")
    leads = t["orders"].select(
        key.alias("Id"), F.col("o_orderstatus").alias("Status"),
        F.when(key % 3 != 0, F.col("o_custkey")).alias("ContactId"),
        F.when(key % 4 != 0, key * 10).alias("OpportunityId"),
    )
    return {
        "statuses": statuses,
        "leadrow": leads,
        "leaddetail": leads,
        "opportunities": t.raw_opportunities(),
        "contact": t.raw_lead_contacts(),
    }


@query("l3_first_lead_with_link", """
    SELECT o_orderkey AS Id, o_custkey AS ContactId FROM orders
    WHERE o_orderstatus = 'O' AND o_orderkey % 3 <> 0 ORDER BY o_orderkey LIMIT 1""")
def first_lead_with_link(t: Tables) -> DataFrame:
    f = lead_frames(t)
    return snapshots.first_lead(f["statuses"], f["leaddetail"], "ContactId").select(
        "Id", "ContactId"
    )


@query("l4_first_row", "SELECT n_nationkey AS Id, n_name AS Name FROM nation ORDER BY 1 LIMIT 1")
def first_row(t: Tables) -> DataFrame:
    return snapshots.first_row(t.raw_referrals().select("Id", "Name"))


@query("t13_snapshot", """
    SELECT Id, LeadId FROM (
      SELECT o_orderkey * 10 AS Id, o_orderkey AS LeadId FROM orders
      WHERE o_orderstatus = 'O' AND o_orderkey % 4 <> 0 ORDER BY o_orderkey LIMIT 1)""")
def snapshot(t: Tables) -> DataFrame:
    return snapshots.snapshot(lead_frames(t), "lead", "core", "Opportunities").select(
        "Id", "LeadId"
    )
