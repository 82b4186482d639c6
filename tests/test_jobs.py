"""Batch jobs over a raw folder laid out file by file."""

import pyarrow as pa
import pyarrow.parquet as pq

from conftest import rows
from lexweave.__main__ import main
from lexweave.config.whitelists import lead_whitelist
from lexweave.functions import flatten
from lexweave.plans import jobs
from lexweave.sources.files import read_phase_files, read_raw


def one_file(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


def lay_out(base):
    """Two projects with different columns, contacts, types and one empty section."""
    org = base / "cms" / "6"
    one_file(org / "contact" / "historical_contacts.parquet",
             personId=[1, 2], firstName=["A", "B"], lastName=["C", "D"], personTypes=["x|y", ""])
    phases = [[{"phaseId": 7, "name": "Open", "isPermanent": True}]]
    one_file(org / "projecttype" / "projecttypes.parquet",
             projectTypeId=[18], name=["Injury"], phases=phases)
    one_file(org / "18" / "10" / "project.parquet", projectId=[10], projectTypeId=[18],
             isArchived=[False], incidentDate=["2020-01-02"])
    one_file(org / "18" / "11" / "project.parquet", projectId=[11], projectTypeId=[18],
             isArchived=[True], incidentDate=["n/a"], extra=["e"])
    one_file(org / "18" / "10" / "collections" / "meds.parquet", projectId=[10, 10],
             type=["Bill", "Bill"], recordsordereddate=["2020-02-03", None], valueTotal=["1.5", "x"])
    return str(base / "cms")


def test_job_over_a_raw_folder(spark, tmp_path):
    raw, out = lay_out(tmp_path), str(tmp_path / "model")
    assert set(read_raw(spark, raw, "6", 18)) == {"contact", "projecttype", "project", "meds"}
    paths = main(["--raw", raw, "--out", out, "--org", "6", "--project-type", "18", "--typed"])
    assert set(paths) == {"PeopleTypes", "Peoples", "Peoples_PeopleType", "Cases",
                          "PracticeTypes", "Phases", "CaseFigures"}
    assert all(path == f"{out}/{name.lower()}" for name, path in paths.items())
    cases = spark.read.parquet(paths["Cases"]).selectExpr(
        "Platform_Org_ID", "Case_ID", "Is_Archived", "string(Incident_Date)")
    assert rows(cases) == [(6, 10, False, "2020-01-02"), (6, 11, True, None)]
    figures = spark.read.parquet(paths["CaseFigures"]).selectExpr("Case_ID", "Value")
    assert rows(figures) == [(10, 1.5), (10, None)]
    links = spark.read.parquet(paths["Peoples_PeopleType"])
    assert rows(links) == [(1, 0), (1, 1)]
    again = main(["--raw", raw, "--out", out, "--org", "6", "--project-type", "18", "--typed"])
    assert rows(spark.read.parquet(again["Peoples_PeopleType"])) == [(1, 0), (1, 1)]


def test_adopted_store_reads_like_the_raw_folder(spark, tmp_path, scratch):
    raw = lay_out(tmp_path)
    paths = jobs.adopt_raw(spark, raw, 6, 18, scratch())
    stored = spark.read.parquet(paths["project"])
    assert stored.columns[-2:] == ["org_id", "project_type_id"]
    plain = read_raw(spark, raw, "6", 18)["project"]
    assert rows(stored.select(*plain.columns)) == rows(plain)
    assert rows(stored.select("org_id", "project_type_id").distinct()) == [(6, 18)]


def test_phase_files(spark, tmp_path):
    base = tmp_path / "cms" / "6" / "18" / "10" / "phases"
    one_file(base / "1654733926323.parquet", project_id=[10], phase=["Demand"])
    one_file(base / "1654733926400.parquet", project_id=[10], phase=["Trial"])
    log = read_phase_files(spark, str(tmp_path / "cms" / "*" / "*" / "*" / "phases" / "*.parquet"))
    assert rows(log) == [(6, 18, 10, 1654733926323, "Demand"), (6, 18, 10, 1654733926400, "Trial")]


def test_lead_load_flattens_and_whitelists(spark, tables, scratch):
    paths = jobs.load_leads(
        {"leaddetail": tables.raw_lead_details(), "users": tables.raw_users()},
        lead_whitelist("acme"), scratch(),
    )
    users = spark.read.parquet(paths["users"])
    assert "Internal" not in users.columns and "Roles" in users.columns
    detail = spark.read.parquet(paths["leaddetail"]).where("Id = 5").first()
    assert detail.Opportunity == 50 and detail.CustomFields[0].CustomFieldId == 5


def test_case_load_keeps_nested_phases(spark, tables, scratch):
    types = spark.sql(
        "SELECT named_struct('native', 1) projectTypeId, 'n' name, "
        "array(named_struct('phaseId', 2, 'name', 'Open', 'isPermanent', true)) phases, 'l' links"
    )
    contact_types = flatten.contact_types({"firstName": "Text"})
    paths = jobs.load_cases(
        {"projecttype": types, "contact": tables.raw_contacts()}, {"contact": contact_types}, scratch()
    )
    stored = spark.read.parquet(paths["projecttype"])
    assert stored.columns == ["projectTypeId", "name", "phases"]
    assert stored.first().phases[0].phaseId == 2
    contact = spark.read.parquet(paths["contact"])
    assert contact.columns == ["personId", "firstName", "personTypes"]
    assert contact.schema["personId"].dataType.simpleString() == "string"


def test_loads_of_two_tenants_share_a_root(spark, scratch):
    root = scratch("leads")
    for org in (6, 7, 6):
        landed = {"leadrow": spark.createDataFrame([(org, 1, "x", 2)], "Id long, ContactId long, Code string, StatusId long")}
        paths = jobs.load_leads(landed, lead_whitelist("acme"), root, {"org_id": org})
    assert rows(spark.read.parquet(paths["leadrow"]).select("org_id", "Id")) == [(6, 6), (7, 7)]
