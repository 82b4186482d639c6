"""Configuration, the mapped builder and the standard-model tables."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexweave.config.model import (
    ConfigError, Section, TargetField, TargetTable, load_lead_whitelist, load_mapping,
    load_whitelist, unique_targets,
)
from lexweave.config.standard_model import standard_mapping
from lexweave.config.whitelists import case_whitelist, lead_whitelist
from lexweave.plans.mapped import build, missing_sources
from lexweave.plans.standard_model import StandardModel
from lexweave.sources import records


def field(name, source=None, kind="string"):
    return TargetField(name, kind, source, "data" if source else "null")


def table(*fields):
    return TargetTable("T", "e", fields)


YAML = """
org_id: 9
tsm:
  - name: Peoples
    fields:
    - {name: Tenant_Org_ID, data_type: int, transform: {source: internal, type: key}}
    - {name: Client_Org_ID, data_type: int, transform: {source: etl, type: org_id}}
    - {name: People_ID, data_type: int,
       transform: {source_entity_name: contact, source_field: personId, type: data}}
    - {name: Team_ID, data_type: int, transform: {source: internal, type: key}}
    - {name: Gender, data_type: string}
"""


def test_mapping_file(spark, tmp_path):
    path = tmp_path / "map.yaml"
    path.write_text(YAML)
    mapping = load_mapping(str(path))
    assert mapping.org_id == 9
    people = mapping.table("Peoples")
    assert people.entity == "contact"
    df = spark.createDataFrame([(5,)], "personId int")
    out = build(df, people, mapping.org_id)
    # The tenant columns keep the file's names; an internal key is not produced.
    assert out.columns == ["Tenant_Org_ID", "Client_Org_ID", "People_ID", "Gender"]
    assert rows(out) == [(9, 9, 5, None)]
    with pytest.raises(ConfigError):
        mapping.table("Nothing")


def test_json_whitelists(tmp_path):
    path = tmp_path / "src.json"
    path.write_text(json.dumps({
        "org_id": 1, "core": [{"name": "contact", "fields": ["a"]}],
        "projectTypes": [{"id": 5, "sections": [{"name": "intake", "fields": ["b"]}]}],
    }))
    loaded = load_whitelist(str(path))
    assert loaded.section("Contact").fields == ("a",)
    assert loaded.section("intake", 5).allows("b")
    with pytest.raises(ConfigError):
        loaded.section("intake", 6)
    lead = load_lead_whitelist({"org_name": "x", "table_users": [{"name": "Users", "fields": ["Id"]}]})
    assert lead.section("users").fields == ("Id",)


def test_default_whitelists():
    sizes = {n: len(s.fields) for n, s in lead_whitelist().core.items()}
    assert sizes == {
        "statuses": 4, "leadsource": 2, "casetype": 6, "leadrow": 17, "leaddetail": 52,
        "contact": 31, "opportunities": 51, "referrals": 5, "users": 7,
    }
    assert {n: len(s.fields) for n, s in case_whitelist().core.items()} == {
        "contact": 18, "projecttype": 3, "project": 23
    }
    assert Section("form").allows("anything")


def test_duplicate_target_once_and_conflict_is_an_error():
    assert len(unique_targets(table(field("Fee", "f"), field("FEE", "f"))).fields) == 1
    with pytest.raises(ConfigError, match="mapped from both"):
        unique_targets(table(field("Fee", "f"), field("Fee", "g")))


def test_missing_source_strict_and_lenient(spark):
    df = spark.createDataFrame([(1,)], "a int")
    wanted = table(field("x", "a"), field("y", "gone", "date"))
    assert missing_sources(df, wanted) == ["gone"]
    with pytest.raises(ConfigError, match="gone"):
        build(df, wanted, 1)
    assert rows(build(df, wanted, 1, typed=True, strict=False)) == [("1", None)]


def test_source_names_match_in_any_case(spark):
    df = spark.createDataFrame([(1,)], "caseManager int")
    assert rows(build(df, table(field("m", "casemanager")), 1)) == [(1,)]
    both = df.select("caseManager", F.col("caseManager").alias("CASEMANAGER"))
    with pytest.raises(ConfigError, match="ambiguous"):
        build(both, table(field("m", "casemanager")), 1)


def test_reads_come_from_the_input_frame(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(build(df, table(field("b", "a"), field("c", "b")), 1)) == [(1, 2)]


def test_tenant_from_a_column(spark):
    df = spark.createDataFrame([(1, 8), (2, 9)], "a int, tenant int")
    wanted = table(TargetField("Org", "int", kind="org"), field("a", "a"))
    assert rows(build(df, wanted, F.col("tenant"))) == [(8, 1), (9, 2)]


def test_ingest_time_is_opt_in(tables):
    at = datetime(2024, 1, 2, 3)
    plain = StandardModel(standard_mapping(1)).cases(tables["project"])
    stamped = StandardModel(standard_mapping(1), ingested_at=at).cases(tables["project"])
    assert "date_ingested" not in plain.columns
    assert stamped.first().date_ingested == at


def test_tenant_column_names_are_a_setting(tables):
    model = StandardModel(standard_mapping(1, ("House_Org_ID", "Client_Org_ID")))
    for df in (model.cases(tables["project"]), model.people_types(tables["contact"])):
        assert "House_Org_ID" in df.columns


def test_customer_override(tables):
    mapping = standard_mapping(1)
    own = mapping.table("Cases").without("Is_Archived")
    out = StandardModel(mapping.with_overrides({"Cases": own})).cases(tables["project"])
    assert "Is_Archived" not in out.columns


def people(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "personId int, personTypes string").selectExpr(
        "*", "'f' firstName", "'l' lastName"
    )


def test_blank_types_are_dropped_in_both_tables(spark):
    contact = people(spark, None, "", "a", "a|b", "b||")
    model = StandardModel(standard_mapping(1))
    types = model.people_types(contact)
    assert rows(types.select("People_Type", "People_Type_Id")) == [("a", 0), ("b", 1)]
    assert rows(model.people_type_links(contact, types)) == [(2, 0), (3, 0), (3, 1), (4, 1)]


def test_unknown_type_keeps_a_null_id(spark):
    contact = people(spark, "a|z")
    model = StandardModel(standard_mapping(1))
    types = model.people_types(people(spark, "a"))
    assert rows(model.people_type_links(contact, types)) == [(0, 0), (0, None)]


def test_type_ids_do_not_depend_on_partitioning(tables):
    model = StandardModel(standard_mapping(1))
    one = rows(model.people_types(tables["contact"].repartition(1)))
    many = rows(model.people_types(tables["contact"].repartition(13)))
    assert one == many


def test_phases_outputs_no_permanence(spark):
    df = spark.sql(
        "SELECT 1 projectTypeId, 'n' name, "
        "array(named_struct('phaseId', 2, 'name', 'Open', 'isPermanent', true)) phases"
    )
    out = StandardModel(standard_mapping(1)).phases(df)
    assert "isPermanent" not in out.columns
    assert out.first().Phase_ID == 2 and out.first().Phase_Name == "Open"


def test_builders_are_lazy(spark, tables):
    model = StandardModel(standard_mapping(1))
    contact, project = tables["contact"], tables["project"]
    spark.sparkContext.setJobGroup("lazy", "builders")
    try:
        types = model.people_types(contact)
        model.people(contact)
        model.people_type_links(contact, types)
        model.cases(project)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
        types.count()
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ids_are_unwrapped_everywhere(tables):
    out = records.projects(tables.raw_projects())
    kinds = {f.name: f.dataType.simpleString() for f in out.schema}
    assert kinds["projectId"] == "bigint" and kinds["projectTypeId"] == "int"
    assert kinds["clientId"] == "bigint"


def test_contact_ids_of_leads_once_and_not_null(spark):
    leads = spark.sql(
        "SELECT named_struct('Id', a) Contact FROM VALUES (1), (1), (null) t(a) "
        "UNION ALL SELECT null"
    )
    assert rows(records.linked_ids(leads, "Contact")) == [(1,)]
