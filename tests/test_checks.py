"""Constraint checks and the declared warehouse."""

import random
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from conftest import rows
from lexweave.config.model import ConfigError
from lexweave.config.standard_model import standard_mapping
from lexweave.config.warehouse import RENAMES, WAREHOUSE, ForeignKey, warehouse_table
from lexweave.operators import checks
from lexweave.operators.references import References
from lexweave.plans.standard_model import StandardModel


def test_declared_tables(spark):
    assert len(WAREHOUSE) == 34
    assert sum(len(t.references) for t in WAREHOUSE.values()) == 25
    assert sum(len(k.columns) == 2 for t in WAREHOUSE.values() for k in t.references) == 3
    for table in WAREHOUSE.values():
        names = [f.name.lower() for f in table.schema().fields]
        assert len(names) == len(set(names))
        for key in (*table.primary_key, *table.unique, *(c for k in table.references for c in k.columns)):
            assert key.lower() in names, (table.name, key)
        for key in table.references:
            parent = [f.name.lower() for f in warehouse_table(key.parent).schema().fields]
            assert all(c.lower() in parent for c in key.parent_columns)
    with pytest.raises(ConfigError):
        warehouse_table("CMS_Nothing")


DECIMALS = [
    ("999999.99", 0), ("999999.994", 0), ("999999.995", 1), ("1000000", 1), ("-1000000", 1),
    ("-999999.994", 0), ("0", 0), (None, 0),
]


@pytest.mark.parametrize("kind", ["double", "decimal(20,6)", "string"])
def test_decimal_range_agrees_with_the_cast(spark, kind):
    table = warehouse_table("CMS_CaseFigures")
    for text, expected in DECIMALS:
        df = spark.createDataFrame([(text,)], "t string").selectExpr(f"cast(t as {kind}) Value")
        report = checks.check_values(df, table, ["decimal"])
        assert rows(report.select("violations")) == [(expected,)], text
        assert df.selectExpr("count_if(try_cast(Value as decimal(8,2)) is null and Value is not null)"
                             ).first()[0] == expected, text


def test_length_and_null_counts(spark):
    df = spark.createDataFrame([(1, "a" * 256), (None, "a" * 255)], "People_ID int, First_Name string")
    report = checks.check_values(df, warehouse_table("CMS_People"))
    found = {(r.check, r.column_name): r.violations for r in report.collect()}
    assert found["length", "First_Name"] == 1
    assert found["not_null", "People_ID"] == 1
    assert found["not_null", "Team_ID"] == 2  # a declared column that was not built


def test_duplicates_and_orphans_count_rows_and_skip_nulls(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (2,), (None,)], "Case_Type_ID int")
    parent = spark.createDataFrame([(1,)], "Case_Type_ID int")
    key = warehouse_table("CMS_CaseDetails").references[0]
    assert rows(checks.orphans(child, key, parent)) == [(2, 2)]
    assert rows(checks.duplicate_keys(child, ["Case_Type_ID"])) == [(1, 2), (2, 2)]


def test_conform_and_report(spark, tables):
    model = StandardModel(standard_mapping(1))
    cases = checks.conform(model.cases(tables["project"]), warehouse_table("CMS_Cases"), RENAMES["CMS_Cases"])
    declared = [f.name for f in warehouse_table("CMS_Cases").schema().fields]
    assert cases.columns == declared
    report = checks.check_table(cases, warehouse_table("CMS_Cases"))
    assert {r.violations for r in report.collect()} == {0}


def test_whole_warehouse_report(spark):
    frames = {
        "CMS_Teams": spark.sql("SELECT 1 Platform_Org_ID, 1 Client_Org_ID, 1 Team_ID, 'a' Team_Name"),
        "CMS_People": spark.sql(
            "SELECT 1 Platform_Org_ID, '1' Client_Org_ID, id People_ID, id % 3 Team_ID FROM range(1, 7)"
        ),
        "CMS_PeopleType": spark.sql(
            "SELECT 1 Platform_Org_ID, '1' Client_Org_ID, 4 People_Type_ID, 'x' People_Type"
        ),
        "CMS_PeoplePeopleTypes": spark.sql(
            "SELECT 1 Platform_Org_ID, '1' Client_Org_ID, a People_ID, b People_Type_ID "
            "FROM VALUES (1, 4), (1, 4), (9, 4), (2, 5) t(a, b)"
        ),
    }
    bad = {
        (r.table_name, r.check, r.column_name): r.violations
        for r in checks.check_warehouse(frames).collect() if r.violations
    }
    assert bad == {
        ("CMS_People", "foreign_key", "Team_ID"): 4,
        ("CMS_PeoplePeopleTypes", "primary_key", "People_ID,People_Type_ID"): 2,
        ("CMS_PeoplePeopleTypes", "foreign_key", "People_ID"): 1,
        ("CMS_PeoplePeopleTypes", "foreign_key", "People_Type_ID"): 1,
    }


def test_drift(spark, tables):
    built = StandardModel(standard_mapping(1)).cases(tables["project"]).schema
    drift = checks.column_drift(built, warehouse_table("CMS_Cases"))
    assert ("Date_of_Incident", "absent", "date") in drift
    assert ("Incident_Date", "date", "undeclared") in drift
    assert ("Client_Org_ID", "int", "varchar(255)") in drift
    renamed = checks.column_drift(built, warehouse_table("CMS_Cases"), RENAMES["CMS_Cases"])
    assert "Date_of_Incident" not in {d[0] for d in renamed}


def test_conform_of_numbers_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, 999999.994), (2, 1e7), (3, float("nan")), (4, None)],
                               "Case_ID int, Value double")
    out = checks.conform(df, warehouse_table("CMS_CaseFigures"))
    assert rows(out.select("Case_ID", "Value")) == [
        (1, Decimal("999999.99")), (2, None), (3, None), (4, None)]


def test_conform_decimal(spark):
    df = spark.createDataFrame([(1, "12.345"), (2, "1e9"), (3, "x")], "Case_ID int, Value string")
    out = checks.conform(df, warehouse_table("CMS_CaseFigures"))
    assert rows(out.select("Case_ID", "Value")) == [(1, Decimal("12.35")), (2, None), (3, None)]


def test_one_scan_and_one_shuffle_of_keys(spark, scratch):
    """All constraints of a table with ten references: its rows are read and fanned out once."""
    table = warehouse_table("CMS_CaseDetails")
    ids = [c for k in table.references for c in k.columns]
    spark.range(500).selectExpr(
        "1 Platform_Org_ID", "'1' Client_Org_ID", "id Parent_Case_ID", "id % 400 Case_ID",
        *[f"CASE WHEN id % 3 > 0 THEN id % {11 + i} END {c}" for i, c in enumerate(ids)],
        "repeat('x', cast(id as int)) Case_Name",
    ).write.parquet(path := scratch())
    details = spark.read.parquet(path)
    parents = {}
    for ref in table.references:
        parents.setdefault(ref.parent, spark.range(7).withColumnRenamed("id", ref.parent_columns[0]))
    report = checks.check_table(details, table, parents)
    found = {(r.check, r.column_name): r.violations for r in report.collect()}
    for i, c in enumerate(ids):
        assert found["foreign_key", c] == sum(n % 3 > 0 and n % (11 + i) >= 7 for n in range(500)), c
    assert found["primary_key", "Parent_Case_ID,Case_ID"] == 0
    assert found["length", "Case_Name"] == 500 - 256
    assert found["not_null", "Case_ID"] == 0
    plan = report._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert initial.count("FileScan parquet") == 1
    assert initial.count("Exchange hashpartitioning(rule#") == 2  # the keys, then one row per rule
    assert [line.count("key#") for line in initial.splitlines() if "Exchange hashpartitioning(rule#" in line].count(1) == 1


@pytest.mark.parametrize("kinds", [("int", "bigint"), ("double", "int"), ("decimal(9,2)", "int"), ("string", "string")])
def test_references_of_other_types_compare_as_a_join_does(spark, kinds):
    child = spark.range(10).selectExpr(f"cast(id as {kinds[0]}) Team_ID", "id People_ID")
    parent = spark.range(7).selectExpr(f"cast(id as {kinds[1]}) Team_ID")
    report = checks.check_table(child, warehouse_table("CMS_People"), {"CMS_Teams": parent})
    assert report.where("check = 'foreign_key'").first().violations == 3


def loads_of(spark, rng, key_sql, n):
    """Random loads of children and parents, and what a full check over all of them finds."""
    for _ in range(n):
        child = [(rng.randint(-40, 60) if rng.random() < 0.9 else None,) for _ in range(rng.randint(0, 80))]
        parent = [(rng.randint(-40, 60),) for _ in range(rng.randint(0, 15))]
        yield (spark.createDataFrame(child, "k int").selectExpr(*key_sql("k")),
               spark.createDataFrame(parent, "k int").selectExpr(*key_sql("k")))


@pytest.mark.parametrize("kind", ["int", "far", "text", "two"])
def test_loads_of_references_equal_the_full_check(spark, scratch, kind):
    sql = {
        "int": lambda k: [f"{k} a"],
        "far": lambda k: [f"cast({k} as bigint) * 100000000000007 a"],
        "text": lambda k: [f"'x' || {k} a"],
        "two": lambda k: [f"{k} a", f"cast({k} % 7 as string) b"],
    }[kind]
    names = tuple("ab"[: len(sql("k"))])
    key = ForeignKey(names, "parent", names)
    state = References(scratch(), key)
    children, parents = [], []
    for child, parent in loads_of(spark, random.Random(kind), sql, 4):
        children.append(child)
        parents.append(parent)
        state.load(child, parent)
        whole = [reduce(DataFrame.unionByName, side) for side in (children, parents)]
        assert rows(state.orphans(spark)) == rows(checks.orphans(whole[0], key, whole[1]))
    # A load that is done already is not taken twice.
    state.load(children[-1], parents[-1], number=3)
    assert rows(state.orphans(spark)) == rows(checks.orphans(whole[0], key, whole[1]))


def test_references_name_types_that_differ(spark, scratch):
    key = ForeignKey(("a",), "parent", ("a",))
    with pytest.raises(TypeError, match="a is double, but string"):
        References(scratch(), key).load(spark.sql("SELECT 1d a"), spark.sql("SELECT '1' a"))


def test_half_a_load_of_references_is_done_again(spark, scratch):
    key, path = ForeignKey(("a",), "parent", ("p",)), scratch()
    state = References(path, key)
    state.load(spark.sql("SELECT explode(array(1, 2, 2)) a"), spark.sql("SELECT 1 p"))
    spark.sql("SELECT 2L a").write.parquet(f"{path}/parents/load=1")  # a load that died here
    state.load(spark.sql("SELECT 3 a"), spark.sql("SELECT 3 p"))
    assert rows(state.orphans(spark)) == [(2, 2)]
