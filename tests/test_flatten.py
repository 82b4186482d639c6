"""Flattening rules on literal records, nulls included."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexweave.config.model import ConfigError, Section
from lexweave.functions import flatten, leads
from lexweave.functions.types import lake_schema, to_lake


def records(spark, schema, *lines):
    return spark.createDataFrame([(line,) for line in lines], "j string").select(
        F.from_json("j", schema).alias("r")
    ).select("r.*")


def flat(spark, schema, kind, *lines):
    df = records(spark, f"x {schema}", *lines)
    return [r[0] for r in flatten.flatten(df, {"x": kind}).collect()]


def test_id_struct_scalar_and_null(spark):
    assert flat(spark, "struct<native: bigint>", "Id", '{"x":{"native":7}}', '{"x":null}') == [7, None]
    assert flat(spark, "bigint", "Id", '{"x":7}') == [7]


def test_id_of_mixed_shape(spark):
    df = spark.createDataFrame([('{"native": 5}',), ("6",), (None,)], "j string").select(
        F.parse_json("j").alias("x")
    )
    assert [r[0] for r in flatten.flatten(df, {"x": "Id"}).collect()] == ["5", "6", None]


def test_person_link_null_does_not_reuse_the_previous_value(spark):
    lines = ['{"x":{"id":1}}', '{"x":null}', '{"x":{"id":3}}']
    assert flat(spark, "struct<id: bigint>", "PersonLink", *lines) == [1, None, 3]


def test_person_list(spark):
    lines = ['{"x":[{"id":1},{"id":2}]}', '{"x":[]}', '{"x":null}', '{"x":[{"id":1},null]}']
    assert flat(spark, "array<struct<id: bigint>>", "PersonList", *lines) == ["1|2", "", "", "1"]


def test_string_list(spark):
    lines = ['{"x":["a","b"]}', '{"x":[]}', '{"x":null}', '{"x":["a",null]}']
    assert flat(spark, "array<string>", "StringList", *lines) == ["a|b", "", None, "a"]


def test_other_lists(spark):
    assert flat(spark, "array<string>", "Dropdown", '{"x":["a","b"]}') == ["a|b"]
    assert flat(spark, "array<bigint>", "Dropdown", '{"x":[1,2]}') == [[1, 2]]


def test_object_is_kept_and_null_stays_null(spark):
    got = flat(spark, "struct<a: bigint>", "object", '{"x":{"a":1}}', '{"x":null}')
    assert got[0].a == 1 and got[1] is None


def test_selection_drops_display_and_unknown_fields(spark):
    df = records(spark, "a string, b string, c string", '{"a":"1","b":"2","c":"3"}')
    out = flatten.flatten(df, {"c": "Text", "a": "Text", "b": "DocGen", "z": "Text"})
    assert out.columns == ["a", "c"]


@pytest.mark.parametrize(
    "kind", ["Header", "DocGen", "ActionButton", "MultiDocGen", "DocList", "Doc", "ReportFusion"]
)
def test_display_types(spark, kind):
    df = records(spark, "a string, b string", '{"a":"1","b":"2"}')
    assert flatten.flatten(df, {"a": "Text", "b": kind}).columns == ["a"]


def test_odd_field_names(spark):
    df = records(spark, "`100Liability` string, `a.b` string", '{"100Liability":"1","a.b":"2"}')
    out = flatten.flatten(df, {"100Liability": "Text", "a.b": "Text"})
    assert rows(out) == [("1", "2")]


def test_metadata_within_whitelist(spark):
    meta = spark.createDataFrame(
        [("custom.fee", "Currency"), ("custom.note", "Text"), ("hidden", "Text")], "s string, t string"
    )
    section = Section("intake", ("fee", "note"))
    declared = flatten.field_types(meta, "s", "t", section)
    assert declared == {"fee": "Currency", "note": "Text"}
    assert flatten.selected_types(declared, "projectId") == {
        "fee": "Currency", "note": "Text", "projectId": "int"
    }
    assert flatten.selected_types({}, "id", "ProjectId") == {"id": "Id", "projectId": "ProjectId"}
    assert flatten.field_types(meta, "s", "t", Section("all")).keys() == {"fee", "note", "hidden"}


def test_contradicting_metadata_is_an_error(spark):
    meta = spark.createDataFrame([("custom.a", "Text"), ("a", "Date")], "s string, t string")
    with pytest.raises(ConfigError, match="declared as"):
        flatten.field_types(meta, "s", "t", Section("all"))


def test_whitelist_alone(spark):
    section = Section("project", ("projectId", "name"))
    assert flatten.whitelist_types(section, "projectId") == {"projectId": "int", "name": "string"}
    with pytest.raises(ConfigError):
        flatten.whitelist_types(Section("project"), "projectId")


def test_registered_rule(spark):
    flatten.register_rule("Shout", lambda c, _: F.upper(c))
    try:
        assert flat(spark, "string", "Shout", '{"x":"a"}') == ["A"]
    finally:
        del flatten.RULES["Shout"]


def test_unknown_types_are_listed():
    with pytest.raises(ConfigError, match="Gauge, Map"):
        lake_schema({"a": "Map", "b": "Text", "c": "Gauge", "d": "Header"})


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1.5", "x", "2020-01-02")], "a string, b string, c string")
    out = to_lake(df, {"a": "double", "b": "double", "c": "date"})
    assert [f.dataType.simpleString() for f in out.schema] == ["double", "double", "date"]
    assert out.first()[1] is None


def test_text_record(spark):
    df = records(spark, "o struct<a: bigint>, l array<string>", '{"o":{"a":1},"l":["x","y"]}')
    assert rows(flatten.as_text_record(df, {"o": "object", "l": "StringList"})) == [('{"a":1}', "x|y")]


LEAD = (
    "Id bigint, Contact struct<Id: bigint>, Attorney struct<Id: bigint, Name: string>, "
    "Notes array<struct<Id: bigint>>, CustomFields array<struct<CustomFieldId: bigint>>"
)


def test_lead_detail(spark):
    df = records(
        spark, LEAD,
        '{"Id":1,"Contact":{"Id":2},"Attorney":{"Id":3},"Notes":[{"Id":4},{"Id":5}],'
        '"CustomFields":[{"CustomFieldId":9}]}',
        '{"Id":2,"Contact":null,"Attorney":null,"Notes":null,"CustomFields":null}',
    )
    out = leads.lead_detail(df)
    assert rows(out.drop("CustomFields")) == [(1, 2, 3, "4,5"), (2, None, None, None)]
    assert out.first().CustomFields[0].CustomFieldId == 9


def test_lead_contact(spark):
    df = records(
        spark, "Id bigint, LeadIds array<bigint>, CustomFields array<struct<CustomFieldId: bigint>>",
        '{"Id":1,"LeadIds":[7,8],"CustomFields":[{"CustomFieldId":3},{"CustomFieldId":4}]}',
        '{"Id":2,"LeadIds":[],"CustomFields":[]}',
    )
    assert rows(leads.contact(df)) == [(1, "7,8", "3,4"), (2, "", "")]


NAME = "struct<FirstName: string, LastName: string>"


def test_opportunity(spark):
    df = records(
        spark, f"Id bigint, AssignedTo array<{NAME}>, ProcessedBy {NAME}",
        '{"Id":1,"AssignedTo":[{"FirstName":"A","LastName":"B"},{"FirstName":"C"}],'
        '"ProcessedBy":{"FirstName":"D","LastName":"E"}}',
        '{"Id":2,"AssignedTo":[],"ProcessedBy":null}',
        '{"Id":3,"AssignedTo":null,"ProcessedBy":{"FirstName":"D","LastName":null}}',
    )
    assert rows(leads.opportunity(df)) == [(1, "A B", "D E"), (2, "", ""), (3, "", "D")]


def test_lead_whitelist_keeps_order_and_adds_nothing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, x int")
    assert leads.whitelisted(df, Section("s", ("a", "b", "c"))).columns == ["c", "a"]
