"""Small text and time expressions on literal values."""

import pytest
from pyspark.sql import functions as F

from lexweave.functions import text
from lexweave.functions.types import LAKE_TYPES, WAREHOUSE_TYPES, target_type, type_column
from lexweave.config.model import ConfigError


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("value, parts", [
    (None, None), ("", []), ("a", ["a"]), ("a|b", ["a", "b"]), ("b||", ["b"]), ("a.b|c", ["a.b", "c"]),
])
def test_tokens(spark, value, parts):
    assert one(spark, text.tokens, value) == parts


@pytest.mark.parametrize("value, parts", [(None, None), ("", [""]), ("a||b", ["a", "", "b"]), ("a.b|", ["a.b", ""])])
def test_parts_keep_blanks(spark, value, parts):
    assert one(spark, text.parts, value) == parts


@pytest.mark.parametrize("uri, bucket, key", [
    ("s3://b/k/x.parquet", "b", "k/x.parquet"), ("b/k", "b", "k"), ("s3://b", "b", ""),
])
def test_uri_parts(spark, uri, bucket, key):
    assert one(spark, lambda c: text.uri_parts(c)[0], uri) == bucket
    assert one(spark, lambda c: text.uri_parts(c)[1], uri) == key


def test_tenant_and_selector(spark):
    assert one(spark, text.tenant_of_url, "https://acme.host.com/a") == "acme"
    assert one(spark, text.bare_selector, "custom.fee") == "fee"
    assert one(spark, text.bare_selector, "fee") == "fee"


def test_utc_day_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(1704067199999,), (1704067200000,)], "ms long")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        days = [str(r[0]) for r in df.select(text.utc_day(F.col("ms"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert days == ["2023-12-31", "2024-01-01"]


def test_type_tables(spark):
    assert one(spark, lambda c: type_column(c, LAKE_TYPES), "CalculatedCurrency") == "string"
    assert one(spark, lambda c: type_column(c, WAREHOUSE_TYPES), "decimal") == "numeric(10,3)"
    assert one(spark, lambda c: type_column(c, LAKE_TYPES), "Gauge") is None
    assert target_type("Case_ID", "int") == "bigint" and target_type("n", "int") == "int"
    with pytest.raises(ConfigError):
        target_type("x", "blob")
