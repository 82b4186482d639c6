"""The spread join gives the plain join's rows, whatever the row holds."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexweave.operators.skew import spread_join


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("payload", ["flat", "nested", "none"])
def test_same_as_the_plain_join(spark, how, payload):
    left = spark.range(200).select(
        F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 7 != 0, F.col("id") % 5).alias("k"), "id"
    )
    if payload == "nested":
        left = left.select("k", F.create_map(F.lit("a"), "id").alias("m")).select(
            "k", "m", F.array(F.element_at("m", "a")).alias("l"))
    if payload == "none":
        left = left.select("k")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (9, "z")], "k long, v string")
    if how in ("left_semi", "left_anti"):
        right = right.select("k")
    assert rows(spread_join(left, right, ["k"], how)) == rows(left.join(right, "k", how))


def test_hot_key_is_spread(spark):
    left = spark.range(1000).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1,)], "k int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = spread_join(left, right.distinct(), ["k"], "left_semi")
        assert joined.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        spread_join(spark.range(1), spark.range(1), ["id"], "right")
