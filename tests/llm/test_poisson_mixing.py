"""Mixing: rates, shares and hard rows."""

import math

from conftest import SF, rows
from pyspark.sql import functions as F

from lexweave.llm import poisson_mixing as mixing


def test_weights_set_the_shares(spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"),
    )
    out = mixing.mix(df, weights={"a": 3.0, "b": 1.0})
    counts = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert set(counts) == {"a", "b"}
    # 4500 and 1500 expected; four standard deviations.
    assert abs(counts["a"] - 4500) < 270 and abs(counts["b"] - 1500) < 160


def test_copies_follow_the_distribution(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    out = mixing.mix(df, size=2.0)
    per = {r["n"]: r["count"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).groupBy("n").count().collect()}
    for n in range(1, 6):
        expected = 4000 * math.exp(-2) * 2**n / math.factorial(n)
        assert abs(per[n] - expected) < 4 * math.sqrt(expected) + 5


def test_same_rows_every_time_and_shuffled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    once = rows(mixing.mix(docs).select("doc_id", "mix_copy", "mix_place"))
    again = rows(mixing.mix(docs.repartition(5)).select("doc_id", "mix_copy", "mix_place"))
    assert once == again
    places = [r["mix_place"] for r in mixing.mix(docs).collect()]
    assert [r for r in places] != sorted(places, reverse=True) and len(set(places)) == len(places)


def test_hard_rows(spark):
    data = [(None, None, None, 1), (1, None, "a", 2), (1, "x", "a", 3), (1, "x", "a", 3), (2, "", None, 4)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, _mix_id int")
    out = mixing.mix(df, size=3.0)
    assert out.columns == ["doc_id", "text", "source", "_mix_id", "mix_copy", "mix_place"]
    twin = [r["mix_copy"] for r in out.where("text = 'x'").collect()]
    assert sorted(twin) == sorted([*set(twin)] * 2)
    assert mixing.mix(df.limit(0)).collect() == []


def test_high_rates_are_whole(spark):
    """A rate of 50, far above one part's, keeps its mean, its spread and the mix its size."""
    df = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"),
        F.when(F.col("id") < 200, "small").otherwise("big").alias("source"),
    )
    out = mixing.mix(df, weights={"small": 0.5, "big": 0.5}).select("doc_id", "source", "mix_copy")
    per = [r["n"] for r in out.where("source = 'small'").groupBy("doc_id").agg(F.count("*").alias("n")).collect()]
    assert len(per) == 200
    # 10,000 expected of each source; four standard deviations.
    assert abs(sum(per) - 10_000) < 400 and abs(out.count() - 20_000) < 600
    spread = sum((n - sum(per) / 200) ** 2 for n in per) / 199
    assert 30 < spread < 75 and max(per) > 64
