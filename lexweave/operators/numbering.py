"""Dense numbers in key order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexweave.functions.types import quoted
from lexweave.sources.files import complete

PER_RANGE = 4  # sample keys per range
FAN_OUT = 8
RANGE_ROWS = 1_000_000  # rows that one task sorts well; ranges are cut for about as many


def depth_for(rows: int) -> int:
    """Levels of eight that keep ranges near ``RANGE_ROWS``: 0 is one range, 512 ranges are 3."""
    depth = 0
    while FAN_OUT**depth * RANGE_ROWS < rows:
        depth += 1
    return depth


def with_range(df: DataFrame, key: str, out: str, depth: int) -> DataFrame:
    """Number of the key range a row falls in: ``8 ** depth`` ranges at sample quantiles.

    A key finds its range in ``depth`` steps, each among the seven cuts between
    the eight parts of the part found before. All cuts are in one small row.
    """
    ranges = FAN_OUT**depth
    sample = df.select(key).orderBy(F.xxhash64(key), key).limit(ranges * PER_RANGE - 1)
    in_order = F.sort_array(F.collect_list(key))
    quantiles = F.filter(in_order, lambda _, i: i % PER_RANGE == PER_RANGE - 1)
    cuts = sample.agg(quantiles.alias("cuts"))

    def level(number: int) -> Column:
        """For each part at this level the cuts between its eight parts."""
        step = FAN_OUT ** (depth - number - 1)
        parts = F.sequence(F.lit(0), F.lit(FAN_OUT**number - 1))
        inner = F.sequence(F.lit(1), F.lit(FAN_OUT - 1))
        return F.transform(
            parts,
            lambda p: F.transform(inner, lambda m: F.get("cuts", (p * FAN_OUT + m) * step - 1)),
        )

    tree = cuts.select(F.struct(*[level(n).alias(f"level{n}") for n in range(depth)]))
    found = df.withColumns({"_tree": tree.scalar(), out: F.lit(0)})
    for number in range(depth):
        between = F.get(F.col(f"_tree.level{number}"), F.col(out))
        passed = F.size(F.filter(between, lambda cut: cut <= F.col(key)))
        found = found.withColumn(out, F.col(out) * FAN_OUT + F.coalesce(passed, F.lit(0)))
    return found.drop("_tree")


def number_in_order(df: DataFrame, key: str, out: str, depth: int | None = None) -> DataFrame:
    """0-based position of each row by ``key``, which must be unique and not null.

    ``depth`` gives ``8 ** depth`` key ranges; without it the rows are counted now, so that
    there are as many as they need.

    Each key range is numbered on its own and shifted by the rows of the ranges
    before it. The sample behind the ranges only balances them: the numbers are
    exact whatever it holds.
    """
    depth = depth_for(df.count()) if depth is None else depth
    if depth == 0:
        position = F.row_number().over(W.orderBy(key)) - 1
        return df.select(*df.columns, position.cast("bigint").alias(out))
    binned = with_range(df, key, "_bin", depth)
    # At most one row per range from here on: the running total and the broadcast are small.
    sizes = binned.groupBy("_bin").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bin", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    position = F.row_number().over(W.partitionBy("_bin").orderBy(key)) - 1
    numbered = binned.withColumn("_position", position).join(F.broadcast(offsets), "_bin")
    return numbered.select(*df.columns, (F.col("_offset") + F.col("_position")).alias(out))


class KeyMap:
    """Numbers of values under ``path`` that stay as they are while loads bring new values.

    A load's new values are numbered in order after the highest number so far, so the numbers
    are dense over all loads. Each load has its own folder and is never written again; what a
    load costs beside its own values is one look at the known ones.
    """

    def __init__(self, path: str, key: str, out: str) -> None:
        self.path, self.key, self.out = path, key, out

    def loads(self, spark: SparkSession) -> list[int]:
        """Numbers of the loads that are done, in order."""
        return sorted(int(p.rpartition("=")[2]) for p in complete(spark, f"{self.path}/keys/load=*"))

    def numbers(self, spark: SparkSession) -> DataFrame | None:
        """Every known value with its number, or nothing before the first load."""
        done = self.loads(spark)
        return spark.read.parquet(*[f"{self.path}/keys/load={n}" for n in done]) if done else None

    def load(self, values: DataFrame, number: int | None = None) -> DataFrame:
        """Take values in and return all numbers; nulls have none, a load done already changes nothing."""
        spark = values.sparkSession
        done, known = self.loads(spark), self.numbers(spark)
        number = (done[-1] + 1 if done else 0) if number is None else number
        if number not in done:
            new = values.select(quoted(self.key)).dropna().distinct()
            if known is not None:
                new = new.join(known, self.key, "left_anti")
            # Written first: counted and cut into ranges as files, not by running the join again.
            new.write.mode("overwrite").parquet(f"{self.path}/new/load={number}")
            new = spark.read.parquet(f"{self.path}/new/load={number}")
            first = 0 if known is None else known.count()
            numbered = number_in_order(new, self.key, self.out)
            shifted = numbered.withColumn(self.out, F.col(self.out) + F.lit(first).cast("bigint"))
            shifted.write.mode("overwrite").parquet(f"{self.path}/keys/load={number}")
        return self.numbers(spark)


def hashed_key(df: DataFrame, key: str, out: str) -> DataFrame:
    """A 64-bit key from the value itself: no shuffle, the same in every run."""
    return df.withColumn(out, F.xxhash64(key))


def key_collisions(df: DataFrame, key: str, hashed: str) -> DataFrame:
    """Hashed keys that stand for more than one value; expected empty."""
    pairs = df.groupBy(hashed).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return pairs.where(F.col("low") != F.col("high"))
