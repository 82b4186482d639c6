"""References checked load by load: what a new load cannot have changed is not looked at again.

Kept under a path, each load in its own folder: the parent's keys, their bitmap, and the
orphans that are left. A load counts its references, adds the orphans of before, and looks
both up in the bitmap. Whole numbers have a bit of their own, in blocks of 32,768 numbers, so
the bitmap alone decides. Other keys share bits by hash, in a bitmap of fixed size: a key
without its bit is an orphan, and only those with one are compared with the parent's keys.
A load writes no more than its own keys and the orphans that are left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.config.warehouse import ForeignKey
from lexweave.functions.types import quoted
from lexweave.operators.skew import spread_join
from lexweave.sources.files import complete

BLOCK = 32_768  # bits of one bitmap that Spark's functions make: 4 KB
HASHED_BLOCKS = 256  # so the bitmap of hashed keys has 1 MB at most, which is why it is broadcast


class References:
    """The orphans of one foreign key under ``path``, kept up with each load of both tables."""

    def __init__(self, path: str, key: ForeignKey) -> None:
        self.path, self.key = path, key
        self.columns = list(key.columns)

    def loads(self, spark: SparkSession) -> list[int]:
        """Numbers of the loads that are done, in order."""
        return sorted(int(p.rpartition("=")[2]) for p in complete(spark, f"{self.path}/open/load=*"))

    def load(self, child: DataFrame, parent: DataFrame, number: int | None = None) -> None:
        """Take new rows of both tables in; a number that is done already changes nothing.

        Rows with a null part of the key refer to nothing. Parents come and never go.
        """
        spark = child.sparkSession
        done = self.loads(spark)
        number = (done[-1] + 1 if done else 0) if number is None else number
        if number in done:
            return
        if done and number < done[-1]:
            raise ValueError(f"load {number} comes after load {done[-1]}")
        renamed = [quoted(p).alias(c) for c, p in zip(self.columns, self.key.parent_columns, strict=True)]
        kinds = {c: _kind(child, c, parent, p) for c, p in zip(self.columns, self.key.parent_columns, strict=True)}
        typed = [quoted(c).cast(k).alias(c) for c, k in kinds.items()]
        keys = parent.select(*renamed).select(*typed).dropna().distinct()
        keys.write.mode("overwrite").parquet(self._folder("parents", number))
        written = spark.read.parquet(self._folder("parents", number))
        exact = list(kinds.values()) == [T.LongType()]
        block, position = self._place(exact)
        bits = written.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(position).alias("bits"))
        bits.write.mode("overwrite").parquet(self._folder("bits", number))

        rows = child.select(*typed).dropna().groupBy(*map(quoted, self.columns))
        open_now = rows.agg(F.count(F.lit(1)).alias("n_rows"))
        if done:
            before = spark.read.parquet(self._folder("open", done[-1]))
            both = open_now.unionByName(before).groupBy(*map(quoted, self.columns))
            open_now = both.agg(F.sum("n_rows").alias("n_rows"))
        self._missing(open_now, [*done, number], exact).write.mode("overwrite").parquet(self._folder("open", number))

    def orphans(self, spark: SparkSession) -> DataFrame:
        """Referenced values that no load's parents have, with the rows that refer to them."""
        return spark.read.parquet(self._folder("open", self.loads(spark)[-1]))

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/load={number}"

    def _all(self, spark: SparkSession, kind: str, numbers: Sequence[int]) -> DataFrame:
        return spark.read.parquet(*[self._folder(kind, n) for n in numbers])

    def _place(self, exact: bool) -> tuple[Column, Column]:
        """Block and bit of a key."""
        columns = [quoted(c) for c in self.columns]
        number = columns[0] if exact else F.pmod(F.xxhash64(*columns), F.lit(BLOCK * HASHED_BLOCKS))
        return F.shiftright(number, BLOCK.bit_length() - 1), F.pmod(number, F.lit(BLOCK))

    def _missing(self, refs: DataFrame, numbers: Sequence[int], exact: bool) -> DataFrame:
        spark = refs.sparkSession
        bits = self._all(spark, "bits", numbers).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        block, position = self._place(exact)
        placed = refs.withColumns({"_block": block, "_bit": position})
        right = bits.withColumnRenamed("block", "_of")
        met = placed.join(right if exact else F.broadcast(right), F.col("_block") == F.col("_of"), "left")
        # The byte that holds the bit, as a number, shifted until the bit is the last.
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        shifted = F.call_function("shiftright", byte, F.pmod("_bit", F.lit(8)).cast("int"))
        is_set = F.coalesce(shifted.bitwiseAND(F.lit(1)) == 1, F.lit(False))
        flagged = met.withColumn("_set", is_set).drop("_block", "_bit", "_of", "bits")
        missing = flagged.where(~F.col("_set")).drop("_set")
        if exact:
            return missing
        maybe = flagged.where("_set").drop("_set")
        parents = self._all(spark, "parents", numbers)
        # References are counted and few beside the parents: those found are collected on their side.
        found = parents.join(maybe.select(*map(quoted, self.columns)), self.columns, "left_semi").distinct()
        return missing.unionByName(spread_join(maybe, found, self.columns, "left_anti"))


def _kind(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> T.DataType:
    """The one type in which both sides are kept: equal values must have equal bits."""
    kinds = [child.schema[column].dataType, parent.schema[parent_column].dataType]
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    if kinds[0] != kinds[1]:
        raise TypeError(f"{column} is {kinds[0].simpleString()}, but {kinds[1].simpleString()} in the table it refers to")
    return kinds[0]
