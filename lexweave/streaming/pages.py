"""Landed pages as a stream: records appear once every page of their pull has landed.

A pull fetches all pages of something (the leads of a status, the projects of a tenant) and
lands them one by one. Pages are kept as they come, in any order and over any number of
batches; when a pull has all of its pages, its records replace those of the pull before. An
older pull that is completed late replaces nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lexweave.functions.types import quoted
from lexweave.operators.skew import spread_join
from lexweave.sinks.store import compact, read_current, replace_sections, upsert
from lexweave.streaming.feed import ALL_NOW


def numbered_pages(pages: DataFrame, of: Sequence[str]) -> DataFrame:
    """``{Records, TotalPages}`` pages with ``page`` from 1, in the shape that ``PageFeed`` takes."""
    return pages.select(
        *map(quoted, of), F.col("pull").cast("bigint"), F.col("page").cast("bigint"),
        F.col("TotalPages").cast("bigint").alias("pages"), F.col("Records").alias("records"),
    )


def offset_pages(pages: DataFrame, of: Sequence[str]) -> DataFrame:
    """``{items, hasMore, offset, limit}`` pages likewise: the one without more is the last."""
    page = (F.floor(F.col("offset") / F.col("limit")) + 1).cast("bigint")
    return pages.select(
        *map(quoted, of), F.col("pull").cast("bigint"), page.alias("page"),
        F.when(~F.col("hasMore"), page).alias("pages"), F.col("items").alias("records"),
    )


@dataclass
class PageFeed:
    """Applies pages under ``root``; ``of`` names what a pull fetches, none of it null.

    Batches have ``of``, ``pull`` (later pulls are greater), ``page``, ``pages`` (how many the
    pull has, null where the page does not tell) and ``records`` (null counts as empty).
    """

    root: str
    of: Sequence[str]
    buckets: int = 64

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        spark, of, pull = batch.sparkSession, list(self.of), [*self.of, "pull"]
        upsert(batch, f"{self.root}/pages", [*pull, "page"], ["pages"], [], self.buckets)
        named = batch.select(*map(quoted, pull)).distinct()
        held = read_current(spark, f"{self.root}/pages").join(named, pull, "left_semi")
        whole = held.groupBy(*map(quoted, pull)).agg(F.count(F.lit(1)).alias("n"), F.max("pages").alias("pages"))
        newest = whole.where("n >= pages").groupBy(*map(quoted, of)).agg(F.max("pull").alias("pull"))
        if newest.isEmpty():
            return
        # The last complete pull of each; one that an earlier batch knows to be newer stays.
        upsert(newest, f"{self.root}/pulls", of, ["pull"], [], self.buckets)
        taken = newest.join(read_current(spark, f"{self.root}/pulls"), pull, "left_semi")
        rows = spread_join(held, taken, pull, "left_semi").select(*map(quoted, pull), F.explode("records").alias("record"))
        replace_sections(rows, f"{self.root}/records", of, taken, [], self.buckets)

    def start(self, pages: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        writer = pages.writeStream.option("checkpointLocation", checkpoint)
        return writer.foreachBatch(self.apply).trigger(**(trigger or ALL_NOW)).start()

    def records(self, spark: SparkSession) -> DataFrame:
        """Records of the last complete pulls, with what they are of."""
        current = read_current(spark, f"{self.root}/records")
        return current.select(*map(quoted, self.of), "record.*")

    def compact(self, spark: SparkSession) -> int:
        return sum(compact(spark, f"{self.root}/{name}") for name in ("pages", "pulls", "records"))
