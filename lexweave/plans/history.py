"""Phase history kept up with each load of changes, late ones included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.operators.phases import PROJECT, phase_history
from lexweave.sinks.store import compact, next_load, read_current, upsert, view

CHANGE = [*PROJECT, "event_ts", "phase"]
LINKS = ["previous_phase", "next_ts", "days_in_phase", "is_current"]


class PhaseHistory:
    """The history under ``path``: what ``phase_history`` gives over all loads so far.

    A change has its own row, so a load writes its new changes and the rows whose neighbour
    it became: the change before each now ends earlier, the one after follows another phase.
    Only projects that the load names are read for that.
    """

    def __init__(self, path: str, buckets: int = 64) -> None:
        self.path, self.buckets = path, buckets
        self.schema = T.StructType([
            T.StructField("org_id", T.LongType()), T.StructField("project_id", T.LongType()),
            T.StructField("event_ts", T.LongType()), T.StructField("phase", T.StringType()),
            T.StructField("previous_phase", T.StringType()), T.StructField("next_ts", T.LongType()),
            T.StructField("days_in_phase", T.LongType()), T.StructField("is_current", T.BooleanType()),
            T.StructField("load_id", T.LongType()),
        ])

    def load(self, log: DataFrame) -> None:
        """Take changes in; a change that is known already adds nothing."""
        spark = log.sparkSession
        new = log.select(*[F.col(c).cast(self.schema[c].dataType) for c in CHANGE]).distinct()
        if view(spark, self.path, self.schema) is None:
            linked = phase_history(new)
        else:
            named = new.select(*PROJECT).distinct()
            before = self.read(spark).join(named, list(PROJECT), "left_semi").select(*CHANGE, *LINKS)
            changes = before.select(*CHANGE).unionByName(new).distinct()
            linked = phase_history(changes).select(*CHANGE, *LINKS).subtract(before)
        load = next_load(spark, self.path)
        rows = linked.select(*CHANGE, *LINKS, F.lit(load).cast("bigint").alias("load_id"))
        upsert(rows, self.path, CHANGE, ["load_id"], ["org_id"], self.buckets, self.schema, load=load)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_current(spark, self.path, self.schema).drop("load_id")

    def compact(self, spark: SparkSession) -> int:
        return compact(spark, self.path, self.schema)
