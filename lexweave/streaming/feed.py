"""The change feed: micro-batches of events into the raw store.

Each batch is written under its run and id, and a batch that runs again replaces
what it wrote, so a restart neither loses nor repeats rows. A new checkpoint starts
a new run beside the former ones; loads are ordered by the time they were made.

The last event of every record is kept too, by event time, so events may arrive in any
order. A collection item whose last event deletes it is not there, whatever a reload that
came with an older event still holds of it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from lexweave.operators.phases import PROJECT, current_phase
from lexweave.operators.skew import spread_join
from lexweave.sinks.tables import append_batch, compact, read_current, read_versions, replace_sections, upsert
from lexweave.streaming.events import (
    normalise,
    phase_log,
    route_leads,
    routed,
    subscribed,
    with_project_type,
)

Loader = Callable[[SparkSession, DataFrame], DataFrame]

PARTITIONS = ["org_id"]
ALL_NOW = {"availableNow": True}
RECORD = ["org_id", "entity", "project_id", "section", "item_id"]
ITEM = ["org_id", "project_id", "section"]


def run_of(batch: DataFrame) -> str:
    """The run a batch belongs to: its query, which a checkpoint keeps over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"


EVENT_FIELDS = T.StructType([
    T.StructField("org_id", T.LongType()),
    T.StructField("entity", T.StringType()),
    T.StructField("project_id", T.LongType()),
    T.StructField("section", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("project_type_id", T.LongType()),
])


@dataclass
class CaseFeed:
    """Applies case-system events under ``root``.

    ``loaders`` give the landed, flattened records of a route (``project``,
    ``form`` or ``collections``) for the batch's keys, which are their second argument
    (``org_id``, ``project_id``, ``section``), and should read no more than those. Records
    have these columns and their own ``project_type_id``: the type that is stored is the
    record's, whatever the event says or leaves out. Collections also have ``id``.
    ``schemas`` may declare a route's stored columns, ``event_timestamp`` and ``load_id``
    included. ``log`` and ``refreshed`` keep every load, to rebuild ``current``; ``events``
    keeps the last event of each record. ``projects`` gives the type of projects whose
    phase events come without one.
    """

    root: str
    loaders: dict[str, Loader] = field(default_factory=dict)
    schemas: dict[str, T.StructType] = field(default_factory=dict)
    buckets: int = 64
    projects: Callable[[SparkSession], DataFrame] | None = None

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        normal = normalise(subscribed(batch))
        if self.projects is not None:
            normal = with_project_type(normal, self.projects(batch.sparkSession))
        # Several writes read the batch; the event's whole text is not kept for them.
        events = routed(normal).drop("webhook_body").persist()
        run = run_of(batch)
        try:
            phases = phase_log(events)
            append_batch(phases, f"{self.root}/phases", batch_id, run)
            self._remember(events)
            for name, loader in self.loaders.items():
                self._refresh(name, loader, events, batch_id, run)
        finally:
            events.unpersist()

    def _remember(self, events: DataFrame) -> None:
        """Keep each record's last event by event time; deletes are tombstones.

        What decides is stored, so it needs no state of the stream and no bound on lateness.
        """
        last = events.select(*RECORD, "event_timestamp", "event_name", "project_type_id")
        gone = F.col("event_name") == "Deleted"
        order = ["event_timestamp", "event_name"]
        upsert(last, f"{self.root}/events", RECORD, order, PARTITIONS, self.buckets, EVENT_FIELDS, gone)

    def last_events(self, spark: SparkSession) -> DataFrame:
        """The last event of every record, with ``is_gone`` for deletes."""
        return read_versions(spark, f"{self.root}/events", EVENT_FIELDS)

    def items(self, spark: SparkSession) -> DataFrame:
        """Current collection items without those that were deleted."""
        schema = self.schemas.get("collections")
        current = read_current(spark, f"{self.root}/collections/current", schema)
        gone = self.last_events(spark).where(F.col("is_gone") & (F.col("entity") == "CollectionItem"))
        keyed = current.withColumn("item_id", F.col("id").cast("string"))
        return spread_join(keyed, gone.select(*ITEM, "item_id"), [*ITEM, "item_id"], "left_anti").drop("item_id")

    def compact(self, spark: SparkSession, keep_gone: int | None = None) -> int:
        """Compact all stores of the feed, beside the stream; tombstones stay for ``keep_gone`` microseconds."""
        done = compact(spark, f"{self.root}/events", EVENT_FIELDS, keep_gone=keep_gone)
        for name in self.loaders:
            done += compact(spark, f"{self.root}/{name}/current", self.schemas.get(name))
        return done

    def _refresh(
        self, name: str, loader: Loader, events: DataFrame, batch_id: int, run: str
    ) -> None:
        """Load the records again that this batch's events name."""
        spark = events.sparkSession
        named = events.where(F.col("route") == name)
        keys = ["org_id", "project_id", "section"]
        asked = named.groupBy(*keys).agg(F.max("event_timestamp").alias("event_timestamp"))
        records = loader(spark, asked.select(*keys))
        # A refresh reads the record as it is now: the later load is the newer
        # state, also when a late event asked for it.
        load = F.lit(time.time_ns() // 1000).cast("bigint").alias("load_id")
        fresh = spread_join(records, asked, keys, "inner").withColumn("load_id", load)
        # Written first and read back: the store then reads the batch's rows as
        # files instead of running the join again.
        written = append_batch(fresh, f"{self.root}/{name}/log", batch_id, run)
        landed = spark.read.parquet(written)
        current = f"{self.root}/{name}/current"
        if name == "collections":
            refreshed = asked.select(*keys, load)
            append_batch(refreshed, f"{self.root}/{name}/refreshed", batch_id, run)
            replace_sections(
                landed, current, ["project_id", "section"], refreshed, PARTITIONS, self.buckets,
                self.schemas.get(name),
            )
        else:
            upsert(landed, current, keys, ["load_id"], PARTITIONS, self.buckets, self.schemas.get(name))

    def start(self, events: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        writer = events.writeStream.option("checkpointLocation", checkpoint)
        return writer.foreachBatch(self.apply).trigger(**(trigger or ALL_NOW)).start()


@dataclass
class LeadFeed:
    """Applies lead-system events under ``root``; unknown types are kept apart.

    ``loaders`` give the landed, flattened records of ``leaddetail``, ``contact`` or
    ``opportunities`` with their ``Id`` for the batch's ids, their second argument; what an
    event names is loaded again and upserted by id, the later load winning.
    """

    root: str
    loaders: dict[str, Loader] = field(default_factory=dict)
    buckets: int = 64

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        events = route_leads(batch).persist()
        run = run_of(batch)
        try:
            known = events.where(F.col("entity") != "quarantine")
            ids = known.select("entity", "record_id").distinct()
            append_batch(ids, f"{self.root}/refresh", batch_id, run)
            unknown = events.where(F.col("entity") == "quarantine").select(*batch.columns)
            append_batch(unknown, f"{self.root}/quarantine", batch_id, run)
            for name, loader in self.loaders.items():
                self._refresh(name, loader, ids.where(F.col("entity") == name), batch_id, run)
        finally:
            events.unpersist()

    def _refresh(self, name: str, loader: Loader, ids: DataFrame, batch_id: int, run: str) -> None:
        spark = ids.sparkSession
        asked = ids.select(F.col("record_id").alias("Id")).dropna()
        records = loader(spark, asked)
        load = F.lit(time.time_ns() // 1000).cast("bigint")
        fresh = records.join(asked, "Id", "left_semi").withColumn("load_id", load)
        landed = spark.read.parquet(append_batch(fresh, f"{self.root}/{name}/log", batch_id, run))
        upsert(landed, f"{self.root}/{name}/current", ["Id"], ["load_id"], [], self.buckets)

    def start(self, events: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        writer = events.writeStream.option("checkpointLocation", checkpoint)
        return writer.foreachBatch(self.apply).trigger(**(trigger or ALL_NOW)).start()


def stream_phases(
    events: DataFrame, path: str, checkpoint: str, lateness: str | None = None, **trigger: object
) -> StreamingQuery:
    """Append phase changes as they come; read them with ``read_phase_log``."""
    log = phase_log(normalise(subscribed(events)), lateness)
    writer = log.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    return writer.format("parquet").trigger(**(trigger or ALL_NOW)).start(path)


def stream_current_phase(
    events: DataFrame, path: str, checkpoint: str, **trigger: object
) -> StreamingQuery:
    """Current phase of each project; a batch writes the projects it changes."""
    changes = normalise(subscribed(events)).where(F.col("event_name") == "PhaseChanged")
    state = current_phase(changes.withColumnRenamed("event_timestamp", "event_ts"))

    def apply(batch: DataFrame, _: int) -> None:
        upsert(batch, path, PROJECT, ["since_ts", "current_phase"], ["org_id"])

    writer = state.writeStream.option("checkpointLocation", checkpoint).outputMode("update")
    return writer.foreachBatch(apply).trigger(**(trigger or ALL_NOW)).start()
