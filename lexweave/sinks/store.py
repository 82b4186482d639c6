"""Stores that grow by deltas, are merged when read, and compacted apart from both.

A load writes its own rows only, under ``deltas/load=…``, so its cost follows the batch and
not the store. ``compact`` merges the deltas of those key buckets where they have outgrown
the rest and writes these buckets anew under ``base/run=…``; all others stay. Reading takes
the last written files of every bucket and the deltas after them.

A folder counts once its job has committed (it then holds ``_SUCCESS``) and is never written
again, so readers see a load or a compaction whole or not at all. One writer at a time:
loads are numbered as they begin, and a compaction beside the writer takes those that are
complete. ``vacuum`` removes what nothing reads any more.

Two kinds of store share this. An upsert store keeps the last row of each key by its order
columns, then by load. A section store keeps, for each group, the rows of the last load that
refreshed it. Rows of an upsert store may be tombstones: they take part like others, so that
an older row of the key that comes late stays hidden, and compaction forgets them after a
time to live.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.functions.types import quoted
from lexweave.operators.latest import latest_per_key
from lexweave.operators.skew import spread_join
from lexweave.sources.files import complete, listed, read_if_present, read_merged, remove

BUCKET, LOAD, STATE = "key_bucket", "_load", "_state"
ROW, GONE, MARK = "row", "gone", "mark"
RUN_PARTS = ("run", "upto", "buckets", "whole")
OUTGROWN = 0.2  # rows of deltas per stored row of a bucket from which on it is written anew


@dataclass(frozen=True)
class Layout:
    """What a store keeps beside its data, under ``{path}-layout``."""

    buckets: int
    keys: list[str]
    order: list[str]
    partition_by: list[str]
    sections: bool
    types: dict  # of the partition columns, which folders' names don't tell

    @property
    def columns(self) -> list[str]:
        return [*self.partition_by, BUCKET]

    @property
    def partition_fields(self) -> list[T.StructField]:
        return list(T.StructType.fromJson(self.types).fields)

    def bucketed(self, df: DataFrame) -> DataFrame:
        hashed = [k for k in self.keys if k not in self.partition_by] if self.sections else self.keys
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*map(quoted, hashed)), F.lit(self.buckets)))


@dataclass(frozen=True)
class Run:
    """A written compaction: its files hold everything up to a load, for the buckets they name."""

    number: int
    upto: int
    buckets: int
    whole: bool
    path: str

    @staticmethod
    def of(path: str) -> Run:
        values = [int(part.partition("=")[2]) for part in path.split("/")[-len(RUN_PARTS) :]]
        return Run(values[0], values[1], values[2], bool(values[3]), path)


def loads(spark: SparkSession, path: str) -> list[str]:
    return complete(spark, f"{path}/deltas/load=*")


def load_number(folder: str) -> int:
    return int(folder.rpartition("=")[2])


def runs(spark: SparkSession, path: str) -> list[Run]:
    """Compactions that still count, the last first: those since the store was last written whole."""
    found = complete(spark, f"{path}/base/" + "/".join(f"{p}=*" for p in RUN_PARTS))
    newest = sorted(map(Run.of, found), key=lambda r: -r.number)
    whole = next((i for i, r in enumerate(newest) if r.whole), len(newest))
    return newest[: whole + 1]


def keep_layout(spark: SparkSession, path: str, layout: Layout) -> None:
    """Record a store's layout; a load that contradicts it is refused."""
    known = read_layout(spark, path)
    if known is None:
        text = F.lit(json.dumps(layout.__dict__)).alias("layout")
        spark.range(1).select(text).write.parquet(f"{path.rstrip('/')}-layout")
        return
    if known.buckets != layout.buckets:
        raise ValueError(f"the store at {path} has {known.buckets} buckets, not {layout.buckets}")
    if (known.keys, known.order, known.sections) != (layout.keys, layout.order, layout.sections):
        raise ValueError(f"the store at {path} has other keys or another order")


def read_layout(spark: SparkSession, path: str) -> Layout | None:
    """The recorded layout, with as many buckets as the last compaction made."""
    schema = T.StructType.fromDDL("layout string")
    found = read_if_present(spark, f"{path.rstrip('/')}-layout", schema)
    if found is None:
        return None
    layout = json.loads(found.first()["layout"])
    live = runs(spark, path)
    return Layout(**(layout | {"buckets": live[0].buckets} if live else layout))


def next_load(spark: SparkSession, path: str) -> int:
    """A number above those of all loads: microseconds, unless a clock went back."""
    return max([time.time_ns() // 1000, *[load_number(p) + 1 for p in loads(spark, path)]])


def append_delta(rows: DataFrame, path: str, load: int | None = None) -> int:
    """Write one load's rows, which have ``STATE``; a load written again replaces itself."""
    number = next_load(rows.sparkSession, path) if load is None else load
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{path}/deltas/load={number:020d}")
    return number


def upsert(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str],
    buckets: int = 64,
    schema: T.StructType | None = None,
    gone: Column | None = None,
    load: int | None = None,
) -> None:
    """Keyed upsert, last write wins by ``order``, then by load; writes the batch's keys only.

    Rows for which ``gone`` holds are tombstones: from their place in the order on the key is
    not there. ``schema`` is of use to readers, who may declare it.
    """
    outside = [c for c in partition_by if c not in keys]
    if outside:
        raise ValueError(f"partition columns {outside} must be part of the key")
    _keep(incoming, path, keys, order, partition_by, buckets, sections=False)
    state = F.lit(ROW) if gone is None else F.when(gone, GONE).otherwise(ROW)
    append_delta(latest_per_key(incoming.withColumn(STATE, state), keys, order), path, load)


def replace_sections(
    incoming: DataFrame,
    path: str,
    group: Sequence[str],
    refreshed: DataFrame,
    partition_by: Sequence[str],
    buckets: int = 64,
    schema: T.StructType | None = None,
    load: int | None = None,
) -> None:
    """Replace the items of every refreshed group, also where none is left.

    ``refreshed`` has the partition columns and the group columns, none of them null; groups of
    different partitions are different groups. A group that ``incoming`` holds is refreshed too.
    Each group leaves a mark in the load, by which readers know that its older rows are void.
    """
    keys = [*partition_by, *group]
    _keep(incoming, path, keys, [], partition_by, buckets, sections=True)
    columns = [quoted(k) for k in keys]
    groups = refreshed.select(*columns).unionByName(incoming.select(*columns)).distinct()
    marks = groups.withColumn(STATE, F.lit(MARK))
    rows = incoming.withColumn(STATE, F.lit(ROW))
    append_delta(rows.unionByName(marks, allowMissingColumns=True), path, load)


def _keep(
    df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition_by: Sequence[str],
    buckets: int, sections: bool,
) -> None:
    if not all(isinstance(c, str) for c in order):
        raise TypeError("a store's order is kept beside it: name columns, not expressions")
    types = T.StructType([df.schema[c] for c in partition_by]).jsonValue()
    layout = Layout(buckets, list(keys), list(order), list(partition_by), sections, types)
    keep_layout(df.sparkSession, path, layout)


@dataclass(frozen=True)
class View:
    """One consistent state of a store: the files of every bucket and the loads after them.

    ``base`` and ``fresh`` have the data columns, ``STATE``, ``LOAD`` and ``BUCKET``; either
    may be missing.
    """

    layout: Layout
    base: DataFrame | None
    fresh: DataFrame | None
    last_load: int

    def merged(self) -> DataFrame:
        """Current rows with ``STATE``, tombstones included."""
        base, fresh = self.base, self.fresh
        stored = None if base is None else base.where(F.col(STATE) != MARK)
        if fresh is None:
            return stored
        return self._sections(stored, fresh) if self.layout.sections else self._rows(stored, fresh)

    def _rows(self, stored: DataFrame | None, fresh: DataFrame) -> DataFrame:
        """Stored rows whose key no delta has go through as they are, the others meet the deltas."""
        keys, order = self.layout.keys, [*self.layout.order, LOAD]
        newest = latest_per_key(fresh, keys, order)
        if stored is None:
            return newest
        asked = newest.select(*[quoted(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_asked"))
        same = [quoted(k).eqNullSafe(F.col(f"`_k_{k}`")) for k in keys]
        flagged = stored.join(asked, same, "left")
        met = flagged.where("_asked").select(*map(quoted, stored.columns))
        again = latest_per_key(met.unionByName(newest, allowMissingColumns=True), keys, order)
        kept = flagged.where("_asked IS NULL").select(*map(quoted, stored.columns))
        return kept.unionByName(again, allowMissingColumns=True)

    def _sections(self, stored: DataFrame | None, fresh: DataFrame) -> DataFrame:
        keys = self.layout.keys
        last = fresh.where(F.col(STATE) == MARK).groupBy(*map(quoted, keys)).agg(F.max(LOAD).alias(LOAD))
        rows = spread_join(fresh.where(F.col(STATE) == ROW), last, [*keys, LOAD], "inner")
        if stored is None:
            return rows
        kept = spread_join(stored, last.drop(LOAD), keys, "left_anti")
        return kept.unionByName(rows, allowMissingColumns=True)

    def only(self, partitions: list[T.Row]) -> View:
        """The same within some partitions, which are literals in the scan's filter."""
        parts = [None if df is None else within(df, partitions, self.layout.columns) for df in (self.base, self.fresh)]
        return View(self.layout, parts[0], parts[1], self.last_load)


def within(df: DataFrame, partitions: list[T.Row], columns: Sequence[str]) -> DataFrame:
    """Rows of the listed partitions; others are not listed or read."""
    for name in columns:
        seen = {r[name] for r in partitions}
        known = quoted(name).isin(sorted(v for v in seen if v is not None))
        df = df.where(known | quoted(name).isNull() if None in seen else known)
    renamed = T.StructType([T.StructField(f"_p_{c}", df.schema[c].dataType) for c in columns])
    listed_ = df.sparkSession.createDataFrame([tuple(r[c] for c in columns) for r in partitions], renamed)
    same = [quoted(c).eqNullSafe(F.col(f"`_p_{c}`")) for c in columns]
    return df.join(listed_, same, "left_semi")


def view(spark: SparkSession, path: str, schema: T.StructType | None = None) -> View | None:
    """The state of a store as it is now, or nothing before the first load."""
    layout = read_layout(spark, path)
    if layout is None:
        return None
    live, deltas = runs(spark, path), loads(spark, path)
    base = _read_base(spark, path, layout, live, schema)
    last = max([r.upto for r in live] + [load_number(p) for p in deltas], default=0)
    fresh = _read_deltas(spark, path, layout, deltas, schema) if deltas else None
    if base is not None:
        if fresh is not None:
            # One row per partition: everything up to its load is in the base.
            seen = base.select(*[quoted(c).alias(f"_s_{c}") for c in layout.columns], "upto").distinct()
            same = [quoted(c).eqNullSafe(F.col(f"`_s_{c}`")) for c in layout.columns]
            known = fresh.join(seen, same, "left").where("upto IS NULL OR _load > upto")
            fresh = known.select(*map(quoted, fresh.columns))
        base = base.drop(*RUN_PARTS)
    return View(layout, base, fresh, last) if base is not None or fresh is not None else None


def _read_base(
    spark: SparkSession, path: str, layout: Layout, live: list[Run], schema: T.StructType | None
) -> DataFrame | None:
    """The last files of every bucket."""
    chosen: dict[str, str] = {}
    for run in live:
        levels = "*/" * len(layout.partition_by)
        for folder in listed(spark, f"{run.path}/{levels}{BUCKET}=*"):
            chosen.setdefault(folder[folder.index("/", folder.index("/whole=") + 1) :], folder)
    if not chosen:
        return None
    added = [T.StructField(STATE, T.StringType()), T.StructField(LOAD, T.LongType())]
    parts = [T.StructField(p, T.LongType()) for p in (*RUN_PARTS, BUCKET)]
    reader = spark.read.option("basePath", f"{path}/base")
    if schema is None:
        found = reader.option("mergeSchema", "true").parquet(*chosen.values()).schema
        typed = {f.name: f for f in [*layout.partition_fields, *parts]}
        whole = T.StructType([typed.get(f.name, f) for f in found.fields])
    else:
        whole = T.StructType([*schema.fields, *added, *parts])
    return reader.schema(whole).parquet(*chosen.values())


def _read_deltas(
    spark: SparkSession, path: str, layout: Layout, folders: list[str], schema: T.StructType | None
) -> DataFrame:
    reader = spark.read.option("basePath", f"{path}/deltas")
    if schema is None:
        found = reader.option("mergeSchema", "true").parquet(*folders)
    else:
        added = [T.StructField(STATE, T.StringType()), T.StructField("load", T.LongType())]
        found = reader.schema(T.StructType([*schema.fields, *added])).parquet(*folders)
    # Loads after the first are numbered above it, which leaves room for files that carry no state.
    return layout.bucketed(found.withColumn(LOAD, F.col("load").cast("bigint")).drop("load"))


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current state of an ``upsert`` or ``replace_sections`` store.

    Without ``schema`` the files' footers are read to merge their columns.
    """
    now = view(spark, path, schema)
    if now is None:
        raise ValueError(f"no store at {path}")
    return now.merged().where(F.col(STATE) == ROW).drop(STATE, LOAD, BUCKET)


def read_versions(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The last version of every key of an upsert store, tombstones included, with ``is_gone``."""
    now = view(spark, path, schema)
    if now is None:
        return None
    return now.merged().withColumn("is_gone", F.col(STATE) == GONE).drop(STATE, LOAD, BUCKET)


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    outgrown: float = OUTGROWN,
    buckets: int | None = None,
    keep_gone: int | None = None,
) -> int:
    """Merge the deltas of buckets that they have outgrown; returns how many were written.

    ``buckets`` deals the whole store to another number of buckets. ``keep_gone`` is how many
    microseconds tombstones outlive the last load; by default they are kept for good.
    """
    now = view(spark, path, schema)
    if now is None:
        return 0
    layout, whole = now.layout, buckets is not None and buckets != now.layout.buckets
    if whole:
        layout = Layout(**(layout.__dict__ | {"buckets": buckets}))
        parts = [None if df is None else layout.bucketed(df.drop(BUCKET)) for df in (now.base, now.fresh)]
        now = View(layout, parts[0], parts[1], now.last_load)
    partitions = _outgrown(now, -1.0 if whole else outgrown)
    if not partitions:
        return 0
    rows = (now if whole else now.only(partitions)).merged()
    if keep_gone is not None:
        rows = rows.where((F.col(STATE) != GONE) | (F.col(LOAD) >= now.last_load - keep_gone))
    write_base(rows, path, layout, partitions, now.last_load, whole)
    return len(partitions)


def _outgrown(now: View, share: float) -> list[T.Row]:
    """Partitions with more delta rows than this share of the stored ones: one row each, as the files are."""
    columns = [quoted(c) for c in now.layout.columns]
    parts = [(now.base, 1, 0), (now.fresh, 0, 1)]
    counts = [
        df.groupBy(*columns).agg((F.count(F.lit(1)) * old).alias("old"), (F.count(F.lit(1)) * new).alias("new"))
        for df, old, new in parts if df is not None
    ]
    both = counts[0] if len(counts) == 1 else counts[0].unionByName(counts[1])
    sums = both.groupBy(*columns).agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    return sums.where(F.col("new") > share * F.col("old")).select(*columns).collect()


def write_base(
    rows: DataFrame, path: str, layout: Layout, partitions: list[T.Row] | None, upto: int, whole: bool
) -> None:
    """Write the rows of some partitions (all if ``None``) as a run of their own.

    A partition left without rows still replaces its former files, by a mark.
    """
    spark = rows.sparkSession
    number = max([Run.of(p).number for p in listed(spark, f"{path}/base/" + "/".join(f"{p}=*" for p in RUN_PARTS))], default=0) + 1
    if partitions is not None:
        kinds = T.StructType([rows.schema[c] for c in layout.columns])
        marks = spark.createDataFrame([tuple(r) for r in partitions], kinds)
        marks = marks.withColumns({STATE: F.lit(MARK), LOAD: F.lit(upto).cast("bigint")})
        rows = rows.unionByName(marks, allowMissingColumns=True)
    out = f"{path}/base/run={number}/upto={upto}/buckets={layout.buckets}/whole={int(whole)}"
    rows.hint("rebalance", *layout.columns).write.mode("overwrite").partitionBy(*layout.columns).parquet(out)


def vacuum(spark: SparkSession, path: str, schema: T.StructType | None = None) -> int:
    """Remove loads and compactions that no reader needs any more; returns how many folders went.

    Readers that began before the last compaction may still be at work: call it when they are done.
    """
    now = view(spark, path, schema)
    live = runs(spark, path)
    if now is None or not live:
        return 0
    fresh = set() if now.fresh is None else {r[0] for r in now.fresh.select(LOAD).distinct().collect()}
    upto = max(r.upto for r in live)
    old = [p for p in loads(spark, path) if load_number(p) <= upto and load_number(p) not in fresh]
    counted = {r.path for r in live}
    old += [p for p in complete(spark, f"{path}/base/" + "/".join(f"{p}=*" for p in RUN_PARTS)) if p not in counted]
    for folder in old:
        remove(spark, folder)
    return len(old)


def rebuild(
    spark: SparkSession,
    log_path: str,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str],
    buckets: int = 64,
) -> None:
    """Make the current state again from the whole log."""
    log = read_merged(spark, log_path).drop("run", "batch_id")
    _keep(log, path, keys, order, partition_by, buckets, sections=False)
    _write_whole(latest_per_key(log, keys, order), path)


def rebuild_sections(
    spark: SparkSession,
    log_path: str,
    refreshed_path: str,
    path: str,
    group: Sequence[str],
    partition_by: Sequence[str],
    buckets: int = 64,
) -> None:
    """Make a section store again: each group's rows are those of its last refresh.

    Both logs carry ``load_id``, which grows over all runs.
    """
    keys = [*partition_by, *group]
    log = read_merged(spark, log_path).drop("run", "batch_id")
    _keep(log, path, keys, [], partition_by, buckets, sections=True)
    last = read_merged(spark, refreshed_path).groupBy(*keys).agg(F.max("load_id").alias("load_id"))
    _write_whole(spread_join(log, last, [*keys, "load_id"], "inner"), path)


def _write_whole(rows: DataFrame, path: str) -> None:
    spark = rows.sparkSession
    layout = read_layout(spark, path)
    upto = max((load_number(p) for p in loads(spark, path)), default=0)
    added = {STATE: F.lit(ROW), LOAD: F.lit(upto).cast("bigint")}
    write_base(layout.bucketed(rows.withColumns(added)), path, layout, None, upto, True)
