"""Writers for logs, whole tables, the standard model and the warehouse.

A feed's store keeps per entity ``log``, every load as it came, and ``current``, the latest
state (``sinks.store``). The log is complete, so ``rebuild`` and ``rebuild_sections`` can make
the state again. A record's project type is a column like others, so a record that changes
its type, or an event without one, stays in its partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.config.warehouse import WarehouseTable
from lexweave.operators.checks import conform, rejected
from lexweave.sinks.store import (
    compact,
    read_current,
    read_versions,
    rebuild,
    rebuild_sections,
    replace_sections,
    upsert,
    vacuum,
)

__all__ = [
    "append_batch", "batch_path", "compact", "export", "jdbc_load", "read_current", "read_phase_log", "read_versions", "rebuild",
    "rebuild_sections", "replace_sections", "upsert", "vacuum", "warehouse_load", "warehouse_write",
    "write_entity", "write_partitioned", "write_table",
]


def write_table(df: DataFrame, root: str, name: str) -> str:
    """Overwrite a table under its lower-cased name."""
    path = f"{root}/{name.lower()}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_entity(df: DataFrame, path: str) -> None:
    """Overwrite a whole-table entity (contacts, project types, lookups)."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Keep what used to be path parts as partition columns; other partitions stay."""
    _write_partitions(df, path, columns)


def batch_path(path: str, batch_id: int, run: str) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def append_batch(df: DataFrame, path: str, batch_id: int, run: str = "0") -> str:
    """Append one batch of a run. The same batch written again replaces itself.

    Batch numbers start anew with a new checkpoint, so each run has its own folder.
    """
    out = batch_path(path, batch_id, run)
    df.write.mode("overwrite").parquet(out)
    return out


def export(df: DataFrame, path: str, files: int | None = None) -> None:
    """Files for use elsewhere: as many as the caller asks for, by default one a task.

    The rows are dealt out anew for that, so the work before it keeps its tasks; only
    the writing of ``files=1`` is a single task.
    """
    (df if files is None else df.repartition(files)).write.mode("overwrite").parquet(path)


def read_phase_log(spark: SparkSession, path: str) -> DataFrame:
    """The phase log, each change once however often its event arrived."""
    log = spark.read.parquet(path)
    keys = ["org_id", "project_type_id", "project_id", "event_ts"]
    return log.groupBy(*keys).agg(F.max("phase").alias("phase"))


def _write_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace the partitions present in ``df``; all others stay.

    Spark stages the new files and moves them when the job commits, so the
    partitions being replaced can be read by the same job.
    """
    (
        df.hint("rebalance", *columns).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    )


def warehouse_write(
    df: DataFrame,
    name: str,
    path: str,
    distribute_by: str | None = None,
    sort_by: Sequence[str] = (),
    buckets: int = 64,
) -> None:
    """Create or replace a saved table, bucketed on its distribution key."""
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    if distribute_by:
        writer = writer.bucketBy(buckets, distribute_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)


def warehouse_load(
    df: DataFrame,
    table: WarehouseTable,
    staging: str,
    path: str,
    renames: dict[str, str] | None = None,
) -> None:
    """Stage rows as files in the declared shape, then load the table from them.

    Rows with a value that its column cannot hold are loaded with a null there, as
    the declaration asks, and kept whole beside the table, under ``{path}-rejected``.
    """
    rejected(df, table, renames).write.mode("overwrite").parquet(f"{path}-rejected")
    conform(df, table, renames).write.mode("overwrite").parquet(staging)
    warehouse_write(df.sparkSession.read.parquet(staging), table.name.lower(), path)


def jdbc_load(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 32
) -> None:
    """Load over JDBC, for warehouses reached by URL, over that many connections."""
    writer = df.write.mode("append").option("numPartitions", connections)
    writer.jdbc(url, table, properties=properties)
