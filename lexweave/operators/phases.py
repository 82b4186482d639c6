"""Phase log: current phase, history, and the link to the phase dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY_MILLIS = 86_400_000
HOUR_MILLIS = 3_600_000


PROJECT = ("org_id", "project_id")


def current_phase(log: DataFrame, project: Sequence[str] = PROJECT) -> DataFrame:
    """Last phase of each project by event time, then name."""
    last = F.max(F.struct("event_ts", "phase")).alias("l")
    return log.groupBy(*project).agg(last).select(
        *project, F.col("l.phase").alias("current_phase"), F.col("l.event_ts").alias("since_ts")
    )


def phase_history(
    log: DataFrame, slice_millis: int = HOUR_MILLIS, project: Sequence[str] = PROJECT
) -> DataFrame:
    """Each phase change with the phase before it, the next change and the days between.

    A project's changes are ordered within time slices, and each slice learns
    the last change before it and the first one after it from a summary with
    one row per project and slice. A project with very many changes is spread
    over its slices. ``log`` has one row per project, time and phase.
    """
    part = [*project, "_slice"]
    sliced = log.select(*project, "event_ts", "phase").withColumn(
        "_slice", F.floor(F.col("event_ts") / slice_millis)
    )
    change = F.struct("event_ts", "phase")
    ends = sliced.groupBy(*part).agg(
        F.min(change).alias("_first"), F.max(change).alias("_last")
    )
    slices = W.partitionBy(*project).orderBy("_slice")
    around = ends.select(
        *part,
        F.lag("_last").over(slices).alias("_before"),
        F.lead("_first").over(slices).alias("_after"),
    )
    inside = W.partitionBy(*part).orderBy("event_ts", "phase")
    linked = sliced.withColumns(
        {
            "_prev": F.lag(F.struct("event_ts", "phase")).over(inside),
            "_next": F.lead(F.struct("event_ts", "phase")).over(inside),
        }
    ).join(around, part)
    previous = F.coalesce(F.col("_prev"), F.col("_before"))
    following = F.coalesce(F.col("_next"), F.col("_after"))
    return linked.select(
        *project,
        "event_ts",
        "phase",
        previous["phase"].alias("previous_phase"),
        following["event_ts"].alias("next_ts"),
        F.floor((following["event_ts"] - F.col("event_ts")) / DAY_MILLIS).alias("days_in_phase"),
        following.isNull().alias("is_current"),
    )


def with_phase_id(changes: DataFrame, phases: DataFrame) -> DataFrame:
    """Phase id by practice type and phase name; unknown phases keep a null id.

    Where ``phases`` names its tenant (``org_id``), changes match within it.
    """
    tenant = [c for c in ("org_id",) if c in phases.columns]
    names = phases.select(
        *tenant,
        F.col("projectTypeId").alias("project_type_id"),
        F.col("name").alias("phase"),
        F.col("phaseId").alias("phase_id"),
    )
    return changes.join(names, [*tenant, "project_type_id", "phase"], "left")
