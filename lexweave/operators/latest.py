"""Latest state per key, group replacement and deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions.types import quoted
from lexweave.operators.skew import spread_join


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row of each key that is last in ``order``.

    An aggregate, so each task sends at most one row per key: a key with very
    many versions does not reach one task whole. ``order`` has to decide ties.
    """
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.distinct()
    last = F.max_by(F.struct(*map(quoted, payload)), F.struct(*order))
    return (
        df.groupBy(*map(quoted, keys)).agg(last.alias("_last"))
        .select(*map(quoted, keys), "_last.*").select(*map(quoted, df.columns))
    )


def replace_groups(
    current: DataFrame,
    incoming: DataFrame,
    group: Sequence[str],
    refreshed: DataFrame | None = None,
) -> DataFrame:
    """Swap whole groups: old rows of every refreshed group go, the incoming rows come.

    ``refreshed`` lists the refreshed groups; pass it when a group may now be
    empty, otherwise the groups of ``incoming`` are taken.
    """
    groups = (incoming if refreshed is None else refreshed).select(*group).distinct()
    kept = spread_join(current, groups, group, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def without_deleted(
    items: DataFrame, events: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Items whose last event is not a delete. ``events`` has the keys and ``event_name``.

    ``keys`` must name an item whole (tenant, project, section, item): item ids are
    unique only within a section.
    """
    last = latest_per_key(events, keys, order)
    gone = last.where(F.col("event_name") == "Deleted").select(*keys)
    return spread_join(items, gone, keys, "left_anti")


def chunked_ids(numbered: DataFrame, number: str, size: int, out: str = "chunk") -> DataFrame:
    """Batch number of each numbered id, ``size`` ids a batch."""
    return numbered.withColumn(out, F.floor(F.col(number) / size))


def bounded(
    df: DataFrame, key: str, upper: int | None = None, head: int | None = None
) -> DataFrame:
    """Ids up to a bound, and at most the first ``head`` of them; both off by default."""
    if upper is not None:
        df = df.where(F.col(key) <= upper)
    if head is not None:
        df = df.orderBy(key).limit(head)
    return df
