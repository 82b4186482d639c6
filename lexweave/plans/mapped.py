"""Any target table from its mapping: one projection, resolved up front."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.config.model import ConfigError, TargetField, TargetTable, unique_targets
from lexweave.functions.types import quoted, target_type

OrgId = int | str | Column | None


def _resolve(df: DataFrame, name: str) -> str | None:
    """The frame's column for a source field; names match in any case."""
    matches = [c for c in df.columns if c.lower() == name.lower()]
    if len(matches) > 1:
        raise ConfigError(f"source field {name} is ambiguous: {matches}")
    return matches[0] if matches else None


def missing_sources(df: DataFrame, table: TargetTable) -> list[str]:
    sources = {f.source for f in table.fields if f.kind == "data"}
    return sorted(s for s in sources if _resolve(df, s) is None)


def tenant_column(org_id: OrgId) -> Column:
    return org_id if isinstance(org_id, Column) else F.lit(org_id)


def _column(df: DataFrame, field: TargetField, org_id: OrgId, typed: bool) -> Column:
    kind = target_type(field.name, field.data_type) if typed else "string"
    if field.kind == "org":
        return tenant_column(org_id).alias(field.name)
    source = _resolve(df, field.source) if field.kind == "data" else None
    if source is None:
        return F.lit(None).cast(kind).alias(field.name)
    column = quoted(source)
    if typed:
        # A nested value has no plain target type; it is left to the flattening rules.
        if not isinstance(df.schema[source].dataType, (T.StructType, T.ArrayType, T.MapType)):
            column = column.try_cast(kind)
    return column.alias(field.name)


def build(
    df: DataFrame,
    table: TargetTable,
    org_id: OrgId,
    typed: bool = False,
    strict: bool = True,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """The target columns in mapping order.

    ``typed`` casts to the mapping's types (unreadable text becomes null);
    otherwise source types are kept and unmapped columns are text nulls.
    ``strict`` makes a missing source field an error, else it is a null.
    ``org_id`` is a value, or a column of ``df`` when it holds several tenants.
    """
    table = unique_targets(table)
    if strict and (missing := missing_sources(df, table)):
        raise ConfigError(f"{table.name}: source has no {', '.join(missing)}")
    columns = [_column(df, f, org_id, typed) for f in table.fields if f.kind != "key"]
    if ingested_at is not None:
        columns.append(F.lit(ingested_at).cast("timestamp").alias("date_ingested"))
    return df.select(*columns)
