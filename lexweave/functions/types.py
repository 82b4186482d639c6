"""Source field type to storage type, and typed projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.config.model import ConfigError

# Source field type -> lake type.
LAKE_TYPES = {
    "Text": "string",
    "Dropdown": "string",
    "Boolean": "boolean",
    "PersonLink": "string",
    "Date": "date",
    "Percent": "double",
    "Currency": "string",
    "IncidentDate": "date",
    "MultiSelectList": "string",
    "Header": "string",
    "String": "string",
    "object": "struct",
    "ProjectId": "int",
    "Id": "string",
    "CalculatedCurrency": "string",
    "Deadline": "string",
    "Instructions": "string",
    "StringList": "string",
    "PersonList": "string",
    "string": "string",
    "int": "int",
    "bool": "boolean",
    "date": "date",
    "decimal": "double",
}

# Source field type -> warehouse type.
WAREHOUSE_TYPES = {
    "string": "varchar(255)",
    "object": "text",
    "int": "int",
    "bool": "boolean",
    "date": "date",
    "decimal": "numeric(10,3)",
}

# Field types that hold no data.
DISPLAY_TYPES = (
    "Header", "DocGen", "ActionButton", "MultiDocGen", "DocList", "Doc", "ReportFusion"
)

# Mapping data types as Spark types. Ids are 64 bit: the source's are.
TARGET_TYPES = {
    "int": "int",
    "string": "string",
    "boolean": "boolean",
    "date": "date",
    "float": "double",
    "double": "double",
    "timestamp": "timestamp",
}


def target_type(name: str, data_type: str) -> str:
    if data_type == "int" and name.lower().endswith("_id"):
        return "bigint"
    if data_type.startswith("decimal"):
        return data_type
    try:
        return TARGET_TYPES[data_type]
    except KeyError:
        raise ConfigError(f"unknown target type {data_type} of {name}") from None


def lake_schema(field_types: dict[str, str]) -> dict[str, str]:
    """Lake type per field, without display-only fields; unknown types are an error."""
    data = {n: t for n, t in field_types.items() if t not in DISPLAY_TYPES}
    unknown = sorted({t for t in data.values() if t not in LAKE_TYPES})
    if unknown:
        raise ConfigError(f"unknown source field types: {', '.join(unknown)}")
    return {name: LAKE_TYPES[t] for name, t in data.items()}


def lake_type_of(data_type: T.DataType) -> str:
    """Lake type of a column whose type Spark knows (lead system, no metadata)."""
    if isinstance(data_type, T.IntegralType):
        return "int"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "float"
    return "string"


def type_column(type_name: Column, mapping: dict[str, str]) -> Column:
    """The mapping as an expression over a column of type names; unknown is null."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), type_name)


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots and leading digits included."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_lake(df: DataFrame, lake: dict[str, str]) -> DataFrame:
    """Cast the columns that are present to their lake type; bad text becomes null."""
    spark_types = {"int": "bigint", "float": "double"}
    out = []
    for field in df.schema.fields:
        wanted = lake.get(field.name)
        column = quoted(field.name)
        nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
        if wanted is None or wanted == "struct" or nested:
            out.append(column)
        else:
            out.append(column.try_cast(spark_types.get(wanted, wanted)).alias(field.name))
    return df.select(*out)


def by_inferred_type(df: DataFrame) -> DataFrame:
    """Lead entities: lake types follow the frame's own types."""
    return to_lake(df, {f.name: lake_type_of(f.dataType) for f in df.schema.fields})
