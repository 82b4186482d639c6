"""Flattening of the lead system's records, one projection per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.config.model import Section
from lexweave.functions.flatten import joined
from lexweave.functions.types import quoted


def _is_list_of_structs(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType)


def _full_name(person: Column) -> Column:
    return F.concat_ws(" ", person["FirstName"], person["LastName"])


def lead_detail(df: DataFrame) -> DataFrame:
    """Nested people and links become ids, lists become ``,``-joined ids.

    ``CustomFields`` stays the list it is.
    """
    out = []
    for field in df.schema.fields:
        column, kind = quoted(field.name), field.dataType
        if field.name == "CustomFields":
            pass
        elif isinstance(kind, T.StructType):
            column = column["Id"]
        elif isinstance(kind, T.ArrayType):
            column = joined(column, kind, ",", "Id")
        out.append(column.alias(field.name))
    return df.select(*out)


def contact(df: DataFrame) -> DataFrame:
    """Lists become ``,``-joined text; custom fields are named by their id."""
    out = []
    for field in df.schema.fields:
        column, kind = quoted(field.name), field.dataType
        if isinstance(kind, T.ArrayType):
            name = "CustomFieldId" if field.name == "CustomFields" else "Id"
            column = joined(column, kind, ",", name)
        out.append(column.alias(field.name))
    return df.select(*out)


def opportunity(df: DataFrame) -> DataFrame:
    """Custom fields by id, the first assignee and the processor by name."""
    out = []
    for field in df.schema.fields:
        column, kind = quoted(field.name), field.dataType
        if field.name == "CustomFields":
            column = joined(column, kind, ",", "CustomFieldId")
        elif field.name == "AssignedTo" and _is_list_of_structs(kind):
            first = F.get(column, F.lit(0))
            column = F.when(F.size(column) > 0, _full_name(first)).otherwise("")
        elif field.name == "ProcessedBy" and isinstance(kind, T.StructType):
            column = F.when(column.isNotNull(), _full_name(column)).otherwise("")
        out.append(column.alias(field.name))
    return df.select(*out)


def as_is(df: DataFrame) -> DataFrame:
    """Lookups, referrals, users and lead rows are flat already."""
    return df


def whitelisted(df: DataFrame, section: Section) -> DataFrame:
    """Keep the whitelisted columns in record order; absent ones are not added."""
    return df.select(*[quoted(c) for c in df.columns if section.allows(c)])


TRANSFORMS = {
    "statuses": as_is,
    "leadsource": as_is,
    "casetype": as_is,
    "leadrow": as_is,
    "leaddetail": lead_detail,
    "contact": contact,
    "opportunities": opportunity,
    "referrals": as_is,
    "users": as_is,
}
