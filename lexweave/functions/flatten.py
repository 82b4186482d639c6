"""Flatten nested source values by their declared field type.

A rule takes a column and its Spark type and returns the flat column. Rules are
chosen while the plan is built, so a record costs one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.config.model import ConfigError, Section
from lexweave.functions.text import bare_selector
from lexweave.functions.types import DISPLAY_TYPES, quoted

Rule = Callable[[Column, T.DataType], Column]



def child(column: Column, data_type: T.DataType, name: str) -> Column:
    """``column.name`` where the value is a struct or a variant, else the value itself."""
    if isinstance(data_type, T.StructType):
        return column[name]
    if isinstance(data_type, T.VariantType):
        nested = F.try_variant_get(column, f"$.{name}", "string")
        return F.coalesce(nested, F.try_variant_get(column, "$", "string"))
    return column


def joined(column: Column, data_type: T.DataType, delimiter: str, name: str = "id") -> Column:
    """Elements of a list as one text; null elements are left out."""
    if not isinstance(data_type, T.ArrayType):
        return column.cast("string")
    inner = data_type.elementType
    if isinstance(inner, T.VariantType):
        column = F.transform(column, lambda e: child(e, inner, name))
    elif isinstance(inner, T.StructType):
        # The field of all elements at once: compiled, where a lambda is interpreted.
        column = column[name]
    return F.array_join(column.cast("array<string>"), delimiter)


def flat_id(column: Column, data_type: T.DataType) -> Column:
    return child(column, data_type, "native")


def flat_link(column: Column, data_type: T.DataType) -> Column:
    return child(column, data_type, "id")


def flat_people(column: Column, data_type: T.DataType) -> Column:
    return F.coalesce(joined(column, data_type, "|"), F.lit(""))


def flat_strings(column: Column, data_type: T.DataType) -> Column:
    return joined(column, data_type, "|")


def flat_other(column: Column, data_type: T.DataType) -> Column:
    """Lists of text are joined, any other value passes through."""
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StringType):
        return F.array_join(column, "|")
    return column


def unchanged(column: Column, data_type: T.DataType) -> Column:
    return column


RULES: dict[str, Rule] = {
    "Id": flat_id,
    "PersonLink": flat_link,
    "PersonList": flat_people,
    "StringList": flat_strings,
    "object": unchanged,
}


def register_rule(field_type: str, rule: Rule) -> None:
    """Give a further field type its own flattening."""
    RULES[field_type] = rule


def field_types(
    meta: DataFrame, selector: str, type_name: str, section: Section
) -> dict[str, str]:
    """Whitelisted field name to declared type, from a section's metadata.

    There is one entry for each field of a section, and each becomes a column, so
    the driver holds no more than the select that is built from it.
    """
    pairs = meta.select(bare_selector(F.col(selector)).alias("name"), F.col(type_name))
    if section.fields is not None:
        pairs = pairs.where(F.col("name").isin(*section.fields))
    rows = pairs.distinct().collect()
    types: dict[str, str] = {}
    for name, declared in sorted(rows):
        if types.setdefault(name, declared) != declared:
            raise ConfigError(f"field {name} is declared as {types[name]} and {declared}")
    return types


def selected_types(
    declared: dict[str, str], key: str, project_type: str = "int"
) -> dict[str, str]:
    """Declared fields plus the forced key columns."""
    return {**declared, key: "Id", "projectId": project_type}


def contact_types(declared: dict[str, str]) -> dict[str, str]:
    """Contacts carry no project, and ``personTypes`` is not in their metadata."""
    return {**declared, "personId": "Id", "personTypes": "StringList"}


def whitelist_types(section: Section, key: str) -> dict[str, str]:
    """Entities without metadata: the whitelist alone, everything text but the key."""
    if section.fields is None:
        raise ConfigError(f"{section.name} has no metadata, so it needs a field list")
    return {**dict.fromkeys(section.fields, "string"), key: "int"}


def flatten(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Select the typed fields that the records have, in record order, flattened."""
    out = []
    for field in df.schema.fields:
        declared = types.get(field.name)
        if declared is None or declared in DISPLAY_TYPES:
            continue
        rule = RULES.get(declared, flat_other)
        out.append(rule(quoted(field.name), field.dataType).alias(field.name))
    return df.select(*out)


def unwrap_ids(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Replace ``{native: id}`` structs by the id."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({n: flat_id(quoted(n), kinds[n]) for n in names if n in kinds})


def as_text_record(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Alternate mapper: objects as JSON text, lists joined, the rest unchanged."""
    out = []
    for field in df.schema.fields:
        if field.name not in types:
            continue
        column = quoted(field.name)
        if types[field.name] == "object":
            column = F.to_json(column)
        elif isinstance(field.dataType, T.ArrayType):
            column = joined(column, field.dataType, "|")
        out.append(column.alias(field.name))
    return df.select(*out)
