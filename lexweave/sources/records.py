"""Records out of landed API responses.

Each function takes the landed responses as a frame, so the same code serves a
batch scan, a stream and a test.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.functions.flatten import flat_id
from lexweave.functions.types import quoted
from lexweave.operators.skew import spread_join


def _with_id(df: DataFrame, source: str, target: str) -> Column:
    kind = df.select(source).schema.fields[0].dataType
    return flat_id(F.col(source), kind).alias(target)


def offset_pages(pages: DataFrame) -> DataFrame:
    """Items of ``{items, hasMore, offset, limit}`` pages."""
    return pages.select(F.explode("items").alias("item")).select("item.*")


def status_pages(pages: DataFrame) -> DataFrame:
    """Records of ``{Records, TotalPages}`` pages over all statuses; a missing page is empty.

    Where pages are kept with the ``status`` they answer, their records have it too.
    """
    asked = [c for c in ("status",) if c in pages.columns]
    return pages.select(*asked, F.explode("Records").alias("record")).select(*asked, "record.*")


def lookup(responses: DataFrame, lookup_type: str) -> DataFrame:
    """One lookup's entries out of responses kept with their ``lookup_type``."""
    wanted = responses.where(F.col("lookup_type") == lookup_type)
    return wanted.select(F.explode("entries").alias("entry")).select("entry.*")


def status_names(statuses: DataFrame) -> DataFrame:
    return statuses.select("Status")


def collection_items(pages: DataFrame) -> DataFrame:
    """One row per collection item: its data, its id and its project."""
    items = pages.select("projectId", F.explode("items").alias("item"))
    return items.select(
        "item.dataObject.*", "projectId", _with_id(items, "item.itemId", "id")
    )


def form_records(forms: DataFrame) -> DataFrame:
    """One row per project that has the section."""
    return forms.where(F.col("section").isNotNull()).select("section.*", "projectId")


def projects(items: DataFrame) -> DataFrame:
    """Project records with plain ids."""
    ids = ["projectId", "projectTypeId", "phaseId", "clientId", "orgId"]
    return items.withColumns(
        {n: _with_id(items, n, n) for n in ids if n in items.columns}
    )


def projects_of_type(project_df: DataFrame, project_type: int) -> DataFrame:
    return project_df.where(F.col("projectTypeId") == project_type)


def sections_of(project_df: DataFrame, sections: DataFrame, fields: Sequence[str] = ()) -> DataFrame:
    """Section records (forms or collection items) of the listed projects, with ``fields`` of their project.

    One row per record, however often the list names its project; of rows that differ the
    least fields count. A project with very many records is dealt to several tasks. Records
    whose own columns are named like a field keep them. Records without a project go.
    """
    own = {c.lower() for c in sections.columns}
    kept = [f for f in dict.fromkeys(fields) if f.lower() not in own]
    listed = project_df.groupBy("projectId").agg(F.min(F.struct(F.lit(0), *map(quoted, kept))).alias("_p"))
    named = listed.select("projectId", *[F.col("_p").getField(f).alias(f) for f in kept])
    joined = spread_join(sections, named, ["projectId"], "inner")
    return joined.select(*map(quoted, [*kept, *sections.columns]))


def project_types(types: DataFrame, phases: DataFrame) -> DataFrame:
    """Project types with their phases nested.

    Phases are made distinct before they are nested, so an array holds a type's
    phase list and does not grow with the records it came from.
    """
    plain = types.drop("links").withColumn(
        "projectTypeId", _with_id(types, "projectTypeId", "projectTypeId")
    )
    distinct = phases.select("projectTypeId", "phaseId", "name", "isPermanent").distinct()
    nested = distinct.groupBy("projectTypeId").agg(
        F.sort_array(F.collect_list(F.struct("phaseId", "name", "isPermanent"))).alias("phases")
    )
    return plain.join(nested, "projectTypeId", "left")


def contacts(pages: DataFrame) -> DataFrame:
    items = offset_pages(pages)
    return items.withColumn("personId", _with_id(items, "personId", "personId"))


def project_contacts(pages: DataFrame) -> DataFrame:
    """Contacts of a project: each item wraps ``orgContact``."""
    return pages.select(F.explode("items").alias("item")).select("item.orgContact.*")


def section_fields(sections: DataFrame) -> DataFrame:
    """Metadata of a section: field selector and type."""
    return sections.select(F.explode("customFields").alias("f")).select(
        "f.fieldSelector", "f.customFieldType"
    )


def section_list(pages: DataFrame) -> DataFrame:
    return offset_pages(pages).select(
        F.col("sectionSelector").alias("id"), "name", "isCollection"
    )


def with_ids(records: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The records an id list names, however often it names them."""
    return records.join(ids.select(key).distinct(), key, "left_semi")


def lead_ids(lead_rows: DataFrame) -> DataFrame:
    return lead_rows.select("Id")


def linked_ids(lead_details: DataFrame, link: str) -> DataFrame:
    """Ids of the contacts or opportunities that leads point to, each once."""
    return lead_details.select(F.col(f"{link}.Id").alias("Id")).dropna().distinct()


def opportunity_ids(lead_details: DataFrame) -> DataFrame:
    """Opportunity id of every lead that has one."""
    return lead_details.select(F.col("Opportunity.Id").alias("Id")).dropna()


def backfill_events(
    project_df: DataFrame, bound: int, millis: int, user_id: int, section: str = "intake"
) -> DataFrame:
    """An update event for a section of every project below the id bound."""
    return project_df.where(F.col("projectId") < bound).select(
        F.lit(millis).cast("bigint").alias("Timestamp"),
        F.lit("Form").alias("Object"),
        F.lit("Updated").alias("Event"),
        F.struct(
            F.col("projectTypeId").cast("bigint").alias("ProjectTypeId"),
            F.lit(section).alias("SectionSelector"),
        ).alias("ObjectId"),
        F.col("orgId").cast("bigint").alias("OrgId"),
        F.col("projectId").cast("bigint").alias("ProjectId"),
        F.lit(user_id).cast("bigint").alias("UserId"),
        F.lit(None).cast(T.StructType([T.StructField("PhaseName", T.StringType())])).alias("Other"),
    )
