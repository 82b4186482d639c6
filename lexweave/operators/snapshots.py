"""One example record of an entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.config.model import ConfigError

# Tables of the lead system.
LEAD_TABLES = (
    "statuses", "leadsource", "casetype", "leadrow", "leaddetail", "contact", "opportunities",
    "referrals", "users",
)


def first_of_type(records: DataFrame, project_type: int, key: str = "projectId") -> DataFrame:
    """First project (or project's section) of a project type."""
    return records.where(F.col("projectTypeId") == project_type).orderBy(key).limit(1)


def first_form(projects: DataFrame, forms: DataFrame, project_type: int) -> DataFrame:
    """First form of a project type; a form takes its type from its project."""
    ids = projects.where(F.col("projectTypeId") == project_type).select("projectId")
    return forms.join(ids, "projectId", "left_semi").orderBy("projectId").limit(1)


def first_with_items(
    projects: DataFrame, items: DataFrame, project_type: int, order: list[str]
) -> DataFrame:
    """First item of the first project of a type that has any."""
    ids = projects.where(F.col("projectTypeId") == project_type).select("projectId")
    return items.join(ids, "projectId", "left_semi").orderBy(*order).limit(1)


def first_row(records: DataFrame, key: str = "Id") -> DataFrame:
    return records.orderBy(key).limit(1)


def first_lead(
    statuses: DataFrame, leads: DataFrame, link: str | None = None
) -> DataFrame:
    """First lead of the first status that has leads, optionally one with a link.

    ``leads`` has ``Id``, ``Status`` and the link; only that first status counts,
    even if none of its leads has the link.
    """
    counted = leads.groupBy("Status").agg(F.count(F.lit(1)).alias("leads"))
    first = (
        statuses.join(counted, "Status", "left_semi")
        .agg(F.min_by("Status", F.struct("Id", "Status"))).scalar()
    )
    chosen = leads.where(F.col("Status") == first)
    if link:
        chosen = chosen.where(F.col(link).isNotNull())
    return chosen.orderBy("Id").limit(1)


def snapshot(
    frames: dict[str, DataFrame],
    system: str,
    entity_type: str,
    name: str,
    project_type: int | None = None,
) -> DataFrame:
    """The example record an API read would give for an entity."""
    name = name.lower()
    if system == "case":
        if entity_type == "core" and name != "project":
            return first_row(frames[name], {"contact": "personId"}.get(name, "projectTypeId"))
        if entity_type == "core":
            return first_of_type(frames[name], project_type)
        if entity_type == "form":
            return first_form(frames["project"], frames[name], project_type)
        if entity_type == "collections":
            return first_with_items(
                frames["project"], frames[name], project_type, ["projectId", "id"]
            )
    elif system == "lead" and name in LEAD_TABLES:
        link = {"contact": "ContactId", "opportunities": "OpportunityId"}.get(name)
        if name == "leadrow":
            return first_lead(frames["statuses"], frames["leadrow"])
        if name == "leaddetail":
            return first_lead(frames["statuses"], frames["leaddetail"])
        if link:
            lead = first_lead(frames["statuses"], frames["leaddetail"], link)
            ids = lead.select(F.col(link).alias("Id"))
            return frames[name].join(ids, "Id", "left_semi")
        return first_row(frames[name])
    raise ConfigError(f"no snapshot of {system}/{entity_type}/{name}")
