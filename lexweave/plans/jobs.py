"""Batch jobs: historical loads and the full standard-model run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.config.model import Mapping, Section, Whitelist
from lexweave.functions import flatten, leads
from lexweave.functions.types import by_inferred_type, lake_schema, to_lake
from lexweave.plans.standard_model import StandardModel
from lexweave.sinks.tables import write_entity, write_partitioned, write_table
from lexweave.sources.files import read_raw, read_table

# Load order of the lead system's entities.
LEAD_LOAD_ORDER = (
    "statuses", "leadsource", "casetype", "leadrow", "leaddetail", "contact", "opportunities",
    "referrals", "users",
)


def flatten_lead(entity: str, records: DataFrame, section: Section) -> DataFrame:
    """Flatten, whitelist and type one lead entity."""
    flat = leads.TRANSFORMS[entity](records)
    return by_inferred_type(leads.whitelisted(flat, section))


def write_load(df: DataFrame, path: str, tenant: dict[str, object] | None) -> None:
    """A whole-entity load; with ``tenant`` (org, project type) only that part is replaced."""
    if tenant is None:
        return write_entity(df, path)
    keyed = df.withColumns({name: F.lit(value) for name, value in tenant.items()})
    return write_partitioned(keyed, path, list(tenant))


def load_leads(
    landed: dict[str, DataFrame],
    whitelist: Whitelist,
    root: str,
    tenant: dict[str, object] | None = None,
) -> dict[str, str]:
    """Historical load of the lead system: every landed entity, whole.

    Give ``tenant`` (partition columns and their values) where several share ``root``.
    """
    paths = {}
    for entity in LEAD_LOAD_ORDER:
        if entity in landed:
            paths[entity] = f"{root}/{entity}"
            flat = flatten_lead(entity, landed[entity], whitelist.section(entity))
            write_load(flat, paths[entity], tenant)
    return paths


def flatten_case(records: DataFrame, types: dict[str, str]) -> DataFrame:
    """Flatten and type one case-system entity by its selected field types."""
    return to_lake(flatten.flatten(records, types), lake_schema(types))


def load_cases(
    landed: dict[str, DataFrame],
    types: dict[str, dict[str, str]],
    root: str,
    tenant: dict[str, object] | None = None,
) -> dict[str, str]:
    """Historical load of the case system: contacts, types, projects, forms, collections.

    ``types`` holds the selected field types of each entity. Project types keep
    their nested phases. ``tenant`` is as in ``load_leads``.
    """
    paths = {}
    for entity, records in landed.items():
        paths[entity] = f"{root}/{entity}"
        if entity == "projecttype":
            ids = flatten.unwrap_ids(records, ["projectTypeId"])
            write_load(ids.select("projectTypeId", "name", "phases"), paths[entity], tenant)
        else:
            write_load(flatten_case(records, types[entity]), paths[entity], tenant)
    return paths


def adopt_raw(
    spark: SparkSession, root: str, org: int, project_type: int, store: str
) -> dict[str, str]:
    """Move raw sets of one file per project into tables partitioned by tenant and type.

    Listing very many small files is done once, here; readers of the tables
    filter on the partition columns.
    """
    paths = {}
    keys = {"org_id": F.lit(org), "project_type_id": F.lit(project_type)}
    for name, frame in read_raw(spark, root, str(org), project_type).items():
        paths[name] = f"{store}/{name}"
        write_partitioned(frame.withColumns(keys), paths[name], list(keys))
    return paths


def run_standard_model(
    raw: dict[str, DataFrame], out: str, mapping: Mapping | None = None, typed: bool = False
) -> dict[str, str]:
    """Build and write every table whose raw input is given.

    The person types are read back before they are joined: numbered once, and
    of known size.
    """
    model = StandardModel(mapping, typed=typed)
    builders = [
        ("project", "Cases", model.cases),
        ("projecttype", "PracticeTypes", model.practice_types),
        ("projecttype", "Phases", model.phases),
        ("meds", "CaseFigures", model.case_figures),
        ("intake", "IntakeDetails", model.intake_details),
        ("casesummary", "CaseDetails", model.case_details),
    ]
    paths = {}
    if "contact" in raw:
        contact = raw["contact"]
        paths["PeopleTypes"] = write_table(model.people_types(contact), out, "PeopleTypes")
        paths["Peoples"] = write_table(model.people(contact), out, "Peoples")
        types = read_table(contact.sparkSession, out, "PeopleTypes")
        links = model.people_type_links(contact, types)
        paths["Peoples_PeopleType"] = write_table(links, out, "Peoples_PeopleType")
    for entity, name, builder in builders:
        if entity in raw:
            paths[name] = write_table(builder(raw[entity]), out, name)
    return paths
