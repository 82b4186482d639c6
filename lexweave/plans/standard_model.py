"""Builders of the standard-model tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.config.model import Mapping
from lexweave.config.standard_model import ORG_COLUMNS, standard_mapping
from lexweave.config.warehouse import CRM_RENAMES, CRM_TABLES, warehouse_table
from lexweave.functions.text import tokens, utc_day
from lexweave.functions.types import quoted
from lexweave.operators.checks import conform
from lexweave.operators.numbering import number_in_order
from lexweave.operators.phases import with_phase_id
from lexweave.plans.mapped import build, tenant_column


class StandardModel:
    """Lazy builders over flattened raw frames, driven by a mapping."""

    def __init__(
        self,
        mapping: Mapping | None = None,
        typed: bool = False,
        strict: bool = True,
        ingested_at: datetime | None = None,
    ):
        self.mapping = mapping or standard_mapping()
        self.typed = typed
        self.strict = strict
        self.ingested_at = ingested_at

    def mapped(self, name: str, df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
        """A table that is nothing but its mapping."""
        return build(
            df,
            self.mapping.table(name).without(*drop),
            self.mapping.org_id,
            self.typed,
            self.strict,
            self.ingested_at,
        )

    def people_types(self, contact: DataFrame) -> DataFrame:
        """The distinct person types with a dense id in name order.

        Whole texts are made distinct before they are split: contacts share few
        combinations, so far fewer rows reach the second distinct. Where the tenant
        is a column, each tenant has its own types, numbered tenant after tenant.
        """
        table = self.mapping.table("PeopleType")
        source = table.field("People_Type").source
        tenants = isinstance(self.mapping.org_id, Column)
        own = [self.mapping.org_id.alias("_org")] if tenants else []
        kept = ["_org"] if tenants else []
        texts = contact.select(*own, quoted(source).alias("text")).distinct()
        split = F.explode(tokens(F.col("text"))).alias("People_Type")
        types = texts.select(*kept, split).distinct()
        key = "People_Type"
        if tenants:
            key = "_key"
            types = types.withColumn(key, F.struct("_org", "People_Type"))
        # A dimension of few values: eight ranges do, and builders count nothing.
        numbered = number_in_order(types, key, "People_Type_Id", depth=1)
        tenant = F.col("_org") if tenants else F.lit(self.mapping.org_id)
        text_null = F.lit(None).cast("string")
        out = numbered.select(
            "People_Type",
            *[tenant.alias(c) for c in table.org_columns],
            *[text_null.alias(c) for c in ("Custom1", "Custom2", "Custom3", "People_Sub_Type")],
            "People_Type_Id",
        )
        if self.ingested_at is not None:
            out = out.withColumn("date_ingested", F.lit(self.ingested_at).cast("timestamp"))
        return out

    def people(self, contact: DataFrame) -> DataFrame:
        return self.mapped("Peoples", contact, drop=("People_Type_ID",))

    def people_type_links(self, contact: DataFrame, people_types: DataFrame) -> DataFrame:
        """One row per person and person type, with the type's id.

        Pass the type table as written: its size is known then, and Spark
        broadcasts it exactly when it is small. Types are matched within the tenant
        where that is a column.
        """
        table = self.mapping.table("Peoples")
        on, own, theirs = ["People_Type"], [], []
        if isinstance(self.mapping.org_id, Column):
            on = ["_org", "People_Type"]
            own = [self.mapping.org_id.alias("_org")]
            theirs = [F.col(self.mapping.table("PeopleType").org_columns[0]).alias("_org")]
        pairs = contact.select(
            *own,
            quoted(table.field("People_ID").source).alias("People_ID"),
            F.explode(tokens(quoted(table.field("People_Type_ID").source))).alias("People_Type"),
        )
        ids = people_types.select(
            *theirs, "People_Type", F.col("People_Type_Id").alias("People_Type_ID")
        )
        return pairs.join(ids, on, "left").select("People_ID", "People_Type_ID")

    def cases(self, project: DataFrame) -> DataFrame:
        return self.mapped("Cases", project)

    def practice_types(self, projecttype: DataFrame) -> DataFrame:
        return self.mapped("PracticeTypes", projecttype)

    def phases(self, projecttype: DataFrame) -> DataFrame:
        rows = projecttype.select("projectTypeId", F.explode("phases").alias("phase"))
        flat = rows.select("projectTypeId", "phase.name", "phase.phaseId", "phase.isPermanent")
        return self.mapped("Phases", flat)

    def case_figures(self, meds: DataFrame) -> DataFrame:
        return self.mapped("CaseFigures", meds)

    def intake_details(self, intake: DataFrame) -> DataFrame:
        return self.mapped("IntakeDetails", intake)

    def case_details(self, casesummary: DataFrame) -> DataFrame:
        return self.mapped("CaseDetails", casesummary)

    def phase_changes(self, log: DataFrame, projecttype: DataFrame) -> DataFrame:
        """The phase log as warehouse rows; ``log`` has org, type, project, phase, event_ts."""
        dim = projecttype.select("projectTypeId", F.explode("phases").alias("p")).select(
            *[c for c in ("org_id",) if c in projecttype.columns],
            "projectTypeId", "p.name", "p.phaseId",
        )
        linked = with_phase_id(log, dim).select(
            *[tenant_column(self.mapping.org_id).alias(c) for c in ORG_COLUMNS],
            F.col("project_id").alias("Parent_Case_ID"),
            F.col("project_id").alias("Case_ID"),
            F.col("phase_id").alias("Phase_ID"),
            utc_day(F.col("event_ts")).alias("Phase_Change_Date"),
        )
        return conform(linked, warehouse_table("CMS_PhaseChanges"))


def crm_table(entity: str, flat: DataFrame, platform_org: int, client_org: str) -> DataFrame:
    """A lead entity as its warehouse table: tenant columns and same-named fields."""
    tenant = flat.withColumns(
        {ORG_COLUMNS[0]: F.lit(platform_org), ORG_COLUMNS[1]: F.lit(client_org)}
    )
    return conform(tenant, warehouse_table(CRM_TABLES[entity]), CRM_RENAMES.get(entity))
