"""The declared warehouse: columns, keys and references of each table.

Columns are plain Spark DDL, read by Spark's own schema parser. Every table
starts with its tenant columns; ``custom`` appends that many free text columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import types as T

from lexweave.config.model import ConfigError
from lexweave.config.standard_model import ORG_COLUMNS
from lexweave.config.whitelists import LEAD_ENTITIES


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class WarehouseTable:
    name: str
    body: str
    primary_key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: tuple[ForeignKey, ...] = ()
    custom: int = 0
    org_types: tuple[str, ...] = ("INT", "VARCHAR(255)")

    @property
    def ddl(self) -> str:
        org = [f"{n} {t} NOT NULL" for n, t in zip(ORG_COLUMNS, self.org_types)]
        body = [self.body] if self.body else []
        free = [f"Custom{i + 1} VARCHAR(255)" for i in range(self.custom)]
        return ", ".join(org + body + free)

    def schema(self) -> T.StructType:
        """Needs a running session: Spark parses the DDL."""
        return _parse(self.ddl)


@lru_cache(maxsize=None)
def _parse(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _fk(columns: str, parent: str, parent_columns: str | None = None) -> ForeignKey:
    return ForeignKey(tuple(columns.split()), parent, tuple((parent_columns or columns).split()))


_CASE = _fk("Parent_Case_ID Case_ID", "CMS_CaseDetails")
_PERSON = ("People_ID",)

# Case-management tables.
_CMS = [
    WarehouseTable(
        "CMS_PeopleType",
        "People_Type_ID INT NOT NULL, People_Type VARCHAR(255) NOT NULL, "
        "People_Sub_Type VARCHAR(255)",
        ("People_Type_ID",), custom=3),
    WarehouseTable(
        "CMS_Teams",
        "Team_ID INT NOT NULL, Team_Name VARCHAR(255) NOT NULL, Team_Type VARCHAR(255), "
        "Team_Sub_Type VARCHAR(255)",
        ("Team_ID",), ("Team_Name",), custom=3, org_types=("INT", "INT")),
    WarehouseTable(
        "CMS_People",
        "People_ID INT NOT NULL, Team_ID INT NOT NULL, First_Name VARCHAR(255), "
        "Middle_Name VARCHAR(255), Last_Name VARCHAR(255), Date_of_Birth DATE, Gender VARCHAR(50)",
        ("People_ID",), (), (_fk("Team_ID", "CMS_Teams"),), 3),
    WarehouseTable(
        "CMS_PeoplePeopleTypes",
        "People_ID INT NOT NULL, People_Type_ID INT NOT NULL",
        ("People_ID", "People_Type_ID"), (),
        (_fk("People_ID", "CMS_People"), _fk("People_Type_ID", "CMS_PeopleType"))),
    WarehouseTable(
        "CMS_CaseTypes",
        "Case_Type_ID INT NOT NULL, Case_Type_Name VARCHAR(255) NOT NULL, "
        "Case_Type_Category VARCHAR(255), Case_Type_Sub_Category VARCHAR(255), "
        "Phase_Change_Date DATE",
        ("Case_Type_ID",), ("Case_Type_Name",), custom=3),
    WarehouseTable(
        "CMS_PracticeTypes",
        "Practice_Type_ID INT NOT NULL, Practice_Type_Name VARCHAR(255) NOT NULL",
        ("Practice_Type_ID",), custom=3),
    WarehouseTable(
        "CMS_Phases",
        "Phase_ID INT NOT NULL, Phase_Name VARCHAR(255) NOT NULL, Phase_Order INT, "
        "Phase_Category VARCHAR(255), Phase_Sub_Category VARCHAR(255), "
        "Practice_Type_ID INT NOT NULL",
        ("Phase_ID",), ("Phase_Name",), (_fk("Practice_Type_ID", "CMS_PracticeTypes"),), 3),
    WarehouseTable(
        "CMS_StatusMaster",
        "Status_ID INT NOT NULL, Practice_Type_ID INT NOT NULL, Case_Type_ID INT NOT NULL, "
        "Status_Name VARCHAR(255) NOT NULL, Sub_Status_Name VARCHAR(255)",
        ("Status_ID",), (),
        (_fk("Practice_Type_ID", "CMS_PracticeTypes"), _fk("Case_Type_ID", "CMS_CaseTypes")), 3),
    WarehouseTable(
        "CMS_Cases",
        "Case_ID INT NOT NULL, Practice_Type_ID INT NOT NULL, Is_Archived BOOLEAN, "
        "Date_of_Incident DATE",
        ("Case_ID",), (), (_fk("Practice_Type_ID", "CMS_PracticeTypes"),)),
    WarehouseTable(
        "CMS_InsuranceMaster",
        "Insurance_ID INT NOT NULL, Insurance_Name VARCHAR(255) NOT NULL, "
        "Insurance_Type VARCHAR(255) NOT NULL, Insurance_Sub_Type VARCHAR(255) NOT NULL, "
        "Insurance_Limit1_Type VARCHAR(255), Insurance_Limit2_Type VARCHAR(255), "
        "Limit_Value1 DECIMAL(8,2), Limit_Value2 DECIMAL(8,2)",
        ("Insurance_ID",), custom=3),
    WarehouseTable(
        "CMS_CaseDetails",
        "Parent_Case_ID INT NOT NULL, Case_ID INT NOT NULL, Case_Type_ID INT, "
        "Case_Create_Date DATE, Date_of_Incident DATE, Case_Name VARCHAR(255), "
        "Plaintiff_Full_Name VARCHAR(255), Attorney_ID INT, Prelitigation_Paralegal_ID INT, "
        "Litigation_Paralegal_ID INT, CaseManager_ID INT, Cocounsel_ID INT, Case_Team_ID INT, "
        "Case_Status_ID INT, Insurance_ID INT, Case_Marketing_Source VARCHAR(255), "
        "Case_Source_Name VARCHAR(255), Attorney_Fee_Percentage DECIMAL(3,2), "
        "Projected_Settlement_Date DATE, Projected_Settlement_Amount DECIMAL(8,2), "
        "Actual_Settlement_Date DATE, Actual_Settlement_Amount DECIMAL(8,2), "
        "If_Case_Settled_Presuit VARCHAR(50), If_VIP_Case VARCHAR(50), "
        "If_Case_Referred_Out VARCHAR(50), Case_Phase_ID INT",
        ("Parent_Case_ID", "Case_ID"), (),
        (
            _fk("Case_Type_ID", "CMS_CaseTypes"),
            _fk("Attorney_ID", "CMS_People", "People_ID"),
            _fk("Prelitigation_Paralegal_ID", "CMS_People", "People_ID"),
            _fk("Litigation_Paralegal_ID", "CMS_People", "People_ID"),
            _fk("CaseManager_ID", "CMS_People", "People_ID"),
            _fk("Cocounsel_ID", "CMS_People", "People_ID"),
            _fk("Case_Team_ID", "CMS_Teams", "Team_ID"),
            _fk("Case_Status_ID", "CMS_StatusMaster", "Status_ID"),
            _fk("Insurance_ID", "CMS_InsuranceMaster"),
            _fk("Case_Phase_ID", "CMS_Phases", "Phase_ID"),
        ), 5),
    WarehouseTable(
        "CMS_CaseFigures",
        "Parent_Case_ID INT NOT NULL, Case_ID INT NOT NULL, Case_Figure_ID INT, "
        "Figure_Type VARCHAR(255), Figure_Date DATE, Figure_Status VARCHAR(255), "
        "Value DECIMAL(8,2)",
        (), (), (_CASE,), 3),
    WarehouseTable(
        "CMS_IntakeDetails",
        "Parent_Case_ID INT NOT NULL, Case_ID INT NOT NULL, Intake_ID INT NOT NULL, "
        "Person_Performing_Intake_ID INT, Intake_Source VARCHAR(255), Date_of_Intake DATE, "
        "Date_of_Incident DATE, DUI_or_HitandRun VARCHAR(50), Referral_Fee_ID INT, "
        "If_Case_Referred_In VARCHAR(50), If_Qualified_Case VARCHAR(50), If_VIP_Lead VARCHAR(50)",
        ("Intake_ID",), (), (_CASE,), 3, ("INT",)),
    WarehouseTable(
        "CMS_PhaseChanges",
        "Parent_Case_ID INT NOT NULL, Case_ID INT NOT NULL, Phase_ID INT NOT NULL, "
        "Phase_Change_Date DATE NOT NULL",
        (), (), (_fk("Phase_ID", "CMS_Phases"), _CASE), 3),
]

# Social-media tables.
_IG = [
    WarehouseTable(
        "IG_Posts",
        "Post_ID VARCHAR(255) NOT NULL, PostDate TIMESTAMP NOT NULL, Caption STRING, "
        "Username VARCHAR(255), Media_Type VARCHAR(255), Media_Url VARCHAR(255), "
        "Permalink VARCHAR(255), Comments INT, Likes INT",
        ("Post_ID",), custom=3),
    WarehouseTable(
        "IG_Dates", "Date_Date DATE NOT NULL, Followers INT, Posts INT, Comments INT, Likes INT"),
    WarehouseTable(
        "IG_Hashtags",
        "Hashtag VARCHAR(255) NOT NULL, Hashtag_Date DATE, Posts INT, "
        "Media_Count_Type VARCHAR(255)",
        custom=3),
    *(
        WarehouseTable(
            table, f"{column} VARCHAR(255) NOT NULL, {date} DATE, {measure} INT", custom=3)
        for table, column, date, measure in [
            ("IG_MediaTypes", "Media_Type", "Media_Type_Date", "Posts"),
            ("IG_Countries", "Country", "Countries_Date", "Followers"),
            ("IG_Ages", "Age", "Ages_Date", "Followers"),
            ("IG_Gender", "Gender", "Gender_Date", "Followers"),
            ("IG_Locales", "Locale", "Locale_Date", "Followers"),
            ("IG_Hours", "Hour", "Hours_Date", "Posts"),
            ("IG_Cities", "City", "Cities_Date", "Followers"),
        ]
    ),
]

# Application tables, names spelt as declared.
_APP = [
    WarehouseTable(
        "APP_Departments",
        "department_id INT NOT NULL, deparment_name VARCHAR(255) NOT NULL",
        ("department_id",), ("deparment_name",), custom=3, org_types=("INT",)),
    WarehouseTable(
        "APP_TeamsforTargets",
        "Team_ID INT NOT NULL, Team_Name VARCHAR(255) NOT NULL, Team_Type VARCHAR(255), "
        "Team_Sub_Type VARCHAR(255), Team_member_id INT, department_id INT",
        ("Team_ID", "Team_member_id"), ("Team_Name",),
        (_fk("Team_member_id", "CMS_People", "People_ID"),
         _fk("department_id", "APP_Departments")),
        3, ("INT",)),
    WarehouseTable(
        "APP_Targets",
        "Target_ID INT NOT NULL, deparment_id INT NOT NULL, Team_member_id INT NOT NULL, "
        "Year INT NOT NULL, Quarter INT NOT NULL, Month INT NOT NULL, Week INT NOT NULL, "
        "Target DECIMAL(12,2)",
        ("Target_ID",), (),
        (_fk("deparment_id", "APP_Departments", "department_id"),
         _fk("Team_member_id", "CMS_People", "People_ID")),
        3, ("INT",)),
]

# Lead entity -> its table, and the columns that are not text.
CRM_TABLES = {
    "casetype": "CRM_CaseType",
    "leadsource": "CRM_LeadSource",
    "opportunities": "CRM_Opportunities",
    "referrals": "CRM_Referrals",
    "statuses": "CRM_Status",
    "users": "CRM_Users",
}
CRM_RENAMES = {"users": {"Id": "UserID", "Roles": "CRM_Roles", "Permissions": "CRM_Permissions"}}
_CRM_TYPES = {
    "casetype": {"IsMassTort": "BOOLEAN"},
    "opportunities": {
        "Birthdate": "TIMESTAMP",
        "IncidentDate": "TIMESTAMP",
        "CreatedDate": "TIMESTAMP",
        "LeadId": "INT",
        "AppointmentScheduledDate": "TIMESTAMP",
        "Processed": "BOOLEAN",
        "ProcessedDate": "TIMESTAMP",
        "OpportunityTypeId": "INT",
        "IsBeingEdited": "BOOLEAN",
    },
    "referrals": {"Outgoing": "BOOLEAN"},
}


def _crm(entity: str) -> WarehouseTable:
    """A lead entity's table: its whitelisted fields, as text where nothing else is said."""
    types = {"Id": "INT", **_CRM_TYPES.get(entity, {})}
    renames = CRM_RENAMES.get(entity, {})
    columns = [
        f"{renames.get(f, f)} {types.get(f, 'VARCHAR(255)')}" for f in LEAD_ENTITIES[entity].split()
    ]
    return WarehouseTable(CRM_TABLES[entity], ", ".join(columns))


_CRM = [_crm(entity) for entity in CRM_TABLES]

_CLUSTERING = WarehouseTable(
    "case_value_clustering",
    "final_value DOUBLE NOT NULL, "
    + ", ".join(f"clusters_{k} INT NOT NULL" for k in range(2, 8))
    + ", clusters_lower_bound INT, clusters_upper_bound INT",
    ("final_value",), org_types=())

WAREHOUSE: dict[str, WarehouseTable] = {
    t.name: t for t in [*_CMS, *_IG, *_APP, *_CRM, _CLUSTERING]
}

# Where a builder's column name differs from the declared one.
RENAMES = {
    "CMS_Cases": {"Incident_Date": "Date_of_Incident"},
    "CMS_IntakeDetails": {"Referral_Fee": "Referral_Fee_ID"},
    "CMS_PeopleType": {"People_Type_Id": "People_Type_ID"},
}


def warehouse_table(name: str) -> WarehouseTable:
    try:
        return WAREHOUSE[name]
    except KeyError:
        raise ConfigError(f"no declared table {name}") from None
