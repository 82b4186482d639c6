"""The standard model: which target column comes from which source field.

Fixed values: target names, types and source fields are a data contract. Every
table also starts with the two tenant columns, whose names are a setting.
"""

from __future__ import annotations

from lexweave.config.model import Mapping, TargetField, TargetTable, unique_targets

ORG_COLUMNS = ("Platform_Org_ID", "Client_Org_ID")

CUSTOM = [("Custom1", "string"), ("Custom2", "string"), ("Custom3", "string")]

# Fixed values: (target column, target type[, source field]).
TABLES = {
    "PeopleType": ("contact", [
        ("People_Type_ID", "int"),
        ("People_Type", "string", "personTypes"),
        ("People_Sub_Type", "string"),
        *CUSTOM,
    ]),
    "Peoples": ("contact", [
        ("People_ID", "int", "personId"),
        ("People_Type_ID", "int", "personTypes"),
        ("First_Name", "string", "firstName"),
        ("Middle_Name", "string"),
        ("Last_Name", "string", "lastName"),
        ("Date_of_Birth", "date"),
        ("Gender", "string"),
        *CUSTOM,
    ]),
    "Cases": ("project", [
        ("Case_ID", "int", "projectId"),
        ("Practice_Type_ID", "int", "projectTypeId"),
        ("Is_Archived", "boolean", "isArchived"),
        ("Incident_Date", "date", "incidentDate"),
    ]),
    "PracticeTypes": ("projecttype", [
        ("Practice_Type_ID", "int", "projectTypeId"),
        ("Practice_Type_Name", "string", "name"),
        *CUSTOM,
    ]),
    "Phases": ("phases", [
        ("Phase_ID", "int", "phaseId"),
        ("Phase_Name", "string", "name"),
        ("Practice_Type_ID", "int", "projectTypeId"),
        ("Phase_Order", "string"),
        ("Phase_Category", "string"),
        ("Phase_Sub_Category", "string"),
        *CUSTOM,
    ]),
    "CaseDetails": ("casesummary", [
        ("Parent_Case_ID", "int", "projectId"),
        ("Case_ID", "int", "projectId"),
        ("Case_Type_ID", "int"),
        ("Case_Create_Date", "date"),
        ("Date_of_Incident", "date", "dateOfIncident"),
        ("Case_Name", "string"),
        ("Plaintiff_Full_Name", "string"),
        ("Attorney_ID", "int", "primaryattorney"),
        ("Prelitigation_Paralegal_ID", "int", "paralegal"),
        ("Litigation_Paralegal_ID", "int", "paralegal"),
        ("CaseManager_ID", "int", "casemanager"),
        ("Cocounsel_ID", "int", "cocounsel"),
        ("Case_Team_ID", "int"),
        ("Insurance_ID", "int"),
        ("Case_Status_ID", "int"),
        ("Case_Marketing_Source", "string"),
        ("Case_Source_Name", "string"),
        ("Attorney_Fee_Percentage", "float", "attorneysFeesAmount"),
        ("Projected_Settlement_Date", "date", "projectedsettlementdate"),
        ("Projected_Settlement_Amount", "float", "projectedsettlementgoal"),
        ("Actual_Settlement_Date", "date", "settlementdate"),
        ("Actual_Settlement_Amount", "float", "actualsettlementamount"),
        ("If_Case_Settled_Presuit", "boolean", "caseSettledPresuit"),
        ("If_VIP_Case", "boolean", "vIPCase"),
        ("If_Case_Referred_Out", "boolean"),
        ("Case_Phase_ID", "int"),
        *CUSTOM,
        ("Custom4", "string"),
        ("Custom5", "string"),
    ]),
    "CaseFigures": ("meds", [
        ("Parent_Case_ID", "int", "projectId"),
        ("Case_ID", "int", "projectId"),
        ("Case_Figure_ID", "int"),
        ("Figure_Type", "string", "type"),
        ("Figure_Date", "date", "recordsordereddate"),
        ("Figure_Status", "string"),
        ("Value", "float", "valueTotal"),
        *CUSTOM,
    ]),
    "IntakeDetails": ("intake", [
        ("Parent_Case_ID", "int", "projectId"),
        ("Case_ID", "int", "projectId"),
        ("Intake_ID", "int", "projectId"),
        ("Person_Performing_Intake_ID", "int", "personperformingintake"),
        ("Intake_Source", "string"),
        ("Date_of_Intake", "date", "dateofintake"),
        ("Date_of_Incident", "date", "dateofincident"),
        ("DUI_or_HitandRun", "string", "dUIOrHItAndRun"),
        ("Referral_Fee", "double", "referralfee"),
        ("If_Case_Referred_In", "boolean"),
        ("If_Qualified_Case", "boolean"),
        ("If_VIP_Lead", "boolean"),
        *CUSTOM,
    ]),
}


def standard_mapping(
    org_id: int | str | None = None, org_columns: tuple[str, str] = ORG_COLUMNS
) -> Mapping:
    """The mapping above for one tenant, with the tenant columns named as asked."""
    tenant = tuple(TargetField(name, "int", kind="org") for name in org_columns)
    tables = {}
    for name, (entity, columns) in TABLES.items():
        fields = tuple(
            TargetField(c[0], c[1], c[2], "data") if len(c) == 3 else TargetField(c[0], c[1])
            for c in columns
        )
        tables[name] = unique_targets(TargetTable(name, entity, tenant + fields))
    return Mapping(org_id, tables)
