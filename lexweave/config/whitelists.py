"""Default field whitelists.

Section forms and collections differ per practice, so they default to every
field their metadata declares; ``load_whitelist`` reads a tenant's own list.
"""

from __future__ import annotations

from lexweave.config.model import Section, Whitelist

# Whitelisted fields of the case system's core entities.
CONTACT = (
    "personId firstName lastName isSingleName fullName primaryEmail primaryEmailLabel pictureUrl "
    "pictureKey ssn birthDate notes isTextingPermitted remarket personTypes isMinor uniqueId "
    "searchNames"
)
PROJECT_TYPE = "projectTypeId name phases"
PROJECT = (
    "projectTypeCode rootDocFolderId phaseName clientName clientPictureURL clientPictureKey "
    "firstPrimaryName firstPrimaryUsername isArchived lastActivity uniqueKey projectOrClientName "
    "hashtags orgId projectEmailAddress projectUrl projectId projectTypeId clientId projectName "
    "phaseId incidentDate links"
)

# Whitelisted fields of the lead system's entities.
LEAD_ENTITIES = {
    "statuses": "Id Status StatusName Substatuses",
    "leadsource": "Id SourceName",
    "casetype": "Id TypeName TypeNameShort Code IsMassTort CustomQuestionOrder",
    "leadrow": (
        "Id ContactId PhoneNumber MobilePhone HomePhone WorkPhone PreferredContactMethod Email "
        "FirstName LastName StatusId StatusName SubStatusId SubStatusName CaseType Code "
        "LastStatusChangeDate"
    ),
    "leaddetail": (
        "Id Summary InjuryInformation Status SubStatus SeverityLevel Code Contact PracticeArea "
        "MarketingSource ContactSource TalkedToOtherAttorneys FoundUsNotes UTM CurrentUrl "
        "ReferringUrl ClickId ClientId Keywords Campaign AppointmentLocation Office OfficeCode "
        "ReferredTo ReferredByName ReferredBy CreatedDate IncidentDate RejectedDate ReferredDate "
        "AssignedDate AppointmentScheduledDate ChaseDate SignedUpDate CaseClosedDate LostDate "
        "UnderReviewDate PendingSignupDate HoldDate Intake Paralegal Investigator Attorney "
        "AssignedTo Creator RelatedContacts Messages Notes Opportunity PhoneCall CustomFields "
        "Settlements"
    ),
    "contact": (
        "Id FirstName MiddleName LastName Address1 Address2 City State Zip County HomePhone "
        "MobilePhone WorkPhone Email PreferredContactMethod Birthdate Longitude Latitude "
        "SubscribeToMailingList BadAddress Deceased Gender Minor Language Code DoNotText "
        "CreatedOn CreatedBy PendingGeocode LeadIds CustomFields"
    ),
    "opportunities": (
        "Id FirstName MiddleName LastName Address1 Address2 City State Zip HomePhone WorkPhone "
        "MobilePhone Email Gender Language Birthdate PreferredContactMethod LeadStatus SubStatus "
        "Office MarketingSource MarketingSourceDetails ContactSource Summary InjuryInformation "
        "IncidentDate CreatedDate LeadId Note ReferredBy SeverityLevel County AppointmentLocation "
        "AppointmentScheduledDate Code ReferringUrl CurrentUrl UTM ClientId ClickId Keywords "
        "Campaign Processed ProcessedDate ProcessedByName OpportunityTypeId DisregardReason "
        "IsBeingEdited CustomFields AssignedTo ProcessedBy"
    ),
    "referrals": "Id Name Type Code Outgoing",
    "users": "Id FirstName LastName Email Code Roles Permissions",
}


def _section(name: str, fields: str) -> Section:
    return Section(name, tuple(fields.split()))


def case_whitelist(org_id: int | str | None = None) -> Whitelist:
    return Whitelist(
        org_id,
        {
            "contact": _section("contact", CONTACT),
            "projecttype": _section("projecttype", PROJECT_TYPE),
            "project": _section("project", PROJECT),
        },
    )


def lead_whitelist(org_name: str | None = None) -> Whitelist:
    return Whitelist(org_name, {n: _section(n, f) for n, f in LEAD_ENTITIES.items()})
