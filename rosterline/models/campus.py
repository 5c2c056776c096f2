"""Campus tables and the views shared by the plans.

Table and column names follow the student-information schema the plans work
on. Functions and views that the source system supplies from outside are
rebuilt here under stated assumptions:

* terms are numbered by their start day (``ordered_terms``);
* a display name is a pattern of name tokens (``functions.text.display_name``);
* the campus and the alternate address of a party are its newest active
  address of type Campus or Personal (``campus_emails``, ``email_top``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import NAME_TOKENS, blank_to_null, display_name
from ..operators import joins, keys, ranking
from ..operators.joins import SECTION_JOIN, SECTION_KEY
from ..sources.registry import TableRegistry

_KEY = ", ".join(f"{c} string" for c in SECTION_KEY)
_AUDIT = ", ".join(
    f"{k}_DATE date, {k}_TIME timestamp_ntz, {k}_OPID string, {k}_TERMINAL string" for k in ("CREATE", "REVISION")
) + ", ABT_JOIN string"
_CODE = "CODE_VALUE_KEY string, SHORT_DESC string, MEDIUM_DESC string, LONG_DESC string, CODE_XVAL string, STATUS string"

# Code tables that share one layout.
CODE_TABLES = (
    "CODE_COLLEGE", "CODE_CURRICULUM", "CODE_SALUTATION", "CODE_PREFIX", "CODE_CANCELREASON", "CODE_PROGRAM",
    "CODE_DEGREE", "CODE_VIOLATIONS", "CODE_RATING", "CODE_RESPONSE", "CODE_OFFICE",
)

# Table layouts (columns the plans read or write).
SCHEMAS: dict[str, str] = {
    "TRANSCRIPTDETAIL": f"TranscriptDetailId bigint, PEOPLE_CODE string, PEOPLE_ID string, PEOPLE_CODE_ID string, {_KEY}, TRANSCRIPT_SEQ string,"
    " EVENT_MED_NAME string, EVENT_LONG_NAME string, CREDIT_TYPE string, CREDIT decimal(19,4), FINAL_GRADE string,"
    " ADD_DROP_WAIT string, STATUS_DATE date",
    "ACADEMIC": "PEOPLE_ID string, PEOPLE_CODE_ID string, ACADEMIC_YEAR string, ACADEMIC_TERM string, ACADEMIC_SESSION string,"
    " TRANSCRIPT_SEQ string, PROGRAM string, DEGREE string, CURRICULUM string, DEPARTMENT string, CREDITS decimal(19,4),"
    " ENROLL_SEPARATION string, FULL_PART string, STATUS string, PRIMARY_FLAG string, ACADEMIC_FLAG string,"
    " GRADUATED string, NONTRAD_PROGRAM string",
    "SECTIONS": f"SectionId bigint, {_KEY}, EVENT_STATUS string, EVENT_MED_NAME string, EVENT_LONG_NAME string,"
    " ORG_CODE_ID string, PROGRAM string, COLLEGE string, DEPARTMENT string, CURRICULUM string, SCHEDULED_MEETINGS int,"
    " CREATE_DATE date, CREATE_TIME timestamp_ntz",
    "SECTIONSCHEDULE": f"SECTIONSCHEDULE_ID bigint, {_KEY}, DAY string, START_TIME timestamp_ntz, END_TIME timestamp_ntz,"
    " ROOM_ID string, CALENDARDET_EVENT_KEY bigint",
    "CALENDARDETAIL": f"EVENT_KEY bigint, {_KEY}",
    "CALENDAR": "CALENDAR_KEY bigint, EVENT_KEY bigint, CALENDAR_DATE date, DAY_OF_WEEK string, START_TIME timestamp_ntz,"
    " END_TIME timestamp_ntz, BUILDING_CODE string, ROOM_ID string, MEETING_TYPE string, EVENT_TYPE string",
    "SECTIONPER": f"PERSON_CODE_ID string, {_KEY}, PERCENTAGE decimal(19,4)",
    "FacultyAssistant": "AssistantId bigint, SectionId bigint, CanAccessOverallGrades boolean, CanSubmitOverallGrades boolean",
    "TRANATTENDANCE": f"TranAttendanceId bigint, PEOPLE_CODE string, PEOPLE_ID string, PEOPLE_CODE_ID string, {_KEY},"
    f" ATTENDANCE_DATE date, ATTENDANCE_STATUS string, COMMENTS string, CalendarKey bigint, {_AUDIT}",
    "TRANSCRIPTMARKETING": f"PEOPLE_CODE_ID string, {_KEY}, DROP_REASON string",
    "GRADEVALUES": "ACADEMIC_YEAR string, ACADEMIC_TERM string, CREDIT_TYPE string, GRADE string, WITHDRAWN_GRADE string",
    "ACADEMICCALENDAR": "ACADEMIC_YEAR string, ACADEMIC_TERM string, ACADEMIC_SESSION string, SessionPeriodId int,"
    " START_DATE date, END_DATE date, PRE_REG_DATE date, REG_DATE date, GRADE_PENALTY_DATE date, FIN_AID_YEAR string",
    "EVENT": "EVENT_ID string, PUBLICATION_NAME_1 string, EVENT_STATUS string, CURRICULUM string",
    "sectioncrosstally": "EVENT_ID string, EVENT_SUB_TYPE string, SECTION string",
    "VIOLATIONS": f"PEOPLE_CODE_ID string, {_KEY}, VIOLATION_DATE date, VIOLATION string, REPORTED_BY_ID string, COMMENTS string, {_AUDIT}",
    "STDDEGREQ": "PEOPLE_CODE_ID string, PROGRAM string, DEGREE string, CURRICULUM string, MATRIC_YEAR string, MATRIC_TERM string, RECORD_TYPE string",
    "STDDEGREQEVENT": "PEOPLE_CODE_ID string, PROGRAM string, DEGREE string, CURRICULUM string, MATRIC_YEAR string,"
    " MATRIC_TERM string, RECORD_TYPE string, EVENT_CLASS string, EVENT_ID string, EVENT_SUB_TYPE string, STATUS string, REQUIRED string",
    "DEGREQEVENT": "MATRIC_YEAR string, MATRIC_TERM string, CURRICULUM string, EVENT_ID string",
    "CartSection": "PersonId bigint, SectionId bigint",
    "PEOPLE": "PersonId bigint, PEOPLE_ID string, PEOPLE_CODE_ID string, PREFIX string, FIRST_NAME string, LAST_NAME_PREFIX string,"
    " LAST_NAME string, SUFFIX string, DISPLAY_NAME string, BIRTH_DATE date, PrimaryEmailId bigint, PrimaryPhoneId bigint",
    "PEOPLETYPE": "PEOPLE_ID string, PEOPLE_CODE_ID string, PEOPLE_TYPE string",
    "FACULTY": "PEOPLE_ID string",
    "ORGANIZATION": "ORG_CODE_ID string, PrimaryEmailId bigint",
    "EmailAddress": "EmailAddressId bigint, PeopleOrgCodeId string, PeopleOrgId string, Email string, EmailType string,"
    " IsActive string, CREATE_DATE date, CREATE_TIME timestamp_ntz",
    "PersonPhone": "PersonPhoneId bigint, PersonId bigint, PhoneType string, PhoneNumber string, CountryId int, Create_Date date, Create_Time timestamp_ntz",
    "DialingCodes": "CountryId int, Prefix int, NumberLength int, Created timestamp_ntz, Updated timestamp_ntz",
    "ADDRESSSCHEDULE": "SEQUENCE_NO bigint, PEOPLE_ORG_CODE_ID string, ADDRESS_TYPE string, START_DATE date, END_DATE date,"
    " STATUS string, RECURRING string, ADDRESS_LINE_1 string, ADDRESS_LINE_2 string, ADDRESS_LINE_3 string,"
    " ADDRESS_LINE_4 string, CITY string, STATE string, ZIP_CODE string, COUNTRY string, COUNTY string, NO_MAIL string",
    "ADDRESS": "PEOPLE_ORG_CODE_ID string, ADDRESS_TYPE string",
    "PersonUser": "PersonId bigint, UserName string, NonQualifiedUserName string",
    "Application": "ApplicationId int, Name string",
    "AppStore": "AppStoreId int, ApplicationId int, Mode int",
    "AppUser": "AppUserId bigint, ApplicationId int, UserName string, LoweredUserName string, Email string, LoweredEmail string,"
    " Password string, ChangePasswordAtNextLogon int, CreationAppStoreId int, AuthenticationAppStoreId int",
    "AppRole": "AppRoleId bigint, ApplicationId int, Name string",
    "AppUserRole": "AppUserId bigint, AppRoleId bigint",
    "AppClaim": "AppClaimId bigint, ApplicationId int, Name string",
    "AppRoleClaim": "AppRoleId bigint, AppClaimId bigint",
    "SiteMapRole": "SiteMapRoleId bigint, RoleName string, SortOrder int, IsCustom boolean",
    "SiteMapOption": "SiteMapOptionId bigint, LinkId string, ExternalLink string, IsCustom boolean",
    "SiteMapOptionDetail": "SiteMapOptionDetailId bigint, SiteMapOptionId bigint, LinkId string, ExternalLink string, IsCustom boolean",
    "SiteMapOptionRole": "SiteMapOptionId bigint, SiteMapRoleId bigint, IsVisible boolean",
    "SiteMapOptionDetailRole": "SiteMapOptionDetailId bigint, SiteMapRoleId bigint, IsVisible boolean",
    "ABT_USERS": "OPERATOR_ID string, PEOPLE_CODE_ID string, STATUS string",
    "ABT_USERPROFILE": "OPERATOR_ID string, PROFILE_CODE string",
    "ABT_PROFILE": "PROFILE_CODE string, PROFILE_NAME string",
    "PersonTypeRole": "RoleName string, PersonTypeId int",
    "CODE_RECORDTYPE": "RecordTypeId int, CODE_VALUE_KEY string, STATUS string",
    "ABT_SETTINGS": "AREA_NAME string, SECTION_NAME string, LABEL_NAME string, SETTING string",
    "InstitutionSetting": "AreaName string, SectionName string, LabelName string, Setting string, PersonId bigint,"
    " CreateDatetime timestamp_ntz, RevisionDatetime timestamp_ntz",
    "ACTION": "ACTION_ID string, ACTION_NAME string, OFFICE string, TYPE string, NOTE string, STATUS string, REQUIRED string, PRIORITY string, Instruction string",
    "ACTIONSCHEDULE": "ACTIONSCHEDULE_ID bigint, ACTION_ID string, PEOPLE_ORG_CODE string, PEOPLE_ORG_ID string,"
    " PEOPLE_ORG_CODE_ID string, REQUEST_DATE date, REQUEST_TIME timestamp_ntz, SCHEDULED_DATE date, EXECUTION_DATE date,"
    f" {_AUDIT}, ACTION_NAME string, OFFICE string, TYPE string, RESP_STAFF string, COMPLETED_BY string, REQUIRED string,"
    " PRIORITY string, RATING string, RESPONSE string, CONTACT string, SCHEDULED_TIME timestamp_ntz, NOTE string,"
    " UNIQUE_KEY string, COMPLETED string, WAIVED string, WAIVED_REASON string, CANCELED string, CANCELED_REASON string,"
    " NUM_OF_REMINDERS int, ACADEMIC_YEAR string, ACADEMIC_TERM string, ACADEMIC_SESSION string, RULE_ID int, SEQ_NUM int,"
    " DURATION string, DOCUMENT string, Instruction string",
    "MESSAGEQUEUE": "MESSAGEID bigint, MESSAGESOURCE string, SUBJECT string, BODY string, BODYFORMAT int, TIMESENT timestamp_ntz,"
    f" SENDER_EMAIL string, PEOPLECODEID string, HIDERECIPIENTS int, SENDTIME timestamp_ntz, STATUS string, {_AUDIT}",
    "MESSAGERECIPIENTS": f"MESSAGEID bigint, RECIPIENTTYPE string, EMAILADDRESS string, PEOPLECODEID string, {_AUDIT}",
    "STOPLIST": "PEOPLE_CODE string, PEOPLE_ID string, PEOPLE_CODE_ID string, STOP_REASON string, STOP_DATE date,"
    f" CLEARED string, CLEARED_DATE date, COMMENTS string, {_AUDIT}",
    "CODE_STOPLIST": f"CODE_VALUE string, {_CODE}, STOP_REGISTRATION string, STOP_GRADES string, SHOW_STOP_PICTURE string, CREATE_DATE timestamp_ntz",
    "CODE_ENROLLMENT": "CODE_VALUE_KEY string, REQUIRE_SEPDATE string",
    "CODE_EVENTSUBTYPE": "CODE_VALUE string, LONG_DESC string",
    "CODE_CHARGECREDIT": "CODE_VALUE_KEY string, CRG_CRD_DESC string, CRG_CRD_MED_DESC string",
    "PEOPLEORGBALANCE": "ID string, PEOPLE_ORG_CODE_ID string, ACADEMIC_YEAR string, ACADEMIC_TERM string, ACADEMIC_SESSION string, BALANCE_AMOUNT decimal(19,4)",
    "CHARGECREDIT": "CHARGECREDITNUMBER bigint, PEOPLE_ORG_CODE_ID string, ACADEMIC_YEAR string, ACADEMIC_TERM string,"
    " ACADEMIC_SESSION string, CHARGE_CREDIT_CODE string, CHARGE_CREDIT_TYPE string, AMOUNT decimal(19,4),"
    " ANTICIPATED_FLAG string, POSTED_FLAG string, BATCH string",
    "ChargeCreditTax": "CHARGECREDITNUMBER bigint, AMOUNT decimal(19,4)",
    "BATCHHEADER": "BATCH_NUMBER string, BATCH_TYPE string, TABLENAME string, DELETED_FLAG string, DELETED_DATE date, DELETE_OPID string",
    "InvoiceDetail": "InvoiceDetailId bigint, ChargeCreditNumber bigint",
    "ASSESSMENTRULE": "ASSESSMENT_RULE_ID bigint, ACADEMIC_YEAR string, ACADEMIC_TERM string, LONG_DESC string, SELECT_CRITERIA string,"
    " SECTION_FEE_FLAG string, OVERLOAD string, COURSE_CREDIT_BASE string",
    "ASSESSCHARGECREDIT": "ASSESSMENT_RULE_ID bigint, CHARGE_CREDIT_CODE string, PER_CREDIT_FLAT string, AMOUNT decimal(19,4)",
    "Reported1098TInformation": "ReportedInformationId bigint, TaxYear int, People_Code_Id string, NameLine1 string, Payment decimal(19,4), PaymentAdjustment decimal(19,4), Scholarship decimal(19,4)",
    "Reported1098TPeriodSummary": "ReportedPeriodSummaryId bigint, ReportedInformationId bigint, TaxYear int, AcademicYear string,"
    " AcademicTerm string, CumulativeChargesBilled decimal(19,4), CurrentPaymentsReported decimal(19,4)",
    "Reported1098TSummaryDetail": "ReportedSummaryDetailId bigint, ReportedPeriodSummaryId bigint, ChargeCreditNumber bigint, ChargeCreditCode string, Amount decimal(19,4)",
    "Reported1098TRefundCode": "ReportedRefundCodeId bigint, TaxYear int, ChargeCreditCode string",
    "ABT_OBJECTS": "OBJECT_NAME string, HELP_NAME string, REVISION_DATE date, REVISION_TIME timestamp_ntz, REVISION_OPID string",
    "ABT_TABLESECURITY": "SECURITY_ID string, TABLE_NAME string, EDIT_RIGHTS string, DELETE_RIGHTS string",
    "VISTAVIEW": "VIEW_ID bigint, VIEW_NAME string, VIEW_DB_NAME string, DESCRIPTION string, SYNTAX_ALTERED string, IS_DISTINCT string",
    **{
        f"VISTAVIEW{part}": "VIEW_ID bigint, SEQUENCE bigint"
        for part in ("COLUMNS", "COMPUTES", "CRITERIA", "GROUPS", "JOIN", "JOINCRITERIA", "SORT", "SYNTAX", "TABLES")
    },
    "PBCATCOL": "PBC_TNAM string, PBC_CNAM string",
    "PBCATTBL": "PBT_TNAM string",
    "ABT_TABLES": "TABLE_NAME string",
    **{name: _CODE for name in CODE_TABLES},
}


def dense_terms(calendar: DataFrame, order: Sequence[str], name: str = "TermId") -> DataFrame:
    """Terms numbered 1, 2, .. without gaps; one row per term, so the window is as small as the calendar."""
    return calendar.withColumn(name, F.dense_rank().over(Window.orderBy(*order)))


def ordered_terms(t: TableRegistry) -> DataFrame:
    terms = t["ACADEMICCALENDAR"].groupBy("ACADEMIC_YEAR", "ACADEMIC_TERM").agg(F.min("START_DATE").alias("_start"))
    return dense_terms(terms, ["_start", "ACADEMIC_YEAR", "ACADEMIC_TERM"]).drop("_start")


def settings(t: TableRegistry, area: str, section: str, label: str) -> DataFrame:
    return t["ABT_SETTINGS"].filter(
        (F.col("AREA_NAME") == area) & (F.col("SECTION_NAME") == section) & (F.col("LABEL_NAME") == label)
    ).select("SETTING")


# Where the current year and term are kept.
CURRENT_YEAR = ("ACA_RECORDS", "CURRENT_YT", "CURRENT_YEAR")
CURRENT_TERM = ("ACA_RECORDS", "CURRENT_YT", "CURRENT_TERM")


def current_term(t: TableRegistry) -> Column:
    """Predicate on ACADEMIC_YEAR and ACADEMIC_TERM: the current term. The settings are scalar subqueries."""
    return (F.col("ACADEMIC_YEAR") == settings(t, *CURRENT_YEAR).scalar()) & (
        F.col("ACADEMIC_TERM") == settings(t, *CURRENT_TERM).scalar()
    )


def current_term_id(t: TableRegistry) -> Column:
    return ordered_terms(t).filter(current_term(t)).select("TermId").scalar()


def academic(t: TableRegistry) -> DataFrame:
    """Academic rows with their TermId."""
    return t["ACADEMIC"].join(ordered_terms(t), ["ACADEMIC_YEAR", "ACADEMIC_TERM"])


def name_columns(people: DataFrame) -> dict[str, Column]:
    found = {token: F.col(c) for token, c in NAME_TOKENS.items() if c in people.columns}
    if "FN" in found:
        shown = [blank_to_null(found["DN"])] if "DN" in found else []
        found["DN"] = F.coalesce(*shown, found["FN"])
    return found


def person_names(t: TableRegistry, patterns: Mapping[str, str]) -> DataFrame:
    """PEOPLE_CODE_ID and one column per display pattern."""
    people = t["PEOPLE"]
    columns = name_columns(people)
    return people.select("PEOPLE_CODE_ID", *[display_name(p, columns).alias(n) for n, p in patterns.items()])


def _newest_email(t: TableRegistry, kind: str, name: str) -> DataFrame:
    rows = t["EmailAddress"].filter((F.col("IsActive") == "1") & (F.col("EmailType") == kind))
    order = F.struct(
        F.coalesce(F.date_diff(F.col("CREATE_DATE"), F.lit("1900-01-01").cast("date")), F.lit(-1)).alias("d"),
        F.col("CREATE_TIME").alias("t"),
    )
    newest = rows.groupBy("PeopleOrgCodeId").agg(F.max(order).alias("_best"))
    tied = rows.withColumn("_o", order).join(
        newest.withColumnRenamed("PeopleOrgCodeId", "_p"), (F.col("PeopleOrgCodeId") == F.col("_p")) & (F.col("_o") == F.col("_best"))
    )
    return tied.groupBy(F.col("PeopleOrgCodeId").alias("PEOPLE_ORG_CODE_ID")).agg(F.min("Email").alias(name))


def primary_emails(t: TableRegistry) -> DataFrame:
    """Primary address of each person or organisation."""
    parents = joins.coalesce_parents(
        t["EmailAddress"].select("EmailAddressId", "PeopleOrgCodeId", "Email"),
        t["PEOPLE"], t["ORGANIZATION"],
        {"PeopleOrgCodeId": ("PEOPLE_CODE_ID", "ORG_CODE_ID"), "EmailAddressId": ("PrimaryEmailId", "PrimaryEmailId")},
        ("PEOPLE_CODE_ID", "ORG_CODE_ID"), "PEOPLE_ORG_CODE_ID",
    )
    return parents.select("PEOPLE_ORG_CODE_ID", F.col("Email").alias("PrimaryEmail"))


def campus_emails(t: TableRegistry) -> DataFrame:
    return _newest_email(t, "Campus", "CampusEmail")


def alternate_emails(t: TableRegistry) -> DataFrame:
    """Newest active personal address of each party; equal stamps fall to the first address in order."""
    return _newest_email(t, "Personal", "AlternateEmail")


def email_top(t: TableRegistry) -> DataFrame:
    """Primary and best alternate address of each party that has a primary one."""
    return primary_emails(t).join(alternate_emails(t), "PEOPLE_ORG_CODE_ID", "left")


def section_meetings(t: TableRegistry, of_current_term: bool = False) -> DataFrame:
    """One row per registered student and meeting of an active section, of all terms or the current one.

    The joins run on the section key and the event key. A filter on TermId reaches the registrations alone; ``of_current_term`` limits
    registrations, sections and schedule before they meet.
    """
    wanted = current_term(t) if of_current_term else F.lit(True)
    registered = t["TRANSCRIPTDETAIL"].filter((F.col("ADD_DROP_WAIT") == "A") & wanted).select(
        "PEOPLE_CODE_ID", "PEOPLE_ID", *SECTION_KEY, "TRANSCRIPT_SEQ", "EVENT_MED_NAME", "EVENT_LONG_NAME"
    )
    sections = t["SECTIONS"].filter((F.col("EVENT_STATUS") == "A") & wanted).select(*SECTION_KEY, "SectionId", "COLLEGE", "DEPARTMENT")
    return (
        registered.join(ordered_terms(t), ["ACADEMIC_YEAR", "ACADEMIC_TERM"])
        .join(sections, SECTION_JOIN)
        .join(scheduled_meetings(t, of_current_term), SECTION_JOIN)
        .select(
            "PEOPLE_CODE_ID", "PEOPLE_ID", "TermId", *SECTION_KEY, "TRANSCRIPT_SEQ", "EVENT_MED_NAME", "EVENT_LONG_NAME",
            "COLLEGE", "DEPARTMENT", "REGULAR_DAY", "CALENDAR_DATE", "START_TIME", "END_TIME", "DAY_OF_WEEK",
            "BUILDING_CODE", "ROOM_ID", "SectionId", "SECTIONSCHEDULE_ID", "EVENT_KEY", "CALENDAR_KEY",
        )
    )


def scheduled_meetings(t: TableRegistry, of_current_term: bool = False) -> DataFrame:
    """Meetings of each section with its regular day."""
    schedule = t["SECTIONSCHEDULE"].filter(current_term(t) if of_current_term else F.lit(True)).select(
        *SECTION_KEY, F.col("DAY").alias("REGULAR_DAY"), "SECTIONSCHEDULE_ID", F.col("CALENDARDET_EVENT_KEY").alias("EVENT_KEY")
    )
    return schedule.join(t["CALENDARDETAIL"].select("EVENT_KEY"), "EVENT_KEY").join(t["CALENDAR"], "EVENT_KEY")


def codes(t: TableRegistry, tables: Sequence[str] = CODE_TABLES) -> DataFrame:
    """All code tables of the common layout in one frame."""
    out = None
    for name in tables:
        part = t[name].select(F.lit(name).alias("code_table"), "CODE_VALUE_KEY", "SHORT_DESC", "MEDIUM_DESC", "LONG_DESC", "CODE_XVAL", "STATUS")
        out = part if out is None else out.unionByName(part)
    return out


def chosen_persons(t: TableRegistry, who: str | DataFrame) -> DataFrame:
    """Requested persons with repaired keys; unknown persons drop out."""
    asked = t.spark.createDataFrame([(who,)], "typed string") if isinstance(who, str) else who.toDF("typed")
    fixed = keys.fix_person_id(asked, "typed", t["PEOPLE"], "PEOPLE_CODE_ID", "PEOPLE_CODE_ID")
    return fixed.filter(F.col("PEOPLE_CODE_ID").isNotNull()).select("PEOPLE_CODE_ID")


def of_persons(t: TableRegistry, df: DataFrame, who: str | DataFrame | None, column: str = "PEOPLE_CODE_ID") -> DataFrame:
    """Rows of the requested persons; everyone's when none is requested."""
    return df if who is None else joins.semi(df, chosen_persons(t, who), {column: "PEOPLE_CODE_ID"})


def withdrawn_grades(t: TableRegistry) -> DataFrame:
    return t["GRADEVALUES"].filter(F.col("WITHDRAWN_GRADE") == "Y").select("ACADEMIC_YEAR", "ACADEMIC_TERM", "CREDIT_TYPE", "GRADE")


def not_withdrawn(t: TableRegistry, rows: DataFrame) -> DataFrame:
    """Drop rows whose final grade is a withdrawal grade of that year, term and credit type (three-valued)."""
    return joins.not_in_per_group(
        rows, "FINAL_GRADE", withdrawn_grades(t), "GRADE", ["ACADEMIC_YEAR", "ACADEMIC_TERM", "CREDIT_TYPE"]
    )
