"""Reports: schedule conflicts, plan demand and progress, rules, stop reasons, value search, status."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import decode, text_between
from ..models import campus as m
from ..operators import aggregates, filters, joins
from ..operators.joins import SECTION_JOIN, SECTION_KEY
from ..sources.registry import TableRegistry, find_value as search_tables
from ..staging import stage


def _meetings_of(who: DataFrame, person: str, meetings: DataFrame) -> DataFrame:
    """Meetings of each person's sections as intervals, with what the conflict reports show."""
    rows = who.join(meetings, SECTION_JOIN)
    start, end = dates.on_date("CALENDAR_DATE", "START_TIME"), dates.on_date("CALENDAR_DATE", "END_TIME")
    return rows.select(
        F.col(person).alias("PEOPLE_CODE_ID"), "ACADEMIC_YEAR", "ACADEMIC_TERM", "EVENT_ID", "EVENT_SUB_TYPE", "SECTION",
        F.col("REGULAR_DAY").alias("DAY"), "DAY_OF_WEEK", "CALENDAR_KEY", start.alias("Start"), end.alias("End"),
        (dates.minutes_between("START_TIME", "END_TIME") > 10).alias("_sync"),
    )


def _conflicts(t: TableRegistry, who: DataFrame, person: str, year: str | None, term: str | None) -> DataFrame:
    """Overlapping meetings of one person; only the first side is limited to the term.

    Meetings begin and end on their day, so only the days of the term matter: the calendar is staged once, its range of
    days prunes it, persons' sections of terms without a meeting on those days are left out before they are moved, and the persons'
    meetings on those days are staged for both sides of the join.
    """
    in_term = filters.optional_equals({"ACADEMIC_YEAR": year, "ACADEMIC_TERM": term})
    limited = filters.given(year) or filters.given(term)
    meetings = m.scheduled_meetings(t)
    if limited:
        meetings = stage(meetings, "meetings")
        days = meetings.filter(in_term).agg(F.min("CALENDAR_DATE").alias("lo"), F.max("CALENDAR_DATE").alias("hi"))
        meetings = meetings.filter(F.col("CALENDAR_DATE").between(days.select("lo").scalar(), days.select("hi").scalar()))
        who = joins.among_few(who, meetings, ["ACADEMIC_YEAR", "ACADEMIC_TERM"])
    rows = stage(_meetings_of(who, person, meetings).withColumn("_listed", in_term if limited else F.lit(True)), "persons-meetings")
    pairs = joins.overlap_pairs(
        rows, "PEOPLE_CODE_ID", "Start", "End", "CALENDAR_KEY",
        carry=["EVENT_ID", "EVENT_SUB_TYPE", "SECTION", "DAY", "DAY_OF_WEEK", "_sync", "_listed"],
    ).filter("_listed1")
    asynchronous = F.when(F.col("_sync1") | F.col("_sync2"), "N").otherwise("Y")
    return pairs.withColumn("Async", asynchronous).drop("_sync1", "_sync2", "_listed1", "_listed2")


def student_conflicts(t: TableRegistry, year: str | None = None, term: str | None = None) -> DataFrame:
    registered = t["TRANSCRIPTDETAIL"].filter(F.col("ADD_DROP_WAIT") == "A").select("PEOPLE_CODE_ID", *SECTION_KEY)
    return _conflicts(t, registered, "PEOPLE_CODE_ID", year, term)


def instructor_conflicts(t: TableRegistry, year: str | None = None, term: str | None = None) -> DataFrame:
    assigned = t["SECTIONPER"].select("PERSON_CODE_ID", *SECTION_KEY)
    return _conflicts(t, assigned, "PERSON_CODE_ID", year, term)


def conflicts_on_days(conflicts: DataFrame, days: Sequence[date | str] = (), day_pair: tuple[str, str] | None = None) -> DataFrame:
    """Synchronous conflicts per person, optionally on given days and between two regular weekdays."""
    test = F.col("Async") == "N"
    if days:
        test = test & F.col("Start1").cast("date").isin(*[dates.day(d) for d in days])
    if day_pair:
        test = test & (F.col("DAY1") == day_pair[0]) & (F.col("DAY2") == day_pair[1])
    return conflicts.filter(test).groupBy("PEOPLE_CODE_ID").agg(F.count("*").alias("Conflicts")).orderBy("PEOPLE_CODE_ID", "Conflicts")


def _on_regular_days(conflicts: DataFrame) -> DataFrame:
    return conflicts.filter(
        (F.col("Async") == "N") & (F.substring("DAY1", 1, 3) == F.col("DAY_OF_WEEK1")) & (F.substring("DAY2", 1, 3) == F.col("DAY_OF_WEEK2"))
    )


def _with_curricula(t: TableRegistry, rows: DataFrame) -> DataFrame:
    event = t["EVENT"].select("EVENT_ID", "CURRICULUM")
    rows = joins.lookup(rows, event, {"EVENT_ID1": "EVENT_ID"}, {"CURRICULUM1": "CURRICULUM"})
    return joins.lookup(rows, event, {"EVENT_ID2": "EVENT_ID"}, {"CURRICULUM2": "CURRICULUM"})


def conflicts_student(t: TableRegistry, year: str | None = None, term: str | None = None) -> DataFrame:
    """Pairs of sections that conflict on their regular days, with the number of students concerned."""
    counted = _on_regular_days(student_conflicts(t, year, term)).groupBy("EVENT_ID1", "SECTION1", "EVENT_ID2", "SECTION2").agg(
        F.count_distinct("PEOPLE_CODE_ID").alias("Students")
    )
    return _with_curricula(t, counted).select(
        "Students", "EVENT_ID1", "SECTION1", "CURRICULUM1", "EVENT_ID2", "SECTION2", "CURRICULUM2"
    ).orderBy(F.col("Students").desc(), "EVENT_ID1", "EVENT_ID2")


def conflicts_instructor(t: TableRegistry, year: str | None = None, term: str | None = None) -> DataFrame:
    """Pairs of sections of one instructor that conflict, less cross-tallied first sections."""
    rows = _on_regular_days(instructor_conflicts(t, year, term))
    crossed = {"EVENT_ID1": "EVENT_ID", "EVENT_SUB_TYPE1": "EVENT_SUB_TYPE", "SECTION1": "SECTION"}
    rows = joins.anti(rows, t["sectioncrosstally"], crossed).select(
        "PEOPLE_CODE_ID", "EVENT_ID1", "SECTION1", "EVENT_ID2", "SECTION2"
    ).distinct()
    rows = joins.lookup(rows, m.person_names(t, {"Name": "DN |LN"}), {"PEOPLE_CODE_ID": "PEOPLE_CODE_ID"}, {"Name": "Name"})
    return _with_curricula(t, rows).select(
        "PEOPLE_CODE_ID", "Name", "EVENT_ID1", "SECTION1", "CURRICULUM1", "EVENT_ID2", "SECTION2", "CURRICULUM2"
    ).orderBy("PEOPLE_CODE_ID", "EVENT_ID1", "EVENT_ID2")


def _plan_rows(t: TableRegistry, year: str, curriculum: str | None) -> DataFrame:
    """Required plan courses of enrolled students; one row per matching academic record."""
    plan = ["PEOPLE_CODE_ID", "PROGRAM", "DEGREE", "CURRICULUM"]
    full = [*plan, "MATRIC_YEAR", "MATRIC_TERM", "RECORD_TYPE"]
    head = t["STDDEGREQ"].filter((F.col("RECORD_TYPE") == "A") & filters.optional_equals({"CURRICULUM": curriculum})).select(*full)
    courses = t["STDDEGREQEVENT"].filter(F.col("REQUIRED") == "Y").select(*full, "EVENT_CLASS", "EVENT_ID", "EVENT_SUB_TYPE", "STATUS")
    enrolled = t["ACADEMIC"].filter(
        (F.col("ACADEMIC_YEAR") == year) & (F.col("ENROLL_SEPARATION") == "ENRL") & (F.col("ACADEMIC_FLAG") == "Y")
    ).select(*plan)
    return head.join(courses, full).join(enrolled, plan)


def plan_demand(t: TableRegistry, year: str, curriculum: str | None = None) -> DataFrame:
    """Courses taken and needed per curriculum; sub-types count apart but are not shown."""
    status = F.col("STATUS")
    grouped = aggregates.group_hidden(
        _plan_rows(t, year, curriculum), ["CURRICULUM", "EVENT_CLASS", "EVENT_ID"], ["EVENT_SUB_TYPE"],
        Taken=aggregates.sum_when(status.isin("C", "P")), Needed=aggregates.sum_when(status.isin("X", "Z")),
    )
    return grouped.withColumnRenamed("Taken", "Taken/In Progress").orderBy("EVENT_CLASS", "EVENT_ID")


# Wording of plan course states; a planned course has none.
PLAN_STATES = {"C": "Complete", "P": "In Progress", "X": "Fail", "Z": None}


def plan_progress(t: TableRegistry, year: str, curriculum: str | None = None) -> DataFrame:
    return _plan_rows(t, year, curriculum).select(
        "PEOPLE_CODE_ID", "CURRICULUM", "EVENT_CLASS", "EVENT_ID", decode("STATUS", PLAN_STATES).alias("Status")
    ).orderBy("PEOPLE_CODE_ID", "EVENT_CLASS", "EVENT_ID")


# Fixed value: the call whose argument holds the billing credits of a rule.
BILLING_MARKER = "STUDENTFINANCIAL.CREDIT_BILLING"


def billing_rules(t: TableRegistry) -> DataFrame:
    rules = t["ASSESSMENTRULE"].filter(F.col("SECTION_FEE_FLAG") == "N")
    charge = t["CODE_CHARGECREDIT"].withColumnRenamed("CODE_VALUE_KEY", "CHARGE_CREDIT_CODE")
    return rules.join(t["ASSESSCHARGECREDIT"], "ASSESSMENT_RULE_ID").join(charge, "CHARGE_CREDIT_CODE").select(
        "ASSESSMENT_RULE_ID", "ACADEMIC_YEAR", "ACADEMIC_TERM", "LONG_DESC",
        text_between("SELECT_CRITERIA", BILLING_MARKER, ")").alias("Billing Credits Filter"),
        "PER_CREDIT_FLAT", "AMOUNT", "CHARGE_CREDIT_CODE", "CRG_CRD_DESC", "CRG_CRD_MED_DESC", "OVERLOAD", "COURSE_CREDIT_BASE",
    )


# Wording of flags and states.
YES_NO = {"Y": "Yes", "N": "No"}
ACTIVE_STATES = {"A": "Active", "I": "Inactive"}


def stop_reasons(t: TableRegistry) -> DataFrame:
    flags = [decode(c, YES_NO).alias(c) for c in ("STOP_REGISTRATION", "STOP_GRADES", "SHOW_STOP_PICTURE")]
    return t["CODE_STOPLIST"].select(
        "CODE_VALUE", "SHORT_DESC", "MEDIUM_DESC", F.col("LONG_DESC").alias("Message"), *flags,
        F.col("CREATE_DATE").cast("date").alias("CREATE_DATE"), decode("STATUS", ACTIVE_STATES).alias("Status"),
    )


# Tables that have a term but no year, limited by term alone.
TERM_ONLY_TABLES = {"EVENTSESSIONS": ["ACADEMIC_TERM"], "EVENTSCHEDULE": ["ACADEMIC_TERM"]}


def find_value(
    t: TableRegistry, names: Sequence[str], column: str, value: str, year: str | None = None, term: str | None = None, all_tables: bool = False
) -> DataFrame:
    """Tables in which a column of that name, or a code key, holds the value."""
    scope = {"ACADEMIC_YEAR": year, "ACADEMIC_TERM": term} if filters.given(year) and filters.given(term) else None
    return search_tables({n: t[n] for n in names}, value, [column, "CODE_VALUE_KEY"], scope, TERM_ONLY_TABLES, all_tables)


def find_value_rows(t: TableRegistry, name: str, column: str, value: str, year: str | None = None, term: str | None = None) -> DataFrame:
    """The matching rows of one found table."""
    df = t[name]
    held = TERM_ONLY_TABLES.get(name, ["ACADEMIC_YEAR", "ACADEMIC_TERM"])
    limits = {c: v for c, v in {"ACADEMIC_YEAR": year, "ACADEMIC_TERM": term}.items() if c in held and c in df.columns}
    return df.filter(filters.optional_equals(limits) & (F.col(column) == value)).select(F.lit(name).alias("TableName"), "*")


def _operator_people(t: TableRegistry, person_ids: Sequence[str] | DataFrame | None) -> DataFrame:
    people = t["PEOPLE"].select("PersonId", "PEOPLE_ID", "PEOPLE_CODE_ID", "FIRST_NAME", "LAST_NAME")
    if isinstance(person_ids, DataFrame):
        people = joins.semi(people, person_ids.toDF("PEOPLE_ID"), ["PEOPLE_ID"])
    elif person_ids is not None:
        people = people.filter(F.col("PEOPLE_ID").isin(*person_ids))
    return people.join(t["PersonUser"], "PersonId")


def operator_people(t: TableRegistry, person_ids=None) -> DataFrame:
    users = t["ABT_USERS"].select("PEOPLE_CODE_ID", "OPERATOR_ID", "STATUS")
    return _operator_people(t, person_ids).join(users, "PEOPLE_CODE_ID", "left").select(
        "PEOPLE_ID", "PersonId", "FIRST_NAME", "LAST_NAME", "UserName", "NonQualifiedUserName", "OPERATOR_ID", "STATUS"
    )


def operator_diff(t: TableRegistry, person_ids=None) -> DataFrame:
    """Profiles of the chosen operators: held by one of them only, or shared."""
    operators = _operator_people(t, person_ids).join(t["ABT_USERS"].select("PEOPLE_CODE_ID", "OPERATOR_ID"), "PEOPLE_CODE_ID")
    held = operators.select("OPERATOR_ID").distinct().join(t["ABT_USERPROFILE"], "OPERATOR_ID", "left")
    # An operator without profiles shows one empty row of its own.
    bare = held.filter(F.col("PROFILE_CODE").isNull()).select(
        "PROFILE_CODE", F.concat(F.lit("Only "), F.col("OPERATOR_ID")).alias("status")
    )
    shared = joins.side_difference(held.filter(F.col("PROFILE_CODE").isNotNull()), "OPERATOR_ID", ["PROFILE_CODE"])
    diff = shared.unionByName(bare).withColumnRenamed("status", "Status")
    return joins.lookup(diff, t["ABT_PROFILE"], {"PROFILE_CODE": "PROFILE_CODE"}, {"PROFILE_NAME": "PROFILE_NAME"}).select(
        "PROFILE_CODE", "PROFILE_NAME", "Status"
    )


def operator_offices(t: TableRegistry, person_ids=None) -> DataFrame:
    """Offices switched on for the chosen operators: one only, or shared."""
    operators = _operator_people(t, person_ids).join(t["ABT_USERS"].select("PEOPLE_CODE_ID", "OPERATOR_ID"), "PEOPLE_CODE_ID")
    on = t["ABT_SETTINGS"].filter(F.col("SETTING") == "Y").select(F.col("SECTION_NAME").alias("OPERATOR_ID"), F.col("LABEL_NAME").alias("Office"))
    held = operators.select("OPERATOR_ID").distinct().join(on, "OPERATOR_ID")
    diff = joins.side_difference(held, "OPERATOR_ID", ["Office"]).withColumnRenamed("status", "Status")
    return joins.lookup(diff, t["CODE_OFFICE"], {"Office": "CODE_VALUE_KEY"}, {"SHORT_DESC": "SHORT_DESC"}).select("Office", "SHORT_DESC", "Status")


def action_status(t: TableRegistry, as_of: date) -> DataFrame:
    """Every scheduled action with its derived state."""
    status = filters.action_status(
        F.col("EXECUTION_DATE"), F.coalesce(F.col("CANCELED") == "Y", F.lit(False)), F.coalesce(F.col("WAIVED") == "Y", F.lit(False)),
        F.col("SCHEDULED_DATE"), dates.day(as_of),
    )
    return t["ACTIONSCHEDULE"].select("ACTIONSCHEDULE_ID", "PEOPLE_ORG_CODE_ID", "ACTION_ID", status.alias("ACTION_STATUS"))
