"""The campus plans over tables derived from the star schema, each with its SQL check."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models import campus as m
from ..operators import sets
from ..plans import identity, lookups, metadata, notices, quality, reports, writers
from ..sources.registry import TableRegistry
from .base import ORACLES, QUERIES, portable, portable_sql
from .campus_tables import campus, with_tables

SUNDAY, TUESDAY = date(1999, 11, 21), date(1999, 11, 23)
NOW = datetime(1999, 11, 23, 9, 30)

# The same plans' checks over plain campus names, for fixture tables.
PLAIN: dict[str, str] = {}
PLANS: dict[str, object] = {}


def plan(sql: str | None = None, texts: Sequence[str] = (), numbers: Sequence[str] = ()):
    def wrap(fn):
        name = f"campus_{fn.__name__}"
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: portable(fn(campus(spark, sf_dir)), texts, numbers)
        PLANS[name] = fn
        if sql is not None:
            ORACLES[name] = portable_sql(with_tables(sql), texts, numbers)
            PLAIN[name] = sql
        return fn

    return wrap


KEY6 = "ACADEMIC_YEAR, ACADEMIC_TERM, ACADEMIC_SESSION, EVENT_ID, EVENT_SUB_TYPE, SECTION"
OT = """ot AS (SELECT ACADEMIC_YEAR, ACADEMIC_TERM, dense_rank() OVER (ORDER BY min(START_DATE), ACADEMIC_YEAR, ACADEMIC_TERM) AS TermId
  FROM ACADEMICCALENDAR GROUP BY ACADEMIC_YEAR, ACADEMIC_TERM)"""
CUR = """cur AS (SELECT (SELECT SETTING FROM ABT_SETTINGS WHERE LABEL_NAME = 'CURRENT_YEAR') AS cy, (SELECT SETTING FROM ABT_SETTINGS WHERE LABEL_NAME = 'CURRENT_TERM') AS ct)"""
CURID = f"{OT}, {CUR}, curid AS (SELECT TermId AS cid FROM ot JOIN cur ON ACADEMIC_YEAR = cy AND ACADEMIC_TERM = ct)"
PRIM = """prim AS (SELECT coalesce(p.PEOPLE_CODE_ID, o.ORG_CODE_ID) AS pid, e.Email AS PrimaryEmail FROM EmailAddress e
  LEFT JOIN PEOPLE p ON p.PEOPLE_CODE_ID = e.PeopleOrgCodeId AND p.PrimaryEmailId = e.EmailAddressId
  LEFT JOIN ORGANIZATION o ON o.ORG_CODE_ID = e.PeopleOrgCodeId AND o.PrimaryEmailId = e.EmailAddressId
  WHERE p.PEOPLE_CODE_ID IS NOT NULL OR o.ORG_CODE_ID IS NOT NULL)"""


def newest(kind: str, name: str) -> str:
    return f"""{name.lower()} AS (SELECT pid, {name} FROM (SELECT PeopleOrgCodeId AS pid, Email AS {name},
  row_number() OVER (PARTITION BY PeopleOrgCodeId ORDER BY CREATE_DATE DESC NULLS LAST, CREATE_TIME DESC NULLS LAST, Email) AS rn
  FROM EmailAddress WHERE IsActive = '1' AND EmailType = '{kind}') WHERE rn = 1)"""


ALT = newest("Personal", "AlternateEmail")
CAMP = newest("Campus", "CampusEmail")
FULL = "coalesce(nullif(rtrim(p.DISPLAY_NAME), ''), p.FIRST_NAME) || ' ' || p.LAST_NAME"
FIRST = "coalesce(nullif(rtrim(p.DISPLAY_NAME), ''), p.FIRST_NAME)"


def money(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN '-' ELSE '' END || '$' || format('{{:,.2f}}', CAST(abs({c}) AS DOUBLE))"


# ---------------------------------------------------------------- look-ups


@plan("""SELECT ACTION_ID, ACTION_NAME, ACTION_NAME || ' (' || ACTION_ID || ')' AS NameCode, ACTION_ID || ' - ' || ACTION_NAME AS CodeName, OFFICE, TYPE, NOTE
FROM ACTION WHERE OFFICE = 'REG' AND STATUS = 'A'""")
def action_codes(t: TableRegistry) -> DataFrame:
    return lookups.action_codes(t, "REG", "")


@plan(f"""SELECT BalanceId, PEOPLE_CODE_ID, ACADEMIC_YEAR, ACADEMIC_TERM, BALANCE_AMOUNT, {money('BALANCE_AMOUNT')} AS BalanceFormatted,
  AnticBalance, {money('AnticBalance')} AS AnticBalanceFormatted FROM (
  SELECT ID AS BalanceId, PEOPLE_ORG_CODE_ID AS PEOPLE_CODE_ID, ACADEMIC_YEAR, ACADEMIC_TERM, BALANCE_AMOUNT,
    CAST(BALANCE_AMOUNT - coalesce((SELECT sum(AMOUNT) FROM CHARGECREDIT c WHERE c.PEOPLE_ORG_CODE_ID = b.PEOPLE_ORG_CODE_ID AND c.ANTICIPATED_FLAG = 'Y' AND c.CHARGE_CREDIT_TYPE = 'F'
      AND c.ACADEMIC_YEAR = b.ACADEMIC_YEAR AND c.ACADEMIC_TERM = b.ACADEMIC_TERM AND c.ACADEMIC_SESSION = b.ACADEMIC_SESSION), 0) AS DECIMAL(19, 4)) AS AnticBalance
  FROM PEOPLEORGBALANCE b)""", numbers=["BALANCE_AMOUNT", "AnticBalance"])
def balance_detail(t):
    return lookups.balance_detail(t)


@plan("""SELECT CODE_VALUE_KEY, SHORT_DESC, MEDIUM_DESC, LONG_DESC, CODE_XVAL FROM CODE_CURRICULUM WHERE (CODE_XVAL = 'P900000001' OR CODE_XVAL = '') AND STATUS = 'A'""")
def code_values(t):
    return lookups.code_values(t, "CODE_CURRICULUM", "", "P900000001")


@plan("SELECT EVENT_ID || ' - ' || PUBLICATION_NAME_1 AS CourseName FROM EVENT WHERE PUBLICATION_NAME_1 <> '' AND EVENT_STATUS = 'A'")
def course_catalog(t):
    return lookups.course_catalog(t)


@plan(f"""WITH {PRIM} SELECT p.PEOPLE_CODE_ID, p.LAST_NAME AS LastName, p.FIRST_NAME AS FirstName, PrimaryEmail FROM FACULTY f
JOIN PEOPLETYPE pt ON pt.PEOPLE_ID = f.PEOPLE_ID AND pt.PEOPLE_TYPE = 'FAC' JOIN PEOPLE p ON p.PEOPLE_ID = f.PEOPLE_ID LEFT JOIN prim ON pid = p.PEOPLE_CODE_ID""")
def faculty_directory(t):
    return lookups.faculty_directory(t)


@plan(f"""WITH {CURID}
SELECT FacultyId, SectionId, s.ACADEMIC_YEAR, s.ACADEMIC_TERM, ACADEMIC_SESSION,
  s.ACADEMIC_YEAR || '/' || s.ACADEMIC_TERM || '/' || EVENT_ID || '/' || EVENT_MED_NAME || '/' || SECTION AS "Year/Term/EventId/Med/Section",
  s.ACADEMIC_YEAR || ' / ' || s.ACADEMIC_TERM || ' / ' || EVENT_ID || ' / ' || EVENT_LONG_NAME || ' / ' || SECTION AS "Year/Term/EventId/Long/Section",
  EVENT_ID, SECTION, EVENT_MED_NAME, EVENT_LONG_NAME, CAST(TermId AS INTEGER) AS TermId
FROM (SELECT sp.PERSON_CODE_ID AS FacultyId, s.* FROM SECTIONPER sp JOIN SECTIONS s USING ({KEY6}) UNION ALL
  SELECT p.PEOPLE_CODE_ID, s.* FROM FacultyAssistant fa JOIN SECTIONS s ON s.SectionId = fa.SectionId JOIN PEOPLE p ON p.PersonId = fa.AssistantId
  WHERE CanAccessOverallGrades AND CanSubmitOverallGrades) s JOIN ot ON ot.ACADEMIC_YEAR = s.ACADEMIC_YEAR AND ot.ACADEMIC_TERM = s.ACADEMIC_TERM
WHERE s.EVENT_STATUS IN ('P', 'A') AND TermId BETWEEN (SELECT cid FROM curid) - 2 AND (SELECT cid FROM curid)""")
def faculty_sections(t):
    return lookups.faculty_sections(t, past_terms=2)


@plan("""SELECT DISTINCT PEOPLE_CODE_ID, PROGRAM, DEGREE, CURRICULUM, cp.LONG_DESC || ' / ' || cd.LONG_DESC || ' / ' || cc.LONG_DESC AS LongDesc
FROM ACADEMIC a JOIN CODE_PROGRAM cp ON cp.CODE_VALUE_KEY = PROGRAM JOIN CODE_DEGREE cd ON cd.CODE_VALUE_KEY = DEGREE JOIN CODE_CURRICULUM cc ON cc.CODE_VALUE_KEY = CURRICULUM
WHERE ACADEMIC_SESSION = '01' AND ACADEMIC_FLAG = 'Y' AND GRADUATED <> 'G'""")
def programs_enrolled(t):
    return lookups.programs_enrolled(t)


PERSON_SQL = f"""SELECT {FULL} AS FullName, {FIRST} AS FirstName, p.LAST_NAME AS LastName, p.PEOPLE_CODE_ID, PrimaryEmail, CASE WHEN prim.pid IS NOT NULL THEN AlternateEmail END AS AlternateEmail
FROM PEOPLE p LEFT JOIN prim ON prim.pid = p.PEOPLE_CODE_ID LEFT JOIN alternateemail alt ON alt.pid = p.PEOPLE_CODE_ID"""


@plan(f"WITH {PRIM}, {ALT} {PERSON_SQL}")
def person_lookup(t):
    return lookups.person_lookup(t)


def _cart_requests(t):
    """Everyone's cart is asked for; requests for one segment come from somebody who is no advisor."""
    asked = t["PEOPLE"].select("PEOPLE_CODE_ID", "PEOPLE_ID", "LAST_NAME", "FIRST_NAME")
    advisor = F.when(F.col("FIRST_NAME") == "BUILDING", "P000000001").otherwise("P900000001")
    return asked.select(F.col("PEOPLE_ID").alias("PEOPLE_CODE_ID"), advisor.alias("advisor"))


CART_SQL = f"""req AS (SELECT 'P' || PEOPLE_ID AS PEOPLE_CODE_ID, CASE WHEN FIRST_NAME = 'BUILDING' THEN 'P000000001' ELSE 'P900000001' END AS advisor FROM PEOPLE),
 okreq AS (SELECT DISTINCT PEOPLE_CODE_ID FROM req WHERE advisor IN (SELECT PEOPLE_CODE_ID FROM PEOPLETYPE WHERE PEOPLE_TYPE = 'ADV')),
 cart AS (SELECT p.PEOPLE_CODE_ID, s.* FROM CartSection c JOIN PEOPLE p ON p.PersonId = c.PersonId JOIN SECTIONS s ON s.SectionId = c.SectionId
   WHERE EXISTS (SELECT 1 FROM ACADEMICCALENDAR ac WHERE ac.ACADEMIC_YEAR = s.ACADEMIC_YEAR AND ac.ACADEMIC_TERM = s.ACADEMIC_TERM))"""


@plan(f"""WITH {CART_SQL} SELECT PEOPLE_CODE_ID, SectionId, EVENT_ID || ' / ' || EVENT_SUB_TYPE || ' / ' || SECTION AS "Desc" FROM cart JOIN okreq USING (PEOPLE_CODE_ID)""")
def cart_contents(t):
    return lookups.cart_contents(t, _cart_requests(t))


@plan(f"""WITH {CART_SQL} SELECT r.PEOPLE_CODE_ID, '{lookups.CART_STYLE}' || '<table class="sections"><thead><tr><th>Year / Term / Session</th><th>EVENT_ID</th><th>EVENT_SUB_TYPE</th><th>SECTION</th></tr></thead><tbody>'
  || coalesce((SELECT string_agg('<tr><td>' || ACADEMIC_YEAR || ' / ' || ACADEMIC_TERM || ' / ' || ACADEMIC_SESSION || '</td><td>' || EVENT_ID || '</td><td>' || EVENT_SUB_TYPE || '</td><td>' || SECTION || '</td></tr>', ''
      ORDER BY ACADEMIC_YEAR, ACADEMIC_TERM, EVENT_ID, SECTION) FROM cart c WHERE c.PEOPLE_CODE_ID = r.PEOPLE_CODE_ID AND r.PEOPLE_CODE_ID IN (SELECT PEOPLE_CODE_ID FROM okreq)), '{lookups.CART_EMPTY}')
  || '</tbody></table>' AS "HTML" FROM (SELECT DISTINCT PEOPLE_CODE_ID FROM req) r""")
def cart_html(t):
    return lookups.cart_html(t, _cart_requests(t))


@plan(f"""WITH {CART_SQL} SELECT PersonId, SectionId FROM CartSection WHERE PersonId NOT IN (SELECT PersonId FROM PEOPLE WHERE PEOPLE_CODE_ID IN (SELECT PEOPLE_CODE_ID FROM okreq))""")
def cart_delete(t):
    requests = _cart_requests(t).withColumn("SectionId", F.lit(None).cast("bigint"))
    return writers.cart_delete(t, requests).new_state


SECTION_COLUMNS = """SectionId, ACADEMIC_YEAR, ACADEMIC_TERM, EVENT_ID, EVENT_ID || ': ' || EVENT_MED_NAME AS EventIdMedName, EVENT_ID || ': ' || EVENT_LONG_NAME AS EventIdLongName,
 EVENT_ID || ' / ' || SECTION || ': ' || EVENT_LONG_NAME AS EventIdSectionLongName, EVENT_SUB_TYPE, SECTION, EVENT_MED_NAME, EVENT_LONG_NAME, ORG_CODE_ID, PROGRAM, COLLEGE, DEPARTMENT, CURRICULUM"""


@plan(f"""SELECT {SECTION_COLUMNS} FROM SECTIONS s WHERE (ACADEMIC_YEAR = '1999' AND ACADEMIC_TERM = 'FALL' AND EVENT_STATUS = 'A' AND EVENT_ID IN
  (SELECT d.EVENT_ID FROM DEGREQEVENT d WHERE MATRIC_YEAR = s.ACADEMIC_YEAR AND MATRIC_TERM = s.ACADEMIC_TERM AND d.CURRICULUM = 'BS')) OR SectionId = (510000000000 + 10)""")
def sections(t):
    return lookups.sections(t, "1999", "FALL", "BS", "", None, 510000000010)


PLAN_SQL = """PROGRAM, DEPARTMENT, cp.SHORT_DESC AS ProgramShort, cp.MEDIUM_DESC AS ProgramMedium, cp.LONG_DESC AS ProgramLong, DEGREE, cd.SHORT_DESC AS DegreeShort,
 cd.MEDIUM_DESC AS DegreeMedium, cd.LONG_DESC AS DegreeLong, CURRICULUM, cc.SHORT_DESC AS CurriculumShort, cc.MEDIUM_DESC AS CurriculumMedium, cc.LONG_DESC AS CurriculumLong, CREDITS, ENROLL_SEPARATION"""
CODES_JOIN = """JOIN CODE_PROGRAM cp ON cp.CODE_VALUE_KEY = PROGRAM JOIN CODE_DEGREE cd ON cd.CODE_VALUE_KEY = DEGREE JOIN CODE_CURRICULUM cc ON cc.CODE_VALUE_KEY = CURRICULUM"""


@plan(f"""WITH {CUR} SELECT PEOPLE_CODE_ID, ACADEMIC_YEAR, ACADEMIC_TERM, {PLAN_SQL}, FULL_PART FROM ACADEMIC a {CODES_JOIN} JOIN cur ON ACADEMIC_YEAR = cy AND ACADEMIC_TERM = ct
WHERE ACADEMIC_SESSION = '' AND ENROLL_SEPARATION = 'ENRL' AND a.STATUS <> 'N' AND PRIMARY_FLAG = 'Y'""", numbers=["CREDITS"])
def student_current(t):
    return lookups.student_current(t)


@plan(f"""WITH {CURID}
SELECT a.PEOPLE_CODE_ID, a.ACADEMIC_YEAR, a.ACADEMIC_TERM, CAST(sum(CAST(td.CREDIT AS DECIMAL(6, 2))) AS DECIMAL(19, 2)) AS TOTAL_CREDITS
FROM ACADEMIC a JOIN ot ON ot.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND ot.ACADEMIC_TERM = a.ACADEMIC_TERM
LEFT JOIN TRANSCRIPTDETAIL td ON td.PEOPLE_ID = a.PEOPLE_ID AND td.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND td.ACADEMIC_TERM = a.ACADEMIC_TERM
  AND td.ACADEMIC_SESSION = a.ACADEMIC_SESSION AND td.ADD_DROP_WAIT = 'A'
WHERE TermId = (SELECT cid FROM curid) - 1 AND a.ENROLL_SEPARATION = 'ENRL' AND a.STATUS <> 'N' GROUP BY a.PEOPLE_CODE_ID, a.ACADEMIC_YEAR, a.ACADEMIC_TERM""", numbers=["TOTAL_CREDITS"])
def student_offset(t):
    return lookups.student_offset(t, term_offset=-1)


@plan(f"""WITH {OT}, open_term AS (SELECT max(TermId) AS o FROM ot JOIN ACADEMICCALENDAR c ON c.ACADEMIC_YEAR = ot.ACADEMIC_YEAR AND c.ACADEMIC_TERM = ot.ACADEMIC_TERM
  WHERE ACADEMIC_SESSION = '01' AND DATE '1999-11-23' BETWEEN PRE_REG_DATE AND GRADE_PENALTY_DATE)
SELECT PEOPLE_CODE_ID, ACADEMIC_YEAR, ACADEMIC_TERM, PROGRAM, DEPARTMENT, ProgramShort, ProgramMedium, ProgramLong, DEGREE, DegreeShort, DegreeMedium, DegreeLong, CURRICULUM,
  CurriculumShort, CurriculumMedium, CurriculumLong, CREDITS, ENROLL_SEPARATION
FROM (SELECT PEOPLE_CODE_ID, a.ACADEMIC_YEAR, a.ACADEMIC_TERM, {PLAN_SQL}, row_number() OVER (PARTITION BY PEOPLE_CODE_ID ORDER BY TRANSCRIPT_SEQ DESC, ACADEMIC_SESSION DESC, PROGRAM DESC, DEGREE DESC, CURRICULUM DESC) AS rn
  FROM ACADEMIC a {CODES_JOIN} JOIN ot ON ot.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND ot.ACADEMIC_TERM = a.ACADEMIC_TERM
  WHERE TermId = (SELECT o FROM open_term) AND a.STATUS <> 'N' AND ACADEMIC_FLAG = 'Y' AND PRIMARY_FLAG = 'Y'
    AND ENROLL_SEPARATION NOT IN (SELECT CODE_VALUE_KEY FROM CODE_ENROLLMENT WHERE REQUIRE_SEPDATE = 'Y')) WHERE rn = 1""", numbers=["CREDITS"])
def student_reg(t):
    return lookups.student_reg(t, TUESDAY)


@plan(f"""WITH {CURID}, {PRIM}
SELECT a.PEOPLE_CODE_ID, td.TranscriptDetailId, a.ACADEMIC_YEAR, a.ACADEMIC_TERM, td.EVENT_ID || ' / ' || td.EVENT_MED_NAME AS "EventId+Med", td.EVENT_ID || ' / ' || td.EVENT_LONG_NAME AS "EventId+Long",
  td.EVENT_ID || ' / ' || td.SECTION || ': ' || td.EVENT_LONG_NAME AS "EventId+Section+LongName", td.EVENT_ID, td.SECTION, td.EVENT_MED_NAME, td.EVENT_LONG_NAME,
  CASE WHEN p.PEOPLE_CODE_ID IS NOT NULL THEN concat(p.PREFIX || ' ', {FULL}, ', ' || nullif(p.SUFFIX, '')) END AS FacultyName, fid AS FacultyID, PrimaryEmail AS FacultyEmail
FROM ACADEMIC a JOIN ot ON ot.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND ot.ACADEMIC_TERM = a.ACADEMIC_TERM
LEFT JOIN TRANSCRIPTDETAIL td ON td.PEOPLE_ID = a.PEOPLE_ID AND td.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND td.ACADEMIC_TERM = a.ACADEMIC_TERM AND td.ACADEMIC_SESSION = a.ACADEMIC_SESSION AND td.ADD_DROP_WAIT = 'A'
LEFT JOIN (SELECT {KEY6}, min(PERSON_CODE_ID) AS fid FROM SECTIONPER GROUP BY ALL) f ON f.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND f.ACADEMIC_TERM = a.ACADEMIC_TERM AND f.ACADEMIC_SESSION = a.ACADEMIC_SESSION
  AND f.EVENT_ID = td.EVENT_ID AND f.EVENT_SUB_TYPE = td.EVENT_SUB_TYPE AND f.SECTION = td.SECTION
LEFT JOIN PEOPLE p ON p.PEOPLE_CODE_ID = fid LEFT JOIN prim ON pid = fid
WHERE TermId = (SELECT cid FROM curid) AND a.STATUS <> 'N' AND a.ENROLL_SEPARATION = 'ENRL'""")
def sections_enrolled(t):
    return lookups.sections_enrolled(t)


@plan(f"""WITH {CURID}, {PRIM}, {ALT}
SELECT *, PEOPLE_CODE_ID || ', ' || FullName || ', ' || PrimaryEmail AS SearchableDesc FROM ({PERSON_SQL}) WHERE PEOPLE_CODE_ID IN (
  SELECT PEOPLE_CODE_ID FROM ACADEMIC a JOIN ot ON ot.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND ot.ACADEMIC_TERM = a.ACADEMIC_TERM
  WHERE TermId BETWEEN (SELECT cid FROM curid) - 1 AND (SELECT cid FROM curid) AND ACADEMIC_SESSION > '' AND ACADEMIC_FLAG = 'Y')""")
def students_in_terms(t):
    return lookups.students_in_terms(t, 1)


WITHDRAWN = """(SELECT GRADE FROM GRADEVALUES gv WHERE gv.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND gv.ACADEMIC_TERM = td.ACADEMIC_TERM AND gv.CREDIT_TYPE = td.CREDIT_TYPE AND WITHDRAWN_GRADE = 'Y')"""


@plan(f"""WITH {PRIM}, td0 AS (SELECT * FROM TRANSCRIPTDETAIL td WHERE FINAL_GRADE NOT IN {WITHDRAWN})
SELECT td.PEOPLE_CODE_ID, TranscriptDetailId, {FULL} AS FullName, {FIRST} AS FirstName, p.LAST_NAME AS LastName, PrimaryEmail, td.PEOPLE_CODE_ID || ', ' || {FULL} || ', ' || PrimaryEmail AS SearchableDesc,
  SectionId, {', '.join('td.' + c for c in KEY6.split(', '))}, td.TRANSCRIPT_SEQ, CREDIT_TYPE, FINAL_GRADE, ADD_DROP_WAIT, a.PROGRAM, a.CURRICULUM, ENROLL_SEPARATION
FROM SECTIONS s JOIN td0 td USING ({KEY6}) JOIN ACADEMIC a ON a.PEOPLE_CODE_ID = td.PEOPLE_CODE_ID AND a.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND a.ACADEMIC_TERM = td.ACADEMIC_TERM
  AND a.ACADEMIC_SESSION = td.ACADEMIC_SESSION AND a.TRANSCRIPT_SEQ = td.TRANSCRIPT_SEQ AND PRIMARY_FLAG = 'Y' AND a.STATUS IN ('A', 'G')
  AND ENROLL_SEPARATION NOT IN (SELECT CODE_VALUE_KEY FROM CODE_ENROLLMENT WHERE REQUIRE_SEPDATE = 'Y')
LEFT JOIN PEOPLE p ON p.PEOPLE_CODE_ID = td.PEOPLE_CODE_ID LEFT JOIN prim ON pid = td.PEOPLE_CODE_ID""")
def students_in_section(t):
    return lookups.students_in_section(t)


@plan("""SELECT strftime(START_DATE, '%Y-%m-%d %H:%M:%S.000') AS Start, strftime(END_DATE, '%Y-%m-%d %H:%M:%S.000') AS "End",
  strftime(START_DATE + 7, '%Y-%m-%d %H:%M:%S.000') AS "1WeekAfterStart" FROM ACADEMICCALENDAR WHERE (ACADEMIC_TERM = 'FALL' AND ACADEMIC_SESSION = '01') OR SessionPeriodId = 512""")
def term_dates(t):
    return lookups.term_dates(t, "", "FALL", "", " 512", "")


@plan("""SELECT ACADEMIC_YEAR, ACADEMIC_TERM, ACADEMIC_SESSION, ACADEMIC_YEAR || '/' || ACADEMIC_TERM || '/' || ACADEMIC_SESSION AS YTS, ACADEMIC_TERM || '/' || ACADEMIC_YEAR || '/' || ACADEMIC_SESSION AS TYS,
  START_DATE, END_DATE, PRE_REG_DATE, REG_DATE, FIN_AID_YEAR, SessionPeriodId FROM ACADEMICCALENDAR WHERE END_DATE >= DATE '1999-11-23'
  AND 1 >= CAST(trunc(date_diff('day', START_DATE, DATE '1999-11-23') / 7.0) AS INTEGER) + 1""", texts=["START_DATE", "END_DATE", "PRE_REG_DATE", "REG_DATE"])
def terms(t):
    return lookups.terms(t, TUESDAY, True, "/", 1)


@plan("""SELECT ADDRESS_TYPE AS kind, date_diff('day', START_DATE, CASE WHEN ADDRESS_LINE_1 = '' THEN DATE '1999-11-23' ELSE END_DATE END) AS "Diff", count(*) AS n
FROM ADDRESSSCHEDULE GROUP BY ALL""")
def date_difference(t):
    typed = t["ADDRESSSCHEDULE"].select(
        F.col("ADDRESS_TYPE").alias("kind"), F.col("START_DATE").cast("string").alias("a"),
        F.when(F.col("ADDRESS_LINE_1") == "", "").otherwise(F.col("END_DATE").cast("string")).alias("b"),
    )
    rows = lookups.date_difference(typed, "a", "b", TUESDAY)
    return rows.groupBy("kind", F.col("Diff").cast("bigint").alias("Diff")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- views and reports

MEETINGS = f"""meet AS (SELECT {', '.join('ss.' + c for c in KEY6.split(', '))}, ss.DAY AS REGULAR_DAY, SECTIONSCHEDULE_ID, c.* FROM SECTIONSCHEDULE ss
  JOIN CALENDARDETAIL cd ON cd.EVENT_KEY = ss.CALENDARDET_EVENT_KEY JOIN CALENDAR c ON c.EVENT_KEY = cd.EVENT_KEY)"""


@plan(f"""WITH {OT}, {MEETINGS}
SELECT td.PEOPLE_CODE_ID, td.PEOPLE_ID, CAST(TermId AS INTEGER) AS TermId, {', '.join('td.' + c for c in KEY6.split(', '))}, TRANSCRIPT_SEQ, td.EVENT_MED_NAME, td.EVENT_LONG_NAME, COLLEGE, DEPARTMENT, REGULAR_DAY,
  CALENDAR_DATE, m.START_TIME, m.END_TIME, DAY_OF_WEEK, BUILDING_CODE, m.ROOM_ID, SectionId, SECTIONSCHEDULE_ID, EVENT_KEY, CALENDAR_KEY
FROM (SELECT x.*, TermId FROM TRANSCRIPTDETAIL x JOIN ot ON ot.ACADEMIC_YEAR = x.ACADEMIC_YEAR AND ot.ACADEMIC_TERM = x.ACADEMIC_TERM) td JOIN SECTIONS s USING ({KEY6}) JOIN meet m USING ({KEY6})
WHERE s.EVENT_STATUS = 'A' AND ADD_DROP_WAIT = 'A'""", texts=["CALENDAR_DATE", "START_TIME", "END_TIME"])
def section_meetings_student(t):
    return m.section_meetings(t)


@plan(f"WITH {PRIM}, {ALT} SELECT prim.pid AS PEOPLE_ORG_CODE_ID, PrimaryEmail, AlternateEmail FROM prim LEFT JOIN alternateemail alt ON alt.pid = prim.pid")
def email_top(t):
    return m.email_top(t)


CONFLICTS = f"""iv AS (SELECT td.PEOPLE_CODE_ID, m.*, CALENDAR_DATE + (START_TIME - TIMESTAMP '1900-01-01') AS b, CALENDAR_DATE + (END_TIME - TIMESTAMP '1900-01-01') AS e,
   date_diff('minute', START_TIME, END_TIME) AS len FROM people6 td JOIN meet m USING ({KEY6})),
 conf AS (SELECT a.PEOPLE_CODE_ID, a.EVENT_ID AS EVENT_ID1, a.EVENT_SUB_TYPE AS EVENT_SUB_TYPE1, a.SECTION AS SECTION1, a.REGULAR_DAY AS DAY1, a.DAY_OF_WEEK AS DAY_OF_WEEK1, a.b AS Start1,
   z.EVENT_ID AS EVENT_ID2, z.SECTION AS SECTION2, z.REGULAR_DAY AS DAY2, z.DAY_OF_WEEK AS DAY_OF_WEEK2
   FROM iv a JOIN iv z ON a.PEOPLE_CODE_ID = z.PEOPLE_CODE_ID AND a.CALENDAR_DATE = z.CALENDAR_DATE
   WHERE (a.b BETWEEN z.b AND z.e OR a.e BETWEEN z.b AND z.e OR z.b BETWEEN a.b AND a.e) AND a.CALENDAR_KEY <> z.CALENDAR_KEY
     AND a.ACADEMIC_YEAR = '1999' AND (a.len > 10 OR z.len > 10))"""
STUDENTS6 = f"people6 AS (SELECT PEOPLE_CODE_ID, {KEY6} FROM TRANSCRIPTDETAIL WHERE ADD_DROP_WAIT = 'A')"
TEACHERS6 = f"people6 AS (SELECT PERSON_CODE_ID AS PEOPLE_CODE_ID, {KEY6} FROM SECTIONPER)"
REGULAR = "left(DAY1, 3) = DAY_OF_WEEK1 AND left(DAY2, 3) = DAY_OF_WEEK2"


@plan(f"""WITH {MEETINGS}, {STUDENTS6}, {CONFLICTS}
SELECT count(DISTINCT PEOPLE_CODE_ID) AS Students, EVENT_ID1, SECTION1, (SELECT CURRICULUM FROM EVENT v WHERE v.EVENT_ID = EVENT_ID1) AS CURRICULUM1,
  EVENT_ID2, SECTION2, (SELECT CURRICULUM FROM EVENT v WHERE v.EVENT_ID = EVENT_ID2) AS CURRICULUM2 FROM conf WHERE {REGULAR} GROUP BY EVENT_ID1, SECTION1, EVENT_ID2, SECTION2""")
def conflicts_student(t):
    return reports.conflicts_student(t, "1999")


@plan(f"""WITH {MEETINGS}, {STUDENTS6}, {CONFLICTS}
SELECT PEOPLE_CODE_ID, count(*) AS Conflicts FROM conf WHERE DAY1 = 'MON' AND DAY2 = 'THUR' AND CAST(Start1 AS DATE) IN (DATE '1999-10-06', DATE '1999-11-18', DATE '1999-03-02', DATE '1999-05-05') GROUP BY PEOPLE_CODE_ID""")
def conflicts_student_days(t):
    days = ["1999-10-06", "1999-11-18", "1999-03-02", "1999-05-05"]
    return reports.conflicts_on_days(reports.student_conflicts(t, "1999"), days, ("MON", "THUR"))


@plan(f"""WITH {MEETINGS}, {TEACHERS6}, {CONFLICTS}
SELECT DISTINCT c.PEOPLE_CODE_ID, {FULL} AS Name, EVENT_ID1, SECTION1, (SELECT CURRICULUM FROM EVENT v WHERE v.EVENT_ID = EVENT_ID1) AS CURRICULUM1,
  EVENT_ID2, SECTION2, (SELECT CURRICULUM FROM EVENT v WHERE v.EVENT_ID = EVENT_ID2) AS CURRICULUM2
FROM conf c LEFT JOIN PEOPLE p ON p.PEOPLE_CODE_ID = c.PEOPLE_CODE_ID WHERE {REGULAR} AND NOT EXISTS
  (SELECT 1 FROM sectioncrosstally x WHERE x.EVENT_ID = EVENT_ID1 AND x.EVENT_SUB_TYPE = EVENT_SUB_TYPE1 AND x.SECTION = SECTION1)""")
def conflicts_instructor(t):
    return reports.conflicts_instructor(t, "1999")


PLANROWS = """FROM STDDEGREQ r JOIN STDDEGREQEVENT e USING (PEOPLE_CODE_ID, PROGRAM, DEGREE, CURRICULUM, MATRIC_YEAR, MATRIC_TERM, RECORD_TYPE)
 JOIN ACADEMIC a USING (PEOPLE_CODE_ID, PROGRAM, DEGREE, CURRICULUM) WHERE RECORD_TYPE = 'A' AND a.ACADEMIC_YEAR = '1999' AND ENROLL_SEPARATION = 'ENRL' AND ACADEMIC_FLAG = 'Y' AND REQUIRED = 'Y'"""


@plan(f"""SELECT CURRICULUM, EVENT_CLASS, EVENT_ID, "Taken/In Progress", "Needed" FROM (SELECT CURRICULUM, EVENT_CLASS, EVENT_ID, EVENT_SUB_TYPE,
  count(*) FILTER (e.STATUS IN ('C', 'P')) AS "Taken/In Progress", count(*) FILTER (e.STATUS IN ('X', 'Z')) AS "Needed" {PLANROWS} GROUP BY 1, 2, 3, 4)""")
def plan_demand(t):
    return reports.plan_demand(t, "1999")


@plan(f"""SELECT PEOPLE_CODE_ID, CURRICULUM, EVENT_CLASS, EVENT_ID, CASE e.STATUS WHEN 'C' THEN 'Complete' WHEN 'P' THEN 'In Progress' WHEN 'X' THEN 'Fail' END AS Status {PLANROWS}""")
def plan_progress(t):
    return reports.plan_progress(t, "1999")


@plan(r"""SELECT r.ASSESSMENT_RULE_ID, ACADEMIC_YEAR, ACADEMIC_TERM, r.LONG_DESC, nullif(regexp_extract(SELECT_CRITERIA, 'STUDENTFINANCIAL.CREDIT_BILLING([^)]*)', 1, 'i'), '') AS "Billing Credits Filter",
  PER_CREDIT_FLAT, AMOUNT, CHARGE_CREDIT_CODE, CRG_CRD_DESC, CRG_CRD_MED_DESC, OVERLOAD, COURSE_CREDIT_BASE FROM ASSESSMENTRULE r JOIN ASSESSCHARGECREDIT a ON a.ASSESSMENT_RULE_ID = r.ASSESSMENT_RULE_ID
JOIN CODE_CHARGECREDIT c ON c.CODE_VALUE_KEY = CHARGE_CREDIT_CODE WHERE SECTION_FEE_FLAG = 'N'""", numbers=["AMOUNT"])
def billing_rules(t):
    return reports.billing_rules(t)


@plan("""SELECT CODE_VALUE, SHORT_DESC, MEDIUM_DESC, LONG_DESC AS Message, CASE STOP_REGISTRATION WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' END AS STOP_REGISTRATION,
  CASE STOP_GRADES WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' END AS STOP_GRADES, CASE SHOW_STOP_PICTURE WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' END AS SHOW_STOP_PICTURE,
  CAST(CREATE_DATE AS DATE) AS CREATE_DATE, CASE STATUS WHEN 'A' THEN 'Active' WHEN 'I' THEN 'Inactive' END AS Status FROM CODE_STOPLIST""", texts=["CREATE_DATE"])
def stop_reasons(t):
    return reports.stop_reasons(t)


@plan("""SELECT * FROM (SELECT 'TRANSCRIPTDETAIL' AS table_name, 'EVENT_SUB_TYPE' AS column_name, count(*) AS instances FROM TRANSCRIPTDETAIL WHERE EVENT_SUB_TYPE = 'LECT' AND ACADEMIC_YEAR = '1999' AND ACADEMIC_TERM = 'FALL'
 UNION ALL SELECT 'SECTIONS', 'EVENT_SUB_TYPE', count(*) FROM SECTIONS WHERE EVENT_SUB_TYPE = 'LECT' AND ACADEMIC_YEAR = '1999' AND ACADEMIC_TERM = 'FALL'
 UNION ALL SELECT 'TRANATTENDANCE', 'EVENT_SUB_TYPE', count(*) FROM TRANATTENDANCE WHERE EVENT_SUB_TYPE = 'LECT' AND ACADEMIC_YEAR = '1999' AND ACADEMIC_TERM = 'FALL') WHERE instances > 0""")
def find_value(t):
    names = ["TRANSCRIPTDETAIL", "SECTIONS", "TRANATTENDANCE", "ACADEMIC", "sectioncrosstally", "CODE_PROGRAM"]
    return reports.find_value(t, names, "EVENT_SUB_TYPE", "LECT", "1999", "FALL")


@plan("""WITH ops AS (SELECT DISTINCT u.OPERATOR_ID FROM PersonUser pu JOIN PEOPLE p ON p.PersonId = pu.PersonId JOIN ABT_USERS u ON u.PEOPLE_CODE_ID = p.PEOPLE_CODE_ID),
 perms AS (SELECT DISTINCT ops.OPERATOR_ID, PROFILE_CODE FROM ops LEFT JOIN ABT_USERPROFILE up ON up.OPERATOR_ID = ops.OPERATOR_ID)
SELECT DISTINCT a.PROFILE_CODE, PROFILE_NAME, CASE WHEN b.PROFILE_CODE IS NULL THEN 'Only ' || a.OPERATOR_ID ELSE 'Both have' END AS Status
FROM perms a LEFT JOIN ABT_PROFILE ap ON ap.PROFILE_CODE = a.PROFILE_CODE LEFT JOIN perms b ON b.PROFILE_CODE = a.PROFILE_CODE AND b.OPERATOR_ID <> a.OPERATOR_ID""")
def operator_diff(t):
    return reports.operator_diff(t)


@plan("""WITH held AS (SELECT DISTINCT u.OPERATOR_ID, s.LABEL_NAME AS Office FROM PersonUser pu JOIN PEOPLE p ON p.PersonId = pu.PersonId JOIN ABT_USERS u ON u.PEOPLE_CODE_ID = p.PEOPLE_CODE_ID
  JOIN ABT_SETTINGS s ON s.SECTION_NAME = u.OPERATOR_ID AND SETTING = 'Y')
SELECT DISTINCT a.Office, SHORT_DESC, CASE WHEN b.Office IS NULL THEN 'Only ' || a.OPERATOR_ID ELSE 'Both have' END AS Status
FROM held a LEFT JOIN CODE_OFFICE c ON c.CODE_VALUE_KEY = a.Office LEFT JOIN held b ON b.Office = a.Office AND b.OPERATOR_ID <> a.OPERATOR_ID""")
def operator_offices(t):
    return reports.operator_offices(t)


@plan("""SELECT p.PEOPLE_ID, p.PersonId, p.FIRST_NAME, p.LAST_NAME, pu.UserName, pu.NonQualifiedUserName, u.OPERATOR_ID, u.STATUS
FROM PEOPLE p JOIN PersonUser pu ON pu.PersonId = p.PersonId LEFT JOIN ABT_USERS u ON u.PEOPLE_CODE_ID = p.PEOPLE_CODE_ID""")
def operator_people(t):
    return reports.operator_people(t)


@plan("""SELECT 'TRANSCRIPTDETAIL' AS TableName, TranscriptDetailId, PEOPLE_CODE_ID, EVENT_ID, EVENT_SUB_TYPE FROM TRANSCRIPTDETAIL
WHERE EVENT_SUB_TYPE = 'LECT' AND ACADEMIC_YEAR = '1999' AND ACADEMIC_TERM = 'FALL'""")
def find_value_rows(t):
    return reports.find_value_rows(t, "TRANSCRIPTDETAIL", "EVENT_SUB_TYPE", "LECT", "1999", "FALL").select(
        "TableName", "TranscriptDetailId", "PEOPLE_CODE_ID", "EVENT_ID", "EVENT_SUB_TYPE"
    )


@plan("""SELECT ACTIONSCHEDULE_ID, PEOPLE_ORG_CODE_ID, ACTION_ID, CASE WHEN EXECUTION_DATE IS NOT NULL THEN 'Complete' WHEN CANCELED = 'Y' THEN 'Canceled' WHEN WAIVED = 'Y' THEN 'Waived'
  WHEN SCHEDULED_DATE > DATE '1999-11-23' THEN 'Future' WHEN SCHEDULED_DATE = DATE '1999-11-23' THEN 'Today' ELSE 'Past Due' END AS ACTION_STATUS FROM ACTIONSCHEDULE""")
def action_status(t):
    return reports.action_status(t, TUESDAY)


# ---------------------------------------------------------------- data quality

LINES10 = quality.ADDRESS_LINES
SAME_ADDRESS = " AND ".join(f"coalesce(x.{c}, '') = coalesce(y.{c}, '')" for c in LINES10)


def same(x: str, y: str) -> str:
    return SAME_ADDRESS.replace("x.", f"{x}.").replace("y.", f"{y}.")


@plan(f"""WITH good AS (SELECT * FROM ADDRESSSCHEDULE a WHERE STATUS = 'A' AND END_DATE IS NULL AND ADDRESS_TYPE <> 'EMAL' AND RECURRING = 'N' AND EXISTS (SELECT 1 FROM ADDRESSSCHEDULE b
  WHERE b.PEOPLE_ORG_CODE_ID = a.PEOPLE_ORG_CODE_ID AND b.ADDRESS_TYPE = a.ADDRESS_TYPE AND b.STATUS = 'I' AND b.END_DATE = a.START_DATE - 1 AND {same('b', 'a')})),
 rest AS (SELECT * FROM ADDRESSSCHEDULE a WHERE NOT (END_DATE IS NULL AND EXISTS (SELECT 1 FROM good g WHERE g.PEOPLE_ORG_CODE_ID = a.PEOPLE_ORG_CODE_ID AND g.START_DATE = a.START_DATE AND {same('g', 'a')}))),
 kept AS (SELECT * FROM rest WHERE NOT (STATUS = 'I' AND SEQUENCE_NO NOT IN (SELECT min(SEQUENCE_NO) FROM rest GROUP BY PEOPLE_ORG_CODE_ID, ADDRESS_TYPE, END_DATE, {', '.join(LINES10)})))
SELECT SEQUENCE_NO, PEOPLE_ORG_CODE_ID, ADDRESS_TYPE, START_DATE, CASE WHEN hit THEN NULL ELSE END_DATE END AS END_DATE, CASE WHEN hit THEN 'A' ELSE STATUS END AS STATUS
FROM (SELECT *, EXISTS (SELECT 1 FROM good g WHERE g.PEOPLE_ORG_CODE_ID = k.PEOPLE_ORG_CODE_ID AND k.END_DATE = g.START_DATE - 1 AND {same('g', 'k')}) AS hit FROM kept k)""", texts=["START_DATE", "END_DATE"])
def repair_addresses(t):
    return quality.repair_addresses(t).new_state.select("SEQUENCE_NO", "PEOPLE_ORG_CODE_ID", "ADDRESS_TYPE", "START_DATE", "END_DATE", "STATUS")


@plan("""SELECT DISTINCT s.PEOPLE_ORG_CODE_ID FROM ADDRESSSCHEDULE s LEFT JOIN ADDRESS a ON a.PEOPLE_ORG_CODE_ID = s.PEOPLE_ORG_CODE_ID AND a.ADDRESS_TYPE = s.ADDRESS_TYPE
WHERE s.STATUS = 'A' AND a.PEOPLE_ORG_CODE_ID IS NULL""")
def people_missing_addresses(t):
    return quality.people_missing_addresses(t)


@plan("""WITH dups AS (SELECT pp.*, rank() OVER (PARTITION BY PersonId, PhoneType, PhoneNumber ORDER BY CASE WHEN PersonPhoneId IN (SELECT PrimaryPhoneId FROM PEOPLE p WHERE p.PersonId = pp.PersonId) THEN 0 ELSE 1 END, Create_Date, Create_Time) AS rk
  FROM PersonPhone pp WHERE EXISTS (SELECT 1 FROM PersonPhone q WHERE q.PersonPhoneId <> pp.PersonPhoneId AND q.PersonId = pp.PersonId AND q.PhoneNumber = pp.PhoneNumber AND q.PhoneType = pp.PhoneType AND q.CountryId <> pp.CountryId)),
 left_over AS (SELECT * FROM PersonPhone WHERE PersonPhoneId NOT IN (SELECT PersonPhoneId FROM dups WHERE rk > 1)),
 found AS (SELECT l.*, CASE WHEN CountryId = 240 THEN coalesce((SELECT first(d.CountryId ORDER BY length(CAST(d.Prefix AS VARCHAR)) DESC, d.CountryId) FROM DialingCodes d
   WHERE d.NumberLength = length(PhoneNumber) AND starts_with(PhoneNumber, CAST(d.Prefix AS VARCHAR))), 240) ELSE CountryId END AS c2 FROM left_over l)
SELECT PersonPhoneId, PersonId, PhoneType, PhoneNumber, CASE WHEN c2 = 240 AND length(PhoneNumber) = 11 AND left(PhoneNumber, 2) IN ('77', '76') THEN 122
  WHEN c2 = 240 AND length(PhoneNumber) = 11 AND left(PhoneNumber, 1) = '7' THEN 190 ELSE c2 END AS CountryId FROM found""")
def phone_country(t):
    return quality.phone_country(t).new_state.select("PersonPhoneId", "PersonId", "PhoneType", "PhoneNumber", "CountryId")


NEW_INFO = "NEW_Reported1098TInformation"


@plan("""WITH i AS (SELECT ReportedInformationId FROM (SELECT *, rank() OVER (PARTITION BY People_Code_Id ORDER BY ReportedInformationId DESC) AS rk FROM Reported1098TInformation WHERE TaxYear = 1998) WHERE rk = 1),
 allof AS (SELECT ReportedPeriodSummaryId FROM Reported1098TPeriodSummary WHERE ReportedInformationId IN (SELECT * FROM i)),
 ni AS (SELECT * FROM i EXCEPT SELECT ReportedInformationId FROM NEW_Reported1098TInformation),
 s AS (SELECT * FROM allof EXCEPT SELECT ReportedPeriodSummaryId FROM NEW_Reported1098TPeriodSummary),
 d AS (SELECT ReportedSummaryDetailId FROM Reported1098TSummaryDetail WHERE ReportedPeriodSummaryId IN (SELECT * FROM allof) EXCEPT SELECT ReportedSummaryDetailId FROM NEW_Reported1098TSummaryDetail),
 r AS (SELECT ReportedRefundCodeId FROM Reported1098TRefundCode EXCEPT SELECT ReportedRefundCodeId FROM NEW_Reported1098TRefundCode)
SELECT 'information' AS table_name, count(*) AS n, CAST(sum(ReportedInformationId) AS BIGINT) AS key_sum FROM ni UNION ALL SELECT 'summary', count(*), CAST(sum(ReportedPeriodSummaryId) AS BIGINT) FROM s
UNION ALL SELECT 'detail', count(*), CAST(sum(ReportedSummaryDetailId) AS BIGINT) FROM d
UNION ALL SELECT 'refund', count(*), CAST(sum(ReportedRefundCodeId) AS BIGINT) FROM r""")
def copy_tax_forms(t):
    copied = quality.copy_tax_forms(t, "old", "new", 1998)
    keys = {
        "information": (quality.INFORMATION, "ReportedInformationId"), "summary": (quality.SUMMARY, "ReportedPeriodSummaryId"),
        "detail": (quality.DETAIL, "ReportedSummaryDetailId"), "refund": (quality.REFUND, "ReportedRefundCodeId"),
    }
    out = None
    for label, (table, key) in keys.items():
        part = copied[table].changes.agg(F.count("*").alias("n"), F.sum(key).alias("key_sum")).select(F.lit(label).alias("table_name"), "n", "key_sum")
        out = part if out is None else out.unionByName(part)
    return out


@plan("""WITH o AS (SELECT * FROM Reported1098TInformation WHERE TaxYear = 1998), n AS (SELECT * FROM NEW_Reported1098TInformation WHERE TaxYear = 1998),
 ps AS (SELECT * FROM Reported1098TPeriodSummary WHERE TaxYear = 1998), pn AS (SELECT * FROM NEW_Reported1098TPeriodSummary WHERE TaxYear = 1998)
SELECT 'Reported1098TInformation' AS table_name, count(*) AS total_rows, count(*) FILTER (o.ReportedInformationId IS NOT NULL) AS matched_rows FROM n LEFT JOIN o
  ON (o.ReportedInformationId, o.People_Code_Id, o.NameLine1, o.Payment, o.PaymentAdjustment, o.Scholarship) = (n.ReportedInformationId, n.People_Code_Id, n.NameLine1, n.Payment, n.PaymentAdjustment, n.Scholarship)
UNION ALL SELECT 'Reported1098TPeriodSummary', count(*), count(*) FILTER (ps.ReportedPeriodSummaryId IS NOT NULL) FROM pn LEFT JOIN ps ON ps.ReportedPeriodSummaryId = pn.ReportedPeriodSummaryId AND ps.CumulativeChargesBilled = pn.CumulativeChargesBilled
UNION ALL SELECT 'Reported1098TSummaryDetail', count(*), count(*) FILTER (d.ReportedSummaryDetailId IS NOT NULL) FROM NEW_Reported1098TSummaryDetail nd
  LEFT JOIN (SELECT * FROM Reported1098TSummaryDetail WHERE ReportedPeriodSummaryId IN (SELECT ReportedPeriodSummaryId FROM ps)) d ON d.ReportedSummaryDetailId = nd.ReportedSummaryDetailId AND d.Amount = nd.Amount""")
def reconcile_tax_forms(t):
    return quality.reconcile_tax_forms(t, "old", "new", 1998)


@plan("""SELECT side, count(*) AS "Rows", CAST(sum(Payment) AS DOUBLE) AS PaymentSum, CAST(sum(Amount) AS DOUBLE) AS DetailSum FROM (
  SELECT 'old' AS side, ReportedInformationId, Payment FROM Reported1098TInformation WHERE TaxYear = 1998 UNION ALL
  SELECT 'new', ReportedInformationId, Payment FROM NEW_Reported1098TInformation WHERE TaxYear = 1998) i
JOIN NEW_Reported1098TPeriodSummary s ON s.ReportedInformationId = i.ReportedInformationId JOIN NEW_Reported1098TSummaryDetail d ON d.ReportedPeriodSummaryId = s.ReportedPeriodSummaryId GROUP BY side""")
def tax_form_totals(t):
    totals = quality.tax_form_totals(t, "old", "new", 1998)
    return totals.select("side", "Rows", F.col("PaymentSum").cast("double").alias("PaymentSum"), F.col("DetailSum").cast("double").alias("DetailSum"))


def form_chain(prefix: str) -> str:
    """Forms of 1998 with their periods and details on one side."""
    return f"""SELECT i.ReportedInformationId, s.ReportedPeriodSummaryId, d.ReportedSummaryDetailId, i.Payment, d.Amount FROM {prefix}Reported1098TInformation i
  JOIN {prefix}Reported1098TPeriodSummary s ON s.ReportedInformationId = i.ReportedInformationId JOIN {prefix}Reported1098TSummaryDetail d ON d.ReportedPeriodSummaryId = s.ReportedPeriodSummaryId
  WHERE i.TaxYear = 1998"""


@plan(f"""WITH here AS ({form_chain("NEW_")}), there AS ({form_chain("")}), picked AS (
  SELECT * FROM here ORDER BY md5(concat_ws('|', '0', ReportedInformationId, ReportedPeriodSummaryId, ReportedSummaryDetailId)), ReportedInformationId, ReportedPeriodSummaryId, ReportedSummaryDetailId LIMIT 5)
SELECT p.ReportedInformationId, p.ReportedPeriodSummaryId, p.ReportedSummaryDetailId, CAST(p.Payment AS DOUBLE) AS new_payment, CAST(t.Payment AS DOUBLE) AS old_payment, CAST(t.Amount AS DOUBLE) AS old_amount
FROM picked p LEFT JOIN there t ON t.ReportedInformationId = p.ReportedInformationId AND t.ReportedPeriodSummaryId = p.ReportedPeriodSummaryId AND t.ReportedSummaryDetailId = p.ReportedSummaryDetailId""")
def sample_tax_forms(t):
    """Five rows by a seed beside their counterparts; the limit is the sample's size."""
    amount = lambda c, n: F.col(c).cast("double").alias(n)
    return quality.sample_tax_forms(t, "old", "new", 1998).select(
        "ReportedInformationId", "ReportedPeriodSummaryId", "ReportedSummaryDetailId", amount("here.Payment", "new_payment"),
        amount("there.Payment", "old_payment"), amount("there.Amount", "old_amount"),
    )


@plan("""SELECT People_Code_Id, count(*) AS "Count" FROM Reported1098TInformation WHERE TaxYear = 1998 GROUP BY People_Code_Id HAVING count(*) > 1""")
def repeated_tax_forms(t):
    return quality.repeated_tax_forms(t, "old", 1998)


@plan("""SELECT 'Reported1098TInformation' AS table_name, max(ReportedInformationId) AS max_key, max(ReportedInformationId) + 1 AS next_key FROM NEW_Reported1098TInformation
UNION ALL SELECT 'Reported1098TPeriodSummary', max(ReportedPeriodSummaryId), max(ReportedPeriodSummaryId) + 1 FROM NEW_Reported1098TPeriodSummary
UNION ALL SELECT 'Reported1098TSummaryDetail', max(ReportedSummaryDetailId), max(ReportedSummaryDetailId) + 1 FROM NEW_Reported1098TSummaryDetail
UNION ALL SELECT 'Reported1098TRefundCode', max(ReportedRefundCodeId), max(ReportedRefundCodeId) + 1 FROM NEW_Reported1098TRefundCode""")
def tax_form_keys(t):
    return quality.tax_form_keys(t, "new")


# ---------------------------------------------------------------- writers


@plan("""WITH req AS (SELECT TranscriptDetailId AS detail_id, CASE TRANSCRIPT_SEQ WHEN '002' THEN '2-HIGH' ELSE CASE WHEN FINAL_GRADE = 'W' THEN '4-NOT SPECIFIED' ELSE '1-URGENT' END END AS violation FROM TRANSCRIPTDETAIL WHERE FINAL_GRADE IS NOT NULL),
 new AS (SELECT DISTINCT td.PEOPLE_CODE_ID, ACADEMIC_YEAR, ACADEMIC_TERM, EVENT_ID, SECTION, violation FROM req JOIN TRANSCRIPTDETAIL td ON TranscriptDetailId = detail_id
   WHERE violation IN (SELECT CODE_VALUE_KEY FROM CODE_VIOLATIONS))
SELECT PEOPLE_CODE_ID, ACADEMIC_YEAR, ACADEMIC_TERM, EVENT_ID, SECTION, violation AS VIOLATION, DATE '1999-11-23' AS VIOLATION_DATE FROM new n WHERE NOT EXISTS (SELECT 1 FROM VIOLATIONS v
  WHERE v.PEOPLE_CODE_ID = n.PEOPLE_CODE_ID AND v.ACADEMIC_YEAR = n.ACADEMIC_YEAR AND v.ACADEMIC_TERM = n.ACADEMIC_TERM AND v.EVENT_ID = n.EVENT_ID AND v.SECTION = n.SECTION AND v.VIOLATION = n.violation)""", texts=["VIOLATION_DATE"])
def record_violation(t):
    kind = F.when(F.col("TRANSCRIPT_SEQ") == "002", "2-HIGH").when(F.col("FINAL_GRADE") == "W", "4-NOT SPECIFIED").otherwise("1-URGENT")
    requests = t["TRANSCRIPTDETAIL"].filter("FINAL_GRADE IS NOT NULL").select(F.col("TranscriptDetailId").alias("detail_id"), kind.alias("violation"))
    return writers.record_violation(t, requests, NOW).accepted.changes.select(
        "PEOPLE_CODE_ID", "ACADEMIC_YEAR", "ACADEMIC_TERM", "EVENT_ID", "SECTION", "VIOLATION", "VIOLATION_DATE"
    )


@plan("""SELECT PEOPLE_ORG_CODE_ID, ACTION_ID, CAST((SELECT max(ACTIONSCHEDULE_ID) FROM ACTIONSCHEDULE) + row_number() OVER (ORDER BY p.PEOPLE_CODE_ID) AS BIGINT) AS ACTIONSCHEDULE_ID,
  'Action ' || ACTION_ID AS ACTION_NAME, 'Y' AS REQUIRED, 'N' AS COMPLETED, ACTION_ID || '199911239300' AS UNIQUE_KEY, left(p.PEOPLE_CODE_ID, 1) AS PEOPLE_ORG_CODE, right(p.PEOPLE_CODE_ID, 9) AS PEOPLE_ORG_ID
FROM (SELECT PEOPLE_CODE_ID, PEOPLE_CODE_ID AS PEOPLE_ORG_CODE_ID, CASE FIRST_NAME WHEN 'BUILDING' THEN 'unknown' WHEN 'Pat' THEN '1-URGENT' ELSE '2-HIGH' END AS ACTION_ID FROM PEOPLE) p
WHERE ACTION_ID <> 'unknown'""")
def schedule_actions_batch(t):
    kind = F.when(F.col("FIRST_NAME") == "BUILDING", "unknown").when(F.col("FIRST_NAME") == "Pat", "1-URGENT").otherwise("2-HIGH")
    actions = t["PEOPLE"].select(F.col("PEOPLE_CODE_ID").alias("PEOPLE_ORG_CODE_ID"), kind.alias("ACTION_ID"), F.lit("OP").alias("OPID"))
    _, numbered = writers.schedule_actions_batch(t, actions, NOW)
    return numbered.select(
        "PEOPLE_ORG_CODE_ID", "ACTION_ID", "ACTIONSCHEDULE_ID", "ACTION_NAME", "REQUIRED", "COMPLETED", "UNIQUE_KEY", "PEOPLE_ORG_CODE", "PEOPLE_ORG_ID"
    )


ACTION_REQ = """req AS (SELECT PEOPLE_CODE_ID, CASE FIRST_NAME WHEN 'BUILDING' THEN 'unknown' WHEN 'Pat' THEN '1-URGENT' ELSE '2-HIGH' END AS action_id,
  CASE WHEN FIRST_NAME = 'MACHINERY' THEN '' ELSE '1999-12-24' END AS sched_date, CASE WHEN FIRST_NAME = 'FURNITURE' THEN 'Y' ELSE '' END AS completed,
  CASE WHEN FIRST_NAME = 'HOUSEHOLD' THEN 'P999999999' END AS resp_staff FROM PEOPLE)"""


@plan(f"""WITH {ACTION_REQ}
SELECT PEOPLE_CODE_ID AS PEOPLE_ORG_CODE_ID, action_id AS ACTION_ID, DATE '1999-12-24' AS SCHEDULED_DATE, CASE WHEN completed = 'Y' THEN DATE '1999-11-23' END AS EXECUTION_DATE,
  CASE WHEN completed = 'Y' THEN PEOPLE_CODE_ID END AS COMPLETED_BY, CASE WHEN completed = 'Y' THEN 'Y' ELSE 'N' END AS COMPLETED, '1999' AS ACADEMIC_YEAR, 'FALL' AS ACADEMIC_TERM, '' AS ACADEMIC_SESSION,
  'Y' AS REQUIRED, '    1 5' AS DURATION, 'DYNFORMS' AS CREATE_OPID, CAST((SELECT max(ACTIONSCHEDULE_ID) FROM ACTIONSCHEDULE) + row_number() OVER (ORDER BY PEOPLE_CODE_ID) AS BIGINT) AS ACTIONSCHEDULE_ID
FROM req WHERE sched_date <> '' AND action_id <> 'unknown' AND resp_staff IS NULL""", texts=["SCHEDULED_DATE", "EXECUTION_DATE"])
def schedule_action(t):
    first = F.col("FIRST_NAME")
    requests = t["PEOPLE"].select(
        F.col("PEOPLE_CODE_ID").alias("people_code_id"), F.when(first == "BUILDING", "unknown").when(first == "Pat", "1-URGENT").otherwise("2-HIGH").alias("action_id"),
        F.when(first == "MACHINERY", "").otherwise("1999-12-24").alias("sched_date"), F.when(first == "FURNITURE", "Y").otherwise("").alias("completed"),
        F.when(first == "HOUSEHOLD", "P999999999").alias("resp_staff"),
        F.lit("1900-01-01 09:00:00").cast("timestamp_ntz").alias("start_time"), F.lit("1900-01-01 10:05:00").cast("timestamp_ntz").alias("end_time"),
    )
    return writers.schedule_action(t, requests, NOW).accepted.changes.select(
        "PEOPLE_ORG_CODE_ID", "ACTION_ID", "SCHEDULED_DATE", "EXECUTION_DATE", "COMPLETED_BY", "COMPLETED", "ACADEMIC_YEAR", "ACADEMIC_TERM",
        "ACADEMIC_SESSION", "REQUIRED", "DURATION", "CREATE_OPID", "ACTIONSCHEDULE_ID",
    )


def _action_requests(t):
    first = F.col("FIRST_NAME")
    return t["PEOPLE"].select(
        F.col("PEOPLE_CODE_ID").alias("people_code_id"), F.when(first == "BUILDING", "unknown").when(first == "Pat", "1-URGENT").otherwise("2-HIGH").alias("action_id"),
        F.when(first == "MACHINERY", "").otherwise("1999-12-24").alias("sched_date"), F.when(first == "HOUSEHOLD", "P999999999").alias("resp_staff"),
    )


@plan(f"""WITH {ACTION_REQ}
SELECT PEOPLE_CODE_ID AS people_code_id, concat_ws('; ', CASE WHEN action_id = 'unknown' THEN 'action_id ''unknown'' not found' END,
  CASE WHEN resp_staff IS NOT NULL THEN 'resp_staff ''' || resp_staff || ''' not found' END) AS errors
FROM req WHERE sched_date <> '' AND (action_id = 'unknown' OR resp_staff IS NOT NULL)""")
def refused_actions(t):
    """Requests that name unknown actions or people, with what is wrong about each."""
    return writers.schedule_action(t, _action_requests(t), NOW).rejected.select("people_code_id", F.concat_ws("; ", "errors").alias("errors"))


@plan(f"""WITH {ACTION_REQ}
SELECT '1999-11-23' AS CREATE_DATE, '1999-11-23 09:30:00' AS CREATE_TIME, 'DYNFORMS' AS CREATE_OPID, '0001' AS CREATE_TERMINAL, '1999-11-23' AS REVISION_DATE, '1999-11-23 09:30:00' AS REVISION_TIME,
  'DYNFORMS' AS REVISION_OPID, '0001' AS REVISION_TERMINAL, '*' AS ABT_JOIN, count(*) AS n FROM req WHERE sched_date <> '' AND action_id <> 'unknown' AND resp_staff IS NULL HAVING count(*) > 0""")
def action_audit(t):
    """The audit columns that every inserted action carries."""
    stamps = [f"{k}_{c}" for k in ("CREATE", "REVISION") for c in ("DATE", "TIME", "OPID", "TERMINAL")] + ["ABT_JOIN"]
    rows = writers.schedule_action(t, _action_requests(t), NOW).accepted.changes
    return rows.groupBy(*[F.col(c).cast("string").alias(c) for c in stamps]).agg(F.count("*").alias("n"))


STOPS = """req AS (SELECT DISTINCT 'P' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS pid, CASE WHEN o_orderstatus = 'P' THEN '2-HIGH' ELSE o_orderpriority END AS reason FROM orders),
 ok AS (SELECT * FROM req WHERE reason IN (SELECT CODE_VALUE_KEY FROM CODE_STOPLIST WHERE STATUS <> 'I') AND pid IN (SELECT PEOPLE_CODE_ID FROM PEOPLE)),
 new AS (SELECT * FROM ok WHERE NOT EXISTS (SELECT 1 FROM STOPLIST s WHERE s.PEOPLE_CODE_ID = pid AND s.STOP_REASON = reason AND (s.CLEARED = 'N' OR s.CLEARED = 'Y' AND s.STOP_DATE = DATE '1999-11-23'))),
 again AS (SELECT s.*, reason FROM ok JOIN STOPLIST s ON s.PEOPLE_CODE_ID = pid AND s.STOP_REASON = reason AND s.CLEARED = 'Y' AND s.STOP_DATE = DATE '1999-11-23')"""
STOP_COMMENT = "'Batch entry Nov 23, 1999'"


def _stops(t):
    orders = t.databases["main"]._frame("orders")
    reason = F.when(F.col("o_orderstatus") == "P", "2-HIGH").otherwise(F.col("o_orderpriority"))
    asked = orders.select(F.concat(F.lit("P"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("PEOPLE_CODE_ID"), reason.alias("STOP_REASON"))
    return writers.insert_stops(t, asked, NOW)


@plan(f"""WITH {STOPS}
SELECT pid AS PEOPLE_CODE_ID, reason AS STOP_REASON, DATE '1999-11-23' AS STOP_DATE, CAST(NULL AS VARCHAR) AS CURRENT_CLEARED, 'N' AS NEW_CLEARED, CAST(NULL AS VARCHAR) AS CURRENT_COMMENTS, {STOP_COMMENT} AS NEW_COMMENTS FROM new
UNION ALL SELECT PEOPLE_CODE_ID, reason, STOP_DATE, CLEARED, 'N', COMMENTS, CASE WHEN length(coalesce(COMMENTS, '')) > 0 THEN COMMENTS || chr(13) || chr(10) || {STOP_COMMENT} ELSE {STOP_COMMENT} END FROM again""", texts=["STOP_DATE"])
def insert_stops(t):
    return _stops(t)["log"].select("PEOPLE_CODE_ID", "STOP_REASON", "STOP_DATE", "CURRENT_CLEARED", "NEW_CLEARED", "CURRENT_COMMENTS", "NEW_COMMENTS")


@plan(f"""WITH {STOPS}
SELECT PEOPLE_CODE_ID, STOP_REASON, CLEARED, count(*) AS n FROM (
  SELECT s.PEOPLE_CODE_ID, s.STOP_REASON, CASE WHEN a.PEOPLE_CODE_ID IS NOT NULL THEN 'N' ELSE s.CLEARED END AS CLEARED FROM STOPLIST s
    LEFT JOIN (SELECT DISTINCT PEOPLE_CODE_ID, reason FROM again) a ON a.PEOPLE_CODE_ID = s.PEOPLE_CODE_ID AND a.reason = s.STOP_REASON AND s.CLEARED = 'Y' AND s.STOP_DATE = DATE '1999-11-23'
  UNION ALL SELECT pid, reason, 'N' FROM new) GROUP BY ALL""")
def stop_list_after(t):
    return _stops(t)["STOPLIST"].new_state.groupBy("PEOPLE_CODE_ID", "STOP_REASON", "CLEARED").agg(F.count("*").alias("n"))


@plan(f"""WITH {CUR}, {MEETINGS}
SELECT td.PEOPLE_CODE_ID, td.EVENT_ID, td.SECTION, CALENDAR_DATE AS ATTENDANCE_DATE, CALENDAR_KEY AS CalendarKey, 'ABSENT' AS ATTENDANCE_STATUS, count(*) AS n
FROM TRANSCRIPTDETAIL td JOIN cur ON td.ACADEMIC_YEAR = cy AND td.ACADEMIC_TERM = ct
JOIN ACADEMIC a ON a.PEOPLE_CODE_ID = td.PEOPLE_CODE_ID AND a.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND a.ACADEMIC_TERM = td.ACADEMIC_TERM AND a.ACADEMIC_SESSION = td.ACADEMIC_SESSION
  AND a.STATUS <> 'N' AND PRIMARY_FLAG = 'Y' AND ENROLL_SEPARATION IN (SELECT CODE_VALUE_KEY FROM CODE_ENROLLMENT WHERE REQUIRE_SEPDATE = 'N')
JOIN SECTIONS s ON s.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND s.ACADEMIC_TERM = td.ACADEMIC_TERM AND s.ACADEMIC_SESSION = td.ACADEMIC_SESSION AND s.EVENT_ID = td.EVENT_ID AND s.EVENT_SUB_TYPE = td.EVENT_SUB_TYPE AND s.SECTION = td.SECTION AND s.EVENT_STATUS = 'A'
JOIN meet m ON m.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND m.ACADEMIC_TERM = td.ACADEMIC_TERM AND m.ACADEMIC_SESSION = td.ACADEMIC_SESSION AND m.EVENT_ID = td.EVENT_ID AND m.EVENT_SUB_TYPE = td.EVENT_SUB_TYPE AND m.SECTION = td.SECTION
WHERE ADD_DROP_WAIT = 'A' AND NOT EXISTS (SELECT 1 FROM TRANATTENDANCE ta WHERE ta.CalendarKey = m.CALENDAR_KEY AND ta.PEOPLE_CODE_ID = td.PEOPLE_CODE_ID)
  AND FINAL_GRADE NOT IN {WITHDRAWN} AND STATUS_DATE > CALENDAR_DATE AND s.CREATE_DATE + (s.CREATE_TIME - TIMESTAMP '1900-01-01') < CALENDAR_DATE + (m.END_TIME - TIMESTAMP '1900-01-01') GROUP BY ALL""", texts=["ATTENDANCE_DATE"])
def late_registrant_absences(t):
    return writers.late_registrant_absences(t, NOW).changes.groupBy(
        "PEOPLE_CODE_ID", "EVENT_ID", "SECTION", "ATTENDANCE_DATE", "CalendarKey", "ATTENDANCE_STATUS"
    ).agg(F.count("*").alias("n"))


@plan(f"""WITH c AS (SELECT {', '.join('cd.' + c for c in KEY6.split(', '))}, CALENDAR_DATE, first(CALENDAR_KEY ORDER BY START_TIME, CALENDAR_KEY) AS k FROM CALENDARDETAIL cd JOIN CALENDAR ca ON ca.EVENT_KEY = cd.EVENT_KEY GROUP BY ALL),
 w AS (SELECT ta.PEOPLE_CODE_ID, {', '.join('ta.' + c for c in KEY6.split(', '))}, k, max(TranAttendanceId) AS id FROM TRANATTENDANCE ta JOIN c USING ({KEY6}) WHERE CALENDAR_DATE = ATTENDANCE_DATE AND CalendarKey IS NULL GROUP BY ALL)
SELECT id AS TranAttendanceId, k AS CalendarKey FROM w WHERE NOT EXISTS (SELECT 1 FROM TRANATTENDANCE x WHERE x.PEOPLE_CODE_ID = w.PEOPLE_CODE_ID AND x.EVENT_ID = w.EVENT_ID AND x.SECTION = w.SECTION
  AND x.ACADEMIC_YEAR = w.ACADEMIC_YEAR AND x.ACADEMIC_TERM = w.ACADEMIC_TERM AND x.CalendarKey = w.k)""")
def fill_calendar_key(t):
    return writers.fill_calendar_key(t).changes.select("TranAttendanceId", "CalendarKey")


AID = """b AS (SELECT DISTINCT BATCH FROM CHARGECREDIT WHERE ANTICIPATED_FLAG = 'Y' AND CHARGE_CREDIT_CODE NOT IN ('5-LOW', '3-MEDIUM')),
 gone AS (SELECT CHARGECREDITNUMBER FROM CHARGECREDIT WHERE BATCH IN (SELECT BATCH FROM b))"""


@plan(f"""WITH {AID}
SELECT 'CHARGECREDIT' AS table_name, count(*) AS n FROM gone UNION ALL SELECT 'InvoiceDetail', count(*) FROM InvoiceDetail WHERE ChargeCreditNumber IN (SELECT * FROM gone)
UNION ALL SELECT 'ChargeCreditTax', count(*) FROM ChargeCreditTax WHERE CHARGECREDITNUMBER IN (SELECT * FROM gone) UNION ALL SELECT 'BATCHHEADER', count(*) FROM BATCHHEADER WHERE BATCH_NUMBER IN (SELECT BATCH FROM b)""")
def purge_anticipated_aid(t):
    purged = writers.purge_anticipated_aid(t, TUESDAY, ["5-LOW", "3-MEDIUM"])
    out = None
    for name, c in purged.items():
        part = c.changes.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@plan("""WITH c1 AS (SELECT * FROM CALENDAR WHERE NOT (MEETING_TYPE = 'CLASS' AND EVENT_TYPE = 'COURSE' AND CALENDAR_DATE = DATE '1999-10-20' AND EVENT_KEY IN (SELECT CALENDARDET_EVENT_KEY FROM SECTIONSCHEDULE)))
SELECT s.SectionId, CAST(coalesce(n, SCHEDULED_MEETINGS) AS INTEGER) AS SCHEDULED_MEETINGS FROM SECTIONS s LEFT JOIN (SELECT d.EVENT_ID, d.SECTION, count(*) AS n FROM c1 JOIN CALENDARDETAIL d ON d.EVENT_KEY = c1.EVENT_KEY
  WHERE ACADEMIC_YEAR = '1999' AND ACADEMIC_TERM = 'FALL' GROUP BY 1, 2) x ON s.ACADEMIC_YEAR = '1999' AND s.ACADEMIC_TERM = 'FALL' AND x.EVENT_ID = s.EVENT_ID AND x.SECTION = s.SECTION""")
def update_section_meetings(t):
    updated = writers.update_section_meetings(t, "1999", "FALL", ("1999", "FALL"), ["1999-10-20"], {"1999-10-11": "1999-10-12"})
    return updated["SECTIONS"].new_state.select("SectionId", "SCHEDULED_MEETINGS")


@plan("""SELECT CALENDAR_KEY, CASE WHEN moved THEN DATE '1999-10-12' ELSE CALENDAR_DATE END AS CALENDAR_DATE, CASE WHEN moved THEN 'TUE' ELSE DAY_OF_WEEK END AS DAY_OF_WEEK FROM (
  SELECT *, CALENDAR_DATE = DATE '1999-10-11' AND date_diff('minute', START_TIME, END_TIME) > 10 AS moved FROM CALENDAR WHERE CALENDAR_DATE <> DATE '1999-10-20')""", texts=["CALENDAR_DATE"])
def shifted_calendar(t):
    updated = writers.update_section_meetings(t, "1999", "FALL", ("1999", "FALL"), ["1999-10-20"], {"1999-10-11": "1999-10-12"})
    return updated["CALENDAR"].new_state.select("CALENDAR_KEY", "CALENDAR_DATE", "DAY_OF_WEEK")


# ---------------------------------------------------------------- identity

OPERATORS = {"Dossier": None, "Approval": ("REGSTAFF", "REGISTRAR")}
DESIRED = """roles AS (SELECT ar.AppRoleId, crt.CODE_VALUE_KEY AS rt FROM SiteMapRole sm JOIN PersonTypeRole ptr ON ptr.RoleName = sm.RoleName JOIN CODE_RECORDTYPE crt ON crt.RecordTypeId = ptr.PersonTypeId
  JOIN AppRole ar ON ar.Name = sm.RoleName WHERE ar.ApplicationId = 1),
 ops AS (SELECT pu.UserName, up.PROFILE_CODE FROM ABT_USERPROFILE up JOIN ABT_USERS u ON u.OPERATOR_ID = up.OPERATOR_ID AND u.STATUS = 'A' JOIN PEOPLE p ON p.PEOPLE_CODE_ID = u.PEOPLE_CODE_ID JOIN PersonUser pu ON pu.PersonId = p.PersonId),
 named AS (SELECT pu.UserName, AppRoleId FROM PersonUser pu JOIN PEOPLE p ON p.PersonId = pu.PersonId JOIN PEOPLETYPE pt ON pt.PEOPLE_ID = p.PEOPLE_ID JOIN CODE_RECORDTYPE crt ON crt.CODE_VALUE_KEY = pt.PEOPLE_TYPE AND crt.STATUS = 'A'
    JOIN roles ON rt = pt.PEOPLE_TYPE UNION SELECT UserName, 3 FROM ops UNION SELECT UserName, 4 FROM ops WHERE PROFILE_CODE IN ('REGSTAFF', 'REGISTRAR')),
 desired AS (SELECT n.UserName, AppUserId, AppRoleId FROM named n LEFT JOIN AppUser au ON au.UserName = n.UserName
    UNION SELECT NULL, aur.AppUserId, aur.AppRoleId FROM AppUser au JOIN AppUserRole aur ON aur.AppUserId = au.AppUserId WHERE Password <> ''),
 gone AS (SELECT AppUserId FROM AppUser WHERE Password = '' AND ApplicationId = 1 AND UserName NOT IN (SELECT UserName FROM PersonUser)),
 fresh AS (SELECT UserName, Email, (SELECT max(AppUserId) FROM AppUser) + row_number() OVER (ORDER BY UserName, Email) AS id FROM (
    SELECT DISTINCT d.UserName, e.Email FROM desired d LEFT JOIN PersonUser pu ON pu.UserName = d.UserName LEFT JOIN PEOPLE p ON p.PersonId = pu.PersonId
    LEFT JOIN EmailAddress e ON e.EmailAddressId = p.PrimaryEmailId WHERE d.AppUserId IS NULL)),
 final AS (SELECT DISTINCT coalesce(AppUserId, id) AS AppUserId, AppRoleId FROM desired LEFT JOIN fresh USING (UserName))"""


@plan("""SELECT ar.AppRoleId, crt.CODE_VALUE_KEY AS RECORDTYPE FROM SiteMapRole sm JOIN PersonTypeRole ptr ON ptr.RoleName = sm.RoleName JOIN CODE_RECORDTYPE crt ON crt.RecordTypeId = ptr.PersonTypeId
  JOIN AppRole ar ON ar.Name = sm.RoleName WHERE ar.ApplicationId = 1""")
def role_map(t):
    return identity.role_map(t, "portal", "identity")


@plan(f"WITH {DESIRED} SELECT UserName, AppUserId, CAST(AppRoleId AS BIGINT) AS AppRoleId FROM desired")
def desired_roles(t):
    return identity.desired_roles(t, "portal", OPERATORS, "identity")


@plan(f"""WITH {DESIRED}
SELECT 'DELETE' AS action, AppUserId, UserName, Email FROM AppUser WHERE AppUserId IN (SELECT * FROM gone) UNION ALL SELECT 'INSERT', CAST(id AS BIGINT), UserName, Email FROM fresh""")
def sync_identity_users(t):
    return identity.sync_identity(t, "portal", OPERATORS, "identity")["AppUser"].changes.select("action", "AppUserId", "UserName", "Email")


@plan(f"""WITH {DESIRED}
SELECT 'INSERT' AS action, CAST(AppUserId AS BIGINT) AS AppUserId, CAST(AppRoleId AS BIGINT) AS AppRoleId FROM final f WHERE NOT EXISTS (SELECT 1 FROM AppUserRole t WHERE t.AppUserId = f.AppUserId AND t.AppRoleId = f.AppRoleId)
UNION ALL SELECT 'DELETE', AppUserId, AppRoleId FROM AppUserRole t WHERE (AppRoleId IN (SELECT AppRoleId FROM roles) OR AppUserId IN (SELECT AppUserId FROM gone)) AND NOT EXISTS (SELECT 1 FROM final f WHERE t.AppUserId = f.AppUserId AND t.AppRoleId = f.AppRoleId)""")
def sync_identity_roles(t):
    return identity.sync_identity(t, "portal", OPERATORS, "identity")["AppUserRole"].changes.select("action", "AppUserId", "AppRoleId")


@plan("""SELECT AppUserId, CASE WHEN known THEN name ELSE UserName END AS UserName, CASE WHEN known THEN lower(name) ELSE LoweredUserName END AS LoweredUserName, CAST(11 AS INTEGER) AS CreationAppStoreId, CAST(12 AS INTEGER) AS AuthenticationAppStoreId
FROM (SELECT au.*, pu.UserName AS name, pu.UserName IS NOT NULL AS known FROM AppUser au LEFT JOIN (SELECT min(UserName) AS UserName FROM PersonUser GROUP BY lower(rtrim(UserName))) pu ON lower(rtrim(pu.UserName)) = lower(rtrim(au.UserName))) WHERE known""")
def correct_identity(t):
    return identity.correct_identity(t, "portal", "identity").new_state.select("AppUserId", "UserName", "LoweredUserName", "CreationAppStoreId", "AuthenticationAppStoreId")


@plan("""SELECT 'AppRoleClaim' AS table_name, AppClaimId AS entry_id FROM AppClaim c WHERE ApplicationId = 1 AND NOT EXISTS (SELECT 1 FROM AppRoleClaim g WHERE g.AppRoleId = 1 AND g.AppClaimId = c.AppClaimId)
UNION ALL SELECT 'SiteMapOptionRole', SiteMapOptionId FROM SiteMapOption WHERE SiteMapOptionId NOT IN (SELECT SiteMapOptionId FROM SiteMapOptionRole WHERE SiteMapRoleId = 1)
UNION ALL SELECT 'SiteMapOptionDetailRole', SiteMapOptionDetailId FROM SiteMapOptionDetail WHERE SiteMapOptionDetailId NOT IN (SELECT SiteMapOptionDetailId FROM SiteMapOptionDetailRole WHERE SiteMapRoleId = 1)""")
def grant_all(t):
    granted = identity.grant_all(t, "Student", "identity", 1)
    keys = {"AppRoleClaim": "AppClaimId", "SiteMapOptionRole": "SiteMapOptionId", "SiteMapOptionDetailRole": "SiteMapOptionDetailId"}
    out = None
    for name, key in keys.items():
        part = granted[name].changes.select(F.lit(name).alias("table_name"), F.col(key).alias("entry_id"))
        out = part if out is None else out.unionByName(part)
    return out


def _migrated(t):
    return identity.migrate_settings(t, "old", "new", "old", "new", "portal", NOW)


MIGRATED = """opt AS (SELECT * FROM NEW_SiteMapOption UNION ALL SELECT (SELECT max(SiteMapOptionId) FROM NEW_SiteMapOption) + row_number() OVER (ORDER BY LinkId), LinkId, ExternalLink, IsCustom
  FROM SiteMapOption WHERE IsCustom AND LinkId NOT IN (SELECT LinkId FROM NEW_SiteMapOption))"""


@plan(f"""WITH {MIGRATED}
SELECT n.SiteMapOptionId, nr.SiteMapRoleId, r.IsVisible FROM SiteMapOptionRole r JOIN SiteMapOption o ON o.SiteMapOptionId = r.SiteMapOptionId JOIN SiteMapRole orr ON orr.SiteMapRoleId = r.SiteMapRoleId
JOIN opt n ON n.LinkId = o.LinkId JOIN NEW_SiteMapRole nr ON nr.RoleName = orr.RoleName
WHERE NOT EXISTS (SELECT 1 FROM NEW_SiteMapOptionRole x WHERE x.SiteMapOptionId = n.SiteMapOptionId AND x.SiteMapRoleId = nr.SiteMapRoleId)""")
def migrate_menu_links(t):
    return _migrated(t)["SiteMapOptionRole"].changes.select("SiteMapOptionId", "SiteMapRoleId", "IsVisible")


@plan("""WITH src AS (SELECT * FROM InstitutionSetting WHERE AreaName = 'Theme')
SELECT coalesce(n.LabelName, s.LabelName) AS LabelName, CASE WHEN s.LabelName IS NOT NULL THEN s.Setting ELSE n.Setting END AS Setting, s.LabelName IS NOT NULL AS revised, n.LabelName IS NULL AND s.LabelName IS NOT NULL AS created
FROM NEW_InstitutionSetting n FULL JOIN src s ON s.AreaName = n.AreaName AND s.SectionName = n.SectionName AND s.LabelName = n.LabelName""")
def migrate_institution_settings(t):
    return _migrated(t)["InstitutionSetting"].new_state.select(
        "LabelName", "Setting", F.col("RevisionDatetime").isNotNull().alias("revised"), F.col("CreateDatetime").isNotNull().alias("created")
    )


DETAILS = """fresh AS (SELECT d.LinkId FROM SiteMapOptionDetail d JOIN SiteMapOption o ON o.SiteMapOptionId = d.SiteMapOptionId JOIN opt n ON n.LinkId = o.LinkId
  WHERE d.IsCustom AND d.LinkId NOT IN (SELECT LinkId FROM NEW_SiteMapOptionDetail)),
det AS (SELECT SiteMapOptionDetailId, LinkId FROM NEW_SiteMapOptionDetail UNION ALL
  SELECT (SELECT coalesce(max(SiteMapOptionDetailId), 0) FROM NEW_SiteMapOptionDetail) + row_number() OVER (ORDER BY LinkId), LinkId FROM fresh)"""
ROLES = """gone AS (SELECT Name FROM AppRole WHERE ApplicationId = 1 AND Name NOT IN (SELECT Name FROM NEW_AppRole)),
rol AS (SELECT AppRoleId, Name FROM NEW_AppRole UNION ALL SELECT (SELECT max(AppRoleId) FROM NEW_AppRole) + row_number() OVER (ORDER BY Name), Name FROM gone)"""


@plan(f"""WITH {MIGRATED}, {DETAILS}, {ROLES}
SELECT 'SiteMapOption' AS table_name, SiteMapOptionId AS entry_id, LinkId AS name FROM opt WHERE SiteMapOptionId NOT IN (SELECT SiteMapOptionId FROM NEW_SiteMapOption)
UNION ALL SELECT 'SiteMapOptionDetail', SiteMapOptionDetailId, LinkId FROM det WHERE SiteMapOptionDetailId NOT IN (SELECT SiteMapOptionDetailId FROM NEW_SiteMapOptionDetail)
UNION ALL SELECT 'AppRole', AppRoleId, Name FROM rol WHERE AppRoleId NOT IN (SELECT AppRoleId FROM NEW_AppRole)""")
def migrate_entries(t):
    """New menu entries, details and roles with the ids they get (no custom site role is among the derived ones)."""
    out, parts = _migrated(t), {"SiteMapRole": ("SiteMapRoleId", "RoleName"), "SiteMapOption": ("SiteMapOptionId", "LinkId"),
                                "SiteMapOptionDetail": ("SiteMapOptionDetailId", "LinkId"), "AppRole": ("AppRoleId", "Name")}
    rows = [out[n].changes.select(F.lit(n).alias("table_name"), F.col(k).alias("entry_id"), F.col(v).alias("name")) for n, (k, v) in parts.items()]
    return sets.union_branches(rows)


@plan(f"""WITH {MIGRATED}, {DETAILS}
SELECT n.SiteMapOptionDetailId, nr.SiteMapRoleId, r.IsVisible FROM SiteMapOptionDetailRole r JOIN SiteMapOptionDetail o ON o.SiteMapOptionDetailId = r.SiteMapOptionDetailId
JOIN SiteMapRole orr ON orr.SiteMapRoleId = r.SiteMapRoleId JOIN det n ON n.LinkId = o.LinkId JOIN NEW_SiteMapRole nr ON nr.RoleName = orr.RoleName
WHERE NOT EXISTS (SELECT 1 FROM NEW_SiteMapOptionDetailRole x WHERE x.SiteMapOptionDetailId = n.SiteMapOptionDetailId AND x.SiteMapRoleId = nr.SiteMapRoleId)""")
def migrate_detail_links(t):
    return _migrated(t)["SiteMapOptionDetailRole"].changes.select("SiteMapOptionDetailId", "SiteMapRoleId", "IsVisible")


@plan(f"""WITH {ROLES}
SELECT n.AppRoleId, c.AppClaimId FROM AppRoleClaim g JOIN AppRole o ON o.AppRoleId = g.AppRoleId JOIN rol n ON n.Name = o.Name
JOIN AppClaim oc ON oc.AppClaimId = g.AppClaimId JOIN NEW_AppClaim c ON c.Name = oc.Name
WHERE NOT EXISTS (SELECT 1 FROM NEW_AppRoleClaim x WHERE x.AppRoleId = n.AppRoleId AND x.AppClaimId = c.AppClaimId)""")
def migrate_role_claims(t):
    return _migrated(t)["AppRoleClaim"].changes.select("AppRoleId", "AppClaimId")


# ---------------------------------------------------------------- small updates and metadata


@plan("""SELECT OBJECT_NAME, HELP_NAME, count(*) AS n FROM (SELECT OBJECT_NAME, CASE WHEN coalesce(rtrim(HELP_NAME), '') <> '' THEN HELP_NAME WHEN OBJECT_NAME = '1-URGENT' THEN 'urgent.html' WHEN OBJECT_NAME = '2-HIGH' THEN 'high.html' ELSE HELP_NAME END AS HELP_NAME
FROM ABT_OBJECTS) GROUP BY ALL""")
def fix_help_links(t):
    fixed = writers.fix_help_links(t, {"1-URGENT": "urgent.html", "2-HIGH": "high.html"}, NOW, "ME")
    return fixed.new_state.groupBy("OBJECT_NAME", "HELP_NAME").agg(F.count("*").alias("n"))


@plan("""SELECT a.SECURITY_ID, a.TABLE_NAME, b.EDIT_RIGHTS, b.DELETE_RIGHTS FROM ABT_TABLESECURITY a JOIN ABT_TABLESECURITY b ON b.TABLE_NAME = a.TABLE_NAME AND b.SECURITY_ID = '1-URGENT' AND (b.EDIT_RIGHTS = 'Y' OR b.DELETE_RIGHTS = 'Y')
WHERE a.SECURITY_ID = '2-HIGH' AND (a.EDIT_RIGHTS <> b.EDIT_RIGHTS OR a.DELETE_RIGHTS <> b.DELETE_RIGHTS)""")
def copy_rights(t):
    return writers.copy_rights(t, "1-URGENT", "2-HIGH").changes.select("SECURITY_ID", "TABLE_NAME", "EDIT_RIGHTS", "DELETE_RIGHTS")


def _family_counts(parts):
    out = None
    for member in metadata.FAMILY:
        part = parts[member.table].changes.agg(F.count("*").alias("n")).select(F.lit(member.table).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def family_sql(rights: str) -> str:
    keys = {"id": "(SELECT VIEW_ID FROM VISTAVIEW WHERE VIEW_DB_NAME = 'v42')", "name": "('v42')"}
    return " UNION ALL ".join(
        f"SELECT '{x.table}' AS table_name, count(*) AS n FROM {x.table} WHERE {x.key} IN {keys[x.by]}" + (rights if x.table == "ABT_TABLESECURITY" else "")
        for x in metadata.FAMILY
    )


@plan(family_sql(""))
def view_metadata_delete(t):
    return _family_counts(metadata.view_metadata_delete(t, "v42", NOW))


@plan(family_sql(" AND SECURITY_ID <> 'SYSTEM'"))
def view_metadata_copy(t):
    empty = {x.table: t[x.table].limit(0) for x in metadata.FAMILY}
    return _family_counts(metadata.view_metadata_copy(t.alias(target=empty), 42, "main", "target"))


# ---------------------------------------------------------------- notices

MISSING = f"""missing AS (SELECT {', '.join('td.' + c for c in KEY6.split(', '))}, CALENDAR_KEY, CALENDAR_DATE, s.CURRICULUM, count(DISTINCT td.PEOPLE_CODE_ID) AS Missing
FROM TRANSCRIPTDETAIL td JOIN cur ON td.ACADEMIC_YEAR = cy AND td.ACADEMIC_TERM = ct JOIN ACADEMIC a ON a.PEOPLE_CODE_ID = td.PEOPLE_CODE_ID AND a.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND a.ACADEMIC_TERM = td.ACADEMIC_TERM
  AND a.ACADEMIC_SESSION = td.ACADEMIC_SESSION AND ENROLL_SEPARATION = 'ENRL' JOIN SECTIONS s ON s.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND s.ACADEMIC_TERM = td.ACADEMIC_TERM AND s.ACADEMIC_SESSION = td.ACADEMIC_SESSION
  AND s.EVENT_ID = td.EVENT_ID AND s.EVENT_SUB_TYPE = td.EVENT_SUB_TYPE AND s.SECTION = td.SECTION AND s.EVENT_STATUS = 'A'
JOIN meet m ON m.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND m.ACADEMIC_TERM = td.ACADEMIC_TERM AND m.ACADEMIC_SESSION = td.ACADEMIC_SESSION AND m.EVENT_ID = td.EVENT_ID AND m.EVENT_SUB_TYPE = td.EVENT_SUB_TYPE AND m.SECTION = td.SECTION
WHERE ADD_DROP_WAIT = 'A' AND FINAL_GRADE NOT IN {WITHDRAWN} AND CALENDAR_DATE BETWEEN DATE '1999-11-15' AND DATE '1999-11-21' AND s.SECTION NOT ILIKE 'MIS%'
  AND NOT EXISTS (SELECT 1 FROM TRANATTENDANCE ta WHERE ta.CalendarKey = m.CALENDAR_KEY AND ta.PEOPLE_CODE_ID = td.PEOPLE_CODE_ID) GROUP BY ALL)"""


@plan(f"""WITH {CUR}, {MEETINGS}, {MISSING}
SELECT CODE_XVAL AS fromId, p.PEOPLE_CODE_ID AS toId, 'Attendance Not Taken' AS subject, '<p>Dear Professor ' || p.LAST_NAME || ',</p><p>Attendance is missing for ' || Missing || ' ' || CASE WHEN Missing > 1 THEN 'students' ELSE 'student' END
  || ' of <strong>' || m.EVENT_ID || ' / ' || m.SECTION || '</strong> on <strong>' || strftime(CALENDAR_DATE, '%A, %B %-d, %Y') || '</strong>. Please record it.</p>' AS body
FROM missing m JOIN SECTIONPER sp USING ({KEY6}) JOIN PEOPLE p ON p.PEOPLE_CODE_ID = sp.PERSON_CODE_ID LEFT JOIN CODE_CURRICULUM ON CODE_VALUE_KEY = CURRICULUM WHERE PERCENTAGE > 0""")
def attendance_not_taken(t):
    return notices.attendance_not_taken(t, TUESDAY).select("fromId", "toId", "subject", "body")


@plan(f"""WITH {CUR}, {MEETINGS}, early AS (SELECT {', '.join('td.' + c for c in KEY6.split(', '))}, m.CALENDAR_KEY, CALENDAR_DATE, count(*) AS Early FROM TRANSCRIPTDETAIL td JOIN cur ON td.ACADEMIC_YEAR = cy AND td.ACADEMIC_TERM = ct
  JOIN SECTIONS s USING ({KEY6}) JOIN meet m USING ({KEY6}) JOIN TRANATTENDANCE ta ON ta.CalendarKey = m.CALENDAR_KEY AND ta.PEOPLE_ID = td.PEOPLE_ID
  WHERE s.EVENT_STATUS = 'A' AND ADD_DROP_WAIT = 'A' AND CALENDAR_DATE + (m.START_TIME - TIMESTAMP '1900-01-01') > TIMESTAMP '1999-11-23 09:30:00' GROUP BY ALL)
SELECT p.PEOPLE_CODE_ID AS toId, '<p>Dear Professor ' || p.LAST_NAME || CASE WHEN coalesce(p.SUFFIX, '') = '' THEN '' ELSE ' ' || p.SUFFIX END || ',</p><p>You recorded attendance for ' || Early || ' ' || CASE WHEN Early > 1 THEN 'students' ELSE 'student' END
  || ' of <strong>' || e.EVENT_ID || ' / ' || e.SECTION || '</strong> for the meeting on <strong>' || strftime(CALENDAR_DATE, '%A, %B %-d, %Y') || '</strong>, which has not taken place yet.</p>' AS body
FROM early e JOIN SECTIONPER sp USING ({KEY6}) JOIN PEOPLE p ON p.PEOPLE_CODE_ID = sp.PERSON_CODE_ID WHERE PERCENTAGE > 0""")
def attendance_early(t):
    return notices.attendance_early(t, NOW, "office@x.edu").select("toId", "body")


@plan(f"""WITH {CURID}
SELECT p.PEOPLE_CODE_ID AS toId, '<p>Dear ' || {FIRST} || ',</p><p>Happy birthday from all of us!</p>' AS body FROM PEOPLE p WHERE month(BIRTH_DATE) = 11 AND day(BIRTH_DATE) = 21
  AND p.PEOPLE_CODE_ID IN (SELECT a.PEOPLE_CODE_ID FROM ACADEMIC a JOIN ot ON ot.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND ot.ACADEMIC_TERM = a.ACADEMIC_TERM
    WHERE TermId = (SELECT cid FROM curid) AND a.STATUS <> 'N' AND ACADEMIC_FLAG = 'Y' AND EXISTS (SELECT 1 FROM TRANSCRIPTDETAIL td WHERE td.PEOPLE_CODE_ID = a.PEOPLE_CODE_ID AND td.ACADEMIC_YEAR = a.ACADEMIC_YEAR
      AND td.ACADEMIC_TERM = a.ACADEMIC_TERM AND td.ACADEMIC_SESSION = a.ACADEMIC_SESSION AND td.TRANSCRIPT_SEQ = a.TRANSCRIPT_SEQ AND td.ADD_DROP_WAIT = 'A'))
  AND NOT EXISTS (SELECT 1 FROM MESSAGEQUEUE q JOIN MESSAGERECIPIENTS r ON r.MESSAGEID = q.MESSAGEID AND r.RECIPIENTTYPE = 'to' AND r.PEOPLECODEID = p.PEOPLE_CODE_ID AND q.CREATE_DATE = DATE '1999-11-21' WHERE q.SUBJECT = 'Happy Birthday!')""")
def birthday(t):
    return notices.birthday(t, SUNDAY, "life@x.edu").select("toId", "body")


@plan(f"""WITH {CUR} SELECT td.PEOPLE_ID, td.PEOPLE_CODE_ID, EVENT_ID, SECTION, td.TRANSCRIPT_SEQ FROM TRANSCRIPTDETAIL td JOIN cur ON ACADEMIC_YEAR = cy AND ACADEMIC_TERM = ct WHERE ADD_DROP_WAIT = 'A'
  AND NOT EXISTS (SELECT 1 FROM ACADEMIC a WHERE a.PEOPLE_ID = td.PEOPLE_ID AND a.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND a.ACADEMIC_TERM = td.ACADEMIC_TERM AND a.TRANSCRIPT_SEQ = td.TRANSCRIPT_SEQ AND a.ACADEMIC_SESSION > '')""")
def rogue_registrations(t):
    return notices.rogue_registrations(t)


@plan(f"""WITH {CUR} SELECT td.PEOPLE_ID AS "uniqueKey", '<p>Registrations without a matching academic record:</p><p><strong><table class="merged"><thead><tr><th>ID</th><th>Name</th><th>Course</th><th>Rogue Sequence</th></tr></thead><tbody>' ||
  string_agg('<tr><td>' || td.PEOPLE_ID || '</td><td>' || p.FIRST_NAME || ' ' || p.LAST_NAME || '</td><td>' || EVENT_ID || ' / ' || SECTION || '</td><td>' || TRANSCRIPT_SEQ || '</td></tr>', '' ORDER BY EVENT_ID, SECTION, TRANSCRIPT_SEQ)
  || '</tbody></table></strong></p>' AS body FROM TRANSCRIPTDETAIL td JOIN cur ON ACADEMIC_YEAR = cy AND ACADEMIC_TERM = ct LEFT JOIN PEOPLE p ON p.PEOPLE_CODE_ID = td.PEOPLE_CODE_ID WHERE ADD_DROP_WAIT = 'A'
  AND NOT EXISTS (SELECT 1 FROM ACADEMIC a WHERE a.PEOPLE_ID = td.PEOPLE_ID AND a.ACADEMIC_YEAR = td.ACADEMIC_YEAR AND a.ACADEMIC_TERM = td.ACADEMIC_TERM AND a.TRANSCRIPT_SEQ = td.TRANSCRIPT_SEQ AND a.ACADEMIC_SESSION > '') GROUP BY td.PEOPLE_ID""")
def transcript_mismatch(t):
    return notices.transcript_mismatch(t, "self@x.edu", "registrar@x.edu").select("uniqueKey", "body")


# Tables of canceled sections, in place of the campus ones of these names.
CANCELED = {
    "ACTIONSCHEDULE": "CANCELED_ACTIONS", "ACTION": "CANCELED_ACTION", "TRANSCRIPTMARKETING": "CANCELED_DROPS", "SECTIONS": "CANCELED_SECTIONS",
    "CODE_EVENTSUBTYPE": "CANCELED_SUBTYPE",
}


def _canceled(t):
    frames = t.databases["main"]
    return t.alias(main={**{n: frames[n] for n in ("PEOPLE", "ABT_SETTINGS")}, **{n: frames._frame(c) for n, c in CANCELED.items()}})


@plan(f"""SELECT a.PEOPLE_ORG_CODE_ID AS toId, a.UNIQUE_KEY AS uniqueKey, 'Section canceled' AS subject, 'Dear ' || {FIRST} || ': ' ||
  CASE WHEN d.EVENT_ID IS NOT NULL THEN d.EVENT_ID || '/Lecture/' || d.SECTION || ' (Long & ' || d.EVENT_ID || ')' WHEN starts_with(ACTION_NAME, 'Section was canceled') THEN '01/' || split_part(ACTION_NAME, '/', 4) || '/' || split_part(ACTION_NAME, '/', 5)
  ELSE '(unknown)' END || ' is off.' AS body FROM CANCELED_ACTIONS a JOIN PEOPLE p ON p.PEOPLE_CODE_ID = a.PEOPLE_ORG_CODE_ID LEFT JOIN CANCELED_DROPS d ON d.PEOPLE_CODE_ID = a.PEOPLE_ORG_CODE_ID
  AND d.ACADEMIC_YEAR = a.ACADEMIC_YEAR AND d.ACADEMIC_TERM = a.ACADEMIC_TERM AND starts_with(ACTION_NAME, 'Canceled/') AND d.EVENT_ID = split_part(ACTION_NAME, '/', 2) AND d.SECTION = split_part(ACTION_NAME, '/', 3)
WHERE COMPLETED <> 'Y'""")
def section_canceled(t):
    """Messages to all who lost a section: told by the drop record, by the action's name, or not at all."""
    return notices.section_canceled(_canceled(t), "self@x.edu").select("toId", "uniqueKey", "subject", "body")


@plan("SELECT ACTIONSCHEDULE_ID, 'Y' AS COMPLETED, '1999-11-23' AS EXECUTION_DATE, 'P000000000' AS COMPLETED_BY FROM CANCELED_ACTIONS WHERE COMPLETED <> 'Y'")
def section_canceled_done(t):
    """The actions whose messages went out are completed."""
    frames = _canceled(t)
    done = notices.complete_actions(frames, notices.section_canceled(frames, "self@x.edu"), TUESDAY, "P000000000")
    return done.changes.select("ACTIONSCHEDULE_ID", "COMPLETED", F.col("EXECUTION_DATE").cast("string").alias("EXECUTION_DATE"), "COMPLETED_BY")


def table_sql(titles: str, rows: str, empty: str) -> str:
    heads = "".join(f"<th>{h}</th>" for h in titles.split("|"))
    return f"""'<table class="merged"><thead><tr>{heads}</tr></thead><tbody>' || coalesce(({rows}), '{empty}') || '</tbody></table>'"""


COURSE_ROWS = "SELECT string_agg('<tr><td>' || EVENT_ID || ': ' || replace(replace(replace(EVENT_LONG_NAME, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</td><td>' || SECTION || '</td></tr>', '' ORDER BY EVENT_ID, SECTION, EVENT_LONG_NAME) FROM {src} x WHERE x.PEOPLE_ID = a.PEOPLE_ID"
SYNC_ROWS = """SELECT string_agg('<tr><td>' || EVENT_ID || ': ' || replace(replace(replace(EVENT_LONG_NAME, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</td><td>' || SECTION || '</td><td>' || strftime(CALENDAR_DATE, '%a %m/%d') || '</td><td>' || strftime(START_TIME, '%-I:%M %p') || ' - ' || strftime(END_TIME, '%-I:%M %p')
 || '</td><td>' || CASE BUILDING_CODE WHEN 'ONLINE' THEN 'Online' ELSE 'Unknown' END || '</td><td>' || CASE ROOM_ID WHEN 'ZOOM' THEN 'Zoom' WHEN 'ONLINE' THEN 'Online' ELSE ROOM_ID END || '</td></tr>', '' ORDER BY CALENDAR_DATE, START_TIME, EVENT_ID, SECTION) FROM sync x WHERE x.PEOPLE_ID = a.PEOPLE_ID"""


@plan(f"""WITH {CURID}, {MEETINGS}, sm AS (SELECT td.PEOPLE_ID, td.EVENT_LONG_NAME, m.*, date_diff('minute', m.START_TIME, m.END_TIME) AS len, CALENDAR_DATE BETWEEN DATE '1999-11-22' AND DATE '1999-11-28' AS wk
   FROM TRANSCRIPTDETAIL td JOIN cur ON td.ACADEMIC_YEAR = cy AND td.ACADEMIC_TERM = ct JOIN SECTIONS s USING ({KEY6}) JOIN meet m USING ({KEY6}) WHERE s.EVENT_STATUS = 'A' AND ADD_DROP_WAIT = 'A'),
 sync AS (SELECT * FROM sm WHERE wk AND len > 10), asy AS (SELECT DISTINCT PEOPLE_ID, EVENT_ID, SECTION, EVENT_LONG_NAME FROM sm WHERE REGULAR_DAY = 'DIST'),
 hol AS (SELECT DISTINCT PEOPLE_ID, EVENT_ID, SECTION, EVENT_LONG_NAME FROM sm WHERE wk AND REGULAR_DAY <> 'DIST' AND len < 10),
 st AS (SELECT DISTINCT a.PEOPLE_ID, a.PEOPLE_CODE_ID FROM ACADEMIC a JOIN cur ON a.ACADEMIC_YEAR = cy AND a.ACADEMIC_TERM = ct WHERE ENROLL_SEPARATION = 'ENRL' AND (NONTRAD_PROGRAM <> 'LDRHS' OR NONTRAD_PROGRAM IS NULL)
   AND (a.PEOPLE_ID IN (SELECT PEOPLE_ID FROM sync) OR a.PEOPLE_ID IN (SELECT PEOPLE_ID FROM asy)))
SELECT a.PEOPLE_CODE_ID AS toId, '<p>Dear ' || {FIRST} || ',</p><p>' || CASE WHEN h THEN 'Your class schedule changes this week.' ELSE 'This is your class schedule for the week.' END || '</p>'
  || CASE WHEN h THEN '<p>Because of a holiday these courses work asynchronously this week.</p>' || {table_sql('Adjusted Courses|Section', COURSE_ROWS.format(src='hol'), '')} || '<p>All other classes follow their regular schedule.</p>' ELSE '' END
  || '<p>These ' || CASE WHEN h THEN 'remaining ' ELSE '' END || 'synchronous courses meet at their scheduled times.</p>' || {table_sql('Synchronous Courses|Section|Date|Time|Campus|Room', SYNC_ROWS, '<td>Nothing scheduled.</td><td></td><td></td><td></td><td></td><td></td>')}
  || '<p>These asynchronous courses have online work each week.</p>' || {table_sql('Asynchronous Courses|Section', COURSE_ROWS.format(src='asy'), '<td>Nothing scheduled.</td><td></td>')} AS body
FROM (SELECT st.*, PEOPLE_ID IN (SELECT PEOPLE_ID FROM hol) AS h FROM st) a JOIN PEOPLE p ON p.PEOPLE_CODE_ID = a.PEOPLE_CODE_ID""")
def weekly_schedule(t):
    return notices.weekly_schedule(t, SUNDAY, "self@x.edu").select("toId", "body")


QUEUE = f"""{PRIM}, {ALT}, {CAMP},
 msg AS (SELECT DISTINCT fm.PrimaryEmail AS "from", p.PEOPLE_CODE_ID AS toId, CASE WHEN FIRST_NAME = 'BUILDING' THEN 1 ELSE 0 END AS flag, p.LAST_NAME AS subject FROM PEOPLE p JOIN prim fm ON fm.pid = 'P900000001'),
 res AS (SELECT "from", toId, flag, CASE flag WHEN 0 THEN CampusEmail ELSE AlternateEmail END AS "to", subject FROM msg LEFT JOIN campusemail c ON c.pid = toId LEFT JOIN alternateemail a ON a.pid = toId)"""


def _queued(t):
    people = t["PEOPLE"]
    messages = people.select(
        F.lit("P900000001").alias("fromId"), F.col("PEOPLE_CODE_ID").alias("toId"), F.when(F.col("FIRST_NAME") == "BUILDING", 1).otherwise(0).alias("toTypeFlag"),
        F.col("LAST_NAME").alias("subject"), F.lit("hello").alias("body"), F.lit(1).alias("formatBodyFlag"), F.lit("x").alias("extra"),
        F.when(F.col("FIRST_NAME") == "FURNITURE", "P900000002").alias("ccId"),
    )
    return notices.queue_messages(t, messages.unionByName(messages), NOW, "<head>", "<foot>", "color:red")


@plan(f"""WITH {QUEUE}
SELECT CAST((SELECT max(MESSAGEID) FROM MESSAGEQUEUE) + row_number() OVER (ORDER BY "to", toId) AS BIGINT) AS MESSAGEID, subject AS SUBJECT,
  '<head><div style=''color:red''>hello</div><foot>' AS BODY, "from" AS SENDER_EMAIL FROM res WHERE "to" IS NOT NULL""")
def queue_messages(t):
    return _queued(t)["MESSAGEQUEUE"].changes.select("MESSAGEID", "SUBJECT", "BODY", "SENDER_EMAIL")


@plan(f"""WITH {QUEUE}
SELECT 'to' AS RECIPIENTTYPE, "to" AS EMAILADDRESS, toId AS PEOPLECODEID, count(*) AS n FROM res WHERE "to" IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'cc', PrimaryEmail, 'P900000002', count(*) FROM res JOIN PEOPLE p ON p.PEOPLE_CODE_ID = toId JOIN prim ON pid = 'P900000002' WHERE "to" IS NOT NULL AND p.FIRST_NAME = 'FURNITURE' GROUP BY ALL""")
def queue_recipients(t):
    return _queued(t)["MESSAGERECIPIENTS"].changes.groupBy("RECIPIENTTYPE", "EMAILADDRESS", "PEOPLECODEID").agg(F.count("*").alias("n"))
