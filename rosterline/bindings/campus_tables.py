"""Campus tables derived from the star schema, so that every plan runs on the given data.

Each derivation is one select that Spark and the checking database both run;
``{name}`` refers to a given table or to another derivation. Customers become
students, suppliers become instructors, order quarters become terms, and the
lines of one supplier, quarter and return flag form a section.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..models.campus import SCHEMAS
from ..session import prepare
from ..sources.registry import TableRegistry
from ..staging import stage

#: Derivations that many others read: computed once for each query.
STAGED = ("LINE", "SEC")
#: Given tables that a derivation reads dealt by one column: grouping by that and others and joining on it then move them once.
DEALT = {"LINE": {"lineitem": "l_orderkey"}}
GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")

TERM = "CASE quarter(o_orderdate) WHEN 1 THEN 'WINTER' WHEN 2 THEN 'SPRING' WHEN 3 THEN 'SUMMER' ELSE 'FALL' END"
YEAR = "CAST(year(o_orderdate) AS STRING)"
DAY = "CAST(o_orderdate AS DATE)"


def person(c: str) -> str:
    return f"'P' || lpad(CAST({c} AS STRING), 9, '0')"


def number(c: str) -> str:
    return f"lpad(CAST({c} AS STRING), 9, '0')"


def instructor(c: str) -> str:
    return f"'P9' || lpad(CAST({c} AS STRING), 8, '0')"


def at(time: str) -> str:
    return f"CAST('1900-01-01 {time}' AS {{NTZ}})"


KEY = (
    "y AS ACADEMIC_YEAR, term AS ACADEMIC_TERM, '01' AS ACADEMIC_SESSION, lpad(CAST(s AS STRING), 9, '0') AS EVENT_ID, 'LECT' AS EVENT_SUB_TYPE, "
    "CASE fi WHEN 0 THEN 'D01' WHEN 1 THEN 'H01' ELSE 'MIS1' END AS SECTION"
)
EVENT_CODE = "'SUP ' || right(lpad(CAST(s AS STRING), 9, '0'), 3) || ' LEC'"
SID = "yq * 10000000000 + s * 10 + fi"
START = f"CASE fi WHEN 2 THEN {at('10:30:00')} ELSE {at('09:00:00')} END"
END = f"CASE fi WHEN 0 THEN {at('11:00:00')} WHEN 1 THEN {at('09:05:00')} ELSE {at('12:00:00')} END"

DERIVED: dict[str, str] = {
    "LINE": f"""SELECT l_orderkey * 10 + l_linenumber AS k, o_orderkey, o_custkey AS cust, {YEAR} AS y, {TERM} AS term,
      CAST((year(o_orderdate) - 1990) * 10 + quarter(o_orderdate) AS BIGINT) AS yq, {DAY} AS d, s, f, CASE f WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS fi,
      q, disc, CAST(ship AS DATE) AS ship, o_orderpriority AS prio, o_orderstatus AS st
      FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS s, min(l_returnflag) AS f, min(l_quantity) AS q, min(l_discount) AS disc,
        max(l_shipdate) AS ship FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber) l JOIN {{orders}} ON o_orderkey = l_orderkey""",
    "SEC": f"SELECT {SID} AS sid, y, term, s, fi, min(d) AS d0, min(disc) AS disc0 FROM {{LINE}} GROUP BY {SID}, y, term, s, fi",
    "TRANSCRIPTDETAIL": f"""SELECT k AS TranscriptDetailId, 'P' AS PEOPLE_CODE, {number('cust')} AS PEOPLE_ID, {person('cust')} AS PEOPLE_CODE_ID, {KEY},
      CASE WHEN prio = '2-HIGH' THEN '002' ELSE '001' END AS TRANSCRIPT_SEQ, 'Med ' || CAST(s AS STRING) AS EVENT_MED_NAME, 'Long & ' || CAST(s AS STRING) AS EVENT_LONG_NAME,
      CASE WHEN disc >= 0.05 THEN 'X' ELSE 'C' END AS CREDIT_TYPE, q AS CREDIT, CASE WHEN q < 4 THEN 'W' WHEN q < 7 THEN NULL ELSE 'B' END AS FINAL_GRADE,
      CASE WHEN disc >= 0.09 THEN 'D' ELSE 'A' END AS ADD_DROP_WAIT, ship AS STATUS_DATE FROM {{LINE}}""",
    "RECORD": f"""SELECT o_custkey AS cust, {YEAR} AS y, {TERM} AS term, min(o_orderpriority) AS program, min(o_orderstatus) AS degree,
      max(o_orderpriority) AS curriculum, max(o_totalprice) AS price, count(*) AS n FROM {{orders}} GROUP BY o_custkey, {YEAR}, {TERM}""",
    "ACADEMIC": " UNION ALL ".join(
        f"""SELECT {number('cust')} AS PEOPLE_ID, {person('cust')} AS PEOPLE_CODE_ID, y AS ACADEMIC_YEAR, term AS ACADEMIC_TERM, '{session}' AS ACADEMIC_SESSION,
      '001' AS TRANSCRIPT_SEQ, program AS PROGRAM, degree AS DEGREE, curriculum AS CURRICULUM, 'DEP' AS DEPARTMENT, n AS CREDITS,
      CASE WHEN price < 60000 THEN 'WITH' WHEN price < 90000 THEN NULL ELSE 'ENRL' END AS ENROLL_SEPARATION, 'F' AS FULL_PART,
      CASE WHEN degree = 'P' THEN 'N' ELSE 'A' END AS STATUS, CASE WHEN program = '4-NOT SPECIFIED' THEN 'N' ELSE 'Y' END AS PRIMARY_FLAG, 'Y' AS ACADEMIC_FLAG,
      CASE WHEN degree = 'O' AND curriculum = '5-LOW' THEN 'G' ELSE 'N' END AS GRADUATED, CASE WHEN program = '3-MEDIUM' THEN 'LDRHS' END AS NONTRAD_PROGRAM
      FROM {{RECORD}}"""
        for session in ("01", "")
    ),
    "SECTIONS": f"""SELECT sid AS SectionId, {KEY}, CASE WHEN disc0 >= 0.06 THEN 'C' WHEN disc0 >= 0.04 THEN 'P' ELSE 'A' END AS EVENT_STATUS,
      'Med ' || CAST(s AS STRING) AS EVENT_MED_NAME, 'Long & ' || CAST(s AS STRING) AS EVENT_LONG_NAME, 'O000000001' AS ORG_CODE_ID, 'GRAD' AS PROGRAM, 'COL' AS COLLEGE, 'DEP' AS DEPARTMENT,
      CASE WHEN fi = 0 THEN 'BS' ELSE 'MS' END AS CURRICULUM, 0 AS SCHEDULED_MEETINGS, d0 AS CREATE_DATE, {at('10:00:00')} AS CREATE_TIME FROM {{SEC}}""",
    "SECTIONSCHEDULE": f"""SELECT sid AS SECTIONSCHEDULE_ID, {KEY}, CASE fi WHEN 0 THEN 'MON' WHEN 1 THEN 'DIST' ELSE 'THUR' END AS DAY,
      {START} AS START_TIME, {END} AS END_TIME, CASE WHEN fi = 2 THEN 'R' || CAST(s AS STRING) ELSE 'ONLINE' END AS ROOM_ID, sid AS CALENDARDET_EVENT_KEY FROM {{SEC}}""",
    "CALENDARDETAIL": f"SELECT sid AS EVENT_KEY, {KEY} FROM {{SEC}}",
    "CALENDAR": f"""SELECT sid * 10000 + month(d) * 100 + day(d) AS CALENDAR_KEY, sid AS EVENT_KEY, d AS CALENDAR_DATE,
      CASE fi WHEN 0 THEN 'MON' WHEN 1 THEN 'DIS' ELSE 'THU' END AS DAY_OF_WEEK, {START} AS START_TIME,
      CASE WHEN fi = 0 AND month(d) = 11 AND day(d) > 20 THEN {at('09:05:00')} ELSE {END} END AS END_TIME,
      CASE fi WHEN 0 THEN '60W' WHEN 1 THEN 'ONLINE' ELSE NULL END AS BUILDING_CODE, CASE fi WHEN 0 THEN 'ZOOM' WHEN 1 THEN 'ONLINE' ELSE 'R1' END AS ROOM_ID,
      'CLASS' AS MEETING_TYPE, 'COURSE' AS EVENT_TYPE FROM (SELECT DISTINCT {SID} AS sid, fi, d FROM {{LINE}}) m""",
    "SECTIONPER": f"SELECT {instructor('s')} AS PERSON_CODE_ID, {KEY}, CASE WHEN fi = 1 AND disc0 >= 0.01 THEN 0 ELSE 100 END AS PERCENTAGE FROM {{SEC}}",
    "FacultyAssistant": "SELECT 900000000000 + s + 1 AS AssistantId, sid AS SectionId, fi <> 1 AS CanAccessOverallGrades, disc0 < 0.02 AS CanSubmitOverallGrades FROM {SEC} WHERE fi <> 2",
    "TRANATTENDANCE": f"""SELECT k AS TranAttendanceId, 'P' AS PEOPLE_CODE, {number('cust')} AS PEOPLE_ID, {person('cust')} AS PEOPLE_CODE_ID, {KEY}, d AS ATTENDANCE_DATE,
      'PRESENT' AS ATTENDANCE_STATUS, CASE WHEN prio <> '5-LOW' THEN ({SID}) * 10000 + month(d) * 100 + day(d) END AS CalendarKey FROM {{LINE}} WHERE disc < 0.08""",
    "GRADEVALUES": f"""SELECT {YEAR} AS ACADEMIC_YEAR, {TERM} AS ACADEMIC_TERM, 'C' AS CREDIT_TYPE, 'W' AS GRADE, 'Y' AS WITHDRAWN_GRADE FROM {{orders}} GROUP BY 1, 2
      UNION ALL SELECT {YEAR}, {TERM}, 'C', 'B', 'N' FROM {{orders}} GROUP BY 1, 2""",
    "QUARTER": f"""SELECT {YEAR} AS y, {TERM} AS term, (year(o_orderdate) - 1990) * 10 + quarter(o_orderdate) AS yq, min({DAY}) AS start, max({DAY}) AS fin
      FROM {{orders}} GROUP BY 1, 2, 3""",
    "ACADEMICCALENDAR": " UNION ALL ".join(
        f"""SELECT y AS ACADEMIC_YEAR, term AS ACADEMIC_TERM, '0{n}' AS ACADEMIC_SESSION, CAST(yq * 10 + {n} AS INT) AS SessionPeriodId, start AS START_DATE,
      fin AS END_DATE, start - 60 AS PRE_REG_DATE, start - 30 AS REG_DATE, start + 14 AS GRADE_PENALTY_DATE, y AS FIN_AID_YEAR FROM {{QUARTER}}"""
        for n in (1, 2)
    ),
    "ABT_SETTINGS": """SELECT 'ACA_RECORDS' AS AREA_NAME, 'CURRENT_YT' AS SECTION_NAME, 'CURRENT_YEAR' AS LABEL_NAME, '1999' AS SETTING
      UNION ALL SELECT 'ACA_RECORDS', 'CURRENT_YT', 'CURRENT_TERM', 'FALL' UNION ALL SELECT 'SYSADMIN', 'DATABASE', 'VERSION', '9.1.4'
      UNION ALL SELECT 'OFFICES', 'OP' || CAST(s_suppkey AS STRING), CAST(s_nationkey AS STRING), CASE WHEN s_acctbal > 0 THEN 'Y' ELSE 'N' END FROM {supplier}""",
    "EVENT": """SELECT lpad(CAST(s_suppkey AS STRING), 9, '0') AS EVENT_ID, CASE WHEN s_acctbal < 0 THEN '' ELSE s_name END AS PUBLICATION_NAME_1,
      CASE WHEN s_acctbal > 8000 THEN 'I' ELSE 'A' END AS EVENT_STATUS, 'CUR' || CAST(s_nationkey AS STRING) AS CURRICULUM FROM {supplier}""",
    "sectioncrosstally": "SELECT lpad(CAST(s_suppkey AS STRING), 9, '0') AS EVENT_ID, 'LECT' AS EVENT_SUB_TYPE, 'D01' AS SECTION FROM {supplier} WHERE s_acctbal > 5000",
    "DEGREQEVENT": f"SELECT {YEAR} AS MATRIC_YEAR, {TERM} AS MATRIC_TERM, 'BS' AS CURRICULUM, lpad(CAST(l_suppkey AS STRING), 9, '0') AS EVENT_ID FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey WHERE l_quantity > 45",
    "CartSection": "SELECT DISTINCT cust AS PersonId, " + SID + " AS SectionId FROM {LINE} WHERE prio = '1-URGENT' AND st = 'O'",
    "PEOPLE": f"""SELECT c_custkey AS PersonId, {number('c_custkey')} AS PEOPLE_ID, {person('c_custkey')} AS PEOPLE_CODE_ID, c_mktsegment AS FIRST_NAME, c_name AS LAST_NAME,
      CAST(NULL AS STRING) AS PREFIX, CAST(NULL AS STRING) AS SUFFIX, DATE '1970-10-15' + CAST(floor(c_acctbal / 100) AS INT) AS BIRTH_DATE,
      CASE WHEN c_acctbal >= 0 THEN c_custkey END AS PrimaryEmailId, phone AS PrimaryPhoneId
      FROM {{customer}} LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS phone FROM {{orders}} GROUP BY o_custkey) p ON o_custkey = c_custkey
      UNION ALL SELECT 900000000000 + s_suppkey, '9' || lpad(CAST(s_suppkey AS STRING), 8, '0'), {instructor('s_suppkey')}, 'Pat', s_name, 'Dr.',
      CASE WHEN s_acctbal > 5000 THEN 'Jr.' END, DATE '1960-01-01', 900000000000 + s_suppkey, CAST(NULL AS BIGINT) FROM {{supplier}}""",
    "PEOPLETYPE": f"""SELECT {number('c_custkey')} AS PEOPLE_ID, {person('c_custkey')} AS PEOPLE_CODE_ID, 'STU' AS PEOPLE_TYPE FROM {{customer}}
      UNION ALL SELECT '9' || lpad(CAST(s_suppkey AS STRING), 8, '0'), {instructor('s_suppkey')}, 'FAC' FROM {{supplier}}
      UNION ALL SELECT '9' || lpad(CAST(s_suppkey AS STRING), 8, '0'), {instructor('s_suppkey')}, 'ADV' FROM {{supplier}} WHERE s_acctbal > 0""",
    "FACULTY": "SELECT '9' || lpad(CAST(s_suppkey AS STRING), 8, '0') AS PEOPLE_ID FROM {supplier} WHERE s_acctbal > -500",
    "ORGANIZATION": "SELECT 'O' || lpad(CAST(n_nationkey AS STRING), 9, '0') AS ORG_CODE_ID, 800000000000 + n_nationkey AS PrimaryEmailId FROM {nation}",
    "EmailAddress": f"""SELECT c_custkey AS EmailAddressId, {person('c_custkey')} AS PeopleOrgCodeId, 'c' || CAST(c_custkey AS STRING) || '@x.edu' AS Email, 'Campus' AS EmailType,
      CASE WHEN c_acctbal > 9000 THEN '0' ELSE '1' END AS IsActive, DATE '1995-01-01' AS CREATE_DATE, {at('08:00:00')} AS CREATE_TIME FROM {{customer}}
      UNION ALL SELECT 900000000000 + s_suppkey, {instructor('s_suppkey')}, 's' || CAST(s_suppkey AS STRING) || '@x.edu', 'Campus', '1', DATE '1995-01-01', {at('08:00:00')} FROM {{supplier}}
      UNION ALL SELECT 800000000000 + n_nationkey, 'O' || lpad(CAST(n_nationkey AS STRING), 9, '0'), 'n' || CAST(n_nationkey AS STRING) || '@x.org', 'Campus', '1', DATE '1995-01-01', {at('08:00:00')} FROM {{nation}}
      UNION ALL SELECT 700000000000 + o_orderkey, {person('o_custkey')}, 'o' || CAST(o_orderkey AS STRING) || '@y.com', CASE WHEN o_orderpriority = '1-URGENT' THEN 'Personal' ELSE 'Work' END,
        CASE WHEN o_orderstatus = 'P' THEN '0' ELSE '1' END, DATE '1995-01-01' + CAST((year(o_orderdate) - 1995) * 365 AS INT), {at('08:00:00')} FROM {{orders}}""",
    "PersonPhone": f"""SELECT o_orderkey AS PersonPhoneId, o_custkey AS PersonId, o_orderpriority AS PhoneType,
      CASE o_orderstatus WHEN 'O' THEN '77' WHEN 'F' THEN '33' ELSE '7960' END || lpad(CAST(o_custkey AS STRING), CASE WHEN o_orderstatus = 'P' THEN 7 ELSE 9 END, '0') AS PhoneNumber,
      CASE WHEN month(o_orderdate) <= 6 THEN 240 ELSE 100 END AS CountryId, {DAY} AS Create_Date, {at('08:00:00')} AS Create_Time FROM {{orders}}""",
    "DialingCodes": "SELECT 77 AS CountryId, 33 AS Prefix, 11 AS NumberLength UNION ALL SELECT 141, 60, 11 UNION ALL SELECT 101, 91, 12 UNION ALL SELECT 55, 225, 11",
    "ADDRESSSCHEDULE": f"""SELECT o_orderkey AS SEQUENCE_NO, {person('o_custkey')} AS PEOPLE_ORG_CODE_ID, CASE WHEN o_orderpriority = '5-LOW' THEN 'EMAL' ELSE 'HOME' END AS ADDRESS_TYPE,
      {DAY} AS START_DATE, CASE WHEN o_orderstatus <> 'O' THEN {DAY} + 9 END AS END_DATE, CASE WHEN o_orderstatus = 'O' THEN 'A' ELSE 'I' END AS STATUS,
      CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS RECURRING, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE '' END AS ADDRESS_LINE_1, 'Town' AS CITY FROM {{orders}}""",
    "ADDRESS": f"SELECT {person('o_custkey')} AS PEOPLE_ORG_CODE_ID, 'HOME' AS ADDRESS_TYPE FROM {{orders}} WHERE o_totalprice > 300000 GROUP BY 1",
    "PEOPLEORGBALANCE": f"""SELECT CAST(min(o_orderkey) AS STRING) AS ID, {person('o_custkey')} AS PEOPLE_ORG_CODE_ID, {YEAR} AS ACADEMIC_YEAR, {TERM} AS ACADEMIC_TERM,
      '01' AS ACADEMIC_SESSION, sum(CAST(o_totalprice AS DECIMAL(19, 4))) - 200000 AS BALANCE_AMOUNT FROM {{orders}} GROUP BY o_custkey, 3, 4""",
    "CHARGECREDIT": f"""SELECT o_orderkey AS CHARGECREDITNUMBER, {person('o_custkey')} AS PEOPLE_ORG_CODE_ID, {YEAR} AS ACADEMIC_YEAR, {TERM} AS ACADEMIC_TERM, '01' AS ACADEMIC_SESSION,
      o_orderpriority AS CHARGE_CREDIT_CODE, CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'F' END AS CHARGE_CREDIT_TYPE, o_totalprice AS AMOUNT,
      CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS ANTICIPATED_FLAG, CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS POSTED_FLAG,
      CASE WHEN o_orderstatus = 'O' THEN 'A' ELSE 'B' END || CAST(o_custkey AS STRING) AS BATCH FROM {{orders}}""",
    "ChargeCreditTax": "SELECT o_orderkey AS CHARGECREDITNUMBER, o_totalprice / 10 AS AMOUNT FROM {orders} WHERE o_orderpriority = '2-HIGH'",
    "BATCHHEADER": "SELECT 'A' || CAST(o_custkey AS STRING) AS BATCH_NUMBER, 'IMPORT' AS BATCH_TYPE, 'CHARGECREDIT' AS TABLENAME, 'N' AS DELETED_FLAG FROM {orders} GROUP BY o_custkey",
    "InvoiceDetail": "SELECT l_orderkey * 10 + min(l_linenumber) AS InvoiceDetailId, l_orderkey AS ChargeCreditNumber FROM {lineitem} GROUP BY l_orderkey",
    "STOPLIST": f"""SELECT 'P' AS PEOPLE_CODE, {number('o_custkey')} AS PEOPLE_ID, {person('o_custkey')} AS PEOPLE_CODE_ID, o_orderpriority AS STOP_REASON,
      {DAY} AS STOP_DATE, CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS CLEARED, {DAY} AS CLEARED_DATE, CASE WHEN o_totalprice > 250000 THEN 'old' END AS COMMENTS FROM {{orders}}""",
    "CODE_STOPLIST": """SELECT o_orderpriority AS CODE_VALUE, o_orderpriority AS CODE_VALUE_KEY, 'short' AS SHORT_DESC, 'medium' AS MEDIUM_DESC, 'long' AS LONG_DESC,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'I' ELSE 'A' END AS STATUS, 'Y' AS STOP_REGISTRATION, 'N' AS STOP_GRADES, CAST(NULL AS STRING) AS SHOW_STOP_PICTURE,
      CAST(min(o_orderdate) AS {NTZ}) AS CREATE_DATE FROM {orders} GROUP BY o_orderpriority""",
    "CODE_ENROLLMENT": "SELECT 'ENRL' AS CODE_VALUE_KEY, 'N' AS REQUIRE_SEPDATE UNION ALL SELECT 'WITH', 'Y'",
    "CODE_PROGRAM": "SELECT o_orderpriority AS CODE_VALUE_KEY, 'P' || o_orderpriority AS SHORT_DESC, 'PM' AS MEDIUM_DESC, 'Program ' || o_orderpriority AS LONG_DESC, 'A' AS STATUS FROM {orders} GROUP BY o_orderpriority",
    "CODE_DEGREE": "SELECT o_orderstatus AS CODE_VALUE_KEY, 'D' || o_orderstatus AS SHORT_DESC, 'DM' AS MEDIUM_DESC, 'Degree ' || o_orderstatus AS LONG_DESC, 'A' AS STATUS FROM {orders} GROUP BY o_orderstatus",
    "CODE_CURRICULUM": """SELECT o_orderpriority AS CODE_VALUE_KEY, 'C' AS SHORT_DESC, 'CM' AS MEDIUM_DESC, 'Curriculum ' || o_orderpriority AS LONG_DESC, '' AS CODE_XVAL, 'A' AS STATUS FROM {orders} GROUP BY o_orderpriority
      UNION ALL SELECT 'BS', 'BS', 'BS', 'Bachelor', 'P900000001', 'A' UNION ALL SELECT 'MS', 'MS', 'MS', 'Master', 'P900000002', 'A'""",
    "STDDEGREQ": f"""SELECT {person('o_custkey')} AS PEOPLE_CODE_ID, min(o_orderpriority) AS PROGRAM, min(o_orderstatus) AS DEGREE, max(o_orderpriority) AS CURRICULUM, {YEAR} AS MATRIC_YEAR,
      {TERM} AS MATRIC_TERM, 'A' AS RECORD_TYPE FROM {{orders}} GROUP BY o_custkey, {YEAR}, {TERM}""",
    "STDDEGREQEVENT": f"""SELECT {person('cust')} AS PEOPLE_CODE_ID, PROGRAM, DEGREE, CURRICULUM, y AS MATRIC_YEAR, term AS MATRIC_TERM, 'A' AS RECORD_TYPE, f AS EVENT_CLASS,
      lpad(CAST(s AS STRING), 9, '0') AS EVENT_ID, CASE WHEN q > 25 THEN 'LECT' ELSE 'LAB' END AS EVENT_SUB_TYPE,
      CASE WHEN q < 10 THEN 'C' WHEN q < 20 THEN 'P' WHEN q < 30 THEN 'X' WHEN q < 40 THEN 'Z' ELSE 'Q' END AS STATUS, CASE WHEN disc < 0.08 THEN 'Y' ELSE 'N' END AS REQUIRED
      FROM {{LINE}} JOIN {{STDDEGREQ}} r ON r.PEOPLE_CODE_ID = {person('cust')} AND r.MATRIC_YEAR = y AND r.MATRIC_TERM = term""",
    "ASSESSMENTRULE": """SELECT p_partkey AS ASSESSMENT_RULE_ID, '1999' AS ACADEMIC_YEAR, 'FALL' AS ACADEMIC_TERM, p_name AS LONG_DESC,
      CASE WHEN p_size < 25 THEN 'IF(StudentFinancial.Credit_Billing >= ' || CAST(p_size AS STRING) || ') AND X' ELSE p_type END AS SELECT_CRITERIA,
      CASE WHEN p_brand = 'Brand#11' THEN 'Y' ELSE 'N' END AS SECTION_FEE_FLAG, 'N' AS OVERLOAD, 'B' AS COURSE_CREDIT_BASE FROM {part}""",
    "ASSESSCHARGECREDIT": "SELECT l_partkey AS ASSESSMENT_RULE_ID, l_returnflag AS CHARGE_CREDIT_CODE, l_linestatus AS PER_CREDIT_FLAT, max(l_extendedprice) AS AMOUNT FROM {lineitem} GROUP BY 1, 2, 3",
    "CODE_CHARGECREDIT": "SELECT l_returnflag AS CODE_VALUE_KEY, 'Charge ' || l_returnflag AS CRG_CRD_DESC, 'Ch' AS CRG_CRD_MED_DESC FROM {lineitem} GROUP BY l_returnflag",
    "ACTION": """SELECT o_orderpriority AS ACTION_ID, 'Action ' || o_orderpriority AS ACTION_NAME, CASE WHEN o_orderpriority < '3' THEN 'REG' ELSE 'FIN' END AS OFFICE, 'T' AS TYPE, 'note' AS NOTE,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'I' ELSE 'A' END AS STATUS, 'Y' AS REQUIRED, '1' AS PRIORITY, 'do it' AS Instruction FROM {orders} GROUP BY o_orderpriority""",
    "ACTIONSCHEDULE": f"""SELECT o_orderkey AS ACTIONSCHEDULE_ID, o_orderpriority AS ACTION_ID, {person('o_custkey')} AS PEOPLE_ORG_CODE_ID, {DAY} AS SCHEDULED_DATE,
      CASE WHEN o_orderstatus = 'F' THEN {DAY} END AS EXECUTION_DATE, CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS CANCELED,
      CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Y' END AS WAIVED FROM {{orders}}""",
    "VIOLATIONS": f"""SELECT {person('cust')} AS PEOPLE_CODE_ID, {KEY}, d AS VIOLATION_DATE, prio AS VIOLATION FROM {{LINE}} WHERE q > 40""",
    "CODE_VIOLATIONS": "SELECT o_orderpriority AS CODE_VALUE_KEY, 'A' AS STATUS FROM {orders} WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY o_orderpriority",
    "PersonUser": "SELECT c_custkey AS PersonId, c_name AS UserName FROM {customer} UNION ALL SELECT 900000000000 + s_suppkey, 'op' || CAST(s_suppkey AS STRING) FROM {supplier}",
    "Application": "SELECT 1 AS ApplicationId, 'portal' AS Name UNION ALL SELECT 2, 'other'",
    "AppStore": "SELECT 11 AS AppStoreId, 1 AS ApplicationId, 2 AS Mode UNION ALL SELECT 12, 1, 3",
    "AppRole": "SELECT 1 AS AppRoleId, 1 AS ApplicationId, 'Student' AS Name UNION ALL SELECT 2, 1, 'Faculty' UNION ALL SELECT 3, 1, 'Dossier' UNION ALL SELECT 4, 1, 'Approval' UNION ALL SELECT DISTINCT 100 + ascii(c_mktsegment), 1, c_mktsegment FROM {customer}",
    "AppUser": """SELECT c_custkey AS AppUserId, 1 AS ApplicationId, c_name AS UserName, '' AS Password, 11 AS CreationAppStoreId, 12 AS AuthenticationAppStoreId FROM {customer} WHERE c_acctbal > 2000
      UNION ALL SELECT 900000000000 + s_suppkey, 1, s_name, CASE WHEN s_acctbal > 5000 THEN 'secret' ELSE '' END, 11, 10 FROM {supplier}""",
    "AppUserRole": """SELECT o_custkey AS AppUserId, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS AppRoleId FROM {orders} GROUP BY 1, 2
      UNION ALL SELECT 900000000000 + s_suppkey, 2 FROM {supplier}""",
    "SiteMapRole": "SELECT 1 AS SiteMapRoleId, 'Student' AS RoleName UNION ALL SELECT 2, 'Faculty' UNION ALL SELECT DISTINCT 100 + ascii(c_mktsegment), c_mktsegment FROM {customer}",
    "PersonTypeRole": "SELECT 'Student' AS RoleName, 7 AS PersonTypeId UNION ALL SELECT 'Faculty', 8 UNION ALL SELECT DISTINCT c_mktsegment, CAST(100 + ascii(o_orderpriority) AS INT) FROM {orders} JOIN {customer} ON o_custkey = c_custkey",
    "CODE_RECORDTYPE": "SELECT 7 AS RecordTypeId, 'STU' AS CODE_VALUE_KEY, 'A' AS STATUS UNION ALL SELECT 8, 'FAC', 'A' UNION ALL SELECT DISTINCT CAST(100 + ascii(o_orderpriority) AS INT), o_orderpriority, 'A' FROM {orders}",
    "ABT_USERS": f"SELECT 'OP' || CAST(s_suppkey AS STRING) AS OPERATOR_ID, {instructor('s_suppkey')} AS PEOPLE_CODE_ID, CASE WHEN s_acctbal > -500 THEN 'A' ELSE 'I' END AS STATUS FROM {{supplier}}",
    "ABT_USERPROFILE": """SELECT 'OP' || CAST(l_suppkey AS STRING) AS OPERATOR_ID, CAST(l_partkey AS STRING) AS PROFILE_CODE FROM {lineitem} WHERE l_quantity = 50 GROUP BY 1, 2
      UNION ALL SELECT 'OP' || CAST(s_suppkey AS STRING), 'REGSTAFF' FROM {supplier} WHERE s_acctbal > 7000""",
    "ABT_PROFILE": "SELECT CAST(p_partkey AS STRING) AS PROFILE_CODE, p_name AS PROFILE_NAME FROM {part}",
    "CODE_OFFICE": "SELECT CAST(n_nationkey AS STRING) AS CODE_VALUE_KEY, n_name AS SHORT_DESC FROM {nation}",
    "Reported1098TInformation": f"""SELECT o_orderkey AS ReportedInformationId, CAST(year(o_orderdate) AS INT) AS TaxYear, {person('o_custkey')} AS People_Code_Id, 'Name ' || CAST(o_custkey AS STRING) AS NameLine1,
      o_totalprice AS Payment, 0 AS PaymentAdjustment, 0 AS Scholarship FROM {{orders}}""",
    "Reported1098TPeriodSummary": f"""SELECT o_orderkey * 10 AS ReportedPeriodSummaryId, o_orderkey AS ReportedInformationId, CAST(year(o_orderdate) AS INT) AS TaxYear, {YEAR} AS AcademicYear,
      {TERM} AS AcademicTerm, o_totalprice AS CumulativeChargesBilled, 1 AS CurrentPaymentsReported FROM {{orders}}""",
    "Reported1098TSummaryDetail": "SELECT k AS ReportedSummaryDetailId, o_orderkey * 10 AS ReportedPeriodSummaryId, o_orderkey AS ChargeCreditNumber, f AS ChargeCreditCode, q AS Amount FROM {LINE}",
    "Reported1098TRefundCode": "SELECT CAST(n_nationkey AS BIGINT) AS ReportedRefundCodeId, 1998 AS TaxYear, n_name AS ChargeCreditCode FROM {nation}",
    # The "new" database of the copy: other years' forms, and some of the year's with a changed amount.
    "NEW_Reported1098TInformation": "SELECT ReportedInformationId, TaxYear, People_Code_Id, NameLine1, CASE WHEN Payment > 400000 THEN Payment + 1 ELSE Payment END AS Payment, PaymentAdjustment, Scholarship FROM {Reported1098TInformation} WHERE TaxYear <> 1998 OR Payment > 300000",
    "NEW_Reported1098TPeriodSummary": "SELECT * FROM {Reported1098TPeriodSummary} WHERE TaxYear <> 1998 OR CumulativeChargesBilled > 300000",
    "NEW_Reported1098TSummaryDetail": "SELECT d.* FROM {Reported1098TSummaryDetail} d JOIN {NEW_Reported1098TPeriodSummary} p ON p.ReportedPeriodSummaryId = d.ReportedPeriodSummaryId",
    "NEW_Reported1098TRefundCode": "SELECT * FROM {Reported1098TRefundCode} WHERE ReportedRefundCodeId <= 4",
    "AppClaim": "SELECT c_custkey AS AppClaimId, 1 AS ApplicationId, c_name AS Name FROM {customer}",
    "AppRoleClaim": "SELECT CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS AppRoleId, o_custkey AS AppClaimId FROM {orders} GROUP BY 1, 2",
    "SiteMapOption": "SELECT p_partkey AS SiteMapOptionId, 'L' || CAST(p_partkey AS STRING) AS LinkId, p_name AS ExternalLink, p_size > 25 AS IsCustom FROM {part}",
    "SiteMapOptionDetail": "SELECT s_suppkey AS SiteMapOptionDetailId, s_suppkey AS SiteMapOptionId, 'D' || CAST(s_suppkey AS STRING) AS LinkId, s_name AS ExternalLink, s_acctbal > 0 AS IsCustom FROM {supplier}",
    "SiteMapOptionRole": "SELECT l_partkey AS SiteMapOptionId, CASE l_returnflag WHEN 'R' THEN 1 ELSE 2 END AS SiteMapRoleId, max(l_quantity) > 40 AS IsVisible FROM {lineitem} WHERE l_discount >= 0.05 GROUP BY 1, 2",
    "SiteMapOptionDetailRole": "SELECT l_suppkey AS SiteMapOptionDetailId, CASE l_returnflag WHEN 'R' THEN 1 ELSE 2 END AS SiteMapRoleId, true AS IsVisible FROM {lineitem} WHERE l_quantity = 50 AND l_discount = 0.1 GROUP BY 1, 2",
    "InstitutionSetting": "SELECT CASE WHEN c_acctbal > 0 THEN 'Theme' ELSE 'Other' END AS AreaName, c_mktsegment AS SectionName, c_name AS LabelName, CAST(c_nationkey AS STRING) AS Setting, c_custkey AS PersonId FROM {customer}",
    "NEW_SiteMapRole": "SELECT 1 AS SiteMapRoleId, 'Student' AS RoleName UNION ALL SELECT 12, 'Faculty'",
    "NEW_SiteMapOption": "SELECT SiteMapOptionId + 1000000 AS SiteMapOptionId, LinkId, ExternalLink, IsCustom FROM {SiteMapOption} WHERE IsCustom = false OR ExternalLink > 'm'",
    "NEW_SiteMapOptionDetail": "SELECT SiteMapOptionDetailId + 500 AS SiteMapOptionDetailId, SiteMapOptionId, LinkId, ExternalLink, IsCustom FROM {SiteMapOptionDetail} WHERE IsCustom = false",
    "NEW_SiteMapOptionRole": "SELECT SiteMapOptionId + 1000000 AS SiteMapOptionId, 12 AS SiteMapRoleId, IsVisible FROM {SiteMapOptionRole} WHERE SiteMapRoleId = 2 AND IsVisible",
    "NEW_SiteMapOptionDetailRole": "SELECT SiteMapOptionDetailId + 500 AS SiteMapOptionDetailId, SiteMapRoleId, IsVisible FROM {SiteMapOptionDetailRole} WHERE SiteMapRoleId = 1",
    "NEW_InstitutionSetting": "SELECT AreaName, SectionName, LabelName, 'old' AS Setting, PersonId FROM {InstitutionSetting} WHERE Setting < '2'",
    "NEW_AppRole": "SELECT AppRoleId + 50 AS AppRoleId, ApplicationId, Name FROM {AppRole} WHERE Name IN ('Student', 'BUILDING')",
    "NEW_AppClaim": "SELECT AppClaimId + 700000 AS AppClaimId, ApplicationId, Name FROM {AppClaim}",
    "NEW_AppRoleClaim": "SELECT 51 AS AppRoleId, o_custkey + 700000 AS AppClaimId FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY o_custkey",
    "ABT_OBJECTS": "SELECT o_orderpriority AS OBJECT_NAME, CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'P' THEN ' ' ELSE 'kept' END AS HELP_NAME FROM {orders}",
    "ABT_TABLESECURITY": """SELECT o_orderpriority AS SECURITY_ID, 'v' || CAST(o_custkey AS STRING) AS TABLE_NAME, CASE max(o_orderstatus) WHEN 'P' THEN 'Y' ELSE 'N' END AS EDIT_RIGHTS,
      CASE min(o_orderstatus) WHEN 'F' THEN 'Y' ELSE 'N' END AS DELETE_RIGHTS FROM {orders} GROUP BY o_orderpriority, o_custkey""",
    "VISTAVIEW": "SELECT c_custkey AS VIEW_ID, c_name AS VIEW_NAME, 'v' || CAST(c_custkey AS STRING) AS VIEW_DB_NAME FROM {customer}",
    **{
        f"VISTAVIEW{part}": f"SELECT o_custkey AS VIEW_ID, o_orderkey AS SEQUENCE FROM {{orders}} WHERE o_orderpriority >= '{least}'"
        for part, least in (
            ("COLUMNS", "1"), ("COMPUTES", "5"), ("CRITERIA", "4"), ("GROUPS", "5"), ("JOIN", "3"), ("JOINCRITERIA", "3"), ("SORT", "4"), ("SYNTAX", "2"), ("TABLES", "2"),
        )
    },
    "PBCATCOL": "SELECT 'v' || CAST(o_custkey AS STRING) AS PBC_TNAM, o_orderpriority AS PBC_CNAM FROM {orders}",
    "PBCATTBL": "SELECT 'v' || CAST(c_custkey AS STRING) AS PBT_TNAM FROM {customer}",
    "ABT_TABLES": "SELECT 'v' || CAST(c_custkey AS STRING) AS TABLE_NAME FROM {customer}",
    # Dropped lines as canceled sections: told by a drop record, by the name of the action, or not at all.
    "CANCELED_ACTIONS": f"""SELECT k AS ACTIONSCHEDULE_ID, 'CANCSECT' AS ACTION_ID, {person('cust')} AS PEOPLE_ORG_CODE_ID, y AS ACADEMIC_YEAR, term AS ACADEMIC_TERM, '01' AS ACADEMIC_SESSION,
      'k' || CAST(k AS STRING) AS UNIQUE_KEY, CASE fi WHEN 0 THEN 'Canceled/' || {EVENT_CODE} || '/D01' WHEN 1 THEN 'Section was canceled: 2020/FALL/01/' || {EVENT_CODE} || '/H01' ELSE 'Canceled' END AS ACTION_NAME,
      CASE WHEN q > 40 THEN 'Y' ELSE 'N' END AS COMPLETED, 'N' AS CANCELED, 'N' AS WAIVED, CAST(NULL AS DATE) AS EXECUTION_DATE, CAST(NULL AS STRING) AS COMPLETED_BY FROM {{LINE}} WHERE disc >= 0.09""",
    "CANCELED_ACTION": "SELECT 'CANCSECT' AS ACTION_ID, 'Section canceled' AS ACTION_NAME, 'Dear ' || repeat(chr(123), 2) || 'FIRST_NAME' || repeat(chr(125), 2) || ': ' || repeat(chr(123), 2) || 'SECTION' || repeat(chr(125), 2) || ' is off.' AS NOTE",
    "CANCELED_DROPS": f"SELECT DISTINCT {person('cust')} AS PEOPLE_CODE_ID, y AS ACADEMIC_YEAR, term AS ACADEMIC_TERM, '01' AS ACADEMIC_SESSION, {EVENT_CODE} AS EVENT_ID, 'LECT' AS EVENT_SUB_TYPE, 'D01' AS SECTION, 'CANCEL' AS DROP_REASON FROM {{LINE}} WHERE disc >= 0.09 AND fi = 0 AND q > 10",
    "CANCELED_SECTIONS": f"SELECT DISTINCT y AS ACADEMIC_YEAR, term AS ACADEMIC_TERM, '01' AS ACADEMIC_SESSION, {EVENT_CODE} AS EVENT_ID, 'LECT' AS EVENT_SUB_TYPE, 'D01' AS SECTION, 'Long & ' || {EVENT_CODE} AS EVENT_LONG_NAME FROM {{LINE}}",
    "CANCELED_SUBTYPE": "SELECT 'LECT' AS CODE_VALUE, 'Lecture' AS LONG_DESC",
    "MESSAGEQUEUE": "SELECT o_orderkey AS MESSAGEID, 'Happy Birthday!' AS SUBJECT, DATE '1999-11-21' AS CREATE_DATE FROM {orders} WHERE o_orderpriority = '1-URGENT'",
    "MESSAGERECIPIENTS": f"SELECT o_orderkey AS MESSAGEID, 'to' AS RECIPIENTTYPE, {person('o_custkey')} AS PEOPLECODEID FROM {{orders}} WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'",
}

_DUCK_TYPES = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "boolean": "BOOLEAN"}


def layout(name: str) -> list[tuple[str, str]]:
    """(column, type) of a table, empty for helper derivations."""
    ddl = SCHEMAS.get(name.removeprefix("NEW_"), "")
    return [tuple(part.rsplit(" ", 1)) for part in ddl.split(", ")] if ddl else []


def references(text: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", text)) if n != "NTZ"]


class CampusFrames(Mapping):
    """Derived tables by name, built on first use; tables without a derivation are empty."""

    def __init__(self, spark: SparkSession, path: str, prefix: str = "", shared: dict | None = None):
        self._spark, self._path, self._prefix = spark, path, prefix
        self._built: dict[str, DataFrame] = {} if shared is None else shared

    def __getitem__(self, name: str) -> DataFrame:
        return self._frame(self._prefix + name if self._prefix + name in DERIVED else name)

    def _frame(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self._spark.read.parquet(f"{self._path}/{name}.parquet")
        columns = layout(name)
        if name not in DERIVED:
            return self._spark.createDataFrame([], T.StructType.fromDDL(SCHEMAS[name]))
        df = self.derive(name)
        if not columns:
            return stage(df, name.lower()) if name in STAGED else df
        have = {c.lower() for c in df.columns}
        return df.select(*[(F.col(c) if c.lower() in have else F.lit(None)).cast(k).alias(c) for c, k in columns])

    def derive(self, name: str) -> DataFrame:
        """The derivation of a table before it is staged or cast to its layout."""
        text = DERIVED[name].replace("{NTZ}", "TIMESTAMP_NTZ")
        frames = {n: self._frame(n) for n in references(text)}
        for n, column in DEALT.get(name, {}).items():
            frames[n] = frames[n].repartition(column)
        return self._spark.sql(text, **frames)

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)


def campus(spark: SparkSession, path: str) -> TableRegistry:
    prepare(spark)
    shared: dict[str, DataFrame] = {}
    frames, new = CampusFrames(spark, path, "", shared), CampusFrames(spark, path, "NEW_", shared)
    return TableRegistry(spark, {"main": frames, "identity": frames, "old": frames, "new": new})


def duck_type(kind: str) -> str:
    return _DUCK_TYPES.get(kind, kind.upper())


def _columns_of(text: str) -> set[str]:
    return {c.lower() for c in re.findall(r"\bAS (\w+)", text)} | {c.lower() for c in re.findall(r"[ ,.](\w+)(?=,| FROM)", text)}


def with_tables(sql: str) -> str:
    """Oracle text over campus names, preceded by the derivations it needs."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name in needed or name in GIVEN:
            return
        if name in DERIVED:
            for r in references(DERIVED[name]):
                need(r)
        needed.append(name)

    for word in dict.fromkeys(re.findall(r"\b\w+\b", sql)):
        if word in DERIVED or word in SCHEMAS and re.search(rf"(FROM|JOIN)\s+{word}\b", sql):
            need(word)
    ctes = []
    for name in needed:
        columns = layout(name)
        if name not in DERIVED:
            body = "SELECT " + ", ".join(f"CAST(NULL AS {duck_type(k)}) AS {c}" for c, k in columns) + " WHERE false"
        else:
            text = re.sub(r"\{(\w+)\}", lambda m: "TIMESTAMP" if m[1] == "NTZ" else m[1], DERIVED[name])
            have = _columns_of(DERIVED[name]) if columns else set()
            star = bool(re.search(r"SELECT (\w+\.)?\*", DERIVED[name]))
            body = text if not columns else "SELECT " + ", ".join(
                (f"CAST({c} AS {duck_type(k)})" if star or c.lower() in have else f"CAST(NULL AS {duck_type(k)})") + f" AS {c}" for c, k in columns
            ) + f" FROM ({text}) src"
        ctes.append(f"{name} AS MATERIALIZED ({body})")
    sql = sql.strip()
    if sql.startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + sql
