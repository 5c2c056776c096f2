"""A small campus with the awkward rows: ties, nulls beside blanks, shared digits, touching meetings."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb
from pyspark.sql import types as T

from rosterline.bindings.campus_tables import duck_type, layout
from rosterline.models.campus import SCHEMAS
from rosterline.sources.registry import TableRegistry

KEYS = ("ACADEMIC_YEAR", "ACADEMIC_TERM", "ACADEMIC_SESSION", "EVENT_ID", "EVENT_SUB_TYPE", "SECTION")


def day(text):
    return dt.date.fromisoformat(text)


def clock(text):
    return dt.datetime.fromisoformat(f"1900-01-01 {text}:00")


def key(event="ENG 101", section="D01", term="FALL", year="1999", sub="LECT"):
    return dict(zip(KEYS, (year, term, "01", event, sub, section)))


def money(x):
    return Decimal(x)


A, B, C, D, E = "P000000001", "P000000002", "P000000003", "P000000004", "P000000005"
FAC, FAC2 = "P900000001", "P900000002"


def person(number, first, last, **more):
    return {"PersonId": int(number), "PEOPLE_ID": number, "PEOPLE_CODE_ID": "P" + number, "FIRST_NAME": first, "LAST_NAME": last, **more}


def academic(who, session="01", term="FALL", year="1999", seq="001", **more):
    base = {
        "PEOPLE_ID": who[1:], "PEOPLE_CODE_ID": who, "ACADEMIC_YEAR": year, "ACADEMIC_TERM": term, "ACADEMIC_SESSION": session, "TRANSCRIPT_SEQ": seq,
        "PROGRAM": "GRAD", "DEGREE": "MBA", "CURRICULUM": "BS", "DEPARTMENT": "DEP", "CREDITS": money("9"), "ENROLL_SEPARATION": "ENRL",
        "FULL_PART": "F", "STATUS": "A", "PRIMARY_FLAG": "Y", "ACADEMIC_FLAG": "Y", "GRADUATED": "N",
    }
    return {**base, **more}


def detail(n, who, event="ENG 101", section="D01", grade="B", adw="A", status="1999-11-18", term="FALL", year="1999", **more):
    base = {
        "TranscriptDetailId": n, "PEOPLE_CODE": "P", "PEOPLE_ID": who[1:], "PEOPLE_CODE_ID": who, **key(event, section, term, year), "TRANSCRIPT_SEQ": "001",
        "EVENT_MED_NAME": "Med", "EVENT_LONG_NAME": "Reading & <Writing>", "CREDIT_TYPE": "C", "CREDIT": money("3"), "FINAL_GRADE": grade,
        "ADD_DROP_WAIT": adw, "STATUS_DATE": day(status),
    }
    return {**base, **more}


def section(n, event, name, status="A", **more):
    base = {
        "SectionId": n, **key(event, name), "EVENT_STATUS": status, "EVENT_MED_NAME": "Med", "EVENT_LONG_NAME": "Reading & <Writing>", "ORG_CODE_ID": "O000000001",
        "PROGRAM": "GRAD", "COLLEGE": "COL", "DEPARTMENT": "DEP", "CURRICULUM": "BS", "SCHEDULED_MEETINGS": 0, "CREATE_DATE": day("1999-09-01"), "CREATE_TIME": clock("08:00"),
    }
    return {**base, **more}


def schedule(n, event, name, weekday, start, end):
    return {"SECTIONSCHEDULE_ID": n, **key(event, name), "DAY": weekday, "START_TIME": clock(start), "END_TIME": clock(end), "ROOM_ID": "ONLINE", "CALENDARDET_EVENT_KEY": n}


def meeting(n, event_key, on, weekday, start, end):
    return {
        "CALENDAR_KEY": n, "EVENT_KEY": event_key, "CALENDAR_DATE": day(on), "DAY_OF_WEEK": weekday, "START_TIME": clock(start), "END_TIME": clock(end),
        "BUILDING_CODE": "ONLINE", "ROOM_ID": "ZOOM", "MEETING_TYPE": "CLASS", "EVENT_TYPE": "COURSE",
    }


def email(n, owner, address, kind, created="1999-01-01", at="08:00", active="1"):
    return {
        "EmailAddressId": n, "PeopleOrgCodeId": owner, "PeopleOrgId": owner[1:], "Email": address, "EmailType": kind, "IsActive": active,
        "CREATE_DATE": day(created), "CREATE_TIME": clock(at),
    }


def code(key_value, long_desc, xval=None, status="A"):
    return {"CODE_VALUE_KEY": key_value, "SHORT_DESC": key_value, "MEDIUM_DESC": key_value, "LONG_DESC": long_desc, "CODE_XVAL": xval, "STATUS": status}


def phone(n, owner, number, country, kind="HOME", created="1999-01-01"):
    return {"PersonPhoneId": n, "PersonId": owner, "PhoneType": kind, "PhoneNumber": number, "CountryId": country, "Create_Date": day(created), "Create_Time": clock("08:00")}


def address(n, who, start, end, status, line=None, kind="HOME", recurring="N"):
    return {
        "SEQUENCE_NO": n, "PEOPLE_ORG_CODE_ID": who, "ADDRESS_TYPE": kind, "START_DATE": day(start), "END_DATE": day(end) if end else None, "STATUS": status,
        "RECURRING": recurring, "ADDRESS_LINE_1": line, "CITY": "Town",
    }


def charge(n, who, amount, anticipated="Y", kind="F", batch="B1", posted="N", code_value="AID"):
    return {
        "CHARGECREDITNUMBER": n, "PEOPLE_ORG_CODE_ID": who, "ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "ACADEMIC_SESSION": "01", "CHARGE_CREDIT_CODE": code_value,
        "CHARGE_CREDIT_TYPE": kind, "AMOUNT": money(amount), "ANTICIPATED_FLAG": anticipated, "POSTED_FLAG": posted, "BATCH": batch,
    }


def stop(who, reason, on, cleared, comments=None):
    return {"PEOPLE_CODE": "P", "PEOPLE_ID": who[1:], "PEOPLE_CODE_ID": who, "STOP_REASON": reason, "STOP_DATE": day(on), "CLEARED": cleared, "COMMENTS": comments}


def attendance(n, who, event, name, on, calendar_key=None):
    return {
        "TranAttendanceId": n, "PEOPLE_CODE": "P", "PEOPLE_ID": who[1:], "PEOPLE_CODE_ID": who, **key(event, name), "ATTENDANCE_DATE": day(on),
        "ATTENDANCE_STATUS": "PRESENT", "CalendarKey": calendar_key,
    }


def term(year, name, start, end, session="01", period=1, pre=None, penalty=None):
    return {
        "ACADEMIC_YEAR": year, "ACADEMIC_TERM": name, "ACADEMIC_SESSION": session, "SessionPeriodId": period, "START_DATE": day(start), "END_DATE": day(end),
        "PRE_REG_DATE": day(pre or start), "REG_DATE": day(start), "GRADE_PENALTY_DATE": day(penalty or end), "FIN_AID_YEAR": year,
    }


def setting(area, part, label, value):
    return {"AREA_NAME": area, "SECTION_NAME": part, "LABEL_NAME": label, "SETTING": value}


def build() -> dict[str, list[dict]]:
    tables: dict[str, list[dict]] = {
        "PEOPLE": [
            person("000000001", "Ann", "O'Neil & <Son>", BIRTH_DATE=day("1980-11-21"), PrimaryEmailId=1, PrimaryPhoneId=2),
            person("000000002", "BUILDING", "Two", BIRTH_DATE=day("1980-02-29"), DISPLAY_NAME="Bob", PrimaryEmailId=2),
            person("000000003", "FURNITURE", "Three", BIRTH_DATE=day("1981-11-21"), DISPLAY_NAME="  "),
            person("000000004", "MACHINERY", "Four", PrimaryEmailId=4),
            person("000000005", "HOUSEHOLD", "Five", BIRTH_DATE=day("1990-11-21"), PrimaryEmailId=5),
            person("900000001", "Pat", "Prof", PREFIX="Dr.", SUFFIX="Jr.", PrimaryEmailId=91),
            person("900000002", "Pat", "Dean", PREFIX="Dr.", PrimaryEmailId=92),
        ],
        "PEOPLETYPE": [
            *({"PEOPLE_ID": w[1:], "PEOPLE_CODE_ID": w, "PEOPLE_TYPE": "STU"} for w in (A, B, C, D, E)),
            *({"PEOPLE_ID": w[1:], "PEOPLE_CODE_ID": w, "PEOPLE_TYPE": k} for w, k in ((FAC, "FAC"), (FAC, "ADV"), (FAC2, "FAC"))),
        ],
        "FACULTY": [{"PEOPLE_ID": FAC[1:]}, {"PEOPLE_ID": FAC2[1:]}],
        "ORGANIZATION": [{"ORG_CODE_ID": "O000000001", "PrimaryEmailId": 50}],
        "EmailAddress": [
            email(1, A, "ann@x.edu", "Campus"), email(11, A, "b@y.com", "Personal", "1999-05-05"), email(12, A, "a@y.com", "Personal", "1999-05-05"),
            email(13, A, "old@y.com", "Personal", "1998-05-05"), email(14, A, "off@y.com", "Personal", "1999-06-06", active="0"),
            email(2, B, "bob@x.edu", "Campus"), email(3, C, "cee@x.edu", "Campus"), email(4, D, "dee@y.com", "Personal"), email(5, E, "eve@x.edu", "Campus"),
            email(50, "O000000001", "org@x.org", "Campus"), email(51, "O000000001", "org@y.org", "Personal", "1999-09-09"),
            email(91, FAC, "prof@x.edu", "Campus"), email(92, FAC2, "dean@x.edu", "Campus"),
        ],
        "ACADEMICCALENDAR": [
            term("1998", "FALL", "1998-09-01", "1998-12-20", period=1), term("1999", "SPRING", "1999-01-15", "1999-05-20", period=2),
            term("1999", "SUMMER", "1999-06-01", "1999-08-20", session="02", period=3),
            term("1999", "FALL", "1999-09-01", "1999-12-20", period=4, pre="1999-08-01", penalty="1999-09-15"),
            term("2000", "SPRING", "2000-01-15", "2000-05-20", period=512, pre="1999-11-01", penalty="2000-02-01"),
        ],
        "ABT_SETTINGS": [
            setting("ACA_RECORDS", "CURRENT_YT", "CURRENT_YEAR", "1999"), setting("ACA_RECORDS", "CURRENT_YT", "CURRENT_TERM", "FALL"),
            setting("SYSADMIN", "DATABASE", "VERSION", "9.1.4"), setting("OFFICES", "OP1", "REG", "Y"), setting("OFFICES", "OP2", "REG", "Y"),
            setting("OFFICES", "OP2", "FIN", "Y"), setting("OFFICES", "OP1", "FIN", "N"),
        ],
        "ACADEMIC": [
            academic(A), academic(A, session=""), academic(B), academic(B, session="", STATUS="N"), academic(C, ENROLL_SEPARATION="WITH"),
            academic(D, ENROLL_SEPARATION=None), academic(E, NONTRAD_PROGRAM="LDRHS"), academic(A, term="SPRING"), academic(B, term="SPRING", PRIMARY_FLAG="N"),
            academic(A, term="SPRING", year="2000", seq="001"), academic(A, term="SPRING", year="2000", seq="002", CURRICULUM="MS"),
            academic(D, term="SPRING", year="2000", ENROLL_SEPARATION=None), academic(C, term="SUMMER", session="02"),
        ],
        "TRANSCRIPTDETAIL": [
            detail(1, A), detail(2, A, "ENG 102", "D02"), detail(3, A, "ENG 103", "H01"), detail(4, B), detail(5, B, "ENG 104", "D04"), detail(6, B, grade="W", section="D02", event="ENG 102"),
            detail(7, C, grade=None), detail(8, D, grade=None, CREDIT_TYPE="Z"), detail(9, E), detail(10, A, "IND 200", "MIS1"), detail(11, A, "ENG 105", "D05"),
            detail(12, B, "ENG 106", "D06", adw="D"), detail(13, A, term="SPRING", CREDIT=money("12.5")), detail(14, B, "ENG 103", "H01", TRANSCRIPT_SEQ="009"),
            detail(15, E, "ENG 104", "D04", grade="N", CREDIT_TYPE="N"), detail(16, A, "MBA 500", "MBA 503 FDN"),
        ],
        "SECTIONS": [
            section(1, "ENG 101", "D01"), section(2, "ENG 102", "D02"), section(3, "ENG 103", "H01"), section(4, "ENG 104", "D04"), section(5, "ENG 105", "D05"),
            section(6, "ENG 106", "D06", status="P"), section(7, "IND 200", "MIS1"), section(8, "ENG 108", "D08", status="C"), section(9, "MBA 500", "MBA 503 FDN", CREATE_DATE=day("1999-12-01")),
        ],
        "SECTIONSCHEDULE": [
            schedule(1, "ENG 101", "D01", "MON", "09:00", "11:00"), schedule(2, "ENG 102", "D02", "MON", "11:00", "12:00"), schedule(3, "ENG 103", "H01", "DIST", "09:00", "09:05"),
            schedule(4, "ENG 104", "D04", "THUR", "10:00", "10:10"), schedule(5, "ENG 105", "D05", "THUR", "10:00", "10:11"), schedule(7, "IND 200", "MIS1", "MON", "09:00", "10:00"),
            schedule(9, "MBA 500", "MBA 503 FDN", "MON", "15:00", "16:00"),
        ],
        "CALENDARDETAIL": [
            {"EVENT_KEY": n, **key(e, s)}
            for n, e, s in ((1, "ENG 101", "D01"), (2, "ENG 102", "D02"), (3, "ENG 103", "H01"), (4, "ENG 104", "D04"), (5, "ENG 105", "D05"), (7, "IND 200", "MIS1"), (9, "MBA 500", "MBA 503 FDN"))
        ],
        "CALENDAR": [
            meeting(101, 1, "1999-11-15", "MON", "09:00", "11:00"), meeting(102, 1, "1999-11-22", "MON", "09:00", "11:00"), meeting(103, 1, "1999-11-29", "MON", "09:00", "11:00"),
            meeting(201, 2, "1999-11-15", "MON", "11:00", "12:00"), meeting(202, 2, "1999-11-22", "MON", "11:00", "12:00"),
            meeting(301, 3, "1999-11-22", "DIS", "09:00", "09:05"), meeting(401, 4, "1999-11-18", "THU", "10:00", "10:10"), meeting(402, 4, "1999-11-25", "THU", "10:00", "10:05"),
            meeting(501, 5, "1999-11-18", "THU", "10:00", "10:11"), meeting(502, 5, "1999-11-25", "THU", "10:00", "10:05"), meeting(701, 7, "1999-11-15", "MON", "09:00", "10:00"),
            meeting(104, 1, "1999-10-20", "WED", "09:00", "11:00"), meeting(105, 1, "1999-10-11", "MON", "09:00", "11:00"), meeting(106, 3, "1999-10-11", "DIS", "09:00", "09:05"),
            meeting(901, 9, "1999-11-15", "MON", "15:00", "16:00"), meeting(107, 1, "1999-11-15", "MON", "08:00", "08:30"),
        ],
        "SECTIONPER": [
            {"PERSON_CODE_ID": FAC, **key("ENG 101", "D01"), "PERCENTAGE": money("100")}, {"PERSON_CODE_ID": FAC2, **key("ENG 101", "D01"), "PERCENTAGE": money("0")},
            {"PERSON_CODE_ID": FAC, **key("ENG 102", "D02"), "PERCENTAGE": money("50")}, {"PERSON_CODE_ID": FAC2, **key("ENG 105", "D05"), "PERCENTAGE": money("50")},
            {"PERSON_CODE_ID": FAC2, **key("ENG 104", "D04"), "PERCENTAGE": money("50")}, {"PERSON_CODE_ID": FAC, **key("IND 200", "MIS1"), "PERCENTAGE": money("50")},
        ],
        "FacultyAssistant": [
            {"AssistantId": 900000002, "SectionId": 2, "CanAccessOverallGrades": True, "CanSubmitOverallGrades": True},
            {"AssistantId": 900000002, "SectionId": 3, "CanAccessOverallGrades": True, "CanSubmitOverallGrades": False},
        ],
        "TRANATTENDANCE": [
            attendance(1, A, "ENG 101", "D01", "1999-11-15", 101), attendance(2, B, "ENG 101", "D01", "1999-11-15"), attendance(3, B, "ENG 101", "D01", "1999-11-15"),
            attendance(4, A, "ENG 101", "D01", "1999-11-15"), attendance(5, A, "ENG 101", "D01", "1999-11-29", 103), attendance(6, A, "ENG 102", "D02", "1999-11-16"),
            attendance(7, E, "ENG 101", "D01", "1999-11-29", 103),
        ],
        "GRADEVALUES": [
            {"ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "CREDIT_TYPE": "C", "GRADE": "W", "WITHDRAWN_GRADE": "Y"},
            {"ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "CREDIT_TYPE": "C", "GRADE": "B", "WITHDRAWN_GRADE": "N"},
            {"ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "CREDIT_TYPE": "N", "GRADE": None, "WITHDRAWN_GRADE": "Y"},
        ],
        "EVENT": [
            {"EVENT_ID": "ENG 101", "PUBLICATION_NAME_1": "English", "EVENT_STATUS": "A", "CURRICULUM": "BS"}, {"EVENT_ID": "ENG 102", "PUBLICATION_NAME_1": "", "EVENT_STATUS": "A", "CURRICULUM": "MS"},
            {"EVENT_ID": "ENG 103", "PUBLICATION_NAME_1": None, "EVENT_STATUS": "A", "CURRICULUM": None}, {"EVENT_ID": "IND 200", "PUBLICATION_NAME_1": "Study", "EVENT_STATUS": "I", "CURRICULUM": "MS"},
        ],
        "sectioncrosstally": [{"EVENT_ID": "ENG 102", "EVENT_SUB_TYPE": "LECT", "SECTION": "D02"}],
        "DEGREQEVENT": [{"MATRIC_YEAR": "1999", "MATRIC_TERM": "FALL", "CURRICULUM": "BS", "EVENT_ID": "ENG 101"}] * 2,
        "CartSection": [{"PersonId": 1, "SectionId": 1}, {"PersonId": 1, "SectionId": 2}, {"PersonId": 2, "SectionId": 1}, {"PersonId": 3, "SectionId": 99}],
        "CODE_ENROLLMENT": [{"CODE_VALUE_KEY": "ENRL", "REQUIRE_SEPDATE": "N"}, {"CODE_VALUE_KEY": "WITH", "REQUIRE_SEPDATE": "Y"}],
        "CODE_PROGRAM": [code("GRAD", "Graduate")], "CODE_DEGREE": [code("MBA", "Master")],
        "CODE_CURRICULUM": [code("BS", "Business", FAC2), code("MS", "Science", "", "A"), code("OLD", "Old", FAC, "I"), code("NUL", "Null", None)],
        "PersonPhone": [
            phone(1, 1, "33123456789", 240), phone(2, 1, "33123456789", 77), phone(3, 1, "225123456789", 240), phone(4, 2, "60123456789", 240), phone(5, 2, "60123456789", 100, created="1998-01-01"),
            phone(6, 3, "77123456789", 240), phone(7, 3, "79123456789", 240), phone(8, 3, "79123456789", 1, kind="WORK"), phone(9, 4, "22512345678", 240),
            phone(10, 4, "33123456789", 240), phone(11, 4, "33123456789", 241), phone(12, 5, "5", None), phone(13, 5, "5", 7), phone(14, 5, "22912345678", 240),
        ],
        "DialingCodes": [
            {"CountryId": c, "Prefix": p, "NumberLength": n} for c, p, n in ((77, 33, 11), (141, 60, 11), (55, 225, 11), (56, 22, 11), (24, 229, 11), (23, 229, 11), (9, 7, 12))
        ],
        "ADDRESSSCHEDULE": [
            address(1, A, "1999-01-01", "1999-05-31", "I", ""), address(2, A, "1999-06-01", None, "A", None), address(3, B, "1999-01-01", "1999-05-31", "I", "x"),
            address(4, B, "1999-06-01", None, "A", "y"), address(5, C, "1999-01-01", "1999-05-31", "I"), address(6, C, "1999-02-01", "1999-05-31", "I"),
            address(7, C, "1999-06-01", None, "A"), address(8, D, "1999-01-01", "1999-05-31", "I", kind="EMAL"), address(9, D, "1999-06-01", None, "A", kind="EMAL"),
            address(10, E, "1999-01-01", "1999-05-31", "I", recurring="Y"), address(11, E, "1999-06-01", None, "A", recurring="Y"), address(12, A, "1999-01-01", "1999-05-31", "I", None),
        ],
        "ADDRESS": [{"PEOPLE_ORG_CODE_ID": B, "ADDRESS_TYPE": "HOME"}, {"PEOPLE_ORG_CODE_ID": A, "ADDRESS_TYPE": "WORK"}],
        "PEOPLEORGBALANCE": [
            {"ID": "1", "PEOPLE_ORG_CODE_ID": A, "ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "ACADEMIC_SESSION": "01", "BALANCE_AMOUNT": money("1234.5")},
            {"ID": "2", "PEOPLE_ORG_CODE_ID": B, "ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "ACADEMIC_SESSION": "01", "BALANCE_AMOUNT": money("-0.5")},
        ],
        "CHARGECREDIT": [charge(1, A, "2000"), charge(2, A, "10", kind="C"), charge(3, A, "5", code_value="5-LOW", batch="B2"), charge(4, B, "7", anticipated="N", batch="B3", posted="Y")],
        "ChargeCreditTax": [{"CHARGECREDITNUMBER": 1, "AMOUNT": money("1")}, {"CHARGECREDITNUMBER": 4, "AMOUNT": money("1")}],
        "BATCHHEADER": [{"BATCH_NUMBER": b, "BATCH_TYPE": k, "TABLENAME": "CHARGECREDIT", "DELETED_FLAG": "N"} for b, k in (("B1", "IMPORT"), ("B2", "IMPORT"), ("B3", "MANUAL"))],
        "InvoiceDetail": [{"InvoiceDetailId": 1, "ChargeCreditNumber": 1}, {"InvoiceDetailId": 2, "ChargeCreditNumber": 4}],
        "STOPLIST": [stop(A, "2-HIGH", "1999-11-23", "Y", "was"), stop(B, "2-HIGH", "1999-11-22", "Y"), stop(C, "2-HIGH", "1999-01-01", "N"), stop(D, "2-HIGH", "1999-11-23", "Y")],
        "CODE_STOPLIST": [
            {"CODE_VALUE": "1", **code("2-HIGH", "High"), "STOP_REGISTRATION": "Y", "STOP_GRADES": "N", "SHOW_STOP_PICTURE": None, "CREATE_DATE": dt.datetime(1999, 1, 1, 5)},
            {"CODE_VALUE": "2", **code("1-URGENT", "Urgent", status="I"), "STOP_REGISTRATION": "y", "CREATE_DATE": dt.datetime(1999, 1, 2, 5)},
        ],
        "STDDEGREQ": [{"PEOPLE_CODE_ID": A, "PROGRAM": "GRAD", "DEGREE": "MBA", "CURRICULUM": "BS", "MATRIC_YEAR": "1998", "MATRIC_TERM": "FALL", "RECORD_TYPE": r} for r in ("A", "B")],
        "STDDEGREQEVENT": [
            {"PEOPLE_CODE_ID": A, "PROGRAM": "GRAD", "DEGREE": "MBA", "CURRICULUM": "BS", "MATRIC_YEAR": "1998", "MATRIC_TERM": "FALL", "RECORD_TYPE": "A", "EVENT_CLASS": "CORE",
             "EVENT_ID": "ENG 101", "EVENT_SUB_TYPE": s, "STATUS": st, "REQUIRED": req}
            for s, st, req in (("LECT", "C", "Y"), ("LAB", "Z", "Y"), ("LAB", "X", "Y"), ("LECT", None, "Y"), ("LECT", "P", "N"))
        ],
        "ASSESSMENTRULE": [
            {"ASSESSMENT_RULE_ID": 1, "ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "LONG_DESC": "x", "SELECT_CRITERIA": "a (STUDENTFINANCIAL.CREDIT_BILLING > 3) b", "SECTION_FEE_FLAG": "N"},
            {"ASSESSMENT_RULE_ID": 2, "ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "LONG_DESC": "y", "SELECT_CRITERIA": None, "SECTION_FEE_FLAG": "N"},
        ],
        "ASSESSCHARGECREDIT": [{"ASSESSMENT_RULE_ID": n, "CHARGE_CREDIT_CODE": "T", "PER_CREDIT_FLAT": "P", "AMOUNT": money("9.99")} for n in (1, 2)],
        "CODE_CHARGECREDIT": [{"CODE_VALUE_KEY": "T", "CRG_CRD_DESC": "Tuition", "CRG_CRD_MED_DESC": "Tu"}],
        "ACTION": [
            {"ACTION_ID": "1-URGENT", "ACTION_NAME": "Action 1-URGENT", "OFFICE": "REG", "TYPE": "T", "NOTE": "n", "STATUS": "A", "REQUIRED": "Y", "PRIORITY": "1", "Instruction": "do"},
            {"ACTION_ID": "2-HIGH", "ACTION_NAME": "Action 2-HIGH", "OFFICE": "FIN", "TYPE": "T", "NOTE": None, "STATUS": "A", "REQUIRED": "Y", "PRIORITY": "1"},
            {"ACTION_ID": "CANCSECT", "ACTION_NAME": "Section canceled", "OFFICE": "REG", "TYPE": "T", "NOTE": "Dear {{FIRST_NAME}}: {{SECTION}} is off.", "STATUS": "I", "REQUIRED": "N"},
        ],
        "ACTIONSCHEDULE": [
            {"ACTIONSCHEDULE_ID": 1, "ACTION_ID": "1-URGENT", "PEOPLE_ORG_CODE_ID": A, "SCHEDULED_DATE": day("1999-11-23"), "CANCELED": "N"},
            {"ACTIONSCHEDULE_ID": 2, "ACTION_ID": "1-URGENT", "PEOPLE_ORG_CODE_ID": A, "SCHEDULED_DATE": day("1999-11-24"), "WAIVED": "Y"},
            {"ACTIONSCHEDULE_ID": 3, "ACTION_ID": "1-URGENT", "PEOPLE_ORG_CODE_ID": A, "SCHEDULED_DATE": day("1999-11-24"), "EXECUTION_DATE": day("1999-11-01"), "CANCELED": "Y"},
            {"ACTIONSCHEDULE_ID": 4, "ACTION_ID": "1-URGENT", "PEOPLE_ORG_CODE_ID": A, "SCHEDULED_DATE": None},
        ],
        "VIOLATIONS": [{"PEOPLE_CODE_ID": A, **key(), "VIOLATION": "1-URGENT", "VIOLATION_DATE": day("1999-10-01")}],
        "CODE_VIOLATIONS": [code("1-URGENT", "u"), code("2-HIGH", "h")],
        "PersonUser": [
            {"PersonId": 1, "UserName": "Ann"}, {"PersonId": 2, "UserName": "bob"}, {"PersonId": 900000001, "UserName": "prof"}, {"PersonId": 900000002, "UserName": "dean"},
        ],
        "Application": [{"ApplicationId": 1, "Name": "portal"}, {"ApplicationId": 2, "Name": "other"}],
        "AppStore": [{"AppStoreId": 11, "ApplicationId": 1, "Mode": 2}, {"AppStoreId": 12, "ApplicationId": 1, "Mode": 3}],
        "AppRole": [{"AppRoleId": n, "ApplicationId": 1, "Name": r} for n, r in ((1, "Student"), (2, "Faculty"), (3, "Dossier"), (4, "Approval"))],
        "AppUser": [
            {"AppUserId": 1, "ApplicationId": 1, "UserName": "Ann", "Password": "", "CreationAppStoreId": 11, "AuthenticationAppStoreId": None},
            {"AppUserId": 9, "ApplicationId": 1, "UserName": "gone", "Password": ""}, {"AppUserId": 3, "ApplicationId": 1, "UserName": "admin", "Password": "x"},
            {"AppUserId": 4, "ApplicationId": 1, "UserName": "DEAN ", "Password": "", "CreationAppStoreId": 11, "AuthenticationAppStoreId": 12},
        ],
        "AppUserRole": [{"AppUserId": 1, "AppRoleId": 2}, {"AppUserId": 1, "AppRoleId": 4}, {"AppUserId": 3, "AppRoleId": 1}, {"AppUserId": 4, "AppRoleId": 1}, {"AppUserId": 9, "AppRoleId": 4}],
        "SiteMapRole": [{"SiteMapRoleId": 1, "RoleName": "Student"}, {"SiteMapRoleId": 2, "RoleName": "Faculty"}],
        "PersonTypeRole": [{"RoleName": "Student", "PersonTypeId": 7}, {"RoleName": "Faculty", "PersonTypeId": 8}],
        "CODE_RECORDTYPE": [{"RecordTypeId": 7, "CODE_VALUE_KEY": "STU", "STATUS": "A"}, {"RecordTypeId": 8, "CODE_VALUE_KEY": "FAC", "STATUS": "A"}],
        "ABT_USERS": [{"OPERATOR_ID": "OP1", "PEOPLE_CODE_ID": FAC, "STATUS": "A"}, {"OPERATOR_ID": "OP2", "PEOPLE_CODE_ID": FAC2, "STATUS": "A"}, {"OPERATOR_ID": "OP3", "PEOPLE_CODE_ID": A, "STATUS": "I"}],
        "ABT_USERPROFILE": [{"OPERATOR_ID": "OP1", "PROFILE_CODE": "REGSTAFF"}, {"OPERATOR_ID": "OP1", "PROFILE_CODE": "X"}, {"OPERATOR_ID": "OP2", "PROFILE_CODE": "X"}],
        "ABT_PROFILE": [{"PROFILE_CODE": "X", "PROFILE_NAME": "Ex"}],
        "CODE_OFFICE": [code("REG", "Registrar")],
        "MESSAGEQUEUE": [{"MESSAGEID": 7, "SUBJECT": "Happy Birthday!", "CREATE_DATE": day("1999-11-21")}],
        "MESSAGERECIPIENTS": [{"MESSAGEID": 7, "RECIPIENTTYPE": "to", "PEOPLECODEID": E}],
        "TRANSCRIPTMARKETING": [{"PEOPLE_CODE_ID": A, **key("ENG 101 ABC".replace(" ABC", ""), "D01"), "DROP_REASON": "CANCEL"}],
        "CODE_EVENTSUBTYPE": [{"CODE_VALUE": "LECT", "LONG_DESC": "Lecture"}],
    }
    for n, year, who, pay in ((1, 1998, A, "10"), (2, 1998, A, "20"), (3, 1998, B, "30"), (4, 1997, B, "40")):
        tables.setdefault("Reported1098TInformation", []).append(
            {"ReportedInformationId": n, "TaxYear": year, "People_Code_Id": who, "NameLine1": "N", "Payment": money(pay), "PaymentAdjustment": money("0"), "Scholarship": money("0")}
        )
        tables.setdefault("Reported1098TPeriodSummary", []).append(
            {"ReportedPeriodSummaryId": 10 * n, "ReportedInformationId": n, "TaxYear": year, "AcademicYear": str(year), "AcademicTerm": "FALL", "CumulativeChargesBilled": money(pay), "CurrentPaymentsReported": money("1")}
        )
        tables.setdefault("Reported1098TSummaryDetail", []).append(
            {"ReportedSummaryDetailId": 100 * n, "ReportedPeriodSummaryId": 10 * n, "ChargeCreditNumber": n, "ChargeCreditCode": "T", "Amount": money(pay)}
        )
        tables.setdefault("Reported1098TRefundCode", []).append({"ReportedRefundCodeId": n + 2, "TaxYear": year, "ChargeCreditCode": "R"})
    tables["NEW_Reported1098TInformation"] = [{**r, "Payment": money("41")} if r["ReportedInformationId"] == 2 else r for r in tables["Reported1098TInformation"][1:]]
    tables["NEW_Reported1098TPeriodSummary"] = tables["Reported1098TPeriodSummary"][1:]
    tables["NEW_Reported1098TSummaryDetail"] = tables["Reported1098TSummaryDetail"][1:3]
    tables["NEW_Reported1098TRefundCode"] = tables["Reported1098TRefundCode"][:1]
    return tables


def frames(spark, tables):
    out = {}
    for name in [*SCHEMAS, *(n for n in tables if n not in SCHEMAS)]:
        schema = T.StructType.fromDDL(SCHEMAS[name.removeprefix("NEW_")])
        rows = [tuple(r.get(f.name) for f in schema.fields) for r in tables.get(name, [])]
        out[name] = spark.createDataFrame(rows, schema)
    return out


def registry(spark, tables=None, **options) -> TableRegistry:
    built = frames(spark, tables or build())
    new = {n: built.get(f"NEW_{n}", f) for n, f in built.items()}
    return TableRegistry(spark, {"main": built, "identity": built, "old": built, "new": new}, **options)


def duck(tables=None):
    tables = tables or build()
    con = duckdb.connect()
    for name in [*SCHEMAS, *(n for n in tables if n not in SCHEMAS)]:
        columns = layout(name)
        con.execute(f"CREATE TABLE {name} (" + ", ".join(f"{c} {duck_type(k)}" for c, k in columns) + ")")
        for r in tables.get(name, []):
            con.execute(f"INSERT INTO {name} VALUES (" + ", ".join("?" * len(columns)) + ")", [r.get(c) for c, _ in columns])
    for name in SCHEMAS:
        if f"NEW_{name}" not in tables:
            con.execute(f"CREATE VIEW NEW_{name} AS SELECT * FROM {name}")
    return con
