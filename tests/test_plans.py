"""Campus plans whose results the shared SQL does not cover."""

import datetime as dt

import campus_fixture as c
import pytest
from pyspark.sql import functions as F

from rosterline.operators.changes import RunAborted
from rosterline.plans import groups, identity, lookups, metadata, notices, quality, reports, writers
from rosterline.sources.registry import TableRegistry

NOW = dt.datetime(1999, 11, 23, 9, 30)


@pytest.fixture(scope="module")
def campus(spark):
    return c.registry(spark)


def rows(df, *names):
    return {tuple(r[n] for n in names) for r in df.collect()}


def test_requested_people(spark, campus):
    assert rows(lookups.student_current(campus, "000-000 001"), "PEOPLE_CODE_ID") == {(c.A,)}
    asked = spark.createDataFrame([("1",), ("2",), ("77",)], "id string")
    assert rows(lookups.programs_enrolled(campus, asked), "PEOPLE_CODE_ID") == {(c.A,), (c.B,)}
    assert lookups.person_lookup(campus, "1").count() == 1
    assert lookups.person_lookup(campus, "0-1").count() == 0  # this service does not strip dashes
    assert lookups.students_in_section(campus, 1).count() < lookups.students_in_section(campus).count()
    assert lookups.balance_detail(campus, "2").collect()[0].BalanceFormatted == "-$0.50"
    assert lookups.code_values(campus, "CODE_PROGRAM").count() == 0  # not an open table
    assert lookups.sections(campus, section_id=8).count() >= 1  # a canceled section answers to its id


def test_case_blind_tables(spark):
    tables = c.build()
    tables["ACADEMIC"] = [{**r, "PEOPLE_CODE_ID": r["PEOPLE_CODE_ID"].lower() + " "} for r in tables["ACADEMIC"]]
    tables["CODE_PROGRAM"] = [c.code("grad ", "Graduate")]
    blind = c.registry(spark, tables, case_blind=True)
    plain = c.registry(spark, tables)
    assert lookups.student_current(blind).count() == lookups.student_current(c.registry(spark)).count() > 0
    assert lookups.student_current(plain).count() == 0


def test_unique_stop_run(spark, campus):
    asked = spark.createDataFrame(
        [(p, r) for p in (c.A, c.B, c.C, c.D, c.E, "P999999999") for r in ("2-HIGH", "1-URGENT", "none")] + [(c.A, "2-HIGH")], "PEOPLE_CODE_ID string, STOP_REASON string"
    )
    out = writers.insert_stops(campus, asked, NOW, "test", "ME", "why")
    note = "why\r\nBatch entry Nov 23, 1999"
    assert rows(out["STOPLIST"].changes, "PEOPLE_CODE_ID", "action", "COMMENTS") == {
        (c.A, "REOPEN", "was\r\n" + note), (c.D, "REOPEN", note), (c.B, "INSERT", note), (c.E, "INSERT", note),
    }
    assert out["STOPLIST"].new_state.count() == 6
    again = TableRegistry(spark, {"main": {**campus.databases["main"], "STOPLIST": out["STOPLIST"].new_state}})
    assert writers.insert_stops(again, asked, NOW)["STOPLIST"].changes.count() == 0
    with pytest.raises(RunAborted, match="ten letters"):
        writers.insert_stops(campus, spark.createDataFrame([("P1", "2-HIGH")], "PEOPLE_CODE_ID string, STOP_REASON string"), NOW)
    with pytest.raises(RunAborted, match="begin with P"):
        writers.insert_stops(campus, spark.createDataFrame([("X000000001", "2-HIGH")], "PEOPLE_CODE_ID string, STOP_REASON string"), NOW)


def test_one_posted_row_stops_the_purge(spark):
    tables = c.build()
    tables["CHARGECREDIT"].append(c.charge(9, c.B, "1", batch="B1", posted="Y"))
    with pytest.raises(RunAborted, match="posted.*B1"):
        writers.purge_anticipated_aid(c.registry(spark, tables), NOW)


def test_purge_leaves_headers_of_other_kinds(campus):
    out = writers.purge_anticipated_aid(campus, NOW, ["5-LOW"])
    assert rows(out["CHARGECREDIT"].changes, "CHARGECREDITNUMBER") == {(1,), (2,)}
    assert rows(out["BATCHHEADER"].new_state, "BATCH_NUMBER", "DELETED_FLAG") == {("B1", "Y"), ("B2", "N"), ("B3", "N")}


def test_action_requests_are_checked(spark, campus):
    asked = spark.createDataFrame(
        [("1-URGENT", c.A, "1999-12-01", None), ("none", c.A, "1999-12-01", None), ("1-URGENT", "P1", "1999-12-01", None), ("1-URGENT", c.A, " ", None), ("1-URGENT", c.B, "1999-12-01", "P8")],
        "action_id string, people_code_id string, sched_date string, resp_staff string",
    )
    out = writers.schedule_action(campus, asked, NOW)
    assert rows(out.accepted.changes, "ACTIONSCHEDULE_ID", "PEOPLE_ORG_ID", "REQUIRED") == {(5, "000000001", "Y")}
    assert sorted(r.errors[0] for r in out.rejected.collect()) == ["action_id 'none' not found", "people_code_id 'P1' not found", "resp_staff 'P8' not found"]


def test_batch_accepts_its_optional_columns(spark, campus):
    asked = spark.createDataFrame([("2-HIGH", c.A, "ME", "Y", 3)], "ACTION_ID string, PEOPLE_ORG_CODE_ID string, OPID string, WAIVED string, extra int")
    _, numbered = writers.schedule_actions_batch(campus, asked, NOW)
    assert numbered.collect()[0].WAIVED == "Y"
    with pytest.raises(ValueError, match="OPID"):
        writers.schedule_actions_batch(campus, asked.drop("OPID"), NOW)


def test_violation_once_per_person_and_section(spark, campus):
    asked = spark.createDataFrame([(1, "1-URGENT"), (4, "1-URGENT"), (4, "1-URGENT"), (4, "none"), (99, "2-HIGH"), (None, "2-HIGH")], "detail_id int, violation string")
    out = writers.record_violation(campus, asked, NOW)
    assert rows(out.accepted.changes, "PEOPLE_CODE_ID", "VIOLATION") == {(c.B, "1-URGENT")}
    assert out.rejected.count() == 2
    assert writers.record_violation(campus, asked, NOW, allow_duplicates=True).accepted.changes.count() == 3


def test_meeting_changes_need_their_term(campus):
    out = writers.update_section_meetings(campus, "1999", "FALL", ("2000", "SPRING"), ["1999-10-20"], {"1999-10-11": "1999-10-12"})
    assert all(part.changes.count() == 0 for part in out.values())
    out = writers.update_section_meetings(campus, "1999", "FALL", ("1999", "FALL"), ["1999-10-20"], {"1999-10-11": "1999-10-12"})
    assert rows(out["CALENDAR"].changes, "CALENDAR_KEY", "action") == {(104, "DELETE"), (105, "UPDATE")}
    assert rows(out["SECTIONSCHEDULE"].changes, "SECTIONSCHEDULE_ID") == {(1,), (2,), (5,), (7,), (9,)}


def test_cart_section_removal(spark, campus):
    asked = spark.createDataFrame([("000000001", c.FAC, 2), (c.B, c.FAC2, None), (c.C, c.FAC, None)], "PEOPLE_CODE_ID string, advisor string, SectionId bigint")
    assert rows(writers.cart_delete(campus, asked).changes, "PersonId", "SectionId") == {(1, 2), (3, 99)}


def test_help_links_and_rights(spark):
    reg = TableRegistry(
        spark,
        {"main": {
            "ABT_OBJECTS": spark.createDataFrame([("w1", None), ("w1", "kept"), ("w2", " "), ("w3", None)], "OBJECT_NAME string, HELP_NAME string").withColumns(
                {"REVISION_DATE": F.lit(None).cast("date"), "REVISION_TIME": F.lit(None).cast("timestamp_ntz"), "REVISION_OPID": F.lit(None).cast("string")}
            ),
            "ABT_TABLESECURITY": spark.createDataFrame(
                [("A", "t1", "Y", "N"), ("A", "t2", "N", "N"), ("B", "t1", "N", "N"), ("B", "t2", "Y", "Y"), ("C", "t1", "N", "N")],
                "SECURITY_ID string, TABLE_NAME string, EDIT_RIGHTS string, DELETE_RIGHTS string",
            ),
        }},
    )
    fixed = writers.fix_help_links(reg, {"w1": "one", "w2": "two"}, NOW, "ME")
    assert rows(fixed.changes, "OBJECT_NAME", "HELP_NAME", "REVISION_OPID") == {("w1", "one", "ME"), ("w2", "two", "ME")}
    copied = writers.copy_rights(reg, "A", "B")
    assert rows(copied.changes, "SECURITY_ID", "TABLE_NAME", "EDIT_RIGHTS") == {("B", "t1", "Y")}


def test_address_repair_runs_until_stable(spark, campus):
    first = quality.repair_addresses(campus)
    assert rows(first.changes, "SEQUENCE_NO", "action") == {(2, "DELETE"), (7, "DELETE"), (6, "PURGE"), (1, "REOPEN"), (12, "REOPEN"), (5, "REOPEN")}
    again = TableRegistry(spark, {"main": {**campus.databases["main"], "ADDRESSSCHEDULE": first.new_state}})
    assert quality.repair_addresses(again).changes.count() == 0
    old = TableRegistry(spark, {"main": {**campus.databases["main"], "ABT_SETTINGS": campus["ABT_SETTINGS"].withColumn("SETTING", F.lit("8.8.4"))}})
    with pytest.raises(RunAborted):
        quality.repair_addresses(old)


def test_tax_form_sample(campus):
    sample = quality.sample_tax_forms(campus, "old", "new", 1998, k=2).collect()
    assert len(sample) == 2 and all(r.here is not None and r.there is not None for r in sample)


def test_canceled_section_message(spark):
    tables = c.build()
    tables["TRANSCRIPTMARKETING"] = [{"PEOPLE_CODE_ID": c.A, **c.key("ENG 101 ABC", "D01-LONG"), "DROP_REASON": "CANCEL"}]
    tables["SECTIONS"].append(c.section(50, "ENG 101 ABC", "D01-LONG"))
    base = {"ACTION_ID": "CANCSECT", "COMPLETED": "N", "CANCELED": "N", "WAIVED": "N", "ACADEMIC_YEAR": "1999", "ACADEMIC_TERM": "FALL", "ACADEMIC_SESSION": "01"}
    tables["ACTIONSCHEDULE"] += [
        {**base, "ACTIONSCHEDULE_ID": 10, "PEOPLE_ORG_CODE_ID": c.A, "UNIQUE_KEY": "k1", "ACTION_NAME": "Canceled 1999/FALL/ENG 101 ABC/LECT/D01"},
        {**base, "ACTIONSCHEDULE_ID": 11, "PEOPLE_ORG_CODE_ID": c.B, "UNIQUE_KEY": "k2", "ACTION_NAME": "Canceled Section    2021/FALL/01/ENG 101 ABC/Lec"},
        {**base, "ACTIONSCHEDULE_ID": 12, "PEOPLE_ORG_CODE_ID": c.E, "UNIQUE_KEY": "k3", "ACTION_NAME": "Canceled"},
        {**base, "ACTIONSCHEDULE_ID": 13, "PEOPLE_ORG_CODE_ID": c.E, "UNIQUE_KEY": "k4", "ACTION_NAME": "Canceled", "COMPLETED": "Y"},
    ]
    reg = c.registry(spark, tables)
    messages = notices.section_canceled(reg, "self@x.edu")
    bodies = {r.uniqueKey: r.body for r in messages.collect()}
    assert bodies["k1"] == "Dear Ann: ENG 101 ABC/Lecture/D01-LONG (Reading & <Writing>) is off."
    assert bodies["k2"] == "Dear Bob: 01/ENG 101 ABC/Lec is off."
    assert bodies["k3"] == "Dear HOUSEHOLD: (unknown) is off." and "k4" not in bodies
    queued = notices.queue_messages(reg, messages, NOW)
    done = notices.complete_actions(reg, queued["result"], NOW, "P000000000")
    assert rows(done.changes, "ACTIONSCHEDULE_ID", "COMPLETED") == {(10, "Y"), (11, "Y"), (12, "Y")}


def test_queue_drops_and_numbers(spark, campus):
    asked = spark.createDataFrame([("f@x.edu", c.A, 1, "s", "b", 0)] * 2 + [("f@x.edu", c.B, 1, "s", "b", 0)], "`from` string, toId string, toTypeFlag int, subject string, body string, formatBodyFlag int")
    out = notices.queue_messages(campus, asked, NOW, "<", ">")
    assert rows(out["MESSAGEQUEUE"].changes, "MESSAGEID", "BODY") == {(8, "<b>")}
    assert rows(out["MESSAGERECIPIENTS"].changes, "RECIPIENTTYPE", "EMAILADDRESS") == {("to", "a@y.com")}
    with pytest.raises(ValueError):
        notices.queue_messages(campus, asked.drop("from"), NOW)
    nobody = asked.withColumn("from", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="no sender"):
        notices.queue_messages(campus, nobody, NOW)["result"].collect()


def test_guards(campus):
    assert notices.attendance_not_taken(campus, dt.date(1999, 11, 22)).count() == 0  # a Monday
    assert notices.attendance_not_taken(campus, dt.date(1999, 11, 23)).count() > 0
    assert notices.weekly_schedule(campus, dt.date(1999, 8, 15), "s@x.edu").count() == 0  # before the term
    assert rows(notices.birthday(campus, dt.date(1999, 11, 21), "l@x.edu"), "toId") == {(c.A,), (c.C,)}  # one more was greeted today
    assert notices.birthday(campus, dt.date(1999, 2, 28), "l@x.edu").count() == 0  # born on Feb 29


def test_mismatch_message_only_when_needed(spark, campus):
    assert notices.transcript_mismatch(campus, "a@x.edu", "b@x.edu").count() == 1
    tables = c.build()
    tables["TRANSCRIPTDETAIL"] = tables["TRANSCRIPTDETAIL"][:1]
    assert notices.transcript_mismatch(c.registry(spark, tables), "a@x.edu", "b@x.edu").count() == 0


def site(spark):
    def frame(data, kinds):
        return spark.createDataFrame(data, kinds)

    role, option = "SiteMapRoleId bigint, RoleName string, SortOrder int, IsCustom boolean", "SiteMapOptionId bigint, LinkId string, ExternalLink string, IsCustom boolean"
    detail = "SiteMapOptionDetailId bigint, SiteMapOptionId bigint, LinkId string, ExternalLink string, IsCustom boolean"
    link, link2 = "SiteMapOptionId bigint, SiteMapRoleId bigint, IsVisible boolean", "SiteMapOptionDetailId bigint, SiteMapRoleId bigint, IsVisible boolean"
    inst = "AreaName string, SectionName string, LabelName string, Setting string, PersonId bigint, CreateDatetime timestamp_ntz, RevisionDatetime timestamp_ntz"
    apps, roles, claims, grants = "ApplicationId int, Name string", "AppRoleId bigint, ApplicationId int, Name string", "AppClaimId bigint, ApplicationId int, Name string", "AppRoleId bigint, AppClaimId bigint"
    then = dt.datetime(1990, 1, 1)
    old = {
        "SiteMapRole": frame([(1, "Student", 1, False), (5, "Custom", 2, True)], role), "SiteMapOption": frame([(1, "home", None, False), (6, "extra", "x", True)], option),
        "SiteMapOptionDetail": frame([(1, 1, "home.d", None, False), (7, 6, "extra.d", "y", True)], detail), "SiteMapOptionRole": frame([(6, 5, True), (1, 1, True), (1, 5, False), (6, 99, True)], link),
        "SiteMapOptionDetailRole": frame([(7, 5, True)], link2), "InstitutionSetting": frame([("Theme", "s", "color", "red", 1, then, then), ("Theme", "s", "font", "big", 1, then, then), ("Other", "s", "z", "no", 1, then, then)], inst),
        "Application": frame([(4, "portal")], apps), "AppRole": frame([(41, 4, "Student"), (42, 4, "Custom")], roles), "AppClaim": frame([(1, 4, "read"), (2, 4, "write")], claims),
        "AppRoleClaim": frame([(41, 1), (42, 2)], grants),
    }
    new = {
        "SiteMapRole": frame([(1, "Student", 1, False)], role), "SiteMapOption": frame([(3, "home", None, False)], option), "SiteMapOptionDetail": frame([(9, 3, "home.d", None, False)], detail),
        "SiteMapOptionRole": frame([(3, 1, True)], link), "SiteMapOptionDetailRole": frame([], link2), "InstitutionSetting": frame([("Theme", "s", "color", "blue", 2, then, then)], inst),
        "Application": frame([(2, "portal")], apps), "AppRole": frame([(21, 2, "Student")], roles), "AppClaim": frame([(11, 2, "read"), (12, 2, "write")], claims), "AppRoleClaim": frame([(21, 11)], grants),
    }
    return TableRegistry(spark, {"main": new, "old": old, "new": new, "old_id": old, "new_id": new})


def test_settings_move_by_name(spark):
    reg = site(spark)
    out = identity.migrate_settings(reg, "old", "new", "old_id", "new_id", "portal", NOW)
    assert rows(out["SiteMapRole"].changes, "SiteMapRoleId", "RoleName") == {(2, "Custom")}
    assert rows(out["SiteMapOption"].changes, "SiteMapOptionId", "LinkId") == {(4, "extra")}
    assert rows(out["SiteMapOptionDetail"].changes, "SiteMapOptionDetailId", "SiteMapOptionId", "LinkId") == {(10, 4, "extra.d")}
    assert rows(out["SiteMapOptionRole"].changes, "SiteMapOptionId", "SiteMapRoleId", "IsVisible") == {(4, 2, True), (3, 2, False)}
    assert rows(out["SiteMapOptionDetailRole"].changes, "SiteMapOptionDetailId", "SiteMapRoleId") == {(10, 2)}
    assert rows(out["InstitutionSetting"].new_state, "LabelName", "Setting", "PersonId") == {("color", "red", 1), ("font", "big", 1)}
    assert rows(out["AppRole"].changes, "AppRoleId", "ApplicationId", "Name") == {(22, 2, "Custom")}
    assert rows(out["AppRoleClaim"].changes, "AppRoleId", "AppClaimId") == {(22, 12)}


def test_grant_all(spark):
    reg = site(spark)
    out = identity.grant_all(reg, "Student", "new_id", application_id=2)
    assert rows(out["AppRoleClaim"].changes, "AppRoleId", "AppClaimId") == {(21, 12)}
    assert out["SiteMapOptionRole"].changes.count() == 0 and rows(out["SiteMapOptionDetailRole"].changes, "SiteMapOptionDetailId", "SiteMapRoleId") == {(9, 1)}


def test_view_metadata(spark):
    def family(ids):
        out = {}
        for m in metadata.FAMILY:
            if m.table == metadata.HEAD:
                out[m.table] = spark.createDataFrame([(i, f"n{i}", f"v{i}") for i in ids], "VIEW_ID int, VIEW_NAME string, VIEW_DB_NAME string")
            elif m.table == "ABT_TABLESECURITY":
                out[m.table] = spark.createDataFrame([(f"v{i}", a) for i in ids for a in ("SYSTEM", "U")], "TABLE_NAME string, SECURITY_ID string")
            elif m.by == "name":
                out[m.table] = spark.createDataFrame([(f"v{i}",) for i in ids], f"{m.key} string")
            else:
                out[m.table] = spark.createDataFrame([(i, j) for i in ids for j in range(2)], "VIEW_ID int, n int")
        return out

    reg = TableRegistry(spark, {"main": family([5, 6, 10001]), "old": family([5, 7]), "new": family([6])})
    out = metadata.view_metadata_delete(reg, "v5", NOW)
    assert out["log"].count() == 1 and all(out[m.table].changes.count() >= 1 for m in metadata.FAMILY)
    assert rows(out["VISTAVIEW"].new_state, "VIEW_ID") == {(6,), (10001,)}
    assert metadata.view_metadata_delete(reg, "v10001", NOW)["VISTAVIEW"].changes.count() == 0
    assert metadata.view_metadata_delete(reg, "v10001", NOW, confirm=True)["VISTAVIEWSORT"].changes.count() == 2
    assert metadata.view_metadata_delete(reg, "nothing", NOW)["log"].count() == 0
    copied = metadata.view_metadata_copy(reg, 7, "old", "new")
    assert rows(copied["ABT_TABLESECURITY"].changes, "TABLE_NAME", "SECURITY_ID") == {("v7", "U")}
    assert copied["VISTAVIEW"].new_state.count() == 2 and copied["PBCATCOL"].changes.count() == 1


def test_group_sync(spark):
    edges = spark.createDataFrame([("g", "h"), ("h", "ann"), ("g", "bob")], "parent string, member string")
    current = spark.createDataFrame([("bob",), ("eve",)], "member string")
    out = groups.group_sync(edges, spark.createDataFrame([("g",)], "root string"), current)
    assert rows(out, "member", "action") == {("ann", "ADD"), ("eve", "REMOVE")}


def test_identity_report_and_second_run(spark, campus):
    operators = {"Dossier": None, "Approval": ("REGSTAFF",)}
    out = identity.sync_identity(campus, "portal", operators, "identity")
    assert {r.action for r in out["report"].collect()} == {"INSERT", "DELETE"}
    state = {**campus.databases["main"], "AppUser": out["AppUser"].new_state, "AppUserRole": out["AppUserRole"].new_state}
    again = identity.sync_identity(TableRegistry(spark, {"main": state, "identity": state}), "portal", operators, "identity")
    assert again["AppUser"].changes.count() == 0 and again["AppUserRole"].changes.count() == 0
    users = {a: {r.AppUserId for r in out["AppUser"].changes.filter(F.col("action") == a).collect()} for a in ("INSERT", "DELETE")}
    assert users["DELETE"] and not users["INSERT"] & users["DELETE"]
    assert not {r.AppUserId for r in out["AppUserRole"].new_state.collect()} & users["DELETE"]


def test_find_value_rows(campus):
    found = reports.find_value_rows(campus, "SECTIONS", "EVENT_ID", "ENG 101", "1999", "FALL")
    assert found.count() == 1 and found.columns[0] == "TableName"
    names = ["SECTIONS", "PEOPLE"]
    assert rows(reports.find_value(campus, names, "LAST_NAME", "Two", all_tables=True), "table_name", "instances") == {("PEOPLE", 1)}
    assert reports.find_value(campus, names, "EVENT_ID", "ENG 101", "1999", "FALL").collect()[0].instances == 1
