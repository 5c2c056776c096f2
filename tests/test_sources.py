"""Files and streams at the edges."""

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.sources import files
from rosterline.sources.registry import TableRegistry
from rosterline.streaming import ingest


def test_typed_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "codes.csv").write_bytes(b"\xef\xbb\xbfCountryId,Prefix,NumberLength,Created,Updated\n141,60,11,2021-03-18 18:23,\n")
    now = dt.datetime(2022, 1, 1, 5)
    row = files.read_csv_typed(spark, str(tmp_path), files.DIALING_CODES, {"Created": now, "Updated": now}).collect()[0]
    assert tuple(row) == (141, 60, 11, dt.datetime(2021, 3, 18, 18, 23), now)


def test_forms_to_index_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/f.xml").write_text(
        '<?xml version="1.0"?><DataSet xmlns:diffgr="urn:x"><diffgr:diffgram><DynamicForms>'
        "<DynamicForm><zNGImageName>a</zNGImageName><PEOPLE_CODE_ID>P1</PEOPLE_CODE_ID><EmailAddress>e@x</EmailAddress><Other>z</Other></DynamicForm>"
        "<DynamicForm><zNGImageName>b</zNGImageName><PEOPLE_CODE_ID>P2</PEOPLE_CODE_ID></DynamicForm></DynamicForms></diffgr:diffgram></DataSet>"
    )
    lines = files.form_index_lines(files.read_forms(spark, str(tmp_path / "in")))
    files.write_lines(lines.coalesce(1), str(tmp_path / "out"))
    written = b"".join(p.read_bytes() for p in (tmp_path / "out").glob("part-*"))
    assert sorted(written.decode().split("\r\n")) == ["", "a,P1,e@x", "b,P2,"]


def test_export_ids(spark):
    listing = json.dumps([{"uid": "1", "status": "NotDelivered"}, {"status": "NotDelivered"}, {"uid": "2", "status": "Delivered"}])
    df = spark.createDataFrame([(listing,)], "value string")
    assert [r.uid for r in files.export_ids(df, status="NotDelivered").collect()] == ["1"]
    assert files.export_ids(df).count() == 2


def test_registry_aliases_and_views(spark):
    a, b = spark.range(1).toDF("k"), spark.range(2).toDF("k")
    reg = TableRegistry(spark, {"main": {"t": a}, "old": {"t": b}})
    assert reg["t"].count() == 1 and reg.table("t", "old").count() == 2 and reg.use("old")["t"].count() == 2
    assert reg.alias(old={"t": a}).table("t", "old").count() == 1
    reg.register_views({"v_t": "t"})
    assert spark.sql("SELECT * FROM v_t").count() == 1


def test_document_names(spark):
    names = [
        "DICAS_app_77_p1_fullAppPDF__55!2021-01-02.pdf", "DICAS_pers_77__essay__f9!2021-01-02.pdf", "DICAS_pers_77__transcriptofficial_c4_f9!2021-01-02.pdf", "other.pdf",
    ]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(*ingest.document_parts(F.col("n")))
    assert [tuple(r) for r in df.collect()] == [
        ("app", "77", "p1", "fullAppPDF", None, "55", "2021-01-02"), ("pers", "77", None, "essay", None, "f9", "2021-01-02"),
        ("pers", "77", None, "transcriptofficial", "c4", "f9", "2021-01-02"), (None,) * 7,
    ]


SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("score", T.StringType())])


def test_landed_files_are_consumed_once(spark, tmp_path):
    land, out, mark = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "mark")
    land.mkdir()
    (land / "DICAS_i_o_p_app1_c1.csv").write_text("name,score\nann,1\n")

    def run():
        stream = ingest.applications(ingest.landed_csv(spark, str(land), SCHEMA, str(tmp_path / "archive")))
        ingest.run_available(stream, mark, ingest.append_batches(out))

    run()
    run()
    (land / "DICAS_i_o_p_app1_c2.csv").write_text("name,score\nann,2\n")
    run()
    rows = spark.read.parquet(out)
    assert rows.count() == 2 and {r.casApplicantId for r in rows.collect()} == {"c1", "c2"}
    latest = ingest.latest_versions(rows, ["applicationId"], ["landed_at", "score"])
    assert [(r.applicationId, r.score) for r in latest.collect()] == [("app1", "2")]
    everything = ingest.replay(rows.withColumn("landed_at", F.col("landed_at").cast("timestamp_ntz")), "landed_at", dt.datetime(2000, 1, 1), dt.datetime(2100, 1, 1))
    assert everything.count() == 2


def test_landed_updates_replace_earlier_versions(spark, tmp_path):
    land, out, mark = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "mark")
    land.mkdir()

    def run():
        stream = ingest.applications(ingest.landed_csv(spark, str(land), SCHEMA))
        ingest.run_available(stream, mark, ingest.merge_batches(out, ["applicationId"], ["landed_at", "score"]))

    (land / "DICAS_i_o_p_app1_c1.csv").write_text("name,score\nann,1\n")
    (land / "DICAS_i_o_p_app2_c1.csv").write_text("name,score\nbob,5\n")
    run()
    (land / "DICAS_i_o_p2_app1_c1.csv").write_text("name,score\nann,2\n")
    run()
    run()
    states = spark.read.parquet(out)
    assert states.agg(F.max("state")).collect()[0][0] == 1
    assert {(r.applicationId, r.score) for r in states.filter("state = 1").collect()} == {("app1", "2"), ("app2", "5")}


def test_opaque_files_give_names(spark, tmp_path):
    land, out = tmp_path / "docs", str(tmp_path / "names")
    land.mkdir()
    (land / "DICAS_pers_77__essay__f9!2021-01-02.pdf").write_bytes(b"%PDF")
    ingest.run_available(ingest.landed_names(spark, str(land)), str(tmp_path / "m"), ingest.append_batches(out))
    assert spark.read.parquet(out).select(*ingest.document_parts(F.col("file_name"))).collect()[0].fileId == "f9"


def test_repeated_pulls_are_dropped(spark, tmp_path):
    land, out, mark = tmp_path / "pull", str(tmp_path / "o"), str(tmp_path / "m")
    land.mkdir()
    schema = "id int, ts timestamp"
    spark.sql("SELECT 1 AS id, timestamp'2024-01-01' AS ts UNION ALL SELECT 2, timestamp'2024-01-02'").coalesce(1).write.mode("append").parquet(str(land))

    def run():
        stream = ingest.dedupe_overlap(spark.readStream.schema(schema).parquet(str(land)), ["id"], "ts")
        ingest.run_available(stream, mark, ingest.append_batches(out))

    run()
    spark.sql("SELECT 2 AS id, timestamp'2024-01-02' AS ts UNION ALL SELECT 3, timestamp'2024-01-05'").coalesce(1).write.mode("append").parquet(str(land))
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_error_bodies_are_set_apart(spark):
    df = spark.createDataFrame([("rows",), ("User is not authenticated.",), (None,)], "body string")
    parts = ingest.split_errors(df, "body")
    assert parts["ok"].count() == 2 and parts["rejected"].count() == 1
