"""Stores with manifests, staged tables, and streams that keep tables in a store."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rosterline import staging
from rosterline.operators import changes, keys
from rosterline.operators.changes import ChangeSet, RunAborted
from rosterline.sources.folders import Folder
from rosterline.sources.manifest import Store
from rosterline.sources.registry import TableRegistry
from rosterline.streaming import ingest
from rosterline.streaming.state import LatestVersions, SeenOnce


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def first_run(spark, store):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(1,)], "k int")
    return store.publish({"a": changes.append(a.limit(0), a), "b": changes.append(b.limit(0), b)}, "first")


def test_names_are_taken_once(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.listing() == {} and not folder.exists()
    assert folder.write_new("a/b", "one ä") and not folder.write_new("a/b", "two")
    assert folder.read("a/b") == "one ä" and set(folder.listing("a")) == {"b"}


def test_a_run_becomes_current_whole(spark, store):
    assert dict(store.snapshot()) == {}
    first_run(spark, store)
    before = store.snapshot()
    a, b = before["a"], before["b"]
    sets = {
        "a": changes.upsert(a, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"], {"v": F.col("s.v")}, {}),
        "b": changes.delete_where(b, F.col("k") == 1),
    }
    done = store.publish(sets, "second")
    after = store.snapshot()
    assert (done.number, rows(after["a"]), rows(after["b"])) == (2, [(1, "a"), (2, "c"), (3, "d")], [])
    assert rows(after.changes("a")) == [(2, "c", "UPDATE"), (3, "d", "INSERT")] and rows(after.changes("b")) == [(1, "DELETE")]
    # A snapshot keeps showing its own tables, by itself and as a database of a registry.
    assert rows(before["a"]) == [(1, "a"), (2, "b")]
    registry = TableRegistry(spark, {"main": after, "old": before})
    assert rows(registry["b"]) == [] and rows(registry.table("b", "old")) == [(1,)]


def test_a_crash_between_two_writes_leaves_the_old_state(spark, store):
    first_run(spark, store)
    a, b = store.snapshot()["a"], store.snapshot()["b"]
    broken = b.withColumn("k", F.raise_error(F.lit("executor lost for good")).cast("int"))
    sets = {"a": changes.update_where(a, F.lit(True), {"v": F.lit("x")}), "b": ChangeSet(broken, broken.withColumn("action", F.lit("UPDATE")))}
    with pytest.raises(Exception, match="executor lost for good"):
        store.publish(sets, "second")
    assert len(store.folder.listing("runs/second")) == 1  # the first table was written
    assert store.manifest().run == "first" and rows(store.snapshot()["a"]) == [(1, "a"), (2, "b")]
    done = store.publish({**sets, "b": changes.append(b, b.withColumn("k", F.col("k") + 1))}, "second")
    assert done.number == 2 and rows(store.snapshot()["a"]) == [(1, "x"), (2, "x")] and rows(store.snapshot()["b"]) == [(1,), (2,)]
    assert store.vacuum(older_than_hours=24) == []
    gone = store.vacuum(keep=1, older_than_hours=0)
    assert len(gone) == 2 and rows(store.snapshot()["a"]) == [(1, "x"), (2, "x")]


def test_checks_come_before_any_write(spark, store):
    first_run(spark, store)
    a = store.snapshot()["a"]
    twice = spark.createDataFrame([(2, "c"), (2, "d")], "k int, v string")
    with pytest.raises(RunAborted, match="repeated source key"):
        store.publish({"a": changes.upsert(a, twice, ["k"], {"v": F.col("s.v")}, {})}, "second")
    with pytest.raises(RunAborted, match="posted"):
        store.publish({"a": changes.append(a, a)}, "second", {"posted": a})
    assert not store.folder.exists("runs/second") and store.manifest().number == 1


def test_a_run_is_published_once(spark, store):
    first_run(spark, store)
    a = store.snapshot()["a"]
    one = store.publish({"a": changes.append(a, a)}, "double")
    two = store.publish({"a": changes.append(store.snapshot()["a"], a)}, "double")
    assert one == two and store.snapshot()["a"].count() == 4
    with pytest.raises(ValueError, match="run name"):
        store.publish({}, "../x")


def test_of_two_runs_on_one_manifest_one_is_refused(spark, store):
    base = first_run(spark, store)
    a = store.snapshot()["a"]
    store.publish({"a": changes.append(a, a)}, "left", based_on=base)
    with pytest.raises(RunAborted, match="another run"):
        store.publish({"a": changes.delete_where(a, F.lit(True))}, "right", based_on=base)
    assert store.snapshot()["a"].count() == 4


def test_staged_tables_go_with_their_run(spark):
    df = spark.range(5).withColumn("v", F.lit("x"))
    with staging.run(spark):
        outer = staging.stage(df)
        with staging.run(spark):
            inner, kept = staging.stage(df, "inner"), staging.keep(df, "kept")
            assert inner.count() == 5
            paths = staging.staged_paths(spark)
        assert kept.count() == outer.count() == 5
        folder = staging.shared_folder(spark)
        left = set(Folder(spark, folder).listing())
        assert not any(n.startswith("inner-") for n in left) and any(n.startswith("kept-") for n in left)
    assert not {p.rpartition("/")[2] for p in paths[-3:]} & set(Folder(spark, folder).listing())


def test_staged_tables_are_pruned_and_keep_awkward_columns(spark):
    df = spark.range(3).selectExpr("id AS a", "id AS A", "NULL AS none", "id * 2 AS `x.y`")
    back = staging.stage(df)
    assert back.columns == df.columns and rows(back) == rows(df)
    plan = staging.stage(spark.range(3).selectExpr("id", "id * 2 AS wide")).select("id").filter("id > 1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,1)]" in text and "wide" not in text


def test_a_run_on_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        applicationId, master = "app-of-a-cluster", "spark://x"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(ValueError, match="shared by all executors"):
        staging.shared_folder(Session())


def test_row_keys_run_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    body = F.repeat(F.lit("body "), 200)
    df = spark.range(500).select((F.col("id") % 3).alias("g"), body.alias("body"), "id").repartition(5).mapInArrow(count, "g long, body string, id long")
    keyed = keys.with_row_key(df, ["g", F.col("id").desc()])
    got = rows(keyed.select("row_key", "g", "id"))
    want = sorted((i % 3, -i) for i in range(500))
    assert got == [(k + 1, g, -i) for k, (g, i) in enumerate(want)] and seen.value == 500


def test_row_keys_of_equal_rows_spread(spark):
    df = spark.range(2_000).select(F.lit("same").alias("v")).repartition(4)
    plan = keys.with_row_key(df, ["v"])
    assert sorted(r.row_key for r in plan.collect()) == list(range(1, 2_001))


APPLICATIONS = "app string, at int, score string"


def versions(store, buckets=8):
    return LatestVersions(store, "applications", ["app"], ["at"], buckets)


def test_latest_versions_rewrite_touched_buckets_only(spark, store):
    state = versions(store)
    everyone = spark.range(400).selectExpr("cast(id AS string) AS app", "1 AS at", "'old' AS score")
    first = state.merge(everyone)
    assert len(first.tables["applications"].parts) == 8
    second = state.merge(spark.createDataFrame([("7", 2, "new"), ("7", 3, "newer"), ("8", 0, "late")], APPLICATIONS))
    before, after = first.tables["applications"].parts, second.tables["applications"].parts
    assert sum(before[b] != after[b] for b in before) == 1  # the late row changes nothing
    found = {r.app: (r.at, r.score) for r in state.current().collect()}
    assert len(found) == 400 and found["7"] == (3, "newer") and found["8"] == (1, "old")


def test_repeated_batches_and_equal_versions_change_nothing(spark, store):
    state = versions(store)
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), (None, 1, "n"), ("b", None, "z")], APPLICATIONS)
    one = state.merge(batch)
    assert state.merge(batch) == one and state.merge(batch.limit(0)) == one
    assert rows(state.current().filter("app IS NOT NULL")) == [("a", 1, "y"), ("b", None, "z")]
    state.merge(spark.createDataFrame([("b", 1, "dated"), (None, 2, "m")], APPLICATIONS))
    assert {tuple(r) for r in state.current().collect()} == {("a", 1, "y"), ("b", 1, "dated"), (None, 2, "m")}
    # The number of buckets is the table's own, its key cannot change.
    assert versions(store, 99).merge(batch.limit(1)).tables["applications"].options["buckets"] == 8
    with pytest.raises(ValueError, match="kept by"):
        LatestVersions(store, "applications", ["score"], ["at"]).merge(batch)


def test_latest_versions_equal_a_plain_group_by(spark, store):
    events = spark.range(3_000).selectExpr("cast(pmod(hash(id), 211) AS string) AS app", "cast(pmod(hash(id, 1), 50) AS int) AS at", "cast(id AS string) AS score")
    state = versions(store, 5)
    for part in range(3):
        state.merge(events.filter(F.col("score").cast("int") % 4 >= part))
    want = events.groupBy("app").agg(F.max("at").alias("at"))
    assert rows(state.current().select("app", "at")) == rows(want)


def test_versions_survive_a_new_checkpoint(spark, store, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    state = LatestVersions(store, "applications", ["applicationId"], ["landed_at", "score"], 4)

    def run(mark):
        stream = ingest.applications(ingest.landed_csv(spark, str(land), "name string, score string"))
        ingest.run_available(stream, str(tmp_path / mark), state)

    (land / "DICAS_i_o_p_app1_c1.csv").write_text("name,score\nann,1\n")
    run("m1")
    one = store.manifest().number
    (land / "DICAS_i_o_p_app1_c1.csv").unlink()
    (land / "DICAS_i_o_p_app2_c1.csv").write_text("name,score\nbob,5\n")
    run("m2")  # another checkpoint counts its batches from zero again
    assert {(r.applicationId, r.score) for r in state.current().collect()} == {("app1", "1"), ("app2", "5")}
    run("m3")  # the same file a second time
    assert store.manifest().number == one + 1


def test_output_of_an_earlier_checkpoint_stays(spark, tmp_path):
    land, out = tmp_path / "land", str(tmp_path / "out")
    land.mkdir()

    def run(mark):
        stream = ingest.landed_csv(spark, str(land), "name string", str(tmp_path / "archive"))
        ingest.run_available(stream, str(tmp_path / mark), ingest.append_batches(out))

    (land / "a.csv").write_text("name\nann\n")
    run("m1")
    (land / "a.csv").unlink(missing_ok=True)
    (land / "b.csv").write_text("name\nbob\n")
    run("m2")
    run("m2")
    assert sorted(r.name for r in spark.read.parquet(out).collect()) == ["ann", "bob"]


def test_late_rows_of_a_replay_are_kept_once(spark, store, tmp_path):
    land, seen = tmp_path / "pull", SeenOnce(store, "scores", ["id"], "ts")
    land.mkdir()

    def pull(mark, *held):
        df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=d) if d is not None else None) for i, d in held], "id int, ts timestamp")
        df.coalesce(1).write.mode("append").parquet(str(land))
        ingest.run_available(spark.readStream.schema("id int, ts timestamp").parquet(str(land)), str(tmp_path / mark), seen)

    pull("m", (1, 0), (2, 40))
    pull("m", (2, 40), (3, 41), (None, 41))
    pull("m", (1, 0), (4, 1), (5, None), (None, 41))  # weeks behind the newest day
    assert {r.id for r in seen.current().collect()} == {1, 2, 3, 4, 5, None} and seen.current().count() == 6
    before = store.manifest().number
    pull("other", (4, 1))  # everything comes again under a new checkpoint
    assert store.manifest().number == before
    plan = store.frame(store.manifest().tables["scores"], ["19723/x"])
    assert plan.count() == 0 and os.path.isdir(store.folder.path)
