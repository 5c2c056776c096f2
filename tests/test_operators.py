"""Operator properties, null rules, skew and plan shapes."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterline.functions import dates, markup, money, text
from rosterline.operators import aggregates, batch, changes, filters, joins, keys, ranking, rendering, sets


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def one(spark, expression, **columns):
    names = list(columns) or ["x"]
    values = tuple(columns.values()) or (1,)
    kinds = ", ".join(f"{n} {'string' if v is None or isinstance(v, str) else 'timestamp_ntz' if isinstance(v, dt.datetime) else 'date' if isinstance(v, dt.date) else 'double' if isinstance(v, float) else 'bigint'}" for n, v in zip(names, values))
    return spark.createDataFrame([values], kinds).select(expression.alias("r")).collect()[0]["r"]


# ---------------------------------------------------------------- expressions


@pytest.mark.parametrize(
    "typed, fixed",
    [("165-048", "P000165048"), (" 12 ", "P000000012"), ("12345678", "P012345678"), ("123456789", "P123456789"), ("P123456789", "P123456789"), ("12345678901", "12345678901"), (None, None)],
)
def test_person_id_padding(spark, typed, fixed):
    assert one(spark, text.pad_person_id("x"), x=typed) == fixed


def test_text_rules(spark):
    assert one(spark, text.same_text("a", "b"), a="Bob ", b="BOB")
    assert one(spark, text.text_length("a"), a="ab  ") == 2
    assert one(spark, text.blank_to_null("a"), a="  ") is None
    assert one(spark, text.join_text(F.col("a"), "-", F.col("b")), a="x", b=None) is None
    assert one(spark, text.append_line("a", F.lit("new")), a=None) == "new"
    assert one(spark, text.append_line("a", F.lit("new")), a="old") == "old\r\nnew"
    assert one(spark, text.version_part("a", 1), a="9.1.4") == 4
    assert one(spark, text.version_part("a", 3), a="9.1") is None
    assert one(spark, text.text_between("a", "MARK", ")"), a="x(mark >= 3) y)") == " >= 3"
    assert one(spark, text.text_between("a", "MARK", ")"), a="nothing") is None
    assert one(spark, text.merge_template("Hi {{A}} {{B}}", {"A": F.col("a"), "B": F.col("b")}), a="x", b=None) is None
    assert one(spark, text.merge_template("Hi {{A}}{{A}}", {"A": F.col("a")}), a="x") == "Hi xx"


def test_case_blind_join(spark):
    a = spark.createDataFrame([("Ann ",), ("bob",)], "k string")
    b = spark.createDataFrame([("ANN",)], "k string")
    a, b = (d.select(text.case_blind("k").alias("k")) for d in (a, b))
    assert joins.semi(a, b, ["k"]).count() == 1
    assert a.unionByName(b).distinct().count() == 2


def test_display_names(spark):
    columns = {"PX": F.col("px"), "DN": F.col("dn"), "LN": F.col("ln"), "SX": F.col("sx")}
    pattern = "PX |DN |LP |LN, |SX "
    assert one(spark, text.display_name(pattern, columns), px="Dr.", dn="Pat", ln="Lee", sx="Jr.") == "Dr. Pat Lee, Jr."
    assert one(spark, text.display_name(pattern, columns), px=None, dn="Pat", ln="Lee", sx="") == "Pat Lee"
    with pytest.raises(ValueError):
        text.display_name("ZZ ", columns)


def test_date_rules(spark):
    late, early = dt.datetime(2020, 1, 1, 10, 0, 59), dt.datetime(2020, 1, 1, 10, 1, 0)
    assert one(spark, dates.minutes_between("a", "b"), a=late, b=early) == 1
    assert one(spark, dates.hours_between("a", "b"), a=dt.datetime(2020, 1, 1, 9, 59), b=dt.datetime(2020, 1, 1, 10, 0)) == 1
    assert one(spark, dates.on_date("d", "t"), d=dt.date(2020, 2, 3), t=dt.datetime(1900, 1, 1, 7, 8, 9)) == dt.datetime(2020, 2, 3, 7, 8, 9)
    assert one(spark, dates.duration_text("a", "b"), a=dt.datetime(1900, 1, 1, 9), b=dt.datetime(1900, 1, 1, 10, 5)) == "    1 5"
    assert one(spark, dates.duration_text("a", "b"), a=dt.datetime(1900, 1, 1, 9), b=dt.datetime(1900, 1, 1, 9)) == "       "
    assert one(spark, dates.week_number("a", F.lit("2020-01-01").cast("date")), a=dt.date(2020, 1, 5)) == 1
    assert one(spark, dates.format_date("a", "D"), a=dt.date(2020, 2, 3)) == "Monday, February 3, 2020"
    assert one(spark, dates.format_date("a", "t"), a=dt.datetime(2020, 2, 3, 13, 5)) == "1:05 PM"
    assert one(spark, dates.same_month_and_day("a", dt.date(2021, 2, 28)), a=dt.date(2020, 2, 29)) is False
    assert one(spark, dates.stamp_key("a", dt.datetime(2020, 2, 3, 4, 5, 6, 7000)), a="ACT") == "ACT202023457"


def test_money_and_markup(spark):
    assert one(spark, money.format_amount("a"), a=-1234.5) == "-$1,234.50"
    assert one(spark, money.format_amount("a", "N"), a=0.0) == "0.00"
    assert one(spark, markup.row([F.col("a"), F.col("b")]), a="x & <y>", b=None) == "<tr><td>x &amp; &lt;y&gt;</td></tr>"


# ---------------------------------------------------------------- null rules


@pytest.mark.parametrize("values, kept", [([1, 2], {3}), ([1, None], set()), ([], {1, 3, None}), ([None], set()), ([9], {1, 3})])
def test_not_in_matches_sql(spark, values, kept):
    probe = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    listed = spark.createDataFrame([(v,) for v in values], "v int")
    assert {r[0] for r in joins.not_in(probe, "x", listed, "v").collect()} == kept
    listed.createOrReplaceTempView("listed")
    probe.createOrReplaceTempView("probe")
    assert {r[0] for r in spark.sql("SELECT x FROM probe WHERE x NOT IN (SELECT v FROM listed)").collect()} == kept


def test_not_in_per_group_matches_sql(spark):
    probe = spark.createDataFrame([(g, x) for g in "abcd" for x in (1, 2, None)], "g string, x int")
    listed = spark.createDataFrame([("a", 1), ("b", None), ("c", 1), ("c", 2)], "g string, v int")
    ours = {tuple(r) for r in joins.not_in_per_group(probe, "x", listed, "v", ["g"]).collect()}
    listed.createOrReplaceTempView("listed_g")
    probe.createOrReplaceTempView("probe_g")
    sql = spark.sql("SELECT g, x FROM probe_g p WHERE x NOT IN (SELECT v FROM listed_g l WHERE l.g = p.g)")
    assert ours == {tuple(r) for r in sql.collect()}


def test_blank_and_null_are_one_key(spark):
    rows = spark.createDataFrame([(1, "x", None, dt.date(2020, 1, 1), None, "A"), (2, "x", "", dt.date(2019, 1, 1), dt.date(2019, 12, 31), "I")], "id int, p string, a string, s date, e date, st string")
    found = joins.adjacent_versions(rows, ["p", "a"], "s", "e", F.col("st") == "A", F.col("st") == "I")
    assert [r.id for r in found.collect()] == [1]


# ---------------------------------------------------------------- overlaps


intervals = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(0, 6), st.integers(0, 200), st.integers(0, 80)), min_size=1, max_size=25
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=intervals)
def test_overlaps_match_brute_force(spark, rows):
    base = dt.datetime(2020, 1, 1)
    data = [(p, k, base + dt.timedelta(hours=s), base + dt.timedelta(hours=s + n)) for p, k, s, n in rows]
    df = spark.createDataFrame(data, "p string, k int, s timestamp_ntz, e timestamp_ntz")
    expected = sorted((a[0], a[1], b[1]) for a in data for b in data if a[0] == b[0] and a[1] != b[1] and a[2] <= b[3] and b[2] <= a[3])
    for width in (1, 3):
        pairs = joins.overlap_pairs(df, "p", "s", "e", "k", bucket_days=width)
        assert sorted((r.p, r.k1, r.k2) for r in pairs.collect()) == expected


def test_overlap_counts_match_pairs(spark):
    base = dt.datetime(2020, 1, 1)
    data = [("hot" if i % 3 else f"p{i}", i, base + dt.timedelta(hours=(i * 37) % 500), base + dt.timedelta(hours=(i * 37) % 500 + i % 9)) for i in range(300)]
    data += [("hot", 1, *data[1][2:])]  # one key twice: pairs within a key do not count
    df = spark.createDataFrame(data, "p string, k int, s timestamp_ntz, e timestamp_ntz")
    pairs = joins.overlap_pairs(df, "p", "s", "e", "k").groupBy("p").count()
    counts = aggregates.overlap_counts(df, "p", "s", "e", "k")
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, counts.collect()))


def test_touching_meetings_conflict(spark):
    at = lambda h, m=0: dt.datetime(2020, 1, 1, h, m)
    df = spark.createDataFrame([("p", 1, at(9), at(10)), ("p", 2, at(10), at(11)), ("p", 3, at(11, 1), at(12))], "p string, k int, s timestamp_ntz, e timestamp_ntz")
    assert {(r.k1, r.k2) for r in joins.overlap_pairs(df, "p", "s", "e", "k").collect()} == {(1, 2), (2, 1)}


# ---------------------------------------------------------------- keys, ranking, sets


def test_row_keys_are_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("v"), F.col("id"))
    out = keys.with_row_key(df, [F.col("v").desc(), "id"], base=10)
    assert out.agg(F.min("row_key"), F.max("row_key"), F.count_distinct("row_key")).collect()[0] == (11, 5010, 5000)
    pairs = [tuple(r) for r in out.select("row_key", "v").collect()]
    assert [v for _, v in sorted(pairs)] == sorted((v for _, v in pairs), reverse=True)


def test_rank_one_keeps_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 3), (None, 5, 4), ("b", None, 5), ("b", 1, 6)], "k string, o int, id int")
    assert {r.id for r in ranking.first_per_key(df, ["k"], [F.col("o")]).collect()} == {1, 2, 4, 5}
    assert {r.id for r in ranking.beaten_per_key(df, ["k"], [F.col("o")]).collect()} == {3, 6}
    assert {r.id for r in ranking.last_per_key(df, ["k"], [F.col("o")]).collect()} == {3, 4, 6}


def test_sample_is_stable(spark):
    df = spark.range(1000)
    first = {r.id for r in ranking.seeded_sample(df, ["id"], 5, 3).collect()}
    assert first == {r.id for r in ranking.seeded_sample(df.repartition(7), ["id"], 5, 3).collect()}
    assert first != {r.id for r in ranking.seeded_sample(df, ["id"], 5, 4).collect()}


def test_membership_is_cycle_safe(spark):
    edges = spark.createDataFrame([("g", "g"), ("g", "h"), ("h", "i"), ("i", "h"), ("i", "ann"), ("h", "bob"), ("x", "eve")], "parent string, member string")
    roots = spark.createDataFrame([("g",), ("x",)], "root string")
    assert {tuple(r) for r in sets.flatten_membership(edges, roots).collect()} == {("g", "ann"), ("g", "bob"), ("x", "eve")}


def test_render_rows_of_a_hot_key(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2500, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    out = {r.k: r.h for r in rendering.render_rows(df, ["k"], ["id"], [F.col("id")], "h").collect()}
    assert out["hot"] == "".join(f"<tr><td>{i}</td></tr>" for i in range(2500))
    assert len(out) == 51


def test_dedupe_keeps_lowest_and_spares_the_rest(spark):
    df = spark.createDataFrame([(3, "x", "I"), (1, "x", "A"), (2, None, "I"), (4, None, "I"), (5, "", "I")], "id int, v string, s string")
    assert {r.id for r in aggregates.dedupe_keep_min(df, ["v"], "id").collect()} == {1, 2, 5}
    assert {r.id for r in aggregates.dedupe_keep_min(df, ["v"], "id", F.col("s") == "A").collect()} == {1, 2, 3, 4, 5}


def test_reconcile_with_itself(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "b", None)], "id int, x string, y string")
    assert tuple(aggregates.reconcile(df, df, "id", ["x", "y"]).collect()[0]) == (2, 2)
    swapped = df.select("id", F.col("y").alias("x"), F.col("x").alias("y"))
    assert tuple(aggregates.reconcile(df, swapped, "id", ["x", "y"]).collect()[0]) == (2, 0)


def test_prefix_lookup_prefers_the_longest(spark):
    numbers = spark.createDataFrame([("12345",), ("12999",), ("1234",), ("99999",), (None,)], "n string")
    codes = spark.createDataFrame([("1", 5, 1), ("12", 5, 2), ("123", 5, 4), ("123", 5, 3)], "p string, l int, c int")
    out = {r.n: r.c for r in joins.prefix_lookup(numbers, "n", codes, "p", "l", "c", "c").collect()}
    assert out == {"12345": 3, "12999": 2, "1234": None, "99999": None, None: None}


# ---------------------------------------------------------------- change-sets


def test_conform_schema_checks_before_work(spark):
    df = spark.createDataFrame([(1, "x", 9)], "A int, b string, extra int")
    out = filters.conform_schema(df, {"a": "bigint"}, {"B": "string", "c": "date"}, one_of=[("b", "z")])
    assert out.columns == ["a", "B", "c"] and out.collect()[0] == (1, "x", None)
    with pytest.raises(ValueError, match="missing"):
        filters.conform_schema(df, {"q": "string"}, {})
    with pytest.raises(ValueError, match="at least one"):
        filters.conform_schema(df, {}, {}, one_of=[("y", "z")])
    empty = spark.createDataFrame([(None,)], "a int")
    with pytest.raises(Exception, match="must not be null"):
        filters.conform_schema(empty, {"a": "int"}, {}).collect()


def test_sync_twice_changes_nothing(spark):
    target = spark.createDataFrame([(1, 1), (2, 1), (3, 9)], "u int, r int")
    desired = spark.createDataFrame([(1, 1), (4, 1)], "u int, r int")
    managed = spark.createDataFrame([(1,)], "r int")
    first = changes.sync_to(target, desired, ["u", "r"], managed, ["r"])
    assert {tuple(r) for r in first.changes.collect()} == {(4, 1, "INSERT"), (2, 1, "DELETE")}
    assert changes.sync_to(first.new_state, desired, ["u", "r"], managed, ["r"]).changes.count() == 0
    assert {tuple(r) for r in changes.preview(first.changes).collect()} == {("INSERT", 1), ("DELETE", 1)}


def test_insert_missing_twice(spark):
    target, source = spark.range(3).toDF("k"), spark.range(5).toDF("k")
    first = changes.insert_missing(target, source, ["k"])
    assert first.changes.count() == 2 and changes.insert_missing(first.new_state, source, ["k"]).changes.count() == 0


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    out = changes.upsert(target, source, ["k"], {"v": F.col("s.v")}, {})
    assert {tuple(r) for r in out.new_state.collect()} == {("a", 1), ("b", 20), ("c", 30)}
    assert {(r.k, r.action) for r in out.changes.collect()} == {("b", "UPDATE"), ("c", "INSERT")}


def test_new_ids_continue_and_an_empty_table_starts_at_one(spark):
    target = spark.createDataFrame([(7, "x")], "id bigint, n string")
    rows = spark.createDataFrame([("b",), ("a",)], "n string")
    _, numbered = changes.insert_returning(target, rows, "id", ["n"])
    assert {tuple(r) for r in numbered.select("n", "id").collect()} == {("a", 8), ("b", 9)}
    _, numbered = changes.insert_returning(target.limit(0), rows, "id", ["n"])
    assert {r.id for r in numbered.collect()} == {1, 2}


def test_gate_and_run_path(spark, tmp_path):
    bad = spark.createDataFrame([("B1",)], "batch string")
    with pytest.raises(changes.RunAborted, match="posted.*B1"):
        changes.require_none({"posted": bad})
    changes.require_none({"posted": bad.limit(0)})
    done = changes.append(spark.range(2).toDF("k"), spark.range(2, 3).toDF("k"))
    changes.write_run({"t": done}, str(tmp_path / "run"))
    assert spark.read.parquet(str(tmp_path / "run/state/t")).count() == 3
    with pytest.raises(Exception, match="already exists"):
        changes.write_run({"t": done}, str(tmp_path / "run"))


def test_writers_run_once_and_refuse_repeated_source_keys(spark, tmp_path):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (None, "z")], "k int, v string")
    for name, out in {"up": changes.upsert(target, twice, ["k"], {"v": F.col("s.v")}, {}), "from": changes.update_from(target, twice, ["k"], {"v": "v"})}.items():
        with pytest.raises(changes.RunAborted, match="repeated source key"):
            changes.write_run({"t": out}, str(tmp_path / name))
        assert not (tmp_path / name).exists()

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.createDataFrame([(1, "x"), (3, "n")], "k int, v string")
    for n, (write, state, done) in enumerate([
        (lambda t: changes.update_where(t, F.col("k") == 1, {"v": F.lit("x")}), {(1, "x"), (2, "b")}, {(1, "x", "UPDATE")}),
        (lambda t: changes.delete_where(t, F.col("k") == 1), {(2, "b")}, {(1, "a", "DELETE")}),
        (lambda t: changes.append(t, source.filter("k = 3")), {(1, "a"), (2, "b"), (3, "n")}, {(3, "n", "INSERT")}),
        (lambda t: changes.upsert(t, source, ["k"], {"v": F.col("s.v")}, {}), {(1, "x"), (2, "b"), (3, "n")}, {(1, "x", "UPDATE"), (3, "n", "INSERT")}),
        (lambda t: changes.update_from(t, source, ["k"], {"v": "v"}), {(1, "x"), (2, "b")}, {(1, "x", "UPDATE")}),
    ]):
        before, path = seen.value, str(tmp_path / f"once{n}")
        changes.write_run({"t": write(target.mapInArrow(count, "k int, v string"))}, path)
        assert seen.value - before == 2
        assert {tuple(r) for r in spark.read.parquet(f"{path}/state/t").select("k", "v").collect()} == state
        assert {tuple(r) for r in spark.read.parquet(f"{path}/changes/t").select("k", "v", "action").collect()} == done


def test_audit_log(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "k int, v string, w string")
    after = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", "z")], "k int, v string, w string")
    log = changes.audit_log(before, after, ["k"], ["v", "w"], "job", dt.datetime(2020, 1, 1), "ME")
    assert {(r.k, r.action, r.before_image, r.after_image) for r in log.collect()} == {
        (2, "UPDATE", '{"v":"b","w":"x"}', '{"v":"b","w":null}'), (3, "DELETE", '{"v":"c","w":"y"}', None), (4, "INSERT", None, '{"v":"d","w":"z"}'),
    }
    assert changes.audit_log(before, before, ["k"], ["v"], "job", dt.datetime(2020, 1, 1), "ME").count() == 0


def test_backfill_gives_a_key_once(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", 10), (4, "b", None), (5, "c", None)], "id int, who string, key int")
    candidates = spark.createDataFrame([("a", 11, 2), ("a", 12, 1), ("b", 10, 1), ("c", 13, 1)], "w string, k int, o int")
    out = batch.backfill_key(target, "key", "id", candidates, {"who": "w"}, "k", [F.col("o")], ["who"], 10)
    assert {(r.id, r.key) for r in out.changes.collect()} == {(2, 12), (5, 13)}
    one_only = batch.backfill_key(target, "key", "id", candidates, {"who": "w"}, "k", [F.col("o")], ["who"], 1)
    assert {r.id for r in one_only.changes.collect()} == {5}


# ---------------------------------------------------------------- plans


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_sides_join_by_key(spark, no_broadcast):
    """Without small sides no operator falls back to a nested loop or a product."""
    a = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.current_date().alias("s"), F.current_date().alias("e"))
    b = a.select(F.col("k").alias("k2"), F.col("v").alias("v2"))
    codes = spark.createDataFrame([(1, 2, 3)], "p int, l int, c int")
    frames = {
        "overlap": joins.overlap_pairs(a, "v", "s", "e", "k"),
        "prefix": joins.prefix_lookup(a.withColumn("n", F.col("k").cast("string")), "n", codes, "p", "l", "c", "c"),
        "not in": joins.not_in(a, "v", b, "v2"),
        "not in group": joins.not_in_per_group(a, "v", b, "v2", {"k": "k2"}),
        "first": joins.first_match(a, b, {"v": "v2"}, [F.col("k2")], {"x": "k2"}),
        "rank": ranking.first_per_key(a, ["v"], [F.col("k")]),
        "sets": sets.compare_sets(a, a, ["k"]),
    }
    for name, df in frames.items():
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name
        assert "PythonUDF" not in plan and "BatchEval" not in plan, name


def test_no_window_over_a_hot_key(spark):
    a = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    for df in (ranking.first_per_key(a, ["v"], [F.col("k")]), ranking.latest_row_per_key(a, ["v"], [F.col("k")]), joins.first_match(a, a.toDF("k2", "v2"), {"v": "v2"}, [F.col("k2")], {"x": "k2"})):
        plan = plan_of(df)
        assert "Window" not in plan and "partial_" in plan


def test_hot_key_of_chained_joins_is_split(spark):
    """One key holds a third of the rows; the joins on it are split although they share their partitioning."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 90000, 1, 4).select(F.when(F.col("id") < 30000, 0).otherwise(F.col("id") % 900).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        one, two = (spark.range(900).select(F.col("id").alias("k"), F.lit(n).alias(f"d{n}")) for n in (1, 2))
        out = facts.join(one, "k").join(two, "k")
        assert len(out.collect()) == 90000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    from rosterline.sources.registry import TableRegistry

    reg = TableRegistry(spark, {"main": sf_dir})
    df = reg["orders"].filter(filters.optional_equals({"o_orderstatus": "F", "o_orderpriority": ""})).select("o_orderkey")
    plan = plan_of(df)
    assert "EqualTo(o_orderstatus,F)" in plan and "o_totalprice" not in plan
