"""Operators whose work must not follow one key, one depth or one length."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from rosterline.bindings import joined
from rosterline.bindings.base import Tables
from rosterline.bindings.campus_tables import CampusFrames, campus
from rosterline.models import campus as m
from rosterline.operators import aggregates, changes, joins, rendering, sets
from rosterline.plans import reports


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def jobs_run(spark, build):
    """Number of jobs that building a frame starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"g{random.random()}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        build()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_an_interval_of_any_length_takes_two_buckets(spark):
    day = dt.date(1969, 12, 20)
    spans = [(day + dt.timedelta(days=a), day + dt.timedelta(days=a + n)) for a in range(0, 40, 3) for n in (0, 1, 2, 3, 7, 8, 100, 365, 3653, 40_000)]
    df = spark.createDataFrame(spans, "s date, e date")
    for days in (1, 7):
        sizes = df.select(F.size(joins.interval_buckets(F.col("s"), F.col("e"), days)).alias("n"))
        assert 1 <= sizes.agg(F.min("n")).first()[0] and sizes.agg(F.max("n")).first()[0] <= 2


def spans(spark, seed, n, kind):
    chance = random.Random(seed)
    origin = dt.datetime(1969, 11, 1, 8)
    out = []
    for k in range(n):
        s = origin + dt.timedelta(days=chance.randrange(200), minutes=chance.randrange(600))
        e = s + dt.timedelta(minutes=chance.choice([-5, 0, 30, 600, 60 * 24 * 3, 60 * 24 * 90, 60 * 24 * 4_000]))
        out.append((f"p{chance.randrange(4)}", k if chance.random() < 0.95 else 0, s, e))
    df = spark.createDataFrame(out, "p string, k int, s timestamp_ntz, e timestamp_ntz")
    return df.select("p", "k", F.col("s").cast(kind).alias("s"), F.col("e").cast(kind).alias("e"))


def brute(a, b):
    return sorted((x.p, x.k, y.k, x.s, y.s, x.e, y.e) for x in a for y in b if x.p == y.p and x.k != y.k and x.s <= x.e and y.s <= y.e and x.s <= y.e and y.s <= x.e)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "date"])
@pytest.mark.parametrize("days", [1, 5])
def test_overlaps_of_long_and_short_intervals(spark, kind, days):
    a, b = spans(spark, 1, 60, kind), spans(spark, 2, 40, kind)
    assert rows(joins.overlap_pairs(a, "p", "s", "e", "k", bucket_days=days)) == brute(a.collect(), a.collect())
    assert rows(joins.overlap_pairs(a, "p", "s", "e", "k", second=b, bucket_days=days)) == brute(a.collect(), b.collect())
    assert joins.overlap_pairs(a.limit(0), "p", "s", "e", "k", second=b).count() == 0


@pytest.mark.parametrize("kind", ["timestamp_ntz", "date"])
def test_counts_equal_pairs_of_long_intervals(spark, kind):
    a = spans(spark, 3, 80, kind).withColumn("k", F.monotonically_increasing_id())
    a = a.unionByName(a.limit(7))  # rows that repeat whole are one key
    pairs = joins.overlap_pairs(a, "p", "s", "e", "k").groupBy("p").count()
    assert rows(aggregates.overlap_counts(a, "p", "s", "e", "k")) == rows(pairs)


def test_an_entity_with_all_rows_spreads_over_days(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    df = spark.range(20_000).select(F.concat(F.lit("hot"), F.col("id") % 1).alias("p"), "id", (start + F.make_dt_interval(F.col("id") % 100, F.col("id") % 24)).alias("s"))
    df = df.withColumn("e", F.col("s") + F.make_dt_interval(F.lit(0), F.lit(1)))
    counted = aggregates.overlap_counts(df, "p", "s", "e", "id", unique_key=True)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"windowspecdefinition\((p#\d+), (\w+)#", plan)
    assert {second for _, second in windows} == {"_day"}  # the days of an entity in order, and the moments of (entity, day)
    # Every hour of each of the 100 days holds what starts in it; touching ends count.
    assert counted.collect()[0]["conflicts"] == rows(joins.overlap_pairs(df, "p", "s", "e", "id").groupBy("p").count())[0][1]


def test_prefixes_of_any_length_take_one_join_with_the_codes(spark):
    codes = spark.createDataFrame([("1", 6, 1), ("12", 6, 2), ("123456789012", 14, 3), ("1234", 6, 4), ("9", 1, 5)], "p string, n int, c int")
    numbers = spark.createDataFrame([("123499",), ("123499",), ("129999 ",), ("111111",), ("12345678901234",), ("9",), ("x",), ("",), (None,)], "`a.b` string")
    build = lambda: joins.prefix_lookup(numbers.toDF("n"), "n", codes, "p", "n", "c", "c")
    assert jobs_run(spark, build) == 0
    found = build()
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("123499", 4), ("123499", 4), ("129999 ", 2), ("111111", 1), ("12345678901234", 3), ("9", 5), ("x", None), ("", None), (None, None)], key=repr)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2  # with the codes, and back to the rows


def test_a_deep_chain_closes_in_a_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(sets, "stage", lambda df, what="t", own=sets.stage: rounds.append(what) or own(df, what))
    n = 1_000
    edges = spark.range(n).selectExpr("concat('g', id) AS parent", "concat('g', id + 1) AS member").unionByName(
        spark.range(n).selectExpr("concat('g', id) AS parent", "concat('leaf', id % 10) AS member")
    )
    roots = spark.createDataFrame([("g0",), ("g990",), ("nobody",)], "root string")
    found = rows(sets.flatten_membership(edges, roots))
    assert found == sorted([(r, f"leaf{i}") for r in ("g0", "g990") for i in range(10)] + [("g0", f"g{n}"), ("g990", f"g{n}")])
    assert rounds.count("reach") - 1 <= 11


def test_closure_of_cycles_equals_plain_search(spark):
    chance = random.Random(5)
    edges = [(f"g{chance.randrange(12)}", f"{chance.choice('ggm')}{chance.randrange(12)}") for _ in range(40)]
    df = spark.createDataFrame(edges, "parent string, member string")
    roots = [f"g{i}" for i in range(12)] + ["none"]
    want = set()
    for root in roots:
        seen, todo = set(), [root]
        while todo:
            at = todo.pop()
            new = {m for p, m in edges if p == at} - seen
            seen |= new
            todo += new
        want |= {(root, m) for m in seen if m != root}
    parents = {p for p, _ in edges}
    asked = spark.createDataFrame([(r,) for r in roots], "root string")
    assert set(rows(sets.flatten_membership(df, asked, leaves_only=False))) == want
    assert set(rows(sets.flatten_membership(df, asked))) == {(r, m) for r, m in want if m not in parents}


def test_few_valued_sides_do_not_move_the_rows(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30), (4, "c", None)], "id int, k string, `x.y` int")
    side = spark.createDataFrame([("a", 1, None), ("b", 2, "two"), (None, 3, "none")], "k string, n int, t string")
    for most in (256, 1):  # the second one joins by key
        inner = joins.few_valued(df, side, ["k"], {"n": "n", "t": "t"}, most=most)
        left = joins.few_valued(df, side, {"k": "k"}, {"n": "n"}, "left", most=most)
        assert inner.columns == ["id", "k", "x.y", "n", "t"] and rows(inner) == [(1, "a", 10, 1, None), (2, "b", 20, 2, "two")]
        assert sorted((r.id, r.n) for r in left.collect()) == [(1, 1), (2, 2), (3, None), (4, None)]
    text = joins.few_valued(df, side, ["k"], {"n": "n"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text
    assert joins.few_valued(df, side.limit(0), ["k"], {"n": "n"}).count() == 0


@pytest.mark.parametrize("few", [True, False])
def test_not_in_per_group_either_way(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(joins, "few_rows", lambda side, most=0: None)
    left = spark.createDataFrame([("g", "x"), ("g", "y"), ("g", None), ("n", "x"), ("n", None), ("other", "x"), ("other", None), (None, "x")], "g string, v string")
    values = spark.createDataFrame([("g", "x"), ("g", "x"), ("g", "z"), ("n", None), ("n", "q"), (None, "x")], "grp string, val string")
    kept = joins.not_in_per_group(left, "v", values, "val", {"g": "grp"})
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([("g", "y"), ("other", "x"), ("other", None), (None, "x")], key=repr)


def test_chunks_put_together_are_the_table(spark):
    df = spark.range(2_345).selectExpr("if(id % 5 = 0, NULL, 'hot') AS k", "id", "concat('<', id, '>') AS t").repartition(7)
    chunks = rendering.render_chunks(df, ["k"], ["id"], [F.col("t")], ["T & U"], "c", rows_per_chunk=100).collect()
    assert max(r.html.count("<tr>") for r in chunks) == 100
    for key in (None, "hot"):
        own = sorted((r.chunk, r.html) for r in chunks if r.k == key)
        assert [c for c, _ in own] == list(range(len(own)))
        ids = [i for i in range(2_345) if (i % 5 == 0) == (key is None)]
        body = "".join(f"<tr><td>&lt;{i}&gt;</td></tr>" for i in ids)
        assert "".join(h for _, h in own) == f'<table class="c"><thead><tr><th>T &amp; U</th></tr></thead><tbody>{body}</tbody></table>'


def test_repeated_natural_keys_are_refused_before_a_write(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None), (5, None)], "id int, name string")
    new = spark.createDataFrame([(11, "a"), (12, "c"), (13, "c")], "id int, name string")
    witness = joins.repeated_natural_keys(old, new, ["name"])
    assert rows(witness) == [("new", '{"name":"c"}', 2), ("old", '{"name":"b"}', 2)]
    change = changes.insert_missing(new, old, ["id"])
    with pytest.raises(changes.RunAborted, match="repeated source key"):
        changes.write_run({"t": changes.ChangeSet(change.new_state, change.changes, change.tagged, witness)}, str(tmp_path / "run"))
    assert not (tmp_path / "run").exists()


def test_a_cut_name_meets_all_names_that_begin_with_it(spark, tmp_path):
    """The note holds the beginning of a name, not the name: parts of other names are met as well."""
    parts = [(1, "large ring", "Brand#7", 3), (2, "large bolt", "Brand#7", 3), (3, "large", "Brand#7", 3), (4, "larg", "Brand#7", 3), (5, "large ring", "Brand#7", 4), (6, None, "Brand#7", 3)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = joined.text_key_match(Tables(spark, str(tmp_path))).collect()
    large = [(a, b) for a in (1, 2, 3) for b in (1, 2, 3)]
    assert sorted((r[0], -1 if r[1] is None else r[1]) for r in found) == sorted([*large, (4, 1), (4, 2), (4, 3), (4, 4), (5, 5), (6, -1)])


def test_names_meet_by_equal_keys_however_many_share_a_code(spark):
    names = ["", "a", "ab", "AB", "abc", "a%", "äb", None]
    left = spark.createDataFrame([(i, f"x/K/{n}") for i, n in enumerate([*names[:-1], "b", "ä", "abcd"])] + [(90, "no"), (91, None)], "id int, note string")
    right = spark.createDataFrame([(i, "K", n) for i, n in enumerate(names)], "cid int, code string, name string")
    tails = left.withColumn("t", F.regexp_extract("note", r"/(K)/(.*)$", 2)).withColumn("c", F.regexp_extract("note", r"/(K)/(.*)$", 1))
    wanted = rows(tails.join(right, (F.col("c") == F.col("code")) & F.startswith("name", "t"), "left").select("id", F.coalesce("cid", F.lit(-1))))
    for many in (False, True):
        got = joins.text_match(left, "note", r"/(K)/(.*)$", right, {}, "code", "name", {"m": "cid"}, many)
        assert rows(got.select("id", F.coalesce("m", F.lit(-1)))) == wanted
        assert "startswith" not in got._jdf.queryExecution().optimizedPlan().toString().lower()


def test_a_join_is_dealt_by_the_pairs_it_makes(spark):
    left = spark.range(1_000).select(F.when(F.col("id") < 900, "hot").when(F.col("id") < 950, F.col("id").cast("string")).alias("k"), "id")
    right = spark.range(400).select(F.when(F.col("id") < 300, "hot").otherwise((F.col("id") + 600).cast("string")).alias("k"), F.col("id").alias("r"))
    plain = rows(left.join(right, "k", "left").select("id", F.coalesce("r", F.lit(-1))))
    a, b, on = joins.dealt_by_pairs(left, right, ["k"], 20_000)
    dealt = a.join(b, on, "left")
    assert rows(dealt.select("id", F.coalesce("r", F.lit(-1)))) == plain
    assert a.rdd.getNumPartitions() == b.rdd.getNumPartitions() >= 900 * 300 // 20_000
    made = a.join(b, on).groupBy(*on).count().agg(F.max("count")).first()[0]
    assert made < 3 * 20_000 < 900 * 300
    empty = joins.dealt_by_pairs(left.limit(0), right, ["k"])
    assert empty[0].join(empty[1], empty[2], "left").count() == 0


def test_lines_are_moved_once_and_digests_as_bytes(spark, sf_dir):
    """Lines are grouped and joined with their orders in one exchange, and rows to compare go as 32 bytes."""
    frames = CampusFrames(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = frames.derive("LINE")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # lines and orders
    a = spark.createDataFrame([(1, "x", 2.0), (2, None, 1.0), (3, "y", 0.5)], "k int, s string, d double")
    b = spark.createDataFrame([(1, "x", 2.0), (2, None, 1.0), (3, "z", 0.5), (4, "x", 2.0)], "k int, s string, d double")
    out = aggregates.reconcile(a, b, "k", ["k", "s", "d"])
    assert [tuple(r) for r in out.collect()] == [(3, 2)]
    assert "unhex(sha2(" in out._jdf.queryExecution().optimizedPlan().toString()


def test_section_joins_sort_by_what_tells_sections_apart(spark, sf_dir):
    t = campus(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = m.section_meetings(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Sort \[EVENT_ID#\d+ ASC", plan)) >= 3 and not re.search(r"Sort \[ACADEMIC_YEAR#\d+ ASC[^,]*, ACADEMIC_TERM#\d+ ASC[^,]*, ACADEMIC_SESSION", plan)


def test_persons_of_other_terms_are_left_out_by_a_filter(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (4, None, "x"), (5, "c", None)], "id int, p string, q string")
    side = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), (None, "x"), ("c", None)], "p string, q string")
    wanted = [(1, "a", "x"), (3, "b", "x")]
    few = joins.among_few(df, side, ["p", "q"])
    assert rows(few) == wanted and "Join" not in few._jdf.queryExecution().optimizedPlan().toString()
    assert joins.among_few(df, side.limit(0), ["p", "q"]).count() == 0
    monkeypatch.setattr(joins, "FEW_ROWS", 1)
    many = joins.among_few(df, side, ["p", "q"])
    assert rows(many) == wanted and "Join" in many._jdf.queryExecution().optimizedPlan().toString()


def test_conflicts_of_a_year_move_that_years_registrations_only(spark, sf_dir, monkeypatch):
    moved = []
    kept = reports._meetings_of
    monkeypatch.setattr(reports, "_meetings_of", lambda who, person, meetings: moved.append(who) or kept(who, person, meetings))
    reports.student_conflicts(campus(spark, sf_dir), "1999")
    assert {r[0] for r in moved[0].select("ACADEMIC_YEAR").distinct().collect()} == {"1999"}


def test_meetings_of_the_current_term_are_limited_on_every_side(spark, sf_dir):
    t = campus(spark, sf_dir)
    chosen, everything = m.section_meetings(t, of_current_term=True), m.section_meetings(t)
    shown = ["PEOPLE_CODE_ID", "SectionId", "CALENDAR_KEY"]
    wanted = rows(everything.filter(F.col("TermId") == m.current_term_id(t)).select(*shown))
    assert rows(chosen.select(*shown)) == wanted != []
    assert rows(m.scheduled_meetings(t, of_current_term=True).select("ACADEMIC_YEAR", "ACADEMIC_TERM").distinct()) == [("1999", "FALL")]
