"""Aggregation, ranking and set operators over the star schema."""

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import aggregates, ranking, rendering, sets
from ..plans.groups import group_sync
from .base import Tables, cents, query


@query("""SELECT o_orderpriority, count(DISTINCT l_suppkey) AS suppliers FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def distinct_per_key(t: Tables):
    joined = t.orders.select("o_orderkey", "o_orderpriority").join(
        t.lineitem.select("l_orderkey", "l_suppkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.groupBy("o_orderpriority").agg(F.count_distinct("l_suppkey").alias("suppliers"))


@query("""SELECT l_partkey, CAST(sum(CASE WHEN l_returnflag IN ('A', 'N') THEN 1 ELSE 0 END) AS BIGINT) AS taken,
  CAST(sum(CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END) AS BIGINT) AS needed FROM lineitem GROUP BY l_partkey""")
def conditional_sums(t: Tables):
    flag = F.col("l_returnflag")
    return t.lineitem.groupBy("l_partkey").agg(
        aggregates.sum_when(flag.isin("A", "N")).alias("taken"), aggregates.sum_when(flag == "R").alias("needed")
    )


@query("""SELECT c_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM customer
LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY c_custkey""")
def decimal_sum(t: Tables):
    sums = t.orders.filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("total"))
    return t.customer.join(sums, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", F.col("total").cast("double").alias("total")
    )


@query("""SELECT l_returnflag, n FROM (SELECT l_returnflag, l_linestatus, l_suppkey, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus, l_suppkey)""")
def hidden_group_key(t: Tables):
    return aggregates.group_hidden(t.lineitem, ["l_returnflag"], ["l_linestatus", "l_suppkey"], n=F.count("*"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def having_duplicates(t: Tables):
    return aggregates.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def global_totals(t: Tables):
    joined = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.agg(
        F.count("*").alias("n"),
        F.sum(cents("o_totalprice")).cast("double").alias("price"),
        F.sum(cents("l_quantity")).cast("double").alias("quantity"),
    )


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)")
def dedupe_keep_min(t: Tables):
    return aggregates.dedupe_keep_min(t.documents, ["text"], "doc_id").select("doc_id", "lang", "source", "n_chars")


@query("""
WITH copy AS (SELECT o_orderkey, o_custkey, o_totalprice + CASE WHEN o_orderdate = TIMESTAMP '1998-03-03' THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P')
SELECT count(*) AS total_rows, CAST(sum(CASE WHEN c.o_custkey = o.o_custkey AND c.o_totalprice = o.o_totalprice THEN 1 ELSE 0 END) AS BIGINT) AS matched_rows
FROM orders o LEFT JOIN copy c ON c.o_orderkey = o.o_orderkey""")
def reconcile_rows(t: Tables):
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    changed = F.col("o_orderdate") == dates.moment("1998-03-03 00:00:00")
    copy = t.orders.filter("o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P'").withColumn(
        "o_totalprice", F.col("o_totalprice") + F.when(changed, 1).otherwise(0)
    )
    return aggregates.reconcile(t.orders, copy, "o_orderkey", columns)


HTML_SQL = """
SELECT c_custkey, '<table class="merged"><thead><tr><th>Order</th><th>Date</th><th>Status &amp; priority</th></tr></thead><tbody>' ||
  coalesce((SELECT string_agg('<tr><td>' || o_orderkey || '</td>' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE '<td>' || strftime(o_orderdate, '%Y-%m-%d') || '</td>' END
    || '<td>' || o_orderstatus || ' &lt; ' || o_orderpriority || '</td></tr>', '' ORDER BY o_orderdate, o_orderkey) FROM orders WHERE o_custkey = c_custkey AND o_orderpriority <> '5-LOW'),
    '<td>Nothing found.</td><td></td><td></td>') || '</tbody></table>' AS html FROM customer"""


@query(HTML_SQL)
def html_rows_per_key(t: Tables):
    rows = t.dated_orders.filter("o_orderpriority <> '5-LOW'").withColumnRenamed("o_custkey", "c_custkey")
    shown = F.when(F.col("o_orderstatus") != "P", F.date_format("d", "yyyy-MM-dd"))
    return rendering.html_tables(
        t.customer.select("c_custkey"), rows, ["c_custkey"], ["d", "o_orderkey"],
        [F.col("o_orderkey"), shown, F.concat("o_orderstatus", F.lit(" < "), "o_orderpriority")],
        ["Order", "Date", "Status & priority"], "merged", "html", "<td>Nothing found.</td><td></td><td></td>",
    )


@query("""
WITH r AS (SELECT o_orderpriority, '<tr><td>' || o_orderkey || '</td><td>' || o_orderstatus || '</td></tr>' AS tr,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS n, count(*) OVER (PARTITION BY o_orderpriority) AS rows FROM orders),
 c AS (SELECT o_orderpriority, n // 200 + 1 AS chunk, string_agg(tr, '' ORDER BY n) AS html FROM r GROUP BY ALL
  UNION ALL SELECT DISTINCT o_orderpriority, 0, '<table class="merged"><thead><tr><th>Order</th><th>Status</th></tr></thead><tbody>' FROM r
  UNION ALL SELECT DISTINCT o_orderpriority, (rows + 199) // 200 + 1, '</tbody></table>' FROM r)
SELECT o_orderpriority, CAST(chunk AS BIGINT) AS chunk, html FROM c""")
def html_chunks_per_key(t: Tables):
    """Five keys with all orders among them, in texts of 200 rows."""
    return rendering.render_chunks(
        t.dated_orders, ["o_orderpriority"], ["d", "o_orderkey"], [F.col("o_orderkey"), F.col("o_orderstatus")], ["Order", "Status"], "merged", 200
    )


@query("""
SELECT 'orders' AS table_name, max(o_orderkey) AS max_key, max(o_orderkey) + 1 AS next_key FROM orders
UNION ALL SELECT 'customer', max(c_custkey), max(c_custkey) + 1 FROM customer
UNION ALL SELECT 'part', max(p_partkey), max(p_partkey) + 1 FROM part
UNION ALL SELECT 'events', max(event_id), max(event_id) + 1 FROM events""")
def key_high_water(t: Tables):
    return aggregates.high_water(
        {"orders": (t.orders, "o_orderkey"), "customer": (t.customer, "c_custkey"), "part": (t.part, "p_partkey"), "events": (t.events, "event_id")}
    )


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rk FROM events) WHERE rk = 1""")
def latest_per_key(t: Tables):
    return ranking.latest_row_per_key(t.events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select(
        "event_id", "user_id", "event_type"
    )


PRIORITY_SQL = """SELECT *, rank() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END DESC,
 date_trunc('month', o_orderdate)) AS rk FROM orders"""


def _priority_order():
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 0).otherwise(1)
    return [urgent, F.date_trunc("month", "o_orderdate")]


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus FROM ({PRIORITY_SQL}) WHERE rk = 1")
def priority_rank(t: Tables):
    return ranking.first_per_key(t.orders, ["o_custkey", "o_orderstatus"], _priority_order()).select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus FROM ({PRIORITY_SQL}) WHERE rk > 1")
def priority_rank_beaten(t: Tables):
    return ranking.beaten_per_key(t.orders, ["o_custkey", "o_orderstatus"], _priority_order()).select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


@query("""
SELECT c_custkey, b.o_orderkey AS best_key FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey,
  rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey) AS rk FROM orders WHERE o_orderstatus = 'F') b
ON b.o_custkey = c_custkey AND rk = 1""")
def best_alternate(t: Tables):
    done = t.orders.filter("o_orderstatus = 'F'")
    best = ranking.last_per_key(done, ["o_custkey"], [F.col("o_orderdate"), F.col("o_totalprice"), -F.col("o_orderkey")])
    return t.customer.join(best, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", F.col("o_orderkey").alias("best_key")
    )


@query("""SELECT c_mktsegment, c_nationkey, count(DISTINCT o_orderpriority) AS priorities, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey
GROUP BY c_mktsegment, c_nationkey ORDER BY n DESC, c_mktsegment, c_nationkey""")
def ordered_report(t: Tables):
    joined = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"))
    report = joined.groupBy("c_mktsegment", "c_nationkey").agg(
        F.count_distinct("o_orderpriority").alias("priorities"), F.count("*").alias("n")
    )
    return report.orderBy(F.col("n").desc(), "c_mktsegment", "c_nationkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(t: Tables):
    return ranking.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query("""
WITH s AS (SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 5)
SELECT s.o_orderkey, s.o_totalprice AS here, c.o_totalprice AS there FROM s JOIN orders c ON c.o_orderkey = s.o_orderkey""")
def seeded_sample_compare(t: Tables):
    sample = ranking.seeded_sample(t.orders.select("o_orderkey", F.col("o_totalprice").alias("here")), ["o_orderkey"], 5, 7)
    return sample.join(t.orders.select("o_orderkey", F.col("o_totalprice").alias("there")), "o_orderkey")


@query("""
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 0 UNION ALL
SELECT 'supplier', s_suppkey, s_name FROM supplier WHERE s_acctbal > 0""")
def union_branches(t: Tables):
    a = t.customer.filter("c_acctbal > 0").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = t.supplier.filter("s_acctbal > 0").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return sets.union_branches([a, b])


@query("""
SELECT o_custkey AS user_key, 'role ' || o_orderpriority AS role_name FROM orders
UNION SELECT o_custkey, 'returns' FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
UNION SELECT c_custkey, 'segment ' || c_mktsegment FROM customer""")
def desired_state(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey").distinct()
    return sets.union_branches(
        [
            t.orders.select(F.col("o_custkey").alias("user_key"), F.concat(F.lit("role "), "o_orderpriority").alias("role_name")),
            t.orders.join(returned, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(
                F.col("o_custkey").alias("user_key"), F.lit("returns").alias("role_name")
            ),
            t.customer.select(F.col("c_custkey").alias("user_key"), F.concat(F.lit("segment "), "c_mktsegment").alias("role_name")),
        ],
        distinct=True,
    )


@query("""
SELECT coalesce(a.k, b.k) AS l_partkey, CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS side
FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity < 5) a
FULL JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 5) b ON a.k = b.k""")
def set_compare(t: Tables):
    small = t.lineitem.filter("l_quantity < 5")
    return sets.compare_sets(small.filter("l_returnflag = 'R'"), small.filter("l_returnflag = 'A'"), ["l_partkey"])


MEMBERS_SQL = """
SELECT 'R' || n_regionkey AS parent, 'N' || n_nationkey AS member FROM nation
UNION SELECT 'N' || c_nationkey, 'N' || c_nationkey || ' ' || c_mktsegment FROM customer
UNION SELECT 'N' || c_nationkey || ' ' || c_mktsegment, 'C' || c_custkey FROM customer
UNION SELECT 'N' || s_nationkey, 'S' || s_suppkey FROM supplier
UNION SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation"""


def membership_edges(t: Tables):
    """Regions hold nations, nations hold segment groups and suppliers, groups hold customers; nations also hold their region (a cycle)."""

    def tag(letter, c):
        return F.concat(F.lit(letter), F.col(c).cast("string"))

    segment = F.concat(tag("N", "c_nationkey"), F.lit(" "), F.col("c_mktsegment"))
    return sets.union_branches(
        [
            t.nation.select(tag("R", "n_regionkey").alias("parent"), tag("N", "n_nationkey").alias("member")),
            t.nation.select(tag("N", "n_nationkey").alias("parent"), tag("R", "n_regionkey").alias("member")),
            t.customer.select(tag("N", "c_nationkey").alias("parent"), segment.alias("member")),
            t.customer.select(segment.alias("parent"), tag("C", "c_custkey").alias("member")),
            t.supplier.select(tag("N", "s_nationkey").alias("parent"), tag("S", "s_suppkey").alias("member")),
        ]
    )


@query(f"""
WITH RECURSIVE edges AS ({MEMBERS_SQL}), reach(root, member) AS (
  SELECT DISTINCT parent, parent FROM edges WHERE parent LIKE 'R%' UNION SELECT r.root, e.member FROM reach r JOIN edges e ON e.parent = r.member)
SELECT root, member FROM reach WHERE member <> root AND member NOT IN (SELECT parent FROM edges)""")
def transitive_closure(t: Tables):
    roots = t.region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("root"))
    return sets.flatten_membership(membership_edges(t), roots)


@query(f"""
WITH RECURSIVE edges AS ({MEMBERS_SQL}), reach(member) AS (SELECT DISTINCT parent FROM edges WHERE parent LIKE 'R%' UNION SELECT e.member FROM reach r JOIN edges e ON e.parent = r.member),
 wanted AS (SELECT member FROM reach WHERE member NOT IN (SELECT parent FROM edges)),
 present AS (SELECT DISTINCT 'C' || o_custkey AS member FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000 UNION SELECT DISTINCT 'P' || l_partkey FROM lineitem WHERE l_quantity = 50)
SELECT member, 'ADD' AS action FROM wanted WHERE member NOT IN (SELECT member FROM present)
UNION ALL SELECT member, 'REMOVE' FROM present WHERE member NOT IN (SELECT member FROM wanted)""")
def group_sync_actions(t: Tables):
    roots = t.region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("root"))
    members = t.orders.filter("o_orderstatus = 'F' AND o_totalprice > 100000").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("member"))
    others = t.lineitem.filter("l_quantity = 50").select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("member"))
    return group_sync(membership_edges(t), roots, sets.union_branches([members, others], distinct=True))
