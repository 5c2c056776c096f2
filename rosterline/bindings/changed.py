"""Writers over the star schema: each query returns the new state or the change log."""

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import batch, changes, joins
from .base import AS_OF, Tables, query
from .joined import order_terms

NOW = datetime(2001, 8, 1, 9, 30)


def _with_finished(t: Tables):
    return joins.semi(t.customer, t.orders.filter("o_orderstatus = 'F' AND o_totalprice > 250000"), {"c_custkey": "o_custkey"})


FINISHED_SQL = "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000)"


@query(f"SELECT c_custkey, c_name, 'INSERT' AS action FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM ({FINISHED_SQL}))")
def insert_missing(t: Tables):
    return changes.insert_missing(_with_finished(t), t.customer, ["c_custkey"]).changes.select("c_custkey", "c_name", "action")


@query("""
SELECT 'unique' AS mode, o_orderkey FROM orders a WHERE o_orderpriority = '1-URGENT' AND NOT EXISTS
  (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderdate = a.o_orderdate AND b.o_orderstatus = 'F')
UNION ALL SELECT 'duplicates', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def insert_unless_exists(t: Tables):
    target, source = t.orders.filter("o_orderstatus = 'F'"), t.orders.filter("o_orderpriority = '1-URGENT'")
    out = None
    for mode, allow in (("unique", False), ("duplicates", True)):
        added = changes.insert_unless_exists(target, source, ["o_custkey", "o_orderdate"], allow).changes
        part = added.select(F.lit(mode).alias("mode"), "o_orderkey")
        out = part if out is None else out.unionByName(part)
    return out


@query("""
WITH target AS (SELECT o_custkey AS k, max(o_totalprice) AS setting FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
 source AS (SELECT o_custkey AS k, min(o_totalprice) AS setting FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT coalesce(t.k, s.k) AS k, coalesce(s.setting, t.setting) AS setting,
  CASE WHEN t.k IS NULL THEN DATE '2001-08-01' ELSE DATE '1995-01-01' END AS created,
  CASE WHEN s.k IS NOT NULL THEN DATE '2001-08-01' ELSE DATE '1995-01-01' END AS revised
FROM target t FULL JOIN source s ON s.k = t.k""", texts=["created", "revised"])
def upsert_settings(t: Tables):
    old = dates.day("1995-01-01")
    target = t.orders.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(
        F.max("o_totalprice").alias("setting")
    ).withColumns({"created": old, "revised": old})
    source = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_totalprice").alias("setting"))
    now = dates.day(AS_OF)
    return changes.upsert(
        target, source, ["k"], {"setting": F.col("s.setting"), "revised": now}, {"created": now, "revised": now}
    ).new_state


SYNC_SQL = """
SELECT 'INSERT' AS action, o_custkey, o_orderpriority FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O') d
WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_custkey = d.o_custkey AND t.o_orderpriority = d.o_orderpriority)
UNION ALL
SELECT 'DELETE', o_custkey, o_orderpriority FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F') t
WHERE o_orderpriority <> '5-LOW' AND NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderstatus = 'O' AND d.o_custkey = t.o_custkey AND d.o_orderpriority = t.o_orderpriority)"""


def _sync(t: Tables):
    key = ["o_custkey", "o_orderpriority"]
    current = t.orders.filter("o_orderstatus = 'F'").select(*key).distinct()
    desired = t.orders.filter("o_orderstatus = 'O'").select(*key).distinct()
    managed = t.orders.filter("o_orderpriority <> '5-LOW'").select("o_orderpriority").distinct()
    return changes.sync_to(current, desired, key, managed, ["o_orderpriority"])


@query(SYNC_SQL)
def sync_changes(t: Tables):
    return _sync(t).changes


@query(f"SELECT action, count(*) AS n FROM ({SYNC_SQL}) GROUP BY action")
def change_preview(t: Tables):
    return changes.preview(_sync(t).changes)


@query("""
SELECT c_custkey, CAST((SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_name) AS BIGINT) AS o_orderkey, 'INSERT' AS action FROM customer""")
def insert_returning_ids(t: Tables):
    rows = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    _, numbered = changes.insert_returning(t.orders, rows, "o_orderkey", ["c_name"])
    return numbered.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.lit("INSERT").alias("action"))


@query("""
SELECT o_orderkey, coalesce(CAST(n AS INTEGER), -1) AS lines FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) <> 4) ON l_orderkey = o_orderkey""")
def update_from_join(t: Tables):
    target = t.orders.select("o_orderkey").withColumn("lines", F.lit(-1))
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return changes.update_from(target, counts, {"o_orderkey": "l_orderkey"}, {"lines": "n"}, F.col("s.n") != 4).new_state


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def conditional_update(t: Tables):
    return changes.update_where(
        t.orders, F.col("o_orderstatus") == "P", {"o_orderpriority": F.lit("5-LOW")}
    ).new_state.select("o_orderkey", "o_orderpriority")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_name = 'NATION_7')""")
def delete_from_join(t: Tables):
    doomed = joins.semi(t.customer, t.nation.filter("n_name = 'NATION_7'"), {"c_nationkey": "n_nationkey"})
    return changes.delete_matching(t.orders, doomed, {"o_custkey": "c_custkey"}).new_state.select("o_orderkey", "o_custkey")


VERSIONS_SQL = """
v AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS start_date,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + 2 END AS end_date,
  CASE WHEN o_orderstatus = 'O' THEN 'A' ELSE 'I' END AS status FROM orders),
g AS (SELECT DISTINCT o_custkey, start_date FROM v a WHERE status = 'A' AND end_date IS NULL AND EXISTS (
  SELECT 1 FROM v b WHERE b.o_custkey = a.o_custkey AND b.status = 'I' AND b.end_date = a.start_date - 1)),
r AS (SELECT * FROM v WHERE NOT (end_date IS NULL AND EXISTS (SELECT 1 FROM g WHERE g.o_custkey = v.o_custkey AND g.start_date = v.start_date))),
p AS (SELECT * FROM r WHERE NOT (status = 'I' AND o_orderkey NOT IN (SELECT min(o_orderkey) FROM r GROUP BY o_custkey, end_date)))"""


@query(f"""
WITH {VERSIONS_SQL}
SELECT o_orderkey, o_custkey, start_date, CASE WHEN hit THEN NULL ELSE end_date END AS end_date, CASE WHEN hit THEN 'A' ELSE status END AS status
FROM (SELECT p.*, EXISTS (SELECT 1 FROM g WHERE g.o_custkey = p.o_custkey AND p.end_date = g.start_date - 1) AS hit FROM p)""", texts=["start_date", "end_date"])
def repair_versions(t: Tables):
    is_open = F.col("o_orderstatus") == "O"
    versions = t.dated_orders.select(
        "o_orderkey", "o_custkey", F.col("d").alias("start_date"), F.when(~is_open, F.date_add("d", 2)).alias("end_date"),
        F.when(is_open, "A").otherwise("I").alias("status"),
    )
    return batch.repair_versions(
        versions, "o_orderkey", ["o_custkey"], ["o_custkey"], "start_date", "end_date", "status", F.lit(True)
    ).new_state


DECISION_SQL = """
SELECT c_custkey, CASE WHEN coalesce(bool_or(o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-06-01'), false) THEN 'reopen'
  WHEN coalesce(bool_or(o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'), false) THEN 'ignore' ELSE 'insert' END AS decision
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"""


def _decisions(t: Tables):
    return batch.classify_requests(
        t.customer.select("c_custkey"), t.dated_orders, {"c_custkey": "o_custkey"},
        (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"),
        (F.col("o_orderstatus") == "F") & (F.col("d") >= dates.day("2001-06-01")),
    )


@query(DECISION_SQL)
def three_way_upsert(t: Tables):
    return _decisions(t)


@query(f"""
WITH d AS ({DECISION_SQL})
SELECT d.c_custkey, 'INSERT' AS action, CAST(NULL AS VARCHAR) AS before_status, 'N' AS after_status, 'Added' AS after_comment FROM d WHERE decision = 'insert'
UNION ALL SELECT d.c_custkey, 'REOPEN', o_orderstatus, 'N', o_orderpriority || chr(13) || chr(10) || 'Added'
FROM d JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-06-01' WHERE decision = 'reopen'""")
def stop_insert_audit(t: Tables):
    from ..functions.text import append_line

    decided = _decisions(t)
    inserted = decided.filter("decision = 'insert'").select(
        "c_custkey", F.lit("INSERT").alias("action"), F.lit(None).cast("string").alias("before_status"),
        F.lit("N").alias("after_status"), F.lit("Added").alias("after_comment"),
    )
    held = t.dated_orders.filter((F.col("o_orderstatus") == "F") & (F.col("d") >= dates.day("2001-06-01")))
    reopened = decided.filter("decision = 'reopen'").join(held, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", F.lit("REOPEN").alias("action"), F.col("o_orderstatus").alias("before_status"),
        F.lit("N").alias("after_status"), append_line("o_orderpriority", F.lit("Added")).alias("after_comment"),
    )
    return inserted.unionByName(reopened)


@query("""
SELECT l_orderkey, CASE WHEN bool_or(l_returnflag <> 'R') THEN 'mixed' ELSE 'purge' END AS verdict, bool_or(l_quantity > 45) AS has_large
FROM lineitem GROUP BY l_orderkey HAVING bool_or(l_returnflag = 'R')""")
def guarded_purge(t: Tables):
    verdicts = batch.batch_verdicts(
        t.lineitem, "l_orderkey", F.col("l_returnflag") == "R",
        {"has_other": F.col("l_returnflag") != "R", "has_large": F.col("l_quantity") > 45},
    )
    return verdicts.select("l_orderkey", F.when(F.col("has_other"), "mixed").otherwise("purge").alias("verdict"), "has_large")


@query("""
WITH c AS (SELECT o_custkey, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey),
 e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, CASE WHEN event_type = 'error' THEN k END AS order_key, k FROM events JOIN c ON o_custkey = user_id),
 w AS (SELECT user_id, day, k, max(event_id) AS event_id FROM e WHERE order_key IS NULL GROUP BY ALL)
SELECT event_id, k AS order_key FROM w WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = w.user_id AND e.day = w.day AND e.order_key = w.k)""")
def bounded_backfill(t: Tables):
    partial = t.dated_orders.filter("o_orderstatus = 'P'")
    order = [F.col("d"), F.col("o_orderkey")]
    events = t.events.select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "event_type")
    first = joins.first_match(events, partial, {"user_id": "o_custkey"}, order, {"k": "o_orderkey"}, "left")
    target = first.select("event_id", "user_id", "day", F.when(F.col("event_type") == "error", F.col("k")).alias("order_key"))
    return batch.backfill_key(
        target, "order_key", "event_id", partial, {"user_id": "o_custkey"}, "o_orderkey", order, ["user_id", "day"]
    ).changes.select("event_id", "order_key")


CASCADE_SQL = """
n AS (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7'),
c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c))"""


def _family(t: Tables):
    nations = t.nation.filter("n_name = 'NATION_7'").select(F.col("n_nationkey").alias("key"))
    customers = joins.semi(t.customer, nations, {"c_nationkey": "key"}).select(F.col("c_custkey").alias("key"))
    orders = joins.semi(t.orders, customers, {"o_custkey": "key"}).select(F.col("o_orderkey").alias("key"))
    tables = {"customer": t.customer, "supplier": t.supplier, "orders": t.orders, "lineitem": t.lineitem}
    members = [
        changes.Member("customer", "c_nationkey", "nation"), changes.Member("supplier", "s_nationkey", "nation"),
        changes.Member("orders", "o_custkey", "customer"), changes.Member("lineitem", "l_orderkey", "order"),
    ]
    return tables, members, {"nation": nations, "customer": customers, "order": orders}


def _counts(frames):
    out = None
    for name, df in frames.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""
WITH {CASCADE_SQL}
SELECT 'customer' AS table_name, count(*) AS n FROM customer WHERE c_nationkey NOT IN (SELECT * FROM n)
UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_nationkey NOT IN (SELECT * FROM n)
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT * FROM c)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT * FROM o)""")
def cascade_delete(t: Tables):
    tables, members, doomed = _family(t)
    return _counts({n: c.new_state for n, c in changes.cascade_delete(tables, members, doomed).items()})


@query(f"""
WITH {CASCADE_SQL}
SELECT 'customer' AS table_name, count(*) AS n FROM customer WHERE c_nationkey IN (SELECT * FROM n)
UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_nationkey IN (SELECT * FROM n) AND s_acctbal >= 0
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey IN (SELECT * FROM c)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey IN (SELECT * FROM o)""")
def cascade_copy(t: Tables):
    tables, members, wanted = _family(t)
    empty = {n: df.limit(0) for n, df in tables.items()}
    copied = changes.cascade_copy(tables, empty, members, wanted, {"supplier": F.col("s_acctbal") < 0})
    return _counts({n: c.changes for n, c in copied.items()})


@query("""
SELECT o_custkey, count(*) AS meetings, max(d) AS last_day FROM (
  SELECT o_custkey, CASE WHEN o_orderdate = TIMESTAMP '1998-02-20' AND o_totalprice > 1000 THEN DATE '1998-02-21' ELSE CAST(o_orderdate AS DATE) END AS d
  FROM orders WHERE o_orderdate <> TIMESTAMP '1998-04-25') GROUP BY o_custkey""", texts=["last_day"])
def shift_and_recount(t: Tables):
    kept = changes.delete_where(t.dated_orders, F.col("d") == dates.day("1998-04-25")).new_state
    moved = changes.update_where(
        kept, (F.col("d") == dates.day("1998-02-20")) & (F.col("o_totalprice") > 1000), {"d": dates.day("1998-02-21")}
    ).new_state
    return moved.groupBy("o_custkey").agg(F.count("*").alias("meetings"), F.max("d").alias("last_day"))


@query("""
SELECT c_custkey, y, q FROM customer CROSS JOIN (SELECT DISTINCT year(o_orderdate) AS y, quarter(o_orderdate) AS q FROM orders)
WHERE (y, q) > (1995, 1) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = y AND quarter(o_orderdate) = q)
  AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = y - 1)""")
def generate_absences(t: Tables):
    """Quarters of the year after an order in which the customer has none."""
    kept = t.dated_orders.select("o_custkey", F.year("d").alias("y"), F.quarter("d").alias("q")).distinct()
    calendar = order_terms(t).groupBy("y").agg(F.collect_set("q").alias("qs"))
    due = t.dated_orders.select(F.col("o_custkey").alias("c_custkey"), (F.year("d") + 1).alias("y")).distinct()
    expected = joins.few_valued(due, calendar, ["y"], {"qs": "qs"}).select("c_custkey", "y", F.explode("qs").alias("q"))
    expected = expected.join(t.customer.select("c_custkey"), "c_custkey", "left_semi")
    return joins.anti(expected, kept, {"c_custkey": "o_custkey", "y": "y", "q": "q"}).select(
        "c_custkey", F.col("y").cast("bigint").alias("y"), F.col("q").cast("bigint").alias("q")
    )


@query("""
SELECT a.user_name, CASE WHEN m.c_name IS NOT NULL THEN m.c_name ELSE a.user_name END AS aligned, 'kept' AS state
FROM (SELECT upper(c_name) AS user_name FROM customer UNION ALL SELECT upper(s_name) FROM supplier) a JOIN customer m ON lower(m.c_name) = lower(a.user_name)""")
def align_master(t: Tables):
    from ..functions.text import text_key

    users = t.customer.select(F.upper("c_name").alias("user_name")).unionByName(t.supplier.select(F.upper("s_name").alias("user_name")))
    keyed = users.withColumns({"k": text_key("user_name"), "aligned": F.col("user_name")})
    master = t.customer.select(text_key("c_name").alias("k"), "c_name")
    updated = changes.update_from(keyed, master, ["k"], {"aligned": "c_name"}).new_state
    return joins.semi(updated, master, ["k"]).select("user_name", "aligned", F.lit("kept").alias("state"))


@query("""
SELECT DISTINCT r_name AS role, o_custkey AS member_key, o_orderpriority AS record_type FROM region JOIN nation ON n_regionkey = r_regionkey
JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def role_map(t: Tables):
    return (
        t.orders.select("o_custkey", F.col("o_orderpriority").alias("record_type"))
        .distinct()
        .join(t.customer.filter("c_mktsegment = 'BUILDING'"), F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select(F.col("r_name").alias("role"), F.col("o_custkey").alias("member_key"), "record_type")
    )


@query(f"""
SELECT c_name, CAST((SELECT max(c_custkey) FROM ({FINISHED_SQL})) + row_number() OVER (ORDER BY c_name) AS BIGINT) AS user_id
FROM customer WHERE c_name NOT IN (SELECT c_name FROM ({FINISHED_SQL}))""")
def create_missing_users(t: Tables):
    users = _with_finished(t)
    wanted = joins.anti(t.customer, users, ["c_name"]).select("c_name").distinct()
    _, numbered = changes.insert_returning(users, wanted, "c_custkey", ["c_name"])
    return numbered.select("c_name", F.col("c_custkey").alias("user_id"))


@query("""
WITH b AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey), a AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW' GROUP BY o_custkey)
SELECT coalesce(b.o_custkey, a.o_custkey) AS o_custkey, CASE WHEN b.n IS NULL THEN 'INSERT' WHEN a.n IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
  '{"n":' || b.n || '}' AS before_image, '{"n":' || a.n || '}' AS after_image, 'recount' AS process FROM b FULL JOIN a ON a.o_custkey = b.o_custkey WHERE a.n IS DISTINCT FROM b.n""")
def audit_images(t: Tables):
    def counted(test: str):
        return t.orders.filter(test).groupBy("o_custkey").agg(F.count("*").alias("n"))

    log = changes.audit_log(
        counted("o_orderstatus = 'F'"), counted("o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW'"), ["o_custkey"], ["n"], "recount", NOW, "ME"
    )
    return log.select("o_custkey", "action", "before_image", "after_image", "process")
