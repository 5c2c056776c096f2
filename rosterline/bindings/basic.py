"""Sources, projections, predicates and schema conformance (IO and S operators)."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import default_if_blank, join_text
from ..functions.text import decode
from ..operators import filters, joins, keys
from ..sources.files import json_field
from ..sources.registry import find_value
from .base import Tables, query


@query("""
SELECT src, o_orderstatus, count(*) AS n FROM (
  SELECT 'live' AS src, o_orderstatus FROM orders UNION ALL SELECT 'archive', o_orderstatus FROM orders)
GROUP BY src, o_orderstatus""")
def scan_multi_source(t: Tables):
    reg = t.registry.alias(live=t.path, archive=t.path)
    parts = [reg.table("orders", db).select(F.lit(db).alias("src"), "o_orderstatus") for db in ("live", "archive")]
    return parts[0].unionByName(parts[1]).groupBy("src", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""
SELECT * FROM (
  SELECT 'customer' AS table_name, 'c_mktsegment' AS column_name, count(*) AS instances FROM customer WHERE c_mktsegment = 'O'
  UNION ALL SELECT 'customer', 'c_name', count(*) FROM customer WHERE c_name = 'O'
  UNION ALL SELECT 'orders', 'o_orderstatus', count(*) FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'orders', 'o_orderpriority', count(*) FROM orders WHERE o_orderpriority = 'O'
  UNION ALL SELECT 'lineitem', 'l_returnflag', count(*) FROM lineitem WHERE l_returnflag = 'O'
  UNION ALL SELECT 'lineitem', 'l_linestatus', count(*) FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL SELECT 'events', 'event_type', count(*) FROM events WHERE event_type = 'O'
  UNION ALL SELECT 'events', 'props', count(*) FROM events WHERE props = 'O'
  UNION ALL SELECT 'documents', 'text', count(*) FROM documents WHERE text = 'O'
  UNION ALL SELECT 'documents', 'lang', count(*) FROM documents WHERE lang = 'O'
  UNION ALL SELECT 'documents', 'source', count(*) FROM documents WHERE source = 'O')
WHERE instances > 0""")
def find_value_across_tables(t: Tables):
    names = ("customer", "orders", "lineitem", "events", "documents")
    return find_value({n: t.registry[n] for n in names}, "O")


@query("""
SELECT event_id, k FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) WHERE k > 90""")
def json_key_filter(t: Tables):
    return t.events.select("event_id", json_field(F.col("props"), "k", "bigint").alias("k")).filter("k > 90")


@query("""
SELECT p_partkey, p_brand || ' / ' || p_type || ': ' || p_name AS "Brand/Type: Name",
       p_name || ' (' || p_partkey || ')' AS name_code, p_partkey || ' - ' || p_name AS code_name FROM part""")
def course_label(t: Tables):
    code = F.col("p_partkey").cast("string")
    return t.part.select(
        "p_partkey",
        join_text(F.col("p_brand"), " / ", F.col("p_type"), ": ", F.col("p_name")).alias("Brand/Type: Name"),
        join_text(F.col("p_name"), " (", code, ")").alias("name_code"),
        join_text(code, " - ", F.col("p_name")).alias("code_name"),
    )


@query("SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand = 'Brand#11'")
def optional_filter_parts(t: Tables):
    return t.part.filter(filters.optional_equals({"p_brand": "Brand#11", "p_type": "", "p_size": None})).select(
        "p_partkey", "p_brand", "p_type"
    )


@query("""
SELECT p_type AS code_table, p_name AS code_value, count(*) AS n FROM part
WHERE p_type = 'PROMO' AND (p_brand = 'Brand#3' OR CASE WHEN p_size <= 25 THEN '' ELSE p_brand END = '')
GROUP BY p_type, p_name""")
def code_values(t: Tables):
    codes = t.part.select(
        F.col("p_type").alias("code_table"),
        F.col("p_name").alias("code_value"),
        F.when(F.col("p_size") <= 25, "").otherwise(F.col("p_brand")).alias("xval"),
    )
    chosen = codes.filter(filters.optional_equals({"code_table": "PROMO"}) & filters.wildcard_equals("xval", "Brand#3"))
    return chosen.groupBy("code_table", "code_value").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') OR o_orderkey = 7""")
def scope_or_key(t: Tables):
    scope = filters.optional_equals({"o_orderstatus": "O", "o_orderpriority": "1-URGENT"})
    return t.orders.filter(filters.scope_or_key(scope, "o_orderkey", 7)).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )


@query("SELECT o_orderkey, o_custkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'")
def gated_rows(t: Tables):
    allowed = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return filters.gate(t.orders, allowed, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("SELECT p_brand, p_type, p_size FROM part GROUP BY p_brand, p_type, p_size")
def distinct_triples(t: Tables):
    return t.part.select("p_brand", "p_type", "p_size").distinct()


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Finished' END AS status FROM orders""")
def status_decode(t: Tables):
    return t.orders.select(
        "o_orderkey", decode("o_orderstatus", {"O": "Open", "F": "Finished", "P": None}).alias("status")
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Complete'
  WHEN o_orderstatus = 'P' AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') THEN 'Canceled'
  WHEN o_orderpriority = '5-LOW' THEN 'Waived'
  WHEN o_orderdate > TIMESTAMP '1999-01-01' THEN 'Future' WHEN o_orderdate = TIMESTAMP '1999-01-01' THEN 'Today' ELSE 'Past Due' END AS status
FROM orders""")
def order_status_at(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey").distinct().withColumn("_r", F.lit(True))
    joined = t.dated_orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = filters.action_status(
        F.when(F.col("o_orderstatus") == "F", F.col("d")),
        (F.col("o_orderstatus") == "P") & F.col("_r"),
        F.col("o_orderpriority") == "5-LOW",
        F.col("d"),
        dates.day("1999-01-01"),
    )
    return joined.select("o_orderkey", status.alias("status"))


@query("""
SELECT p_partkey, p_brand, p_name FROM part
WHERE NOT regexp_matches(lower(p_brand), '^brand#1[1-4]$') AND lower(p_name) NOT LIKE 'cold%'""")
def name_pattern(t: Tables):
    return t.part.filter(~F.col("p_brand").rlike("(?i)^brand#1[1-4]$") & ~F.ilike("p_name", F.lit("cold%"))).select(
        "p_partkey", "p_brand", "p_name"
    )


@query("SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS c_regionkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def conform_partial_input(t: Tables):
    return filters.conform_schema(
        t.customer,
        required={"c_custkey": "bigint", "c_name": "string"},
        optional={"c_regionkey": "int", "c_nationkey": "string"},
        one_of=[("c_nationkey", "c_regionkey")],
    )


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_name DESC) AS row_key FROM customer")
def keyed_stage(t: Tables):
    return keys.with_row_key(t.customer.select("c_custkey", "c_mktsegment", "c_name"), ["c_mktsegment", F.col("c_name").desc()]).select(
        "c_custkey", "row_key"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
  NOT (c.c_custkey IS NULL OR (l_returnflag <> 'N' AND s.s_suppkey IS NULL)) AS ok,
  concat_ws('; ', CASE WHEN c.c_custkey IS NULL THEN 'l_partkey ''' || l_partkey || ''' not found' END,
    CASE WHEN l_returnflag <> 'N' AND s.s_suppkey IS NULL THEN 'reporter ''' || l_suppkey || ''' not found' END) AS errors
FROM lineitem LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = l_partkey
LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = l_suppkey""")
def validated_orders(t: Tables):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("reporter"),
    )
    checked = filters.validate_refs(
        lines,
        [
            filters.Reference("l_partkey", t.customer.filter("c_acctbal > 0"), "c_custkey"),
            filters.Reference("reporter", t.supplier.filter("s_acctbal > 0"), "s_suppkey", required=False),
        ],
    )
    return checked.withColumn("errors", F.concat_ws("; ", "errors")).drop("reporter")


@query("""
SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN 'P' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS person_id
FROM orders LEFT JOIN customer ON c_custkey = o_orderkey""")
def normalize_keys(t: Tables):
    digits = F.col("o_orderkey").cast("string")
    loose = F.concat(F.lit(" "), F.substring(digits, 1, 2), F.lit("-"), F.substring(digits, 3, 20), F.lit(" "))
    people = t.customer.select(F.concat(F.lit("P"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("id"))
    typed = t.orders.select("o_orderkey", loose.alias("typed"))
    return keys.fix_person_id(typed, "typed", people, "id", "person_id").drop("typed")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '5-LOW' ELSE o_orderpriority END AS priority FROM orders""")
def defaults_applied(t: Tables):
    holes = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return filters.with_defaults(holes, {"priority": "5-LOW"})


@query("""
SELECT event_id, event_type FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-21'""")
def guarded_run(t: Tables):
    as_of = date(2024, 1, 23)
    first, last = as_of - timedelta(days=8), as_of - timedelta(days=2)
    week = t.events.filter((F.col("ts") >= dates.moment(f"{first} 00:00:00")) & (F.col("ts") < dates.moment(f"{last + timedelta(days=1)} 00:00:00")))
    return filters.guarded(week, dates.is_weekday(as_of, 2)).select("event_id", "event_type")


@query("""
SELECT o_orderkey,
  date_diff('day', DATE '1999-01-01', CAST(o_orderdate AS DATE)) AS days_from,
  CAST(trunc(date_diff('day', DATE '1999-01-01', CAST(o_orderdate AS DATE)) / 7.0) AS INTEGER) + 1 AS week_no,
  strftime(o_orderdate, '%A, %B %-d, %Y') AS long_date, strftime(o_orderdate, '%a %m/%d') AS short_date,
  CASE WHEN o_totalprice < 0 THEN '-' ELSE '' END || '$' || format('{:,.2f}', abs(o_totalprice)) AS amount
FROM orders""")
def scalar_formats(t: Tables):
    from ..functions.money import format_amount

    start = dates.day("1999-01-01")
    return t.dated_orders.select(
        "o_orderkey",
        dates.days_between(start, F.col("d")).cast("bigint").alias("days_from"),
        ((F.date_diff(F.col("d"), start) / 7).cast("int") + 1).alias("week_no"),
        dates.format_date("d", "D").alias("long_date"),
        dates.format_date("d", "ddd MM/dd").alias("short_date"),
        format_amount("o_totalprice").alias("amount"),
    )


@query("""
SELECT event_id, date_diff('minute', TIMESTAMP '2024-01-01 00:00:30', ts) AS minutes,
  date_diff('hour', TIMESTAMP '2024-01-01 00:00:30', ts) AS hours FROM events""")
def boundary_differences(t: Tables):
    start = dates.moment("2024-01-01 00:00:30")
    return t.events.select(
        "event_id", dates.minutes_between(start, "ts").alias("minutes"), dates.hours_between(start, "ts").alias("hours")
    )


@query("""
SELECT lower(rtrim(k)) AS k, count(*) AS n, max(len) AS longest FROM (
  SELECT CASE WHEN o_orderstatus = 'F' THEN upper(o_orderpriority) || '  ' ELSE lower(o_orderpriority) END AS k,
         length(rtrim(CASE WHEN o_orderstatus = 'F' THEN upper(o_orderpriority) || '  ' ELSE lower(o_orderpriority) END)) AS len
  FROM orders) GROUP BY 1""")
def case_blind_groups(t: Tables):
    from ..functions.text import case_blind, text_key, text_length

    mixed = F.when(F.col("o_orderstatus") == "F", F.concat(F.upper("o_orderpriority"), F.lit("  "))).otherwise(
        F.lower("o_orderpriority")
    )
    grouped = t.orders.select(case_blind(mixed).alias("k")).groupBy("k").agg(
        F.count("*").alias("n"), F.max(text_length("k")).cast("bigint").alias("longest")
    )
    return grouped.select(text_key("k").cast("string").alias("k"), "n", "longest")
