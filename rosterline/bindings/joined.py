"""Join operators over the star schema."""

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import aggregates, filters, joins
from .base import AS_OF, Tables, cents, query


def order_windows(t: Tables, days: int = 3):
    """Each order as the interval from its day to ``days`` later."""
    return t.dated_orders.select(
        "o_custkey", "o_orderkey", F.col("d").alias("s"), F.date_add("d", days).alias("e")
    )


OVERLAP_SQL = """
SELECT a.o_custkey, a.o_orderkey AS o_orderkey1, b.o_orderkey AS o_orderkey2,
  CAST(a.o_orderdate AS DATE) AS s1, CAST(b.o_orderdate AS DATE) AS s2,
  CAST(a.o_orderdate AS DATE) + 3 AS e1, CAST(b.o_orderdate AS DATE) + 3 AS e2
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey
 AND a.o_orderdate <= b.o_orderdate + INTERVAL 3 DAY AND b.o_orderdate <= a.o_orderdate + INTERVAL 3 DAY"""


@query(OVERLAP_SQL, texts=["s1", "s2", "e1", "e2"])
def overlap_pairs(t: Tables):
    return joins.overlap_pairs(order_windows(t), "o_custkey", "s", "e", "o_orderkey")


@query(f"SELECT o_custkey, count(*) AS conflicts FROM ({OVERLAP_SQL}) GROUP BY o_custkey")
def count_by_key(t: Tables):
    return aggregates.overlap_counts(order_windows(t), "o_custkey", "s", "e", "o_orderkey", unique_key=True)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, o_orderstatus, c_name, n_name, r_name
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def meetings_flat(t: Tables):
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
        .join(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "o_custkey", "o_orderstatus", "c_name", "n_name", "r_name")
    )


@query("""SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def left_attach(t: Tables):
    return joins.lookup(
        t.documents.select("doc_id", "lang", "n_chars"), t.labels, {"doc_id": "doc_id"}, {"quality": "quality", "toxic": "toxic"}
    )


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')""")
def semi_active_customers(t: Tables):
    recent = t.orders.filter(F.col("o_orderdate") >= dates.moment("2001-01-01 00:00:00"))
    return joins.semi(t.customer, recent, {"c_custkey": "o_custkey"}).select("c_custkey", "c_name")


@query("""SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderpriority = '1-URGENT')
 OR c_custkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 50)""")
def semi_either(t: Tables):
    urgent = t.orders.filter((F.col("o_orderdate") >= dates.moment("2001-01-01 00:00:00")) & (F.col("o_orderpriority") == "1-URGENT"))
    returned = t.lineitem.filter("l_returnflag = 'R' AND l_quantity = 50")
    return joins.semi_any(t.customer, [(urgent, "o_custkey"), (returned, "l_partkey")], "c_custkey").select("c_custkey")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P'
 AND o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2001-01-01')""")
def anti_missing_parent(t: Tables):
    partial = t.orders.filter(
        (F.col("o_orderstatus") == "P")
        & (F.col("o_orderdate") >= dates.moment("2000-01-01 00:00:00"))
        & (F.col("o_orderdate") < dates.moment("2001-01-01 00:00:00"))
    )
    return joins.anti(t.customer, partial, {"c_custkey": "o_custkey"}).select("c_custkey")


@query("SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL")
def anti_null_probe(t: Tables):
    return joins.anti(t.documents, t.labels, ["doc_id"]).select("doc_id", "source")


@query("""
SELECT 'clean list' AS branch, p_partkey FROM part WHERE CASE WHEN p_size <= 5 THEN NULL ELSE p_size END
  NOT IN (SELECT CAST(l_quantity AS INTEGER) FROM lineitem WHERE l_returnflag = 'R' AND l_discount = 0.1 AND l_tax = 0.08 AND l_quantity > 30)
UNION ALL
SELECT 'list with null', p_partkey FROM part WHERE p_size
  NOT IN (SELECT CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS INTEGER) END FROM lineitem WHERE l_returnflag = 'R')
UNION ALL
SELECT 'empty list', p_partkey FROM part WHERE CASE WHEN p_size <= 5 THEN NULL ELSE p_size END
  NOT IN (SELECT CAST(l_quantity AS INTEGER) FROM lineitem WHERE l_returnflag = 'none')""")
def not_in_null_aware(t: Tables):
    probe = t.part.select("p_partkey", F.when(F.col("p_size") > 5, F.col("p_size")).alias("p_size"))
    size = F.col("l_quantity").cast("int")
    lists = {
        "clean list": (probe, t.lineitem.filter("l_returnflag = 'R' AND l_discount = 0.1D AND l_tax = 0.08D AND l_quantity > 30").select(size.alias("v"))),
        "list with null": (t.part, t.lineitem.filter("l_returnflag = 'R'").select(F.when(F.col("l_quantity") > 10, size).alias("v"))),
        "empty list": (probe, t.lineitem.filter("l_returnflag = 'none'").select(size.alias("v"))),
    }
    out = None
    for branch, (rows, values) in lists.items():
        kept = joins.not_in(rows, "p_size", values, "v").select(F.lit(branch).alias("branch"), "p_partkey")
        out = kept if out is None else out.unionByName(kept)
    return out


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM (
  SELECT lineitem.*, p_brand, CASE WHEN l_returnflag = 'A' AND l_discount = 0.05 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS q
  FROM lineitem JOIN part ON p_partkey = l_partkey) li
WHERE q NOT IN (SELECT CASE WHEN p_type = 'PROMO' AND p_name LIKE 'cold%' AND p_size < 5 THEN NULL ELSE p_size END FROM part p WHERE p.p_brand = li.p_brand AND p_retailprice > 1000)""")
def not_in_correlated(t: Tables):
    q = F.when((F.col("l_returnflag") == "A") & (F.col("l_discount") == 0.05), None).otherwise(F.col("l_quantity").cast("int"))
    lines = t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey")).withColumn("q", q)
    hole = (F.col("p_type") == "PROMO") & F.col("p_name").startswith("cold") & (F.col("p_size") < 5)
    sizes = t.part.filter("p_retailprice > 1000").select("p_brand", F.when(~hole, F.col("p_size")).alias("v"))
    return joins.not_in_per_group(lines, "q", sizes, "v", ["p_brand"]).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )


@query("SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND l_shipdate < o_orderdate", texts=["l_shipdate", "o_orderdate"])
def late_events(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.filter("l_shipdate < o_orderdate").select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")


TERMS_SQL = """
SELECT y, q, dense_rank() OVER (ORDER BY y, q) AS term_id, min(d) AS start_date, max(d) AS end_date FROM (
  SELECT year(o_orderdate) AS y, quarter(o_orderdate) AS q, CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY y, q"""


def order_terms(t: Tables):
    """Quarters of the order calendar with dense consecutive ids."""
    from ..models.campus import dense_terms

    days = t.dated_orders.select(F.year("d").alias("y"), F.quarter("d").alias("q"), "d")
    spans = days.groupBy("y", "q").agg(F.min("d").alias("start_date"), F.max("d").alias("end_date"))
    return dense_terms(spans, ["y", "q"], "term_id")


@query(f"""
WITH terms AS ({TERMS_SQL})
SELECT o_orderkey, CAST(term_id AS BIGINT) AS term_id FROM orders JOIN terms ON y = year(o_orderdate) AND q = quarter(o_orderdate)
WHERE term_id BETWEEN (SELECT max(term_id) FROM terms) - 2 AND (SELECT max(term_id) FROM terms)""")
def recent_terms(t: Tables):
    terms = order_terms(t)
    current = terms.agg(F.max("term_id").alias("m")).scalar()
    wanted = terms.filter(F.col("term_id").between(current - 2, current))
    dated = t.dated_orders.select("o_orderkey", F.year("d").alias("y"), F.quarter("d").alias("q"))
    found = joins.few_valued(dated, wanted, ["y", "q"], {"term_id": "term_id"})
    return found.select("o_orderkey", F.col("term_id").cast("bigint").alias("term_id"))


@query(f"""
WITH terms AS ({TERMS_SQL})
SELECT CAST(max(term_id) AS BIGINT) AS term_id FROM terms WHERE DATE '1999-05-17' BETWEEN start_date AND end_date""")
def open_window(t: Tables):
    as_of = dates.day("1999-05-17")
    return order_terms(t).filter(as_of.between(F.col("start_date"), F.col("end_date"))).agg(
        F.max("term_id").cast("bigint").alias("term_id")
    )


FIRST_URGENT = "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders WHERE o_orderpriority = '1-URGENT'"


def _first_urgent(t: Tables, how: str):
    urgent = t.dated_orders.filter("o_orderpriority = '1-URGENT'")
    return joins.first_match(
        t.customer.select("c_custkey"), urgent, {"c_custkey": "o_custkey"},
        [F.col("d"), F.col("o_orderkey")], {"first_key": "o_orderkey", "first_day": "d"}, how,
    )


@query(f"SELECT c_custkey, o_orderkey AS first_key, CAST(o_orderdate AS DATE) AS first_day FROM customer JOIN ({FIRST_URGENT}) ON o_custkey = c_custkey AND rn = 1", texts=["first_day"])
def apply_top1(t: Tables):
    return _first_urgent(t, "inner")


@query(f"SELECT c_custkey, o_orderkey AS first_key, CAST(o_orderdate AS DATE) AS first_day FROM customer LEFT JOIN ({FIRST_URGENT}) ON o_custkey = c_custkey AND rn = 1", texts=["first_day"])
def outer_apply_top1(t: Tables):
    return _first_urgent(t, "left")


@query("""
SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) - coalesce((SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders
  WHERE o_custkey = c_custkey AND o_orderstatus = 'O'), 0) AS DOUBLE) AS balance_after FROM customer""")
def balance_with_pending(t: Tables):
    pending = joins.attach_sum(
        t.customer, t.orders.filter("o_orderstatus = 'O'"), {"c_custkey": "o_custkey"}, cents("o_totalprice"), "pending"
    )
    return pending.select("c_custkey", (cents("c_acctbal") - F.col("pending")).cast("double").alias("balance_after"))


@query("""
SELECT l.p_partkey, p.p_partkey AS match_key FROM part l LEFT JOIN part p
ON p.p_brand = l.p_brand AND p.p_size = l.p_size AND starts_with(p.p_name, substr(l.p_name, 1, 5))""")
def text_key_match(t: Tables):
    noted = t.part.select(
        "p_partkey", "p_size", F.concat(F.lit("2020/"), F.col("p_brand"), F.lit("/"), F.substring("p_name", 1, 5)).alias("note")
    )
    return joins.text_match(
        noted, "note", r"/(Brand#[0-9]+)/(.*)$", t.part, {"p_size": "p_size"}, "p_brand", "p_name", {"match_key": "p_partkey"}, many=True
    ).select("p_partkey", "match_key")


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey, (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS customer_nation,
  (SELECT n_name FROM nation WHERE n_nationkey = s_nationkey) AS supplier_nation
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey""")
def scalar_lookup_pair(t: Tables):
    lines = (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("s_suppkey") == F.col("l_suppkey"))
    )
    lines = joins.lookup(lines, t.nation, {"c_nationkey": "n_nationkey"}, {"customer_nation": "n_name"})
    lines = joins.lookup(lines, t.nation, {"s_nationkey": "n_nationkey"}, {"supplier_nation": "n_name"})
    return lines.select("l_orderkey", "l_linenumber", "l_suppkey", "customer_nation", "supplier_nation")


PREFIX_SQL = """
SELECT number, coalesce(
    (SELECT min(c) FROM codes WHERE p = substr(number, 1, 3) AND length(p) = 3 AND n = length(number)),
    (SELECT min(c) FROM codes WHERE p = substr(number, 1, 2) AND length(p) = 2 AND n = length(number)),
    (SELECT min(c) FROM codes WHERE p = substr(number, 1, 1) AND length(p) = 1 AND n = length(number)), 240) AS country
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS number FROM orders)"""
CODES_SQL = "codes(p, n, c) AS (VALUES ('1', 4, 10), ('12', 4, 20), ('123', 4, 30), ('123', 5, 31), ('14', 5, 40), ('14', 5, 39), ('7', 4, 50))"


def _countries(t: Tables):
    # Code values of the check: (prefix, number length, country).
    codes = t.spark.createDataFrame(
        [("1", 4, 10), ("12", 4, 20), ("123", 4, 30), ("123", 5, 31), ("14", 5, 40), ("14", 5, 39), ("7", 4, 50)],
        "p string, n int, c int",
    )
    numbers = t.orders.select(F.col("o_orderkey").cast("string").alias("number"))
    found = joins.prefix_lookup(numbers, "number", codes, "p", "n", "c", "country")
    return found.withColumn("country", F.coalesce("country", F.lit(240)))


@query(f"WITH {CODES_SQL} {PREFIX_SQL}")
def prefix_lookup(t: Tables):
    return _countries(t)


@query(f"""WITH {CODES_SQL} SELECT number, CASE WHEN country <> 240 THEN country WHEN length(number) <> 4 THEN country
  WHEN substr(number, 1, 2) IN ('97', '96') THEN 122 WHEN substr(number, 1, 1) = '9' THEN 190 ELSE country END AS country FROM ({PREFIX_SQL})""")
def prefix_override(t: Tables):
    from ..plans.quality import override_by_prefix

    return _countries(t).withColumn(
        "country", override_by_prefix("number", "country", 240, length=4, narrow=("97", "96"), narrow_value=122, wide="9", wide_value=190)
    )


@query("""
SELECT a.o_orderkey FROM orders a WHERE a.o_orderstatus = 'O' AND EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey
  AND b.o_orderstatus <> 'O' AND b.o_orderdate = a.o_orderdate - INTERVAL 1 DAY)""")
def adjacent_versions(t: Tables):
    return joins.adjacent_versions(
        t.dated_orders, ["o_custkey"], "d", "d", F.col("o_orderstatus") == "O", F.col("o_orderstatus") != "O"
    ).select("o_orderkey")


@query("""
SELECT doc_id, count(*) AS n_equal FROM (
  SELECT a.doc_id FROM (SELECT doc_id, md5(text) AS h, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang FROM documents) a
  JOIN (SELECT md5(text) AS h, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang FROM documents) b
    ON a.h = b.h AND coalesce(a.lang, '') = coalesce(b.lang, '')) GROUP BY doc_id""")
def blank_safe_match(t: Tables):
    keyed = t.documents.select("doc_id", F.md5("text").alias("h"), "lang")
    a = keyed.withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")))
    b = keyed.withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")).otherwise(""))
    names = ["h", "lang"]
    left = a.select("doc_id", *joins.blank_safe_columns(names))
    # Equal rows are counted before the join, so a group of copies meets one row.
    right = b.select(*joins.blank_safe_columns(names)).groupBy("_k_h", "_k_lang").agg(F.count("*").alias("n_equal"))
    return left.join(right, ["_k_h", "_k_lang"]).select("doc_id", "n_equal")


@query("""
SELECT o_orderkey, n.c_custkey AS o_custkey FROM orders JOIN customer o ON o.c_custkey = o_custkey
JOIN (SELECT c_name, c_custkey + 1000000 AS c_custkey FROM customer WHERE c_acctbal > 0) n ON n.c_name = o.c_name""")
def remap_keys(t: Tables):
    new = t.customer.filter("c_acctbal > 0").withColumn("c_custkey", F.col("c_custkey") + 1000000)
    return joins.remap_keys(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", t.customer, new, "c_custkey", ["c_name"])


@query("""
SELECT l_partkey, CASE WHEN count(DISTINCT side) = 2 THEN 'Both have' ELSE 'Only ' || min(side) END AS status FROM (
  SELECT l_partkey, o_orderpriority AS side FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus = 'P' AND l_returnflag = 'R') GROUP BY l_partkey""")
def set_diff_two_sides(t: Tables):
    sided = (
        t.lineitem.filter("l_returnflag = 'R'")
        .join(t.orders.filter("o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus = 'P'"), F.col("o_orderkey") == F.col("l_orderkey"))
        .select("l_partkey", F.col("o_orderpriority").alias("side"))
    )
    return joins.side_difference(sided, "side", ["l_partkey"])


@query("""
SELECT event_id, coalesce(c.c_custkey, s.s_suppkey) AS parent FROM events
LEFT JOIN (SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 5000) c ON c.c_custkey = user_id
LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) s ON s.s_suppkey = user_id
WHERE coalesce(c.c_custkey, s.s_suppkey) IS NOT NULL""")
def coalesce_parents(t: Tables):
    return joins.coalesce_parents(
        t.events.select("event_id", "user_id"), t.customer.filter("c_acctbal > 5000"), t.supplier.filter("s_acctbal > 5000"),
        {"user_id": ("c_custkey", "s_suppkey")}, ("c_custkey", "s_suppkey"), "parent",
    ).select("event_id", "parent")


@query("""
WITH root AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
 o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM root)),
 l AS (SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
SELECT 'customer' AS level, count(*) AS n FROM root UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM l""")
def fk_closure_copy(t: Tables):
    copied = joins.copy_closure(
        t.customer.filter("c_mktsegment = 'BUILDING'"),
        [("orders", t.orders, "o_custkey", "c_custkey"), ("lineitem", t.lineitem, "l_orderkey", "o_orderkey")],
    )
    names = {"root": "customer", "orders": "orders", "lineitem": "lineitem"}
    out = None
    for level, label in names.items():
        part = copied[level].agg(F.count("*").alias("n")).select(F.lit(label).alias("level"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("""
SELECT DISTINCT o_orderkey, l_suppkey, s_name, n_name FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 0
JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey WHERE o_orderstatus = 'P'""")
def fanout_recipients(t: Tables):
    exceptions = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey")
    contacts = (
        exceptions.join(t.lineitem.filter("l_quantity > 0").select("l_orderkey", "l_suppkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_orderkey", "l_suppkey")
        .distinct()
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    )
    return joins.lookup(contacts, t.nation, {"s_nationkey": "n_nationkey"}, {"n_name": "n_name"}).select(
        "o_orderkey", "l_suppkey", "s_name", "n_name"
    )
