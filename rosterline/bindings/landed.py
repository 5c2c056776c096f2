"""Batch twins of the landed-file operators."""

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import changes
from ..operators.ranking import latest_row_per_key
from ..operators.sets import union_branches
from ..sources.manifest import Store
from ..staging import new_folder
from ..streaming import ingest
from ..streaming.state import LatestVersions, SeenOnce
from .base import Tables, query

# Pattern of the page addresses: scheme, host, language, number.
ADDRESS = r"^(https?)://([^/]+)/([a-z]+)/([0-9]+)"


@query(r"""
SELECT page_id, nullif(regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+)', 1), '') AS scheme,
  nullif(regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+)', 2), '') AS host,
  nullif(regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+)', 3), '') AS lang,
  nullif(regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+)', 4), '') AS number FROM pages""")
def st_parse_names(t: Tables):
    return t.pages.select("page_id", *ingest.name_parts(F.col("url"), ADDRESS, ["scheme", "host", "lang", "number"]))


@query("SELECT event_id, user_id, event_type FROM events")
def overlap_dedupe(t: Tables):
    again = t.events.filter(F.col("ts") >= F.lit("2024-01-24 00:00:00").cast("timestamp_ntz"))
    pulled = union_branches([t.events, again])
    return ingest.dedupe_overlap(pulled, ["event_id"], "ts").select("event_id", "user_id", "event_type")


@query("""
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def replay_range(t: Tables):
    """Applying a range again leaves the latest versions unchanged."""
    again = ingest.replay(t.events, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20))
    return latest_row_per_key(
        union_branches([t.events, again]), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]
    ).select("user_id", "event_type", "event_id")


@query("""
SELECT CAST(ts AS DATE) AS day, CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'ok' END AS part, count(*) AS n FROM events GROUP BY 1, 2""", texts=["day"])
def quarantine_split(t: Tables):
    parts = ingest.split_errors(t.events.withColumn("day", F.col("ts").cast("date")), "event_type", ["error"])
    counted = [
        df.groupBy("day").agg(F.count("*").alias("n")).select("day", F.lit(name).alias("part"), "n") for name, df in parts.items()
    ]
    return union_branches(counted)


@query("""
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def versions_by_bucket(t: Tables):
    """Three batches, one of them old and one repeated, leave the latest version of each key."""
    state = LatestVersions(Store(t.spark, new_folder(t.spark, "versions")), "events", ["user_id", "event_type"], ["ts", "event_id"], 16)
    events = t.events.select("user_id", "event_type", "event_id", "ts")
    split = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    for batch in (events.filter(F.col("ts") >= split), events.filter(F.col("ts") < split), events):
        state.merge(batch)
    return state.current().drop("ts")


@query("SELECT event_id, user_id, event_type FROM events")
def late_pulls_seen_once(t: Tables):
    """The newest days first, then older and overlapping ones: every row once, none lost."""
    seen = SeenOnce(Store(t.spark, new_folder(t.spark, "seen")), "events", ["event_id"], "ts")
    events = t.events.select("event_id", "user_id", "event_type", "ts")
    ends = [F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz") for d in ("10", "24")]
    for batch in (events.filter(F.col("ts") >= ends[1]), events.filter(F.col("ts") < ends[0]), events.filter(F.col("ts") >= ends[0]), events):
        seen.take(batch)
    return seen.current().select("event_id", "user_id", "event_type")


@query("""
SELECT o_orderkey, o_orderstatus, 'orders' AS part FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_orderstatus, 'purged' FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'""")
def published_run(t: Tables):
    """A purge and its archive become current together; both are read back through the manifest."""
    store = Store(t.spark, new_folder(t.spark, "store"))
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    doomed = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    empty = orders.filter("false")
    store.publish({"orders": changes.append(empty, orders), "purged": changes.append(empty, empty)}, "load")
    now = store.snapshot()
    gone = now["orders"].filter(doomed)
    store.publish({"orders": changes.delete_where(now["orders"], doomed), "purged": changes.append(now["purged"], gone)}, "purge")
    after = store.snapshot()
    return union_branches([after[n].select("o_orderkey", "o_orderstatus", F.lit(n).alias("part")) for n in ("orders", "purged")])
