"""Queries of operators that are made for many rows a key: interval joins, skipping merges, reachability, indexes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import graphs, intervals, pq, state
from ..operators.textindex import TextIndex
from ..sources.ranged import Ranged
from ..sources.store import Store
from ..streaming import observations
from .lineage import scratch
from .library import TEXT_QUERY, _bm25_sql, _ranked
from .registry import register, table

#: A third and more of all events belong to one subject.
_SUBJECT = "CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE user_id END"


@register(
    f"""WITH e AS (SELECT {_SUBJECT} AS subject, event_id, ts, event_type, value FROM events),
    a AS (SELECT subject, event_id AS assertion, ts AS valid_from, lead(ts) OVER (PARTITION BY subject, floor(value / 10) ORDER BY ts, event_id) AS valid_until FROM e)
    SELECT e.event_id, a.subject, count(*) AS held, min(assertion) AS first_assertion, sum(assertion)::BIGINT AS total FROM e JOIN a ON e.subject = a.subject AND valid_from <= ts AND (valid_until IS NULL OR valid_until > ts) GROUP BY ALL"""
)
def interval_asof(spark, sf_dir):
    """At each event, what holds of its subject: the last event of each size class."""
    e = table(spark, sf_dir, "events").select(F.expr(_SUBJECT).alias("subject"), "event_id", "ts", F.floor(F.col("value") / 10).alias("size"))
    a = state.intervals(e.withColumn("_k", F.struct("subject", "size")), "_k", "ts", "event_id")
    a = a.select("subject", F.col("event_id").alias("assertion"), F.col("ts").alias("valid_from"), "valid_until")
    held = intervals.asof_between(e.drop("size"), a, "subject", "ts", "valid_from", "valid_until")
    return held.groupBy("event_id", "subject").agg(F.count(F.lit(1)).alias("held"), F.min("assertion").alias("first_assertion"), F.sum("assertion").alias("total"))


@register(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus, o_totalprice > 400000 AND o_orderkey % 1000 <> 7 AS deleted FROM orders
    UNION ALL SELECT -o_orderkey - 1, 1, 'N', FALSE FROM orders WHERE o_totalprice > 400000"""
)
def skip_merge(spark, sf_dir):
    """Orders, loaded again with one price in a thousand changed, the dearest gone and as many new ones: only what differs is joined and written."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    dear, changed = F.col("o_totalprice") > 400000, F.col("o_orderkey") % 1000 == 7
    new = orders.where(dear).select((-F.col("o_orderkey") - 1).alias("o_orderkey"), F.lit(1.0).alias("o_totalprice"), F.lit("N").alias("o_orderstatus"))
    later = orders.where(~dear | changed).withColumn("o_totalprice", F.when(changed, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).unionByName(new)
    relation = Ranged(Store(spark, scratch(spark, "skip-merge"), "test", "orders"), "orders", "o_orderkey", file_rows=20_000)
    for scan in (orders, later):
        relation.load(scan, ["o_totalprice", "o_orderstatus"])
    return relation.read()


@register("SELECT event_id AS node FROM events")
def chain_closure(spark, sf_dir):
    """What follows from the first event, each from the one before: as many steps as there are events."""
    from ..operators.state import placed

    events = placed(table(spark, sf_dir, "events").select("event_id"), [F.col("event_id")], "place")
    edges = events.select("place", F.col("event_id").alias("a")).join(events.select((F.col("place") - 1).alias("place"), F.col("event_id").alias("b")), "place")
    return graphs.closure(events.where("place = 0").select("event_id"), edges, "a", "b")


_CYCLE = "c_nationkey % 5 = 3"


@register(
    f"""WITH o AS (SELECT o_orderkey AS node, o_custkey, {_CYCLE} AND count(*) OVER (PARTITION BY o_custkey) > 1 AS ring, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r
      FROM orders JOIN customer ON o_custkey = c_custkey),
    after AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    SELECT node, CASE WHEN NOT ring THEN r - 1 END AS level, ring AS cyclic FROM o WHERE ring OR node IN (SELECT node FROM o QUALIFY count(*) OVER (PARTITION BY o_custkey) > 1)
    UNION ALL SELECT -(l_orderkey * 10 + l_linenumber) - 1, CASE WHEN NOT ring THEN r END, FALSE FROM after JOIN o ON l_orderkey = node
    UNION ALL SELECT node, 0, FALSE FROM o WHERE node IN (SELECT l_orderkey FROM lineitem) AND node NOT IN (SELECT node FROM o QUALIFY count(*) OVER (PARTITION BY o_custkey) > 1)"""
)
def plan_levels(spark, sf_dir):
    """The level of each order after the customer's earlier ones and of each line after its order; some customers' last order leads to their first again."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    own = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    each = orders.select(F.col("o_orderkey").alias("a"), F.lead("o_orderkey").over(own).alias("_next"), F.first("o_orderkey").over(own).alias("_first"), F.expr(_CYCLE).alias("_ring"))
    each = each.withColumn("b", F.coalesce("_next", F.when(F.col("_ring") & (F.col("a") != F.col("_first")), F.col("_first"))))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("a"), (-(F.col("l_orderkey") * 10 + F.col("l_linenumber")) - 1).alias("b")).join(each.select("a"), "a", "left_semi")
    return graphs.levels(each.select("a", "b").unionByName(lines), "a", "b")


def _segments(spark, sf_dir):
    """All documents, by language in two segments, without those of one source."""
    docs = table(spark, sf_dir, "documents")
    index = TextIndex(Store(spark, scratch(spark, "text-index"), "test", "documents"), "index", "doc_id", zone=32)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    index.create()
    index.append(docs.where(~english), "text")
    index.append(docs.where(english), "text")
    index.delete(docs.where("source = 'src3'").select("doc_id"))
    return index


_LIVE = "FROM documents WHERE source IS DISTINCT FROM 'src3'"


@register(_ranked(_bm25_sql(TEXT_QUERY).replace("FROM documents)", f"{_LIVE})"), "doc_id", 20))
def segments_topk(spark, sf_dir):
    """As bm25_topk over the documents that an append and a deletion have left, reading the zones that can hold results."""
    return _segments(spark, sf_dir).search(TEXT_QUERY, 20)[0]


@register(
    f"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w {_LIVE})
    SELECT doc_id, len(list_filter(range(1, len(w) - 1), lambda i: w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved'))::BIGINT AS places FROM d WHERE places > 0"""
)
def segments_phrase(spark, sf_dir):
    return _segments(spark, sf_dir).phrase("All rights reserved")


@register()
def pq_search(spark, sf_dir):
    """Nearest neighbours of every hundredth vector in two thirds of the lists: the share of the exact ten that was found, by query."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    n = rows.count()
    lists = max(4, round(n**0.5))
    index = pq.Index.build(rows, "vec_id", "embedding", scratch(spark, "pq"), lists, 16)
    queries = rows.where("vec_id % 100 = 0")
    found = index.search(queries, "vec_id", "embedding", 10, -(-2 * lists // 3), 100)
    return pq.recall(found, pq.exact_search(rows, "vec_id", "embedding", queries, "vec_id", "embedding", 10))


# --- streams ------------------------------------------------------------------------------------


def _events(spark, sf_dir, *columns):
    static = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(static.schema).parquet(f"{sf_dir}/events.parquet*")
    return stream.select(F.col("ts").cast("timestamp").alias("at"), *columns)


def _published(spark, stream, mode):
    store = Store(spark, scratch(spark, "streams"), "test", "law")
    observations.publish_stream(stream, store, "result", scratch(spark, "stream-state"), mode=mode, once=True).awaitTermination()
    return store.read("result")


@register(
    """WITH e AS (SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 6 HOURS AS apart FROM events),
    s AS (SELECT user_id, ts, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM e)
    SELECT user_id, min(ts) AS began, max(ts) + INTERVAL 6 HOURS AS ended, count(*) AS n FROM s GROUP BY user_id, session"""
)
def stream_sessions(spark, sf_dir):
    found = observations.sessions(_events(spark, sf_dir, "user_id"), "at", "6 hours", ["user_id"])
    times = [F.col(f"session.{k}").cast("timestamp_ntz").alias(n) for k, n in (("start", "began"), ("end", "ended"))]
    return _published(spark, found.select("user_id", *times, "n"), "complete")


@register(
    """SELECT a.event_id AS viewed, b.event_id AS bought, a.user_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 3 HOURS
    WHERE a.event_type = 'view' AND b.event_type = 'purchase'"""
)
def stream_followed(spark, sf_dir):
    views = _events(spark, sf_dir, "user_id", "event_type", F.col("event_id").alias("viewed")).where("event_type = 'view'").select("at", "user_id", "viewed")
    bought = _events(spark, sf_dir, "user_id", "event_type", F.col("event_id").alias("bought")).where("event_type = 'purchase'").select(F.col("at").alias("bought_at"), "user_id", "bought")
    return _published(spark, observations.followed(views, "at", bought, "bought_at", "user_id", "3 HOURS").select("viewed", "bought", "user_id"), "append")


@register(
    """SELECT user_id, CASE WHEN lag(value) OVER w IS NULL THEN 'inserted' WHEN floor(lag(value) OVER w / 50) = floor(value / 50) THEN 'reused' ELSE 'changed' END AS change_type, floor(value / 50)::BIGINT::VARCHAR AS size
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)"""
)
def stream_versions(spark, sf_dir):
    """Each event's size class against the one before of its user, from state kept by user."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    sized = _events(session, sf_dir, "user_id", F.floor(F.col("value") / 50).cast("string").alias("size"))
    changes = observations.versions(sized, "user_id", "size", "at", 366 * 86_400_000)
    return _published(spark, changes, "append")
