"""Queries of acquisition, ingestion, stored relations, streams and artifacts."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from ..functions import identity
from ..operators import state
from ..sources import acquire, readers
from ..sources.store import Store, ingest
from ..streaming import observations
from . import models
from .lineage import scratch
from .registry import register, table

REVISION = "0123456789abcdef0123456789abcdef01234567"
CARD = {"revision": REVISION, "licence": ["mit"]}


def _store(spark, name: str) -> Store:
    return Store(spark, scratch(spark, name), "test", "data")


# --- acquisition ------------------------------------------------------------------------------


@register("""SELECT doc_id AS row_number, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || '}') AS row_sha256 FROM documents WHERE lang IN ('de', 'fr')""")
def row_selection(spark, sf_dir):
    wanted = acquire.Selection("owner/texts", REVISION, "texts.parquet", "mit", ("doc_id", "lang", "n_chars"), selector="lang", values=("de", "fr"))
    return acquire.select_rows(table(spark, sf_dir, "documents"), CARD, wanted, "doc_id").select("row_number", "row_sha256")


@register("""SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS row_number, sha256('{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') AS row_sha256 FROM nation""")
def file_acquire(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # the nations of the world
    folder = scratch(spark, "acquire")
    index = acquire.write_artifacts(spark, folder, {"nations.json": [r.asDict() for r in nations]}).first()
    wanted = acquire.Selection("owner/nations", REVISION, "nations.json", "mit", ("n_name", "n_regionkey"), tuple(range(len(nations))), file_sha256=index["sha256"].removeprefix("sha256:"))
    return acquire.acquire_file(spark, folder, CARD, wanted).select("row_number", "row_sha256")


def _pages(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "role", F.concat_ws("-", "conv_id", "turn").alias("q"), "text", F.concat_ws(":", "conv_id", "role").alias("image"), F.array(F.substring("text", 1, 20)).alias("answers")
    )
    return acquire.document_pages(turns, "conv_id", "role", "q", "text", "image", "answers", most=None)


@register("""SELECT 'doc:' || conv_id || ':page:' || role AS page_id, 'sha256:' || sha256(conv_id || ':' || role) AS image_sha256, count(*) AS n_questions FROM conversations GROUP BY conv_id, role""")
def document_pages(spark, sf_dir):
    questions, pages, _ = _pages(spark, sf_dir)
    return questions.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_questions")).join(pages.select("page_id", "image_sha256"), "page_id")


@register("""SELECT conv_id || '-' || turn AS question_id, 'doc:' || conv_id || ':page:' || role AS page_id, left(text, 20) AS answer, 'sha256:' || sha256(conv_id || ':' || role) AS image_sha256 FROM conversations""")
def page_questions(spark, sf_dir):
    questions, pages, judgments = _pages(spark, sf_dir)
    judged = judgments.select("question_id", F.element_at("acceptable_answers", 1).alias("answer"))
    return questions.join(pages, "page_id").join(judged, "question_id").select("question_id", "page_id", "answer", "image_sha256")


@register("SELECT c_custkey, o_orderkey, o_orderdate AS valid_from FROM customer JOIN orders ON o_custkey = c_custkey")
def case_images(spark, sf_dir):
    cases = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("valid_from"))
    return state.inherited(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", cases, "o_custkey", ["o_orderkey", "valid_from"])


@register("SELECT o_orderkey, l_linenumber, l_quantity AS quantity, coalesce(nullif(l_returnflag, 'N'), l_linestatus) AS flag, o_orderpriority FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def flatten_nested(spark, sf_dir):
    item = F.struct("l_linenumber", F.col("l_quantity").alias("quantity"), F.nullif("l_returnflag", F.lit("N")).alias("after"), F.col("l_linestatus").alias("before"))
    parents = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey", "o_orderpriority").agg(F.collect_list(item).alias("items"))
    flat = acquire.flattened(parents, "items", ["o_orderkey", "o_orderpriority"], {"flag": ("after", "before")})
    return flat.select("o_orderkey", "l_linenumber", "quantity", "flag", "o_orderpriority")


@register("SELECT c_custkey, o_orderkey AS case_id, o_totalprice AS price FROM customer JOIN orders ON o_custkey = c_custkey")
def flatten_structs(spark, sf_dir):
    """Customers without orders have a null list and give no rows."""
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").alias("case_id"), F.col("o_totalprice").alias("price"))).alias("cases"))
    parents = table(spark, sf_dir, "customer").join(lists, F.col("c_custkey") == F.col("o_custkey"), "left")
    return acquire.flattened(parents, "cases", ["c_custkey"])


@register("SELECT issue, count(*) AS n FROM (SELECT CASE WHEN html <> trim(url) || html THEN 'hash' END AS issue FROM pages UNION ALL SELECT CASE WHEN strlen(html) <> length(html) THEN 'size' END FROM pages) GROUP BY issue")
def verified_content(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("sha", F.concat(F.lit("sha256:"), F.sha2(F.col("html").cast("binary"), 256)))
    other = F.concat(F.lit("sha256:"), F.sha2(F.concat(F.trim("url"), F.col("html")).cast("binary"), 256))
    content = F.col("html").cast("binary")
    checked = pages.select(acquire.content_issues(content, other).alias("issue")).unionByName(pages.select(acquire.content_issues(content, F.col("sha"), F.length("html")).alias("issue")))
    return checked.groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@register("SELECT 'a.json' AS path, CAST(NULL AS VARCHAR) AS issue WHERE false UNION ALL VALUES ('b.json', 'hash'), ('c.json', 'missing'), ('d.json', 'repeated'), ('../e.json', 'unsafe')")
def artifact_issues(spark, sf_dir):
    regions = [r[0] for r in table(spark, sf_dir, "region").select("r_name").orderBy("r_regionkey").collect()]  # five regions
    folder = scratch(spark, "artifacts")
    index = acquire.write_artifacts(spark, folder, {"a.json": regions, "b.json": regions[:1], "d.json": {"regions": regions}})
    wrong = F.when(F.col("path") == "b.json", F.concat(F.lit("sha256:"), F.sha2(F.lit("other"), 256))).otherwise(F.col("sha256"))
    more = spark.createDataFrame([("c.json", "sha256:0", 1, "application/json"), ("../e.json", "sha256:0", 1, "application/json")], index.schema)
    return acquire.artifact_issues(spark, folder, index.withColumn("sha256", wrong).unionByName(more).unionByName(index.where("path = 'd.json'")))


# --- ingestion ----------------------------------------------------------------------------------


@register("SELECT conv_id || '-' || turn AS record_id, role AS channel, 'ctx:talk:' || left('sha256:' || sha256(to_json(conv_id || '-' || turn)::VARCHAR), 12) AS context_unit_id FROM conversations")
def ingest_simple(spark, sf_dir):
    records = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("record_id"), F.col("role").alias("channel"), "text")
    return readers.plain_records(records, "test", "talk").select("record_id", "channel", "context_unit_id")


def _bound(spark, sf_dir):
    contract = readers.Contract(("id", "body", "tongue"), ("id",), ("body",), media_types=("text/plain", "text/markdown"), resource="texts")
    media = F.when(F.col("lang") == "es", "text/html").when(F.col("lang") == "de", "text/markdown").otherwise("text/plain")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", media.alias("_media_type"), F.concat(F.when(F.col("source") == "src1", "md5:").otherwise("sha256:"), F.sha2("text", 256)).alias("_content_sha256"),
        F.lit("2024-01-01T00:00:00Z").alias("_observed_at"), F.when(F.col("source") != "src2", F.concat(F.lit("doc://"), F.col("doc_id"))).alias("_content_ref"),
    )
    return contract, *readers.bind(docs, contract, {"id": "doc_id", "body": "text", "tongue": "lang"}, observed=True)


_BOUND = """SELECT *, CASE WHEN lang = 'es' THEN 'media_type_not_allowed' WHEN source IS NULL OR source = 'src2' THEN 'missing_observation'
    WHEN source = 'src1' THEN 'missing_content_hash' ELSE 'admitted' END AS reason FROM documents"""


@register(f"SELECT reason, count(*) AS n FROM ({_BOUND}) GROUP BY reason")
def bound_ingest(spark, sf_dir):
    _, good, issues = _bound(spark, sf_dir)
    reasons = good.select(F.lit("admitted").alias("reason")).unionByName(issues.select(F.col("reason_code").alias("reason")))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register(f"""SELECT doc_id::VARCHAR AS record_id, 'sha256:' || sha256(text) AS content_sha256, 'ctx:law:' || left('sha256:' || sha256('{{"key":"' || doc_id || '","resource":"texts"}}'), 12) AS context_unit_id FROM ({_BOUND}) WHERE reason = 'admitted'""")
def bound_units(spark, sf_dir):
    contract, good, _ = _bound(spark, sf_dir)
    return readers.bound_records(good, contract, "files", "law").select("record_id", "content_sha256", "context_unit_id")


@register(
    f"""WITH g AS (SELECT doc_id, 'sha256:' || sha256(text) AS c, left('sha256:' || sha256('{{"key":"' || doc_id || '","resource":"texts"}}'), 12) AS u FROM ({_BOUND}) WHERE reason = 'admitted')
    SELECT 'node' AS part, 'source_record' AS kind, count(*) AS n FROM g UNION ALL SELECT 'node', 'source_observation', count(DISTINCT c) FROM g UNION ALL SELECT 'node', 'context_unit', count(DISTINCT u) FROM g
    UNION ALL SELECT 'node', 'ingestion_load', 1 UNION ALL SELECT 'edge', 'observed', count(*) FROM g UNION ALL SELECT 'edge', 'ingested', count(DISTINCT c) FROM g UNION ALL SELECT 'edge', 'canonicalized', count(DISTINCT u) FROM g"""
)
def ingest_lineage(spark, sf_dir):
    contract, good, _ = _bound(spark, sf_dir)
    nodes, edges = readers.ingest_lineage(readers.bound_records(good, contract, "files", "law"), "load1", "run1")
    count = lambda df, part, c: df.groupBy(F.lit(part).alias("part"), F.col(c).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return count(nodes, "node", "node_type").unionByName(count(edges, "edge", "edge_type"))


def _counted(op: str) -> str:
    return f"SELECT user_id || '-' || event_type AS k, count(*) || '@' || max(event_id) AS v, max(ts) AS at FROM events WHERE ts {op} TIMESTAMP '2024-01-02' GROUP BY 1"


@register(
    f"""WITH a AS ({_counted("<")}), b AS ({_counted(">=")})
    SELECT coalesce(a.k, b.k) AS k, coalesce(b.v, a.v) AS v, b.k IS NULL AS deleted, (SELECT strftime(max(ts), '%Y-%m-%d %H') FROM events) AS "cursor" FROM a FULL JOIN b ON a.k = b.k"""
)
def ingest_rerun(spark, sf_dir):
    """One scan, the same again (nothing is loaded), then another: changed and new rows, tombstones for what it lacks, and the latest cursor."""
    events = table(spark, sf_dir, "events").withColumn("k", F.concat_ws("-", "user_id", "event_type"))
    scans = [
        events.where(f"ts {op} timestamp_ntz'2024-01-02 00:00:00'").groupBy("k").agg(F.concat_ws("@", F.count(F.lit(1)), F.max("event_id")).alias("v"), F.max("ts").alias("at")) for op in ("<", ">=")
    ]
    s = _store(spark, "ingest")
    counts = [ingest(s, "counts", scan, "k", "v", cursor="at") for scan in (scans[0], scans[0], scans[1])]
    if counts[1]["reused"] != counts[0]["inserted"] or len(s._versions("counts")) != 2:
        raise AssertionError("the second scan loaded something")
    cursor = F.lit(s.cursor("counts")["value"][:13])
    return s.read("counts").select("k", "v", "deleted", cursor.alias("cursor"))


@register("SELECT kind, count(*) AS n FROM (SELECT CASE WHEN lang IN ('de', 'fr') THEN 'moved' ELSE 'kept' END AS kind FROM documents WHERE lang <> 'es') GROUP BY kind")
def cursor_merge(spark, sf_dir):
    """An incremental source that marks its deleted rows itself."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), "lang")
    s = _store(spark, "marked")
    first = docs.select("k", F.lit("kept").alias("v"), F.col("k").alias("at"), F.lit(False).alias("gone"))
    second = docs.where("lang <> 'en'").select("k", F.lit("moved").alias("v"), F.col("k").alias("at"), (F.col("lang") == "es").alias("gone"))
    for scan in (first, second):
        ingest(s, "texts", scan, "k", "v", snapshot=False, cursor="at", removed="gone")
    return s.read("texts").where("NOT deleted").groupBy(F.col("v").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@register("SELECT max(event_id) AS \"cursor\", count(*) AS n_keys FROM events")
def cursor_advance(spark, sf_dir):
    """The cursor is the largest by its type, not by its text."""
    s = _store(spark, "cursor")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    ingest(s, "events", events.where("ts < timestamp_ntz'2024-01-16 00:00:00'"), "event_id", "event_type", snapshot=False, cursor="event_id")
    ingest(s, "events", events, "event_id", "event_type", snapshot=False, cursor="event_id")
    return s.read("events").agg(F.lit(int(s.cursor("events")["value"])).cast("long").alias("cursor"), F.count(F.lit(1)).alias("n_keys"))


# --- stored relations and streams ---------------------------------------------------------------


@register("SELECT c_custkey, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def store_append(spark, sf_dir):
    s = _store(spark, "append")
    s.create("parties", table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    s.add("parties", table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.lit("supplier").alias("c_mktsegment")))
    return s.read("parties")


@register("SELECT 'customers' AS name, count(*) AS row_count, 'c_custkey,c_name' AS columns FROM customer UNION ALL SELECT 'regions', count(*), 'r_name' FROM region")
def store_metadata(spark, sf_dir):
    s = _store(spark, "metadata")
    s.create("regions", table(spark, sf_dir, "nation").select("n_name"))
    s.replace("regions", table(spark, sf_dir, "region").select("r_name"))
    s.create("customers", table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    s.vacuum("regions", 1)
    found = [s.metadata(n) for n in s.names()]
    return spark.createDataFrame([(m["name"], m["row_count"], ",".join(m["columns"])) for m in found], "name string, row_count long, columns string")


@register("SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'checked' ELSE o_orderstatus END AS status FROM orders UNION ALL SELECT -1 - c_custkey, 'new' FROM customer")
def store_merge(spark, sf_dir):
    """Merges write the changed rows only; a reader takes the last change of a key."""
    orders = table(spark, sf_dir, "orders")
    s = _store(spark, "merge")
    s.create("orders", orders.select("o_orderkey", F.col("o_orderstatus").alias("status")))
    s.merge("orders", orders.where("o_totalprice > 400000").select("o_orderkey", F.lit("seen").alias("status")), "o_orderkey")
    s.merge("orders", orders.where("o_totalprice > 400000").select("o_orderkey", F.lit("checked").alias("status")), "o_orderkey")
    s.merge("orders", table(spark, sf_dir, "customer").select((-1 - F.col("c_custkey")).alias("o_orderkey"), F.lit("new").alias("status")), "o_orderkey")
    return s.read("orders")


def _stream(spark, sf_dir):
    static = table(spark, sf_dir, "events")
    return spark.readStream.schema(static.schema).parquet(f"{sf_dir}/events.parquet*")


@register("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_merge(spark, sf_dir):
    s = _store(spark, "stream")
    stream = _stream(spark, sf_dir).select("user_id", "event_id", "event_type", "value", F.col("event_id").cast("string").alias("content"))
    observations.merge_stream(stream, s, "last", "user_id", "content", "event_id", scratch(spark, "stream-state"), once=True).awaitTermination()
    return s.read("last").select("user_id", "event_id", "event_type", "value")


@register("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    s = _store(spark, "windows")
    stream = _stream(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp"))
    counted = observations.windowed(stream, "at", "1 day", ["event_type"]).select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n")
    observations.publish_stream(counted, s, "days", scratch(spark, "windows-state"), once=True).awaitTermination()
    return s.read("days")


@register("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(spark, sf_dir):
    s = _store(spark, "distinct")
    stream = _stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("at"), "user_id", "event_type")
    distinct = observations.distinct_observations(stream, "at", ["user_id", "event_type"], "40 days").select("user_id", "event_type")
    observations.publish_stream(distinct, s, "pairs", scratch(spark, "distinct-state"), mode="append", once=True).awaitTermination()
    return s.read("pairs")


# --- identities of ingested content -------------------------------------------------------------


@register("""SELECT event_id, 'sha256:' || sha256('{"a":"' || event_type || '","n":{"k":' || to_json(value) || ',"u":[' || user_id || ',null]}}') AS identity FROM events""")
def identity_nested(spark, sf_dir):
    value = F.struct(F.col("event_type").alias("a"), F.struct(F.col("value").alias("k"), F.array(F.col("user_id"), F.lit(None).cast("long")).alias("u")).alias("n"))
    return table(spark, sf_dir, "events").select("event_id", identity.nested_identity(value).alias("identity"))


@register("""SELECT c_custkey, 'sha256:' || sha256('{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') AS identity, sha256('{"name":"' || c_name || '"}') AS row_hash FROM customer""")
def identity_conventions(spark, sf_dir):
    named = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", identity.over_json(named, identity.ingest_identity).alias("identity"), identity.over_json(F.struct(F.col("c_name").alias("name")), identity.row_hash).alias("row_hash")
    )


# --- scans and declarations ------------------------------------------------------------------------


@register("""SELECT 'train/' || r_name || '/' || r_regionkey || '.png' AS member, 'sha256:' || sha256(r_name) AS image_sha256, strlen(r_name) AS byte_count, r_name AS label FROM region""")
def archive_members(spark, sf_dir):
    regions = table(spark, sf_dir, "region").orderBy("r_regionkey").collect()  # five regions
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as archive:
        for r in regions:
            archive.writestr(f"train/{r['r_name']}/{r['r_regionkey']}.png", r["r_name"])
    folder = scratch(spark, "archive")
    acquire.write_bytes(spark, f"{folder}/images.zip", body.getvalue())
    wanted = acquire.Selection("owner/images", REVISION, "images.zip", "mit", members=tuple(sorted(f"train/{r['r_name']}/{r['r_regionkey']}.png" for r in regions)))
    records, judgments = acquire.acquire_members(spark, folder, CARD, wanted)
    return records.join(judgments.select("asset_id", "label"), "asset_id").select("member", "image_sha256", "byte_count", "label")


@register("""SELECT 'res://' || r_regionkey AS uri, r_name AS name, 'text/plain' AS mime_type, upper(r_name) AS text FROM region""")
def resource_scan(spark, sf_dir):
    """A client that lists the regions' names, which it got where it was made, on two pages."""
    readers.register(spark)
    names = [r[0] for r in table(spark, sf_dir, "region").select("r_name").orderBy("r_regionkey").collect()]  # five regions
    rows = spark.read.format("ctxloom_resources").option("client", "ctxloom.plans.queries_sources:listing").option("argument", ",".join(names)).load()
    return rows.select("uri", "name", "mime_type", "text")


class listing:  # noqa: N801 (named like the function that it stands for)
    def __init__(self, argument: str):
        self.names = argument.split(",")

    def list(self, token):
        items = [{"uri": f"res://{i}", "name": n, "mimeType": "text/plain"} for i, n in enumerate(self.names)]
        return (items[:2], "more") if token is None else (items[2:], None)

    def read(self, uri):
        return {"text": self.names[int(uri.removeprefix("res://"))].upper()}


@register("SELECT * FROM (VALUES (1, 100), (101, 1), (350, 1)) t(start, length)")
def window_coalescing(spark, sf_dir):
    return spark.createDataFrame(readers.row_windows([5, 1, 5, 100, 101, 350]), "start int, length int")


@register("SELECT * FROM (VALUES ('fits', true), ('unmapped identity', false), ('bound twice', false), ('unbound resource', false), ('foreign concept', false), ('no cursor', false), ('unknown deletion', false), ('repeated concept', false), ('open identity', false)) t(declaration, accepted)")
def source_declarations(spark, sf_dir):
    contract = lambda **more: readers.Contract(**({"concepts": ("id", "body", "at"), "identity": ("id",), "resource": "r"} | more))
    cases = {
        "fits": lambda: readers.check_binding([contract(mode="incremental", cursor="at", deletion="tombstone")], [("r", {"id": "k", "at": "t"})]),
        "unmapped identity": lambda: readers.check_binding([contract()], [("r", {"body": "b"})]),
        "bound twice": lambda: readers.check_binding([contract()], [("r", {"id": "k"}), ("r", {"id": "k"})]),
        "unbound resource": lambda: readers.check_binding([contract()], []),
        "foreign concept": lambda: readers.check_binding([contract()], [("r", {"id": "k", "z": "z"})]),
        "no cursor": lambda: contract(mode="cdc"),
        "unknown deletion": lambda: contract(deletion="soft"),
        "repeated concept": lambda: contract(concepts=("id", "id")),
        "open identity": lambda: contract(identity=("z",)),
    }
    rows = []
    for name, case in cases.items():
        try:
            case()
            rows.append((name, True))
        except ValueError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "declaration string, accepted boolean")


@register("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type HAVING count(*) > (SELECT count(*) / 6 FROM events)")
def sql_models(spark, sf_dir):
    """Two models in dependency order; one whose test fails leaves what was published."""
    s = _store(spark, "models")
    s.create("events", table(spark, sf_dir, "events").select("event_type", "value"))
    totals = models.Model("totals", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type", ("events",), ("non_empty", "unique:event_type"))
    frequent = models.Model("frequent", "SELECT * FROM totals WHERE n > (SELECT sum(n) / 6 FROM totals)", ("totals",))
    models.run_models(s, [frequent, totals])
    try:
        models.run_models(s, [models.Model("frequent", "SELECT event_type, 1L AS n, 0.0D AS total FROM events", ("events",), ("unique:event_type",))])
    except ValueError:
        return s.read("frequent")
    raise AssertionError("a failed test was published")
