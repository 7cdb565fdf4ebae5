"""The registered queries over the test tables and the SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import identity, text
from ..operators import enrich, metrics, resolve, retrieval, state
from ..sources import readers, relations, store
from . import lifecycle
from .engine import Engine
from .registry import ORACLES, QUERIES, plain, register, table

# --- SQL through the engine ----------------------------------------------------------------

plain("agg_sum_by_key", ("events",), "SELECT event_type, round(sum(value), 4) AS total, count(*) AS n FROM events GROUP BY event_type ORDER BY event_type")
plain("filter_in_and", ("orders",), "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 200000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'")
plain("project_alias", ("customer",), "SELECT c_custkey AS id, c_name AS label, c_acctbal AS balance FROM customer WHERE c_acctbal < 0")
plain("select_literal", ("region",), "SELECT 1 AS id FROM region")
plain("select_star", ("nation",), "SELECT * FROM nation")
plain("join_two", ("orders", "customer"), "SELECT c.c_mktsegment, count(*) AS n, round(sum(o.o_totalprice), 2) AS total FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment")
plain(
    "join_seven", ("region", "nation", "customer", "orders", "lineitem", "supplier", "part"),
    """SELECT n.n_name, count(*) AS n, round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue
    FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey JOIN customer c ON c.c_nationkey = n.n_nationkey
    JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_nationkey = n.n_nationkey JOIN part p ON p.p_partkey = l.l_partkey
    GROUP BY n.n_name""",
)
plain(
    "self_join_edges", ("customer", "orders"),
    """WITH nodes AS (SELECT concat('c', c_custkey) AS id, c_name AS label FROM customer UNION ALL SELECT concat('o', o_orderkey) AS id, o_orderstatus AS label FROM orders),
    edges AS (SELECT concat('c', o_custkey) AS source, concat('o', o_orderkey) AS target FROM orders)
    SELECT s.label AS source_label, t.label AS target_label, count(*) AS n
    FROM edges e JOIN nodes s ON e.source = s.id JOIN nodes t ON e.target = t.id GROUP BY s.label, t.label""",
)


@register("SELECT n.n_name, count(*) AS n FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name")
def fanout_join_count(spark, sf_dir):
    """Suppliers times customers of each nation: both are counted before they meet, so no pair is made."""
    each = lambda name, key: table(spark, sf_dir, name).groupBy(F.col(key).alias("n_nationkey")).agg(F.count(F.lit(1)).alias(name))
    nations = table(spark, sf_dir, "nation").join(each("supplier", "s_nationkey"), "n_nationkey").join(each("customer", "c_nationkey"), "n_nationkey")
    return nations.groupBy("n_name").agg(F.sum(F.col("supplier") * F.col("customer")).alias("n"))


plain("global_agg_empty", ("events",), "SELECT count(*) AS n, sum(value) AS total FROM events WHERE event_type = 'it''s none'")
plain("topk_tiebreak", ("lineitem",), "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 50")
plain("multi_key_order", ("supplier",), "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier ORDER BY s_nationkey ASC, s_acctbal DESC, s_suppkey")
plain("subquery_in", ("orders", "customer"), "SELECT count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
plain("cube_totals", ("orders",), "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
plain("set_difference", ("customer", "orders"), "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")


@register("SELECT cast(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def json_field_agg(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long").alias("k")
    return table(spark, sf_dir, "events").groupBy(k).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


# --- retrieval ------------------------------------------------------------------------------

#: A fixed query vector of 64 numbers, from a rule.
QUERY_VECTOR = [((i * 37) % 64 - 32) / 64 for i in range(64)]
_QV = "[" + ", ".join(map(str, QUERY_VECTOR)) + "]::DOUBLE[]"
_VECTOR = f"SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], {_QV}), 6) AS score FROM embeddings"


def _ranked(inner: str, id_col: str, limit: int, more: str = "") -> str:
    return f"SELECT *, row_number() OVER (ORDER BY score DESC, {id_col}) - 1 AS retrieval_rank FROM (SELECT * FROM ({inner}) {more} ORDER BY score DESC, {id_col} LIMIT {limit})"


@register(_ranked(_VECTOR, "vec_id", 10))
def vector_topk(spark, sf_dir):
    return retrieval.vector_search(table(spark, sf_dir, "embeddings"), QUERY_VECTOR, 10, "vec_id", "embedding")


@register(_ranked(_VECTOR, "vec_id", 10, "WHERE label IN (1, 2)"))
def vector_prefilter(spark, sf_dir):
    return retrieval.vector_search(table(spark, sf_dir, "embeddings"), QUERY_VECTOR, 10, "vec_id", "embedding", "label IN (1, 2)")


@register(f"WITH r AS ({_ranked(_VECTOR, 'vec_id', 50)}) SELECT count(*) AS n_inversions FROM (SELECT score, lag(score) OVER (ORDER BY retrieval_rank) AS before FROM r) WHERE before < score")
def lag_order_check(spark, sf_dir):
    best = retrieval.vector_search(table(spark, sf_dir, "embeddings"), QUERY_VECTOR, 50, "vec_id", "embedding")
    before = F.lag("score").over(Window.orderBy("retrieval_rank"))
    return best.select("score", before.alias("before")).where("before < score").agg(F.count(F.lit(1)).alias("n_inversions"))


TEXT_QUERY = "apache license the"


def _bm25_sql(query: str) -> str:
    terms = ", ".join(f"('{t}')" for t in sorted(set(query.split())))
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents),
    q(term) AS (VALUES {terms}), s AS (SELECT count(*) AS n, avg(len(w)) AS al FROM d),
    tf AS (SELECT doc_id, len(w) AS dl, term, len(list_filter(w, lambda x: x = term)) AS tf FROM d, q),
    df AS (SELECT term, count(*) FILTER (WHERE tf > 0) AS df FROM tf GROUP BY term)
    SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / al))), 6) AS score
    FROM tf JOIN df USING (term), s GROUP BY doc_id HAVING max(tf) > 0"""


@register(_ranked(_bm25_sql(TEXT_QUERY), "doc_id", 20))
def bm25_topk(spark, sf_dir):
    return retrieval.full_text_search(table(spark, sf_dir, "documents"), TEXT_QUERY, 20, "doc_id", "text")


@register(
    f"""WITH a AS ({_ranked(_bm25_sql(TEXT_QUERY), "doc_id", 40)}), b AS ({_ranked(_bm25_sql("all rights reserved"), "doc_id", 40)}),
    f AS (SELECT doc_id, round(sum(1.0::DOUBLE / (60 + retrieval_rank)), 9) AS score FROM (SELECT doc_id, retrieval_rank FROM a UNION ALL SELECT doc_id, retrieval_rank FROM b) GROUP BY doc_id)
    {_ranked("SELECT * FROM f", "doc_id", 20)}"""
)
def hybrid_rrf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    a, b = (retrieval.full_text_search(docs, q, 40, "doc_id", "text") for q in (TEXT_QUERY, "all rights reserved"))
    return retrieval.hybrid(a, b, "doc_id", 20)


@register(
    """WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents),
    c AS (SELECT doc_id, ('0x' || substr(sha256(token), 1, 4))::BIGINT % 16 AS slot, count(*) AS n FROM t GROUP BY 1, 2)
    SELECT doc_id, slot, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 6) AS weight FROM c"""
)
def feature_hash(spark, sf_dir):
    return retrieval.feature_hash(table(spark, sf_dir, "documents"), "doc_id", "text", 16)


@register(
    f"""SELECT doc_id::VARCHAR AS canonical_identity, retrieval_rank, score AS semantic_score, source AS source_system, left(text, 40) AS evidence_preview, lang AS status, 'candidate' AS retrieval_outcome
    FROM ({_ranked(_bm25_sql(TEXT_QUERY), "doc_id", 10)}) JOIN documents USING (doc_id) WHERE lang = 'en'"""
)
def semantic_search_sql(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    catalog = docs.select(
        F.col("doc_id").cast("string").alias("canonical_identity"), F.col("source").alias("source_system"), text.preview(F.col("text"), 40).alias("evidence_preview"), F.col("lang").alias("status")
    )
    engine = Engine(spark, {"context_catalog": catalog}, retrieval=docs.select(F.col("doc_id").alias("context_identity"), "text"))
    return engine.sql(
        f"""SELECT s.canonical_identity, s.retrieval_rank, s.semantic_score, s.source_system, s.evidence_preview, s.status, s.retrieval_outcome
        FROM semantic_search('context_catalog', '{TEXT_QUERY}', 'full_text', 10) AS s WHERE s.status = 'en'"""
    )


# --- state and time --------------------------------------------------------------------------


@register("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def dedup_last(spark, sf_dir):
    return state.last_by(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id")


@register(
    """SELECT user_id, arg_max(value, event_id) FILTER (WHERE event_type = 'click') AS click_value, arg_max(ts, event_id) FILTER (WHERE value > 50) AS high_ts,
    arg_max(event_type, event_id) AS last_type FROM events GROUP BY user_id"""
)
def overlay_merge(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("value").alias("click_value"), F.col("ts").alias("high_ts"), F.col("event_type").alias("last_type"), "event_type", "value")
    return state.overlay(events, "user_id", "event_id", {"click_value": F.col("event_type") == "click", "high_ts": F.col("value") > 50, "last_type": F.lit(True)})


_AS_OF = "2024-01-15 00:00:00"
_INTERVALS = "SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_until FROM events"


@register(f"SELECT user_id, event_id, event_type FROM ({_INTERVALS}) WHERE ts <= TIMESTAMP '{_AS_OF}' AND (valid_until IS NULL OR valid_until > TIMESTAMP '{_AS_OF}')")
def asof_valid(spark, sf_dir):
    rows = state.intervals(table(spark, sf_dir, "events"), "user_id", "ts", "event_id")
    return state.valid_at(rows, "ts", "valid_until", F.expr(f"timestamp_ntz'{_AS_OF}'")).select("user_id", "event_id", "event_type")


@register(f"SELECT CASE WHEN ts > TIMESTAMP '{_AS_OF}' THEN 'future' WHEN valid_until <= TIMESTAMP '{_AS_OF}' THEN 'expired' ELSE 'valid' END AS status, count(*) AS n FROM ({_INTERVALS}) GROUP BY 1")
def asof_status(spark, sf_dir):
    rows = state.intervals(table(spark, sf_dir, "events"), "user_id", "ts", "event_id")
    status = state.temporal_status(F.col("ts"), F.col("valid_until"), F.expr(f"timestamp_ntz'{_AS_OF}'"))
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@register(
    """SELECT o_orderkey, 'before' AS version, o_orderdate - INTERVAL 60 DAY AS valid_from, o_orderdate AS valid_until, 'P' AS value FROM orders
    UNION ALL SELECT o_orderkey, 'after', o_orderdate, NULL, o_orderstatus FROM orders"""
)
def scd2_expand(spark, sf_dir):
    return state.expand_versions(table(spark, sf_dir, "orders"), "o_orderkey", F.expr("o_orderdate - INTERVAL 60 DAYS"), F.col("o_orderdate"), F.lit("P"), F.col("o_orderstatus"))


@register(
    """SELECT outcome, reason, count(*) AS n FROM (SELECT
      CASE WHEN l_discount IS NULL OR l_discount >= 0.09 THEN 'abstained' WHEN l_shipdate > TIMESTAMP '1995-06-17' THEN 'rejected' WHEN l_shipdate + INTERVAL 365 DAY <= TIMESTAMP '1995-06-17' THEN 'rejected' ELSE 'selected' END AS outcome,
      CASE WHEN l_discount IS NULL OR l_discount >= 0.09 THEN 'missing_authority' WHEN l_shipdate > TIMESTAMP '1995-06-17' THEN 'not_yet_effective' WHEN l_shipdate + INTERVAL 365 DAY <= TIMESTAMP '1995-06-17' THEN 'superseded' ELSE 'authoritative_at_as_of' END AS reason
    FROM lineitem) GROUP BY 1, 2"""
)
def authority_generic(spark, sf_dir):
    decided = resolve.generic_policy(F.col("l_discount") < 0.09, F.col("l_shipdate"), F.expr("l_shipdate + INTERVAL 365 DAYS"), F.expr("timestamp_ntz'1995-06-17 00:00:00'"))
    return table(spark, sf_dir, "lineitem").select(decided.alias("d")).groupBy("d.outcome", "d.reason").agg(F.count("*").alias("n"))


@register(
    """WITH g AS (SELECT l_orderkey, count(DISTINCT l_suppkey) AS issuers, min(l_shipdate) AS a, max(l_shipdate) AS z, max(l_discount) < 0.09 AS ok FROM lineitem GROUP BY l_orderkey)
    SELECT CASE WHEN issuers > 1 THEN 'conflict' WHEN ok AND a <= TIMESTAMP '1995-06-17' AND z > TIMESTAMP '1995-06-17' THEN 'selected' WHEN NOT ok THEN 'abstained' ELSE 'rejected' END AS outcome, count(*) AS n FROM g GROUP BY 1"""
)
def authority_conflict(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count_distinct("l_suppkey").alias("issuers"), F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("z"), (F.max("l_discount") < 0.09).alias("ok")
    )
    outcome = resolve.conflict_policy(F.col("issuers"), F.col("ok"), F.col("a"), F.col("z"), F.expr("timestamp_ntz'1995-06-17 00:00:00'"))
    return g.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@register(
    """WITH RECURSIVE o AS (SELECT l_orderkey AS g, l_linenumber AS item, l_quantity::BIGINT AS cost, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS rn FROM lineitem),
    f AS (SELECT g, 0::BIGINT AS rn, 0::BIGINT AS total, '' AS items FROM (SELECT DISTINCT g FROM o)
      UNION ALL SELECT o.g, o.rn, CASE WHEN f.total + o.cost <= 60 THEN f.total + o.cost ELSE f.total END,
        CASE WHEN f.total + o.cost <= 60 THEN CASE WHEN f.items = '' THEN o.item::VARCHAR ELSE f.items || ',' || o.item END ELSE f.items END
      FROM f JOIN o ON o.g = f.g AND o.rn = f.rn + 1)
    SELECT g AS l_orderkey, arg_max(total, rn) AS total, arg_max(items, rn) AS items FROM f GROUP BY g"""
)
def budget_pack(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("_q", F.col("l_quantity"))
    return state.pack(rows, "l_orderkey", ["l_linenumber", "l_partkey", "_q"], "l_linenumber", "l_quantity", 60)


@register(
    """WITH RECURSIVE o AS (SELECT l_suppkey AS g, l_quantity::BIGINT AS cost, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn FROM lineitem),
    f AS (SELECT g, 0::BIGINT AS rn, 0::BIGINT AS batches, 500::BIGINT AS used FROM (SELECT DISTINCT g FROM o)
      UNION ALL SELECT o.g, o.rn, CASE WHEN f.used + o.cost > 500 THEN f.batches + 1 ELSE f.batches END, CASE WHEN f.used + o.cost > 500 THEN o.cost ELSE f.used + o.cost END
      FROM f JOIN o ON o.g = f.g AND o.rn = f.rn + 1)
    SELECT g AS l_suppkey, arg_max(batches, rn) AS batches, arg_max(used, rn) AS last_used FROM f GROUP BY g"""
)
def next_fit_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("_q", F.col("l_quantity"))
    return state.next_fit(rows, "l_suppkey", ["l_orderkey", "l_linenumber", "_q"], "l_quantity", 500)


@register(
    """WITH p AS (SELECT o_orderkey, any_value(o_orderpriority) AS consumer, count(*) AS n_items, sum(l_quantity)::BIGINT AS n_tokens, bool_or(l_returnflag = 'R') AS sup, bool_and(l_discount > 0) AS auth
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey),
    v AS (SELECT *, array_to_string(list_filter([
      CASE WHEN consumer NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'unauthorized_consumer' END, CASE WHEN n_items > 6 THEN 'max_items_exceeded' END,
      CASE WHEN n_tokens > 150 THEN 'max_tokens_exceeded' END, CASE WHEN sup THEN 'superseded_evidence_rejected' END], lambda x: x IS NOT NULL), ',') AS violated FROM p)
    SELECT violated, CASE WHEN violated <> '' THEN 'deny' WHEN NOT auth THEN 'abstain' ELSE 'allow' END AS decision, count(*) AS n FROM v GROUP BY 1, 2"""
)
def contract_decide(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    packages = joined.groupBy("o_orderkey").agg(
        F.any_value("o_orderpriority").alias("consumer"), F.count("*").alias("n_items"), F.sum("l_quantity").cast("long").alias("n_tokens"),
        F.bool_or(F.col("l_returnflag") == "R").alias("any_superseded"), F.bool_and(F.col("l_discount") > 0).alias("authority_ok"),
    ).select("*", F.lit("t").alias("task"), F.lit("p").alias("purpose"), F.lit(0).alias("n_bytes"), F.lit(0).alias("n_uncited"), F.lit(False).alias("any_expired"))
    contract = resolve.Contract(consumers=("1-URGENT", "2-HIGH", "3-MEDIUM"), max_items=6, max_tokens=150, authority_level="verified")
    decided = resolve.evaluate(packages, contract)
    return decided.groupBy(F.array_join("violated_rules", ",").alias("violated"), "decision").agg(F.count("*").alias("n"))


# --- integrity, capture, graphs ----------------------------------------------------------------


@register("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AND o_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def orphan_check(spark, sf_dir):
    solvent = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return resolve.orphans(table(spark, sf_dir, "orders"), "o_custkey", (solvent, "c_custkey"), (table(spark, sf_dir, "supplier"), "s_suppkey"))


@register("SELECT sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (WHERE doc_id IS NULL), 0)::BIGINT AS blanks, count(*) FILTER (WHERE n > 1 AND doc_id IS NOT NULL) AS duplicates FROM (SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM labels) GROUP BY doc_id)")
def pk_check(spark, sf_dir):
    return resolve.key_report(table(spark, sf_dir, "documents").select("doc_id").unionByName(table(spark, sf_dir, "labels").select("doc_id")), "doc_id")


@register("SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey WHERE coalesce(n, 0) <> 1")
def one_binding(spark, sf_dir):
    return resolve.not_exactly_one(table(spark, sf_dir, "customer"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey")


_HALF = "2024-01-16 00:00:00"
_VERSION = "SELECT concat_ws('-', user_id, event_type, floor(value / 10)::INT) AS k, count(*) AS v FROM events WHERE ts {} TIMESTAMP '" + _HALF + "' GROUP BY 1"
_OLD, _NEW = _VERSION.format("<"), _VERSION.format(">=")


def _versions(spark, sf_dir):
    """Two versions of a relation: how often a user had an event of a kind and size, in the first and in the second half of the month."""
    events = table(spark, sf_dir, "events").withColumn("k", F.concat_ws("-", "user_id", "event_type", F.floor(F.col("value") / 10).cast("int")))
    return [events.where(f"ts {op} timestamp_ntz'{_HALF}'").groupBy("k").agg(F.count(F.lit(1)).alias("v")) for op in ("<", ">=")]


@register(
    f"""SELECT k, CASE WHEN n.v IS NULL THEN 'deleted' WHEN o.v IS NULL THEN 'inserted' WHEN o.v = n.v THEN 'reused' ELSE 'changed' END AS change_type, coalesce(n.v, o.v) AS v
    FROM ({_OLD}) o FULL JOIN ({_NEW}) n USING (k)"""
)
def cdc_diff(spark, sf_dir):
    return state.changes(*_versions(spark, sf_dir), "k", "v")


@register(f"SELECT k, coalesce(n.v, o.v) AS v FROM ({_OLD}) o FULL JOIN ({_NEW}) n USING (k)")
def merge_state(spark, sf_dir):
    return state.merged(*_versions(spark, sf_dir), "k")


@register(
    """WITH RECURSIVE e AS (SELECT conv_id * 1000 + turn AS a, conv_id * 1000 + turn + 1 AS b FROM conversations),
    c AS (SELECT conv_id * 1000 AS node FROM conversations WHERE turn = 0 UNION SELECT b FROM c JOIN e ON e.a = c.node)
    SELECT node::BIGINT AS node FROM c"""
)
def closure_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    edges = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("a"), (F.col("conv_id") * 1000 + F.col("turn") + 1).alias("b"))
    return state.closure(turns.where("turn = 0").select((F.col("conv_id") * 1000).alias("node")), edges, "a", "b")


# --- scalar functions and metrics ----------------------------------------------------------------


@register("SELECT doc_id, 'sha256:' || sha256(to_json(text)::VARCHAR) AS identity FROM documents")
def identity_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", identity.string_identity(F.col("text")).alias("identity"))


@register("SELECT doc_id, left(text, 96) AS preview, 'ctx:docs:' || left('sha256:' || sha256(to_json(text)::VARCHAR), 12) AS unit FROM documents")
def preview_and_unit(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.preview(F.col("text"), 96).alias("preview"), identity.context_unit_id("docs", identity.string_identity(F.col("text"))).alias("unit"))


_RULES = [("license", ("licensed under", "all rights reserved")), ("secret", ("token", "password")), ("contact", ("@",))]


@register(
    """SELECT CASE WHEN lower(text) LIKE '%licensed under%' OR lower(text) LIKE '%all rights reserved%' THEN 'license' WHEN lower(text) LIKE '%token%' OR lower(text) LIKE '%password%' THEN 'secret'
    WHEN lower(text) LIKE '%@%' THEN 'contact' ELSE 'other' END AS label, count(*) AS n, round(avg(quality), 6) AS quality FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1"""
)
def classify_metrics(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy(text.classify(F.col("text"), _RULES).alias("label")).agg(F.count("*").alias("n"), F.round(F.avg("quality"), 6).alias("quality"))


@register(
    f"""WITH r AS ({_ranked(_VECTOR, "vec_id", 100)}), m AS (SELECT label, min(retrieval_rank) AS first FROM r GROUP BY label)
    SELECT round(avg((first = 0)::INT), 6) AS recall_1, round(avg((first < 3)::INT), 6) AS recall_3, round(avg(1.0::DOUBLE / (first + 1)), 6) AS mrr FROM m"""
)
def recall_mrr(spark, sf_dir):
    best = retrieval.vector_search(table(spark, sf_dir, "embeddings"), QUERY_VECTOR, 100, "vec_id", "embedding")
    relevant = best.select(F.col("label").alias("query"), F.col("vec_id").alias("item"), F.lit("all").alias("slice"))
    hits = best.select(F.col("label").alias("query"), F.col("vec_id").alias("item"), "retrieval_rank")
    return metrics.retrieval(hits, relevant, "query", "item", "slice").drop("slice")


@register(
    """WITH l AS (SELECT doc_id, trim(regexp_replace(regexp_replace(lower(coalesce(regexp_extract(text, '(CC BY[A-Z0-9. -]*|Apache License)', 1), '')), '[-_]', ' ', 'g'), ' +', ' ', 'g')) AS w FROM documents)
    SELECT doc_id, (w = 'cc by' OR w LIKE 'cc by %' OR w = 'apache' OR w LIKE 'apache %') AND NOT list_has_any(string_split(w, ' '), ['nc', 'nd', 'sa']) AS allowed FROM l"""
)
def licence_gate(spark, sf_dir):
    found = F.regexp_extract(F.col("text"), "(CC BY[A-Z0-9. -]*|Apache License)", 1)
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(text.licence_allowed(found, ("cc by", "apache")), F.lit(False)).alias("allowed"))


@register("SELECT o_orderkey, try_strptime(nullif(regexp_extract(concat('rev-', strftime(o_orderdate, '%Y%m%d'), '-', o_orderstatus), '([0-9]{8})', 1), ''), '%Y%m%d') AS effective FROM orders")
def date_parse(spark, sf_dir):
    revision = F.concat(F.lit("rev-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"), F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.parse_revision_date(revision).alias("effective"))


# --- relations, lifecycle, evaluation ---------------------------------------------------------------


def _sha(json_text: str) -> str:
    return f"'sha256:' || sha256({json_text})"


def _lifecycle_inputs(spark, sf_dir):
    """Customers as observations; orders as outputs derived from them (the sources of those of low priority are lacking)."""
    seen = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("snapshot_identity"), F.lit("crm").alias("source_system"), F.col("c_custkey").cast("string").alias("source_key"),
        F.lit("customer").alias("snapshot_role"), F.lit("customer").alias("object_role"), F.col("c_name").alias("preview"),
    )
    made = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("identity"), F.lit("order").alias("role"), F.lit("summary").alias("kind"), F.lit("active").alias("status"),
        F.array(F.concat(F.when(F.col("o_orderpriority") == "5-LOW", "x").otherwise("c"), F.col("o_custkey"))).alias("derived_from"), F.col("o_orderpriority").alias("text"),
    )
    return seen, made


@register(
    """SELECT canonical_identity, object_kind, physical_relation, preview FROM (
      SELECT 'c' || c_custkey AS canonical_identity, 'customer' AS object_kind, 'context_snapshots' AS physical_relation, c_name AS preview FROM customer
      UNION ALL SELECT 'o' || o_orderkey, 'summary', 'context_outputs', o_orderpriority FROM orders)"""
)
def catalog_build(spark, sf_dir):
    made = relations.materialize(spark, {"context_model_id": "m"}, *_lifecycle_inputs(spark, sf_dir))
    return made["context_catalog"].select("canonical_identity", "object_kind", "physical_relation", "preview")


_EDGES = "SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'x' ELSE 'c' END || o_custkey AS a, 'o' || o_orderkey AS b FROM orders"


@register(f"""SELECT {_sha("'{\"source\":\"' || a || '\",\"target\":\"' || b || '\",\"type\":\"derived_from\"}'")} AS edge_identity, a AS source_node_id, b AS target_node_id FROM ({_EDGES})""")
def lineage_edges_build(spark, sf_dir):
    return relations.derived_edges(_lifecycle_inputs(spark, sf_dir)[1]).select("edge_identity", "source_node_id", "target_node_id")


@register(
    f"""WITH known AS (SELECT 'c' || c_custkey AS n FROM customer UNION SELECT 'o' || o_orderkey FROM orders), ends AS (SELECT a AS n FROM ({_EDGES}) UNION SELECT b FROM ({_EDGES}))
    SELECT kind, count(*) AS n FROM (SELECT n, 'context' AS kind FROM known UNION ALL SELECT n, 'referenced' FROM ends WHERE n NOT IN (SELECT n FROM known)) GROUP BY kind"""
)
def lineage_nodes_build(spark, sf_dir):
    made = relations.materialize(spark, {"context_model_id": "m"}, *_lifecycle_inputs(spark, sf_dir))
    return made["lineage_nodes"].groupBy(F.col("node_kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@register(
    """WITH l AS (SELECT l_orderkey, l_linenumber, max(l_linestatus) AS s FROM lineitem GROUP BY 1, 2)
    SELECT 'reference:candidate_context' AS "check", count(DISTINCT l_orderkey) AS n_failed FROM l WHERE l_linenumber < 7 AND s = 'F' HAVING count(*) > 0
    UNION ALL SELECT 'reference:decision_candidate', count(*) FROM l WHERE l_linenumber >= 7 HAVING count(*) > 0"""
)
def conformance_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_linestatus").alias("s"))
    candidate = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("candidate_identity")
    context = F.concat(F.when(F.col("s") == "F", "none").otherwise("o"), F.col("l_orderkey")).alias("context_identity")
    made = relations.materialize(
        spark, {"context_model_id": "m", "context_model_identity": "m1"}, *_lifecycle_inputs(spark, sf_dir),
        resolution_candidates=lines.where("l_linenumber < 7").select(candidate, context),
        resolution_decisions=lines.select(F.concat(F.lit("d"), F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("decision_identity"), candidate, F.lit("selected").alias("outcome")),
    )
    return relations.conformance(spark, made).where("NOT passed").select("check", "n_failed")


@register(
    """WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber < 6), p AS (SELECT l_orderkey, count(*) AS n FROM d GROUP BY l_orderkey)
    SELECT decision, count(*) AS packages, sum(n)::BIGINT AS items FROM (SELECT n, CASE WHEN n > 4 THEN 'deny' ELSE 'allow' END AS decision FROM p) GROUP BY decision"""
)
def package_publication(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    outcome = F.when(F.col("l_linenumber") < 6, "selected").otherwise("rejected")
    candidates = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("candidate_identity"), F.col("l_orderkey").cast("string").alias("request_identity"),
        F.concat(F.lit("o"), F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("context_identity"), F.struct(outcome.alias("outcome"), F.lit("rule").alias("reason")).alias("d"),
    )
    packages, items = lifecycle.default_packages(lifecycle.decision_rows(candidates))
    outputs = lines.select(F.concat(F.lit("o"), F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("identity"), F.lit("active").alias("status"))
    decided = resolve.evaluate(lifecycle.measured(packages, items, outputs, "c", "t", "p", None), resolve.Contract(max_items=4))
    return decided.groupBy("decision").agg(F.count(F.lit(1)).alias("packages"), F.sum("n_items").alias("items"))


@register("SELECT doc_id::VARCHAR AS identity, 'succeeded' AS status, round(list_sum(list_transform(range(8), lambda i: round(('0x' || substr(sha256(text), 2 * i + 1, 2))::INT / 255, 6))), 6) AS total FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id::VARCHAR, 'skipped', NULL FROM documents WHERE text IS NULL")
def enrich_digest(spark, sf_dir):
    done = enrich.enrich(table(spark, sf_dir, "documents"), "doc_id", "text", enrich.DigestEmbedding(8))
    total = F.aggregate(F.from_json("value_json", "array<double>"), F.lit(0.0), lambda a, x: a + x)
    return done.select("identity", "status", F.round(total, 6).alias("total"))


@register("SELECT o_orderkey, o_shippriority AS size FROM (SELECT o_orderkey, 1 + o_orderkey % 7 AS o_shippriority, sum(1 + o_orderkey % 7) OVER (ORDER BY o_orderkey) AS run FROM orders) WHERE run <= 5000")
def budget_prefix(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (1 + F.col("o_orderkey") % 7).alias("size"))
    return readers.affordable(rows, "o_orderkey", "size", 5000)


@register("SELECT doc_id, CASE WHEN b IS NULL THEN 'invalidated' WHEN a IS NULL THEN 'created' ELSE 'reused' END AS change FROM (SELECT doc_id, 1 AS a FROM documents) FULL JOIN (SELECT DISTINCT doc_id + 100 AS doc_id, 1 AS b FROM labels) USING (doc_id)")
def mutation_sets(spark, sf_dir):
    after = table(spark, sf_dir, "labels").select((F.col("doc_id") + 100).alias("doc_id"))
    return metrics.identity_sets(table(spark, sf_dir, "documents"), after, "doc_id")


@register(
    """SELECT round(avg(CASE WHEN quality = 1 THEN (source IS NOT NULL AND source LIKE '%1')::INT END), 6) AS accuracy, coalesce(bool_or(quality = 0 AND source IS NOT NULL), FALSE) AS no_answer_false_positive
    FROM labels LEFT JOIN documents USING (doc_id)"""
)
def answer_metrics(spark, sf_dir):
    judgments = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 0).alias("no_answer"), F.array(F.lit("1")).alias("labels"))
    predictions = table(spark, sf_dir, "documents").select("doc_id", F.substring("source", -1, 1).alias("prediction"))
    return metrics.answers(judgments, predictions, "doc_id")


@register("SELECT lacks, count(*) AS n FROM (SELECT array_to_string(list_filter([CASE WHEN trim(coalesce(lang, '')) = '' THEN 'lang' END, CASE WHEN trim(coalesce(text, '')) = '' THEN 'text' END], lambda x: x IS NOT NULL), ',') AS lacks FROM documents) GROUP BY lacks")
def record_admission(spark, sf_dir):
    good, issues = store.admitted(table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") >= 0, F.col("lang")).alias("lang"), "text"), ["lang", "text"])
    counted = good.select(F.lit("").alias("lacks")).unionByName(issues.select(F.array_join("missing_concepts", ",").alias("lacks")))
    return counted.groupBy("lacks").agg(F.count(F.lit(1)).alias("n"))


from . import queries_evaluation, queries_lifecycle, queries_plans, queries_retrieval, queries_scale, queries_sources  # noqa: E402, F401 (they register themselves)
