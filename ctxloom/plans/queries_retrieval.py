"""Queries of retrieval, its inputs, requests and candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ann, requests, retrieval, state
from .engine import Engine
from .lineage import scratch
from .library import _QV, _VECTOR, QUERY_VECTOR, TEXT_QUERY, _bm25_sql, _ranked
from .registry import register, table


def _joined(spark, sf_dir):
    """Texts with vectors: documents and embeddings of one id."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    return table(spark, sf_dir, "documents").join(vectors, "doc_id").select(F.col("doc_id").alias("context_identity"), "text", "vector", "lang")


_BOTH = f"""WITH d0 AS (SELECT doc_id, text, list_cosine_similarity(embedding::DOUBLE[], {_QV}) AS c FROM documents JOIN embeddings ON vec_id = doc_id),
    a AS ({_ranked("SELECT doc_id, round(c, 6) AS score FROM d0", "doc_id", 40)}),
    b AS ({_ranked(_bm25_sql(TEXT_QUERY).replace("FROM documents)", "FROM d0)"), "doc_id", 40)}),
    f AS (SELECT doc_id, round(sum(1.0::DOUBLE / (60 + retrieval_rank)), 9) AS score FROM (SELECT doc_id, retrieval_rank FROM a UNION ALL SELECT doc_id, retrieval_rank FROM b) GROUP BY doc_id)
    SELECT doc_id AS context_identity, score, retrieval_rank FROM ({_ranked("SELECT * FROM f", "doc_id", 10)})"""


@register(_BOTH.replace("SELECT doc_id AS context_identity, score, retrieval_rank", "SELECT doc_id::VARCHAR AS canonical_identity, score AS semantic_score, retrieval_rank"))
def hybrid_vector_text(spark, sf_dir):
    rows = _joined(spark, sf_dir)
    catalog = rows.select(F.col("context_identity").cast("string").alias("canonical_identity"))
    engine = Engine(spark, {"catalog": catalog}, rows, {"q": QUERY_VECTOR})
    return engine.semantic_search("catalog", TEXT_QUERY, "hybrid", 10, "q").select("canonical_identity", "semantic_score", "retrieval_rank")


@register(_ranked(_bm25_sql(TEXT_QUERY), "doc_id", 20))
def postings_topk(spark, sf_dir):
    """The same as bm25_topk, from a stored index."""
    index = retrieval.Postings.build(table(spark, sf_dir, "documents"), "doc_id", "text", scratch(spark, "postings"))
    return index.search(TEXT_QUERY, 20, "doc_id")


@register(_ranked(_VECTOR, "vec_id", 10))
def ann_search(spark, sf_dir):
    """All lists are probed, so the result is exact; recall with fewer probes is measured in the tests."""
    rows = table(spark, sf_dir, "embeddings")
    centres = ann.fit(rows, "embedding", 8)
    index = ann.build(rows, "embedding", centres, scratch(spark, "ann"))
    return ann.search(index, QUERY_VECTOR, 10, "vec_id", "embedding", centres, len(centres))


@register("SELECT 8::BIGINT AS lists, count(*) AS indexed, 0::BIGINT AS without_vector, (SELECT count(*) FROM benchmark) AS unindexed FROM embeddings")
def ann_facts(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    index = ann.build(rows, "embedding", ann.fit(rows, "embedding", 8), scratch(spark, "ann"))
    return ann.facts(index, table(spark, sf_dir, "benchmark"))


@register("SELECT 'context_retrieval' AS \"table\", 'full_text' AS mode, 'lang = ''en''' AS prefilter, 7 AS \"limit\", true AS planned")
def execution_facts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("context_identity"), "text", "lang")
    engine = Engine(spark, {"context_retrieval": rows, "catalog": rows.select(F.col("context_identity").alias("canonical_identity"))})
    engine.semantic_search("catalog", TEXT_QUERY, "full_text", 7, prefilter="lang = 'en'")
    f = engine.last_execution
    # the prefilter is part of the plan, below the ranking
    return spark.createDataFrame([(f["table"], f["mode"], f["prefilter"], f["limit"], "lang" in f["plan"])], "table string, mode string, prefilter string, limit int, planned boolean")


@register("SELECT '' AS canonical_identity, 0.0::DOUBLE AS semantic_score WHERE false")
def search_missing(spark, sf_dir):
    """Without a retrieval relation there are no facts and no error."""
    catalog = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("canonical_identity"))
    return Engine(spark, {"catalog": catalog}).sql("SELECT canonical_identity, semantic_score FROM semantic_search('catalog', 'apache', 'full_text', 5)")


@register(f"""SELECT count(*) AS n FROM ({_bm25_sql("the")}) JOIN documents USING (doc_id) WHERE source <> 'it''s'""")
def escaped_prefilter(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("context_identity"), "text", "source")
    engine = Engine(spark, {"catalog": rows.select(F.col("context_identity").alias("canonical_identity"))}, rows)
    return engine.sql("SELECT count(*) AS n FROM semantic_search('catalog', 'the', 'full_text', NULL, '', 'source <> ''it''''s''')")


@register("SELECT event_type, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY event_type")
def double_quoted(spark, sf_dir):
    return Engine(spark, {"events": table(spark, sf_dir, "events")}).sql('SELECT event_type, count(*) AS n FROM events WHERE event_type = "click" GROUP BY event_type')


@register(
    f"""SELECT doc_id::VARCHAR AS context_identity, score, retrieval_rank AS rank, 'sha256:' || sha256('{{"context":"' || doc_id || '","query":"q1"}}') AS result_identity, 'full_text' AS query_type
    FROM ({_ranked(_bm25_sql(TEXT_QUERY), "doc_id", 15)})"""
)
def fact_rows(spark, sf_dir):
    best = retrieval.full_text_search(table(spark, sf_dir, "documents"), TEXT_QUERY, 15, "doc_id", "text")
    facts = requests.fact_rows(best, "doc_id", "context_retrieval", "full_text", "q1")
    return facts.select("context_identity", "score", "rank", "result_identity", F.col("facts.query_type").alias("query_type"))


@register("SELECT l_orderkey, l_linenumber, round(coalesce(CASE WHEN l_returnflag = 'A' THEN l_discount END, 0 - l_tax), 6) AS score FROM lineitem")
def score_flip(spark, sf_dir):
    score = F.when(F.col("l_returnflag") == "A", F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(requests.similarity(score, F.col("l_tax")), 6).alias("score"))


# --- retrieval inputs and requests ----------------------------------------------------------------

_MANY = """WITH q AS (SELECT label AS query_id, arg_min(embedding, vec_id) AS v FROM embeddings GROUP BY label),
    s AS (SELECT query_id::VARCHAR AS query_id, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], v::DOUBLE[]), 6) AS score FROM embeddings, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) - 1 AS rank FROM s)
    SELECT query_id, vec_id, score, rank FROM r WHERE rank < 5"""


def _query_vectors(spark, sf_dir):
    first = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("v"))
    return sorted((str(r["label"]), list(map(float, r["v"]))) for r in first.collect())  # one query a label


@register(_MANY)
def many_queries(spark, sf_dir):
    return requests.many_vector_search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _query_vectors(spark, sf_dir), 5)


def _executed(spark, sf_dir):
    facts = many_queries(spark, sf_dir).select("query_id", F.col("vec_id").cast("string").alias("context_identity"), "score", "rank")
    inputs = spark.createDataFrame([(q, "messages", f"request-{int(q) // 2}", "2024-01-01T00:00:00Z", "triage") for q, _ in _query_vectors(spark, sf_dir)], "query_id string, retrieval_role string, request_identity string, as_of string, task_id string")
    return requests.executed(inputs, facts)


_CANDIDATE = """'sha256:' || sha256('{"context_identity":"' || vec_id || '","rank":' || rank || ',"request_identity":"request-' || (query_id::INT // 2) || '"}')"""


@register(
    f"""SELECT query_id, vec_id::VARCHAR AS context_identity, rank, {_CANDIDATE} AS candidate_identity, 'context:' || vec_id AS evidence_locator,
    'sha256:' || sha256('{{"context_identity":"' || vec_id || '","query_id":"' || query_id || '","rank":' || rank || ',"retrieval_role":"messages"}}') AS result_identity FROM ({_MANY})"""
)
def retrieval_inputs(spark, sf_dir):
    return _executed(spark, sf_dir).select("query_id", "context_identity", "rank", "candidate_identity", "evidence_locator", "result_identity")


@register(f"SELECT 'request-' || (query_id::INT // 2) AS request_identity, 'triage' AS task_id, 'messages' AS retrieval_role, count(*) AS n_candidates FROM ({_MANY}) GROUP BY ALL")
def request_grouping(spark, sf_dir):
    found, _ = requests.grouped_requests(_executed(spark, sf_dir))
    return found.select("request_identity", "task_id", "retrieval_role", "n_candidates")


@register("SELECT l_orderkey, 'sha256:' || sha256('{\"candidates\":' || to_json(list_sort(list(l_partkey::VARCHAR)))::VARCHAR || ',\"evidence\":' || to_json(list_sort(list(l_suppkey::VARCHAR)))::VARCHAR || '}') AS identity FROM lineitem GROUP BY l_orderkey")
def request_identity(spark, sf_dir):
    listed = lambda c: F.collect_list(F.col(c).cast("string"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(requests.order_free_identity(evidence=listed("l_suppkey"), candidates=listed("l_partkey")).alias("identity"))


@register("SELECT doc_id FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings) OR lang = 'fr'")
def retrieval_admission(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    rows = table(spark, sf_dir, "documents").join(vectors, "doc_id", "left").select("doc_id", F.col("doc_id").alias("context_identity"), "vector", (F.col("lang") == "fr").alias("materialize_retrieval"))
    return requests.admitted_rows(rows).select("doc_id")


@register(
    """WITH f AS (SELECT vec_id::VARCHAR AS c FROM embeddings), k AS (SELECT doc_id::VARCHAR AS c, 'known-' || doc_id AS id FROM labels)
    SELECT c AS context_identity, coalesce(id, 'sha256:' || sha256('{"candidate":"' || c || '"}')) AS candidate_identity FROM f LEFT JOIN k USING (c)"""
)
def candidate_merge(spark, sf_dir):
    facts = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("context_identity"), F.lit(0.5).alias("score"))
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("context_identity"), F.concat(F.lit("known-"), "doc_id").alias("candidate_identity"))
    return requests.merged_candidates(facts, known).select("context_identity", "candidate_identity")


@register("SELECT l_orderkey || '-' || l_linenumber AS candidate_identity, max(o_orderstatus) AS context_identity FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_linenumber")
def decision_context(spark, sf_dir):
    candidate = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("candidate_identity")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", candidate).distinct()
    known = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("candidate_identity", F.col("o_orderstatus").alias("context_identity"))
    return requests.with_context(lines.select("candidate_identity"), known)


_OUTCOME = "CASE l_returnflag WHEN 'A' THEN 'selected' WHEN 'R' THEN 'rejected' ELSE 'abstained' END"


def _decisions(spark, sf_dir):
    flag = F.col("l_returnflag")
    outcome = F.when(flag == "A", "selected").when(flag == "R", "rejected").otherwise("abstained")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("request_identity"), F.concat_ws("-", "l_linenumber", "l_partkey").alias("candidate_identity"), outcome.alias("outcome")
    )


def _listed(outcome: str) -> str:
    return f"coalesce(array_to_string(list_sort(list(c) FILTER (WHERE o = '{outcome}')), ','), '') AS {outcome}"


@register(f"SELECT l_orderkey AS request_identity, {', '.join(map(_listed, ('selected', 'rejected', 'abstained', 'conflict')))} FROM (SELECT l_orderkey, l_linenumber || '-' || l_partkey AS c, {_OUTCOME} AS o FROM lineitem) GROUP BY l_orderkey")
def outcome_groups(spark, sf_dir):
    grouped = requests.by_outcome(_decisions(spark, sf_dir))
    return grouped.select("request_identity", *[F.array_join(f"{o}_identities", ",").alias(o) for o in ("selected", "rejected", "abstained", "conflict")])


@register("SELECT role, array_to_string(list_sort(list(DISTINCT id)), ',') AS identities FROM (SELECT o_orderpriority AS role, o_orderstatus AS id FROM orders UNION ALL SELECT c_mktsegment, c_nationkey::VARCHAR FROM customer) GROUP BY role")
def role_identities(spark, sf_dir):
    found = requests.role_identities((table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus"), (table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey"))
    return found.select("role", F.array_join("identities", ",").alias("identities"))


@register("SELECT user_id, arg_min(event_id, event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def first_fact(spark, sf_dir):
    facts = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.col("event_id").alias("rank"))
    return requests.first_fact(facts, "user_id").drop("rank")


@register(
    """SELECT o_orderkey AS request_identity, 'o' || o_orderkey || '-' || k AS candidate_identity, k AS rank, CASE WHEN k = 0 THEN o_orderpriority END AS evidence
    FROM (SELECT o_orderkey, o_orderpriority, unnest(range(0, 3)) AS k FROM orders)"""
)
def resolution_replay(spark, sf_dir):
    candidate = lambda k: F.struct(
        F.concat(F.lit("o"), "o_orderkey", F.lit(f"-{k}")).alias("candidate_identity"), F.lit(f"c{k}").alias("context_identity"), F.lit(None).cast("string").alias("result_identity"),
        F.lit(0.5).alias("score"), F.lit(None).cast("long").alias("rank"),
    )
    records = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_identity"), F.lit("t").alias("task_id"), F.lit("2024-01-01").alias("as_of"), F.col("o_orderpriority").alias("evidence"), F.array(*map(candidate, range(3))).alias("candidates")
    )
    return requests.replayed(records).select("request_identity", "candidate_identity", "rank", "evidence")


@register("SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, p_partkey) - 1 AS place FROM part")
def work_order(spark, sf_dir):
    return requests.work_order(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", "p_partkey").select("p_partkey", "place")


@register(
    """WITH a AS (SELECT user_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_until, event_id FROM events)
    SELECT user_id, event_id, valid_from FROM a WHERE valid_from <= TIMESTAMP '2024-01-15' AND (valid_until IS NULL OR valid_until > TIMESTAMP '2024-01-15')"""
)
def asof_join(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    assertions = state.intervals(events, "user_id", "ts", "event_id").select("user_id", "event_id", F.col("ts").alias("valid_from"), "valid_until")
    joined = state.asof_intervals(events.select("user_id").distinct(), assertions, "user_id", F.expr("timestamp_ntz'2024-01-15 00:00:00'"), "valid_from", "valid_until")
    return joined.select("user_id", "event_id", "valid_from")


@register(
    """SELECT e.event_id, p.event_id AS last_error, p.value AS error_value FROM events e
    LEFT JOIN LATERAL (SELECT event_id, value FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'error' AND p.ts <= e.ts ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) p ON true"""
)
def asof_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    errors = events.where("event_type = 'error'").select("user_id", "ts", F.col("event_id").alias("last_error"), F.col("value").alias("error_value"))
    joined = state.asof_latest(events.select("event_id", "user_id", "ts"), errors, "user_id", "ts", "last_error", ["last_error", "error_value"])
    return joined.select("event_id", "last_error", "error_value")
