"""Retrieval inputs, resolution requests and their candidates, as frames.

A retrieval input is a query with a role and a task; running many of them gives facts, the
facts of one request become its candidates, and a policy decides on each.  All steps are
joins and aggregations on request, context or candidate ids.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import struct_identity
from ..functions.text import blank
from ..session import ship

#: Query vectors that one pass over the rows holds; more are run in blocks.
QUERIES = 1024


def utc(as_of: datetime.datetime) -> datetime.datetime:
    """The instant itself; a naive one, or one of another offset, raises ValueError."""
    if as_of.tzinfo is None or as_of.utcoffset() != datetime.timedelta(0):
        raise ValueError("as_of must be a UTC instant")
    return as_of


def many_vector_search(rows: DataFrame, id_col: str, vector_col: str, queries: list[tuple[str, list[float]]], limit: int) -> DataFrame:
    """(query_id, id, score, rank): the ``limit`` rows of largest cosine for each query, ties by id, zero vectors left out.

    A stated set of queries goes to all tasks in blocks of QUERIES; each task keeps its best
    rows of a query, so what is shuffled is bounded by queries x limit x tasks.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    ship(rows.sparkSession)
    out = None
    kind = dict(rows.dtypes)[id_col]
    for at in range(0, len(queries), QUERIES):
        block = queries[at : at + QUERIES]
        names = np.array([q for q, _ in block], object)
        vectors = np.array([v for _, v in block], np.float64)
        norms = np.linalg.norm(vectors, axis=1)

        def run(batches: Iterator[pa.RecordBatch], names=names, vectors=vectors, norms=norms) -> Iterator[pa.RecordBatch]:
            held: list[tuple] = []  # of each query the best so far: (score, id)
            best: list[list[tuple]] = [[] for _ in names]
            for batch in batches:
                ids, lists = batch.column(0), batch.column(1)
                width = vectors.shape[1]
                fits = [i for i, v in enumerate(lists.to_pylist()) if v is not None and len(v) == width and None not in v]
                if not fits:
                    continue
                taken = lists.take(pa.array(fits))
                m = taken.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(fits), width)
                size = np.linalg.norm(m, axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    scores = np.round((m @ vectors.T) / (size[:, None] * norms[None, :]), 6)
                own = ids.take(pa.array(fits)).to_pylist()
                order = np.argsort(np.array(own, object), kind="stable")
                for q in range(len(names)):
                    s = scores[order, q]
                    first = order[np.argsort(-s, kind="stable")][:limit]
                    best[q] = sorted([*best[q], *((-scores[i, q], own[i]) for i in first if np.isfinite(scores[i, q]))])[:limit]
            held = [(names[q], i, -s) for q, found in enumerate(best) for s, i in found]
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.string()), pa.array([h[1] for h in held], id_type), pa.array([float(h[2]) for h in held], pa.float64())], ["query_id", id_col, "score"])

        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(rows.schema[id_col].dataType)
        part = rows.select(id_col, vector_col).mapInArrow(run, f"query_id string, `{id_col}` {kind}, score double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.sparkSession.createDataFrame([], f"query_id string, `{id_col}` {kind}, score double")
    ranked = out.withColumn("rank", (F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(id_col))) - 1).cast("long"))
    return ranked.where(F.col("rank") < limit)


def executed(inputs: DataFrame | None, facts: DataFrame, keep: Sequence[str] = (), deal: bool = False) -> DataFrame:
    """Retrieval inputs with their facts: one row a fact, under deterministic result and candidate ids.

    ``inputs`` have query_id, retrieval_role and, optionally, request_identity, candidate_identity,
    evidence_locator and more; ``facts`` query_id, context_identity, score and rank.  An input's own
    candidate id is kept only where it has exactly one fact.  Further columns of the facts are kept by name.
    Without ``inputs`` each query has one, whose columns its facts carry.
    With ``deal`` the rows of a query are dealt to one task by ``_deal``, a hash of its id, while they
    are narrow; grouped by it and an id that tells the query, they move no more.  Facts without
    inputs may have been dealt by a ``_deal`` of their own, never null, that queries of one trimmed id share.  Inputs with
    request or candidate ids of their own are not dealt, as these don't tell the query.
    """
    given = facts if inputs is None else inputs
    if not given.where(blank(F.col("retrieval_role"))).isEmpty():
        raise ValueError("contract_invalid: a retrieval input needs a role")
    optional = lambda c: F.col(c) if c in given.columns else F.lit(None).cast("string")
    rank = F.col("rank").cast("long")
    joined = facts if inputs is None else inputs.join(facts.select("query_id", "context_identity", "score", "rank", *keep), "query_id")
    if "candidate_identity" in given.columns:
        joined = joined.join(facts.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")), "query_id")
    else:
        joined = joined.withColumn("_n", F.lit(None).cast("long"))  # only an own id asks for it
    if not deal or {"request_identity", "candidate_identity"} & set(given.columns):
        joined = joined.drop("_deal")
    elif "_deal" not in joined.columns:
        # trimmed, as in the id of a request
        joined = joined.withColumn("_deal", F.xxhash64(F.coalesce(F.trim(F.col("query_id").cast("string")), F.lit("")))).repartition("_deal")
    result = struct_identity(F.col("context_identity").alias("context_identity"), F.col("query_id").alias("query_id"), rank.alias("rank"), F.col("retrieval_role").alias("retrieval_role"))
    request = F.coalesce(optional("request_identity"), F.col("query_id"))
    candidate = struct_identity(F.col("context_identity").alias("context_identity"), rank.alias("rank"), request.alias("request_identity"))
    own = F.when((F.col("_n") == 1) & ~blank(optional("candidate_identity")), optional("candidate_identity"))
    made = {
        "result_identity": result, "retrieval_identity": result, "candidate_identity": F.coalesce(own, candidate), "rank": rank, "score": F.col("score").cast("double"),
        "evidence_locator": F.coalesce(optional("evidence_locator"), F.concat(F.lit("context:"), F.col("context_identity"))),
        "source_snapshot_id": F.coalesce(optional("source_snapshot_id"), F.col("context_identity")),
    }
    return joined.withColumns(made).drop("_n")


def fact_rows(ranked: DataFrame, id_col: str, relation: str, mode: str, query_id: str) -> DataFrame:
    """Ranked rows in the shape of retrieval facts."""
    of = F.create_map(F.lit("table"), F.lit(relation), F.lit("query_type"), F.lit(mode), F.lit("query_id"), F.lit(query_id))
    context = F.col(id_col).cast("string")
    result = struct_identity(context.alias("context"), F.lit(query_id).alias("query"))
    return ranked.select(result.alias("result_identity"), context.alias("context_identity"), F.col("score").cast("double").alias("score"), F.col("retrieval_rank").cast("long").alias("rank"), of.alias("facts"))


def similarity(score: Column | None, distance: Column | None) -> Column:
    """The score if there is one, else the negated distance: higher is better."""
    known = [c for c in (score, None if distance is None else -distance) if c is not None]
    return F.coalesce(*known, F.lit(0.0)).cast("double")


def admitted_rows(rows: DataFrame) -> DataFrame:
    """Rows that may be retrieved: those with a context and a vector, or marked ``materialize_retrieval``."""
    flag = F.coalesce(F.col("materialize_retrieval"), F.lit(False)) if "materialize_retrieval" in rows.columns else F.lit(False)
    return rows.where(~blank(F.col("context_identity")) & (F.col("vector").isNotNull() | flag))


def request_identity(rows: DataFrame) -> Column:
    """The id that a row names, else one of role, task, schema revision, instant and query."""
    optional = lambda c, other: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(other)) if c in rows.columns else F.lit(other)
    made = struct_identity(
        F.col("as_of").cast("string").alias("as_of"), optional("query_id", "").alias("query_identity"), F.col("retrieval_role").alias("retrieval_role"),
        F.col("task_id").alias("task_id"), optional("task_schema_revision", "1").alias("task_schema_revision"),
    )
    return F.coalesce(F.nullif(F.trim(F.col("request_identity")), F.lit("")), made) if "request_identity" in rows.columns else made


# What all rows of a request have in common.
COMMON = ("retrieval_role", "task_id", "task_schema_revision", "as_of")


def grouped_requests(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests, candidates) of retrieval rows; rows without a role are left out, mixed metadata in a request raise ValueError.

    The candidates stay rows, so a request of any number of them is no single row's load.
    """
    kept = rows.where(~blank(F.col("retrieval_role"))).withColumn("request_identity", request_identity(rows))
    if "task_schema_revision" not in kept.columns:
        kept = kept.withColumn("task_schema_revision", F.lit("1"))
    bare = blank(F.col("task_id")) | F.col("as_of").isNull() | blank(F.col("context_identity"))
    ends = [f(F.col(c).cast("string")).alias(f"{n}_{c}") for c in COMMON for n, f in (("a", F.min), ("z", F.max))]
    requests = kept.groupBy(*(c for c in kept.columns if c == "_deal"), "request_identity").agg(*ends, F.count(F.lit(1)).alias("n_candidates"), F.bool_or(bare).alias("bare"))
    mixed = F.lit(False)
    for c in COMMON:
        mixed = mixed | ~F.col(f"a_{c}").eqNullSafe(F.col(f"z_{c}"))
    from ..plans.lineage import settle

    requests = requests.withColumn("mixed", mixed)
    if "_deal" not in kept.columns:  # else they are grouped where they lie, and cheaper made again than written
        requests = settle(requests)
    # an id made of all that its rows have in common mixes nothing, so its rows are judged before they are dealt
    told = "_deal" in kept.columns and not {"request_identity", "task_schema_revision"} & set(rows.columns)
    judged = kept.where(bare).withColumn("bare", F.lit(True)) if told else requests.where("bare OR mixed")
    wrong = judged.select("request_identity", "bare").orderBy("request_identity").first()
    if wrong is not None:
        raise ValueError(f"contract_invalid: request {wrong['request_identity']} {'lacks task, instant or context' if wrong['bare'] else 'mixes metadata'}")
    given = F.nullif(F.trim(F.col("candidate_identity")), F.lit("")) if "candidate_identity" in kept.columns else F.lit(None).cast("string")
    rank = F.coalesce(F.col("rank").cast("long"), F.lit(0).cast("long")) if "rank" in kept.columns else F.lit(0).cast("long")
    made = struct_identity(F.col("context_identity").alias("context_identity"), rank.alias("rank"), F.col("request_identity").alias("request_identity"))
    candidates = kept.withColumn("candidate_identity", F.coalesce(given, made))
    return requests.select("request_identity", *[F.col(f"a_{c}").alias(c) for c in COMMON], "n_candidates"), candidates


def compiled_identity(request: DataFrame, candidates: DataFrame, model: str, retrieval: str, policy_role: str, policy: str, revision: str = "1") -> DataFrame:
    """(request_identity, compiled_identity): a hash that doesn't depend on the candidates' order.

    The candidates' ids enter as digests of their sorted values by a two-level tree, so that
    no row holds the ids of a large request: ids are hashed within 4096 parts, parts within the request.
    """
    part = F.pmod(F.xxhash64("candidate_identity"), F.lit(4096))
    parts = candidates.groupBy("request_identity", part.alias("_part")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("candidate_identity")), "\n"), 256).alias("_h"))
    whole = parts.groupBy("request_identity").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_part", "_h"))), lambda x: F.concat_ws(":", x["_part"].cast("string"), x["_h"])), "\n"), 256).alias("_all"))
    identity = struct_identity(
        F.col("as_of").alias("as_of"), F.col("_all").alias("candidates"), F.lit(model).alias("context_model_identity"), F.lit(policy).alias("policy_identity"), F.lit(revision).alias("policy_revision"),
        F.lit(policy_role).alias("policy_role"), F.lit(retrieval).alias("retrieval_identity"), F.col("retrieval_role").alias("retrieval_role"), F.col("task_id").alias("task_id"),
        F.col("task_schema_revision").alias("task_schema_revision"),
    )
    return request.join(whole, "request_identity", "left").select("request_identity", identity.alias("compiled_identity"))


def order_free_identity(**arrays: Column) -> Column:
    """``stable_identity`` of an object of lists of ids, each sorted first."""
    return struct_identity(*[F.array_sort(arrays[k]).alias(k) for k in sorted(arrays)])


def merged_candidates(facts: DataFrame, known: DataFrame) -> DataFrame:
    """A candidate for each fact: the known one of its context, of several the least, else a made one; the fact's score and rank hold.

    Repeated candidate ids raise ValueError.
    """
    first = known.groupBy("context_identity").agg(F.min("candidate_identity").alias("_known"))
    made = struct_identity(F.col("context_identity").alias("candidate"))
    out = facts.join(first, "context_identity", "left").withColumn("candidate_identity", F.coalesce("_known", made)).drop("_known")
    again = out.groupBy("candidate_identity").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("candidate_identity").first()
    if again is not None:
        raise ValueError(f"contract_invalid: repeated candidate {again[0]}")
    return out


def with_context(decisions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Decisions with the context of their candidate, where they name none themselves."""
    of = candidates.groupBy("candidate_identity").agg(F.min("context_identity").alias("_context"))
    own = F.nullif(F.trim(F.col("context_identity")), F.lit("")) if "context_identity" in decisions.columns else F.lit(None).cast("string")
    return decisions.join(of, "candidate_identity", "left").withColumn("context_identity", F.coalesce(own, F.col("_context"))).drop("_context")


def by_outcome(decisions: DataFrame, request: str = "request_identity") -> DataFrame:
    """Each request's candidates in four ordered lists by outcome."""
    listed = lambda o: F.array_sort(F.collect_list(F.when(F.col("outcome") == o, F.col("candidate_identity")))).alias(f"{o}_identities")
    return decisions.groupBy(request).agg(*[listed(o) for o in ("selected", "rejected", "abstained", "conflict")])


def check_decisions(requests: DataFrame, candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """(request_identity, candidate_identity, issue): candidates without exactly one decision, decisions on no candidate or another basis, conflicts without a set."""
    n = decisions.groupBy("request_identity", "candidate_identity").agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or((F.col("outcome") == "conflict") & F.col("conflict_set_id").isNull()).alias("_open"), F.min("as_of").alias("_a"), F.max("as_of").alias("_z")
    )
    both = candidates.select("request_identity", "candidate_identity", F.lit(True).alias("_c")).distinct().join(n, ["request_identity", "candidate_identity"], "full_outer")
    both = both.join(requests.select("request_identity", F.col("as_of").alias("_as_of")), "request_identity", "left")
    issue = (
        F.when(F.col("_c").isNull(), "unknown_candidate").when(F.coalesce(F.col("_n"), F.lit(0)) != 1, "not_one_decision")
        .when(F.col("_open"), "conflict_without_set").when((F.col("_a") != F.col("_as_of")) | (F.col("_z") != F.col("_as_of")), "other_basis")
    )
    return both.select("request_identity", "candidate_identity", issue.alias("issue")).where("issue IS NOT NULL")


def role_identities(*sources: tuple[DataFrame, str, str]) -> DataFrame:
    """(role, identities): the different ids of each role, in order, over (frame, role column, id column)."""
    pairs = None
    for df, role, key in sources:
        part = df.where(~blank(F.col(role)) & ~blank(F.col(key))).select(F.col(role).cast("string").alias("role"), F.col(key).cast("string").alias("_id"))
        pairs = part if pairs is None else pairs.unionByName(part)
    return pairs.groupBy("role").agg(F.array_sort(F.collect_set("_id")).alias("identities"))


def first_fact(facts: DataFrame, context: str = "context_identity", rank: str = "rank") -> DataFrame:
    """Of each context its fact of least rank."""
    rest = [c for c in facts.columns if c != context]
    return facts.groupBy(context).agg(F.min_by(F.struct(*rest), rank).alias("_f")).select(context, *[F.col(f"_f.{c}").alias(c) for c in rest])


def replayed(resolutions: DataFrame) -> DataFrame:
    """A retrieval row for each candidate of a resolution record, with the record's task and instant; shared evidence stands on its first row.

    Records have request_identity, task_id, as_of, evidence and ``candidates``, an array of
    (candidate_identity, context_identity, result_identity, score, rank).
    """
    one = resolutions.select("request_identity", "task_id", "as_of", "evidence", F.posexplode("candidates").alias("_i", "_c"))
    first = F.col("_i") == 0
    made = struct_identity(F.col("_i").cast("long").alias("rank"), F.col("_c.context_identity").alias("retrieval"))
    return one.select(
        "request_identity", "task_id", "as_of", F.col("_c.candidate_identity").alias("candidate_identity"), F.col("_c.context_identity").alias("context_identity"),
        F.coalesce(F.col("_c.result_identity"), made).alias("retrieval_identity"), F.coalesce(F.col("_c.score"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("_c.rank").cast("long"), F.col("_i").cast("long")).alias("rank"), F.when(first, F.col("evidence")).alias("evidence"),
    )


def work_order(items: DataFrame, priority: str, identity: str) -> DataFrame:
    """Items by falling priority, then by id, with their place."""
    from .state import placed

    return placed(items, [F.desc(priority), F.asc(identity)], "place")
