"""Execution of derivation plans, the rows they publish, and the run packages that record them.

A plan's nodes are a frame (output_identity, operation, input_identities); so are the texts
that semantic operations read.  All nodes of an operation run at once over Arrow batches,
each output is published at most once, and what fails is an outcome of its own row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import struct_identity
from ..functions.schema import violation
from ..functions.text import blank
from ..operators import enrich
from ..sources.relations import publish
from .lineage import settle
from .manifest import Plan

# Operations with one of these beginnings ask a port.
SEMANTIC = ("embedding", "enrichment")


def plan_nodes(spark: SparkSession, plan: Plan) -> DataFrame:
    """The nodes of a plan that the driver made."""
    return spark.createDataFrame([(d.output, d.operation, list(d.inputs)) for d in plan.run], "output_identity string, operation string, input_identities array<string>")


@dataclass(frozen=True)
class Execution:
    """outcomes (identity, outcome, attempts, failure), store (identity, value_json), published, lineage and failures."""

    outcomes: DataFrame
    store: DataFrame
    published: DataFrame
    lineage: DataFrame
    failures: DataFrame


def execute(
    nodes: DataFrame, inputs: DataFrame, ports: Mapping[str, enrich.Port], store: DataFrame, reused: DataFrame | None = None, schemas: Mapping[str, Mapping] | None = None,
    attempts: int = 3, pause: float = 0.0,
) -> Execution:
    """Runs the planned nodes.

    ``inputs`` are (identity, text), read by semantic nodes through their first input; a node
    without its content, or an operation without its port, raises ValueError before anything
    runs.  Values that break the schema of their operation are ``malformed_output``.  An output
    that the store has is left as it is.
    """
    kind = F.when(F.startswith("operation", F.lit(SEMANTIC[0])), SEMANTIC[0]).when(F.startswith("operation", F.lit(SEMANTIC[1])), SEMANTIC[1])
    first = nodes.withColumn("_kind", kind).withColumn("_input", F.try_element_at("input_identities", F.lit(1)))
    texts = inputs.select(F.col("identity").alias("_input"), F.col("text").alias("_text"), F.lit(True).alias("_there"))
    ready = settle(first.join(texts, "_input", "left"))
    lacking = ready.where("_kind IS NOT NULL AND (_there IS NULL OR _text IS NULL)").orderBy("output_identity").first()
    if lacking is not None:
        raise ValueError(f"missing_content: {lacking['output_identity']}")
    made = None
    for k in SEMANTIC:
        part = ready.where(F.col("_kind") == k)
        if k not in ports:
            if not part.isEmpty():
                raise ValueError(f"port_unavailable: {k}")
            continue
        done = enrich.enrich(part, "output_identity", "_text", ports[k], attempts=attempts, pause=pause)
        if schemas and k in schemas:
            wrong = violation(F.col("value_json"), schemas[k])
            done = done.withColumn("_wrong", wrong).withColumns({
                "outcome": F.when(F.col("_wrong").isNotNull(), "malformed_output").otherwise(F.col("outcome")),
                "value_json": F.when(F.col("_wrong").isNull(), F.col("value_json")),
            }).drop("_wrong")
        made = done if made is None else made.unionByName(done)
    plain_value = F.to_json(F.struct(F.col("input_identities").alias("inputs"), F.col("operation").alias("operation")))
    rest = ready.where("_kind IS NULL").select(F.col("output_identity").alias("identity"), plain_value.alias("value_json"), F.lit("succeeded").alias("outcome"), F.lit(1).alias("attempts"))
    every = rest if made is None else rest.unionByName(made.select("identity", "value_json", "outcome", "attempts"))
    every = settle(every)
    good = every.where("outcome = 'succeeded'")
    after = publish(store, good.select("identity", "value_json").join(store.select("identity"), "identity", "left_anti"), "identity", "value_json")
    published = good.select("identity").join(store.select("identity"), "identity", "left_anti")
    outcomes = every.select("identity", F.when(F.col("outcome") == "succeeded", "published").otherwise(F.col("outcome")).alias("outcome"), "attempts", F.when(F.col("outcome") != "succeeded", _failure()).alias("failure"))
    if reused is not None:
        outcomes = outcomes.unionByName(reused.select("identity", F.lit("reused").alias("outcome"), F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("failure")))
    lineage = ready.join(good.select(F.col("identity").alias("output_identity")), "output_identity", "left_semi").select(
        F.lit("derived_from").alias("edge_type"), "output_identity", F.explode("input_identities").alias("input_identity")
    )
    return Execution(outcomes, after, published, lineage, outcomes.where("failure IS NOT NULL").select("identity", F.col("failure").alias("category")))


def _failure():
    known = {o: enrich.failure_of(o) for o in enrich.OUTCOMES if o != "succeeded"}
    out = None
    for o, f in known.items():
        out = F.when(F.col("outcome") == o, f) if out is None else out.when(F.col("outcome") == o, f)
    return out.otherwise("provider_rejected")


def output_rows(nodes: DataFrame, done: Execution, package: str | None = None, items: DataFrame | None = None) -> DataFrame:
    """Context outputs of executed nodes, with their stored values, and a row for the package that was made of ``items``."""
    kind = F.when(F.startswith("operation", F.lit(SEMANTIC[0])) | F.startswith("operation", F.lit(SEMANTIC[1])), "semantic_derivation").otherwise("context_representation")
    status = done.outcomes.select(F.col("identity").alias("output_identity"), F.col("outcome").alias("status"))
    values = done.store.select(F.col("identity").alias("output_identity"), F.col("value_json").alias("value"))
    rows = nodes.join(status, "output_identity", "left").join(values, "output_identity", "left").select(
        F.col("output_identity").alias("identity"), F.col("operation").alias("role"), kind.alias("kind"), F.col("input_identities").alias("derived_from"),
        F.col("operation").alias("operation_name"), F.coalesce("status", F.lit("unknown")).alias("status"), "value",
    )
    if package is None:
        return rows
    listed = items.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "representation_identity"))), lambda x: x["representation_identity"]).alias("derived_from"))  # the items of one package
    own = listed.select(F.lit(package).alias("identity"), F.lit("context_package").alias("role"), F.lit("context_package").alias("kind"), "derived_from", F.lit("compile_package").alias("operation_name"), F.lit("published").alias("status"))
    return rows.unionByName(own, allowMissingColumns=True)


def candidate_rows(facts: DataFrame) -> DataFrame:
    """Resolution candidates of retrieval facts."""
    made = struct_identity(F.col("context_identity").alias("context_identity"), F.col("rank").alias("rank"))
    key = F.coalesce(F.nullif(F.trim("result_identity"), F.lit("")), made)
    return facts.select(
        key.alias("candidate_identity"), "context_identity", key.alias("retrieval_identity"), F.col("rank").cast("long").alias("retrieval_rank"), F.col("score").cast("double").alias("semantic_score")
    )


def context_items(spark: SparkSession, explicit: Sequence[tuple[str, str]] = (), required: Sequence[str] = (), derivations: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Items of a package in the order given: explicit (identity, role) ones, else the required ids, else one for each derivation (output, operation)."""
    operation = dict(derivations)
    rows = list(explicit) or [(r, operation.get(r, "required-context")) for r in required] or list(derivations)
    return spark.createDataFrame([(i, role, rank, 0) for rank, (i, role) in enumerate(rows)], "representation_identity string, role string, rank long, token_estimate long")


# --- lineage and run packages -------------------------------------------------------------------


def merged_lineage(run: str, *graphs: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of several graphs of one run, one row an identity; a row of another run, a self edge or an open end raises ValueError.

    Nodes have node_id and run_identity, edges edge_id, source_node_id, target_node_id and run_identity.
    """
    nodes, edges = graphs[0]
    for n, e in graphs[1:]:
        nodes, edges = nodes.unionByName(n, allowMissingColumns=True), edges.unionByName(e, allowMissingColumns=True)
    nodes, edges = settle(nodes.dropDuplicates(["node_id"])), settle(edges.dropDuplicates(["edge_id"]))
    foreign = nodes.where(~F.col("run_identity").eqNullSafe(F.lit(run))).select("node_id").unionByName(edges.where(~F.col("run_identity").eqNullSafe(F.lit(run))).select(F.col("edge_id").alias("node_id")))
    if (first := foreign.orderBy("node_id").first()) is not None:
        raise ValueError(f"{first[0]} belongs to another run")
    if (first := lineage_issues(nodes, edges).orderBy("edge_id").first()) is not None:
        raise ValueError(f"edge {first['edge_id']}: {first['issue']}")
    return nodes, edges


def lineage_issues(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(edge_id, issue) of edges from a node to itself and of edges with an end that is no node."""
    ends = edges.select("edge_id", F.explode(F.array("source_node_id", "target_node_id")).alias("node_id"))
    open_ = ends.join(nodes.select("node_id"), "node_id", "left_anti").select("edge_id", F.lit("open_end").alias("issue")).distinct()
    return edges.where(F.col("source_node_id") == F.col("target_node_id")).select("edge_id", F.lit("self_edge").alias("issue")).unionByName(open_)


def package_issues(run: str, index_run: str, artifacts: DataFrame, stages: DataFrame) -> DataFrame:
    """(subject, issue): repeated artifact ids, paths or stage ids, ids that stages use and none declares, an index of another run.

    ``artifacts`` are (identity, path), ``stages`` (stage_id, input_identities, output_identities).
    """
    repeated = lambda df, c, issue: df.groupBy(F.col(c).alias("subject")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("subject", F.lit(issue).alias("issue"))
    used = stages.select(F.explode(F.array_union("input_identities", "output_identities")).alias("subject")).distinct()
    unknown = used.join(artifacts.select(F.col("identity").alias("subject")), "subject", "left_anti").select("subject", F.lit("undeclared_artifact").alias("issue"))
    out = unknown.unionByName(repeated(artifacts, "identity", "repeated_identity")).unionByName(repeated(artifacts, "path", "repeated_path")).unionByName(repeated(stages, "stage_id", "repeated_stage"))
    if run != index_run:
        out = out.unionByName(artifacts.sparkSession.createDataFrame([(index_run, "other_run")], "subject string, issue string"))
    return out


@dataclass(frozen=True)
class Stage:
    """A step that reads the artifacts made so far and makes new ones, by name."""

    stage_id: str
    run: Callable[[Mapping[str, Any]], Mapping[str, Any]]
    needs: tuple[str, ...] = ()


def compose(stages: Iterable[Stage], given: Mapping[str, Any] | None = None) -> tuple[dict[str, Any], list[dict]]:
    """All artifacts and a record of each stage; repeated stage ids or artifact names and unmet needs raise ValueError.

    A stage sees every earlier artifact.  Artifacts may be DataFrames, which stay lazy.
    """
    artifacts, records, seen = dict(given or {}), [], set()
    for stage in stages:
        if stage.stage_id in seen:
            raise ValueError(f"repeated stage: {stage.stage_id}")
        seen.add(stage.stage_id)
        if unmet := [n for n in stage.needs if n not in artifacts]:
            raise ValueError(f"{stage.stage_id} needs {unmet}")
        made = dict(stage.run(dict(artifacts)))
        if again := sorted(set(made) & set(artifacts)):
            raise ValueError(f"{stage.stage_id} makes {again} again")
        artifacts |= made
        records.append({"stage_id": stage.stage_id, "inputs": sorted(stage.needs), "outputs": sorted(made)})
    return artifacts, records


def duplicate_identities(*registries: tuple[str, DataFrame]) -> DataFrame:
    """(identity, definitions): identities that more than one definition of the registries (name, frame of ref and identity) has."""
    rows = None
    for name, df in registries:
        part = df.where(~blank(F.col("identity"))).select("identity", F.concat_ws(":", F.lit(name), F.col("ref").cast("string")).alias("_d"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.distinct().groupBy("identity").agg(F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list("_d")).alias("definitions")).where("_n > 1").drop("_n")
