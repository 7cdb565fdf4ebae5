"""The standard context relations: their schemas, how they are built from input frames, and their conformance.

Inputs are frames of any size; every relation is one lazy plan.  Rows of equal keys are
settled by ``_seq`` (the last wins) if the input has it, so give one where order matters.
Columns beyond the declared ones are kept behind them.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import struct_identity
from ..functions.text import blank, preview

#: The columns by which a row names its model.
MODEL = ("context_model_id", "context_model_revision")

# The standard relations and their columns in the declared order.
RELATIONS = {
    "context_models": {
        "context_model_identity": "string", "context_model_id": "string", "context_model_revision": "string", "semantic_identity": "string",
        "title": "string", "status": "string", "manifest_json": "string",
    },
    "context_objects": {
        "object_identity": "string", "context_model_id": "string", "context_model_revision": "string", "object_role": "string",
        "object_kind": "string", "source_system": "string", "source_key": "string", "current_snapshot_identity": "string", "status": "string",
        "display_name": "string",
    },
    "context_snapshots": {
        "snapshot_identity": "string", "object_identity": "string", "context_model_id": "string", "context_model_revision": "string",
        "snapshot_role": "string", "source_system": "string", "source_key": "string", "observed_at": "string", "content_ref": "string",
        "content_sha256": "string", "media_type": "string", "byte_length": "bigint", "change_type": "string", "status": "string",
        "payload_json": "string",
    },
    "context_assertions": {
        "assertion_identity": "string", "context_model_id": "string", "context_model_revision": "string", "assertion_subject": "string",
        "assertion_type": "string", "evidence_identities": "array<string>", "status": "string", "value_json": "string",
    },
    "context_catalog": {
        "canonical_identity": "string", "display_name": "string", "context_model_id": "string", "context_model_revision": "string",
        "object_kind": "string", "schema_id": "string", "schema_revision": "string", "source_system": "string", "source_key": "string",
        "media_type": "string", "evidence_preview": "string", "preview": "string", "content_ref": "string", "operation_name": "string",
        "status": "string", "authority_status": "string", "temporal_status": "string", "policy_id": "string", "as_of": "string",
        "physical_relation": "string",
    },
    "context_outputs": {
        "identity": "string", "output_identity": "string", "context_model_id": "string", "context_model_revision": "string", "output_role": "string",
        "output_kind": "string", "status": "string", "value": "string", "value_json": "string", "payload_json": "string",
    },
    "context_retrieval": {
        "identity": "string", "context_identity": "string", "retrieval_identity": "string", "vector": "array<double>", "text": "string",
        "context_model_id": "string", "status": "string",
    },
    "authority_policies": {
        "policy_identity": "string", "context_model_id": "string", "context_model_revision": "string", "policy_role": "string",
        "target_role": "string", "policy_ref": "string", "settings_json": "string", "status": "string",
    },
    "context_contracts": {
        "contract_identity": "string", "context_model_id": "string", "context_model_revision": "string", "contract_id": "string",
        "contract_version": "string", "semantic_identity": "string", "rules_json": "string", "status": "string",
    },
    "context_package_contracts": {
        "binding_identity": "string", "package_identity": "string", "context_model_id": "string", "context_model_revision": "string",
        "contract_identity": "string", "contract_version": "string", "evaluation_identity": "string", "decision": "string",
    },
    "contract_evaluations": {
        "evaluation_identity": "string", "package_identity": "string", "context_model_id": "string", "context_model_revision": "string",
        "contract_identity": "string", "contract_version": "string", "decision": "string", "violated_rules": "array<string>",
        "explanation": "string", "evaluated_at": "string", "evaluator_identity": "string",
    },
    "resolution_decisions": {
        "decision_identity": "string", "context_model_id": "string", "context_model_revision": "string", "candidate_identity": "string",
        "outcome": "string", "reason_code": "string", "request_identity": "string", "resolution_identity": "string", "context_identity": "string",
        "selected_identity": "string",
    },
    "resolution_candidates": {
        "candidate_identity": "string", "context_model_id": "string", "context_model_revision": "string", "context_identity": "string",
        "retrieval_identity": "string", "semantic_score": "double", "retrieval_rank": "bigint", "request_identity": "string",
        "resolution_identity": "string", "task_id": "string",
    },
    "lineage_nodes": {
        "canonical_node_id": "string", "display_name": "string", "context_model_id": "string", "context_model_revision": "string",
        "node_kind": "string", "node_type": "string", "source_system": "string", "source_key": "string", "schema_id": "string",
        "schema_revision": "string", "operation_name": "string", "status": "string", "preview": "string", "content_ref": "string",
        "media_type": "string",
    },
    "lineage_edges": {
        "edge_identity": "string", "context_model_id": "string", "context_model_revision": "string", "source_node_id": "string",
        "target_node_id": "string", "edge_type": "string", "operation_identity": "string", "run_identity": "string",
    },
    "context_packages": {
        "package_identity": "string", "context_model_id": "string", "context_model_revision": "string", "task_id": "string",
        "package_kind": "string", "budget_tokens": "bigint", "metadata": "string",
    },
    "package_items": {
        "package_item_identity": "string", "package_identity": "string", "context_model_id": "string", "context_model_revision": "string",
        "representation_identity": "string", "role": "string", "rank": "bigint", "token_estimate": "bigint", "evidence_identities": "array<string>",
    },
}

# The key of each relation.
KEYS = {
    "context_models": "context_model_identity",
    "context_objects": "object_identity",
    "context_snapshots": "snapshot_identity",
    "context_assertions": "assertion_identity",
    "context_catalog": "canonical_identity",
    "context_outputs": "identity",
    "context_retrieval": "retrieval_identity",
    "authority_policies": "policy_identity",
    "context_contracts": "contract_identity",
    "context_package_contracts": "binding_identity",
    "contract_evaluations": "evaluation_identity",
    "resolution_decisions": "decision_identity",
    "resolution_candidates": "candidate_identity",
    "lineage_nodes": "canonical_node_id",
    "lineage_edges": "edge_identity",
    "context_packages": "package_identity",
    "package_items": "package_item_identity",
}


def fields(name: str) -> dict[str, str]:
    return RELATIONS[name]


def key_of(name: str) -> str:
    return KEYS[name]


def empty(spark: SparkSession, name: str) -> DataFrame:
    """No rows, as a plan of which the optimiser knows it, so what reads nothing else is left out."""
    return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in fields(name).items()]).where(F.lit(False))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Declared columns with their types first (null where absent), others after; one row a key.

    Each column is aggregated by itself, so a plan that reads some columns, or the key alone,
    shuffles no others; all go by the same order, so their values are those of one row.
    """
    declared = fields(name)
    extra = [c for c in df.columns if c not in declared and c not in ("_seq", "_deal")]
    key, order = key_of(name), F.col("_seq") if "_seq" in df.columns else F.lit(0)
    there = [_has(df, c, t).alias(c) for c, t in declared.items() if c in df.columns or c == key]
    rest = [c for c in [*declared, *extra] if c in df.columns and c != key]
    # rows of one key have one ``_deal``, by which they may already lie together
    keys = [*(c for c in df.columns if c == "_deal"), key]
    shaped = df.select(*keys[:-1], *there, *extra, order.alias("_seq"))
    best = shaped.groupBy(*keys).agg(*[F.max_by(c, "_seq").alias(c) for c in rest]) if rest else shaped.select(*keys).distinct()
    return best.select(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in declared.items()], *extra)


def _has(df: DataFrame, c: str, t: str = "string") -> Column:
    return (F.col(c) if c in df.columns else F.lit(None)).cast(t)


def _either(a: Column, b: Column) -> Column:
    """The first array unless it is null or empty, then the second, then none."""
    return F.when(F.size(a) > 0, a).otherwise(F.coalesce(b, F.array().cast("array<string>")))


def _id(**parts: Column) -> Column:
    """Identity of a flat object; names are put in order."""
    return struct_identity(*[parts[k].cast("string").alias(k) for k in sorted(parts)])


def catalog(snapshots: DataFrame, outputs: DataFrame) -> DataFrame:
    """Snapshots and outputs as catalog rows; of a snapshot and an output of one identity the output wins."""

    def rows(df: DataFrame, key: str, kind: Column, relation: str, later: int) -> DataFrame:
        wanted = [c for c in fields("context_catalog") if c not in ("canonical_identity", "object_kind", "preview", "evidence_preview", "physical_relation")]
        shown, evidence = _has(df, "preview"), _has(df, "evidence_preview")
        return df.select(
            F.col(key).alias("canonical_identity"), kind.alias("object_kind"), F.lit(relation).alias("physical_relation"),
            F.coalesce(shown, evidence).alias("preview"), F.coalesce(evidence, shown).alias("evidence_preview"),
            *[_has(df, c).alias(c) for c in wanted], F.struct(F.lit(later).alias("later"), _has(df, "_seq", "long").alias("seq")).alias("_seq"),
        )

    a = rows(snapshots, "snapshot_identity", _has(snapshots, "snapshot_role"), "context_snapshots", 0)
    return conform(a.unionByName(rows(outputs, "identity", _has(outputs, "kind"), "context_outputs", 1)), "context_catalog")


def derived_edges(outputs: DataFrame) -> DataFrame:
    """An edge from each source of an output (``derived_from``, else its inputs; an empty list counts as absent)."""
    sources = _either(_has(outputs, "derived_from", "array<string>"), _has(outputs, "input_identities", "array<string>"))
    pairs = outputs.select(F.explode(sources).alias("source_node_id"), F.col("identity").alias("target_node_id"), F.lit("derived_from").alias("edge_type"))
    return with_edge_identity(pairs)


def with_edge_identity(edges: DataFrame) -> DataFrame:
    return edges.withColumn("edge_identity", _id(source=F.col("source_node_id"), target=F.col("target_node_id"), type=F.col("edge_type")))


def items_of(packages: DataFrame) -> DataFrame:
    """One row for each element of ``items``, with its place in the package as rank where it carries none."""
    parts = packages.select("package_identity", F.posexplode("items").alias("_i", "_item")).select("package_identity", "_i", "_item.*")
    rank = F.coalesce(_has(parts, "rank", "long"), F.col("_i").cast("long"))
    item = _has(parts, "representation_identity")
    return parts.withColumn("rank", rank).withColumn("package_item_identity", _id(package=F.col("package_identity"), index=F.col("_i"), item=item)).drop("_i")


def lifecycle_edges(decisions: DataFrame, items: DataFrame, evaluations: DataFrame) -> DataFrame:
    """context -> decision, item -> package, package -> evaluation, contract -> evaluation."""
    edge = lambda df, a, b, t: df.where(~blank(F.col(a)) & ~blank(F.col(b))).select(F.col(a).alias("source_node_id"), F.col(b).alias("target_node_id"), t.alias("edge_type"))
    kind = F.when(F.col("outcome") == "selected", "selected_by_resolution").otherwise("evaluated_by_resolution")
    parts = [
        edge(decisions, "context_identity", "decision_identity", kind),
        edge(items, "representation_identity", "package_identity", F.lit("included_in_package")),
        edge(evaluations, "package_identity", "evaluation_identity", F.lit("evaluated_by_contract")),
        edge(evaluations, "contract_identity", "evaluation_identity", F.lit("applied_contract")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return with_edge_identity(out)


def nodes(edges: DataFrame, *sources: tuple[DataFrame, str, str]) -> DataFrame:
    """A node for each row of (frame, key, kind), of several of one key the last source's; a ``referenced`` stub for each edge end that none of them has.

    Stubs come before all sources, so one aggregation settles them too; the kind follows from the place.
    """
    shown = [c for c in fields("lineage_nodes") if c not in ("canonical_node_id", "node_kind")]
    known = edges.select(F.explode(F.array("source_node_id", "target_node_id")).alias("canonical_node_id"), *[F.lit(None).cast("string").alias(c) for c in shown], F.lit(0).alias("_place"))
    for place, (df, key, _) in enumerate(sources, 1):
        known = known.unionByName(df.select(F.col(key).cast("string").alias("canonical_node_id"), *[_has(df, c).alias(c) for c in shown], F.lit(place).alias("_place")))
    best = known.groupBy("canonical_node_id").agg(F.max("_place").alias("_place"), *[F.max_by(c, "_place").alias(c) for c in shown])
    kinds = F.array(F.lit("referenced"), *[F.lit(kind) for _, _, kind in sources])
    return best.withColumn("node_kind", kinds[F.col("_place")]).select(*fields("lineage_nodes"))


def materialize(spark: SparkSession, model: Mapping[str, str], observations: DataFrame, outputs: DataFrame, **given: DataFrame) -> dict[str, DataFrame]:
    """All relations from one model (its id, revision, identity and so on), observations and outputs.

    ``given`` holds further inputs by relation name; packages may carry ``items``, an array of
    structs, which then are the package's only items.  Missing inputs give empty relations.
    """
    unknown = set(given) - set(RELATIONS)
    if unknown:
        raise ValueError(f"unknown relations: {sorted(unknown)}")
    stamp = {c: F.lit(model.get(c)) for c in MODEL}

    def stamped(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(_has(df, c), v) for c, v in stamp.items()})

    out = {n: conform(stamped(given[n]) if "context_model_id" in fields(n) else given[n], n) if n in given else empty(spark, n) for n in RELATIONS}
    schema = ", ".join(f"{c} string" for c in fields("context_models"))
    out["context_models"] = conform(spark.createDataFrame([tuple(model.get(c) for c in fields("context_models"))], schema), "context_models")

    seen = stamped(observations).withColumn("object_identity", _id(source_system=F.col("source_system"), source_key=F.col("source_key")))
    objects = seen.select(
        "object_identity", *MODEL, "object_role", _has(seen, "object_kind").alias("object_kind"), "source_system", "source_key",
        F.col("snapshot_identity").alias("current_snapshot_identity"), _has(seen, "status").alias("status"), _has(seen, "display_name").alias("display_name"),
        _has(seen, "_seq", "long").alias("_seq"),
    )
    out["context_objects"] = conform(objects.withColumn("_seq", F.coalesce("_seq", F.lit(0))), "context_objects")
    out["context_snapshots"] = conform(seen, "context_snapshots")

    made = stamped(outputs)
    role, kind = _has(made, "role"), _has(made, "kind")
    shaped = made.withColumns({"output_identity": F.col("identity"), "output_role": role, "output_kind": kind})
    out["context_outputs"] = conform(shaped, "context_outputs")
    inputs = _either(_has(made, "derived_from", "array<string>"), _has(made, "input_identities", "array<string>"))
    evidence = _either(_has(made, "evidence_identities", "array<string>"), inputs)
    asserted = made.where(F.coalesce(_has(made, "publish_assertion", "boolean"), F.lit(True))).select(
        _id(output=F.col("identity"), type=F.lit("output")).alias("assertion_identity"), *MODEL, F.col("identity").alias("assertion_subject"),
        _has(made, "kind").alias("assertion_type"), evidence.alias("evidence_identities"), _has(made, "status").alias("status"), _has(made, "value_json").alias("value_json"),
    )
    out["context_assertions"] = conform(asserted.unionByName(out["context_assertions"], allowMissingColumns=True), "context_assertions")
    if "vector" in made.columns:
        vectors = made.where(F.col("vector").isNotNull()).select(
            _id(identity=F.col("identity"), kind=F.lit("retrieval")).alias("retrieval_identity"), "identity", F.col("identity").alias("context_identity"),
            F.col("vector").cast("array<double>").alias("vector"), _has(made, "text").alias("text"), "context_model_id", _has(made, "status").alias("status"),
        )
        out["context_retrieval"] = conform(vectors.unionByName(out["context_retrieval"], allowMissingColumns=True), "context_retrieval")
    text = preview(F.coalesce(_has(made, "preview"), _has(made, "text")))
    out["context_catalog"] = catalog(seen, made.withColumn("preview", text))

    if "context_packages" in given and "items" in given["context_packages"].columns:
        # inline items are the package's items; explicit rows of the same package are left out
        inline = stamped(items_of(given["context_packages"]))
        loose = out["package_items"].join(given["context_packages"].where(F.size("items") > 0).select("package_identity"), "package_identity", "left_anti")
        out["package_items"] = conform(inline.unionByName(loose, allowMissingColumns=True), "package_items")
        out["context_packages"] = out["context_packages"].drop("items")
    edges = derived_edges(made).unionByName(lifecycle_edges(out["resolution_decisions"], out["package_items"], out["contract_evaluations"]))
    out["lineage_edges"] = conform(stamped(edges).unionByName(out["lineage_edges"], allowMissingColumns=True), "lineage_edges")
    # the id of a made edge is that of its ends, so those of one id have the same
    ends = out["lineage_edges"] if "lineage_edges" in given else edges
    declared = [
        (out["context_contracts"], "contract_identity", "contract"), (out["context_catalog"], "canonical_identity", "context"),
        (out["resolution_decisions"], "decision_identity", "decision"), (out["contract_evaluations"], "evaluation_identity", "evaluation"),
        (out["context_packages"], "package_identity", "package"), (out["lineage_nodes"], "canonical_node_id", "node"),
    ]
    out["lineage_nodes"] = nodes(ends, *declared)
    return out


# A foreign key and the relations (with their keys) of which one must have it.
REFERENCES = {
    "snapshot_object": ("context_snapshots.object_identity", "context_objects.object_identity"),
    "object_snapshot": ("context_objects.current_snapshot_identity", "context_snapshots.snapshot_identity"),
    "output_catalog": ("context_outputs.identity", "context_catalog.canonical_identity"),
    "assertion_subject": ("context_assertions.assertion_subject", "context_outputs.identity context_catalog.canonical_identity context_snapshots.snapshot_identity"),
    "retrieval_context": ("context_retrieval.context_identity", "context_outputs.identity context_catalog.canonical_identity"),
    "edge_source": ("lineage_edges.source_node_id", "lineage_nodes.canonical_node_id"),
    "edge_target": ("lineage_edges.target_node_id", "lineage_nodes.canonical_node_id"),
    "decision_candidate": ("resolution_decisions.candidate_identity", "resolution_candidates.candidate_identity"),
    "candidate_context": ("resolution_candidates.context_identity", "context_outputs.identity context_catalog.canonical_identity context_snapshots.snapshot_identity"),
    "item_package": ("package_items.package_identity", "context_packages.package_identity"),
    "item_context": ("package_items.representation_identity", "context_outputs.identity context_catalog.canonical_identity"),
    "binding_package": ("context_package_contracts.package_identity", "context_packages.package_identity"),
    "binding_contract": ("context_package_contracts.contract_identity", "context_contracts.contract_identity"),
    "binding_evaluation": ("context_package_contracts.evaluation_identity", "contract_evaluations.evaluation_identity"),
    "evaluation_contract": ("contract_evaluations.contract_identity", "context_contracts.contract_identity"),
}


def conformance(spark: SparkSession, relations: Mapping[str, DataFrame], evidence: int = 20) -> DataFrame:
    """(check, passed, n_failed, examples): presence, keys, references and one contract a package.

    n_failed counts every failing key; ``examples`` are the least ``evidence`` of them.  If a
    relation is missing only the presence check is reported.

    One aggregation by value decides every check: a value of any number of relations is one group,
    whose ``mask`` has a bit for each relation that has it as key and each reference that uses it.
    Keys that several rows have, or that trimming changes, are counted aside, in a slot of their relation.
    """
    missing = sorted(set(RELATIONS) - set(relations))
    head = spark.createDataFrame([("presence", not missing, len(missing), missing)], "check string, passed boolean, n_failed long, examples array<string>")
    if missing:
        return head
    names, checks = list(RELATIONS), [*REFERENCES, "one_contract", "several_contracts"]
    defined = {n: 1 << i for i, n in enumerate(names)}
    padded = {n: 1 << len(names) + i for i, n in enumerate(names)}
    used = {c: 1 << 2 * len(names) + i for i, c in enumerate(checks)}
    bits: dict[str, dict[str, int]] = {n: {key_of(n): defined[n]} for n in names}
    for check, (fk, _) in REFERENCES.items():
        name, column = fk.split(".")
        bits[name][column] = bits[name].get(column, 0) | used[check]
    row = lambda value, mask, slot=0, n=0: F.struct(value.alias("bad"), F.lit(slot).alias("slot"), F.lit(mask).cast("long").alias("mask"), F.lit(n).cast("long").alias("n"))
    met = None
    for slot, name in enumerate(names, 1):
        rows = relations[name].select(F.inline(F.array(*[row(F.col(c).cast("string"), mask) for c, mask in bits[name].items()])))
        own = relations[name].groupBy(F.col(key_of(name)).cast("string").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        value = F.coalesce(F.trim("_k"), F.lit(""))
        odd = own.where((F.col("_n") > 1) | F.col("_k").isNull() | (F.col("_k") != value) | (value == ""))
        counted = F.struct(value.alias("bad"), F.lit(slot).alias("slot"), F.lit(0).cast("long").alias("mask"), F.col("_n").alias("n"))
        also = row(F.when(F.col("_k") != value, value), padded[name])
        part = rows.where("bad IS NOT NULL").unionByName(odd.select(F.inline(F.array(counted, also))).where("bad IS NOT NULL"))
        met = part if met is None else met.unionByName(part)
    bound = relations["context_package_contracts"].groupBy(F.col("package_identity").cast("string").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    mask = F.when(F.col("_n") == 1, used["one_contract"]).otherwise(used["several_contracts"]).cast("long")
    met = met.unionByName(bound.where("_k IS NOT NULL").select(F.col("_k").alias("bad"), F.lit(0).alias("slot"), mask.alias("mask"), F.lit(0).cast("long").alias("n")))
    met = met.groupBy("bad", "slot").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    has = lambda m: F.col("mask").bitwiseAND(F.lit(m)) != 0
    failing = {f"key:{n}": (has(padded[n]) & has(defined[n])) | ((F.col("slot") == i) & ((F.col("n") > 1) | (F.col("bad") == ""))) for i, n in enumerate(names, 1)}
    for check, (_, targets) in REFERENCES.items():
        any_of = sum(defined[t.split(".")[0]] for t in targets.split())
        failing[f"reference:{check}"] = has(used[check]) & ~has(any_of) & ~blank(F.col("bad"))
    failing["one_contract"] = has(defined["context_packages"]) & ~has(used["one_contract"]) & ~blank(F.col("bad"))
    found = F.array_compact(F.array(*[F.when(fails, F.lit(check)) for check, fails in failing.items()]))
    # few values fail, and only for these the checks are listed; a key can fail in its slot and beside it
    bad = met.where(reduce(operator.or_, failing.values())).select("bad", F.explode(found).alias("check")).distinct()
    counts = bad.groupBy("check").agg(F.count(F.lit(1)).alias("n_failed"))
    # the limit on the rank holds before the shuffle, so a check with many failing keys is no single task's load
    least = bad.withColumn("_r", F.row_number().over(_by("check", "bad"))).where(F.col("_r") <= evidence)
    shown = least.groupBy("check").agg(F.array_sort(F.collect_list("bad")).alias("examples"))
    listed = spark.createDataFrame([(c,) for c in failing], "check string")
    rows = listed.join(counts, "check", "left").join(shown, "check", "left").select(
        "check", F.col("n_failed").isNull().alias("passed"), F.coalesce("n_failed", F.lit(0)).alias("n_failed"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples")
    )
    return head.unionByName(rows)


def _by(key: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order)


def declared_test(relations: Mapping[str, DataFrame], kind: str, role: str) -> tuple[bool, str]:
    """Runs one declared test on the outputs of a role; without target rows or with an unknown kind it fails."""
    return declared_tests(relations, [(kind, role)])[0]


def declared_tests(relations: Mapping[str, DataFrame], tests: Sequence[tuple[str, str]]) -> list[tuple[bool, str]]:
    """The same for several (kind, role), in one job: the outputs of a role and all that is asked of them meet once."""
    facts = {
        "evidence_required": ("context_assertions", "assertion_subject", F.size("evidence_identities") > 0),
        "lineage_complete": ("lineage_edges", "target_node_id", F.lit(True)),
        "retrieval_indexed": ("context_retrieval", "context_identity", F.lit(True)),
        "no_orphan_outputs": ("context_catalog", "canonical_identity", F.lit(True)),
        "authority_resolved": ("context_catalog", "canonical_identity", ~blank(F.col("authority_status"))),
    }
    asked: dict[str, list[str]] = {}
    for kind, role in dict.fromkeys(tests):
        if kind in facts or kind in ("identity_unique", "snapshot_integrity"):
            asked.setdefault(role, []).append(kind)
    parts = []  # (role, kind, n rows, n that fail)
    for role, kinds in asked.items():
        wanted = [k for k in kinds if k in facts]
        if wanted or "identity_unique" in kinds:
            marks = lambda own: [F.lit(int(k == own)).alias(k) for k in wanted]  # noqa: B023, E731
            met = relations["context_outputs"].where(F.col("output_role") == role).select("identity", F.lit(1).alias("_row"), *marks(None))
            for kind in wanted:
                name, column, holds = facts[kind]
                # a null is no output's identity
                fits = relations[name].where(holds & F.col(column).isNotNull())
                met = met.unionByName(fits.select(F.col(column).alias("identity"), F.lit(0).alias("_row"), *marks(kind)))
            of = met.groupBy("identity").agg(F.sum("_row").alias("_rows"), *[F.max(k).alias(k) for k in wanted])
            failed = {k: F.sum(F.when(F.col(k) == 0, F.col("_rows")).otherwise(0)) for k in wanted} | {"identity_unique": F.count_if(F.col("_rows") > 1)}
            counts = F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"), F.coalesce(f, F.lit(0)).alias("failed")) for k, f in failed.items() if k in kinds])
            parts.append(of.agg(counts.alias("_all")).select(F.lit(role).alias("role"), F.inline("_all")))
        if "snapshot_integrity" in kinds:
            lacking = blank(F.col("content_sha256")) | blank(F.col("content_ref"))
            rows = relations["context_snapshots"].where(F.col("snapshot_role") == role)
            parts.append(rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(lacking).alias("failed")).select(F.lit(role).alias("role"), F.lit("snapshot_integrity").alias("kind"), "n", "failed"))
    every = None
    for part in parts:
        every = part if every is None else every.unionByName(part)
    found = {(r["kind"], r["role"]): (r["n"], r["failed"]) for r in every.collect()} if every is not None else {}  # a row a test

    def verdict(test: tuple[str, str]) -> tuple[bool, str]:
        if test not in found:
            return False, f"unsupported test: {test[0]}"
        n, failed = found[test]
        return (False, "no target rows") if not n else (failed == 0, f"{failed} rows fail" if failed else "")

    return [verdict(t) for t in tests]


def publish(prior: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """The next version of an immutable store; a key with two values, in the rows or against the store, raises ValueError."""
    # two values are enough to tell; a key's rows are reduced before the shuffle
    ends = rows.groupBy(key).agg(F.min(F.coalesce(F.col(value).cast("string"), F.lit("\0"))).alias("_a"), F.max(F.coalesce(F.col(value).cast("string"), F.lit("\0"))).alias("_z"))
    stored = prior.select(key, F.coalesce(F.col(value).cast("string"), F.lit("\0")).alias("_old"))
    clash = ends.join(stored, key, "left").where((F.col("_a") != F.col("_z")) | (F.col("_old") != F.col("_a")))
    first = clash.select(key).orderBy(key).first()
    if first is not None:
        raise ValueError(f"persistence_conflict: {first[0]}")
    return prior.unionByName(rows.dropDuplicates([key]).join(prior.select(key), key, "left_anti"), allowMissingColumns=True)


def counts(relations: Mapping[str, DataFrame]) -> DataFrame:
    """(name, n): rows of each relation."""
    out = None
    for name, df in sorted(relations.items()):
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out
