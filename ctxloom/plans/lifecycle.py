"""From observations and outputs to published relations: requests, decisions, packages, contracts, relations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.identity import stable_identity, struct_identity
from ..functions.text import parse_time
from ..operators import requests, resolve
from ..sources import relations
from ..sources.store import Store
from .lineage import settle

#: Relations that are published at once.
WRITERS = 8


def decision_rows(candidates: DataFrame, decided: str = "d") -> DataFrame:
    """Rows of resolution_decisions; ``selected_identity`` only where the outcome is ``selected``."""
    parts = [F.col("candidate_identity").alias("candidate"), F.col(f"{decided}.outcome").alias("outcome"), F.col("request_identity").alias("request")]
    return candidates.select(
        *_dealt(candidates), struct_identity(*parts).alias("decision_identity"), "candidate_identity", "request_identity", "context_identity",
        F.col(f"{decided}.outcome").alias("outcome"), F.col(f"{decided}.reason").alias("reason_code"),
        F.when(F.col(f"{decided}.outcome") == "selected", F.col("context_identity")).alias("selected_identity"),
    )


def _dealt(df: DataFrame) -> list[str]:
    """The column by which the rows of a request lie together, if they were dealt so."""
    return [c for c in df.columns if c == "_deal"]


def default_packages(decisions: DataFrame, accepted: tuple[str, ...] = ("selected",)) -> tuple[DataFrame, DataFrame]:
    """(packages, items): one package a request with an accepted decision; items by candidate id, one token each."""
    taken = decisions.where(F.col("outcome").isin(list(accepted)))
    package = struct_identity(F.col("request_identity").alias("request")).alias("package_identity")
    dealt = _dealt(decisions)
    ranked = F.row_number().over(Window.partitionBy(*dealt, "request_identity").orderBy("candidate_identity", "context_identity")) - 1
    items = taken.select(*dealt, package, F.col("context_identity").alias("representation_identity"), ranked.cast("long").alias("rank"), F.lit(1).cast("long").alias("token_estimate"))
    item_id = struct_identity(F.col("rank").alias("index"), F.col("representation_identity").alias("item"), F.col("package_identity").alias("package"))
    items = items.withColumn("package_item_identity", item_id)
    packages = taken.groupBy(*dealt, "request_identity").agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("budget_tokens"))
    return packages.select(*dealt, package, "budget_tokens", F.lit("resolution").alias("package_kind")), items


def packages_from(decisions: DataFrame, accepted: tuple[str, ...] = ("selected",), allow_empty: bool = False, token_estimate: int = 0, budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(packages, items) of the requests' accepted decisions, in the candidates' order; a request without any raises ValueError unless empty packages are allowed."""
    every = decisions.groupBy("request_identity").agg(F.count_if(F.col("outcome").isin(list(accepted))).alias("_n"))
    if not allow_empty and (empty := every.where("_n = 0").orderBy("request_identity").first()) is not None:
        raise ValueError(f"contract_invalid: request {empty[0]} has no accepted decision")
    _, items = default_packages(decisions, accepted)
    items = items.withColumn("token_estimate", F.lit(token_estimate).cast("long"))
    package = struct_identity(F.col("request_identity").alias("request")).alias("package_identity")
    tokens = F.lit(budget) if budget is not None else F.greatest(F.col("_n") * token_estimate, F.lit(1))
    return every.select(package, tokens.cast("long").alias("budget_tokens"), F.lit("task_context").alias("package_kind"), "request_identity"), items


def package_issues(packages: DataFrame, items: DataFrame) -> DataFrame:
    """(package_identity, issue): items that need more tokens than the budget, ranks that repeat."""
    sums = items.groupBy("package_identity").agg(F.sum("token_estimate").alias("_sum"))
    over = packages.join(sums, "package_identity").where(F.col("_sum") > F.col("budget_tokens")).select("package_identity", F.lit("budget_exceeded").alias("issue"))
    ranks = items.groupBy("package_identity", "rank").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return over.unionByName(ranks.select("package_identity", F.lit("repeated_rank").alias("issue")).distinct())


def unsatisfied(required: DataFrame, selected: DataFrame, packed: DataFrame) -> DataFrame:
    """(request_identity, context_identity, issue): required items that the resolution didn't select or that the budget left out."""
    keys = ["request_identity", "context_identity"]
    chosen, kept = (df.select(*keys).distinct().withColumn(flag, F.lit(True)) for df, flag in ((selected, "_selected"), (packed, "_packed")))
    joined = required.select(*keys).distinct().join(chosen, keys, "left").join(kept, keys, "left")
    issue = F.when(F.col("_selected").isNull(), "not_selected").when(F.col("_packed").isNull(), "not_packed")
    return joined.select(*keys, issue.alias("issue")).where("issue IS NOT NULL")


def require(required: DataFrame, selected: DataFrame, packed: DataFrame) -> None:
    """Raises ValueError with the first required item that is lacking."""
    first = unsatisfied(required, selected, packed).orderBy("request_identity", "context_identity").first()
    if first is not None:
        raise ValueError(f"budget_unsatisfied: {first['context_identity']} {first['issue']}")


def _first(df: DataFrame, kind: str, *names: str) -> Column:
    """The first of these columns that there is and that isn't null."""
    known = [F.col(n).cast(kind) for n in names if n in df.columns]
    return F.coalesce(*known) if known else F.lit(None).cast(kind)


def _instant(df: DataFrame, *names: str) -> Column:
    """The same for instants, given as such or as ISO texts."""
    kinds = dict(df.dtypes)
    known = [parse_time(F.col(n)) if kinds[n] == "string" else F.col(n).cast("timestamp") for n in names if n in df.columns]
    return F.coalesce(*known) if known else F.lit(None).cast("timestamp")


def measured(
    packages: DataFrame | None, items: DataFrame, outputs: DataFrame, consumer: str | None, task: str | None, purpose: str | None, authority_level: str | None,
    as_of: str | None = None, budget_tokens: int | None = None, budget_bytes: int | None = None, context_level: str | None = None,
) -> DataFrame:
    """What a contract reads of each package.

    Tokens and bytes are those of the context, else of the package, else the sums over its
    items; an item's bytes are its own estimate, else its output's length.  It is superseded
    if it or its output is; it expires with its own ``valid_until``, else with its output's.
    Authority may come from the context, the package, its items or their outputs.
    Without ``packages`` they are those of the items, as ``default_packages`` makes them, and need no join.
    """
    output = F.struct(
        F.lower(_first(outputs, "string", "status")).alias("status"), _first(outputs, "long", "byte_length", "byte_count").alias("size"), _instant(outputs, "valid_until", "expires_at").alias("until"),
        _first(outputs, "string", "authority_level", "authority_status").alias("level"), _first(outputs, "boolean", "expired").alias("expired"), _first(outputs, "boolean", "cited").alias("cited"),
    )
    cited = F.size(F.filter("evidence_identities", lambda e: F.trim(e) != "")) > 0 if "evidence_identities" in items.columns else F.col("_o.cited")
    yes = lambda c: F.coalesce(c, F.lit(False))
    level = F.lit(authority_level)
    # an output that says none of these counts like one that isn't there, so it needn't meet its items
    told = yes(F.col("_o.status") == "superseded") | yes(F.col("_o.expired")) | yes(F.col("_o.cited")) | yes(F.col("_o.level") == level) | F.col("_o.size").isNotNull() | F.col("_o.until").isNotNull()
    state = outputs.select(F.col("identity").alias("representation_identity"), output.alias("_o")).where(told)
    item_level, item_size, item_until = _first(items, "string", "authority_level"), _first(items, "long", "byte_estimate"), _instant(items, "valid_until", "expires_at")
    facts = items.withColumns({"_status": F.lower(_first(items, "string", "status")), "_level": item_level, "_size": item_size, "_until": item_until, "_tokens": F.col("token_estimate")})
    keys = [*_dealt(items if packages is None else packages), "package_identity"] if _dealt(items) else ["package_identity"]
    joined = facts.join(state, "representation_identity", "left").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_items"), F.coalesce(F.sum("_tokens"), F.lit(0)).alias("_sum"), F.sum(F.coalesce("_size", "_o.size", F.lit(0))).alias("_bytes"),
        F.sum((~yes(cited)).cast("long")).alias("n_uncited"), F.bool_or(yes(F.col("_status") == "superseded") | yes(F.col("_o.status") == "superseded")).alias("any_superseded"),
        F.min(F.coalesce("_until", "_o.until")).alias("_least"), F.bool_or(yes(F.col("_o.expired"))).alias("_expired"),
        F.bool_or(yes(F.col("_level") == level) | yes(F.col("_o.level") == level)).alias("_authority"),
    )
    if packages is None:
        out = packages = joined.withColumns({"budget_tokens": F.col("n_items"), "package_kind": F.lit("resolution")})
    else:
        # a package without items has nothing to count, and is judged all the same
        nothing = {"n_items": 0, "_sum": 0, "_bytes": 0, "n_uncited": 0, "any_superseded": False, "_expired": False, "_authority": False}
        out = packages.join(joined, keys, "left").fillna(nothing)
    asked = parse_time(F.lit(as_of)) if as_of is not None else _instant(packages, "as_of", "created_at")
    own = yes(_first(packages, "string", "authority_level") == level) | yes(_first(packages, "string", "metadata_authority_level") == level) | F.lit(authority_level is not None and context_level == authority_level)
    made = {
        "consumer": F.coalesce(F.lit(consumer), _first(packages, "string", "consumer"), F.lit("")), "task": F.coalesce(F.lit(task), _first(packages, "string", "task_id", "task"), F.lit("")),
        "n_tokens": F.coalesce(F.lit(budget_tokens).cast("long"), _first(packages, "long", "budget_tokens"), F.col("_sum")),
        "n_bytes": F.coalesce(F.lit(budget_bytes).cast("long"), _first(packages, "long", "byte_count", "bytes"), F.col("_bytes")),
        "as_of": asked, "any_expired": F.col("_expired") | yes(F.col("_least") < asked), "authority_ok": F.col("_authority") | own,
    }
    out = out.withColumns(made)
    return out.withColumn("purpose", F.coalesce(F.lit(purpose), _first(packages, "string", "purpose"), F.col("task"))).drop("_sum", "_bytes", "_least", "_expired", "_authority")


def publication(evaluated: DataFrame, contract_identity: str, contract_version: str = "1", evaluator: str = "ctxloom.contract") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(evaluations of all packages, bindings of the allowed, keys of the allowed): only ``allow`` is published."""
    of, version = F.lit(contract_identity), F.lit(contract_version)
    why = F.when(F.col("decision") == "abstain", F.array(F.lit("missing_authoritative_evidence"))).otherwise(F.col("violated_rules"))
    rows = evaluated.withColumn("violated_rules", why)
    eid = struct_identity(
        of.alias("contract_identity"), version.alias("contract_version"), F.col("decision").alias("decision"), F.lit(evaluator).alias("evaluator_identity"),
        F.col("package_identity").alias("package_identity"), F.col("violated_rules").alias("violated_rules"),
    )
    explanation = F.when(F.col("decision") == "allow", "allowed").otherwise(F.array_join("violated_rules", ", "))
    evaluations = rows.select(
        *_dealt(rows), eid.alias("evaluation_identity"), "package_identity", of.alias("contract_identity"), version.alias("contract_version"), "decision", "violated_rules",
        explanation.alias("explanation"), F.lit(evaluator).alias("evaluator_identity"),
    )
    allowed = evaluations.where("decision = 'allow'")
    binding = struct_identity(*[F.col(c).alias(c) for c in ("contract_identity", "contract_version", "evaluation_identity", "package_identity")])
    bindings = allowed.select(*_dealt(rows), binding.alias("binding_identity"), "package_identity", "contract_identity", "contract_version", "evaluation_identity", "decision")
    return evaluations, bindings, allowed.select("package_identity")


def run(
    spark: SparkSession, model: Mapping[str, str], observations: DataFrame, outputs: DataFrame, candidates: DataFrame, contract: resolve.Contract, contract_identity: str,
    consumer: str, task: str, purpose: str, store: Store | None = None, packages: DataFrame | None = None, items: DataFrame | None = None,
    tests: Sequence[tuple[str, str]] = (), **context: Any,
) -> dict[str, DataFrame]:
    """All relations; with a store they are published there too, every one again on every run, and declared tests run on what was published.

    ``candidates`` have candidate_identity, request_identity, context_identity and the
    decision ``d`` of a policy; without ``packages`` each request with a selected one makes
    a package.  ``context`` goes to ``measured``.
    """
    decisions = decision_rows(candidates)
    made_of = packages
    if packages is None:
        packages, items = default_packages(decisions)
    evaluated = resolve.evaluate(measured(made_of, items, outputs, consumer, task, purpose, contract.authority_level, **context), contract)
    if store is not None or not _dealt(evaluated):
        # computed once, as five relations read the verdicts; rows that are dealt stay where they are, and in one plan share their shuffle
        evaluated = settle(evaluated)
    evaluations, bindings, allowed = publication(evaluated, contract_identity)

    def published(rows: DataFrame) -> DataFrame:
        if not _dealt(rows):
            return rows.join(allowed, "package_identity", "left_semi")
        # the rows stay where they are; of one hash there are as many packages as its queries have requests
        of = evaluated.where("decision = 'allow'").groupBy("_deal").agg(F.collect_set("package_identity").alias("_allowed"))
        return rows.join(of, "_deal").where(F.array_contains("_allowed", F.col("package_identity"))).drop("_allowed")

    contracts = spark.createDataFrame([(contract_identity, "active")], "contract_identity string, status string")
    made = relations.materialize(
        spark, model, observations, outputs, resolution_candidates=candidates.drop("d"), resolution_decisions=decisions, context_contracts=contracts,
        context_packages=published(packages) if made_of is not None else evaluated.where("decision = 'allow'").select(*packages.columns), package_items=published(items),
        context_package_contracts=bindings, contract_evaluations=evaluations,
    )
    if store is not None:
        # many of the relations are small, so their jobs go side by side
        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(lambda n: store.replace(n, made[n]), made))
        made = {name: store.read(name) for name in made}
    for (kind, role), (passed, why) in zip(tests, relations.declared_tests(made, tests), strict=True):
        if not passed:
            raise ValueError(f"declared test {kind} of {role}: {why}")
    return made


def orchestrate(
    spark: SparkSession, model: Mapping[str, str], observations: DataFrame, outputs: DataFrame, inputs: DataFrame | None, facts: DataFrame, decide: Callable[[DataFrame], DataFrame],
    contract: Mapping[str, Any], store: Store | None = None, tests: Sequence[tuple[str, str]] = (), keep: Sequence[str] = (), **context: Any,
) -> dict[str, DataFrame]:
    """Retrieval inputs with their facts, requests, decisions, packages, contract, relations and tests, in this order.

    ``decide`` adds the policy's decision ``d`` to candidate rows; ``contract`` is a resolved
    contract; ``context`` holds consumer, task and purpose and whatever ``measured`` takes.
    What the policy reads can come with the facts, as the columns ``keep``, so that it needs no join,
    and so can the inputs' columns where each query has one input.
    """
    _, candidates = requests.grouped_requests(requests.executed(inputs, facts, keep, deal=True))
    decided = decide(candidates)
    ruled = resolve.Contract.of(contract["rules"])
    asked = {k: context.pop(k, None) for k in ("consumer", "task", "purpose")}
    return run(spark, model, observations, outputs, decided, ruled, contract["contract_identity"], **asked, store=store, tests=tests, **context)


def publish_request(spark: SparkSession, store: Store, request: Mapping[str, Any], contract: Mapping[str, Any], model: Mapping[str, str]) -> dict[str, Any]:
    """Judges the packages that a request file declares and publishes the allowed ones in their own store.

    ``request`` has ``publication`` (output_role, consumer, task, purpose, as_of and, optionally,
    budget_tokens, budget_bytes, authority_level), ``runtime_outputs`` and ``packages`` with
    ``items``: the driver's own and small.  ``published`` is true only if every package was allowed.
    """
    asked = request["publication"]
    level = asked.get("authority_level") or ""
    rows = [(o["identity"], o.get("status") or "active", o.get("byte_length") or 0, o.get("valid_until"), o.get("authority_level") or level, asked["output_role"]) for o in request.get("runtime_outputs", ())]
    outputs = spark.createDataFrame(rows, "identity string, status string, byte_length long, valid_until string, authority_level string, role string")
    packages, items = [], []
    for p in request.get("packages", ()):
        listed = p.get("items", ())
        budget = p.get("budget_tokens") or asked.get("budget_tokens") or sum(i.get("token_estimate", 0) for i in listed)
        key = stable_identity({"request": asked["output_role"], "package": p})
        packages.append((key, p.get("task_id") or asked["task"], "task_context", budget, p.get("authority_level") or level))
        for rank, i in enumerate(listed):
            items.append((key, stable_identity({"package": key, "index": rank, "item": i}), i["representation_identity"], i.get("rank", rank), i.get("token_estimate", 0), list(i.get("evidence_identities", ()))))
    package_rows = spark.createDataFrame(packages, "package_identity string, task_id string, package_kind string, budget_tokens long, authority_level string")
    item_rows = spark.createDataFrame(items, "package_identity string, package_item_identity string, representation_identity string, rank long, token_estimate long, evidence_identities array<string>")
    nobody = spark.createDataFrame([], "candidate_identity string, request_identity string, context_identity string, d struct<outcome:string, reason:string>")
    unseen = spark.createDataFrame([], "snapshot_identity string, source_system string, source_key string, snapshot_role string, object_role string")
    made = run(
        spark, model, unseen, outputs, nobody, resolve.Contract.of(contract["rules"]), contract["contract_identity"], asked["consumer"], asked["task"], asked.get("purpose") or asked["task"], store,
        package_rows, item_rows, as_of=asked.get("as_of"), budget_tokens=asked.get("budget_tokens"), budget_bytes=asked.get("budget_bytes"), context_level=level or None,
    )
    decisions = sorted(r[0] for r in made["contract_evaluations"].select("decision").distinct().collect())
    counts = dict(relations.counts(made).collect())  # a row a relation
    return {"output_role": asked["output_role"], "contract_identity": contract["contract_identity"], "decisions": decisions, "published": counts["context_packages"] > 0 and decisions == ["allow"], "relation_counts": counts}
