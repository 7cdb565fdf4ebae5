"""SQL over a set of relations, with the table function ``semantic_search``.

A call's arguments are literals: relation, query text, mode (vector, full_text or hybrid),
limit (NULL: all rows) and, optionally, the name of a registered query vector and a prefilter.  It is found
by the session's own parser, planned lazily as a DataFrame, and its text is replaced by the
name of a temporary view before Spark plans the whole statement.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import retrieval as search

_numbers = itertools.count()


class Engine:
    def __init__(
        self, spark: SparkSession, relations: Mapping[str, DataFrame], retrieval: DataFrame | None = None, vectors: Mapping[str, list[float]] | None = None,
        id_col: str = "context_identity", text_col: str = "text", vector_col: str = "vector", postings: search.Postings | None = None, retrieval_name: str = "context_retrieval",
    ):
        self.spark, self.relations, self.vectors, self.postings = spark, dict(relations), dict(vectors or {}), postings
        self.retrieval = retrieval if retrieval is not None else self.relations.get(retrieval_name)
        self.id_col, self.text_col, self.vector_col, self.retrieval_name = id_col, text_col, vector_col, retrieval_name
        #: What the last search did: adapter, table, mode, prefilter, limit and its plan.
        self.last_execution: dict = {}
        self._views: dict[str, str] = {}

    def sql(self, text: str) -> DataFrame:
        """A lazy DataFrame; any error is a ValueError."""
        if not text.strip():
            raise ValueError("analytical query is empty")
        try:
            planned = self._planned(text)
            # the relations are parameters of this engine's statements alone, so two engines of a session don't meet
            return self.spark.sql(self._renamed(planned))
        except Exception as e:
            raise ValueError(f"analytical query failed: {e}") from e

    def semantic_search(self, relation: str, query: str, mode: str, limit: int | None, vector: str | None = None, prefilter: str | None = None) -> DataFrame:
        """The table function as an API; the relation is only the catalog that facts are joined to.  Without a limit all rows that match are facts."""
        if limit is not None and limit <= 0:
            raise ValueError("limit must be positive")
        if vector is not None and vector not in self.vectors:
            raise ValueError(f"unknown query vector: {vector}")
        if mode not in ("vector", "full_text", "hybrid"):
            raise ValueError(f"unknown retrieval mode: {mode}")
        if self.retrieval is None:
            # without a retrieval relation there are no facts
            nothing = self.spark.createDataFrame([], f"{self.id_col} string, score double, retrieval_rank long")
            self._record(relation, mode, prefilter, limit, nothing)
            return search.with_catalog(nothing, self._catalog(relation), self.id_col)
        rows = self.retrieval.where(prefilter) if prefilter else self.retrieval

        def by_vector(n: int | None) -> DataFrame:
            if vector is None:
                raise ValueError("vector search needs a query vector")
            return search.vector_search(rows.select(self.id_col, self.vector_col), self.vectors[vector], n, self.id_col, self.vector_col)

        def by_text(n: int | None) -> DataFrame:
            if self.postings is not None and prefilter is None:
                return self.postings.search(query, n, self.id_col)
            return search.full_text_search(rows.select(self.id_col, self.text_col), query, n, self.id_col, self.text_col)

        if mode == "vector":
            facts = by_vector(limit)
        elif mode == "full_text":
            facts = by_text(limit)
        else:
            wide = None if limit is None else max(limit * 4, 40)
            facts = search.hybrid(by_vector(wide), by_text(wide), self.id_col, limit)
        self._record(relation, mode, prefilter, limit, facts)
        return search.with_catalog(facts.withColumn(self.id_col, F.col(self.id_col).cast("string")), self._catalog(relation), self.id_col, limit is not None)

    def _catalog(self, relation: str) -> DataFrame:
        if relation not in self.relations:
            raise ValueError(f"unknown relation: {relation}")
        return self.relations[relation]

    def _record(self, relation: str, mode: str, prefilter: str | None, limit: int | None, facts: DataFrame) -> None:
        plan = facts._jdf.queryExecution().optimizedPlan().toString()
        self.last_execution = {"adapter": "ctxloom", "table": self.retrieval_name, "catalog": relation, "mode": mode, "prefilter": prefilter, "limit": limit, "plan": plan}

    def _renamed(self, text: str) -> str:
        """The statement with each relation of this engine under the name of a view of its own."""
        for name, df in self.relations.items():
            if name not in self._views:
                self._views[name] = f"__relation_{next(_numbers)}"
                df.createOrReplaceTempView(self._views[name])
        aliases = [f"`{n}` AS (SELECT * FROM {v})" for n, v in sorted(self._views.items())]
        return f"WITH {', '.join(aliases)} ({text.rstrip().rstrip(';')})" if aliases else text

    def _planned(self, text: str) -> str:
        if "semantic_search" not in text.lower():
            return text
        for start, arguments in sorted(self._calls(text), reverse=True):
            if len(arguments) not in (4, 5, 6):
                raise ValueError("semantic_search takes 4 to 6 literal arguments")
            relation, query, mode, limit, *more = arguments
            view = f"__semantic_search_{next(_numbers)}"
            self.semantic_search(relation, query, mode, None if limit is None else int(limit), *[x if x else None for x in more]).createOrReplaceTempView(view)
            text = text[:start] + view + text[_call_end(text, start) :]
        return text

    def _calls(self, text: str) -> list[tuple[int, list]]:
        plan = self.spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        found, queue = [], [plan]
        while queue:
            node = queue.pop()
            if node.nodeName() == "UnresolvedTableValuedFunction" and node.name().last().lower() == "semantic_search":
                literals = []
                arguments = node.functionArgs()
                for i in range(arguments.size()):
                    a = arguments.apply(i)
                    if a.getClass().getSimpleName() != "Literal":
                        raise ValueError("semantic_search takes literal arguments")
                    literals.append(None if a.value() is None else a.toString())
                found.append((node.origin().startIndex().get(), literals))
            for seq in (node.children(), node.innerChildren(), node.subqueries()):
                queue += [x for i in range(seq.size()) if hasattr(x := seq.apply(i), "nodeName") and _is_plan(x)]
        return found


def _is_plan(x) -> bool:
    return "plans.logical" in x.getClass().getName() or "catalyst.analysis" in x.getClass().getName()


def _call_end(text: str, start: int) -> int:
    """Place behind the call's closing parenthesis; quotes are skipped."""
    depth, quote, i = 0, "", text.index("(", start)
    while True:
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth:
                return i + 1
        i += 1
