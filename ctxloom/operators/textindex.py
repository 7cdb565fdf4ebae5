"""A stored full-text index of segments: appended, deleted from, searched by skipping, with positions for phrases.

A segment cuts its documents into zones of about ``ZONE`` by a hash of their ids.  Its
postings have a row for each term and zone: the documents with the term's places in each,
and beside them the largest count and the least length, which bound what the term can add
to a score there.  A search reads these bounds for its terms, takes the zones of the highest
bounds first, and then only those whose bound reaches the score that the first have given.
A deletion writes the ids and what the terms lose in document frequency; no segment is
written again until ``merge``.  Versions are published as those of any stored relation, so
racing writers don't lose each other's segments.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store
from .retrieval import _bm25_part, query_terms, top, worded

#: Documents in a zone, folders of a segment's postings, zones that a search looks into before it skips any.
ZONE, BUCKETS, FIRST_ZONES = 128, 32, 8


class TextIndex:
    """The index ``name`` of a store; ``id_col`` names the documents, whose ids must be unique and not null."""

    def __init__(self, store: Store, name: str, id_col: str, zone: int = ZONE):
        self.store, self.name, self.id_col, self.zone, self.spark = store, name, id_col, zone, store.spark

    # --- writing --------------------------------------------------------------------------------

    def create(self) -> None:
        self.store._point(self.name, {"segments": [], "parts": [], "deltas": []}, None)

    def append(self, df: DataFrame, text_col: str) -> None:
        """New documents, as a segment; a null text has no terms."""
        folder = self._segment(worded(df.where(F.col(f"`{self.id_col}`").isNotNull()), self.id_col, text_col))
        if folder:
            self.store._publish(self.name, lambda s: s | {"segments": [*s["segments"], folder], "parts": [*s["parts"], folder["folder"]]})

    def delete(self, ids: DataFrame) -> None:
        """The documents of these ids go, as far as segments hold them now; those of later segments stay."""
        state = self.store._state(self.name)
        wanted = ids.select(F.col(ids.columns[0]).alias("id")).distinct()
        docs = self._live_docs(state)
        if docs is None:
            return
        gone = docs.select("segment", "id", "len").join(wanted, "id", "left_semi")  # the narrow columns only
        folder = uuid.uuid4().hex
        path = f"{self.store.base}/{self.name}/data/{folder}"
        gone.select("segment", "id", "len").write.parquet(f"{path}/ids")
        gone = docs.join(self.spark.read.parquet(f"{path}/ids").select("segment", "id"), ["segment", "id"], "left_semi")
        gone = gone.select("id", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        gone.withColumn("bucket", _bucket(F.col("term"))).repartitionByRange("bucket", "term").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms")
        lost = self.spark.read.parquet(f"{path}/ids").agg(F.count(F.lit(1)), F.sum("len")).first()
        if lost[0]:
            told = {"folder": folder, "n": lost[0], "len": lost[1]}

            def change(s: dict) -> dict:
                if s.get("tombstones", []) != state.get("tombstones", []):
                    raise ValueError("deleted from by another")  # a document must not be counted off twice
                return s | {"tombstones": [*s.get("tombstones", []), told], "deltas": [*s["deltas"], folder]}

            self.store._publish(self.name, change)

    def merge(self) -> None:
        """All live documents as one segment without deletions; a Conflict if others publish meanwhile."""
        base = self.store.version(self.name)
        state = self.store._state(self.name, base)
        docs = self._live_docs(state)
        if docs is None:
            return
        folder = self._segment(docs.drop("segment"))
        self.store._point(self.name, {"segments": [folder] if folder else [], "parts": [folder["folder"]] if folder else [], "deltas": []}, base)

    def _segment(self, docs: DataFrame) -> dict | None:
        """Writes documents (id, len, terms, places), and from these their postings: a document goes to its zone's task whole, and is taken apart there."""
        folder = uuid.uuid4().hex
        path = f"{self.store.base}/{self.name}/data/{folder}"
        docs.write.parquet(f"{path}/docs")
        n, length = self.spark.read.parquet(f"{path}/docs").agg(F.count(F.lit(1)), F.sum("len")).first()
        if not n:
            return None
        bits = max(0, math.ceil(math.log2(n / self.zone))) if n > self.zone else 0
        zone = F.shiftrightunsigned(F.xxhash64("id"), 64 - bits) if bits else F.lit(0).cast("long")
        stored = self.spark.read.parquet(f"{path}/docs").withColumn("zone", zone).repartition("zone")
        held = stored.select("zone", "id", "len", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("places").alias("places")))).groupBy("zone", "term")
        one = F.struct("id", "len", "places")
        rows = held.agg(F.array_sort(F.collect_list(one)).alias("_e"), F.max(F.size("places")).alias("most"), F.min("len").alias("least"), F.count(F.lit(1)).alias("n"))
        rows = rows.select(_bucket(F.col("term")).alias("bucket"), "term", "zone", "n", "most", "least", F.col("_e.id").alias("ids"), F.col("_e.len").alias("lens"), F.col("_e.places").alias("places"))
        rows.sortWithinPartitions("bucket", "term", "zone").write.partitionBy("bucket").parquet(f"{path}/postings")
        return {"folder": folder, "n": n, "len": int(length or 0)}

    # --- reading --------------------------------------------------------------------------------

    def _each(self, state: dict, part: str) -> DataFrame | None:
        found = [self.spark.read.parquet(f"{self.store.base}/{self.name}/data/{s['folder']}/{part}").withColumn("segment", F.lit(s["folder"])) for s in state["segments"]]
        return reduce(DataFrame.unionByName, found) if found else None

    def _tombstones(self, state: dict, part: str) -> DataFrame | None:
        found = [self.spark.read.parquet(f"{self.store.base}/{self.name}/data/{t['folder']}/{part}") for t in state.get("tombstones", [])]
        return reduce(DataFrame.unionByName, found) if found else None

    def _alive(self, rows: DataFrame, state: dict) -> DataFrame:
        """Rows with segment and id, without those of deleted documents."""
        gone = self._tombstones(state, "ids")
        return rows if gone is None else rows.join(gone.select("segment", "id"), ["segment", "id"], "left_anti")

    def _live_docs(self, state: dict) -> DataFrame | None:
        docs = self._each(state, "docs")
        return None if docs is None else self._alive(docs, state)

    def _postings(self, state: dict, terms: list[str] | None) -> DataFrame | None:
        rows = self._each(state, "postings")
        if rows is None or terms is None:
            return rows
        return rows.where(F.col("bucket").isin(sorted({zlib.crc32(t.encode()) % BUCKETS for t in terms})) & F.col("term").isin(terms))

    def _frequencies(self, state: dict, terms: list[str], rows: DataFrame) -> tuple[dict[str, int], int, float]:
        """Documents of each term, documents and their mean length, without the deleted: a row a term comes to the driver."""
        counts = dict(rows.groupBy("term").agg(F.sum("n")).collect())
        gone = self._tombstones(state, "terms")
        if gone is not None:
            for t, n in gone.where(F.col("bucket").isin(sorted({zlib.crc32(t.encode()) % BUCKETS for t in terms})) & F.col("term").isin(terms)).groupBy("term").agg(F.sum("n")).collect():
                counts[t] -= n
        total = lambda k: sum(s[k] for s in state["segments"]) - sum(t[k] for t in state.get("tombstones", []))
        return counts, total("n"), total("len") / max(1, total("n"))

    def search(self, query: str, limit: int) -> tuple[DataFrame, dict]:
        """The best documents by BM25 (id, score, retrieval_rank), as over the live documents alone, and facts: postings in all and read."""
        from ..plans.lineage import settle

        terms, state = query_terms(query), self.store._state(self.name)
        rows = self._postings(state, terms) if terms else None
        facts = {"postings": 0, "postings_read": 0, "zones": 0, "zones_read": 0}
        if rows is None:
            return self._none(state), facts
        counts, n, mean = self._frequencies(state, terms, rows)
        known = [t for t in terms if counts.get(t)]
        if not known:
            return self._none(state), facts
        df = F.create_map(*[F.lit(x) for t in known for x in (t, counts[t])])
        part = lambda tf, length: _bm25_part(tf, df[F.col("term")], length, F.lit(n), F.lit(mean))
        rows = rows.where(F.col("term").isin(known))
        # the narrow columns only: what each zone's documents can reach at most, rounded up as scores are rounded
        zones = settle(rows.groupBy("segment", "zone").agg((F.sum(part(F.col("most"), F.col("least"))) + F.lit(1e-6)).alias("bound"), F.sum("n").alias("n")))
        first = [(r["segment"], r["zone"]) for r in zones.orderBy(F.desc("bound"), "segment", "zone").limit(FIRST_ZONES + limit // 4).collect()]
        begun = settle(self._scored(rows, state, self.spark.createDataFrame(first, "segment string, zone long"), part))
        best = [r["score"] for r in begun.orderBy(F.desc("score")).limit(limit).collect()]
        reached = best[-1] if len(best) == limit else -1.0
        rest = zones.where(F.col("bound") >= reached).select("segment", "zone").join(F.broadcast(self.spark.createDataFrame(first, "segment string, zone long")), ["segment", "zone"], "left_anti")
        scored = begun.unionByName(self._scored(rows, state, rest, part))
        opened = zones.where(F.col("bound") >= reached).select("segment", "zone").unionByName(self.spark.createDataFrame(first, "segment string, zone long")).distinct()
        facts["zones"], facts["postings"] = zones.agg(F.count(F.lit(1)), F.sum("n")).first()
        facts["zones_read"], facts["postings_read"] = zones.join(opened, ["segment", "zone"], "left_semi").agg(F.count(F.lit(1)), F.sum("n")).first()
        return top(scored.withColumnRenamed("id", self.id_col), self.id_col, limit), facts

    def _none(self, state: dict) -> DataFrame:
        docs = self._each(state, "docs")
        kind = dict(docs.dtypes)["id"] if docs is not None else "string"
        return self.spark.createDataFrame([], f"`{self.id_col}` {kind}, score double, retrieval_rank long")

    def _scored(self, rows: DataFrame, state: dict, zones: DataFrame, part) -> DataFrame:
        """(id, score) of the live documents of some zones."""
        each = rows.join(zones, ["segment", "zone"], "left_semi").select("segment", "term", F.explode(F.arrays_zip("ids", "lens", "places")).alias("e"))
        hits = self._alive(each.select("segment", F.col("e.ids").alias("id"), "term", F.size("e.places").alias("tf"), F.col("e.lens").alias("len")), state)
        # terms in order, so that equal documents have equal sums
        parts = F.array_sort(F.collect_list(F.struct(F.col("term"), part(F.col("tf"), F.col("len")).alias("p"))))
        return hits.groupBy("segment", "id").agg(F.round(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x["p"]), 6).alias("score")).select("id", "score")

    def phrase(self, query: str) -> DataFrame:
        """(id, places): how often the words stand consecutively; only zones that hold all of them are read."""
        words = re.findall("[a-z0-9]+", query.lower())
        state = self.store._state(self.name)
        rows = self._postings(state, sorted(set(words))) if words else None
        if rows is None:
            return self._none(state).select(F.col(self.id_col), F.col("retrieval_rank").alias("places"))
        zones = rows.groupBy("segment", "zone").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(set(words))).select("segment", "zone")
        each = rows.join(zones, ["segment", "zone"], "left_semi").select("segment", "term", F.explode(F.arrays_zip("ids", "places")).alias("e"))
        # a row a word of the phrase: the places where the phrase would begin; as many as the phrase has words meet in a document
        offsets = F.create_map(*[x for t in sorted(set(words)) for x in (F.lit(t), F.array(*[F.lit(i) for i, w in enumerate(words) if w == t]))])
        begins = each.select("segment", F.col("e.ids").alias("id"), F.explode(offsets[F.col("term")]).alias("_o"), F.col("e.places").alias("_p"))
        begins = self._alive(begins.withColumn("_p", F.expr("transform(_p, p -> p - _o)")), state)
        met = begins.groupBy("segment", "id").agg(F.collect_list("_p").alias("_all")).where(F.size("_all") == len(words))
        places = met.select("id", F.size(F.aggregate("_all", F.col("_all")[0], F.array_intersect)).cast("long").alias("places"))
        return places.where("places > 0").withColumnRenamed("id", self.id_col)


def _bucket(term: Column) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(BUCKETS)).cast("int")
