"""Keyed relations in files of disjoint key ranges, compared by digests and merged by what differs.

A relation has files of sorted keys with the statistics of each (least and largest key, live
rows, a digest), and digests of the key's hash buckets inside each file.  A scan is digested
the same way: files of equal digests are never opened; of the others only the keys of buckets
that differ are joined with what is stored, and of that only keys and content hashes are read.
Changes are written as rows of their file beside it; a file is written anew, alone, once its
changes are a share of its rows.  So a load costs in proportion to what has changed, beside
one pass over the scan, and a read of some keys opens the files that can hold them.

Digests are sums without carry of 64-bit hashes of key and content, with the number of rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .store import ATTEMPTS, Conflict, Store

#: Hash buckets of a file, rows of a file, and the share of changes at which it is written anew.
BUCKETS, FILE_ROWS, FOLD_SHARE = 256, 1_000_000, 0.2
_INNER = ("_h", "_file", "_seq")


class Ranged:
    """The relation ``name`` of a store, by ``key``; rows have the loaded columns and ``deleted``.

    Keys are unique within a scan; rows without one take no part.  Every load has the same columns.
    """

    def __init__(self, store: Store, name: str, key: str, file_rows: int = FILE_ROWS, buckets: int = BUCKETS, fold_share: float = FOLD_SHARE):
        self.store, self.name, self.key, self.file_rows, self.buckets, self.fold_share = store, name, key, file_rows, buckets, fold_share
        self.spark = store.spark

    # --- reading --------------------------------------------------------------------------------

    def _folder(self, f: str) -> str:
        return f"{self.store.base}/{self.name}/data/{f}"

    def _table(self, f: str) -> DataFrame:
        return self.spark.read.parquet(self._folder(f))

    def files(self, low=None, high=None, version: str | None = None) -> DataFrame:
        """Statistics of the files that can hold keys of [low, high]."""
        stats = self._table(self.store._state(self.name, version)["files"])
        stats = stats if low is None else stats.where(F.col("hi") >= F.lit(low))
        return stats if high is None else stats.where(F.col("lo") <= F.lit(high))

    def read(self, low=None, high=None, version: str | None = None) -> DataFrame:
        """The rows whose key is in [low, high], all by default."""
        state = self.store._state(self.name, version)
        paths = [r["file"] for r in self.files(low, high, version).select("file").collect()]  # a path a file to be opened
        rows = self._rows(state, paths).drop(*_INNER)
        rows = rows if low is None else rows.where(F.col(self.key) >= F.lit(low))
        return rows if high is None else rows.where(F.col(self.key) <= F.lit(high))

    def _rows(self, state: dict, paths: list[str], columns: list[str] | None = None) -> DataFrame:
        """The latest rows of some files, their file with them; ``columns`` besides key, hash and deleted."""
        from ..operators.state import last_by

        schema = StructType.fromJson(state["schema"])
        own = [self.key, *[f.name for f in schema if f.name not in (self.key, "deleted") and (columns is None or f.name in columns)], "deleted", "_h", "_file"]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumns({"_h": F.lit(0).cast("long"), "_file": F.lit("")}).select(*own)
        reader = self.spark.read.schema(schema.add("_h", "long")).option("recursiveFileLookup", "true")  # a run is no column
        base = reader.parquet(*map(self._folder, paths)).withColumn("_file", self._file())
        changes = None
        for seq, f in enumerate(state["deltas"]):
            part = self._table(f).withColumn("_seq", F.lit(seq))
            changes = part if changes is None else changes.unionByName(part)
        if changes is None:
            return base.select(*own)
        if len(paths) <= 1000:  # changes are sorted by file, so these reach the scan as a filter
            changes = changes.where(F.col("_file").isin(paths))
        else:
            changes = changes.join(self.spark.createDataFrame([(p,) for p in paths], "_file string"), "_file", "left_semi")
        last = last_by(changes.select(*own, "_seq"), [self.key], "_seq").drop("_seq")
        return base.select(*own).join(last.select(self.key), self.key, "left_anti").unionByName(last.select(*own))

    def _file(self) -> Column:
        return F.regexp_extract("_metadata.file_path", "/data/([^/]+/([^/]+=[^/]+/)?[^/]+)$", 1)

    # --- digests --------------------------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _digested(self, rows: DataFrame) -> DataFrame:
        """(file, bucket, n, d) of live rows with key, _h and _file."""
        return rows.groupBy(F.col("_file").alias("file"), self._bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(self.key, "_h")).alias("d"))

    def _placed(self, slim: DataFrame, files: DataFrame) -> DataFrame:
        """Key and hash of a scan with the file of each key: the last that begins at or before it, else the first."""
        from ..operators.state import asof_latest
        from ..plans.lineage import settle

        begins = files.select(F.lit(0).alias("_one"), F.col("lo").alias(self.key), F.col("file").alias("_file"))
        first = files.agg(F.min_by("file", "lo")).first()[0]
        # settled first: sorting by ranges reads its input twice
        found = asof_latest(settle(slim).withColumn("_one", F.lit(0)), begins, "_one", self.key, "_file", ["_file"])
        return settle(found.select(self.key, "_h", F.coalesce("_file", F.lit(first)).alias("_file")))

    def _differing(self, seen: DataFrame, state: dict) -> DataFrame:
        """(file, bucket) where a scan and the stored rows differ: first whole files are compared, then the buckets of those that differ."""
        files = self._table(state["files"]).select("file", F.col("live").alias("_n"), F.col("d").alias("_d"))
        whole = seen.groupBy("file").agg(F.sum("n").alias("n"), F.bit_xor("d").alias("d"))
        same = F.coalesce(F.col("n"), F.lit(0)).eqNullSafe(F.coalesce(F.col("_n"), F.lit(0))) & F.coalesce(F.col("d"), F.lit(0)).eqNullSafe(F.coalesce(F.col("_d"), F.lit(0)))
        odd = files.join(whole, "file", "full_outer").where(~same).select("file")
        known = self._table(state["digests"]).join(odd, "file", "left_semi").select("file", "bucket", F.col("n").alias("_n"), F.col("d").alias("_d"))
        return known.join(seen.join(odd, "file", "left_semi"), ["file", "bucket"], "full_outer").where(~same).select("file", "bucket")

    # --- loading --------------------------------------------------------------------------------

    def load(self, scan: DataFrame, content: list[str], snapshot: bool = True, cursor: dict | None = None) -> dict[str, int]:
        """Bring the relation up to the scan; counts of inserted, changed, reused and deleted keys.

        In snapshot mode keys that the scan lacks become tombstones with their last row.  If
        another writer publishes a version meanwhile, the scan is compared anew with that.
        """
        rows = scan.where(F.col(self.key).isNotNull()).withColumns({"deleted": F.lit(False), "_h": F.xxhash64(*content)})
        for _ in range(ATTEMPTS):
            base = self.store.version(self.name)
            try:
                return self._changed(rows, snapshot, base, cursor) if base else self._first(rows, cursor)
            except Conflict:
                continue
        raise Conflict(f"{self.name}: others have always been first")

    def _written(self, rows: DataFrame, n: int) -> tuple[str, DataFrame, DataFrame]:
        """Rows as files of disjoint key ranges, none of which spans two runs (``_run``): folder, statistics of the files, digests."""
        parts, folder = max(1, -(-n // self.file_rows)), uuid.uuid4().hex
        rows.drop("_file").repartitionByRange(parts, "_run", self.key).sortWithinPartitions("_run", self.key).write.partitionBy("_run").parquet(self._folder(folder))
        back = self._table(folder).select(self.key, "_h", "deleted", self._file().alias("_file"))
        digests = self._digested(back.where("not deleted"))
        stats = back.groupBy(F.col("_file").alias("file")).agg(
            F.min(self.key).alias("lo"), F.max(self.key).alias("hi"), F.count(F.lit(1)).alias("n"), F.count_if(~F.col("deleted")).alias("live"),
            F.bit_xor(F.when(~F.col("deleted"), F.xxhash64(self.key, "_h"))).alias("d"), F.lit(0).cast("long").alias("changes"),
        )
        return folder, stats, digests

    def _whole(self, rows: DataFrame, n: int) -> tuple[str | None, DataFrame, DataFrame]:
        """``_written`` of a first load, which may have no rows."""
        if n:
            return self._written(rows.withColumn("_run", F.lit(0)), n)
        kind = dict(rows.dtypes)[self.key]
        stats = self.spark.createDataFrame([], f"file string, lo {kind}, hi {kind}, n long, live long, d long, changes long")
        return None, stats, self.spark.createDataFrame([], "file string, bucket int, n long, d long")

    def _first(self, rows: DataFrame, cursor: dict | None) -> dict[str, int]:
        n = rows.count()
        folder, stats, digests = self._whole(rows, n)
        state = {"ranged": self.key, "parts": [folder] if folder else [], "deltas": [], "schema": rows.drop("_h").schema.jsonValue()}
        state |= {"files": self.store._write(self.name, stats.coalesce(1)), "digests": self.store._write(self.name, digests)} | ({"cursor": cursor} if cursor else {})
        self.store._point(self.name, state, None)
        return {"inserted": n, "changed": 0, "reused": 0, "deleted": 0}

    def _changed(self, rows: DataFrame, snapshot: bool, base: str, cursor: dict | None) -> dict[str, int]:
        from ..plans.lineage import settle

        state = self.store._state(self.name, base)
        files = self._table(state["files"])
        if files.isEmpty():  # nothing has ever been loaded
            state = state | {"deltas": []}
            n = rows.count()
            if n:
                folder, stats, digests = self._whole(rows, n)
                self._publish(state | {"parts": [folder]}, stats, digests, base, cursor)
            return {"inserted": n, "changed": 0, "reused": 0, "deleted": 0}
        placed = self._placed(rows.select(self.key, "_h"), files)
        seen = settle(self._digested(placed))
        scanned = seen.agg(F.sum("n")).first()[0] or 0
        differing = settle(self._differing(seen, state) if snapshot else seen.select("file", "bucket"))
        opened = [r["file"] for r in differing.select("file").distinct().collect()]  # a path a file to be opened
        own = [F.col("file") == F.col("_file"), F.col("bucket") == self._bucket()]
        new = placed.join(differing, own, "left_semi").select(self.key, F.col("_h").alias("_new"), F.col("_file").alias("_at"))
        old = self._rows(state, opened, []).where("not deleted").join(differing, own, "left_semi").select(self.key, F.col("_h").alias("_old"), F.col("_file").alias("_in"))
        kind = F.when(F.col("_new").isNull(), "deleted").when(F.col("_old").isNull(), "inserted").when(F.col("_old") == F.col("_new"), "reused").otherwise("changed")
        both = old.join(new, self.key, "full_outer" if snapshot else "right")
        found = settle(both.select(self.key, F.coalesce("_in", "_at").alias("_file"), "_old", "_new", kind.alias("change")).where("change <> 'reused'"))
        counts = {k: 0 for k in ("inserted", "changed", "deleted")} | {r[0]: r[1] for r in found.groupBy("change").count().collect()}
        counts["reused"] = scanned - counts["inserted"] - counts["changed"]
        if found.isEmpty():
            if cursor and cursor != state.get("cursor"):
                self.store._point(self.name, state | {"cursor": cursor}, base)
            return counts
        current = rows.join(found.where("_new IS NOT NULL").select(self.key, "_file"), self.key)
        holding = [r["_file"] for r in found.where("change = 'deleted'").select("_file").distinct().collect()]
        gone = self._rows(state, holding).join(found.where("change = 'deleted'").select(self.key), self.key, "left_semi").withColumn("deleted", F.lit(True))
        delta = self.store._write(self.name, current.unionByName(gone).repartitionByRange("_file", self.key).sortWithinPartitions("_file", self.key))
        part = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(self.key, c))
        present = lambda c: F.col(c).isNotNull().cast("long")
        moved = found.groupBy(F.col("_file").alias("file"), self._bucket().alias("bucket")).agg(
            F.sum(present("_new") - present("_old")).alias("dn"), F.bit_xor(F.coalesce(part("_old"), F.lit(0)).bitwiseXOR(F.coalesce(part("_new"), F.lit(0)))).alias("dd"),
            F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count(F.lit(1)).alias("more"),
        )
        sums = self._table(state["digests"]).join(moved.select("file", "bucket", "dn", "dd"), ["file", "bucket"], "full_outer")
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        digests = sums.select("file", "bucket", (zero("n") + zero("dn")).alias("n"), zero("d").bitwiseXOR(zero("dd")).alias("d")).where("n > 0")
        per_file = moved.groupBy("file").agg(F.sum("dn").alias("dn"), F.bit_xor("dd").alias("dd"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("more").alias("more"))
        stats = files.join(per_file, "file", "left").select(
            "file", F.least("lo", "low").alias("lo"), F.greatest("hi", "high").alias("hi"), "n", (F.col("live") + zero("dn")).alias("live"),
            zero("d").bitwiseXOR(zero("dd")).alias("d"), (F.col("changes") + zero("more")).alias("changes"),
        )
        self._publish(state | {"deltas": [*state["deltas"], delta]}, stats, digests, base, cursor)
        return counts

    def _publish(self, state: dict, stats: DataFrame, digests: DataFrame, base: str, cursor: dict | None) -> None:
        """Write statistics and digests, before that anew the files whose changes are too many."""
        from ..plans.lineage import settle

        stats = settle(stats)
        full = F.col("changes") > F.lit(self.fold_share) * F.col("n")
        folded = [r["file"] for r in stats.where(full).select("file").collect()]
        if folded:
            # neighbours may become one file, but no file may reach over one that stays
            runs = stats.withColumn("_run", F.sum((~full).cast("int")).over(Window.orderBy("lo"))).where(full).select(F.col("file").alias("_file"), "_run")  # a row a file
            folder, more, sums = self._written(self._rows(state, folded).join(runs, "_file"), stats.where(full).agg(F.sum(F.col("n") + F.col("changes"))).first()[0])
            stats = stats.where(~full).unionByName(more)
            digests = digests.join(stats.select("file"), "file", "left_semi").unionByName(sums)
            state = state | {"parts": [*state["parts"], folder]}
            if not stats.where("changes > 0").count():
                state = state | {"deltas": []}
        state = state | {"files": self.store._write(self.name, stats.coalesce(1)), "digests": self.store._write(self.name, digests)}
        self.store._point(self.name, state | ({"cursor": cursor} if cursor else {}), base)
