"""Suffix-array removal of repeated byte strings by a difference-cover algorithm.

Every byte covered by a string of ``length`` bytes that also starts elsewhere goes.

Distribution.  Each window of ``length`` bytes has an anchor, the least hash among its
64-grams (the last one of equals), which depends on the window's bytes alone.  Windows that
are equal have equal anchors, so an anchor that occurs once in all texts rules its windows
out, and the texts around equal anchors can be sorted independently of all others.  Equal
texts are sorted once.  Where a text goes on in one period, every window has an anchor of the
same hash one step further; such windows are one piece, which is sorted for what it repeats
of itself, so a piece is never many times as large as its text.

Sorting.  The texts around the anchors of a group are joined and their suffixes sorted by
the difference cover {1, 2} modulo 3: sampled triples are sorted and named, the names are
sorted recursively until a name spans more than ``length`` bytes, the remaining suffixes are
merged in by their first symbol and the rank behind it, and adjacent suffixes are compared
over ``length`` bytes.

An anchor with more occurrences than fit one sort is dealt to several; windows that one of
them doesn't repeat are then compared across them by 128-bit fingerprints, so no occurrence
is left out however many there are.

Defined results: a null text counts as empty; repeated rows are copies of each other, so
each loses everything if it has ``length`` bytes or more; an empty table gives an empty
result; other columns are ignored; matches never cross texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SEEDS, documents, map_batches, map_rows, mix64, prepare, release, settle, text_bytes

LENGTH, GRAM = 200, 64
#: Windows are found in stretches of so many starts, so a long text needs no more memory.
STRETCH = 1 << 18
_LOW = np.uint64((1 << 20) - 1)
#: Occurrences of one anchor that one sort takes, and symbols in a sort (three names fit 63 bits).
GROUP, SYMBOLS = 5000, 1_500_000
_BYTES = SEEDS[3000:3256]


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    h, n, power = _BYTES[b], 1, int(SEEDS[7])
    while n < GRAM:
        h = h[:-n] * np.uint64(power) + h[n:]
        n, power = 2 * n, power * power % (1 << 64)
    return mix64(h)


def anchors(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first start, number of starts, weight) of the runs of windows that follow each other and whose anchors have one hash.

    The weight is 1 where these are one place, else as many as places would have given so many windows, and at least 2.
    """
    out: list[tuple] = []
    for at in range(0, max(0, len(raw) - length + 1), STRETCH):
        h = _gram_hashes(np.frombuffer(raw, np.uint8)[at : at + STRETCH + length - 1])
        # the last of equal hashes is the least: the place counts down in the low bits
        a = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
        n, width = 1, length - GRAM + 1
        while 2 * n <= width:
            a, n = np.minimum(a[:-n], a[n:]), 2 * n
        if n < width:
            a = np.minimum(a[: len(a) - (width - n)], a[width - n :])
        place = (_LOW - (a & _LOW)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        hashes = h[place[first]]
        runs = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        counts = np.diff(np.append(first[runs], len(place)))
        several = np.diff(np.append(runs, len(first))) > 1
        out.append((hashes[runs], first[runs] + at, counts, np.where(several, np.maximum(2, -(-counts // width)), 1)))
    if not out:
        return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def suffix_order(t: np.ndarray, depth: int, limit: int) -> np.ndarray:
    """Suffixes of ``t`` (symbols of 1 or more, each spanning ``depth`` bytes) in order over at least ``limit`` bytes."""
    n = len(t)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    padded = np.concatenate([t, np.zeros(3, np.int64)])
    base = int(t.max()) + 1
    ones, twos = np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triple = (padded[sample] * base + padded[sample + 1]) * base + padded[sample + 2]
    order = np.argsort(triple, kind="stable")
    sorted_ = triple[order]
    new = np.concatenate(([True], sorted_[1:] != sorted_[:-1]))
    name = np.empty(len(sample), np.int64)
    name[order] = np.cumsum(new)
    rank = np.zeros(n + 3, np.int64)
    if new.all() or 3 * depth > limit:
        by_rank = sample[order]
        rank[sample] = name
    else:
        # the names of the one class, an end mark, the names of the other
        deeper = suffix_order(np.concatenate([name[: len(ones)] + 1, [1], name[len(ones) :] + 1]), 3 * depth, limit)
        deeper = deeper[deeper != len(ones)]
        by_rank = sample[np.where(deeper > len(ones), deeper - 1, deeper)]
        rank[by_rank] = np.arange(1, len(by_rank) + 1)
    high = len(by_rank) + 2
    zeros = np.arange(0, n, 3)
    key = padded[zeros] * high + rank[zeros + 1]
    zeros = zeros[np.argsort(key, kind="stable")]
    # how many sampled suffixes come before each other suffix: against class 1 by one symbol, against class 2 by two
    one = np.sort(padded[ones] * high + rank[ones + 1])
    two = np.sort((padded[twos] * base + padded[twos + 1]) * high + rank[twos + 2])
    before = np.searchsorted(one, padded[zeros] * high + rank[zeros + 1]) + np.searchsorted(two, (padded[zeros] * base + padded[zeros + 1]) * high + rank[zeros + 2])
    return np.concatenate([zeros, by_rank])[np.argsort(np.concatenate([2 * before, 2 * np.arange(len(by_rank)) + 1]), kind="stable")]


def repeated_starts(texts: list[bytes], starts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each text: which of its first ``starts`` windows also stand at another of these places."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(x) for x in texts])
    at = np.cumsum(sizes) - sizes
    where = at + np.arange(len(texts))  # with a mark between texts
    t = np.ones(len(flat) + len(texts), np.int64)
    t[np.repeat(where - at, sizes) + np.arange(len(flat))] = flat.astype(np.int64) + 2
    counts = np.array(starts)
    wanted = np.zeros(len(t), bool)
    wanted[np.repeat(where, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = True
    order = suffix_order(t, 1, length)
    order = order[wanted[order]]
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([t - 1, np.zeros(8, np.int64)]).astype(np.uint8), 8).copy().view(np.uint64).reshape(-1)
    pair = np.arange(len(order) - 1)
    for k in [*range(0, length - 7, 8), length - 8]:
        pair = pair[words[order[pair] + k] == words[order[pair + 1] + k]]
    hit = np.zeros(len(t), bool)
    hit[order[pair]] = True
    hit[order[pair + 1]] = True
    return [hit[w : w + c] for w, c in zip(where.tolist(), starts, strict=True)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, and spans (array of removed (start, end) in bytes)."""
    spark = df.sparkSession
    base = prepare(df, id_col, text_col)
    # a row is known by its id and the digest of its text, so rows of one id don't meet in one place
    base = base.withColumn("_digest", F.substring(F.unhex(F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256)), 1, 16))

    def first_pass(batch: pa.RecordBatch) -> dict:
        raws = text_bytes(batch.column("_text"))
        return {"_id": batch.column("_id"), "_digest": batch.column("_digest"), "_n": [len(x) for x in raws], "_hashes": [np.repeat(h.view(np.int64), w) for h, _, _, w in (anchors(x, length) for x in raws)]}

    found = settle(map_rows(base, first_pass, "_id long, _digest binary, _n long, _hashes array<long>").where(F.col("_n") >= length))
    rows = settle(found.select("_id", "_digest", "_n"))
    copies = rows.groupBy("_digest").agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_copies"))
    wanted = settle(_shared_anchors(found, group).join(copies.select("_digest", "_rep"), "_digest").withColumnRenamed("_digest", "_of"))
    del found  # the anchors of all texts need the shared folder no longer
    release(spark)

    sources = base.join(wanted, F.col("_id").eqNullSafe(F.col("_rep")) & (F.col("_digest") == F.col("_of"))).select("_text", "_digest", "_cuts")

    def cut(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("_hash", "_parts", "_digest", "_first", "_count", "_several", "_piece")}
        for raw, own, cuts in zip(text_bytes(batch.column("_text")), batch.column("_digest").to_pylist(), batch.column("_cuts").to_pylist(), strict=True):
            parts = {c["_hash"]: c["_parts"] for c in cuts}
            hashes, firsts, counts, weights = anchors(raw, length)
            for h, first, count, several in zip(hashes.view(np.int64).tolist(), firsts.tolist(), counts.tolist(), (weights > 1).tolist(), strict=True):
                if h in parts:
                    out["_hash"].append(h)
                    out["_parts"].append(parts[h])
                    out["_digest"].append(own)
                    out["_first"].append(first)
                    out["_count"].append(count)
                    out["_several"].append(several)
                    out["_piece"].append(raw[first : first + count + length - 1])
        return out

    # equal rows of one id give the same pieces more than once
    pieces = map_rows(sources, cut, "_hash long, _parts int, _digest binary, _first int, _count int, _several boolean, _piece binary")
    spans = _covered(pieces, length)
    whole = copies.where("_copies > 1").select("_digest")
    removed = (
        spans.join(whole, "_digest", "left_anti")
        .groupBy("_digest").agg(F.collect_list(F.struct("_from", "_to")).alias("_spans"))  # the spans of one text
        .unionByName(rows.select("_digest", "_n").distinct().join(whole, "_digest").select("_digest", F.array(F.struct(F.lit(0).alias("_from"), F.col("_n").cast("int").alias("_to"))).alias("_spans")))
    )
    of_rows = settle(rows.select("_id", "_digest").distinct().join(removed, "_digest").select(F.col("_id").alias("_rid"), F.col("_digest").alias("_of"), "_spans"))

    def finish(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")}
        for raw, spans in zip(text_bytes(batch.column("_text")), batch.column("_spans").to_pylist(), strict=True):
            merged: list[list[int]] = []
            for a, b in sorted((s["_from"], s["_to"]) for s in spans or []):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            edges = [0, *[e for s in merged for e in s], len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(len(raw) - len(kept))
            out["n_spans"].append(len(merged))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["spans"].append([{"start": a, "end": b} for a, b in merged])
        return out | {"_id": batch.column("_id")}

    joined = base.join(of_rows, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_digest") == F.col("_of")), "left").select("_id", "_text", "_spans")
    out = map_rows(joined, finish, "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>")
    return out.withColumnRenamed("_id", id_col)


def _shared_anchors(found: DataFrame, group: int) -> DataFrame:
    """Per different text: its anchors (_hash, _parts) that occur again, dealt to a sort for each ``group`` occurrences."""
    texts = found.dropDuplicates(["_digest"])
    times = texts.select(F.explode("_hashes").alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    shared = times.select("_h", F.ceil(F.col("_times") / group).cast("int").alias("_parts"))
    own = texts.select("_digest", F.explode(F.array_distinct("_hashes")).alias("_hash"))
    return own.join(shared, F.col("_hash") == F.col("_h")).groupBy("_digest").agg(F.collect_list(F.struct("_hash", "_parts")).alias("_cuts"))


def _covered(pieces: DataFrame, length: int) -> DataFrame:
    """(_digest, _from, _to): covered bytes.

    A sort takes whole parts of anchors.  Of an anchor that has several parts, each part
    also gives 128-bit fingerprints of its different windows, and a window that its own
    part doesn't repeat is covered if another part has its fingerprint.
    """

    def sort(rows: list[tuple]) -> Iterator[tuple]:
        distinct: dict[tuple, set] = {}
        for h, part, digest, first, count, repeating, piece in rows:
            distinct.setdefault((h, part, piece, count, repeating), set()).add((digest, first))
        # a piece that stands at two places repeats whole; it is sorted only where its group has others to compare, or it can repeat within itself
        several: dict[tuple, int] = {}
        for h, part, *_ in distinct:
            several[h, part] = several.get((h, part), 0) + 1
        compared = [x for x in distinct if several[x[:2]] > 1 or x[4]]
        hits = dict(zip(compared, repeated_starts([x[2] for x in compared], [x[3] for x in compared], length), strict=True)) if compared else {}
        seen: set[bytes] = set()
        for x, places in distinct.items():
            _, part, piece, count, _ = x
            flags = np.ones(count, bool) if len(places) > 1 else hits.get(x, np.zeros(count, bool))
            runs = _runs(flags)
            for digest, first in places:
                for a, b in runs:
                    yield digest, first + a, first + b + length - 1, None
            if part is not None:
                for i, known in enumerate(flags.tolist()):
                    mark = _digest(piece[i : i + length])
                    if not known:
                        yield digest, first + i, first + i + length, mark
                    elif mark not in seen:
                        seen.add(mark)
                        yield None, None, None, mark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("_hash", "_part", "_digest", "_first", "_count", "_several", "_piece")], strict=True):
                if size > SYMBOLS // 2 and row[:2] != held[-1][:2]:
                    yield from sorted_batch(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6]) + 1
        yield from sorted_batch(held)

    def sorted_batch(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows := list(sort(held)):
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["_digest", "_from", "_to", "_print"])

    part = F.when(F.col("_parts") > 1, F.pmod(F.xxhash64("_digest", "_first"), F.col("_parts")))
    dealt = pieces.withColumn("_part", part).repartition("_hash", "_part").sortWithinPartitions("_hash", "_part")
    found = settle(map_batches(dealt.select("_hash", "_part", "_digest", "_first", "_count", "_several", "_piece"), run, "_digest binary, _from int, _to int, _print binary"))
    windows = found.where("_print is not null")
    again = windows.groupBy("_print").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select("_print")
    elsewhere = windows.where("_digest is not null").join(again, "_print").drop("_print")
    return found.where("_print is null").drop("_print").unionByName(elsewhere)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("spans")


ORACLE = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM t)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY m) AS n FROM w) WHERE n > 1),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
    FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM again)) GROUP BY doc_id, run),
gone AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id),
edges AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS start, a AS stop FROM (SELECT doc_id, a, z FROM runs UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 FROM t)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start) AS k FROM edges JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM t LEFT JOIN gone USING (doc_id) JOIN kept USING (doc_id)
"""
