"""MinHash near-duplicates by a chosen-path set similarity join.

Equal sets of word shingles are one class.  In each of several independent trees a class
follows, at every level, the paths of its minwise tokens under that level's hash
functions; a node of a tree holds the classes that chose the same path.  Nodes with few
members are compared exhaustively on their full sets; larger ones branch again.  Two sets
of Jaccard similarity s choose a common child with probability s for each branch, so with
two branches and s = 0.75 they meet in one tree with probability 0.889 at any depth, and
in one of eight trees with 1 - 2e-8.

In a node that is still large at the last level, as a large group of near copies makes,
every class is first compared with a few leaders.  Only components are wanted, so classes
that these links join need no comparison among themselves: those outside the node's largest
part are then compared with all of the node, in blocks against blocks.  This finds every
link between different parts, so no row is dropped, and its cost is that of the node times
the number of its classes outside the largest part.

Nodes with the same members (as most of a group's are, over the trees) are compared once, and
nodes that share members as one, unless these are more than one task may hold.  A comparison
emits a star for each connected part of a node, not its pairs, and the parts are joined by
distributed connected components.

Defined results: texts without words (or null) have an empty set and are linked with
nothing; texts with fewer words than a shingle have one shingle, the whole sequence;
repeated rows are copies of each other, all marked alike by the query, of which ``keep_one``
keeps one; a row with a null id belongs to its component and is kept only if no row of the
component has an id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, SEEDS, documents, map_batches, map_rows, masked, mix64, prepare, settle, shingle_hashes, text_bytes, word_hashes
from .graph import components

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
TREES, BRANCHES, LEVELS = 8, 2, 3
#: A node of at most so many classes and shingles is compared in one task; larger ones branch.
NODE_CLASSES, NODE_SHINGLES = 512, 4_000_000
#: Classes in a block of a node that is large at the last level, and the leaders that all of its classes are compared with.
BLOCK, LEADERS = 512, 16
#: Bits of a map of the texts to be fetched, or of the nodes with several members, which all tasks get: 16 MB at most, less where one bit in so many is enough.
BITS, SPARSE = 27, 128


def shingle_set(raw: bytes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of the lower-cased words of a UTF-8 text."""
    return np.unique(shingle_hashes(word_hashes(LOWER[np.frombuffer(raw, np.uint8)]), n)) if raw else np.empty(0, np.uint64)


def minwise(s: np.ndarray, count: int) -> np.ndarray:
    """The minwise tokens of a set under ``count`` hash functions."""
    out = np.empty(count, np.uint64)
    for k in range(count):
        x = (s ^ SEEDS[200 + k]) * SEEDS[1200 + k]
        x ^= x >> np.uint64(29)
        out[k] = (x * SEEDS[2200 + k]).min()
    return mix64(out).view(np.int64)


def pack(raw: bytes, s: np.ndarray) -> tuple[bool, bytes]:
    """The shorter of the compressed text (True), from which the set is made again, and the set itself: hashes don't compress."""
    z = zstandard.ZstdCompressor(level=3).compress(raw)
    return (True, z) if len(z) < s.nbytes else (False, s.tobytes())


def unpack(zipped: bool, b: bytes, n: int = SHINGLE) -> np.ndarray:
    return shingle_set(zstandard.ZstdDecompressor().decompress(b), n) if zipped else np.frombuffer(b, np.uint64)


def _class(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


class Parts:
    """Disjoint sets of small integers."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up
        return self.parent

    def join(self, members: np.ndarray) -> None:
        roots = self.roots()
        self.parent = roots[:]
        touched = np.unique(roots[members])
        self.parent[touched] = touched[0]
        self.roots()


def link(sets: list[np.ndarray], first: int | None = None, num: int = NUMERATOR, den: int = DENOMINATOR) -> np.ndarray:
    """The connected part of each set, by exact Jaccard similarity.

    A set's intersections with all others come from counting the owners of its shingles.
    Sets inside the largest part so far need no comparison among themselves.  With
    ``first``, only the links between the first so many sets and the others are looked for:
    these are found when all sets of one side, or all outside the largest part, are compared.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, code, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(code, kind="stable")
    owners, ends = owner[order], np.cumsum(counts)
    starts, at = ends - counts, np.concatenate(([0], np.cumsum(sizes)))
    parts, done = Parts(n), np.zeros(n, bool)
    sides = [] if first is None else [np.arange(n) < first, np.arange(n) >= first]
    while True:
        roots = parts.roots()
        tally = np.bincount(roots, minlength=n)
        if tally.max() == n:
            break
        left = np.flatnonzero(min((~done & x for x in (roots != tally.argmax(), *sides)), key=np.count_nonzero))
        if not len(left):
            break
        for i in left[:1] if not done.any() else left[:64]:
            done[i] = True
            c = code[at[i] : at[i + 1]]
            c = c[counts[c] > 1]
            lens = counts[c]
            stops = np.cumsum(lens)
            if len(stops):
                seen = owners[np.arange(stops[-1]) + np.repeat(starts[c] - stops + lens, lens)]
                both = np.bincount(seen, minlength=n)
                near = den * both >= num * (sizes[i] + sizes - both)
                near[i] = True  # its own shingles that no other set has aren't counted
                if near.sum() > 1:
                    parts.join(np.flatnonzero(near))
    return parts.roots()


def signatures(df: DataFrame, id_col: str, text_col: str, n: int, tokens: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(x, n) for x in text_bytes(batch.column("_text"))]
        return {
            "_id": batch.column("_id"),
            "_n": [len(s) for s in sets],
            "_class": [_class(s) if len(s) else None for s in sets],
            "_tokens": [minwise(s, tokens).tolist() if len(s) else [] for s in sets],
        }

    return map_rows(prepare(df, id_col, text_col), run, "_id long, _n long, _class binary, _tokens array<long>")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, num: int = NUMERATOR, den: int = DENOMINATOR,
    trees: int = TREES, branches: int = BRANCHES, levels: int = LEVELS, node_classes: int = NODE_CLASSES, node_shingles: int = NODE_SHINGLES,
    block: int = BLOCK,
) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept."""
    out = _members(df, id_col, text_col, shingle, num, den, trees, branches, levels, node_classes, node_shingles, block)
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"), F.col("_id").eqNullSafe(F.col("_component")).alias("kept"))


def _members(
    df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, num: int = NUMERATOR, den: int = DENOMINATOR,
    trees: int = TREES, branches: int = BRANCHES, levels: int = LEVELS, node_classes: int = NODE_CLASSES, node_shingles: int = NODE_SHINGLES,
    block: int = BLOCK,
) -> DataFrame:
    """Per row: _id, _n, _class, _root (a class that stands for the component), _component."""
    rows = settle(signatures(df, id_col, text_col, shingle, trees * branches * levels))
    classes = settle(rows.where("_n > 0").groupBy("_class").agg(F.min("_id").alias("_rep"), F.first("_n").alias("_n"), F.first("_tokens").alias("_tokens")))
    small, large = _groups(classes, trees, branches, levels, node_classes, node_shingles, block)
    edges = _compare(df, id_col, text_col, shingle, classes, small if large is None else small.unionByName(_led(large)), num, den)
    labels = components(edges)
    if large is not None:
        labels = settle(labels)
        rest = _rest(large, labels, block)
        if not rest.isEmpty():
            more = _compare(df, id_col, text_col, shingle, classes, rest, num, den)
            labels = components(labels.select(F.col("root").alias("a"), F.col("vertex").alias("b")).unionByName(more))
    named = settle(labels.join(classes.select(F.col("_class").alias("vertex"), "_rep"), "vertex"))
    least = named.groupBy("root").agg(F.min("_rep").alias("_component"))
    linked = named.join(least, "root").select(F.col("vertex").alias("_class"), "root", "_component")
    final = classes.select("_class", "_rep").join(linked, "_class", "left").select("_class", F.coalesce("root", "_class").alias("_root"), F.coalesce("_component", "_rep").alias("_component"))
    return (
        rows.where("_n > 0").select("_id", "_n", "_class").join(final, "_class", "left").select("_id", "_n", "_class", "_root", "_component")
        .unionByName(rows.where("_n = 0").select("_id", "_n", "_class", F.lit(None).cast("binary").alias("_root"), F.col("_id").alias("_component")))
    )


def _groups(classes: DataFrame, trees: int, branches: int, levels: int, node_classes: int, node_shingles: int, block: int) -> tuple[DataFrame, DataFrame | None]:
    """(_group, _key, _side), classes to be compared with each other, and the large ones as (_node, _key, _block, _blocks) if there are any.

    Where _side isn't null, only the links between sides 0 and 1 of a group are wanted.

    A class goes by a 64-bit key here.  Should two classes have the same key, both are
    compared wherever one is.
    """
    width = trees * branches
    keyed = classes.select(F.xxhash64("_class").alias("_key"), F.col("_n").cast("int").alias("_n"), "_tokens")
    member = keyed.select("_key", "_n", F.posexplode(F.slice("_tokens", 1, width)).alias("_branch", "_token")).select(
        "_key", "_n", F.floor(F.col("_branch") / branches).cast("byte").alias("_tree"), F.xxhash64("_branch", "_token").alias("_node")
    )
    small, large, kept = [], None, None
    for level in range(1, levels + 1):
        # the first level only branches: two common tokens in a row tell similar classes from those that share a passage
        branching = level == 1 < levels
        told = [] if branching else [F.sum("_n").alias("_total"), F.bit_xor("_key").alias("_x"), F.bit_xor(F.xxhash64("_key")).alias("_y")]
        nodes = settle(member.groupBy("_node").agg(F.count(F.lit(1)).alias("_count"), *told).where("_count > 1"))
        # most members are alone in their node, and stay behind before the joins
        member = _among(member, nodes)
        large = nodes
        if not branching:
            fits = (F.col("_count") <= node_classes) & (F.col("_total") <= node_shingles)
            once = nodes.where(fits).groupBy("_count", "_x", "_y").agg(F.min("_node").alias("_node"))
            small.append(member.join(once.select("_node"), "_node").select(F.col("_node").alias("_group"), "_key", "_n"))
            large = nodes.where(~fits)
            if large.isEmpty():
                return _gathered(_union(small), node_classes, node_shingles), None
        kept = member.join(large.select("_node"), "_node")
        if level < levels:
            ahead = keyed.select("_key", F.slice("_tokens", level * width + 1, width).alias("_next"))
            pick = F.expr(f"slice(_next, _tree * {branches} + 1, {branches})")
            member = settle(
                kept.join(ahead, "_key")
                .select("_key", "_n", "_tree", "_node", F.posexplode(pick).alias("_branch", "_token"))
                .select("_key", "_n", "_tree", F.xxhash64("_node", "_branch", "_token").alias("_node"))
            )
    # still large: classes go to blocks by their digest
    blocks = F.greatest(F.ceil(F.col("_count") / block), F.ceil(F.col("_total") * 4 / node_shingles)).cast("int").alias("_blocks")
    once = large.withColumn("_b", blocks).groupBy("_count", "_x", "_y").agg(F.min("_node").alias("_node"), F.max("_b").alias("_blocks"))
    placed = _members_of(kept, once).withColumn("_block", F.pmod(F.xxhash64(F.lit(7), "_key"), F.col("_blocks")).cast("int"))
    return _gathered(_union(small), node_classes, node_shingles), settle(placed.select("_node", "_key", "_block", "_blocks").distinct())


def _among(member: DataFrame, nodes: DataFrame) -> DataFrame:
    """The members of these nodes, and a few others that share a bit with one."""
    marked, names = _bitmap(nodes.select("_node")), member.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(names).take(pa.array(_wanted(batch, marked.value)))

    return map_batches(member.withColumn("_bit", _bit("_node")), run, member.schema)


def _gathered(groups: DataFrame, node_classes: int, node_shingles: int) -> DataFrame:
    """(_group, _key, _side) of (_group, _key, _n): groups that share classes are one group, where that fits in one task.

    A class is in some five groups, most of them of the same few classes: gathered, its set is
    dealt once.  Whatever is gathered into more than a node may hold stays in its groups.
    """
    groups = settle(groups)
    first = groups.groupBy("_group").agg(F.min("_key").alias("_first"))
    whole = settle(components(groups.join(first, "_group").select(F.col("_first").alias("a"), F.col("_key").alias("b"))))
    placed = whole.select(F.col("vertex").alias("_key"), F.col("root").alias("_root")).join(groups.groupBy("_key").agg(F.max("_n").alias("_n")), "_key")
    held = placed.groupBy("_root").agg(F.count(F.lit(1)).alias("_count"), F.sum("_n").alias("_total"))
    fits = (F.col("_count") <= node_classes) & (F.col("_total") <= node_shingles)
    placed = settle(placed.join(held.select("_root", fits.alias("_fits")), "_root").select("_key", "_root", "_fits"))
    apart = groups.join(placed.where("NOT _fits").select("_key"), "_key").select(F.xxhash64(F.lit(5), "_group").alias("_group"), "_key")
    return placed.where("_fits").select(F.xxhash64(F.lit(6), "_root").alias("_group"), "_key").unionByName(apart).withColumn("_side", F.lit(None).cast("int"))


def _members_of(members: DataFrame, nodes: DataFrame) -> DataFrame:
    return members.select("_node", "_key").join(nodes.select("_node", "_blocks"), "_node")


def _led(large: DataFrame) -> DataFrame:
    """Groups of the blocks of each large node (side 1), each with the node's leaders (side 0)."""
    spread = F.pmod(F.xxhash64(F.lit(9), "_key"), F.lit(LEADERS))
    leaders = large.groupBy("_node", spread.alias("_s")).agg(F.min("_key").alias("_key"), F.max("_blocks").alias("_blocks"))
    first = leaders.select("_node", "_key", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block")).withColumn("_side", F.lit(0))
    every = large.select("_node", "_key", "_block").withColumn("_side", F.lit(1)).unionByName(first)
    return every.select(F.xxhash64("_node", "_block").alias("_group"), "_key", "_side")


def _rest(large: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Groups in which the classes outside a large node's largest part (side 0) meet all of the node (side 1)."""
    parts = labels.select(F.xxhash64("vertex").alias("_k"), F.xxhash64(F.lit(3), "root").alias("_part"))
    # two classes of one key in different parts are in none, so they are compared
    parts = parts.groupBy("_k").agg(F.min("_part").alias("_part"), F.max("_part").alias("_other")).where("_part = _other").drop("_other")
    known = large.join(parts, F.col("_key") == F.col("_k"), "left").withColumn("_part", F.coalesce("_part", F.xxhash64(F.lit(4), "_key"))).drop("_k")
    sizes = known.groupBy("_node", "_part").agg(F.count(F.lit(1)).alias("_n"))
    main = sizes.groupBy("_node").agg(F.max_by("_part", F.struct("_n", "_part")).alias("_main"), (F.sum("_n") - F.max("_n")).alias("_outside"))
    main = main.where("_outside > 0").withColumn("_rows", F.ceil(F.col("_outside") / block).cast("int"))
    there = known.join(main, "_node").select("_node", "_key", "_block", "_blocks", "_rows", (F.col("_part") != F.col("_main")).alias("_out"))
    row = F.pmod(F.xxhash64(F.lit(8), "_key"), F.col("_rows")).cast("int")
    outside = there.where("_out").select("_node", "_key", row.alias("_row"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"), F.lit(0).alias("_side"))
    whole = there.select("_node", "_key", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("_row"), "_block", F.lit(1).alias("_side"))
    return settle(outside.unionByName(whole).select(F.xxhash64("_node", "_row", "_block").alias("_group"), "_key", "_side"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _compare(df: DataFrame, id_col: str, text_col: str, shingle: int, classes: DataFrame, groups: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) between classes: a star for each connected part of each group."""
    groups = settle(groups)
    reps = classes.select(F.xxhash64("_class").alias("_key"), "_rep").join(groups.select("_key"), "_key", "left_semi").select("_rep")
    marked = _bitmap(reps)
    texts = prepare(df, id_col, text_col).withColumn("_bit", _bit("_id"))

    def as_sets(batch: pa.RecordBatch) -> dict:
        # the texts of other ids stay behind, but for a few that share a bit, whose sets no group asks for
        raw = text_bytes(batch.column("_text").take(pa.array(_wanted(batch, marked.value))))
        some = [(x, s) for x in raw if len(s := shingle_set(x, shingle))]
        packed = [pack(x, s) for x, s in some]
        return {"_class": [_class(s) for _, s in some], "_zipped": [z for z, _ in packed], "_set": [b for _, b in packed]}

    # rows with one id and several texts give sets more often than needed; a group takes each class once
    sets = map_rows(texts.select("_bit", "_text"), as_sets, "_class binary, _zipped boolean, _set binary").withColumn("_key", F.xxhash64("_class"))
    dealt = groups.join(sets, "_key").repartition("_group").sortWithinPartitions("_group")

    def stars(rows: list[tuple[bytes, int | None, bool, bytes]]) -> Iterator[tuple[bytes, bytes]]:
        group = sorted({(x[1] or 0, x[0]): x for x in rows}.values(), key=lambda x: (x[1] or 0, x[0]))
        first = sum(x[1] == 0 for x in group) or None
        roots = link([unpack(x[2], x[3], shingle) for x in group], first, num, den)
        for i, r in enumerate(roots.tolist()):
            if i != r:
                yield group[r][0], group[i][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, out = None, [], []
        for batch in batches:
            for k, *row in zip(*[batch.column(n).to_pylist() for n in ("_group", "_class", "_side", "_zipped", "_set")], strict=True):
                if k != key:
                    if group:
                        out += stars(group)
                    key, group = k, []
                group.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in range(2)], ["a", "b"])
                out = []
        if group and (out := list(stars(group))):
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in range(2)], ["a", "b"])

    return map_batches(dealt.select("_group", "_class", "_side", "_zipped", "_set"), run, "a binary, b binary")


def _bit(column: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(column), 64 - BITS)


def _bitmap(ids: DataFrame):
    """A broadcast map with a bit set for the hash of each id; partial maps are merged before they are sent."""
    spark = ids.sparkSession
    at = ids.select(_bit(ids.columns[0]).alias("_at"))
    # parts of 32,768 bits, numbered from 1 and set from bit 0 on
    parts = at.groupBy(F.bitmap_bucket_number(F.col("_at") + 1).alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_at") + 1)).alias("_bits"))
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    for part in parts.coalesce(8).toLocalIterator():  # a job a partition
        own = np.frombuffer(part["_bits"], np.uint8)
        bits[(part["_part"] - 1) * len(own) : part["_part"] * len(own)] = own
    return spark.sparkContext.broadcast(_folded(bits))


def _folded(bits: np.ndarray) -> tuple[np.ndarray, int]:
    """The map with runs of 2^shift bits as one, as long as one bit in SPARSE is set at most, and the shift: 0, or 3 or more."""
    wide = len(bits) * 8 // SPARSE // max(int(np.bitwise_count(bits).sum()), 1)
    shift = min(max(wide.bit_length() - 1, 0), BITS - 16)
    if shift < 3:
        return bits, 0
    return np.packbits(bits.reshape(-1, 1 << (shift - 3)).any(axis=1), bitorder="little"), shift


def _wanted(batch: pa.RecordBatch, marked: tuple[np.ndarray, int]) -> np.ndarray:
    """The rows whose _bit is set in a folded map."""
    bits, shift = marked
    at = batch.column("_bit").to_numpy() >> shift
    return np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, with all its columns, and all rows without words, which are in no group."""
    members = settle(_members(df, id_col, text_col))
    rows, at = masked(df), {c: f"c{i}" for i, c in enumerate(df.columns)}
    key = F.col(at[id_col]).cast("long")
    several = settle(members.groupBy("_id").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1 OR _id IS NULL").select(F.col("_id").alias("_kept")))
    picked = members.where("_id <=> _component AND _n > 0").groupBy("_root").agg(F.first("_id").alias("_id"), F.min("_class").alias("_class"))
    picked = settle(picked.select("_id", "_class").unionByName(members.where("_n = 0").select("_id", "_class")).distinct())
    single = rows.join(picked.select(F.col("_id").alias("_kept")).distinct(), key.eqNullSafe(F.col("_kept")), "left_semi")
    if several.isEmpty():
        return single.toDF(*df.columns)

    # an id of several rows doesn't tell them apart: theirs are found by their sets as well
    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(x) for x in text_bytes(batch.column("_text"))]
        return {n: batch.column(n) for n in batch.schema.names if n != "_text"} | {"_class": [_class(x) if len(x) else None for x in sets]}

    schema = ", ".join(f"{n} {k}" for n, k in rows.dtypes) + ", _id long, _class binary"
    sets = picked.select(F.col("_id").alias("_kept_id"), F.col("_class").alias("_kept_class"))
    among = rows.join(several, key.eqNullSafe(F.col("_kept")), "left_semi")
    among = map_rows(among.select(*rows.columns, key.alias("_id"), F.col(at[text_col]).cast("string").alias("_text")), run, schema)
    stay = among.join(sets, F.col("_id").eqNullSafe(F.col("_kept_id")) & F.col("_class").eqNullSafe(F.col("_kept_class")), "left_semi")
    one = stay.where("_class IS NOT NULL").dropDuplicates(["_id", "_class"]).unionByName(stay.where("_class IS NULL"))
    return single.join(several, key.eqNullSafe(F.col("_kept")), "left_anti").unionByName(one.select(*rows.columns)).toDF(*df.columns)


def op9_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


ORACLE = """
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END)) AS s FROM t),
d AS (SELECT doc_id, s, len(s) AS n, md5(array_to_string(s, '|')) AS c FROM s),
c AS (SELECT c, any_value(s) AS s, any_value(n) AS n FROM d WHERE n > 0 GROUP BY c),
g AS (SELECT c, n, unnest(s) AS g FROM c),
l AS (
  SELECT a, b FROM (SELECT x.c AS a, y.c AS b, any_value(x.n) AS m, any_value(y.n) AS n, count(*) AS common FROM g x JOIN g y ON x.g = y.g AND x.c < y.c GROUP BY x.c, y.c)
  WHERE 100 * common >= 75 * (m + n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT c AS a, c AS root FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.a),
k AS (SELECT r.a, min(doc_id) AS component_id FROM r JOIN d ON d.c = r.root AND d.n > 0 GROUP BY r.a)
SELECT doc_id, n::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept FROM d LEFT JOIN k ON k.a = d.c AND d.n > 0
"""
