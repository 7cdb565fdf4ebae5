"""Acquisition of pinned dataset files that lie under a folder: whole files, rows by value, archive members, document pages.

A selection names an immutable revision and a licence; the dataset's card must agree before
anything is read.  Sizes are checked before bytes are parsed.  Every row gets the hash of
its selected fields, so a later run can tell whether it got the same.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import re
import zipfile
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, struct_hash
from ..functions.schema import media_type, safe_path
from ..session import ship

CEILING = 512 * 1024 * 1024
MOST_MEMBERS, MOST_PAGES = 12, 32


class AcquisitionError(ValueError):
    pass


def _require(holds: bool, message: str) -> None:
    if not holds:
        raise AcquisitionError(message)


@dataclass(frozen=True)
class Selection:
    """A pinned file and what is wanted of it: row numbers, or rows with one of the values of a field."""

    repository: str
    revision: str
    file: str
    licence: str
    fields: tuple[str, ...] = ()
    rows: tuple[int, ...] = ()
    selector: str | None = None
    values: tuple[str, ...] = ()
    members: tuple[str, ...] = ()
    file_sha256: str | None = None
    row_sha256: tuple[str, ...] = ()
    most_bytes: int = CEILING

    def __post_init__(self):
        _require(re.fullmatch(r"[0-9a-f]{40}", self.revision) is not None, "a revision has 40 hexadecimal digits")
        _require(re.fullmatch(r"[^/]+/[^/]+", self.repository) is not None, "a repository is owner/name")
        _require(bool(self.file) and not self.file.startswith("/") and ".." not in self.file.split("/"), "a file's path is relative to its repository")
        _require(bool(self.licence.strip()) and self.most_bytes > 0, "a licence and a size limit are needed")
        for name, listed in (("fields", self.fields), ("values", self.values), ("members", self.members)):
            _require(len(set(listed)) == len(listed), f"{name} are unique")
        _require(list(self.rows) == sorted(set(self.rows)) and all(r >= 0 for r in self.rows), "row numbers are unique, ordered and not negative")
        _require(list(self.members) == sorted(self.members) and len(self.members) <= MOST_MEMBERS, f"at most {MOST_MEMBERS} members, in order")
        _require(not self.row_sha256 or len(self.row_sha256) == len(self.rows), "a hash for each selected row")
        _require(self.selector is None or self.selector in self.fields and bool(self.values), "a selector is one of the fields and has values")


def check_card(card: Mapping, selection: Selection) -> None:
    """The dataset is open, at the pinned revision, and under the expected licence."""
    _require(not (card.get("private") or card.get("gated") or card.get("disabled")), "the dataset is not open")
    _require(card.get("revision") == selection.revision, "the card is of another revision")
    listed = card.get("licence") or []
    listed = [listed] if isinstance(listed, str) else listed
    _require(selection.licence.lower() in {str(x).lower() for x in listed}, f"licence {selection.licence} expected, got {listed}")


def _content(spark: SparkSession, folder: str, selection: Selection) -> DataFrame:
    """One row (path, length, sha256, content) of the file, whose size and hash are checked."""
    found = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{selection.file}")
    # the size comes from the listing, so a file over the limit isn't read
    length = found.select("length").first()
    _require(length is not None, "no such file")
    _require(length[0] <= selection.most_bytes, f"more than {selection.most_bytes} bytes")
    if selection.file_sha256:
        _require(found.select(F.sha2("content", 256)).first()[0] == selection.file_sha256, "the file has another hash")
    return found.select("path", "length", F.sha2("content", 256).alias("sha256"), "content")


def _records(file: str, content: bytes) -> Iterator[dict]:
    text = content.decode()
    if file.endswith(".jsonl"):
        return (json.loads(line) for line in text.splitlines() if line.strip())
    if file.endswith(".json"):
        value = json.loads(text)
        return iter(value if isinstance(value, list) else value.get("data", []))
    if file.endswith(".csv"):
        return iter(csv.DictReader(io.StringIO(text)))
    raise AcquisitionError("JSON, JSONL or CSV is expected")


def file_rows(spark: SparkSession, folder: str, selection: Selection) -> DataFrame:
    """(row_number, record): each row's selected fields as canonical JSON, null where the row lacks one of them.

    A file is one task, whose memory the selection's size limit bounds.
    """
    ship(spark)
    file, fields, wanted = selection.file, selection.fields, frozenset(selection.rows)
    schema = pa.schema([("row_number", pa.int64()), ("record", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                numbers, texts = [], []
                for n, row in enumerate(_records(file, content)):
                    if not wanted or n in wanted:
                        chosen = {f: row[f] for f in fields or row} if all(f in row for f in fields) else None
                        numbers.append(n)
                        texts.append(None if chosen is None else canonical_json(chosen))
                for at in range(0, len(numbers), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(numbers[at : at + 10_000], pa.int64()), pa.array(texts[at : at + 10_000], pa.string())], schema=schema)

    return _content(spark, folder, selection).select("content").mapInArrow(run, "row_number long, record string")


def _checked(rows: DataFrame, selection: Selection) -> DataFrame:
    """(row_number, record, row_sha256); a missing row, field or value or another hash raises AcquisitionError."""
    from ..plans.lineage import settle

    hashed = settle(rows.withColumn("row_sha256", F.sha2("record", 256)))
    n, lacking = hashed.agg(F.count(F.lit(1)), F.count_if(F.col("record").isNull())).first()
    _require(n > 0, "no rows are selected")
    _require(lacking == 0, "a selected field is missing")
    if selection.rows:
        if selection.selector is None:
            _require(n == len(selection.rows), "a selected row is missing")
        if selection.row_sha256:
            expected = rows.sparkSession.createDataFrame(list(zip(selection.rows, selection.row_sha256)), "row_number long, expected string")
            _require(hashed.join(F.broadcast(expected), "row_number").where("row_sha256 <> expected").isEmpty(), "a selected row has another hash")
    if selection.selector is not None:
        value = F.get_json_object("record", f"$['{selection.selector}']")
        seen = {r[0] for r in hashed.select(value).distinct().collect()}  # the rows were selected by these values
        _require(set(selection.values) <= seen, f"values not found: {sorted(set(selection.values) - seen)}")
    return hashed


def acquire_file(spark: SparkSession, folder: str, card: Mapping, selection: Selection) -> DataFrame:
    """(row_number, record, row_sha256) of the selected rows of a pinned file."""
    check_card(card, selection)
    rows = file_rows(spark, folder, selection)
    if selection.selector is not None:
        rows = rows.where(F.col("record").isNull() | F.get_json_object("record", f"$['{selection.selector}']").isin(list(selection.values)))
    return _checked(rows, selection)


def select_rows(df: DataFrame, card: Mapping, selection: Selection, number: str = "row_number") -> DataFrame:
    """The same from a table of any size with a row number: the value filter reaches its scan; sizes are those of the hashed records."""
    check_card(card, selection)
    _require(selection.selector is not None, "a selector is needed")
    lacking = [f for f in selection.fields if f not in df.columns]
    _require(not lacking, f"selected fields are missing: {lacking}")
    rows = df.where(F.col(selection.selector).cast("string").isin(list(selection.values)))
    if selection.rows:
        rows = rows.where(F.col(number).isin(list(selection.rows)))
    columns = [F.col(f) for f in sorted(selection.fields)]
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    out = rows.select(F.col(number).alias("row_number"), record.alias("record"), struct_hash(*columns).alias("row_sha256"), F.col(selection.selector).cast("string").alias("_v"))
    # one pass: as many rows as there are values
    seen = {r[0]: r[1] for r in out.groupBy("_v").agg(F.sum(F.octet_length("record"))).collect()}
    _require(bool(seen), "no rows are selected")
    _require(set(selection.values) <= set(seen), f"values not found: {sorted(set(selection.values) - set(seen))}")
    _require(sum(seen.values()) <= selection.most_bytes, f"more than {selection.most_bytes} bytes")
    return out.drop("_v")


# The endings of image members.
IMAGES = (".jpg", ".jpeg", ".png")


def acquire_members(spark: SparkSession, folder: str, card: Mapping, selection: Selection) -> tuple[DataFrame, DataFrame]:
    """(records with their bytes, judgments): members of a pinned ZIP archive; the label, which is the member's folder, is in the judgments alone."""
    check_card(card, selection)
    _require(bool(selection.members), "members are needed")
    _require(all(m.lower().endswith(IMAGES) for m in selection.members), "a member is no image")
    ship(spark)
    members = selection.members
    schema = pa.schema([("member", pa.string()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    there = set(archive.namelist())
                    for m in members:
                        yield pa.RecordBatch.from_arrays([pa.array([m]), pa.array([archive.read(m) if m in there else None], pa.binary())], schema=schema)

    found = _content(spark, folder, selection).select("content").mapInArrow(run, "member string, content binary")
    lacking = [r[0] for r in found.where("content IS NULL").select("member").collect()]  # at most MOST_MEMBERS
    _require(not lacking, f"members not found: {lacking}")
    asset = F.concat(F.lit(f"{selection.repository}@{selection.revision}:"), F.col("member"))
    kind = F.when(F.endswith(F.lower("member"), F.lit(".png")), "image/png").otherwise("image/jpeg")
    records = found.select(
        asset.alias("asset_id"), "member", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("image_sha256"), kind.alias("media_type"),
        F.octet_length("content").cast("long").alias("byte_count"), "content",
    )
    parts = F.split("member", "/")
    label = F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise("unknown")
    return records, found.select(asset.alias("asset_id"), label.alias("label"), "member")


def document_pages(rows: DataFrame, document: str, page: str, question: str, text: str, image: str, answers: str, most: int | None = MOST_PAGES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(questions, pages, judgments): a page's image once however many questions it has; answers are in the judgments alone.

    ``most`` bounds the questions of one acquisition; None lifts it.
    """
    if most is not None:
        _require(rows.limit(most + 1).count() <= most, f"more than {most} questions")
    page_id = F.concat(F.lit("doc:"), F.col(document).cast("string"), F.lit(":page:"), F.col(page).cast("string")).alias("page_id")
    questions = rows.select(page_id, F.col(document).cast("string").alias("document_id"), F.col(page).cast("string").alias("page_number"), F.col(question).cast("string").alias("question_id"), F.col(text).alias("question"))
    # equal page ids carry equal images; the least is taken so that a rerun takes the same
    pages = rows.select(page_id, F.col(image).alias("image")).groupBy("page_id").agg(F.min("image").alias("image"))
    pages = pages.withColumn("image_sha256", F.concat(F.lit("sha256:"), F.sha2("image", 256)))
    judgments = rows.select(F.col(question).cast("string").alias("question_id"), page_id, F.col(answers).alias("acceptable_answers"), F.lit("answerable").alias("answerability"))
    return questions, pages, judgments


def flattened(df: DataFrame, items: str, inherited: list[str], fallbacks: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A row for each struct of the array ``items``, with the parent's inherited columns; a null or empty array gives none.

    ``fallbacks`` gives further columns, each the first of several item fields that isn't null.
    """
    flat = df.select(*inherited, F.inline(items))
    return flat.withColumns({name: F.coalesce(*[F.col(c) for c in chain]) for name, chain in (fallbacks or {}).items()})


# --- artifacts ----------------------------------------------------------------------------------


def content_issues(content: Column, sha256: Column, size: Column | None = None) -> Column:
    """What is wrong with content against its declared identity: ``missing``, ``hash``, ``size`` or null."""
    wrong_size = F.octet_length(content) != size if size is not None else F.lit(False)
    actual = F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))
    return F.when(content.isNull(), "missing").when(~actual.eqNullSafe(sha256), "hash").when(wrong_size, "size")


def write_bytes(spark: SparkSession, path: str, body: bytes) -> None:
    """A new file at a Hadoop path; the bytes are the driver's own."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, False)
    stream.write(bytearray(body))
    stream.close()


def write_artifacts(spark: SparkSession, root: str, artifacts: Mapping[str, object]) -> DataFrame:
    """Canonical JSON files under a root and their index (path, sha256, size, media_type); the values are the driver's own and small."""
    index = []
    for path, value in sorted(artifacts.items()):
        if path.startswith("/") or ".." in path.split("/"):
            raise ValueError(f"unsafe path: {path}")
        body = canonical_json(value).encode()
        write_bytes(spark, f"{root.rstrip('/')}/{path}", body)
        index.append((path, "sha256:" + hashlib.sha256(body).hexdigest(), len(body), "application/json"))
    return spark.createDataFrame(index, "path string, sha256 string, size long, media_type string")


def artifact_issues(spark: SparkSession, root: str, index: DataFrame) -> DataFrame:
    """(path, issue) of indexed files that are missing, unsafe, repeated or have other bytes than declared; each file is read by a task."""
    base = root.rstrip("/")
    seen = index.groupBy("path").agg(F.count(F.lit(1)).alias("_n"), F.min("sha256").alias("sha256"), F.min("size").alias("size"), F.min("media_type").alias("media_type"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    bare = lambda path: F.regexp_replace(path, "^[a-z0-9]+:/*", "/")
    # digests travel to the join, contents don't
    files = files.select(bare(F.col("path")).alias("_path"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("_sha256"), F.col("length").alias("_size"))
    joined = seen.join(files, F.concat(bare(F.lit(base + "/")), F.col("path")) == F.col("_path"), "left")
    issue = (
        F.when(F.col("_n") > 1, "repeated").when(~safe_path(F.col("path")), "unsafe").when(~F.coalesce(media_type(F.col("media_type")), F.lit(False)), "media_type")
        .when(F.col("_sha256").isNull(), "missing").when(~F.col("_sha256").eqNullSafe(F.col("sha256")), "hash").when(F.col("_size") != F.col("size"), "size")
    )
    return joined.select("path", issue.alias("issue")).where("issue IS NOT NULL")
