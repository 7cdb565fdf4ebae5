import datetime
import decimal
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from ctxloom.functions import identity, schema, text
from ctxloom.sources import acquire, readers, store
from ctxloom.sources.store import Store, ingest
from ctxloom.streaming import observations

REVISION = "a" * 40
CARD = {"revision": REVISION, "licence": "MIT"}


def selection(**more):
    return acquire.Selection(**({"repository": "o/n", "revision": REVISION, "file": "x.jsonl", "licence": "mit", "fields": ("b", "a")} | more))


def test_files_of_all_formats_give_the_same_rows(spark, tmp_path):
    rows = [{"a": i, "b": f"é{i}", "c": None} for i in range(5)]
    (tmp_path / "x.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n\n")
    (tmp_path / "x.json").write_text(json.dumps({"data": rows}))
    (tmp_path / "x.csv").write_text("a,b\n" + "".join(f'{r["a"]},"{r["b"]}"\n' for r in rows))
    folder = f"file://{tmp_path}"
    want = [(n, json.dumps({"a": n, "b": f"é{n}"}, separators=(",", ":"), ensure_ascii=False)) for n in (1, 3)]
    for name in ("x.jsonl", "x.json"):
        got = acquire.acquire_file(spark, folder, CARD, selection(file=name, rows=(1, 3))).orderBy("row_number").collect()
        assert [(r["row_number"], r["record"]) for r in got] == want
        assert [r["row_sha256"] for r in got] == [identity.row_hash(json.loads(w)) for _, w in want]
    assert [json.loads(r["record"]) for r in acquire.acquire_file(spark, folder, CARD, selection(file="x.csv")).orderBy("row_number").collect()] == [{"a": str(n), "b": f"é{n}"} for n in range(5)]
    hashes = tuple(identity.row_hash(json.loads(w)) for _, w in want)
    acquire.acquire_file(spark, folder, CARD, selection(rows=(1, 3), row_sha256=hashes))
    picked = acquire.acquire_file(spark, folder, CARD, selection(selector="b", values=("é2", "é4"))).collect()
    assert sorted(r["row_number"] for r in picked) == [2, 4]
    for bad in ({"rows": (1, 9)}, {"rows": (1, 3), "row_sha256": hashes[::-1]}, {"fields": ("a", "z")}, {"selector": "b", "values": ("é2", "none")}, {"most_bytes": 10}, {"file_sha256": "0" * 64}, {"file": "x.txt"}):
        with pytest.raises(Exception):
            acquire.acquire_file(spark, folder, CARD, selection(**bad)).collect()
    for card in ({"revision": "b" * 40, "licence": "mit"}, {"revision": REVISION, "licence": ["gpl"]}, CARD | {"gated": True}):
        with pytest.raises(acquire.AcquisitionError):
            acquire.acquire_file(spark, folder, card, selection())
    for bad in ({"revision": "main"}, {"repository": "n"}, {"file": "../x"}, {"rows": (3, 1)}, {"rows": (-1,)}, {"fields": ("a", "a")}, {"selector": "z", "values": ("1",)}, {"members": tuple("b a".split())}):
        with pytest.raises(acquire.AcquisitionError):
            selection(**bad)


def test_members_keep_labels_apart(spark, tmp_path):
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("train/rust/1.jpg", b"one")
        z.writestr("train/healthy/2.png", b"two")
    (tmp_path / "x.zip").write_bytes(body.getvalue())
    wanted = selection(file="x.zip", members=("train/healthy/2.png", "train/rust/1.jpg"))
    records, judgments = acquire.acquire_members(spark, f"file://{tmp_path}", CARD, wanted)
    got = {r["member"]: r for r in records.collect()}
    assert "label" not in records.columns and got["train/rust/1.jpg"]["byte_count"] == 3 and got["train/healthy/2.png"]["media_type"] == "image/png"
    assert {r["member"]: r["label"] for r in judgments.collect()} == {"train/rust/1.jpg": "rust", "train/healthy/2.png": "healthy"}
    for bad in (("train/none.jpg",), ("train/x.txt",), ()):
        with pytest.raises(acquire.AcquisitionError):
            acquire.acquire_members(spark, f"file://{tmp_path}", CARD, selection(file="x.zip", members=bad))
    with pytest.raises(acquire.AcquisitionError):
        acquire.document_pages(spark.range(40).selectExpr("id d", "id p", "id q", "'t' t", "'i' i", "array('a') a"), "d", "p", "q", "t", "i", "a")


def test_store_versions_merges_and_cursor(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_CHANGES", 3)
    s = Store(spark, f"file://{tmp_path}", "test", "law")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v string, at long")
    assert ingest(s, "t", rows(("a", "1", 9), ("b", "1", 10)), "k", "v", cursor="at")["inserted"] == 2
    assert s.cursor("t") == {"type": "bigint", "value": "10"}  # by type: as text 9 is larger
    before = s._versions("t")
    assert ingest(s, "t", rows(("a", "1", 9), ("b", "1", 10)), "k", "v", cursor="at") == {"inserted": 0, "changed": 0, "reused": 2, "deleted": 0} and s._versions("t") == before
    for i in range(5):  # more changes than are kept apart
        ingest(s, "t", rows(("a", str(i + 5), 11 + i), ("b", "1", 10)), "k", "v", cursor="at")
    assert sorted((r["k"], r["v"], r["deleted"]) for r in s.read("t").collect()) == [("a", "9", False), ("b", "1", False)]
    assert len(s._state("t").get("changes", ())) < 5 and s.cursor("t")["value"] == "15"
    assert ingest(s, "t", rows(("b", "1", 10)), "k", "v")["deleted"] == 1 and s.cursor("t")["value"] == "15"
    assert ingest(s, "t", rows(("a", "9", 9), ("b", "1", 10)), "k", "v")["inserted"] == 1
    gone = rows(("b", "1", 10)).withColumn("gone", F.lit(True))
    assert ingest(s, "t", gone, "k", "v", snapshot=False, removed="gone") == {"inserted": 0, "changed": 1, "reused": 0, "deleted": 1}
    want = sorted(map(tuple, s.read("t").select("k", "v", "deleted").collect()))
    assert want == [("a", "9", False), ("b", "1", True)]
    assert s.vacuum("t") > 5 and len(s._versions("t")) == 2 and sorted(map(tuple, s.read("t").select("k", "v", "deleted").collect())) == want
    s.compact("t")
    s.add("t", s.read("t").limit(0).unionByName(rows(("c", "3", 1)).withColumn("deleted", F.lit(False)), allowMissingColumns=True))
    assert s.read("t").count() == 3
    assert ingest(s, "empty", rows().limit(0), "k", "v", cursor="at")["inserted"] == 0
    for bad in ("s3a:///x", "s3a://", "file:///x?y"):
        with pytest.raises(ValueError):
            Store(spark, bad, "e", "d")


def test_stream_merges_by_order(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store", "test", "law")
    rows = spark.createDataFrame([("a", "1", 1), ("a", "3", 3), ("a", "2", 2), (None, "x", 9), ("b", "1", 4)], "k string, v string, n long")
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    observations.merge_stream(stream, s, "t", "k", "v", "n", f"file://{tmp_path}/state", once=True).awaitTermination()
    assert {r["k"] for r in s.read("t").collect()} == {"a", "b"}
    again = spark.createDataFrame([("b", "7", 7)], rows.schema)
    again.write.mode("append").parquet(f"{tmp_path}/in")
    observations.merge_stream(stream, s, "t", "k", "v", "n", f"file://{tmp_path}/state", once=True).awaitTermination()
    assert {r["k"]: r["v"] for r in s.read("t").collect()}["b"] == "7"


def test_schema_and_nested_values(spark):
    rules = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": ["string", "null"], "maxLength": 2}, "b": {"type": "array", "items": {"enum": [1, "x"]}}}}
    schema.validate(rules, {"a": None, "b": [1, "x", 1.0]})
    for bad, where in (({}, "$.a"), ({"a": 1}, "$.a"), ({"a": "abc"}, "$.a"), ({"a": "a", "b": [True]}, "$.b.0"), ({"a": "a", "c": 1}, "$.c"), ([], "$")):
        with pytest.raises(ValueError, match=f" at {where.replace('$', '[$]')}$"):
            schema.validate(rules, bad)
    with pytest.raises(ValueError, match="unsupported"):
        schema.violation(F.col("x"), {"unknown": 1})
    rows = spark.createDataFrame([('{"a": "x"}',), ("{",), (None,), ('{"a": 3}',)], "t string")
    assert [r[0] for r in rows.select(schema.violation(F.col("t"), rules)).collect()] == [None, "$ json", None, "$.a type"]
    assert schema.secret_fields({"max_tokens": 1, "x": [{"Api-Key": 1}], "token_ref": 2}) == ["x.0.Api-Key"]
    assert schema.without_keys({"a": [{"id": 1, "b": 2}]}, "id") == {"a": [{"b": 2}]}
    value = {"d": datetime.date(2024, 1, 2), "n": decimal.Decimal("1.50"), "x": [b"\x01", {"t": datetime.datetime(2024, 1, 2, 3)}]}
    assert schema.json_safe(value) == {"d": "2024-01-02", "n": "1.50", "x": ["01", {"t": "2024-01-02T03:00:00"}]}
    assert identity.ingest_identity({"b": "é", "a": datetime.date(2024, 1, 2)}) == "sha256:" + identity.hashlib.sha256(b'{"a":"2024-01-02","b":"\\u00e9"}').hexdigest()
    one = spark.createDataFrame([({"k": [1.5, None]}, "é")], "m map<string,array<double>>, s string")
    assert one.select(identity.canonical(F.struct(F.col("s").alias("s"), F.col("m").alias("m"))).alias("c")).first()[0] == '{"m":{"k":[1.5,null]},"s":"é"}'


def test_compiled_schemas_equal_the_plain_rules(spark):
    values = [None, True, 0, 1, 1.0, -2, 2.5, "", "ab", "é𝒳z", [], [1, "x", None, [2]], {}, {"a": None}, {"a": "x", "b": [{"c": 1}, {"c": "y", "d": 2}]}, {"a": {"a": {"a": 5}}, "z": False, "q r": 1.5}, [[1], [1, 2, 3]], {"b": [1] * 4}]
    rules = [
        True, False, {"type": "integer"}, {"type": ["number", "null"]}, {"type": "boolean"}, {"enum": [1, None, "ab", [], {"a": None}]}, {"const": True}, {"const": "x"}, {"minLength": 2, "maxLength": 2}, {"pattern": "^a"},
        {"minimum": 1, "maximum": 2}, {"minItems": 1, "maxItems": 2}, {"items": {"type": ["integer", "array"], "maximum": 1, "items": False}}, {"required": ["a", "b"]}, {"additionalProperties": False},
        {"properties": {"a": {"type": "string"}, "b": {"items": {"required": ["d"], "properties": {"c": {"type": "integer"}}}}}, "additionalProperties": {"type": "integer", "title": "shown only"}},
        {"anyOf": [{"type": "string"}, {"required": ["a"]}]}, {"oneOf": [{"type": "integer"}, {"minimum": 2}]}, {"allOf": [{"type": "object"}, {"required": ["z"]}]},
        {"type": "object", "properties": {"a": {"properties": {"a": {"properties": {"a": {"maximum": 4}}}}}}},
    ]
    texts = [json.dumps(v) for v in values] + ["{", "", '{"a": 1, "a": 2}', "[1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string").coalesce(1)
    out = df.select("i", *[schema.violation(F.col("t"), r).alias(f"r{k}") for k, r in enumerate(rules)])
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    for row in out.collect():
        for k, r in enumerate(rules):
            if row["i"] < len(values):
                want = next((" ".join(x) for x in sorted(schema.violations(r, values[row["i"]]))), None)
            else:
                want = None if row["i"] == 99 else "$ json"
            assert row[f"r{k}"] == want, (row["i"], r)


def test_malformed_json_has_defined_results(spark):
    df = spark.createDataFrame([("{bad",), ("",), (None,), ('{"x": [{"my-Token": 1}]}',), ("[" * 100_000,), ('{"id": 1, "n": NaN}',)], "t string").coalesce(1)
    got = df.select(schema.secret_field(F.col("t")), schema.redacted(F.col("t"), "id")).collect()
    assert [r[0] for r in got] == ["$ json", "$ json", None, "x.0.my-Token", "$ json", None]
    assert [r[1] for r in got] == [None, None, None, '{"x":[{"my-Token":1}]}', None, None]


def test_times(spark):
    rows = spark.createDataFrame([(t,) for t in ("2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.25+02:00", "2024-01-02 03:04", "", "soon", None, "2024-13-01")], "t string")
    got = [r[0] for r in rows.select(F.unix_micros(text.parse_time(F.col("t")))).collect()]
    base = int(datetime.datetime(2024, 1, 2, tzinfo=datetime.timezone.utc).timestamp()) * 10**6
    assert got == [base, base + 11045 * 10**6, base + 3845 * 10**6 + 250000, base + 11040 * 10**6, None, None, None, None]


def test_bindings(spark):
    c = readers.Contract(("id", "body"), ("id",), ("body",), resource="r")
    readers.check_binding([c], [("r", {"id": "k", "body": "b"})])
    for bad in ([("r", {"id": "k"})], [("r", {"id": "k", "body": "b"})] * 2, [], [("x", {})], [("r", {"id": "k", "body": "b", "z": "z"})]):
        with pytest.raises(ValueError):
            readers.check_binding([c], bad)
    for bad in ({"deletion": "x"}, {"mode": "x"}, {"mode": "incremental"}):
        with pytest.raises(ValueError):
            readers.Contract(("id",), ("id",), **bad)
    records = lambda *r: spark.createDataFrame(list(r), "record_id string, channel string, text string")
    for bad in (records(("a", "c", " ")), records(("a", "c", "t"), ("a", "c", "t")), records().limit(0)):
        with pytest.raises(ValueError):
            readers.plain_records(bad, "e", "d")


class Client:
    def list(self, token):
        return ([{"uri": "u1", "name": "n", "mimeType": "text/plain"}], "t") if token is None else ([{"uri": "u2"}], None)

    def read(self, uri):
        return {"text": uri}


def test_resources_as_a_data_source(spark):
    readers.register(spark)
    got = spark.read.format("ctxloom_resources").option("client", "tests.test_acquire:Client").load()
    assert [r["text"] for r in got.orderBy("uri").collect()] == ["u1", "u2"]
