import hashlib
import json
import random
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textassay.operators import ingest as I
from textassay.sources import jsonl, manifest

RECORDS = [
    {"url": "http://a/1", "text": "<p>uno</p>\n<p>dos</p>"},
    {"url": "http://a/2", "text": None},
    {"url": "http://a/3"},
    {"text": "sin url"},
    {"url": "http://a/5", "text": 12345},
]


@pytest.fixture
def jsonl_file(tmp_path):
    path = tmp_path / "records.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS) + "\n{broken\n", encoding="utf-8")
    return path


def test_jsonl_ingest(spark, jsonl_file):
    rows = I.ingest(jsonl.read_jsonl(spark, str(jsonl_file))).collect()
    assert [tuple(r) for r in rows] == [
        ("http://a/1", "<p>uno</p>\n<p>dos</p>", "uno dos"),
        ("http://a/2", None, ""),
        ("http://a/3", None, ""),
        (None, "sin url", "sin url"),
        ("http://a/5", "12345", "12345"),
        (None, None, ""),
    ]
    corrupt = jsonl.read_jsonl(spark, str(jsonl_file), keep_corrupt=True).where("_corrupt_record IS NOT NULL").collect()
    assert [r["_corrupt_record"] for r in corrupt] == ["{broken"]


def test_missing_input(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        jsonl.read_jsonl(spark, str(tmp_path / "none.jsonl"))


def test_missing_columns_read_as_null(spark):
    row = I.ingest(spark.createDataFrame([("x",)], "other string")).first()
    assert (row["url"], row["text"], row["text_clean"]) == (None, None, "")


def test_manifest(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.bin").write_bytes(bytes([i]) * (1_500_000 * i + 10))
    expected = {f"f{i}.bin": hashlib.sha256((tmp_path / f"f{i}.bin").read_bytes()).hexdigest() for i in range(3)}
    for limit in (manifest.INLINE_BYTES, 1_000):  # the second reads two of the files block by block
        rows = manifest.ingest_manifest(spark, str(tmp_path), limit).collect()
        assert {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in rows} == expected
        assert {r["bytes"]: r["mb"] for r in rows} == {10: 0.0, 1_500_010: 1.43, 3_000_010: 2.86}
    out, table = tmp_path / "manifest", tmp_path / "table"
    records = spark.createDataFrame([("u", None, None), (None, None, "{bad"), ("v", None, None)], "url string, text string, bad string")
    counts = manifest.IngestCounts(("url", "text"), "bad")
    counts.observe(records).write.parquet(str(table))
    manifest.write_manifest(manifest.ingest_manifest(spark, str(tmp_path / "f0.bin")), ["url", "text"], counts, str(out))
    row = spark.read.json(str(out)).first()
    assert (row["total_rows"], row["corrupt_rows"], row["columns"], row["missing_columns"]) == (2, 1, ["url", "text"], ["text"])
    assert row["sha256"] == expected["f0.bin"]


def test_manifest_of_files_beyond_two_gigabytes(spark, tmp_path):
    """One reader for every size, below a mount as well; the file is sparse and takes no disk."""
    size = 3 * 1024**3 + 17
    with (tmp_path / "sparse.bin").open("wb") as f:
        f.seek(size - 1)
        f.write(b"x")
    (tmp_path / "small.bin").write_bytes(b"small")
    digest, zeros = hashlib.sha256(), bytes(1 << 24)
    for _ in range((size - 1) // len(zeros)):
        digest.update(zeros)
    digest.update(bytes((size - 1) % len(zeros)) + b"x")
    spark.conf.set("fs.viewfs.mounttable.large.link./in", f"file://{tmp_path}")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.large.link./in", f"file://{tmp_path}")
    for path in (str(tmp_path / "*.bin"), "viewfs://large/in"):
        rows = {r["bytes"]: r["sha256"] for r in manifest.ingest_manifest(spark, path).collect()}
        assert rows == {size: digest.hexdigest(), 5: hashlib.sha256(b"small").hexdigest()}


def test_fixed_part_of_a_path(spark, tmp_path):
    for path, fixed in ((f"{tmp_path}/a*/b", f"file:{tmp_path}"), (f"{tmp_path}", f"file:{tmp_path}"), ("*.json", None)):
        given, real = manifest.stored_at(spark, path)
        assert (given, real) == ((fixed, fixed) if fixed else ("", ""))


def test_doc_ids_identify_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "COPIES_PER_UNIT", 4)
    data = [("u", "a")] * 31 + [("u", "b"), ("v", "a"), (None, "a"), ("u", None), ("u", ""), ("", "u")] + [("w", "c")] * 4
    rows = [(*r, i) for i, r in enumerate(data)]
    random.Random(1).shuffle(rows)
    found = []
    for files in (5, 1):
        path = str(tmp_path / f"t{files}")
        spark.createDataFrame(rows, "url string, text string, n int").repartition(files).write.parquet(path)
        table = spark.read.parquet(path)
        ids = I.assign_doc_id(table, ("url", "text"), ("n",))
        assert ids.columns == ["doc_key", "copy_no", "n", "file_name", "row_index"]
        got = {r["n"]: (r["doc_key"], r["copy_no"]) for r in ids.collect()}
        assert len(got) == len(set(got.values())) == len(data) and all(len(k) == 32 for k, _ in got.values())
        by_content = {}
        for i, r in enumerate(data):
            by_content.setdefault(r, []).append(got[i])
        assert all(len({k for k, _ in v}) == 1 and sorted(c for _, c in v) == list(range(len(v))) for v in by_content.values())
        assert len({v[0][0] for v in by_content.values()}) == len(by_content) == 8
        back = I.with_doc_id(table, ids)
        assert {r["n"]: (r["doc_key"], r["copy_no"]) for r in back.collect()} == got and set(back.columns) == {"url", "text", "n", "doc_key", "copy_no"}
        found.append(set(got.values()))
    assert found[0] == found[1]
    empty = spark.createDataFrame([], "url string, text string")
    empty.write.parquet(str(tmp_path / "none"))
    assert I.assign_doc_id(spark.read.parquet(str(tmp_path / "none")), ("url", "text")).collect() == []


def test_doc_ids_move_no_text(spark, tmp_path):
    spark.range(50).select(F.repeat(F.md5(F.col("id").cast("string")), 50).alias("long_prose")).write.parquet(str(tmp_path / "t"))
    plan = I.assign_doc_id(spark.read.parquet(str(tmp_path / "t")), ("long_prose",))._jdf.queryExecution().executedPlan().toString()
    assert "long_prose" not in plan and "Exchange" in plan


def test_row_positions(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = I.row_position_id(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert all(r["row_id"] == r["id"] for r in rows)
    spark.range(100).repartition(4).write.option("maxRecordsPerFile", 10).parquet(str(tmp_path / "u"))
    ids = [r["doc_id"] for r in I.written_row_id(spark.read.parquet(str(tmp_path / "u"))).collect()]
    assert len(set(ids)) == 100 and min(ids) == 0
    assert [r["doc_id"] for r in I.written_row_id(spark.read.parquet(str(tmp_path / "t"))).orderBy("id").collect()] == list(range(100))


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k long, t string")
    base = I.corpus_fingerprint(df, ("k", "t")).first()
    assert base["n_rows"] == 3
    assert I.corpus_fingerprint(df.repartition(3), ("k", "t")).first() == base
    # An even number of copies must not cancel out.
    assert I.corpus_fingerprint(df.where("k = 1"), ("k", "t")).first()["fingerprint"] != base["fingerprint"]
    assert I.corpus_fingerprint(df.where("false"), ("k", "t")).first()["fingerprint"] == "0"


def test_schema_report(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, 0.5)], "k long, t string, extra double")
    expected = {"k": "int", "t": "string", "gone": "string"}
    rows = {r["name"]: (r["type"], r["expected_type"], r["status"], r["n_values"]) for r in I.schema_report(df, expected).collect()}
    assert rows == {
        "k": ("bigint", "int", "TYPE", 2),
        "t": ("string", "string", "OK", 1),
        "extra": ("double", None, "EXTRA", 2),
        "gone": (None, "string", "MISSING", 0),
    }
    nested = df.withColumn("more", F.array("t"))
    nested.write.parquet(str(tmp_path / "t"))
    expected["more"] = "array<string>"
    of_files = sorted(map(tuple, I.file_schema_report(spark, str(tmp_path / "t"), expected).collect()))
    assert of_files == sorted(map(tuple, I.schema_report(nested, expected).collect())) and len(of_files) == 5
    with pytest.raises(ValueError, match="gone: expected string, found nothing"):
        I.require_schema(df, expected)
    assert I.require_schema(df, {"k": "bigint"}) is df


def test_manifest_totals(spark):
    df = spark.range(7).select("id", F.lit("x").alias("text"))
    assert tuple(manifest.manifest_totals(df).first()) == (7, ["id", "text"])


def test_run_id():
    from textassay.sources.scorecards import run_id

    assert run_id(datetime(2026, 3, 4, 5, 6, 7)) == "SC-20260304-050607"


def test_hashes_of_odd_paths_and_stores(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    for name in ("x y", "50%", "a%2Fb", "q?r#s", "ü"):
        (folder / name).write_bytes(name.encode() * 1000)
    want = sorted(hashlib.sha256(f.read_bytes()).hexdigest() for f in folder.iterdir())
    for limit in (manifest.INLINE_BYTES, 0):
        assert sorted(r["sha256"] for r in manifest.ingest_manifest(spark, f"{tmp_path}", limit).collect()) == want
    # A store that only Spark opens.
    spark.conf.set("fs.viewfs.mounttable.manifest.link./in", f"file://{tmp_path}")
    for limit in (manifest.INLINE_BYTES, 0):
        assert sorted(r["sha256"] for r in manifest.ingest_manifest(spark, "viewfs://manifest/in", limit).collect()) == want
