import bisect

import pytest

from textassay.functions.patterns import PII_PATTERNS
from textassay.operators import toxicity
from textassay.operators.ingest import ingest
from textassay.sources.jsonl import record_schema
from textassay.streaming import jobs

TERMS = {"bad": 900}


def write_batches(spark, path):
    rows = [(f"http://x/{i}", f"<p>page {i}</p> " + ("bad " if i % 4 == 0 else "good ") * (40 if i % 2 else 3) + ("a@b.co" if i % 5 == 0 else "")) for i in range(30)]
    frame = spark.createDataFrame(rows, "url string, text string")
    frame.repartition(6).write.json(path)
    return frame


def test_stream_ingest_equals_batch(spark, tmp_path):
    frame = write_batches(spark, str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):  # the second run finds nothing new
        stream = jobs.read_record_stream(spark, str(tmp_path / "in"), record_schema(), files_per_trigger=2)
        jobs.stream_ingest(stream, out, checkpoint).awaitTermination()
        assert sorted(spark.read.parquet(out).collect()) == sorted(ingest(frame).collect())
    frame.limit(2).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = jobs.read_record_stream(spark, str(tmp_path / "in"), record_schema())
    jobs.stream_ingest(stream, out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 32


def test_stream_flags_equal_batch(spark, tmp_path):
    frame = write_batches(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = jobs.read_record_stream(spark, str(tmp_path / "in"), record_schema(), files_per_trigger=2)
    jobs.stream_flags(stream, TERMS, out, str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(f"{out}/totals").count() == 3
    expected = jobs._totals(jobs.flag_rows(frame, TERMS)).first().asDict()
    assert jobs.stream_totals(spark, out).first().asDict() == expected
    assert (expected["n_rows"], expected["drop_short"] > 0, expected["kept"] > 0) == (30, True, True)
    rows = spark.read.parquet(f"{out}/rows")
    assert rows.count() == 30
    assert {"reject_reason", "tox_score", "pii_any", *[p.column for p in PII_PATTERNS]} <= set(rows.columns)


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    frame = write_batches(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for run in range(2):  # a lost checkpoint replays batch 0
        stream = jobs.read_record_stream(spark, str(tmp_path / "in"), record_schema())
        jobs.stream_flags(stream, TERMS, out, str(tmp_path / f"check{run}")).awaitTermination()
    assert jobs.stream_totals(spark, out).first()["n_rows"] == frame.count()


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_stream_flags_with_a_long_list(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(toxicity, "INLINE_TERMS", 1)
    monkeypatch.setattr(toxicity, "BROADCAST_TERMS", broadcast)
    frame = write_batches(spark, str(tmp_path / "in"))
    table = spark.createDataFrame([("bad", 0.9), ("worse", 0.1)], "term string, weight double")
    stream = jobs.read_record_stream(spark, str(tmp_path / "in"), record_schema(), files_per_trigger=3)
    jobs.stream_flags(stream, table, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    expected = jobs._totals(jobs.flag_rows(frame, TERMS)).first().asDict()
    assert jobs.stream_totals(spark, str(tmp_path / "out")).first().asDict() == expected


def test_many_small_arrivals_end_in_few_files(spark, tmp_path):
    frame = write_batches(spark, str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")

    def arrive(checkpoint):
        stream = jobs.read_record_stream(spark, str(tmp_path / "in"), record_schema(), files_per_trigger=2)
        jobs.stream_batches(stream, out, checkpoint).awaitTermination()

    def files(folder):
        return len(list((tmp_path / "out" / folder).glob("**/*.parquet")))

    expected = sorted(ingest(frame).collect())
    arrive(checkpoint)
    assert files("rows") == 3  # a file for each micro-batch
    assert sorted(jobs.batch_rows(spark, out).collect()) == expected
    assert (jobs.compact(spark, out), jobs.compact(spark, out)) == (2, None)
    assert files("packed") == 1 and sorted(jobs.batch_rows(spark, out).collect()) == expected
    # A replay of the same arrivals changes nothing.
    arrive(str(tmp_path / "lost"))
    assert sorted(jobs.batch_rows(spark, out).collect()) == expected
    # What arrives later is read beside the merged files, and merged in its turn.
    frame.limit(2).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    arrive(checkpoint)
    assert jobs.batch_rows(spark, out).count() == 32
    assert jobs.compact(spark, out) == 3 and files("packed") == 2
    assert jobs.batch_rows(spark, out).count() == 32
    # Files of a compaction that is not in the log are not read.
    frame.select("url", "text", "text").toDF("url", "text", "text_clean").write.parquet(f"{out}/packed/upto=9")
    assert jobs.batch_rows(spark, out).count() == 32


def test_quantiles_of_the_stream_keep_their_error(spark, tmp_path):
    n = 20_000
    docs = spark.range(0, n, 1, 8).selectExpr("concat('u', id) url", "concat(repeat('bad ', int(id * 7919 % 20000 % 199)), repeat('good ', 200)) text")
    docs.write.json(str(tmp_path / "in"))
    stream = jobs.read_record_stream(spark, str(tmp_path / "in"), record_schema(), files_per_trigger=3)
    jobs.stream_flags(stream, TERMS, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out/rows")).where("reject_reason IS NULL")
    scores = sorted(r[0] for r in rows.select("tox_score").collect())
    probabilities = (0.1, 0.5, 0.9, 0.99)
    found = jobs.stream_quantiles(spark, str(tmp_path / "out"), probabilities).collect()
    assert [(r["p"], r["n"]) for r in found] == [(p, n) for p in probabilities]
    for r in found:
        low, high = bisect.bisect_left(scores, r["score"]) / n, bisect.bisect_right(scores, r["score"]) / n
        assert low - jobs.RANK_ERROR <= r["p"] <= high + jobs.RANK_ERROR


def test_quantiles_without_a_kept_document(spark, tmp_path):
    spark.createDataFrame([("u", "")], "url string, text string").write.json(str(tmp_path / "in"))
    stream = jobs.read_record_stream(spark, str(tmp_path / "in"), record_schema())
    jobs.stream_flags(stream, TERMS, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert [tuple(r) for r in jobs.stream_quantiles(spark, str(tmp_path / "out"), (0.5,)).collect()] == [(0.5, None, 0)]
