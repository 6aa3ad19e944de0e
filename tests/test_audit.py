"""A corpus with known totals through the whole audit."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textassay.operators import near_dup, toxicity
from textassay.operators.ingest import ingest
from textassay.operators.near_dup import NearDupParams
from textassay.operators.quality import quality_report
from textassay.plans.audit import run_audit
from textassay.plans.files import audit_files
from textassay.sources.scorecards import latest_scorecard, read_scorecards

TOPICS = (
    "river bridge harbour market station library museum garden castle forest valley desert island mountain village temple "
    "engine mirror ladder window candle hammer basket carpet blanket pillow kettle saucer teapot napkin ribbon button "
    "salmon falcon badger beaver rabbit turtle lizard spider donkey monkey parrot pigeon turkey walrus"
).split()


def sample(spark):
    """54 records: two too short, three copies of one text, two pairs of copies, three with e-mail, one lexicon hit."""
    texts = []
    for i in range(45):
        a, b, c = (TOPICS[k % len(TOPICS)] for k in (i, i * 7 + 3, i * 11 + 5))
        texts.append(f"{a} number {i * 37} was seen near {b} while {c} report {i * i} told of {b}{a} and of {c}{b} in year {1000 + i * 13} again")
    mail = "We look for an engineer who writes clear programs and likes long walks, please send a letter to jobs@example.org today"
    texts += [mail] * 3
    texts += ["The weather of the coming week will be mild with some rain in the north and strong winds along the coast"] * 2
    texts += ["A new train line between both towns opens in spring and will carry four thousand travellers on every day"] * 2
    texts[0] = texts[0] + " ansiedad"
    texts += ["<div class='post'><p>a <b>short</b> note inside a lot of markup</p></div>", "x" * 98]
    assert len(texts) == 54
    rows = [(i, f"http://example.org/{i}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, url string, text string").repartition(6)


def audit(spark, **kw):
    return run_audit(ingest(sample(spark), keep=("doc_id", "url")), {"ansiedad": 200}, **kw)


def test_known_totals(spark):
    result = audit(spark)
    rows = {r["metric"]: r for r in result.scorecard.collect()}
    assert {m: (r["value"], r["status"]) for m, r in rows.items()} == {
        "MI-01": (9.62, "OK"), "MI-02": (5.77, "ALERT"), "MI-03": (0.0, "OK"), "MI-04": (96.3, "OK"),
    }
    assert {m: (int(r["n_hits"]), r["n_total"]) for m, r in rows.items()} == {"MI-01": (5, 52), "MI-02": (3, 52), "MI-03": (0, 52), "MI-04": (52, 54)}
    assert rows["MI-03"]["score_mean"] > 0
    pairs = sorted((r["doc_a"], r["doc_b"], r["jaccard"]) for r in result.dups.pairs().collect())
    assert pairs == [(45, 46, 1.0), (45, 47, 1.0), (46, 47, 1.0), (48, 49, 1.0), (50, 51, 1.0)]
    report = {r["rule"]: r["docs"] for r in quality_report(result.features).collect()}
    assert report == {"html": 0, "short": 2, "empty": 0, "dropped": 2, "kept": 52}


def test_ratio_on_raw_text_names_the_other_rule(spark):
    report = {r["rule"]: r["docs"] for r in quality_report(audit(spark, raw_col="text").features).collect()}
    assert report == {"html": 1, "short": 1, "empty": 0, "dropped": 2, "kept": 52}


def test_crowded_units_change_nothing(spark):
    few = audit(spark, params=NearDupParams(unit_rows=1))
    assert few.dups.pairs().count() == 5
    assert {r["value"] for r in few.scorecard.where("metric = 'MI-01'").collect()} == {9.62}


def test_no_signature_is_looked_up_by_pair(spark, monkeypatch):
    """The pairs behind the scorecard are counted where they meet, not joined with their signatures once more."""
    monkeypatch.setattr(near_dup, "match_count", None)
    assert {r["value"] for r in audit(spark).scorecard.where("metric = 'MI-01'").collect()} == {9.62}


def test_empty_corpus(spark):
    ingested = ingest(sample(spark).where("false"), keep=("doc_id", "url"))
    rows = {r["metric"]: r["value"] for r in run_audit(ingested, {"a": 1}).scorecard.collect()}
    assert rows == {"MI-01": 0.0, "MI-02": 0.0, "MI-03": 0.0, "MI-04": 0.0}


def test_texts_are_read_once(spark):
    """Everything after the feature pass works on the feature table."""
    result = audit(spark)
    for frame in (result.scorecard, result.cleaned, result.dups.pairs()):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "text" not in plan and "LogicalRDD" not in plan


def test_files(spark, tmp_path):
    records, out = str(tmp_path / "records"), str(tmp_path / "out")
    sample(spark).orderBy("doc_id").coalesce(1).select("url", F.col("text").alias("texto")).write.json(records)
    Path(records, "broken.json").write_text('{"url": "http://example.org/54", "texto\n')  # counted, not audited
    (tmp_path / "terms.json").write_text('{"ansiedad": 0.1, "otro": 0.5, "ansiedad": 0.2}')
    for day in (1, 2):
        audit_files(spark, records, out, datetime(2026, 5, day), str(tmp_path / "terms.json"), text_col="texto", list_pairs=True)
    history = read_scorecards(spark, f"{out}/scorecards")
    assert history.count() == 2
    latest = {r["metric"]: r for r in latest_scorecard(history).collect()}
    assert {m: r["value"] for m, r in latest.items()} == {"MI-01": 9.62, "MI-02": 5.77, "MI-03": 0.0, "MI-04": 96.3}
    assert latest["MI-01"]["run_id"] == "SC-20260502-000000"
    # Ids are positions in the input; the copies sit at 45 to 51.
    pairs = sorted((r["doc_a"], r["doc_b"]) for r in spark.read.parquet(f"{out}/near_dups/pairs").collect())
    assert pairs == [(45, 46), (45, 47), (46, 47), (48, 49), (50, 51)]
    assert spark.read.json(f"{out}/near_dups/summary").first()["total_pairs"] == 5
    audited = spark.read.parquet(f"{out}/audited")
    assert audited.where("reject_reason IS NULL").count() == 52
    assert [r["doc_id"] for r in audited.where("tox_millis = 200").collect()] == [0]
    manifest = spark.read.json(f"{out}/manifest").collect()
    assert {(r["total_rows"], r["corrupt_rows"], tuple(r["columns"]), tuple(r["missing_columns"])) for r in manifest} == {(54, 1, ("url", "text", "text_clean"), ())}
    assert spark.read.json(f"{out}/reports/quality").where("rule = 'short'").first()["docs"] == 2


@pytest.mark.parametrize("broadcast", [1_000_000, 10])
def test_files_with_a_long_list(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(toxicity, "BROADCAST_TERMS", broadcast)
    records = str(tmp_path / "records")
    sample(spark).orderBy("doc_id").coalesce(1).select("text").write.json(records)
    (tmp_path / "terms.json").write_text(json.dumps({"ansiedad": 0.2} | {f"term{i}": 0.5 for i in range(6_000)}))
    audit_files(spark, records, str(tmp_path / "out"), datetime(2026, 5, 1), str(tmp_path / "terms.json"))
    audited = spark.read.parquet(str(tmp_path / "out/audited"))
    assert [r["doc_id"] for r in audited.where("tox_millis = 200").collect()] == [0] and audited.where("tox_millis > 0").count() == 1
    assert audited.count() == 54 and audited.where("n_tokens > 10").count() == 52
    assert [r["missing_columns"] for r in spark.read.json(str(tmp_path / "out/manifest")).collect()] == [["url"]]
