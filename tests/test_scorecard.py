from datetime import datetime

import pytest

from textassay.operators import scorecard as S
from textassay.sources import scorecards as H


def inputs(spark, pair_pct=0.0, pii=0, toxic=0, kept=100, total=100):
    dup = spark.createDataFrame([(pair_pct, 7, kept)], "pair_pct double, total_pairs long, total_docs long")
    stats = spark.createDataFrame(
        [(kept, pii, 100.0 * pii / kept, 0.012345, toxic, 100.0 * toxic / kept)],
        "total_docs long, pii_docs long, pct_pii double, mean_score double, toxic_docs long, pct_toxic double",
    )
    return dup, stats, spark.createDataFrame([(total,)], "total_rows long")


def judged(metrics):
    return {r["metric"]: r for r in S.recommendations(metrics).collect()}


def test_limits_are_strict(spark):
    at = judged(S.scorecard_metrics(*inputs(spark, 10.0, 200, 500, 10_000, 12_500)))
    assert {m: (r["value"], r["status"]) for m, r in at.items()} == {
        "MI-01": (10.0, "OK"), "MI-02": (2.0, "OK"), "MI-03": (5.0, "OK"), "MI-04": (80.0, "OK"),
    }
    past = judged(S.scorecard_metrics(*inputs(spark, 10.01, 201, 501, 10_000, 12_501)))
    assert {m: (r["value"], r["status"], r["code"]) for m, r in past.items()} == {
        "MI-01": (10.01, "ALERT", "HIGH_DUPLICATION"),
        "MI-02": (2.01, "ALERT", "PII_FOUND"),
        "MI-03": (5.01, "ALERT", "HIGH_TOXICITY"),
        "MI-04": (79.99, "ALERT", "LOW_QUALITY"),
    }
    assert "79.99%" in past["MI-04"]["message"]
    assert past["MI-03"]["score_mean"] == 0.0123
    assert [int(past[m]["n_hits"]) for m in sorted(past)] == [7, 201, 501, 10_000]


def test_alerts_use_unrounded_values(spark):
    # 2.001 % shows as 2.0 but passes the limit.
    row = judged(S.scorecard_metrics(*inputs(spark, pii=2001, kept=100_000, total=100_000)))["MI-02"]
    assert (row["value"], row["status"]) == (2.0, "ALERT")


def test_missing_inputs(spark):
    dup, stats, total = inputs(spark)
    rows = judged(S.scorecard_metrics(None, stats, total))
    assert (rows["MI-01"]["value"], rows["MI-01"]["status"], rows["MI-01"]["message"]) == (None, "MISSING", None)
    assert rows["MI-04"]["value"] == 100.0
    zero = judged(S.scorecard_metrics(dup, None, None, missing="zero"))
    assert {m: r["value"] for m, r in zero.items()} == {"MI-01": 0.0, "MI-02": 0.0, "MI-03": 0.0, "MI-04": 0.0}
    # Without a manifest the final total stands in for the original one.
    assert judged(S.scorecard_metrics(dup, stats))["MI-04"]["value"] == 100.0
    with pytest.raises(ValueError):
        S.scorecard_metrics(None, None)


def test_clean_rate(spark):
    _, stats, total = inputs(spark, kept=52, total=54)
    assert tuple(S.clean_rate(stats, total).first()) == (54, 52, pytest.approx(96.2963, abs=1e-4))
    assert tuple(S.clean_rate(stats).first()) == (52, 52, 100.0)


def test_stats_without_columns(spark):
    df = spark.createDataFrame([(1,)], "doc_id long")
    row = S.dataset_stats(df).first()
    assert (row["total_docs"], row["pii_docs"], row["mean_score"], row["pct_toxic"]) == (1, None, None, None)
    texts = S.report_values(S.dataset_stats(df)).first()
    assert (texts["pct_pii_text"], texts["mean_score_text"]) == ("N/A", "N/A")


def test_history(spark, tmp_path):
    path = str(tmp_path / "history")
    for day, pii in ((2, 3), (9, 1), (5, 2)):
        H.write_scorecard(S.recommendations(S.scorecard_metrics(*inputs(spark, pii=pii))), path, datetime(2026, 1, day))
    history = H.read_scorecards(spark, path)
    assert history.count() == 3
    latest = {r["metric"]: r for r in H.latest_scorecard(history).collect()}
    assert latest["MI-02"]["run_id"] == "SC-20260109-000000"
    assert (latest["MI-02"]["value"], latest["MI-02"]["status"], int(latest["MI-01"]["n_hits"])) == (1.0, "OK", 7)
    assert H.latest_scorecard(history.where("false")).count() == 0


def test_scorecard_with_absent_fields(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"run_id": "SC-1", "metrics": [{"metric": "MI-01"}]}')
    row = H.latest_scorecard(H.read_scorecards(spark, str(tmp_path / "one.json"))).first()
    assert (row["run_id"], row["metric"], row["value"]) == ("SC-1", "MI-01", None)
