import json
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from textassay.operators import toxicity as X
from textassay.sources import lexicon as L

TERMS = {"xy": 200, "bad": 500, "worse": 1000}


def test_scores(texts):
    rows = X.toxicity_score(texts(None, "...", "x,y z", "bad bad ok", "xy " + "w " * 16, "worse"), TERMS).collect()
    found = {r["doc_id"]: (r["tox_millis"], r["n_tokens"], r["tox_score"]) for r in rows}
    assert found == {
        0: (0, 0, 0.0), 1: (0, 0, 0.0), 2: (200, 2, 0.1), 3: (1000, 3, 0.333333), 4: (200, 17, 0.011765), 5: (1000, 1, 1.0),
    }
    assert [r["doc_id"] for r in X.toxicity_flagged(X.toxicity_score(texts("bad bad ok", "worse", "bad"), TERMS)).collect()] == [1]


@pytest.mark.parametrize(("inline", "broadcast", "busy"), [(5_000, 9, 9), (0, 1_000, 9), (0, 1, 1_000_000), (0, 1, 5)])
def test_all_forms_of_a_list_agree(spark, texts, monkeypatch, inline, broadcast, busy):
    """Literals, hashes on every worker, a join by term, and one whose frequent terms are dealt to several tasks."""
    monkeypatch.setattr(X, "INLINE_TERMS", inline)
    monkeypatch.setattr(X, "BROADCAST_TERMS", broadcast)
    monkeypatch.setattr(X, "BUSY_DOCS", busy)
    rng = random.Random(5)
    df = texts(*[" ".join(rng.choices(["bad", "worse", "xy", "the", "of"], k=rng.randint(0, 30))) for _ in range(60)], None)
    table = spark.createDataFrame([(t, w / 1000) for t, w in TERMS.items()], "term string, weight double")
    columns = ["doc_id", "tox_millis", "n_tokens", "tox_score"]
    expected = sorted(X.toxicity_score(df, TERMS).select(columns).collect())
    assert sorted(X.toxicity_score(df, table).select(columns).collect()) == expected
    kinds = {(5_000, 9): dict, (0, 1_000): X.TermTable, (0, 1): type(table)}
    assert isinstance(X.prepared(table), kinds[inline, broadcast])
    assert X.toxicity_score(df.limit(0), table).collect() == []


def test_long_lists(spark, texts):
    """100,000 terms are searched without a shuffle; the scores are those of the few terms that occur."""
    few = {f"w{i}": i % 1000 + 1 for i in range(0, 100_000, 7)}
    table = spark.range(100_000).select(F.concat(F.lit("w"), "id").alias("term"), ((F.col("id") % 1000 + 1) / 1000).alias("weight"))
    df = texts(*[" ".join(f"w{7 * i * k % 100_100}" for k in range(1, 40)) for i in range(50)], "", None)
    terms = X.prepared(table)
    assert isinstance(terms, X.TermTable)
    scored = X.toxicity_score(df, terms)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    expected = {}
    for r in df.collect():
        tokens = (r["text"] or "").split()
        expected[r["doc_id"]] = (sum(int(t[1:]) % 1000 + 1 if int(t[1:]) < 100_000 else 0 for t in tokens), len(tokens))
    assert {r["doc_id"]: (r["tox_millis"], r["n_tokens"]) for r in scored.collect()} == expected and len(few) > 5_000


def test_a_costly_list_is_made_once(spark, texts, monkeypatch):
    """The list is written before its form is chosen, and what may reach the driver is bounded by some ten megabytes."""
    made = spark.sparkContext.accumulator(0)

    def mark(rows):
        for r in rows:
            made.add(1)
            yield r

    rows = spark.createDataFrame(spark.range(60).rdd.map(lambda r: (f"w{r['id']}", 0.5)).mapPartitions(mark), "term string, weight double")
    monkeypatch.setattr(X, "INLINE_TERMS", 5)
    df = texts("w1 w2 x", "w3", None)
    for limit, kind in ((100, X.TermTable), (10, type(rows))):
        monkeypatch.setattr(X, "BROADCAST_TERMS", limit)
        made.value = 0
        terms = X.prepared(rows)
        assert isinstance(terms, kind)
        assert {r["doc_id"]: r["tox_millis"] for r in X.toxicity_score(df, terms).collect()} == {0: 1000, 1: 500, 2: 0}
        assert made.value == 60
    monkeypatch.undo()
    assert 16 * X.BROADCAST_TERMS <= 10_000_000


def test_empty_lexicon(texts):
    assert [r["tox_score"] for r in X.toxicity_score(texts("bad"), {}).collect()] == [0.0]


def test_distribution_is_exact(spark):
    rng = random.Random(3)
    values = [0.0] * 500 + [round(rng.random() ** 4, 6) for _ in range(700)] + [1.0]
    df = spark.createDataFrame([(v,) for v in values], "tox_score double").repartition(5)
    row = X.toxicity_distribution(df).first()
    assert (row["min_score"], row["max_score"]) == (0.0, 1.0)
    assert row["mean_score"] == pytest.approx(statistics.fmean(values), abs=1e-12)
    assert row["std_score"] == pytest.approx(statistics.stdev(values), abs=1e-12)
    for name, q in (("median_score", 50), ("p90_score", 90), ("p95_score", 95)):
        assert row[name] == pytest.approx(float(np.percentile(values, q)), abs=1e-12)


def test_distribution_of_one_and_of_none(spark):
    one = spark.createDataFrame([(0.25,)], "tox_score double")
    row = X.toxicity_distribution(one).first()
    assert (row["median_score"], row["p95_score"], row["std_score"]) == (0.25, 0.25, None)
    assert X.toxicity_distribution(one.where("false")).first()["median_score"] is None


def test_rate_of_empty_corpus(spark):
    df = spark.createDataFrame([], "tox_score double")
    assert X.toxicity_rate(df).first().asDict() == {"total_docs": 0, "toxic_docs": 0, "mean_score": 0.0, "pct_toxic": 0.0}


def test_top_breaks_ties_by_id(texts):
    scored = X.toxicity_score(texts("bad", "ok", "bad", "worse " * 30), TERMS)
    rows = X.toxicity_top(scored, 3).collect()
    assert [r["doc_id"] for r in rows] == [3, 0, 2]
    assert rows[0]["snippet"] == ("worse " * 30)[:100] + "..."


def test_lexicon_last_entry_wins(spark, tmp_path):
    path = tmp_path / "terms.json"
    path.write_text('{"uno": 0.2, "dos": 0.3, "uno": 0.4, "año": 1.0}', encoding="utf-8")
    entries = L.read_lexicon(spark, str(path))
    assert [tuple(r) for r in entries.orderBy("ord").collect()] == [(0, "uno", 0.2), (1, "dos", 0.3), (2, "uno", 0.4), (3, "año", 1.0)]
    table = L.lexicon_table(entries)
    assert L.inline_terms(table) == {"uno": 400, "dos": 300, "año": 1000}
    assert L.inline_terms(table, max_terms=2) is None


def test_pretty_printed_json_and_csv(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"x": 0.1, "y": 0.2}, indent=2))
    (tmp_path / "b.csv").write_text("ord,term,weight\n0,x,0.5\n1,x,0.1\n2,y,0.2\n")
    from_json = L.inline_terms(L.lexicon_table(L.read_lexicon(spark, str(tmp_path / "a.json"))))
    from_csv = L.inline_terms(L.lexicon_table(L.read_lexicon(spark, str(tmp_path / "b.csv"), "csv")))
    assert from_json == from_csv == {"x": 100, "y": 200}


def test_two_column_csv_and_bad_entries(spark, tmp_path):
    (tmp_path / "a.csv").write_text("term,weight\nx,0.9\ny,0.25\n")
    assert L.inline_terms(L.lexicon_table(L.read_lexicon(spark, str(tmp_path / "a.csv"), "csv"))) == {"x": 900, "y": 250}
    (tmp_path / "b.csv").write_text("word,weight\nx,0.9\n")
    with pytest.raises(ValueError, match="term"):
        L.read_lexicon(spark, str(tmp_path / "b.csv"), "csv")
    for body in ("x,high", ",0.5", "x,0.0004"):
        (tmp_path / "c.csv").write_text(f"term,weight\n{body}\n")
        with pytest.raises(Exception, match="lexicon entry|multiple of 0.001"):
            L.inline_terms(L.read_lexicon(spark, str(tmp_path / "c.csv"), "csv"))


def test_default_terms(spark):
    assert L.inline_terms(L.lexicon_table(L.default_lexicon(spark))) == L.default_terms()
    assert all(w % 100 == 0 for w in L.default_terms().values())
    assert X.toxicity_score(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("idiot").alias("text")), L.default_terms()).first()["tox_score"] == 0.5
