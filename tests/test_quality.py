from textassay.operators import quality as Q


def reasons(df, **kw):
    return {r["doc_id"]: r["reject_reason"] for r in Q.quality_reject_reason(df, **kw).collect()}


def test_first_failing_rule(texts):
    df = texts("x" * 99, "x" * 100, None, "", "<b>" * 40 + "x", "<b>" * 2 + "x", " " * 120, "<b>" * 10 + "x" * 70)
    assert reasons(df) == {0: "short", 1: None, 2: "empty", 3: "short", 4: "html", 5: "html", 6: "empty", 7: None}


def test_length_counts_code_points(texts):
    assert reasons(texts("\U0001f642" * 99, "\U0001f642" * 100)) == {0: "short", 1: None}


def test_ratio_on_raw(spark):
    df = spark.createDataFrame([(0, "<b>" * 100 + "x" * 100, "x" * 100), (1, "y" * 100, "y" * 100)], "doc_id long, raw string, text string")
    assert reasons(df, raw_col="raw") == {0: "html", 1: None}
    assert reasons(df) == {0: None, 1: None}


def test_report_sums_to_total(texts):
    df = texts("x" * 99, "x" * 100, None, "<b>" * 40, "y" * 150)
    report = {r["rule"]: (r["docs"], r["pct"]) for r in Q.quality_report(Q.quality_reject_reason(df)).collect()}
    assert report == {"html": (1, 20.0), "short": (1, 20.0), "empty": (1, 20.0), "dropped": (3, 60.0), "kept": (2, 40.0)}
    assert sorted(r["doc_id"] for r in Q.quality_filter(df).collect()) == [1, 4]


def test_empty_corpus(texts):
    report = Q.quality_report(Q.quality_reject_reason(texts("a").where("false"))).collect()
    assert [(r["docs"], r["pct"]) for r in report] == [(0, 0.0)] * 5
