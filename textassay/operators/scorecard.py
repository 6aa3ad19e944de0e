"""The four integrity metrics, their alerts and the scorecard."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textassay.functions.text import number_label, percent_label
from textassay.operators.toxicity import THRESHOLD, mean_score
from textassay.runtime import percent

# --- fixed values: metric, alert limit, direction of the alert --------------------------------
LIMITS = {
    "MI-01": (10.0, ">"),
    "MI-02": (2.0, ">"),
    "MI-03": (5.0, ">"),
    "MI-04": (80.0, "<"),
}
# ----------------------------------------------------------------------------------------------

TITLES = {
    "MI-01": ("near-duplicate pairs per document", "MinHash + LSH, Jaccard >= 0.8"),
    "MI-02": ("documents with personal data", "regular expressions, 5 categories"),
    "MI-03": ("documents above the toxicity threshold", "weighted lexicon, mean per token"),
    "MI-04": ("records kept by the filters", "HTML ratio, length, completeness"),
}

# metric -> (code and text when the limit is passed, code and text otherwise); %s is the value.
ADVICE = {
    "MI-01": (
        ("HIGH_DUPLICATION", "Near-duplicate pairs reach %s of the documents: deduplicate with a lower similarity threshold."),
        ("DUPLICATION_OK", "Duplication is within the accepted limit."),
    ),
    "MI-02": (
        ("PII_FOUND", "Personal data may be present in %s of the documents: mask it or review them."),
        ("PII_OK", "Personal data is below the accepted limit."),
    ),
    "MI-03": (
        ("HIGH_TOXICITY", "%s of the documents pass the toxicity threshold: filter them out."),
        ("TOXICITY_OK", "Toxicity is within the accepted limit."),
    ),
    "MI-04": (
        ("LOW_QUALITY", "Only %s of the records pass the quality filters: check the source or the filter limits."),
        ("QUALITY_OK", "The share of clean records is above the accepted limit."),
    ),
}


def dataset_stats(final: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row: total_docs, pii_docs, pct_pii, mean_score, toxic_docs, pct_toxic.

    Figures whose columns are absent are NULL.
    """
    total = F.count("*")

    def present(column: str, value: Column, kind: str) -> Column:
        return value if column in final.columns else F.lit(None).cast(kind)

    pii = F.count_if(F.col("pii_any")) if "pii_any" in final.columns else None
    toxic = F.count_if(F.col("tox_score") > threshold) if "tox_score" in final.columns else None
    return final.agg(
        total.alias("total_docs"),
        present("pii_any", pii, "bigint").alias("pii_docs"),
        present("pii_any", percent(pii, total) if pii is not None else None, "double").alias("pct_pii"),
        present("tox_score", mean_score() if toxic is not None else None, "double").alias("mean_score"),
        present("tox_score", toxic, "bigint").alias("toxic_docs"),
        present("tox_score", percent(toxic, total) if toxic is not None else None, "double").alias("pct_toxic"),
    )


def one_row(*frames: DataFrame | None) -> DataFrame:
    """One-row frames with different columns, side by side on one row (without a join)."""
    present = [f for f in frames if f is not None]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def clean_rate(final_total: DataFrame, ingested_total: DataFrame | None = None) -> DataFrame:
    """(total_original, total_final, pct_clean); the original total falls back to the final one.

    ``final_total`` has ``total_docs``, ``ingested_total`` has ``total_rows``; one row each.
    """
    both = one_row(final_total.select("total_docs"), ingested_total.select("total_rows") if ingested_total is not None else None)
    original = F.coalesce("total_rows", "total_docs") if ingested_total is not None else F.col("total_docs")
    return both.select(
        original.alias("total_original"),
        F.col("total_docs").alias("total_final"),
        percent(F.col("total_docs"), original).alias("pct_clean"),
    )


def scorecard_metrics(dup_summary: DataFrame | None, stats: DataFrame | None, ingested_total: DataFrame | None = None,
                      missing: str = "null") -> DataFrame:
    """Tidy scorecard, one row per metric:
    (metric, title, value, score_mean, unit, method, threshold, direction, n_hits, n_total, exact_value).

    ``value`` is rounded to two digits, ``exact_value`` is what the alerts are tested on. An absent
    input leaves its metrics NULL, or 0 with ``missing="zero"``.
    """
    columns = {
        "pair_pct": "double", "total_pairs": "decimal(38,0)", "dup_total": "bigint", "total_docs": "bigint",
        "pii_docs": "bigint", "pct_pii": "double", "mean_score": "double", "toxic_docs": "bigint",
        "pct_toxic": "double", "total_rows": "bigint",
    }
    dup = dup_summary.select("pair_pct", "total_pairs", F.col("total_docs").alias("dup_total")) if dup_summary is not None else None
    rows = ingested_total.select("total_rows") if ingested_total is not None else None
    frames = [f for f in (dup, stats, rows) if f is not None]
    if not frames:
        raise ValueError("a scorecard needs at least one input")
    row = one_row(*frames)
    row = row.select(*[(F.col(c) if c in row.columns else F.lit(None)).cast(k).alias(c) for c, k in columns.items()])
    original = F.coalesce("total_rows", "total_docs")
    if missing == "zero":
        row = row.select(*[F.coalesce(c, F.lit(0)).cast(k).alias(c) for c, k in columns.items()])
        original = F.when(F.col("total_rows") > 0, F.col("total_rows")).otherwise(F.col("total_docs"))
    clean = F.when(F.col("total_docs").isNotNull(), percent(F.col("total_docs"), original))

    def metric(name: str, value: Column, hits: Column, total: Column, mean: Column = F.lit(None)) -> Column:
        title, method = TITLES[name]
        limit, direction = LIMITS[name]
        return F.struct(
            F.lit(name).alias("metric"),
            F.lit(title).alias("title"),
            F.bround(value, 2).alias("value"),
            F.bround(mean.cast("double"), 4).alias("score_mean"),
            F.lit("%").alias("unit"),
            F.lit(method).alias("method"),
            F.lit(limit).alias("threshold"),
            F.lit(direction).alias("direction"),
            hits.cast("decimal(38,0)").alias("n_hits"),
            total.alias("n_total"),
            value.alias("exact_value"),
        )

    metrics = F.array(
        metric("MI-01", F.col("pair_pct"), F.col("total_pairs"), F.col("dup_total")),
        metric("MI-02", F.col("pct_pii"), F.col("pii_docs"), F.col("total_docs")),
        metric("MI-03", F.col("pct_toxic"), F.col("toxic_docs"), F.col("total_docs"), F.col("mean_score")),
        metric("MI-04", clean, F.col("total_docs"), original),
    )
    return row.select(F.explode(metrics).alias("m")).select("m.*")


def recommendations(metrics: DataFrame) -> DataFrame:
    """Adds ``status`` (ALERT, OK or MISSING), ``code`` and ``message`` to tidy metrics.

    The limits are strict: a value equal to its limit is OK.
    """
    value = F.col("exact_value") if "exact_value" in metrics.columns else F.col("value")
    passed = F.when(F.col("direction") == ">", value > F.col("threshold")).otherwise(value < F.col("threshold"))
    status = F.when(value.isNull(), "MISSING").when(passed, "ALERT").otherwise("OK")

    def advice(part: int) -> Column:
        text = F.lit(None).cast("string")
        for name, (alert, ok) in ADVICE.items():
            mine = F.col("metric") == name
            label = F.format_string(alert[part], percent_label(value)) if part else F.lit(alert[part])
            text = F.when(mine & (F.col("status") == "ALERT"), label).when(mine & (F.col("status") == "OK"), ok[part]).otherwise(text)
        return text

    judged = metrics.withColumn("status", status).withColumn("code", advice(0)).withColumn("message", advice(1))
    return judged.drop("exact_value")


def report_values(stats: DataFrame) -> DataFrame:
    """The figures of ``dataset_stats`` with display texts; NULL shows as N/A."""
    return stats.select(
        "*",
        percent_label("pct_pii").alias("pct_pii_text"),
        percent_label("pct_toxic").alias("pct_toxic_text"),
        number_label("mean_score").alias("mean_score_text"),
    )
