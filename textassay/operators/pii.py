"""Personal data flags: one native predicate per category, all in one projection over one scan."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textassay.functions.patterns import PII_PATTERNS, PiiPattern
from textassay.runtime import percent


def pii_columns(text_col: str = "text", patterns: tuple[PiiPattern, ...] = PII_PATTERNS) -> list[Column]:
    return [F.coalesce(F.col(text_col).rlike(p.pattern), F.lit(False)).alias(p.column) for p in patterns]


def pii_flags(df: DataFrame, text_col: str = "text", patterns: tuple[PiiPattern, ...] = PII_PATTERNS) -> DataFrame:
    """Input columns plus one boolean per category; NULL text has no personal data."""
    return df.select("*", *pii_columns(text_col, patterns))


def pii_any(df: DataFrame, patterns: tuple[PiiPattern, ...] = PII_PATTERNS) -> DataFrame:
    """Adds ``pii_any``: at least one category found."""
    return df.withColumn("pii_any", reduce(Column.__or__, [F.col(p.column) for p in patterns]))


def pii_report(flagged: DataFrame, patterns: tuple[PiiPattern, ...] = PII_PATTERNS) -> DataFrame:
    """(category, docs, pct): documents per category and, as ``any``, with at least one hit."""
    names = [(p.category, p.column) for p in patterns] + [("any", "pii_any")]
    counts = flagged.agg(F.count("*").alias("total"), *[F.count_if(F.col(c)).alias(c) for _, c in names])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("category"), F.col(c).alias("docs")) for n, c in names]))
    return counts.select("total", rows.alias("row")).select(
        "row.category", "row.docs", percent(F.col("row.docs"), F.col("total")).alias("pct")
    )


def pii_fp_estimate(flagged: DataFrame, patterns: tuple[PiiPattern, ...] = PII_PATTERNS) -> DataFrame:
    """(category, docs, fp_rate, fp_note, expected_true): documented false-hit rates applied to the counts."""
    rates = [
        F.struct(F.lit(p.category).alias("category"), F.lit(p.fp_rate).alias("fp_rate"), F.lit(p.fp_note).alias("fp_note"))
        for p in patterns
    ]
    rate = F.filter(F.array(*rates), lambda r: r["category"] == F.col("category"))[0]
    return (
        pii_report(flagged, patterns)
        .where("category <> 'any'")
        .select("category", "docs", rate.alias("rate"))
        .select(
            "category",
            "docs",
            "rate.fp_rate",
            "rate.fp_note",
            F.round(F.col("docs") * (1 - F.col("rate.fp_rate")), 2).alias("expected_true"),
        )
    )
