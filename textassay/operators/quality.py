"""Heuristic quality filters, applied in order; the first rule that fails names the reason."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textassay.functions.text import html_ratio, is_blank
from textassay.runtime import percent

MAX_HTML_RATIO = 0.3
MIN_LENGTH = 100
RULES = ("html", "short", "empty")


def reject_reason(text_col: str = "text", raw_col: str | None = None,
                  max_html_ratio: float = MAX_HTML_RATIO, min_length: int = MIN_LENGTH) -> Column:
    """'html', 'short', 'empty' or NULL (kept).

    The ratio is taken on the clean text, or on ``raw_col`` where given. The length of NULL is not
    short, so NULL text reaches the last rule.
    """
    text = F.col(text_col)
    return (
        F.when(F.coalesce(html_ratio(raw_col or text_col) > max_html_ratio, F.lit(False)), "html")
        .when(F.coalesce(F.length(text) < min_length, F.lit(False)), "short")
        .when(is_blank(text), "empty")
    )


def quality_reject_reason(df: DataFrame, text_col: str = "text", raw_col: str | None = None, **limits) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(text_col, raw_col, **limits))


def quality_filter(df: DataFrame, text_col: str = "text", raw_col: str | None = None, **limits) -> DataFrame:
    """The rows that pass every rule, columns unchanged."""
    return df.where(reject_reason(text_col, raw_col, **limits).isNull())


def quality_report(judged: DataFrame) -> DataFrame:
    """(rule, docs, pct): one pass over ``reject_reason``; every share is of the initial total."""
    reason = F.col("reject_reason")
    counts = judged.agg(
        F.count("*").alias("total"),
        *[F.count_if(reason == r).alias(r) for r in RULES],
        F.count_if(reason.isNotNull()).alias("dropped"),
        F.count_if(reason.isNull()).alias("kept"),
    )
    names = [*RULES, "dropped", "kept"]
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("docs")) for n in names]))
    return counts.select("total", rows.alias("row")).select(
        "row.rule", "row.docs", percent(F.col("row.docs"), F.col("total")).alias("pct")
    )
