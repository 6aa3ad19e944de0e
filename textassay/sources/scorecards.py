"""Scorecard history: one JSON document per run, the newest by run id."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textassay.sources.jsonl import read_json_documents

SCORECARD_SCHEMA = """
    run_id string, generated_at timestamp, project string,
    metrics array<struct<metric: string, title: string, value: double, score_mean: double, unit: string,
        method: string, threshold: double, direction: string, n_hits: decimal(38,0), n_total: bigint,
        status: string, code: string, message: string>>
"""
METRIC_FIELDS = (
    "metric", "title", "value", "score_mean", "unit", "method", "threshold", "direction", "n_hits", "n_total",
    "status", "code", "message",
)


def run_id(at: datetime) -> str:
    return at.strftime("SC-%Y%m%d-%H%M%S")


def scorecard_document(judged: DataFrame, at: datetime, project: str = "corpus audit", name: str | None = None) -> DataFrame:
    """The tidy scorecard (four rows) as one nested row."""
    metrics = F.array_sort(F.collect_list(F.struct(*METRIC_FIELDS)))
    return judged.agg(metrics.alias("metrics")).select(
        F.lit(name or run_id(at)).alias("run_id"), F.lit(at).alias("generated_at"), F.lit(project).alias("project"), "metrics"
    )


def write_scorecard(judged: DataFrame, history: str, at: datetime, project: str = "corpus audit", name: str | None = None) -> None:
    """Append one JSON document to the history folder."""
    scorecard_document(judged, at, project, name).coalesce(1).write.mode("append").json(history)


def read_scorecards(spark: SparkSession, history: str) -> DataFrame:
    return read_json_documents(spark, history, SCORECARD_SCHEMA)


def latest_scorecard(history: DataFrame) -> DataFrame:
    """The metrics of the run with the greatest run id, one row each; no rows without a run."""
    newest = history.agg(F.max_by(F.struct("run_id", "generated_at", "metrics"), "run_id").alias("s"))
    return newest.select("s.run_id", "s.generated_at", F.explode("s.metrics").alias("m")).select("run_id", "generated_at", "m.*")
