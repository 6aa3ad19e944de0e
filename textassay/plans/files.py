"""From JSON lines to all audit outputs on storage."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textassay.functions.patterns import PII_PATTERNS
from textassay.operators.ingest import ingest, written_row_id
from textassay.operators.near_dup import DEFAULTS, NearDupParams, NearDups
from textassay.operators.pii import pii_fp_estimate, pii_report
from textassay.operators.quality import quality_report
from textassay.operators.toxicity import toxicity_distribution, toxicity_rate
from textassay.plans.audit import Audit, audit_features, audit_of
from textassay.sources.jsonl import CORRUPT_COLUMN, read_jsonl, record_schema
from textassay.sources.lexicon import default_terms, lexicon_table, read_lexicon
from textassay.sources.manifest import IngestCounts, ingest_manifest, write_manifest
from textassay.sources.scorecards import write_scorecard


def write_near_dups(dups: NearDups, path: str, list_pairs: bool = False) -> None:
    """Summary as JSON, and the pairs as Parquet: compact (groups and similar groups), and spelled out if wanted.

    The list has k(k-1)/2 rows for k copies of one text; the compact tables hold the same information
    in one row per document.
    """
    dups.summary().coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    dups.signed.select("doc_id", "group_key").write.mode("overwrite").parquet(f"{path}/members")
    dups.groups.select("group_key", "rep", "copies").write.mode("overwrite").parquet(f"{path}/groups")
    dups.similar.write.mode("overwrite").parquet(f"{path}/similar_groups")
    if list_pairs:
        dups.pairs().write.mode("overwrite").parquet(f"{path}/pairs")


def _write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def audit_files(spark: SparkSession, records: str, out: str, at: datetime, lexicon: str | None = None, text_col: str = "text",
                raw_ratio: bool = False, list_pairs: bool = False, params: NearDupParams = DEFAULTS) -> Audit:
    """Read ``records`` (JSON lines with ``url`` and ``text_col``) and write to ``out``:

    ingested/     url, text, text_clean; lines that are not JSON as they are, in ``_corrupt_record``
    audited/      the same with id, reject reason, scores and flags (the kept rows have no reason)
    near_dups/    summary, members, groups, similar groups; with ``list_pairs`` every pair
    reports/      quality, toxicity, personal data
    manifest/     files, sizes, hashes; rows, lines that are not JSON (they take no part in the audit) and declared columns
                  without any value, all counted while ``ingested`` is written
    scorecards/   one document per run

    ``lexicon`` is a JSON object of term weights, of any length; ``raw_ratio`` takes the HTML ratio on the raw text.
    """
    declared = (text_col, "url")
    counts = IngestCounts(declared, CORRUPT_COLUMN)
    lines = counts.observe(read_jsonl(spark, records, record_schema(text_col), keep_corrupt=True))
    ingest(lines, text_col, ("url", CORRUPT_COLUMN)).write.mode("overwrite").parquet(f"{out}/ingested")
    stored = spark.read.parquet(f"{out}/ingested")
    names = [c for c in stored.columns if c != CORRUPT_COLUMN]
    write_manifest(ingest_manifest(spark, records), names, counts, f"{out}/manifest")
    ingested = written_row_id(stored).where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)

    terms = lexicon_table(read_lexicon(spark, lexicon)) if lexicon else default_terms()
    features = audit_features(
        ingested, terms, raw_col="text" if raw_ratio else None, params=params, carried=("url", "text", "text_clean")
    )
    features.write.mode("overwrite").parquet(f"{out}/audited")

    # Every step below reads a few narrow columns of that table.
    audit = audit_of(spark.read.parquet(f"{out}/audited"), params)
    write_near_dups(audit.dups, f"{out}/near_dups", list_pairs)
    _write_report(quality_report(audit.features), f"{out}/reports/quality")
    _write_report(toxicity_distribution(audit.cleaned), f"{out}/reports/toxicity_distribution")
    _write_report(toxicity_rate(audit.cleaned), f"{out}/reports/toxicity_rate")
    flags = audit.cleaned.select(*[p.column for p in PII_PATTERNS], F.col("pii_any"))
    _write_report(pii_report(flags), f"{out}/reports/pii")
    _write_report(pii_fp_estimate(flags), f"{out}/reports/pii_expected")
    write_scorecard(audit.scorecard, f"{out}/scorecards", at)
    return audit
