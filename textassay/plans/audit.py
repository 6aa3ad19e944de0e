"""The whole audit as one job.

The texts are read once: a single narrow pass derives everything that needs them (reject reason,
toxicity sums, personal data flags, signature) into a small feature table. All reports, the
near-duplicate search and the scorecard work on that table.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textassay.functions.minhash import signature_udf
from textassay.functions.patterns import PII_PATTERNS
from textassay.functions.text import shingle_normalize
from textassay.operators.near_dup import DEFAULTS, NearDupParams, NearDups, near_dups_of, signature_key
from textassay.operators.pii import pii_any, pii_columns
from textassay.operators.quality import reject_reason
from textassay.operators.scorecard import dataset_stats, recommendations, scorecard_metrics
from textassay.operators.toxicity import Terms, TermTable, joined_sums, prepared, score_column, token_hashes, token_sums
from textassay.runtime import materialize, small_batches


@dataclass(frozen=True)
class Audit:
    features: DataFrame
    cleaned: DataFrame
    dups: NearDups
    scorecard: DataFrame


def audit_features(ingested: DataFrame, lexicon: Terms, id_col: str = "doc_id", text_col: str = "text_clean",
                   raw_col: str | None = None, params: NearDupParams = DEFAULTS, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carried columns, reject_reason, tox_millis, n_tokens, pii_*, signature, tox_score, pii_any, group_key).

    About 700 bytes a row besides the carried columns. ``lexicon`` may have any length (see ``toxicity.prepared``): only one
    beyond a broadcast needs a join, by ``doc_id``, which must be unique then.
    """
    small_batches(ingested.sparkSession)
    terms = prepared(lexicon)
    reason = reject_reason(text_col, raw_col).alias("reject_reason")
    rows = ingested.select(F.col(id_col).alias("doc_id"), *carried, reason, F.col(text_col).alias("_text"))
    # Rejected texts are blanked, so no later expression spends time on them.
    judged = rows.withColumn("_text", F.when(F.col("reject_reason").isNull(), F.col("_text")))
    if isinstance(terms, dict):
        tokens, sums = token_sums("_text", terms).alias("tox"), ["tox.tox_millis", "tox.n_tokens"]
    elif isinstance(terms, TermTable):
        tokens, sums = token_hashes("_text").alias("hashes"), [terms.sums("hashes").alias("tox_millis"), F.size("hashes").cast("bigint").alias("n_tokens")]
    else:
        tokens, sums = F.lit(None).alias("tox"), []
    local = judged.select("doc_id", *carried, "reject_reason", tokens, *pii_columns("_text"), shingle_normalize("_text").alias("norm"))
    udf = signature_udf(params.n_gram, params.num_perm)
    flags = [p.column for p in PII_PATTERNS]
    made = local.select("doc_id", *carried, "reject_reason", *sums, *flags, udf("norm").alias("signature"))
    if not sums:
        made = made.join(joined_sums(judged, terms, "doc_id", "_text"), "doc_id")
    order = ["doc_id", *carried, "reject_reason", "tox_millis", "n_tokens", *flags, "signature"]
    return pii_any(made.select(*order).withColumn("tox_score", score_column())).withColumn("group_key", signature_key())


def run_audit(ingested: DataFrame, lexicon: Terms, id_col: str = "doc_id", text_col: str = "text_clean",
              raw_col: str | None = None, params: NearDupParams = DEFAULTS, missing: str = "null") -> Audit:
    """Filters, near-duplicates, toxicity, personal data and scorecard of an ingested table."""
    return audit_of(materialize(audit_features(ingested, lexicon, id_col, text_col, raw_col, params), "features"), params, missing)


def audit_of(features: DataFrame, params: NearDupParams = DEFAULTS, missing: str = "null") -> Audit:
    """The audit of a written feature table."""
    cleaned = features.where("reject_reason IS NULL")
    dups = near_dups_of(cleaned.select("doc_id", "group_key", "signature"), params)
    total = features.agg(F.count("*").alias("total_rows"))
    scorecard = recommendations(scorecard_metrics(dups.summary(), dataset_stats(cleaned), total, missing))
    return Audit(features, cleaned, dups, scorecard)
