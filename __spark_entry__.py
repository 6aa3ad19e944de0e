"""Registered queries and their SQL counterparts."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import check_sql  # noqa: E402
from textassay.functions import text as T  # noqa: E402
from textassay.operators import ingest as I  # noqa: E402
from textassay.operators import near_dup as N  # noqa: E402
from textassay.operators import pii as P  # noqa: E402
from textassay.operators import quality as Q  # noqa: E402
from textassay.operators import scorecard as S  # noqa: E402
from textassay.operators import toxicity as X  # noqa: E402
from textassay.plans import files  # noqa: E402
from textassay.plans.audit import run_audit  # noqa: E402
from textassay.runtime import scratch_path, spread  # noqa: E402
from textassay.sources import jsonl, lexicon, manifest, scorecards  # noqa: E402
from textassay.streaming import jobs  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "pages"))


def _ingested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.ingest(_pages(spark, sf_dir), "html", ("page_id", "url"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.toxicity_score(_docs(spark, sf_dir), lexicon.default_terms())


def _flagged(df: DataFrame) -> DataFrame:
    return P.pii_any(P.pii_flags(df))


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(X.toxicity_score(Q.quality_filter(_docs(spark, sf_dir)), lexicon.default_terms()))


def _big(df: DataFrame, *columns: str) -> DataFrame:
    """Wide decimal counts as BIGINT, for the comparison with the other engine."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# --- sources ---------------------------------------------------------------------------------


def assign_doc_id(spark, d):
    ids = I.assign_doc_id(_table(spark, d, "documents"), ("text", "lang", "source"), ("lang", "source", "n_chars"))
    return ids.drop("file_name", "row_index")


def row_position_id(spark, d):
    return I.row_position_id(_table(spark, d, "documents")).select("doc_id", "row_id")


def corpus_fingerprint(spark, d):
    return I.corpus_fingerprint(_table(spark, d, "documents"), tuple(DOCUMENT_TYPES))


def ingest_manifest(spark, d):
    # A file of text for every hundred documents; the larger half is streamed by the workers.
    path = scratch_path(spark, "document files")
    part = F.floor(F.col("doc_id") / 100).cast("bigint").alias("part")
    rows = _table(spark, d, "documents").select(part, "doc_id", "text").repartition("part").sortWithinPartitions("part", "doc_id")
    rows.drop("doc_id").write.partitionBy("part").text(path)
    key = F.regexp_extract("path", r"part=(\d+)", 1).cast("bigint").alias("part")
    return manifest.ingest_manifest(spark, path, inline_bytes=150_000).select(key, "bytes", "mb", "sha256")


def file_hashes(spark, d):
    # One file for each row of the table.
    path = scratch_path(spark, "nation files")
    _table(spark, d, "nation").select("n_nationkey", "n_name").coalesce(1).write.partitionBy("n_nationkey").text(path)
    key = F.regexp_extract("path", r"n_nationkey=(\d+)", 1).cast("bigint").alias("n_nationkey")
    return manifest.ingest_manifest(spark, path).select(key, "bytes", "sha256")


def manifest_totals(spark, d):
    table = _ingested_pages(spark, d).drop("page_id")
    return manifest.manifest_totals(table).withColumn("columns", F.array_join("columns", ","))


def schema_report(spark, d):
    return I.file_schema_report(spark, f"{d}/documents.parquet", DOCUMENT_TYPES)


def jsonl_ingest(spark, d):
    path = scratch_path(spark, "records")
    _table(spark, d, "pages").select("url", F.col("html").alias("text")).write.json(path)
    return I.ingest(jsonl.read_jsonl(spark, path))


def lexicon_table(spark, d):
    # Every token of every document plays a term, in order of document and position.
    tokens = _docs(spark, d).select("doc_id", "n_chars", F.posexplode(T.tox_tokens("text")).alias("pos", "term"))
    place = F.col("doc_id").cast("decimal(38,0)") * 2**32 + F.col("pos")
    entries = tokens.select(place.alias("ord"), "term", ((F.col("n_chars") % 10 + 1) / 10).alias("weight"))
    return lexicon.lexicon_table(entries)


# --- projections -----------------------------------------------------------------------------


def html_strip(spark, d):
    return _pages(spark, d).select("page_id", T.html_strip("html").alias("text_clean"))


def ingest_select(spark, d):
    return I.ingest(_pages(spark, d), "html")


def html_ratio(spark, d):
    return _pages(spark, d).select("page_id", T.html_ratio("html").alias("html_ratio"))


def text_length(spark, d):
    return _docs(spark, d).select("doc_id", F.length("text").cast("bigint").alias("text_length"))


def blank_text(spark, d):
    return _docs(spark, d).select("doc_id", T.is_blank("text").alias("is_blank"))


def shingle_normalize(spark, d):
    return _docs(spark, d).select("doc_id", T.shingle_normalize("text").alias("normalized"))


def shingles(spark, d):
    sets = _docs(spark, d).select("doc_id", F.sort_array(T.shingles("text")).alias("s"))
    return sets.select("doc_id", F.size("s").cast("bigint").alias("n_shingles"), F.md5(F.array_join("s", "|")).alias("shingles_md5"))


def tox_tokens(spark, d):
    found = _docs(spark, d).select("doc_id", T.tox_tokens("text").alias("t"))
    return found.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


def toxicity_score(spark, d):
    return _scored(spark, d).select("doc_id", "tox_millis", "n_tokens", "tox_score")


def toxicity_score_join(spark, d):
    table = lexicon.lexicon_table(lexicon.default_lexicon(spark))
    return X.toxicity_score(_docs(spark, d), table).select("doc_id", "tox_millis", "n_tokens", "tox_score")


def toxicity_long_list(spark, d):
    # A list as long as the vocabulary of the documents.
    return X.toxicity_score(_docs(spark, d), lexicon_table(spark, d)).select("doc_id", "tox_millis", "n_tokens", "tox_score")


def pii_flags(spark, d):
    return P.pii_flags(_docs(spark, d).select("doc_id", "text")).drop("text")


def pii_any(spark, d):
    return _flagged(_docs(spark, d)).select("doc_id", "pii_any")


def text_snippet(spark, d):
    return _docs(spark, d).select("doc_id", T.snippet("text").alias("snippet"))


def report_values(spark, d):
    return S.report_values(S.dataset_stats(_final(spark, d)))


# --- filters ---------------------------------------------------------------------------------


def quality_reject_reason(spark, d):
    return Q.quality_reject_reason(_ingested_pages(spark, d), "text_clean", "text").select("page_id", "reject_reason")


def quality_filter(spark, d):
    return Q.quality_filter(_docs(spark, d)).select("doc_id", "text")


def quality_report(spark, d):
    return Q.quality_report(Q.quality_reject_reason(_ingested_pages(spark, d), "text_clean", "text"))


def quality_report_documents(spark, d):
    return Q.quality_report(Q.quality_reject_reason(_docs(spark, d)))


def toxicity_flagged(spark, d):
    # No document of the tables passes the usual threshold of 0.5.
    return X.toxicity_flagged(_scored(spark, d), threshold=0.05).select("doc_id", "tox_score")


# --- near-duplicates -------------------------------------------------------------------------


def minhash_signature(spark, d):
    signed = N.minhash_signature(_docs(spark, d))
    return signed.select("doc_id", F.concat_ws(",", F.col("signature").cast("array<string>")).alias("signature"))


def lsh_bands(spark, d):
    return N.lsh_bands(N.minhash_signature(_docs(spark, d)))


def near_dup_candidates(spark, d):
    return N.near_dup_candidates(_docs(spark, d))


def near_dup_pairs(spark, d):
    return N.near_dups(_docs(spark, d)).pairs()


def near_dup_pairs_exact(spark, d):
    return N.near_dup_pairs_exact(_docs(spark, d))


def near_dup_groups(spark, d):
    found = N.near_dups(_docs(spark, d))
    return found.signed.select("doc_id", "group_key").join(found.groups.select("group_key", "rep", "copies"), "group_key").drop("group_key")


def near_dup_similar_groups(spark, d):
    similar = N.near_dups(_docs(spark, d)).similar
    return similar.select("rep_a", "rep_b", F.col("matches").cast("bigint").alias("matches"), "copies_a", "copies_b")


def near_dup_summary(spark, d):
    return _big(N.near_dups(_docs(spark, d)).summary(), "total_pairs")


def near_dup_examples(spark, d):
    return N.near_dups(_docs(spark, d)).examples()


# --- aggregates ------------------------------------------------------------------------------


def toxicity_distribution(spark, d):
    row = X.toxicity_distribution(_scored(spark, d))
    return row.withColumns({c: F.round(c, 9) for c in ("median_score", "std_score", "p90_score", "p95_score")})


def toxicity_rate(spark, d):
    return X.toxicity_rate(_scored(spark, d))


def toxicity_top5(spark, d):
    return X.toxicity_top(_scored(spark, d), 5)


def pii_report(spark, d):
    return P.pii_report(_flagged(_docs(spark, d)))


def pii_fp_estimate(spark, d):
    return P.pii_fp_estimate(_flagged(_docs(spark, d)))


def dataset_stats(spark, d):
    return S.dataset_stats(_final(spark, d))


def clean_rate(spark, d):
    docs = _docs(spark, d)
    final = Q.quality_filter(docs).agg(F.count("*").alias("total_docs"))
    return S.clean_rate(final, docs.agg(F.count("*").alias("total_rows")))


def _document_scorecard(spark, d):
    return _big(run_audit(_docs(spark, d), lexicon.default_terms(), text_col="text").scorecard, "n_hits")


def _page_scorecard(spark, d):
    return _big(run_audit(_ingested_pages(spark, d), lexicon.default_terms(), "page_id", raw_col="text").scorecard, "n_hits")


def scorecard_metrics(spark, d):
    return _document_scorecard(spark, d).drop("status", "code", "message")


def recommendations(spark, d):
    return _document_scorecard(spark, d).select("metric", "value", "threshold", "status", "code", "message")


def corpus_audit(spark, d):
    return _page_scorecard(spark, d)


def audit_files(spark, d):
    records, out = scratch_path(spark, "records"), scratch_path(spark, "audit")
    _table(spark, d, "pages").select("url", F.col("html").alias("text")).write.json(records)
    files.audit_files(spark, records, out, datetime(2026, 1, 1), raw_ratio=True)
    newest = scorecards.latest_scorecard(scorecards.read_scorecards(spark, f"{out}/scorecards"))
    return _big(newest, "n_hits").drop("run_id", "generated_at")


def latest_scorecard(spark, d):
    history = scratch_path(spark, "history")
    scorecards.write_scorecard(_document_scorecard(spark, d), history, datetime(2026, 1, 1))
    scorecards.write_scorecard(_page_scorecard(spark, d), history, datetime(2026, 1, 2))
    newest = scorecards.latest_scorecard(scorecards.read_scorecards(spark, history))
    return _big(newest.select("run_id", "metric", "value", "score_mean", "threshold", "n_hits", "n_total", "status"), "n_hits")


# --- streams ---------------------------------------------------------------------------------


def stream_ingest(spark, d):
    table = _table(spark, d, "pages").select("url", F.col("html").alias("text"))
    records, out = scratch_path(spark, "records"), scratch_path(spark, "ingested")
    table.write.json(records)
    stream = jobs.read_record_stream(spark, records, jsonl.record_schema())
    jobs.stream_ingest(stream, out, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(out)


def stream_batches(spark, d):
    # Two runs of the stream, with a compaction between them.
    table = _table(spark, d, "pages").select("url", F.col("html").alias("text"), (F.col("page_id") % 2).alias("wave"))
    records, out, checkpoint = scratch_path(spark, "records"), scratch_path(spark, "batches"), scratch_path(spark, "stream")
    for wave in range(2):
        table.where(F.col("wave") == wave).drop("wave").write.mode("append").json(records)
        jobs.stream_batches(jobs.read_record_stream(spark, records, jsonl.record_schema()), out, checkpoint).awaitTermination()
        if wave == 0:
            jobs.compact(spark, out)
    return jobs.batch_rows(spark, out)


def _flags_folder(spark, d):
    out = scratch_path(spark, "flags")
    schema = _table(spark, d, "documents").schema
    stream = jobs.read_record_stream(spark, f"{d}/documents.parquet*", schema, "parquet")
    jobs.stream_flags(stream, lexicon.default_terms(), out, scratch_path(spark, "stream")).awaitTermination()
    return out


def stream_flags(spark, d):
    return jobs.stream_totals(spark, _flags_folder(spark, d))


def stream_quantiles(spark, d):
    # Each quantile of the sketches with a check of its rank among all scores.
    out = _flags_folder(spark, d)
    found = jobs.stream_quantiles(spark, out).collect()  # one row for each of three quantiles
    rows = spark.read.parquet(f"{out}/rows").where("reject_reason IS NULL")
    score, error = F.col("tox_score"), jobs.RANK_ERROR
    shares = [
        F.struct(
            F.lit(r["p"]).alias("p"), F.lit(r["n"]).cast("bigint").alias("n"),
            ((F.avg((score < r["score"]).cast("int")) - error <= r["p"]) & (F.avg((score <= r["score"]).cast("int")) + error >= r["p"])).alias("in_error"),
        )
        for r in found
    ]
    return rows.agg(F.array(*shares).alias("shares")).select(F.inline("shares"))


_REGISTERED = (
    assign_doc_id, row_position_id, corpus_fingerprint, ingest_manifest, file_hashes, manifest_totals, schema_report, jsonl_ingest, lexicon_table,
    html_strip, ingest_select, html_ratio, text_length, blank_text, shingle_normalize, shingles, tox_tokens,
    toxicity_score, toxicity_score_join, toxicity_long_list, pii_flags, pii_any, text_snippet, report_values,
    quality_reject_reason, quality_filter, quality_report, quality_report_documents, toxicity_flagged,
    minhash_signature, lsh_bands, near_dup_candidates, near_dup_pairs, near_dup_pairs_exact, near_dup_groups, near_dup_similar_groups,
    near_dup_summary, near_dup_examples,
    toxicity_distribution, toxicity_rate, toxicity_top5, pii_report, pii_fp_estimate, dataset_stats, clean_rate,
    scorecard_metrics, recommendations, corpus_audit, audit_files, latest_scorecard, stream_ingest, stream_batches, stream_flags, stream_quantiles,
)


def entry(spark: SparkSession) -> DataFrame:
    """The audit of the smallest pages table: scorecard and recommendations."""
    return corpus_audit(spark, SMOKE_DIR)


try:
    import corpus_pipeline
    from textassay.llm import queries as llm_queries
    from textassay.llm import statements as llm_statements
except ImportError as missing:
    # The training-data operators come as a whole or not at all; any other failure is a fault.
    if not (missing.name or "").startswith(("textassay.llm", "corpus_pipeline")):
        raise
    llm_queries = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in _REGISTERED}
    if llm_queries is not None:
        found |= llm_queries.queries()
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = check_sql.statements()
    if llm_queries is not None:
        found |= llm_statements.statements()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
