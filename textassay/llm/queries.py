"""Registered queries of this package: each applies one operator to its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textassay.llm import (
    ann, bpe_chunks, chat_template, fill_in_middle, fingerprints, html_extraction, language_id, lexical_search, quality_classifier, repeats, secret_scan,
    simhash, source_mixing,
)
from textassay.llm.common import table


def op1_suffix_array_dedup(spark: SparkSession, d: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, d, "documents"))


def op2_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_id.language_report(table(spark, d, "documents"))


def op3_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return source_mixing.taken_report(table(spark, d, "documents"))


def op4_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return html_extraction.main_texts(table(spark, d, "pages"))


def op5_bpe_coding(spark: SparkSession, d: str) -> DataFrame:
    return bpe_chunks.coding_report(table(spark, d, "documents"))


def op6_simhash_near_dup(spark: SparkSession, d: str) -> DataFrame:
    classes = simhash.near_dup_classes(table(spark, d, "documents"))
    return classes.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op7_ann_search(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_document_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, d, "documents"))


def op9_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.scan_report(table(spark, d, "documents"))


def op10_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, d, "documents"))


def op11_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op12_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    return chat_template.formatting_report(table(spark, d, "conversations"))


def op13_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    return fill_in_middle.fill_report(table(spark, d, "documents"))


REGISTERED = (
    op1_suffix_array_dedup, op2_language_id, op3_source_mixing, op4_html_extraction, op5_bpe_coding, op6_simhash_near_dup, op7_ann_search,
    op8_document_fingerprints, op9_secret_scan, op10_quality_classifier, op11_lexical_search, op12_chat_formatting, op13_fill_in_middle,
)


def queries() -> dict:
    return {f.__name__: f for f in REGISTERED}
