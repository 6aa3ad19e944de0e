"""A corpus pipeline of five stages: language, near-duplicates, secrets, mix, tokens.

Each stage takes all rows its predecessor kept and returns the columns of documents (the last: the encoded
documents). Stages are written as Parquet between one another, so a lost executor costs one stage at most. Stages
that run Python lower the session's Arrow batch size, which keeps the workers' memory flat.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textassay.llm import bpe_chunks, language_id, secret_scan, simhash, source_mixing
from textassay.llm.common import materialize, whole
from textassay.runtime import small_batches

ORACLE_SQL = None  # fingerprints, profiles and token ids cannot be written in SQL; tests compare with brute force


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, in which no language can be told; fills in missing languages (``und`` where no
    row has one to learn from)."""
    small_batches(spark)
    said = language_id.identify(docs, docs, names=("_lang", "_lang_score", "_lettered"))
    kept = said.where("_lettered")
    return kept.withColumn("lang", F.coalesce("lang", "_lang")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: the smallest id, rows without an id last, ties by text. Ids decide nothing
    else: different texts under one id, or without an id, all stay."""
    small_batches(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    keys = {
        "_no_id": F.col("doc_id").isNull(),
        "_id": F.coalesce("doc_id", F.lit(0)),
        "_text": F.md5(whole("text")),
        "_rest": F.xxhash64(F.col("text").isNull(), *others),
    }
    signed = docs.select(*[key.alias(name) for name, key in keys.items()], simhash.fingerprint_udf()(whole("text")).alias("f"))
    prints = materialize(signed.groupBy("f").agg(F.min(F.struct(*keys)).alias("first")), "simhash-prints")
    first = simhash.component_of(prints).groupBy("component").agg(F.min("first").alias("first")).select("first.*")
    # Rows that are equal in all columns have one key: one of them stays.
    return docs.withColumns(keys).join(first, [*keys], "left_semi").dropDuplicates([*keys]).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mask; no document is dropped."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and orders documents so that every source reaches its target; the last copy of a source may be cut."""
    mixed = source_mixing.mix(docs)
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document of the mix."""
    small_batches(spark)
    return bpe_chunks.coding_report(docs)


STAGES = [
    ("language id", keep_known_languages),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("source mixing", mix_sources),
    ("bpe encoding", encode_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
