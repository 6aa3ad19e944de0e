"""Incremental ingest and incremental flags as Structured Streaming jobs over arriving files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from textassay.functions.patterns import PII_PATTERNS
from textassay.operators.ingest import ingest, written_row_id
from textassay.operators.pii import pii_any, pii_flags
from textassay.operators.quality import RULES, quality_reject_reason
from textassay.operators.toxicity import THRESHOLD, Terms, prepared, toxicity_score
from textassay.runtime import materialize, spread

TOTALS = ("n_rows", *[f"drop_{r}" for r in RULES], "kept", *[p.column for p in PII_PATTERNS], "pii_any", "toxic")
PACKED = "upto int"
# Size of a quantile sketch (some 25 kB a batch), and the rank error that one quantile keeps with 99 % probability.
SKETCH_K, RANK_ERROR = 1024, 0.0028


def read_record_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_ingest(records: DataFrame, out: str, checkpoint: str, text_col: str = "text", keep: tuple[str, ...] = ("url",)) -> StreamingQuery:
    """Strip HTML from arriving records and append them to a Parquet table; stops when all input is read."""
    return (
        ingest(records, text_col, keep)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_batches(records: DataFrame, out: str, checkpoint: str, text_col: str = "text", keep: tuple[str, ...] = ("url",)) -> StreamingQuery:
    """Like ``stream_ingest`` for arrivals of many small files: each micro-batch is a folder of few files, which ``compact``
    merges later. Read it by ``batch_rows``.

    Rows are dealt to files of Spark's advisory partition size. A replayed batch overwrites itself; a new checkpoint, whose
    batches are numbered anew, needs a new ``out``.
    """
    records.sparkSession.createDataFrame([], PACKED).write.mode("ignore").parquet(f"{out}/packed_log")

    def write(batch: DataFrame, batch_id: int) -> None:
        # A stream's own session has this off; a batch without state is free to choose its partitions.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        ingest(batch, text_col, keep).hint("rebalance").write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _packed_to(spark: SparkSession, out: str) -> int:
    """The last batch that a compaction holds, -1 before the first."""
    return spark.read.schema(PACKED).parquet(f"{out}/packed_log").agg(F.coalesce(F.max("upto"), F.lit(-1))).first()[0]


def compact(spark: SparkSession, out: str) -> int | None:
    """Merges the batches that arrived since the last compaction into few files; the number of the last one, None if there
    are none. To be called between runs of ``stream_batches``.

    One row in the log makes a compaction count: before it readers see the batches, after it the merged files, so a
    compaction that was broken off is simply repeated. Batches that were merged are left in place, unread.
    """
    done = _packed_to(spark, out)
    fresh = spark.read.parquet(f"{out}/rows").where(F.col("batch_id") > done)
    newest = fresh.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return None
    merged = fresh.where(F.col("batch_id") <= newest).drop("batch_id").hint("rebalance")
    merged.write.mode("overwrite").parquet(f"{out}/packed/upto={newest}")
    spark.createDataFrame([(newest,)], PACKED).coalesce(1).write.mode("append").parquet(f"{out}/packed_log")
    return newest


def batch_rows(spark: SparkSession, out: str) -> DataFrame:
    """All rows of ``stream_batches``: merged files, and the batches that came after them."""
    done = _packed_to(spark, out)
    fresh = spark.read.parquet(f"{out}/rows").where(F.col("batch_id") > done).drop("batch_id")
    if done < 0:
        return fresh
    counted = F.broadcast(spark.read.schema(PACKED).parquet(f"{out}/packed_log"))  # a row for each compaction
    return spark.read.parquet(f"{out}/packed").join(counted, "upto", "left_semi").drop("upto").unionByName(fresh)


def flag_rows(records: DataFrame, lexicon: Terms, text_col: str = "text") -> DataFrame:
    """All row-local results of the batch operators: reject reason, toxicity and personal data.

    A lexicon too long for a broadcast is joined; the rows are then written once, so their positions can serve as ids.
    """
    terms = prepared(lexicon)
    if isinstance(terms, DataFrame):
        stored = written_row_id(materialize(records, "batch"), "_row")
        scored = stored.join(toxicity_score(stored, terms, "_row", text_col), "_row").drop("_row")
        return pii_any(pii_flags(quality_reject_reason(scored, text_col), text_col))
    judged = quality_reject_reason(records, text_col)
    return pii_any(pii_flags(toxicity_score(judged, terms, text_col=text_col), text_col))


def _totals(flagged: DataFrame, *more: Column) -> DataFrame:
    kept = F.col("reject_reason").isNull()
    return flagged.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col("reject_reason") == r).alias(f"drop_{r}") for r in RULES],
        F.count_if(kept).alias("kept"),
        *[F.count_if(kept & F.col(p.column)).alias(p.column) for p in PII_PATTERNS],
        F.count_if(kept & F.col("pii_any")).alias("pii_any"),
        F.count_if(kept & (F.col("tox_score") > THRESHOLD)).alias("toxic"),
        *more,
    )


def score_sketch() -> Column:
    """A mergeable quantile sketch of the scores of the documents that pass all rules."""
    return F.kll_sketch_agg_double(F.when(F.col("reject_reason").isNull(), F.col("tox_score")), SKETCH_K).alias("score_sketch")


def stream_flags(records: DataFrame, lexicon: Terms, out: str, checkpoint: str, text_col: str = "text") -> StreamingQuery:
    """Flag arriving records and keep one row of totals per micro-batch.

    Rows and totals of a batch go to a folder named by its id, so a replayed batch overwrites itself. ``lexicon`` is
    {term: thousandths} or a table (term, weight) of any length, which is prepared once.
    """
    terms = prepared(lexicon)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = f"{out}/rows/batch_id={batch_id}"
        flag_rows(spread(batch), terms, text_col).drop(text_col).write.mode("overwrite").parquet(rows)
        flagged = batch.sparkSession.read.parquet(rows)
        _totals(flagged, score_sketch()).write.mode("overwrite").parquet(f"{out}/totals/batch_id={batch_id}")

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_totals(spark: SparkSession, out: str) -> DataFrame:
    """Totals over all batches so far."""
    totals = spark.read.parquet(f"{out}/totals")
    return totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS])


def stream_quantiles(spark: SparkSession, out: str, probabilities: tuple[float, ...] = (0.5, 0.9, 0.95)) -> DataFrame:
    """(p, score, n): quantiles of the scores of all kept documents so far, from the merged sketches of the batches.

    The rank of ``score`` is within ``RANK_ERROR`` of p; ``n`` is exact. NULL while no document was kept. The exact figures
    of a finished table are ``toxicity_distribution``.
    """
    merged = spark.read.parquet(f"{out}/totals").agg(F.kll_merge_agg_double("score_sketch", SKETCH_K).alias("s"))
    n = F.coalesce(F.kll_sketch_get_n_double("s"), F.lit(0).cast("bigint"))
    wanted = F.explode(F.array(*[F.lit(p) for p in probabilities])).alias("p")
    some = merged.select("s", n.alias("n"), wanted)
    # One literal rank for each branch: the sketch takes no column for it.
    score = F.coalesce(*[F.when((F.col("p") == p) & (F.col("n") > 0), F.kll_sketch_get_quantile_double("s", F.lit(p))) for p in probabilities])
    return some.select("p", score.alias("score"), "n")
