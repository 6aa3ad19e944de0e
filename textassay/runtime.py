"""Session helpers: a tuned builder, the shared scratch folder and small plan utilities."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

# What a Python worker gets at once, whatever the size of its partition: documents are long.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 * 2**20}

_local_scratch: dict[str, str] = {}


def build_session(master: str | None = None, cores: int | None = None) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Only settings that hold at any scale are fixed here. Shuffle parallelism is left to the cluster
    unless ``cores`` is given (local runs).
    """
    builder = (
        SparkSession.builder.appName("textassay")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Documents are long: small Arrow batches keep the Python workers' memory flat.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    )
    if master:
        builder = builder.master(master)
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's shared checkpoint folder.

    A machine-local folder is used only where the setting is absent and the session is local.
    """
    shared = spark.conf.get(CHECKPOINT_KEY, None)
    context = spark.sparkContext
    if shared:
        return f"{shared.rstrip('/')}/textassay/{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="textassay-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Used where a costly result (signatures above all) feeds several joins: the table survives the
    loss of any executor, is column-pruned by its readers and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a frame over all cores when its scan has fewer splits than there are cores.

    A no-op on large inputs, whose scans have far more splits than the cluster has cores. For frames
    that come straight from a source: asking a frame with shuffles for its partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * 2)


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limits of an Arrow batch where they are above BATCH_LIMITS (or absent); they stay so."""
    for key, most in BATCH_LIMITS.items():
        now = spark.conf.get(key, None) or "0"
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def bind(value, body):
    """Evaluate the array, string or struct expression ``value`` once and use it many times in ``body``."""
    return F.transform(F.array(value), body)[0]


def percent(part, whole):
    """100 * part / whole, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(F.lit(100.0) * part, whole), F.lit(0.0))
