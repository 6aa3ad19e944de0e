"""Provenance of input files: path, time, size, SHA-256, totals."""

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Files up to this size are hashed from the ``content`` column; larger ones are streamed in blocks by the workers.
INLINE_BYTES = 64 * 1024 * 1024
OPENED_BY_WORKERS = ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")
BLOCK_BYTES = 8 * 1024 * 1024
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"

HASHED = "path string, modified_at timestamp, bytes bigint, sha256 string"


def _file_hasher(given: str, real: str):
    """Adds ``sha256`` to rows of file paths, reading each file in blocks; paths below ``given`` are opened below ``real``."""
    block_bytes = BLOCK_BYTES

    def add_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import urllib.parse

        from pyarrow import fs

        for files in batches:
            digests = []
            for path, size in zip(files["path"], files["bytes"], strict=True):
                # Paths come as they are: a blank or a percent sign in them is not encoded.
                scheme, _, rest = (real + path[len(given) :] if path.startswith(given) else path).partition(":")
                if scheme == "file":
                    filesystem, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    filesystem, name = fs.FileSystem.from_uri(f"{scheme}:{urllib.parse.quote(rest, safe='/:@')}")
                digest, done = hashlib.sha256(), 0
                with filesystem.open_input_stream(name) as stream:
                    while block := stream.read(block_bytes):
                        digest.update(block)
                        done += len(block)
                if done != size:
                    raise OSError(f"{path}: {done} bytes read, {size} listed")
                digests.append(digest.hexdigest())
            yield files.assign(sha256=digests)

    return add_hashes


def stored_at(spark: SparkSession, path: str) -> tuple[str, str]:
    """The fixed part of a path as Spark names it, and the place behind it where that is a link (a view file system's mount).

    The fixed part ends before the first component with a pattern in it.
    """
    fixed = re.match(r"^[^*?\[{]*$|^[^*?\[{]*/", path)
    if not fixed:
        return "", ""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(fixed[0])
    store = at.getFileSystem(context._jsc.hadoopConfiguration())
    given = store.makeQualified(at)
    return given.toString(), store.resolvePath(given).toString() if store.exists(given) else given.toString()


def ingest_manifest(spark: SparkSession, path: str, inline_bytes: int = INLINE_BYTES) -> DataFrame:
    """(path, processed_at, modified_at, bytes, mb, sha256), one row per file, hashed in parallel.

    Files above ``inline_bytes`` are read once, in blocks, so their size does not matter; the size filter is pushed into
    the reader, so their content is not loaded. Mounted paths are opened at the place behind the mount. Only where that
    lies in a store which the workers cannot open, a file's content comes from Spark's reader, which ends at 2 GB and
    fails beyond; each file is decided by itself.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    given, real = stored_at(spark, path)
    found = F.when(F.col("path").startswith(given), F.lit(real)).otherwise(F.col("path"))
    opened = (F.col("length") > inline_bytes) & F.regexp_extract(found, SCHEME, 1).isin(*OPENED_BY_WORKERS)
    named = [F.col("path"), F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes")]
    # A filter on the length alone is pushed into the reader; the other one decides between the columns that are read.
    large = files.where(F.col("length") > inline_bytes)
    streamed = large.where(opened).select(*named).repartition("path").mapInPandas(_file_hasher(given, real), HASHED)
    parts = [files.where(F.col("length") <= inline_bytes).select(*named, F.sha2("content", 256).alias("sha256")), streamed]
    if re.match(SCHEME, real) is None or re.match(SCHEME, real)[1] not in OPENED_BY_WORKERS:
        parts.append(large.where(~opened).select(*named, F.sha2("content", 256).alias("sha256")))
    return reduce(DataFrame.unionByName, parts).select(
        "path",
        F.current_timestamp().alias("processed_at"),
        "modified_at",
        "bytes",
        F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 2).alias("mb"),
        "sha256",
    )


class IngestCounts:
    """Counts taken while a table is being written, so nothing is read again for the manifest.

    ``observe`` marks the rows; after the write ``missing`` names the declared columns in which no good row has a value.
    """

    def __init__(self, columns: tuple[str, ...], corrupt: str | None = None):
        self._watch, self._columns, self._corrupt = Observation(), columns, corrupt

    def observe(self, rows: DataFrame) -> DataFrame:
        bad = F.col(self._corrupt).isNotNull() if self._corrupt else F.lit(False)
        values = [F.count(F.when(~bad, F.col(c))).alias(f"values_{i}") for i, c in enumerate(self._columns)]
        return rows.observe(self._watch, F.count("*").alias("rows"), F.count_if(bad).alias("corrupt"), *values)

    @property
    def total_rows(self) -> int:
        return self._watch.get["rows"] - self.corrupt_rows

    @property
    def corrupt_rows(self) -> int:
        return self._watch.get["corrupt"]

    @property
    def missing(self) -> list[str]:
        return [c for i, c in enumerate(self._columns) if not self._watch.get[f"values_{i}"]]


def manifest_totals(df: DataFrame) -> DataFrame:
    """(total_rows, columns) of an ingested table."""
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count("*").alias("total_rows")).select("total_rows", names.alias("columns"))


def write_manifest(manifest: DataFrame, columns: list[str], counts: IngestCounts, path: str) -> None:
    """The manifest rows with the ingested table's columns and what was counted while it was written, as JSON."""
    manifest.select(
        "*",
        F.lit(counts.total_rows).cast("bigint").alias("total_rows"),
        F.array(*[F.lit(c) for c in columns]).alias("columns"),
        F.lit(counts.corrupt_rows).cast("bigint").alias("corrupt_rows"),
        F.array(*[F.lit(c) for c in counts.missing]).cast("array<string>").alias("missing_columns"),
    ).write.mode("overwrite").json(path)
