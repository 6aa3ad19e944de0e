"""Ingest: HTML strip, final projection, document ids, fingerprints."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textassay.functions.text import html_strip
from textassay.runtime import materialize

# Rows of a file among which copies of one row are numbered within one work unit.
COPIES_PER_UNIT = 10_000


def ingest(records: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(kept columns, text, text_clean). A missing column reads as NULL, and NULL text as ''."""

    def column(name: str):
        return F.col(name) if name in records.columns else F.lit(None).cast("string")

    return records.select(
        *[column(c).alias(c) for c in keep], column(text_col).alias("text"), html_strip(column(text_col)).alias("text_clean")
    )


def row_digest(columns: list[str]) -> Column:
    """128 bits of a row's content as 32 hexadecimal digits; NULL and the empty string differ."""
    parts = [F.coalesce(F.md5(F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat(*parts))


def assign_doc_id(table: DataFrame, content: tuple[str, ...], carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_key, copy_no, carried columns, file_name, row_index) of a stored table: ids for input without a key.

    ``doc_key`` comes from the ``content`` columns alone; ``copy_no`` numbers identical rows 0, 1, ... in order of file and
    position. As identical rows are interchangeable, the set of ids does not depend on how the table is stored.

    The content is digested where it is scanned: only digests, positions and the carried columns are shuffled. Copies are
    numbered within work units (a run of ``COPIES_PER_UNIT`` rows of a file) and each unit starts after those before it,
    so no task holds all copies of a row. The position leads back to the row without moving it (``with_doc_id``).
    """
    at = [F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index")]
    # One scan of the contents, and a table of some 60 bytes a row for all that follows.
    keyed = materialize(table.select(row_digest(list(content)).alias("doc_key"), *carried, *at), "row-keys")
    unit = F.floor(F.col("row_index") / F.lit(COPIES_PER_UNIT)).alias("unit")
    counts = keyed.groupBy("doc_key", "file_name", unit).agg(F.count("*").alias("n"))
    several = counts.groupBy("doc_key").agg(F.sum("n").alias("copies")).where("copies > 1").select("doc_key")
    units = materialize(counts.join(several, "doc_key", "left_semi"), "copy-units")
    earlier = Window.partitionBy("doc_key").orderBy("file_name", "unit").rowsBetween(Window.unboundedPreceding, -1)
    starts = units.select("doc_key", "file_name", "unit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    # Rows without a start have no copy; every group of the window lies in one run of one file.
    placed = keyed.withColumn("unit", unit).join(starts, ["doc_key", "file_name", "unit"], "left")
    inside = Window.partitionBy("doc_key", "file_name", "unit").orderBy("row_index")
    copy_no = F.coalesce("start", F.lit(0)) + F.row_number().over(inside) - 1
    return placed.withColumn("copy_no", copy_no).select("doc_key", "copy_no", *carried, "file_name", "row_index")


def with_doc_id(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a stored table with ``doc_key`` and ``copy_no``, by position."""
    at = [F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index")]
    return table.select(*table.columns, *at).join(ids.select("doc_key", "copy_no", "file_name", "row_index"), ["file_name", "row_index"]).drop(
        "file_name", "row_index"
    )


def row_position_id(table: DataFrame, column: str = "row_id") -> DataFrame:
    """A Parquet table with each row's position in its file, and the file's name.

    A narrow step: the reader supplies both.
    """
    return table.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias(column), *table.columns)


def written_row_id(table: DataFrame, column: str = "doc_id") -> DataFrame:
    """Adds an id to a table written by Spark: number of the part file, then position in the file.

    Narrow and stable (the files do not change), and it follows the order of the rows. Bits: 20 for the
    writing task, 10 for its file counter, 33 for the position; a number beyond its bits fails.
    """
    name = F.col("_metadata.file_name")
    task = F.regexp_extract(name, r"^part-(\d+)-", 1).cast("bigint")
    counter = F.regexp_extract(name, r"-c(\d+)\.", 1).cast("bigint")
    position = F.col("_metadata.row_index")
    fits = (task < 1 << 20) & (counter < 1 << 10) & (position < 1 << 33)
    bad = F.raise_error(F.concat(F.lit("no row id for this file: "), name)).cast("bigint")
    packed = F.shiftleft(task, 43) + F.shiftleft(counter, 33) + position
    return table.select(F.when(fits, packed).otherwise(bad).alias(column), *table.columns)


def corpus_fingerprint(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(n_rows, fingerprint): sum of 60-bit row hashes; independent of row order and of file layout."""
    parts = [F.coalesce(F.md5(F.col(c).cast("string")), F.lit("-")) for c in columns]
    row_hash = F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("decimal(20,0)")
    total = F.coalesce(F.sum(row_hash), F.lit(0).cast("decimal(30,0)"))
    return df.agg(F.count("*").alias("n_rows"), total.cast("string").alias("fingerprint"))


def schema_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(ordinal, name, type, expected_type, status, n_values): declared against found schema, with non-NULL counts.

    ``status`` is OK, TYPE (another type), EXTRA (not declared) or MISSING. Of a table in files, ``file_schema_report``
    takes the counts from the footers.
    """
    return _schema_rows(df.agg(*[F.count(n).alias(n) for n in df.columns]), dict(df.dtypes), expected)


def file_schema_report(spark: SparkSession, path: str, expected: dict[str, str]) -> DataFrame:
    """``schema_report`` of Parquet files whose counts come from their footers: no value of any column is read.

    Parquet counts are pushed into the scan by the newer reader only, which a session of its own turns on; the one row of
    counts goes through the driver. Runs when called.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(path)
    # The footers count the leaves of a nested column, not its rows: those columns are scanned.
    flat = [n for n, t in table.dtypes if not t.startswith(("array", "map", "struct", "variant"))]
    nested = [n for n in table.columns if n not in flat]
    counted = {}
    for source, names in ((table, flat), (spark.read.parquet(path), nested)):
        if names:
            counted |= source.agg(*[F.count(n).alias(n) for n in names]).first().asDict()
    values = [F.lit(counted[n]).cast("bigint").alias(n) for n in table.columns]
    return _schema_rows(spark.range(1).select(*values), dict(table.dtypes), expected)


def _schema_rows(counts: DataFrame, found: dict[str, str], expected: dict[str, str]) -> DataFrame:
    names = list(found) + [n for n in expected if n not in found]

    def status(name: str) -> str:
        if name not in found:
            return "MISSING"
        if name not in expected:
            return "EXTRA"
        return "OK" if found[name] == expected[name] else "TYPE"

    rows = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(n).alias("name"),
            F.lit(found.get(n)).cast("string").alias("type"),
            F.lit(expected.get(n)).cast("string").alias("expected_type"),
            F.lit(status(n)).alias("status"),
            (F.col(n) if n in found else F.lit(0).cast("bigint")).alias("n_values"),
        )
        for i, n in enumerate(names)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def require_schema(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """``df`` itself, or ValueError naming every column that is missing or has another type."""
    found = dict(df.dtypes)
    wrong = [f"{n}: expected {t}, found {found.get(n, 'nothing')}" for n, t in expected.items() if found.get(n) != t]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df
