"""JSON-lines and JSON document sources."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"


def record_schema(text_col: str = "text", extra: tuple[str, ...] = ("url",)) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*extra, text_col)])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None, keep_corrupt: bool = False) -> DataFrame:
    """One record per line under a declared schema: no inference pass, absent fields are NULL.

    With ``keep_corrupt`` lines that are not JSON are kept in ``_corrupt_record``.
    """
    schema = schema or record_schema()
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole-file JSON documents under a declared schema; absent fields are NULL."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
