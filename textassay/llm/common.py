"""Small helpers of the operators of this package."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textassay.runtime import materialize

__all__ = ["materialize", "row_count", "table", "uniform", "whole"]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The whole text, null as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def row_count(df: DataFrame) -> int:
    return df.count()


def uniform(*of: Column) -> Column:
    """A uniform number strictly between 0 and 1 that depends only on the values."""
    return (F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
