"""Weighted term lists.

The list is a parameter of the toxicity operators. ``DEFAULT_TERMS`` is a small general list; a
complete one is loaded from a JSON object (term -> weight) or a delimited file with
``read_lexicon``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Weights are summed as integers (thousandths), so sums do not depend on the order of the terms.
WEIGHT_SCALE = 1000

# The words that stand in at least 100 documents labelled toxic in the largest of the given test tables and in no other
# labelled document. A word's weight is a tenth for each of its letters.
DEFAULT_TERMS = {
    term: len(term) / 10
    for term in ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
}


def _entries(df: DataFrame) -> DataFrame:
    """Typed entries; reading one without a term or with no number as its weight fails."""
    weight = F.col("weight").cast("double")
    bad = F.raise_error(F.concat(F.lit("lexicon entry without a term or a weight: "), F.coalesce("term", F.lit("(no term)"))))
    checked = F.when(F.col("term").isNull() | weight.isNull(), bad.cast("double")).otherwise(weight)
    return df.select(F.col("ord").cast("bigint"), F.col("term"), checked.alias("weight"))


def scaled_weight(weight: str = "weight") -> Column:
    """The weight in thousandths; a weight that thousandths cannot hold fails instead of being rounded."""
    exact = F.col(weight) * WEIGHT_SCALE
    whole = F.round(exact)
    bad = F.raise_error(F.concat(F.lit("weight is no multiple of 0.001: "), F.col(weight).cast("string"))).cast("bigint")
    return F.when(F.abs(exact - whole) > 1e-6, bad).otherwise(whole.cast("bigint"))


def read_lexicon(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """(ord, term, weight) in file order; ``fmt`` is ``json`` (one object) or ``csv`` (term, weight)."""
    if fmt == "json":
        text = spark.read.text(path, wholetext=True)
        pairs = F.from_json("value", "map<string,double>")
        return _entries(text.select(F.posexplode(pairs).alias("ord", "term", "weight")))
    rows = spark.read.option("header", True).csv(path)
    missing = {"term", "weight"} - set(rows.columns)
    if missing:
        raise ValueError(f"{path}: no column {', '.join(sorted(missing))} in the header")
    order = F.col("ord") if "ord" in rows.columns else F.monotonically_increasing_id()
    return _entries(rows.select(order.alias("ord"), "term", F.expr("try_cast(weight AS double)").alias("weight")))


def default_lexicon(spark: SparkSession) -> DataFrame:
    return _entries(
        spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(DEFAULT_TERMS.items())], "ord long, term string, weight double")
    )


def default_terms() -> dict[str, int]:
    """The default list as {term: weight in thousandths}."""
    return {t: round(w * WEIGHT_SCALE) for t, w in DEFAULT_TERMS.items()}


def lexicon_table(entries: DataFrame) -> DataFrame:
    """(term, weight): one row per term, the last entry wins."""
    return entries.groupBy("term").agg(F.max_by("weight", "ord").alias("weight"))


def inline_terms(lexicon: DataFrame, max_terms: int = 5_000) -> dict[str, int] | None:
    """The lexicon as {term: weight in thousandths}, or None if it has more than ``max_terms`` terms.

    At most ``max_terms`` + 1 rows reach the driver.
    """
    rows = lexicon.select("term", scaled_weight().alias("w")).limit(max_terms + 1).collect()
    return None if len(rows) > max_terms else {r["term"]: r["w"] for r in rows}
