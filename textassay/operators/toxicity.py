"""Lexicon toxicity: the mean weight per token of a document.

A list of terms is used in one of three forms, by its checked length (see ``prepared``): literals inside the expression, a
broadcast table of term hashes that is searched in a narrow step, or a join by term.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textassay.functions.text import snippet, tox_tokens
from textassay.runtime import bind, materialize, percent
from textassay.sources.lexicon import WEIGHT_SCALE, inline_terms, scaled_weight

THRESHOLD = 0.5
# Terms up to which a lexicon becomes literals, and up to which it goes to every worker as 16 bytes a term.
INLINE_TERMS = 5_000
BROADCAST_TERMS = 500_000
# Documents of one term that meet in one task of the join by term, and the most tasks a term is dealt to.
BUSY_DOCS = 1_000_000
MAX_PARTS = 10_000


def score_column(millis: str = "tox_millis", tokens: str = "n_tokens") -> Column:
    """Mean weight per token, rounded to six digits; 0 without tokens.

    The rounding (half up) is done on integers, so it is the same on every engine.
    """
    micros = F.expr(f"(2 * {10**6 // WEIGHT_SCALE} * {millis} + {tokens}) div (2 * {tokens})")
    return F.when(F.col(tokens) > 0, micros / F.lit(1e6)).otherwise(F.lit(0.0))


def mean_score(column: str = "tox_score") -> Column:
    """Average of six-digit scores from an exact decimal sum, whatever the order of the rows."""
    total = F.sum(F.col(column).cast("decimal(18,6)")).cast("double")
    return F.coalesce(F.try_divide(total, F.count(column)), F.lit(0.0))


def token_sums(text_col: str, terms: dict[str, int]) -> Column:
    """struct(tox_millis, n_tokens) of a text, from literals only.

    Tokens are tested against a hash set first; only the few hits look up their weight. The step is
    narrow: no explode, no join, no shuffle.
    """
    weights = F.create_map(*[F.lit(v) for pair in terms.items() for v in pair]) if terms else None

    def sums(tokens):
        if weights is None:
            total = F.lit(0).cast("bigint")
        else:
            hits = F.filter(tokens, lambda t: t.isin(list(terms)))
            total = F.aggregate(hits, F.lit(0).cast("bigint"), lambda s, t: s + weights[t].cast("bigint"))
        return F.struct(total.alias("tox_millis"), F.size(tokens).cast("bigint").alias("n_tokens"))

    return bind(tox_tokens(text_col), sums)


@dataclass(frozen=True)
class TermTable:
    """Term hashes in order and their weights in thousandths, known to every worker."""

    table: Broadcast

    def sums(self, hashes: str) -> Column:
        """Sum of the weights of the tokens whose hashes are given; a narrow Arrow step."""
        table = self.table

        @F.pandas_udf("bigint")
        def add(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import numpy
            import pandas

            keys, weights = table.value
            for rows in batches:
                sizes = numpy.array([len(r) for r in rows], numpy.int64)
                flat = numpy.concatenate([numpy.zeros(0, numpy.int64), *rows])
                at = numpy.minimum(numpy.searchsorted(keys, flat), len(keys) - 1)
                hits = numpy.where(keys[at] == flat, weights[at], 0) if len(keys) else flat * 0
                running = numpy.concatenate(([0], numpy.cumsum(hits)))
                ends = numpy.cumsum(sizes)
                yield pandas.Series(running[ends] - running[ends - sizes])

        return add(hashes)


def token_hashes(text_col: str) -> Column:
    """A 64-bit hash of every token, in order."""
    return F.transform(tox_tokens(text_col), lambda t: F.xxhash64(t))


Terms = dict[str, int] | TermTable | DataFrame


def prepared(lexicon: Terms) -> Terms:
    """The form in which a lexicon is used, whatever its length; counts the terms of a table (term, weight).

    Up to INLINE_TERMS become literals and up to BROADCAST_TERMS a table of hashes; a longer list, or one in which two terms
    share a hash, stays a table to be joined. All give the same scores. The table is written once, as lists may be costly to make.
    """
    if not isinstance(lexicon, DataFrame):
        return lexicon
    lexicon = materialize(lexicon.select("term", "weight"), "terms")
    if (few := inline_terms(lexicon, INLINE_TERMS)) is not None:
        return few
    rows = lexicon.select(F.xxhash64("term").alias("h"), scaled_weight().alias("w"))
    if lexicon.count() > BROADCAST_TERMS:
        return lexicon
    found = rows.toPandas().sort_values("h")
    keys, weights = found["h"].to_numpy(np.int64), found["w"].to_numpy(np.int64)
    if (keys[1:] == keys[:-1]).any():
        return lexicon
    return TermTable(lexicon.sparkSession.sparkContext.broadcast((keys, weights)))


def narrow_sums(df: DataFrame, terms: dict[str, int] | TermTable, text_col: str) -> DataFrame:
    """``df`` with tox_millis and n_tokens; no explode, no join, no shuffle."""
    if isinstance(terms, dict):
        # inline() also keeps later filters on the score from evaluating the tokens a second time.
        return df.select("*", F.inline(F.array(token_sums(text_col, terms))))
    hashed = df.withColumn("_hashes", token_hashes(text_col))
    return hashed.withColumns({"tox_millis": terms.sums("_hashes"), "n_tokens": F.size("_hashes").cast("bigint")}).drop("_hashes")


def toxicity_score(df: DataFrame, lexicon: Terms, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Input columns plus ``tox_millis`` (sum of weights, in thousandths), ``n_tokens`` and ``tox_score``.

    ``lexicon`` is {term: thousandths}, a ``TermTable`` or a table (term, weight) of any length. With a table the ids must be
    unique, and the result has the id and the three new columns only: texts stay where they are and are joined by whoever
    wants them.
    """
    if isinstance(lexicon, DataFrame):
        return joined_sums(df, lexicon, id_col, text_col).withColumn("tox_score", score_column())
    return narrow_sums(df, lexicon, text_col).withColumn("tox_score", score_column())


def joined_sums(df: DataFrame, lexicon: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tox_millis, n_tokens); each text is tokenised once, and only ids, terms and sums are shuffled."""
    terms = prepared(lexicon)
    if not isinstance(terms, DataFrame):
        return narrow_sums(df.select(id_col, text_col), terms, text_col).select(id_col, "tox_millis", "n_tokens")
    # Both sides are shuffled by term: the tokens of each document are counted before. A document without tokens keeps one
    # row with a NULL term.
    weights = terms.select("term", scaled_weight().alias("w"))
    tokens = df.select(id_col, F.explode_outer(tox_tokens(text_col)).alias("term"))
    counted = tokens.groupBy(id_col, "term").agg(F.count("term").alias("n"))
    # A term of very many documents would fill one task: rows are dealt on term and part of the id, and the list is repeated
    # for each part of the terms that need it. No term has more documents than there are.
    if df.count() > BUSY_DOCS:
        # Counted within each document, so that only terms are shuffled.
        held = df.select(F.explode(F.array_distinct(tox_tokens(text_col))).alias("term"))
        busy = materialize(held.groupBy("term").agg(F.count("*").alias("docs")).where(F.col("docs") > BUSY_DOCS), "busy-terms")
        parts = F.least(F.ceil(F.col("docs") / F.lit(BUSY_DOCS)), F.lit(MAX_PARTS)).cast("int")
        spread = busy.join(weights, "term").select("term", "w", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), parts.alias("parts"))
        of_busy = F.broadcast(busy.select("term", parts.alias("parts")))  # at most one term for each BUSY_DOCS rows
        dealt = counted.join(of_busy, "term", "left").withColumn("part", F.pmod(F.xxhash64(id_col), F.coalesce("parts", F.lit(1))).cast("int"))
        rest = weights.join(F.broadcast(busy.select("term")), "term", "left_anti").select("term", "w", F.lit(0).alias("part"))
        weighed = dealt.join(rest.unionByName(spread.select("term", "w", "part")), ["term", "part"], "left")
    else:
        weighed = counted.join(weights, "term", "left")
    return weighed.groupBy(id_col).agg(
        F.sum(F.coalesce("w", F.lit(0)) * F.col("n")).cast("bigint").alias("tox_millis"), F.sum("n").cast("bigint").alias("n_tokens")
    )


def toxicity_flagged(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents with a score above the threshold."""
    return scored.where(F.col("tox_score") > threshold)


def toxicity_rate(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    counts = scored.agg(
        F.count("*").alias("total_docs"),
        F.count_if(F.col("tox_score") > threshold).alias("toxic_docs"),
        mean_score().alias("mean_score"),
    )
    return counts.select("*", percent(F.col("toxic_docs"), F.col("total_docs")).alias("pct_toxic"))


def toxicity_top(scored: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``k`` highest scores, ties by id, with the first 100 characters of the text."""
    return (
        scored.orderBy(F.desc("tox_score"), F.asc(id_col))
        .limit(k)
        .select(id_col, "tox_millis", "n_tokens", "tox_score", snippet(text_col).alias("snippet"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(v, n): distinct values and how often each occurs."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))


def exact_percentiles(counts: DataFrame, probabilities: dict[str, float], grain: float = 1e-4) -> DataFrame:
    """One row of exact percentiles with linear interpolation, named by the keys of ``probabilities``.

    The built-in exact ``percentile`` gathers every distinct value in one task. Here the values
    (``value_counts``) are counted per cell of width ``grain`` (clamped to 10,001 cells), and only the
    cells that hold a wanted rank are ordered inside.
    """
    cells = 10_000
    cell = F.greatest(F.least(F.floor(F.col("v") / F.lit(grain)), F.lit(cells)), F.lit(0)).alias("cell")
    values = counts.select("v", "n", cell)
    # At most 10,001 rows from here on, so the unpartitioned window is bounded.
    per_cell = values.groupBy("cell").agg(F.sum("n").alias("cell_n"))
    by_cell = Window.partitionBy(F.lit(0)).orderBy("cell")
    running = by_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = by_cell.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = per_cell.select(
        "cell",
        "cell_n",
        (F.sum("cell_n").over(running) - F.col("cell_n")).alias("before"),
        F.sum("cell_n").over(everything).alias("total"),
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(p).alias("p")) for k, p in probabilities.items()]))
    spots = placed.select("*", wanted.alias("w")).select(
        "cell", "cell_n", "before", "w.name", (F.col("w.p") * (F.col("total") - 1)).alias("spot")
    )
    share = F.col("spot") - F.floor("spot")
    ends = F.explode(F.array(F.struct(F.floor("spot").alias("rank"), F.lit("lo").alias("end")), F.struct(F.ceil("spot").alias("rank"), F.lit("hi").alias("end"))))
    ranks = spots.select("cell", "before", "cell_n", "name", share.alias("share"), ends.alias("r"))
    ranks = ranks.select("cell", "before", "cell_n", "name", "share", "r.rank", "r.end")
    # Two rows per probability.
    hits = ranks.where("rank >= before AND rank < before + cell_n").drop("cell_n")
    in_cell = Window.partitionBy("cell", "name", "end").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = values.join(F.broadcast(hits), "cell").withColumn("upto", F.col("before") + F.sum("n").over(in_cell))
    chosen = inside.where("rank < upto AND rank >= upto - n")


    def at(name: str, end: str):
        return F.max(F.when((F.col("name") == name) & (F.col("end") == end), F.col("v")))

    def fraction(name: str):
        return F.max(F.when(F.col("name") == name, F.col("share")))

    return chosen.agg(*[(at(k, "lo") + (at(k, "hi") - at(k, "lo")) * fraction(k)).alias(k) for k in probabilities])


def toxicity_distribution(scored: DataFrame) -> DataFrame:
    """One row: min, max, mean, median, std (n-1), p90 and p95 of the scores.

    The documents are read once, into counts per distinct score; all figures come from those. Sums
    are exact (scores in millionths), so they do not depend on the order of the rows.
    """
    counts = materialize(value_counts(scored, "tox_score"), "scores")
    micros = F.round(F.col("v") * 1e6).cast("decimal(12,0)")
    n = F.col("n").cast("decimal(14,0)")
    sums = counts.agg(
        F.min("v").alias("min_score"),
        F.max("v").alias("max_score"),
        F.sum("n").cast("double").alias("total"),
        F.sum(n).cast("decimal(14,0)").alias("dn"),
        F.sum(micros * n).cast("decimal(22,0)").alias("d1"),
        F.sum((micros * micros).cast("decimal(20,0)") * n).cast("decimal(24,0)").alias("d2"),
    )
    # n * (sum of squares) - (sum)**2 without loss, then the variance.
    scatter = (F.col("dn") * F.col("d2") - F.col("d1") * F.col("d1")).cast("double")
    moments = sums.select(
        "min_score",
        "max_score",
        F.try_divide(F.col("d1").cast("double") / F.lit(1e6), F.col("total")).alias("mean_score"),
        F.when(F.col("total") > 1, F.sqrt(scatter / (F.col("total") * (F.col("total") - 1))) / 1e6).alias("std_score"),
    )
    ranks = exact_percentiles(counts, {"median_score": 0.5, "p90_score": 0.9, "p95_score": 0.95})
    # Both sides have one row: put them on one row without a join.
    merged = moments.unionByName(ranks, allowMissingColumns=True)
    names = ["min_score", "max_score", "mean_score", "median_score", "std_score", "p90_score", "p95_score"]
    return merged.agg(*[F.max(c).alias(c) for c in names])
