"""Document fingerprints by consistent weighted sampling.

The weighted terms of a text are its pairs of neighbouring words, weighted by their counts. A term of weight
w draws r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) from its own hash; with t = floor(ln w / r + b) its rank is
ln a = ln c - r (t - b + 1), and the term with the smallest rank is the sample, together with t. Two texts
draw the same sample with the probability of their generalised Jaccard similarity sum min / sum max. Terms
are dealt into ``BINS`` bins by hash and each bin takes one sample, so a term is ranked once, not once per
sample (bin-wise consistent weighted sampling). The likeness of two fingerprints is the share of equal bins
among those that are filled in either.

The main path is DataFrame functions only. Texts are shuffled once, by document; terms are counted and
sampled inside that partitioning, so no term is ever shuffled. From the neighbour in descending order
of ids only the characters needed travel. Its id comes from narrow rows, range-partitioned.

Defined cases: null text counts as empty; texts without a word have an empty fingerprint, and two empty
fingerprints have likeness 1. Of several rows with one id, the one with the smallest SHA-256 of its text is the
neighbour that others see; each row keeps its own result. A null id counts as the smallest number. In a table
of one id the neighbour is the row itself. Columns other than id and text are not read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textassay.llm.common import materialize, uniform, whole

BINS = 128
NULL_ID = -(2**63)
BLANKS = r"[\x20\x09-\x0D]+"


def neighbours(ids: DataFrame) -> DataFrame:
    """(k, next_k, from_k, give) of unique (k, n_chars): the next id in descending order, the one before, and n_chars of that.

    Ids are range-partitioned and written; the order within a range and the order of ranges give the neighbour,
    so no window sees more than a range. The table of ranges has one row per partition.
    """
    placed = ids.repartitionByRange("k").withColumn("range_no", F.spark_partition_id())
    placed = materialize(placed, "fingerprint-ids")
    ends = placed.groupBy("range_no").agg(F.max("k").alias("top"), F.min(F.struct("k", "n_chars")).alias("low"))
    order = Window.orderBy(F.col("range_no").desc())
    full = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "range_no",
        F.coalesce(F.lead("top").over(order), F.first("top").over(full)).alias("top_below"),
        F.coalesce(F.lag("low").over(order), F.last("low").over(full)).alias("low_above"),
    )
    inside = Window.partitionBy("range_no").orderBy(F.col("k").desc())
    here = placed.select("range_no", "k", F.lead("k").over(inside).alias("next_k"), F.lag(F.struct("k", "n_chars")).over(inside).alias("above"))
    joined = here.join(F.broadcast(ends), "range_no")  # a row per partition
    above = F.coalesce("above", "low_above")
    return joined.select(
        "k", F.coalesce("next_k", "top_below").alias("next_k"), above["k"].alias("from_k"), F.floor(above["n_chars"] / 3).cast("int").alias("give")
    )


def edited_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, nth, next_k, text, edited): the text whose last third is replaced by the start of the next document."""
    k = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID))
    rows = df.select(k.alias("k"), whole(text_col).alias("text"))
    ids = df.select(k.alias("k"), F.length(whole(text_col)).alias("n_chars")).groupBy("k").agg(F.max("n_chars").alias("n_chars"))
    order = materialize(neighbours(ids), "fingerprint-order")
    ranked = rows.join(order, "k").withColumn("nth", F.row_number().over(Window.partitionBy("k").orderBy(F.sha2("text", 256))))
    heads = ranked.where("nth = 1").select(F.col("from_k").alias("k"), F.substring("text", F.lit(1), F.col("give")).alias("head"))
    both = ranked.join(heads, "k")
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - third), F.substring("head", F.lit(1), third))
    return both.select("k", "nth", "next_k", "text", edited.alias("edited"))


def terms(text: Column) -> Column:
    """Hashes of the pairs of neighbouring words, the last word closing with none; empty without a word."""
    words = F.filter(F.split(text, BLANKS, -1), lambda w: w != "")
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))), lambda a, b: F.xxhash64(a, b))


def _sample(term: Column, weight: Column) -> tuple[Column, Column]:
    """ln a and the number of the sampled interval of a term of the given weight."""
    r = -F.log(uniform(term, F.lit(1)) * uniform(term, F.lit(2)))
    c = -F.log(uniform(term, F.lit(3)) * uniform(term, F.lit(4)))
    b = uniform(term, F.lit(5))
    t = F.floor(F.log(weight.cast("double")) / r + b)
    return F.log(c) - r * (t - b + 1), t


def sampled(split: DataFrame, keys: list[str], sides: list[str], bins: int = BINS) -> DataFrame:
    """``keys`` and, for each side, the sorted array of bin * 65536 + sample code, from (keys, mask, term).

    Bit i of ``mask`` says that this occurrence of the term is in side i, so a term that sides share is counted and
    hashed once. ``split`` must be partitioned by a subset of ``keys`` for the counts to need no shuffle.
    """
    has = [F.sum(F.shiftright("mask", i).bitwiseAND(1)).alias(f"w{i}") for i in range(len(sides))]
    weighted = split.groupBy(*keys, "term").agg(*has)
    drawn = [F.pmod(F.xxhash64("term", F.lit(6)), F.lit(bins)).cast("int").alias("bin")]
    for i in range(len(sides)):
        # Without a weight the rank is null, and such a term is never the smallest.
        rank, t = _sample(F.col("term"), F.nullif(F.col(f"w{i}"), F.lit(0)))
        drawn += [rank.alias(f"rank{i}"), F.xxhash64("term", t).bitwiseAND(F.lit(0xFFFF)).cast("int").alias(f"code{i}")]
    least = [F.min_by(f"code{i}", f"rank{i}").alias(f"code{i}") for i in range(len(sides))]
    best = weighted.select(*keys, *drawn).groupBy(*keys, "bin").agg(*least)
    cells = [F.sort_array(F.collect_list(F.col("bin") * 65536 + F.col(f"code{i}"))).alias(f"{c}_cells") for i, c in enumerate(sides)]
    return best.groupBy(*keys).agg(*cells)


def _split(parts: DataFrame, keys: list[str], masked: dict[int, Column]) -> DataFrame:
    """(keys, mask, term), one row per term of the arrays in ``masked``."""
    both = F.explode(F.array(*[F.struct(F.lit(mask).alias("mask"), found.alias("terms")) for mask, found in masked.items()]))
    return parts.select(*keys, both.alias("x")).select(*keys, "x.mask", F.explode("x.terms").alias("term"))


def signatures(texts: DataFrame, keys: list[str], sides: list[str], bins: int = BINS) -> DataFrame:
    """``sampled`` of the text columns in ``sides``."""
    return sampled(_split(texts, keys, {1 << i: terms(F.col(c)) for i, c in enumerate(sides)}), keys, sides, bins)


def edited_signatures(texts: DataFrame) -> DataFrame:
    """``signatures`` of text and edited, whose common start is split and counted once.

    A word that the cut falls into belongs to both ends: the start's last part, which may be empty, opens either of them,
    behind the last whole word, with which the first of an end makes a pair.
    """
    kept = F.length("text") - F.floor(F.length("text") / 3).cast("int")
    parts = texts.select(
        "k", "nth", F.split(F.substring("text", F.lit(1), kept), BLANKS, -1).alias("parts"),
        F.substring("text", kept + 1, F.length("text")).alias("own_end"), F.substring("edited", kept + 1, F.length("text")).alias("new_end"),
    )
    closed = F.filter(F.slice("parts", F.lit(1), F.size("parts") - 1), lambda w: w != "")
    parts = parts.select("k", "nth", F.element_at("parts", -1).alias("open"), closed.alias("closed"), "own_end", "new_end")
    last = F.array_join(F.slice("closed", F.greatest(F.size("closed"), F.lit(1)), F.lit(1)), "")
    common = F.zip_with(
        F.slice("closed", F.lit(1), F.greatest(F.size("closed") - 1, F.lit(0))),
        F.slice("closed", F.lit(2), F.greatest(F.size("closed") - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b),
    )
    end = lambda c: terms(F.concat(last, F.lit(" "), "open", c))
    return sampled(_split(parts, ["k", "nth"], {3: common, 1: end("own_end"), 2: end("new_end")}), ["k", "nth"], ["text", "edited"])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins among the bins filled in either fingerprint; 1 if both are empty."""
    bins_of = lambda x: F.transform(x, lambda v: F.shiftright(v, 16))
    filled = F.size(a) + F.size(b) - F.size(F.array_intersect(bins_of(a), bins_of(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / filled)


def packed(cells: Column) -> Column:
    """A fingerprint of up to 128 bins in three bytes a bin: the bins, whose order compresses well, and their codes."""
    bins = F.transform(cells, lambda v: F.shiftright(v, 16).cast("tinyint"))
    codes = F.transform(cells, lambda v: (v.bitwiseAND(0xFFFF) - 0x8000).cast("smallint"))
    return F.struct(bins.alias("filled"), codes.alias("codes"))


def unpacked(packing: Column) -> Column:
    return F.zip_with(packing["filled"], packing["codes"], lambda b, code: b.cast("int") * 65536 + code.cast("int") + 0x8000)


def cells_text(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda v: F.lpad(F.lower(F.hex(v)), 6, "0")), "")


def fingerprint_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per row."""
    texts = edited_texts(df, id_col, text_col)
    cells = edited_signatures(texts)
    # Both sides of the joins below are shuffled: fingerprints travel packed, digests as bytes.
    found = cells.select("k", "nth", packed(F.col("text_cells")).alias("packed_own"), packed(F.col("edited_cells")).alias("packed_edit"))
    digest = F.unhex(F.sha2("edited", 256))
    facts = texts.select("k", "nth", "next_k", F.length("text").cast("bigint").alias("n_chars"), digest.alias("digest"))
    none = packed(F.array().cast("array<int>"))
    signed = facts.join(found, ["k", "nth"], "left").withColumns({c: F.coalesce(c, none) for c in ("packed_own", "packed_edit")})
    signed = materialize(signed, "fingerprints")
    following = signed.where("nth = 1").select(F.col("k").alias("next_k"), F.col("packed_own").alias("packed_next"))
    both = signed.join(following, "next_k")
    opened = both.withColumns({name: unpacked(F.col(f"packed_{part}")) for name, part in (("own", "own"), ("edit", "edit"), ("next_own", "next"))})
    return opened.select(
        F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), "n_chars", F.lower(F.hex("digest")).alias("edited_sha256"),
        cells_text(F.col("own")).alias("fingerprint"), cells_text(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
