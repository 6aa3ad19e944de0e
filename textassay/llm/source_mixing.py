"""Mixing sources to target weights by weighted fair queueing.

The documents of a source queue up in shuffled order (by a digest of id and seed) and may be served up to
``PASSES`` times, one pass after the other. A copy's virtual finish time is the source's cumulative words at
its end divided by the source's target. All sources share one virtual clock: copies are range-sorted by
finish time, and the service stops at virtual time 1. There every source has been given exactly its target,
and as the targets add up to the total budget, this is where the budget ends. The copy in service at that
moment is cut after the words that are left, so that a source's words are its target, rounded.

Scale: texts are read once, for their sizes; everything else works on narrow rows. The cumulative sums of a
source never need one task: its rows are cut into hash buckets, a window runs over the sums per bucket
and another within each bucket, and the number of buckets follows the number of rows.

Defined cases: a null or blank text has size 0 and takes 0; a null source is a source of its own, ordered
last; rows with equal ids and sizes are interchangeable; an empty table gives an empty table. Columns
other than id, text and source are not read by the plan, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textassay.llm.common import materialize, whole

WEIGHTS = (5, 2, 1)
PASSES = 3
BUCKET_ROWS = 20_000
WORD, BLANKS = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
WIDE = "decimal(38,0)"


def word_count(text: str = "text") -> Column:
    """Number of maximal runs of non-blank characters: blank-to-word steps in a text reduced to blanks and others."""
    parts = F.size(F.split(F.btrim(whole(text), F.lit(" \t\n\x0b\x0c\r")), BLANKS, -1))
    return F.when(F.btrim(whole(text), F.lit(" \t\n\x0b\x0c\r")) == "", 0).otherwise(parts).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(source_key, source_size, target) from (source_key, source_size), one row per source.

    Water filling: in order of cap per weight, a source is capped while its cap is at most its share of what
    the capped ones before it leave. Products are exact decimals, so that the outcome has no rounding in it.
    The windows see one row per source.
    """
    by_name = Window.orderBy("source_key")
    ranked = sizes.withColumn("pick", (F.row_number().over(by_name) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("pick") + 1).cast(WIDE)
    ranked = ranked.select("source_key", "source_size", weight.alias("w"), (F.col("source_size") * passes).cast(WIDE).alias("cap"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), "source_key").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(WIDE)
    left = ranked.select(
        "source_key", "source_size", "w", "cap",
        (F.sum(F.col("source_size").cast(WIDE)).over(everything) - F.coalesce(F.sum("cap").over(before), zero)).cast(WIDE).alias("rest"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), zero)).cast(WIDE).alias("w_rest"),
    )
    capped = (F.col("cap") * F.col("w_rest")).cast(WIDE) <= (F.col("rest") * F.col("w")).cast(WIDE)
    marked = left.withColumn("capped", capped)
    # The first source that is not capped sets the share of all that are not.
    share = marked.select(
        "*",
        F.max(F.when(~F.col("capped"), F.col("rest"))).over(everything).alias("pot"),
        F.max(F.when(~F.col("capped"), F.col("w_rest"))).over(everything).alias("pot_w"),
    )
    fair = F.col("pot").cast("double") * F.col("w").cast("double") / F.col("pot_w").cast("double")
    return share.select("source_key", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(fair).alias("target"))


def source_key(source: str = "source") -> Column:
    """Orders as the code points of the source do, null last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))


def mixing_plan(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(doc_id, source_key, size, source_size, target, copies), one row per row.

    ``copies`` is the array of (pass_no, words, finish) that the mix takes of the document, ``words`` less
    than the size only in the copy at which the source's service ends. Runs jobs when called: sizes are
    written once to the shared folder.
    """
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    sized = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), source_key(source_col).alias("source_key"), word_count(text_col).alias("size"), order.alias("turn")
        ),
        "mix-sizes",
    )
    buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    place = (F.conv(F.substring("turn", 1, 8), 16, 10).cast("bigint") * buckets / F.lit(2**32)).cast("bigint")
    sized = sized.withColumn("bucket", place)
    sums = materialize(sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-sums")
    targets = source_targets(sums.groupBy("source_key").agg(F.sum("bucket_size").alias("source_size")), weights, passes)
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_key", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset"))
    offsets = offsets.join(targets, "source_key")
    within = Window.partitionBy("source_key", "bucket").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    queued = sized.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets, ["source_key", "bucket"])
    budget = F.round("target").cast("bigint")

    def copy(n: int) -> Column:
        start = F.col("offset") + F.col("ahead") + n * F.col("source_size")
        words = F.least(F.col("size"), budget - start)
        finish = (start + F.col("size")).cast("double") / F.col("target")
        row = F.struct(F.lit(n).alias("pass_no"), words.alias("words"), finish.alias("finish"))
        return F.when((F.col("size") > 0) & (words > 0), row)

    copies = F.filter(F.array(*[copy(n) for n in range(passes)]), lambda x: x.isNotNull())
    return queued.select("doc_id", "source_key", "size", "source_size", "target", copies.alias("copies"))


def taken_report(docs: DataFrame, seed: int = 7) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    taken = F.aggregate("copies", F.lit(0).cast("bigint"), lambda total, x: total + x["words"])
    return mixing_plan(docs, seed).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word and the blanks behind it; the whole text if it has no more words."""
    body = F.regexp_replace(text, r"^[\x20\x09-\x0D]+", "")
    parts = F.split(body, BLANKS, (n + 1).cast("int"))
    return F.when(F.size(parts) > n, F.substring(body, F.lit(1), F.length(body) - F.length(F.element_at(parts, -1)))).otherwise(text)


def mix(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, repeated and cut as planned, globally sorted by virtual finish time.

    ``mix_pass`` and ``mix_finish`` follow the columns of ``docs``.
    """
    plan = mixing_plan(docs, seed, id_col, text_col, source_col)
    names = ["mix_id", "mix_source", "mix_size"]
    alike = Window.partitionBy(*names)
    # Rows with one id, source and size are interchangeable: the first takes the first plan row, and so on.
    planned = plan.select(F.col("doc_id").alias("mix_id"), F.col("source_key").alias("mix_source"), F.col("size").alias("mix_size"), "copies")
    planned = planned.where(F.size("copies") > 0).withColumn("mix_nth", F.row_number().over(alike.orderBy(F.col("copies")[0]["finish"])))
    rows = docs.select(*docs.columns, F.col(id_col).alias("mix_id"), source_key(source_col).alias("mix_source"), word_count(text_col).alias("mix_size"))
    rows = rows.withColumn("mix_nth", F.row_number().over(alike.orderBy(F.md5(whole(text_col)))))
    same = F.lit(True)
    for c in (*names, "mix_nth"):
        same = same & rows[c].eqNullSafe(planned[c])
    met = rows.join(planned, same).select(*[rows[c] for c in docs.columns], rows["mix_size"], F.explode("copies").alias("mix_copy"))
    text = F.col(text_col)
    cut = F.when(F.col("mix_copy")["words"] < F.col("mix_size"), first_words(text, F.col("mix_copy")["words"])).otherwise(text)
    met = met.withColumn(text_col, cut).withColumns({"mix_pass": F.col("mix_copy")["pass_no"], "mix_finish": F.col("mix_copy")["finish"]})
    met = met.select(*docs.columns, "mix_pass", "mix_finish")
    return met.repartitionByRange("mix_finish", id_col).sortWithinPartitions("mix_finish", id_col)
