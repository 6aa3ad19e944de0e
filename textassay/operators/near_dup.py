"""Near-duplicate detection: MinHash signatures, banded buckets, verified pairs.

Rows that must share every partner (equal signatures, or equal normalised texts in exact mode) are
first collapsed into one group with a copy count. Buckets and comparisons see one representative per
group; counts of pairs follow from the copy counts, and the full list of document pairs is only
spelled out when asked for.

Buckets come in three sizes. In sparse ones every pair of groups is a candidate. In dense ones the words of the
bands and a sketch of the signature travel along: a pair leaves the join once only, from the first bucket it shares,
and only if the sketches do not rule it out. In crowded ones groups meet by block: signatures that may differ in
d positions agree on one of d + 1 disjoint blocks, so a bucket falls apart into the values of the blocks. What is still
crowded then, and groups of any size, is cut into work units of bounded size, so none ever lands in a single task.
"""

from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textassay.functions.minhash import (
    HALF_MASK, band_keys, band_words, bucket_keys, common_shingles, match_count, shingle_count_udf, signature_udf, similar_pairs,
)
from textassay.functions.text import shingle_normalize
from textassay.runtime import materialize, percent, small_batches

# Keys (16 bytes each) up to which a table of hot keys may be broadcast; beyond it the join is salted.
BROADCAST_KEYS = 500_000
SALTS = 64
# Bytes of text that the exact check may always move to work units in one round.
ROUND_BYTES = 2**28
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A slice compared by numpy has several times ``unit_rows`` signatures; buckets of more slices than these fall apart into blocks.
SLICE_UNITS = 4
CROWDED_SLICES = 8


@dataclass(frozen=True)
class NearDupParams:
    n_gram: int = 5
    num_perm: int = 128
    threshold: float = 0.8
    bands: int = 16
    unit_rows: int = 2_000  # rows of one bucket or group compared within one work unit; larger buckets are crowded
    unit_texts: int = 512  # texts of one neighbourhood that one work unit of the exact check holds at once, on either side
    dense_rows: int = 128  # groups of a bucket above which pairs are tested inside the join

    @property
    def rows_per_band(self) -> int:
        return self.num_perm // self.bands

    @property
    def min_matches(self) -> int:
        """Least number of agreeing positions whose share reaches the threshold."""
        return next(m for m in range(self.num_perm + 1) if m / self.num_perm >= self.threshold)


DEFAULTS = NearDupParams()


def minhash_signature(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: NearDupParams = DEFAULTS) -> DataFrame:
    """(doc_id, signature): a narrow step, one Arrow UDF over the natively normalised text."""
    small_batches(df.sparkSession)
    udf = signature_udf(params.n_gram, params.num_perm)
    return df.select(F.col(id_col).alias("doc_id"), udf(shingle_normalize(text_col)).alias("signature"))


def lsh_bands(signatures: DataFrame, params: NearDupParams = DEFAULTS) -> DataFrame:
    """(doc_id, band, band_key): the bucket of each document in each band."""
    keys = band_keys("signature", params.bands, params.rows_per_band)
    return signatures.select("doc_id", F.posexplode(keys).alias("band", "band_key"))


def signature_key(signature: str = "signature") -> Column:
    return F.md5(F.concat_ws(",", F.col(signature).cast("array<string>")))


def sign(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: NearDupParams = DEFAULTS, exact: bool = False) -> DataFrame:
    """(doc_id, group_key, signature), written once: every later step reads this small table, not the texts.

    Documents of one group have the same partners: equal signatures for the estimate, equal
    normalised texts (hence equal shingle sets) for exact Jaccard.
    """
    small_batches(df.sparkSession)
    udf = signature_udf(params.n_gram, params.num_perm)
    normalized = df.select(F.col(id_col).alias("doc_id"), shingle_normalize(text_col).alias("norm"))
    if exact:
        key = F.coalesce(F.md5("norm"), F.lit("null"))
        signed = normalized.select("doc_id", key.alias("group_key"), udf("norm").alias("signature"))
    else:
        signed = normalized.select("doc_id", udf("norm").alias("signature")).select(
            "doc_id", signature_key().alias("group_key"), "signature"
        )
    return materialize(signed, "signed")


def signature_groups(signed: DataFrame) -> DataFrame:
    """(rep, group_key, copies, signature): one row per group, led by its smallest document id."""
    groups = signed.groupBy("group_key").agg(
        F.min("doc_id").alias("rep"),
        F.count("*").alias("copies"),
        F.first("signature").alias("signature"),
    )
    return materialize(groups, "groups")


def _split_lookup(
    rows: DataFrame, table: DataFrame, key: str, size_col: str, params: NearDupParams
) -> tuple[DataFrame, DataFrame | None]:
    """Inner join of ``rows`` to ``table`` (unique on ``key``; ``size_col`` counts its rows in ``rows``).

    Returns the rows of ordinary keys and, where there are any, those of crowded keys. A key with
    more than ``unit_rows`` rows would fill one reducer, so crowded keys never take part in a plain
    shuffle join: they are broadcast while provably few, else both sides are salted.
    """
    hot = table.where(F.col(size_col) > params.unit_rows)
    n_hot = hot.select(key).limit(BROADCAST_KEYS + 1).count()
    if n_hot == 0:
        return rows.join(table, key), None
    cold = table.where(F.col(size_col) <= params.unit_rows)
    if n_hot <= BROADCAST_KEYS:
        rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
        return rest.join(cold, key), rows.join(F.broadcast(hot), key)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt")
    hot_salted = hot.select("*", salts)
    rest = salted.join(hot_salted.select(key, "salt"), [key, "salt"], "left_anti").drop("salt")
    return rest.join(cold, key), salted.join(hot_salted, [key, "salt"]).drop("salt")


def _lookup(rows: DataFrame, table: DataFrame, key: str, size_col: str, params: NearDupParams) -> DataFrame:
    cold, hot = _split_lookup(rows, table, key, size_col, params)
    return cold if hot is None else cold.unionByName(hot)


def _unit(size_col: str, row_id: str, params: NearDupParams, units: int = 1) -> tuple[Column, Column]:
    """Number of slices (of ``units * unit_rows`` rows) of a group and the slice of one of its rows."""
    slices = F.ceil(F.col(size_col) / F.lit(params.unit_rows * units)).cast("bigint")
    return slices, F.pmod(F.xxhash64(F.col(row_id)), slices)


def _many_parts(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)


def _pairs_within(
    rows: DataFrame, key: str, row_id: str, size_col: str, params: NearDupParams, carried: list[str] = (), condition: Column | None = None
) -> DataFrame:
    """Unordered pairs of rows with equal ``key`` as ``row_id``_a < ``row_id``_b.

    A group of k rows is cut into s = ceil(k / unit_rows) slices; slices (i, j) with i <= j meet in
    their own work unit, so a unit holds about unit_rows rows per side however large the group.
    ``condition`` may compare the ``carried`` columns as l_<name> and r_<name> within the join.
    """
    slices, mine = _unit(size_col, row_id, params)
    sliced = rows.select(key, row_id, *carried, slices.alias("slices"), mine.alias("mine"))
    later = F.explode(F.sequence("mine", F.col("slices") - 1)).alias("hi")
    earlier = F.explode(F.sequence(F.lit(0).cast("bigint"), "mine")).alias("lo")
    left = sliced.select(key, F.col("mine").alias("lo"), later, F.col(row_id).alias("l"), *[F.col(c).alias(f"l_{c}") for c in carried])
    right = sliced.select(key, earlier, F.col("mine").alias("hi"), F.col(row_id).alias("r"), *[F.col(c).alias(f"r_{c}") for c in carried])
    if condition is not None and carried:
        # Little data, but work that grows with the square of a unit: left to itself, Spark merges such partitions into few tasks.
        parts = _many_parts(rows.sparkSession)
        left, right = left.repartition(parts, key, "lo", "hi"), right.repartition(parts, key, "lo", "hi")
    met = left.join(right, [key, "lo", "hi"]).where((F.col("lo") < F.col("hi")) | (F.col("l") < F.col("r")))
    if condition is not None:
        met = met.where(condition)
    return met.select(F.least("l", "r").alias(f"{row_id}_a"), F.greatest("l", "r").alias(f"{row_id}_b"))


def _bucket_rows(groups: DataFrame, params: NearDupParams, row_id: str = "rep") -> DataFrame:
    return groups.select(row_id, F.posexplode(bucket_keys(band_words("signature", params.bands, params.rows_per_band))).alias("band", "bucket"))


def _bucket_sizes(groups: DataFrame, params: NearDupParams) -> DataFrame:
    """(bucket, bucket_size) of the buckets that hold at least two groups."""
    sizes = _bucket_rows(groups, params).groupBy("bucket").agg(F.count("*").alias("bucket_size"))
    return materialize(sizes.where("bucket_size > 1"), "buckets")


def _differ(word: str) -> Column:
    return F.col(f"l_{word}").bitwiseXOR(F.col(f"r_{word}"))


@dataclass(frozen=True)
class _Blocks:
    """Half bands as disjoint blocks: pairs with at most ``allowed`` differing positions agree on one of those left."""

    params: NearDupParams
    allowed: int

    @property
    def per_band(self) -> int:
        return 2 if self.params.rows_per_band > 1 else 1

    @property
    def skipped(self) -> int:
        """Bands whose blocks are not needed, counted from the one of the bucket, on which all of its pairs agree."""
        return (self.params.bands * self.per_band - self.allowed - 1) // self.per_band

    def _used(self, band: int) -> Column:
        return F.pmod(F.lit(band) - F.col("l_band"), F.lit(self.params.bands)) >= self.skipped

    def explode(self, rows: DataFrame, carried: list[str]) -> DataFrame:
        """``rows`` (bucket, band, rep, words w0, w1, ...) under the keys of their blocks."""
        bands = range(self.params.bands)
        values = [F.shiftrightunsigned(F.col(f"w{b}"), 32) for b in bands], [F.col(f"w{b}").bitwiseAND(F.lit(HALF_MASK)) for b in bands]
        blocks = [
            F.struct(F.lit(b).alias("of"), F.xxhash64("bucket", F.lit(b), F.lit(side), values[side][b]).alias("block"), F.lit(2 * b + side).alias("block_no"))
            for b in bands for side in range(self.per_band)
        ]
        far = F.filter(F.array(*blocks), lambda x: F.pmod(x["of"] - F.col("band"), F.lit(self.params.bands)) >= self.skipped)
        return rows.select("rep", *carried, F.explode(far).alias("b")).select("rep", *carried, "b.block", "b.block_no")

    def first_agreed(self) -> Column:
        """Number of the first block on which the two sides of a join agree."""
        found = []
        for b in range(self.params.bands):
            parts = F.shiftrightunsigned(_differ(f"w{b}"), 32), _differ(f"w{b}").bitwiseAND(F.lit(HALF_MASK))
            found += [F.when((parts[side] == 0) & self._used(b), F.lit(2 * b + side)) for side in range(self.per_band)]
        return F.coalesce(*found)


def _candidates(groups: DataFrame, sizes: DataFrame, params: NearDupParams, carried: dict[str, Column], possible: Column | None = None,
                allowed: int | None = None) -> DataFrame:
    """(rep_a, rep_b): pairs of groups that share a bucket (``sizes`` has those of several groups) and are ``possible``, each once.

    ``possible`` may compare the ``carried`` columns as l_<name> and r_<name>. With ``allowed``, pairs that differ in more
    positions of the signature may be missing, which lets crowded buckets be searched by block.
    """
    bands = range(params.bands)
    names = ["band", *[f"w{b}" for b in bands], *carried]
    sparse = _bucket_rows(groups, params).join(sizes.where(F.col("bucket_size") <= params.dense_rows), "bucket")
    if possible is not None and len(carried) <= 1:  # a single number is no burden in sparse buckets
        few = sparse.join(groups.select("rep", *[c.alias(name) for name, c in carried.items()]), "rep")
        ids = _pairs_within(few, "bucket", "rep", "bucket_size", params, list(carried), possible)
    else:
        ids = _pairs_within(sparse, "bucket", "rep", "bucket_size", params)
    big = sizes.where(F.col("bucket_size") > params.dense_rows)
    if big.limit(1).count() == 0:
        return ids.distinct()

    words = groups.select("rep", band_words("signature", params.bands, params.rows_per_band).alias("w"), *[c.alias(name) for name, c in carried.items()])
    table = materialize(words.select("rep", *[F.get("w", F.lit(b)).alias(f"w{b}") for b in bands], *carried), "marks")
    once = F.coalesce(*[F.when(_differ(f"w{b}") == 0, F.lit(b)) for b in bands]) == F.col("l_band")
    tested = once if possible is None else once & possible
    cold, hot = _split_lookup(_bucket_rows(groups, params), big, "bucket", "bucket_size", params)
    ids = ids.unionByName(_pairs_within(cold.join(table, "rep"), "bucket", "rep", "bucket_size", params, names, tested))
    if hot is None:
        return ids.distinct()
    crowded = hot.join(table, "rep")
    blocks = None if allowed is None else _Blocks(params, allowed)
    if blocks is None or blocks.skipped < 1:
        return ids.unionByName(_pairs_within(crowded, "bucket", "rep", "bucket_size", params, names, tested)).distinct()
    exploded = blocks.explode(crowded, names)
    counts = exploded.groupBy("block").agg(F.count("*").alias("block_size"))
    rows = _lookup(exploded, materialize(counts.where("block_size > 1"), "blocks"), "block", "block_size", params)
    first = blocks.first_agreed() == F.col("l_block_no")
    return ids.unionByName(_pairs_within(rows, "block", "rep", "block_size", params, [*names, "block_no"], first & tested)).distinct()


def candidate_groups(groups: DataFrame, params: NearDupParams = DEFAULTS) -> DataFrame:
    """(rep_a, rep_b): pairs of groups that share a bucket."""
    return _candidates(groups, _bucket_sizes(groups, params), params, {})


def _met(rows: DataFrame, key: str, size_col: str, params: NearDupParams) -> DataFrame:
    """``rows`` under the work units in which they meet: those of a group of k rows are cut into slices of
    ``SLICE_UNITS * unit_rows``, and a row goes to a unit for each of them: left (side 1) or right (2) of another slice or among its own (0)."""
    slices, mine = _unit(size_col, "group_key", params, SLICE_UNITS)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)).alias("other")
    met = rows.withColumn("mine", mine).select("*", other)
    unit = F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other")).alias("unit")
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).cast("tinyint").alias("side")
    return met.select(unit, side, F.col("band").cast("int"), F.col("block_no").cast("int"), "rep", "copies", "alone", "signature")


def similar_groups(groups: DataFrame, params: NearDupParams = DEFAULTS) -> DataFrame:
    """(rep_a, rep_b, matches, copies_a, copies_b): groups that share a bucket and whose signatures agree often enough.

    Runs jobs when called. The rows of shared buckets are written once. Signatures travel to work units of bounded size, where
    numpy compares all pairs (some 30 ns each) and counts what agrees, so no pair of groups is looked up again. Buckets above
    ``CROWDED_SLICES`` slices fall apart into blocks first, as above that the square of their size would count.
    """
    spark = groups.sparkSession
    keyed = groups.where("rep IS NOT NULL").select("group_key", "rep", "copies", "signature")
    sizes = _bucket_sizes(keyed, params)
    rows = _lookup(_bucket_rows(keyed, params, "group_key"), sizes, "bucket", "bucket_size", params)
    rows = materialize(rows, "bucket-rows")
    # Groups of different texts under one id: the id stands for all of them.
    twins = materialize(keyed.groupBy("rep").count().where("count > 1").select("rep", F.lit(False).alias("alone")), "twins")
    repeated = twins.limit(1).count() > 0
    marked = keyed.join(twins, "rep", "left").withColumn("alone", F.coalesce("alone", F.lit(True))) if repeated else keyed.withColumn("alone", F.lit(True))

    blocks = _Blocks(params, params.num_perm - params.min_matches)
    limit = params.unit_rows * SLICE_UNITS * CROWDED_SLICES
    apart = blocks.skipped >= 1 and rows.where(F.col("bucket_size") > limit).limit(1).count() > 0
    direct = rows.where(F.col("bucket_size") <= limit) if apart else rows
    # Keys of many rows are a small file: left to itself, Spark would broadcast them.
    marked = marked.hint("merge")
    met = _met(direct.join(marked, "group_key").withColumn("block_no", F.lit(-1)), "bucket", "bucket_size", params)
    if apart:
        crowded = rows.where(F.col("bucket_size") > limit).join(marked, "group_key")
        words = band_words("signature", params.bands, params.rows_per_band)
        wide = crowded.withColumn("w", words).withColumns({f"w{b}": F.get("w", F.lit(b)) for b in range(params.bands)})
        exploded = blocks.explode(wide, ["group_key", "band", "copies", "alone", "signature"])
        counts = exploded.groupBy("block").agg(F.count("*").alias("block_size"))
        lone = _lookup(exploded, materialize(counts.where("block_size > 1"), "blocks"), "block", "block_size", params)
        met = met.unionByName(_met(lone, "block", "block_size", params))

    kind = groups.schema["rep"].dataType.simpleString()
    step, schema = similar_pairs(params.num_perm, params.bands, params.min_matches, blocks.per_band, blocks.skipped, kind)
    found = met.repartition(_many_parts(spark), "unit").sortWithinPartitions("unit").mapInArrow(step, schema)
    found = found.where("rep_l != rep_r")
    swap = F.col("rep_l") > F.col("rep_r")
    columns = {"rep_a": ("rep_l", "rep_r"), "rep_b": ("rep_r", "rep_l"), "copies_a": ("copies_l", "copies_r"), "copies_b": ("copies_r", "copies_l")}
    pairs = found.select("matches", *[F.when(swap, F.col(y)).otherwise(F.col(x)).alias(c) for c, (x, y) in columns.items()])
    pairs = pairs.select("rep_a", "rep_b", "matches", "copies_a", "copies_b")
    if not repeated:
        return pairs
    pairs = materialize(pairs, "met")
    signatures = groups.select("rep", "signature", "copies")
    matches = match_count(F.col("signature_a"), F.col("signature_b"))
    many = (
        pairs.where("matches IS NULL").select("rep_a", "rep_b").distinct()
        .join(signatures.toDF("rep_a", "signature_a", "copies_a"), "rep_a")
        .join(signatures.toDF("rep_b", "signature_b", "copies_b"), "rep_b")
        .select("rep_a", "rep_b", matches.alias("matches"), "copies_a", "copies_b")
        .where(F.col("matches") >= params.min_matches)
    )
    return pairs.where("matches IS NOT NULL").unionByName(many)


def _members(signed: DataFrame, groups: DataFrame, params: NearDupParams, keep: int | None = None) -> DataFrame:
    """(rep, doc_id, copies) of groups with at least two documents, optionally only the ``keep`` smallest ids of each."""
    several = groups.where("copies > 1").select("group_key", "rep", "copies")
    rows = signed.select("doc_id", "group_key")
    if keep is None:
        return _lookup(rows, several, "group_key", "copies", params).select("rep", "doc_id", "copies")
    # The rank limit is applied before the shuffle as well, so a huge group sends a few rows per task.
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("group_key").orderBy("doc_id")))
    few = ranked.where(F.col("rank") <= keep).drop("rank")
    return few.join(several, "group_key").select("rep", "doc_id", F.least("copies", F.lit(keep)).alias("copies"))


def expand_pairs(group_pairs: DataFrame, signed: DataFrame, groups: DataFrame, params: NearDupParams = DEFAULTS,
                 value: str | None = None, same_value: Column | None = None, keep: int | None = None) -> DataFrame:
    """Document pairs (doc_a < doc_b) behind pairs of groups plus the pairs inside each group.

    Members of a group are joined slice by slice; no task sees a whole large group.
    """
    carried = [value] if value else []
    members = _members(signed, groups, params, keep)
    slices, mine = _unit("copies", "doc_id", params)
    sliced = members.select("rep", mine.alias("slice"), "doc_id")

    def expand(pairs: DataFrame, side: str) -> DataFrame:
        copies = F.col(f"copies_{side}")
        if keep is not None:
            copies = F.least(copies, F.lit(keep))
        n_slices = F.ceil(copies / F.lit(params.unit_rows)).cast("bigint")
        numbered = pairs.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), n_slices - 1)))
        own = sliced.toDF(f"rep_{side}", "slice", f"member_{side}")
        return numbered.join(own, [f"rep_{side}", "slice"], "left").drop("slice").withColumn(
            f"member_{side}", F.coalesce(f"member_{side}", f"rep_{side}")
        )

    across = expand(expand(group_pairs, "a"), "b").select(
        F.least("member_a", "member_b").alias("doc_a"), F.greatest("member_a", "member_b").alias("doc_b"), *carried
    )
    inside = _pairs_within(members, "rep", "doc_id", "copies", params).select(
        F.col("doc_id_a").alias("doc_a"), F.col("doc_id_b").alias("doc_b"),
        *([same_value.alias(value)] if value else []),
    )
    return across.unionByName(inside)


def _with_copies(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    copies = groups.select("rep", "copies")
    return pairs.join(copies.toDF("rep_a", "copies_a"), "rep_a").join(copies.toDF("rep_b", "copies_b"), "rep_b")


def near_dup_candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: NearDupParams = DEFAULTS) -> DataFrame:
    """(doc_a, doc_b): every pair of documents that shares at least one bucket."""
    signed = sign(df, id_col, text_col, params)
    groups = signature_groups(signed)
    pairs = _with_copies(candidate_groups(groups, params), groups)
    return expand_pairs(pairs, signed, groups, params)


@dataclass(frozen=True)
class NearDups:
    """Near-duplicates in compact form: documents -> groups -> similar groups."""

    signed: DataFrame
    groups: DataFrame
    similar: DataFrame
    params: NearDupParams

    def pairs(self, keep: int | None = None) -> DataFrame:
        """(doc_a, doc_b, jaccard), the reported list."""
        # Shares are multiples of 1/128, so ties are exact: half to even, as in Python.
        share = F.bround(F.col("matches") / F.lit(float(self.params.num_perm)), 4)
        return expand_pairs(
            self.similar.withColumn("jaccard", share), self.signed, self.groups, self.params, "jaccard", F.lit(1.0), keep
        )

    def examples(self, k: int = 5) -> DataFrame:
        """First ``k`` pairs by (doc_a, doc_b).

        A document that is not among the k+1 smallest of its group cannot be part of them: the smaller
        ones have the same partners and their pairs come first. So only those are expanded. Of two similar groups the pair
        of their representatives comes first, so the ``k`` first pairs of representatives are all that is needed of them.
        """
        first = replace(self, similar=self.similar.orderBy("rep_a", "rep_b").limit(k))
        return first.pairs(keep=k + 1).orderBy("doc_a", "doc_b").limit(k)

    def summary(self) -> DataFrame:
        """One row of parameters and totals, from copy counts; no pair is spelled out."""
        wide = "decimal(38,0)"
        copies = F.col("copies").cast("decimal(18,0)")
        across = self.similar.agg(
            F.sum(F.col("copies_a").cast("decimal(18,0)") * F.col("copies_b").cast("decimal(18,0)")).alias("pairs")
        )
        inside = self.groups.agg(
            F.sum("copies").alias("total_docs"),
            F.sum((copies * (copies - 1) / 2).cast(wide)).alias("pairs"),
        )
        linked = (
            self.similar.select(F.col("rep_a").alias("rep"), F.col("copies_a").alias("copies"))
            .unionByName(self.similar.select(F.col("rep_b").alias("rep"), F.col("copies_b").alias("copies")))
            .unionByName(self.groups.where("copies > 1").select("rep", "copies"))
            .distinct()
            .agg(F.sum("copies").alias("dup_docs"))
        )
        merged = across.unionByName(inside, allowMissingColumns=True).unionByName(linked, allowMissingColumns=True)
        totals = merged.agg(
            F.coalesce(F.max("total_docs"), F.lit(0)).cast("bigint").alias("total_docs"),
            F.coalesce(F.sum("pairs").cast(wide), F.lit(0).cast(wide)).alias("total_pairs"),
            F.coalesce(F.max("dup_docs"), F.lit(0)).cast("bigint").alias("dup_docs"),
        )
        p = self.params
        return totals.select(
            F.lit(p.n_gram).alias("n"),
            F.lit(p.num_perm).alias("num_perm"),
            F.lit(p.threshold).alias("threshold"),
            F.lit(p.bands).alias("bands"),
            F.lit(p.rows_per_band).alias("rows_per_band"),
            "total_docs",
            "total_pairs",
            F.bround(percent(F.col("total_pairs").cast("double"), F.col("total_docs")), 2).alias("pair_pct"),
            "dup_docs",
            F.bround(percent(F.col("dup_docs"), F.col("total_docs")), 2).alias("dup_doc_pct"),
        )


def near_dups_of(signed: DataFrame, params: NearDupParams = DEFAULTS) -> NearDups:
    """Near-duplicates of a table that holds (doc_id, group_key, signature)."""
    groups = signature_groups(signed)
    return NearDups(signed, groups, materialize(similar_groups(groups, params), "similar"), params)


def near_dups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: NearDupParams = DEFAULTS) -> NearDups:
    return near_dups_of(sign(df, id_col, text_col, params), params)


def _unit_pairs(ids: DataFrame, params: NearDupParams) -> DataFrame:
    """(unit, a, b): pairs of ids under their work unit.

    The neighbourhood of a text is named by the smallest id that one or two pairs lead to. One of k texts is cut into
    s = ceil(k / unit_texts) slices, and a unit holds the pairs between two slices: of a group whose pairs are all asked
    for, a text goes to s units and not along with k pairs.
    """
    both = ids.unionByName(ids.select(F.col("rep_b").alias("rep_a"), F.col("rep_a").alias("rep_b")))
    near = materialize(both.groupBy(F.col("rep_a").alias("rep")).agg(F.least("rep_a", F.min("rep_b")).alias("home")), "near")
    homes = both.join(near, F.col("rep_b") == F.col("rep")).groupBy(F.col("rep_a").alias("rep")).agg(F.min("home").alias("home"))
    homes = materialize(homes.join(near.toDF("rep", "own"), "rep").select("rep", F.least("home", "own").alias("home")), "homes")
    counts = materialize(homes.groupBy("home").agg(F.count("*").alias("texts")), "home-sizes")
    slices = F.ceil(F.col("texts") / F.lit(params.unit_texts)).cast("bigint")
    spot = F.xxhash64("home", F.pmod(F.xxhash64("rep"), slices)).alias("spot")
    spots = materialize(_lookup(homes, counts, "home", "texts", params).select("rep", spot), "spots")
    placed = ids.join(spots.toDF("rep_a", "spot_a"), "rep_a").join(spots.toDF("rep_b", "spot_b"), "rep_b")
    unit = F.xxhash64(F.least("spot_a", "spot_b"), F.greatest("spot_a", "spot_b")).alias("unit")
    return materialize(placed.select(unit, F.col("rep_a").alias("a"), F.col("rep_b").alias("b")), "check-pairs")


def _wanted(pairs: DataFrame) -> DataFrame:
    return pairs.select("unit", F.explode(F.array("a", "b")).alias("rep")).distinct()


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(unit, a, b, norm): ``pairs``, and each text (no b) once in every unit that has a pair of it."""
    # Ids are a small file: left to itself, Spark would broadcast very many of them.
    held = _wanted(pairs).hint("merge").join(texts, "rep").select("unit", F.col("rep").alias("a"), "norm")
    return pairs.unionByName(held, allowMissingColumns=True)


def _check_units(ids: DataFrame, texts: DataFrame, params: NearDupParams) -> DataFrame:
    """``_with_texts`` of all units."""
    return _with_texts(_unit_pairs(ids, params), texts)


def _rounds(pairs: DataFrame, sizes: DataFrame) -> list[DataFrame]:
    """``pairs`` in parts of whole units for which about as many bytes of text travel as there are, or ROUND_BYTES where those are few.

    In a crowd of k texts each goes to some k / unit_texts units, so all at once would fill the disk.
    """
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    moved = _wanted(pairs).hint("merge").join(sizes, "rep").agg(F.sum("bytes")).first()[0] or 0
    rounds = max(1, -(-moved // max(total, ROUND_BYTES)))
    return [pairs.where(F.pmod("unit", F.lit(rounds)) == n) for n in range(rounds)] if rounds > 1 else [pairs]


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """What is written within leaves no shuffle files behind, which would else stay until the driver's memory is cleaned."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def near_dup_pairs_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: NearDupParams = DEFAULTS) -> DataFrame:
    """(doc_a, doc_b, jaccard): candidates checked with the exact Jaccard similarity of their shingle sets.

    The normalised texts of the representatives that share a bucket are kept once; their ids select them (broadcast while
    provably few, so no text is moved). Sets of 64-bit hashes are several times as long as texts, so they are made where pairs
    are checked, and a text goes to work units of many pairs, not along with each pair (see ``_check_units``). The similarity
    of two sets is at most the ratio of their sizes, so pairs of too different sizes never leave the bucket join.
    """
    signed = sign(df, id_col, text_col, params, exact=True)
    groups = signature_groups(signed)
    sizes = _bucket_sizes(groups, params)
    shared = _bucket_rows(groups, params).join(sizes, "bucket", "left_semi")
    reps = materialize(shared.select("rep").distinct(), "shared")
    wanted = F.broadcast(reps) if reps.count() <= BROADCAST_KEYS else reps
    texts = df.select(F.col(id_col).alias("rep"), shingle_normalize(text_col).alias("norm")).join(wanted, "rep", "left_semi")
    texts = materialize(texts.withColumn("n", shingle_count_udf(params.n_gram)("norm")), "texts")

    ratio = F.try_divide(F.least("l_n", "r_n"), F.greatest("l_n", "r_n"))
    possible = F.coalesce(ratio, F.lit(1.0)) >= params.threshold
    sized = groups.select("rep", "signature").join(texts.select("rep", "n"), "rep")
    ids = materialize(_candidates(sized, sizes, params, {"n": F.col("n")}, possible), "candidates")

    kind = ids.schema["rep_a"].dataType.simpleString()
    share = F.coalesce(F.try_divide("common", F.col("n_a") + F.col("n_b") - F.col("common")), F.lit(1.0))
    pairs = _unit_pairs(ids, params)
    scored = None
    for units in _rounds(pairs, texts.select("rep", F.octet_length("norm").alias("bytes"))):
        rows = _with_texts(units, texts.select("rep", "norm")).repartition(_many_parts(df.sparkSession), "unit").sortWithinPartitions("unit", F.col("b").isNotNull(), "a")
        counted = rows.mapInArrow(common_shingles(params.n_gram), f"rep_a {kind}, rep_b {kind}, n_a int, n_b int, common int")
        # Written before the filter, which would otherwise make the join check every pair a second time.
        with _shuffles_dropped(df.sparkSession):
            part = materialize(counted.select("rep_a", "rep_b", share.alias("jaccard")), "scored")
        scored = part if scored is None else scored.unionByName(part)
    scored = scored.where(F.col("jaccard") >= params.threshold)
    return expand_pairs(_with_copies(scored, groups), signed, groups, params, "jaccard", F.lit(1.0))
