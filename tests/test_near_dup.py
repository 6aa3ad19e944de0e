import itertools
import random

import pytest
from pyspark.sql import functions as F

from textassay.functions import minhash as M
from textassay.operators import near_dup as N

WORDS = "alfa bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa".split()


def shingle_set(text, n=5):
    if text is None:
        return set()
    t = " ".join("".join(c for c in text.lower() if c.isalnum() or c.isspace()).split())
    return {t} if len(t) < n else {t[i : i + n] for i in range(len(t) - n + 1)}


def hash32(shingle):
    mask = 0xFFFFFFFF
    h = M.SEED
    for c in shingle:
        h = (h * M.RADIX + ord(c)) & mask
    h ^= h >> 16
    h = (h * M.MIX_1) & mask
    h ^= h >> 15
    h = (h * M.MIX_2) & mask
    return h ^ (h >> 16)


def signature(text):
    hashes = [hash32(s) for s in shingle_set(text)]
    return [min([(a * h + b) & 0xFFFFFFFF for h in hashes], default=0xFFFFFFFF) >> 1 for a, b in M.permutations(128)]


def candidate_pairs(texts):
    sigs = [signature(t) for t in texts]
    for i, j in itertools.combinations(range(len(texts)), 2):
        if any(sigs[i][b : b + 8] == sigs[j][b : b + 8] for b in range(0, 128, 8)):
            yield i, j, sum(x == y for x, y in zip(sigs[i], sigs[j]))


def expected_pairs(texts):
    return sorted((i, j, round(m / 128, 4)) for i, j, m in candidate_pairs(texts) if m >= 103)


def expected_exact(texts):
    found = []
    for i, j, _ in candidate_pairs(texts):
        a, b = shingle_set(texts[i]), shingle_set(texts[j])
        similarity = len(a & b) / len(a | b) if a | b else 1.0
        if similarity >= 0.8:
            found.append((i, j, similarity))
    return sorted(found)


def corpus(seed, families=6, size=6):
    """Families of texts that differ in a few words, exact copies, junk and NULLs."""
    rng = random.Random(seed)
    found = ["!!!", "...", "ab", "AB!", None, None, ""]
    for _ in range(families):
        base = rng.choices(WORDS, k=60)
        for _ in range(size):
            variant = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 12])):
                variant[rng.randrange(60)] = rng.choice(WORDS)
            found.append(" ".join(variant))
    rng.shuffle(found)
    return found


def pairs_of(dups):
    return sorted((r["doc_a"], r["doc_b"], r["jaccard"]) for r in dups.pairs().collect())


def test_signature_values(texts):
    values = ["abc", "", None, "the quick brown fox jumps", "\U0001d49c\U0001d49c x y z añb", "x" * 5_000, "word " * 900]
    rows = N.minhash_signature(texts(*values)).collect()
    assert {r["doc_id"]: r["signature"] for r in rows} == {i: signature(v) for i, v in enumerate(values)}


def test_small_groups(texts):
    dup = "identical text of some length, identical text of some length"
    found = pairs_of(N.near_dups(texts(dup, dup, "unrelated words " * 9, dup, "!!!", "?!", "zz", None, None)))
    assert found == [(0, 1, 1.0), (0, 3, 1.0), (1, 3, 1.0), (4, 5, 1.0), (7, 8, 1.0)]


# unit_rows = 2 makes nearly every group and bucket a crowded one, dense_rows = 1 every other one dense; the results must not change.
@pytest.mark.parametrize(("unit_rows", "dense_rows"), [(2_000, 128), (2, 1), (5, 2), (2_000, 1)])
def test_pairs_against_brute_force(texts, unit_rows, dense_rows):
    values = corpus(1)
    dups = N.near_dups(texts(*values), params=N.NearDupParams(unit_rows=unit_rows, dense_rows=dense_rows))
    expected = expected_pairs(values)
    assert len(expected) > 30
    assert pairs_of(dups) == expected
    summary = dups.summary().first()
    linked = {d for a, b, _ in expected for d in (a, b)}
    assert (summary["total_docs"], int(summary["total_pairs"]), summary["dup_docs"]) == (len(values), len(expected), len(linked))
    assert summary["pair_pct"] == round(100 * len(expected) / len(values), 2)
    examples = [(r["doc_a"], r["doc_b"], r["jaccard"]) for r in dups.examples(5).collect()]
    assert examples == expected[:5]


@pytest.mark.parametrize(("unit_rows", "dense_rows"), [(2_000, 128), (3, 1)])
def test_candidates_and_exact_against_brute_force(texts, unit_rows, dense_rows):
    values = corpus(2, families=4)
    params = N.NearDupParams(unit_rows=unit_rows, dense_rows=dense_rows)
    found = sorted((r["doc_a"], r["doc_b"]) for r in N.near_dup_candidates(texts(*values), params=params).collect())
    assert found == sorted((i, j) for i, j, _ in candidate_pairs(values))
    exact = sorted((r["doc_a"], r["doc_b"], r["jaccard"]) for r in N.near_dup_pairs_exact(texts(*values), params=params).collect())
    assert exact == expected_exact(values)


def test_salted_lookup(texts, monkeypatch):
    values = corpus(3, families=3)
    monkeypatch.setattr(N, "BROADCAST_KEYS", 0)
    assert pairs_of(N.near_dups(texts(*values), params=N.NearDupParams(unit_rows=3, dense_rows=2))) == expected_pairs(values)


def test_crowded_bucket_falls_apart_into_blocks(spark):
    """Groups that share one band and little else: pairs meet by block, not all with all, and true pairs are found."""
    rng, rows = random.Random(4), []
    shared = [rng.randrange(2**31) for _ in range(8)]
    for i in range(600):
        base = shared + [rng.randrange(2**31) for _ in range(120)]
        changed = set(rng.sample(range(8, 128), 25 if i % 3 else 27))
        near = [rng.randrange(2**31) if j in changed else x for j, x in enumerate(base)]
        rows += [(2 * i, str(2 * i), base), (2 * i + 1, str(2 * i + 1), near)]
    signed = spark.createDataFrame(rows, "doc_id long, group_key string, signature array<int>")
    params = N.NearDupParams(unit_rows=100, dense_rows=10)
    groups = N.signature_groups(signed)
    found = {(r["rep_a"], r["rep_b"]): r["matches"] for r in N.similar_groups(groups, params).collect()}
    same = {(2 * i, 2 * i + 1): sum(a == b for a, b in zip(rows[2 * i][2], rows[2 * i + 1][2])) for i in range(600)}
    assert found == {pair: m for pair, m in same.items() if m >= 103} and len(found) == 400
    blocks = N._Blocks(params, 25)
    assert (blocks.skipped, blocks.per_band) == (3, 2)
    assert N._Blocks(N.NearDupParams(bands=4, num_perm=16), 3).skipped == 2
    table = groups.select("rep", F.lit(0).alias("band"), F.lit(1).cast("bigint").alias("bucket"), M.band_words("signature", 16, 8).alias("w"))
    table = N.materialize(table.select("rep", "band", "bucket", *[F.col("w")[b].alias(f"w{b}") for b in range(16)]), "table")
    sizes = blocks.explode(table, []).groupBy("block").count().agg(F.max("count"), F.sum(F.expr("count * (count - 1)"))).first()
    assert sizes[0] <= 4 and sizes[1] < 40 * 600  # all with all: 720,000


@pytest.mark.parametrize(("slices", "unit_rows"), [(8, 2_000), (8, 25), (1, 10)])
def test_similar_groups_in_large_units(spark, slices, unit_rows, monkeypatch):
    """A crowd in one bucket, compared as a whole, slice by slice or block by block, against brute force; each pair comes once."""
    monkeypatch.setattr(N, "CROWDED_SLICES", slices)
    rng, rows = random.Random(7), []
    base = [rng.randrange(2**31) for _ in range(128)]
    for i in range(400):
        changed = set(rng.sample(range(16, 128), rng.choice([0, 5, 12, 20, 60]) if i else 0))
        # Other values with equal low bytes must not count as equal.
        row = [(x ^ 256 if j % 3 else rng.randrange(2**31)) if j in changed else x for j, x in enumerate(base)]
        rows.append((i, str(row), row))
    groups = N.signature_groups(spark.createDataFrame(rows, "doc_id long, group_key string, signature array<int>"))
    leaders = [(r["rep"], r["signature"]) for r in groups.collect()]
    found = [tuple(r) for r in N.similar_groups(groups, N.NearDupParams(unit_rows=unit_rows)).select("rep_a", "rep_b", "matches").collect()]
    same = ((a, b, sum(x == y for x, y in zip(s, t))) for a, s in leaders for b, t in leaders if a < b)
    assert sorted(found) == sorted(x for x in same if x[2] >= 103) and len(found) > 10_000


def test_groups_under_one_id(spark):
    """Different texts under one id are compared each; ids decide nothing else, and a group without an id has no pairs."""
    rng = random.Random(8)
    base = [rng.randrange(2**31) for _ in range(128)]
    far = [rng.randrange(2**31) for _ in range(128)]
    near = [*base[:120], *far[:8]]
    rows = [(1, "a", base), (1, "b", near), (2, "c", [*base[:110], *far[:18]]), (3, "d", far), (3, "e", base[:64] + far[64:]), (None, "f", base[:127] + far[:1])]
    groups = N.signature_groups(spark.createDataFrame(rows, "doc_id long, group_key string, signature array<int>"))
    found = sorted(tuple(r) for r in N.similar_groups(groups).collect())
    assert found == [(1, 2, 110, 1, 1), (1, 2, 110, 1, 1)]


def test_signatures_are_looked_up_once_a_row(spark):
    """Pairs carry their matches from the unit that compared them: no join by pair, no sketch, and nothing of a group's size is broadcast."""
    rows = [(i, str(i), [j if j < 100 else i * j for j in range(128)]) for i in range(50)]
    groups = N.signature_groups(spark.createDataFrame(rows, "doc_id long, group_key string, signature array<int>"))
    plan = N.similar_groups(groups)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0] and "MapInArrow" in plan


def test_large_group_of_copies(spark):
    """A third of the rows are one text: counted without spelling out the pairs, and cut into units when they are."""
    rows = spark.range(900).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same page again and again " * 5)).otherwise(F.md5(F.col("id").cast("string"))).alias("text"),
    )
    dups = N.near_dups(rows, params=N.NearDupParams(unit_rows=40))
    assert int(dups.summary().first()["total_pairs"]) == 300 * 299 // 2
    listed = dups.pairs()
    assert listed.count() == 300 * 299 // 2
    assert listed.select("doc_a", "doc_b").distinct().count() == 300 * 299 // 2
    assert [(r["doc_a"], r["doc_b"]) for r in dups.examples(3).collect()] == [(0, 3), (0, 6), (0, 9)]


def test_examples_expand_few_pairs(spark, monkeypatch):
    """Of a crowd of similar groups only the first pairs of representatives are spelled out; the list is that of all pairs."""
    df = spark.createDataFrame([(i, " ".join([*WORDS, *WORDS, f"n{i // 2}"])) for i in range(60)], "doc_id long, text string").repartition(3)
    dups = N.near_dups(df)
    everything = sorted((r["doc_a"], r["doc_b"], r["jaccard"]) for r in dups.pairs().collect())
    asked = []

    def count(pairs, *rest, expand=N.expand_pairs):
        asked.append(pairs.count())
        return expand(pairs, *rest)

    monkeypatch.setattr(N, "expand_pairs", count)
    assert [tuple(r) for r in dups.examples(4).collect()] == everything[:4]
    assert asked == [4] and dups.similar.count() > 20


def test_result_does_not_depend_on_partitions(texts):
    df = texts(*corpus(4, families=3))
    assert pairs_of(N.near_dups(df.repartition(7))) == pairs_of(N.near_dups(df.coalesce(1)))


def test_empty_corpus(texts):
    dups = N.near_dups(texts("a").where("false"))
    row = dups.summary().first()
    assert (row["total_docs"], int(row["total_pairs"]), row["pair_pct"], row["dup_docs"]) == (0, 0, 0.0, 0)
    assert dups.pairs().count() == 0


def test_sketch_never_counts_too_many_mismatches(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(200):
        a = [rng.randrange(2**31) for _ in range(128)]
        b = [rng.randrange(2**31) if rng.random() < 0.3 else x for x in a]
        rows.append((a, b, sum(x != y for x, y in zip(a, b))))
    df = spark.createDataFrame(rows, "a array<int>, b array<int>, mismatches int")
    bound = M.sketch_mismatches(M.sketch_words("a", 128), M.sketch_words("b", 128))
    for r in df.select("mismatches", bound.alias("bound")).collect():
        assert r["mismatches"] - 5 <= r["bound"] <= r["mismatches"]


def test_wide_shingle_hashes_are_sets(spark):
    values = ["abc", "", None, "abcabcabcabc", "x" * 5_000, "\U0001d49c xyz \U0001d49c xyz"]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, norm string")
    for r in df.select("doc_id", "norm", M.shingle_hashes_udf()("norm").alias("h")).collect():
        t = r["norm"]
        assert r["h"] == sorted(set(r["h"])) and len(r["h"]) == (0 if t is None else len({t[i : i + 5] for i in range(max(1, len(t) - 4))}))


def test_exact_check_moves_texts_by_work_unit(texts, monkeypatch):
    """No set of shingles is written or shuffled, and a text of a crowd goes to a few work units, not along with each pair."""
    rng = random.Random(3)
    base = rng.choices(WORDS, k=60)
    crowd = [" ".join([*base[:-2], f"n{i}", f"m{i % 7}"]) for i in range(60)]
    values = [*crowd, *(" ".join(rng.choices(WORDS, k=30)) for _ in range(10)), None, "", "ab"]
    written = {}

    def keep(df, name, write=N.materialize):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(N, "materialize", keep)
    df = texts(*values)
    for size in (512, 8):
        params = N.NearDupParams(unit_texts=size)
        found = {(r["doc_a"], r["doc_b"]): r["jaccard"] for r in N.near_dup_pairs_exact(df, params=params).collect()}
        assert all(kind != "array<bigint>" for table in written.values() for _, kind in table.dtypes)
        moved = N._check_units(written["candidates"], written["texts"].select("rep", "norm"), params).where("b IS NULL").count()
        assert moved <= 80 if size == 512 else moved < written["candidates"].count()
        assert found and {k for k in found} <= {(r["rep_a"], r["rep_b"]) for r in written["candidates"].collect()}
        for (a, b), jaccard in found.items():
            x, y = shingle_set(values[a]), shingle_set(values[b])
            assert jaccard == len(x & y) / len(x | y) >= 0.8


def test_exact_check_goes_in_rounds(texts, monkeypatch):
    """Where texts travel to many units, the units are checked in rounds, none of which moves much more text than there is."""
    rng = random.Random(5)
    base = rng.choices(WORDS, k=60)
    values = [" ".join([*base[:-2], f"n{i}", f"m{i % 7}"]) for i in range(80)]
    rounds = []
    monkeypatch.setattr(N, "ROUND_BYTES", 1)
    monkeypatch.setattr(N, "_with_texts", lambda pairs, texts, make=N._with_texts: rounds.append(make(pairs, texts)) or rounds[-1])
    df = texts(*values)
    found = sorted((r["doc_a"], r["doc_b"], r["jaccard"]) for r in N.near_dup_pairs_exact(df, params=N.NearDupParams(unit_texts=8)).collect())
    assert found == expected_exact(values) and len(found) > 500
    assert 5 <= len(rounds) <= 12
    moved = [r.agg(F.count("norm")).first()[0] for r in rounds]
    assert max(moved) < 2 * len(values) < sum(moved)
    assert df.sparkSession.conf.get(N.DROP_SHUFFLES, "false") == "false"


def test_threshold_in_matches():
    assert N.NearDupParams().min_matches == 103
    assert N.NearDupParams(threshold=0.5).min_matches == 64


def test_estimate_is_unbiased_enough():
    """Signature agreement stays within four standard deviations of the true similarity on average."""
    rng = random.Random(9)
    errors = []
    for _ in range(40):
        base = rng.choices(WORDS, k=80)
        other = list(base)
        for _ in range(8):
            other[rng.randrange(80)] = rng.choice(WORDS)
        a, b = " ".join(base), " ".join(other)
        sa, sb = shingle_set(a), shingle_set(b)
        estimate = sum(x == y for x, y in zip(signature(a), signature(b))) / 128
        errors.append(estimate - len(sa & sb) / len(sa | sb))
    assert abs(sum(errors) / len(errors)) < 4 * 0.04 / 40**0.5


def test_tested_pairs_are_spread_over_many_tasks(spark):
    """Pairs that are tested inside the join are dealt to a fixed number of partitions, which Spark does not merge."""
    rows = spark.range(200).select(F.lit(1).alias("bucket"), F.col("id").alias("rep"), F.lit(200).alias("size"), F.col("id").alias("n"))
    params = N.NearDupParams(unit_rows=20)
    found = N._pairs_within(rows, "bucket", "rep", "size", params, ["n"], F.abs(F.col("l_n") - F.col("r_n")) < 3)
    assert {tuple(r) for r in found.collect()} == {(a, b) for a in range(200) for b in range(a + 1, min(a + 3, 200))}
    assert found.rdd.getNumPartitions() == 8 * spark.sparkContext.defaultParallelism
