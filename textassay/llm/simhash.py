"""SimHash near-duplicates with multi-index hashing.

Fingerprints of 64 bits come from an Arrow UDF (numpy; blocks of shingles, so memory follows one text). Equal
fingerprints are collapsed before anything is compared. A fingerprint is cut into two halves: two that
differ in at most 3 bits differ in at most 1 bit in one half. Every fingerprint stands in the table of each
half under that half's value and looks up the Hamming ball of radius 1 around it (33 values); matches are
verified on all 64 bits inside the join. A table entry with more than ``CROWDED`` fingerprints is not
compared pair by pair: its rows are keyed by the entry and one of the four bytes of the other half, of
which at least one must agree as well. Probes are 66 rows a fingerprint, which Spark's sizes do not see, so
neither side of these joins is ever broadcast. Links then connect documents through distinct fingerprints only.

Defined cases: null text counts as empty; texts without a word have fingerprint 0 and are linked like any
other; a null id never names a component, and a component of null ids only is null; repeated rows stay
rows; an empty table gives an empty table. Columns other than id and text are not read.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from textassay.llm.common import materialize, whole
from textassay.llm.components import connected_components

MAX_DISTANCE = 3
SHINGLE_WORDS = 3
CROWDED = 512
SEED = 42
BLOCK = 1 << 16
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of the lower-cased text joined by single spaces, with their starts and ends."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    blank = _BLANK[raw]
    kept = ~blank
    kept[1:] |= ~blank[:-1]  # one blank behind each word
    joined = raw[kept].copy()
    blank = _BLANK[joined]
    joined[blank] = 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([1], blank.view(np.int8), [1]))))
    return joined.tobytes(), edge[0::2], edge[1::2]


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit SimHash of a text."""
    joined, starts, ends = word_bounds(text or "")
    if not len(starts):
        return 0
    width = min(words, len(starts))
    starts, ends = starts[: len(starts) - width + 1], ends[width - 1 :]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), BLOCK):
        spans = zip(starts[i : i + BLOCK].tolist(), ends[i : i + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_udf(words: int = SHINGLE_WORDS):
    @pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return simhash


def _half(value: Column, no: int) -> Column:
    """Half ``no`` of a fingerprint as a key that also tells the half."""
    low = F.shiftrightunsigned(value, 32 * no).bitwiseAND(F.lit(0xFFFFFFFF))
    return low.bitwiseOR(F.lit(no << 32))


def _entries(prints: DataFrame) -> DataFrame:
    return prints.select("f", F.explode(F.array(_half(F.col("f"), 0), _half(F.col("f"), 1))).alias("key"))


def _probes(prints: DataFrame) -> DataFrame:
    """Every fingerprint with the keys of the balls of radius 1 around its halves."""
    halves = [_half(F.col("f"), no) for no in (0, 1)]
    balls = [h if bit is None else h.bitwiseXOR(F.lit(1 << bit)) for h in halves for bit in (None, *range(32))]
    return prints.select("f", F.explode(F.array(*balls)).alias("key"))


def _other_bytes(rows: DataFrame) -> DataFrame:
    """One row for each byte of the half that the key does not stand for."""
    other = F.when(F.shiftright("key", 32) == 0, F.shiftrightunsigned("f", 32)).otherwise(F.col("f"))
    parts = [F.lit(i << 8).bitwiseOR(F.shiftright(other, 8 * i).bitwiseAND(F.lit(0xFF))) for i in range(4)]
    return rows.select("f", "key", F.explode(F.array(*parts)).alias("part"))


def linked(prints: DataFrame) -> DataFrame:
    """(a, b) of distinct fingerprints ``f`` that differ in 1 to MAX_DISTANCE bits."""
    entries, probes = _entries(prints), _probes(prints)
    crowded = materialize(entries.groupBy("key").count().where(F.col("count") > CROWDED).select("key"), "simhash-crowded")

    def verified(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        left, right = left.withColumnRenamed("f", "a"), right.withColumnRenamed("f", "b")
        close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE
        # Spark takes an exploded table to be as small as it was before, so its choice would be to broadcast the probes.
        return left.hint("merge").join(right.hint("merge"), on).where((F.col("a") < F.col("b")) & close).select("a", "b")

    plain = verified(entries.join(crowded, "key", "left_anti"), probes, ["key"])
    # Crowded entries are at most rows / CROWDED keys, and they meet their probes byte by byte.
    dense_entries, dense_probes = entries.join(crowded, "key", "left_semi"), probes.join(crowded, "key", "left_semi")
    dense = verified(_other_bytes(dense_entries), _other_bytes(dense_probes), ["key", "part"])
    return plain.unionByName(dense)


def component_of(prints: DataFrame) -> DataFrame:
    """``prints``, one row for each fingerprint ``f``, with the ``component`` of linked fingerprints it belongs to."""
    parts = connected_components(linked(prints.select("f")))
    return prints.join(parts.withColumnRenamed("node", "f"), "f", "left").withColumn("component", F.coalesce("component", "f"))


def near_dup_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, f, component_id), one row per row; ``f`` is the fingerprint as a signed number.

    Runs jobs when called: fingerprints and links are written to the shared folder.
    """
    signed = df.select(F.col(id_col).cast("bigint").alias("doc_id"), fingerprint_udf(words)(whole(text_col)).alias("f"))
    signed = materialize(signed, "simhash")
    prints = materialize(signed.groupBy("f").agg(F.min("doc_id").alias("first_id")), "simhash-prints")
    roots = component_of(prints)
    least = roots.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = materialize(roots.join(least, "component").select("f", "component_id"), "simhash-classes")
    return signed.join(classes, "f").select("doc_id", "f", "component_id")


def fingerprint_hex(value: str = "f") -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")
