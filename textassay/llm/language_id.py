"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The vector of an n-gram binds (multiplies) the vectors of its
letters, each permuted (rotated) once more than the one behind it. A text's profile bundles (adds) the vectors
of all its n-grams, a language's prototype those of its training texts; the prediction is the prototype with
the largest cosine. As bundling is linear, the counts of n-grams are added up first: a text costs one pass
over its letters and one product of its counts with the vectors of the n-grams it has.

Training reads every row that may be learnt from. Counts per language and n-gram are summed by Spark, profiles are
bundled in blocks of n-grams and the blocks of a language added up; prototypes (a few kB per language) go to every task.
Letters beyond the basic ones share a bounded number of symbols by hash, so the tables do not grow.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a null language is not learnt
from; with nothing to learn from, every text is ``und`` with score 0; ties go to the smaller language value. Rows
stay rows, and only the columns id, text and lang are read.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from textassay.llm.common import whole

DIMENSIONS = 1024
N = 3
SYMBOLS = 48  # 0: between words, 1-26: a-z, the rest: other letters by hash
UNKNOWN = "und"
SEED = 20
BLOCK = 1 << 20
STEP = 4096  # n-grams whose vectors are in memory at once


def _letters() -> np.ndarray:
    """+1 or -1 for each symbol and dimension."""
    return np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, DIMENSIONS), np.int8) * np.int8(2) - np.int8(1)


def head_vectors(letters: np.ndarray) -> np.ndarray:
    """Bound vectors of what stands before the last letter of an n-gram; a few MB, shared by all texts of a task."""
    heads = np.arange(SYMBOLS ** (N - 1))
    out = np.ones((len(heads), DIMENSIONS), np.int8)
    for turn in range(1, N):
        out *= np.roll(letters, turn, axis=1)[heads // SYMBOLS ** (turn - 1) % SYMBOLS]
    return out


def bundled(grams: np.ndarray, weights: np.ndarray, letters: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Weighted sum of the bound vectors of n-grams given as numbers to the base SYMBOLS, ``STEP`` n-grams at a time."""
    out = np.zeros(DIMENSIONS)
    for i in range(0, len(grams), STEP):
        some = grams[i : i + STEP]
        vectors = heads[some // SYMBOLS] * letters[some % SYMBOLS]
        out += weights[i : i + STEP].astype(np.float32) @ vectors.astype(np.float32)
    return out


def _shared_symbol(point: int) -> int:
    """One of the symbols beyond a-z, by a hash of the code point: neighbours in an alphabet spread over all of them."""
    return 27 + (point * 2654435761 % 2**32 >> 16) % (SYMBOLS - 27)


def _symbol_table() -> np.ndarray:
    """The symbol of each code point below 0x3000; those above are letters or not by ``str.isalpha``."""
    points = np.arange(0x3000)
    table = np.array([_shared_symbol(p) if chr(p).isalpha() else 0 for p in points.tolist()], np.uint8)
    table[97:123] = np.arange(1, 27)
    return table


def gram_counts(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text and their counts; runs of other characters count as one space."""
    total = np.zeros(SYMBOLS**N, np.int32)
    carried = np.zeros(1, np.int64)
    for i in range(0, len(text), BLOCK):
        points = np.frombuffer(text[i : i + BLOCK].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = table[np.minimum(points, len(table) - 1)].astype(np.int64)
        for at in np.flatnonzero(points >= len(table)) if points.max(initial=0) >= len(table) else ():
            symbols[at] = _shared_symbol(int(points[at])) if chr(points[at]).isalpha() else 0
        symbols = np.concatenate((carried, symbols))
        keep = np.concatenate(([True], (symbols[1:] > 0) | (symbols[:-1] > 0)))
        symbols = symbols[keep]
        grams = sum(symbols[j : len(symbols) - N + 1 + j] * SYMBOLS ** (N - 1 - j) for j in range(N))
        total += np.bincount(grams, minlength=len(total)).astype(np.int32)
        carried = symbols[-(N - 1) :]
    total += np.bincount([int(carried[-2:] @ [SYMBOLS**2, SYMBOLS]) if len(carried) > 1 else int(carried[-1]) * SYMBOLS], minlength=len(total)).astype(np.int32)
    total[0] = 0
    found = np.flatnonzero(total)
    return found, total[found]


def training_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, weight): n-gram shares summed over the training texts (lang, text)."""

    def count(batches):
        table, sums = _symbol_table(), {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                grams, counts = gram_counts(text, table)
                if len(grams):
                    sums.setdefault(lang, np.zeros(SYMBOLS**N))[grams] += counts / counts.sum()
            if len(sums) >= 64:  # many languages: hand over what there is
                yield from flush(sums)
        yield from flush(sums)

    def flush(sums):
        for lang, total in sums.items():
            grams = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "gram": grams, "weight": total[grams]})
        sums.clear()

    counted = rows.mapInPandas(count, "lang string, gram bigint, weight double")
    return counted.groupBy("lang", "gram").agg(F.sum("weight").alias("weight"))


def prototypes(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their profiles of length 1; one row per language reaches the driver.

    What all languages have in common tells them apart least: the mean share of an n-gram over the languages is
    taken off.
    """

    def bundle(group: pd.DataFrame) -> pd.DataFrame:
        letters, group = _letters(), group.sort_values("gram")
        weight = group["weight"].to_numpy()
        profile = bundled(group["gram"].to_numpy(), weight, letters, head_vectors(letters))
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "step": [group["step"].iloc[0]], "weight": [weight.sum()], "profile": [profile]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("step")
        profile = np.sum(group["profile"].tolist(), axis=0) / group["weight"].sum()
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "profile": [profile]})

    # At most STEP rows a group, and then one row for each STEP of the SYMBOLS ** N n-grams of a language.
    counted = training_counts(rows).withColumn("step", F.expr(f"gram div {STEP}"))
    parts = counted.groupBy("lang", "step").applyInPandas(bundle, "lang string, step bigint, weight double, profile array<double>")
    made = parts.groupBy("lang").applyInPandas(add, "lang string, profile array<double>").collect()
    if not made:
        return [], np.zeros((0, DIMENSIONS))
    own = sorted((r["lang"], np.array(r["profile"])) for r in made)
    vectors = np.array([v for _, v in own])
    if len(own) > 1:
        # Bundling is linear: the mean of the profiles is the profile of the mean shares.
        vectors = vectors - vectors.mean(axis=0)
    return [lang for lang, _ in own], vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def predictor(langs: list[str], vectors: np.ndarray):
    """Arrow UDF text -> (lang_pred, score, lettered); ``lettered`` tells whether the text has a letter.

    Declared nondeterministic: else a filter on its result is pushed below and every text predicted twice, by twice the workers.
    """

    @pandas_udf("lang_pred string, score double, lettered boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table, letters = _symbol_table(), _letters()
        heads = head_vectors(letters)

        def said(text: str) -> tuple[str, float, bool]:
            grams, counts = gram_counts(text, table)
            if not len(grams) or not langs:
                return UNKNOWN, 0.0, len(grams) > 0
            profile = bundled(grams, counts, letters, heads)
            scores = vectors @ (profile / max(float(np.linalg.norm(profile)), 1e-12))
            best = int(np.argmax(scores))
            return langs[best], float(min(max(scores[best], 0.0), 1.0)), True

        for texts in batches:
            yield pd.DataFrame([said(t) for t in texts], columns=["lang_pred", "score", "lettered"])

    return predict.asNondeterministic()


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def identify(df: DataFrame, train: DataFrame, text_col: str = "text", names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """``df`` with prediction and score under ``names``, which replace columns so named; learnt from (text, lang) rows of ``train``.

    A third name adds whether the text has a letter, which does not depend on what could be learnt.
    Runs the training when called.
    """
    rows = train.where("text is not null and lang is not null").select("lang", "text")
    langs, vectors = prototypes(rows)
    said = predictor(langs, vectors)(whole(text_col)).alias("_said")
    kept = [c for c in df.columns if c not in names]
    fields = zip(("lang_pred", "score", "lettered"), names, strict=False)
    return df.select(*kept, said).select(*kept, *[F.col(f"_said.{field}").alias(name) for field, name in fields])


def language_report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learnt from those that are not held out."""
    train = docs.where(~held_out()).select("text", "lang")
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(rows, train).select("doc_id", "held_out", "lang_pred", "score")
