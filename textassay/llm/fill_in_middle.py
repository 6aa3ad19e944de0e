"""Fill-in-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` keeps every repetition of the group: the ends of its captures are the borders of all
units, so their number gives n and two look-ups give both cuts. The match runs in an Arrow UDF that returns n and the
two cuts (code points) only; hashes, cutting, joining and restoring are built-in functions.

The library keeps some 200 bytes for a capture, so a text is matched in pieces of about ``PIECE`` code points, cut
where a word ends and blanks begin; a unit never reaches across such a place, so the borders are the same.

Defined cases: null text counts as empty and stays plain; a null id is hashed as an empty string; repeated rows stay
rows, with equal results for equal rows; an empty table gives an empty table. Columns of the input are kept unless a
result column has their name, which then replaces them.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from textassay.llm.common import whole

SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
FORM_PERCENT = 50  # of the texts that can be cut
SPM_PERCENT = 80  # of those that are
PIECE = 1 << 18

_UNITS = regex.compile(f"({UNIT})*")
_WORD_END = regex.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")


def unit_ends(text: str, piece: int = PIECE) -> np.ndarray:
    """The end of every unit of the text, in code points; none for an empty text."""
    found, start = [np.zeros(0, np.int64)], 0
    while start < len(text):
        border = _WORD_END.search(text, start + piece) if len(text) - start > piece else None
        stop = border.start() if border else len(text)
        ends = _UNITS.fullmatch(text, start, stop).ends(1)
        found.append(np.array(ends, np.int64))
        start = stop
    return np.concatenate(found)


def cuts_udf(piece: int = PIECE):
    @pandas_udf("n bigint, first bigint, second bigint")
    def cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, one, other in batches:
            rows = []
            for text, a, b in zip(texts, one, other, strict=True):
                ends = np.concatenate(([0], unit_ends(text, piece)))
                n = len(ends) - 1
                low, high = sorted((int(a) % (n + 1), int(b) % (n + 1)))
                rows.append((n, int(ends[low]), int(ends[high])))
            yield pd.DataFrame(rows, columns=["n", "first", "second"])

    return cuts


def _draws(id_col: str, seed: int) -> list[Column]:
    """Four 32-bit numbers that depend on seed and id only."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, percent: int = FORM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``df`` with n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output.

    A narrow step. A text that is empty or holds one of the marks stays plain, and so does the rest of ``percent``.
    """
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [F.col(c) for c in df.columns if c not in made]
    text, (h1, h2, h3, h4) = whole(text_col), _draws(id_col, seed)
    plain = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (h3 % 100 >= percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    rows = df.select(*kept, text.alias("_whole"), form.alias("form"), cuts_udf()(text, h1, h2).alias("_cut"))
    at, until = F.col("_cut.first"), F.col("_cut.second")

    def part(start: Column, size: Column) -> Column:
        return F.substring("_whole", start.cast("int") + 1, size.cast("int"))

    prefix, middle, suffix = part(F.lit(0), at), part(at, until - at), part(until, F.length("_whole") - until)
    output = (
        F.when(F.col("form") == "plain", F.col("_whole"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    cut = F.col("form") != "plain"
    names = [c for c in df.columns if c not in made]
    return rows.select(
        *names, F.col("_cut.n").alias("n"), "form", F.when(cut, at).alias("prefix_chars"), F.when(cut, until - at).alias("middle_chars"),
        output.alias("output"),
    )


def restore(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text behind an output of ``transform``, from the output and its form alone."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    body = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
    psm, spm = (F.split(body, f"{mark}|{MIDDLE}", 3) for mark in (SUFFIX, PREFIX))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(F.get(psm, F.lit(0)), F.get(psm, F.lit(2)), F.get(psm, F.lit(1))))
        .otherwise(F.concat(F.get(spm, F.lit(1)), F.get(spm, F.lit(2)), F.get(spm, F.lit(0))))
    )


def fill_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every document."""
    done = transform(docs.select("doc_id", "text"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(), 256).alias("restored_sha256")
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)
