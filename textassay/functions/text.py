"""Row-local text expressions. All of them stay in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from textassay.functions import patterns as P
from textassay.runtime import bind


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_spaces(c) -> Column:
    return F.trim(F.regexp_replace(_col(c), f"{P.SPACE}+", " "))


def replace_tags(text: Column, replacement: str) -> Column:
    """Every ``<...>`` replaced.

    No tag can start after the last ``>``. Leaving that tail out keeps the search linear: each ``<``
    before it finds its end, while a tail of unclosed ``<`` would be scanned once for each of them.
    """
    tail = F.substring_index(text, ">", -1)
    head = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
    return F.concat(F.regexp_replace(head, P.HTML_TAG, replacement), tail)


def html_strip(c) -> Column:
    """Tags become a space, runs of whitespace collapse, ends are trimmed; NULL becomes ''."""
    return collapse_spaces(replace_tags(F.coalesce(_col(c), F.lit("")), " "))


def html_ratio(c) -> Column:
    """Share of the code points that belong to tags; 0 for empty or NULL."""
    size = F.length(_col(c))
    rest = F.length(replace_tags(_col(c), ""))
    return F.when(size > 0, (size - rest) / size).otherwise(F.lit(0.0))


def is_blank(c) -> Column:
    return _col(c).isNull() | ~_col(c).rlike(P.NOT_SPACE)


def snippet(c, size: int = 100) -> Column:
    text = _col(c)
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def tox_tokens(c) -> Column:
    """Lower-case tokens; characters outside the alphabet are deleted, not replaced by a space."""
    kept = collapse_spaces(F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), P.NOT_TOKEN_CHARS, ""))
    # Single blanks only, so the one empty token to avoid is that of an empty text.
    return bind(kept, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " ")))


def shingle_normalize(c) -> Column:
    """Lower case, letters, digits and single spaces only. NULL stays NULL."""
    return collapse_spaces(F.regexp_replace(F.lower(_col(c)), P.NOT_SHINGLE_CHARS, ""))


def shingles_of(normalized, n: int = 5) -> Column:
    """Distinct character n-grams of a normalised text.

    A text shorter than ``n`` is its own single shingle, NULL has none. A match captures
    ``n`` characters ahead and then consumes one whole code point, so one linear pass finds all
    n-grams (``substring`` would walk from the start for every one).
    """
    text = _col(normalized)
    grams = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))
    return (
        F.when(text.isNull(), F.array().cast("array<string>"))
        .when(F.length(text) < n, F.array(text))
        .otherwise(F.array_distinct(grams))
    )


def shingles(c, n: int = 5) -> Column:
    return shingles_of(shingle_normalize(c), n)


def percent_label(c, digits: int = 2) -> Column:
    return _label(c, digits, "%%")


def number_label(c, digits: int = 4) -> Column:
    return _label(c, digits)


def _label(c, digits: int, unit: str = "") -> Column:
    # format_string renders NULL as "null", so it is kept away from NULL.
    text = F.format_string(f"%.{digits}f{unit}", F.bround(_col(c), digits))
    return F.when(_col(c).isNotNull(), text).otherwise(F.lit("N/A"))
