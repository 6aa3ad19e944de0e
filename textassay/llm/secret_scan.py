"""Secret scans: three fixed kinds of spans, and sliding-window Shannon entropy over candidate strings.

A narrow step of DataFrame functions: no shuffle, no Python. The spans of a pattern follow from the pieces
between its matches: ``split`` and ``regexp_extract_all`` walk the same leftmost non-overlapping matches,
so a match starts where the pieces and matches before it end. Positions are code points, end exclusive. Running
sums and maxima over a text's matches go by chunks, so time is close to linear in the length of a text and in its matches.

Entropy: every maximal run of ``[A-Za-z0-9+/_=-]`` of at least ``WINDOW`` characters is a candidate. A
window of that width slides over it. The counts of its characters are kept in packed numbers, five bits a
character, and its sum of c*log2(c) beside them: the leaving and the entering character change two counts, all others
stay. The entropy of a window is log2(WINDOW) - sum/WINDOW. A candidate is a secret if its largest window entropy reaches the limit of its
character class (hexadecimal, letters and digits, all). Allow-listed candidates are suppressed: words and
paths of words, numbers, UUIDs, strings with EXAMPLE, and digests announced by ``sha256:`` and the like.

Defined cases: a null or empty text has no span and the digest of the empty string; rows are kept as they
are, repeated ones included; an empty table gives an empty table; other columns of the input are not read.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textassay.llm.common import whole
from textassay.runtime import bind

# Fixed values of the base kinds: pattern, group that is measured, least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)

def _may_hold(text: Column, kind: str) -> Column:
    """True wherever a match of the kind passes its length; only saves work, plain searches being the cheapest."""
    if kind == "assign":
        return (text.contains(":") | text.contains("=")) & text.rlike(KINDS[0][1])
    if kind == "access":
        return text.contains("AKIA")
    return text.rlike(r"[0-9a-f]{24}")


WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
LIMITS = (("^[0-9A-Fa-f]+$", 3.0), ("^[0-9A-Za-z]+$", 3.7), ("", 3.8))
ALLOWED = (
    r"^[0-9+/_=-]+$",
    r"^[/+_=-]*+[A-Za-z]?+[a-z]*+(?:[/+_=-]++[A-Za-z]?+[a-z]*+)*+$",
    r"^[A-Z]++(?:[/+_=-]++[A-Z]*+)*+$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example",
)
MASK = "[SECRET]"
CHUNK = 512
# Patterns that find the same spans as the base ones without the short matches, which are dropped anyway: no match
# within a run that is too short can be long enough.
LONG_ENOUGH = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
FIRST_CODE, COUNT_BITS, COUNTS_A_WORD, WORDS = ord("+"), 5, 12, 7
UNIT = 10**12


def running(items: Column, value, merge, zero: int) -> Column:
    """Array of (item, before): ``before`` merges the values of all earlier items; ``merge`` is associative, on integers.

    Within a chunk the array grows item by item, and so does the array of the chunks' beginnings; nothing else is copied.
    """
    start = F.lit(zero)

    def spread(chunk: Column, base: Column) -> Column:
        # One item, as there is no empty array of a type that is only known to the engine.
        head = F.transform(F.slice(chunk, 1, 1), lambda x: F.struct(x.alias("item"), base.alias("before")))
        first = F.struct(merge(base, value(chunk[0])).alias("acc"), head.alias("out"))

        def step(state, x):
            row = F.struct(x.alias("item"), state["acc"].alias("before"))
            return F.struct(merge(state["acc"], value(x)).alias("acc"), F.concat(state["out"], F.array(row)).alias("out"))

        return F.aggregate(F.slice(chunk, 2, CHUNK), first, step, lambda state: state["out"])

    def with_chunks(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, start, lambda acc, x: merge(acc, value(x))))
        begin = F.aggregate(totals, F.array(start), lambda acc, x: F.concat(acc, F.array(merge(F.element_at(acc, -1), x))))
        return bind(begin, lambda bases: F.flatten(F.transform(chunks, lambda c, i: spread(c, F.get(bases, i)))))

    def cut(everything: Column) -> Column:
        last = F.floor((F.size(everything) - 1) / CHUNK).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(everything, i * CHUNK + 1, CHUNK))
        return bind(F.filter(chunks, lambda c: F.size(c) > 0), with_chunks)

    return bind(items, cut)


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Array of (start, end, measured) of the matches of ``pattern``, in order."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )
    # The last gap has no match behind it.
    sized = F.transform(pieces, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), x["part"].alias("part")))
    steps = running(sized, lambda x: x["gap"] + F.coalesce(x["hit"], F.lit(0)), lambda a, b: a + b, 0)

    def row(x):
        start = x["before"] + x["item"]["gap"]
        return F.struct(start.alias("start"), (start + x["item"]["hit"]).alias("end"), x["item"]["part"].alias("part"))

    return F.transform(F.filter(steps, lambda x: x["item"]["hit"].isNotNull()), row)


def entropy_peak(s: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits) of a window of ``s``, of the characters of CANDIDATE; 0 for strings shorter than the window."""
    cost = F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0).cast("bigint") for c in range(window + 1)])
    one = F.lit(1).cast("bigint")

    def place(character: Column) -> Column:
        return F.struct(F.floor(character / COUNTS_A_WORD).cast("int").alias("word"), (character % COUNTS_A_WORD * COUNT_BITS).alias("bit"))

    def shifted(bit: Column) -> Column:
        return F.call_function("shiftleft", one, bit)

    def count(words: Column, at: Column) -> Column:
        return F.call_function("shiftright", F.get(words, at["word"]), at["bit"]).bitwiseAND(F.lit(2**COUNT_BITS - 1).cast("bigint")).cast("int")

    def slide(codes: Column):
        def enter(words, total, at):
            n = count(words, at)
            new = F.transform(words, lambda w, j: F.when(j == at["word"], w + shifted(at["bit"])).otherwise(w))
            return F.struct(new.alias("words"), (total + F.get(cost, n + 1) - F.get(cost, n)).alias("sum"))

        def leave(words, total, at):
            n = count(words, at)
            new = F.transform(words, lambda w, j: F.when(j == at["word"], w - shifted(at["bit"])).otherwise(w))
            return F.struct(new.alias("words"), (total + F.get(cost, n - 1) - F.get(cost, n)).alias("sum"))

        def step(state, i):
            kept = F.when(i >= window, leave(state["words"], state["sum"], F.get(codes, i - window))).otherwise(
                F.struct(state["words"].alias("words"), state["sum"].alias("sum"))
            )
            now = bind(kept, lambda x: enter(x["words"], x["sum"], F.get(codes, i)))
            best = lambda x: F.when(i >= window - 1, F.least(state["best"], x["sum"])).otherwise(state["best"])
            return bind(now, lambda x: F.struct(x["words"].alias("words"), x["sum"].alias("sum"), best(x).alias("best")))

        zero = F.lit(0).cast("bigint")
        start = F.struct(F.array(*[zero] * WORDS).alias("words"), zero.alias("sum"), F.lit(2**62).cast("bigint").alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda x: x["best"])

    codes = F.transform(F.split(s, ""), lambda c: place(F.ascii(c) - FIRST_CODE))
    peak = F.log2(F.lit(float(window))) - bind(codes, slide) / (float(UNIT) * window)
    return F.when(F.length(s) >= window, F.greatest(peak, F.lit(0.0))).otherwise(0.0)


def is_allowed(s: Column) -> Column:
    hit = F.lit(False)
    for pattern in ALLOWED:
        hit = hit | s.rlike(pattern)
    return hit


def is_random(s: Column, window: int = WINDOW) -> Column:
    limit = F.lit(LIMITS[-1][1])
    for pattern, value in reversed(LIMITS[:-1]):
        limit = F.when(s.rlike(pattern), value).otherwise(limit)
    return entropy_peak(s, window) >= limit


SPAN = "struct<start:int,kind_no:int,end:int,kind:string>"


def _none(kind: str = SPAN) -> Column:
    return F.array().cast(f"array<{kind}>")


def _span(no: int, kind: str):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(no).alias("kind_no"), x["end"].alias("end"), F.lit(kind).alias("kind"))


def _at_least(n: int):
    return lambda x: F.length(x["part"]) >= n


def _apart(base: Column, found: Column) -> Column:
    """Those of the matches ``found`` that overlap no span of ``base``: no earlier one ends behind their start, and no later one
    starts before their end."""
    never = 2**31 - 1
    sides = F.concat(
        F.transform(base, lambda x: F.struct(x["start"].alias("start"), F.lit(0).alias("side"), x["end"].alias("end"), F.lit("").alias("part"))),
        F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(1).alias("side"), x["end"].alias("end"), x["part"].alias("part"))),
    )
    ended = running(F.array_sort(sides), lambda x: F.when(x["side"] == 0, x["end"]).otherwise(0), F.greatest, 0)
    ahead = running(F.reverse(ended), lambda x: F.when(x["item"]["side"] == 0, x["item"]["start"]).otherwise(never), F.least, never)
    inner = lambda x: x["item"]["item"]
    free = F.filter(ahead, lambda x: (inner(x)["side"] == 1) & (x["item"]["before"] <= inner(x)["start"]) & (x["before"] >= inner(x)["end"]))
    return F.transform(free, inner)


def secret_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``_base_spans`` and ``_all_spans``: arrays of (start, kind_no, end, kind), ordered by start, then kind."""
    text = whole(text_col)
    by_kind = []
    for no, (kind, pattern, group, least) in enumerate(KINDS):
        hits = F.filter(_matches(text, LONG_ENOUGH.get(kind, pattern), group), _at_least(least))
        spans = F.transform(hits, _span(no, kind))
        by_kind.append(F.when(_may_hold(text, kind), spans).otherwise(_none()))
    df = df.withColumn("_base_spans", F.array_sort(F.concat(*by_kind)))
    found = F.filter(_matches(text, CANDIDATE, 0), lambda x: ~is_allowed(x["part"]))
    fresh = bind(found, lambda hits: F.when(F.size("_base_spans") == 0, hits).otherwise(_plain(_apart(F.col("_base_spans"), hits))))
    random = F.filter(fresh, lambda x: F.when(is_random(x["part"]), True).otherwise(False))
    added = F.transform(random, _span(len(KINDS), "entropy"))
    return df.withColumn("_all_spans", F.array_sort(F.concat("_base_spans", F.when(text.rlike(CANDIDATE), added).otherwise(_none()))))


def _plain(matches: Column) -> Column:
    return F.transform(matches, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["part"].alias("part")))


def spans_text(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")


def scan_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans), one row per row."""
    found = secret_spans(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return found.select(
        "doc_id", *[count_kind("_base_spans", kind).alias(f"n_{kind}") for kind, *_ in KINDS],
        count_kind("_all_spans", "entropy").alias("n_entropy"),
        F.sha2(spans_text("_base_spans"), 256).alias("base_sha256"), spans_text("_all_spans").alias("spans"),
    )


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by MASK (overlapping spans by one).

    Null stays null and empty stays empty; rows, repeated ones included, and all other columns stay as they are, but for
    columns named ``_base_spans`` or ``_all_spans``, which are dropped; an empty table gives an empty table.
    """
    found = secret_spans(df, text_col)
    text = F.col(text_col)

    def cleaned(characters: Column) -> Column:
        def piece(x):
            gap = F.array_join(F.slice(characters, x["before"] + 1, F.greatest(x["item"]["start"] - x["before"], F.lit(0))), "")
            return F.concat(gap, F.when(x["item"]["start"] >= x["before"], F.lit(MASK)).otherwise(""))

        def joined(spans: Column) -> Column:
            end = F.array_max(F.transform(spans, lambda x: x["item"]["end"]))
            tail = F.array_join(F.slice(characters, end + 1, F.size(characters)), "")
            return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

        return bind(running(F.col("_all_spans"), lambda x: x["end"], F.greatest, 0), joined)

    clean = bind(F.split(text, ""), cleaned)
    return found.withColumn(text_col, F.when(F.size("_all_spans") > 0, clean).otherwise(text)).drop("_base_spans", "_all_spans")
