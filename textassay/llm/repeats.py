"""Removal of repeated passages by distributed prefix-free parsing.

Every byte covered by a string of ``WINDOW`` bytes that also starts elsewhere in the corpus is removed. Positions are put in
corpus order by their next ``WINDOW`` bytes as far as it takes to tell equal ones; nothing is ever sorted
per position where the parse already knows the answer:

1. *Parse.* A rolling hash of ``TRIGGER`` bytes marks triggers; from one trigger to the next runs a phrase (with the next
   trigger's bytes, so that no phrase is a prefix of another). The dictionary counts the phrases. A window that
   holds a phrase of count 1 in full is unique, which settles most of the corpus.
2. *Order of the parse.* What is left falls into segments: runs of positions with the same first trigger behind
   them. A segment's class is its suffix of the parse, cut where the last of its windows ends. Positions of
   segments with equal classes are equal one by one, so all windows of a class of 2 or more are repeated.
3. *Order of the dictionary.* Segments of a class of 1 can only equal others at the same trigger with the same phrase behind
   it. These few are brought together by that phrase, along with one member of each larger class, their
   suffixes are put in order by their window, and equal neighbours are repeated. Where more than ``CROWDED`` of
   them share a phrase, they are not brought together: Spark counts the 128-bit hashes of their single windows.

Shuffled are phrase hashes, class hashes (128 bits) and the contexts of step 3; texts are dealt out once, into
a bucketed table in the shared folder, and joined there without moving again. A phrase in a third of all
documents is pre-aggregated by task and document, and the joins on it can be split. Work and memory per text go
by blocks, so a text may be of any length. Rows are keyed by a hash of id and text, so that rows without an id, or
with one id, do not meet; texts that share a key share what is known of their phrases, which changes no result.

Defined cases: null text counts as empty; texts below ``WINDOW`` bytes keep everything; rows stay rows, so a repeated row
of at least that length loses all of it; null and repeated ids stay as they are; an empty table gives an empty table. Other
columns are not read.
"""

import hashlib
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textassay.llm.common import materialize, whole
from textassay.runtime import scratch_path

WINDOW = 200
TRIGGER = 12
MEAN_PHRASE = 32
KEY = 100  # longest part of a phrase that is counted
BLOCK = 1 << 21
MARGIN = 2 * WINDOW
CROWDED = 16_384  # segments of one phrase that one task takes at once: at most some 100 MB with the hashes of their windows
# Phrases are counted by so many bits: a coincidence only makes a phrase count as a repeated one, which leaves more windows open.
PHRASE_BITS = np.int64((1 << 48) - 1)
_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_tables: dict[int, list[np.ndarray]] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0xA0761D6478BD642F))


def _powers(base: int, n: int) -> list[np.ndarray]:
    """Powers of ``base`` and of its inverse, modulo 2^64."""
    if base not in _tables or len(_tables[base][0]) < n:
        size = max(n, 1 << 16)
        _tables[base] = [np.cumprod(np.append(_U(1), np.full(size - 1, b, np.uint64))) for b in (base, pow(base, -1, 1 << 64))]
    return _tables[base]


class Block:
    """A stretch of a text: its triggers, phrases and hashes of any of its ranges."""

    def __init__(self, raw: np.ndarray):
        self.n = len(raw)
        self.values = _BYTES[raw]
        self.sums: dict[int, np.ndarray] = {}

    def prefix(self, which: int) -> np.ndarray:
        if which not in self.sums:
            inverse = _powers(_BASES[which], self.n + 1)[1]
            sums = self.sums[which] = np.zeros(self.n + 1, np.uint64)
            np.cumsum(self.values * inverse[: self.n], out=sums[1:])
        return self.sums[which]

    @cached_property
    def t(self) -> np.ndarray:
        """Positions of triggers."""
        count = self.n - TRIGGER + 1
        if count < 1:
            return np.zeros(0, int)
        sums = self.prefix(0)
        rolling = (sums[TRIGGER:] - sums[:count]) * _powers(_BASES[0], self.n + 1)[0][:count]
        # The highest bits of a product depend on all bits below.
        return np.flatnonzero(rolling * _U(_BASES[1]) < _U(2**64 // MEAN_PHRASE))

    def hash(self, a: np.ndarray, b: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of the ranges [a, b), as signed numbers."""
        base, sums = _BASES[which], self.prefix(which)
        value = (sums[b] - sums[a]) * _powers(base, self.n + 1)[0][a]
        return _mix(value + (b - a).astype(np.uint64) * _U(base)).view(np.int64)

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, hash) of what is counted: phrases cut at KEY bytes, and the KEY bytes before the end of a long phrase."""
        t = self.t
        end = np.minimum(np.append(t[1:] + TRIGGER, self.n + KEY), t + KEY)
        ok = end <= self.n
        forward = t[ok], end[ok]
        first = t + TRIGGER - KEY
        far = (first >= 0) & (np.append(KEY, np.diff(t)) > KEY - TRIGGER)
        backward = first[far], t[far] + TRIGGER
        a, b = (np.concatenate(x) for x in zip(forward, backward, strict=True))
        # A phrase that ends at a trigger and one that ends at KEY bytes are told apart by their length alone.
        return a, b, self.hash(a, b) & PHRASE_BITS

    def survivors(self, low: int, high: int, known: np.ndarray) -> np.ndarray:
        """Starts in [low, high) of windows in which every phrase held in full is in ``known`` (sorted)."""
        high = min(high, self.n - WINDOW + 1)
        if high <= low:
            return np.zeros(0, int)
        a, b, h = self.phrases()
        alone = np.ones(len(h), bool) if not len(known) else known[np.minimum(np.searchsorted(known, h), len(known) - 1)] != h
        first, last = np.maximum(b[alone] - WINDOW, low), np.minimum(a[alone], high - 1)
        hit = first <= last
        size = high - low + 1
        dead = np.bincount(first[hit] - low, minlength=size) - np.bincount(last[hit] + 1 - low, minlength=size)
        return np.flatnonzero(np.cumsum(dead[:-1]) == 0) + low

    def _placed(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For window starts: number and position of the first trigger behind, and how near it is."""
        after = np.searchsorted(self.t, starts)
        t = np.append(self.t, self.n + WINDOW)[after]
        return after, t, np.where(t - starts <= KEY, 2, np.where(t + TRIGGER <= starts + WINDOW, 1, 0))

    def segments(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, count) of the segments of sorted window starts."""
        if not len(starts):
            return starts, starts
        after, _, kind = self._placed(starts)
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(starts) > 1) | (np.diff(after) > 0) | (np.diff(kind) != 0) | (kind[1:] == 0)
        at = np.flatnonzero(new)
        return starts[at], np.diff(np.append(at, len(starts)))

    def groups(self, starts: np.ndarray) -> np.ndarray:
        """For the starts of segments a hash that equal windows share; 0 for windows without a trigger, segments of their own."""
        after, t, kind = self._placed(starts)
        group = np.zeros(len(starts), np.int64)
        full, part = kind == 2, kind == 1
        following = np.append(self.t, [self.n + 2 * WINDOW] * 2)[after + 1]
        end = np.minimum(np.minimum(following + TRIGGER, t + KEY), self.n)
        group[full] = self.hash(t[full], end[full])
        group[part] = self.hash(t[part], t[part] + TRIGGER) ^ 0x55
        return group


def blocks(raw: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(offset, low, high, bytes): stretches whose own positions are offset + [low, high), with a margin around them."""
    for start in range(0, len(raw), BLOCK):
        offset = max(0, start - MARGIN)
        stop = min(len(raw), start + BLOCK)
        yield offset, start - offset, stop - offset, raw[offset : min(len(raw), stop + MARGIN)]


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def phrase_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different phrase hashes of a text, and 1 or 2 for once or more often."""
    found = []
    for _, low, high, part in blocks(raw):
        a, _, h = Block(part).phrases()
        found.append(h[(a >= low) & (a < high)])
    values, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
    return values, np.minimum(counts, 2)


def text_segments(raw: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and numbers of windows of the segments that phrase counts leave open."""
    out = [(np.zeros(0, int), np.zeros(0, int))]
    for offset, low, high, part in blocks(raw):
        if len(part) >= WINDOW:
            block = Block(part)
            starts, counts = block.segments(block.survivors(low, high, known))
            out.append((starts + offset, counts))
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def classes(raw: np.ndarray, starts: np.ndarray, counts: np.ndarray, wanted: tuple[str, ...] = ("z1", "z2", "g")) -> list[np.ndarray]:
    """Hashes of the given segments: z1 and z2 of all that their windows hold, g of the phrase behind them."""
    out = [[np.zeros(0, np.int64)] * len(wanted)]
    for offset, low, high, part in blocks(raw):
        mine = (starts >= offset + low) & (starts < offset + high)
        if mine.any():
            block = Block(part)
            a = starts[mine] - offset
            ends = a + counts[mine] - 1 + WINDOW
            out.append([block.groups(a) if name == "g" else block.hash(a, ends, int(name == "z2")) for name in wanted])
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def segment_windows(raw: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window of the given segments, segment by segment."""
    out = [[np.zeros(0, np.int64)] * 2]
    for offset, low, high, part in blocks(raw):
        mine = (starts >= offset + low) & (starts < offset + high)
        if mine.any():
            block, n = Block(part), counts[mine]
            at = np.arange(n.sum()) + np.repeat(starts[mine] - offset - np.cumsum(n) + n, n)
            out.append([block.hash(at, at + WINDOW, which) for which in (0, 1)])
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def repeated_windows(contexts: list[bytes], twice: np.ndarray) -> list[np.ndarray]:
    """For each context, which of its windows occurs more than once in all contexts; those of ``twice`` count double."""
    sizes = np.array([len(c) - WINDOW + 1 for c in contexts])
    prints, some, room = [], [], 0
    for i, c in enumerate(contexts):  # hashed many at a time; a window never reaches into the next context
        some.append(c)
        room += len(c)
        if room > BLOCK or i + 1 == len(contexts):
            block = Block(np.frombuffer(b"".join(some), np.uint8))
            starts = np.cumsum([0, *map(len, some[:-1])])
            counts = np.array([len(x) - WINDOW + 1 for x in some])
            at = np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
            prints.append(np.column_stack([block.hash(at, at + WINDOW), block.hash(at, at + WINDOW, 1)]))
            some, room = [], 0
    rows = np.concatenate(prints)
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    fresh = np.append(True, (rows[order[1:]] != rows[order[:-1]]).any(axis=1))
    which = np.empty(len(rows), np.int64)
    which[order] = np.cumsum(fresh) - 1
    weight = np.bincount(which, weights=np.repeat(np.where(twice, 2, 1), sizes))
    return np.split(weight[which] > 1, np.cumsum(sizes)[:-1])


def _arrays(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    """The arrays of a list column as numpy arrays, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [np.array(x.as_py() or [], np.int64) for x in column] if not isinstance(column, pa.ListArray) else [
        column.values[a:b].to_numpy(zero_copy_only=False) for a, b in zip(column.offsets.to_pylist()[:-1], column.offsets.to_pylist()[1:], strict=True)
    ]


def _rows(columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _flat(k: list[int], parts: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    """One row per element of parallel arrays, each with the id of its text."""
    first = next(iter(parts.values()))
    ids = np.repeat(np.array(k, np.int64), [len(x) for x in first])
    joined = {name: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for name, x in parts.items()}
    return pa.RecordBatch.from_pydict({"k": pa.array(ids)} | joined)


def _emit_phrases(batches):
    for batch in batches:
        found = [phrase_hashes(_bytes(t)) for t in batch.column("text").to_pylist()]
        yield _flat(batch.column("k").to_pylist(), {"h": [v for v, _ in found], "n": [n for _, n in found]})


def _emit_segments(batches):
    for batch in batches:
        texts, known = batch.column("text").to_pylist(), _arrays(batch, "known")
        rows = {c: batch.column(c) for c in ("k", "doc_id", "text")} | {"n_bytes": [], "starts": [], "counts": []}
        for text, hashes in zip(texts, known, strict=True):
            raw = _bytes(text)
            starts, counts = text_segments(raw, np.sort(hashes))
            rows["n_bytes"].append(len(raw))
            rows["starts"].append(starts.astype(np.int64))
            rows["counts"].append(counts.astype(np.int64))
        yield _rows(rows)


def _emit_classes(*wanted: str):
    def emit(batches):
        for batch in batches:
            texts = zip(batch.column("text").to_pylist(), _arrays(batch, "starts"), _arrays(batch, "counts"), strict=True)
            found = [classes(_bytes(text), starts, counts, wanted) for text, starts, counts in texts]
            yield _flat(batch.column("k").to_pylist(), {name: [f[i] for f in found] for i, name in enumerate(wanted)})

    return emit


def _emit_contexts(batches):
    for batch in batches:
        out = {"g": [], "k": [], "z1": [], "twice": [], "context": []}
        columns = [batch.column("k").to_pylist(), batch.column("text").to_pylist(), *(_arrays(batch, c) for c in ("starts", "counts", "many", "shown", "wide"))]
        for k, text, starts, counts, many, shown, wide in zip(*columns, strict=True):
            raw = _bytes(text)
            z1, group = classes(raw, starts, counts, ("z1", "g"))
            several = np.isin(z1, many)
            for i in np.flatnonzero((group != 0) & (~several | np.isin(z1, shown)) & ~np.isin(z1, wide)):
                out["g"].append(int(group[i]))
                out["k"].append(k)
                out["z1"].append(int(z1[i]))
                out["twice"].append(bool(several[i]))
                out["context"].append(raw[starts[i] : starts[i] + counts[i] - 1 + WINDOW].tobytes())
        types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))


def _emit_windows(batches):
    """Every window of the segments of crowded groups: its hashes, where it is, and 2 where its segment is known to recur."""
    for batch in batches:
        ids, parts = [], {"w1": [], "w2": [], "z1": [], "low": [], "n": []}
        columns = [batch.column("k").to_pylist(), batch.column("text").to_pylist(), *(_arrays(batch, c) for c in ("starts", "counts", "many", "wide"))]
        for k, text, starts, counts, many, wide in zip(*columns, strict=True):
            raw = _bytes(text)
            (z1,) = classes(raw, starts, counts, ("z1",))
            mine = np.isin(z1, wide)
            n = counts[mine]
            ids.append(k)
            low = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            values = (*segment_windows(raw, starts[mine], n), np.repeat(z1[mine], n), low, np.repeat(np.where(np.isin(z1[mine], many), 2, 1), n))
            for column, value in zip(parts.values(), values, strict=True):
                column.append(value.astype(np.int64))
        yield _flat(ids, parts)


def _order_suffixes(batches):
    """Rows come sorted by group, of at most CROWDED rows; one is worked on when the next begins or the input ends."""
    held = {"g": [], "k": [], "z1": [], "twice": [], "context": []}

    def flush(n: int):
        twice = np.array(held["twice"][:n], bool)
        out = {"k": [], "z1": [], "low": [], "high": []}
        # Single segments of a lone group have nothing to be equal to but themselves.
        for i, hit in enumerate(repeated_windows(held["context"][:n], twice)):
            if not twice[i] and hit.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
                    for name, value in (("k", held["k"][i]), ("z1", held["z1"][i]), ("low", a), ("high", b)):
                        out[name].append(value)
        for column in held.values():
            del column[:n]
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})

    for batch in batches:
        for name, column in held.items():
            column += batch.column(name).to_pylist()
        groups = np.array(held["g"])
        n = int(np.searchsorted(groups, groups[-1])) if len(groups) else 0
        if n:
            yield flush(n)
    if held["g"]:
        yield flush(len(held["g"]))


def _removed(batches):
    for batch in batches:
        rows = {c: batch.column(c) for c in ("doc_id", "n_bytes")} | {"n_removed": [], "n_spans": [], "kept_sha256": []}
        names = ("starts", "counts", "many", "z1s", "lows", "highs")
        for text, starts, counts, many, z1s, lows, highs in zip(batch.column("text").to_pylist(), *(_arrays(batch, c) for c in names), strict=True):
            raw = _bytes(text)
            gone = np.zeros(len(raw) + 1, np.int32)
            if len(starts):
                (z1,) = classes(raw, starts, counts, ("z1",))
                several = np.isin(z1, many)
                np.add.at(gone, starts[several], 1)
                np.add.at(gone, (starts + counts - 1 + WINDOW)[several], -1)
                if len(z1s):
                    order = np.argsort(z1, kind="stable")
                    left, right = np.searchsorted(z1[order], z1s), np.searchsorted(z1[order], z1s, "right")
                    for a, b, low, high in zip(left, right, lows, highs, strict=True):
                        for i in order[a:b]:
                            gone[starts[i] + low] += 1
                            gone[starts[i] + high - 1 + WINDOW] -= 1
            cut = np.cumsum(gone[:-1]) > 0
            rows["n_removed"].append(int(cut.sum()))
            rows["n_spans"].append(int((np.diff(np.concatenate(([0], cut.view(np.int8)))) == 1).sum()))
            rows["kept_sha256"].append(hashlib.sha256(raw[~cut].tobytes()).hexdigest())
        yield _rows(rows)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row. Runs jobs when called."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), whole(text_col).alias("text"))
    # 40 bits travel lighter than 64, and keys may coincide.
    docs = docs.select(F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 24).alias("k"), "doc_id", "text")

    # 1. The dictionary: which phrases occur more than once. A phrase goes out once per text.
    phrases = docs.select("k", "text").mapInArrow(_emit_phrases, "k bigint, h bigint, n bigint")
    common = phrases.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    known = phrases.select("k", "h").join(common, "h").groupBy("k").agg(F.collect_set("h").alias("known"))

    # Texts with their open segments, in buckets by key: the joins below do not move them again.
    found = "k bigint, doc_id bigint, text string, n_bytes bigint, starts array<bigint>, counts array<bigint>"
    met = docs.join(known, "k", "left").mapInArrow(_emit_segments, found)
    name, buckets = f"repeats_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    met.write.bucketBy(buckets, "k").sortBy("k").option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name)
    texts = spark.table(name)

    # 2. The parse: classes of segments. Keys tell which member of a class shows its context in step 3.
    open_texts = texts.where(F.size("starts") > 0).select("k", "text", "starts", "counts")
    rows = open_texts.mapInArrow(_emit_classes("z1", "z2", "g"), "k bigint, z1 bigint, z2 bigint, g bigint")
    sized = materialize(rows.groupBy("z1", "z2", "g").agg(F.count("*").alias("n"), F.min("k").alias("shown_by")), "repeat-classes")
    groups = sized.where("g != 0").groupBy("g").agg(F.count_if(F.col("n") == 1).alias("lone"), F.count("*").alias("members")).where("lone > 0")
    groups = materialize(groups.select("g", (F.col("members") > CROWDED).alias("crowded")), "repeat-groups")
    # A class of 2 or more is asked for if a class of 1 shares its phrase; classes of 1 matter where the phrase is crowded, and
    # there is at most one such phrase for each CROWDED classes.
    several = sized.where("n > 1").join(groups, "g", "left")
    several = several.select("z1", "z2", F.when(F.col("crowded").isNotNull(), F.col("shown_by")).alias("shown_by"), F.coalesce("crowded", F.lit(False)).alias("crowded"))
    lone = sized.where("n = 1").join(groups.where("crowded").select("g"), "g").select("z1", "z2")
    marked = several.withColumn("several", F.lit(True)).unionByName(lone.withColumns({"several": F.lit(False), "crowded": F.lit(True)}), allowMissingColumns=True)
    rows = open_texts.mapInArrow(_emit_classes("z1", "z2"), "k bigint, z1 bigint, z2 bigint").join(marked, ["z1", "z2"])
    shows = F.col("k") == F.col("shown_by")
    chosen = {"many": F.col("several"), "shown": shows, "wide": F.col("crowded") & (~F.col("several") | shows)}
    marks = rows.groupBy("k").agg(*[F.collect_set(F.when(which, F.col("z1"))).alias(c) for c, which in chosen.items()])
    marks = materialize(marks, "repeat-marks")

    # 3. The dictionary's suffixes: windows of segments that no other segment equals as a whole.
    spans = "k bigint, z1 bigint, low bigint, high bigint"
    contexts = open_texts.join(marks, "k", "left").mapInArrow(_emit_contexts, "g bigint, k bigint, z1 bigint, twice boolean, context binary")
    ranges = contexts.repartition("g").sortWithinPartitions("g").mapInArrow(_order_suffixes, spans)
    wide = marks.where(F.size("wide") > 0)
    if not wide.isEmpty():
        windows = open_texts.join(wide, "k").mapInArrow(_emit_windows, "k bigint, w1 bigint, w2 bigint, z1 bigint, low bigint, n bigint")
        windows = materialize(windows, "repeat-windows")
        repeated = windows.groupBy("w1", "w2").agg(F.sum("n").alias("times")).where("times > 1").select("w1", "w2")
        hits = windows.where("n = 1").join(repeated, ["w1", "w2"])
        ranges = ranges.unionByName(hits.select("k", "z1", "low", (F.col("low") + 1).alias("high")))
    parts = F.sort_array(F.collect_list(F.struct("z1", "low", "high"))).alias("parts")
    ranges = ranges.groupBy("k").agg(parts).select("k", *[F.col(f"parts.{c}").alias(f"{c}s") for c in ("z1", "low", "high")])
    done = texts.join(marks.select("k", "many"), "k", "left").join(ranges, "k", "left")
    return done.mapInArrow(_removed, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
