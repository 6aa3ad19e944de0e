"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it into chunks wherever the hash hits a fixed value, so a passage
that many documents share is cut alike in all of them. Documents are range-partitioned and sorted by their
smallest chunk hash, which brings copies and near copies together; a task encodes a chunk once and takes
its ids from a bounded cache afterwards. A chunk may start and end in the middle of a word. At each join the
words around it are encoded anew, over more and more words, until the outer words get the very ids they
have inside their chunks; blanks of the ASCII range always separate words of this vocabulary.

The vocabulary is a file of the tokenizers library, whose path is a parameter (default: the public word-level BPE).
Words are encoded by the library itself and remembered up to a bound: in chunks of plain characters by their pieces (runs
of letters or marks, digits), as there are fewer of those than of words in all their cases and with all their marks.

Defined cases: null text counts as empty and has no ids; very long texts are encoded chunk by chunk; rows stay
rows, repeated ones included; an empty table gives an empty table. Columns other than id and text are dropped.
"""

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from textassay.llm.common import whole

VOCABULARY = "word_bpe_49k.json"
MEAN_CHUNK = 1024  # bytes
HASH_WIDTH = 16
MEMO_WORDS = 200_000
CACHED_CHUNKS = 4096
OUT_ROWS = 256
HASHED_BYTES = 2**18  # of short texts whose cuts are looked for at once
_BLANKS = re.compile("[ \t\n\x0b\x0c\r]+")
# Characters that the library only lower-cases and splits into pieces, and those pieces: its model may be asked directly.
# Special tokens begin with "<".
_OTHERS = re.compile("[^ \t\n\x0b\x0c\r!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
_PIECE = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[!-/:;=-@\\[-`{-~]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def rolling_hash(raw: np.ndarray, width: int = HASH_WIDTH) -> np.ndarray:
    """Polynomial hash of the ``width`` bytes that end at each position (fewer at the start)."""
    out = raw.astype(np.uint32)
    shift, power = 1, 0x9E3779B1
    while shift < width:  # h(2w, i) = h(w, i) + h(w, i - w) * base^w
        out[shift:] += out[:-shift] * np.uint32(power)
        shift, power = 2 * shift, power * power & 0xFFFFFFFF
    return (out ^ (out >> np.uint32(15))) * np.uint32(0x85EBCA6B)


def chunk_ends(raw: np.ndarray, mean: int = MEAN_CHUNK) -> np.ndarray:
    """Ends of the chunks of a UTF-8 text, the last one being its length; never inside a code point."""
    if not len(raw):
        return np.zeros(0, np.int64)
    cuts = np.flatnonzero((rolling_hash(raw) >> np.uint32(8)) % np.uint32(mean) == 0) + 1
    for _ in range(3):
        inside = cuts < len(raw)
        inside[inside] &= (raw[cuts[inside]] & 0xC0) == 0x80
        cuts = cuts + inside
    return np.unique(np.append(cuts[cuts < len(raw)], len(raw)))


def chunked(texts: Iterable[str]) -> Iterator[tuple[bytes, list[int]]]:
    """Each text in UTF-8 and the ends of its chunks. Short texts are hashed together, zeros as wide as the hash between them."""

    def cut(raws: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        ends, start = chunk_ends(np.frombuffer(bytes(HASH_WIDTH).join(raws), np.uint8)), 0
        for raw in raws:
            a, b = np.searchsorted(ends, [start + 1, start + len(raw)])
            yield raw, [*(ends[a:b] - start).tolist(), len(raw)] if raw else []
            start += len(raw) + HASH_WIDTH

    group, held = [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        if group and held + len(raw) > HASHED_BYTES:
            yield from cut(group)
            group, held = [], 0
        group.append(raw)
        held += len(raw) + HASH_WIDTH
    yield from cut(group)


def smallest_chunk(raw: bytes, ends: list[int]) -> int:
    return min((xxhash.xxh64_intdigest(raw[a:b]) >> 1 for a, b in zip([0, *ends], ends, strict=False)), default=0)


def anchor_udf():
    """The smallest digest of a text's chunks: equal for texts that share that chunk."""

    @pandas_udf("bigint")
    def anchor(texts: pd.Series) -> pd.Series:
        return pd.Series([smallest_chunk(raw, ends) for raw, ends in chunked(texts)], dtype="int64")

    return anchor


def _letter_bytes() -> list[tuple[bytes, int]]:
    """The bytes above 127 that letters up to U+00FF consist of, with the lead byte they need."""
    return [(b"\xc3", b) for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]


class _Memo(dict):
    """Ids of words, made when first asked for. With too many, the newer half stays and is asked before anything is made anew."""

    def __init__(self, make):
        super().__init__({"": b""})
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.pop(word, None)
        if ids is None:
            ids = self.make(word)
        if len(self) >= MEMO_WORDS // 2:
            self.older = dict(self)
            self.clear()
            self[""] = b""
        if len(word) <= 64:
            self[word] = ids
        return ids


class Chunk(NamedTuple):
    """The first word of a chunk and the last one (none, if it has one word only), both open; its inner words' ids and outermost words."""

    first: str
    after: list[str]
    ids: bytes
    before: list[str]
    last: str | None


class ChunkCodec:
    """Encodes and decodes texts; one per Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.library.id_to_token(i) or "" for i in range(size)]
        self.model = self.library.model
        # Byte-level vocabularies write each byte as one printable character; the library tells which.
        shown = {b: self.library.pre_tokenizer.pre_tokenize_str(bytes([*lead, b]).decode()) for lead, b in _letter_bytes()}
        self.byte_chars = {b: pieces[0][0][-1] for b, pieces in shown.items()} | {0xC3: next(iter(shown.values()))[0][0][0]}
        self.id_bytes = [i.to_bytes(4, "little") for i in range(size)]
        self.words = _Memo(self.word_ids)
        self.chunks: dict[str, Chunk] = {}

    def library_ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a lower-case run of letters, a run of marks, a digit or an English ending."""
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.byte_chars)
        return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(piece)])

    def word_ids(self, word: str) -> bytes:
        if _PIECE.fullmatch(word):
            return self.piece_ids(word)
        return self.library_ids(word) if _OTHERS.search(word) else self.plain_ids(word)

    def plain_ids(self, words: str) -> bytes:
        """Ids of words of plain characters and the blanks between them."""
        return b"".join(map(self.words.__getitem__, _PIECE.findall(words.lower())))

    def chunk(self, chunk: str) -> Chunk:
        known = self.chunks.get(chunk)
        if known is None:
            known = self.split_chunk(chunk)
            if len(self.chunks) >= CACHED_CHUNKS:
                self.chunks.pop(next(iter(self.chunks)))
            self.chunks[chunk] = known
        return known

    def split_chunk(self, chunk: str) -> Chunk:
        blank = _BLANKS.search(chunk)
        if blank is None:
            return Chunk(chunk, [], b"", [], None)
        if _OTHERS.search(chunk):
            first, *inner, last = _BLANKS.split(chunk)
            return Chunk(first, inner[:8], b"".join(map(self.words.__getitem__, inner)), inner[-8:], last)
        last = "" if chunk[-1].isspace() else chunk.rsplit(None, 1)[-1]
        inner = chunk[blank.end() : len(chunk) - len(last)]
        return Chunk(chunk[: blank.start()], inner.split(None, 8)[:8], self.plain_ids(inner), inner.rsplit(None, 8)[-8:], last)

    def repaired(self, before: list[str], joined: str, after: list[str]) -> bytes:
        """Ids of the word at a join, encoded within more and more of its neighbours until those keep their own ids."""
        reach = 1
        while True:
            left, right = before[-reach:] if before else [], after[:reach]
            own_left, own_right = b"".join(map(self.words.__getitem__, left)), b"".join(map(self.words.__getitem__, right))
            ids = self.library_ids(" ".join([*left, joined, *right]))
            if ids.startswith(own_left) and ids.endswith(own_right) and len(ids) >= len(own_left) + len(own_right):
                return ids[len(own_left) : len(ids) - len(own_right)]
            if reach > max(len(before), len(after)):
                raise ValueError("blanks do not separate the words of this vocabulary")
            reach *= 2

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_chunks(*next(chunked([text])))

    def encode_chunks(self, raw: bytes, ends: list[int]) -> bytes:
        out, start = bytearray(), 0
        closed: list[str] = []
        opened, mended = "", False
        for end in ends:
            chunk = self.chunk(raw[start:end].decode("utf-8", "surrogatepass"))
            start = end
            cut = bool(opened) and bool(chunk.first)
            joined = opened + chunk.first
            mended = mended or cut
            if chunk.last is None:
                opened = joined
                continue
            out += self.repaired(closed, joined, chunk.after) if mended else self.words[joined]
            out += chunk.ids
            closed, opened, mended = chunk.before, chunk.last, False
        return bytes(out + (self.repaired(closed, opened, []) if mended else self.words[opened]))

    def decode(self, ids: bytes) -> str:
        """The vocabulary has no decoder of its own: its tokens are joined by blanks."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> ChunkCodec:
    return ChunkCodec(path)


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit integers in one binary value, and the text they decode to."""
    path = vocabulary or default_vocabulary()
    rows = df.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    rows = rows.withColumn("anchor", anchor_udf()("text")).repartitionByRange("anchor", "doc_id").sortWithinPartitions("anchor")

    def run(batches):
        own = codec(path)
        for batch in batches:
            for i in range(0, len(batch), OUT_ROWS):
                part = batch.iloc[i : i + OUT_ROWS]
                ids = [own.encode_chunks(raw, ends) for raw, ends in chunked(part["text"])]
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": ids, "decoded": [own.decode(x) for x in ids]})

    return rows.drop("anchor").mapInPandas(run, f"doc_id {df.schema[id_col].dataType.simpleString()}, ids binary, decoded string")


def coding_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per row."""
    coded = encode_texts(df, id_col, text_col, vocabulary)
    n = F.floor(F.octet_length("ids") / 4).cast("bigint")
    return coded.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
