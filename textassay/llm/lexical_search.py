"""Ranked lexical search with Block-Max MaxScore.

The index is cut into shards of at most ``SHARD_DOCS`` documents and about ``SHARD_TERMS`` postings, each built by one
task from its own documents in one pass: no text is shuffled. A posting list is cut into blocks of ``BLOCK_DOCS``
consecutive documents of the shard (the same cuts for all lists); a block is stored compressed (variable-length bytes of
gaps and term frequencies) beside its frontier, the pairs of term frequency and document length of which none is worse in
both. Numbers of documents and terms come from the same rows, so the frontier gives exact block maxima once they are known.

A search reads the lists of the query terms only. Each shard (and block of queries, if there are many) is one group:
lists are ordered by their largest score in the shard; those whose bounds together stay below the 50th best score so far
are non-essential. Block by block, essential lists are added up, then the non-essential ones from the largest bound down:
documents that cannot reach the 50th score even with the block maxima of all lists left are rejected, and a list's
block is decompressed only while any document is left. Every shard hands over its best 50 for each query; they are
merged by a limited sort, with the limit applied before the shuffle as well.

Weights and scores are 64-bit integers as defined for the query; ties go to smaller document ids.

Defined cases: null text has no term; a document without a term takes no part in the counts and never scores; a null
document id comes after all others in ties; repeated document rows are documents of their own; rows of one item id make
one item with all their terms (so do rows without an item id); items without a term or a hit give no rows; empty
tables give an empty table. Other columns are not read.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textassay.llm.common import materialize, whole

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
SHARD_DOCS = 1 << 14
SHARD_TERMS = 1 << 23
BLOCK_DOCS = 1 << 10
QUERY_BLOCK = 1_000  # items searched together
BROADCAST_TERMS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of other characters (all of them above 0x7F) belong to terms.
_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)

INDEX = """shard bigint, term string, df int, blocks array<int>, starts array<int>, tops array<int>, top_tf array<int>, top_n array<int>,
    payload binary, docs array<bigint>, sizes array<int>, n_docs bigint, n_terms bigint"""
_INTS = pa.list_(pa.int32())
_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("term", pa.string()), ("df", pa.int32()), ("blocks", _INTS), ("starts", _INTS), ("tops", _INTS), ("top_tf", _INTS), ("top_n", _INTS),
    ("payload", pa.binary()), ("docs", pa.list_(pa.int64())), ("sizes", _INTS), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
])


def terms_of(text: str | Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.translate(whole(text), UPPER, LOWER), F.lit(f"({TERM})")))


# --- index -------------------------------------------------------------------------------------


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers as bytes, seven bits each with the low ones first and the top bit set on all but the last; and their starts."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        size += values >= (np.uint64(1) << np.uint64(bits))
    ends = np.cumsum(size)
    starts = ends - size
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(int(size.max(initial=0))):
        some = np.flatnonzero(size > i)
        part = (values[some] >> np.uint64(7 * i)) & np.uint64(0x7F)
        out[starts[some] + i] = part.astype(np.uint8) | ((size[some] > i + 1).astype(np.uint8) << 7)
    return out, starts


def unpack(data: np.ndarray) -> np.ndarray:
    last = data < 0x80
    if last.all():
        return data.astype(np.int64)
    ends = np.flatnonzero(last)
    starts = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 0x7F).astype(np.int64) << (7 * place), starts)


class _Shard:
    """Postings of some documents, in flat arrays."""

    def __init__(self):
        self.vocabulary = defaultdict(count().__next__)
        self.docs: list = []
        self.sizes: list[int] = []
        self.terms, self.tfs, self.distinct = [], [], []

    def add(self, doc_id, text: str | None) -> int:
        """Takes a document with a term in; returns the number of its postings."""
        found = (text or "").encode().translate(_BYTES).split()
        if not found:
            return 0
        counts, words = Counter(found), self.vocabulary
        self.docs.append(doc_id)
        self.sizes.append(len(found))
        self.terms.append(np.fromiter(map(words.__getitem__, counts), np.int32, len(counts)))
        self.tfs.append(np.fromiter(counts.values(), np.int32, len(counts)))
        self.distinct.append(len(counts))
        return len(counts)

    def batch(self, number: int) -> pa.RecordBatch:
        """A row for each term, and one for the documents."""
        terms, tfs = np.concatenate(self.terms), np.concatenate(self.tfs)
        docs = np.repeat(np.arange(len(self.docs), dtype=np.int32), self.distinct)
        order = np.argsort(terms, kind="stable")
        terms, tfs, docs = terms[order], tfs[order], docs[order]
        sizes = np.array(self.sizes, np.int64)
        # A block is a run of one term and one range of documents.
        key = terms.astype(np.int64) * (SHARD_DOCS // BLOCK_DOCS + 1) + docs // BLOCK_DOCS
        opens = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(opens)
        gaps = docs - np.concatenate(([0], docs[:-1]))
        gaps[first] = docs[first] % BLOCK_DOCS
        data, starts = pack(np.stack((gaps, tfs), 1).reshape(-1))
        block_of = np.cumsum(opens) - 1
        rank = np.lexsort((sizes[docs], -tfs.astype(np.int64), block_of))
        # Below the smallest size of all larger term frequencies of the block: on its frontier.
        small = sizes[docs][rank] - block_of[rank] * (1 << 40)
        kept = rank[np.concatenate(([True], small[1:] < np.minimum.accumulate(small)[:-1]))]
        # Cuts of the flat arrays: by term in blocks, postings and bytes; by block in frontier pairs and bytes.
        n = len(self.vocabulary)
        term_cuts = np.searchsorted(terms[first], np.arange(n + 1))
        posting_cuts = np.searchsorted(terms, np.arange(n + 1))
        byte_starts = np.concatenate((starts[2 * first], [len(data)]))
        byte_cuts = byte_starts[term_cuts]
        tops = np.bincount(block_of[kept], minlength=len(first))
        top_cuts = np.concatenate(([0], np.cumsum(tops)))[term_cuts]

        def lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int32()))

        blocks = (docs[first] // BLOCK_DOCS).astype(np.int32)
        inner = starts[2 * first] - np.repeat(byte_cuts[:-1], np.diff(term_cuts))
        payload = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(byte_cuts.astype(np.int32)), pa.py_buffer(data)])
        listed = [
            pa.array(np.full(n, number), pa.int64()), pa.array([t.decode() for t in self.vocabulary], pa.string()), pa.array(np.diff(posting_cuts), pa.int32()),
            lists(blocks, term_cuts), lists(inner, term_cuts), lists(tops, term_cuts), lists(tfs[kept], top_cuts), lists(sizes[docs][kept], top_cuts),
            payload, *[pa.nulls(n, f.type) for f in list(_SCHEMA)[9:]],
        ]
        own = [pa.array([number], pa.int64()), *[pa.nulls(1, f.type) for f in list(_SCHEMA)[1:9]]]
        own += [pa.array([self.docs], _SCHEMA.field("docs").type), pa.array([self.sizes], pa.list_(pa.int32())), pa.array([len(self.docs)], pa.int64()), pa.array([int(sizes.sum())], pa.int64())]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(listed, own, strict=True)], schema=_SCHEMA)


def _build(shard_docs: int, shard_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, held = TaskContext.get().partitionId() << 32, _Shard(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held += shard.add(doc_id, text.as_py())
                if len(shard.docs) >= shard_docs or held >= shard_terms:
                    yield shard.batch(number)
                    number, shard, held = number + 1, _Shard(), 0
        if shard.docs:
            yield shard.batch(number)

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The index of all documents, written to the shared folder: a row for each shard and term, and one with the shard's documents."""
    if shard_docs > SHARD_DOCS:
        raise ValueError(f"a shard has at most {SHARD_DOCS} documents")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(_build(shard_docs, shard_terms), INDEX), "lexical-index")


# --- search ------------------------------------------------------------------------------------


class _List:
    """A posting list of a shard: block maxima, and blocks decompressed when asked for."""

    def __init__(self, row, lengths: np.ndarray, n_blocks: int):
        self.weight, self.payload = int(row.w), np.frombuffer(row.payload, np.uint8)
        self.starts, self.lengths, self.known = np.append(row.starts, len(self.payload)), lengths, {}
        self.place = {int(b): i for i, b in enumerate(row.blocks)}
        tops = np.asarray(row.tops, np.int64)
        scores = self.weight * impact(np.asarray(row.top_tf, np.int64), np.asarray(row.top_m, np.int64))
        self.bounds = np.zeros(n_blocks, np.int64)
        self.bounds[np.asarray(row.blocks)] = np.maximum.reduceat(scores, np.cumsum(tops) - tops)
        self.bound = int(self.bounds.max())

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places within the block, in order) and their scores."""
        if b not in self.known:
            i = self.place[b]
            pairs = unpack(self.payload[self.starts[i] : self.starts[i + 1]]).reshape(-1, 2)
            docs = np.cumsum(pairs[:, 0])
            self.known[b] = docs, self.weight * impact(pairs[:, 1], self.lengths[b * BLOCK_DOCS + docs])
        return self.known[b]


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def search_shard(lists: list[_List], doc_ids: np.ndarray, n_blocks: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best ``top`` documents of a shard, best first.

    ``doc_ids`` are ranks for ties: smaller ones first. Documents below the ``top``-th score so far are rejected; those
    that reach it stay, as their ids may decide.
    """
    lists = sorted(lists, key=lambda x: x.bound)
    sums = np.cumsum([x.bound for x in lists])
    bounds = np.array([x.bounds for x in lists])
    best_docs, best_scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    # Promising blocks first: the sooner the least score rises, the more is rejected.
    for b in np.argsort(-bounds.sum(axis=0), kind="stable").tolist():
        block = bounds[:, b]
        if block.sum() < least:
            break
        essential = int(np.searchsorted(sums, least))  # lists before it cannot reach the least score together
        scores = np.zeros(BLOCK_DOCS, np.int64)
        for i in range(essential, len(lists)):
            if block[i]:
                docs, gained = lists[i].block(b)
                scores[docs] += gained
        left = np.cumsum(block[:essential])  # what the non-essential lists up to each can still add
        alive = np.flatnonzero(scores)
        for i in range(essential - 1, -1, -1):
            alive = alive[scores[alive] + left[i] >= least]
            if not len(alive):
                break
            if block[i]:
                docs, gained = lists[i].block(b)
                at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
                scores[alive] += np.where(docs[at] == alive, gained[at], 0)
        alive = alive[scores[alive] >= least]
        if len(alive):
            best_docs = np.concatenate((best_docs, b * BLOCK_DOCS + alive))
            best_scores = np.concatenate((best_scores, scores[alive]))
            order = np.lexsort((doc_ids[best_docs], -best_scores))[:top]
            best_docs, best_scores = best_docs[order], best_scores[order]
            if len(best_docs) == top:
                least = int(best_scores[-1])
    return best_docs, best_scores


def _search(top: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        is_docs = group["term"].isna()
        shard = group[is_docs].iloc[0]
        ids, lengths = list(shard["docs"]), np.asarray(shard["sizes"], np.int64)
        missing = np.array([i is None or i != i for i in ids])
        numbers = np.array([0 if m else int(i) for i, m in zip(ids, missing, strict=True)], np.int64)
        ranks = np.empty(len(ids), np.int64)
        ranks[np.lexsort((numbers, missing))] = np.arange(len(ids))
        n, total = int(shard["all_docs"]), int(shard["all_terms"])
        n_blocks = -(-len(ids) // BLOCK_DOCS)
        norms = 50 + 50 * lengths * n // total
        lists = {}
        for row in group[~is_docs].itertuples():
            row = row._replace(top_m=50 + 50 * np.asarray(row.top_n, np.int64) * n // total)
            lists[row.term] = _List(row, norms, n_blocks)
        out = []
        for item in shard["items"]:
            if own := [lists[t] for t in item["terms"] if t in lists and lists[t].bound]:
                docs, scores = search_shard(own, ranks, n_blocks, top)
                out += [(item["item"], None if missing[d] else int(numbers[d]), int(s)) for d, s in zip(docs, scores, strict=True)]
        found = pd.DataFrame(out, columns=["item", "doc_id", "score"])
        return found.astype({"item": "Int64", "doc_id": "Int64"})

    return run


def search(index: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item, rank, doc_id, score): the best ``top`` documents for each row of ``items`` (item: bigint, unique; terms: array<string>).

    Runs jobs when called: query terms, their weights and the totals of the index are made first.
    """
    size = items.count()
    blocks = max(1, -(-size // QUERY_BLOCK))
    asked = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    terms = materialize(asked.select("block", F.explode("terms").alias("term")).distinct(), "query-terms")
    few = terms.count() <= BROADCAST_TERMS

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    totals = index.where("term is null").agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = F.lit(totals["docs"] or 0).cast("bigint"), F.lit(totals["terms"] or 0).cast("bigint")
    wanted = index.where("term is not null").join(sent(terms.select("term").distinct()), "term", "left_semi")
    df = wanted.groupBy("term").agg(F.sum("df").cast("bigint").alias("df"))
    ratio = (2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weights = materialize(df.select("term", F.floor(1000 * F.log(ratio)).alias("w")), "query-weights")
    lists = index.where("term is not null").join(sent(terms.join(weights, "term")), "term")
    packed = asked.groupBy("block").agg(F.collect_list(F.struct("item", "terms")).alias("items"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block")
    shards = index.where("term is null").select("shard", "docs", "sizes", every, n_docs.alias("all_docs"), n_terms.alias("all_terms")).join(packed, "block")
    columns = ("shard", "block", "term", "w", "blocks", "starts", "tops", "top_tf", "top_n", "payload")
    rows = lists.select(*columns).withColumn("top_m", F.lit(None).cast("array<int>"))
    groups = rows.unionByName(shards, allowMissingColumns=True).groupBy("shard", "block")
    found = groups.applyInPandas(_search(top), "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, item_col: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of the best ``top`` documents for each item. Runs the indexing when called."""
    terms = items.select(F.col(item_col).cast("bigint").alias("item"), F.explode(terms_of(item_text)).alias("term"))
    asked = materialize(terms.groupBy("item").agg(F.collect_set("term").alias("terms")), "items")
    index = build_index(docs)
    return search(index, asked, top).select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
