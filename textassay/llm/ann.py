"""Approximate nearest neighbours by inner product: balanced posting lists under an in-memory graph of centroids.

Largest inner product becomes smallest distance by one more coordinate: sqrt(M^2 - |x|^2), M being the largest norm.
Centroids are fitted on a bounded sample (``SAMPLE`` vectors by hash of the id) by k-means whose assignment
charges crowded clusters, which keeps the posting lists balanced. Every vector is indexed: it goes to its
closest list and, as a boundary vector, to the next ``COPIES - 1`` as far as their distance is within ``BOUNDARY``
times the closest. Centroids are found by best-first search over a k-nearest-neighbour graph of centroids
that every task holds. A query visits all lists within ``PRUNE`` times the distance of its closest list, or of the usual
closest list if that is farther, and then the next ones until they hold enough vectors for ``k`` rows besides its own.

The number of lists follows the rows up to ``MAX_LISTS``, a bound for what is broadcast (centroids and
graph); beyond it lists grow. Equal vectors are indexed and asked for once, with their ``k + 1`` smallest ids: ties go to
smaller ids, so no other can be in a result. Lists are scanned in units of about ``UNIT_ROWS`` vectors: small lists share a
unit, a large one is cut into several by hash of the id; the queries of a unit are cut by hash as well, into pieces of
about ``UNIT_QUERIES``. A unit hands on a query's best ``k + 1`` only. Scores are double-precision inner products of the
original vectors, summed in one fixed order, so equal vectors tie exactly.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part; vectors of
another length than most are not comparable and take no part either; a repeated id counts once (its smallest
vector); fewer than ``k`` candidates give as many rows; an empty table gives an empty table. Columns other than id
and vector are not read.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textassay.llm.common import materialize

K = 20
SAMPLE = 40_000
LIST_ROWS = 250
MAX_LISTS = 8_192
COPIES = 3
BOUNDARY = 1.1
PRUNE = 1.15
UNIT_ROWS = 20_000
UNIT_QUERIES = 20_000
DEGREE = 24
BEAM = 96


def balanced_centroids(x: np.ndarray, n: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """``n`` centroids of ``x``; crowded clusters cost more, so that sizes even out."""
    rng = np.random.default_rng(seed)
    unique = np.unique(x, axis=0)
    n = min(n, len(unique))
    centroids = unique[rng.choice(len(unique), n, replace=False)].copy()
    charge = np.zeros(n, np.float32)
    for _ in range(rounds):
        owner = np.concatenate([_closest(x[i : i + 4096], centroids, charge) for i in range(0, len(x), 4096)])
        sizes = np.bincount(owner, minlength=n)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, x)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
        centroids[~filled] = unique[rng.choice(len(unique), int((~filled).sum()))]
        spread = float(np.mean(np.square(x - centroids[owner]).sum(axis=1)))
        charge = np.float32(0.05 * spread) * np.minimum(sizes / max(len(x) / n, 1.0), 8.0).astype(np.float32)
    return centroids


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    squared = np.square(x).sum(axis=1)[:, None] + np.square(centroids).sum(axis=1)[None, :] - 2 * x @ centroids.T
    return np.maximum(squared, 0)


def _closest(x: np.ndarray, centroids: np.ndarray, charge: np.ndarray) -> np.ndarray:
    return (_distances(x, centroids) + charge).argmin(axis=1)


class CentroidGraph:
    """Centroids, each linked to its nearest ones and to a few drawn at random; searched best first."""

    def __init__(self, centroids: np.ndarray, typical: float = 0.0, seed: int = 6):
        self.centroids = centroids
        self.typical = typical  # the usual distance to the closest centroid: a query that is a centroid prunes by it
        n = len(centroids)
        near = min(DEGREE, max(n - 1, 0))
        links = [np.argpartition(row, near)[: near + 1] for i in range(0, n, 1024) for row in _distances(centroids[i : i + 1024], centroids)] if n > near + 1 else [np.arange(n)] * n
        rng = np.random.default_rng(seed)
        self.links = [np.unique(np.append(a, rng.integers(0, n, 4))) for a in links]
        for i, own in enumerate([a.copy() for a in self.links]):  # both ways, so that no centroid is out of reach
            for j in own[rng.permutation(len(own))[:8]]:
                if len(self.links[j]) < 3 * DEGREE:
                    self.links[j] = np.append(self.links[j], i)
        self.links = [np.unique(a) for a in self.links]
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(int)) if n else np.zeros(0, int)

    def search(self, q: np.ndarray, n: int = 0, within: float = 1.0, beam: int = BEAM, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Centroids found, closest first, and their distances: the ``n`` closest and all within ``within`` times the closest or ``least``."""
        seen = np.zeros(len(self.centroids), bool)
        found: list[tuple[float, int]] = []
        queue: list[tuple[float, int]] = []
        worst: list[float] = []  # of the best max(n, beam) so far, as a heap of negative distances
        beam, best = max(beam, n), np.inf

        def offer(nodes: np.ndarray) -> None:
            nonlocal best
            nodes = nodes[~seen[nodes]]
            seen[nodes] = True
            apart = np.sqrt(np.square(self.centroids[nodes] - q).sum(axis=1)).tolist()
            for d, node in zip(apart, nodes.tolist(), strict=True):
                best = min(best, d)
                if len(worst) < beam or d < -worst[0] or d <= max(within * best, least):
                    found.append((d, node))
                    heapq.heappush(queue, (d, node))
                    heapq.heappush(worst, -d)
                    if len(worst) > beam:
                        heapq.heappop(worst)

        offer(self.entries)
        while queue:
            d, node = heapq.heappop(queue)
            if len(worst) >= beam and d > -worst[0] and d > max(within * best, least):
                break
            offer(self.links[node])
        kept = [x for i, x in enumerate(sorted(found)) if i < n or x[0] <= max(within * best, least) + 1e-9]
        return np.array([node for _, node in kept], int), np.array([d for d, _ in kept])

    def postings(self, x: np.ndarray) -> list[int]:
        """Lists of a vector: the closest and those it lies on the boundary of."""
        nodes, apart = self.search(x, COPIES, beam=16)
        return nodes[:COPIES][apart[:COPIES] <= BOUNDARY * apart[0] + 1e-9].tolist()

    def probes(self, q: np.ndarray, held: np.ndarray, enough: int) -> list[int]:
        """Lists a query visits; together they hold ``enough`` vectors, or all. ``held``: vectors whose closest list it is."""
        near = self.search(q, 1, PRUNE, least=PRUNE * self.typical)[0]
        if held[near].sum() >= enough:
            return near.tolist()
        order = np.argsort(np.square(self.centroids - q).sum(axis=1), kind="stable")
        order = np.concatenate((near, order[~np.isin(order, near)]))
        return order[: int(np.searchsorted(np.cumsum(held[order]), enough)) + 1].tolist()


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def vectors_of(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v: array<double>, norm2) of the vectors that take part, one per id."""
    rows = df.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).select("n")
    rows = rows.join(F.broadcast(common), F.size("v") == F.col("n"), "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))  # one zero, for xxhash64
    return rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))


def distinct_vectors(base: DataFrame, n: int) -> DataFrame:
    """(vec_id, v, norm2, h, ids) of the different vectors: ``ids`` are the ``n`` smallest of each, ``vec_id`` the first of them."""
    # Tasks cut their own part to n rows a vector before anything is shuffled.
    order = Window.partitionBy("h", "v").orderBy("vec_id")
    some = base.withColumn("h", F.xxhash64("v")).withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= n)
    groups = some.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min("norm2").alias("norm2"))
    return groups.select(F.col("ids")[0].alias("vec_id"), "v", "norm2", "h", "ids")


def _lifted(v: pd.Series, norm2: pd.Series, top: float) -> np.ndarray:
    x = np.array(v.tolist(), np.float32)
    return np.column_stack([x, np.sqrt(np.maximum(top - norm2.to_numpy(), 0)).astype(np.float32)])


def nearest(df: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for every row of ``df`` with ``is_query`` (over ``vec_id``).

    Runs jobs when called: the cleaned vectors and the postings are written to the shared folder.
    """
    spark = df.sparkSession
    out = "query_id bigint, rank int, vec_id bigint, score double"
    everyone = materialize(vectors_of(df, id_col, vector_col), "ann-vectors")
    wanted = k + 1  # a query's own id is among its best and taken out at the end
    base = materialize(distinct_vectors(everyone, wanted), "ann-distinct")
    rows, top = base.agg(F.count("*"), F.max("norm2")).first()
    if not rows:
        return spark.createDataFrame([], out)
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v", "norm2").toPandas()
    lists = int(min(MAX_LISTS, max(1, rows // LIST_ROWS)))
    points = _lifted(sample["v"], sample["norm2"], top)
    centroids = balanced_centroids(points, lists)
    typical = float(np.median(np.sqrt(_distances(points[:2000], centroids).min(axis=1))))
    graph = spark.sparkContext.broadcast(CentroidGraph(centroids, typical))

    def post(batches):
        for b in batches:
            x = _lifted(b["v"], b["norm2"], top)
            ids = [own if len(own) > 1 else None for own in b["ids"]]
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": b["v"], "ids": ids, "lists": [graph.value.postings(q) for q in x]})

    posted = base.mapInPandas(post, "vec_id bigint, v array<double>, ids array<bigint>, lists array<int>")
    posted = posted.select("vec_id", "v", "ids", F.posexplode("lists").alias("nth", "list"))
    posted = materialize(posted, "ann-postings")
    # At most MAX_LISTS rows: the units of each list. Small lists share one, by number.
    counted = posted.groupBy("list").agg(F.count("*").alias("n"), F.count_if(F.col("nth") == 0).alias("own")).collect()
    sizes = {r["list"]: r["n"] for r in counted}
    held = np.zeros(len(centroids), int)
    held[[r["list"] for r in counted]] = [r["own"] for r in counted]
    shared = -(-sum(sizes.values()) // UNIT_ROWS)
    pieces = {one: -(-n // UNIT_ROWS) for one, n in sizes.items()}
    units = {one: [one % shared] if n == 1 else [shared + (one << 20) + i for i in range(n)] for one, n in pieces.items()}
    table = spark.createDataFrame([(one, own) for one, own in units.items()], "list int, units array<bigint>")
    own_unit = F.element_at("units", (F.pmod(F.xxhash64("vec_id"), F.size("units").cast("bigint")) + 1).cast("int"))
    indexed = posted.join(F.broadcast(table), "list").select("vec_id", "v", "ids", "list", own_unit.alias("unit"))

    def probe(batches):
        for b in batches:
            x = _lifted(b["v"], b["norm2"], top)
            x[:, -1] = 0  # a query has no lift: its inner product with a lifted vector is the plain one
            scale = np.sqrt(top) / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
            rows = []
            for rep, q in zip(b["vec_id"], (x * scale).astype(np.float32), strict=True):
                asked: dict[int, list[int]] = {}
                for one in graph.value.probes(q, held, wanted):
                    for unit in units.get(one, ()):
                        asked.setdefault(unit, []).append(one)
                rows += [(rep, unit, lists) for unit, lists in asked.items()]
            yield pd.DataFrame(rows, columns=["rep", "unit", "lists"])

    # Queries stand for their vector: those with equal ones are answered together.
    reps = base.select("h", "v", F.col("vec_id").alias("rep"))
    askers = everyone.where(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("h"), "v")
    askers = materialize(askers.join(reps, ["h", "v"]).select("query_id", "rep"), "ann-queries")
    queries = base.join(askers.select(F.col("rep").alias("vec_id")).distinct(), "vec_id", "left_semi").select("vec_id", "v", "norm2")
    asked = materialize(queries.mapInPandas(probe, "rep bigint, unit bigint, lists array<int>"), "ann-asked")
    # One row a unit: the pieces its queries are cut into, each of which meets all of its vectors.
    cut = asked.groupBy("unit").count().select("unit", F.ceil(F.col("count") / UNIT_QUERIES).cast("bigint").alias("pieces"))
    cut = materialize(cut, "ann-pieces")
    dealt = asked.join(F.broadcast(cut), "unit").withColumn("piece", F.pmod(F.xxhash64("rep"), F.col("pieces"))).drop("pieces")
    dealt = dealt.join(queries.select(F.col("vec_id").alias("rep"), F.col("v").alias("q")), "rep")
    met_by = indexed.join(F.broadcast(cut), "unit").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1))).drop("pieces")

    def scan(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"rep": [], "vec_id": [], "score": []})
        of_list = {one: (g["vec_id"].to_numpy(), np.array(g["v"].tolist())) for one, g in vectors.groupby("list")}
        copies = {rep: ids for rep, ids in zip(vectors["vec_id"], vectors["ids"], strict=True) if ids is not None}
        reps, q = queries["rep"].to_numpy(), np.array(queries["q"].tolist())
        best, held_back, n = (np.zeros(0, int), np.zeros(0, int), np.zeros(0)), [], 0
        pairs = queries["lists"].explode()
        rows = pd.Series(np.repeat(np.arange(len(queries)), queries["lists"].map(len)))
        for one, at in rows.groupby(pairs.to_numpy()):
            if one in of_list:
                ids, x = of_list[one]
                for i in range(0, len(at), 256):
                    part = at.to_numpy()[i : i + 256]
                    row, which, score = best_of_each(*best_pairs(q[part], x, ids, wanted), wanted)
                    held_back.append((part[row], which, score))
                    n += len(row)
                    if n > 1 << 20:
                        best = best_of_each(*map(np.concatenate, zip(best, *held_back, strict=True)), wanted)
                        held_back, n = [], 0
        best = best_of_each(*map(np.concatenate, zip(best, *held_back, strict=True)), wanted)
        rows, ids, scores = with_copies(*best, copies, wanted)
        return pd.DataFrame({"rep": reps[rows], "vec_id": ids, "score": scores})

    met = dealt.groupBy("unit", "piece").cogroup(met_by.groupBy("unit", "piece")).applyInPandas(scan, "rep bigint, vec_id bigint, score double")
    unique = met.dropDuplicates(["rep", "vec_id"])
    order = Window.partitionBy("rep").orderBy(F.col("score").desc(), "vec_id")
    ranked = unique.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)
    answers = ranked.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    answers = materialize(answers, "ann-answers")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    each = askers.join(answers, "rep").select("query_id", F.posexplode(others).alias("nth", "x"))
    return each.select("query_id", (F.col("nth") + 1).alias("rank"), "x.vec_id", "x.score")


def best_pairs(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, id, score) of each query's best ``k`` rows of ``x``, and of what ties with them.

    A fast product finds the candidates; their scores are then summed in a fixed order.
    """
    quick = q @ x.T
    last = np.partition(quick, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(q), -np.inf)
    slack = 1e-9 * np.maximum(np.abs(np.where(np.isfinite(last), last, 0)), 1e-3)
    row, col = np.nonzero(quick >= (last - slack)[:, None])
    return row, ids[col], np.concatenate([(q[row[i : i + 65536]] * x[col[i : i + 65536]]).sum(axis=1) for i in range(0, len(row), 65536)] or [np.zeros(0)])


def best_of_each(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` different ids of each row, ties to smaller ids."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    fresh = np.ones(len(rows), bool)  # an id found in two lists has one score, so its copies are neighbours
    fresh[1:] = (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1])
    rows, ids, scores = rows[fresh], ids[fresh], scores[fresh]
    start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, int)
    rank = np.arange(len(rows)) - np.repeat(start, np.diff(np.append(start, len(rows))))
    kept = rank < k
    return rows[kept], ids[kept], scores[kept]


def with_copies(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, copies: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` of each row when every id brings along those in ``copies``, which have its score."""
    each = [copies[i] if i in copies else (i,) for i in ids.tolist()]
    sizes = np.fromiter(map(len, each), int, len(each))
    spelled = np.fromiter((i for own in each for i in own), np.int64, int(sizes.sum()))
    return best_of_each(np.repeat(rows, sizes), spelled, np.repeat(scores, sizes), k)
