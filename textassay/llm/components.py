"""Connected components of a link table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textassay.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``links`` (a, b: bigint); component is the smallest node reachable.

    Alternating large-star and small-star steps: each node's larger (smaller) neighbours are linked to its
    smallest one. The number of rows never grows beyond the links, a hub of any size is pre-aggregated to
    one minimum, and the rounds are logarithmic in practice. Every round is written to the shared folder.
    """
    links = materialize(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        starred = materialize(_small_star(_large_star(links)), "stars")
        same = links.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if same == starred.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first():
            break
        links = starred
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of those; ``links`` has a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    out = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
