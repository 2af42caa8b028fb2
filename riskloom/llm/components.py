"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import pin

MAX_ROUNDS = 60
ROWS_PER_FILE = 1_000_000  # links of a round; many small files cost more than they hold


def _least(pairs: DataFrame) -> DataFrame:
    """Each ``a`` with the least ``b``; a hub's links are reduced on every task first."""
    return pairs.groupBy("a").agg(F.min("b").alias("least"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the component's least node.

    Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): a large-star
    step hangs each node's larger neighbours on its least neighbour, a small-star step its
    smaller ones; both keep the components and the rounds grow with the logarithm of a
    component's diameter. Every step is an aggregation and a join of links; each round's
    links are written to the shared folder, which cuts the lineage. Links from a node to
    itself and repeated links do no harm; without links there are no nodes.
    """
    nodes = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node"))).distinct()
    edges = pin(
        links.filter("a != b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct(), "links"
    )
    before, n = None, edges.count()
    for _ in range(MAX_ROUNDS):
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).withColumn("least", F.least("a", "least"))
        large = both.filter("b > a").join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        smallest = _least(large)
        small = (
            large.join(smallest, "a")
            .select(F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b"))
            .filter("a != b")
            .distinct()
        )
        edges = pin(small.coalesce(-(-n // ROWS_PER_FILE) or 1), "links")
        # Stars only: no node is both a leaf and a root, and nothing has moved.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(state) == before:
            break
        before, n = tuple(state), state[0]
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
