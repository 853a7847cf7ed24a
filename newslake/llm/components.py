"""Connected components of a graph of links, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.session import staged


def _lowest(edges):
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links):
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    hubs = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(hubs, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links):
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    hubs = _lowest(down)
    moved = down.join(hubs, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(hubs.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(links):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; a root is the least node that its nodes reach.

    Each round links nodes to the least neighbour on both sides; a hub is one row of an aggregate, and what joins with
    it is split by adaptive execution. Rounds end when the links are stars and stay as they are. Each round's links
    are a table in the shared folder. Links from a node to itself count for nothing; no links, no rows.
    """
    links = staged(_small_star(links.filter(F.col("a") != F.col("b"))), "links")
    state = _state(links)
    while state[0]:
        links = staged(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b")).distinct()
