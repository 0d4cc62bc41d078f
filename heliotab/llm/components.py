"""Connected components of a graph that no single machine holds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle


def _attach_least(pairs: DataFrame, smaller: bool) -> DataFrame:
    """Tie the larger (or smaller) neighbours of every vertex to its least neighbour."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = pairs.join(least, "a")
    if smaller:
        tied = tied.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    else:
        tied = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between longs -> (vertex, label): the least vertex that each linked one reaches.

    Alternates large-star and small-star steps until nothing changes, so the rounds grow with the
    logarithm of the longest chain. Least neighbours are aggregated before they move, each round is
    written to the shared folder, and only a count and a checksum come to the driver.
    """
    edges = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("label")).union(
                edges.select(F.col("b"), F.col("b")).distinct()
            )
        before = tuple(state)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = settle(_attach_least(_attach_least(both, False), True), "links")
