"""Connected components of a link table, by alternating large-star and small-star rounds on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import forget, written
from quillspark.operators.skew import lookup


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: for every node of ``links`` the smallest node that it can reach.

    Each round takes the least neighbour of every node with an aggregate, which combines before the shuffle, and joins it back
    on; of nodes with many links, of which there are few, it is broadcast, so a hub with a third of all links is no hot group. Rounds end when the links no longer change. Null ends and
    self links are ignored; an empty table gives an empty one.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    edges = written(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(lo.alias("u"), hi.alias("v")).distinct(), "links")
    last = None
    while True:
        # Large star: every larger neighbour of a node moves to the node's least neighbour (or the node, if that is less).
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = lookup(both.where("v > u"), least, ["u"], size="n").where("v != m").select(F.col("m").alias("u"), "v").distinct()
        # Small star: a node and all its smaller neighbours move to the least of them.
        large = written(large, "large")
        least = large.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n"))
        small = lookup(large, least, ["v"], size="n").select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("v").alias("v")), F.struct(F.col("m").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        new = written(small, "links")
        # The rounds are at rest when every node has one link, to a node that has none of its own.
        sign = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        forget(large)
        forget(edges)
        edges = new
        if sign == last or sign[0] == 0:
            break
        last = sign
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )
