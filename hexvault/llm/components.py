"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault.llm.common import salted_lookup
from hexvault.session import cut_lineage, narrowed


def _with_minimum(edges: DataFrame) -> DataFrame:
    """Edges ``u, v`` with ``m``, the smallest of u and all its neighbours.

    The minimum combines map-side and the join key is salted, so a node with a third
    of all edges is no single task.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("w"))
    return salted_lookup(edges, low, ["u"], "v").withColumn("m", F.least("u", "w")).drop("w")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_minimum(both).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    marked = _with_minimum(down)
    return (marked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(marked.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; root is the smallest node reachable.

    Each round is checkpointed to the shared folder, in few files as an edge is two numbers. The rounds end when the edge set
    is unchanged; they raise rather than return an unfinished result.
    """
    edges = cut_lineage(narrowed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                                 .filter("u <> v").distinct()))

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    last = mark(edges)
    for _ in range(max_rounds):
        if not last[0]:
            break
        edges = cut_lineage(narrowed(_small_star(_large_star(edges))))
        now = mark(edges)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
