"""Connected components of an edge list, by alternating star contraction.

Each round links every node's larger neighbours to the least node of its
neighbourhood (large star), then its smaller ones (small star). Both are a
minimum per node with map-side combine and a join back, so a node with a
third of all edges is neither collected nor sorted in one task. The rounds
end when the edges are stars; their number grows with the logarithm of the
longest path. Each round is written under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over distinct edges (u > v)."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    # A plain table: the join below can split the rows of a node with many edges.
    least = saved(least.select(F.col("u").alias("c"), F.least("u", "m").alias("m")), "component-least")
    joined = near.join(least, F.col("u") == F.col("c"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); root is the least node
    of the component. Self-links and repeated links change nothing."""
    e = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
              "component-edges")

    def digest(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    state = digest(e)
    while True:
        e = saved(_star(_star(e, large=True), large=False), "component-edges")
        now = digest(e)
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
