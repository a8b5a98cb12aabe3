"""Connected components of an edge table by alternating star rewrites."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, store: Callable[[DataFrame], DataFrame], src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, root) for every node of the edges; root is the smallest node of the component.

    Each round links every node's larger neighbours, then its smaller ones, to the
    smallest node around; a logarithmic number of rounds leaves stars.  store() cuts
    the lineage after a round (a written table or a checkpoint).  Loops and null ends
    are ignored; an empty table gives no rows.
    """
    a, b = F.col(src), F.col(dst)
    links = store(edges.where(a != b).select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).distinct())
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
        large = both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
        near = large.groupBy("src").agg(F.min("dst").alias("low"))
        joined = large.join(near, "src")
        small = joined.where("dst != low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        links = store(small.unionByName(near.select("src", F.col("low").alias("dst"))).distinct())
        seen = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("sum")).first()
        if mark == seen:
            break
        mark = seen
    roots = links.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return links.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(roots)
