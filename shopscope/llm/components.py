"""Connected components by alternating large-star and small-star steps.

(Kiveris, Lattanzi, Mirrokni, Rastogi and Vassilvitskii, "Connected Components
in MapReduce and Beyond", 2014.) Every step is a grouped minimum and a join of
distributed tables; each round is staged in the shared folder. Nothing is
collected but two numbers per round that tell whether the edges still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, stage


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """For edges (a, b) over bigint nodes: (node, root), root the smallest node
    of the component; roots themselves and nodes without an edge are absent."""
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst"))
              .distinct(), "edges")
    sign = _signature(e)
    while sign[0]:
        both = e.union(e.select("dst", "src"))
        low = both.groupBy("src").agg(F.min("dst").alias("low")) \
            .select("src", F.least("src", "low").alias("low"))
        large = both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")) \
            .distinct()
        large = stage(large, "large-star")
        low = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = large.join(low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst")) \
            .union(low).distinct()
        old, e = e, stage(small, "small-star")
        drop_staged(large)
        drop_staged(old)
        before, sign = sign, _signature(e)
        if sign == before:
            break
    return e.select(F.col("src").alias("node"), F.col("dst").alias("root"))
