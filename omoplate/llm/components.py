"""Connected components of a graph too large for one machine.

Large-star and small-star rounds (Kiveris et al., 2014): every node links
its larger neighbours to the smallest one it knows, then links the rest of
its smaller neighbours there too, until all edges are stars. A round is two
map-side combined minima and two equi-joins, and a node with very many
neighbours is only ever a skewed join key, which adaptive execution splits.
Each round is written to the shared folder, so a lost executor costs one
round, and the plan never grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omoplate.llm.common import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).collect()[0])


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """``node, component`` for every node of ``edges`` (two columns of one ordered type): the
    smallest node that can be reached. Null ends, loops and repeated edges do no harm."""
    e = cut_lineage(edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull())
                    .select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).distinct())
    loops = e.filter("a = b").select(F.col("a").alias("node"))
    e = e.filter("a > b")
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        ).select("col.a", "col.b").filter("a > b").distinct()
        e = cut_lineage(small)
        after = _state(e)
        if after == before:
            break
        before = after
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    alone = loops.unionByName(e.select(F.col("b").alias("node"))).distinct().select("node", F.col("node").alias("component"))
    return stars.unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
