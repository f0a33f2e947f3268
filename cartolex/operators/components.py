"""Connected components of an edge table, with DataFrame operations only.

Alternating large-star and small-star steps over a table of edges. A step pre-aggregates each
node's smallest neighbour before the shuffle, so a hub of millions of edges costs each map task one
row; joining the minimum back to the edges reads two written tables, so adaptive execution splits
a hub's partition. The driver sees two numbers a round: how many edges there are and their checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolex.staging import release, stage


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; a component is named by its smallest node.

    Edges with a null end and loops are ignored; repeated edges count once. A node that has only
    loops isn't returned: it is its own component. Nodes may be of any ordered type.
    """
    a, b = F.col(src), F.col(dst)
    low_high = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    table = stage(low_high.distinct(), "edges")
    seen = None
    for _ in range(rounds):
        now = table.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen or not now["n"]:
            break
        seen = now
        both = table.select("u", "v").union(table.select(F.col("v"), F.col("u")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large")
        down = stage(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        after = stage(small.distinct(), "edges")
        for old in (table, least, large, down):
            release(old)
        table = after
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    return table.select(F.col("u").alias("node"), F.col("v").alias("component")).union(table.select("v", "v").distinct())
