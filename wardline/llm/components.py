"""Connected components by alternating star contraction (large-star, small-star).

Every round is two shuffles by vertex and is written to the shared folder; the number of
rounds grows with the logarithm of the longest chain, and a lost executor costs its own
tasks only.  Links never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import stage_table


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that the links reach, for every linked node.

    Links are undirected; loops and repeats do no harm; nulls are ignored.
    """
    star = stage_table(links.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y"))
                       .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))), "links")
    mark = None
    for _ in range(max_rounds):
        # One shuffle by x each: distinct pairs, the smallest neighbour and the join back use it.
        # Large star: every larger neighbour goes to the smallest node around.
        both = star.union(star.select(F.col("y").alias("x"), F.col("x").alias("y"))).repartition("x").distinct()
        big = (both.join(both.groupBy("x").agg(F.min("y").alias("low")), "x").filter(F.col("y") > F.col("x"))
               .select(F.col("y").alias("x"), F.least("low", "x").alias("y")))
        # Small star: smaller neighbours and the node itself go to the smallest of them.
        big = big.repartition("x").distinct()
        star = stage_table(big.join(big.groupBy("x").agg(F.min("y").alias("low")), "x").select(
            F.explode(F.array(F.struct(F.col("x").alias("x"), F.col("low").alias("y")),
                              F.struct(F.col("y").alias("x"), F.col("low").alias("y")))).alias("e"))
            .select("e.*").filter("x != y"), "links")
        code = F.xxhash64("x", "y")
        now = tuple(star.agg(F.max(code), F.min(code), F.bit_xor(code), F.count(F.lit(1))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"links still change after {max_rounds} rounds")
    ends = star.select(F.col("x").alias("node"), F.col("y").alias("component")).union(
        star.select(F.col("y").alias("node"), F.col("y").alias("component")))
    return ends.groupBy("node").agg(F.min("component").alias("component"))
