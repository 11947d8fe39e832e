"""Connected components over an edge table: alternating large-star and small-star rounds.

Every round is a pair of aggregations and joins by node, so neither one component nor the whole
set of links is ever held by one task or the driver. Rounds are written to the shared folder,
which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    out = down.join(least, "u").select(
        F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                          F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return out.select("e.u", "e.v").where("u <> v").distinct()


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Nulls and self-links are ignored; an empty edge table gives an empty result. Repeated links
    and either direction are fine.
    """
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    print_of = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == print_of or now[0] == 0:
            break
        print_of = tuple(now)
        e = written(_small_star(_large_star(e)), "edges")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
