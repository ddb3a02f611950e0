"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcframe.llm.common import cut


def connected(links: DataFrame) -> DataFrame:
    """`node` and `root` (the smallest node it reaches) for every node of `links` (columns `a`, `b`) that is not its own root.

    Rounds of two steps: every node hands its smallest neighbour to its larger neighbours, then to its smaller ones, until
    there is a star around each root; the number of rounds grows with the logarithm of the longest path. No step makes more
    links than there are. A round joins links with one row per node, so a hub's links can be split over tasks.
    """
    a, b = F.col("a"), F.col("b")
    stars = links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    while True:
        stars = cut(stars)
        ends = F.explode(F.array(F.struct(a, b), F.struct(b.alias("a"), a.alias("b")))).alias("end")
        nodes = stars.select(ends).select("end.a", "end.b").groupBy("a")
        nodes = nodes.agg(F.min(F.least(a, b)).alias("least"), F.count("*").alias("links"))
        if nodes.filter("least < a and links > 1").isEmpty():
            return stars.select(a.alias("node"), b.alias("root"))
        wide = stars.select(b.alias("a"), a.alias("b")).join(nodes.select("a", "least"), "a")
        wide = wide.select(b.alias("a"), F.col("least").alias("b"))
        least = wide.groupBy("a").agg(F.min("b").alias("least"))
        narrow = wide.join(least, "a")
        stars = narrow.select(F.when(b > F.col("least"), b).otherwise(a).alias("a"), F.col("least").alias("b")).distinct()
