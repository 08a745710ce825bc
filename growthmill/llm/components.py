"""Connected components by alternating large and small stars, with hubs spread over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import join_by_share, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node of ``edges`` but the roots.

    ``edges`` has the long columns ``a`` and ``b``. Loops and repeated edges do no harm; no edges give no rows.
    Each half round hangs neighbours under the smallest node around; the number of rounds grows with the
    logarithm of the longest path. Minima are aggregated before they are joined back.
    """
    high_low = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars, mark = staged(high_low, "edges"), None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = staged(both.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n")), "around")
        large = join_by_share(both, around, ["a"], "n", ["b"]).where("b > a")
        large = large.select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()
        large = staged(large, "large-stars")
        below = staged(large.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n")), "below")
        small = join_by_share(large, below, ["a"], "n", ["b"])
        hung = small.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = staged(hung.unionAll(below.select("a", F.col("low").alias("b"))).distinct(), "small-stars")
