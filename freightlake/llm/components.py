"""Connected components of a graph that is given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common


def _state(links: DataFrame) -> tuple:
    # Sums of hashes are kept within 32 bits each, so no sum overflows.
    mark = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mark)).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``u, v`` with the smallest number ``v`` reachable from ``u``, for u above v.

    ``links`` has whole numbers ``u`` and ``v``, in any direction and repeated at
    will. Large and small stars alternate until nothing changes: every vertex
    hands its larger neighbours, then its smaller ones, to the smallest it knows.
    The number of rounds grows with the logarithm of the largest component, and
    the links never grow beyond what they were. Each round ends in the shared
    folder; adaptive execution splits a vertex that has very many links.
    """
    greater, least = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    stars = common.stored_once(
        links.where("u <> v").select(greater, least).distinct(), "links"
    )
    before, now = None, _state(stars)
    while now != before and now[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = stars.groupBy("u").agg(F.min("v").alias("low"))
        # A vertex without a smaller neighbour is its own smallest.
        large = (
            both.where("v > u")
            .join(lowest, "u", "left")
            .select(F.col("v").alias("u"), F.coalesce("low", "u").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        handed = large.join(lowest, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("low").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                )
            ).alias("link")
        )
        small = handed.select("link.*").where("u <> v").distinct()
        stars = common.stored_once(small, "links")
        before, now = now, _state(stars)
    return stars
