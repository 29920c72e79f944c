"""What the stages of a plan leave out, counted alike for all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def counted(stage: str, reason: str | Column, rows: DataFrame) -> DataFrame:
    """``stage, reason, rows``: number of rejected rows by reason.

    A fixed reason always has a row, with 0 where nothing was rejected.
    """
    if isinstance(reason, str):
        summed = rows.agg(F.count(F.lit(1)).alias("rows"))
        reason = F.lit(reason)
    else:
        summed = rows.groupBy(reason.alias("_reason")).agg(F.count(F.lit(1)).alias("rows"))
        reason = F.col("_reason")
    return summed.select(F.lit(stage).alias("stage"), reason.alias("reason"), "rows")


def together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class Watch:
    """Counts what a plan leaves out while it runs, without running it again.

    Stages hand their rows to ``rows`` on the way; once an action has run on the
    result, ``counts`` has the numbers. They are metrics of that run: where an
    executor is lost, rows of tasks that ran again count again.
    """

    def __init__(self) -> None:
        self._parts: list[tuple[str, list[str], Observation]] = []

    def rows(self, df: DataFrame, stage: str, reasons: dict[str, Column]) -> DataFrame:
        """``df``, with the number of rows counted to which each reason applies."""
        seen = Observation()
        self._parts.append((stage, list(reasons), seen))
        counts = [F.count_if(c).alias(f"n{i}") for i, c in enumerate(reasons.values())]
        return df.observe(seen, *counts)

    def counts(self) -> list[tuple[str, str, int]]:
        return [
            (stage, reason, seen.get[f"n{i}"])
            for stage, reasons, seen in self._parts
            for i, reason in enumerate(reasons)
        ]

    def frame(self, spark: SparkSession, optional: tuple[str, ...] = ()) -> DataFrame:
        """``stage, reason, rows``; reasons of ``optional`` stages only where any."""
        found = [c for c in self.counts() if c[2] or c[0] not in optional]
        return spark.createDataFrame(found, "stage string, reason string, rows bigint")
