"""One row per counted item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Items laid out from one row at a time, and by one task for one row.
CHUNK = 4096


def lay_out(
    df: DataFrame,
    count: Column,
    number: str,
    keys: Sequence[str],
    chunk: int = CHUNK,
    spread: bool = True,
) -> DataFrame:
    """Repeat each row ``count`` times, numbered from 1 in ``number``.

    Rows with no count, or none to repeat, are left out. A row is first cut
    into chunks; with ``spread`` the chunks are shuffled before they are laid
    out, so a row that stands for a large part of all items does not stay in
    one task. The number of tasks is given, as adaptive execution would judge
    the chunks by their bytes, not by the items in them, and put them together.
    """
    counted = df.withColumn("_items", count.cast("bigint")).filter(F.col("_items") > 0)
    last_chunk = F.floor((F.col("_items") - 1) / chunk)
    chunks = counted.withColumn("_chunk", F.explode(F.sequence(F.lit(0), last_chunk)))
    if spread:
        spark = df.sparkSession
        tasks = max(
            int(spark.conf.get("spark.sql.shuffle.partitions")),
            spark.sparkContext.defaultParallelism,
        )
        chunks = chunks.repartition(tasks, *keys, "_chunk")
    first = F.col("_chunk") * chunk + 1
    final = F.least(first + (chunk - 1), F.col("_items"))
    return chunks.withColumn(number, F.explode(F.sequence(first, final))).drop(
        "_chunk", "_items"
    )
