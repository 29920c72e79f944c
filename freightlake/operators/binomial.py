"""How many of a number of items are chosen, and which, without one row for each.

A line of n trucks of which each travels with probability p needs two draws, not n:
how many travel is a binomial number, and which of them it is a sample of their
numbers without replacement. Lines of very many trucks are cut into chunks, whose
numbers are independent, so that a chunk has few chosen items.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.functions import keyed_uniform

# Chosen items that a chunk has on average at most, and the most that inversion
# looks at; beyond it is less than the resolution of a draw. The chance that a
# whole chunk has none stays far above the least double.
MEAN_CHOSEN = 64
MOST_CHOSEN = 220
LARGEST_CHUNK = 1 << 20


def chunk_size(p: float) -> int:
    """Items of a chunk, for the rarer of chosen and left out items."""
    rarer = min(p, 1 - p)
    return LARGEST_CHUNK if rarer <= 0 else max(1, min(LARGEST_CHUNK, int(MEAN_CHOSEN / rarer)))


def binomial(n: Column, p: float, uniform: Column) -> Column:
    """Number of chosen items among ``n``, by inversion of the uniform number.

    Terms follow from each other, P(k) = P(k-1) (n-k+1)/k p/(1-p). ``p`` is at most
    a half and n p at most ``MEAN_CHOSEN``.
    """
    odds = p / (1 - p)
    first = F.pow(F.lit(1 - p), n)
    start = F.struct(first.alias("term"), first.alias("upto"), F.lit(0).alias("k"))

    def step(at: Column, k: Column) -> Column:
        term = at["term"] * (n - k + 1) / k * odds
        further = F.struct(
            term.alias("term"), (at["upto"] + term).alias("upto"), k.cast("int").alias("k")
        )
        return F.when(uniform < at["upto"], at).otherwise(further)

    counts = F.sequence(F.lit(1).cast("bigint"), F.least(n, F.lit(MOST_CHOSEN)).cast("bigint"))
    return F.aggregate(counts, start, step, lambda at: at["k"]).cast("bigint")


def some_numbers(n: Column, k: Column, uniform_of: Callable[[Column], Column]) -> Column:
    """``k`` different numbers from 1 to ``n``, every such set alike.

    For j from n-k+1 to n one number up to j is drawn; j itself takes the place of
    one that is there already. ``uniform_of`` gives the draw for j.
    """
    none = F.array().cast("array<bigint>")

    def step(chosen: Column, j: Column) -> Column:
        drawn = F.floor(uniform_of(j) * j).cast("bigint") + 1
        return F.array_append(chosen, F.when(F.array_contains(chosen, drawn), j).otherwise(drawn))

    each = F.aggregate(F.sequence(n - k + 1, n), none, step)
    return F.when(k > 0, each).otherwise(none)


def choose_items(
    df: DataFrame,
    count: Column,
    number: str,
    p: float,
    keys: Sequence[str],
    stage: str,
    seed: int = 0,
    size: int | None = None,
) -> DataFrame:
    """Rows for the chosen ones of ``count`` items of each row, numbered ``number``.

    Each item is chosen with probability ``p``, independently of the others. Rows of
    no item give none. Nothing is shuffled: most rows are left out by one
    comparison, before any number is drawn.
    """
    if not 0 <= p <= 1 or math.isnan(p):
        raise ValueError(f"{p} is no probability")
    size = size or chunk_size(p)
    rarer, all_but = min(p, 1 - p), p > 0.5
    counted = df.withColumn("_items", count.cast("bigint")).filter(F.col("_items") > 0)
    first = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_items") - 1) / size))
    chunks = counted.withColumn("_chunk", F.explode(first)).withColumn(
        "_n", F.least(F.lit(size).cast("bigint"), F.col("_items") - F.col("_chunk") * size)
    )
    drawn = chunks.withColumn("_u", keyed_uniform(*keys, "_chunk", stage=f"{stage} number", seed=seed))
    if not all_but:
        drawn = drawn.filter(F.col("_u") >= F.pow(F.lit(1 - rarer), F.col("_n")))
    drawn = drawn.withColumn("_k", binomial(F.col("_n"), rarer, F.col("_u")))
    some = some_numbers(
        F.col("_n"),
        F.col("_k"),
        lambda j: keyed_uniform(*keys, "_chunk", j, stage=f"{stage} item", seed=seed),
    )
    if all_but:
        every = F.sequence(F.lit(1).cast("bigint"), F.col("_n"))
        some = F.array_except(every, some)
    return drawn.withColumn("_item", F.explode(some)).withColumn(
        number, F.col("_chunk") * size + F.col("_item")
    ).drop("_items", "_chunk", "_n", "_u", "_k", "_item")
