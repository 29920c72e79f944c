"""Exact running totals over a whole table, with no task seeing all of it.

A window without a partition sorts the table in one task. Here the ordering
ids are cut into blocks of 4,096 consecutive values, 65,536 of those make a
larger block, and so on. Totals go up that ladder by ordinary aggregation,
offsets come down it by equi-joins, and every window sees one block only,
whatever the ids look like. The rows are worked out once and written, and read from
there for sums and for the result. Only as many steps are taken as the range of the ids
calls for; three leave a million blocks at most, even where ids are scattered
over all of 64 bits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from freightlake.operators.checks import ModelInputError
from freightlake.sources.tables import stored_once

# Low bits of the id that are inside a block, at each step of the ladder.
BLOCK_BITS = (12, 28, 44)

# Blocks that one last window may put in order.
TOP_BLOCKS = 65_536
_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def _steps(span: int, block_bits: Sequence[int]) -> list[int]:
    """The steps needed for ids that are ``span`` apart at most."""
    return [
        bits
        for less, bits in zip([None, *block_bits], block_bits)
        if less is None or span >> less > TOP_BLOCKS
    ]


def _written(df: DataFrame, order: str) -> tuple[DataFrame, int]:
    """The rows, worked out and written once, and how far apart their ids are.

    Sums, offsets and rows are read from what was written; the ends of the ids are
    seen on the way.
    """
    wide = "decimal(20,0)"
    ends = Observation()
    watched = df.observe(
        ends, F.min(order).cast(wide).alias("low"), F.max(order).cast(wide).alias("high")
    )
    stored = stored_once(watched, "ordered")
    low, high = ends.get["low"], ends.get["high"]
    return stored, 0 if low is None else int(high - low)


def without_id(df: DataFrame, order: str) -> DataFrame:
    """Rows that running totals leave out for want of an id."""
    return df.filter(F.col(order).isNull())


def _same(keys: Sequence[str]) -> Column:
    """Equal keys on both sides, ``l`` and ``r``; NULL equals NULL."""
    tests = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, tests)


def running_totals(
    df: DataFrame,
    values: Sequence[str],
    order: str,
    by: Sequence[str] = (),
    prefix: str = "through_",
    last: str | None = None,
    block_bits: Sequence[int] = BLOCK_BITS,
) -> DataFrame:
    """Add the running total of each of ``values`` up to and with each row.

    ``order`` is an integer id, unique within ``by``. Rows without an id have no
    place in the order: they are left out, of the totals too, and ``without_id``
    gives them back. A NULL in ``by`` is a group like any other. Decimal values
    give totals that do not depend on the layout of the data. ``last`` names a
    column to hold the highest id within ``by``.
    """
    df = df.filter(F.col(order).isNotNull())
    kind = df.schema[order].dataType.simpleString()
    if kind not in _INTEGRAL:
        raise ModelInputError(f"running totals need an integer id, {order} is {kind}")
    by = list(by)

    def block(level: int) -> str:
        return f"_block{level}"

    df, span = _written(df, order)
    steps = _steps(span, block_bits)
    widths = [bits - less for less, bits in zip([0, *steps], steps)]
    levels = len(widths)

    def up(lower: str, level: int):
        wider = F.shiftright(F.col(lower).cast("bigint"), widths[level - 1])
        return wider.alias(block(level))

    rows = df.select("*", up(order, 1))
    ladder = [
        rows.groupBy(*by, block(1)).agg(
            *[F.sum(v).alias(v) for v in values], F.max(order).alias("_last")
        )
    ]
    for level in range(2, levels + 1):
        below = ladder[-1].select("*", up(block(level - 1), level))
        ladder[-1] = below
        ladder.append(
            below.groupBy(*by, block(level)).agg(
                *[F.sum(v).alias(v) for v in values], F.max("_last").alias("_last")
            )
        )

    whole = Window.partitionBy(*by)
    top = whole.orderBy(block(levels)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = ladder[-1].select(
        *by,
        block(levels),
        F.max("_last").over(whole).alias("_last"),
        *[(F.sum(v).over(top) - F.col(v)).alias(f"_before_{v}") for v in values],
    )
    for level in range(levels - 1, 0, -1):
        outer = [*by, block(level + 1)]
        inner = (
            Window.partitionBy(*outer)
            .orderBy(block(level))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        offsets = (
            ladder[level - 1]
            .drop("_last")
            .alias("l")
            .join(offsets.alias("r"), _same(outer))
            .select("l.*", "r._last", *[f"r._before_{v}" for v in values])
            .select(
                *by,
                block(level),
                "_last",
                *[
                    (F.col(f"_before_{v}") + F.sum(v).over(inner) - F.col(v)).alias(
                        f"_before_{v}"
                    )
                    for v in values
                ],
            )
        )
    within = (
        Window.partitionBy(*by, block(1))
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = (
        rows.alias("l")
        .join(offsets.alias("r"), _same([*by, block(1)]))
        .select("l.*", "r._last", *[f"r._before_{v}" for v in values])
    )
    return joined.select(
        *df.columns,
        *([F.col("_last").alias(last)] if last else []),
        *[
            (F.col(f"_before_{v}") + F.sum(v).over(within)).alias(f"{prefix}{v}")
            for v in values
        ],
    )


def bucket_round(
    df: DataFrame, values: Sequence[str], order: str, by: Sequence[str] = ()
) -> DataFrame:
    """Round amounts to whole numbers, carrying each fraction to the next row.

    The last row takes what is left, rounded half to even, so the total is
    kept. With running totals S, a row gets floor(S) - floor(S before it).
    """
    totals = running_totals(df, values, order, by, "_through_", last="_final")
    is_last = F.col(order) == F.col("_final")

    def rounded(v: str):
        through = F.col(f"_through_{v}")
        before = F.floor(through - F.col(v))
        left = F.bround(through - before)
        return F.when(is_last, left).otherwise(F.floor(through) - before).cast("bigint")

    return totals.select(
        *[rounded(c).alias(c) if c in values else F.col(c) for c in df.columns]
    )
