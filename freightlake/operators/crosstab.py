"""Two-way tables with totals, in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "Sum"


def _with_margins(
    df: DataFrame, row: str, column: str, cell: Column, name: str
) -> DataFrame:
    """Cells are added up first, so the cube only sees one row per cell."""
    cells = (
        df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(row, column)
        .agg(cell.alias(name))
    )
    totals = cells.cube(row, column).agg(
        F.sum(name).alias(name),
        F.grouping(row).alias("_all_rows"),
        F.grouping(column).alias("_all_columns"),
    )

    def label(key: str, is_total: str) -> Column:
        text = F.col(key).cast("string")
        return F.when(F.col(is_total) == 1, TOTAL).otherwise(text).alias(key)

    return totals.select(
        label(row, "_all_rows"), label(column, "_all_columns"), F.col(name)
    )


def crosstab_sums(df: DataFrame, row: str, column: str, measure: str) -> DataFrame:
    """Sum of ``measure`` by two keys, with totals labelled ``Sum``."""
    return _with_margins(df, row, column, F.sum(measure), measure)


def crosstab_counts(
    df: DataFrame, row: str, column: str, name: str = "n"
) -> DataFrame:
    """Row counts by two keys, with totals labelled ``Sum``."""
    return _with_margins(df, row, column, F.count(F.lit(1)), name)
