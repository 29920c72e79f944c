"""Assigned network links against traffic counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.functions import half_even, highest, is_in, lowest
from freightlake.operators.checks import (
    missing_columns,
    require_columns,
    require_none,
)
from freightlake.operators.crosstab import crosstab_counts
from freightlake.operators.sizing import MAX_BROADCAST_ROWS, broadcast_if_small

# Link columns, link types left out and names of area types.
LINK_COLUMNS = [
    "A",
    "B",
    "PCT_TRUCK",
    "FINALCOUNT",
    "AT",
    "MILES",
    "TYP",
    "SRC",
]
PERIOD_COLUMNS = {"SUT": "SUT", "MUT": "MUT", "CTIME": "travel_time"}
LEFT_OUT = ["Centroid", "Ramp"]
AREA_TYPES = ["CBD", "Urban", "Rural"]


def required_link_columns(period: str) -> list[str]:
    return [f"{name}{period}" for name in PERIOD_COLUMNS] + LINK_COLUMNS


def missing_link_columns(links: DataFrame, period: str) -> list[str]:
    return missing_columns(links, required_link_columns(period))


def link_columns_check(links: DataFrame, period: str) -> DataFrame:
    """``name, present, filled``: each column a period needs, whether the table has
    it, and the rows in which it is not NULL."""
    needed = required_link_columns(period)
    there = [name for name in needed if name in links.columns]
    counted = links.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in there])
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(name in there).alias("present"),
            (F.col(f"`{name}`") if name in there else F.lit(0)).cast("bigint").alias("filled"),
        )
        for name in needed
    ]
    return counted.select(F.inline(F.array(*rows)))


def link_id(combine_directions: bool = True) -> Column:
    """Name of a link by its nodes, the same both ways if combined."""
    a, b = F.col("A").cast("bigint"), F.col("B").cast("bigint")
    if combine_directions:
        a, b = lowest(a, b), highest(a, b)
    return F.concat(a.cast("string"), F.lit("-"), b.cast("string"))


def link_summary(
    links: DataFrame,
    period: str,
    area_types: Sequence[str] = tuple(AREA_TYPES),
    combine_directions: bool = True,
    count_direction: str = "two-way",
) -> DataFrame:
    """Counted links with assigned trucks, daily truck count and link id."""
    require_columns(links, required_link_columns(period), "link table")
    counted = links.filter(
        (F.col("PCT_TRUCK") > 0) & (F.col("FINALCOUNT") > 0) & ~is_in("TYP", LEFT_OUT)
    )
    daily = half_even(F.col("PCT_TRUCK") * F.col("FINALCOUNT"))
    if count_direction != "two-way":
        daily = half_even(daily / 2)
    names = F.array(*[F.lit(name) for name in area_types])
    sut, mut = F.col(f"SUT{period}"), F.col(f"MUT{period}")
    return counted.select(
        sut.alias("SUT"),
        mut.alias("MUT"),
        F.col(f"CTIME{period}").alias("travel_time"),
        "PCT_TRUCK",
        "FINALCOUNT",
        "MILES",
        "TYP",
        "SRC",
        (sut + mut).alias("total_assigned"),
        F.lit(period).alias("period"),
        F.get(names, F.col("AT") - 1).alias("area_type"),
        link_id(combine_directions).alias("linkID"),
        daily.alias("daily_count"),
    )


def first_districts(
    definitions: DataFrame, order: str, combine_directions: bool = True
) -> DataFrame:
    """District of each link by its first definition; a missing one is 0."""
    return (
        definitions.select(
            link_id(combine_directions).alias("linkID"),
            F.coalesce("DistrictID", F.lit(0)).alias("DistrictID"),
            order,
        )
        .groupBy("linkID")
        .agg(F.min_by("DistrictID", order).alias("DistrictID"))
    )


def link_districts(
    summary: DataFrame,
    definitions: DataFrame,
    order: str,
    combine_directions: bool = True,
    strict: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add the district of each link; ``order`` ranks the definitions.

    Links without one keep NULL (``undefined_links``), or raise with ``strict``.
    """
    districts = first_districts(definitions, order, combine_directions)
    joined = summary.join(
        broadcast_if_small(districts, max_broadcast_rows), "linkID", "left"
    )
    if strict:
        require_none(undefined_links(joined), "links without a district")
    return joined


def undefined_links(joined: DataFrame) -> DataFrame:
    return joined.filter(F.col("DistrictID").isNull()).select("linkID").distinct()


def crosstab_links_margins(joined: DataFrame) -> DataFrame:
    """Links by type and district with totals."""
    return crosstab_counts(joined, "TYP", "DistrictID", "links")
