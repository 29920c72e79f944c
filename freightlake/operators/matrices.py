"""Trip lists to origin-destination matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.operators.checks import require_none
from freightlake.operators.crosstab import crosstab_counts

# Vehicle types of the two truck groups, and the periods.
TRUCK_GROUPS = {"SU": "SUT", "TT": "SUT", "CS": "MUT", "DBL": "MUT", "TPT": "MUT"}
PERIODS = ["AM", "MD", "PM", "NT"]
MATRIX_NAMES = [
    f"{period}_{group}".lower() for period in PERIODS for group in ("SUT", "MUT")
]


def truck_group_join(trips: DataFrame) -> DataFrame:
    """Add the truck group of the vehicle type; unknown types get NULL."""
    group = F.when(F.lit(False), F.lit(None).cast("string"))
    for vehicle, name in TRUCK_GROUPS.items():
        group = group.when(F.col("vehicle_type") == vehicle, name)
    return trips.withColumn("truck_group", group)


def crosstab_trips_margins(trips: DataFrame) -> DataFrame:
    """Trips by truck group and vehicle type with totals."""
    return crosstab_counts(
        truck_group_join(trips), "truck_group", "vehicle_type", "trips"
    )


def _named(trips: DataFrame) -> DataFrame:
    return truck_group_join(trips).withColumn(
        "_matrix", F.lower(F.concat("period", F.lit("_"), "truck_group"))
    )


def unlisted_trips(
    trips: DataFrame, names: Sequence[str] = tuple(MATRIX_NAMES)
) -> DataFrame:
    """Trips that belong to none of the matrices."""
    listed = F.coalesce(F.col("_matrix").isin(list(names)), F.lit(False))
    return _named(trips).filter(~listed).drop("_matrix")


def od_matrices(
    trips: DataFrame,
    origin: str = "origin",
    destination: str = "destination",
    names: Sequence[str] = tuple(MATRIX_NAMES),
    strict: bool = False,
) -> DataFrame:
    """Trips by zone pair, one column per period and truck group.

    The columns are known, so all are counted in one aggregation. Trips that
    fit none of them are in ``unlisted_trips``, or raise with ``strict``; they
    are counted in the extra column ``unlisted``.
    """
    if strict:
        require_none(
            unlisted_trips(trips, names).select("vehicle_type", "period").distinct(),
            "trips outside the listed matrices",
        )
    counts = [
        F.count_if(F.col("_matrix") == name).alias(name) for name in names
    ]
    listed = F.coalesce(F.col("_matrix").isin(list(names)), F.lit(False))
    return (
        _named(trips)
        .groupBy(F.col(origin).alias("origin"), F.col(destination).alias("destination"))
        .agg(*counts, F.count_if(~listed).alias("unlisted"))
    )
