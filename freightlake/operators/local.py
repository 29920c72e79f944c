"""Destinations of local trips by trip length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.functions import half_even, keyed_uniform
from freightlake.operators.checks import require_none
from freightlake.operators.pick import weighted_pick
from freightlake.operators.sizing import (
    MAX_BROADCAST_ROWS,
    broadcast_if_small,
)
from freightlake.operators.truckloads import VEHICLE_TYPES

TRIP_KEYS = ["pfirmID", "vehicle_type", "trip_number"]
MAX_DISTANCE = 120.0


def skimless_origins(trips: DataFrame, skims: DataFrame) -> DataFrame:
    """Origins of trips that no skim starts from."""
    return trips.select("origin").distinct().join(
        skims.select("origin").distinct(), "origin", "left_anti"
    )


def trip_length_targets_long(
    targets: DataFrame,
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES),
    max_distance: float = MAX_DISTANCE,
) -> DataFrame:
    """Share of trips by whole distance and vehicle type, on the full grid.

    Distances without a target appear once, with no vehicle type and no share.
    """
    spark = targets.sparkSession
    grid = spark.range(int(max_distance) + 1).select(
        F.col("id").cast("int").alias("distance")
    )
    long = targets.unpivot(["distance"], list(vehicles), "vehicle_type", "share")
    return grid.join(long, "distance", "left")


def banded_skims(
    skims: DataFrame,
    targets: DataFrame,
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES),
    max_distance: float = MAX_DISTANCE,
    allow_intrazonals: bool = True,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    with_home: bool = False,
) -> DataFrame:
    """Zone pairs within reach, for each vehicle type with the share of trips
    of that length; NULL where there is no target.

    ``with_home`` adds the pairs of a zone with itself that are not within reach,
    and a column ``near`` that is false for them.
    """
    home = F.col("origin") == F.col("destination")
    within = F.coalesce(F.col("value") <= max_distance, F.lit(False))
    if not allow_intrazonals:
        within &= ~home
    near = skims.filter(within)
    if with_home:
        near = skims.withColumn("near", within).filter(F.col("near") | home)
    banded = near.withColumns(
        {
            "distance": half_even(F.col("value") + 0.5).cast("int"),
            "vehicle_type": F.explode(F.array(*[F.lit(v) for v in vehicles])),
        }
    )
    long = trip_length_targets_long(targets, vehicles, max_distance).filter(
        F.col("vehicle_type").isNotNull()
    )
    return banded.join(
        broadcast_if_small(long, max_broadcast_rows), ["distance", "vehicle_type"], "left"
    )


def append_skim_distance(
    trips: DataFrame, skims: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Add the distance between a trip's zones as ``wgt_dist``."""
    distances = skims.select(
        "origin", "destination", F.col("value").alias("wgt_dist")
    )
    narrow = broadcast_if_small(distances, max_broadcast_rows)
    return trips.join(narrow, ["origin", "destination"], "left")


def sample_local_destinations(
    trips: DataFrame,
    skims: DataFrame,
    targets: DataFrame,
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES),
    max_distance: float = MAX_DISTANCE,
    allow_intrazonals: bool = True,
    keys: Sequence[str] = tuple(TRIP_KEYS),
    seed: int = 0,
    strict: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    route: str = "stretches",
) -> DataFrame:
    """Draw a destination by trip length and add the distance to it.

    Candidates carry their distance, so the skims are read once; a zone's distance
    to itself comes along with the number of zones within its reach.

    A trip with no zone within reach stays in its own zone. One whose zones
    within reach have no share at all gets no destination
    (``undrawn_destinations``), or raises with ``strict``.
    """
    if strict:
        require_none(skimless_origins(trips, skims), "origins without skims")
    reach = banded_skims(
        skims.select("origin", "destination", "value"),
        targets,
        vehicles,
        max_distance,
        allow_intrazonals,
        max_broadcast_rows,
        with_home=True,
    ).select("origin", "vehicle_type", "destination", "share", "near", F.col("value").alias("wgt_dist"))
    home = F.col("origin") == F.col("destination")
    drawn = weighted_pick(
        trips,
        reach,
        ["origin", "vehicle_type"],
        "destination",
        "share",
        keyed_uniform(*keys, stage="destination", seed=seed),
        "destination",
        "_within_reach",
        max_broadcast_rows=max_broadcast_rows,
        payload=["wgt_dist"],
        eligible="near",
        beside={"_home": F.max(F.when(home, F.col("wgt_dist")))},
        route=route,
    )
    stays = F.col("_within_reach").isNull()
    placed = drawn.withColumns(
        {
            "destination": F.when(stays, F.col("origin")).otherwise(F.col("destination")),
            "wgt_dist": F.when(stays, F.col("_home")).otherwise(F.col("wgt_dist")),
        }
    ).drop("_within_reach", "_home")
    if strict:
        require_none(undrawn_destinations(placed).select(*keys), "no destination for")
    return placed


def undrawn_destinations(placed: DataFrame) -> DataFrame:
    return placed.filter(F.col("destination").isNull())
