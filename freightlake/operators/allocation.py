"""Regional trip ends to zones: fixed equivalents outside, draws inside."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.functions import is_in, keyed_uniform
from freightlake.operators.checks import require_none
from freightlake.operators.daily import TRUCK_KEYS
from freightlake.operators.pick import weighted_pick
from freightlake.operators.sizing import (
    MAX_BROADCAST_ROWS,
    broadcast_if_small,
    local_if_small,
)


def recode_region_to_zone(
    trips: DataFrame,
    equivalencies: DataFrame,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add origin and destination zones where a region has an equivalent.

    A region with several zones gives a row for each; see ``multi_zone_regions``.
    """
    zones = broadcast_if_small(
        equivalencies.select("faf_region", "STDM_TAZ"), max_broadcast_rows
    )
    starts = zones.select(
        F.col("faf_region").alias("dms_orig"), F.col("STDM_TAZ").alias("origin")
    )
    ends = zones.select(
        F.col("faf_region").alias("dms_dest"), F.col("STDM_TAZ").alias("destination")
    )
    return trips.join(starts, "dms_orig", "left").join(ends, "dms_dest", "left")


def multi_zone_regions(
    equivalencies: DataFrame, internal_regions: Collection[int]
) -> DataFrame:
    """Outside regions with more than one zone: their trips would multiply."""
    return (
        equivalencies.filter(~is_in("faf_region", internal_regions))
        .groupBy("faf_region")
        .agg(F.count(F.lit(1)).alias("zones"))
        .filter(F.col("zones") > 1)
    )


def combi_attractions(zonal_attractions: DataFrame) -> DataFrame:
    """Attraction of combination trucks by zone."""
    return zonal_attractions.select(
        "STDM_TAZ", (F.col("CS") + F.col("DBL") + F.col("TPT")).alias("combi")
    )


def allocate_internal_ends(
    trips: DataFrame,
    internal_regions: Collection[int],
    zonal_attractions: DataFrame,
    equivalencies: DataFrame,
    keys: Sequence[str] = tuple(TRUCK_KEYS),
    seed: int = 0,
    strict: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Zones of both trip ends.

    Ends in internal regions are drawn from all zones by the attraction of
    combination trucks, origin and destination independently. Other ends take
    the zone of their region. Ends without a zone stay NULL (``uncoded_ends``),
    or raise with ``strict``.
    """
    outside = equivalencies.filter(~is_in("faf_region", internal_regions))
    if strict:
        require_none(
            multi_zone_regions(equivalencies, internal_regions),
            "outside regions with more than one zone",
        )
    # Both ends are drawn from one table, and only for trips that end inside.
    weights = local_if_small(combi_attractions(zonal_attractions), max_broadcast_rows)
    placed = recode_region_to_zone(trips, outside, max_broadcast_rows)
    for end, region in (("origin", "dms_orig"), ("destination", "dms_dest")):
        inside = is_in(region, internal_regions)
        drawn = weighted_pick(
            placed,
            weights,
            [],
            "STDM_TAZ",
            "combi",
            F.when(inside, keyed_uniform(*keys, stage=end, seed=seed)),
            "_drawn",
            max_broadcast_rows=max_broadcast_rows,
        )
        placed = drawn.withColumn(
            end, F.when(inside, F.col("_drawn")).otherwise(F.col(end))
        ).drop("_drawn")
    if strict:
        require_none(uncoded_ends(placed), "regions without a zone")
    return placed


def uncoded_ends(placed: DataFrame) -> DataFrame:
    """Regions of trip ends that got no zone, with the number of such ends."""
    ends = F.array(
        F.struct(F.col("dms_orig").alias("faf_region"), F.col("origin").alias("zone")),
        F.struct(
            F.col("dms_dest").alias("faf_region"), F.col("destination").alias("zone")
        ),
    )
    return (
        placed.select(F.inline(ends))
        .filter(F.col("zone").isNull())
        .groupBy("faf_region")
        .agg(F.count(F.lit(1)).alias("uncoded_ends"))
    )
