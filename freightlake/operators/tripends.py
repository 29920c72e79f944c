"""Draw the zones of interregional trip ends within their regions."""

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
    beside,
    broadcast_if_small,
    local_if_small,
    part_of,
)


def _all_zones(equivalencies: DataFrame, phantom_zones: DataFrame | None) -> DataFrame:
    if phantom_zones is None:
        return equivalencies
    return equivalencies.unionByName(phantom_zones)


def tripend_candidates(
    zonal_attractions: DataFrame,
    equivalencies: DataFrame,
    included_attractions: Collection[str] = ("Heavy",),
    phantom_zones: DataFrame | None = None,
) -> DataFrame:
    """Zones with their region, district and attraction by firm category.

    Zones without attractions and attractions without a region are both kept.
    """
    attractors = zonal_attractions.filter(is_in("truck_type", included_attractions))
    zones = _all_zones(equivalencies, phantom_zones)
    return zones.join(attractors.drop("truck_type"), "STDM_TAZ", "full").select(
        "STDM_TAZ",
        F.coalesce("ITD_district", F.lit(0)).alias("ITD_district"),
        "Category",
        "faf_region",
        "attractions",
    )


def missing_regions(
    trips: DataFrame, equivalencies: DataFrame, phantom_zones: DataFrame | None = None
) -> DataFrame:
    """Regions that trips use but that have no zone."""
    ends = F.explode(F.array("dms_orig", "dms_dest"))
    used = trips.select(ends.alias("faf_region")).distinct()
    known = _all_zones(equivalencies, phantom_zones).select("faf_region").distinct()
    return used.join(known, "faf_region", "left_anti")


def make_use_scaling(
    candidates: DataFrame,
    coefficients: DataFrame,
    kind: str,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Attractions by commodity, scaled by make (``M``) or use (``U``)
    coefficients of the firm category.

    A category's coefficients are one list, which a zone's row meets once and lays
    out in place: the few categories are no keys of a shuffle.

    Pairs without a coefficient count as zero and are left out, as are zeros.
    """
    entry = F.struct("sctg2", "coefficient")
    rows = coefficients.filter((F.col("MorU") == kind) & (F.col("coefficient") != 0))
    scaled = rows.groupBy("Category").agg(F.collect_list(entry).alias("_scaled"))
    side = part_of(scaled, coefficients)
    known = beside(side, candidates, coefficients)
    side = known if known is not side else broadcast_if_small(side, max_broadcast_rows)
    kept = [c for c in candidates.columns if c != "attractions"]
    return (
        candidates.join(side, "Category")
        .select(*kept, F.col("attractions").alias("_plain"), F.inline("_scaled"))
        .select(*kept, "sctg2", (F.col("coefficient") * F.col("_plain")).alias("attractions"))
        .filter(F.col("attractions") > 0)
    )


def collapse_attractors(
    candidates: DataFrame, extra_keys: Sequence[str] = ()
) -> DataFrame:
    """Total attraction by zone, district and region; none counts as zero."""
    return candidates.groupBy(
        *extra_keys, "STDM_TAZ", "ITD_district", "faf_region"
    ).agg(F.coalesce(F.sum("attractions"), F.lit(0.0)).alias("attractions"))


def _by_region_and_zone(attractors: DataFrame, *keys: str) -> DataFrame:
    """One row per zone; one that is listed in two districts counts twice."""
    return attractors.groupBy(*keys, "faf_region", "STDM_TAZ").agg(
        F.sum("attractions").alias("weight"), F.count(F.lit(1)).alias("listed")
    )


def _pools(
    candidates: DataFrame, coefficients: DataFrame | None, kind: str
) -> DataFrame:
    """Candidates of every pool.

    ``base`` holds plain attractions, ``equal`` the same zones all alike, and
    a pool per commodity, named by its code, the scaled attractions.
    """
    in_region = part_of(candidates.filter(F.col("faf_region").isNotNull()), candidates)
    base = _by_region_and_zone(collapse_attractors(in_region))
    totals = base.groupBy("faf_region").agg(F.sum("weight").alias("_total"))
    listed = F.col("listed").cast("double")
    plain = base.join(beside(totals, candidates), "faf_region").select(
        F.lit("base").alias("pool"),
        "faf_region",
        "STDM_TAZ",
        F.when(F.col("_total") == 0, listed).otherwise(F.col("weight")).alias("weight"),
    )
    if coefficients is None:
        return plain
    equal = base.select(
        F.lit("equal").alias("pool"), "faf_region", "STDM_TAZ", listed.alias("weight")
    )
    scaled = _by_region_and_zone(
        collapse_attractors(make_use_scaling(in_region, coefficients, kind), ["sctg2"]),
        "sctg2",
    )
    own = scaled.select(
        F.col("sctg2").cast("string").alias("pool"), "faf_region", "STDM_TAZ", "weight"
    )
    return plain.unionByName(equal).unionByName(own)


def sample_tripends(
    trips: DataFrame,
    zonal_attractions: DataFrame,
    equivalencies: DataFrame,
    included_attractions: Collection[str] = ("Heavy",),
    phantom_zones: DataFrame | None = None,
    makeuse_coefficients: DataFrame | None = None,
    keys: Sequence[str] = tuple(TRUCK_KEYS),
    seed: int = 0,
    strict: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``ozone`` and ``dzone``, drawn by attraction within each region.

    Make coefficients scale the origins of a commodity, use coefficients its
    destinations; commodities without any are not scaled. Where a region has
    no attraction left its zones are all alike. Trips to a region without zones
    keep NULL (``missing_tripends``), or raise with ``strict``.
    """
    if strict:
        require_none(
            missing_regions(trips, equivalencies, phantom_zones),
            "regions without a zone",
        )
    candidates = local_if_small(
        tripend_candidates(
            zonal_attractions, equivalencies, included_attractions, phantom_zones
        ),
        max_broadcast_rows,
    )
    if makeuse_coefficients is not None:
        makeuse_coefficients = local_if_small(makeuse_coefficients, max_broadcast_rows)
    placed = trips
    for zone, region, kind in (("ozone", "dms_orig", "M"), ("dzone", "dms_dest", "U")):
        pools = local_if_small(
            _pools(candidates, makeuse_coefficients, kind), max_broadcast_rows
        )
        renamed = pools.withColumnsRenamed({"faf_region": region, "pool": "_pool"})
        pools = part_of(renamed, pools)
        group = [region]
        if makeuse_coefficients is not None:
            rows = part_of(
                makeuse_coefficients.filter(F.col("MorU") == kind), makeuse_coefficients
            )
            placed = _with_pool(placed, pools, rows, region, max_broadcast_rows)
            group = ["_pool", region]
        placed = weighted_pick(
            placed,
            pools,
            group,
            "STDM_TAZ",
            "weight",
            keyed_uniform(*keys, stage=zone, seed=seed),
            zone,
            max_broadcast_rows=max_broadcast_rows,
        ).drop("_pool")
    if strict:
        require_none(missing_tripends(placed).select(*keys), "trips without a zone")
    return placed


def _with_pool(
    trips: DataFrame,
    pools: DataFrame,
    coefficients: DataFrame,
    region: str,
    max_broadcast_rows: int,
) -> DataFrame:
    """Add the pool of each trip: the commodity's own where it has any weight
    in the region, ``equal`` where its coefficients leave none, else ``base``."""
    scaled = coefficients.select("sctg2").distinct().withColumn("_scaled", F.lit(True))
    scaled = part_of(scaled, coefficients)
    # The names of the other pools are no codes and give NULL.
    own = (
        pools.select(F.col("_pool").try_cast("int").alias("sctg2"), region)
        .filter(F.col("sctg2").isNotNull())
        .distinct()
        .withColumn("_own", F.lit(True))
    )
    own = part_of(own, pools)
    return (
        trips.join(broadcast_if_small(scaled, max_broadcast_rows), "sctg2", "left")
        .join(broadcast_if_small(own, max_broadcast_rows), ["sctg2", region], "left")
        .withColumn(
            "_pool",
            F.when(F.col("_own"), F.col("sctg2").cast("string"))
            .when(F.col("_scaled"), "equal")
            .otherwise("base"),
        )
        .drop("_scaled", "_own")
    )


def missing_tripends(placed: DataFrame) -> DataFrame:
    """Trips that still lack a zone at either end."""
    return placed.filter(F.col("ozone").isNull() | F.col("dzone").isNull())
