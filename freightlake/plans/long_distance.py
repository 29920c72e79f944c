"""Regional flows to daily long-distance trip matrices."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.operators.allocation import allocate_internal_ends
from freightlake.operators.daily import (
    TARGET_DAY,
    TARGET_WEEK,
    TRUCK_KEYS,
    sample_daily_trucks,
    temporal_allocation,
    temporal_gaps,
)
from freightlake.operators.flows import prepare_flows
from freightlake.operators.matrices import od_matrices
from freightlake.operators.tripends import missing_tripends, sample_tripends
from freightlake.operators.truckloads import (
    TruckFactors,
    annual_truckloads,
    rejected_flows,
)
from freightlake.plans.rejects import Watch, counted, together
from freightlake.sources import stored_once


def daily_trucks(
    flows: DataFrame,
    target_year: int,
    factors: TruckFactors,
    internal_regions: Collection[int] | None = None,
    outer_regions: DataFrame | None = None,
    target_week: int = TARGET_WEEK,
    target_day: int = TARGET_DAY,
    seed: int = 0,
    load_consolidation_factor: float = 1.0,
    calendar: DataFrame | None = None,
    day_method: str = "trucks",
    watch: Watch | None = None,
) -> DataFrame:
    """Flow database to the trucks of one day; ``flow_id`` names a flow.

    ``calendar`` and ``day_method`` are those of ``sample_daily_trucks``; ``watch``
    counts flows that make no trucks.
    """
    study = prepare_flows(
        flows,
        target_year,
        internal_regions=internal_regions,
        outer_regions=outer_regions,
    )
    annual = annual_truckloads(
        study, factors, load_consolidation_factor, watch.rows if watch else None
    )
    return sample_daily_trucks(
        annual, target_week, target_day, calendar=calendar, seed=seed, method=day_method
    )


def trip_matrices(
    flows: DataFrame,
    target_year: int,
    factors: TruckFactors,
    zonal_attractions: DataFrame,
    equivalencies: DataFrame,
    distributions: DataFrame,
    included_attractions: Collection[str] = ("Heavy",),
    phantom_zones: DataFrame | None = None,
    makeuse_coefficients: DataFrame | None = None,
    internal_regions: Collection[int] | None = None,
    outer_regions: DataFrame | None = None,
    seed: int = 0,
    strict: bool = False,
    load_consolidation_factor: float = 1.0,
    target_week: int = TARGET_WEEK,
    target_day: int = TARGET_DAY,
    calendar: DataFrame | None = None,
    day_method: str = "trucks",
    watch: Watch | None = None,
) -> DataFrame:
    """Flow database to matrices of one day's trucks by zone pair.

    Attractions are added up over all firms and then used for both ends, so
    they are stored once in the shared folder. With ``strict`` trucks without a
    zone or an hour raise; otherwise ``rejects`` counts them, and so does ``watch``
    in the run that works the matrices out.
    """
    trucks = daily_trucks(
        flows,
        target_year,
        factors,
        internal_regions,
        outer_regions,
        target_week,
        target_day,
        seed,
        load_consolidation_factor,
        calendar,
        day_method,
        watch,
    )
    ended = sample_tripends(
        trucks,
        stored_once(zonal_attractions, "attractions"),
        equivalencies,
        included_attractions,
        phantom_zones,
        makeuse_coefficients,
        keys=TRUCK_KEYS,
        seed=seed,
        strict=strict,
    )
    if watch:
        lacking = F.col("ozone").isNull() | F.col("dzone").isNull()
        ended = watch.rows(ended, "trip ends", {"no zone in region": lacking})
    timed = temporal_allocation(
        ended,
        distributions,
        keys=TRUCK_KEYS,
        seed=seed,
        strict=strict,
        watch=watch.rows if watch else None,
    )
    return od_matrices(timed, "ozone", "dzone")


def allocated_matrices(
    flows: DataFrame,
    target_year: int,
    factors: TruckFactors,
    zonal_attractions: DataFrame,
    equivalencies: DataFrame,
    distributions: DataFrame,
    inside: Collection[int],
    outer_regions: DataFrame | None = None,
    seed: int = 0,
    strict: bool = False,
    load_consolidation_factor: float = 1.0,
    target_week: int = TARGET_WEEK,
    target_day: int = TARGET_DAY,
    calendar: DataFrame | None = None,
    day_method: str = "trucks",
    watch: Watch | None = None,
) -> DataFrame:
    """The other route: ends ``inside`` are drawn from all zones, others coded.

    ``zonal_attractions`` is wide, a column for each vehicle type. ``watch`` counts
    what this route leaves out.
    """
    trucks = daily_trucks(
        flows,
        target_year,
        factors,
        None,
        outer_regions,
        target_week,
        target_day,
        seed,
        load_consolidation_factor,
        calendar,
        day_method,
        watch,
    )
    placed = allocate_internal_ends(
        trucks,
        inside,
        stored_once(zonal_attractions, "attractions"),
        equivalencies,
        keys=TRUCK_KEYS,
        seed=seed,
        strict=strict,
    )
    if watch:
        lacking = F.col("origin").isNull() | F.col("destination").isNull()
        placed = watch.rows(placed, "allocation", {"no zone for region": lacking})
    timed = temporal_allocation(
        placed,
        distributions,
        keys=TRUCK_KEYS,
        seed=seed,
        strict=strict,
        watch=watch.rows if watch else None,
    )
    return od_matrices(timed)


def rejects(
    flows: DataFrame,
    target_year: int,
    factors: TruckFactors,
    zonal_attractions: DataFrame,
    equivalencies: DataFrame,
    distributions: DataFrame,
    included_attractions: Collection[str] = ("Heavy",),
    phantom_zones: DataFrame | None = None,
    makeuse_coefficients: DataFrame | None = None,
    internal_regions: Collection[int] | None = None,
    outer_regions: DataFrame | None = None,
    seed: int = 0,
    load_consolidation_factor: float = 1.0,
) -> DataFrame:
    """``stage, reason, rows``: what ``trip_matrices`` leaves out or incomplete.

    Flows without trucks by reason, the day's trucks without a zone at an end, and
    those without a start hour.
    """
    study = prepare_flows(
        flows,
        target_year,
        internal_regions=internal_regions,
        outer_regions=outer_regions,
    )
    annual = annual_truckloads(study, factors, load_consolidation_factor)
    trucks = stored_once(sample_daily_trucks(annual, seed=seed), "trucks")
    ended = sample_tripends(
        trucks,
        stored_once(zonal_attractions, "attractions"),
        equivalencies,
        included_attractions,
        phantom_zones,
        makeuse_coefficients,
        keys=TRUCK_KEYS,
        seed=seed,
    )
    untimed = F.broadcast(temporal_gaps(trucks, distributions))
    return together(
        [
            counted("truckloads", F.col("reason"), rejected_flows(study, factors)),
            counted("trip ends", "no zone in region", missing_tripends(ended)),
            counted(
                "hours",
                "no hourly distribution",
                trucks.join(untimed, "vehicle_type", "left_semi"),
            ),
        ]
    )
