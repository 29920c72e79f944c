"""Annual tons to loaded and empty trucks by vehicle type.

Truck counts are linear in tons until they are rounded. So the factor tables,
which know nothing of single flows, are first combined into one small table
with a row per distance band and commodity that holds the rates of all vehicle
types. Each flow finds its band by comparisons and its row by a broadcast lookup, works out its total in
plain columns, and is then laid out by vehicle type: no shuffle and no lambda,
all in generated code, and little enough of it for the JVM to compile.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlake.functions import half_even, settled
from freightlake.operators.checks import ModelInputError
from freightlake.operators.sizing import (
    MAX_BROADCAST_ROWS,
    beside,
    broadcast_if_small,
    local_if_small,
    together,
)

# Vehicle types, body types and the names of trade types.
VEHICLE_TYPES = ["SU", "TT", "CS", "DBL", "TPT"]
BODY_TYPES = [
    "auto",
    "livestock",
    "bulk",
    "flatbed",
    "tank",
    "dry_van",
    "reefer",
    "logging",
    "other",
]
CROSSING_TYPES = {
    "1": "domestic",
    "2": "border",
    "3": "border",
    "domestic": "domestic",
    "x-border": "border",
}

# Distance bands that a plan may hold.
MAX_BANDS = 1000


@dataclass(frozen=True)
class TruckFactors:
    """The three factor tables and how to read them.

    allocation: minimum_range, maximum_range, vehicle_type, allocation_factor
    equivalency: vehicle_type, sctg2 and one column per body type
    empty: crossing_type, body_type and one column per vehicle type
    """

    allocation: DataFrame
    equivalency: DataFrame
    empty: DataFrame
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES)
    bodies: Sequence[str] = tuple(BODY_TYPES)
    crossing_map: Mapping[str, str] = field(
        default_factory=lambda: dict(CROSSING_TYPES)
    )
    rescue_vehicle: str = "SU"
    max_broadcast_rows: int = MAX_BROADCAST_ROWS

    @property
    def crossings(self) -> list[str]:
        return sorted(set(self.crossing_map.values()))


# Takes rows, a stage and conditions by reason; gives the same rows back.
Watcher = Callable[[DataFrame, str, dict[str, Column]], DataFrame]


def truck_mode_filter(flows: DataFrame) -> DataFrame:
    """Flows by truck, whether the mode is a name or a code."""
    if flows.schema["dms_mode"].dataType.simpleString() == "string":
        return flows.filter(F.col("dms_mode") == "truck")
    return flows.filter(F.col("dms_mode") == 1)


def normalise_allocation_bands(allocation: DataFrame) -> DataFrame:
    """Allocation factors as shares that add up to one within a band."""
    band = Window.partitionBy("minimum_range", "maximum_range")
    share = F.col("allocation_factor") / F.sum("allocation_factor").over(band)
    return allocation.select(
        "minimum_range", "maximum_range", "vehicle_type", share.alias("alloc_factor")
    )


def unpivot_equivalency(
    equivalency: DataFrame, bodies: Sequence[str] = tuple(BODY_TYPES)
) -> DataFrame:
    """Trucks per ton by vehicle, commodity and body, positive factors only."""
    return equivalency.unpivot(
        ["vehicle_type", "sctg2"], list(bodies), "body_type", "equiv_factor"
    ).filter(F.col("equiv_factor") > 0)


def unpivot_empty(
    empty: DataFrame, vehicles: Sequence[str] = tuple(VEHICLE_TYPES)
) -> DataFrame:
    """Empty trucks per loaded truck by crossing, body and vehicle."""
    return empty.unpivot(
        ["crossing_type", "body_type"], list(vehicles), "vehicle_type", "empty_factor"
    )


def band_edges(bands: DataFrame) -> list[tuple]:
    """Lowest and highest distance of each band, in order.

    Bands are parameters: more than ``MAX_BANDS``, bands that overlap and bands
    without an edge are refused.
    """
    ranges = bands.select("minimum_range", "maximum_range")
    if bands.isLocal():
        edges = list({tuple(row) for row in ranges.collect()})
    else:
        edges = [tuple(row) for row in ranges.distinct().limit(MAX_BANDS + 1).collect()]
    if len(edges) > MAX_BANDS:
        raise ModelInputError(f"more than {MAX_BANDS} distance bands")
    if any(None in edge for edge in edges):
        raise ModelInputError("distance bands without an edge")
    edges.sort()
    for (low, high), after in zip(edges, [*edges[1:], None]):
        if low > high or (after is not None and after[0] <= high):
            raise ModelInputError(f"distance band {low} to {high} overlaps or is empty")
    return edges


def distance_band_lookup(
    flows: DataFrame,
    bands: DataFrame,
    distance: str = "wgt_dist",
    how: str = "left",
) -> DataFrame:
    """Add the band whose inclusive range holds the rounded distance.

    The few edges become a search tree of comparisons in the plan: no join, and
    a band costs the same however wide it is. Flows outside every band get NULLs,
    or are left out with ``how="inner"``.
    """
    edges = band_edges(bands)
    found = _numbered_bands(flows, edges, distance, how)
    sides = zip(("minimum_range", "maximum_range"), zip(*edges) if edges else ((), ()))
    listed = {
        name: F.get(F.array(*[F.lit(e) for e in side]).cast(f"array<{bands.schema[name].dataType.simpleString()}>"), F.nullif(F.col("_band"), F.lit(-1)))
        for name, side in sides
    }
    return found.select(*flows.columns, *[c.alias(n) for n, c in listed.items()])


def _numbered_bands(
    flows: DataFrame, edges: list[tuple], distance: str, how: str
) -> DataFrame:
    """Flows with ``_band``, the place of their band among ``edges``, else -1.

    It is never NULL, so that no filter repeats the comparisons in generated code.
    """
    # Distances are whole: where a band starts, and where what lies between starts.
    starts = [(math.ceil(low), at) for at, (low, _) in enumerate(edges)]
    bounds = dict([(math.floor(high) + 1, -1) for _, high in edges] + starts)
    steps = sorted(bounds.items())

    def search(part: list[tuple], before: int) -> Column:
        if not part:
            return F.lit(before)
        middle = len(part) // 2
        start, band = part[middle]
        below = F.col("_distance") < F.lit(float(start))
        return F.when(below, search(part[:middle], before)).otherwise(
            search(part[middle + 1 :], band)
        )

    nowhere = F.lit(float("-inf"))
    rounded = half_even(F.coalesce(F.col(distance).cast("double"), nowhere))
    placed = flows.withColumn("_distance", rounded)
    placed = placed.withColumn("_band", search(steps, -1)).drop("_distance")
    return placed.filter(F.col("_band") >= 0) if how == "inner" else placed


def _rate_of(vehicle: str) -> str:
    return f"_rate_{vehicle}"


def combined_factors(factors: TruckFactors) -> DataFrame:
    """Trucks per ton, ready to multiply: a row per band and commodity.

    Besides the rates it holds the cell (vehicle and body) with the highest
    rate, and the first cell, each with its empty factors. A commodity is left
    out of a band that lacks an allocation for one of its vehicle types.
    """
    most = factors.max_broadcast_rows
    allocation = local_if_small(factors.allocation, most)
    equivalency = local_if_small(factors.equivalency, most)
    empty = local_if_small(factors.empty, most)
    tables = (allocation, equivalency, empty)
    empties = together(unpivot_empty(empty, factors.vehicles), *tables)
    by_crossing = empties.groupBy("body_type", "vehicle_type").agg(
        *[
            F.max(
                F.when(F.col("crossing_type") == crossing, F.col("empty_factor"))
            ).alias(crossing)
            for crossing in factors.crossings
        ]
    )
    place = F.array_position(
        F.array(*[F.lit(body) for body in factors.bodies]), F.col("body_type")
    )
    positive = together(unpivot_equivalency(equivalency, factors.bodies), *tables)
    needed = positive.groupBy("sctg2").agg(F.count(F.lit(1)).alias("_needed"))
    cells = (
        positive.join(
            beside(normalise_allocation_bands(allocation), *tables), "vehicle_type"
        )
        .join(beside(by_crossing, *tables), ["body_type", "vehicle_type"], "left")
        .withColumn("rate", F.col("alloc_factor") * F.col("equiv_factor"))
        .withColumn("place", place)
    )
    facts = ["vehicle_type", "place", *factors.crossings]
    empty_rates = [
        F.sum(F.col("rate") * F.col(crossing)).alias(crossing)
        for crossing in factors.crossings
    ]
    per_cell = [
        F.count(F.lit(1)).alias("found"),
        F.sum("rate").alias("loaded"),
        F.min(F.struct((-F.col("rate")).alias("low"), *facts)).alias("largest"),
        F.min(F.struct(*facts)).alias("first"),
    ]
    key = ["minimum_range", "maximum_range", "sctg2"]
    by_vehicle = cells.groupBy(*key, "vehicle_type").agg(*per_cell, *empty_rates)
    entry = F.struct(
        "vehicle_type", "loaded", F.struct(*factors.crossings).alias("empty")
    )
    combined = by_vehicle.groupBy(*key).agg(
        F.sum("found").alias("_found"),
        F.sum("loaded").alias("_rate"),
        F.min("largest").alias("_largest"),
        F.min("first").alias("_first"),
        F.array_sort(F.collect_list(entry)).alias("_rates"),
        *[
            F.coalesce(
                F.sum(F.when(F.col("vehicle_type") == v, F.col("loaded"))), F.lit(0.0)
            ).alias(_rate_of(v))
            for v in factors.vehicles
        ],
        F.coalesce(
            F.bool_or(F.col("vehicle_type") == factors.rescue_vehicle), F.lit(False)
        ).alias("_can_rescue"),
    )
    return (
        combined.join(beside(needed, *tables), "sctg2")
        .filter(F.col("_found") == F.col("_needed"))
        .drop("_found", "_needed")
    )


def crossing_type(factors: TruckFactors, trade_type: str = "trade_type") -> Column:
    """Domestic or border, from either the code or the name of a trade type."""
    code = F.col(trade_type).cast("string")
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, crossing in factors.crossing_map.items():
        found = found.when(code == key, crossing)
    return found


def match_factors(
    flows: DataFrame, factors: TruckFactors, how: str = "left"
) -> DataFrame:
    """Flows with their band and combined factors, NULL where none apply."""
    most = factors.max_broadcast_rows
    edges = band_edges(factors.allocation)
    number = F.when(F.lit(False), F.lit(None).cast("int"))
    for at, (low, high) in enumerate(edges):
        same = (F.col("minimum_range") == low) & (F.col("maximum_range") == high)
        number = number.when(same, at)
    combined = combined_factors(factors).withColumn("_band", number)
    combined = broadcast_if_small(combined.drop("minimum_range", "maximum_range"), most)
    # Flows outside all bands meet no factors.
    return _numbered_bands(flows, edges, "wgt_dist", "left").join(combined, ["_band", "sctg2"], how)


REASONS = ("no tons", "no distance", "distance outside all bands", "no factors for commodity")


def _reject_reason() -> Column:
    tests = (
        F.col("exp_tons").isNull(),
        F.col("wgt_dist").isNull(),
        F.col("_band") < 0,
        F.col("_rate").isNull(),
    )
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for test, reason in zip(tests, REASONS):
        found = found.when(test, reason)
    return found


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _whole(column: Column) -> Column:
    return half_even(settled(column))


def sized_flows(
    flows: DataFrame,
    factors: TruckFactors,
    load_consolidation_factor: float = 1.0,
    watch: Watcher | None = None,
) -> DataFrame:
    """Truck flows with their rates, the number of trucks ``zed`` before any
    rounding, and which of the two rules for small flows applies:

    * ``_below_one``: less than one truck in all becomes one truck, of the
      kind with most of it (``_single``);
    * ``_rescued``: every vehicle type rounds to none, but there is more than
      one truck in all, which becomes one of the rescue vehicle.
    """
    by_truck = truck_mode_filter(flows)
    if watch is None:
        weighed = by_truck.filter(F.col("exp_tons").isNotNull())
        matched = match_factors(weighed, factors, how="inner")
    else:
        # Flows that go no further are counted on the way.
        reason = _reject_reason()
        every = match_factors(by_truck, factors).withColumn("_reason", reason)
        told = watch(every, "truckloads", {r: F.col("_reason") == r for r in REASONS})
        matched = told.filter(F.col("_reason").isNull()).drop("_reason")
    # Never NULL here, but only a default tells Spark so, and spares the null
    # checks of all that follows.
    tons = F.coalesce(
        F.col("exp_tons") * F.lit(load_consolidation_factor), F.lit(0.0)
    )
    sized = matched.withColumn("_tons", tons).withColumns(
        {
            "zed": settled(F.col("_tons") * F.col("_rate")),
            "_rounded": _total(
                [_whole(F.col("_tons") * F.col(_rate_of(v))) for v in factors.vehicles]
            ),
        }
    )
    # With no tons at all every cell is equal, and the first one is taken.
    no_tons = F.col("_tons") == 0

    def single(name: str) -> Column:
        return F.when(no_tons, F.col(f"_first.{name}")).otherwise(
            F.col(f"_largest.{name}")
        )

    return sized.withColumns(
        {
            "_crossing": crossing_type(factors),
            "_below_one": F.col("zed") < 1,
            "_rescued": (F.col("zed") > 1)
            & (F.col("_rounded") == 0)
            & F.col("_can_rescue"),
            "_single": single("vehicle_type"),
            "_single_empty": F.struct(*[single(c).alias(c) for c in factors.crossings]),
        }
    )


def trucks_by_vehicle(
    flows: DataFrame,
    factors: TruckFactors,
    load_consolidation_factor: float = 1.0,
    watch: Watcher | None = None,
) -> DataFrame:
    """One row per flow and vehicle type with plainly rounded loaded trucks
    (``_plain``), loaded trucks after the rules (``_loaded``), all loaded trucks
    of the flow (``_all_loaded``) and empty trucks (``_empty``)."""
    sized = sized_flows(flows, factors, load_consolidation_factor, watch)
    laid_out = sized.select(
        *flows.columns,
        "zed",
        *["_tons", "_crossing", "_below_one", "_rescued", "_rounded"],
        *["_single", "_single_empty"],
        F.inline("_rates"),
    )

    def by_crossing(rates: str) -> Column:
        chosen = F.when(F.lit(False), F.lit(None).cast("double"))
        for name in factors.crossings:
            chosen = chosen.when(F.col("_crossing") == name, F.col(f"{rates}.{name}"))
        return chosen

    is_single = F.col("_single") == F.col("vehicle_type")
    is_rescue = F.col("vehicle_type") == F.lit(factors.rescue_vehicle)
    plain = laid_out.withColumn("_plain", _whole(F.col("_tons") * F.col("loaded")))
    loaded = (
        F.when(F.col("_below_one"), is_single.cast("double"))
        .when(F.col("_rescued") & is_rescue, F.lit(1.0))
        .otherwise(F.col("_plain"))
    )
    all_loaded = F.when(F.col("_below_one") | F.col("_rescued"), F.lit(1.0))
    exact_empty = F.when(
        F.col("_below_one"), F.when(is_single, by_crossing("_single_empty"))
    ).otherwise(F.col("_tons") * by_crossing("empty"))
    return plain.withColumns(
        {
            "_loaded": loaded,
            "_all_loaded": all_loaded.otherwise(F.col("_rounded")),
            "_empty": F.coalesce(_whole(exact_empty), F.lit(0.0)),
        }
    )


def annual_truckloads(
    flows: DataFrame,
    factors: TruckFactors,
    load_consolidation_factor: float = 1.0,
    watch: Watcher | None = None,
) -> DataFrame:
    """One row per flow, vehicle type and status with the trucks of a year.

    Tons and value of a flow are split over its loaded trucks; empty ones
    carry none. ``zed`` is the number of trucks before any rounding. Flows for
    which no count can be made are in ``rejected_flows``; ``watch`` is handed them
    by reason to be counted in the same run.
    """
    by_vehicle = trucks_by_vehicle(flows, factors, load_consolidation_factor, watch)
    kept = [c for c in flows.columns if c not in ("exp_tons", "exp_value")]
    share = F.try_divide("_loaded", "_all_loaded")
    none = F.lit(0.0)

    def line(status: str, trucks: str, tons: Column, value: Column) -> Column:
        return F.struct(
            F.col(trucks).alias("annual_trucks"),
            F.lit(status).alias("status"),
            tons.alias("tons"),
            value.alias("value"),
        )

    lines = F.array(
        line("Loaded", "_loaded", share * F.col("exp_tons"), share * F.col("exp_value")),
        line("Empty", "_empty", none, none),
    )
    return (
        by_vehicle.select(*kept, "vehicle_type", "zed", F.inline(lines))
        .filter(F.col("annual_trucks") > 0)
        .select(
            *kept, "vehicle_type", "annual_trucks", "status", "tons", "value", "zed"
        )
    )


def rejected_flows(flows: DataFrame, factors: TruckFactors) -> DataFrame:
    """Truck flows for which no trucks can be worked out, with the reason."""
    matched = match_factors(truck_mode_filter(flows), factors)
    return (
        matched.withColumn("reason", _reject_reason())
        .filter(F.col("reason").isNotNull())
        .select(*flows.columns, "reason")
    )


def loaded_trucks(
    flows: DataFrame, factors: TruckFactors, load_consolidation_factor: float = 1.0
) -> DataFrame:
    """Plainly rounded loaded trucks per flow and vehicle type, zeros included."""
    return trucks_by_vehicle(flows, factors, load_consolidation_factor).select(
        *flows.columns, "zed", "vehicle_type", F.col("_plain").alias("annual_trucks")
    )


def min_one_truck(
    flows: DataFrame, factors: TruckFactors, load_consolidation_factor: float = 1.0
) -> DataFrame:
    """Flows worth less than one truck and the vehicle type of their one truck."""
    return (
        sized_flows(flows, factors, load_consolidation_factor)
        .filter("_below_one")
        .select(
            *flows.columns,
            "zed",
            F.col("_single").alias("vehicle_type"),
            F.lit(1.0).alias("annual_trucks"),
        )
    )


def rounding_rescue(
    flows: DataFrame, factors: TruckFactors, load_consolidation_factor: float = 1.0
) -> DataFrame:
    """Flows worth more than one truck whose vehicle types all round to none."""
    return (
        sized_flows(flows, factors, load_consolidation_factor)
        .filter("_rescued")
        .select(
            *flows.columns,
            "zed",
            F.lit(factors.rescue_vehicle).alias("vehicle_type"),
            F.lit(1.0).alias("annual_trucks"),
        )
    )


def empty_trucks(
    flows: DataFrame, factors: TruckFactors, load_consolidation_factor: float = 1.0
) -> DataFrame:
    """The empty lines of ``annual_truckloads``."""
    trucks = annual_truckloads(flows, factors, load_consolidation_factor)
    return trucks.filter(F.col("status") == "Empty")


def split_tons_value(
    flows: DataFrame, factors: TruckFactors, load_consolidation_factor: float = 1.0
) -> DataFrame:
    """The loaded lines of ``annual_truckloads``, with their tons and value."""
    trucks = annual_truckloads(flows, factors, load_consolidation_factor)
    return trucks.filter(F.col("status") == "Loaded")
