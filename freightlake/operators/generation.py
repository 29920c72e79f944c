"""Truck trips and zonal attractions from firm employment."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.functions import half_even, is_in
from freightlake.operators.checks import require_none
from freightlake.operators.expand import lay_out
from freightlake.operators.prefix import bucket_round, without_id
from freightlake.operators.profile import percent
from freightlake.operators.sizing import MAX_BROADCAST_ROWS, broadcast_if_small
from freightlake.operators.truckloads import VEHICLE_TYPES

# Counties taken as urban, their scaling, and the commodity code
# of local trips.
URBAN_COUNTIES = ["Ada", "Canyon"]
URBAN_FACTOR = "0.4"
LOCAL_COMMODITY = 99

RATE_TYPE = "decimal(16,12)"
EXACT_SUM = "decimal(38,4)"


def missing_rates(firms: DataFrame, rates: DataFrame) -> DataFrame:
    """Sectors of firms that have no rates."""
    return firms.select("sector").distinct().join(
        rates.select("sector").distinct(), "sector", "left_anti"
    )


def zonal_attractions(
    firms: DataFrame,
    rates: DataFrame,
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES),
    output: str = "wide",
    by_category: bool = False,
    strict: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Daily truck attractions by zone: rate times size, summed over firms.

    Rates stay wide, so a firm is one row through the only shuffle and that
    carries one partial sum per zone. ``output="long"`` gives rows of
    (STDM_TAZ, [Category,] truck_type, attractions).
    """
    if strict:
        require_none(missing_rates(firms, rates), "no rates for sectors")
    narrow = broadcast_if_small(rates.select("sector", *vehicles), max_broadcast_rows)
    joined = firms.select("sector", "size", "STDM_TAZ").join(narrow, "sector")
    keys = [F.col("STDM_TAZ")]
    if by_category:
        keys.append(F.col("sector").alias("Category"))

    def attraction(v: str):
        each = half_even(F.col(v) * F.col("size"), 4).cast(EXACT_SUM)
        complete = F.count(each) == F.count(F.lit(1))
        return F.when(complete, F.sum(each)).cast("double").alias(v)

    wide = joined.groupBy(*keys).agg(*[attraction(v) for v in vehicles])
    if output == "wide":
        return wide
    ids = [name for name in wide.columns if name not in vehicles]
    return wide.unpivot(ids, list(vehicles), "truck_type", "attractions")


def urban_scaling(
    firms: DataFrame, urban_counties: Collection[str] = tuple(URBAN_COUNTIES)
) -> DataFrame:
    """Add the factor by which trips of firms in urban counties are reduced."""
    urban = is_in("County", urban_counties)
    return firms.withColumn(
        "scaling_factor",
        F.when(urban, F.lit(URBAN_FACTOR)).otherwise(F.lit("1")).cast("decimal(2,1)"),
    )


def _size_type(firms: DataFrame) -> str:
    """A decimal type that holds firm sizes as their column does."""
    kind = firms.schema["size"].dataType.simpleString()
    return "decimal(10,0)" if kind in ("tinyint", "smallint", "int") else "decimal(16,6)"


def exact_trips(
    firms: DataFrame,
    rates: DataFrame,
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES),
    urban_counties: Collection[str] = tuple(URBAN_COUNTIES),
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Firms with their fractional daily trips, a decimal column per vehicle.

    A sector without a rate for a vehicle makes no trips by it.
    """
    narrow = broadcast_if_small(
        rates.select(
            "sector", *[F.col(v).cast(RATE_TYPE).alias(f"_rate_{v}") for v in vehicles]
        ),
        max_broadcast_rows,
    )
    scaled = urban_scaling(firms, urban_counties).join(narrow, "sector", "left")
    size = F.col("size").cast(_size_type(firms))

    def trips(v: str):
        amount = F.col(f"_rate_{v}") * size * F.col("scaling_factor")
        return F.coalesce(amount, F.lit(0)).alias(v)

    return scaled.select(*firms.columns, *[trips(v) for v in vehicles])


def rounded_trips(
    firms: DataFrame,
    rates: DataFrame,
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES),
    urban_counties: Collection[str] = tuple(URBAN_COUNTIES),
    order: str = "pfirmID",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Whole trips per firm and vehicle type, fractions carried in id order.

    All vehicle types ride along in one pass over the firms.
    """
    exact = exact_trips(firms, rates, vehicles, urban_counties, max_broadcast_rows)
    whole = bucket_round(exact, list(vehicles), order)
    return whole.unpivot(
        list(firms.columns), list(vehicles), "vehicle_type", "trucks"
    ).filter(F.col("trucks") > 0)


def generate_trips(
    firms: DataFrame,
    rates: DataFrame,
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES),
    urban_counties: Collection[str] = tuple(URBAN_COUNTIES),
    expand: bool = True,
    order: str = "pfirmID",
    spread: bool = True,
    strict: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Local truck trips by firm, one row per trip numbered ``trip_number``.

    Firms without an id make no trips (``prefix.without_id`` gives them). Firms
    are shuffled before their trips are laid out unless ``spread`` is off. With ``expand=False`` there is one row per firm and vehicle type that makes
    any trip, and ``trip_number`` is NULL.
    """
    if strict:
        require_none(missing_rates(firms, rates), "no rates for sectors")
        require_none(without_id(firms, order), "firms without an id")
    whole = rounded_trips(
        firms, rates, vehicles, urban_counties, order, max_broadcast_rows
    )
    number = F.lit(None).cast("int")
    if expand:
        keys = [order, "vehicle_type"]
        whole = lay_out(whole, F.col("trucks"), "trip_number", keys, spread=spread)
        number = F.col("trip_number").cast("int")
    return whole.select(
        "pfirmID",
        number.alias("trip_number"),
        "sector",
        "vehicle_type",
        F.lit(LOCAL_COMMODITY).alias("sctg2"),
        F.lit(None).cast("double").alias("tons"),
        F.lit(None).cast("double").alias("value"),
        F.col("STDM_TAZ").alias("origin"),
        F.lit("local").alias("direction"),
    )


def generation_summary(
    firms: DataFrame,
    rates: DataFrame,
    vehicles: Sequence[str] = tuple(VEHICLE_TYPES),
    urban_counties: Collection[str] = tuple(URBAN_COUNTIES),
    order: str = "pfirmID",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Firms that make trips, their percentage of all, and trips, by vehicle."""
    whole = rounded_trips(
        firms, rates, vehicles, urban_counties, order, max_broadcast_rows
    )
    everyone = firms.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = whole.groupBy("vehicle_type").agg(
        F.count(F.lit(1)).alias("firms"), F.sum("trucks").alias("trips")
    )
    return counted.withColumn("pct_firms", percent(F.col("firms"), everyone))
