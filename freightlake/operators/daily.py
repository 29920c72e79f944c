"""Annual trucks to single trucks of one simulated day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.functions import keyed_uniform
from freightlake.operators.binomial import choose_items
from freightlake.operators.checks import ModelInputError, require_none
from freightlake.operators.expand import CHUNK, lay_out
from freightlake.operators.pick import weighted_pick
from freightlake.operators.sizing import MAX_BROADCAST_ROWS
from freightlake.operators.truckloads import Watcher

# Weeks in a year, days in a week, and the default day.
WEEKS = 52
DAYS = 7
TARGET_WEEK = 24
TARGET_DAY = 4

LINE_KEYS = ["flow_id", "vehicle_type", "status"]
TRUCK_KEYS = [*LINE_KEYS, "truck_seq"]


def expand_trucks(
    annual: DataFrame,
    keys: Sequence[str] = tuple(LINE_KEYS),
    count: str = "annual_trucks",
    chunk: int = CHUNK,
    spread: bool = True,
) -> DataFrame:
    """One row per truck, numbered ``truck_seq`` from 1 within its line.

    Tons and value are shared out evenly; see ``lay_out`` for large lines.
    """
    trucks = F.col(count)
    shared = annual.filter(trucks.cast("bigint") > 0).withColumns(
        {"tons": F.col("tons") / trucks, "value": F.col("value") / trucks}
    )
    return lay_out(shared, trucks, "truck_seq", keys, chunk, spread).drop(count)


def sample_daily_trucks(
    annual: DataFrame,
    target_week: int = TARGET_WEEK,
    target_day: int = TARGET_DAY,
    keys: Sequence[str] = tuple(LINE_KEYS),
    calendar: DataFrame | None = None,
    seed: int = 0,
    spread: bool = True,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    method: str = "trucks",
) -> DataFrame:
    """Trucks that travel on the target day of the target week.

    Trucks are laid out, drawn and filtered in one stage, so those of other
    days are never stored. One draw among all days of a year gives both week
    and day. ``calendar`` (week, day, share) holds observed shares of the days;
    without it all 364 are alike.

    With ``method="counts"`` trucks of other days are not even laid out: a line
    draws how many of its trucks travel that day, and which ones. The law is the
    same, the draws are not; lines are not shuffled.
    """
    if method not in ("trucks", "counts"):
        raise ModelInputError(f"no method {method}")
    if method == "counts":
        chosen = _travelling(
            annual, day_share(calendar, target_week, target_day), keys, seed
        )
        return chosen.withColumns({"week": F.lit(target_week), "day": F.lit(target_day)})
    trucks = expand_trucks(annual, keys, spread=spread)
    uniform = keyed_uniform(*keys, "truck_seq", stage="day", seed=seed)
    if calendar is None:
        target = (target_week - 1) * DAYS + target_day - 1
        chosen = trucks.filter(F.floor(uniform * (WEEKS * DAYS)) == target)
    else:
        slots = calendar.select(
            ((F.col("week") - 1) * DAYS + F.col("day") - 1).cast("int").alias("_slot"),
            "share",
        )
        chosen = weighted_pick(
            trucks,
            slots,
            [],
            "_slot",
            "share",
            uniform,
            "_slot",
            only=(target_week - 1) * DAYS + target_day - 1,
            max_broadcast_rows=max_broadcast_rows,
        ).drop("_slot")
    return chosen.withColumns({"week": F.lit(target_week), "day": F.lit(target_day)})


def day_share(
    calendar: DataFrame | None, target_week: int, target_day: int
) -> float:
    """Share of the target day in a year; missing and negative ones count as zero.

    The only day of a calendar has all of it, and a calendar without any share none.
    """
    if calendar is None:
        return 1 / (WEEKS * DAYS)
    value = F.greatest(F.nanvl(F.col("share").cast("double"), F.lit(0.0)), F.lit(0.0))
    mine = (F.col("week") == target_week) & (F.col("day") == target_day)
    found = calendar.agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(mine).alias("mine"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("all"),
        F.coalesce(F.sum(F.when(mine, value)), F.lit(0.0)).alias("own"),
    ).first()
    if found.days == 1:
        return float(found.mine)
    return found.own / found.all if found.all > 0 else 0.0


def _travelling(
    annual: DataFrame, share: float, keys: Sequence[str], seed: int
) -> DataFrame:
    trucks = F.col("annual_trucks")
    chosen = choose_items(annual, trucks, "truck_seq", share, keys, "day", seed)
    return chosen.withColumns(
        {"tons": F.col("tons") / trucks, "value": F.col("value") / trucks}
    ).drop("annual_trucks")


def temporal_gaps(trips: DataFrame, distributions: DataFrame) -> DataFrame:
    """Vehicle types that travel but have no hourly distribution."""
    return trips.select("vehicle_type").distinct().join(
        distributions.select("vehicle_type").distinct(), "vehicle_type", "left_anti"
    )


def period_matrix_labels(trips: DataFrame) -> DataFrame:
    """Period of the start hour and the name of the matrix a trip belongs to.

    Both are NULL for a trip without a start hour.
    """
    # Hours of the periods and vehicle types of the groups.
    hour = F.col("start_hour")
    period = (
        F.when(hour.isNull(), F.lit(None).cast("string"))
        .when((hour >= 7) & (hour < 9), "AM")
        .when((hour >= 9) & (hour < 16), "MD")
        .when((hour >= 16) & (hour < 18), "PM")
        .otherwise("NT")
    )
    group = F.when(F.col("vehicle_type").isin("SU", "TT"), "SUT").otherwise("MUT")
    return trips.withColumn("period", period).withColumn(
        "matrix", F.lower(F.concat("period", F.lit("_"), group))
    )


def temporal_allocation(
    trips: DataFrame,
    distributions: DataFrame,
    keys: Sequence[str] = tuple(TRUCK_KEYS),
    seed: int = 0,
    strict: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    route: str = "stretches",
    watch: Watcher | None = None,
) -> DataFrame:
    """Draw a start hour by the shares of the vehicle type; add the labels.

    ``watch`` is handed trips whose vehicle type has no distribution, to be counted.
    """
    if strict:
        require_none(
            temporal_gaps(trips, distributions), "no hourly distribution for"
        )
    drawn = weighted_pick(
        trips,
        distributions.select("vehicle_type", "hour", "share"),
        ["vehicle_type"],
        "hour",
        "share",
        keyed_uniform(*keys, stage="hour", seed=seed),
        "start_hour",
        count_name="_hours" if watch else None,
        max_broadcast_rows=max_broadcast_rows,
        route=route,
    )
    if watch:
        lacking = F.col("_hours").isNull()
        drawn = watch(drawn, "hours", {"no hourly distribution": lacking}).drop("_hours")
    return period_matrix_labels(drawn)
