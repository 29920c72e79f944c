"""Firms to daily local trip matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.operators.daily import temporal_allocation, temporal_gaps
from freightlake.operators.generation import generate_trips, missing_rates
from freightlake.operators.local import (
    MAX_DISTANCE,
    TRIP_KEYS,
    sample_local_destinations,
    undrawn_destinations,
)
from freightlake.operators.matrices import od_matrices
from freightlake.operators.prefix import without_id
from freightlake.plans.rejects import counted, together


def local_trips(
    firms: DataFrame,
    rates: DataFrame,
    skims: DataFrame,
    targets: DataFrame,
    distributions: DataFrame,
    max_distance: float = MAX_DISTANCE,
    allow_intrazonals: bool = True,
    seed: int = 0,
    strict: bool = False,
) -> DataFrame:
    """Firms to trips with origin, destination and start hour.

    With ``strict`` each stage raises where it would leave something out;
    otherwise ``rejects`` counts what that is.
    """
    placed = sample_local_destinations(
        generate_trips(firms, rates, strict=strict),
        skims,
        targets,
        max_distance=max_distance,
        allow_intrazonals=allow_intrazonals,
        seed=seed,
        strict=strict,
    )
    return temporal_allocation(
        placed, distributions, keys=TRIP_KEYS, seed=seed, strict=strict
    )


def rejects(
    firms: DataFrame,
    rates: DataFrame,
    skims: DataFrame,
    targets: DataFrame,
    distributions: DataFrame,
    max_distance: float = MAX_DISTANCE,
    allow_intrazonals: bool = True,
    seed: int = 0,
) -> DataFrame:
    """``stage, reason, rows``: what ``local_trips`` leaves out or incomplete.

    Firms that make no trips, trips without a destination and trips without a
    start hour; a trip may lack both.
    """
    placed = sample_local_destinations(
        generate_trips(firms, rates),
        skims,
        targets,
        max_distance=max_distance,
        allow_intrazonals=allow_intrazonals,
        seed=seed,
    )
    untimed = F.broadcast(temporal_gaps(placed, distributions))
    return together(
        [
            counted("generation", "firm without an id", without_id(firms, "pfirmID")),
            counted(
                "generation",
                "no rates for sector",
                firms.join(missing_rates(firms, rates), "sector", "left_semi"),
            ),
            counted("destinations", "no share within reach", undrawn_destinations(placed)),
            counted(
                "hours",
                "no hourly distribution",
                placed.join(untimed, "vehicle_type", "left_semi"),
            ),
        ]
    )


def trip_matrices(
    firms: DataFrame,
    rates: DataFrame,
    skims: DataFrame,
    targets: DataFrame,
    distributions: DataFrame,
    seed: int = 0,
    strict: bool = False,
) -> DataFrame:
    """Firms to matrices of their trips by zone pair."""
    trips = local_trips(
        firms, rates, skims, targets, distributions, seed=seed, strict=strict
    )
    return od_matrices(trips)
