"""Generation of local trips, destinations, hours and matrices."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from freightlake.operators import daily, generation, local, matrices
from freightlake.operators.checks import ModelInputError
from verification import inputs

FIRMS = "pfirmID bigint, sector string, size int, STDM_TAZ int, County string"
RATES = "sector string, SU double, TT double"
VEHICLES = ["SU", "TT"]


def test_one_firm(make):
    firms = make([(1, "X", 5, 3, "Other")], FIRMS)
    rates = make([("X", 0.5, 0.0)], RATES)
    got = generation.generate_trips(firms, rates, VEHICLES).collect()
    assert [(r.vehicle_type, r.trip_number, r.origin) for r in got] == [
        ("SU", 1, 3),
        ("SU", 2, 3),
    ]


def test_zero_rate_does_not_spoil_later_firms(make):
    firms = make([(i, "XY"[i % 2], 10, 1, "Other") for i in range(10)], FIRMS)
    rates = make([("X", 0.25, 0.0), ("Y", 0.0, 0.5)], RATES)
    got = generation.generate_trips(firms, rates, VEHICLES)
    counts = {r.vehicle_type: r["count"] for r in got.groupBy("vehicle_type").count().collect()}
    assert counts == {"SU": 12, "TT": 25}  # 12.5 is rounded half to even


@pytest.mark.parametrize("size", [200_000, 0])
def test_totals_and_urban_scaling(spark, sf_dir, size):
    firms, rates = inputs.firms(spark, sf_dir), inputs.rates(spark)
    exact = generation.exact_trips(firms, rates).agg(F.sum("SU")).first()[0]
    made = generation.generate_trips(firms, rates, max_broadcast_rows=size)
    whole = made.filter("vehicle_type = 'SU'").count()
    assert whole == int(exact.quantize(Decimal(1), rounding="ROUND_HALF_EVEN"))
    scaled = generation.urban_scaling(firms).groupBy("County").agg(F.max("scaling_factor"))
    assert {r[0]: float(r[1]) for r in scaled.collect()} == {
        "Ada": 0.4,
        "Canyon": 0.4,
        "Other": 1.0,
    }


def test_reference_shape_without_expansion(make):
    firms = make([(1, "X", 50, 3, "Ada"), (2, "X", 1, 4, None)], FIRMS)
    rates = make([("X", 0.5, 0.1)], RATES)
    got = generation.generate_trips(firms, rates, VEHICLES, expand=False)
    assert got.columns == [
        "pfirmID", "trip_number", "sector", "vehicle_type", "sctg2", "tons", "value",
        "origin", "direction",
    ]
    assert {(r.pfirmID, r.vehicle_type, r.trip_number) for r in got.collect()} == {
        (1, "SU", None),
        (1, "TT", None),
    }


def test_sector_without_rates(make):
    firms, rates = make([(1, "Z", 5, 3, "Ada")], FIRMS), make([("X", 1.0, 1.0)], RATES)
    assert [r.sector for r in generation.missing_rates(firms, rates).collect()] == ["Z"]
    for operator in (generation.generate_trips, generation.zonal_attractions):
        with pytest.raises(ModelInputError, match="Z"):
            operator(firms, rates, VEHICLES, strict=True)


def test_attraction_of_a_zone_with_a_firm_of_unknown_size_is_unknown(make):
    firms = make([(1, "X", None, 3, "Ada"), (2, "X", 4, 3, "Ada"), (3, "X", 4, 5, "Ada")], FIRMS)
    got = generation.zonal_attractions(firms, make([("X", 0.12345, 1.0)], RATES), VEHICLES)
    assert {r.STDM_TAZ: r.SU for r in got.collect()} == {3: None, 5: 0.4938}


TRIPS = "pfirmID bigint, trip_number int, vehicle_type string, origin int"
SKIMS = "origin int, destination int, value double"
TARGETS = "distance int, SU double, TT double"


def destinations(make, skims, targets, origins=(1,), n=2000, size=200_000, **options):
    trips = make([(i, 1, "SU", o) for o in origins for i in range(n)], TRIPS)
    return local.sample_local_destinations(
        trips,
        make(skims, SKIMS),
        make(targets, TARGETS),
        VEHICLES,
        max_broadcast_rows=size,
        **options,
    )


@pytest.mark.parametrize("size", [200_000, 0])
def test_destination_by_length(make, size):
    skims = [(1, 1, 0.4), (1, 2, 1.9), (1, 3, 8.0), (1, 4, 121.0)]
    got = destinations(make, skims, [(1, 1.0, 1.0), (2, 3.0, 1.0)], size=size).collect()
    assert {r.destination for r in got} == {1, 2}
    assert abs(sum(r.destination == 2 for r in got) / 2000 - 0.75) < 0.05
    assert {(r.destination, r.wgt_dist) for r in got} == {(1, 0.4), (2, 1.9)}


def test_nothing_in_reach_stays_in_its_own_zone(make):
    got = destinations(make, [(1, 2, 500.0), (9, 9, 1.0)], [(1, 1.0, 1.0)], (1, 9), n=3)
    assert {(r.origin, r.destination) for r in got.collect()} == {(1, 1), (9, 9)}


def test_only_zone_in_reach_is_taken_whatever_its_share(make):
    got = destinations(make, [(1, 2, 50.0)], [(1, 1.0, 1.0)], n=3)
    assert {r.destination for r in got.collect()} == {2}


def test_zones_in_reach_without_any_share(make):
    skims = [(1, 2, 50.0), (1, 3, 60.0)]
    got = destinations(make, skims, [(1, 1.0, 1.0)], n=3)
    assert local.undrawn_destinations(got).count() == 3
    with pytest.raises(ModelInputError):
        destinations(make, skims, [(1, 1.0, 1.0)], n=3, strict=True)


def test_own_zone_left_out(make):
    skims = [(1, 1, 0.4), (1, 2, 0.9), (1, 3, 0.9)]
    got = destinations(make, skims, [(1, 1.0, 1.0)], allow_intrazonals=False)
    assert {r.destination for r in got.collect()} == {2, 3}


def test_origin_without_skims(make):
    with pytest.raises(ModelInputError, match="5"):
        destinations(make, [(1, 1, 0.4)], [(1, 1.0, 1.0)], (5,), strict=True)


def test_bands_round_half_to_even(make):
    skims = make([(1, 2, 0.0), (1, 3, 1.0), (1, 4, 2.0), (1, 5, 2.1)], SKIMS)
    got = local.banded_skims(skims, make([(1, 1.0, 1.0)], TARGETS), ["SU"])
    assert {r.destination: r.distance for r in got.collect()} == {2: 0, 3: 2, 4: 2, 5: 3}


def test_periods(make):
    hours = [None, 0, 6, 7, 8, 9, 15, 16, 17, 18, 23]
    trips = make([(h, v) for h in hours for v in ("SU", "TPT")], "start_hour int, vehicle_type string")
    got = daily.period_matrix_labels(trips).collect()
    assert [r.matrix for r in got if r.vehicle_type == "SU"] == [
        None if p is None else f"{p}_sut"
        for p in (None, "nt", "nt", "am", "am", "md", "md", "pm", "pm", "nt", "nt")
    ]
    others = [r.matrix for r in got if r.vehicle_type == "TPT" and r.start_hour is not None]
    assert {m[3:] for m in others} == {"mut"}


def test_vehicle_without_hours(make):
    trips = make([("a", "SU"), ("b", "TT")], "flow_id string, vehicle_type string")
    shares = make([("SU", 8, 1.0)], "vehicle_type string, hour int, share double")
    got = daily.temporal_allocation(trips, shares, keys=["flow_id"]).collect()
    assert {r.vehicle_type: r.start_hour for r in got} == {"SU": 8, "TT": None}
    with pytest.raises(ModelInputError, match="TT"):
        daily.temporal_allocation(trips, shares, keys=["flow_id"], strict=True)


OD = "ozone int, dzone int, vehicle_type string, period string"


def test_matrices_count_every_trip(make):
    trips = make(
        [(1, 2, "SU", "AM"), (1, 2, "TT", "AM"), (1, 2, "CS", "NT"), (2, 1, "VAN", "AM"), (2, 1, "SU", None)],
        OD,
    )
    rows = {
        (r.origin, r.destination): r.asDict()
        for r in matrices.od_matrices(trips, "ozone", "dzone").collect()
    }
    assert rows[(1, 2)]["am_sut"] == 2 and rows[(1, 2)]["nt_mut"] == 1
    assert rows[(2, 1)]["unlisted"] == 2 and rows[(1, 2)]["unlisted"] == 0
    assert matrices.unlisted_trips(trips).count() == 2
    with pytest.raises(ModelInputError, match="VAN"):
        matrices.od_matrices(trips, "ozone", "dzone", strict=True)


def test_matrix_total_is_number_of_trips(spark, sf_dir):
    trips = daily.period_matrix_labels(inputs.flow_od_trips(spark, sf_dir))
    table = matrices.od_matrices(trips)
    total = table.select(F.sum(sum((F.col(n) for n in matrices.MATRIX_NAMES), F.col("unlisted"))))
    assert total.first()[0] == trips.count()


@pytest.mark.parametrize("size", [200_000, 0])
def test_drawn_rows_carry_their_distance(make, size):
    """As looked up afterwards, also for trips that stay in a zone out of reach."""
    skims = [(o, d, 5.0 * abs(o - d) + 1) for o in range(6) for d in range(6)]
    skims += [(9, 9, 500.0), (9, 1, 700.0), (8, 1, 900.0)]
    trips = [(i, "SU", 1, (0, 1, 4, 8, 9, 77)[i % 6]) for i in range(120)]
    frame = make(trips, "pfirmID int, vehicle_type string, trip_number int, origin int")
    pairs = make(skims, "origin int, destination int, value double")
    targets = make([(float(d) + 1, 1.0, 1.0, 1.0, 1.0, 1.0) for d in range(60)],
                   "distance double, SU double, TT double, CS double, DBL double, TPT double")
    targets = targets.withColumn("distance", targets.distance.cast("int"))
    for home in (True, False):
        placed = local.sample_local_destinations(
            frame, pairs, targets, allow_intrazonals=home, max_broadcast_rows=size
        )
        again = local.append_skim_distance(placed.drop("wgt_dist"), pairs)
        key = lambda r: (r.pfirmID, r.origin, r.destination, r.wgt_dist)
        assert sorted(map(key, placed.collect()), key=str) == sorted(map(key, again.collect()), key=str)
        stayed = {(r.origin, r.wgt_dist) for r in placed.collect() if r.origin > 5}
        assert stayed == {(8, None), (9, 500.0), (77, None)}
