"""Zones of interregional trip ends."""

import pytest
from pyspark.sql import functions as F

from freightlake.operators import allocation, tripends
from freightlake.operators.checks import ModelInputError

TRIPS = "flow_id string, dms_orig int, dms_dest int, sctg2 int"
ZONES = "STDM_TAZ int, faf_region int, ITD_district int"
ATTRACTIONS = "STDM_TAZ int, Category string, truck_type string, attractions double"
COEFFICIENTS = "Category string, sctg2 int, MorU string, coefficient double"


@pytest.fixture
def world(make):
    zones = make([(1, 10, 1), (2, 10, None), (3, 10, 2), (4, 20, 1), (5, 30, 1), (6, 30, 1)], ZONES)
    attractions = make(
        [
            (1, "A", "Heavy", 3.0),
            (1, "B", "Heavy", 1.0),
            (2, "A", "Heavy", 1.0),
            (3, "B", "Heavy", 4.0),
            (3, "B", "Light", 400.0),
            (99, "A", "Heavy", 7.0),
        ],
        ATTRACTIONS,
    )
    return zones, attractions


def ends(trips, world, size=200_000, **options):
    zones, attractions = world
    placed = tripends.sample_tripends(
        trips, attractions, zones, keys=["flow_id"], max_broadcast_rows=size, **options
    )
    return placed.collect()


def many(make, n, orig, dest, sctg2):
    return make([(f"t{i}", orig, dest, sctg2) for i in range(n)], TRIPS)


SIZES = [200_000, 0]


@pytest.mark.parametrize("size", SIZES)
def test_unscaled_draw_uses_included_types_only(make, world, size):
    got = ends(many(make, 4000, 10, 20, 1), world, size)
    assert {r.dzone for r in got} == {4}
    share = {z: sum(r.ozone == z for r in got) / 4000 for z in (1, 2, 3)}
    for zone, weight in {1: 4, 2: 1, 3: 4}.items():
        assert abs(share[zone] - weight / 9) < 0.04


def test_zones_without_attraction_are_all_alike(make, world):
    got = ends(many(make, 2000, 30, 30, 1), world)
    assert abs(sum(r.ozone == 5 for r in got) - 1000) < 150
    assert any(r.ozone != r.dzone for r in got)


@pytest.mark.parametrize("size", SIZES)
def test_make_and_use(make, world, size):
    coefficients = make(
        [("A", 1, "M", 1.0), ("B", 1, "U", 0.5), ("A", 2, "M", 0.0)], COEFFICIENTS
    )
    first = ends(many(make, 3000, 10, 10, 1), world, size, makeuse_coefficients=coefficients)
    assert {r.ozone for r in first} == {1, 2}
    assert abs(sum(r.ozone == 1 for r in first) / 3000 - 0.75) < 0.04
    assert {r.dzone for r in first} == {1, 3}
    # All coefficients zero: every zone of the region alike, also zone 2.
    second = ends(many(make, 3000, 10, 10, 2), world, size, makeuse_coefficients=coefficients)
    for zone in (1, 2, 3):
        assert abs(sum(r.ozone == zone for r in second) / 3000 - 1 / 3) < 0.04
    # No use coefficients for commodity 2: not scaled.
    assert abs(sum(r.dzone == 2 for r in second) / 3000 - 1 / 9) < 0.04
    # No coefficients at all for commodity 3.
    third = ends(many(make, 3000, 10, 10, 3), world, size, makeuse_coefficients=coefficients)
    assert abs(sum(r.ozone == 3 for r in third) / 3000 - 4 / 9) < 0.04


def test_broadcast_and_shuffled_draws_are_the_same(make, world):
    trips = many(make, 500, 10, 30, 1)
    both = [sorted((r.flow_id, r.ozone, r.dzone) for r in ends(trips, world, s)) for s in SIZES]
    assert both[0] == both[1]


def test_region_without_zone(make, world):
    trips = many(make, 3, 10, 77, 1)
    assert [r.dzone for r in ends(trips, world)] == [None] * 3
    with pytest.raises(ModelInputError, match="77"):
        ends(trips, world, strict=True)
    phantom = make([(1, 77, 1)], ZONES)
    assert {r.dzone for r in ends(trips, world, phantom_zones=phantom, strict=True)} == {1}


def test_rejects_and_placed_make_up_all_trips(make, world):
    trips = many(make, 5, 10, 77, 1).unionAll(many(make, 5, 10, 20, 1))
    zones, attractions = world
    placed = tripends.sample_tripends(trips, attractions, zones, keys=["flow_id"])
    assert placed.count() == 10
    assert tripends.missing_tripends(placed).count() == 5


WIDE = "STDM_TAZ int, CS double, DBL double, TPT double"


def test_internal_ends_are_drawn_and_others_recoded(make):
    weights = make([(1, 1.0, 1.0, 0.0), (2, 3.0, 2.0, 1.0), (3, 0.0, 0.0, 0.0)], WIDE)
    equivalents = make([(1, 160), (2, 160), (50, 500)], "STDM_TAZ int, faf_region int")
    trips = make(
        [(f"a{i}", 160, 500, 1) for i in range(4000)] + [("b", 500, 700, 1)], TRIPS
    )
    placed = allocation.allocate_internal_ends(
        trips, [160], weights, equivalents, keys=["flow_id"]
    )
    rows = placed.collect()
    assert len(rows) == 4001
    inside = [r for r in rows if r.dms_orig == 160]
    assert {r.origin for r in inside} == {1, 2}
    assert abs(sum(r.origin == 2 for r in inside) / 4000 - 0.75) < 0.04
    assert {r.destination for r in inside} == {50}
    (outside,) = [r for r in rows if r.dms_orig == 500]
    assert (outside.origin, outside.destination) == (50, None)
    assert [tuple(r) for r in allocation.uncoded_ends(placed).collect()] == [(700, 1)]
    with pytest.raises(ModelInputError, match="700"):
        allocation.allocate_internal_ends(
            trips, [160], weights, equivalents, keys=["flow_id"], strict=True
        )


def test_outside_region_with_two_zones(make):
    equivalents = make([(1, 160), (2, 160), (50, 500), (51, 500)], "STDM_TAZ int, faf_region int")
    assert allocation.multi_zone_regions(equivalents, [160]).collect()[0].faf_region == 500
    trips = make([("a", 500, 500, 1)], TRIPS)
    assert allocation.recode_region_to_zone(trips, equivalents).count() == 4


def test_candidates_keep_both_sides(make, world):
    zones, attractions = world
    got = tripends.tripend_candidates(attractions, zones)
    assert got.filter("STDM_TAZ = 99 AND faf_region IS NULL").count() == 1
    assert got.filter("STDM_TAZ = 5 AND attractions IS NULL").count() == 1
    assert got.filter("ITD_district IS NULL").count() == 0
    total = tripends.collapse_attractors(got).agg(F.sum("attractions")).first()[0]
    assert total == 16.0
