"""Rows that must not vanish, weights that must count, bands and labels at their edges."""

import time

import pytest
from pyspark.sql import functions as F

from freightlake.functions import keyed_uniform
from freightlake.operators import daily, generation, links, prefix, profile, truckloads
from freightlake.operators.checks import ModelInputError
from freightlake.operators.pick import unusable_weights, weighted_pick
from conftest import final_plan

SIZES = [200_000, 0]  # broadcast, shuffled


def pick(rows, candidates, size, group=("g",)):
    return weighted_pick(
        rows,
        candidates,
        list(group),
        "choice",
        "weight",
        keyed_uniform("id", stage="t"),
        "picked",
        max_broadcast_rows=size,
    )


@pytest.mark.parametrize("size", SIZES)
def test_only_the_ratio_of_weights_counts(spark, make, size):
    rows = spark.range(300).withColumn("g", F.lit(1))
    tiny = make([(1, c, 4e-13 * c) for c in (1, 2, 3)], "g int, choice int, weight double")
    large = tiny.withColumn("weight", F.col("weight") * 1e13)
    got = {r.id: r.picked for r in pick(rows, tiny, size).collect()}
    assert got == {r.id: r.picked for r in pick(rows, large, size).collect()}
    assert set(got.values()) == {1, 2, 3}


@pytest.mark.parametrize("size", SIZES)
def test_negative_weights_are_never_drawn(spark, make, size):
    rows = spark.range(200).withColumn("g", F.lit(1))
    given = [(1, 1, -5.0), (1, 2, 1.0), (1, 3, None), (1, 4, float("nan")), (1, 5, 1.0)]
    candidates = make(given, "g int, choice int, weight double")
    assert {r.picked for r in pick(rows, candidates, size).collect()} == {2, 5}
    assert unusable_weights(candidates, "weight").count() == 3


def test_choices_of_any_type_are_drawn_alike_in_both_forms(spark, make):
    rows = spark.range(400).withColumn("g", (F.col("id") % 2).cast("int"))
    given = [(g, f"zone {c}", 1.0 + c) for g in (0, 1) for c in range(9)]
    candidates = make(given, "g int, choice string, weight double")
    first, second = ({r.id: r.picked for r in pick(rows, candidates, s).collect()} for s in SIZES)
    assert first == second and None not in first.values()


@pytest.mark.parametrize("size", SIZES)
def test_one_group_with_most_rows(spark, make, size):
    rows = spark.range(4000).withColumn("g", F.when(F.col("id") % 10 == 0, 2).otherwise(1))
    candidates = make([(g, c, 1.0) for g in (1, 2) for c in range(50)], "g int, choice int, weight double")
    got = pick(rows, candidates, size)
    assert got.filter(F.col("picked").isNull()).count() == 0 and got.count() == 4000


@pytest.mark.parametrize("bits", [(2, 4), (12, 28, 44)])
def test_running_totals_with_null_groups_and_ids(make, bits):
    rows = [(1, None, 0.5), (2, None, 0.5), (3, "a", 0.5), (50, None, 0.25), (None, "a", 9.0)]
    frame = make(rows, "id long, g string, x double").withColumn("x", F.col("x").cast("decimal(10,2)"))
    totals = prefix.running_totals(frame, ["x"], "id", ["g"], block_bits=bits)
    got = sorted((r.id, r.g, float(r.through_x)) for r in totals.collect())
    assert got == [(1, None, 0.5), (2, None, 1.0), (3, "a", 0.5), (50, None, 1.25)]
    assert [r.x for r in prefix.without_id(frame, "id").collect()] == [9]
    rounded = prefix.bucket_round(frame, ["x"], "id", ["g"]).collect()
    assert sum(r.x for r in rounded if r.g is None) == 1 and len(rounded) == 4


FIRMS = "pfirmID long, sector string, size double, STDM_TAZ int, County string"
RATES = "sector string, SU double, TT double"


def test_fractional_firm_sizes(make):
    firms = make([(1, "X", 2.5, 3, "Z"), (2, "X", 2.5, 3, "Z")], FIRMS)
    rates = make([("X", 1.0, 1e-11)], RATES)
    made = generation.generate_trips(firms, rates, ["SU", "TT"])
    assert made.count() == 5
    exact = generation.exact_trips(firms, rates, ["SU", "TT"]).agg(F.sum("TT")).first()[0]
    assert float(exact) == 5e-11


def test_firms_without_an_id(make):
    firms = make([(None, "X", 2.0, 3, "Z"), (2, "X", 3.0, 3, "Z")], FIRMS)
    rates = make([("X", 1.0, 0.0)], RATES)
    assert generation.generate_trips(firms, rates, ["SU", "TT"]).count() == 3
    with pytest.raises(ModelInputError, match="without an id"):
        generation.generate_trips(firms, rates, ["SU", "TT"], strict=True)


BANDS = "minimum_range int, maximum_range int"


def test_open_band_costs_no_more(make):
    flows = make([(d,) for d in (None, 0.0, 50.4, 50.6, 55.0, 61.0, 5e8, 3e9)], "wgt_dist double")
    bands = make([(0, 50), (60, 2147483647), (0, 50)], BANDS)
    start = time.perf_counter()
    found = truckloads.distance_band_lookup(flows, bands)
    got = [r.minimum_range for r in found.collect()]
    assert time.perf_counter() - start < 20
    assert got == [None, 0, 0, None, None, 60, 60, None]
    assert "Join" not in final_plan(found)
    assert truckloads.distance_band_lookup(flows, bands, how="inner").count() == 4
    assert truckloads.distance_band_lookup(flows, bands.limit(0)).filter("minimum_range IS NULL").count() == 8


@pytest.mark.parametrize("bad", [[(0, 50), (50, 60)], [(9, 5)], [(0, None)]])
def test_bad_bands_are_refused(make, bad):
    with pytest.raises(ModelInputError):
        truckloads.band_edges(make(bad, BANDS))


def test_trips_without_an_hour_have_no_period(make):
    trips = make([(1, "SU", 3), (2, "TT", None)], "id int, vehicle_type string, start_hour int")
    got = {r.id: (r.period, r.matrix) for r in daily.period_matrix_labels(trips).collect()}
    assert got == {1: ("NT", "nt_sut"), 2: (None, None)}


def test_draw_keys_do_not_run_into_each_other(make):
    rows = make([("a|b", "c"), ("a", "b|c"), (None, "a|b"), ("a|b", None), ("-", "c")], "x string, y string")
    drawn = rows.select(keyed_uniform("x", "y", stage="s").alias("u")).collect()
    assert len({r.u for r in drawn}) == 5


def test_profile_keeps_types(make):
    rows = [("12345678901234567890.12", 0.1, [1]), ("12345678901234567890.13", 0.1, [2])]
    frame = make(rows, "d string, f float, a array<int>").withColumn("d", F.col("d").cast("decimal(38,2)"))
    got = {r.Variable: r for r in profile.profile_columns(frame).collect()}
    assert got["d"].Unique == 2 and got["d"].Values.endswith("90.13")
    assert got["f"].Values == "0.1" and got["f"].Class == "float"
    assert got["a"].Unique == 2


def test_link_columns_check(make):
    table = make([(1, None), (2, 5)], "A int, TYP int")
    got = {r.name: (r.present, r.filled) for r in links.link_columns_check(table, "AM").collect()}
    assert got["A"] == (True, 2) and got["TYP"] == (True, 1) and got["SUTAM"] == (False, 0)
