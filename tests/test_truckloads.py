"""Truckloads against the plain per-flow procedure."""

import math
import random
from collections import defaultdict
from itertools import chain

import pytest
from pyspark.sql import functions as F

from freightlake.operators import truckloads
from freightlake.operators.truckloads import BODY_TYPES, VEHICLE_TYPES, TruckFactors
from verification import inputs

FLOW = (
    "flow_id int, sctg2 int, dms_mode int, trade_type string, wgt_dist double,"
    " exp_tons double, exp_value double"
)


def half_even(x):
    return float(round(round(x, 9)))


def procedure(flow, alloc, equiv, empty):
    """Lines of one flow, or None if it cannot be worked out."""
    _, sctg2, _, trade, distance, tons, value = flow
    if tons is None or distance is None:
        return None
    mile = half_even(distance)
    band = {v: f for low, high, v, f in alloc if low <= mile <= high}
    cells = sorted(
        (v, j, BODY_TYPES[j], row[j])
        for v, s, *row in equiv
        if s == sctg2
        for j in range(len(BODY_TYPES))
        if row[j] > 0
    )
    if not cells or any(v not in band for v, *_ in cells):
        return None
    total = sum(band.values())
    loads = [(v, body, tons * band[v] / total * f) for v, _, body, f in cells]
    zed = round(sum(n for *_, n in loads), 9)
    if zed < 1:
        top = max(round(n, 12) for *_, n in loads)
        v, body, _ = next(cell for cell in loads if round(cell[2], 12) == top)
        loads = [(v, body, 1.0)]
    crossing = {"domestic": "domestic", "x-border": "border"}.get(trade)
    rates = {
        (body, v): factor
        for kind, body, *row in empty
        if kind == crossing
        for v, factor in zip(VEHICLE_TYPES, row)
    }
    loaded, empties = defaultdict(float), defaultdict(float)
    for v, body, n in loads:
        loaded[v] += n
        empties[v] += n * rates.get((body, v), 0.0)
    loaded = {v: half_even(n) for v, n in loaded.items()}
    if sum(loaded.values()) == 0 and zed > 1 and "SU" in loaded:
        loaded["SU"] = 1.0
    count = sum(loaded.values())
    lines = {
        (v, "Loaded"): (n, n / count * tons, n / count * value)
        for v, n in loaded.items()
        if n > 0
    }
    for v, n in empties.items():
        if half_even(n) > 0:
            lines[(v, "Empty")] = (half_even(n), 0.0, 0.0)
    return lines


@pytest.fixture(scope="module")
def tables(spark):
    frames = (
        inputs.allocation_factors(spark),
        inputs.equivalency_factors(spark),
        inputs.empty_factors(spark),
    )
    return [[tuple(row) for row in frame.collect()] for frame in frames]


def random_flows(n, seed=7):
    rng = random.Random(seed)
    edges = [0.0, 0.5, 50.0, 50.4, 50.5, 51.0, 500.0, 500.5, 501.0, 1150.0, 1150.5, None]
    for i in range(n):
        distance = rng.choice(edges) if i % 4 == 0 else rng.uniform(0, 1200)
        tons = rng.choice([0.0, None, 12.5]) if i % 7 == 0 else 10 ** rng.uniform(-1, 5.5)
        trade = rng.choice(["domestic", "x-border", "x-border", None])
        yield (i, rng.randint(1, 45), 1, trade, distance, tons, rng.uniform(0, 1e6))


@pytest.mark.parametrize("rows", [200_000, 0])
def test_equals_the_procedure(spark, tables, rows):
    """Also where nothing may be broadcast."""
    flows = list(random_flows(4000))
    frame = spark.createDataFrame(flows, FLOW)
    base = inputs.factors(spark)
    factors = TruckFactors(
        base.allocation, base.equivalency, base.empty, max_broadcast_rows=rows
    )
    got = defaultdict(dict)
    for r in truckloads.annual_truckloads(frame, factors).collect():
        got[r.flow_id][(r.vehicle_type, r.status)] = (r.annual_trucks, r.tons, r.value)
    rejected = {r.flow_id for r in truckloads.rejected_flows(frame, factors).collect()}
    for flow in flows:
        want = procedure(flow, *tables)
        assert (want is None) == (flow[0] in rejected), flow
        mine = got.get(flow[0], {})
        assert set(mine) == set(want or {}), (flow, mine, want)
        for line, values in (want or {}).items():
            for a, b in zip(mine[line], values):
                assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (flow, line)


def test_shipped_shape_zero_tons_give_one_truck(spark):
    frame = spark.createDataFrame([(1, 5, 1, "domestic", 10.0, 0.0, 0.0)], FLOW)
    rows = truckloads.annual_truckloads(frame, inputs.factors(spark)).collect()
    loaded = [r for r in rows if r.status == "Loaded"]
    assert [(r.vehicle_type, r.annual_trucks, r.tons) for r in loaded] == [("CS", 1.0, 0.0)]


def test_tons_are_kept(spark, sf_dir):
    study, factors = inputs.study_flows(spark, sf_dir), inputs.factors(spark)
    annual = truckloads.annual_truckloads(study, factors)
    split = annual.groupBy("flow_id").agg(F.sum("tons").alias("tons"))
    off = study.join(split, "flow_id").filter(F.abs(F.col("tons") - F.col("exp_tons")) > 1e-6)
    assert off.count() == 0


def test_truck_flows_are_worked_out_or_rejected(spark, sf_dir):
    study, factors = inputs.study_flows(spark, sf_dir), inputs.factors(spark)
    done = truckloads.annual_truckloads(study, factors).select("flow_id").distinct().count()
    rejected = truckloads.rejected_flows(study, factors).count()
    assert done + rejected == truckloads.truck_mode_filter(study).count()


def test_mode_by_name(make):
    flows = make([("truck",), ("rail",), (None,)], "dms_mode string")
    assert truckloads.truck_mode_filter(flows).count() == 1


def test_crossing_map_can_follow_other_names(spark):
    frame = spark.createDataFrame([(1, 5, 1, "x-border", 10.0, 9e5, 1.0)], FLOW)
    base = inputs.factors(spark)
    none = TruckFactors(base.allocation, base.equivalency, base.empty,
                        crossing_map={"domestic": "domestic"})
    statuses = lambda f: {
        r.status for r in truckloads.annual_truckloads(frame, f).collect()
    }
    assert statuses(base) == {"Loaded", "Empty"}
    assert statuses(none) == {"Loaded"}


def test_vehicle_without_allocation_rejects_its_commodity(spark):
    base = inputs.factors(spark)
    partial = TruckFactors(
        base.allocation.filter("NOT (minimum_range = 0 AND vehicle_type = 'TT')"),
        base.equivalency,
        base.empty,
    )
    frame = spark.createDataFrame(
        [(1, 5, 1, "domestic", 10.0, 100.0, 1.0), (2, 5, 1, "domestic", 90.0, 100.0, 1.0)],
        FLOW,
    )
    rejected = truckloads.rejected_flows(frame, partial).collect()
    assert [(r.flow_id, r.reason) for r in rejected] == [(1, "no factors for commodity")]
    assert {r.flow_id for r in truckloads.annual_truckloads(frame, partial).collect()} == {2}


def test_one_pass_without_shuffle(spark, sf_dir):
    """From the flows on there is no exchange but for broadcasts."""
    annual = truckloads.annual_truckloads(
        inputs.study_flows(spark, sf_dir), inputs.factors(spark)
    )
    plan = annual._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert "Exchange SinglePartition" not in plan
    assert plan.count("BroadcastHashJoin") == 1
    assert "PushedFilters" in plan


def test_layout_does_not_matter(spark, sf_dir):
    study, factors = inputs.study_flows(spark, sf_dir), inputs.factors(spark)
    results = [
        sorted(map(str, truckloads.annual_truckloads(study.repartition(n), factors).collect()))
        for n in (1, 37)
    ]
    assert results[0] == results[1]
    assert len(set(chain(results[0]))) == len(results[0])


def test_generated_code_is_small_enough_to_be_compiled(spark, sf_dir):
    """The JVM compiles no method of over 8,000 bytes; wider flows must fit too."""
    study = inputs.study_flows(spark, sf_dir)
    wide = study.withColumns({f"extra{i}": F.col("exp_tons") * i for i in range(10)})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        trucks = truckloads.annual_truckloads(wide, inputs.factors(spark))
        plan = trucks._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert 0 < max(sizes) < 7800


def test_bands_with_gaps_open_ends_and_halves(make):
    bands = make([(5, 9), (10, 19), (31, 2147483647)], "minimum_range int, maximum_range int")
    rows = [(d,) for d in (None, -1.0, 4.4, 4.6, 9.5, 9.4, 10.5, 19.5, 20.0, 30.4, 30.6, 3e9, float("nan"))]
    got = {
        str(r.wgt_dist): (r.minimum_range, r.maximum_range)
        for r in truckloads.distance_band_lookup(make(rows, "wgt_dist double"), bands).collect()
    }
    none = (None, None)
    assert got == {
        "None": none, "-1.0": none, "4.4": none, "4.6": (5, 9), "9.5": (10, 19), "9.4": (5, 9),
        "10.5": (10, 19), "19.5": none, "20.0": none, "30.4": none, "30.6": (31, 2147483647),
        "3000000000.0": none, "nan": none,
    }
    inner = truckloads.distance_band_lookup(make(rows, "wgt_dist double"), bands, how="inner")
    assert inner.count() == 5
