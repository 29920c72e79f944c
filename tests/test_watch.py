"""What plans leave out, counted while they run, and routes of a plan."""

import pytest

from freightlake.operators.prefix import running_totals
from freightlake.plans import long_distance
from freightlake.plans.rejects import Watch
from freightlake.sources import stored_once
from verification import inputs


def plan(spark, sf_dir, **options):
    return long_distance.trip_matrices(
        inputs.raw_flows(spark, sf_dir),
        inputs.TARGET_YEAR,
        inputs.factors(spark),
        inputs.attractions_long(spark, sf_dir),
        inputs.zones(spark, sf_dir),
        inputs.temporal_shares(spark),
        included_attractions=["CS", "DBL", "TPT"],
        **options,
    )


def test_watched_matrices_are_the_same(spark, sf_dir):
    watch = Watch()
    watched = stored_once(plan(spark, sf_dir, watch=watch), "matrices")
    plain = plan(spark, sf_dir)
    assert sorted(map(str, watched.collect())) == sorted(map(str, plain.collect()))
    counts = {(stage, reason): n for stage, reason, n in watch.counts()}
    rejected = long_distance.rejects(
        inputs.raw_flows(spark, sf_dir),
        inputs.TARGET_YEAR,
        inputs.factors(spark),
        inputs.attractions_long(spark, sf_dir),
        inputs.zones(spark, sf_dir),
        inputs.temporal_shares(spark),
        included_attractions=["CS", "DBL", "TPT"],
    )
    want = {(r.stage, r.reason): r.rows for r in rejected.collect()}
    assert {k: n for k, n in counts.items() if n or k[0] != "truckloads"} == want


@pytest.mark.parametrize("method", ["trucks", "counts"])
def test_day_and_method_reach_the_plan(spark, sf_dir, method):
    def total(**options):
        rows = plan(spark, sf_dir, day_method=method, **options).drop("origin", "destination")
        return sum(sum(r) for r in rows.collect())

    calendar = inputs.calendar(spark)
    assert total(target_week=30, target_day=2, calendar=calendar.filter("week <> 30")) == 0
    only = calendar.filter("week = 30 AND day = 2")
    assert total(target_week=30, target_day=2, calendar=only) > 50 * max(1, total())


def test_rows_of_running_totals_are_worked_out_once(spark, make):
    frame = spark.range(5000).selectExpr("id * 7 AS id", "CAST(1 AS DECIMAL(10,0)) AS n")
    worked = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            worked.add(len(batch))
            yield batch

    got = running_totals(frame.mapInArrow(seen, frame.schema), ["n"], "id")
    assert sorted(int(r.through_n) for r in got.collect()) == list(range(1, 5001))
    assert worked.value == 5000
