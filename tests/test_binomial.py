"""Numbers of trucks by binomial draws, and which trucks these are."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from freightlake.functions import keyed_uniform
from freightlake.operators import daily
from freightlake.operators.binomial import binomial, choose_items, chunk_size
from freightlake.operators.checks import ModelInputError

ANNUAL = "flow_id int, vehicle_type string, status string, annual_trucks double, tons double, value double"


def chi_square(found, expected):
    return sum((found.get(k, 0) - e) ** 2 / e for k, e in expected.items())


def pmf(n, p, k):
    return math.comb(n, k) * p**k * (1 - p) ** (n - k)


def test_numbers_follow_the_plain_inversion(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 40 + 1).alias("n"))
    u = keyed_uniform("id", stage="t")
    for p in (1 / 364, 0.2, 0.5):
        for r in rows.select("n", u.alias("u"), binomial(F.col("n"), p, u).alias("k")).collect():
            upto = 0.0
            for k in range(r.n + 1):
                upto += pmf(r.n, p, k)
                if r.u < upto - 1e-12:
                    break
            assert r.k == k


@pytest.mark.parametrize("p, n, size", [(0.25, 12, None), (0.7, 12, None), (0.25, 12, 5)])
def test_law_of_numbers_and_items(spark, p, n, size):
    lines = 8000
    chosen = choose_items(spark.range(lines), F.lit(n), "item", p, ["id"], "t", size=size).collect()
    items = Counter(r.item for r in chosen)
    assert set(items) <= set(range(1, n + 1)) and len({(r.id, r.item) for r in chosen}) == len(chosen)
    # Twelve items, each with lines * p expected; 30 is beyond 99.5 % of eleven degrees.
    spread = sum((items[i] - lines * p) ** 2 / (lines * p * (1 - p)) for i in range(1, n + 1))
    assert spread < 32
    numbers = Counter(Counter(r.id for r in chosen).values())
    numbers[0] = lines - sum(numbers.values())
    expected = {k: lines * pmf(n, p, k) for k in range(n + 1) if lines * pmf(n, p, k) > 5}
    assert chi_square(numbers, expected) < 3 * len(expected)
    # Two items are in the same draw as often as independent ones.
    sets = {}
    for r in chosen:
        sets.setdefault(r.id, set()).add(r.item)
    both = sum({1, 2} <= s for s in sets.values())
    assert abs(both - lines * p * p) < 4 * math.sqrt(lines * p * p)


def test_edges(spark):
    frame = spark.createDataFrame(
        [(1, 5.0), (2, 0.0), (3, None), (4, -2.0), (5, 2.9), (6, 3_000_000.0)], "id int, n double"
    )
    count = lambda p, **o: Counter(r.id for r in choose_items(frame.where("id < 6"), F.col("n"), "i", p, ["id"], "t", **o).collect())
    assert count(0.0) == {} and count(1.0) == count(1.0, size=2) == {1: 5, 5: 2}
    many = choose_items(frame.where("id = 6"), F.col("n"), "i", 1 / 364, ["id"], "t").collect()
    mean = 3_000_000 / 364
    assert abs(len(many) - mean) < 5 * math.sqrt(mean)
    numbers = sorted(r.i for r in many)
    assert len(set(numbers)) == len(numbers) and 0 < numbers[0] and numbers[-1] <= 3_000_000
    tenths = Counter(i * 10 // 3_000_001 for i in numbers)
    assert chi_square(tenths, dict.fromkeys(range(10), len(many) / 10)) < 28
    with pytest.raises(ValueError):
        choose_items(frame, F.col("n"), "i", 1.5, ["id"], "t")
    assert chunk_size(1 / 364) < 364 * 65 and chunk_size(0.0) == chunk_size(1.0)


def test_day_of_trucks_by_counts(make):
    rows = [(i, "SU", "Loaded", 40.0, 80.0, 120.0) for i in range(4000)] + [(-1, "TT", "Empty", 0.0, 1.0, 1.0)]
    annual = make(rows, ANNUAL)
    one = daily.sample_daily_trucks(annual, method="counts")
    each = daily.sample_daily_trucks(annual)
    assert set(one.columns) == set(each.columns)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    mean = 4000 * 40 / 364
    got = one.collect()
    for found in (got, each.collect()):
        assert abs(len(found) - mean) < 4 * math.sqrt(mean)
    assert {(r.tons, r.value, r.week, r.day) for r in got} == {(2.0, 3.0, 24, 4)}
    assert sorted(map(tuple, got)) == sorted(
        map(tuple, daily.sample_daily_trucks(annual.repartition(5), method="counts").collect())
    )
    calendar = make([(1, 1, 1.0), (1, 2, 3.0), (1, 3, None), (1, 4, -2.0)], "week int, day int, share double")
    own = daily.sample_daily_trucks(annual, 1, 2, calendar=calendar, method="counts").count()
    assert abs(own - 120_000) < 4 * math.sqrt(30_000)
    for week, day in ((1, 3), (1, 4), (2, 1)):
        assert daily.sample_daily_trucks(annual, week, day, calendar=calendar, method="counts").count() == 0
    assert daily.day_share(make([(3, 3, 0.0)], "week int, day int, share double"), 3, 3) == 1.0
    assert daily.day_share(calendar.limit(0), 1, 1) == 0.0
    with pytest.raises(ModelInputError):
        daily.sample_daily_trucks(annual, method="other")
