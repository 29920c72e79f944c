"""Draws against plain range lookups, and where groups are very uneven."""

from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from freightlake.functions import keyed_uniform
from freightlake.operators import daily
from freightlake.operators.checks import ModelInputError
from freightlake.operators.pick import slot_tables, weighted_pick

SIZES = [200_000, 0]  # broadcast, shuffled


def drawn(rows, candidates, group, size, **options):
    return weighted_pick(
        rows,
        candidates,
        group,
        "choice",
        "weight",
        keyed_uniform("id", stage="t"),
        "picked",
        max_broadcast_rows=size,
        **options,
    )


def lookup(candidates, group, u):
    """The candidate whose stretch holds u, by plain addition."""
    mine = sorted((c, w) for g, c, w in candidates if g == group)
    if len(mine) == 1:
        return mine[0][0]
    weights = [(c, Decimal(str(w or 0))) for c, w in mine]
    total = sum(w for _, w in weights)
    upto = Decimal(0)
    for c, w in weights:
        low, upto = upto, upto + w
        if w > 0 and float(low) / float(total) <= u < float(upto) / float(total):
            return c
    return None


CANDIDATES = (
    [(1, c, float(c % 5)) for c in range(300)]  # many, some without weight
    + [(2, 7, 0.0)]  # a lone one without weight
    + [(3, 1, 0.0), (3, 2, None)]  # several without any
    + [(4, 70_000 * k, 0.25 * k) for k in range(1, 9)]  # far apart
)


@pytest.mark.parametrize("size", SIZES)
def test_equals_range_lookup(spark, size):
    rows = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 4).otherwise(F.col("id") % 6).cast("int").alias("g")
    )
    candidates = spark.createDataFrame(CANDIDATES, "g int, choice int, weight double")
    got = (
        drawn(rows, candidates, ["g"], size, count_name="n")
        .withColumn("u", keyed_uniform("id", stage="t"))
        .collect()
    )
    assert len(got) == 6000
    count = Counter(g for g, *_ in CANDIDATES)
    for r in got:
        assert r.picked == lookup(CANDIDATES, r.g, r.u), r
        assert r.n == (count[r.g] or None)


@pytest.mark.parametrize("size", SIZES)
def test_single_pool(spark, size):
    pool = [(0, c, 1.0 + c) for c in range(50)]
    rows = spark.range(2000)
    candidates = spark.createDataFrame(pool, "g int, choice int, weight double")
    got = drawn(rows, candidates.drop("g"), [], size).withColumn(
        "u", keyed_uniform("id", stage="t")
    )
    for r in got.collect():
        assert r.picked == lookup(pool, 0, r.u)


@pytest.mark.parametrize("size", SIZES)
def test_hot_group_is_spread(spark, size):
    """A third of the rows in a group of one, the rest over other groups."""
    rows = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("g")
    )
    candidates = spark.range(50).select(
        F.col("id").cast("int").alias("g"),
        F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("choice"),
        F.lit(1.0).alias("weight"),
    )
    got = drawn(rows, candidates, ["g"], size)
    assert got.count() == 30_000
    assert got.filter("picked IS NULL").count() == 0


def test_shuffled_hot_key_has_many_bins(spark):
    from freightlake.operators.pick import MIN_SHUFFLED_BINS

    rows = spark.range(10_000).select("id", F.lit(1).alias("g"))
    candidates = spark.createDataFrame([(1, 5, 1.0)], "g int, choice int, weight double")
    got = drawn(rows, candidates, ["g"], 0)
    assert got.filter("picked = 5").count() == 10_000
    assert MIN_SHUFFLED_BINS >= 64


def test_no_candidates_at_all(spark):
    empty = spark.createDataFrame([], "choice int, weight double")
    assert drawn(spark.range(5), empty, [], 10).filter("picked IS NULL").count() == 5


def test_only_one_choice(spark):
    candidates = spark.createDataFrame([(c, 1.0) for c in range(8)], "choice int, weight double")
    every = drawn(spark.range(4000), candidates, [], 100)
    one = drawn(spark.range(4000), candidates, [], 100, only=3)
    assert sorted(r.id for r in one.collect()) == sorted(
        r.id for r in every.filter("picked = 3").collect()
    )


def test_shares_follow_weights(spark):
    weights = {c: 1.0 + c for c in range(20)}
    candidates = spark.createDataFrame(list(weights.items()), "choice int, weight double")
    n = 100_000
    seen = {
        r.picked: r["count"]
        for r in drawn(spark.range(n), candidates, [], 100).groupBy("picked").count().collect()
    }
    total = sum(weights.values())
    chi = sum(
        (seen[c] - n * w / total) ** 2 / (n * w / total) for c, w in weights.items()
    )
    assert chi < 43.8  # 0.1 % point at 19 degrees of freedom


def test_draws_do_not_depend_on_layout_but_on_seed_and_stage(spark):
    def uniforms(parts, **options):
        frame = spark.range(500).repartition(parts)
        return dict(
            (r.id, r.u) for r in frame.withColumn("u", keyed_uniform("id", **options)).collect()
        )

    first = uniforms(1, stage="a")
    assert first == uniforms(13, stage="a")
    assert first != uniforms(1, stage="b")
    assert first != uniforms(1, stage="a", seed=1)
    assert all(0 <= u < 1 for u in first.values())


LINES = "flow_id string, vehicle_type string, status string, annual_trucks double, tons double, value double"


@pytest.mark.parametrize("spread", [True, False])
def test_expansion(spark, spread):
    counts = [0.0, 1.0, 9.0, 10.0, 11.0, 1000.0]
    lines = spark.createDataFrame(
        [(f"f{i}", "SU", "Loaded", n, 2 * n, n) for i, n in enumerate(counts)], LINES
    )
    got = daily.expand_trucks(lines, chunk=10, spread=spread).collect()
    seen = defaultdict(list)
    for r in got:
        seen[r.flow_id].append(r.truck_seq)
        assert (r.tons, r.value) == (2.0, 1.0)
    assert {f: sorted(s) for f, s in seen.items()} == {
        f"f{i}": list(range(1, int(n) + 1)) for i, n in enumerate(counts) if n > 0
    }


def test_one_line_with_nearly_all_trucks_is_spread_over_tasks(spark):
    lines = spark.createDataFrame([("f", "SU", "Loaded", 400_000.0, 1.0, 1.0)], LINES)
    parts = (
        daily.expand_trucks(lines)
        .groupBy(F.spark_partition_id().alias("part"))
        .count()
        .collect()
    )
    assert sum(r["count"] for r in parts) == 400_000
    assert len(parts) >= 4
    assert max(r["count"] for r in parts) < 200_000


def test_a_day_gets_its_share_and_draws_the_same_trucks_however_spread(spark):
    lines = spark.createDataFrame(
        [(f"f{i}", "SU", "Loaded", 2000.0, 1.0, 1.0) for i in range(200)], LINES
    )
    day = daily.sample_daily_trucks(lines)
    expected = 400_000 / 364
    assert abs(day.count() - expected) < 5 * expected**0.5
    keys = daily.TRUCK_KEYS
    once = sorted(map(tuple, day.select(*keys).collect()))
    again = daily.sample_daily_trucks(lines.repartition(7), spread=False)
    assert once == sorted(map(tuple, again.select(*keys).collect()))
    assert {(r.week, r.day) for r in day.collect()} == {(24, 4)}


def test_all_days_of_a_year_share_out_all_trucks(spark):
    lines = spark.createDataFrame([("f", "SU", "Loaded", 5000.0, 1.0, 1.0)], LINES)
    calendar = spark.createDataFrame([(1, 1, 3.0), (1, 2, 1.0)], "week int, day int, share double")
    first = daily.sample_daily_trucks(lines, 1, 1, calendar=calendar).count()
    second = daily.sample_daily_trucks(lines, 1, 2, calendar=calendar).count()
    assert first + second == 5000
    assert abs(first - 3750) < 200


def slots_of(candidates):
    """Slots of one group of (choice, weight), one after the other."""
    most = max(w for _, w in candidates)
    if not most:
        return []
    shares = [(c, Decimal(str(w / most)).quantize(Decimal(10) ** -12, ROUND_HALF_UP)) for c, w in candidates]
    mine = sorted((c, w) for c, w in shares if w > 0)
    total, n = sum(w for _, w in mine), len(mine)
    lights = [(c, w * n) for c, w in mine if w * n < total]
    heavies = [(c, w * n) for c, w in mine if w * n >= total]
    out, at, residual = {}, 0, heavies[0][1]
    for c, w in lights:
        while residual <= total and at + 1 < len(heavies):
            out[heavies[at][0]] = (residual / total, heavies[at + 1][0])
            residual = heavies[at + 1][1] - (total - residual)
            at += 1
        out[c] = (w / total, heavies[at][0])
        residual -= total - w
    while at + 1 < len(heavies):
        out[heavies[at][0]] = (residual / total, heavies[at + 1][0])
        residual = heavies[at + 1][1] - (total - residual)
        at += 1
    out[heavies[at][0]] = (residual / total, heavies[at][0])
    return [(c, float(out[c][0]), out[c][1]) for c, _ in mine]


GROUPS = {
    1: [(c, float(c % 5)) for c in range(60)],
    2: [(7, 0.0)],
    3: [(1, 0.0), (2, 0.0)],
    4: [(k, 1.0) for k in range(9)],
    5: [(1, 1e6), *[(k, 1e-3) for k in range(2, 40)]],
    6: [(k, 2.0**-k) for k in range(30)],
    7: [(1, 1.0), (2, 3.0), (3, 3.0), (4, 1.0), (5, 2.0)],
    8: [(1, 1e-30), (2, 1.0), (3, 1e30)],
}


@pytest.mark.parametrize("size", SIZES)
def test_slots_equal_one_pass(spark, size):
    rows = [(g, c, w) for g, own in GROUPS.items() for c, w in own]
    frame = spark.createDataFrame(rows, "g int, choice int, weight double")
    got = {}
    for r in slot_tables(frame, ["g"], "choice", "weight", size > 0).collect():
        got.setdefault(r.g, {})[r._slot] = (r._first.choice, r._own, r._second.choice)
        assert r._slots == sum(1 for c, w in GROUPS[r.g] if w > 1e-12 * max(x for _, x in GROUPS[r.g])) or r.g == 2
    for g, own in GROUPS.items():
        want = slots_of(own) if g != 2 else [(7, 1.0, 7)]
        if g == 8:
            want = [(3, 1.0, 3)]
        mine = [got.get(g, {})[i] for i in range(len(got.get(g, {})))]
        assert [c for c, *_ in mine] == [c for c, *_ in want]
        for (c, own_part, other), (_, part, second) in zip(mine, want):
            assert abs(own_part - part) < 1e-12
            assert other == second or part > 1 - 1e-12
        # Parts of a choice over all slots add up to its share.
        share = Counter()
        for c, part, other in mine:
            share[c] += part
            share[other] += 1 - part
        total = sum(w for _, w in own)
        for c, w in own:
            if total and g != 8:
                assert abs(share[c] / len(mine) - w / total) < 1e-9


@pytest.mark.parametrize("size, most", [(200_000, 1_000_000), (0, 1_000_000), (0, 8)])
def test_slots_draw_by_the_law(spark, size, most):
    rows = spark.range(40_000).select("id", (F.col("id") % 7 + 1).cast("int").alias("g"))
    pairs = [(g, c, w, f"p{c}") for g, own in GROUPS.items() for c, w in own]
    frame = spark.createDataFrame(pairs, "g int, choice int, weight double, tag string")
    got = drawn(
        rows, frame, ["g"], size, count_name="n", route="slots", payload=["tag"], max_slots=most
    ).collect()
    assert len(got) == 40_000
    for g in range(1, 8):
        mine = [r for r in got if r.g == g]
        assert {r.n for r in mine} == {len(GROUPS[g])}
        assert all(r.tag == (f"p{r.picked}" if r.picked is not None else None) for r in mine)
        total = sum(w for _, w in GROUPS[g])
        if not total:
            assert {r.picked for r in mine} == ({7} if g == 2 else {None})
            continue
        found = Counter(r.picked for r in mine)
        expected = {c: len(mine) * w / total for c, w in GROUPS[g] if len(mine) * w / total > 5}
        square = sum((found[c] - e) ** 2 / e for c, e in expected.items())
        assert square < len(expected) + 4 * (2 * len(expected)) ** 0.5 + 4


def test_a_heavy_candidate_needs_no_bins(spark):
    frame = spark.createDataFrame([(1, 1e6)] + [(k, 1e-3) for k in range(2, 3000)], "choice int, weight double")
    tables = slot_tables(frame, [], "choice", "weight", True)
    assert tables.count() == 2999
    assert not any(f.dataType.simpleString().startswith("array") for f in tables.schema)
    rows = spark.range(1_000_000)
    one = rows.select("id", F.lit(1).alias("g"))
    got = drawn(one, frame, [], 200_000, route="slots")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    assert got.filter("picked = 1").count() > 999_900


def test_beside_and_eligible(spark):
    rows = spark.range(300).select("id", (F.col("id") % 4).cast("int").alias("g"))
    pairs = [(0, 1, 1.0, True, 5), (0, 2, 9.0, False, 8), (1, 3, 1.0, False, 6)]
    frame = spark.createDataFrame(pairs, "g int, choice int, weight double, near boolean, size int")
    for route in ("stretches", "slots"):
        for size in SIZES:
            got = drawn(
                rows, frame, ["g"], size, count_name="n", route=route,
                eligible="near", beside={"most": F.max("size")},
            ).collect()
            assert {(r.g, r.picked, r.n, r.most) for r in got} == {
                (0, 1, 1, 8), (1, None, None, 6), (2, None, None, None), (3, None, None, None)
            }
    with pytest.raises(ModelInputError):
        drawn(rows, frame, ["g"], 10, route="other")
