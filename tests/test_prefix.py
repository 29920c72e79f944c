import random
from decimal import Decimal
from math import floor

import pytest
from pyspark.sql import functions as F

from freightlake.operators.checks import ModelInputError
from freightlake.operators.prefix import bucket_round, running_totals


def carry_over(amounts):
    """Fractions carried row by row, the last row rounded half to even."""
    out, carry = [], Decimal(0)
    for amount in amounts[:-1]:
        amount += carry
        carry = amount - floor(amount)
        out.append(floor(amount))
    last = amounts[-1] + carry
    out.append(int(last.quantize(Decimal(1), rounding="ROUND_HALF_EVEN")))
    return out


def frame(spark, groups):
    rows = [
        (g, i, Decimal(a)) for g, pairs in groups.items() for i, a in pairs
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, id bigint, amount decimal(12,3)")


@pytest.mark.parametrize("bits", [(12, 28, 44), (2, 4, 6), (5,)])
def test_equals_the_loop(spark, bits, monkeypatch):
    from freightlake.operators import prefix

    if len(bits) == 3 and bits[0] == 2:
        monkeypatch.setattr(prefix, "TOP_BLOCKS", 1)  # take every step
    plain = prefix.running_totals
    monkeypatch.setattr(
        prefix, "running_totals", lambda *a, **k: plain(*a, **k, block_bits=bits)
    )
    rng = random.Random(5)
    groups = {}
    for g in range(12):
        ids = rng.sample(range(-(2**40), 2**62), rng.randint(2, 200))
        if g % 2 == 0:
            ids = range(g, g + rng.randint(2, 400))
        groups[f"g{g}"] = [(i, Decimal(rng.randint(0, 4000)) / 1000) for i in sorted(ids)]
    groups["one"] = [(3, Decimal("2.500"))]
    got = bucket_round(frame(spark, groups), ["amount"], "id", ["g"]).collect()
    found = {(r.g, r.id): r.amount for r in got}
    for g, pairs in groups.items():
        want = carry_over([a for _, a in pairs])
        assert [found[(g, i)] for i, _ in pairs] == want
        total = sum(a for _, a in pairs)
        assert sum(want) == total.quantize(Decimal(1), rounding="ROUND_HALF_EVEN")


def test_totals_without_groups(spark):
    rows = spark.range(0, 200_000, 7).withColumn("v", F.lit(1).cast("decimal(9,0)"))
    got = running_totals(rows, ["v"], "id", prefix="t_", last="final")
    wrong = got.filter((F.col("t_v") != F.col("id") / 7 + 1) | (F.col("final") != 199_997))
    assert got.count() == rows.count()
    assert wrong.count() == 0


def test_no_window_sees_the_whole_table(spark):
    rows = spark.range(300_000).withColumn("v", F.lit(1).cast("decimal(9,0)"))
    got = running_totals(rows, ["v"], "id")
    largest = got.groupBy(F.shiftright("id", 12)).count().agg(F.max("count")).first()[0]
    assert largest == 4096
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(id#" not in plan


def test_steps_follow_the_range_of_the_ids(spark):
    from freightlake.operators.prefix import BLOCK_BITS, _steps, _written

    for ids, steps in [
        ([], 1),
        ([5, 9], 1),
        ([0, 10**9], 2),
        ([-(2**62), 2**62], 3),
        ([-(2**63), 2**63 - 1], 3),
    ]:
        frame = spark.createDataFrame([(i,) for i in ids], "id bigint")
        _, span = _written(frame, "id")
        assert len(_steps(span, BLOCK_BITS)) == steps


def test_ids_must_be_whole_numbers(spark):
    rows = spark.createDataFrame([("a", 1)], "id string, v int")
    with pytest.raises(ModelInputError):
        running_totals(rows, ["v"], "id")
