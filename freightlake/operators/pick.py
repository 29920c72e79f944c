"""Weighted draws with replacement, one per row, as an equi-join.

Every candidate of a group owns a stretch of [0, 1) as long as its share of the
group's weight; a row's uniform number falls into exactly one of them. To find
it, a group's unit interval is cut into equal bins, about as many as it has
candidates. Rows and stretches meet on (group, bin), so a row is compared with
one or two candidates only, and a group with very many rows is spread over as
many keys as it has bins.

The other route is a table of slots for each group, as many as it has candidates
with weight. A slot holds two choices and the part of it that the first one has, so
a row looks up one slot and a heavy candidate needs no bins: its weight is spread
over the slots of light ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlake.operators.checks import ModelInputError
from freightlake.operators.prefix import running_totals
from freightlake.operators.sizing import (
    MAX_BROADCAST_ROWS,
    bounded,
    broadcast_if_small,
    local_if_small,
    part_of,
)
from freightlake.sources.tables import stored_once

# Exact sums need a fixed scale. Weights are taken relative to the largest of
# their group, so only their ratio counts, and 18 decimals reach further than the
# 52 bits of a draw.
WEIGHT_TYPE = "decimal(38,18)"

_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}

# Weights as slots need them, to 12 decimals of the largest: multiplied by the slots
# of a group they stay exact, and what equals an even share does so in any engine.
SLOT_WEIGHT = "decimal(13,12)"
SLOT_COUNT = "decimal(10,0)"

# Candidates of a group up to which slots are made; a group is sorted in one task.
MAX_SLOTS = 1_000_000

# Where rows are shuffled to their candidates, a group is spread over at least
# this many keys.
MIN_SHUFFLED_BINS = 64


def _weights(
    candidates: DataFrame,
    group: list[str],
    choice: str,
    weight: str,
    payload: Sequence[str],
    small: bool,
) -> DataFrame:
    """Candidates with ``_order``, ``_candidates`` of their group and a ``_weight``.

    Weights are shares of the largest of the group. A missing or negative one counts
    as zero, and the only candidate of a group has all of it.
    """
    order = F.col(choice).cast("bigint")
    if candidates.schema[choice].dataType.simpleString() not in _INTEGRAL:
        digits = F.substring(F.md5(F.col(choice).cast("string")), 1, 15)
        order = F.conv(digits, 16, 10).cast("bigint")
    given = candidates.select(
        *group,
        choice,
        *payload,
        order.alias("_order"),
        F.greatest(F.nanvl(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(
            "_given"
        ),
    )
    none = F.lit(0).cast(WEIGHT_TYPE)
    share = F.try_divide("_given", "_most").cast(WEIGHT_TYPE)
    sole = F.when(F.col("_candidates") == 1, F.lit(1).cast(WEIGHT_TYPE))
    effective = sole.otherwise(F.coalesce(share, none)).alias("_weight")
    if small:
        # The whole table is known to be small, and so is every group.
        pool = Window.partitionBy(*group)
        counted = given.select(
            "*",
            F.count(F.lit(1)).over(pool).alias("_candidates"),
            F.max("_given").over(pool).alias("_most"),
        )
    else:
        counted = _with_sums(
            given,
            group,
            [F.count(F.lit(1)).alias("_candidates"), F.max("_given").alias("_most")],
        )
    return counted.select(*group, choice, *payload, "_order", "_candidates", effective)


def candidate_stretches(
    candidates: DataFrame,
    group: Sequence[str],
    choice: str,
    weight: str,
    small: bool,
    payload: Sequence[str] = (),
) -> DataFrame:
    """Candidates that can be drawn, with their stretch ``_low`` to ``_high``.

    ``choice`` must be unique within the group. A missing or negative weight
    counts as zero (``unusable_weights`` gives such candidates); the only
    candidate of a group is drawn whatever its weight. ``_candidates`` is the
    number of candidates of the group. Choices that are no integers lie in the
    order of a digest, the same in both forms.
    """
    group = list(group)
    weights = _weights(candidates, group, choice, weight, payload, small)
    if small:
        pool = Window.partitionBy(*group)
        upto = pool.orderBy("_order").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        summed = weights.select(
            "*",
            F.sum("_weight").over(pool).alias("_all"),
            F.sum("_weight").over(upto).alias("_upto"),
        )
    else:
        weights = _with_sums(weights, group, [F.sum("_weight").alias("_all")])
        summed = running_totals(
            weights, ["_weight"], "_order", group, prefix="_upto"
        ).withColumnRenamed("_upto_weight", "_upto")
    everything = F.col("_all").cast("double")
    upper = F.col("_upto").cast("double")
    lower = (F.col("_upto") - F.col("_weight")).cast("double")
    return summed.filter(F.col("_weight") > 0).select(
        *group,
        choice,
        *payload,
        "_candidates",
        (lower / everything).alias("_low"),
        (upper / everything).alias("_high"),
    )


def slot_tables(
    candidates: DataFrame,
    group: Sequence[str],
    choice: str,
    weight: str,
    small: bool = False,
    payload: Sequence[str] = (),
) -> DataFrame:
    """``group, _slots, _slot, _own, _first, _second``: two choices for each slot.

    ``_first`` and ``_second`` hold a choice and its payload, ``_own`` is the part of
    the slot that the first one has. Each candidate with weight names a slot. One of
    less than an even share leaves room in its slot, one of more has an excess. Room
    and excess are laid side by side in order of the choices: a light candidate's
    slot is filled up by the heavy one whose stretch of the excess holds the start
    of its room, and a heavy one's own slot, when its excess is used up, by the next
    heavy one. Sums are exact, so nothing is left over.
    """
    group = list(group)
    weights = _weights(candidates, group, choice, weight, payload, small)
    pool = Window.partitionBy(*group)
    inner = pool.orderBy("_order")
    sofar = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heavy, light = F.col("_gap") >= 0, F.col("_gap") < 0
    even = F.col("_total").cast("double")
    sided = (
        weights.select(
            *group,
            F.struct(choice, *payload).alias("_first"),
            "_order",
            F.col("_weight").cast(SLOT_WEIGHT).alias("_weight"),
        )
        .filter(F.col("_weight") > 0)
        .select(
            "*",
            F.count(F.lit(1)).over(pool).alias("_slots"),
            F.sum("_weight").over(pool).alias("_total"),
            (F.row_number().over(inner) - 1).cast("bigint").alias("_slot"),
        )
        .withColumn(
            "_gap", F.col("_weight") * F.col("_slots").cast(SLOT_COUNT) - F.col("_total")
        )
        .select(
            "*",
            F.sum(F.when(light, -F.col("_gap")).otherwise(0)).over(sofar).alias("_room"),
            F.sum(F.when(heavy, F.col("_gap")).otherwise(0)).over(sofar).alias("_excess"),
            F.lead(F.when(heavy, F.col("_first"))).over(
                pool.orderBy(heavy.cast("int"), "_order")
            ).alias("_next"),
        )
    )
    # From the far end on, the last one seen is the first that reaches far enough.
    # A heavy one that ends where room starts has nothing left for it.
    starts = F.when(heavy, F.col("_excess")).otherwise(F.col("_room") + F.col("_gap"))
    ends = F.when(heavy, F.col("_excess")).otherwise(F.col("_room"))
    far = [heavy.cast("int"), F.desc("_order")]

    def seen(position: Column) -> Window:
        ordered = pool.orderBy(position.desc(), *far)
        return ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    filler = F.last(F.when(heavy, F.col("_first")), ignorenulls=True).over(seen(starts))
    used = F.last(F.when(light, F.col("_room")), ignorenulls=True).over(seen(ends))
    matched = sided.withColumn("_filler", filler).withColumn("_used", used)
    left = F.when(
        F.col("_excess") > 0, (F.col("_excess") - F.col("_used")).cast("double") / even
    ).otherwise(0.0)
    own = F.when(heavy, 1.0 + left).otherwise(1.0 + F.col("_gap").cast("double") / even)
    second = F.when(heavy, F.col("_next")).otherwise(F.col("_filler"))
    return matched.select(
        *group, "_slots", "_slot", own.alias("_own"), "_first",
        F.coalesce(second, "_first").alias("_second"),
    )


def _with_sums(rows: DataFrame, group: list[str], sums: list[Column]) -> DataFrame:
    """Rows with aggregates of their group, or of all rows without a group."""
    totals = rows.groupBy(*group).agg(*sums)
    if group:
        return rows.join(totals, group)
    names = [name for name in totals.columns]
    return rows.withColumns({n: totals.select(n).scalar() for n in names})


def unusable_weights(candidates: DataFrame, weight: str) -> DataFrame:
    """Candidates whose weight is missing, negative or no number."""
    value = F.col(weight).cast("double")
    return candidates.filter(value.isNull() | F.isnan(value) | (value < 0))


def _power_of_two_from(n: Column, least: int) -> Column:
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(n, F.lit(least)))))


def weighted_pick(
    rows: DataFrame,
    candidates: DataFrame,
    group: Sequence[str],
    choice: str,
    weight: str,
    uniform: Column,
    name: str,
    count_name: str | None = None,
    only: int | str | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    payload: Sequence[str] = (),
    eligible: str | None = None,
    beside: dict[str, Column] | None = None,
    route: str = "stretches",
    max_slots: int = MAX_SLOTS,
) -> DataFrame:
    """Add ``name``: for each row one ``choice`` drawn by weight in its group.

    ``group`` columns carry the same names in rows and candidates; with none
    there is a single pool. Rows whose group has no candidate, or no weight on
    any of several, get NULL. ``count_name`` adds the number of candidates;
    ``only`` keeps just the rows for which that choice is drawn.

    A row whose ``uniform`` is NULL draws nothing.

    ``payload`` names columns of the candidates that the drawn one hands to the row.
    With ``eligible``, a boolean column, other candidates can't be drawn and don't
    count; ``beside`` adds aggregates over all candidates of the row's group.

    ``route`` is "stretches" or "slots". Slots draw by the same law, but not the
    same choices; groups of more than ``max_slots`` candidates still go by
    stretches.
    """
    group, payload, beside = list(group), list(payload), dict(beside or {})
    if route not in ("stretches", "slots"):
        raise ModelInputError(f"no route {route}")
    flag = [eligible] if eligible else []
    aggregated = [c for c in candidates.columns if beside and c not in {*group, choice, weight, *payload, *flag}]
    needed = candidates.select(*group, choice, weight, *payload, *flag, *aggregated)
    needed = part_of(needed, candidates)
    local = bounded(needed, max_broadcast_rows)
    small = local is not None
    # More candidates than can be broadcast are read several times below.
    candidates = local if small else stored_once(needed, "candidates")
    counts = F.count(F.lit(1)) if eligible is None else F.count_if(F.col(eligible))
    drawable = candidates.filter(F.col(eligible)) if eligible else candidates
    found = [counts.alias("_candidates"), *[c.alias(n) for n, c in beside.items()]]
    if group:
        sizes = candidates.groupBy(*group).agg(*found)
        sizes = F.broadcast(sizes) if small else broadcast_if_small(
            sizes, max_broadcast_rows
        )
        sized = rows.join(sizes, group, "left")
    else:
        total = candidates.agg(*found)
        sized = rows.withColumns({n: total.select(n).scalar() for n in total.columns})
    sized = sized.withColumn("_candidates", F.nullif(F.col("_candidates"), F.lit(0)))
    drawn = sized.withColumn("_u", uniform)
    kept = [F.col(f"r.{c}") for c in rows.columns if c not in {name, *payload, *beside}]
    if count_name:
        kept.append(F.col("_candidates").alias(count_name))
    kept += [F.col(f"r.{n}") for n in beside]
    how = (drawable, group, choice, weight, name, kept, small, only, payload)
    if route == "stretches":
        return _by_stretches(drawn, *how)
    # Small candidates have small groups.
    if small and max_broadcast_rows <= max_slots:
        return _by_slots(drawn, *how)
    of_size = _with_sums(drawable, group, [F.count(F.lit(1)).alias("_n")])
    many = of_size.filter(F.col("_n") > max_slots).drop("_n")
    if many.isEmpty():
        return _by_slots(drawn, *how)
    large = F.col("_candidates") > max_slots
    fit = drawn.filter(F.coalesce(~large, F.lit(True)))
    few = of_size.filter(F.col("_n") <= max_slots).drop("_n")
    slots = _by_slots(fit, few, *how[1:])
    return slots.unionByName(_by_stretches(drawn.filter(large), many, *how[1:]))


def _by_stretches(
    drawn: DataFrame,
    candidates: DataFrame,
    group: list[str],
    choice: str,
    weight: str,
    name: str,
    kept: list[Column],
    small: bool,
    only: int | str | None,
    payload: list[str],
) -> DataFrame:
    least = 1 if small else MIN_SHUFFLED_BINS
    stretches = candidate_stretches(candidates, group, choice, weight, small, payload)
    stretches = stretches.withColumn(
        "_bins", _power_of_two_from(F.col("_candidates"), least)
    )
    # Bins are a power of two in number, so scaling by it is exact.
    first = F.floor(F.col("_low") * F.col("_bins"))
    final = F.ceil(F.col("_high") * F.col("_bins")) - 1
    binned = stretches.filter(F.col("_high") > F.col("_low")).select(
        *group,
        F.explode(F.sequence(first, final)).alias("_bin"),
        "_low",
        "_high",
        F.col(choice).alias(name),
        *payload,
    )
    bins = _power_of_two_from(F.coalesce(F.col("_candidates"), F.lit(1)), least)
    bin_of = F.floor(F.col("_u") * bins)
    if not small:
        # Rows that draw nothing are spread over bins that are not there.
        apart = F.pmod(F.hash(*[F.col(f"`{c}`") for c in drawn.columns]), F.lit(least))
        bin_of = F.coalesce(bin_of, -1 - apart.cast("bigint"))
    placed = drawn.withColumn("_bin", bin_of)
    keys = [F.col(f"r.{key}") == F.col(f"c.{key}") for key in [*group, "_bin"]]
    inside = (F.col("_u") >= F.col("_low")) & (F.col("_u") < F.col("_high"))
    right = F.broadcast(binned) if small else binned
    how = "left"
    if only is not None:
        right = right.filter(F.col(name) == F.lit(only))
        how = "inner"
    taken = [F.col(f"c.{c}") for c in [name, *payload]]
    return placed.alias("r").join(right.alias("c"), [*keys, inside], how).select(*kept, *taken)


def _by_slots(
    drawn: DataFrame,
    candidates: DataFrame,
    group: list[str],
    choice: str,
    weight: str,
    name: str,
    kept: list[Column],
    small: bool,
    only: int | str | None,
    payload: list[str],
) -> DataFrame:
    tables = slot_tables(candidates, group, choice, weight, small, payload)
    slots = tables.select(*group, "_slots", "_slot", "_own", "_first", "_second")
    if small:
        # The tables are worked out once; number and rows of slots are read from them.
        slots = local_if_small(slots, max(1, MAX_SLOTS))
    else:
        slots = stored_once(slots, "slots")
    numbers = slots.filter(F.col("_slot") == 0).select(*group, "_slots")
    if group:
        numbers = F.broadcast(numbers) if small else broadcast_if_small(numbers)
        placed = drawn.join(numbers, group, "left")
    else:
        one = numbers.agg(F.max("_slots").alias("_slots"))
        placed = drawn.withColumn("_slots", one.scalar())
    scaled = F.col("_u") * F.col("_slots")
    placed = placed.withColumn("_slot", F.floor(scaled)).withColumn("_part", scaled - F.col("_slot"))
    keys = [F.col(f"r.{key}") == F.col(f"c.{key}") for key in [*group, "_slot"]]
    right = slots.drop("_slots")
    right = F.broadcast(right) if small else right
    taken = F.when(F.col("_part") < F.col("_own"), F.col("_first")).otherwise(F.col("_second"))
    picked = placed.alias("r").join(right.alias("c"), keys, "left").withColumn("_taken", taken)
    out = picked.select(
        *kept,
        F.col(f"_taken.{choice}").alias(name),
        *[F.col(f"_taken.{c}").alias(c) for c in payload],
    )
    return out if only is None else out.filter(F.col(name) == F.lit(only))
