"""Regional commodity flows: pick a year, scale, tag and keep."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.functions import is_in, to_int
from freightlake.operators.checks import ModelInputError, require_columns
from freightlake.operators.crosstab import crosstab_sums
from freightlake.operators.profile import percent
from freightlake.operators.sizing import MAX_BROADCAST_ROWS, broadcast_if_small

# Yearly measure, its output column and the unit it is stored in.
MEASURES = [
    ("tons", "exp_tons", 1e3),
    ("value", "exp_value", 1e6),
    ("tmiles", "exp_tmiles", 1e6),
]

# Columns that hold whole-number codes.
CODE_COLUMNS = [
    "fr_orig",
    "dms_orig",
    "fr_dest",
    "dms_dest",
    "sctg2",
    "dms_mode",
    "trade_type",
]

# Trade type and transport mode names by code.
TRADE_TYPES = {1: "domestic", 2: "x-border", 3: "x-border"}
TRANSPORT_MODES = {
    1: "Truck",
    2: "Rail",
    3: "Water",
    4: "Air",
    5: "Multiple",
    6: "Pipeline",
    7: "Other",
    8: "None",
}


def data_years(flows: DataFrame) -> list[int]:
    """Years for which the table has a ``tons_YYYY`` column, in column order."""
    return [
        int(name[5:9])
        for name in flows.columns
        if name.startswith("tons_") and name[5:9].isdigit()
    ]


def year_measures(
    flows: DataFrame, target_year: int, interpolate: bool = False
) -> DataFrame:
    """Replace the yearly columns by tons, value and ton-miles of one year.

    The year with data closest to ``target_year`` is used, the first column on
    a tie. With ``interpolate``, a target between two years with data gets the
    straight line between them instead.
    """
    years = data_years(flows)
    if not years:
        raise ModelInputError("flows have no tons_YYYY column")
    nearest = min(years, key=lambda year: abs(year - target_year))
    before = [year for year in years if year <= target_year]
    after = [year for year in years if year >= target_year]

    def measure(name: str) -> Column:
        if not interpolate or not before or not after:
            return F.col(f"{name}_{nearest}")
        low, high = max(before), min(after)
        if low == high:
            return F.col(f"{name}_{low}")
        step = (target_year - low) / (high - low)
        start = F.col(f"{name}_{low}")
        return start + (F.col(f"{name}_{high}") - start) * F.lit(step)

    yearly = {f"{name}_{year}" for name, _, _ in MEASURES for year in years}
    kept = [F.col(name) for name in flows.columns if name not in yearly]
    return flows.select(
        *kept,
        F.lit(target_year).alias("year"),
        *[(measure(name) * F.lit(unit)).alias(out) for name, out, unit in MEASURES],
    )


def recast_codes(
    flows: DataFrame, columns: Sequence[str] = tuple(CODE_COLUMNS)
) -> DataFrame:
    """Code columns that arrive as text become integers; junk becomes NULL."""
    return flows.withColumns({name: to_int(name) for name in columns})


def classify_direction(
    flows: DataFrame, internal_regions: Collection[int] | None
) -> DataFrame:
    """Tag flows as internal, outbound, inbound or drop."""
    if internal_regions is None:
        return flows.withColumn("direction", F.lit("internal"))
    starts = is_in("dms_orig", internal_regions)
    ends = is_in("dms_dest", internal_regions)
    return flows.withColumn(
        "direction",
        F.when(starts & ends, "internal")
        .when(starts, "outbound")
        .when(ends, "inbound")
        .otherwise("drop"),
    )


def two_way_pairs(pairs: DataFrame) -> DataFrame:
    """Outer region pairs in both directions, one row per ordered pair.

    A pair given both ways, or with equal ends, would otherwise double the
    flows it matches. The direction as listed wins over the derived one.
    """
    require_columns(pairs, ["dms_orig", "dms_dest"], "outer region pairs")
    swap = {"dms_orig": "dms_dest", "dms_dest": "dms_orig"}
    if {"entry", "exit"} <= set(pairs.columns):
        swap |= {"entry": "exit", "exit": "entry"}
    reverse = pairs.select(
        *[F.col(swap.get(name, name)).alias(name) for name in pairs.columns]
    )
    extras = [c for c in pairs.columns if c not in ("dms_orig", "dms_dest")]
    ranked = pairs.withColumn("_derived", F.lit(0)).unionByName(
        reverse.withColumn("_derived", F.lit(1))
    )
    first = F.min(F.struct("_derived", *extras)).alias("_first")
    return (
        ranked.groupBy("dms_orig", "dms_dest")
        .agg(first)
        .select("dms_orig", "dms_dest", *[f"_first.{name}" for name in extras])
    )


def tag_through_pairs(
    flows: DataFrame,
    pairs: DataFrame,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Tag flows between outer region pairs as through, over any other tag.

    Further columns of ``pairs`` are carried to the flows they match.
    """
    both = two_way_pairs(pairs).withColumn("_through", F.lit(True))
    joined = flows.join(
        broadcast_if_small(both, max_broadcast_rows), ["dms_orig", "dms_dest"], "left"
    )
    return joined.withColumn(
        "direction", F.when(F.col("_through"), "through").otherwise(F.col("direction"))
    ).drop("_through")


def _named(column: str, names: dict[int, str]) -> Column:
    code = F.col(column)
    named = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, name in names.items():
        named = named.when(code == value, name)
    return named


def recode_trade_mode(flows: DataFrame) -> DataFrame:
    """Trade type code to its name; add the name of the transport mode."""
    return flows.withColumns(
        {
            "trade_type": _named("trade_type", TRADE_TYPES),
            "domestic_mode": _named("dms_mode", TRANSPORT_MODES),
        }
    )


def retain_study_flows(flows: DataFrame, tag: str = "direction") -> DataFrame:
    return flows.filter(F.col(tag) != "drop")


def prepare_flows(
    flows: DataFrame,
    target_year: int,
    interpolate: bool = False,
    internal_regions: Collection[int] | None = None,
    outer_regions: DataFrame | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Flow database to tagged annual flows of the study area; one narrow pass."""
    if internal_regions is None and outer_regions is not None:
        raise ModelInputError("outer regions need internal regions")
    prepared = recast_codes(year_measures(flows, target_year, interpolate))
    tagged = classify_direction(prepared, internal_regions)
    if outer_regions is not None:
        tagged = tag_through_pairs(tagged, outer_regions, max_broadcast_rows)
    return retain_study_flows(recode_trade_mode(tagged))


@dataclass(frozen=True)
class TagRule:
    """A tag for flows whose ends lie in, or outside, the given regions."""

    tag: str
    from_regions: Collection[int] | None = None
    to_regions: Collection[int] | None = None
    not_from: Collection[int] | None = None
    not_to: Collection[int] | None = None

    def matches(self) -> Column:
        test = F.lit(True)
        if self.from_regions is not None:
            test = test & is_in("dms_orig", self.from_regions)
        if self.to_regions is not None:
            test = test & is_in("dms_dest", self.to_regions)
        if self.not_from is not None:
            test = test & ~is_in("dms_orig", self.not_from)
        if self.not_to is not None:
            test = test & ~is_in("dms_dest", self.not_to)
        return test


def study_area_tag_rules(
    flows: DataFrame, rules: Sequence[TagRule], tag: str = "tag"
) -> DataFrame:
    """Apply ordered rules; the last one that matches a flow decides."""
    chosen = F.lit("drop")
    for rule in rules:
        chosen = F.when(rule.matches(), rule.tag).otherwise(chosen)
    return flows.withColumn(tag, chosen)


def zero_flow_report(flows: DataFrame) -> DataFrame:
    """Number and percent of flows with neither tons nor value."""
    zero = (F.col("exp_value") <= 0) & (F.col("exp_tons") <= 0)
    counted = flows.agg(
        F.count_if(zero).alias("zero_flows"), F.count(F.lit(1)).alias("flows")
    )
    return counted.withColumn("pct_zero", percent("zero_flows", "flows"))


def direction_counts(flows: DataFrame) -> DataFrame:
    return flows.groupBy("direction").agg(F.count(F.lit(1)).alias("flows"))


def crosstab_tons_margins(flows: DataFrame) -> DataFrame:
    """Tons by mode and direction with row, column and grand totals."""
    return crosstab_sums(flows, "domestic_mode", "direction", "exp_tons")
