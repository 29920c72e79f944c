"""One registered query per operator, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlake.functions import half_even
from freightlake.operators import allocation, binomial, daily, flows, generation, links
from freightlake.operators import local, matrices, profile, tripends, truckloads
from freightlake.operators.prefix import bucket_round
from freightlake.plans import local_trips, long_distance
from freightlake.plans.rejects import Watch
from freightlake.sources import (
    file_attributes,
    read_table,
    shared_folder,
    stored_once,
    write_table,
)
from verification import inputs as given
from verification import oracle as sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = sql.with_ctes(oracle)
        return function

    return register


FLOW_CODES = (
    "flow_id, fr_orig, dms_orig, dms_dest, fr_dest, dms_mode, trade_type, sctg2, wgt_dist"
)

# --- flow preparation ------------------------------------------------------


@query("nearest_year_measures", "SELECT * FROM measured")
def _(spark, d):
    return flows.year_measures(given.raw_flows(spark, d), given.TARGET_YEAR)


@query(
    "interpolated_year_measures",
    f"""
    SELECT {FLOW_CODES}, 2014 AS year,
      (tons_2012 + (tons_2015 - tons_2012) * (2::DOUBLE / 3::DOUBLE)) * 1e3::DOUBLE AS exp_tons,
      (value_2012 + (value_2015 - value_2012) * (2::DOUBLE / 3::DOUBLE)) * 1e6::DOUBLE AS exp_value,
      (tmiles_2012 + (tmiles_2015 - tmiles_2012) * (2::DOUBLE / 3::DOUBLE)) * 1e6::DOUBLE
        AS exp_tmiles
    FROM raw_flows
    """,
)
def _(spark, d):
    return flows.year_measures(
        given.raw_flows(spark, d), given.TARGET_YEAR, interpolate=True
    )


@query(
    "recast_codes",
    "SELECT * REPLACE (CASE WHEN sctg2 % 7 <> 0 THEN sctg2 END AS sctg2) FROM raw_flows",
)
def _(spark, d):
    return flows.recast_codes(given.text_flows(spark, d))


@query("classify_direction", "SELECT * FROM directed")
def _(spark, d):
    measured = flows.year_measures(given.raw_flows(spark, d), given.TARGET_YEAR)
    return flows.classify_direction(measured, given.INTERNAL_REGIONS)


@query("tag_through_pairs", "SELECT * FROM through")
def _(spark, d):
    measured = flows.year_measures(given.raw_flows(spark, d), given.TARGET_YEAR)
    directed = flows.classify_direction(measured, given.INTERNAL_REGIONS)
    return flows.tag_through_pairs(directed, given.outer_pairs(spark))


@query("recode_trade_mode", "SELECT * EXCLUDE (direction) FROM national_flows")
def _(spark, d):
    measured = flows.year_measures(given.raw_flows(spark, d), given.TARGET_YEAR)
    return flows.recode_trade_mode(measured)


@query("retain_study_flows", "SELECT * FROM study_flows")
def _(spark, d):
    return given.study_flows(spark, d, internal_regions=given.INTERNAL_REGIONS)


@query(
    "zero_flow_report",
    f"""
    SELECT zero_flows, flows, {sql.rounded("zero_flows / flows * 100", 1)} AS pct_zero
    FROM (SELECT count(*) FILTER (exp_tons <= 0 AND exp_value <= 0) AS zero_flows,
      count(*) AS flows FROM national_flows)
    """,
)
def _(spark, d):
    return flows.zero_flow_report(given.study_flows(spark, d))


@query(
    "direction_counts",
    "SELECT direction, count(*) AS flows FROM through WHERE direction <> 'drop' GROUP BY 1",
)
def _(spark, d):
    return flows.direction_counts(
        given.study_flows(
            spark,
            d,
            internal_regions=given.INTERNAL_REGIONS,
            outer_regions=given.outer_pairs(spark),
        )
    )


@query(
    "crosstab_tons_margins",
    sql.crosstab("study_flows", "domestic_mode", "direction", "sum(exp_tons)", "exp_tons"),
)
def _(spark, d):
    return flows.crosstab_tons_margins(
        given.study_flows(spark, d, internal_regions=given.INTERNAL_REGIONS)
    )


WEST, EAST, NORTH = [101, 102, 103], [110, 111], [120]
TAG_RULES = [
    flows.TagRule("internal", from_regions=NORTH, to_regions=NORTH),
    flows.TagRule("outbound", from_regions=NORTH, not_to=NORTH),
    flows.TagRule("inbound", not_from=NORTH, to_regions=NORTH),
    flows.TagRule("through", from_regions=WEST, not_to=EAST),
    flows.TagRule("through", from_regions=EAST, to_regions=[115, 120]),
    flows.TagRule("through", from_regions=[115], to_regions=EAST),
]


@query(
    "study_area_tag_rules",
    """
    SELECT *, CASE
      WHEN dms_orig = 115 AND dms_dest IN (110, 111) THEN 'through'
      WHEN dms_orig IN (110, 111) AND dms_dest IN (115, 120) THEN 'through'
      WHEN dms_orig IN (101, 102, 103) AND dms_dest NOT IN (110, 111) THEN 'through'
      WHEN dms_orig <> 120 AND dms_dest = 120 THEN 'inbound'
      WHEN dms_orig = 120 AND dms_dest <> 120 THEN 'outbound'
      WHEN dms_orig = 120 AND dms_dest = 120 THEN 'internal'
      ELSE 'drop' END AS tag
    FROM national_flows
    """,
)
def _(spark, d):
    return flows.study_area_tag_rules(given.study_flows(spark, d), TAG_RULES)


# --- annual truckloads -----------------------------------------------------


def _loads(spark: SparkSession, d: str):
    return given.study_flows(spark, d), given.factors(spark)


@query("truck_mode_filter", "SELECT * FROM truck_flows")
def _(spark, d):
    return truckloads.truck_mode_filter(given.study_flows(spark, d))


@query(
    "normalise_allocation_bands",
    f"""
    SELECT s.*, coalesce(b.flows, 0) AS flows,
      {sql.rounded("b.tons * s.alloc_factor", 3)} AS tons
    FROM shares s LEFT JOIN (SELECT minimum_range, maximum_range, count(*) AS flows,
        sum(exp_tons) AS tons FROM banded GROUP BY 1, 2) b USING (minimum_range, maximum_range)
    """,
)
def _(spark, d):
    """Shares of each band, and the tons they allot to each vehicle type."""
    study, tables = _loads(spark, d)
    shares = truckloads.normalise_allocation_bands(tables.allocation)
    banded = truckloads.distance_band_lookup(
        truckloads.truck_mode_filter(study), tables.allocation
    )
    band = ["minimum_range", "maximum_range"]
    per_band = banded.groupBy(*band).agg(
        F.count("flow_id").alias("flows"), F.sum("exp_tons").alias("tons")
    )
    return shares.join(per_band, band, "left").select(
        *band,
        "vehicle_type",
        "alloc_factor",
        F.coalesce("flows", F.lit(0)).alias("flows"),
        half_even(F.col("tons") * F.col("alloc_factor"), 3).alias("tons"),
    )


@query(
    "distance_band_lookup",
    "SELECT flow_id, wgt_dist, minimum_range, maximum_range FROM banded",
)
def _(spark, d):
    study, tables = _loads(spark, d)
    return truckloads.distance_band_lookup(
        truckloads.truck_mode_filter(study).select("flow_id", "wgt_dist"),
        tables.allocation,
    )


@query(
    "unpivot_equivalency",
    """
    SELECT vehicle_type, sctg2, body_type, equiv_factor, count(f.flow_id) AS flows
    FROM equiv LEFT JOIN truck_flows f USING (sctg2)
    GROUP BY ALL
    """,
)
def _(spark, d):
    """Positive factors in long form, with the flows each applies to."""
    study, tables = _loads(spark, d)
    long = truckloads.unpivot_equivalency(tables.equivalency)
    used = truckloads.truck_mode_filter(study).groupBy("sctg2").count()
    return long.join(used, "sctg2", "left").select(
        *long.columns, F.coalesce("count", F.lit(0)).alias("flows")
    )


@query(
    "unpivot_empty",
    """
    SELECT e.crossing_type, body_type, vehicle_type, empty_factor, coalesce(flows, 0) AS flows
    FROM empties e LEFT JOIN (SELECT crossing_type, count(*) AS flows
      FROM (SELECT CASE trade_type WHEN 'domestic' THEN 'domestic' ELSE 'border' END
        AS crossing_type FROM truck_flows) GROUP BY 1) f
      ON e.crossing_type = f.crossing_type
    """,
)
def _(spark, d):
    """Factors in long form, with the flows of each crossing type."""
    study, tables = _loads(spark, d)
    long = truckloads.unpivot_empty(tables.empty)
    crossing = truckloads.crossing_type(tables).alias("crossing_type")
    used = truckloads.truck_mode_filter(study).groupBy(crossing).count()
    return long.join(used, "crossing_type", "left").select(
        *long.columns, F.coalesce("count", F.lit(0)).alias("flows")
    )


@query(
    "loaded_trucks",
    f"""
    SELECT c.flow_id, c.vehicle_type, t.zed,
      {sql.rounded(sql.settled("sum(c.trucks)"))} AS annual_trucks
    FROM cells c JOIN totals t USING (flow_id) GROUP BY ALL
    """,
)
def _(spark, d):
    study, tables = _loads(spark, d)
    return truckloads.loaded_trucks(study, tables).select(
        "flow_id", "vehicle_type", "zed", "annual_trucks"
    )


@query(
    "min_one_truck",
    "SELECT flow_id, zed, vehicle_type, CAST(1 AS DOUBLE) AS annual_trucks FROM largest",
)
def _(spark, d):
    study, tables = _loads(spark, d)
    return truckloads.min_one_truck(study, tables).select(
        "flow_id", "zed", "vehicle_type", "annual_trucks"
    )


# Lighter loads, so that the rule for flows that round to nothing applies.
SPARSE = 0.05


@query(
    "rounding_rescue",
    f"""
    SELECT flow_id, zed, 'SU' AS vehicle_type, CAST(1 AS DOUBLE) AS annual_trucks
    FROM (SELECT flow_id, {sql.settled("sum(n)")} AS zed, sum({sql.rounded(sql.settled("n"))}) AS whole,
        count(*) FILTER (vehicle_type = 'SU') AS has_su
      FROM (SELECT flow_id, vehicle_type, sum(trucks * {SPARSE}::DOUBLE) AS n FROM cells
        GROUP BY flow_id, vehicle_type)
      GROUP BY flow_id)
    WHERE zed > 1 AND whole = 0 AND has_su > 0
    """,
)
def _(spark, d):
    study, tables = _loads(spark, d)
    return truckloads.rounding_rescue(study, tables, SPARSE).select(
        "flow_id", "zed", "vehicle_type", "annual_trucks"
    )


@query(
    "empty_trucks",
    "SELECT flow_id, vehicle_type, annual_trucks, tons, value FROM annual WHERE status = 'Empty'",
)
def _(spark, d):
    study, tables = _loads(spark, d)
    return truckloads.empty_trucks(study, tables).select(
        "flow_id", "vehicle_type", "annual_trucks", "tons", "value"
    )


@query(
    "split_tons_value",
    "SELECT flow_id, vehicle_type, annual_trucks, tons, value FROM annual WHERE status = 'Loaded'",
)
def _(spark, d):
    study, tables = _loads(spark, d)
    return truckloads.split_tons_value(study, tables).select(
        "flow_id", "vehicle_type", "annual_trucks", "tons", "value"
    )


@query("annual_truckloads", "SELECT * FROM annual")
def annual(spark, d):
    return truckloads.annual_truckloads(*_loads(spark, d))


@query(
    "rejected_flows",
    """
    SELECT f.flow_id, f.sctg2, f.wgt_dist, f.exp_tons, CASE
      WHEN exp_tons IS NULL THEN 'no tons' WHEN wgt_dist IS NULL THEN 'no distance'
      WHEN minimum_range IS NULL THEN 'distance outside all bands'
      ELSE 'no factors for commodity' END AS reason
    FROM banded f WHERE flow_id NOT IN (SELECT flow_id FROM cells)
    """,
)
def _(spark, d):
    return truckloads.rejected_flows(*_loads(spark, d)).select(
        "flow_id", "sctg2", "wgt_dist", "exp_tons", "reason"
    )


# --- daily sample and zones ------------------------------------------------


@query("expand_trucks", "SELECT * FROM single_trucks")
def _(spark, d):
    return given.single_trucks(spark, d)


_SLOT = (
    "CAST(floor("
    + sql.uniform("day", "flow_id", "vehicle_type", "status", "truck_seq")
    + " * 364) AS INT)"
)
_DATED = f"""
    SELECT * EXCLUDE (slot), slot // 7 + 1 AS week, slot % 7 + 1 AS day
    FROM (SELECT *, {_SLOT} AS slot FROM single_trucks)
"""


@query("sample_daily_trucks", f"SELECT * FROM ({_DATED}) WHERE week = 24 AND day = 4")
def _(spark, d):
    return daily.sample_daily_trucks(given.annual_lines(spark, d))


_CALENDAR = """(SELECT CAST(week * 10 + day AS INT) AS slot,
    CAST((week * 3 + day * 5) % 11 AS DOUBLE) AS share
    FROM range(1, 53) AS w(week), range(1, 8) AS d(day))"""


@query(
    "calendar_daily_trucks",
    f"""
    SELECT t.* EXCLUDE (u), s.choice // 10 AS week, s.choice % 10 AS day
    FROM (SELECT *, {sql.uniform("day", "flow_id", "vehicle_type", "status", "truck_seq")} AS u
      FROM single_trucks) t
    JOIN ({sql.stretches(_CALENDAR, [], "slot", "share")}) s ON t.u >= s.lo AND t.u < s.hi
    WHERE s.choice = 302
    """,
)
def _(spark, d):
    return daily.sample_daily_trucks(
        given.annual_lines(spark, d), 30, 2, calendar=given.calendar(spark)
    )


@query(
    "daily_trucks_by_count",
    sql.trucks_by_count("heavy_lines", 1 / 364, binomial.chunk_size(1 / 364), 24, 4),
)
def by_count(spark, d):
    return daily.sample_daily_trucks(given.heavy_lines(spark, d), method="counts")


_SHARE = given.calendar_share(30, 2) / sum(
    given.calendar_share(week, day) for week in range(1, 53) for day in range(1, 8)
)


@query(
    "calendar_trucks_by_count",
    sql.trucks_by_count("heavy_lines", _SHARE, binomial.chunk_size(_SHARE), 30, 2),
)
def _(spark, d):
    return daily.sample_daily_trucks(
        given.heavy_lines(spark, d), 30, 2, calendar=given.calendar(spark), method="counts"
    )


@query("recode_region_to_zone", "SELECT * FROM recoded")
def _(spark, d):
    return allocation.recode_region_to_zone(
        given.flow_trips(spark, d), given.single_zones(spark, d)
    )


@query("combi_attractions", "SELECT * FROM combi")
def _(spark, d):
    return allocation.combi_attractions(given.attractions_wide(spark, d))


def _allocated(spark: SparkSession, d: str) -> DataFrame:
    return allocation.allocate_internal_ends(
        given.flow_trips(spark, d),
        given.INTERNAL_REGIONS,
        given.attractions_wide(spark, d),
        given.single_zones(spark, d),
        keys=["flow_id"],
    )


@query("allocate_internal_ends", "SELECT * FROM allocated")
def allocate(spark, d):
    return _allocated(spark, d)


@query(
    "uncoded_ends_check",
    """
    SELECT faf_region, count(*) AS uncoded_ends FROM (
      SELECT dms_orig AS faf_region FROM allocated WHERE origin IS NULL UNION ALL
      SELECT dms_dest FROM allocated WHERE destination IS NULL)
    GROUP BY 1
    """,
)
def _(spark, d):
    return allocation.uncoded_ends(_allocated(spark, d))


COMBINATION = ["CS", "DBL", "TPT"]


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return tripends.tripend_candidates(
        given.attractions_long(spark, d),
        given.zones(spark, d),
        COMBINATION,
        given.phantom_zones(spark),
    )


@query("tripend_candidates", "SELECT * FROM candidates")
def _(spark, d):
    return _candidates(spark, d)


@query(
    "missing_region_check",
    """
    SELECT DISTINCT faf_region FROM (SELECT dms_orig AS faf_region FROM flow_trips
      UNION ALL SELECT dms_dest FROM flow_trips)
    WHERE faf_region NOT IN (SELECT faf_region FROM zones)
    """,
)
def _(spark, d):
    return tripends.missing_regions(given.flow_trips(spark, d), given.zones(spark, d))


@query(
    "make_use_scaling",
    """
    SELECT STDM_TAZ, ITD_district, Category, faf_region, sctg2,
      coefficient * attractions AS attractions
    FROM candidates JOIN makeuse USING (Category)
    WHERE MorU = 'M' AND coefficient * attractions > 0
    """,
)
def _(spark, d):
    return tripends.make_use_scaling(
        _candidates(spark, d), given.make_use(spark, d), "M"
    )


@query(
    "collapse_attractors",
    f"""
    SELECT STDM_TAZ, ITD_district, faf_region,
      {sql.rounded("coalesce(sum(attractions), 0)", 6)} AS attractions
    FROM candidates GROUP BY 1, 2, 3
    """,
)
def _(spark, d):
    return tripends.collapse_attractors(_candidates(spark, d)).withColumn(
        "attractions", half_even("attractions", 6)
    )


def _tripends(spark: SparkSession, d: str, phantom: bool = True) -> DataFrame:
    return tripends.sample_tripends(
        given.flow_trips(spark, d),
        given.attractions_long(spark, d),
        given.zones(spark, d),
        COMBINATION,
        given.phantom_zones(spark) if phantom else None,
        given.make_use(spark, d),
        keys=["flow_id"],
    )


@query("sample_tripends", "SELECT * FROM tripends")
def sample_ends(spark, d):
    return _tripends(spark, d)


@query(
    "missing_tripend_rejects",
    "SELECT * REPLACE (CAST(NULL AS INT) AS dzone) FROM tripends WHERE dms_dest = 125",
)
def _(spark, d):
    """Without the phantom zones, trips to region 125 have no destination."""
    return tripends.missing_tripends(_tripends(spark, d, phantom=False))


# --- local trips -----------------------------------------------------------


@query(
    "missing_rate_check",
    """
    SELECT DISTINCT sector FROM firms
    WHERE sector NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
    """,
)
def _(spark, d):
    """Rates of the first three sectors only."""
    return generation.missing_rates(given.firms(spark, d), given.rates(spark, 3))


@query("zonal_attractions", "SELECT * FROM attractions_wide")
def _(spark, d):
    return given.attractions_wide(spark, d)


@query("zonal_attractions_by_category", "SELECT * FROM attractions_long")
def _(spark, d):
    return given.attractions_long(spark, d)


@query(
    "urban_scaling",
    """
    SELECT *, CASE WHEN County IN ('Ada', 'Canyon') THEN CAST(0.4 AS DOUBLE)
      ELSE CAST(1 AS DOUBLE) END AS scaling_factor FROM firms
    """,
)
def _(spark, d):
    return generation.urban_scaling(given.firms(spark, d)).withColumn(
        "scaling_factor", F.col("scaling_factor").cast("double")
    )


@query(
    "bucket_round",
    """
    SELECT c_mktsegment, c_custkey, CAST(CASE
        WHEN c_custkey = max(c_custkey) OVER (PARTITION BY c_mktsegment)
        THEN round_even(through - floor(through - amount), 0)
        ELSE floor(through) - floor(through - amount) END AS BIGINT) AS amount
    FROM (SELECT *, sum(amount) OVER (PARTITION BY c_mktsegment ORDER BY c_custkey
        ROWS UNBOUNDED PRECEDING) AS through
      FROM (SELECT c_mktsegment, c_custkey,
        CAST(abs(c_acctbal) AS DECIMAL(18,2)) / 100 * 1 AS unused,
        CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(22,4))
          AS amount
        FROM customer))
    """,
)
def _(spark, d):
    """Hundredths of the balance of customers, within each segment."""
    amounts = given.table(spark, d, "customer").select(
        "c_mktsegment",
        "c_custkey",
        (
            F.abs("c_acctbal").cast("decimal(18,2)") * F.lit("0.01").cast("decimal(3,2)")
        ).alias("amount"),
    )
    return bucket_round(amounts, ["amount"], "c_custkey", ["c_mktsegment"])


@query("generate_trips", "SELECT * FROM local_trips")
def generate(spark, d):
    return generation.generate_trips(given.firms(spark, d), given.rates(spark))


@query(
    "generate_trips_unexpanded",
    "SELECT DISTINCT * REPLACE (CAST(NULL AS INT) AS trip_number) FROM local_trips",
)
def _(spark, d):
    return generation.generate_trips(
        given.firms(spark, d), given.rates(spark), expand=False
    )


@query(
    "generation_summary",
    f"""
    SELECT vehicle_type, count(*) AS firms, CAST(sum(trucks) AS BIGINT) AS trips,
      {sql.rounded("count(*) / (SELECT count(*) FROM customer) * 100", 1)} AS pct_firms
    FROM bucketed WHERE trucks > 0 GROUP BY 1
    """,
)
def _(spark, d):
    return generation.generation_summary(given.firms(spark, d), given.rates(spark))


@query(
    "skim_origin_check",
    """
    SELECT DISTINCT origin FROM (SELECT dms_orig AS origin FROM raw_flows)
    WHERE origin NOT IN (SELECT origin FROM skims)
    """,
)
def _(spark, d):
    """Region codes are no skim zones, but for those that happen to be both."""
    trips = given.raw_flows(spark, d).select(F.col("dms_orig").alias("origin"))
    return local.skimless_origins(trips, given.skims(spark, d))


@query("trip_length_targets_long", "SELECT * FROM targets_long")
def _(spark, d):
    return local.trip_length_targets_long(given.length_targets(spark, d))


@query("banded_skims", "SELECT * FROM reach")
def _(spark, d):
    return local.banded_skims(given.skims(spark, d), given.length_targets(spark, d))


_WITH_DISTANCE = """
    SELECT t.*, k.value AS wgt_dist FROM ({trips}) t
    LEFT JOIN skims k ON k.origin = t.origin AND k.destination = t.destination
"""


@query(
    "sample_local_destinations",
    _WITH_DISTANCE.format(
        trips=sql.destinations("local_origins", "reach", "reach_stretches")
    ),
)
def local_destinations(spark, d):
    return local.sample_local_destinations(
        given.local_origins(spark, d),
        given.skims(spark, d),
        given.length_targets(spark, d),
    )


@query(
    "slot_destinations",
    _WITH_DISTANCE.format(trips=sql.slot_destinations("local_origins")),
)
def _(spark, d):
    """Destinations by tables of slots."""
    return local.sample_local_destinations(
        given.local_origins(spark, d),
        given.skims(spark, d),
        given.length_targets(spark, d),
        route="slots",
    )


@query(
    "interzonal_destinations",
    _WITH_DISTANCE.format(
        trips=sql.destinations("local_origins", "short_reach", "short_stretches")
    ),
)
def _(spark, d):
    """Short trips that must leave their zone."""
    return local.sample_local_destinations(
        given.local_origins(spark, d),
        given.skims(spark, d),
        given.length_targets(spark, d),
        max_distance=40.0,
        allow_intrazonals=False,
    )


@query(
    "append_skim_distance",
    """
    SELECT t.origin, t.destination, t.vehicle_type, t.start_hour, k.value AS wgt_dist
    FROM od_trips t LEFT JOIN skims k ON k.origin = t.origin AND k.destination = t.destination
    """,
)
def _(spark, d):
    return local.append_skim_distance(
        given.flow_od_trips(spark, d), given.skims(spark, d)
    )


# --- time of day, matrices, links ------------------------------------------


@query("temporal_allocation", sql.timed("flow_trips", "flow_id"))
def start_hours(spark, d):
    return daily.temporal_allocation(
        given.flow_trips(spark, d), given.temporal_shares(spark), keys=["flow_id"]
    )


_HOURS = f"(SELECT *, {sql.uniform('hour', 'flow_id')} AS u FROM flow_trips)"


@query(
    "slot_start_hours",
    sql.labelled(f"({sql.picked(_HOURS, 'hour_slots', ['vehicle_type'], 'start_hour')})"),
)
def _(spark, d):
    """Start hours by tables of slots."""
    return daily.temporal_allocation(
        given.flow_trips(spark, d),
        given.temporal_shares(spark),
        keys=["flow_id"],
        route="slots",
    )


@query("period_matrix_labels", "SELECT * FROM labelled_trips")
def _(spark, d):
    return daily.period_matrix_labels(given.flow_od_trips(spark, d))


@query(
    "truck_group_join",
    """
    SELECT *, CASE WHEN vehicle_type IN ('SU', 'TT') THEN 'SUT' ELSE 'MUT' END AS truck_group
    FROM flow_trips
    """,
)
def _(spark, d):
    return matrices.truck_group_join(given.flow_trips(spark, d))


@query(
    "crosstab_counts_margins",
    sql.crosstab(
        """(SELECT vehicle_type, CASE WHEN vehicle_type IN ('SU', 'TT') THEN 'SUT' ELSE 'MUT' END
          AS truck_group FROM flow_trips)""",
        "truck_group",
        "vehicle_type",
        "count(*)",
        "trips",
    ),
)
def _(spark, d):
    return matrices.crosstab_trips_margins(given.flow_trips(spark, d))


@query("od_matrices", sql.matrices("labelled_trips"))
def trip_matrices(spark, d):
    return matrices.od_matrices(
        daily.period_matrix_labels(given.flow_od_trips(spark, d))
    )


@query("link_summary", "SELECT * FROM summary")
def _(spark, d):
    return links.link_summary(given.links(spark, d), "AM")


@query("link_summary_one_way", sql.summary(both=False, two_way=False))
def _(spark, d):
    return links.link_summary(
        given.links(spark, d),
        "AM",
        combine_directions=False,
        count_direction="one-way",
    )


_LINKS_HAVE = ["A", "B", "PCT_TRUCK", "FINALCOUNT", "AT", "MILES", "TYP", "SRC"]


@query(
    "required_columns_check",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS name, true AS present, count("{name}") AS filled FROM links"""
        for name in _LINKS_HAVE
    )
    + "".join(
        f" UNION ALL SELECT '{name}', false, CAST(0 AS BIGINT)"
        for name in ("SUTPM", "MUTPM", "CTIMEPM")
    ),
)
def _(spark, d):
    """Columns the summary of another period needs, and the links that fill them."""
    return links.link_columns_check(given.links(spark, d), "PM")


def _districted(spark: SparkSession, d: str) -> DataFrame:
    return links.link_districts(
        links.link_summary(given.links(spark, d), "AM"),
        given.districts(spark, d),
        "def_seq",
    )


@query("link_districts", "SELECT * FROM districted")
def _(spark, d):
    return _districted(spark, d)


@query(
    "undefined_links", "SELECT DISTINCT linkID FROM districted WHERE DistrictID IS NULL"
)
def _(spark, d):
    return links.undefined_links(_districted(spark, d))


@query(
    "crosstab_links_margins",
    sql.crosstab("districted", "TYP", "DistrictID", "count(*)", "links"),
)
def _(spark, d):
    return links.crosstab_links_margins(_districted(spark, d))


# --- table tools -----------------------------------------------------------

_PROFILED = {
    "flow_id": "string",
    "fr_orig": "int",
    "dms_orig": "int",
    "dms_dest": "int",
    "fr_dest": "int",
    "dms_mode": "int",
    "trade_type": "string",
    "sctg2": "int",
    "wgt_dist": "double",
    "year": "int",
    "exp_tons": "double",
    "exp_value": "double",
    "exp_tmiles": "double",
    "domestic_mode": "string",
    "direction": "string",
}


def _profile_sql(zeros: bool) -> str:
    parts = []
    for name, kind in _PROFILED.items():
        text = f"CAST({{0}}({name}) AS VARCHAR)"
        value = f"CAST({name} AS VARCHAR)"
        if kind == "double":
            whole = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR)"
            whole += " ELSE CAST({0} AS VARCHAR) END"
            lowest, highest = whole.format(f"min({name})"), whole.format(f"max({name})")
            value = whole.format(name)
        else:
            lowest, highest = text.format("min"), text.format("max")
        zero = f", count(*) FILTER ({name} = 0) AS Zeros" if kind != "string" else (
            ", CAST(0 AS BIGINT) AS Zeros"
        )
        parts.append(
            f"""
            SELECT '{name}' AS Variable, '{kind}' AS Class, count(DISTINCT {name}) AS "Unique",
              count(*) FILTER ({name} IS NULL) AS Missing,
              CASE WHEN count(DISTINCT {name}) < 10
                THEN (SELECT coalesce(string_agg({value}, ', ' ORDER BY {name}), '')
                  FROM (SELECT DISTINCT {name} FROM national_flows WHERE {name} IS NOT NULL))
                ELSE {lowest} || ' -- ' || {highest} END AS "Values" {zero if zeros else ""}
            FROM national_flows
            """
        )
    return "\nUNION ALL\n".join(parts)


def _profiled(spark: SparkSession, d: str) -> DataFrame:
    return given.study_flows(spark, d).select(*_PROFILED)


@query("profile_columns", _profile_sql(zeros=False))
def _(spark, d):
    return profile.profile_columns(_profiled(spark, d))


@query("profile_zero_counts", _profile_sql(zeros=True))
def _(spark, d):
    return profile.profile_columns(_profiled(spark, d), zeros=True)


@query(
    "percent",
    f"""
    SELECT o_orderkey, {sql.rounded("amount / total * 100", 3)} AS pct,
      {sql.rounded("amount / group_total * 100", 1)} AS pct_of_priority
    FROM (SELECT o_orderkey, amount, sum(amount) OVER () AS total,
        sum(amount) OVER (PARTITION BY o_orderpriority) AS group_total
      FROM (SELECT *, floor(o_totalprice) AS amount FROM orders))
    """,
)
def _(spark, d):
    orders = given.table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.floor("o_totalprice").cast("double").alias("amount"),
    )
    shares = profile.with_percent_of_total(orders, "amount", "pct", places=3)
    shares = profile.with_percent_of_total(
        shares, "amount", "pct_of_priority", by=["o_orderpriority"]
    )
    return shares.select("o_orderkey", "pct", "pct_of_priority")


@query(
    "file_attributes",
    "SELECT 'lineitem.parquet' AS file_name, count(*) AS records FROM lineitem",
)
def _(spark, d):
    """Files of a table by name; times and sizes are tested apart."""
    named = F.element_at(F.split("file_path", "/"), -1).alias("file_name")
    return file_attributes(given.table(spark, d, "lineitem")).select(named, "records")


def _new_path(spark: SparkSession, ending: str) -> str:
    return f"{shared_folder(spark)}/roundtrip-{uuid.uuid4().hex}{ending}"


@query("read_table", "SELECT * FROM lineitem")
def _(spark, d):
    """Compressed CSV and back."""
    items = given.table(spark, d, "lineitem")
    path = _new_path(spark, ".csv.gz")
    write_table(items, path)
    return read_table(spark, path, schema=items.schema)


@query("write_table", "SELECT * FROM documents")
def _(spark, d):
    """Parquet and back."""
    documents = given.table(spark, d, "documents")
    path = _new_path(spark, ".parquet")
    write_table(documents, path, overwrite=False)
    return read_table(spark, path)


# --- end to end ------------------------------------------------------------

_DAILY_ANNUAL = f"""
    SELECT flow_id, vehicle_type, status, dms_orig, dms_dest, sctg2, truck_seq
    FROM (SELECT *, {_SLOT} AS slot FROM (
      SELECT *, unnest(range(1, CAST(annual_trucks AS BIGINT) + 1)) AS truck_seq FROM annual))
    WHERE slot = 23 * 7 + 3
"""
_KEYS = ("flow_id", "vehicle_type", "status", "truck_seq")
_DAILY_ENDS = f"""(
    SELECT t.*, o.choice AS origin, d.choice AS destination
    FROM (SELECT *, {sql.uniform("ozone", *_KEYS)} AS uo, {sql.uniform("dzone", *_KEYS)} AS ud
      FROM ({_DAILY_ANNUAL})) t
    LEFT JOIN origin_stretches o ON o.sctg2 = t.sctg2 AND o.faf_region = t.dms_orig
      AND t.uo >= o.lo AND t.uo < o.hi
    LEFT JOIN dest_stretches d ON d.sctg2 = t.sctg2 AND d.faf_region = t.dms_dest
      AND t.ud >= d.lo AND t.ud < d.hi)"""


@query("long_distance_matrices", sql.matrices(f"({sql.timed(_DAILY_ENDS, *_KEYS)})"))
def long_distance_matrices(spark, d):
    return long_distance.trip_matrices(
        given.raw_flows(spark, d),
        given.TARGET_YEAR,
        given.factors(spark),
        given.attractions_long(spark, d),
        given.zones(spark, d),
        given.temporal_shares(spark),
        included_attractions=COMBINATION,
        phantom_zones=given.phantom_zones(spark),
        makeuse_coefficients=given.make_use(spark, d),
    )


@query(
    "local_trip_matrices",
    sql.matrices(
        f"""({sql.timed(
            f"({sql.destinations('local_trips', 'reach', 'reach_stretches')})",
            "pfirmID", "vehicle_type", "trip_number")})"""
    ),
)
def local_trip_matrices(spark, d):
    return local_trips.trip_matrices(
        given.firms(spark, d),
        given.rates(spark),
        given.skims(spark, d),
        given.length_targets(spark, d),
        given.temporal_shares(spark),
    )


_DAILY_PLACED = f"""(
    SELECT t.*, CASE WHEN t.dms_orig IN {sql.INTERNAL} THEN o.choice ELSE so.STDM_TAZ END AS origin,
      CASE WHEN t.dms_dest IN {sql.INTERNAL} THEN d.choice ELSE sd.STDM_TAZ END AS destination
    FROM (SELECT *, {sql.uniform("origin", *_KEYS)} AS uo,
        {sql.uniform("destination", *_KEYS)} AS ud FROM ({_DAILY_ANNUAL})) t
    LEFT JOIN single_zones so ON t.dms_orig = so.faf_region
    LEFT JOIN single_zones sd ON t.dms_dest = sd.faf_region
    LEFT JOIN combi_stretches o ON t.uo >= o.lo AND t.uo < o.hi
    LEFT JOIN combi_stretches d ON t.ud >= d.lo AND t.ud < d.hi)"""


@query("allocated_matrices", sql.matrices(f"({sql.timed(_DAILY_PLACED, *_KEYS)})"))
def _(spark, d):
    """The day's trucks by zone, ends inside drawn from all zones."""
    return long_distance.allocated_matrices(
        given.raw_flows(spark, d),
        given.TARGET_YEAR,
        given.factors(spark),
        given.attractions_wide(spark, d),
        given.single_zones(spark, d),
        given.temporal_shares(spark),
        given.INTERNAL_REGIONS,
    )


@query(
    "long_distance_rejects",
    f"""
    SELECT 'truckloads' AS stage, reason, count(*) AS rows FROM (SELECT CASE
        WHEN exp_tons IS NULL THEN 'no tons' WHEN wgt_dist IS NULL THEN 'no distance'
        WHEN minimum_range IS NULL THEN 'distance outside all bands'
        ELSE 'no factors for commodity' END AS reason
      FROM banded WHERE flow_id NOT IN (SELECT flow_id FROM cells)) GROUP BY reason
    UNION ALL SELECT 'trip ends', 'no zone in region', count(*)
      FROM ({_DAILY_ANNUAL}) WHERE dms_dest = 125
    UNION ALL SELECT 'hours', 'no hourly distribution', count(*)
      FROM ({_DAILY_ANNUAL}) WHERE vehicle_type = 'TPT'
    """,
)
def _(spark, d):
    """Without zones of region 125 and hours of the last vehicle type."""
    return long_distance.rejects(
        given.raw_flows(spark, d),
        given.TARGET_YEAR,
        given.factors(spark),
        given.attractions_long(spark, d),
        given.zones(spark, d),
        given.temporal_shares(spark).filter("vehicle_type <> 'TPT'"),
        included_attractions=COMBINATION,
        makeuse_coefficients=given.make_use(spark, d),
    )


_UNUSED_FLOWS = """
    SELECT 'truckloads' AS stage, reason, count(*) AS rows FROM (SELECT CASE
        WHEN exp_tons IS NULL THEN 'no tons' WHEN wgt_dist IS NULL THEN 'no distance'
        WHEN minimum_range IS NULL THEN 'distance outside all bands'
        ELSE 'no factors for commodity' END AS reason
      FROM banded WHERE flow_id NOT IN (SELECT flow_id FROM cells)) GROUP BY reason
"""
_UNTIMED = f"""
    SELECT 'hours', 'no hourly distribution', count(*)
      FROM ({_DAILY_ANNUAL}) WHERE vehicle_type = 'TPT'
"""


def _watched(spark: SparkSession, matrices, *tables, **options) -> DataFrame:
    """What one run of a plan left out, counted while its matrices were written."""
    watch = Watch()
    stored_once(matrices(*tables, **options, watch=watch), "matrices")
    return watch.frame(spark, optional=("truckloads",))


@query(
    "long_distance_watched",
    f"""
    {_UNUSED_FLOWS} UNION ALL SELECT 'trip ends', 'no zone in region', count(*)
      FROM ({_DAILY_ANNUAL}) WHERE dms_dest = 125 UNION ALL {_UNTIMED}
    """,
)
def _(spark, d):
    return _watched(
        spark,
        long_distance.trip_matrices,
        given.raw_flows(spark, d),
        given.TARGET_YEAR,
        given.factors(spark),
        given.attractions_long(spark, d),
        given.zones(spark, d),
        given.temporal_shares(spark).filter("vehicle_type <> 'TPT'"),
        included_attractions=COMBINATION,
        makeuse_coefficients=given.make_use(spark, d),
    )


@query(
    "allocated_watched",
    f"""
    {_UNUSED_FLOWS} UNION ALL SELECT 'allocation', 'no zone for region', count(*)
      FROM {_DAILY_PLACED} WHERE origin IS NULL OR destination IS NULL UNION ALL {_UNTIMED}
    """,
)
def _(spark, d):
    return _watched(
        spark,
        long_distance.allocated_matrices,
        given.raw_flows(spark, d),
        given.TARGET_YEAR,
        given.factors(spark),
        given.attractions_wide(spark, d),
        given.single_zones(spark, d),
        given.temporal_shares(spark).filter("vehicle_type <> 'TPT'"),
        given.INTERNAL_REGIONS,
    )


@query(
    "local_rejects",
    f"""
    SELECT 'generation' AS stage, 'firm without an id' AS reason,
      count(*) FILTER (pfirmID IS NULL) AS rows FROM firms
    UNION ALL SELECT 'generation', 'no rates for sector',
      count(*) FILTER (sector NOT IN (SELECT sector FROM rates)) FROM firms
    UNION ALL SELECT 'destinations', 'no share within reach', count(*)
      FROM ({sql.destinations('local_trips', 'reach', 'reach_stretches')})
      WHERE destination IS NULL
    UNION ALL SELECT 'hours', 'no hourly distribution', count(*)
      FROM local_trips WHERE vehicle_type = 'TPT'
    """,
)
def _(spark, d):
    return local_trips.rejects(
        given.firms(spark, d),
        given.rates(spark),
        given.skims(spark, d),
        given.length_targets(spark, d),
        given.temporal_shares(spark).filter("vehicle_type <> 'TPT'"),
    )
