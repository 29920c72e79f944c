"""Model inputs shaped from the driver tables.

Large inputs (flows, trips, firms, skims, links) come from the tables. Small
parameter tables (factors, rates, shares) follow from formulas.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.operators.daily import expand_trucks
from freightlake.operators.flows import prepare_flows
from freightlake.operators.generation import zonal_attractions
from freightlake.operators.truckloads import (
    BODY_TYPES,
    VEHICLE_TYPES,
    TruckFactors,
)

TARGET_YEAR = 2014
INTERNAL_REGIONS = [101, 103, 107, 113, 118]
# Edges grow with the square of the band's number; nothing covers 481 to 500,
# and the last band is open.
OPEN_END = 2147483647
BANDS = [
    (40 * j * (j + 1) + (j > 0) + 20 * (j == 3), 40 * (j + 1) * (j + 2) if j < 4 else OPEN_END)
    for j in range(5)
]
SECTORS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
RATES = [
    (sector, *[((i * 7 + k * 3) % 11) / 16 for k in range(1, len(VEHICLE_TYPES) + 1)])
    for i, sector in enumerate(SECTORS, 1)
]
OUTER_PAIRS = [(101, 107, 11, 12), (104, 120, 13, 14), (107, 101, 12, 11)]


def parameters(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table handed to Spark as Arrow data, which it keeps as a local
    relation of known size."""
    fields = [field.split() for field in schema.split(",")]
    columns = {name: list(column) for (name, _), column in zip(fields, zip(*rows))}
    kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    arrow = pa.table(
        {name: pa.array(columns[name], kinds[kind]) for name, kind in fields}
    )
    return spark.createDataFrame(arrow)


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the files only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flow per line item; region 125 has no nation, 44 and 45 no factors."""
    item = table(spark, sf_dir, "lineitem")
    supplier, part = F.col("l_suppkey"), F.col("l_partkey")
    foreign = (801 + supplier % 8).cast("int")
    no_flow = part % 50 == 0
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return item.select(
        flow_id().alias("flow_id"),
        F.when(supplier % 3 == 1, foreign).alias("fr_orig"),
        (100 + supplier % 25).cast("int").alias("dms_orig"),
        (100 + F.col("l_orderkey") % 26).cast("int").alias("dms_dest"),
        F.when(supplier % 3 == 2, foreign).alias("fr_dest"),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % 8 + 1)
        .cast("int")
        .alias("dms_mode"),
        (supplier % 3 + 1).cast("int").alias("trade_type"),
        (part % 45 + 1).cast("int").alias("sctg2"),
        F.when(
            part % 97 != 0, ((part * 37 + supplier * 11) % 2400).cast("double") / 2
        ).alias("wgt_dist"),
        F.when(no_flow, 0.0).otherwise(quantity / 100).alias("tons_2012"),
        F.when(no_flow, 0.0).otherwise(quantity / 80).alias("tons_2015"),
        F.when(no_flow, 0.0).otherwise(price / 1000000).alias("value_2012"),
        F.when(no_flow, 0.0).otherwise(price / 800000).alias("value_2015"),
        (quantity / 1000).alias("tmiles_2012"),
        (quantity / 900).alias("tmiles_2015"),
    )


def flow_id() -> Column:
    return F.concat_ws(
        "|",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("int"),
    )


def text_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows whose codes arrive as text, some with decimals, some unusable."""
    flows = raw_flows(spark, sf_dir)
    sctg2, mode = F.col("sctg2"), F.col("dms_mode")
    return flows.withColumns(
        {
            "sctg2": F.when(sctg2 % 7 == 0, "n/a").otherwise(
                F.concat(sctg2.cast("string"), F.lit(".6"))
            ),
            "dms_mode": mode.cast("string"),
        }
    )


def outer_pairs(spark: SparkSession) -> DataFrame:
    return parameters(
        spark, OUTER_PAIRS, "dms_orig int, dms_dest int, entry int, exit int"
    )


def study_flows(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return prepare_flows(raw_flows(spark, sf_dir), TARGET_YEAR, **options)


def allocation_factors(spark: SparkSession) -> DataFrame:
    rows = [
        (low, high, vehicle, ((k * 13 + low) % 17 + 1) / 50)
        for low, high in BANDS
        for k, vehicle in enumerate(VEHICLE_TYPES, 1)
    ]
    return parameters(
        spark,
        rows,
        "minimum_range int, maximum_range int, vehicle_type string,"
        " allocation_factor double",
    )


def equivalency_factors(spark: SparkSession) -> DataFrame:
    rows = [
        (
            vehicle,
            sctg2,
            *[((k * 3 + sctg2 * 7 + j * 5) % 11) / 1000 for j in range(1, 10)],
        )
        for k, vehicle in enumerate(VEHICLE_TYPES, 1)
        for sctg2 in range(1, 44)
    ]
    bodies = ", ".join(f"{body} double" for body in BODY_TYPES)
    return parameters(spark, rows, f"vehicle_type string, sctg2 int, {bodies}")


def empty_factors(spark: SparkSession) -> DataFrame:
    rows = [
        (crossing, body, *[((k + j) % 6 * m) / 20 for k in range(1, 6)])
        for crossing, m in (("domestic", 1), ("border", 2))
        for j, body in enumerate(BODY_TYPES, 1)
    ]
    vehicles = ", ".join(f"{v} double" for v in VEHICLE_TYPES)
    return parameters(
        spark, rows, f"crossing_type string, body_type string, {vehicles}"
    )


def factors(spark: SparkSession) -> TruckFactors:
    return TruckFactors(
        allocation_factors(spark), equivalency_factors(spark), empty_factors(spark)
    )


def vehicle_of(code: Column) -> Column:
    vehicle = F.lit(VEHICLE_TYPES[0])
    for k, name in enumerate(VEHICLE_TYPES[1:], 1):
        vehicle = F.when(code % len(VEHICLE_TYPES) == k, name).otherwise(vehicle)
    return vehicle


def flow_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flow taken as one truck trip; its vehicle follows the line."""
    return table(spark, sf_dir, "lineitem").select(
        flow_id().alias("flow_id"),
        (100 + F.col("l_suppkey") % 25).cast("int").alias("dms_orig"),
        (100 + F.col("l_orderkey") % 26).cast("int").alias("dms_dest"),
        (F.col("l_partkey") % 45 + 1).cast("int").alias("sctg2"),
        vehicle_of(F.col("l_linenumber")).alias("vehicle_type"),
    )


def firms(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    county = (
        F.when(nation % 5 == 0, "Ada").when(nation % 5 == 1, "Canyon").otherwise("Other")
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pfirmID"),
        F.col("c_mktsegment").alias("sector"),
        (F.floor(F.abs("c_acctbal")) % 200 + 1).cast("int").alias("size"),
        (nation * 4 + F.col("c_custkey") % 4).cast("int").alias("STDM_TAZ"),
        county.alias("County"),
    )


def rates(spark: SparkSession, sectors: int = len(SECTORS)) -> DataFrame:
    """Trip rates of the first few sectors."""
    vehicles = ", ".join(f"{v} double" for v in VEHICLE_TYPES)
    return parameters(spark, RATES[:sectors], f"sector string, {vehicles}")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four zones to a region, or one only in every third."""
    nation = F.col("n_nationkey")
    last = F.when(nation % 3 == 0, 0).otherwise(3)
    return (
        table(spark, sf_dir, "nation")
        .select(nation, F.explode(F.sequence(F.lit(0), last)).alias("k"))
        .select(
            (nation * 4 + F.col("k")).alias("STDM_TAZ"),
            (nation + 100).alias("faf_region"),
            F.when(nation % 6 != 0, nation % 6).alias("ITD_district"),
        )
    )


def phantom_zones(spark: SparkSession) -> DataFrame:
    return parameters(
        spark,
        [(6, 125, 9), (9, 125, 9)],
        "STDM_TAZ int, faf_region int, ITD_district int",
    )


def single_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first zone of each region."""
    return (
        zones(spark, sf_dir)
        .groupBy("faf_region")
        .agg(F.min("STDM_TAZ").alias("STDM_TAZ"))
    )


def attractions_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal_attractions(firms(spark, sf_dir), rates(spark))


def attractions_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal_attractions(
        firms(spark, sf_dir), rates(spark), output="long", by_category=True
    )


def make_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients by sector for the commodities of parts.

    Commodities 41 to 45 have none; those of every fifth are all zero.
    """
    sctg2 = F.col("sctg2")
    sectors = F.array(*[F.lit(row[0]) for row in RATES])
    use = F.when(F.col("MorU") == "U", 1).otherwise(0)
    tenths = (sctg2 * 7 + F.length("Category") * 3 + use) % 10
    return (
        table(spark, sf_dir, "part")
        .select((F.col("p_partkey") % 40 + 1).cast("int").alias("sctg2"))
        .distinct()
        .select(sctg2, F.explode(sectors).alias("Category"))
        .select("*", F.explode(F.array(F.lit("M"), F.lit("U"))).alias("MorU"))
        .withColumn(
            "coefficient",
            F.when(sctg2 % 5 == 0, 0.0).otherwise(tenths.cast("double") / 10),
        )
    )


def skims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the zone pairs that occur in orders."""
    pairs = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            (F.col("c_nationkey") * 4 + F.col("c_custkey") % 4).cast("int").alias("origin"),
            (F.col("o_orderkey") % 100).cast("int").alias("destination"),
        )
        .distinct()
    )
    apart = F.abs(F.col("origin") - F.col("destination"))
    return pairs.withColumn("value", (apart * 17 + 6).cast("double") / 10)


def length_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares by distance over the sizes of parts; SU has none beyond 110."""
    distance = F.col("distance")
    return (
        table(spark, sf_dir, "part")
        .select((F.col("p_partkey") % 121).cast("int").alias("distance"))
        .distinct()
        .select(
            distance,
            F.when(distance <= 110, (200 - distance).cast("double")).alias("SU"),
            (150 - distance).cast("double").alias("TT"),
            (distance + 10).cast("double").alias("CS"),
            (distance % 20 + 1).cast("double").alias("DBL"),
            F.lit(1.0).alias("TPT"),
        )
    )


def local_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order taken as a local trip from the zone of its customer."""
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return order.join(
        firms(spark, sf_dir), F.col("o_custkey") == F.col("pfirmID")
    ).select(
        F.col("pfirmID"),
        F.col("o_orderkey").alias("trip_number"),
        vehicle_of(F.col("o_orderkey")).alias("vehicle_type"),
        F.col("STDM_TAZ").alias("origin"),
    )


def temporal_shares(spark: SparkSession) -> DataFrame:
    rows = [
        (vehicle, hour, ((hour * k) % 24 + (20 if 7 <= hour <= 17 else 1)) / 100)
        for k, vehicle in enumerate(VEHICLE_TYPES, 1)
        for hour in range(24)
    ]
    return parameters(spark, rows, "vehicle_type string, hour int, share double")


def calendar(spark: SparkSession) -> DataFrame:
    rows = [
        (week, day, float(calendar_share(week, day)))
        for week in range(1, 53)
        for day in range(1, 8)
    ]
    return parameters(spark, rows, "week int, day int, share double")


def flow_od_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flow as a trip with zones and a start hour, taken from its keys."""
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        (F.col("l_suppkey") % 100).cast("int").alias("origin"),
        (F.col("l_partkey") % 100).cast("int").alias("destination"),
        vehicle_of(F.col("l_linenumber")).alias("vehicle_type"),
        F.when(F.col("l_orderkey") % 31 != 0, (F.col("l_orderkey") % 24))
        .cast("int")
        .alias("start_hour"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.floor("o_totalprice")
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    kind = (
        F.when(order % 7 == 0, "Centroid")
        .when(order % 7 == 1, "Ramp")
        .when(order % 7 == 3, "Interstate")
        .when(order % 7 != 2, "Arterial")
    )
    return table(spark, sf_dir, "orders").select(
        (order % 300).cast("int").alias("A"),
        (customer % 300).cast("int").alias("B"),
        ((price % 60).cast("double") / 100).alias("PCT_TRUCK"),
        (price % 5000).cast("double").alias("FINALCOUNT"),
        (order % 4 + 1).cast("int").alias("AT"),
        ((customer % 90).cast("double") / 10).alias("MILES"),
        kind.alias("TYP"),
        F.col("o_orderpriority").alias("SRC"),
        (customer % 70).cast("double").alias("SUTAM"),
        (order % 50).cast("double").alias("MUTAM"),
        ((customer % 40).cast("double") / 4).alias("CTIMEAM"),
    )


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District definitions; nodes differ from those of links in part, so some
    links lack one."""
    order = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        order.alias("def_seq"),
        (order % 300).cast("int").alias("A"),
        (F.col("o_custkey") % 290).cast("int").alias("B"),
        F.when(order % 9 != 0, (order % 6 + 1).cast("int")).alias("DistrictID"),
    )


def annual_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items taken as annual truckloads; the first of an order has none."""
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        flow_id().alias("flow_id"),
        vehicle_of(F.col("l_linenumber")).alias("vehicle_type"),
        F.when(F.col("l_returnflag") == "N", "Loaded").otherwise("Empty").alias("status"),
        (F.col("l_linenumber") - 1).cast("double").alias("annual_trucks"),
        (F.col("l_quantity") * 20).alias("tons"),
        F.col("l_extendedprice").alias("value"),
    )


def heavy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with a hundred times the trucks."""
    return annual_lines(spark, sf_dir).withColumn(
        "annual_trucks", F.col("annual_trucks") * 100
    )


def calendar_share(week: int, day: int) -> float:
    return (week * 3 + day * 5) % 11


def single_trucks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_trucks(annual_lines(spark, sf_dir))
