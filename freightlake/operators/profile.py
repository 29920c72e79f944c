"""Column profiles and percentages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.functions import half_even, sum_or_null
from freightlake.functions.columns import as_column
from freightlake.operators.sizing import MAX_BROADCAST_ROWS, broadcast_if_small


def percent(x: Column | str, y: Column | str, places: int = 1) -> Column:
    """``x`` as a percentage of ``y``; NULL where ``y`` is zero."""
    share = F.try_divide(as_column(x).cast("double"), as_column(y).cast("double"))
    return half_even(share * 100, places)


def with_percent_of_total(
    df: DataFrame,
    x: str,
    name: str,
    by: Sequence[str] = (),
    places: int = 1,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``x`` as a percentage of its total, overall or within groups.

    Totals are added up per task before they meet, and joined back: a window
    would move the whole table, or the whole of a large group, to one task.
    """
    if not by:
        total = df.agg(sum_or_null(x)).scalar()
        return df.withColumn(name, percent(F.col(x), total, places))
    totals = df.groupBy(*by).agg(sum_or_null(x).alias("_total"))
    same = None
    for key in by:
        test = F.col(f"rows.{key}").eqNullSafe(F.col(f"totals.{key}"))
        same = test if same is None else same & test
    small = broadcast_if_small(totals, max_broadcast_rows)
    return (
        df.alias("rows")
        .join(small.alias("totals"), same, "left")
        .select("rows.*", percent(F.col(f"rows.{x}"), F.col("_total"), places).alias(name))
    )


_NUMERIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _as_text(value: Column, data_type: T.DataType) -> Column:
    if not isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value.cast("string")
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(
        value.cast("string")
    )


def _value_counts(df: DataFrame) -> tuple[DataFrame, dict[str, T.DataType]]:
    """``Variable``, its value and ``n``; values of one type share a column.

    A value keeps its own type, so distinct values, least and largest one follow
    it; nested values count by their text. The table is read once and there is
    one shuffle for all columns.
    """
    kinds: dict[T.DataType, str] = {}
    chosen: list[tuple[str, str, Column]] = []
    for field in df.schema.fields:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, _NESTED):
            value, kind = value.cast("string"), T.StringType()
        slot = kinds.setdefault(kind, f"_{len(kinds)}")
        chosen.append((field.name, slot, value))
    slots = {slot: kind for kind, slot in kinds.items()}
    rows = [
        F.struct(
            F.lit(name).alias("Variable"),
            *[
                (value if own == slot else F.lit(None).cast(kind)).alias(slot)
                for slot, kind in slots.items()
            ],
        )
        for name, own, value in chosen
    ]
    long = df.select(F.explode(F.array(*rows)).alias("cell")).select("cell.*")
    counted = long.groupBy("Variable", *slots).agg(F.count(F.lit(1)).alias("n"))
    return counted, slots


def _profile(df: DataFrame, threshold: int) -> DataFrame:
    values, slots = _value_counts(df)
    present = F.lit(False)
    for slot in slots:
        present = present | F.col(slot).isNotNull()
    numeric = [s for s, kind in slots.items() if isinstance(kind, _NUMERIC)]
    zero = F.lit(False)
    for slot in numeric:
        zero = zero | F.coalesce(F.col(slot) == 0, F.lit(False))

    def text_of(pick) -> Column:
        return F.coalesce(*[_as_text(pick(F.col(s)), kind) for s, kind in slots.items()])

    summary = values.groupBy("Variable").agg(
        F.count_if(present).alias("Unique"),
        F.sum(F.when(present, 0).otherwise(F.col("n"))).alias("Missing"),
        F.sum(F.when(zero, F.col("n")).otherwise(0)).alias("Zeros"),
        text_of(F.min).alias("_lowest"),
        text_of(F.max).alias("_highest"),
    )
    # Only columns under the threshold have their values listed, so no list
    # holds more than `threshold` entries. One row per column: broadcast. Every
    # column of `values` is used again, so its shuffle is made only once.
    few = F.broadcast(summary.filter(F.col("Unique") < threshold).select("Variable"))
    value = F.when((F.col("n") > 0) & present, F.struct(*slots))
    listed = (
        values.join(few, "Variable")
        .groupBy("Variable")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(value)),
                    lambda v: F.coalesce(
                        *[_as_text(v[s], kind) for s, kind in slots.items()]
                    ),
                ),
                ", ",
            ).alias("_listed")
        )
    )
    return summary.join(F.broadcast(listed), "Variable", "left")


def profile_columns(
    df: DataFrame, threshold: int = 10, zeros: bool = False
) -> DataFrame:
    """One row per column: type, distinct values, missing values, value range.

    Fewer than ``threshold`` distinct values are listed in order, otherwise the
    lowest and the highest are given.
    """
    spark = df.sparkSession
    fields = df.schema.fields
    profiled = _profile(df, threshold)
    classes = spark.createDataFrame(
        [(field.name, field.dataType.simpleString()) for field in fields],
        "Variable string, Class string",
    )
    spread = F.concat_ws(" -- ", "_lowest", "_highest")
    text = F.when(F.col("Unique") < threshold, F.coalesce("_listed", F.lit("")))
    columns = [
        F.col("Variable"),
        F.col("Class"),
        F.coalesce("Unique", F.lit(0)).alias("Unique"),
        F.coalesce("Missing", F.lit(0)).alias("Missing"),
        F.coalesce(text.otherwise(spread), F.lit("")).alias("Values"),
    ]
    if zeros:
        columns.append(F.coalesce("Zeros", F.lit(0)).alias("Zeros"))
    return classes.join(profiled, "Variable", "left").select(*columns)
