"""Column profiles as sketches that are merged, not recomputed.

A sketch of a column is a few kilobytes whatever the number of rows; the sketch of a union is the
union of the sketches. So the profile of a table is put together from those of its parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.columns import quoted

#: Distinct counts: 2**14 registers, a standard error of 0.8 %.
REGISTERS = 14
#: Quantiles: with this many items a value's place is off by 0.7 % of the rows at most, 99 times in 100.
ITEMS = 512
#: Frequent values: so many are followed, and one that is more than one in a quarter of that many is found.
FOLLOWED, FREQUENT = 4096, 5
SKETCH = (
    "column string, rows bigint, nulls bigint, distinct binary, places binary, "
    "often struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"
)


def _atomic(schema: T.StructType) -> list[T.StructField]:
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType, T.BinaryType)
    return [f for f in schema.fields if not isinstance(f.dataType, nested)]


def as_number(column: Column, data_type: T.DataType) -> Column | None:
    """What quantiles are taken of: numbers, and moments as seconds; null for other types."""
    if isinstance(data_type, T.NumericType):
        return column.cast("double")
    if isinstance(data_type, T.DateType):
        return (F.unix_date(column) * 86400).cast("double")
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_micros(F.from_utc_timestamp(column.cast("timestamp"), F.current_timezone())) / 1e6
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column) / 1e6
    return None


def sketched(df: DataFrame) -> DataFrame:
    """One row per column that is no object, list or map: SKETCH. One pass, folded in the map stage."""
    aggregates, rows = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(_atomic(df.schema)):
        c = quoted(f.name)
        number = as_number(c, f.dataType)
        places = F.kll_sketch_agg_double(number, F.lit(ITEMS)) if number is not None else F.lit(None).cast("binary")
        aggregates += [
            F.count(c).alias(f"set{i}"),
            F.hll_sketch_agg(c.cast("string"), F.lit(REGISTERS)).alias(f"distinct{i}"),
            places.alias(f"places{i}"),
            F.expr(f"approx_top_k_accumulate(CAST(`{f.name.replace('`', '``')}` AS STRING), {FOLLOWED})").alias(f"often{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.col("n").alias("rows"),
                (F.col("n") - F.col(f"set{i}")).alias("nulls"),
                *[F.col(f"{name}{i}").alias(name) for name in ("distinct", "places", "often")],
            )
        )
    if not rows:
        return df.sparkSession.createDataFrame([], SKETCH)
    found = df.agg(*aggregates).select(F.inline(F.array(*rows)))
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(SKETCH).fields])


def merged(parts: DataFrame) -> DataFrame:
    """SKETCH of the union of what ``parts`` has sketches of."""
    return parts.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("places").alias("places"),
        F.bool_or(F.col("places").isNotNull()).alias("has_places"),
        F.expr("approx_top_k_combine(often)").alias("often"),
    )


def estimates(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column, rows, nulls, distinct, quantiles, frequent`` of merged sketches.

    ``distinct`` has a standard error of 0.8 %; each of ``quantiles`` (of numbers, and of moments in
    seconds; null for other columns) stands at most 0.7 % of the rows from its place, 99 times in 100;
    ``frequent`` has the commonest values as text, with counts that are exact while a column has no
    more than FOLLOWED * 3 / 4 values.
    """
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    some = F.col("rows") > F.col("nulls")
    return sketches.select(
        "column",
        "rows",
        "nulls",
        F.hll_sketch_estimate("distinct").alias("distinct"),
        F.when(some & F.col("has_places"), F.kll_sketch_get_quantile_double("places", wanted)).alias("quantiles"),
        F.when(some, F.expr(f"approx_top_k_estimate(often, {FREQUENT})")).alias("frequent"),
    )


def profile(df: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``estimates`` of a frame, one row per column that is no object, list or map."""
    return estimates(merged(sketched(df)), quantiles)
