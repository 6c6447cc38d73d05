"""Aggregates of the gold tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import date_parts, quoted


def monthly_rollup(
    df: DataFrame, time_column: str, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Sum of each measure per year, month and key.

    Grouped by the date expressions, never by the names ``year``/``month``: the input may
    already have columns of those names. One exchange, after map-side aggregation.
    """
    parts = date_parts(quoted(time_column), df.schema[time_column].dataType)
    sums = [F.sum(quoted(m)).alias(m) for m in measures]
    slim = df.select(
        parts[0].alias("__year"),
        parts[1].alias("__month"),
        *[quoted(k).alias(k) for k in keys],
        *[quoted(m).alias(m) for m in measures],
    )
    return (
        slim.groupBy("__year", "__month", *[quoted(k) for k in keys])
        .agg(*sums)
        .withColumnsRenamed({"__year": "year", "__month": "month"})
    )


#: Names of a group, of its number of rows, and of the number of values of each measure.
GROUP, ROWS, VALUES = "__group", "__rows", "__values_{}"


def signed_rollup(
    changes: DataFrame, time_column: str, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """What changed rows (``change``, ``copies``, columns) add to the sums of ``monthly_rollup``: per year,
    month and key the sums of what came less what went, with the numbers of rows and of values.

    ``__group`` is the group as text, null like any other value of a key.
    """
    parts = date_parts(quoted(time_column), changes.schema[time_column].dataType)
    sign = F.when(F.col("change") == "insert", F.col("copies")).otherwise(-F.col("copies"))
    slim = changes.select(
        parts[0].alias("__year"),
        parts[1].alias("__month"),
        *[quoted(k).alias(k) for k in keys],
        *[quoted(m).alias(m) for m in measures],
        sign.alias("__sign"),
    )
    sums = []
    for m in measures:
        kind = changes.select(F.sum(quoted(m)).alias("s")).schema["s"].dataType
        sums += [
            F.sum(quoted(m) * F.col("__sign")).cast(kind).alias(m),
            F.sum(F.when(quoted(m).isNotNull(), F.col("__sign")).otherwise(0)).alias(VALUES.format(m)),
        ]
    names = ["year", "month", *keys]
    summed = (
        slim.groupBy("__year", "__month", *[quoted(k) for k in keys])
        .agg(*sums, F.sum("__sign").alias(ROWS))
        .withColumnsRenamed({"__year": "year", "__month": "month"})
    )
    return summed.withColumn(GROUP, F.to_json(F.struct(*[quoted(n) for n in names]), {"ignoreNullFields": "false"}))


def added_up(sums: DataFrame, more: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The groups of ``more`` (``signed_rollup``) with what ``sums`` has for them added."""
    numbers = [*measures, *[VALUES.format(m) for m in measures], ROWS]
    old = sums.select(F.col(GROUP).alias("__old"), *[quoted(c).alias(f"__old_{c}") for c in numbers])
    joined = more.join(old, F.col(GROUP) == F.col("__old"), "left")

    def total(name: str) -> Column:
        return F.coalesce(quoted(name), F.lit(0)) + F.coalesce(quoted(f"__old_{name}"), F.lit(0))

    def value(name: str) -> Column:
        if name not in measures:
            return total(name)
        return F.when(total(VALUES.format(name)) > 0, total(name))

    return joined.select(
        *[
            value(c).cast(more.schema[c].dataType).alias(c) if c in numbers else quoted(c)
            for c in more.columns
        ]
    )


def row_count(df: DataFrame, name: str = "record_count") -> DataFrame:
    """Number of rows; works on batch and streaming frames."""
    return df.selectExpr(f"COUNT(*) AS {name}")
