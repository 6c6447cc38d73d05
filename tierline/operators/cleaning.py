"""Row-wise cleaning and one-pass column profiles. Nothing here shuffles rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.columns import date_parts, map_codes, normal_name, quoted, whole_number


def normalise_names(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Replace spaces in every column name, then apply ``renames``; two equal results are an error."""
    renames = renames or {}
    names = [renames.get(normal_name(n), normal_name(n)) for n in df.columns]
    seen = [n.lower() for n in names]
    clashes = sorted({n for n in names if seen.count(n.lower()) > 1})
    if clashes:
        raise ValueError(f"column names clash after normalising: {clashes}")
    return df.toDF(*names)


def cast_whole_number(df: DataFrame, name: str) -> DataFrame:
    """Cast one column to int in place."""
    return df.withColumn(name, whole_number(quoted(name), df.schema[name].dataType))


def replace_codes(df: DataFrame, name: str, codes: Mapping[int, str]) -> DataFrame:
    """Replace the codes in one column by their names."""
    return df.withColumn(name, map_codes(codes, quoted(name)))


def keep_positive(df: DataFrame, name: str) -> DataFrame:
    """Count nulls as zero and keep the rows above zero.

    The plain comparison comes first so that it reaches the scan; it already drops nulls.
    """
    positive = quoted(name) > 0
    return df.filter(positive).na.fill(0, subset=[name]).filter(positive)


def date_parts_first(df: DataFrame, time_column: str) -> DataFrame:
    """``year`` and ``month`` placed before all other columns."""
    return df.select(*date_parts(quoted(time_column), df.schema[time_column].dataType), "*")


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema. The plan folds to an empty relation, so nothing is read."""
    return df.filter(F.lit(2) == F.lit(1))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, nulls, smallest, largest and about how many distinct values.

    One aggregate over the data; only the one-row result is unfolded.
    """
    simple = [f for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(simple):
        column = quoted(field.name)
        measures += [
            F.count_if(column.isNull()).alias(f"nulls_{i}"),
            F.min(column).cast("string").alias(f"min_{i}"),
            F.max(column).cast("string").alias(f"max_{i}"),
            F.approx_count_distinct(column).alias(f"distinct_{i}"),
        ]
    per_column = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"nulls_{i}").alias("null_count"),
                F.col(f"min_{i}").alias("min_value"),
                F.col(f"max_{i}").alias("max_value"),
                F.col(f"distinct_{i}").alias("distinct_estimate"),
            )
            for i, field in enumerate(simple)
        ]
    )
    return df.agg(*measures).select(F.inline(per_column))
