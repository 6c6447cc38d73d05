"""Column expressions used by the cleaning steps. All of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column by its exact name, also when it holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_set(names: Iterable[str]) -> Column:
    """True where none of the columns is null."""
    return reduce(lambda a, b: a & b, [quoted(n).isNotNull() for n in names])


def same_key(names: Iterable[str], folded: Iterable[str]) -> Column:
    """Join condition between a side with repeated keys and a side folded to one row per key.

    The folded side is already partitioned by its key, so Spark would join it in place, and
    adaptive execution splits a hot key only between two plain shuffles. ``greatest(k, k)`` is
    ``k``, but not a column the folded side is partitioned by: its keys (one row each) are
    shuffled once more, and a hot key on the other side can be split.
    """
    pairs = [quoted(n) == F.greatest(quoted(f), quoted(f)) for n, f in zip(names, folded)]
    return reduce(lambda a, b: a & b, pairs)


def map_codes(codes: Mapping[int, str], column: Column) -> Column:
    """Name for each code; unknown and null codes give null."""
    entries = [F.lit(item) for pair in codes.items() for item in pair]
    return F.create_map(*entries)[column]


def whole_number(column: Column, data_type: T.DataType) -> Column:
    """Cast to int; unreadable or too large values give null, fractions are cut off."""
    if not isinstance(data_type, T.StringType):
        return column.try_cast("int")
    text = F.trim(column)
    is_number = text.rlike(r"^[+-]?[0-9]+([.][0-9]*)?$")
    return F.when(is_number, F.split_part(text, F.lit("."), F.lit(1)).try_cast("int"))


def to_event_time(column: Column, data_type: T.DataType) -> Column:
    """Timestamp of a column that may have been read as text; unreadable text gives null."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column
    return column.try_cast("timestamp")


def date_parts(column: Column, data_type: T.DataType) -> list[Column]:
    """``year`` and ``month`` of an event-time column."""
    moment = to_event_time(column, data_type)
    return [F.year(moment).alias("year"), F.month(moment).alias("month")]


def normal_name(name: str) -> str:
    """Column name with spaces replaced."""
    return name.replace(" ", "_")
