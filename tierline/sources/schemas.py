"""Schema rules: what a write may contain, how a table grows, and a schema kept at a location."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.columns import quoted
from tierline.sources import storage


class SchemaMismatch(ValueError):
    """A write was blocked because it does not fit the table."""


# Casts that cannot lose a value, narrower type to wider types.
WIDENINGS = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"},
    "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
}


def fits(given: T.DataType, wanted: T.DataType) -> bool:
    """True when every value of ``given`` can be stored as ``wanted``."""
    if isinstance(given, T.NullType):
        return True
    have, want = given.simpleString(), wanted.simpleString()
    return have == want or want in WIDENINGS.get(have, set())


def widened(known: T.DataType, given: T.DataType) -> T.DataType:
    """``known`` with the fields that only ``given`` has, in objects at any depth of objects, lists and maps.

    Where the two are of different kinds ``known`` stays as it is.
    """
    if isinstance(known, T.StructType) and isinstance(given, T.StructType):
        others = {f.name.lower(): f for f in given.fields}
        fields = [
            T.StructField(f.name, widened(f.dataType, others[f.name.lower()].dataType), f.nullable, f.metadata)
            if f.name.lower() in others
            else f
            for f in known.fields
        ]
        names = {f.name.lower() for f in known.fields}
        return T.StructType([*fields, *[f for f in nullable(given).fields if f.name.lower() not in names]])
    if isinstance(known, T.ArrayType) and isinstance(given, T.ArrayType):
        return T.ArrayType(widened(known.elementType, given.elementType), known.containsNull)
    if isinstance(known, T.MapType) and isinstance(given, T.MapType):
        return T.MapType(known.keyType, widened(known.valueType, given.valueType), known.valueContainsNull)
    return known


def grew(before: T.StructType, after: T.StructType) -> bool:
    """Whether a column both have differs by fields of its objects only, as when one was widened."""
    later = {f.name: f.dataType for f in after.fields}
    pairs = [(f.dataType, later[f.name]) for f in before.fields if f.name in later]
    pairs = [(a, b) for a, b in pairs if a.simpleString() != b.simpleString()]

    both = [(widened(a, b), widened(b, a)) for a, b in pairs]
    return bool(both) and all(_leaves(a) == _leaves(b) for a, b in both)


def _leaves(data_type: T.DataType, at: str = "") -> set[tuple[str, str]]:
    """Place and type of everything in a type that is no object, list or map."""
    if isinstance(data_type, T.StructType):
        return {x for f in data_type.fields for x in _leaves(f.dataType, f"{at}.{f.name.lower()}")}
    if isinstance(data_type, T.ArrayType):
        return _leaves(data_type.elementType, f"{at}[]")
    if isinstance(data_type, T.MapType):
        return _leaves(data_type.valueType, f"{at}{{{data_type.keyType.simpleString()}}}")
    return {(at, data_type.simpleString())}


def evolve(table: T.StructType, given: T.StructType, *, nested: bool = True) -> T.StructType:
    """The table's columns, then the columns only ``given`` has, as nullable. With ``nested`` the objects
    within columns grow in the same way, those in lists and maps too."""
    if nested:
        return widened(table, given)
    known = {f.name.lower() for f in table.fields}
    added = [
        T.StructField(f.name, f.dataType) for f in given.fields if f.name.lower() not in known
    ]
    return T.StructType([*table.fields, *added])


def without(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name])


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _fitted(column: Column, given: T.DataType, wanted: T.DataType, name: str) -> Column:
    """A column as ``wanted``; objects are matched by the names of their fields, at any depth."""
    if fits(given, wanted):
        return column.cast(wanted)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        have = {f.name.lower(): f for f in given.fields}
        extra = set(have) - {f.name.lower() for f in wanted.fields}
        if extra:
            raise SchemaMismatch(f"fields of {name} not in the table: {sorted(extra)}")
        parts = []
        for f in wanted.fields:
            own = have.get(f.name.lower())
            if own is None:
                parts.append(F.lit(None).cast(f.dataType).alias(f.name))
            else:
                part = _fitted(column.getField(own.name), own.dataType, f.dataType, f"{name}.{f.name}")
                parts.append(part.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(column, lambda x: _fitted(x, given.elementType, wanted.elementType, f"{name}[]"))
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType) and fits(given.keyType, wanted.keyType):
        return F.transform_values(column, lambda _, x: _fitted(x, given.valueType, wanted.valueType, f"{name}{{}}"))
    raise SchemaMismatch(
        f"column {name} is {wanted.simpleString()}, the write has {given.simpleString()}"
    )


def conform(df: DataFrame, table: T.StructType) -> DataFrame:
    """The frame in the table's column order and types, or ``SchemaMismatch``.

    Columns, and fields of objects, that the frame lacks become null; those the table lacks, and
    types that do not fit, block the write.
    """
    given = {f.name.lower(): f for f in df.schema.fields}
    if len(given) < len(df.columns):
        raise SchemaMismatch(f"repeated column names: {df.columns}")
    wanted = {f.name.lower() for f in table.fields}
    extra = [f.name for name, f in given.items() if name not in wanted]
    if extra:
        raise SchemaMismatch(f"columns not in the table: {extra}")
    columns: list[Column] = []
    for field in table.fields:
        have = given.get(field.name.lower())
        if have is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        fitted = _fitted(quoted(have.name), have.dataType, field.dataType, field.name)
        columns.append(fitted.alias(field.name))
    return df.select(*columns)


class SchemaStore:
    """A schema kept at a location, with each growth of it as a further numbered file."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")

    def _numbers(self) -> list[int]:
        names = storage.list_names(self.spark, self.location)
        return sorted(int(n[7:-5]) for n in names if n.startswith("schema-") and n.endswith(".json"))

    def load(self) -> T.StructType | None:
        """The newest stored schema, or none."""
        numbers = self._numbers()
        if not numbers:
            return None
        text = storage.read_text(self.spark, f"{self.location}/schema-{numbers[-1]:06d}.json")
        return T.StructType.fromJson(json.loads(text))

    def save(self, schema: T.StructType) -> None:
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 0
        storage.create_text(
            self.spark, f"{self.location}/schema-{number:06d}.json", nullable(schema).json()
        )

    def grow(self, inferred: T.StructType, *, nested: bool = False) -> T.StructType:
        """Add the columns not yet known, and with ``nested`` fields within them; store the result only if it
        changed."""
        known = self.load()
        wider = nullable(inferred) if known is None else evolve(known, inferred, nested=nested)
        if known is None or wider != known:
            self.save(wider)
        return wider
