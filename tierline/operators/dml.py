"""Row-level changes as functions from frames to a frame.

Skew: an upsert is written as a left join plus an anti join, not as one full outer join,
because adaptive execution can split a hot key on the left of those two and cannot in a full
outer join. Rows with a null key match nothing, so they never enter a join. Source rows are
folded to one per key before they meet the target, so no join can multiply rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.columns import all_set, quoted, same_key


def as_condition(condition: str | Column) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def delete_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows for which the condition is not true; an unknown condition keeps the row."""
    return df.filter(~F.coalesce(as_condition(condition), F.lit(False)))


def update_rows(
    df: DataFrame, condition: str | Column, assignments: Mapping[str, Column | str]
) -> DataFrame:
    """Set columns where the condition is true. All assignments see the old values."""
    unknown = set(assignments) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    hit = F.coalesce(as_condition(condition), F.lit(False))
    columns = []
    for field in df.schema.fields:
        old = quoted(field.name)
        if field.name in assignments:
            new = as_condition(assignments[field.name]).cast(field.dataType)
            old = F.when(hit, new).otherwise(old)
        columns.append(old.alias(field.name))
    return df.select(*columns)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the last by ``order_by``, ties settled by the other columns.

    A row whose order is null (a moment that could not be read) comes before all others. The latest
    moment of each key is found from the keys and the order alone, folded in the map stage, so a key
    with very many rows is never gathered in one task; full rows meet only that narrow table, by
    hash, and are sorted by nobody. Only the rows of keys with several latest ones are compared in
    whole. Columns may be of any type, maps and VARIANTs too. Rows with a null key are all kept.
    """
    names = [f"__order{i}" for i in range(len(order_by))]
    order = [(quoted(c) if isinstance(c, str) else c).alias(n) for n, c in zip(names, order_by)]
    rows = df.select("*", *order)
    own = [quoted(k) for k in keys]
    moments = rows.filter(all_set(keys)).select(*own, *names).groupBy(*own, *names)
    top = F.max(F.struct(*names, "__n")).alias("__top")
    tops = moments.agg(F.count(F.lit(1)).alias("__n")).groupBy(*own).agg(top)
    tops = tops.select(
        *[quoted(k).alias(f"__key{i}") for i, k in enumerate(keys)],
        *[F.col("__top").getField(n).alias(f"{n}_") for n in names],
        F.col("__top").getField("__n").alias("__n"),
    )
    same = [quoted(k) == F.col(f"__key{i}") for i, k in enumerate(keys)]
    same += [F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names]

    def latest(several: str) -> DataFrame:
        some = tops.filter(several).hint("shuffle_hash")
        return rows.join(some, reduce(lambda a, b: a & b, same), "left_semi").drop(*names)

    rest = [c for c in df.columns if c not in keys]
    comparable = [_comparable(f) for f in df.schema.fields if f.name in rest]
    whole = F.struct(*[quoted(c) for c in rest]) if rest else F.lit(True)
    newest = F.max_by(whole, F.struct(*comparable) if rest else F.lit(1)).alias("__row")
    ties = latest("__n > 1").groupBy(*own).agg(newest)
    settled = ties.select(
        *[quoted(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    )
    return latest("__n = 1").unionByName(settled).unionByName(df.filter(~all_set(keys)))


def _comparable(field: T.StructField) -> Column:
    """The column, or its JSON text where values of its type have no order."""
    text = field.dataType.simpleString()
    if "map<" in text or "variant" in text:
        return F.to_json(F.struct(quoted(field.name).alias("v")))
    return quoted(field.name)


def _one_per_key(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Key columns, any one row of the key as ``__row``, and the number of rows as ``__n``."""
    row = F.struct(*[quoted(c) for c in source.columns])
    return (
        source.filter(all_set(on))
        .groupBy(*[quoted(k) for k in on])
        .agg(F.any_value(row).alias("__row"), F.count(F.lit(1)).alias("__n"))
    )


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    *,
    unique: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """Upsert by column name: matched rows take the source's columns, other source rows are added.

    A target row that matches several source rows is an error, raised while the query runs;
    repeated source rows that match nothing are all added. Columns only the target has stay as
    they are (null in added rows); columns only the source has are ignored. ``unique=True``
    skips the check, for callers who have made it; ``known`` are the keys that both sides have, if
    the caller knows them, so that the target's need not be gathered.
    """
    shared = [c for c in target.columns if c in set(source.columns)]
    changes = source.select(
        *[quoted(c).cast(target.schema[c].dataType).alias(c) for c in shared]
    )
    null_keys = ~all_set(on)

    if unique:
        right = changes.filter(~null_keys).select(
            *[quoted(k).alias(k) for k in on], F.struct(*[quoted(c) for c in shared]).alias("__row")
        )
    else:
        right = _one_per_key(changes, on)
    other_names = [f"__k{i}" for i in range(len(on))]
    right = right.withColumnsRenamed(dict(zip(on, other_names)))
    matching = same_key(on, other_names)
    joined = target.filter(~null_keys).join(right, matching, "left")
    if not unique:
        message = F.lit(f"a target row matches several source rows on {list(on)}")
        joined = joined.filter(
            F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        )
    matched = F.col("__k0").isNotNull()
    kept = joined.select(
        *[
            F.when(matched, F.col("__row").getField(f.name))
            .otherwise(quoted(f.name))
            .cast(f.dataType)
            .alias(f.name)
            if f.name in shared
            else quoted(f.name)
            for f in target.schema.fields
        ]
    )

    target_keys = (
        (target.filter(~null_keys) if known is None else known)
        .select(*[quoted(k).alias(name) for k, name in zip(on, other_names)])
        .distinct()
    )
    added = (
        changes.filter(~null_keys)
        .join(target_keys, matching, "left_anti")
        .unionByName(changes.filter(null_keys))
        .select(*_as_target(target, shared))
    )
    return kept.unionByName(target.filter(null_keys)).unionByName(added)


def _as_target(target: DataFrame, shared: Sequence[str]) -> list[Column]:
    return [
        (quoted(f.name) if f.name in shared else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]


def six_step_upsert(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """The upsert put together by hand: new rows, replaced rows, untouched rows, then a union.

    Same result as ``merge`` when no target row matches several source rows, which is not
    checked here; kept as an independent check of it.
    """
    other_names = [f"__k{i}" for i in range(len(on))]

    def keys(df: DataFrame) -> DataFrame:
        return df.filter(all_set(on)).select(
            *[quoted(k).alias(name) for k, name in zip(on, other_names)]
        )

    matching = same_key(on, other_names)
    changes = source.select(*[quoted(c) for c in target.columns])
    inserted = changes.join(keys(target).distinct(), matching, "left_anti")
    replacing = changes.join(keys(target), matching).drop(*other_names)
    untouched = target.join(keys(source).distinct(), matching, "left_anti")
    return untouched.unionByName(replacing).unionByName(inserted)


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that differ between two frames: ``change`` (``delete``/``insert``), ``copies``, columns.

    One aggregate with map-side folding over both frames. Copies are counted, not repeated, so
    a row that occurs a billion times is one row of the result.
    """
    names = list(dict.fromkeys([*before.columns, *after.columns]))
    tagged = before.withColumn("__side", F.lit(-1)).unionByName(
        after.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )
    net = tagged.groupBy(*[quoted(n) for n in names]).agg(F.sum("__side").alias("__net"))
    return net.filter(F.col("__net") != 0).select(
        F.when(F.col("__net") > 0, "insert").otherwise("delete").alias("change"),
        F.abs("__net").alias("copies"),
        *[quoted(n) for n in names],
    )


def keyed_changes(changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What happened to each key, from the rows that went and came (``row_changes``).

    ``change`` is ``insert``, ``delete`` or ``update``; then the key columns, ``copies``, ``before``
    and ``after`` (the whole rows, null where there is none), and ``changed``: the names of the
    columns an update set to another value. Old and new row are paired by folding the few changed
    rows per key, not by a join. A null key, and one with several old or new rows, has nothing to be
    paired by: its rows are deletes and inserts, as often as ``copies`` says.
    """
    names = [c for c in changed.columns if c not in ("change", "copies")]
    own = [quoted(k) for k in keys]
    row = F.struct(*[quoted(c) for c in names])
    old, new = F.col("change") == "delete", F.col("change") == "insert"
    none = F.lit(None).cast(T.StructType([changed.schema[c] for c in names]))
    counted = (
        changed.filter(all_set(keys))
        .groupBy(*own)
        .agg(
            F.coalesce(F.sum(F.when(old, F.col("copies"))), F.lit(0)).alias("__old"),
            F.coalesce(F.sum(F.when(new, F.col("copies"))), F.lit(0)).alias("__new"),
            F.any_value(F.when(old, row), True).alias("before"),
            F.any_value(F.when(new, row), True).alias("after"),
        )
    )
    single = (F.col("__old") <= 1) & (F.col("__new") <= 1)
    kind = F.when(F.col("__old") == 0, "insert").when(F.col("__new") == 0, "delete").otherwise("update")
    differs = [
        F.when(~_same(F.col("before").getField(f.name), F.col("after").getField(f.name), f.dataType), F.lit(f.name))
        for f in changed.schema.fields
        if f.name in names and f.name not in keys
    ]
    differs = F.array_compact(F.array(*differs).cast("array<string>"))
    paired = counted.filter(single).select(
        kind.alias("change"),
        *own,
        F.lit(1).cast("bigint").alias("copies"),
        "before",
        "after",
        F.when(kind == "update", differs).alias("changed"),
    )
    several = counted.filter(~single).select(*[quoted(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    others = [f"__k{i}" for i in range(len(keys))]
    loose = changed.join(several, same_key(keys, others), "left_semi").unionByName(changed.filter(~all_set(keys)))
    loose = loose.select(
        "change",
        *own,
        F.col("copies").cast("bigint").alias("copies"),
        F.when(old, row).otherwise(none).alias("before"),
        F.when(new, row).otherwise(none).alias("after"),
        F.lit(None).cast("array<string>").alias("changed"),
    )
    return paired.unionByName(loose)


def _same(a: Column, b: Column, data_type: T.DataType) -> Column:
    """Whether two values are the same, null like null."""
    text = data_type.simpleString()
    if "map<" in text or "variant" in text:
        a, b = (F.to_json(F.struct(x.alias("v"))) for x in (a, b))
    return a.eqNullSafe(b)
