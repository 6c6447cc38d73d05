"""Loading arriving JSON files once each: in bulk, or as a stream with a stored schema."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierline.functions.columns import quoted, to_event_time
from tierline.operators import dml, rollup
from tierline.operators.rollup import row_count
from tierline.sources import schemas, storage
from tierline.sources.files import file_inventory
from tierline.sources.schemas import SchemaStore, nullable
from tierline.sources.versioned import Commit, VersionedTable

LOADED = "path string, length bigint, modificationTime timestamp"
#: Column for the text of what does not fit the others.
RESCUED = "_rescued"
_NESTED = (T.StructType, T.ArrayType, T.MapType)


# ---- bulk ---------------------------------------------------------------------------------


def copy_into(
    table: VersionedTable,
    folder: str,
    *,
    evolve: bool | str = False,
    rescue: str = "text",
    pattern: str | None = None,
    chunk_files: int = 100_000,
    chunk_bytes: int = 1 << 40,
) -> Commit | None:
    """Append the JSON files of a folder that this table has not loaded yet.

    Which files were loaded is part of the table's version, published together with their rows:
    a retry after a failure loads them again, a retry after success loads nothing. Restoring an
    older version makes the files whose rows went loadable again.

    A line must be one JSON object, without repeated names. Lines that are not, unknown fields, and
    values that do not fit their column block the load. With ``evolve`` the table gets the new
    fields (``"nested"``: also those within objects and lists), and what still does not fit is kept
    in the column ``_rescued`` (``rescue``: as ``"text"`` or ``"variant"``). A table without columns
    takes those of the files.

    Loads of more than about ``chunk_files`` files or ``chunk_bytes`` bytes are cut in chunks by the
    files' names, each published on its own; only the names of one chunk come to the driver at once.
    A chunk that is refused leaves those before it loaded. Returns the last commit.
    """
    spark, base = table.spark, table.commit()
    files = file_inventory(spark, folder, pattern)
    if base.loaded:
        known = spark.read.schema(LOADED).parquet(*[f"{table.root}/loaded/{t}" for t in base.loaded])
        files = files.join(known.select("path"), "path", "left_anti")
    totals = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first()
    if not totals.files:
        return None
    chunks = max(-(-totals.files // chunk_files), -(-(totals.bytes or 0) // chunk_bytes))
    if chunks == 1:
        return _load(table, files, folder, evolve, rescue)
    listing = f"{table.root}/loaded/n-{uuid.uuid4().hex}"
    files.withColumn("chunk", F.pmod(F.xxhash64("path"), F.lit(chunks))).write.partitionBy("chunk").parquet(listing)
    commit = None
    try:
        for chunk in range(chunks):
            part = spark.read.schema(f"{LOADED}, chunk bigint").parquet(listing).filter(F.col("chunk") == chunk)
            if not part.isEmpty():
                commit = _load(table, part.drop("chunk"), folder, evolve, rescue) or commit
    finally:
        storage.remove(spark, listing)
    return commit


def _load(table: VersionedTable, files: DataFrame, folder: str, evolve: bool | str, rescue: str) -> Commit | None:
    """Append the lines of some files in one commit, which lists them."""
    spark, base = table.spark, table.commit()
    tag = f"l-{uuid.uuid4().hex}"
    files.write.parquet(f"{table.root}/loaded/{tag}")
    listed = spark.read.schema(LOADED).parquet(f"{table.root}/loaded/{tag}")
    names = [r.path for r in listed.select("path").collect()]

    def append(rows: DataFrame, accept=None) -> Commit | None:
        return table.append(
            rows,
            evolve=True,
            operation="COPY INTO",
            loaded=tag,
            parameters={"folder": folder, "files": str(len(names))},
            accept=accept,
        )

    load = _Lines(spark.read.text(names), base.struct, append, evolve or not base.struct.fields, folder, rescue)
    return load.append()


# ---- stream -------------------------------------------------------------------------------


def stream_lines(
    spark: SparkSession, folder: str, *, since: str | None = None, **options: str
) -> DataFrame:
    """Unbounded frame of the lines of arriving files, each file once per checkpoint.

    ``since`` leaves out files last changed before that moment; ``options`` are Spark's own,
    such as ``maxFilesPerTrigger`` or ``pathGlobFilter``.
    """
    lines = spark.readStream.options(**options).text(folder)
    if since is not None:
        lines = lines.filter(
            F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp")
        )
    return lines.select("value")


def running_count(
    stream: DataFrame, name: str, checkpoint: str, *, drain: bool = True
) -> StreamingQuery:
    """Number of rows seen so far, as a one-row table in memory under ``name``.

    ``drain=True`` counts what has arrived and stops; ``drain=False`` keeps counting.
    """
    writer = (
        row_count(stream)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def running_rollup(
    stream: DataFrame,
    table: VersionedTable,
    time_column: str,
    window: str,
    keys: Sequence[str],
    measures: Sequence[str],
    *,
    checkpoint: str,
    delay: str,
    drain: bool = True,
) -> StreamingQuery:
    """Keep sums per window of event time and key up to date in ``table`` while rows arrive.

    The sums of open windows are the stream's state, kept by the RocksDB store in the checkpoint, so
    memory does not grow with the number of groups and a later start goes on from them. A window
    closes ``delay`` after its end in event time: its state goes, and rows that come later still are
    dropped (Spark counts them as ``numRowsDroppedByWatermark``); rows without a moment are in no
    window. Each batch merges the groups it changed, with their whole sums, so a replay changes nothing.

    The table has ``window_start``, the keys, the measures, ``record_count`` and the group as text.
    """
    kind = stream.schema[time_column].dataType
    moment, zone = to_event_time(quoted(time_column), kind).cast("timestamp"), F.current_timezone()
    begin = F.col("__window.start")
    if isinstance(kind, T.TimestampNTZType):  # windows of the clock on the wall, in whatever zone that hangs
        moment, begin = F.from_utc_timestamp(moment, zone), F.to_utc_timestamp(begin, zone).cast(kind)
    slim = stream.select(moment.alias("__at"), *[quoted(c) for c in dict.fromkeys([*keys, *measures])])
    names = ["window_start", *keys]
    sums = (
        slim.withWatermark("__at", delay)
        .groupBy(F.window("__at", window).alias("__window"), *[quoted(k) for k in keys])
        .agg(*[F.sum(quoted(m)).alias(m) for m in measures], F.count(F.lit(1)).alias("record_count"))
        .withColumn("window_start", begin)
        .select(*[quoted(c) for c in [*names, *measures]], "record_count")
        .withColumn(rollup.GROUP, F.to_json(F.struct(*[quoted(n) for n in names]), {"ignoreNullFields": "false"}))
    )

    def keep(batch: DataFrame, number: int) -> None:
        if not table.exists:
            table.create(nullable(batch.schema))
        if not batch.isEmpty():
            table.merge(batch, rollup.GROUP)

    conf, store = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(store, None)
    conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:  # a query keeps the settings it was started with
        writer = sums.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if drain else writer).start()
    finally:
        conf.unset(store) if before is None else conf.set(store, before)


def _fields(value: Column) -> Column:
    """The fields of a JSON object by name, each as a VARIANT."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _names(schema: T.StructType) -> Column:
    return F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")


def _lost(raw: Column, parsed: Column, data_type: T.DataType) -> Column:
    """True where ``raw`` (a VARIANT) holds something that ``parsed`` does not, at any depth."""
    given = raw.isNotNull() & ~F.is_variant_null(raw)
    if isinstance(data_type, T.StructType):
        fields = _fields(raw)
        gone = F.size(_lost_fields(fields, parsed, data_type)) > 0
        return given & (fields.isNull() | F.coalesce(gone, F.lit(False)))
    if isinstance(data_type, T.ArrayType):
        items = F.try_variant_get(raw, "$", "array<variant>")
        pairs = F.arrays_zip(items.alias("raw"), parsed.alias("parsed"))
        gone = F.exists(pairs, lambda x: _lost(x["raw"], x["parsed"], data_type.elementType))
        return given & (items.isNull() | parsed.isNull() | F.coalesce(gone, F.lit(False)))
    if isinstance(data_type, T.MapType):
        fields = _fields(raw)
        gone = F.exists(F.map_entries(fields), lambda x: _lost(x["value"], parsed[x["key"]], data_type.valueType))
        return given & (fields.isNull() | parsed.isNull() | F.coalesce(gone, F.lit(False)))
    return given & parsed.isNull()


def _lost_fields(fields: Column, parsed: Column, schema: T.StructType) -> Column:
    """Names of the object's fields that the schema lacks or that did not fit it."""
    misfits = [
        F.when(_lost(fields[F.lit(f.name)], parsed.getField(f.name), f.dataType), F.lit(f.name))
        for f in schema.fields
    ]
    misfits = F.array_compact(F.array(*misfits).cast("array<string>"))
    return F.concat(F.array_except(F.map_keys(fields), _names(schema)), misfits)


def _all_set(fields: Column, parsed: Column, schema: T.StructType) -> Column:
    """True where every field of the object has its column, told by their number alone; false if not known."""
    if any(isinstance(f.dataType, _NESTED) for f in schema.fields):
        return F.lit(False)
    filled = [parsed.getField(f.name).isNotNull().cast("int") for f in schema.fields]
    return F.size(fields) == reduce(lambda a, b: a + b, filled, F.lit(0))


def _alike(raw: Column, data_type: T.DataType) -> Column:
    """True where ``raw`` is null or of the kind of a nested type."""
    kind = "array<variant>" if isinstance(data_type, T.ArrayType) else "map<string,variant>"
    return raw.isNull() | F.is_variant_null(raw) | F.try_variant_get(raw, "$", kind).isNotNull()


def _unknown(fields: Column, schema: T.StructType, nested: bool) -> Column:
    """True where an object has a field the schema lacks; with ``nested`` also one within its objects."""
    lower = F.transform(F.map_keys(fields), lambda k: F.lower(k))
    found = F.size(F.array_except(lower, F.transform(_names(schema), lambda k: F.lower(k)))) > 0
    for f in schema.fields if nested else ():
        found = found | _unknown_within(fields[F.lit(f.name)], f.dataType)
    return F.coalesce(found, F.lit(False))


def _unknown_within(raw: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StructType):
        return _unknown(_fields(raw), data_type, True)
    if isinstance(data_type, T.ArrayType):
        items = F.try_variant_get(raw, "$", "array<variant>")
        return F.coalesce(F.exists(items, lambda x: _unknown_within(x, data_type.elementType)), F.lit(False))
    if isinstance(data_type, T.MapType):
        return F.coalesce(
            F.exists(F.map_values(_fields(raw)), lambda x: _unknown_within(x, data_type.valueType)), F.lit(False)
        )
    return F.lit(False)


def _whole(lines: DataFrame) -> DataFrame:
    """``__line``, and as ``__fields`` those of a line that is one JSON object and nothing else, with no name
    twice; else null. Blank lines are left out.

    A JSON parser stops behind the first value, so the line is read once as the only item of a list
    (here) and once as the only field of an object (``_parse``): whatever follows the value ends one
    of the two too early. Numbers keep all their digits (up to 38).
    """
    def listed(text: Column) -> Column:
        return F.concat(F.lit("["), text, F.lit("]"))

    rows = lines.filter(F.trim("value") != "").select(F.col("value").alias("__line"))
    # Quotes and numbers that Spark's reader takes and the standard does not, written as it has them.
    loose = F.from_json(listed(F.col("__line")), "array<string>")
    loose = F.when(F.size(loose) == 1, F.try_parse_json(listed(loose[0])))
    rows = rows.withColumn("__value", F.coalesce(F.try_parse_json(listed(F.col("__line"))), loose))
    alone = F.try_variant_get("__value", "$[1]", "variant").isNull()
    return rows.select("__line", F.when(alone, F.try_variant_get("__value", "$[0]", "map<string,variant>")).alias("__fields"))


def _parse(lines: DataFrame, schema: T.StructType, rescue: str = "text", nested: bool = False) -> DataFrame:
    """Columns of the schema, ``_rescued``: what is not in them, else null, and a last column (``_flag``): true if
    fields that are not in the schema are part of that.

    What is rescued is an object of the fields that are unknown, did not fit or hold more than their
    column, or the whole line where it is not one JSON object with distinct names.
    """
    known = schema if schema.fields else T.MapType(T.StringType(), T.StringType())
    typed = F.from_json(F.concat(F.lit('{"v":'), "__line", F.lit("}")), T.StructType([T.StructField("v", known)]))
    rows = _whole(lines).withColumn("__row", typed["v"])
    fields, row, lost = F.col("__fields"), F.col("__row"), F.col("__lost")
    whole, nothing = fields.isNotNull() & row.isNotNull(), F.array().cast("array<string>")
    rows = rows.withColumn("__lost", F.when(whole, F.when(_all_set(fields, row, schema), nothing).otherwise(_lost_fields(fields, row, schema))))
    some = F.size(lost) > 0
    rest = F.map_filter(fields, lambda k, v: F.array_contains(lost, k))
    if rescue == "variant":
        kept = F.when(lost.isNull(), F.col("__line").cast("variant")).when(some, F.to_variant_object(rest))
    else:
        written = F.from_json("__line", "map<string,string>")  # objects and lists in the order of the line

        def as_text(name: Column, value: Column) -> Column:
            return F.when(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), written[name]).otherwise(value.cast("string"))

        kept = F.when(lost.isNull(), F.col("__line")).when(some, F.to_json(F.transform_values(rest, as_text)))
    new = F.when(some, _unknown(fields, schema, nested)).otherwise(F.lit(False))
    rows = rows.withColumns({"__kept": kept, "__new": new, "__row": F.when(lost.isNotNull(), row)})
    own = [row.getField(f.name).alias(f.name) for f in schema.fields]
    return rows.select(*own, F.col("__kept").alias(RESCUED), F.col("__new").alias(_flag(schema)))


def _flag(schema: T.StructType) -> str:
    """A name that no column of the schema has."""
    name, taken = "_new", {f.name.lower() for f in schema.fields}
    while name in taken:
        name += "_"
    return name


def rescued(kept: Column, path: str, data_type: str) -> Column:
    """A value out of ``_rescued`` (a VARIANT), as ``data_type``; null where there is none that fits."""
    return F.try_variant_get(kept, path, data_type)


def _infer(lines: DataFrame) -> T.StructType:
    """Schema of JSON lines, found by Spark's JSON reader over just these lines."""
    spark = lines.sparkSession
    texts = getattr(lines._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    found = DataFrame(spark._jsparkSession.read().json(texts), spark).schema
    broken = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    return nullable(T.StructType([f for f in found.fields if f.name != broken]))


class _Lines:
    """JSON lines on their way into a table; each is kept whole, in columns or in ``_rescued``.

    The lines are parsed with the known schema and written, and in the same pass those that do not
    fit are counted. Only if there are any that the table has no place for is that write given up and
    its folder removed: where there are new fields and the table may ``grow``, they are inferred from
    the lines that have them (``"nested"``: at any depth) and the lines are parsed again; what is still
    left over makes the table get the column ``_rescued``. A table that has it takes misfits without a
    second write. If the table may not grow ``SchemaMismatch`` is raised. So nothing is lost, and lines
    that fit, or do so but for misfits of the kind met before, are read and written once.
    """

    def __init__(
        self,
        lines: DataFrame,
        table: T.StructType,
        append: Callable[..., Commit | None],
        grow: bool | str,
        what: str,
        rescue: str = "text",
        store: SchemaStore | None = None,
    ):
        if rescue not in ("text", "variant"):
            raise ValueError(f"rescue is text or variant, not {rescue!r}")
        self.lines, self._append, self.grow, self.what, self.store = lines, append, grow, what, store
        self.has_column = RESCUED in table.fieldNames()
        kept = table[RESCUED].dataType if self.has_column else None
        # A table goes on as it began.
        self.rescue = "variant" if isinstance(kept, T.VariantType) else "text" if kept else rescue
        self.known = (store.load() or T.StructType()) if store else schemas.without(table, RESCUED)
        self.nested = grow == "nested"

    def _parsed(self, lines: DataFrame | None = None) -> DataFrame:
        return _parse(self.lines if lines is None else lines, self.known, self.rescue, self.nested)

    def _try(self) -> tuple[Commit | None, int, int]:
        """Write the lines as the schema has them; the commit if the table has a place for all of them, how
        many do not fit, and how many of those have new fields."""
        seen, counts = Observation(), {}
        parsed = self._parsed().observe(
            seen, F.count_if(F.col(RESCUED).isNotNull()).alias("odd"), F.count_if(_flag(self.known)).alias("new")
        )

        def accept() -> bool:
            counts.update(seen.get)
            return not counts["new"] if self.has_column and self.grow else not counts["odd"]

        rows = parsed.drop(_flag(self.known))
        rows = rows if self.has_column and self.grow else rows.drop(RESCUED)
        commit = self._append(rows, accept)
        return commit, counts.get("odd", 0), counts.get("new", 0)

    def _grown(self) -> bool:
        """Add the fields that are new in the lines to the schema; false if there are none after all."""
        fresh = _whole(self.lines).filter(_unknown(F.col("__fields"), self.known, self.nested))
        line = F.col("__line").alias("value")
        if fresh.isEmpty():
            return False
        inferred, before = _infer(fresh.select(line)), self.known
        # Where an object is something else in another line, the two together would give a text.
        mixed = [f for f in before.fields if isinstance(f.dataType, _NESTED) and f.name in inferred.fieldNames()]
        if self.nested and any(not isinstance(inferred[f.name].dataType, type(f.dataType)) for f in mixed):
            alike = reduce(lambda a, b: a & b, [_alike(F.col("__fields")[F.lit(f.name)], f.dataType) for f in mixed])
            inferred = schemas.evolve(_infer(fresh.filter(alike).select(line)), inferred)
        inferred = schemas.without(inferred, RESCUED)
        if self.store:
            self.known = self.store.grow(inferred, nested=self.nested)
        else:
            self.known = schemas.evolve(before, inferred, nested=self.nested)
        return self.known != before

    def append(self) -> Commit | None:
        odd = new = 0
        if self.known.fields:
            commit, odd, new = self._try()
            if commit is not None or not odd:
                return commit
            if not self.grow:
                raise schemas.SchemaMismatch(f"{self.what}: {odd} lines have fields or values the schema lacks")
        if (new or not self.known.fields) and self._grown() and self.known.fields:
            commit, odd, _ = self._try()
            if commit is not None or not odd:
                return commit
        rows = self._parsed().drop(_flag(self.known))
        return None if not self.known.fields and rows.isEmpty() else self._append(rows)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The lasting id Spark keeps in a checkpoint; a new checkpoint is a new stream."""
    return json.loads(storage.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def start_stream(
    table: VersionedTable,
    folder: str,
    *,
    checkpoint: str,
    schema_location: str,
    drain: bool = True,
    since: str | None = None,
    evolve: bool | str = True,
    rescue: str = "text",
    **options: str,
) -> StreamingQuery:
    """Append arriving JSON files to a table, one version per batch.

    ``drain=True`` takes what has arrived and stops; a later start on the same checkpoint goes
    on from there. ``drain=False`` keeps running.

    The schema comes from the store and grows with the first lines that have new top-level fields;
    with ``evolve="nested"`` also with new fields within objects and lists. A value that does not fit
    the type found first, a field that is not taken up, and a line that is not one JSON object with
    distinct names are kept in the column ``_rescued``, which the table gets with the first such
    line: as text, or with ``rescue="variant"`` as a VARIANT that has all digits of numbers and is
    read by path and type (``rescued``). With ``evolve=False`` a batch with any of these is refused.
    """
    spark = table.spark
    store = SchemaStore(spark, schema_location)

    def add(batch: DataFrame, number: int) -> None:
        stream = (stream_id(spark, checkpoint), number)

        def append(rows: DataFrame, accept=None) -> Commit | None:
            if not table.exists:
                table.create(nullable(rows.schema))
            grows = bool(evolve) or RESCUED in rows.columns
            return table.append(
                rows, evolve=grows, operation="STREAM APPEND", stream=stream, accept=accept
            )

        now = table.schema if table.exists else T.StructType()
        grow = evolve or store.load() is None
        _Lines(batch, now, append, grow, f"batch {number}", rescue, store).append()

    writer = (
        stream_lines(spark, folder, since=since, **options)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


# ---- bronze to silver ---------------------------------------------------------------------


def merge_new(
    silver: VersionedTable,
    bronze: VersionedTable,
    on: Sequence[str],
    *,
    order_by: Sequence[str | Column] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    evolve: bool = True,
) -> Commit | None:
    """Upsert only what came into ``bronze`` since the last call, recorded in ``silver``.

    Rows that were deleted in ``bronze`` meanwhile stay in ``silver`` if it has them, and are not
    taken if it has not; rows that were updated or restored there are taken anew.

    ``order_by`` first folds repeated keys to their latest row; without it a key repeated among
    the new rows and present in ``silver`` is an error. ``prepare`` is applied to the new rows.
    """
    newest = bronze.commit()
    since = silver.commit().consumed.get(newest.table_id, -1)
    if since >= newest.version:
        return None
    rows = bronze.appended_since(since, newest.version)
    if order_by:
        rows = dml.latest_per_key(rows, on, order_by)
    if prepare:
        rows = prepare(rows)
    return silver.merge(rows, on, evolve=evolve, consumed=(newest.table_id, newest.version))


# ---- silver to gold -----------------------------------------------------------------------


def rollup_new(
    gold: VersionedTable,
    silver: VersionedTable,
    time_column: str,
    keys: Sequence[str],
    measures: Sequence[str],
) -> DataFrame:
    """Keep the sums of ``monthly_rollup`` over ``silver`` in ``gold`` by what changed since the last call.

    Only rows that came or went since then are read, whatever brought that about (merges, deletes,
    updates, restores); their signed sums are added to the groups they belong to, and groups without
    rows go. The version of ``silver`` is recorded in the same commit as the sums, so a call that was
    cut short is made good by the next one. Sums of decimals and whole numbers equal those computed
    anew; of doubles the last digits may differ.

    Returns the groups: year, month, keys, measures, and ``record_count``.
    """
    newest = silver.commit()
    nothing = rollup.signed_rollup(
        dml.row_changes(silver.read().limit(0), silver.read().limit(0)), time_column, keys, measures
    )
    if not gold.exists:
        gold.create(nothing.schema, partition_by=["year", "month"])
    since = gold.commit().consumed.get(newest.table_id)
    if since is None:
        if gold.commit().consumed:  # the sums are those of another table
            gold.overwrite(nothing)
        rows = silver.read(newest.version)
        changes = rows.withColumns({"change": F.lit("insert"), "copies": F.lit(1).cast("bigint")})
    elif since < newest.version:
        changes = silver.diff(since, newest.version)
    else:
        changes = None
    if changes is not None:
        more = rollup.signed_rollup(changes, time_column, keys, measures)
        sums = rollup.added_up(gold.read(), more, measures)
        gold.merge(sums, rollup.GROUP, consumed=(newest.table_id, newest.version))
        gold.delete(F.col(rollup.ROWS) <= 0)
    return rollup_rows(gold, keys, measures)


def rollup_rows(gold: VersionedTable, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The groups that ``rollup_new`` keeps."""
    names = [quoted(c) for c in ["year", "month", *keys, *measures]]
    return gold.read().filter(F.col(rollup.ROWS) > 0).select(*names, F.col(rollup.ROWS).alias("record_count"))
