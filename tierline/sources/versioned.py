"""Tables kept as numbered snapshots of immutable Parquet folders.

Every change is one ordinary Spark write into a new folder ``data/commit_tag=<tag>`` plus one
small JSON file ``commits/<version>.json`` that says which folders make up the table. The JSON
holds folder names and totals only; the list of single files with their sizes and key ranges is
itself a Parquet table (``manifests/<tag>``) written and filtered by Spark. A snapshot is

* any number of *whole* folders, read by folder name, and
* at most one *subset*: what is left of folders of which some files were rewritten.

Deletes, updates and upserts find the files that hold a hit, rewrite those, and carry the rest
over untouched. One writer per table is assumed: a second writer of the same version fails.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.columns import all_set, quoted, same_key
from tierline.operators import dml, joins
from tierline.operators import profile as profiles
from tierline.session import work_folder
from tierline.sources import storage
from tierline.sources import schemas
from tierline.sources.schemas import SchemaMismatch, conform, nullable

TAG = "commit_tag"
MANIFEST = "path string, rows bigint, bytes bigint, key string, lo string, hi string, clustered boolean"
LEDGER = (
    "version bigint, committed_at timestamp, operation string, "
    "parameters map<string,string>, metrics map<string,bigint>"
)
# Path of a row's file below the data folder, as it stands in a manifest.
OWN_FILE = f"substring(_metadata.file_path, locate('{TAG}=', _metadata.file_path))"
# Stands before a text that a folder's name could not hold.
MARK = "\x01"
# Files smaller than the first of these are written several to a task, of rows of about the second.
SMALL_FILE, TASK_BYTES = 1 << 20, 16 << 20
# Operations that leave the rows as they are, and those that only add rows.
SAME_ROWS = {"COMPACT", "CLUSTER"}
ADDING = {"CREATE", "APPEND", "STREAM APPEND", "COPY INTO"}


class MergeCardinalityError(ValueError):
    """A target row matches several source rows."""


class ConcurrentWrite(RuntimeError):
    """Another writer published this version first."""


@dataclass
class Part:
    """A whole folder (``tag`` set) or the subset of left-over files (``tag`` none).

    A subset draws from ``folders``; ``removed`` is the table of the files taken out of them.
    """

    tag: str | None
    manifest: str
    files: int
    rows: int
    bytes: int
    folders: list[str] = field(default_factory=list)
    removed: str | None = None
    marked: list[str] = field(default_factory=list)  # partition columns with marked values


@dataclass
class Commit:
    version: int
    committed_at: str
    operation: str
    schema: str
    partition_by: list[str]
    cluster_by: str | None
    parts: list[Part]
    table_id: str  # differs between a table and one made later at the same place
    parameters: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, int] = field(default_factory=dict)
    added: str | None = None  # folder this commit wrote
    loaded: list[str] = field(default_factory=list)  # lists of bulk-loaded source files
    streams: dict[str, int] = field(default_factory=dict)  # last batch of each stream
    consumed: dict[str, int] = field(default_factory=dict)  # last version merged, by source table id

    @classmethod
    def parse(cls, text: str) -> Commit:
        values = json.loads(text)
        values["parts"] = [Part(**p) for p in values["parts"]]
        return cls(**values)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)

    @property
    def marked(self) -> list[str]:
        """Partition columns of which some folder's name has a mark."""
        return sorted({c for p in self.parts for c in p.marked})

    @property
    def files(self) -> int:
        return sum(p.files for p in self.parts)

    @property
    def bytes(self) -> int:
        return sum(p.bytes for p in self.parts)


def _relative(path: str) -> str:
    return path[path.index(f"{TAG}="):]


def _tag_of(relative: str) -> str:
    return relative.split("/", 1)[0][len(TAG) + 1:]


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _as_folder(column: Column) -> Column:
    """A text as the name of a partition's folder can hold it: one that reads back as null, the empty one
    too, gets a mark in front."""
    odd = column.isin("", "__HIVE_DEFAULT_PARTITION__") | column.startswith(MARK)
    return F.when(odd, F.concat(F.lit(MARK), column)).otherwise(column)


def _from_folder(column: Column) -> Column:
    return F.when(column.startswith(MARK), F.substring(column, 2, 1 << 30)).otherwise(column)


def _bound(column: Column, data_type: T.DataType) -> Column:
    """Value in a form whose text reads back the same in every session time zone."""
    return F.unix_micros(column) if isinstance(data_type, T.TimestampType) else column


def _without(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of opened files, less those of the ``files`` (``path``)."""
    named = rows.withColumn("__file", F.expr(OWN_FILE))
    gone = files.withColumnRenamed("path", "__gone")
    return named.join(gone, F.col("__file") == F.col("__gone"), "left_anti").drop("__file")


def _scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables a frame reads, as far as Spark knows their size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)  # Spark puts the largest number where it has none


def _row_bytes(schema: T.StructType) -> int:
    """About what a row takes while it is sorted: a word for each field, and the text of a string."""
    return 8 + sum(8 if isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)) else 28 for f in schema.fields)


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        target_file_bytes: int = 256 * 1024 * 1024,
        auto_compact: int | None = 50,
        size_writes: bool = False,
        find_by: Sequence[str] = (),
    ):
        """``auto_compact``: compact after a write that leaves this many small files too many.

        ``size_writes`` gives writes without partitions evenly sized files too, at the price of
        a shuffle; partitioned writes always get them. ``find_by`` names columns that rows are looked
        for by single values: files get Parquet Bloom filters of them, and any filter with ``=`` or
        ``in`` skips the row groups that cannot have the value, however the table is laid out.
        """
        self.spark = spark
        self.root = storage.full_path(spark, root)
        self.data = f"{self.root}/data"
        self.target_file_bytes = target_file_bytes
        self.auto_compact = auto_compact
        self.size_writes = size_writes
        self.find_by = list(find_by)
        self._known = -1

    # ---- ledger -------------------------------------------------------------------------

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/commits/{version:012d}.json"

    @property
    def version(self) -> int:
        """Newest version; -1 before the table is created."""
        if self._known < 0:
            names = storage.list_names(self.spark, f"{self.root}/commits")
            versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
            self._known = max(versions, default=-1)
            while self._known >= 0 and not storage.length(self.spark, self._commit_path(self._known)):
                self._known -= 1  # a writer died before it had published anything
        else:
            while storage.length(self.spark, self._commit_path(self._known + 1)):
                self._known += 1
        return self._known

    @property
    def exists(self) -> bool:
        return self.version >= 0

    def commit(self, version: int | None = None) -> Commit:
        if version is None:
            version = self.version
        path = self._commit_path(version)
        if version < 0 or not storage.exists(self.spark, path):
            raise ValueError(f"{self.root} has no version {version}")
        return Commit.parse(storage.read_text(self.spark, path))

    @property
    def schema(self) -> T.StructType:
        return self.commit().struct

    def history(self) -> DataFrame:
        """One row per version, newest first."""
        return (
            self.spark.read.schema(LEDGER)
            .json(f"{self.root}/commits")
            .orderBy(F.col("version").desc())
        )

    def _publish(self, commit: Commit) -> Commit:
        """Make the next version visible. Folders of a write that never gets here are never read."""
        try:
            storage.create_text(
                self.spark, self._commit_path(commit.version), json.dumps(asdict(commit))
            )
        except storage.AlreadyExists as error:
            raise ConcurrentWrite(f"version {commit.version} of {self.root} exists") from error
        self._known = commit.version
        return commit

    def _next(self, base: Commit, operation: str, parts: Sequence[Part], **changes) -> Commit:
        values = {
            "schema": base.schema,
            "partition_by": base.partition_by,
            "cluster_by": base.cluster_by,
            "table_id": base.table_id,
            "loaded": base.loaded,
            "streams": base.streams,
            "consumed": base.consumed,
        } | changes
        values.setdefault("metrics", {})
        values["metrics"] = {**values["metrics"], "rows": sum(p.rows for p in parts)}
        return Commit(
            version=base.version + 1,
            committed_at=datetime.now(timezone.utc).isoformat(timespec="microseconds"),
            operation=operation,
            parts=[p for p in parts if p.files],
            **values,
        )

    # ---- files --------------------------------------------------------------------------

    def _place(self, partition_by: Sequence[str]) -> str:
        """Where the folders of one layout lie; those of another are not in the way of tables over them."""
        if not partition_by:
            return self.data
        return f"{self.data}-by-{hashlib.sha256('/'.join(partition_by).encode()).hexdigest()[:12]}"

    def _open(
        self,
        schema: T.StructType,
        folders: Sequence[str],
        files: Sequence[str] = (),
        without: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        marked: Sequence[str] = (),
    ) -> DataFrame:
        """Rows of folders (by tag) and single files (by relative name), ``_metadata`` included.

        Files listed in the tables ``without`` are left out by an anti join on the file's name, so
        their number does not matter and none of the names passes the driver.
        """
        data = self._place(partition_by)
        paths = [f"{data}/{TAG}={tag}" for tag in folders]
        paths += [f"{data}/{unquote(name)}" for name in files]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", data).parquet(*paths)
        if marked:
            rows = rows.withColumns({c: _from_folder(quoted(c)) for c in marked})
        if without:
            rows = _without(rows, self._removed(without))
        return rows

    def _removed(self, names: Sequence[str]) -> DataFrame:
        return self.spark.read.schema("path string").parquet(*[f"{self.root}/manifests/{n}" for n in names])

    def _manifest(self, parts: Sequence[Part]) -> DataFrame:
        """One row per live file. File names, not rows of the table."""
        return self.spark.read.schema(MANIFEST).parquet(
            *[f"{self.root}/manifests/{p.manifest}" for p in parts]
        )

    def _names(self, files: DataFrame) -> list[str]:
        return [r.path for r in files.select("path").collect()]

    def _snapshot(self, commit: Commit, parts: Sequence[Part] | None = None) -> DataFrame:
        parts = commit.parts if parts is None else parts
        folders = [p.tag for p in parts if p.tag]
        subsets = [p for p in parts if not p.tag]
        folders += [tag for p in subsets for tag in p.folders]
        gone = [p.removed for p in subsets if p.removed]
        return self._open(commit.struct, folders, without=gone, partition_by=commit.partition_by, marked=commit.marked)

    def _columns(self, commit: Commit) -> list[Column]:
        return [quoted(f.name) for f in commit.struct.fields]

    def _write(
        self,
        df: DataFrame,
        partition_by: Sequence[str],
        cluster_by: str | None,
        *,
        laid_out: bool = False,
        clustered: bool = False,
        input_bytes: int = 0,
    ) -> Part:
        """Write one new folder and its manifest. Nothing is visible until ``_publish``.

        A partitioned write is rebalanced by partition first, so each partition gets few files
        and adaptive execution splits a partition that is too large. Where a file without partitions
        is to be smaller than a task is worth, the rows are written in large files first, and a task
        cuts those into many.
        """
        clash = {TAG, "__file", "__salt"} & {c.lower() for c in df.columns}
        if clash:
            raise SchemaMismatch(f"reserved column names: {sorted(clash)}")
        tag = f"c-{uuid.uuid4().hex}"
        schema = nullable(df.schema)
        if (partition_by or self.size_writes) and not laid_out:
            df = df.hint("rebalance", *partition_by)
        large = None
        if self.size_writes and not partition_by and not laid_out and self.target_file_bytes < SMALL_FILE:
            large = work_folder(self.spark, "large")
            with self._sized(df, input_bytes or _scanned_bytes(df), TASK_BYTES):
                df.write.parquet(large)
            df = self.spark.read.schema(schema).parquet(large)
        texts = [c for c in partition_by if isinstance(schema[c].dataType, T.StringType)]
        marks = Observation()
        if texts:
            df = df.withColumns({c: _as_folder(quoted(c)) for c in texts})
            found = [F.count_if(quoted(c).startswith(MARK)).alias(f"n{i}") for i, c in enumerate(texts)]
            df = df.observe(marks, *found)
        writer = df.write.mode("error")
        for name in {*self.find_by} & {*df.columns} - {*partition_by}:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if large and (rows := self._rows_per_file(df)):
            writer = writer.option("maxRecordsPerFile", rows)
        with self._sized(df, input_bytes or _scanned_bytes(df)):
            writer.parquet(f"{self._place(partition_by)}/{TAG}={tag}")
        if large:
            storage.remove(self.spark, large)

        files = self._open(schema, [tag], partition_by=partition_by).groupBy(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
        )
        measures = [F.count(F.lit(1)).alias("rows")]
        if cluster_by:
            key = _bound(quoted(cluster_by), schema[cluster_by].dataType)
            measures += [F.min(key).alias("lo"), F.max(key).alias("hi")]
        manifest = files.agg(*measures).select(
            F.expr(f"substring(file, locate('{TAG}=', file))").alias("path"),
            "rows",
            "bytes",
            F.lit(cluster_by).cast("string").alias("key"),
            (F.col("lo") if cluster_by else F.lit(None)).cast("string").alias("lo"),
            (F.col("hi") if cluster_by else F.lit(None)).cast("string").alias("hi"),
            F.lit(clustered).alias("clustered"),
        )
        part = self._write_manifest(manifest, tag, tag)
        part.marked = [c for i, c in enumerate(texts) if marks.get[f"n{i}"]]
        return part

    def _rows_per_file(self, df: DataFrame) -> int:
        """Rows of a file of the table's size, by the size of one such file; 0 if there are no rows."""
        rows = df.count()
        if not rows:
            return 0
        each = max(1, math.ceil(rows * self.target_file_bytes / max(1, _scanned_bytes(df))))
        trial = work_folder(self.spark, "trial")
        df.limit(each).coalesce(1).write.parquet(trial)
        size = _scanned_bytes(self.spark.read.schema(df.schema).parquet(trial))
        storage.remove(self.spark, trial)
        return max(1, round(each * self.target_file_bytes / max(1, size)))

    @contextmanager
    def _sized(self, df: DataFrame, input_bytes: int, each: int | None = None) -> Iterator[None]:
        """Fit shuffles to the data during one job: at least one partition per file read, and
        adaptive execution puts them together up to the table's file size, or to ``each`` bytes. The
        settings are those of the frame's own session; a stream's batch has one of its own."""
        conf = df._jdf.sparkSession().conf()
        each = each or self.target_file_bytes
        wanted = math.ceil(input_bytes / each)
        partitions = max(wanted, int(conf.get("spark.sql.shuffle.partitions")))
        during = {
            "spark.sql.shuffle.partitions": partitions,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": each,
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": min(1 << 20, each),
        }
        before = {name: conf.get(name) for name in during}
        for name, value in during.items():
            conf.set(name, str(value))
        try:
            yield
        finally:
            for name, value in before.items():
                conf.set(name, value)

    def _write_manifest(self, manifest: DataFrame, name: str, tag: str | None) -> Part:
        totals = Observation()
        manifest.observe(
            totals,
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        ).write.parquet(f"{self.root}/manifests/{name}")
        return Part(tag=tag, manifest=name, **totals.get)

    def _rewrite(
        self,
        base: Commit,
        touched: Sequence[str],
        change: Callable[[DataFrame], DataFrame],
        dropped: Sequence[str] = (),
        **write_options,
    ) -> tuple[list[Part], Part | None, int]:
        """Replace the touched files by ``change`` of their rows, and leave the dropped ones out.

        Returns the parts of the next version, the new part (none if no file was touched), and the
        rows that the touched and dropped files held.
        """
        tags: dict[str, int] = {}
        for name in [*touched, *dropped]:
            tags[_tag_of(name)] = tags.get(_tag_of(name), 0) + 1
        kept = [p for p in base.parts if p.tag and p.tag not in tags]
        hit = [p for p in base.parts if p.tag and p.tag in tags]
        full = [p for p in hit if tags[p.tag] == p.files]
        subsets = [p for p in base.parts if not p.tag]
        broken = [p for p in hit if p not in full] + subsets

        whole = {p.tag for p in full} - {_tag_of(n) for n in dropped}
        rows_before = sum(p.rows for p in full + broken)
        new = None
        if touched:
            new = self._write(
                change(
                    self._open(
                        base.struct,
                        sorted(whole),
                        [n for n in touched if _tag_of(n) not in whole],
                        partition_by=base.partition_by,
                        marked=base.marked,
                    )
                ),
                base.partition_by,
                base.cluster_by,
                input_bytes=sum(p.bytes for p in full + broken),
                **write_options,
            )
        in_full = {p.tag for p in full}
        gone = [n for n in [*touched, *dropped] if _tag_of(n) not in in_full]
        if broken and gone:
            names = self.spark.createDataFrame([(n,) for n in gone], "path string")
            rest = self._manifest(broken).join(names, "path", "left_anti")
            subset = self._write_manifest(rest, f"s-{uuid.uuid4().hex}", None)
            before = [p.removed for p in subsets if p.removed]
            removed = self._removed(before).unionByName(names) if before else names
            subset.removed = f"r-{uuid.uuid4().hex}"
            removed.coalesce(1).write.parquet(f"{self.root}/manifests/{subset.removed}")
            subset.folders = [p.tag for p in broken if p.tag] + [t for p in subsets for t in p.folders]
            subset.marked = sorted({c for p in broken for c in p.marked})
            left_over = [subset]
        else:
            left_over = broken
        rows_before -= sum(p.rows for p in left_over)
        return [*kept, *left_over, *([new] if new else [])], new, rows_before

    def _after(self, commit: Commit) -> Commit:
        needed = math.ceil(commit.bytes / self.target_file_bytes)
        if self.auto_compact is not None and commit.files - needed >= self.auto_compact:
            self.compact(self.auto_compact)
        return commit

    # ---- reading ------------------------------------------------------------------------

    def read(self, version: int | None = None, as_of: datetime | str | None = None) -> DataFrame:
        """Rows of the newest version, of a version by number, or of the version at a moment."""
        if as_of is not None:
            version = self.version_at(as_of)
        commit = self.commit(version)
        return self._snapshot(commit).select(*self._columns(commit))

    def version_at(self, moment: datetime | str) -> int:
        """Newest version committed at or before a moment."""
        found = (
            self.history()
            .filter(F.col("committed_at") <= F.lit(moment).cast("timestamp"))
            .agg(F.max("version").alias("version"))
            .first()
        )
        if found.version is None:
            raise ValueError(f"{self.root} had no version at {moment}")
        return found.version

    def _matching_files(self, commit: Commit, low, high) -> DataFrame:
        if commit.cluster_by is None:
            raise ValueError(f"{self.root} is not clustered")
        data_type = commit.struct[commit.cluster_by].dataType
        stored = T.LongType() if isinstance(data_type, T.TimestampType) else data_type
        least, most = (_bound(F.lit(v).cast(data_type), data_type) for v in (low, high))
        no_range = F.coalesce(F.col("key"), F.lit("")) != commit.cluster_by
        overlap = (F.col("lo").cast(stored) <= most) & (F.col("hi").cast(stored) >= least)
        return self._manifest(commit.parts).filter(no_range | overlap)

    def lookup(self, low, high=None, version: int | None = None) -> DataFrame:
        """Rows whose cluster key is ``low``, or between ``low`` and ``high``.

        Files whose key range cannot match are left out before the scan is planned; Parquet
        statistics skip row groups in the rest.
        """
        high = low if high is None else high
        commit = self.commit(version)
        files = self._names(self._matching_files(commit, low, high)) if commit.parts else []
        return (
            self._open(commit.struct, [], files, partition_by=commit.partition_by, marked=commit.marked)
            .select(*self._columns(commit))
            .filter(quoted(commit.cluster_by).between(F.lit(low), F.lit(high)))
        )

    def diff(self, before: int, after: int) -> DataFrame:
        """Rows that went and came between two versions; files in both are not read."""
        old, new = self.commit(before), self.commit(after)
        old_folders = {p.tag for p in old.parts if p.tag}
        new_folders = {p.tag for p in new.parts if p.tag}
        old_parts = [p for p in old.parts if p.tag is None or p.tag not in new_folders]
        new_parts = [p for p in new.parts if p.tag is None or p.tag not in old_folders]

        if schemas.grew(old.struct, new.struct):  # both read with the fields that either has
            wide = schemas.evolve(old.struct, new.struct).json()
            old, new = (Commit(**{**c.__dict__, "schema": wide}) for c in (old, new))

        def only_in(commit: Commit, here: list[Part], there: list[Part]) -> DataFrame:
            rows = self._snapshot(commit, here)
            if any(p.tag is None for p in [*here, *there]):
                # Files that both versions have, of folders that only one has whole.
                both = [p for p in there if p.tag is None or any(p.tag in q.folders for q in here)]
                if here and both:
                    rows = _without(rows, self._manifest(both).select("path"))
            return rows.select(*self._columns(commit))

        return dml.row_changes(only_in(old, old_parts, new_parts), only_in(new, new_parts, old_parts))

    def changes(self, before: int, after: int, on: str | Sequence[str]) -> DataFrame:
        """Inserted, deleted and updated rows by key between two versions, an update's old and new row side
        by side with the names of the columns that changed; see ``dml.keyed_changes``."""
        return dml.keyed_changes(self.diff(before, after), [on] if isinstance(on, str) else list(on))

    def appended_since(self, version: int, until: int | None = None) -> DataFrame:
        """Rows added after a version. Compaction in between neither repeats nor hides rows.

        If rows were also changed, deleted or restored meanwhile, it is the rows that are there now
        and were not then, so a row added and deleted again does not show up.
        """
        newest = self.commit(until)
        commits = (
            self.spark.read.schema("version bigint, operation string, added string")
            .json(f"{self.root}/commits")
            .filter(F.col("version").between(version + 1, newest.version))
            .collect()
        )
        if any(c.operation not in SAME_ROWS | ADDING for c in commits):
            return self._net_rows(version, newest.version)
        folders = [c.added for c in commits if c.operation in ADDING and c.added]
        texts = [c for c in newest.partition_by if isinstance(newest.struct[c].dataType, T.StringType)]
        rows = self._open(newest.struct, folders, partition_by=newest.partition_by, marked=texts)
        return rows.select(*self._columns(newest))

    def _net_rows(self, before: int, after: int) -> DataFrame:
        """Rows that the later version has and the earlier one has not, each as often as it came."""
        newest = self.commit(after)
        if before < 0:
            return self.read(after)
        came = self.diff(before, after).filter("change = 'insert'")
        again = came.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        return again.select(*self._columns(newest))

    def profile(self, version: int | None = None, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
        """Nulls, distinct values, quantiles and frequent values of each column; see ``profiles.estimates``.

        Sketches of a part of the table are computed once, when a profile first needs them, and kept
        beside its list of files; a later version reads only the parts that are new in it.
        """
        commit = self.commit(version)
        kept = []
        for part in commit.parts:
            path = f"{self.root}/profiles/{part.manifest}"
            if not storage.exists(self.spark, f"{path}/_SUCCESS"):
                profiles.sketched(self._snapshot(commit, [part]).select(*self._columns(commit))).write.mode("overwrite").parquet(path)
            kept.append(path)
        if not kept:
            return profiles.profile(self.read(version), quantiles)
        parts = self.spark.read.schema(profiles.SKETCH).parquet(*kept)
        known = {f.name for f in commit.struct.fields}
        return profiles.estimates(profiles.merged(parts.filter(F.col("column").isin(*known))), quantiles)

    # ---- writing ------------------------------------------------------------------------

    def create(
        self,
        schema: T.StructType | str,
        partition_by: Sequence[str] = (),
        cluster_by: str | None = None,
    ) -> Commit:
        """Version 0: no rows."""
        if isinstance(schema, str):
            schema = self.spark.createDataFrame([], schema).schema
        if self.exists:
            raise ValueError(f"{self.root} exists")
        before = self._nothing()
        layout = {"partition_by": list(partition_by), "cluster_by": cluster_by}
        return self._publish(
            self._next(before, "CREATE", [], schema=nullable(schema).json(), **layout)
        )

    def _nothing(self) -> Commit:
        """What comes before version 0."""
        return Commit(-1, "", "", T.StructType().json(), [], None, [], uuid.uuid4().hex)

    def _fit(self, df: DataFrame, base: Commit, grow: bool) -> DataFrame:
        return conform(df, schemas.evolve(base.struct, df.schema) if grow else base.struct)

    def append(
        self,
        df: DataFrame,
        *,
        evolve: bool = False,
        operation: str = "APPEND",
        stream: tuple[str, int] | None = None,
        loaded: str | None = None,
        parameters: Mapping[str, str] | None = None,
        accept: Callable[[], bool] | None = None,
    ) -> Commit | None:
        """Add rows. ``evolve`` adds columns the table lacks; otherwise they block the write.

        ``stream`` is (stream id, batch number): a batch at or below the last one recorded is
        skipped, so a replay adds nothing. ``accept`` is asked after the rows are written and
        before they become visible; when it says no, nothing is published or left behind.
        """
        base = self.commit()
        if stream and base.streams.get(stream[0], -1) >= stream[1]:
            return None
        fitted = self._fit(df, base, evolve)
        part = self._write(fitted, base.partition_by, base.cluster_by)
        if accept and not accept():
            for written in (f"{self._place(base.partition_by)}/{TAG}={part.tag}", f"{self.root}/manifests/{part.manifest}"):
                storage.remove(self.spark, written)
            return None
        changes = {
            "schema": nullable(fitted.schema).json(),
            "added": part.tag if part.files else None,
            "metrics": {"inserted": part.rows, "files_written": part.files},
            "parameters": dict(parameters or {}),
        }
        if stream:
            changes["streams"] = {**base.streams, stream[0]: stream[1]}
        if loaded:
            changes["loaded"] = [*base.loaded, loaded]
        return self._after(
            self._publish(self._next(base, operation, [*base.parts, part], **changes))
        )

    def overwrite(self, df: DataFrame, *, evolve: bool = False) -> Commit:
        """Replace all rows, schema enforced. The frame may read this table."""
        base = self.commit()
        fitted = self._fit(df, base, evolve)
        part = self._write(fitted, base.partition_by, base.cluster_by)
        metrics = {"deleted": base.rows, "inserted": part.rows}
        schema = nullable(fitted.schema).json()
        commit = self._next(
            base, "OVERWRITE", [part], schema=schema, added=part.tag, metrics=metrics
        )
        return self._after(self._publish(commit))

    def replace(
        self, df: DataFrame, *, partition_by: Sequence[str] = (), cluster_by: str | None = None
    ) -> Commit:
        """Create the table from a query, or replace its rows, schema and layout."""
        base = self.commit() if self.exists else self._nothing()
        part = self._write(df, partition_by, cluster_by)
        commit = self._next(
            base,
            "REPLACE" if self.exists else "CREATE",
            [part],
            schema=nullable(df.schema).json(),
            partition_by=list(partition_by),
            cluster_by=cluster_by,
            added=part.tag,
            parameters={"partition_by": ",".join(partition_by)},
            metrics={"deleted": base.rows, "inserted": part.rows},
        )
        return self._after(self._publish(commit))

    def _hits(self, base: Commit, rows: DataFrame, hit: Column) -> list:
        """``path``, ``hits`` and ``rows`` of every file with rows that are hit. Reads the columns of ``hit`` only."""
        if not base.parts:
            return []
        counts = rows.filter(hit).groupBy(F.expr(OWN_FILE).alias("path")).agg(F.count(F.lit(1)).alias("hits"))
        return counts.join(self._manifest(base.parts), "path").select("path", "hits", "rows").collect()

    def _change_rows(
        self,
        operation: str,
        counted: str,
        condition: str | Column,
        change: Callable[[DataFrame], DataFrame],
        drops: bool = False,
    ) -> Commit | None:
        """Rewrite the files that hold rows which meet the condition. If that ``drops`` those rows,
        files of which every row goes are left out without a job."""
        base = self.commit()
        hits = self._hits(base, self._snapshot(base), dml.as_condition(condition)) if base.parts else []
        whole = [r.path for r in hits if drops and r.hits == r.rows]
        return self._publish_change(
            base, operation, counted, hits, whole, change, {"condition": str(condition)}
        )

    def _publish_change(
        self,
        base: Commit,
        operation: str,
        counted: str,
        hits: Sequence,
        whole: Sequence[str],
        change: Callable[[DataFrame], DataFrame],
        parameters: Mapping[str, str],
    ) -> Commit | None:
        if not hits:
            return None
        left = set(whole)
        touched = [r.path for r in hits if r.path not in left]
        parts, new, _ = self._rewrite(
            base, touched, lambda df: change(df.select(*self._columns(base))), whole
        )
        commit = self._next(
            base,
            operation,
            parts,
            added=new.tag if new else None,
            parameters=dict(parameters),
            metrics={
                "rows_before": base.rows,
                counted: sum(r.hits for r in hits),
                "files_rewritten": len(touched),
                "files_dropped": len(left),
                "files_written": new.files if new else 0,
            },
        )
        return self._after(self._publish(commit))

    def delete(self, condition: str | Column) -> Commit | None:
        """Remove rows for which the condition is true; no new version when there are none."""
        return self._change_rows(
            "DELETE", "deleted", condition, lambda df: dml.delete_rows(df, condition), drops=True
        )

    def delete_keys(self, keys: DataFrame, on: str | Sequence[str]) -> Commit | None:
        """Remove the rows whose key is in a frame of keys, however many there are.

        Files whose key range none of them reaches are not opened on a clustered table.
        """
        on = [on] if isinstance(on, str) else list(on)
        base = self.commit()
        if not base.parts:
            return None
        wanted = keys.select(*[quoted(k).cast(base.struct[k].dataType).alias(k) for k in on])
        wanted = wanted.filter(all_set(on)).distinct()
        staged = work_folder(self.spark, "keys")
        wanted.write.parquet(staged)
        wanted = self.spark.read.schema(wanted.schema).parquet(staged)
        names = {k: f"__k{i}" for i, k in enumerate(on)}
        renamed = wanted.withColumnsRenamed(names)
        matching = same_key(on, names.values())
        try:
            rows = self._merge_candidates(base, wanted, on[0])
            if rows is None:
                return None
            found = rows.select(*[quoted(k).alias(k) for k in on], F.expr(OWN_FILE).alias("__path"))
            found = found.join(renamed, matching, "left_semi").groupBy(F.col("__path").alias("path"))
            found = found.agg(F.count(F.lit(1)).alias("hits")).join(self._manifest(base.parts), "path")
            hits = found.select("path", "hits", "rows").collect()
            return self._publish_change(
                base,
                "DELETE",
                "deleted",
                hits,
                [r.path for r in hits if r.hits == r.rows],
                lambda df: df.join(renamed, matching, "left_anti"),
                {"on": ",".join(on)},
            )
        finally:
            storage.remove(self.spark, staged)

    def update(
        self, condition: str | Column, assignments: Mapping[str, Column | str]
    ) -> Commit | None:
        """Set columns in rows for which the condition is true."""
        return self._change_rows(
            "UPDATE", "updated", condition, lambda df: dml.update_rows(df, condition, assignments)
        )

    def merge(
        self,
        source: DataFrame,
        on: str | Sequence[str],
        *,
        evolve: bool = False,
        stage_source: bool = True,
        consumed: tuple[str, int] | None = None,
    ) -> Commit:
        """Upsert by column name; see ``dml.merge`` for what happens to each row.

        The source is read several times. Unless the table is empty it is written to the work
        folder first, so that it cannot change in between and its size is known when joins are
        planned; pass ``stage_source=False`` when it already is a plain scan of files.
        """
        keys = [on] if isinstance(on, str) else list(on)
        base = self.commit()
        wanted = schemas.evolve(base.struct, source.schema) if evolve else base.struct
        source = self._merge_columns(source, wanted, evolve)
        staged = None
        if stage_source and base.parts:
            staged = work_folder(self.spark, "merge")
            schema = source.schema
            source.write.parquet(staged)
            source = self.spark.read.schema(schema).parquet(staged)

        try:
            commit = self._merge_staged(base, source, keys, wanted, consumed)
        finally:
            if staged:
                storage.remove(self.spark, staged)
        return self._after(commit)

    def _merge_staged(
        self,
        base: Commit,
        source: DataFrame,
        keys: Sequence[str],
        wanted: T.StructType,
        consumed: tuple[str, int] | None,
    ) -> Commit:
        matched = work_folder(self.spark, "matched")
        try:
            return self._merge_matched(base, source, keys, wanted, consumed, matched)
        finally:
            storage.remove(self.spark, matched)

    def _merge_matched(
        self,
        base: Commit,
        source: DataFrame,
        keys: Sequence[str],
        wanted: T.StructType,
        consumed: tuple[str, int] | None,
        matched: str,
    ) -> Commit:
        touched, updated, known = self._matched_files(base, source, keys, matched)
        grown = Commit(**{**base.__dict__, "schema": wanted.json()})
        if touched:
            parts, new, rows_before = self._rewrite(
                grown,
                touched,
                lambda df: dml.merge(
                    df.select(*self._columns(grown)), source, keys, unique=True, known=known
                ),
            )
        else:
            fitted = conform(source, wanted)
            new = self._write(fitted, base.partition_by, base.cluster_by)
            parts, rows_before = [*base.parts, new], 0
        commit = self._next(
            grown,
            "MERGE",
            parts,
            added=new.tag,
            parameters={"on": ",".join(keys)},
            metrics={
                "updated": updated,
                "inserted": new.rows - rows_before,
                "files_rewritten": len(touched),
                "files_written": new.files,
            },
            consumed={**base.consumed, consumed[0]: consumed[1]} if consumed else base.consumed,
        )
        return self._publish(commit)

    def _merge_columns(self, source: DataFrame, wanted: T.StructType, grow: bool) -> DataFrame:
        names = {c.lower(): c for c in source.columns}
        lacking = [f.name for f in wanted.fields if f.name.lower() not in names]
        if lacking and not grow:
            raise SchemaMismatch(f"the source lacks columns: {lacking}")
        have = [f for f in wanted.fields if f.name.lower() in names]
        picked = source.select(*[quoted(names[f.name.lower()]).alias(f.name) for f in have])
        return conform(picked, T.StructType(have))

    def _matched_files(
        self, base: Commit, source: DataFrame, keys: Sequence[str], folder: str
    ) -> tuple[list[str], int, DataFrame | None]:
        """Files with matched rows, the number of those rows, and the keys of the source that matched.

        Several matches are an error. The source is folded to one row per key before the join, and
        only the key and an eight-byte file id of each target row take part in it; the matches are
        written to ``folder``, so that the target need not be asked for its keys again. Where the source is
        too large to be broadcast but small beside the table, a Bloom filter of its keys drops most other
        rows before they are shuffled. Two files
        with one id would both be rewritten, which changes nothing in the result.
        """
        if not base.parts:
            return [], 0, None
        per_key = (
            source.filter(all_set(keys))
            .groupBy(*[quoted(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("__n"))
        )
        target = self._merge_candidates(base, source, keys[0])
        if target is None:
            return [], 0, None
        rows = target.filter(all_set(keys)).select(
            *[quoted(k).alias(k) for k in keys],
            F.expr(f"xxhash64({OWN_FILE})").alias("__file"),
        )
        count = source.count() if self._beyond_broadcast(source) else 0
        if base.rows > 4 * count and joins.can_filter(source, keys, count):
            rows = joins.likely_keys(rows, source, keys, count)
        others = {k: f"__k{i}" for i, k in enumerate(keys)}
        matches = rows.join(per_key.withColumnsRenamed(others), same_key(keys, others.values()))
        matches = matches.select(*[quoted(k) for k in keys], "__file", "__n")
        matches = matches.groupBy(*[quoted(k) for k in keys], "__file").agg(
            F.max("__n").alias("__n"), F.count(F.lit(1)).alias("__rows")
        )
        with self._sized(matches, base.bytes // 4):  # of each row only the key and a file id
            matches.write.parquet(folder)
        matches = self.spark.read.schema(matches.schema).parquet(folder)
        hits = matches.groupBy("__file").agg(F.sum("__rows").alias("matched"), F.max("__n").alias("most"))
        files = self._manifest(base.parts).select("path", F.xxhash64("path").alias("__file"))
        found = files.join(hits, "__file").select("path", "__file", "matched", "most")
        found = found.collect()
        if any(r.most > 1 for r in found):
            raise MergeCardinalityError(f"a target row matches several source rows on {list(keys)}")
        updated = sum({r["__file"]: r.matched for r in found}.values())
        return [r.path for r in found], updated, matches.select(*[quoted(k) for k in keys])

    def _beyond_broadcast(self, source: DataFrame) -> bool:
        """Whether a source is so large that a join with it shuffles the other side."""
        most = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return _scanned_bytes(source) > most

    def _merge_candidates(self, base: Commit, source: DataFrame, key: str) -> DataFrame | None:
        """The target's files, less those whose key range the source does not reach."""
        if base.cluster_by != key:
            return self._snapshot(base)
        low, high = source.agg(F.min(quoted(key)), F.max(quoted(key))).first()
        if low is None:
            return None
        files = self._names(self._matching_files(base, low, high))
        return self._open(base.struct, [], files, partition_by=base.partition_by, marked=base.marked) if files else None

    def restore(self, version: int) -> Commit:
        """A new version with the files, schema and layout of an old one; no data is rewritten."""
        old, base = self.commit(version), self.commit()
        return self._publish(
            self._next(
                base,
                "RESTORE",
                old.parts,
                schema=old.schema,
                partition_by=old.partition_by,
                cluster_by=old.cluster_by,
                loaded=old.loaded,
                consumed=old.consumed,
                parameters={"version": str(version)},
            )
        )

    # ---- names --------------------------------------------------------------------------

    def publish_view(self, view: str, files: str) -> None:
        """Let SQL in any session read the newest version under the name ``view``.

        ``files`` becomes an external table over all folders of this table, partitioned by folder;
        the view takes those of the version, without the files taken out of them.
        """
        commit = self.commit()
        struct = commit.struct
        parts = [struct[c] for c in commit.partition_by]
        rest = [f for f in struct.fields if f.name not in set(commit.partition_by)]
        named = lambda f: f"{_name(f.name)} {f.dataType.simpleString()}"
        columns = ", ".join([*map(named, rest), f"{TAG} string", *map(named, parts)])
        layout = ", ".join([TAG, *[_name(f.name) for f in parts]])
        conf, setting = self.spark.conf, "spark.sql.hive.manageFilesourcePartitions"
        before = conf.get(setting)
        conf.set(setting, "false")  # folders are found when the table is read
        try:
            data = self._place(commit.partition_by)
            storage.make_folder(self.spark, data)
            self.spark.sql(f"DROP TABLE IF EXISTS {files}")
            self.spark.sql(
                f"CREATE TABLE {files} ({columns}) USING parquet PARTITIONED BY ({layout}) LOCATION '{data}'"
            )
        finally:
            conf.set(setting, before)
        subsets = [p for p in commit.parts if not p.tag]
        tags = [p.tag for p in commit.parts if p.tag] + [t for p in subsets for t in p.folders]
        gone = " ".join(
            f"LEFT ANTI JOIN parquet.`{self.root}/manifests/{p.removed}` AS g{i} ON __file = g{i}.path"
            for i, p in enumerate(subsets) if p.removed
        )
        wanted = ", ".join(f"'{t}'" for t in tags)
        texts = set(commit.marked)

        def picked(f: T.StructField) -> str:
            name, mark = _name(f.name), r"\u0001"
            own = f"CASE WHEN startswith({name}, '{mark}') THEN substring({name}, 2) ELSE {name} END AS {name}"
            return own if f.name in texts else name

        self.spark.sql(
            f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(map(picked, struct.fields))} "
            f"FROM (SELECT *, {OWN_FILE} AS __file FROM {files} WHERE {f'{TAG} IN ({wanted})' if tags else 'false'}) {gone}"
        )

    # ---- layout -------------------------------------------------------------------------

    def compact(self, at_least: int = 1) -> Commit | None:
        """Put small files together; rows do not change. No new version when there is nothing to do.

        Small is below a quarter of the table's file size. Only partitions with several small files
        are rewritten, and only if all of them together hold ``at_least`` files too many. Without
        partitions the files are packed by ``coalesce``, which moves no rows between tasks. On a
        clustered table the packed files are ordered by its key and count as clustered.
        """
        base = self.commit()
        if base.files < 2:
            return None
        inside = F.regexp_replace("path", f"^{TAG}=[^/]*/|[^/]*$", "")
        small = (
            self._manifest(base.parts)
            .filter(F.col("bytes") < self.target_file_bytes // 4)
            .withColumn("inside", inside)
        )
        several = small.groupBy("inside").count().filter("count > 1")
        picked = small.join(several, "inside", "left_semi").select("path", "bytes", "rows", "inside").collect()
        if len(picked) - len({r.inside for r in picked}) < max(1, at_least):
            return None
        count = max(1, math.ceil(sum(r.bytes for r in picked) / self.target_file_bytes))

        def pack(df: DataFrame) -> DataFrame:
            if base.cluster_by:
                return self._ordered(df, base, base.cluster_by, self._ranges(base, picked))
            rows = df.select(*self._columns(base))
            return rows if base.partition_by else rows.coalesce(count)

        ordered = bool(base.cluster_by)
        parts, new, _ = self._rewrite(
            base, [r.path for r in picked], pack, laid_out=ordered, clustered=ordered
        )
        if not base.partition_by and new.files >= len(picked):
            return None
        return self._publish(
            self._next(
                base,
                "COMPACT",
                parts,
                added=new.tag,
                metrics={"files_rewritten": len(picked), "files_written": new.files},
            )
        )

    def cluster(self, by: str, *, full: bool = False) -> Commit | None:
        """Order rows by one key across files, so each file covers a small key range.

        Files not yet ordered by this key are written as one more run of ordered files. Runs are put
        together when a larger one is less than twice the size of all smaller ones, so their number,
        and with it the files that hold one key, grows with the logarithm of the table at most;
        ``full`` orders everything anew. The range cut also uses the row's place in its file, so one
        key with very many rows spreads over many tasks.
        """
        base = self.commit()
        if by in base.partition_by or by not in base.struct.fieldNames():
            raise ValueError(f"cannot cluster by {by}")
        if not base.parts:
            return None
        done = F.col("clustered") & (F.coalesce(F.col("key"), F.lit("")) == by)
        run = F.when(done, F.regexp_extract("path", f"^{TAG}=([^/]*)", 1))
        files = self._manifest(base.parts).withColumn("run", run)
        runs = {r.run: r.bytes for r in files.groupBy("run").agg(F.sum("bytes").alias("bytes")).collect()}
        fresh = runs.pop(None, 0)
        ordered = sorted(runs, key=lambda r: runs[r])
        merged = len(ordered) if full else 0
        total = fresh
        for i, name in enumerate(ordered):
            if total and runs[name] < 2 * total:
                merged = i + 1
            total += runs[name]
        if not fresh and merged < (1 if full else 2):
            return None
        picked = files.filter(F.col("run").isNull() | F.col("run").isin(ordered[:merged]))
        picked = picked.select("path", "bytes", "rows").collect()
        count = self._ranges(base, picked)
        base.cluster_by = by
        parts, new, _ = self._rewrite(
            base,
            [r.path for r in picked],
            lambda df: self._ordered(df, base, by, count),
            laid_out=True,
            clustered=True,
        )
        return self._publish(
            self._next(
                base,
                "CLUSTER",
                parts,
                added=new.tag,
                parameters={"by": by},
                metrics={"files_rewritten": len(picked), "files_written": new.files},
            )
        )

    def _ranges(self, base: Commit, files: Sequence) -> int:
        """Ranges to order the rows of ``files`` in: files of the table's size, but fewer rows to each
        where these, unpacked for sorting, would take more than twice that."""
        unpacked = sum(r.rows for r in files) * _row_bytes(base.struct) / 2
        return max(1, math.ceil(max(sum(r.bytes for r in files), unpacked) / self.target_file_bytes))

    def _ordered(self, df: DataFrame, base: Commit, by: str, count: int) -> DataFrame:
        """Rows of opened files in ``count`` ranges of partition and key, ordered within each."""
        partitions = [quoted(c) for c in base.partition_by]
        salt = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("__salt")
        return (
            df.select(*self._columns(base), salt)
            .repartitionByRange(count, *partitions, quoted(by), "__salt")
            .drop("__salt")
            .sortWithinPartitions(*partitions, quoted(by))
        )
