"""Helpers of the text operators: staged tables and hashing of words in bulk."""

from __future__ import annotations

import ctypes
import io
import os
import re
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import work_folder
from tierline.sources import storage

#: Texts are worked on in pieces of about this many bytes, always of whole texts.
CHUNK_BYTES = 1 << 20
#: Rows go to the Python workers and back in batches of about this many bytes, always of whole rows.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_BASE = 0x9E3779B97F4A7C15


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that lost executors cost no recomputation."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ship(spark: SparkSession) -> None:
    """Once per application, send this library's modules to the executors, which need not have it."""
    sc = spark.sparkContext
    if getattr(sc, "_tierline_sent", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "tierline")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
    path = f"{work_folder(spark, 'modules')}/tierline.zip"
    storage.create_bytes(spark, path, packed.getvalue())
    sc.addPyFile(path)
    sc._tierline_sent = True


def _bytes(setting: str) -> float:
    """A size as Spark's settings give it; no limit (0 or less) is infinite."""
    size, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(size) * 1024 ** " kmgtp".index(unit or " ") if int(size) > 0 else float("inf")


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this library at hand in the tasks, in batches of about BATCH_BYTES if the session
    does not ask for smaller ones. A worker that waits for its next task gives back the memory that Arrow
    and the C library keep for reuse, which other stages of the same executor need."""
    spark = df.sparkSession
    _ship(spark)
    if _bytes(spark.conf.get(_BATCH_CONF, "64m")) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
        if trim:
            trim(0)

    return df.mapInArrow(task, schema)


def fresh(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` as the operators take them."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def byte_class(allowed: str, beyond_ascii: bool) -> np.ndarray:
    """Which bytes belong to words: the ASCII characters of ``allowed`` and, if so, all others."""
    inside = np.zeros(256, bool)
    inside[[ord(c) for c in allowed]] = True
    inside[128:] = beyond_ascii
    return inside


#: Everything but ASCII white space.
NOT_SPACE = byte_class("".join(chr(i) for i in range(128) if i not in (9, 10, 11, 12, 13, 32)), True)
#: Digits, lower-case letters and everything beyond ASCII.
WORD = byte_class("0123456789abcdefghijklmnopqrstuvwxyz", True)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        inverse = pow(_BASE | 1, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers[:] = [
                np.cumprod(np.full(size, base, np.uint64)) for base in (_BASE | 1, inverse)
            ]
    return _powers


def texts(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """A string column, null as empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
    return pc.fill_null(column, "")


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about CHUNK_BYTES: first row, row after the last, bytes, row limits in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        limits = offsets[first : last + 1]
        yield first, last, data[limits[0] : limits[-1]], limits - limits[0]
        first = last


def pieces(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[pa.RecordBatch]:
    """All rows of the batches, in order, in batches of about CHUNK_BYTES of text, for work on Python strings."""
    for batch in batches:
        for first, last, _, _ in chunks(texts(batch, name)):
            yield batch.slice(first, last - first)


def words(data: np.ndarray, limits: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased) of a chunk, and for each row limit the words before it."""
    low = LOWER[data]
    is_in = inside[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[limits] = True
    before = np.concatenate(([False], is_in[:-1])) if len(data) else is_in
    after = np.concatenate((is_in[1:], [False])) if len(data) else is_in
    starts = np.flatnonzero(is_in & (~before | edge[:-1]))
    ends = np.flatnonzero(is_in & (~after | edge[1:])) + 1
    power, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[low] * power[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, limits)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
