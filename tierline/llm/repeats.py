"""Passages that repeat across documents, found by hashing their sentences or lines.

Units are normalised (lower case, white space folded) and grouped by digest over all documents.
The occurrence that comes first, by document and place, is kept. Runs of later occurrences that
together have enough words are removed, with their places in the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.columns import same_key
from tierline.llm.common import chunks, fresh, map_arrow, stage, texts

#: A unit ends with its line or, as a sentence, where white space follows a full stop or the like.
UNITS = {
    "sentence": re.compile(r"(?=\S)[^\n.!?]*+(?:[.!?]++(?=\S)[^\n.!?]*+)*+[.!?]*+"),
    "line": re.compile(r"\S[^\n]*+"),
}
#: Words that a run of repeated units must have together to be removed.
LEAST_WORDS = 25
_LAST = (1 << 63) - 1


def _units(pattern: re.Pattern):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, column = batch.column(0), batch.column(1), texts(batch)
            for first, last, _, _ in chunks(column):
                row, number, start, end, size, digests = [], [], [], [], [], []
                for i, text in enumerate(column[first:last].to_pylist()):
                    for n, m in enumerate(pattern.finditer(text)):
                        words = m[0].lower().split()
                        row.append(first + i)
                        number.append(n)
                        start.append(m.start())
                        end.append(m.start() + len(m[0].rstrip()))
                        size.append(len(words))
                        digests.append(hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest())
                at = pa.array(row, pa.int64())
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), keys.take(at)]
                    + [pa.array(x, pa.int32()) for x in (number, start, end, size)]
                    + [pa.array(halves[:, k].copy()) for k in range(2)],
                    ["doc_id", "h", "no", "start", "end", "words", "d1", "d2"],
                )

    return run


def repeated_spans(docs: DataFrame, unit: str = "sentence", least_words: int = LEAST_WORDS) -> DataFrame:
    """A row for every passage to remove: ``doc_id, h, start, end, n_words, n_units, first_doc_ids``.

    ``start`` and ``end`` are code points of the original text, ``first_doc_ids`` the documents that
    keep the passage's units, ``h`` a hash of the text. Earlier means a smaller ``doc_id``, then a
    smaller place; documents without id come last. A unit repeated within its document counts, too.
    Rows that repeat a ``doc_id`` and its text are one document. Null and empty texts have no units;
    other columns are not looked at; an empty table gives no rows.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("h"),
        F.col("text").cast("string").alias("text"),
    )
    shape = "doc_id bigint, h bigint, no int, start int, end int, words int, d1 bigint, d2 bigint"
    units = stage(map_arrow(source, _units(UNITS[unit]), shape), "units")
    rank = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.col("h"), F.col("start"))
    groups = units.groupBy(F.col("d1").alias("k1"), F.col("d2").alias("k2")).agg(F.min(rank).alias("keep"), F.count("*").alias("n"))
    groups = groups.filter("n > 1").drop("n")
    later = units.join(groups, same_key(["d1", "d2"], ["k1", "k2"])).filter(rank != F.col("keep"))
    later = later.select("doc_id", "h", "no", "start", "end", "words", F.col("keep.doc").alias("kept")).distinct()
    in_document = Window.partitionBy("doc_id", "h").orderBy("no")
    runs = later.withColumn("run", F.col("no") - F.row_number().over(in_document))
    spans = runs.groupBy("doc_id", "h", "run").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.sum("words").alias("n_words"),
        F.count("*").alias("n_units"),
        F.sort_array(F.collect_set(F.when(F.col("kept") < _LAST, F.col("kept")))).alias("first_doc_ids"),
    )
    return spans.filter(F.col("n_words") >= least_words).drop("run")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``repeated_spans`` of whole lines: every later occurrence of a line, however short it is."""
    return repeated_spans(docs, unit="line", least_words=1)


def without_repeats(docs: DataFrame, unit: str = "sentence", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the passages taken out of ``text``, and the spans taken as the column ``removed``.

    What was around a passage is joined as it is. All rows and columns stay.
    """
    spans = repeated_spans(docs, unit, least_words)
    lists = spans.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))
    key, ids, removed = fresh("h", docs), fresh("spans_doc_id", docs), fresh("removed", docs)
    rows = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    hashes = fresh("spans_h", rows)
    lists = lists.withColumnsRenamed({"doc_id": ids, "h": hashes, "removed": removed})
    on = F.col("doc_id").cast("bigint").eqNullSafe(F.col(ids)) & (F.col(key) == F.col(hashes))
    rows = rows.join(lists, on, "left").drop(ids, hashes, key)
    edges = F.concat(F.array(F.lit(0)), F.transform(F.col(removed), lambda s: s["end"]))
    ends = F.concat(F.transform(F.col(removed), lambda s: s["start"]), F.array(F.length("text")))
    parts = F.zip_with(edges, ends, lambda a, b: F.substring(F.col("text"), a + 1, b - a))
    return rows.withColumn("text", F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(parts, "")))
