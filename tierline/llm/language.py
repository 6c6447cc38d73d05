"""Language of a text by n-gram filters: bit-sliced Bloom filters of all languages at once.

Every slot of the filter holds a bitmask with a bit for each language. The masks at an n-gram's
slots, taken together bit by bit, give all the languages that have the n-gram. A text's n-grams are
counted for each language, the share that false positives make up is taken off, and the language
with the largest share is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import chunks, documents, map_arrow, mix, signed, stage, texts

SIZE = 4
#: Slots of the filter (8 MB for 64 languages) and slots an n-gram has.
SLOTS, HASHES = 1 << 20, 3
#: An n-gram is a language's if at least this share of its n-grams are this one, and it is at
#: least this large a part of the share it has in the language that has it most. So a language
#: has at most 1 / LEAST_SHARE n-grams, however much text there is.
LEAST_SHARE, LEAST_PART = 1e-5, 0.15
UNKNOWN = "und"
_HELD_BACK = 2_000_000
_K = mix(np.arange(11, 11 + SIZE, dtype=np.uint64)) | np.uint64(1)
_SALTS = mix(np.arange(101, 101 + HASHES, dtype=np.uint64))
_letter: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _letter:
        _letter.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letter[0][points]


def ngrams(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of letters (lower-cased, with the limits of words) and where each row's begin."""
    low = [x.lower() for x in rows]
    points = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    limits = np.cumsum([0] + [len(x) + 1 for x in low])
    is_in = _is_letter(points)
    first = is_in & ~np.concatenate(([False], is_in[:-1])) if len(points) else is_in
    spots = np.flatnonzero(is_in)
    word = np.cumsum(first)[spots]
    spread = np.zeros(len(spots) + (int(word[-1]) if len(word) else 0) + 2 * SIZE, np.uint64)
    spread[np.arange(len(spots)) + word] = points[spots]
    starts = np.flatnonzero(first)
    lengths = np.bincount(word - 1, minlength=len(starts)).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
    at = np.cumsum(lengths + 1) - (lengths + 1)
    each = np.maximum(1, lengths + 2 - SIZE + 1)
    ends = np.cumsum(each)
    places = np.arange(int(ends[-1]) if len(starts) else 0) + np.repeat(at - (ends - each), each)
    total = np.zeros(len(places), np.uint64)
    inside = np.repeat(np.minimum(lengths + 2, SIZE), each)
    for j in range(SIZE):
        total += np.where(inside > j, (spread[places + j] + np.uint64(1)) * _K[j], np.uint64(0))
    return mix(total), np.concatenate(([0], ends))[np.searchsorted(starts, limits)]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, places = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(places, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for name in list(held):
            keys, counts = _merged(held.pop(name))
            columns = [pa.array([name] * len(keys), pa.string()), pa.array(signed(keys)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "g", "n"])

    for batch in batches:
        names = batch.column(1).to_pylist()
        column = texts(batch)
        for first, last, _, _ in chunks(column):
            found, at = ngrams(column[first:last].to_pylist())
            own: dict[str, list] = {}
            for i in range(last - first):
                own.setdefault(names[first + i], []).append(found[at[i] : at[i + 1]])
            for name, parts in own.items():
                held.setdefault(name, []).append(np.unique(np.concatenate(parts), return_counts=True))
            if sum(len(k) for parts in held.values() for k, _ in parts) > _HELD_BACK:
                for name in held:
                    held[name] = [_merged(held[name])]
                if sum(len(parts[0][0]) for parts in held.values()) > _HELD_BACK // 2:
                    yield from flush()
    yield from flush()


def _slots(grams: np.ndarray) -> Iterator[np.ndarray]:
    for i in range(HASHES):
        yield (mix(grams + _SALTS[i]) >> np.uint64(44)).astype(np.int64)


def _to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = batch.column(0).to_numpy().view(np.uint64)
        number = batch.column(1).to_numpy()
        slots = np.concatenate(list(_slots(grams)))
        bits = np.tile(np.uint64(1) << (number % 64).astype(np.uint64), HASHES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots), pa.array(np.tile(number // 64, HASHES)), pa.array(signed(bits))], ["slot", "word", "bits"]
        )


class Filters:
    """Names of the languages in the order of their bits, the most used one, masks and false-positive rates."""

    def __init__(self, names: list[str], usual: int, masks: np.ndarray):
        self.names, self.usual, self.masks = names, usual, masks
        full = [np.mean((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(names))]
        self.false = np.array(full) ** HASHES

    def shares(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Per row and language the corrected share of the n-grams that the language has."""
        found = None
        for slot in _slots(grams):
            found = self.masks[slot] if found is None else found & self.masks[slot]
        sizes = np.maximum(1, np.diff(at))
        result = np.zeros((len(at) - 1, len(self.names)))
        for i in range(len(self.names)):
            hits = np.concatenate(([0], np.cumsum((found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1))))
            result[:, i] = ((hits[at[1:]] - hits[at[:-1]]) / sizes - self.false[i]) / (1 - self.false[i])
        return np.maximum(result, 0)


def fit(labelled: DataFrame) -> Filters | None:
    """Filters from ``text, lang`` of all rows with a ``lang``; None if no text has a letter."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = map_arrow(rows.filter("lang is not null"), _count, "lang string, g bigint, n bigint")
    counts = stage(counts.groupBy("lang", "g").agg(F.sum("n").alias("n")), "ngrams")
    # One row for each language.
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    if not totals:
        return None
    names = sorted(totals)
    sizes = counts.sparkSession.createDataFrame([(x, float(totals[x]), i) for i, x in enumerate(names)], "l string, total double, number bigint")
    share = counts.join(F.broadcast(sizes), F.col("lang") == F.col("l")).withColumn("share", F.col("n") / F.col("total"))
    share = share.filter(F.col("share") >= LEAST_SHARE).select("g", "number", "share")
    most = share.groupBy(F.col("g").alias("h")).agg(F.max("share").alias("most"))
    own = share.join(most, F.col("g") == F.col("h")).filter(F.col("share") >= LEAST_PART * F.col("most"))
    slots = map_arrow(own.select("g", "number"), _to_slots, "slot bigint, word bigint, bits bigint")
    masks = np.zeros((SLOTS, (len(names) + 63) // 64), np.uint64)
    # At most a row for each slot and 64 languages.
    for part in slots.groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow().to_batches():
        place = (part.column(0).to_numpy(), part.column(1).to_numpy())
        masks[place] = part.column(2).to_numpy().view(np.uint64)
    return Filters(names, names.index(max(names, key=lambda x: totals[x])), masks)


def _predict(filters: Filters | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            column = texts(batch)
            for first, last, _, _ in chunks(column):
                found, at = ngrams(column[first:last].to_pylist())
                empty = np.diff(at) == 0
                if filters is None:
                    names += [UNKNOWN] * len(empty)
                    scores += [0.0] * len(empty)
                    continue
                shares = filters.shares(found, at)
                total = shares.sum(axis=1)
                best = np.where(total > 0, shares.argmax(axis=1), filters.usual)
                score = np.where(total > 0, shares.max(axis=1) / np.maximum(total, 1e-9), 0.0)
                names += [UNKNOWN if e else filters.names[b] for e, b in zip(empty, best)]
                scores += np.where(empty, 0.0, score).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return run


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("bigint").cast("string")) % folds


def languages(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, lang_pred, score``.

    Learns from ``text`` and ``lang`` of all rows outside the held-out fold (the checksum of the id
    as text is ``held_out`` modulo ``folds``; rows without ``doc_id`` are neither held out nor
    learnt from). The score is the language's part of all languages' shares. A null text, or one
    without a letter, is ``und`` with score 0, and so is every text where there is nothing to learn
    from; a text whose n-grams no language has gets the most used language, with score 0. Repeated
    rows get the same result each, and other columns are not looked at.
    """
    kept = F.coalesce(fold(F.col("doc_id"), folds) != held_out, F.lit(False))
    filters = fit(docs.filter(kept).select("text", "lang"))
    found = map_arrow(documents(docs), _predict(filters), "doc_id bigint, lang_pred string, score double")
    is_held_out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    return found.select("doc_id", is_held_out.alias("held_out"), "lang_pred", "score")
