"""Spelling variants: words one edit apart, found by blocked products of letter counts.

One inserted or deleted letter changes one letter count by one, a replaced one two counts, so the
squared distance of the counts is at most two. Distances of whole blocks of words come from one
matrix product; only pairs at most two apart, of the same or of neighbouring lengths, have their
letters compared. An edit lies in the first or in the second half of a word, so words one edit apart
agree in one of their halves, and a block holds the words of two neighbouring lengths that share
one. Blocks are cut into tiles, so the memory of a task does not grow with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import same_key
from tierline.llm.common import documents, map_arrow, stage

#: Fewest letters of a word, and fewest times it must occur.
LEAST_CHARS, LEAST_COUNT = 5, 3
#: Words of a tile, at most so many letters together.
TILE, TILE_CHARS = 1024, 1 << 20
#: Rows of one side of a matrix product.
SIDE = 512
#: Kinds of letters that are counted apart: all of a-z and U+00C0 to U+00FF, others share one.
KINDS = 128
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLOCK = ("m", "side", "key")


def word_counts(docs: DataFrame, *, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, thinned: int | None = None) -> DataFrame:
    """``word, n``: the runs of letters of all texts with A-Z in lower case, and how often they occur.

    With ``thinned`` a run loses one letter where that number divides the checksum of
    ``<doc_id>:<run>`` (a null ``doc_id`` counts as empty): misspellings that are known.
    """
    # A shorter run cannot give a longer word.
    runs = F.regexp_extract_all("text", F.lit(rf"[A-Za-zÀ-ÿ]{{{least_chars},}}"), F.lit(0))
    rows = documents(docs).select("doc_id", F.explode(runs).alias("run"))
    ascii_only = F.length("run") == F.octet_length("run")
    low = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    rows = rows.select("doc_id", low.alias("word"))
    if thinned:
        named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
        rows = rows.select("word", F.crc32(named.cast("binary")).alias("h"))
        at, size = (F.col("h") % F.length("word")).cast("int"), F.length("word")
        word = F.col("word")
        shorter = F.concat(word.substr(F.lit(1), at), word.substr(at + 2, size))
        rows = rows.select(F.when(F.col("h") % thinned == 0, shorter).otherwise(word).alias("word"))
        rows = rows.filter(F.length("word") >= least_chars)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def blocks(words: DataFrame) -> DataFrame:
    """``m, side, key, word, n``: each word once for each half it may share, with words of ``m`` and of
    ``m + 1`` letters. ``side`` is 0 where the first ``m // 2`` letters are shared, 1 where the last ones are."""
    size = F.length("word")
    first, word = F.lit(1), F.col("word")

    def shared(m):
        half = F.floor(m / 2).cast("int")
        rest = (m - half).cast("int")
        parts = word.substr(first, half), word.substr((size - rest + 1).cast("int"), rest)
        return [F.struct(m.cast("int").alias("m"), F.lit(s).alias("side"), F.xxhash64(p).alias("key")) for s, p in enumerate(parts)]

    own = F.array(*shared(size), *shared(size - 1))
    return words.select("word", "n", F.explode(own).alias("b")).filter("b.m > 0").select("b.*", "word", "n")


def tiles(rows: DataFrame) -> DataFrame:
    """Blocks that can have a pair, cut into tiles: each word once for each pair (``i``, ``j``) of tiles it is in."""
    short = F.length("word") == F.col("m")
    sizes = rows.groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("size"), F.count_if(short).alias("short"))
    sizes = sizes.filter("size > 1 and short > 0").drop("short").withColumnsRenamed({c: f"b_{c}" for c in _BLOCK})
    rows = rows.join(sizes, same_key(_BLOCK, [f"b_{c}" for c in _BLOCK]))
    room = F.greatest(F.lit(2), F.least(F.lit(TILE), F.floor(TILE_CHARS / F.col("m"))))
    rows = rows.select(*_BLOCK, "word", "n", F.ceil(F.col("size") / room).cast("int").alias("tiles"))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pair = [F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")]
    return rows.select(*_BLOCK, *pair, "tile", "word", "n")


class _Pack:
    """Some whole groups (pairs of tiles), and the near pairs in them."""

    def __init__(self, columns: dict[str, np.ndarray], words: list[str], group: np.ndarray):
        self.words, self.group = words, group
        self.m, self.side, self.tile, self.n = (columns[c] for c in ("m", "side", "tile", "n"))
        self.alone = columns["i"] == columns["j"]
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(self.length)
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)

    def counts(self) -> np.ndarray:
        rows = np.repeat(np.arange(len(self.words)), self.length)
        kinds = (self.letters % 192 % KINDS).astype(np.int64)
        counts = np.bincount(rows * KINDS + kinds, minlength=len(self.words) * KINDS).reshape(-1, KINDS)
        # Single precision is exact up to 2**24, and no sum of squares is larger than a squared length.
        return counts.astype(np.float32 if int(self.length.max()) < 1 << 11 else np.float64)

    def close(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows of a group whose letter counts are at most two apart, the shorter word first."""
        counts = self.counts()
        squares = (counts * counts).sum(axis=1)
        short = np.flatnonzero(self.length == self.m)
        for at in range(0, len(short), SIDE):
            some = short[at : at + SIDE]
            for to in range(0, len(counts), SIDE):
                part = counts[to : to + SIDE]
                far = squares[some][:, None] + squares[to : to + SIDE] - 2 * (counts[some] @ part.T)
                x, y = np.nonzero(far <= 2)
                x, y = some[x], y + to
                fits = (self.group[x] == self.group[y]) & (x != y) & (self.alone[x] | (self.tile[x] != self.tile[y]))
                if fits.any():
                    yield x[fits], y[fits]

    def _agreeing(self, x: np.ndarray, y: np.ndarray, backwards: bool) -> np.ndarray:
        """How many letters each pair of words has in common from the start, or from the end."""
        size = np.minimum(self.length[x], self.length[y])
        step = np.arange(int(size.max()))
        last = len(self.letters) - 1
        if backwards:
            a, b = (self.ends[rows][:, None] - 1 - step for rows in (x, y))
        else:
            a, b = ((self.ends - self.length)[rows][:, None] + step for rows in (x, y))
        same = self.letters[np.clip(a, 0, last)] == self.letters[np.clip(b, 0, last)]
        same &= step < size[:, None]
        return np.logical_and.accumulate(same, axis=1).sum(axis=1)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of words one edit apart, in both directions, each pair in one block only."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        room = max(1, TILE_CHARS // max(1, int(self.length.max())))
        for rows, others in self.close():
            for at in range(0, len(rows), room):
                x, y = rows[at : at + room], others[at : at + room]
                start, end = self._agreeing(x, y, False), self._agreeing(x, y, True)
                longer = self.length[y] - self.length[x]
                # What both agree in at the start also makes a block of the other side.
                own = (self.side[x] == 0) | (start < self.m[x] // 2)
                fits = own & (start + end >= self.m[x] - (longer == 0))
                x, y, longer = x[fits], y[fits], longer[fits]
                found += [(x, y), (y[longer == 1], x[longer == 1])]
        return tuple(np.concatenate(side) for side in zip(*found))


_NUMBERS = ("m", "side", "key", "i", "j", "tile", "n")


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of sorted rows, a few groups at a time."""
    held: dict[str, np.ndarray] = {c: np.zeros(0, np.int64) for c in _NUMBERS}
    words: list[str] = []

    def packs(whole: bool) -> Iterator[pa.RecordBatch]:
        """What is held, in packs of whole groups; the last group stays unless all are ``whole``."""
        nonlocal held, words
        if not words:
            return
        new = np.zeros(len(words), bool)
        for c in ("m", "side", "key", "i", "j"):
            new[1:] |= held[c][1:] != held[c][:-1]
        limits = [0, *np.flatnonzero(new).tolist()]
        if whole:
            limits.append(len(words))
        chars = np.concatenate(([0], np.cumsum([len(w) for w in words])))
        group = np.cumsum(new)
        first = 0
        for here, after in zip(limits, [*limits[1:], None]):
            full = after is None or after - first > SIDE or chars[after] - chars[first] > TILE_CHARS
            if full and here > first:
                pack = _Pack({c: v[first:here] for c, v in held.items()}, words[first:here], group[first:here])
                x, y = pack.near()
                if len(x):
                    names = pa.array(pack.words, pa.string())
                    columns = [names.take(pa.array(x)), names.take(pa.array(y)), pa.array(pack.n[y])]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])
                first = here
        held = {c: v[first:] for c, v in held.items()}
        words = words[first:]

    for batch in batches:
        for c in _NUMBERS:
            column = batch.column(batch.schema.get_field_index(c))
            held[c] = np.concatenate((held[c], column.to_numpy(zero_copy_only=False).astype(np.int64)))
        words += batch.column(batch.schema.get_field_index("word")).to_pylist()
        yield from packs(whole=False)
    yield from packs(whole=True)


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: both directions of every pair of ``words`` (``word, n``) that one inserted,
    deleted or replaced letter sets apart."""
    rows = tiles(blocks(words))
    group = [*_BLOCK, "i", "j"]
    rows = rows.repartition(*group).sortWithinPartitions(*group)
    return map_arrow(rows, _near, "word string, near string, near_n bigint")


def _followed(forms: DataFrame) -> DataFrame:
    """``word, root``: where the chain of forms of each word that has one ends. Chains halve each round."""
    steps = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("w"), F.col("root").alias("ahead"))
        steps = steps.join(ahead, F.col("root") == F.col("w"), "left")
        steps = steps.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved"))
        steps = stage(steps, "roots")
        if steps.filter("moved").isEmpty():
            return steps.drop("moved")


def variants(words: DataFrame) -> DataFrame:
    """Per row of ``words`` (``word`` once each, ``n``): ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word that occurs most often (of those the first in code-point order), if it
    does so at least twice as often as the word, else null; ``root`` is where following forms ends,
    the word itself if it has none. An empty table gives no rows.
    """
    words = stage(words.select("word", F.col("n").cast("bigint").alias("n")), "words")
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    pairs = near_pairs(words).select("word", number.alias("n"), "near", "near_n")
    rows = words.select("word", "n", text.alias("near"), number.alias("near_n")).unionByName(pairs)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))))
    counted = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    often = -F.col("best.n") >= 2 * F.col("n")
    forms = counted.select("word", "n", "n_near", F.when(often, F.col("best.word")).alias("form"), F.when(often, -F.col("best.n")).alias("form_n"))
    forms = stage(forms, "forms")
    roots = _followed(forms).withColumnRenamed("word", "w")
    found = forms.join(roots, F.col("word") == F.col("w"), "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, *, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, thinned: int | None = None) -> DataFrame:
    """``variants`` of the words of ``docs`` (``doc_id, text``).

    Null and empty texts have no words; repeated rows count each; a null ``doc_id`` is one more
    document; other columns are not looked at, and an empty table gives no rows.
    """
    return variants(word_counts(docs, least_chars=least_chars, least_count=least_count, thinned=thinned))
