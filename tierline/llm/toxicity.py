"""Toxicity by class-conditional Kneser-Ney models of bytes, over the expressions that tell toxic texts from others.

An expression is a run of eight bytes of a word with its limits, or the whole of a shorter word.
It stands for its last byte behind the seven others, or, at a word's beginning, for each of its
bytes behind those before, so the expressions of a word make up its probability. An expression
counts once for every document it occurs in, however often.

Each class has its own model of order eight: counts less a discount, the rest left to the context
without its first byte, whose counts are continuation counts (different bytes in front; a word's
beginning has none and keeps its counts), down to all 256 bytes alike. A third such model is of both
classes together. All expressions are in the counts of all three, and every one of a text weighs, also
those that no labelled text has: its probability in a class is that of the class's model interpolated
with that of the shared one, by how likely it is that the classes differ in it, given the documents it
occurs in and how often classes differ at all. A text's score is the difference of the two
log-likelihoods over its number of expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import LOWER, WORD, chunks, documents, fresh, map_arrow, signed, stage, texts
from tierline.session import work_folder
from tierline.sources import storage

SIZE = 8
#: Discount of every count; standard deviations from the shared share that make an expression tell.
DISCOUNT, TELLING = 0.75, 4.5
#: Weights in a file of the model, which the tasks map into memory; grams that are worked on at once.
PART = 1 << 20
_BLOCK = 1 << 16
#: Scores per unit in the histogram that the threshold is read from.
STEPS = 2000
_HELD_BACK = 1_000_000
_MASKS = np.array([(1 << 8 * min(n, SIZE)) - 1 for n in range(SIZE + 1)], np.uint64)


def expressions(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All expressions of a chunk as numbers, and for each row limit the expressions before it."""
    low = LOWER[data]
    is_in = WORD[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[limits] = True
    before = np.concatenate(([False], is_in[:-1])) if len(data) else is_in
    first = is_in & (~before | edge[:-1])
    spots = np.flatnonzero(is_in)
    word = np.cumsum(first)[spots]
    # Every word with a zero before it, and zeros after the last one.
    spread = np.zeros(len(spots) + (int(word[-1]) if len(word) else 0) + 2 * SIZE, np.uint8)
    spread[np.arange(len(spots)) + word] = low[spots]
    starts = np.flatnonzero(first)
    n_words = len(starts)
    lengths = np.bincount(word - 1, minlength=n_words).astype(np.int64) if n_words else np.zeros(0, np.int64)
    at = np.cumsum(lengths + 1) - (lengths + 1)
    each = np.maximum(1, lengths + 2 - SIZE + 1)
    ends = np.cumsum(each)
    places = np.arange(int(ends[-1]) if n_words else 0) + np.repeat(at - (ends - each), each)
    runs = np.ndarray(len(spread) - SIZE + 1, "<u8", spread, strides=(1,))
    found = runs[places] & np.repeat(_MASKS[np.minimum(lengths + 2, SIZE)], each)
    before_word = np.concatenate(([0], ends))
    return found, before_word[np.searchsorted(starts, limits)]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, places = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(places, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per class and expression, summed up within the task as far as memory allows; none for
    rows of no class (-1), whose expressions are only listed."""
    held: dict[int, list] = {0: [], 1: [], -1: []}

    def flush(label: int) -> pa.RecordBatch:
        keys, counts = _merged(held[label])
        held[label] = []
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), label, np.int32)), pa.array(signed(keys)), pa.array(counts)], ["toxic", "e", "n"]
        )

    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for first, last, data, limits in chunks(texts(batch)):
            found, at = expressions(data, limits)
            for label in held:
                each = np.unique if label >= 0 else np.asarray
                own = [each(found[at[i] : at[i + 1]]) for i in range(last - first) if labels[first + i] == label]
                if own:
                    keys, counts = np.unique(np.concatenate(own), return_counts=True)
                    held[label].append((keys, counts * (label >= 0)))
                    if sum(len(k) for k, _ in held[label]) > _HELD_BACK:
                        held[label] = [_merged(held[label])]
                        if len(held[label][0][0]) > _HELD_BACK // 2:
                            yield flush(label)
    for label in held:
        if held[label]:
            yield flush(label)


def _counted(labelled: DataFrame, others: DataFrame | None = None) -> tuple[DataFrame, int, int, int]:
    """Documents per expression ``e``, toxic ones ``a`` and others ``b``, also of expressions that only
    ``others`` (``text``) have; their sums and the number of expressions."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.filter("toxic in (0, 1)")
    if others is not None:
        rows = rows.union(others.select(F.col("text").cast("string"), F.lit(-1)))
    counts = map_arrow(rows, _count, "toxic int, e bigint, n bigint")
    toxic, plain = F.col("toxic") == 1, F.col("toxic") == 0
    per = counts.groupBy("e").agg(
        F.sum(F.when(toxic, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(plain, F.col("n")).otherwise(0)).alias("b")
    )
    per = stage(per, "expressions")
    sums = per.agg(F.sum("a"), F.sum("b"), F.count("*")).first()
    return per, *(int(x or 0) for x in sums)


def _tells(in_toxic: int, in_plain: int) -> Column:
    """Whether an expression's shares differ by more than chance."""
    share = in_toxic / max(1, in_toxic + in_plain)
    off = (F.col("a") - (F.col("a") + F.col("b")) * share) / F.sqrt((F.col("a") + F.col("b")) * (share * (1 - share)))
    return F.abs(off) > TELLING


def _arrays(weights: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    kept = weights.select("e", "ratio").toArrow()
    keys = kept["e"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], kept["ratio"].to_numpy()[order]


def fit(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Expressions that tell the classes apart and the log-ratios of their shares, from ``text, toxic``.

    The shares are discounted and interpolated with the shared ones, without contexts; kept for
    comparison, the operator does not use it. Both arrays are empty if a class has no texts.
    """
    per, in_toxic, in_plain, kinds = _counted(labelled)
    if not in_toxic or not in_plain:
        return np.zeros(0, np.uint64), np.zeros(0)
    both = in_toxic + in_plain
    rest = DISCOUNT * kinds / both

    def probability(own: str, total: int) -> Column:
        shared = (F.col("a") + F.col("b")) / float(both)
        return F.greatest(F.col(own) - DISCOUNT, F.lit(0.0)) / float(total) + rest * shared

    return _arrays(per.filter(_tells(in_toxic, in_plain)).withColumn("ratio", F.log(probability("a", in_toxic) / probability("b", in_plain))))


def _first(v: Column, n: int | Column) -> Column:
    """The first ``n`` bytes of a gram, the lowest first."""
    return v.bitwiseAND(F.element_at(F.array(*[F.lit((1 << 8 * k) - 1 if k < SIZE else -1).cast("bigint") for k in range(SIZE + 1)]), F.lit(n) + 1))


def _n_bytes(e: Column) -> Column:
    """The length of an expression: a word's beginning ends with its first zero byte, if there is one."""
    ends = F.lit(SIZE)
    for k in range(SIZE - 1, 0, -1):
        ends = F.when(e.bitwiseAND(F.lit(signed(np.array([0xFF << 8 * k], np.uint64))[0].item())) == 0, k + 1).otherwise(ends)
    return F.when(e.bitwiseAND(F.lit(0xFF)) == 0, ends).otherwise(SIZE)


def _smoothed(counts: np.ndarray, contexts: np.ndarray, lower: np.ndarray | float) -> np.ndarray:
    """Probabilities of grams behind their contexts in each model (a row of ``counts``): the discounted
    count over the context's, and what the discount left times the probability one order ``lower``."""
    own = np.unique(contexts, return_inverse=True)[1]
    total = np.array([np.bincount(own, c)[own] for c in counts])
    kinds = np.array([np.bincount(own, c > 0)[own] for c in counts])
    found = (np.maximum(counts - DISCOUNT, 0) + DISCOUNT * kinds * lower) / np.maximum(total, 1)
    return np.where(total > 0, found, lower)


def _orders(v: np.ndarray, k: np.ndarray, counts: np.ndarray, least: int, most: int, lower: Callable) -> dict[int, tuple]:
    """For each order from ``least`` to ``most``: its grams, their probabilities in each model, and the place
    among them of each ``v`` of so many bytes (``k``).

    Given are all grams that no longer one is counted in, and ``lower``, the probabilities of shorter ones.
    """
    grams, of = {most: v[k == most]}, {most: counts[:, k == most]}
    shorter, place = {}, {most: np.arange(len(grams[most]))}
    for n in range(most - 1, least - 1, -1):
        longer, own = len(grams[n + 1]), k == n
        grams[n], spots = np.unique(np.concatenate((grams[n + 1] >> np.uint64(8), v[own])), return_inverse=True)
        each = np.concatenate((of[n + 1] > 0, counts[:, own]), axis=1)
        of[n] = np.array([np.bincount(spots, c, len(grams[n])) for c in each])
        shorter[n + 1], place[n] = spots[:longer], spots[longer:]
    found = {}
    for n in range(least, most + 1):
        below = lower(grams[n] >> np.uint64(8)) if n == least else own[:, shorter[n]]
        own = _smoothed(of[n], grams[n] & _MASKS[n - 1], below)
        found[n] = grams[n], own, place[n]
    return found


def _short(grams: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams of three bytes in order, their probabilities in each model, and those of grams of two bytes by gram.

    Texts in UTF-8 have about a million different grams of three bytes at most.
    """
    fours = grams.filter("k > 3").select(_ending(4).alias("v"), *[(F.col(c) > 0).cast("bigint").alias(c) for c in ("a", "b")])
    fours = fours.groupBy("v").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    rows = fours.select(F.shiftrightunsigned("v", 8).alias("v"), F.lit(3).alias("k"), "a", "b", F.greatest("a", "b").alias("s"))
    rows = rows.union(grams.filter("k <= 3").select("v", "k", "a", "b", F.col("a") + F.col("b")))
    rows = rows.groupBy("v", "k").agg(*[F.sum(c).alias(c) for c in ("a", "b", "s")]).sort("v", "k").toArrow()
    counts = np.array([rows[c].to_numpy() for c in ("a", "b", "s")], float)
    found = _orders(rows["v"].to_numpy().view(np.uint64), rows["k"].to_numpy(), counts, 1, 3, lambda v: 1 / 256)
    pairs = np.ones((3, 1 << 16))
    pairs[:, found[2][0].astype(np.int64)] = found[2][1]
    return found[3][0], found[3][1], pairs


def _last_bytes(v: np.ndarray, k: np.ndarray, counts: np.ndarray, short: tuple) -> np.ndarray:
    """Log-probabilities in each model of the last byte of grams ``v`` of ``k`` bytes, three or more: all
    grams whose contexts end with some three bytes, so all their contexts and lower orders are there, too."""
    threes, of_threes, _ = short
    found = np.zeros(counts.shape)
    found[:, k == 3] = of_threes[:, np.searchsorted(threes, v[k == 3])]
    for n, (_, own, place) in _orders(v, k, counts, 4, SIZE, lambda x: of_threes[:, np.searchsorted(threes, x)]).items():
        found[:, k == n] = own[:, place]
    return np.log(found)


def _beginnings(v: np.ndarray, k: np.ndarray, logs: np.ndarray, short: tuple) -> np.ndarray:
    """Sums of the log-probabilities of all bytes of grams ``v`` from words' beginnings on, of ``k`` bytes,
    from those ``logs`` of their last bytes; of every gram its own beginnings of four bytes or more are there, too."""
    threes, of_threes, pairs = short
    found = logs + np.log(pairs[:, (v & _MASKS[2]).astype(np.int64)])
    found[:, k > 3] += np.log(of_threes[:, np.searchsorted(threes, v[k > 3] & _MASKS[3])])
    for n in range(5, SIZE + 1):
        at, before = np.flatnonzero(k == n), np.flatnonzero(k == n - 1)
        before = before[np.argsort(v[before])]
        own = before[np.searchsorted(v[before], v[at] & _MASKS[n - 1])]
        found[:, at] = logs[:, at] + found[:, own]
    return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in blocks, those of the same ``part``, by which they are sorted, in one."""
    held, n, enough = [], 0, _BLOCK
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= enough:
            table = pa.Table.from_batches(held).combine_chunks()
            parts = table["part"].to_numpy()
            cut = int(np.searchsorted(parts, parts[-1]))
            if cut:
                yield table.slice(0, cut)
            held, n = table.slice(cut).to_batches(), n - cut
            enough = max(_BLOCK, 2 * n)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


_LOGS = ["la", "lb", "ls"]


def _by_ending(short: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            v, k, a, b = (table[c].to_numpy() for c in ("v", "k", "a", "b"))
            logs = _last_bytes(v.view(np.uint64), k, np.array([a, b, a + b], float), short)
            table = table.drop_columns("part")
            for name, own in zip(_LOGS, logs):
                table = table.append_column(name, pa.array(own))
            yield from table.to_batches(_BLOCK)

    return run


def _by_beginning(short: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            v, k = table["v"].to_numpy().view(np.uint64), table["k"].to_numpy()
            logs = _beginnings(v, k, np.array([table[c].to_numpy() for c in _LOGS]), short)
            whole = (k == SIZE) | (v >> (8 * (k - 1)).astype(np.uint64) == 0)
            columns = [signed(v)[whole], *(table[c].to_numpy()[whole] for c in ("a", "b")), *logs[:, whole]]
            yield from pa.table(dict(zip(["e", "a", "b", *_LOGS], columns))).to_batches(_BLOCK)

    return run


def _ending(n: int) -> Column:
    """The last ``n`` bytes of a gram ``v`` of ``k`` bytes, or all if there are fewer."""
    return F.call_function("shiftrightunsigned", F.col("v"), (F.greatest(F.col("k") - n, F.lit(0)) * 8).cast("int"))


def _together(rows: DataFrame, part: Column) -> DataFrame:
    return rows.withColumn("part", part.cast("int")).repartition("part").sortWithinPartitions("part")


def _drop(tables: list[DataFrame]) -> None:
    """Removes the folders of staged tables that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for table in tables for file in table.inputFiles()}:
        storage.remove(tables[0].sparkSession, folder)


def _likelihoods(per: DataFrame, then: Callable, fields: str) -> tuple[DataFrame, list[DataFrame]]:
    """``per`` with the log-probabilities of each expression's bytes in the toxic model ``la``, in the other
    one ``lb`` and in the shared one ``ls``, as ``then`` gives them on: in the same worker, so that no task
    has two at a time. Also the staged tables behind it.

    A gram of SIZE bytes, or from a word's beginning on, counts as often as it occurs, any other one once
    for every different byte in front of it. Grams whose last byte is behind the same three bytes are worked
    on together; then the beginnings of words with the same first three.
    """
    begins = F.col("e").bitwiseAND(F.lit(0xFF)) == 0
    inner = per.filter(~begins).select(F.col("e").alias("v"), F.lit(SIZE).alias("k"), "a", "b")
    first = per.filter(begins).select("e", "a", "b", F.explode(F.sequence(F.lit(2), _n_bytes(F.col("e")))).alias("k"))
    first = first.select(_first(F.col("e"), F.col("k")).alias("v"), "k", "a", "b")
    first = first.groupBy("v", "k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    first = stage(first, "beginnings")
    grams = inner.union(first)
    short = _short(grams)
    kinds = "a bigint, b bigint, la double, lb double, ls double"
    rows = _together(grams.filter("k >= 3"), _ending(4).bitwiseAND(F.lit(0xFFFFFF)))
    found = stage(map_arrow(rows, _by_ending(short), f"v bigint, k int, {kinds}"), "grams")
    begins = F.col("v").bitwiseAND(F.lit(0xFF)) == 0
    rows = _together(found.filter(begins), F.shiftrightunsigned("v", 8).bitwiseAND(F.lit(0xFFFFFF)))
    inner = found.filter(~begins).select(F.col("v").alias("e"), "a", "b", *_LOGS)
    summed = _by_beginning(short)
    rows = map_arrow(inner, then, fields).union(map_arrow(rows, lambda batches: then(summed(batches)), fields))
    return rows, [per, first, found]


def kneser_ney(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Expressions that tell the classes apart and the log-ratios of their probabilities, from ``text, toxic``.

    These are the class-conditional models as they are, not interpolated with the shared one; kept for
    comparison, the operator does not use it. Both arrays are empty if a class has no texts.
    """
    per, in_toxic, in_plain, _ = _counted(labelled)
    if not in_toxic or not in_plain:
        return np.zeros(0, np.uint64), np.zeros(0)
    fields = "e bigint, a bigint, b bigint, la double, lb double, ls double"
    rows = _likelihoods(per, lambda batches: batches, fields)[0].filter(_tells(in_toxic, in_plain))
    return _arrays(rows.withColumn("ratio", F.col("la") - F.col("lb")))


_log_gamma = np.frompyfunc(math.lgamma, 1, 1)


def evidence(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    """Log of how much likelier ``a`` toxic documents and ``b`` others are if an expression has a share of
    toxic ones of its own (a beta distribution around ``share`` worth one document) than with ``share``."""
    kinds, place = np.unique(a * (b.max(initial=0) + 1) + b, return_index=True, return_inverse=True)[1:]
    x, y = a[kinds].astype(float), b[kinds].astype(float)
    own = (_log_gamma(x + share) + _log_gamma(y + 1 - share) - _log_gamma(x + y + 1)).astype(float)
    own -= math.lgamma(share) + math.lgamma(1 - share)
    return (own - x * math.log(share) - y * math.log(1 - share))[place]


def _bins(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = evidence(batch.column("a").to_numpy(), batch.column("b").to_numpy(), share)
            bins, n = np.unique(np.round(np.clip(own, -50, 50) * 100).astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(n)], ["bin", "n"])

    return run


def differing(per: DataFrame, share: float) -> float:
    """The likeliest share of expressions in which the classes differ, by the evidence (in steps of 0.01)."""
    seen = map_arrow(per.filter("a + b > 0").select("a", "b"), _bins(share), "bin int, n bigint")
    rows = seen.groupBy("bin").agg(F.sum("n").alias("n")).sort("bin").toArrow()
    gain, n = np.expm1(rows["bin"].to_numpy() / 100), rows["n"].to_numpy().astype(float)
    # One expression at least, and all but one at most.
    low, high = 1 / (n.sum() + 1), n.sum() / (n.sum() + 1)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (n * gain / (1 + middle * gain)).sum() > 0 else (low, middle)
    return (low + high) / 2


def weights(a: np.ndarray, b: np.ndarray, logs: np.ndarray, share: float, prior: float) -> np.ndarray:
    """Log-ratios of the expressions' probabilities in both classes: each class's interpolated with the
    shared one by the probability that the classes differ, which without any text is ``prior``."""
    odds = evidence(a, b, share) + math.log(prior) - math.log1p(-prior)
    differ, alike = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    toxic, plain, shared = logs
    return np.logaddexp(differ + toxic, alike + shared) - np.logaddexp(differ + plain, alike + shared)


def _weigh(share: float, prior: float, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
            ratio = weights(a, b, np.array([batch.column(c).to_numpy() for c in _LOGS]), share, prior)
            part = _part(batch.column("e").to_numpy().view(np.uint64), parts)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), batch.column("e"), pa.array(ratio)], ["part", "e", "ratio"])

    return run


def whole(labelled: DataFrame, others: DataFrame) -> list:
    """The model the operator scores by, from ``text, toxic``: weights of all expressions, in parts, also of
    those that only ``others`` (``text``) have.

    A part is a file of keys in order and then their weights, which the tasks map: that in the shared folder
    if it is mounted, else each executor gets a copy. The driver holds one part at a time. There are no
    parts if a class has no texts.
    """
    per, in_toxic, in_plain, kinds = _counted(labelled, others)
    if not in_toxic or not in_plain:
        return []
    share = in_toxic / (in_toxic + in_plain)
    spark = labelled.sparkSession
    n_parts = -(-kinds // PART)
    rows, staged = _likelihoods(per, _weigh(share, differing(per, share), n_parts), "part int, e bigint, ratio double")
    path = work_folder(spark, "weights")
    rows.repartition("part").write.partitionBy("part").parquet(path)
    rows = spark.read.schema("e bigint, ratio double, part int").parquet(path)
    parts = []
    for i in range(n_parts):
        keys, ratios = _arrays(rows.filter(F.col("part") == i))
        if len(keys):
            file = f"{work_folder(spark, 'model')}-{i}"
            storage.create_bytes(spark, file, keys.tobytes() + ratios.tobytes())
            full = storage.full_path(spark, file)
            if full.startswith("file:"):
                parts.append("/" + full.removeprefix("file:").lstrip("/"))
            else:
                spark.sparkContext.addFile(full)
                parts.append(full.rsplit("/", 1)[1])
        else:
            parts.append((keys, ratios))
    _drop(staged)
    storage.remove(spark, path)
    return parts


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64) * parts >> 20


def _opened(part: str | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not isinstance(part, str):
        return part
    keys, ratios = np.memmap(SparkFiles.get(part), np.uint64, "r").reshape(2, -1)
    return keys, ratios.view(np.float64)


def _values(parts: list[tuple[np.ndarray, np.ndarray]], wanted: np.ndarray) -> np.ndarray:
    """The weights of expressions in order; 0 for those that the model has not."""
    found = np.zeros(len(wanted))
    own = _part(wanted, len(parts))
    for i, (keys, ratios) in enumerate(parts):
        at = np.flatnonzero(own == i)
        if len(keys) and len(at):
            place = np.minimum(np.searchsorted(keys, wanted[at]), len(keys) - 1)
            found[at] = np.where(keys[place] == wanted[at], ratios[place], 0.0)
    return found


def _score(parts: list, name: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = [_opened(part) for part in parts]
        for batch in batches:
            margin = []
            for first, last, data, limits in chunks(texts(batch)):
                found, at = expressions(data, limits)
                kinds, place = np.unique(found, return_inverse=True)
                n = np.diff(at)
                total = np.bincount(np.repeat(np.arange(last - first), n), _values(model, kinds)[place], last - first)
                margin.append(total / np.maximum(1, n))
            margin = pa.array(np.concatenate(margin) if margin else np.zeros(0))
            keep = [i for i, n in enumerate(batch.schema.names) if keep_text or n != "text"]
            names = [batch.schema.names[i] for i in keep]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [margin], [*names, name])

    return run


def margins(rows: DataFrame, model: list | tuple[np.ndarray, np.ndarray], name: str = "margin", keep_text: bool = False) -> DataFrame:
    """``rows`` with the length-normalised difference of log-likelihoods as ``name``, without ``text`` unless kept.

    The model is one of ``whole``, or arrays of expressions in order and their weights.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if keep_text or f.name != "text"]
    parts = [model] if isinstance(model, tuple) else model
    return map_arrow(rows, _score(parts, name, keep_text), ", ".join([*fields, f"`{name}` double"]))


def threshold(scored: DataFrame) -> float:
    """The margin from which most texts (``margin, toxic``) are on the right side."""
    bins = scored.groupBy(F.round(F.col("margin") * STEPS).cast("bigint").alias("bin"), "toxic").count().collect()
    if not bins:
        return 1.0
    low = min(r["bin"] for r in bins)
    high = max(r["bin"] for r in bins)
    found = np.zeros((2, high - low + 2))
    for r in bins:
        found[r["toxic"], r["bin"] - low] += r["count"]
    right = np.cumsum(np.concatenate(([0], found[0])))[:-1] + found[1][::-1].cumsum()[::-1]
    best = np.flatnonzero(right == right.max())
    return max((low + (best[0] + best[-1]) / 2 - 0.5) / STEPS, 0.5 / STEPS)


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("bigint").cast("string")) % folds


def _known(docs: DataFrame, labels: DataFrame, folds: int) -> DataFrame:
    """``doc_id, text, toxic`` of the labelled documents outside the held-out fold."""
    docs = documents(docs)
    marks = labels.select(F.col("doc_id").cast("bigint").alias("l"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("toxic").isin(0, 1) & (fold(F.col("l"), folds) != 0))
    # Shuffled at every size: labels grow with the documents, so they are never broadcast.
    return docs.filter(fold(F.col("doc_id"), folds) != 0).join(marks.hint("merge"), F.col("doc_id") == F.col("l")).drop("l")


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5) -> tuple[tuple[np.ndarray, np.ndarray], float]:
    """Telling expressions by ``kneser_ney`` and their threshold, from ``labels`` (``doc_id, toxic``) of documents
    outside the held-out fold; kept for comparison, the operator learns by ``learn_whole``."""
    known = _known(docs, labels, folds)
    model = kneser_ney(known.filter(fold(F.col("doc_id"), folds) != 1))
    if not len(model[0]):
        return model, 1.0
    return model, threshold(margins(known.filter(fold(F.col("doc_id"), folds) == 1), model))


def learn_whole(docs: DataFrame, labels: DataFrame, folds: int = 5) -> tuple[list, float]:
    """Model by ``whole`` with all expressions of ``docs``, and threshold, from ``labels`` (``doc_id, toxic``)
    of documents outside the held-out fold. No text reaches the threshold if no toxic one of the fold
    that sets it does: then nothing shows that those above would be toxic."""
    known = _known(docs, labels, folds)
    model = whole(known.filter(fold(F.col("doc_id"), folds) != 1), documents(docs))
    if not model:
        return model, 1.0
    trial = stage(margins(known.filter(fold(F.col("doc_id"), folds) == 1), model).select("margin", "toxic"), "trial")
    limit = threshold(trial)
    reached = not trial.filter((F.col("toxic") == 1) & (F.col("margin") >= limit)).isEmpty()
    _drop([trial])
    if not reached:
        limit = 1.0 + max(ratios.max(initial=0) for _, ratios in map(_opened, model))
    return model, limit


def scored(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted`` and the ``margin`` behind them.

    Learns from ``labels`` (``doc_id, toxic``) of documents outside the held-out fold (the checksum
    of the id as text is 0 modulo ``folds``): one of the other folds sets the threshold, the rest
    give the counts. The score is 0.5 at the threshold and 0.01 where the classes are alike, as for an
    empty or null text. A row without ``doc_id`` is scored, too, and is not held out. With no
    labels of one class, or too few to set a threshold, nothing is predicted toxic. Repeated rows get the same score; labels that are
    neither 0 nor 1 are left out; other columns are not looked at; an empty table gives no rows.
    """
    model, limit = learn_whole(docs, labels, folds)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-math.log(99) * (F.col("margin") - limit) / limit))
    return margins(documents(docs), model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        "margin",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic by ``scored``."""
    model, limit = learn_whole(docs, labels, folds)
    name = fresh("margin", docs)
    return margins(docs, model, name, keep_text=True).filter(F.col(name) < limit).drop(name)
