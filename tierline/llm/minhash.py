"""Near-duplicates by b-bit MinHash: banded candidates, bit counts, confirmation on full sets.

Minima of HASHES hash functions are cut to their BITS low bits and packed into four numbers.
Bands of the whole minima give candidates; the share of equal low bits, corrected for chance
equality, sorts out the unlikely ones; the rest are confirmed on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import same_key
from tierline.llm.common import NOT_SPACE, chunks, documents, fresh, map_arrow, mix, signed, stage, texts, words
from tierline.llm.components import components

HASHES, ROWS, BITS = 128, 5, 2
BANDS = HASHES // ROWS
#: Hash functions of the longer signature that candidates of crowded buckets get, and how often
#: such a bucket is compared with another of its members before the pairs left are listed.
WIDE, TURNS = 1024, 2
#: Standard deviations of the estimate below the limit at which a candidate is still confirmed.
SLACK = 4.5
_LANES = 0x5555555555555555

_random = np.random.default_rng(20240229)
_A = _random.integers(1, 1 << 32, WIDE, np.uint32) | np.uint32(1)
_B = _random.integers(0, 1 << 32, WIDE, np.uint32)
_K = _random.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles of ``width`` words of one text; a shorter text is one shingle, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(n, width)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total += hashes[i : n - size + 1 + i] * _K[i]
    return np.unique(mix(total))


def _minima(shingles: np.ndarray, n: int = HASHES) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    found = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        part = _A[:n, None] * low[None, at : at + 2048] + _B[:n, None]
        np.minimum(found, part.min(axis=1), out=found)
    return found


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low bits of rows of minima, 32 of them in a number."""
    bits = mix(minima.astype(np.uint64) + np.uint64(1)) & np.uint64((1 << BITS) - 1)
    lanes = bits.reshape(len(minima), -1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(lanes, axis=2)


def _signature(minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The packed low bits of rows of minima (four numbers each) and their band keys."""
    wide = minima.astype(np.uint64)
    packed = _packed(minima)
    rows = wide[:, : BANDS * ROWS].reshape(len(minima), BANDS, ROWS)
    keys = (mix(rows + np.uint64(7)) * _K[:ROWS]).sum(axis=2, dtype=np.uint64)
    return packed, mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * _K[63])


def _sketch(width: int, id_type: pa.DataType):
    schema = pa.schema(
        [("doc_id", id_type), ("n_shingles", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64())]
        + [(f"s{i}", pa.int64()) for i in range(4)]
        + [("bands", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, limits in chunks(texts(batch)):
                hashes, at = words(data, limits, NOT_SPACE)
                n = last - first
                count, minima = np.zeros(n, np.int64), np.zeros((n, HASHES), np.uint32)
                content = np.zeros((n, 2), np.uint64)
                for i in range(n):
                    own = hashes[at[i] : at[i + 1]]
                    if len(own):
                        found = shingle_hashes(own, width)
                        count[i], minima[i] = len(found), _minima(found)
                        place = mix(np.arange(1, len(own) + 1, dtype=np.uint64) * _K[62])
                        content[i] = (own * place).sum(), mix(own ^ place).sum()
                packed, keys = _signature(minima)
                keys = keys[count > 0]
                list_at = np.concatenate(([0], np.cumsum((count > 0) * BANDS))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], pa.array(count)]
                    + [pa.array(signed(content[:, i].copy())) for i in range(2)]
                    + [pa.array(signed(packed[:, i].copy())) for i in range(4)]
                    + [pa.ListArray.from_arrays(pa.array(list_at), pa.array(signed(keys.ravel())))],
                    schema=schema,
                )

    return run


def signatures(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles``, content key ``c1, c2``, ``s0``…``s3`` and band keys."""
    shape = "doc_id bigint, n_shingles bigint, c1 bigint, c2 bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint, bands array<bigint>"
    return map_arrow(documents(docs), _sketch(width, pa.int64()), shape)


def _unequal(x: Column) -> Column:
    """How many lanes of an exclusive or are not zero."""
    return F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(_LANES)))


def equal_lanes(a: str, b: str) -> Column:
    """How many of the packed low-bit minima of two signatures are equal."""
    total = F.lit(HASHES)
    for i in range(4):
        total = total - _unequal(F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}")))
    return total


def equal_wide(a: str, b: str) -> Column:
    """The same for the longer signatures."""
    unequal = F.zip_with(a, b, lambda x, y: _unequal(x.bitwiseXOR(y)))
    return F.lit(WIDE) - F.aggregate(unequal, F.lit(0), lambda t, x: t + x)


def estimate(lanes: Column, hashes: int = HASHES) -> Column:
    """Similarity estimated from the number of equal lanes, corrected for chance equality."""
    chance = 2.0**-BITS
    return (lanes / F.lit(float(hashes)) - F.lit(chance)) / F.lit(1 - chance)


def _least_estimate(percent: int, hashes: int) -> float:
    """What the estimate of a pair of that similarity falls below about once in 300,000 times."""
    equal = 2.0**-BITS + (1 - 2.0**-BITS) * percent / 100
    return percent / 100 - SLACK * math.sqrt(equal * (1 - equal) / hashes) / (1 - 2.0**-BITS)


def _widened(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, limits in chunks(texts(batch)):
                hashes, at = words(data, limits, NOT_SPACE)
                count, minima = np.zeros(last - first, np.int64), np.zeros((last - first, WIDE), np.uint32)
                for i in range(last - first):
                    found = shingle_hashes(hashes[at[i] : at[i + 1]], width)
                    count[i], minima[i] = len(found), _minima(found, WIDE)
                both = []
                for found in (_packed(minima), _signature(minima[:, :HASHES])[1]):
                    limits = np.arange(len(found) + 1, dtype=np.int32) * np.int32(found.shape[1])
                    both.append(pa.ListArray.from_arrays(pa.array(limits), pa.array(signed(found.ravel()))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], pa.array(count), *both], ["id", "n_shingles", "w", "bands"]
                )

    return run


def _confirm(width: int, percent: int):
    def one(text: str) -> np.ndarray:
        _, _, data, limits = next(chunks(pa.array([text], pa.large_string())))
        return shingle_hashes(words(data, limits, NOT_SPACE)[0], width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            left, right = texts(batch, "text_a"), texts(batch, "text_b")
            linked = np.zeros(len(batch), bool)
            for i in range(len(batch)):
                a = left[i].as_py()
                if a != known:
                    known, known_set = a, one(a)
                other = one(right[i].as_py())
                small, large = sorted((len(known_set), len(other)))
                if 100 * small < percent * large or not small:
                    continue
                both = len(np.intersect1d(known_set, other, assume_unique=True))
                linked[i] = 100 * both >= percent * (len(known_set) + len(other) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(linked)), batch.column(1).filter(pa.array(linked))], ["u", "v"]
            )

    return run


def confirmed(pairs: DataFrame, bodies: DataFrame, width: int, percent: int, *ends: str) -> DataFrame:
    """The pairs ``u, v`` whose texts in ``bodies`` (``doc_id, text``) have similar enough full sets.

    With ``ends``, two further columns of ``pairs`` stand for the pair in the result.
    """
    a = bodies.select(F.col("doc_id").alias("u"), F.col("text").alias("text_a"))
    b = bodies.select(F.col("doc_id").alias("v"), F.col("text").alias("text_b"))
    full = pairs.join(b, "v").join(a, "u").select(*(ends or ("u", "v")), "text_a", "text_b")
    return map_arrow(full, _confirm(width, percent), "u bigint, v bigint")


def _sizes_fit(percent: int) -> Column:
    return F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent


def _narrow(percent: int) -> Column:
    """Whether sizes and signatures of a pair with columns ``a_…`` and ``b_…`` allow the similarity."""
    close = estimate(equal_lanes("a_", "b_")) >= _least_estimate(percent, HASHES)
    return _sizes_fit(percent) & close


def _wide(percent: int) -> Column:
    return estimate(equal_wide("a_w", "b_w"), WIDE) >= _least_estimate(percent, WIDE)


def _as(prefix: str, *names: str) -> list[Column]:
    short = {"n_shingles": "n"}
    return [F.col(n).alias(prefix + short.get(n, n)) for n in ("id", "n_shingles", *names)]


def _best(pairs: DataFrame, lanes: Column, *names: str) -> DataFrame:
    """For each ``b_id`` the partner whose signature agrees most, as ``u, v``, and both sides' columns ``names``."""
    best = F.max_by(F.struct("a_id", *[f"a_{n}" for n in names]), F.struct(lanes, -F.col("a_id"))).alias("best")
    found = pairs.groupBy("b_id", *[f"b_{n}" for n in names]).agg(best)
    ends = [c for n in names for c in (F.col(f"best.a_{n}"), F.col(f"b_{n}"))]
    return found.select(F.col("best.a_id").alias("u"), F.col("b_id").alias("v"), *ends)


def _joined(pairs: DataFrame) -> DataFrame:
    """``n, c``: every linked number but the smallest of each group, and that smallest one."""
    found = components(pairs).filter("id <> component")
    return found.select(F.col("id").alias("n"), F.col("component").alias("c"))


def _then(label: DataFrame, joined: DataFrame) -> DataFrame:
    """``label`` with the components of ``joined`` put together, both as ``_joined`` gives them."""
    later = joined.select(F.col("n").alias("m"), F.col("c").alias("d"))
    moved = label.join(later, F.col("c") == F.col("m"), "left").select("n", F.coalesce("d", "c").alias("c"))
    return moved.unionByName(joined)


def _still_open(rows: DataFrame, joined: DataFrame, turn: int) -> DataFrame:
    """Rows of the buckets that hold several components, with ``comp``, the bucket's largest, ``main``, and
    one of its members, ``p``, another one each ``turn``."""
    placed = rows.join(joined, F.col("comp") == F.col("n"), "left").withColumn("comp", F.coalesce("c", "comp"))
    placed = stage(placed.drop("n", "c"), "placed")
    sizes = placed.groupBy("key", "comp").agg(
        F.count("*").alias("size"), F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("p")
    )
    order = F.struct("size", "comp")
    main = sizes.groupBy(F.col("key").alias("k")).agg(
        F.max_by("comp", order).alias("main"), F.max_by("p", order).alias("p"), F.count("*").alias("kinds")
    )
    return stage(placed.join(main.filter("kinds > 1"), same_key(["key"], ["k"])).drop("k", "kinds"), "open")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept`` and the content key ``c1, c2``.

    Two documents are linked if 100 * shared shingles >= ``percent`` * shingles of both together;
    ``component_id`` is the smallest ``doc_id`` reachable by links, ``kept`` says that it is the
    document's own. Texts without words have an empty set and are linked with nothing; nor is a row
    without ``doc_id``, which is kept. Rows with the same ``doc_id`` are one document with several
    texts. Other columns are not looked at. An empty table gives no rows.

    Copies are folded to one representative before anything is compared. In a bucket of
    candidates every member is first compared with the bucket's smallest one only, so a group of
    near copies costs a comparison for each of its members, then with others, each time only those
    not joined yet. What is still apart is compared pair by pair within the bucket, with the bit
    counts of a longer signature inside the join, so that only likely pairs leave it.
    """
    sketch = stage(signatures(docs, width), "sketch")
    real = sketch.filter("n_shingles > 0 and doc_id is not null")
    short = [f"s{i}" for i in range(4)]
    same = [F.first(c).alias(c) for c in ("n_shingles", *short, "bands")]  # the same content has the same sketch
    reps = stage(real.groupBy("c1", "c2").agg(F.min("doc_id").alias("id"), *same), "firsts")
    classes = reps.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), F.col("id").alias("rep"))
    content = (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2"))
    copies = stage(real.select("doc_id", "n_shingles", "c1", "c2").join(classes, content).drop("k1", "k2"), "copies")
    # The texts of a repeated doc_id belong together.
    several = copies.groupBy(F.col("doc_id").alias("n")).agg(F.min("rep").alias("v"), F.max("rep").alias("most"))
    several = stage(several.filter("v < most").drop("most"), "several")
    several = copies.join(several, F.col("doc_id") == F.col("n")).select(F.col("rep").alias("u"), "v")

    banded = reps.select("id", "n_shingles", *short, F.explode("bands").alias("key"))
    buckets = banded.groupBy(F.col("key").alias("k")).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    buckets = buckets.filter("low < high")
    rows = stage(banded.join(buckets, same_key(["key"], ["k"])).drop("k", "high"), "buckets")

    lows = rows.filter("id = low").select(F.col("key").alias("k"), *_as("a_", *short))
    stars = rows.filter("id > low").select("key", *_as("b_", *short)).join(lows, F.col("key") == F.col("k"))
    tried = _best(stars.filter(_narrow(percent)), equal_lanes("a_", "b_"))

    # Every document that has a likely partner is in a bucket; only their texts are read from here on.
    involved = rows.select(F.col("id").alias("i"))
    bodies = stage(documents(docs).join(involved, F.col("doc_id") == F.col("i"), "left_semi"), "bodies")
    label = joined = _joined(confirmed(tried, bodies, width, percent).unionByName(several))

    # From here on only links between different components are looked for, and only components are joined.
    rows = _still_open(rows.withColumn("comp", F.col("id")).drop("low"), joined, 0)
    ids = rows.select(F.col("id").alias("i"))
    open_bodies = bodies.join(ids, F.col("doc_id") == F.col("i"), "left_semi")
    wide = stage(map_arrow(open_bodies, _widened(width), "id bigint, n_shingles bigint, w array<bigint>, bands array<bigint>"), "wide")
    for turn in range(TURNS):
        pairs = rows.filter("comp <> main").select("id", "p", F.col("comp").alias("b_comp"), F.col("main").alias("a_comp"))
        pairs = pairs.distinct().join(wide.select(*_as("a_", "w")), F.col("p") == F.col("a_id"))
        pairs = pairs.join(wide.select(*_as("b_", "w")), F.col("id") == F.col("b_id"))
        likely = pairs.filter(_sizes_fit(percent) & _wide(percent))
        turned = _best(likely, equal_wide("a_w", "b_w"), "comp")
        joined = _joined(confirmed(turned, bodies, width, percent, "a_comp", "b_comp"))
        label = _then(label, joined)
        rows = _still_open(rows.drop("main", "p"), joined, turn + 1)

    full = rows.join(wide.select(F.col("id").alias("i"), "w", "bands"), F.col("id") == F.col("i"))
    outside = full.filter("comp <> main").select("key", F.col("comp").alias("a_comp"), *_as("a_", *short, "w", "bands"))
    others = full.select(F.col("key").alias("k"), F.col("comp").alias("b_comp"), "main", *_as("b_", *short, "w", "bands"))
    apart = F.expr("a_comp <> b_comp and (b_comp = main or a_id < b_id)")
    first_shared = F.element_at(F.array_intersect("a_bands", "b_bands"), 1) == F.col("key")
    found = (F.col("key") == F.col("k")) & apart & _narrow(percent) & _wide(percent) & first_shared
    rest = outside.join(others, found)
    ends = [F.struct(F.col(f"{x}_id").alias("id"), F.col(f"{x}_comp").alias("comp")) for x in "ab"]
    rest = rest.select(F.least(*ends).alias("x"), F.greatest(*ends).alias("y")).distinct()
    names = {"x.id": "u", "x.comp": "u_comp", "y.id": "v", "y.comp": "v_comp"}
    rest = stage(rest.select(*[F.col(c).alias(n) for c, n in names.items()]), "rest")
    label = _then(label, _joined(confirmed(rest, bodies, width, percent, "u_comp", "v_comp")))

    placed = copies.join(label, F.col("rep") == F.col("n"), "left").withColumn("comp", F.coalesce("c", "rep"))
    alone = sketch.filter("n_shingles = 0 or doc_id is null").withColumn("comp", F.col("doc_id"))
    shape = ["doc_id", "n_shingles", "c1", "c2", "comp"]
    result = placed.select(*shape).unionByName(alone.select(*shape))
    return result.select(
        "doc_id",
        "n_shingles",
        F.col("comp").alias("component_id"),
        F.coalesce(F.col("comp") == F.col("doc_id"), F.lit(True)).alias("kept"),
        "c1",
        "c2",
    )


def without_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near copies, the one with the smallest ``doc_id``, with all its columns.

    Of rows that repeat a ``doc_id`` and its text one stays. Rows without ``doc_id`` stay.
    """
    gone = near_duplicates(docs, width, percent).filter("not kept").select("doc_id").distinct()
    gone = stage(gone, "gone").withColumnRenamed("doc_id", fresh("gone", docs))
    key = fresh("k", docs)
    rows = docs.withColumn(key, F.xxhash64("text"))
    rows = rows.join(gone, same_key(["doc_id"], gone.columns), "left_anti")
    return rows.dropDuplicates(["doc_id", key]).drop(key)
