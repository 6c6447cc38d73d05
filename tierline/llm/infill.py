"""Fill-in-the-middle: texts cut in three at unit limits, with the middle moved to the end.

Arrow's compute functions do the work, batch by batch: a text is split into a list of units, the
lists are flattened with the row each unit belongs to, a unit's place in its row says which of the
three pieces it is in, the units of each piece become lists again and are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import chunks, documents, map_arrow, texts

#: What stands before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = "42"
#: Of a hundred texts so many are cut, and of a hundred cut ones so many begin with the suffix.
RATE, SUFFIX_FIRST = 50, 80
#: White space with the word behind it, or white space alone. The bytes of UTF-8 beyond ASCII are no white space.
_UNIT = r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+"
#: A byte that UTF-8 never has.
_CUT = b"\xff"
SHAPE = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def units(column: pa.Array) -> pa.ListArray:
    """The units of each (binary) text; joined they are the text."""
    marked = pc.replace_substring_regex(column, pattern=_UNIT, replacement=b"\\0" + _CUT)
    parts = pc.split_pattern(marked, pattern=_CUT)  # and an empty one behind the last cut
    counts = pc.subtract(pc.list_value_length(parts), 1)
    flat, row, place = _flat(parts)
    kept = pc.less(place, pc.take(counts, row))
    return _lists(pc.filter(flat, kept), counts)


def _flat(lists: pa.ListArray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """All values, the row of each, and its place in that row."""
    row = pc.list_parent_indices(lists)
    lengths = pc.list_value_length(lists)
    first = pc.subtract(pc.cumulative_sum(lengths), lengths)
    number = pa.array(range(0), pa.int32()) if not len(row) else pc.subtract(pc.cumulative_sum(pa.repeat(pa.scalar(1, pa.int32()), len(row))), 1)
    return pc.list_flatten(lists), row, pc.subtract(number, pc.take(first, row))


def _lists(values: pa.Array, lengths: pa.Array) -> pa.ListArray:
    """``values`` as lists of these lengths, in their order."""
    ends = pc.cumulative_sum(lengths).cast(pa.int32())
    return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), values)


def _modulo(x: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def pieces(lists: pa.ListArray, first: pa.Array, second: pa.Array) -> list[pa.Array]:
    """The joined units of each row before its ``first``, from there to its ``second``, and from there on."""
    lengths = pc.list_value_length(lists).cast(pa.int64())
    flat, row, place = _flat(lists)
    early, late = pc.less(place, pc.take(first, row)), pc.greater_equal(place, pc.take(second, row))
    roles = (
        (early, first),
        (pc.and_(pc.invert(early), pc.invert(late)), pc.subtract(second, first)),
        (late, pc.subtract(lengths, second)),
    )
    return [pc.binary_join(_lists(pc.filter(flat, role), count), b"") for role, count in roles]


def _chars(column: pa.Array) -> pa.Array:
    return pc.utf8_length(column.cast(pa.string())).cast(pa.int64())


def _columns(ids: pa.Array, text: pa.Array, h: list[pa.Array], marks: list[bytes], rate: int, suffix_first: int) -> list[pa.Array]:
    """The columns of SHAPE for a run of whole texts."""
    parts = units(text)
    n = pc.list_value_length(parts).cast(pa.int64())
    a, b = (_modulo(x, pc.add(n, 1)) for x in h[:2])
    first, second = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    prefix, middle, suffix = pieces(parts, first, second)
    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(h[2], hundred), rate))
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(text, mark))
    back = pc.less(_modulo(h[3], hundred), suffix_first)
    before, after, last = (pa.scalar(x, pa.binary()) for x in marks)
    join = pc.binary_join_element_wise
    nothing = pa.scalar(b"", pa.binary())
    cut = pc.if_else(
        back,
        join(after, suffix, before, prefix, last, middle, nothing),
        join(before, prefix, after, suffix, last, middle, nothing),
    )
    none = pa.scalar(None, pa.int64())
    return [
        ids,
        n,
        pc.if_else(plain, "plain", pc.if_else(back, "spm", "psm")),
        pc.if_else(plain, none, _chars(prefix)),
        pc.if_else(plain, none, _chars(middle)),
        pc.if_else(plain, text, cut).cast(pa.string()),
    ]


def _cutter(marks: list[bytes], rate: int, suffix_first: int):
    names = [x.split()[0] for x in SHAPE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts(batch)
            for first, last, _, _ in chunks(column):
                size = last - first
                text = column.slice(first, size).cast(pa.string()).cast(pa.binary())
                ids, *h = (batch.column(k).slice(first, size) for k in (0, 2, 3, 4, 5))
                yield pa.RecordBatch.from_arrays(_columns(ids, text, h, marks, rate, suffix_first), names)

    return run


def _unambiguous(marks: tuple[str, str, str]) -> list[bytes]:
    """The marks in bytes, if no text can make one more of them than is put in."""
    for a in marks:
        ends = {a[k:] for k in range(1, len(a))}
        if not a or marks.count(a) > 1 or any(a in b for b in marks if b is not a) or any(b.startswith(tuple(ends)) for b in marks if ends):
            raise ValueError(f"{marks}: a mark must not lie in another, and none may end as one begins")
    return [x.encode() for x in marks]


def filled_in(
    docs: DataFrame,
    *,
    seed: str = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` is the number of units; ``output`` is the text itself (``plain``), or prefix, suffix and
    middle (``psm``) or suffix, prefix and middle (``spm``), each behind its mark. Where a text is
    cut, and into which form, depends on ``seed`` and ``doc_id`` alone. A null or empty text and one
    with a mark in it are plain. A null ``doc_id`` counts as an empty one and is kept; repeated rows
    get the same result each, other columns are not looked at, and an empty table gives no rows.
    """
    marked = _unambiguous(marks)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i}") for i in range(4)]
    return map_arrow(documents(docs).select("doc_id", "text", *groups), _cutter(marked, rate, suffix_first), SHAPE)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``output`` was made of."""
    before, after, last = (F.lit(x) for x in marks)

    def between(start: Column, end: Column | None = None) -> Column:
        rest = F.split_part(output, start, F.lit(2))
        return rest if end is None else F.split_part(rest, end, F.lit(1))

    psm = F.concat(between(before, after), between(last), between(after, last))
    spm = F.concat(between(before, last), between(last), between(after, before))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
