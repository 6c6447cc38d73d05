"""Packing of documents into sequences of fixed length: concatenate and cut.

The first pass turns each document into token ids and notes where it starts among the tokens of
its partition. Prefix sums over the partitions' totals then give every document its place in one
long row of tokens, and the second pass cuts that row into windows.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import chunks, documents, map_arrow, stage, texts

#: Ids of so many different words, and of so many parts of words, are remembered in a worker.
REMEMBERED = 200_000

# White-space words in simple parts: runs of letters, single digits, runs of other signs. A word
# with an apostrophe, a "<" (special ids), a control character or anything beyond Latin letters
# is left whole, since contractions or composition of characters could reach across such parts.
_PLAIN, _LATIN = rb"[!-&(-;=-~]", rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
_LETTERS = rb"(?:[A-Za-z]++|" + _LATIN + rb")++"
_SIMPLE = _LETTERS + rb"|[0-9]|[!-&(-/:-;=-@\[-`{-~]++"
_WHOLE = _PLAIN + rb"*+(?:" + _LATIN + _PLAIN + rb"*+)*+[^\x20\x09-\x0d!-&(-;=-~][^\x20\x09-\x0d]*+"
_parts = re.compile(_WHOLE + rb"|" + _SIMPLE)
_simple = re.compile(_SIMPLE)
#: What the split pattern of a tokenizer must be for these parts to be right.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_encoders: dict[str, Callable[[list[str]], list[bytes]]] = {}


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Parts(dict):
    """Ids of a part of a word, by the tokenizer."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}

    def __missing__(self, part: bytes) -> bytes:
        text = part.decode()
        if _simple.fullmatch(part):
            # As its normaliser and its byte alphabet would have it.
            mapped = text.lower().encode().decode("latin-1").translate(self.letters)
            ids = _packed_ids([t.id for t in self.model.tokenize(mapped)])
        else:
            ids = _packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(self) < REMEMBERED:
            self[part] = ids
        return ids


class _Words(dict):
    """Ids of a white-space word, put together from those of its parts."""

    def __init__(self, parts: _Parts):
        self.parts = parts

    def __missing__(self, word: bytes) -> bytes:
        ids = b"".join([self.parts[x] for x in _parts.findall(word)])
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids


def _encoder(name: str) -> Callable[[list[str]], list[bytes]]:
    """From texts to ids with the tokenizer of that file; once per worker.

    A tokenizer that drops white space works word by word, and words met before are looked up.
    """
    if name not in _encoders:
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        steps = json.loads(tokenizer.to_str())["pre_tokenizer"] or {}
        first = (steps.get("pretokenizers") or [{}])[0]
        if first.get("pattern") == {"Regex": _PATTERN} and first.get("behavior") == "Removed":
            words = _Words(_Parts(tokenizer))
            _encoders[name] = lambda lines: [b"".join(map(words.__getitem__, x.encode().split())) for x in lines]
        else:
            _encoders[name] = lambda lines: [
                _packed_ids(e.ids) for e in tokenizer.encode_batch(lines, add_special_tokens=False)
            ]
    return _encoders[name]


def _tokenize(tokenizer: str, closing: int):
    """Per document its ids (little-endian, 32 bits each) and its place in the partition."""
    end = _packed_ids([closing])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        part, place, number = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            column = texts(batch)
            for first, last, _, _ in chunks(column):
                ids = [x + end for x in encode(column[first:last].to_pylist())]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                starts = place + np.cumsum(sizes) - sizes
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:last],
                        pa.array(np.full(n, part, np.int64)),
                        pa.array(np.arange(number, number + n, dtype=np.int64)),
                        pa.array(starts),
                        pa.array(sizes),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "part", "number", "place", "doc_tokens", "ids"],
                )
                place, number = place + int(sizes.sum()), number + n

    return run


def tokenized(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", closing: int = 2) -> DataFrame:
    """``doc_id, part, number, place, doc_tokens, ids`` of every row, written to the shared folder.

    A null text counts as empty; every document ends with the id ``closing``.
    """
    shape = "doc_id bigint, part bigint, number bigint, place bigint, doc_tokens bigint, ids binary"
    return stage(map_arrow(documents(docs), _tokenize(tokenizer, closing), shape), "tokens")


def packed(docs: DataFrame, length: int = 4096, tokenizer: str = "word_bpe_49k.json", closing: int = 2) -> DataFrame:
    """Pieces of the documents in sequences of ``length`` tokens; only the last one can be shorter.

    A row per piece: ``doc_id, start`` (the document's ids before it), ``length``, ``ids`` (binary,
    little-endian, 32 bits each), ``doc_tokens, sequence_id, offset`` (its place there). The
    sequences have no gaps. Repeated rows are packed as often as they are there; a null ``doc_id``
    stays null; other columns are not looked at; an empty table gives no pieces.
    """
    rows = tokenized(docs, tokenizer, closing)
    # One number per partition; the window over them holds nothing that belongs to a document.
    totals = rows.groupBy(F.col("part").alias("p")).agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(totals.select("p", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "totals")
    # Broadcast: two numbers for each partition of the input, some MB for a million of them.
    placed = rows.join(F.broadcast(base), F.col("part") == F.col("p"))
    placed = placed.withColumn("at", F.col("base") + F.col("place"))
    first = F.floor(F.col("at") / length).cast("bigint")
    last = F.floor((F.col("at") + F.col("doc_tokens") - 1) / length).cast("bigint")

    def piece(sequence):
        start = F.greatest(F.lit(0).cast("bigint"), sequence * length - F.col("at"))
        size = F.least(F.col("doc_tokens"), (sequence + 1) * length - F.col("at")) - start
        ids = F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (size * 4).cast("int"))
        offset = F.col("at") + start - sequence * length
        return F.struct(
            start.alias("start"), size.alias("length"), ids.alias("ids"), sequence.alias("sequence_id"), offset.alias("offset")
        )

    cut = placed.select("doc_id", "doc_tokens", F.explode(F.transform(F.sequence(first, last), piece)).alias("x"))
    return cut.select("doc_id", "x.start", "x.length", "x.ids", "doc_tokens", "x.sequence_id", "x.offset")


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    kept = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32")]
    return pieces.select(*kept, "doc_tokens", "sequence_id", "offset")
