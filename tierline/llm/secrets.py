"""Secrets in texts: three fixed patterns, and formats inferred from what these find.

The values the patterns find are labelled credentials. Prefix trees of them are merged into
probabilistic automata, one for each kind, and so is one of ordinary words. Any other long run of
credential characters is a secret if an automaton explains it so much better than ordinary words.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import documents, map_arrow, pieces, stage
from tierline.llm.grammar import Automaton

KINDS = ("assign", "access", "hex")
#: Different examples of a kind, and different ordinary words, that the automata are fitted on.
EXAMPLES = 1500
#: One in so many ordinary words is offered as an example of them.
ONE_IN = 256
#: Shortest run of credential characters that is scored.
SHORTEST = 20

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{%d,}" % SHORTEST)
_WORD = re.compile(r"[A-Za-z0-9+/_=.-]{6,}")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Start, kind's number, end and credential of what the fixed patterns find, in order."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        kinds, values = [], []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text or "")
            kinds += [KINDS[s[1]] for s in spans]
            values += [s[3] for s in spans]
            taken = {s[3] for s in spans}
            words = {w for w in _WORD.findall(text or "") if not zlib.crc32(w.encode()) % ONE_IN} - taken
            kinds += ["word"] * len(words)
            values += words
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])


class Formats:
    """Automata of the kinds and of ordinary words, and the least gain of a secret."""

    def __init__(self, examples: dict[str, list[str]]):
        words = examples.get("word", [])
        self.kinds = {k: Automaton(examples[k]) for k in KINDS if examples.get(k)}
        self.words = Automaton(words)
        own = [self.gain(x) for k in self.kinds for x in examples[k] if len(x) >= SHORTEST]
        other = [self.gain(x) for x in words]
        # Between nearly all credentials and nearly all words, nearer to the credentials.
        low = float(np.quantile(own, 0.02)) if own else 0.0
        high = max(float(np.quantile(other, 0.999)) if other else 0.0, 0.0)
        self.limit = max(high + 0.6 * (low - high), 0.1)

    def gain(self, text: str) -> float:
        """How much likelier, in logarithms for each character, the best format makes the text than words do."""
        if not self.kinds:
            return -1.0
        best = max(a.log_likelihood(text) for a in self.kinds.values())
        return (best - self.words.log_likelihood(text)) / len(text)

    def added(self, text: str, taken: list[tuple]) -> list[tuple[int, int, int, str]]:
        """Runs, or what base spans leave of them, whose format is a credential's."""
        found = []
        for m in _RUN.finditer(text) if self.kinds else ():
            for first, last in _left(m.start(), m.end(), taken):
                value = text[first:last].strip(".=-")
                if len(value) < SHORTEST:
                    continue
                start = text.index(value, first)
                if self.gain(value) >= self.limit:
                    found.append((start, len(KINDS), start + len(value), value))
        return found


def _left(first: int, last: int, taken: list[tuple]) -> Iterator[tuple[int, int]]:
    """The parts from ``first`` to ``last`` that no span of ``taken``, in order, touches."""
    for start, _, end, _ in taken:
        if end > first and start < last:
            if start > first:
                yield first, start
            first = end
    if first < last:
        yield first, last


def fit(docs: DataFrame) -> Formats:
    """Automata from at most EXAMPLES different credentials of each kind and words of all ``docs``."""
    found = map_arrow(docs.select(F.col("text").cast("string").alias("text")), _examples, "kind string, value string")
    found = stage(found.distinct(), "examples")
    order = (F.xxhash64("value"), F.col("value"))  # any fixed order that does not favour a format
    return Formats(
        {k: [r["value"] for r in found.filter(F.col("kind") == k).orderBy(*order).limit(EXAMPLES).collect()] for k in (*KINDS, "word")}
    )


def _spans(formats: Formats, text: str) -> list[tuple[int, int, int, str]]:
    base = base_spans(text)
    return sorted(base + formats.added(text, base))


def _name(span: tuple) -> str:
    return f"{(*KINDS, 'format')[span[1]]}:{span[0]}:{span[2]}"


def _scan(formats: Formats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [_spans(formats, x or "") for x in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[1] == k for s in row) for row in rows], pa.int64()) for k in range(len(KINDS) + 1)]
            base = [",".join(_name(s) for s in row if s[1] < len(KINDS)) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *counts,
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                    pa.array([",".join(map(_name, row)) for row in rows], pa.string()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"],
            )

    return run


def secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, n_format, base_sha256, spans``.

    ``spans`` has kind:start:end of every secret in order, in code points. Null or empty texts have
    none. Repeated rows get the same result each, a null ``doc_id`` is kept, other columns are not
    looked at, and an empty table gives no rows. Without any credential to learn from only the
    patterns' spans are there.
    """
    shape = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_format bigint, base_sha256 string, spans string"
    return map_arrow(documents(docs), _scan(fit(docs)), shape)


def _mask(formats: Formats, mark: str):
    def masked(text: str | None) -> str | None:
        if text is None:
            return None
        parts, at = [], 0
        for start, _, end, _ in _spans(formats, text):
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        return "".join([*parts, text[at:]]) if parts else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            at = batch.schema.get_field_index("text")
            texts = pa.array([masked(x) for x in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, "text", texts)

    return run


def masked(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with ``mark`` in place of every secret in ``text``; all rows and columns stay.

    If there is a column ``n_chars`` it gets the length of the new text.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    result = map_arrow(docs, _mask(fit(docs), mark), fields)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        result = result.withColumn("n_chars", length)
    return result
