"""Personal data in texts: four fixed patterns, and what a conditional random field adds to them.

The field reads words by their shape: kinds of letters, digits and signs, how many digits, a few
telling words, and the same of the two words on either side. It is fitted on a small labelled table.
Most words are so plain that no neighbour could make them personal data; they part a text into short
sequences, which are decoded by Viterbi, all those of a run of texts at once.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm import pii_examples
from tierline.llm.common import LOWER, chunks, documents, map_arrow, texts
from tierline.llm.crf import Chain
from tierline.llm.pii_examples import luhn

KINDS = ("email", "ip", "card", "phone")
#: What the field adds, in the order of spans that begin at the same place.
ADDED = ("like_email", "like_ip", "like_card", "like_phone", "id", "name")
#: Most rows of a labelled table that the field is fitted on.
EXAMPLES = 2000
#: Words other than plain ones that a task remembers.
REMEMBERED = 200_000

Span = tuple[int, int, int, str]

# ---- patterns -----------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits gives a match from its first digit or none, so later ones need not be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address has the run of characters before its sign from where the last address ended."""
    end = sign = -1
    while (sign := text.find("@", (before := sign) + 1)) >= 0:
        head = text[max(end, before + 1) : sign]
        local = len(head) - len(head.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, sign + 1) if local else None
        if domain:
            end = domain.end()
            yield sign - local, end


def base_spans(text: str) -> list[Span]:
    """Start, kind's number, end and text of what the fixed patterns find, in order."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text) if "." in text else ():
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(number := _digits(m[0])) <= 19 and luhn(number):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(a, k, b, text[a:b]) for a, k, b in sorted(found)]


# ---- words --------------------------------------------------------------------------------

_SMALL, _LARGE, _DIGIT, _SIGN = 1, 2, 4, 8
_BITS = np.full(256, _SIGN, np.uint8)
_BITS[97:123] = _BITS[128:] = _SMALL
_BITS[65:91], _BITS[48:58] = _LARGE, _DIGIT
_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32, *b',;="<>|']] = True
_HEX = np.zeros(256, bool)
_HEX[[*b"0123456789abcdefABCDEF:"]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[*b".!?"]] = True
#: Shapes of words that are letters only.
PLAIN = ("x", "Xx", "X", "xX")


def split(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a run of texts: white space and a few signs part them, and so does
    a colon that is not within a number."""
    inside = ~_BREAK[data]
    colon = np.flatnonzero(data == 58)
    if len(colon):
        near = np.concatenate(([False], _HEX[data], [False]))
        inside[colon[~(near[colon] & near[colon + 2])]] = False
    edge = np.zeros(len(data) + 1, bool)
    edge[limits] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def _letter(c: str) -> str:
    return "X" if "A" <= c <= "Z" else "x" if "a" <= c <= "z" or c > "\x7f" else "d" if "0" <= c <= "9" else c


About = tuple[str, str, str, str, str, bool]


def describe(word: str, cues: frozenset[str] = frozenset()) -> About:
    """Shape, shape without numbers of digits, kinds of characters, telling word, digits, and whether a
    sentence ends with it."""
    body = word.rstrip(".!?") if len(word) > 1 else word
    kinds = "".join(map(_letter, body))
    cue = body.translate(_AS_LOWER) if body.translate(_AS_LOWER) in cues else ""
    if body and not kinds.strip("xX"):
        small = kinds.lstrip("X")
        shape = PLAIN[0 if "X" not in kinds else 2 if "x" not in kinds else 1 if kinds[0] == "X" and "X" not in kinds[1:] else 3]
        return shape, shape, "", cue, "0", len(body) < len(word)
    shape = re.sub(r"(d{4})d+|([^d])\2+", r"\1\2", kinds)
    count = kinds.count("d")
    amount = str(count) if count < 12 else "many" if count > 19 else f"card{luhn(_digits(body)):d}"
    return shape[:24], re.sub("d+", "d", shape)[:24], "".join(sorted(set(kinds)))[:12], cue, amount, len(body) < len(word)


_AS_LOWER = {i: i + 32 for i in range(65, 91)}
#: Places whose words tell something of a place, and its own.
PLACES = (0, -1, -2, 1, 2)


def features(about: About, place: int) -> list[str]:
    """What a word says of itself (``place`` 0) or of the word it stands so many places from."""
    shape, rough, kinds, cue, amount, ends = about
    names = [f"{place}w{cue}"] if cue else []
    if abs(place) < 2:
        names += [f"{place}c{rough}", f"{place}k{kinds}", f"{place}e{ends:d}"]
    names.append(f"{place}n{amount}")
    return [*names, f"0s{shape}", "0"] if place == 0 else names


# ---- the field ----------------------------------------------------------------------------


def _key(words: Iterable[str]) -> np.ndarray:
    """The first eight bytes of words as one number."""
    return np.array([int.from_bytes(w.encode()[:8], "little") for w in words], np.uint64)


class Field:
    """The fitted field, and for words as they come the scores they give to themselves and their neighbours."""

    def __init__(self, rows: Iterable[tuple[str, list[tuple[str, int, int]]]]):
        rows = list(rows)
        kinds = sorted({k for _, spans in rows for k, _, _ in spans}, key=lambda k: (ADDED.index(k) if k in ADDED else len(ADDED), k))
        self.kinds = ["", *kinds]
        lines = [self._labelled(text, spans) for text, spans in rows]
        plain = {w.rstrip(".!?").translate(_AS_LOWER) for line in lines for w, kind in line if not kind}
        often = {}
        for line in lines:
            for w in {w.rstrip(".!?").translate(_AS_LOWER) for w, _ in line}:
                often[w] = often.get(w, 0) + 1
        # Words that several rows have, of letters only and so short that eight bytes tell them apart.
        self.cues = frozenset(w for w in plain if often[w] >= 6 and 1 < len(w) <= 8 and w.isalpha() and w.isascii())
        self.chain = Chain(self.kinds, [(self._features([w for w, _ in line]), [k for _, k in line]) for line in lines])
        self.limit = self.chain.settled(0)
        self.cue_list = sorted(self.cues, key=lambda w: int(_key([w])[0]))
        self.cue_keys = _key(self.cue_list)
        self.cue_lengths = np.array(list(map(len, self.cue_list)))
        self.first_odd = len(PLAIN) * 2 * (len(self.cue_list) + 1)
        plain_ones = [(s, s, "", c, "0", e) for s in PLAIN for e in (False, True) for c in ("", *self.cue_list)]
        self._plain_table = np.array([self._scores(x) for x in plain_ones], np.float32).reshape(len(plain_ones), len(PLACES), len(self.kinds))
        self._forget()

    def __getstate__(self) -> dict:
        """Without what a worker has met."""
        return {**self.__dict__, "known": {}, "described": {}, "odd": []}

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.described: dict[About, int] = {}
        self.odd: list[np.ndarray] = []

    def _scores(self, about: About) -> np.ndarray:
        return np.stack([self.chain.weight(features(about, p)) for p in PLACES])

    @staticmethod
    def _labelled(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str]]:
        """The words of a row with their kinds."""
        raw = text.encode()
        data = np.frombuffer(raw, np.uint8)
        at = [len(text[:i].encode()) for _, i, _ in spans]
        to = [len(text[:i].encode()) for _, _, i in spans]
        line = []
        for a, b in zip(*split(data, np.array([0, len(raw)]))):
            kind = next((k for (k, _, _), i, j in zip(spans, at, to) if a < j and b > i), "")
            line.append((raw[a:b].decode(), kind))
        return line

    def _features(self, words: list[str]) -> list[list[str]]:
        about = [describe(w, self.cues) for w in words]
        return [
            [f for p in PLACES if 0 <= i + p < len(about) for f in features(about[i + p], p)] for i in range(len(about))
        ]

    def _word_rows(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each word the row of the score table that its description has."""
        if len(self.known) > REMEMBERED or len(self.odd) > REMEMBERED // 10:
            self._forget()
        length = ends - starts
        close = _ENDS[data[ends - 1]] & (length > 1)
        stop = ends - close
        bits = np.concatenate((_BITS[data], [0]))
        all_bits = np.bitwise_or.reduceat(bits, np.stack((starts, stop), 1).ravel())[::2]
        large = np.concatenate(([0], np.cumsum(bits[:-1] == _LARGE)))
        capitals = large[stop] - large[starts]
        head = bits[starts] == _LARGE
        shape = np.select([capitals == 0, capitals == stop - starts, (capitals == 1) & head], [0, 2, 1], 3)

        padded = np.concatenate((LOWER[data], np.zeros(8, np.uint8)))
        first = padded[starts[:, None] + np.arange(8)]
        first *= np.arange(8) < (stop - starts)[:, None]
        keys = first.view("<u8").ravel()
        cue = np.zeros(len(keys), np.int64)
        if self.cue_list:
            at = np.searchsorted(self.cue_keys, keys).clip(max=len(self.cue_list) - 1)
            cue = np.where((self.cue_keys[at] == keys) & (self.cue_lengths[at] == stop - starts), at + 1, 0)
        rows = (shape * 2 + close) * (len(self.cue_list) + 1) + cue
        for i in np.flatnonzero(all_bits & (_DIGIT | _SIGN)).tolist():
            word = data[starts[i] : ends[i]].tobytes()
            row = self.known.get(word)
            if row is None:
                about = describe(word.decode("utf-8", "replace"), self.cues)
                row = self.described.get(about)
                if row is None:
                    row = self.described[about] = self.first_odd + len(self.odd)
                    self.odd.append(self._scores(about).astype(np.float32))
                if len(word) <= 64:
                    self.known[word] = row
            rows[i] = row
        return rows

    def score(self, data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words, the text each is of, and the score of every label."""
        starts, ends = split(data, limits)
        if not len(starts):
            return starts, ends, starts, np.zeros((0, len(self.kinds)), np.float32)
        rows = self._word_rows(data, starts, ends)
        table = np.concatenate((self._plain_table, np.array(self.odd, np.float32).reshape(-1, *self._plain_table.shape[1:])))
        text = np.searchsorted(limits, starts, "right") - 1
        score = table[rows, 0]
        for k, place in enumerate(PLACES[1:], 1):
            step = abs(place)
            if len(rows) <= step:
                continue
            same = (text[step:] == text[:-step])[:, None]
            if place < 0:
                score[step:] += table[rows[:-step], k] * same
            else:
                score[:-step] += table[rows[step:], k] * same
        return starts, ends, text, score

    def labels(self, text: np.ndarray, score: np.ndarray, *, cut: bool = True) -> np.ndarray:
        """The likeliest label of every word of every text, which stand one behind the other. ``cut``: decode
        only sequences of words that may be personal data; the result is the same."""
        found = np.zeros(len(text), np.int8)
        if len(self.kinds) == 1 or not len(text):
            return found
        others = score[:, 1:] - score[:, [0]]
        open_ = (others >= self.limit[1:]).any(axis=1) if cut else np.ones(len(text), bool)
        place = np.flatnonzero(open_)
        if not len(place):
            return found
        own = text[place]
        begins = np.concatenate(([True], (np.diff(place) > 1) | (np.diff(own) > 0)))
        first = np.flatnonzero(begins)
        last = np.concatenate((first[1:], [len(place)])) - 1
        row = np.cumsum(begins) - 1
        head, tail = place[first], place[last]
        at_start = (head == 0) | (text[head - 1] != text[head])
        at_end = (tail == len(text) - 1) | (text[np.minimum(tail + 1, len(text) - 1)] != text[tail])
        steps = self.chain.steps
        before = np.where(at_start[:, None], self.chain.starts, steps[0])
        behind = np.where(at_end[:, None], 0.0, steps[:, 0])
        found[place] = self.chain.likeliest(score[place], first, row, before, behind)
        return found


def _ip6(text: str) -> bool:
    groups = text.split(":")
    return text.count("::") <= 1 and (len(groups) == 8 or "::" in text) and all(re.fullmatch("[0-9A-Fa-f]{0,4}", g) for g in groups)


#: What a span the field found must hold besides, by kind.
_HOLDS = {
    "like_email": lambda s: bool(re.search(r"@|\(at\)|\[at\]|\{at\}", s, re.IGNORECASE)),
    "like_card": lambda s: 12 <= len(_digits(s)) <= 19 and luhn(_digits(s)),
    "like_phone": lambda s: 7 <= len(_digits(s)) <= 15,
    "like_ip": _ip6,
    "id": lambda s: len(_digits(s)) >= 6,
    "name": lambda s: not _digits(s),
}
_AROUND = " \t\n\r\x0b\x0c.,;:!?\"'<>[]{}|=#*&%$"


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    value = text[start:end]
    start += len(value) - len(value.lstrip(_AROUND))
    value = value.strip(_AROUND)
    if value.startswith("(") and ")" not in value:
        start, value = start + 1, value[1:]
    if value.endswith(")") and "(" not in value:
        value = value[:-1]
    return start, start + len(value)


def _kind(span: Span, kinds: list[str]) -> str:
    return KINDS[span[1]] if span[1] < len(KINDS) else kinds[span[1] - len(KINDS) + 1]


def find(field: Field, column: pa.Array) -> Iterator[tuple[int, list[Span]]]:
    """For each row of a column of texts that has any its spans in order: start, kind's number, end, text."""
    for first, last, data, limits in chunks(column):
        starts, ends, text, score = field.score(data, limits)
        labels = field.labels(text, score)
        hits = np.flatnonzero(labels)
        # Neighbours of the same kind are one span.
        new = np.concatenate(([True], (np.diff(hits) > 1) | (np.diff(labels[hits]) != 0) | (np.diff(text[hits]) > 0))) if len(hits) else hits
        heads = np.flatnonzero(new)
        tails = np.concatenate((heads[1:], [len(hits)])) - 1 if len(heads) else heads
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        marked: dict[int, list[tuple[int, int, int]]] = {}
        for a, b in zip(hits[heads].tolist(), hits[tails].tolist()):
            at = chars[limits[text[a]]]
            marked.setdefault(int(text[a]), []).append((int(chars[starts[a]] - at), int(labels[a]), int(chars[ends[b]] - at)))
        telling = np.concatenate(([0], np.cumsum((_BITS[data] == _DIGIT) | (data == 64))))
        worth = np.flatnonzero(np.diff(telling[limits]) > 0).tolist()
        for i in sorted({*worth, *marked}):
            value = column[first + i].as_py()
            base = base_spans(value)
            spans = base + list(_new(field, value, base, marked.get(i, [])))
            if spans:
                yield first + i, sorted(spans)


def _new(field: Field, text: str, base: list[Span], marked: list[tuple[int, int, int]]) -> Iterator[Span]:
    """Spans of the field that touch none of ``base`` and hold what they must."""
    k, reach = 0, sorted((a, b) for a, _, b, _ in base)
    ends = np.maximum.accumulate([b for _, b in reach]) if reach else []
    begins = [a for a, _ in reach]
    for start, label, end in marked:
        start, end = _trimmed(text, start, end)
        while k < len(begins) and begins[k] < end:
            k += 1
        if start >= end or (k and ends[k - 1] > start):
            continue
        value, kind = text[start:end], field.kinds[label]
        if _HOLDS.get(kind, bool)(value):
            yield start, len(KINDS) + label - 1, end, value


# ---- operators ----------------------------------------------------------------------------


@functools.cache
def _built_in() -> Field:
    return Field(pii_examples.labelled())


def fit(labelled: DataFrame | None = None) -> Field:
    """The field of a labelled table (``text``, ``spans`` array<struct<kind, start, end>>), of which at most
    EXAMPLES rows count, or of the built-in one."""
    if labelled is None:
        return _built_in()
    rows = labelled.select("text", "spans").orderBy(F.xxhash64("text"), "text").limit(EXAMPLES).collect()
    return Field([(r["text"] or "", [(s[0], s[1], s[2]) for s in r["spans"] or []]) for r in rows])


def _scan(field: Field):
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((len(KINDS) + 1, n), np.int64)
            digests, spans = [nothing] * n, [""] * n
            for i, found in find(field, texts(batch)):
                for s in found:
                    counts[min(s[1], len(KINDS)), i] += 1
                named = [(s[1] < len(KINDS), f"{_kind(s, field.kinds)}:{s[0]}:{s[2]}") for s in found]
                digests[i] = hashlib.sha256(",".join(x for base, x in named if base).encode()).hexdigest()
                spans[i] = ",".join(x for _, x in named)
            columns = [batch.column(0), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def personal(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans``.

    The counts of the four kinds are what the patterns find, ``n_added`` what the field adds;
    ``spans`` has kind:start:end of all in order, in code points. Null and empty texts have none.
    Repeated rows get the same result each, a null ``doc_id`` is kept, other columns are not looked
    at, and an empty table gives no rows.
    """
    shape = ", ".join(["doc_id bigint", *(f"n_{k} bigint" for k in (*KINDS, "added")), "base_sha256 string", "spans string"])
    return map_arrow(documents(docs), _scan(fit(labelled)), shape)


def _mask(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            column = batch.column(at)
            changed = {}
            for i, found in find(field, texts(batch)):
                text, parts, end = column[i].as_py(), [], 0
                for s in found:
                    if s[0] >= end:
                        parts += [text[end : s[0]], f"[{_kind(s, field.kinds)}]"]
                    end = max(end, s[2])
                changed[i] = "".join([*parts, text[end:]])
            if changed:
                values = [changed.get(i, x) if i in changed else x for i, x in enumerate(column.to_pylist())]
                batch = batch.set_column(at, "text", pa.array(values, column.type))
            yield batch

    return run


def masked(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``[kind]`` in place of all personal data in ``text``; all rows and columns stay."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_arrow(docs, _mask(fit(labelled)), fields)
