"""The small labelled table that personal data is learnt from: patterns with slots, filled by rule."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

#: Rows made of the patterns.
ROWS = 1200

# Sentences people give personal data in; {slots} are filled below, {w}, {c} and {k} with other words.
WITH_DATA = (
    "{w} call me at {phone} tonight", "phone: {phone}", "Tel. {phone}", "my number is {phone} {w} {w}", "{w} fax {phone} {w}",
    "reach us on {phone} or {phone}", "Telefon {phone} {w} {w}", "{w} Rufnummer {phone}", "appelez le {phone} {w}",
    "{w} llame al {phone} {w}", "mobile {phone} {w} {w} {w}", "{w} telefono {phone}", "{w} text {phone} {w}",
    "{w} {w} write to {like_email} {w}", "email {like_email}", "mail: {like_email} {w}", "contact {like_email} for {w}",
    "{w} correo {like_email}", "{w} schreiben Sie an {like_email} {w}", "{w} {like_email} {w} {w}",
    "{w} server {like_ip} {w}", "address {like_ip}", "logged in from {like_ip} {w} {w}", "{w} {like_ip} {w}", "host {like_ip} port {n}",
    "{w} card {like_card} {w}", "card number {like_card}", "Karte {like_card} {w}", "carte {like_card}", "{w} {like_card} expires {date}",
    "{w} SSN {id} {w}", "social security number {id}", "{w} IBAN {id} {w}", "Konto {id}", "{w} account {id} {w} {w}", "{w} {id} {w}",
    "{w} {title} {name} {w} {w}", "{w}. {title} {name} {w}", "{title} {name}", "{w} {title} {name}. {c} {w}", "{w} {w} {title} {name}, {w} {w}", "{w} ich bin {title} {name} {w}", "signed by {title} {name}", "dear {title} {name} {w} {w}",
    "je suis {title} {name} {w}", "{w} con {title} {name} {w}", "{w} asked {title} {name} to {w} {w}",
)
# Sentences with numbers and signs that are no personal data.
WITHOUT_DATA = (
    "{w} {w} {w} {w} {w}", "{w} {w}, {w} {w} {w} {w}", "{w} {w} {w}", "{w} on {date} {w} {w}", "{w} {w} at {time} {w}", "costs {price} {w}",
    "{w} version {version} {w}", "{w} {n} {w} {w} {n}", "{w} {hash} {w}", "{w} {bad_card} {w} {w}", "{bad_card} {w} {bad_card}", "{w} {w} {percent} {w}",
    "{w} see {w}, page {n}-{n}", "{w} {bad_ip} {w}", "{w} {w} order {order} {w}", "{w} [{n}] {w} {w}", "{w} ({n}) {w}", "{n}. {w} {w}",
    "{w}### {w}*** {w} {w}&&& {w}", "{w} = {n} {w}", "{w} {w} http://{w}.org/{w} {w}", "{n} {n} {n} {n} {w}", "{w}-{w} {n}.{n} {w}",
    "number {n} of {w} {w}", "{c} {c} {c} {c} {c} {c}", "{w} is. {c} to {w}", "{w}. {c} {c} {w}", "{k}. {c} {k} {w}", "{k}.\n{c} {w}. {k}.\n{c} {c}", "{w} {c} {c}, {c} {c}. {c}", "the name is {w} {w}", "{w} email {w} to {w} {w}", "a card {w} {w}", "{w} {w} call at {time} {w}",
)
# D is a digit, g a hexadecimal one, L a capital.
FORMATS = {
    "phone": ("(ddd) ddd-dddd", "ddd-ddd-dddd", "ddd.ddd.dddd", "(ddd)ddd-dddd", "0ddd dddddd", "0dd/ddddddd", "0d dd dd dd dd", "ddd ddd dddd", "ddd-dddd", "0ddd-ddddddd", "1-ddd-ddd-dddd"),
    "like_ip": ("gggg:gggg:gggg:gggg:gggg:gggg:gggg:gggg", "gggg:ggg::gggg", "gggg::gg:gggg", "gggg:gg:g::gg"),
    "id": ("ddd-dd-dddd", "LLdd dddd dddd dddd dddd dd", "LLdd dddd dddd dddd", "LLdddddddddddddddddddd"),
    "n": ("d", "dd", "ddd", "dddd", "ddddd"),
    "date": ("dddd-dd-dd", "dd.dd.dddd", "dd/dd/dd", "dd/dd/dddd", "d.d.dddd"),
    "time": ("dd:dd", "dd:dd:dd", "d:dd"),
    "price": ("$dd.dd", "$dddd", "ddd.dd", "d.ddd.ddd"),
    "version": ("d.d", "d.d.d", "vd.dd.d", "d.dd.d.ddd"),
    "percent": ("dd%", "d.dd%"),
    "order": ("LLL-ddddd", "Lddd-ddd", "dd-dd", "#dddddd"),
    "hash": ("gggggggggggggggggggggggggggggggg", "gggggggggggggggggggggggggggggggggggggggg", "ggggggg"),
    "bad_ip": ("8dd.dd.9dd.dd", "7dd.4dd.d.dd"),
}
LIKE_EMAIL = ("{u} [at] {h} [dot] com", "{u}(at){h}.com", "{u} {{at}} {h} {{dot}} org", "{u}[at]{h}[dot]net", "{u} (at) {h} (dot) com", "{u}@{h}", "{u} [at] {h}.org")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Mr.", "Mrs.", "Dr.", "Prof.", "Herr", "Frau", "Madame")
CARDS = ("dddd.dddd.dddd.dddd", "dddd/dddd/dddd/dddd", "dddd_dddd_dddd_dddd", "dddd  dddd  dddd  dddd")
# Words that any text is full of.
COMMON = (
    "the of and to in is that for on at with as by an be it not are this from or have was you i he she "
    "de la que y el en los se del las un por con no una su para es al lo "
    "der die und das den von zu mit sich des auf ein ist nicht eine im dem "
    "le les des et est du une dans qui pas pour sur au ce il ne"
).split()
_SYLLABLES = ("ka", "mel", "to", "ris", "un", "de", "sha", "lor", "ven", "ti", "os", "bra", "é", "ün", "ña")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    numbers = [int(x) for x in reversed(digits)]
    return sum(numbers[::2] + [x * 2 - 9 * (x > 4) for x in numbers[1::2]]) % 10 == 0


class _Source:
    """Numbers that depend on a row's number only."""

    def __init__(self, row: int):
        self.row, self.asked = row, 0

    def number(self, below: int) -> int:
        self.asked += 1
        return int.from_bytes(hashlib.sha256(f"{self.row}:{self.asked}".encode()).digest()[:6], "big") % below

    def pick(self, options):
        return options[self.number(len(options))]

    def word(self) -> str:
        word = "".join(self.pick(_SYLLABLES) for _ in range(2 + self.number(3)))
        shape = self.number(12)
        return word.capitalize() if shape < 3 else word.upper() if shape == 3 else word + "." if shape == 4 else word

    def prose(self) -> str:
        """Some sentences."""
        words, begins = [], True
        for _ in range(6 + self.number(9)):
            word = self.pick(COMMON) if self.number(5) < 2 else "".join(self.pick(_SYLLABLES) for _ in range(2 + self.number(3)))
            chance = self.number(20)
            words.append((word.capitalize() if begins or chance == 0 else word) + {1: ".", 2: ",", 3: "!", 4: "?"}.get(chance, ""))
            begins = chance in (1, 3, 4)
        return " ".join(words)

    def name(self) -> str:
        return "".join(self.pick(_SYLLABLES[:12]) for _ in range(2 + self.number(2))).capitalize()

    def digits(self, form: str) -> str:
        sets = {"d": "0123456789", "g": "0123456789abcdef", "L": "ABCDEFGHIKLMNPRSTUZ"}
        return "".join(self.pick(sets[c]) if c in sets else c for c in form)

    def card(self, form: str, right: bool) -> str:
        text = self.digits(form)
        for last in "0123456789":
            if luhn("".join(c for c in text[:-1] + last if c.isdigit())) == right:
                return text[:-1] + last
        return text

    def fill(self, slot: str) -> str:
        if slot == "w":
            return self.word()
        if slot == "k":
            word = self.pick(COMMON)
            return word.capitalize() if self.number(2) else word
        if slot == "c":
            return self.name()
        if slot == "name":
            return " ".join(self.name() for _ in range(1 + self.number(2)))
        if slot == "title":
            return self.pick(TITLES)
        if slot == "like_card":
            return self.card(self.pick(CARDS), True)
        if slot == "bad_card":
            return self.card("dddddddddddddddd", False)
        if slot == "like_email":
            user, host = (self.name().lower() for _ in range(2))
            return self.pick(LIKE_EMAIL).format(u=user + self.pick(("", f".{self.name().lower()}", "7", "42")), h=host)
        return self.digits(self.pick(FORMATS[slot]))


def _filled(source: _Source, pattern: str) -> tuple[str, list[tuple[str, int, int]]]:
    text, spans = "", []
    for part in pattern.split("{"):
        slot, found, rest = part.partition("}")
        if not found:
            text += part
            continue
        start, text = len(text), text + source.fill(slot)
        kind = "like_phone" if slot == "phone" else slot
        if kind in ("like_phone", "like_email", "like_ip", "like_card", "id", "name"):
            spans.append((kind, start, len(text)))
        text += rest
    return text, spans


def labelled(rows: int = ROWS, first: int = 0) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """Rows of text and its (kind, start, end) spans; ``first`` is the number of the first one."""
    for i in range(first, first + rows):
        source, number = _Source(i), i // 3
        if i % 3 == 2:
            yield source.prose(), []
        else:
            patterns = WITHOUT_DATA if i % 3 else WITH_DATA
            yield _filled(source, patterns[number % len(patterns)])
