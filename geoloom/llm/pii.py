"""Personal data by anchor expansion: an Aho-Corasick automaton finds signs and cues, a local parser for each settles the boundaries."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrays import map_arrow, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Kinds in the order in which spans that start together are listed; the first four are the base kinds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "address")

#: Schemes, words before an identifier and words that end a street address, as they are looked for (A-Z may be in either case).
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("account", "acct", "iban", "passport", "ssn", "customer id", "user id")
STREETS = ("street", "avenue", "road", "boulevard", "lane", "straße", "strasse")

_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ADDRESS_TAIL = re.compile(r"[^\s<>\"'\x60]+")
_LABEL = re.compile(r"(?:\s?(?:no\.?|number|nr\.?|#))?\s?[:=#]?\s?", re.IGNORECASE)
#: Blocks of four capitals or digits behind a country and two digits, the last one shorter if it holds a digit.
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: (?=[A-Z]*[0-9])[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
#: A first group with a digit, then groups of digits or of capitals with a digit: words behind a number are none of it.
_ACCOUNT = re.compile(r"[A-Za-z]{0,2}[0-9][A-Za-z0-9]*(?:[ -](?=[A-Z]*[0-9])[A-Z0-9]{2,}(?![A-Za-z0-9]))*")
_STREET_HEAD = re.compile(r"[0-9]{1,6}(?: [A-Z][\w'.-]{0,30}){1,4} $")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


class Finder:
    """Spans of one text, as (start, place of the kind, end). A parser starts at its anchor and never before the end of its last match."""

    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        anchors = {"@": ("email",), "+": ("phone",)}
        anchors |= {str(d): ("number",) for d in range(10)}
        for name, words in (("url", SCHEMES), ("account", CUES), ("address", STREETS)):
            for word in words:
                anchors[word] = (name,)
        for form, (name,) in anchors.items():
            self.automaton.add_word(form, (name, len(form)))
        self.automaton.make_automaton()

    def email(self, text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        return (start, domain.end(), True) if domain else None

    def phone(self, text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
        found = _PHONE.match(text, at)
        return (at, found.end(), 9 <= sum(c.isdigit() for c in found[0]) <= 15) if found else None

    def ip(self, text: str, at: int) -> tuple[int, bool]:
        found = _IP.match(text, at)
        return (found.end(), all(map(_byte, found.groups()))) if found else (_DIGITS.match(text, at).end(), False)

    def card(self, text: str, at: int) -> tuple[int, bool]:
        found = _CARD.match(text, at)
        if not found:
            return at + 1, False
        digits = found[0].replace(" ", "").replace("-", "")
        return found.end(), 12 <= len(digits) <= 19 and _luhn(digits)

    def url(self, text: str, start: int, end: int) -> tuple[int, int, bool] | None:
        tail = _ADDRESS_TAIL.match(text, end)
        if not tail:
            return None
        kept = tail[0].rstrip(".,;:!?)]}")
        return (start, end + len(kept), "." in kept or "@" in kept)

    def account(self, text: str, start: int, end: int) -> tuple[int, int, bool] | None:
        if start and text[start - 1].isalnum():
            return None
        at = _LABEL.match(text, end).end()
        found = _IBAN.match(text, at) or _ACCOUNT.match(text, at)
        return (at, found.end(), sum(c.isdigit() for c in found[0]) >= 5) if found else None

    def address(self, text: str, start: int, end: int) -> tuple[int, int, bool] | None:
        if end < len(text) and text[end].isalnum():
            return None
        floor = max(0, start - 160)
        head = _STREET_HEAD.search(text[floor:start])
        return (floor + head.start(), end, True) if head else None

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        floors, out = dict.fromkeys(KINDS, 0), []

        def take(kind: str, found: tuple[int, int, bool] | None) -> None:
            if found:
                start, end, right = found
                floors[kind] = end
                if right:
                    out.append((start, KINDS.index(kind), end))

        for last, (name, length) in self.automaton.iter(text.encode().translate(_FOLDED).decode()):
            at = last - length + 1
            if name == "number":
                for kind, parse in (("ip", self.ip), ("card", self.card)):
                    if at >= floors[kind]:
                        end, right = parse(text, at)
                        take(kind, (at, end, right))
            elif at >= floors[name]:
                take(name, getattr(self, name)(text, at, floors[name] if name in BASE else last + 1))
        out.sort()
        return out


def _spans_of(finder: Finder, texts: pa.Array) -> Iterator[list[tuple[int, int, int]]]:
    for text in texts:
        value = text.as_py()
        yield finder.spans(value) if value else []


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and `spans`, an array of (kind, start, end, value) by start and kind, in code points, end exclusive.

    email, ip, card and phone are exactly the leftmost matches of their
    patterns that pass their check; url, account and address come on top. An
    account is the number behind a cue, five digits at least: one group, more of
    them if they hold digits, or an IBAN in its blocks. An address is a number of
    at most six digits, one to four capitalised words of at most 31 characters and
    a street word. A null or empty text has no spans. Null and repeated ids are kept as they are.
    Other columns are not read.
    """

    def rows(batches):
        finder = Finder()
        for batch in slices(batches):
            texts = batch.column(1)
            found = [[{"kind": KINDS[k], "start": s, "end": e, "value": t.as_py()[s:e]} for s, k, e in spans] for t, spans in zip(texts, _spans_of(finder, texts), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], names=["id", "spans"])

    return map_arrow(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), rows, "id long, spans array<struct<kind: string, start: long, end: long, value: string>>").withColumnRenamed("id", id_col)


def mask_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with personal data replaced by its kind in brackets; spans that overlap are replaced together, under the name of the first.

    All columns are kept whatever their names; only `text_col` changes. A null text stays null.
    """
    place = docs.columns.index(text_col)

    def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
        out, done, open_until, name = [], 0, -1, None
        for start, kind, end in spans:
            if name is None or start >= open_until:
                if name is not None:
                    out.append(f"[{name.upper()}]")
                    done = open_until
                out.append(text[done:start])
                name, open_until = KINDS[kind], end
            open_until = max(open_until, end)
        if name is None:
            return text
        return "".join([*out, f"[{name.upper()}]", text[open_until:]])

    def rows(batches):
        finder = Finder()
        for batch in slices(batches):
            texts = batch.column(place)
            new = [masked(t.as_py(), spans) for t, spans in zip(texts, _spans_of(finder, texts), strict=True)]
            yield batch.set_column(place, batch.schema.field(place).with_type(pa.string()).name, pa.array(new, pa.string()))

    typed = docs.withColumn(text_col, F.col(text_col).cast("string"))
    return map_arrow(typed, rows, typed.schema)
