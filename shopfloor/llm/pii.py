"""Personal data in text, disguised forms included, with places in the source.

A text goes through a chain of transducers: characters that look like ASCII ones
become these and invisible ones vanish, spelled digits become digits, written-out
at signs and dots become ``@`` and ``.``, letters that stand in for digits become
digits. Every transducer returns its output with the edits it made, so a span
found in the last output is carried back, edit by edit, to the source. The same
detectors run on the source (the plain spans) and on the output; a find in the
output counts when its source is written differently.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KINDS = ("email", "ip", "card", "phone")

# The plain forms. Failing matches are dropped after they are found.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match always takes the whole of its first number, so none starts inside one.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]
Edit = tuple[int, int, str]

# Cyrillic and Greek letters that are drawn like Latin ones. Full-width, mathematical and other
# compatibility forms, foreign digits, dashes and spaces follow from Unicode itself.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z",
    "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o",
    "ν": "v", "ı": "i", "ɡ": "g", "ɑ": "a", "。": ".", "․": ".", "٠": "0", "−": "-",
}
# Digits in English, German, French and Spanish.
SPELLED = (
    ("zero", "null", "zéro", "cero"), ("one", "eins", "un", "uno"), ("two", "zwei", "deux", "dos"),
    ("three", "drei", "trois", "tres"), ("four", "vier", "quatre", "cuatro"), ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"), ("seven", "sieben", "sept", "siete"), ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
)
# Top-level names on which an address written with a plain "at" and "dot" has to end, or any prose would do.
TOP_LEVEL = frozenset(
    "com org net edu gov mil int info biz io dev app ai co eu de at ch fr es it uk us ca au nl be pl pt se no dk fi ie br"
    " mx ar cl ru ua cn jp kr za nz example test invalid".split()
)
#: Spelled digits in a row from which they are read as a number.
SPELLED_RUN = 3
#: Letters that stand in for digits, and the length of a number in which they may.
STAND_INS = {"O": "0", "o": "0", "I": "1", "l": "1", "|": "1"}
STAND_IN_RUN = 10

_VALUE = {word: str(value) for value, words in enumerate(SPELLED) for word in words}
_WORD = re.compile(rf"(?<![^\W_])(?:{'|'.join(sorted(_VALUE, key=len, reverse=True))})(?![^\W_])", re.IGNORECASE)
_BETWEEN = re.compile(r"[\x20\t]{0,2}[-,/]?[\x20\t]{0,2}")
_PLUS = re.compile(r"(?<![^\W_])plus[\x20\t]{1,3}(?=\(?[0-9])", re.IGNORECASE)

_GAP = r"[\x20\t]{0,3}"


def _token(words: str, plain: str, coded: str) -> tuple[str, str]:
    """Bracketed or coded form of a sign, and its plain word between spaces."""
    return rf"{_GAP}[\[({{<]{_GAP}(?:{words}){_GAP}[\])}}>]{_GAP}|{coded}", rf"[\x20\t]{{1,3}}(?:{plain})[\x20\t]{{1,3}}"


_AT_STRONG, _AT_PLAIN = _token("at|@|arroba|arobase", "at|arroba|arobase", r"&#0*64;|&#x0*40;|&commat;")
_DOT_STRONG, _DOT_PLAIN = _token(r"dot|\.|punkt|punto|point", "dot|punkt|punto|point", r"&#0*46;|&#x0*2e;|&period;")
_AT = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?:(?P<strong>{_AT_STRONG})|(?P<plain>{_AT_PLAIN})|@{_GAP})(?=[A-Za-z0-9-])", re.IGNORECASE)
_DOT = re.compile(rf"(?P<strong>{_DOT_STRONG})|(?P<plain>{_DOT_PLAIN})|\.", re.IGNORECASE)
_CHAIN = re.compile(rf"[A-Za-z0-9-]+(?:(?:{_DOT_STRONG}|{_DOT_PLAIN}|\.)[A-Za-z0-9-]+)+", re.IGNORECASE)
_LOCAL_CHAIN = re.compile(rf"[A-Za-z0-9_%+-]+(?:(?:{_DOT_STRONG}|{_DOT_PLAIN}|\.)[A-Za-z0-9_%+-]+)+\Z", re.IGNORECASE)
#: Characters before an at sign in which disguised dots of the name are looked for; no address has a longer name.
NAME_LENGTH = 128
_NUMBER_DOT = re.compile(rf"(?<=[0-9])(?:{_DOT_STRONG}|{_DOT_PLAIN})(?=[0-9])", re.IGNORECASE)
_STAND_IN = re.compile(rf"(?<![A-Za-z0-9])[0-9OoIl|](?:[\x20().-]{{0,2}}[0-9OoIl|]){{{STAND_IN_RUN - 1},}}")


def _digits(text: str) -> str:
    return _NO_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Found from the at signs, so a long run of letters is walked through once."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield 0, start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def detect(text: str) -> list[Span]:
    """``kind, start, end`` of the plain forms, by kind and place; none overlap within a kind."""
    found = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                found.append((3, m.start(), m.end()))
    return found


class Shift:
    """The edits of one transducer, for carrying places of its output back to its input."""

    def __init__(self, edits: list[Edit]):
        self.into, self.out, self.source = [], [], []
        moved = 0
        for start, end, text in edits:
            self.into.append(start + moved)
            moved += len(text) - (end - start)
            self.out.append(end + moved)
            self.source.append((start, end))

    def _place(self, at: int) -> tuple[int, int]:
        """Start and end in the input of what one character of the output was made from."""
        i = bisect_right(self.into, at) - 1
        if i < 0:
            return at, at + 1
        if at < self.out[i]:
            return self.source[i]
        place = self.source[i][1] + at - self.out[i]
        return place, place + 1

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self._place(start)[0], self._place(end - 1)[1]


def _edited(text: str, edits: list[Edit]) -> str:
    parts, at = [], 0
    for start, end, new in edits:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]])


@lru_cache(maxsize=1)
def _alike() -> tuple[dict[int, str], re.Pattern]:
    """ASCII characters by what looks like them, and a pattern of invisible characters."""
    table, invisible = {}, []
    for code in range(0x80, 0x20000):
        char = chr(code)
        kind = unicodedata.category(char)
        plain = unicodedata.normalize("NFKC", char)
        if kind == "Cf" or char == "͏":
            invisible.append(char)
        elif unicodedata.decimal(char, None) is not None:
            table[code] = str(unicodedata.decimal(char))
        elif len(plain) == 1 and plain.isascii():
            table[code] = plain
        elif kind in ("Pd", "Zs"):
            table[code] = "-" if kind == "Pd" else " "
    table.update({ord(c): plain for c, plain in LOOKALIKES.items()})
    return table, re.compile(f"[{re.escape(''.join(invisible))}]+")


def invisible_edits(text: str) -> list[Edit]:
    if text.isascii():
        return []
    return [(m.start(), m.end(), "") for m in _alike()[1].finditer(text)]


def look_alikes(text: str) -> str:
    """One character for one, so that places stay."""
    return text if text.isascii() else text.translate(_alike()[0])


def spelled_edits(text: str) -> list[Edit]:
    """Runs of spelled digits as one number; shorter runs only between disguised dots."""
    runs: list[list[re.Match]] = []
    for m in _WORD.finditer(text):
        if runs and _BETWEEN.fullmatch(text, runs[-1][-1].end(), m.start()):
            runs[-1].append(m)
        else:
            runs.append([m])
    edits = []
    for run in runs:
        start, end = run[0].start(), run[-1].end()
        if len(run) < SPELLED_RUN:
            after, before = _DOT.match(text, end), text[max(0, start - 12) : start]
            last = list(_DOT.finditer(before))[-1:]
            dotted = (after and after.group() != ".") or (last and last[0].group() != "." and last[0].end() == len(before))
            if not dotted:
                continue
        edits.append((start, end, "".join(_VALUE[m.group().lower()] for m in run)))
    return edits


def plus_edits(text: str) -> list[Edit]:
    return [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]


def sign_edits(text: str) -> list[Edit]:
    """Disguised at signs with the dots around them, and disguised dots between numbers.

    A plain ``at`` counts only where the domain after it has a disguised dot too and
    ends on a usual name; one with real dots behind a real at sign is left as it is.
    """
    edits = {(m.start(), m.end()): "." for m in _NUMBER_DOT.finditer(text)}
    for at in _AT.finditer(text):
        domain = _CHAIN.match(text, at.end())
        if not domain:
            continue
        dots = list(_DOT.finditer(text, domain.start(), domain.end()))
        hidden = [d for d in dots if d.group() != "."]
        usual = text[dots[-1].end() : domain.end()].lower() in TOP_LEVEL
        if at["plain"] and not (hidden and usual) or at.group() == "@" and len(hidden) < len(dots):
            continue
        first = max(0, at.start() - NAME_LENGTH)
        name = _LOCAL_CHAIN.search(text, first, at.start())
        if name:
            hidden += [d for d in _DOT.finditer(text, name.start(), name.end()) if d.group() != "."]
        if at.group() != "@":
            edits[at.span()] = "@"
        edits.update({d.span(): "." for d in hidden})
    ordered, free = [], 0
    for (start, end), new in sorted(edits.items()):
        if start >= free:
            ordered.append((start, end, new))
            free = end
    return ordered


def stand_in_edits(text: str) -> list[Edit]:
    """Letters for digits in long numbers that are digits for the most part."""
    edits = []
    for m in _STAND_IN.finditer(text):
        marks = [c for c in m.group() if c in STAND_INS]
        if marks and 2 * len(marks) < len(_digits(m.group())):
            edits += [(i, i + 1, STAND_INS[text[i]]) for i in range(*m.span()) if text[i] in STAND_INS]
    return edits


TRANSDUCERS: tuple[Callable[[str], list[Edit]], ...] = (
    invisible_edits, spelled_edits, plus_edits, sign_edits, stand_in_edits,
)


def normalise(text: str) -> tuple[str, list[Shift]]:
    """The text without disguises, and the edits of every transducer that made some."""
    out, shifts = look_alikes(text), []
    for transducer in TRANSDUCERS:
        edits = transducer(out)
        if edits:
            out = _edited(out, edits)
            shifts.append(Shift(edits))
    return out, shifts


def disguised(text: str, plain: list[Span]) -> list[Span]:
    """Finds in the normalised text whose source is written differently and lies in no plain find of the kind."""
    out, shifts = normalise(text)
    found = []
    if out == text:
        return found
    for kind, start, end in detect(out):
        a, b = start, end
        for shift in reversed(shifts):
            a, b = shift.back(a, b)
        if text[a:b] != out[start:end] and not any(k == kind and x <= a and b <= y for k, x, y in plain):
            found.append((kind, a, b))
    return found


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans, by kind and place."""
    plain = detect(text)
    return plain, sorted({*plain, *disguised(text, plain)})


def _scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``_known`` and ``_spans``; one pass, nothing moves."""
    texts = docs.select(*keep, F.col("text").alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(value.as_py() or "") for value in batch.column(len(keep))]
            columns = [
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row[i]] for row in found], kind) for i in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], names=[*keep, "_known", "_spans"])

    span = "array<struct<kind: int, start: bigint, end: bigint>>"
    added = StructType.fromDDL(f"_known {span}, _spans {span}")
    return texts.mapInArrow(look, StructType([*texts.schema.fields[: len(keep)], *added.fields]))


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id, known, spans`` of every row: arrays of ``kind, start, end``.

    ``known`` are the plain forms, ``spans`` these and the disguised ones, by kind
    (its number in ``KINDS``) and place; places are code points of the source, the
    end exclusive. Null and empty texts have none. Rows may repeat or lack a
    doc_id; other columns are not looked at; an empty table gives no rows. Whole
    texts are read, each by patterns that pass over it a fixed number of times.
    """
    return _scan(docs, ["doc_id"]).select("doc_id", F.col("_known").alias("known"), F.col("_spans").alias("spans"))


def span_names(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs``; every find in ``text`` is replaced by its kind in brackets, as ``[EMAIL]``.

    Overlapping finds are replaced once, under the kind of the one that starts
    first (of these the longest).
    """
    at = docs.columns.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at).to_pylist():
                edits: list[Edit] = []
                for start, end, kind in sorted(((s, e, k) for k, s, e in find_spans(text or "")[1]), key=lambda s: (s[0], -s[1])):
                    if edits and start < edits[-1][1]:
                        edits[-1] = (edits[-1][0], max(end, edits[-1][1]), edits[-1][2])
                    else:
                        edits.append((start, end, f"[{KINDS[kind].upper()}]"))
                texts.append(_edited(text, edits) if edits else text)
            columns = batch.columns
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(replace, docs.schema)
