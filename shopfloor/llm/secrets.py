"""Secrets in text: known forms, and strings that look drawn at random.

A long run of key characters is read as the narrowest usual encoding that has all
its letters; where none has, its parts are. A battery of tests (chi-squared over the alphabet, runs about the
median, serial correlation) asks whether it could be drawn uniformly from that
alphabet. Among those that could, the question is whether writing of the same
length would look as even by chance: its probability is a p-value that short
strings cannot make small. The Benjamini-Hochberg rule over all strings tested in
the corpus keeps the expected share of false finds below a bound.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopfloor.llm.memory import tidied
from shopfloor.session import materialize

KINDS = ("assign", "access", "hex", "random")

# The known forms. Failing matches are dropped after they are found.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH = 6

#: Shortest string that is tested.
TEST_LENGTH = 16
#: A string below this combined p-value is not uniform.
UNIFORM_LEVEL = 0.001
#: Expected share of false finds among the random strings.
FALSE_SHARE = 0.01
#: Width of the classes of -log10 p in which p-values are counted, and their number.
STEP, CLASSES = 0.05, 800
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{TEST_LENGTH},}}")
#: Where no encoding has all characters of a candidate: its parts in letters and digits, base64 and base64url.
_PARTS = [re.compile(rf"[A-Za-z0-9{more}]{{{TEST_LENGTH},}}") for more in ("", "+/", "_-")]
#: Words and separators at the ends of a part, as in a path; the second for reversed text.
_BEFORE, _AFTER = re.compile(r"(?:(?:[A-Z]?[a-z]{2,})?[+/_-])*"), re.compile(r"(?:(?:[a-z]{2,}[A-Z]?)?[+/_-])*")

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings from narrow to wide, and how often two characters of ordinary strings
#: within the alphabet agree: numbers for digits and hex, prose letters otherwise.
ENCODINGS = (
    ("decimal", _DIGITS, 0.15),
    ("hex", _DIGITS + "abcdef", 0.12),
    ("hex", _DIGITS + "ABCDEF", 0.12),
    ("base32", _UPPER + "234567", 0.066),
    ("base36", _DIGITS + _LOWER, 0.066),
    ("base62", _UPPER + _LOWER + _DIGITS, 0.066),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", 0.066),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", 0.066),
)


def infer_encoding(text: str) -> tuple[str, str, float] | None:
    """The first encoding whose alphabet has all characters of ``text``."""
    letters = set(text)
    return next((e for e in ENCODINGS if letters <= set(e[1])), None)


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_p(values: list[int], size: int) -> float:
    """Chance that a uniform draw is as uneven; exact mean and variance, normal tail."""
    n = len(values)
    stat = sum(c * c for c in Counter(values).values()) * size / n - n
    return _upper_tail((stat - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))


def runs_p(values: list[int], size: int) -> float:
    """Chance of as odd a number of runs in the lower and the upper half of the alphabet."""
    high = [2 * v >= size for v in values]
    n, a = len(high), sum(high)
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    mean = 1 + 2 * a * b / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    return 2 * _upper_tail(abs(runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0


def serial_p(values: list[int]) -> float:
    """Chance of as large a correlation between neighbours, the last next to the first."""
    n = len(values)
    mean = sum(values) / n
    spread = sum((v - mean) ** 2 for v in values)
    if not spread:
        return 0.0
    r = sum((x - mean) * (y - mean) for x, y in zip(values, [*values[1:], values[0]])) / spread
    return 2 * _upper_tail(abs(r + 1 / (n - 1)) * math.sqrt(n))


def evenness_p(values: list[int], agree: float) -> float:
    """Chance that ordinary writing of this length has as few equal pairs of characters."""
    n = len(values)
    pairs = sum(c * (c - 1) // 2 for c in Counter(values).values())
    mean = n * (n - 1) / 2 * agree
    # Poisson distribution function by its terms, from the largest on.
    term = math.exp(pairs * math.log(mean) - mean - math.lgamma(pairs + 1))
    total, k = 0.0, pairs
    while term > total * 1e-12 and k >= 0:
        total += term
        term *= k / mean
        k -= 1
    return min(1.0, total)


def evidence(text: str) -> float:
    """-log10 of the p-value against ordinary writing; 0 where the battery rejects uniformity."""
    found = infer_encoding(text)
    if found is None:
        return 0.0
    _, alphabet, agree = found
    values = [alphabet.index(c) for c in text]
    ps = chi_squared_p(values, len(alphabet)), runs_p(values, len(alphabet)), serial_p(values)
    if 3 * min(ps) < UNIFORM_LEVEL:
        return 0.0
    p = max(evenness_p(values, agree), 10 ** (-STEP * CLASSES))
    return math.floor(-math.log10(p) / STEP) * STEP


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the known forms, leftmost without overlaps in each kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def strongest_parts(text: str, start: int, end: int) -> list[tuple[int, int, float]]:
    """``start, end, evidence`` of parts that do not overlap, those of most evidence first chosen.

    Words of a path before and after a part are no part of it. The p-value of each
    is multiplied by the number of parts looked at.
    """
    parts = set()
    for m in (m for pattern in _PARTS for m in pattern.finditer(text, start, end)):
        a, b = m.start() + _BEFORE.match(m.group()).end(), m.end() - _AFTER.match(m.group()[::-1]).end()
        if b - a >= TEST_LENGTH:
            parts.add((a, b))
    each = [(a, b, max(0.0, evidence(text[a:b]) - math.log10(len(parts)))) for a, b in parts]
    found: list[tuple[int, int, float]] = []
    for a, b, e in sorted(each, key=lambda p: (-p[2], p[1] - p[0], p[0])):
        if all(b <= x or y <= a for x, y, _ in found):
            found.append((a, b, math.floor(e / STEP + 1e-9) * STEP))
    return sorted(found)


def tested_strings(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, float]]:
    """``start, end, evidence`` of the strings the battery is applied to; known secrets are not tested again."""
    found = []
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        fits = infer_encoding(m.group()) is not None
        for a, b, e in [(start, end, evidence(m.group()))] if fits else strongest_parts(text, start, end):
            if not any(x <= a and b <= y for x, _, y in known):
                found.append((a, b, e))
    return found


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``_known`` and ``_tested``, the spans found; a written table."""
    texts = docs.select(*keep, F.col("text").alias("_text"))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    tests = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("evidence", pa.float64())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, tested = [], []
            for value in batch.column(len(keep)):
                text = value.as_py() or ""
                spans_here = known_spans(text)
                known.append([{"start": a, "kind": k, "end": b} for a, k, b in spans_here])
                tested.append([{"start": a, "end": b, "evidence": e} for a, b, e in tested_strings(text, spans_here)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(known, spans), pa.array(tested, tests)],
                names=[*keep, "_known", "_tested"],
            )

    added = StructType.fromDDL(
        "_known array<struct<start: bigint, kind: int, end: bigint>>, "
        "_tested array<struct<start: bigint, end: bigint, evidence: double>>"
    )
    schema = StructType([*texts.schema.fields[: len(keep)], *added.fields])
    return materialize(texts.mapInArrow(tidied(look), schema), "scanned")


def discovery_level(scanned: DataFrame, share: float = FALSE_SHARE) -> float:
    """Least evidence of a find: Benjamini-Hochberg over the counts of all strings tested.

    The driver gets one count per class of evidence, at most ``CLASSES`` + 1.
    """
    step = F.round(F.col("evidence") / STEP).cast("int")
    rows = scanned.select(F.explode("_tested.evidence").alias("evidence")).groupBy(step.alias("class")).count().collect()
    counts = {r["class"]: r["count"] for r in rows}
    total, above, level = sum(counts.values()), 0, math.inf
    for at in sorted(counts, reverse=True):
        above += counts[at]
        # A class holds p-values of at most 10 ** -(its evidence).
        if at and total * 10 ** (-at * STEP) <= share * above:
            level = at * STEP
    return level


def _spans(level: float) -> tuple[Column, Column]:
    """Known spans, and known spans with the random strings of at least ``level``."""
    random = F.filter("_tested", lambda t: t["evidence"] >= level - STEP / 2)
    more = F.transform(random, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return F.array_sort("_known"), F.array_sort(F.concat("_known", more))


def find_secrets(docs: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """``doc_id, known, spans`` of every row: arrays of ``start, kind, end``.

    ``known`` are the known forms, ``spans`` these and the random strings, by
    start and then kind (its number in ``KINDS``); places are code points, the end
    exclusive. Null and empty texts have none. Rows may repeat or lack a doc_id;
    other columns are not looked at; an empty table gives no rows.
    """
    scanned = scan(docs, ["doc_id"])
    known, spans = _spans(discovery_level(scanned, share))
    return scanned.select("doc_id", known.alias("known"), spans.alias("spans"))


def span_names(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def masked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    parts, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, share: float = FALSE_SHARE, mark: str = "[SECRET]") -> DataFrame:
    """The rows and columns of ``docs`` with every secret in ``text`` replaced by ``mark``."""
    scanned = scan(docs, docs.columns)
    _, spans = _spans(discovery_level(scanned, share))
    at = docs.columns.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                text if not found else masked(text, [(s["start"], s["end"]) for s in found], mark)
                for text, found in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
            ]
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return scanned.select(*docs.columns, spans.alias("_spans")).mapInArrow(tidied(replace), docs.schema)
