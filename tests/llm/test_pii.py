"""Plain finds against the plain patterns; planted disguises found at their places in the source."""

from __future__ import annotations

import hashlib
import random
import re
import time

import duckdb
import pytest

from shopfloor.llm import pii
from shopfloor.llm.registry import op12_pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The contract's patterns, applied one by one."""

    def digits(s):
        return [int(c) for c in s if c in "0123456789"]

    def checks(ds):
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(ds))]
        return sum(doubled) % 10 == 0

    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [
        (2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and checks(digits(m.group()))
    ]
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]


def names(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)


def test_plain_forms_are_those_of_the_patterns():
    rng = random.Random(3)
    pieces = ["a", "Z", "9", "255", "256", "@", "@@", ".", "..", "-", " ", "+", "+1", "(", ")", "é", "００", "4111 1111 1111 1111",
              "10.0.0.1", "x@y.z", "%", "_", "\n", "+49 (0)30 1234567", "5500-0000-0000-0004", "1.2.3.4.5.6.7.8"]
    for _ in range(20000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.detect(text) == plain(text), text


def test_query_has_the_plain_spans_of_all_documents(spark, data):
    got = {r["doc_id"]: r for r in op12_pii(spark, data).collect()}
    documents = duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall()
    assert len(got) == len(documents)
    for doc_id, text in documents:
        found = plain(text or "")
        row = got[doc_id]
        counts = [sum(k == kind for k, _, _ in found) for kind in range(4)]
        assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == counts
        assert row["base_sha256"] == hashlib.sha256(names(found).encode()).hexdigest()
        assert set(names(found).split(",")) <= set(row["spans"].split(","))


DISGUISED = [
    ("email", "jane (at) example (dot) org"),
    ("email", "jane.doe[at]example[dot]co[dot]uk"),
    ("email", "jane dot doe at example dot org"),
    ("email", "jane at mail dot example dot org"),
    ("email", "jane@example dot org"),
    ("email", "jane&#64;example&#46;org"),
    ("email", "jаne@exаmple.org"),
    ("email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｏｒｇ"),
    ("email", "ja​ne@exam­ple.org"),
    ("email", "𝐣𝐚𝐧𝐞@example.org"),
    ("email", "jane arroba example punto es"),
    ("ip", "10 dot 0 dot 12 dot 255"),
    ("ip", "10[.]0[.]12[.]255"),
    ("ip", "one nine two dot one six eight dot zero dot one"),
    ("ip", "１０.０.１２.２５５"),
    ("card", "four one one one one one one one one one one one one one one one"),
    ("card", "４１１１ １１１１ １１１１ １１１１"),
    ("card", "4lll 1111 1111 11I1"),
    ("card", "4111​111111111111"),
    ("card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ("card", "vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins"),
    ("phone", "plus four nine three zero one two three four five six"),
    ("phone", "+４９ ３０ １２３４５６７"),
    ("phone", "+49 3O l23 4567 89"),
    ("phone", "plus 49 30 1234567"),
    ("phone", "+49‑30‑1234567"),
]


@pytest.mark.parametrize(("kind", "text"), DISGUISED)
@pytest.mark.parametrize(("before", "after"), [("", ""), ("é “reach me”: ", ", or later."), ("x​y ＡＢ ", "\nand more １２")])
def test_disguises_are_found_at_their_places(kind, text, before, after):
    _, spans = pii.find_spans(before + text + after)
    found = [(before + text + after)[a:b] for k, a, b in spans if pii.KINDS[k] == kind]
    assert text in found, spans


def test_any_chain_of_disguises_maps_back():
    rng = random.Random(5)
    wide = {c: chr(ord(c) + 0xFEE0) for c in map(chr, range(33, 127))}
    cyrillic = {"a": "а", "e": "е", "o": "о", "p": "р", "c": "с"}
    for _ in range(3000):
        name = "".join(rng.choice("abcdefop") for _ in range(rng.randint(1, 8)))
        host = "".join(rng.choice("abcdefop") for _ in range(rng.randint(1, 8)))

        def letters(word):
            return "".join(
                rng.choice([c, c, wide[c], cyrillic.get(c, c), c + "‍" if i < len(word) - 1 else c])
                for i, c in enumerate(word)
            )

        at = rng.choice(["@", "＠", " (at) ", "[AT]", " { at } "])
        dot = rng.choice([".", "．", "[dot]", " (dot) "])
        address = letters(name) + at + letters(host) + dot + letters("org")
        before, after = rng.choice([("", ""), ("é: ", "!"), ("(​", ")"), ("ｆｕｌｌ ", " ｗｉｄｅ")])
        text = before + address + after
        _, spans = pii.find_spans(text)
        assert (0, len(before), len(before) + len(address)) in spans, (text, spans)


def test_prose_stays_clean():
    for text in [
        "Look at example.com and at the dot on the map.",
        "They met at one, two or three o'clock; six of seven stayed.",
        "Version 1.2.3 and the point of it at the end. Plus one two.",
        "un deux trois, le point de vue; cero uno dos",
        "ö ä ü ß é ñ — “quoted” … ½ №",
        "lo OO ll 10 Il 0oO at 5 dot 6",
    ]:
        assert pii.find_spans(text) == ([], []), text


def test_shift_covers_deleted_and_grown_text():
    edits = [(1, 3, ""), (3, 4, "xyz"), (6, 9, "q")]
    text = "abcdefghij"
    out = pii._edited(text, edits)
    assert out == "axyzefqj"
    shift = pii.Shift(edits)
    assert shift.back(0, 1) == (0, 1)
    assert shift.back(1, 2) == (3, 4)
    assert shift.back(0, 5) == (0, 5)
    assert shift.back(6, 8) == (6, 10)


@pytest.mark.parametrize("piece", ["a", "1", "0 ", "@", "+1", "lo", "one ", "a.", "1.", " at a", " dot a", "(", "+1 ("])
def test_very_long_texts_take_linear_time(piece):
    text = piece * (400_000 // len(piece))
    start = time.perf_counter()
    pii.find_spans(text)
    assert time.perf_counter() - start < 10


def test_defined_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "a@b.co and a (at) b.co"), (4, "x " * 200_000 + "a@b.co")]
    got = sorted(
        ((r["doc_id"], [tuple(s) for s in r["known"]], [tuple(s) for s in r["spans"]]) for r in pii.find_pii(documents(rows)).collect()),
        key=lambda r: (r[0] is not None, r[0]),
    )
    mail = [(0, 0, 6)]
    assert got == [
        (None, mail, [(0, 0, 6), (0, 11, 22)]), (1, [], []), (2, [], []), (3, mail, mail), (3, mail, mail),
        (4, [(0, 400_000, 400_006)], [(0, 400_000, 400_006)]),
    ]
    assert pii.find_pii(documents([])).count() == 0


def test_redaction(spark, documents):
    df = documents([(1, "to a@b.co, 10 dot 0 dot 0 dot 1."), (2, None), (3, "none")])
    out = pii.redact(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, "to [EMAIL], [IP]."), (2, None), (3, "none")]
