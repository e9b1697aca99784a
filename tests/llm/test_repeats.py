from __future__ import annotations

import random
from collections import Counter

import pytest

from shopfloor.llm import repeats


def brute(docs, length):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[a : a + length] for _, t in texts for a in range(len(t) - length + 1))
    found = []
    for i, t in texts:
        gone = set()
        for a in range(len(t) - length + 1):
            if seen[t[a : a + length]] > 1:
                gone |= set(range(a, a + length))
        spans = [(a, min(b for b in range(a, len(t) + 1) if b not in gone)) for a in sorted(gone) if a - 1 not in gone]
        found.append((i, len(t), spans, bytes(c for a, c in enumerate(t) if a not in gone)))
    return sorted(found, key=str)


def run(docs, length, digit):
    found = repeats.remove_repeats(docs, length, digit).collect()
    return sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in found), key=str)


@pytest.fixture
def texts():
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdé ", k=70))
    docs = [(i, "".join(rng.choices("ab", k=rng.randint(0, 120)))) for i in range(40)]
    docs += [(100 + i, docs[i][1]) for i in range(6)]
    docs += [(200 + i, f"{docs[i][1]}{passage[: 10 + 5 * i]}{docs[i + 9][1]}") for i in range(10)]
    docs += [(300, None), (301, ""), (302, "aaaa" * 30), (303, "ab" * 60), (304, "x" * 20), (305, "x" * 20), (306, "x" * 19)]
    return [*docs, (1, docs[1][1]), (None, docs[2][1]), (None, "lonely é text of its own, all right")]


@pytest.mark.parametrize("large", [4096, 1])
def test_equals_brute_force(documents, texts, monkeypatch, large):
    monkeypatch.setattr(repeats, "LARGE_GROUP", large)
    assert run(documents(texts), 20, 6) == brute(texts, 20)


def test_stretches_cut_long_texts_with_overlap(monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 10)
    parts = [x for group in repeats.stretches([b"abcdefghijklmnopqrstuvwxyz", b"", b"abc"], 4) for x in group]
    assert parts == [(0, 0, b"abcdefghijklm"), (0, 10, b"klmnopqrstuvw"), (0, 20, b"uvwxyz"), (1, 0, b""), (2, 0, b"abc")]


def test_empty_and_short(documents):
    assert run(documents([]), 200, 50) == []
    assert run(documents([(1, "short"), (2, "short")]), 200, 50) == [(1, 5, [], b"short"), (2, 5, [], b"short")]
