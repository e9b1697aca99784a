from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopfloor.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "a", "  a  b ", "x \n y", "a  b", "\x1c a \x1cb", " lead", "it's 'twas   don't", "tab\t\tq \t", "é ̈x",
    "Ünïcödé ＡＢＣ ǅ ß İI Σας", "<|endoftext|> a<|endoftext|>", "123 4567 8,9", "a b c　d", "line.\nNext line,", "end ",
]


def direct(path, text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_encoding_at_once(name):
    path = public_tokenizers.path(name)
    encoder = tokens.WordEncoder(path)
    for text in [*ODD, " ".join(ODD), " ".join(ODD)]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == direct(path, text), text
    assert encoder.encode(None) == b""


def test_forgetting_changes_no_ids(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    encoder = tokens.WordEncoder(PATH)
    text = "one two three four five six one two seven one"
    assert np.frombuffer(encoder.encode(text) + encoder.encode(text), "<u4").tolist() == direct(PATH, text) * 2


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_together_equal_each_alone(name, monkeypatch):
    monkeypatch.setattr(tokens, "TOGETHER", 4)
    path = public_tokenizers.path(name)
    texts = [*ODD, None, "Ends. with, marks: x", " ".join(ODD)]
    got = tokens.WordEncoder(path).encode_all(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [direct(path, text or "") for text in texts]
    assert tokens.WordEncoder(path).encode_all([]) == []


def test_a_word_is_remembered_once():
    encoder = tokens.WordEncoder(PATH)
    encoder.encode_all(["so one, two one. one (one)\nthree one"])
    assert {"one", "one,", "two", "one.", "three"} & set(encoder._words) >= {"one", "one,", "two", "one."}
    assert not [piece for piece in encoder._pieces if piece[:1] == " " and piece[1:].isalpha()]


def test_only_the_first_piece_is_short():
    assert packing.piece_starts(3, 4) == [0]
    assert packing.piece_starts(4, 4) == [0]
    assert packing.piece_starts(9, 4) == [0, 1, 5]
    assert packing.piece_starts(12, 4) == [0, 4, 8]


@pytest.mark.parametrize("seed", range(6))
def test_slots_hold_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 100, 2048])
    most = rng.choice([capacity, capacity // 2, max(1, capacity // 5)])
    counts = Counter(rng.choices(range(1, most + 1), k=rng.choice([0, 1, 40, 3000])))
    slots, bins = packing.pack_lengths(counts, capacity)
    places: dict[int, list] = {}
    taken = Counter()
    for length, rank, n, first, copies, offset in slots:
        assert rank == taken[length] and n % copies == 0
        taken[length] += n
        for i in range(n):
            places.setdefault(first + i // copies, []).append((offset + i % copies * length, length))
    assert taken == counts and sorted(places) == list(range(bins))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in held) <= 2
    total = sum(k * v for k, v in counts.items())
    # Best fit, longest first, stays within 11/9 of the least number and 6/9 of a bin.
    assert bins <= 11 / 9 * max(-(-total // capacity), sum(v for k, v in counts.items() if 2 * k > capacity)) + 1


def test_large_lengths_are_matched_with_the_largest_that_fits():
    slots, bins = packing.pack_lengths({70: 1, 60: 1, 40: 1, 35: 1, 30: 1, 25: 1}, 100)
    assert bins == 3
    assert {(length, first, offset) for length, _, _, first, _, offset in slots} >= {(70, 0, 0), (60, 1, 0), (40, 1, 60)}


def test_documents_become_gapless_sequences(documents):
    texts = [(i, "some words here " * i) for i in range(0, 40, 3)] + [(7, None), (7, None), (None, "x"), (8, ""), (9, "long text " * 900)]
    rows = packing.pack_documents(documents(texts), PATH, 64).collect()
    whole = Counter()
    for doc_id, text in texts:
        ids = [*direct(PATH, text or ""), 0]
        starts = packing.piece_starts(len(ids), 64)
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            whole[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert whole == Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows)
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        ends = [0]
        for offset, length in sorted(held):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 64


def test_no_documents_no_sequences(documents):
    assert packing.pack_documents(documents([]), PATH).count() == 0
