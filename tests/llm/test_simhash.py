from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from shopfloor.llm import simhash
from shopfloor.llm.components import connected_components


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "One", "Two words", "a b c", "A b C d e f g", "Ünï  CÖDÉ x y\x0bz w", "x " * 70_000]
)
def test_fingerprint_is_the_majority_of_bits(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_radii_cover_every_distance():
    for segments in (1, 2, 3, 4):
        for radius in range(7):
            radii = simhash.segment_radii(segments, radius)
            assert len(radii) == segments
            assert sum(r + 1 for r in radii) == radius + 1


@pytest.mark.parametrize(("radius", "segments"), [(0, 2), (1, 2), (2, 2), (3, 2), (2, 3), (3, 4)])
def test_links_equal_brute_force(spark, radius, segments):
    rng = random.Random(radius)
    marks = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(60):
        mark = rng.getrandbits(64)
        marks |= {mark ^ sum(1 << b for b in rng.sample(range(64), k)) for k in range(5)}
    signed = {m: int(np.array(m, dtype="<u8").view("<i8")) for m in marks}
    rows = spark.createDataFrame([(v,) for v in signed.values()], "fingerprint long")
    found = {frozenset(r) for r in simhash.linked_fingerprints(rows, radius, segments).collect()}
    names = list(signed)
    want = {
        frozenset((signed[a], signed[b]))
        for i, a in enumerate(names)
        for b in names[i + 1 :]
        if (a ^ b).bit_count() <= radius
    }
    assert found == want


def test_components_of_chains_stars_and_copies(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (120, 130), (130, 120)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)}


def test_no_links_no_components(spark):
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_groups_of_documents(documents):
    long = " ".join(f"word{i}" for i in range(300))
    docs = documents(
        [(5, long), (3, long), (3, long), (9, None), (8, ""), (7, "  "), (None, long), (4, "quite another text here"), (None, "alone it is")]
    )
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    got = Counter((r["doc_id"], r["component_id"]) for r in found.collect())
    assert got == Counter(
        {(5, 3): 1, (3, 3): 2, (9, 7): 1, (8, 7): 1, (7, 7): 1, (None, 3): 1, (4, 4): 1, (None, None): 1}
    )
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 3, 4, 7]


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.keep_one(documents([])).count() == 0


def test_rows_that_share_a_doc_id_are_kept_by_their_text(documents):
    rows = [(1, "alpha beta gamma delta"), (2, "one two three four five"), (2, "alpha beta gamma delta"), (2, "one two three four five")]
    kept = simhash.keep_one(documents(rows))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "alpha beta gamma delta"), (2, "one two three four five")]
