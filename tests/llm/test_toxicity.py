from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import toxicity


def corpus(n, seed=0):
    """Documents whose toxic ones have a few words of a hidden list."""
    rng = random.Random(seed)
    syllables = [a + b for a in "bcdfglmnprst" for b in ("a", "en", "io", "u")]
    bad = ["vrokkenz", "qwizzump", "xhaffled", "jubbrix"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(60, 200))]
        toxic = int(rng.random() < 0.3)
        for _ in range(len(words) // 15 * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.mark.parametrize("text", ["", "a", "word " * 200, "x" * 5000, " ".join("y" * n for n in range(300)), "Ünï " * 99])
def test_windows_hold_the_whole_text(text):
    parts = toxicity.windows(text)
    joined = " ".join(text.lower().split()).encode()
    assert b"".join(parts).replace(b" ", b"") == joined.replace(b" ", b"")
    assert all(len(p) <= toxicity.WINDOW + toxicity.LONGEST_WORD for p in parts)


def test_held_out_documents_are_told_apart(spark, documents):
    rows = corpus(900)
    docs = documents([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 0, x) for i, _, x in rows], "doc_id long, text int, toxic int")
    model = toxicity.learn(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()}
    out = [(i, x) for i, _, x in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, _ in out} == {i for i, r in found.items() if r["out"]}
    right = sum(found[i]["predicted"] == x for i, x in out)
    assert right / len(out) > 0.95
    assert sum(found[i]["predicted"] and not x for i, x in out) <= 0.01 * len(out)
    kept = toxicity.keep_civil(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if not r["predicted"]}


def test_labels_of_held_out_rows_change_nothing(spark, documents):
    rows = corpus(300)
    docs = documents([(i, t) for i, t, _ in rows])
    turned = [(i, 1 - x if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, _, x in rows]
    models = [
        toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        for labels in ([(i, x) for i, _, x in rows], turned)
    ]
    assert models[0].toxic == models[1].toxic and models[0].weights == models[1].weights


def test_rows_of_all_kinds_get_a_score(spark, documents):
    rows = corpus(200)
    labels = spark.createDataFrame([*[(i, x) for i, _, x in rows], (None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    model = toxicity.learn(documents([(i, t) for i, t, _ in rows]), labels)
    odd = documents([(1, None), (2, ""), (2, ""), (None, "some text"), (3, "   "), (4, "z" * 100_000)])
    found = toxicity.score(odd, model).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 for r in found)
    assert [r["score"] for r in found if r["doc_id"] in (1, 2, 3)] == [model.prior] * 4


@pytest.mark.parametrize("labels", [[], [(0, 0), (2, 0)], [(0, 1)]])
def test_nothing_to_learn_from(spark, documents, labels):
    docs = documents([(0, "a b"), (2, "c d")])
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [model.prior] * 2
    assert toxicity.score(documents([]), model).count() == 0


def test_only_near_copies_count_as_one_text():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("bcdfghjk", k=6)) for _ in range(3000)]
    # Every text has one of a few frequent words, among them that of least hash.
    texts = [" ".join([*rng.sample(vocabulary, rng.choice([5, 20, 80])), *rng.choices(["the", "of", "and"], k=9)]) for _ in range(200)]
    copies = [" ".join([*t.split()[:-1], "other"]) for t in texts[:50] if len(t.split()) > 20]
    found, n = toxicity._documents_with([*texts, *copies, texts[0], "", "12 34"])
    assert n == 200 and len(copies) > 20
    assert found[b"the"] == sum("the" in t.split() for t in texts) and found[b"other"] == len(copies)


@pytest.mark.parametrize("seed", range(4))
def test_groups_are_those_of_comparing_all_pairs(seed):
    rng = random.Random(seed)
    sets = [set(rng.sample(range(60), rng.randint(1, 30))) for _ in range(60)]
    for _ in range(120):
        changed = set(rng.choice(sets))
        for word in rng.sample(range(60), rng.randint(0, 4)):
            changed ^= {word}
        sets.append(changed or {7})
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    found = toxicity._near_copies([np.array(sorted(s)) for s in sets], 60)
    assert len(set(zip(found, group))) == len(set(found)) == len(set(group))
