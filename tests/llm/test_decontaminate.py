from __future__ import annotations

import itertools
import random
import re

import pytest

from shopfloor.llm import decontaminate


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, size):
    found = []
    for doc_id, text in docs:
        w = words(text)
        hit, named = set(), set()
        for item_id, item in items:
            iw = words(item)
            n = min(size, len(iw))
            for i in range(len(iw) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == iw[i : i + n]:
                        hit |= set(range(at, at + n))
                        if item_id is not None:
                            named.add(str(item_id))
        found.append((doc_id, len(w), len(hit), sorted(named), bool(hit)))
    return sorted(found, key=str)


def run(spark, documents, docs, items, size=10):
    table = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, window string")
    found = decontaminate.contamination(documents(docs), table, size)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_random_texts_equal_brute_force(spark, documents):
    rng = random.Random(5)
    vocabulary = ["the", "of", "Ünï", "x1", "rare", "word", "a"]
    text = lambda n: rng.choice([" ", "-", ", "]).join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.randint(0, 12))) for i in range(12)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, f"{text(3)} {t.upper()} {text(4)}") for i, (_, t) in enumerate(items)]
    assert run(spark, documents, docs, items, 4) == brute(docs, items, 4)


@pytest.mark.parametrize("repeat", ["na", "na na na", "one two three four five six seven eight nine ten"])
def test_repetitive_windows(spark, documents, repeat):
    items = [(1, repeat), (10, repeat), (2, " ".join([repeat] * 8)), (None, "only this")]
    docs = [(1, " ".join([repeat] * 30)), (2, repeat), (2, repeat), (None, repeat), (3, None), (4, ""), (5, "x only this y")]
    assert run(spark, documents, docs, items) == brute(docs, items, 10)


def test_many_passes_give_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "WINDOWS_PER_PASS", 3)
    items = [(i, f"alpha beta gamma{i} delta") for i in range(9)]
    docs = [(i, f"so alpha beta gamma{i} delta it is") for i in range(12)]
    assert run(spark, documents, docs, items, 3) == brute(docs, items, 3)


def test_empty_tables(spark, documents):
    assert run(spark, documents, [], [(1, "a b")]) == []
    assert run(spark, documents, [(1, "a b")], []) == [(1, 2, 0, [], False)]
    assert run(spark, documents, [(1, "a b")], [(1, None), (2, "--")]) == [(1, 2, 0, [], False)]


def test_near_matches_are_within_the_slop(spark, documents):
    items = spark.createDataFrame([("red green blue",)], "text string").selectExpr("1L AS item_id", "text")
    windows = decontaminate.item_windows(items).select("window", "words")
    search = decontaminate.Search(documents([(1, "red green blue"), (2, "red and green blue"), (3, "red x x x x green")]), windows)
    found = sorted(r["apart"] for r in search.near(2).collect())
    assert found == [0, 1]


def test_clean_documents_stay(spark, documents):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    docs = documents([(1, "a b c d e f g h i j"), (2, "a b c d e f g h i"), (None, "clean"), (None, "x a b c d e f g h i j"), (3, None)])
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, "clean"), (2, "a b c d e f g h i"), (3, "")]


def test_near_matches_hold_all_words_and_single_words(spark, documents):
    items = spark.createDataFrame([(1, "red green blue"), (2, "mauve")], "item_id long, text string")
    docs = documents(
        [(1, "red green blue"), (2, "x red and green blue"), (2, "x red and green blue"), (3, "red x blue red"),
         (4, "a mauve b"), (5, "blue red green"), (6, None), (7, "red x x x green blue")]
    )
    found = decontaminate.contamination(docs, items, slop=1).select("doc_id", "items", "near_items", "contaminated").collect()
    near = {r["doc_id"]: (r["items"], r["near_items"]) for r in found}
    assert len(found) == 8 and "near_items" not in decontaminate.contamination(docs, items).columns
    assert near == {
        1: (["1"], ["1"]), 2: ([], ["1"]), 3: ([], []), 4: (["2"], ["2"]), 5: ([], []), 6: ([], []), 7: ([], []),
    }


def test_distances_are_those_of_trying_all_ways():
    rng = random.Random(8)
    for _ in range(3000):
        terms, slop = [rng.randrange(3) for _ in range(rng.randint(1, 4))], rng.randrange(3)
        reach = 3 + slop
        context = [rng.randrange(-1, 3) for _ in range(2 * reach + 1)]
        place = terms.index(rng.choice(terms))
        context[reach] = terms[place]
        ways = itertools.product(*([reach] if k == place else range(reach + k - place - slop, reach + k - place + slop + 1) for k in range(len(terms))))
        far = [
            max(abs(at - reach - k + place) for k, at in enumerate(way))
            for way in ways
            if len(set(way)) == len(way) and all(context[at] == t for at, t in zip(way, terms))
        ]
        assert decontaminate.words_apart(terms, place, context, slop) == min(far, default=None)
