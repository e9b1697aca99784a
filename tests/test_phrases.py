from __future__ import annotations

import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of
from shopfloor.operators import phrases as ops

STOP = ["a", "b c", "a b c", "c d e f", "e", "x y", "d"]


def by_hand(text, stop, longest=4):
    """Phrases from the left, the longest first, and the words outside of them."""
    words = re.findall(r"\w+", (text or "").lower())
    found, kept, i = [], [], 0
    while i < len(words):
        for n in range(longest, 0, -1):
            phrase = " ".join(words[i:i + n])
            if i + n <= len(words) and phrase in stop:
                found.append(phrase)
                i += n
                break
        else:
            kept.append(words[i])
            i += 1
    return words, found, kept


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en" if i % 2 else "de") for i, t in enumerate(texts)], "doc_id int, text string, lang string")


def test_against_brute_force(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choices("abcdefxyz", k=rng.randrange(60))) for _ in range(400)]
    texts += [None, "", " .,; ", "A", "a-b/C!", "a b c d e f", "C D  E\nF", "ab c", "é a É", "x", "b"]
    got = {r["doc_id"]: r for r in ops.match_phrases(frame(spark, texts).repartition(5), STOP).collect()}
    for i, text in enumerate(texts):
        words, found, kept = by_hand(text, set(STOP))
        assert (got[i]["words"], got[i]["phrases"], got[i]["kept"]) == (words, found, kept), text


def test_counts_and_totals(spark):
    texts = ["a b c z", "a a q", None, "z d", "a b c z"]
    matched = ops.match_phrases(frame(spark, texts), STOP)
    counts = {(r["lang"], r["phrase"]): r["n"] for r in ops.phrase_counts(matched, ["lang"]).collect()}
    expected = Counter()
    for i, text in enumerate(texts):
        expected.update(("en" if i % 2 else "de", p) for p in by_hand(text, set(STOP))[1])
    assert counts == dict(expected)
    totals = {r["lang"]: tuple(r)[1:] for r in ops.word_totals(matched, ["lang"]).collect()}
    assert totals == {"de": (3, 8, 2, 6, 2), "en": (2, 5, 3, 3, 2)}


def test_other_lengths(spark):
    stop = ["a b c d e f", "a b", "f g"]
    (r,) = ops.match_phrases(frame(spark, ["a b c d e f g a b"]), stop, longest=6).collect()
    assert r["phrases"] == ["a b c d e f", "a b"] and r["kept"] == ["g"]
    (r,) = ops.match_phrases(frame(spark, ["a b A"]), ["A"], longest=1).collect()
    assert r["phrases"] == ["a", "a"] and r["kept"] == ["b"]


def test_empty_list_and_empty_table(spark):
    (r,) = ops.match_phrases(frame(spark, ["a b"]), []).collect()
    assert r["phrases"] == [] and r["kept"] == ["a", "b"]
    none = ops.match_phrases(frame(spark, ["a"]).where("false"), STOP)
    assert none.count() == 0 and ops.phrase_counts(none, ["lang"]).count() == 0
    assert ops.frequent_phrases(frame(spark, ["a"]).where("false"), 0.5) == []


@pytest.mark.parametrize("phrase", ["", "a  b", " a", "a b c d e"])
def test_wrong_phrases_are_errors(spark, phrase):
    with pytest.raises(ValueError, match="not a phrase"):
        ops.match_phrases(frame(spark, ["a"]), [phrase])


def test_frequent_phrases(spark):
    docs = frame(spark, ["a b a b", "a b c", "c a", None])
    assert ops.frequent_phrases(docs, 0.5) == ["a", "a b", "b", "c"]
    assert ops.frequent_phrases(docs, 0.75) == ["a"]
    assert ops.frequent_phrases(docs, 0.25, longest=2) == ["a", "a b", "b", "b a", "b c", "c", "c a"]


def test_a_list_beyond_its_bound_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(ops, "MOST_PHRASES", 3)
    docs = frame(spark, ["a b c d"])
    with pytest.raises(ValueError, match="larger share"):
        ops.frequent_phrases(docs, 0.5)
    with pytest.raises(ValueError, match="at most 3"):
        ops.match_phrases(docs, ["a", "b", "c", "d"])


def test_a_very_long_text_takes_linear_time(spark):
    """Every output column alone, so that an inlined column would show."""
    text = "a b c z d e f " * 30_000
    docs = frame(spark, [text])
    started = time.time()
    for column, n in (("phrases", 90_000), ("kept", 60_000), ("words", 210_000)):
        assert ops.match_phrases(docs, STOP).select(F.size(column)).first()[0] == n
    assert ops.phrase_counts(ops.match_phrases(docs, STOP), ["lang"]).count() == 3
    assert time.time() - started < 60


def test_only_counts_move(spark):
    plan = plan_of(ops.phrase_counts(ops.match_phrases(frame(spark, ["a b"]), STOP), ["lang"]))
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "Join" not in plan and "Python" not in plan
    # The text is cut into words once: nothing derives a second match from the explode.
    assert plan.count("regexp_extract_all") == 1
