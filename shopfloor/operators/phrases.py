"""Stop phrases in a corpus: find, count and remove phrases of one to a few words.

A stop list is a parameter. It goes into the plan as sets of literals, one per
phrase length, so every document is matched where it is read: no join and no
shuffle until counts are summed. Texts with null count as empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of letters, marks and digits.
_BETWEEN_WORDS = r"[^\p{L}\p{M}\p{N}]+"
#: Longest phrase in words; a match length is one digit below.
LONGEST = 4
#: Phrases a list may have: it is part of the plan that every task gets.
MOST_PHRASES = 20_000


def words_of(text: Column) -> Column:
    """Lower-case words of a text, in order."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN_WORDS)
    return F.filter(parts, lambda word: word != "")


def _by_length(phrases: Iterable[str], longest: int) -> dict[int, list[str]]:
    """The list by number of words, longest first. Phrases are words parted by one space."""
    if not 1 <= longest <= 9:
        raise ValueError("phrases have 1 to 9 words")
    found: dict[int, set[str]] = {}
    for phrase in phrases:
        n = len(phrase.split(" "))
        if not all(phrase.split(" ")) or n > longest:
            raise ValueError(f"not a phrase of 1 to {longest} words: {phrase!r}")
        found.setdefault(n, set()).add(phrase.lower())
    if sum(map(len, found.values())) > MOST_PHRASES:
        raise ValueError(f"a stop list has at most {MOST_PHRASES} phrases")
    return {n: sorted(found[n]) for n in sorted(found, reverse=True)}


def _lengths(words: Column, phrases: dict[int, list[str]]) -> Column:
    """For every word the number of words of the longest phrase that starts there, or 0."""

    def longest(word: Column, i: Column) -> Column:
        hits = [
            F.when((i + n <= F.size(words)) & F.array_join(F.slice(words, i + 1, n), " ").isin(listed), F.lit(str(n)))
            for n, listed in phrases.items()
        ]
        return F.coalesce(*hits, F.lit("0"))

    return F.transform(words, longest)


def _chosen(lengths: Column, longest: int) -> Column:
    """The lengths that hold when words are taken from the left and each word once.

    The digits of all words are one string. A pattern that takes a digit and, with
    it, the words its phrase covers walks over it from the left, in linear time; the
    covered words become ``x``.
    """
    taken = "|".join([f"{n}.{{{n - 1}}}" for n in range(longest, 1, -1)] + ["[01]"])
    steps = F.regexp_extract_all(F.array_join(lengths, ""), F.lit(f"({taken})"), F.lit(1))
    marked = F.transform(steps, lambda step: F.rpad(F.left(step, F.lit(1)), F.length(step), F.lit("x")))
    return F.filter(F.split(F.array_join(marked, ""), ""), lambda mark: mark != "")


def match_phrases(
    docs: DataFrame, phrases: Iterable[str], text: str = "text", longest: int = LONGEST
) -> DataFrame:
    """Add ``words``, ``phrases`` found and the ``kept`` words outside of them.

    Matches are taken from the left, the longest phrase first, and do not overlap.
    Each of the three is an array in the order of the text, repeats included.
    """
    listed = _by_length(phrases, longest)
    words = F.col("words")
    found = F.filter(
        F.transform("marks", lambda mark, i: F.when(
            ~mark.isin("0", "x"), F.array_join(F.slice(words, i + 1, mark.cast("int")), " "))),
        lambda phrase: phrase.isNotNull(),
    )
    # Zipped, not looked up by place: a lambda would work out an inlined column once per word.
    outside = F.filter(F.arrays_zip("words", "marks"), lambda pair: pair["marks"] == "0")
    kept = F.transform(outside, lambda pair: pair["words"])
    return (
        docs.withColumn("words", words_of(F.col(text)))
        .withColumn("marks", _chosen(_lengths(words, listed), longest))
        .withColumns({"phrases": found, "kept": kept})
        .drop("marks")
    )


def phrase_counts(matched: DataFrame, by: Sequence[str]) -> DataFrame:
    """How often each phrase was found, per ``by``; tasks sum their own first."""
    # Not ``explode``: the filter that Spark derives from it would match every text again.
    rows = matched.select(*by, F.explode_outer("phrases").alias("phrase"))
    return rows.where("phrase IS NOT NULL").groupBy(*by, "phrase").agg(F.count(F.lit(1)).alias("n"))


def word_totals(matched: DataFrame, by: Sequence[str]) -> DataFrame:
    """Documents, words, phrases found, words they cover and words kept, per ``by``."""
    n_words, n_kept = F.sum(F.size("words").cast("long")), F.sum(F.size("kept").cast("long"))
    return matched.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        n_words.alias("n_words"),
        F.sum(F.size("phrases").cast("long")).alias("n_phrases"),
        (n_words - n_kept).alias("n_stop_words"),
        n_kept.alias("n_kept"),
    )


def frequent_phrases(docs: DataFrame, share: float, text: str = "text", longest: int = LONGEST) -> list[str]:
    """The phrases that at least ``share`` of the texts hold, as a stop list.

    There are at most (phrases of an average text) / share, whatever the number of
    texts; more than a list may have is an error.
    """
    words = F.col("words")

    def of_length(n: int) -> Column:
        starts = F.transform(words, lambda word, i: F.when(i + n <= F.size(words), F.array_join(F.slice(words, i + 1, n), " ")))
        return F.array_distinct(F.array_compact(starts))

    # Phrases of different lengths differ, so each length is made distinct by itself.
    rows = docs.select(words_of(F.col(text)).alias("words")).select(
        F.explode_outer(F.concat(*[of_length(n) for n in range(1, longest + 1)])).alias("phrase")
    )
    least = share * docs.count()
    found = rows.where("phrase IS NOT NULL").groupBy("phrase").count().where(F.col("count") >= least).select("phrase")
    listed = [r["phrase"] for r in found.limit(MOST_PHRASES + 1).collect()]
    if len(listed) > MOST_PHRASES:
        raise ValueError(f"more than {MOST_PHRASES} phrases are in {share:.0%} of the texts; ask for a larger share")
    return sorted(listed)
