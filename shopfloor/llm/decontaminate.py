"""Benchmark passages in training text, found through a positional inverted index."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.memory import tidied
from shopfloor.session import materialize

WINDOW = 10
#: Lists intersected per window, the rarest terms first.
LISTS = 2
#: Windows searched in one pass; a larger benchmark takes several passes. Bounds what is broadcast.
WINDOWS_PER_PASS = 200_000

# Bytes that are no part of a word, after lower-casing.
_BETWEEN = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_SPACED = bytes.maketrans(_BETWEEN, b" " * len(_BETWEEN))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8: digits, a to z and everything beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_SPACED).split() if text else []


# --- the benchmark ------------------------------------------------------------


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, window, words``: the runs of ``size`` words of each item.

    ``window`` is the words with spaces between them. An item of fewer words is
    one window, one without words has none.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, windows = [], []
            for row, text in enumerate(batch.column("text")):
                words = words_of(text.as_py())
                starts = range(max(1, len(words) - size + 1) if words else 0)
                rows += [row] * len(starts)
                windows += [b" ".join(words[at : at + size]).decode("utf-8", "surrogatepass") for at in starts]
            yield pa.record_batch(
                {
                    "item_id": batch.column("item_id").take(pa.array(rows, pa.int64())),
                    "window": pa.array(windows, pa.string()),
                }
            )

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(cut, f"item_id {kind}, window string").distinct()
    return materialize(found, "windows").withColumn("words", F.split("window", " "))


# --- the index ----------------------------------------------------------------


def term_counts(docs: DataFrame, terms: frozenset[bytes]) -> DataFrame:
    """``term, n``: occurrences of each of ``terms`` in all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = shared.value, Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen = Counter(words_of(text.as_py()))
                for term in seen.keys() & wanted if len(seen) < len(wanted) else wanted & seen.keys():
                    total[term] += seen[term]
        names = [t.decode("utf-8", "surrogatepass") for t in total]
        yield pa.record_batch({"term": pa.array(names, pa.string()), "n": pa.array(total.values(), pa.int64())})

    return docs.select("text").mapInArrow(tidied(count), "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def term_postings(docs: DataFrame, listed: frozenset[bytes], numbers: dict[bytes, int], reach: int) -> DataFrame:
    """``key, doc_id, n_words, postings`` of every row of ``docs``, as a written table.

    A posting is a listed term's number, its position among the document's words
    and the numbers of the ``reach`` words on either side (-1: a word that no
    window has). ``key`` stands for doc_id and text together, so rows without or
    with the same doc_id are told apart by what they say.
    """
    shared = docs.sparkSession.sparkContext.broadcast((listed, numbers))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        listed, numbers = shared.value
        chosen = np.zeros(len(numbers) + 1, dtype=bool)
        chosen[[numbers[word] for word in listed]] = True
        width = 2 * reach + 1
        # Postings take more room than their texts; a few documents at a time.
        parts = (batch.slice(at, 512) for batch in batches for at in range(0, batch.num_rows, 512))
        for batch in parts:
            keys, n_words, terms, positions, contexts = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                text = text.as_py()
                words = words_of(text)
                # The last number, one beyond all terms, is that of no term: -1.
                ids = np.full(len(words) + 2 * reach, -1, dtype=np.int32)
                ids[reach : reach + len(words)] = [numbers.get(w, -1) for w in words]
                at = np.flatnonzero(chosen[ids[reach : reach + len(words)]])
                keys.append(xxhash.xxh3_128_digest(f"{doc_id}\n{text}".encode("utf-8", "surrogatepass")))
                n_words.append(len(words))
                terms.append(ids[at + reach])
                positions.append(at)
                contexts.append(np.lib.stride_tricks.sliding_window_view(ids, width)[at].ravel() if len(at) else ids[:0])
            sizes = np.cumsum([0, *map(len, terms)]).astype(np.int32)
            around = pa.ListArray.from_arrays(
                np.arange(sizes[-1] + 1, dtype=np.int32) * np.int32(width), pa.array(np.concatenate(contexts))
            )
            posting = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(terms)), pa.array(np.concatenate(positions).astype(np.int64)), around],
                names=["term", "position", "context"],
            )
            yield pa.record_batch(
                {
                    "key": pa.array(keys, pa.binary()),
                    "doc_id": batch.column("doc_id"),
                    "n_words": pa.array(n_words, pa.int64()),
                    "postings": pa.ListArray.from_arrays(pa.array(sizes), posting),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"key binary, doc_id {kind}, n_words bigint, "
        "postings array<struct<term: int, position: bigint, context: array<int>>>"
    )
    posted = materialize(docs.select("doc_id", "text").mapInArrow(tidied(post), schema), "documents-posted")
    # The table is written; nothing works it out again.
    shared.destroy()
    return posted


def inverted_index(posted: DataFrame) -> DataFrame:
    """``term, key, position, context``, stored in the order of term, document and position.

    Ranges also cut the list of a very frequent term into several files.
    """
    order = ["term", "key", "position"]
    lists = posted.select("key", F.inline("postings")).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(lists.select(*order, "context"), "index")


# --- searching ------------------------------------------------------------------


class Search:
    """One pass: at most ``WINDOWS_PER_PASS`` windows against all documents."""

    def __init__(self, docs: DataFrame, windows: DataFrame, size: int = WINDOW, lists: int = LISTS):
        """``windows`` has ``window`` and its ``words``, each window once."""
        self.size, self.docs = size, docs
        spark = docs.sparkSession
        terms = [r["term"] for r in windows.select(F.explode("words").alias("term")).distinct().collect()]
        numbers = {t.encode("utf-8", "surrogatepass"): i for i, t in enumerate(sorted(terms))}
        self.numbers = numbers
        numbered = spark.createDataFrame(list(zip(sorted(terms), range(len(terms)))), "term string, number int")
        counts = numbered.join(term_counts(docs, frozenset(numbers)), "term", "left").select(
            "term", "number", F.coalesce("n", F.lit(0)).alias("n")
        )
        # A window's terms by place, the rarest in the corpus first.
        placed = windows.select("window", F.posexplode("words").alias("place", "term")).join(counts, "term")
        rarest = Window.partitionBy("window").orderBy("n", "place")
        ranked = placed.withColumn("rank", F.row_number().over(rarest) - 1)
        self.windows = materialize(
            ranked.groupBy("window").agg(
                F.transform(F.array_sort(F.collect_list(F.struct("place", "number"))), lambda x: x["number"]).alias("terms"),
                F.array_sort(F.collect_list(F.when(F.col("rank") < lists, F.struct("rank", "number", "place", "term")))).alias("lists"),
            ),
            "ranked-windows",
        )
        listed = self.windows.select(F.explode("lists.term").alias("term")).distinct().collect()
        self.posted = term_postings(
            docs, frozenset(r["term"].encode("utf-8", "surrogatepass") for r in listed), numbers, size - 1
        )
        self.index = inverted_index(self.posted)

    def _adjusted(self) -> DataFrame:
        """The chosen lists, each moved by its term's place to where the window would start."""
        chosen = self.windows.select("window", F.size("lists").alias("n_lists"), F.inline("lists")).drop("term")
        return self.index.join(chosen, self.index["term"] == chosen["number"]).select(
            "window", "n_lists", "rank", "place", "key", (F.col("position") - F.col("place")).alias("start"), "context"
        )

    def phrases(self) -> DataFrame:
        """``key, window, start, n``: every place where a window occurs word for word.

        The adjusted lists of the rarest terms are intersected; what is left is
        compared word by word with the words around the rarest term.
        """
        both = (
            self._adjusted()
            .groupBy("window", "key", "start")
            .agg(
                F.bit_or(F.expr("shiftleft(1, rank)")).alias("found"),
                F.max("n_lists").alias("n_lists"),
                F.max(F.when(F.col("rank") == 0, F.struct("place", "context"))).alias("rarest"),
            )
            .where("found = shiftleft(1, n_lists) - 1")
        )
        n = F.size("terms")
        there = F.slice("rarest.context", F.lit(self.size) - F.col("rarest.place"), n)
        return (
            both.join(self.windows.select("window", "terms"), "window")
            .where(there == F.col("terms"))
            .select("key", "window", "start", n.cast("long").alias("n"))
        )

    def near(self, slop: int) -> DataFrame:
        """``key, window, start, apart``: all words of a window, each at most ``slop`` words from its place.

        Places are counted from an occurrence of the window's rarest term, which
        gives ``start``; no word of a document stands for two of the window.
        ``apart`` is how far the word farthest off is from its place; 0 are the
        exact phrases. A window of one word is found wherever that word occurs.
        """
        rarest = self.windows.select("window", "terms", F.element_at("lists", 1).alias("rarest"))
        rarest = rarest.select("window", "terms", "rarest.number", "rarest.place", "rarest.term")
        listed = frozenset(r["term"].encode("utf-8", "surrogatepass") for r in rarest.select("term").distinct().collect())
        reach = self.size - 1 + slop
        index = inverted_index(term_postings(self.docs, listed, self.numbers, reach))
        there = index.join(rarest.drop("term"), index["term"] == rarest["number"]).select(
            "key", "window", (F.col("position") - F.col("place")).alias("start"), "terms", "place", "context"
        )

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [
                    words_apart(terms, place, context, slop)
                    for terms, place, context in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)))
                ]
                columns = [*batch.columns[:3], pa.array(found, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "window", "start", "apart"])

        found = there.mapInArrow(compare, "key binary, window string, start bigint, apart int")
        # Rows that repeat post the same places.
        return found.where("apart is not null").distinct()


def words_apart(terms: list[int], place: int, context: list[int], slop: int) -> int | None:
    """Least distance, up to ``slop``, within which each term has a word of its own around its place.

    ``context`` has the word at ``place`` in its middle. None where there is no such distance.
    """
    middle = len(context) // 2
    for most in range(slop + 1):
        last: dict[int, int] = {}
        for k, term in enumerate(terms):
            if k == place:
                continue
            due = middle + k - place
            # Equal terms take their words from the left; their places come in the same order.
            at = max(due - most, last.get(term, -1) + 1)
            while at <= due + most and (context[at] != term or at == middle):
                at += 1
            if at > due + most:
                break
            last[term] = at
        else:
            return most
    return None


def _searches(spark: SparkSession, docs: DataFrame, windows: DataFrame, size: int) -> list[Search]:
    """A search for each part of the windows; their number is that of the benchmark, not the corpus."""
    each = windows.select("window", "words").dropDuplicates(["window"])
    passes = max(1, -(-each.count() // WINDOWS_PER_PASS))
    part = F.pmod(F.xxhash64("window"), F.lit(passes))
    return [Search(docs, each.where(part == i), size) for i in range(passes)]


def _named(found: DataFrame, windows: DataFrame, name: str) -> DataFrame:
    """``key`` and, as ``name``, the sorted ids of the items whose windows were found there."""
    return (
        found.select("key", "window")
        .distinct()
        .join(windows.select("window", F.col("item_id").cast("string").alias("item")), "window")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item")).alias(name))
    )


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated`` of every row of ``docs``.

    A word is hit when any occurrence of a window covers it; ``items`` are the
    ids, as sorted strings, of items that have an occurring window. Texts without
    words have no hits. Repeated rows come back repeated with the same result;
    an item without id hits words but is not named; other columns are not looked
    at. Without items nothing is hit; without documents there are no rows.

    With ``slop`` there is one more column, ``near_items``: the ids of items that
    have a window all of whose words are at most so many words from their places.
    """
    windows = item_windows(items, size)
    searches = _searches(docs.sparkSession, docs, windows, size)
    found = materialize(reduce(DataFrame.unionAll, [s.phrases() for s in searches]).distinct(), "phrases")

    spans = found.groupBy("key", "start").agg((F.col("start") + F.max("n")).alias("stop"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))))
    hits = spans.select("key", fresh.alias("fresh")).groupBy("key").agg(F.sum("fresh").alias("n_hit"))

    named = _named(found, windows, "items")
    texts = searches[0].posted.select("key", "doc_id", "n_words")
    none = F.array().cast("array<string>")
    result = (
        texts.join(hits.join(named, "key"), "key", "left")
        .select(
            "key", "doc_id", "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
        )
        .withColumn("contaminated", F.col("n_hit") > 0)
    )
    if slop is not None:
        near = _named(reduce(DataFrame.unionAll, [s.near(slop) for s in searches]), windows, "near_items")
        result = result.join(near, "key", "left").withColumn("near_items", F.coalesce("near_items", none))
    return result.drop("key")


def keep_clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` no window of the benchmark occurs in; rows without doc_id by their text."""

    def name() -> Column:
        """128 bits of doc_id and text: two hashes with different seeds."""
        return F.concat_ws(":", F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "text", "doc_id"))

    hit = contamination(docs.select(name().alias("doc_id"), "text"), items, size)
    bad = hit.where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.withColumn("_name", name()).join(bad, F.col("_name") == F.col("_bad"), "left_anti").drop("_name")
