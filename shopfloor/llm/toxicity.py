"""Toxic documents by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, and one that goes on
with what training on toxic text adds, namely the words that ordinary text does
not explain and that several toxic documents share. A text is cut into short
windows. Where a window gets shorter with the toxic dictionary than with the
ordinary one, it is closer to toxic text; how much evidence a difference in bytes
carries is calibrated on labelled documents that trained neither dictionary.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.memory import tidied

#: Bound on the labelled documents looked at, per class, and on the length of each.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_CHARS = 2_000, 4_000, 30_000
#: Bytes in a window; it ends with the word that passes this length.
WINDOW = 64
#: Longest stretch without white space that stays in one window.
LONGEST_WORD = 256
ORDINARY_BYTES, TOXIC_BYTES = 32_768, 3_072
#: Differences in bytes that are told apart.
LEAST_GAIN, MOST_GAIN = -3, 8
#: A word of the toxic dictionary: this share of the toxic documents have it, so many
#: at least, and it is so many times as frequent there as in ordinary ones.
SHARED_SHARE, SHARED_BY, ENRICHED = 0.015, 3, 8
#: Jaccard similarity of the words of texts that count as near copies.
ALIKE = 0.8
#: Parts of the sample; each is measured with dictionaries trained on the others.
FOLDS = 3
LEVEL = 3
THRESHOLD = 0.7

_WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """The whole text, lower-cased and with single spaces, in windows of whole words."""
    joined = " ".join(text.lower().split()).encode("utf-8", "surrogatepass")
    found, at = [], 0
    while at < len(joined):
        stop = joined.find(b" ", at + size, at + size + LONGEST_WORD)
        stop = min(stop if stop >= 0 else at + size + LONGEST_WORD, len(joined))
        found.append(joined[at:stop])
        at = stop + 1 if joined[stop : stop + 1] == b" " else stop
    return found


def _words(text: str) -> list[bytes]:
    return _WORD.findall(text.lower().encode("utf-8", "surrogatepass"))


def _trained(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """Content of a dictionary trained on the samples; their end where they are too few to train."""
    import zstandard

    samples = [s for s in samples if len(s) >= 8]
    try:
        whole = zstandard.train_dictionary(size + 1024, samples, k=k, d=d).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]
    return whole[-size:] if len(whole) > size else whole


def _near_copies(sets: list[np.ndarray], n_words: int) -> list[int]:
    """A number for each set of word numbers, the same where near copies lead from one to the other.

    Every pair at ``ALIKE`` is found: both have one of their rarest words in common,
    of as many as the larger may have that the other lacks, and one more.
    """
    spread = np.bincount(np.concatenate(sets), minlength=n_words) if sets else np.empty(0)
    group, by_word = list(range(len(sets))), defaultdict(list)
    there = np.zeros(n_words, dtype=bool)

    def first(i: int) -> int:
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        words, n = sets[i], len(sets[i])
        least = math.ceil(ALIKE * n - 1e-9)
        rarest = words[np.lexsort((words, spread[words]))][: n - least + 1].tolist()
        there[words] = True
        for j in {j for word in rarest for j in by_word[word]}:
            if len(sets[j]) >= least and first(i) != first(j):
                common = int(there[sets[j]].sum())
                if common >= ALIKE * (n + len(sets[j]) - common) - 1e-9:
                    group[first(i)] = first(j)
        there[words] = False
        for word in rarest:
            by_word[word].append(i)
    return [first(i) for i in range(len(sets))]


def _documents_with(texts: Iterable[str]) -> tuple[Counter, int]:
    """In how many different texts each word occurs, and the number of different texts.

    Near copies, by the Jaccard similarity of their words, count as one text.
    """
    numbers: dict[bytes, int] = {}
    found = ({numbers.setdefault(word, len(numbers)) for word in _words(text)} for text in texts)
    sets = [np.array(sorted(each), dtype=np.int32) for each in found if each]
    alike: dict[int, list[np.ndarray]] = defaultdict(list)
    for group, words in zip(_near_copies(sets, len(numbers)), sets):
        alike[group].append(words)
    counts = np.zeros(len(numbers), dtype=np.int64)
    for each in alike.values():
        counts[np.unique(np.concatenate(each))] += 1
    return Counter(dict(zip(numbers, counts.tolist()))), max(1, len(alike))


def train_dictionaries(ordinary: list[str], toxic: list[str]) -> tuple[bytes, bytes]:
    """Content of the ordinary and of the toxic dictionary."""
    base = _trained([w for t in ordinary for w in windows(t, 200)], ORDINARY_BYTES, 24, 8)
    (usual, n_usual), (found, n_found) = _documents_with(ordinary), _documents_with(toxic)
    least = max(SHARED_BY, SHARED_SHARE * n_found)
    own = {
        word
        for word, n in found.items()
        if n >= least and n / n_found >= ENRICHED * (usual[word] + 1) / n_usual
    }
    samples = [b" ".join(w for w in _words(t) if w in own) for t in toxic]
    return base, base + _trained(samples, TOXIC_BYTES, 24, 8)


@dataclass
class Model:
    """Dictionaries, the evidence of each gain and the weights of a document's features."""

    ordinary: bytes
    toxic: bytes
    evidence: list[float]
    prior: float
    centre: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def __post_init__(self):
        self._lengths = None

    def gains(self, text: str | None) -> np.ndarray:
        """By how many bytes each window gets shorter with the toxic dictionary."""
        import zstandard

        if self._lengths is None:
            self._lengths = []
            for content in (self.ordinary, self.toxic):
                held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=LEVEL)
                self._lengths.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
                    ).compress
                )
        plain, toxic = self._lengths
        found = [len(plain(w)) - len(toxic(w)) for w in windows(text or "")]
        return np.clip(np.array(found, dtype=np.int64), LEAST_GAIN, MOST_GAIN) - LEAST_GAIN

    def __getstate__(self):
        return self.__dict__ | {"_lengths": None}

    def features(self, gains: np.ndarray) -> list[float]:
        """Evidence of all windows, of the strongest, and how many there are."""
        each = np.array(self.evidence)[gains]
        strong = gains >= 3 - LEAST_GAIN
        return [
            float(np.clip(each.sum(), -30, 60)),
            float(each.mean()),
            float(each.max()),
            float(np.sort(each)[::-1][:3].sum()),
            math.log(len(each)),
            float(min(strong.sum(), 20)),
            float(strong.mean()),
        ]

    def score(self, text: str | None) -> float:
        """Probability of label 1; that of any document where nothing was learned or there are no words."""
        gains = self.gains(text) if self.weights else np.empty(0)
        if not len(gains):
            return self.prior
        z = (np.array(self.features(gains)) - self.centre) / self.scale
        return float(1 / (1 + math.exp(-(self.weights[0] + float(z @ np.array(self.weights[1:]))))))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights by Newton's method, the first one the intercept."""
    x = np.c_[np.ones(len(x)), x]
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit(ordinary: list[str], toxic: list[str], prior: float) -> Model:
    """Train the dictionaries on all texts given, calibrate on texts they were not trained on.

    For the calibration the sample is dealt into parts, and the gains of each are
    taken with dictionaries trained on the others. Where a class has fewer texts
    than there are parts, the model gives every text the ``prior``, the share of
    label 1.
    """
    if min(len(ordinary), len(toxic)) < FOLDS:
        return Model(b"", b"", [], prior)
    plain: list[np.ndarray] = []
    bad: list[np.ndarray] = []
    for fold in range(FOLDS):
        others = [[t for i, t in enumerate(each) if i % FOLDS != fold] for each in (ordinary, toxic)]
        trial = Model(*train_dictionaries(*others), evidence=[], prior=prior)
        plain += [g for t in ordinary[fold::FOLDS] if len(g := trial.gains(t))]
        bad += [g for t in toxic[fold::FOLDS] if len(g := trial.gains(t))]
    if not plain or not bad:
        return Model(b"", b"", [], prior)
    model = Model(*train_dictionaries(ordinary, toxic), evidence=[], prior=prior)
    classes = MOST_GAIN - LEAST_GAIN + 1

    def shares(each: Iterable[np.ndarray]) -> np.ndarray:
        counts = np.bincount(np.concatenate(list(each)), minlength=classes) + 1.0
        return counts / counts.sum()

    model.evidence = np.log(shares(bad) / shares(plain)).tolist()
    x = np.array([model.features(g) for g in [*plain, *bad]])
    y = np.r_[np.zeros(len(plain)), np.ones(len(bad))]
    model.centre, model.scale = x.mean(axis=0).tolist(), (x.std(axis=0) + 1e-9).tolist()
    weights = _logistic((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9), y)
    # The sample may hold label 1 more often than the labelled rows do.
    if 0 < prior < 1:
        weights[0] += math.log(prior / (1 - prior) * len(plain) / len(bad))
    model.weights = weights.tolist()
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    The sample is the rows with the smallest hashes of doc_id, at most
    ``SAMPLE_TOXIC`` and ``SAMPLE_ORDINARY`` of either label, leaving out texts of
    over ``SAMPLE_CHARS`` characters; it is what the driver gets.
    """
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    order = F.xxhash64("doc_id")
    chosen = known.where("toxic = 1").orderBy(order, "doc_id").limit(SAMPLE_TOXIC).unionAll(
        known.where("toxic = 0").orderBy(order, "doc_id").limit(SAMPLE_ORDINARY)
    )
    texts = docs.select("doc_id", "text").where((F.length("text") > 0) & (F.length("text") <= SAMPLE_CHARS))
    # At most SAMPLE_TOXIC + SAMPLE_ORDINARY ids.
    # One text of each: that of least hash, where a doc_id repeats with different ones.
    texts = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
    rows = texts.agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")).collect()
    # Copies would sit on both sides of the fit.
    texts = {label: sorted({r["text"] for r in rows if r["toxic"] == label}) for label in (0, 1)}
    mixed = {label: [each[i] for i in np.random.default_rng(7).permutation(len(each))] for label, each in texts.items()}
    return fit(mixed[0], mixed[1], prior)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every row, from its whole text alone.

    Null and empty texts get the share of label 1. Repeated rows come back
    repeated; a null doc_id stays null; other columns are not looked at; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.score(text.as_py()) for text in batch.column("text")]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(found, pa.float64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(tidied(scored), f"doc_id {kind}, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_civil(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows and columns of ``docs`` whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            below = [model.score(text.as_py()) < threshold for text in batch.column(at)]
            yield batch.filter(pa.array(below, pa.bool_()))

    return docs.mapInArrow(tidied(kept), docs.schema)
