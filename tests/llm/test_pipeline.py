"""The whole pipeline against its rules applied one after the other in plain Python."""

from __future__ import annotations

import zlib

import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shopfloor.llm import decontaminate, simhash, toxicity
from shopfloor.llm.registry import ORACLE, QUERIES
from shopfloor.llm.tokens import WordEncoder

SECRET = 1_000_000


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("small"))
    source = "/root/testdata/sf0.001"
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{source}/documents.parquet")
    more = spark.createDataFrame([(SECRET, "here the token: abcdefgh123 was found", "en", "s", 37)], docs.schema)
    docs.unionAll(more).write.parquet(f"{folder}/documents.parquet")
    return folder


def near(a, b):
    return (a ^ b).bit_count() <= simhash.MAX_BITS


def test_pipeline_equals_plain_rules(spark, small):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "decontamination", "secret_scan", "best_fit_packing",
    ]
    table = spark.read.parquet(f"{small}/documents.parquet")
    model = toxicity.learn(table, spark.read.parquet(f"{small}/labels.parquet"))
    docs = {r["doc_id"]: r["text"] for r in table.collect() if model.score(r["text"]) < toxicity.THRESHOLD}

    marks = {i: simhash.fingerprint(t) for i, t in docs.items()}
    root = {i: i for i in docs}
    for _ in docs:
        fresh = {i: min(root[j] for j in docs if near(marks[i], marks[j])) for i in docs}
        if fresh == root:
            break
        root = fresh
    docs = {i: t for i, t in docs.items() if root[i] == i}

    windows = set()
    for r in spark.read.parquet(f"{small}/benchmark.parquet").collect():
        words = decontaminate.words_of(r["text"])
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9) if words else 0)}
    sizes = {len(w) for w in windows}

    def clean(text):
        words = decontaminate.words_of(text)
        return not any(tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1))

    docs = {i: t for i, t in docs.items() if clean(t)}
    rows = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    ids = WordEncoder(public_tokenizers.path(corpus_pipeline.TOKENIZER)).encode("here the [SECRET] was found")
    end = (0).to_bytes(4, "little")
    assert [r["ids_crc32"] for r in rows if r["doc_id"] == SECRET] == [zlib.crc32(ids + end)]
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in used.values():
        assert sum(n for _, n in held) <= 2048
        assert sorted(held)[0][0] == 0


def test_stages_keep_rows_of_all_kinds(spark, small, tmp_path):
    table = spark.read.parquet(f"{small}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "s", 0), (None, "no id at all", "en", "s", 12)], table.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, odd, small)
        assert kept.columns == table.columns, name
        n = 2 if name == "simhash_near_dedup" else 3
        assert kept.count() == n, name
        assert stage(spark, odd.limit(0), small).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, small).count() == 3


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(ORACLE) <= set(QUERIES)
    assert all(isinstance(sql, str) for sql in ORACLE.values())
