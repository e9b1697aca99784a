"""A corpus from raw documents to packed sequences, stage by stage.

Each stage calls one operator of ``shopfloor.llm`` on all rows its predecessor
kept, is written as Parquet and read again for the next. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import decontaminate, packing, secrets, simhash, toxicity
from shopfloor.session import materialize, ship_package

TOKENIZER = "byte_bpe_50k.json"


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` of the text as it is now, where the table has that column."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; empty ones are not toxic."""
    ship_package(spark)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_civil(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that with the smallest doc_id."""
    ship_package(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    ship_package(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mark."""
    ship_package(spark)
    return _with_length(secrets.redact(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    ship_package(spark)
    pieces = packing.tokenized_pieces(docs, public_tokenizers.path(TOKENIZER))
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: Hashes of XXH64, compression lengths and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
