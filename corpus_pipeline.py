"""A corpus pipeline of the operators in ``hitloom.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
kept; its result is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hitloom.llm import bpe, exactdup, mixing, simhash, toxicity
from hitloom.llm.queries import VOCABULARY
from hitloom.session import work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field does not predict to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    predicted = scored.columns[len(docs.columns) + 1]
    return scored.where(scored[predicted] == 0).select(*[f"`{c}`" for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return exactdup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, 2 bits; the one with the smallest id."""
    return simhash.keep_one(docs, words_per_shingle=3, max_distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them, shuffled within output shards."""
    mixed = mixing.mix(docs, mixing.plan_mix(docs))
    return mixed.select(*[f"`{c}`" for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, with digests of them and of the text that they decode to."""
    vocabulary = public_tokenizers.path(VOCABULARY)
    rows = bpe.digests(bpe.round_trip(docs, vocabulary, keep=["doc_id", "source"]))
    return rows.select("doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: SQL cannot express the toxicity field; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_dir(spark, "llm", f"pipeline-{uuid.uuid4().hex}")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
