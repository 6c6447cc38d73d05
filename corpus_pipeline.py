"""From raw documents to packed training sequences, in stages that are each written and read again.

Toxic documents go, one document of each group of near copies stays, contaminated documents go,
secrets are masked, and what is left is packed. A stage works on everything its predecessor kept
and returns the columns of ``documents`` (the last one: pieces of sequences). A null or empty text
is neither toxic, a copy, contaminated nor secret, and is packed as an empty document; rows without
``doc_id`` are judged by their text alone, and near copies among them stay (exact ones go). Other columns are
carried along, whatever they are called. An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline.llm import contamination, minhash, packing, secrets, toxicity
from tierline.llm.common import stage

#: Automata and language models can't be said in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not predicted to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return minhash.without_copies(docs, width=5, percent=80)


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.without_contaminated(docs, benchmark)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and ``n_chars`` counted again."""
    return secrets.masked(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens, with a checksum of their ids."""
    return packing.digests(packing.packed(docs, length=4096))


STAGES = [
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", not_contaminated),
    ("secrets", no_secrets),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
