"""From raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plinth.llm.exact_dedup import keep_exact
from plinth.llm.jaccard_join import keep_one_of_each
from plinth.llm.mixing import mixed_rows
from plinth.llm.packing import default_tokenizer, pack
from plinth.llm.toxicity import keep_clean, learn
from plinth.session import checkpointed

#: SQL can't express a learnt lexicon or a tokenizer's merges.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learnt from the labels rejects go."""
    return keep_clean(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return keep_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more on five-word shingles, the one with the smallest id stays."""
    return keep_one_of_each(docs, n=5, threshold="0.8")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences; a document that comes twice is packed twice."""
    return pack(docs, default_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`; what a stage leaves is written to the shared checkpoint folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
