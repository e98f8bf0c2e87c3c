"""The training-data pipeline over documents: quality, exact copies, near copies, mix, tokens.

Each stage takes the rows that its predecessor kept, with the columns of documents, and its decisions take
effect; the last returns token ids. Cases (nulls, empty and very long texts, repeated rows, empty tables,
further columns) are those of the operators that the stages call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from twinfold.llm.bpe import encode_documents
from twinfold.llm.exact_dedup import drop_copies
from twinfold.llm.mixing import mixed_rows
from twinfold.llm.near_dedup import keep_one
from twinfold.llm.quality import keep_quality
from twinfold.llm.queries import MIX_WEIGHTS, default_vocabulary
from twinfold.llm.shared import read_table, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail a quality rule."""
    return keep_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the largest doc_id, of those with equal texts."""
    return drop_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked by five-word shingles and a similarity of 0.8."""
    return keep_one(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, at most twice."""
    return mixed_rows(docs, MIX_WEIGHTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, and the ids."""
    return encode_documents(docs, default_vocabulary(), with_ids=True).withColumnRenamed("id", "doc_id").drop("decoded")


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("tokens", tokens)]

#: Near copies, the mix's order and tokenization are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
