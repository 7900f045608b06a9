"""The corpus pipeline: documents in, token digests of the documents that are kept out.

Each stage takes (spark, docs, folder of tables) and returns a DataFrame; all but the last return
the columns of documents. Between the stages rows are written as Parquet and read again, so a lost
executor costs a re-read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickspan.llm import bpe, bytecnn, minmax, tiling, toxicity
from tickspan.llm.frames import fold, parquet, prepare
from tickspan.llm.queries import FOLDS, HELD_OUT, PREDICTED_FROM, VOCABULARY
from tickspan.session import as_table


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a language: those without any letter go, and those of no clear language."""
    prepare(spark)
    net = bytecnn.train(docs.filter(fold("doc_id", FOLDS) != HELD_OUT))
    return bytecnn.determined(docs, net)


def toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that op4_toxicity doesn't predict toxic."""
    labels = parquet(prepare(spark), folder, "labels")
    index = toxicity.train(docs, labels.filter(fold("doc_id", FOLDS) != HELD_OUT))
    return toxicity.tolerable(docs, index, most=PREDICTED_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8)."""
    prepare(spark)
    return minmax.without_copies(docs, minmax.near_duplicates(docs))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    benchmark = parquet(prepare(spark), folder, "benchmark")
    return tiling.clean_documents(docs, tiling.contamination(docs, benchmark))


def encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of the bytes they decode to."""
    prepare(spark)
    return bpe.encoded_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Trained models and min-max hashing can't be expressed in SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet(prepare(spark), folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = as_table(stage(spark, docs, folder), f"stage-{name}")
    return STAGES[-1][1](spark, docs, folder)
