"""A training corpus from `documents`, stage by stage.

Each stage is a function of (session, documents, folder of the tables) and returns a DataFrame; all but the last return
the columns of `documents`. `run` writes each stage's result as Parquet to the shared folder and reads it for the next.

Edge cases: null texts are empty ones; an empty text is scored like any other, stays alone among near duplicates, leaks nothing, and
has size 0, so the mix may leave it out; of rows that repeat a text one stays, of rows that share a doc_id with different texts each
is judged by its own; very long texts are taken whole; further columns, whatever their names, are carried on; without documents the
result is empty, without labels or test items nothing is rejected or leaked.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandsieve.llm import decontaminate, mixing, neardup, quality, token_files
from strandsieve.llm.common import table, written
from strandsieve.session import ready

TOKENIZER = "byte_bpe_50k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage-attention classifier does not reject."""
    model = quality.fit(docs, table(ready(spark), sf_dir, "labels"))
    return quality.keep_good(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id."""
    ready(spark)
    return neardup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no test item."""
    return decontaminate.without_leaks(docs, table(ready(spark), sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights ask for."""
    ready(spark)
    return mixing.mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents; a row for each document as read back from them."""
    ready(spark)
    return token_files.token_file_digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", good_quality),
    ("near-duplicates", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("source mixing", mixed),
    ("token files", token_output),
]

#: The stages learn a model, sketch sets and align texts, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
