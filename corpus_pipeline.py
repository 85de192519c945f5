"""The corpus pipeline: five stages from raw documents to encoded text.

Each stage takes `(spark, docs, sf_dir)` and returns a DataFrame, which is written as Parquet and reread as
the next stage's documents. All but the last return the columns of the documents given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.frames import materialise, table
from llm.op2_lines import dedup_lines
from llm.op3_bpe import decode, encode
from llm.op5_decontaminate import remove_passages
from llm.op6_simhash import keep_first
from llm.op8_toxicity import reject


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return reject(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are similar to an earlier line go; documents stay."""
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts; documents stay."""
    return remove_passages(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text, their number, and the text that they decode to."""
    coded = decode(encode(docs, "text", "token_ids"), "token_ids", "decoded")
    return coded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe),
]

#: SQL can't express the fitted model of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each from the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
