"""From raw documents to token ids: quality, exact copies, near copies, benchmark leaks, BPE.

Each stage works on all that the stage before it kept, written as Parquet in
the shared folder; all stages but the last keep the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import bpe, decontaminate, jaccard_join, recipes, rules
from quayside.llm.queries import QUALITY_FOLD
from quayside.session import materialise, tune, tune_texts
from quayside.tables import Tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; it learns from the labels of the documents it is given."""
    tune(spark)
    return rules.keep_good(docs, rules.train(docs, Tables(spark, sf_dir).labels, QUALITY_FOLD))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to the case of A-Z, the row with the largest doc_id."""
    tune(spark)
    return recipes.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by links of five-word shingles, that with the smallest doc_id."""
    tune_texts(spark)
    return jaccard_join.drop_near(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    tune(spark)
    return decontaminate.drop_leaks(docs, Tables(spark, sf_dir).benchmark)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and the hashes of ids and decoded text, for each document."""
    tune_texts(spark)
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

#: SQL can't express the classifier, the join and the encoding; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the whole table of documents; the last stage's rows are returned."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
