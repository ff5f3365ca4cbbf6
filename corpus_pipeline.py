"""The corpus pipeline: toxicity, exact and near duplicates, personal data, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. All stages but the last
return the columns of documents:

1. toxicity: documents that score 0.5 or more go; the scorer learns from the labels outside the
   held-out fifth whose documents are among docs.
2. exact dedup: of equal texts (after lower-casing A-Z) the document with the largest doc_id stays.
3. near dedup: of each component of documents linked by a shingle Jaccard similarity of 0.8 or
   more, the one with the smallest doc_id stays. Documents without words are no duplicates.
4. personal data: spans are replaced by their kind, and n_chars counts the new text.
5. packing: a row per piece of a document in a sequence of at most 4096 tokens.

Rows with a null doc_id pass the first two stages like others; the third keeps them all, as
it can't name them. An empty table passes every stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric.llm import exact_sort, harmonic_pack, parity_join, pii_crf, toxicity
from riskfabric.llm.common import scratch_table
from riskfabric.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer takes for toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, toxicity.training_labels(labels)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_sort.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays."""
    groups = parity_join.jaccard_groups(docs)
    gone = scratch_table(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")), "near_duplicates")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii_crf.mask(docs, pii_crf.fit(docs), length_col="n_chars" if "n_chars" in docs.columns else None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens, a row per piece."""
    return harmonic_pack.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("personal data", mask_personal_data),
    ("packing", packing),
]

#: No SQL: the scorer, the tagger and the tokenizer can't be written in it. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
