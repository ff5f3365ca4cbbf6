"""The ``opN_<name>`` queries: each applies its operator to the whole table it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric.catalog import Query
from riskfabric.llm import (
    elias_fano,
    exact_sort,
    harmonic_pack,
    license_index,
    parity_join,
    pii_crf,
    piece_rounds,
    pivotal_mix,
    posting_ann,
    shallot_kmeans,
    token_align,
    token_counts,
    toxicity,
)

_QUERIES: dict[str, Query] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        _QUERIES[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn

    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry() -> dict[str, Query]:
    """All queries of the subpackage, the pipeline included."""
    import corpus_pipeline

    return _QUERIES | {"pipeline": Query("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL, "The corpus pipeline.")}


@_register("op1_noisy_channel_toxicity")
def op1_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learnt from the labels outside the held-out fifth."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity.training_labels(_table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("toxic_words").alias("n_toxic_words"))


@_register("op2_content_sort", exact_sort.SQL)
def op2_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts after lower-casing A-Z; the largest doc_id of each stays."""
    return exact_sort.content_groups(_table(spark, sf_dir, "documents"))


@_register("op3_lstm_crf_pii")
def op3_lstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the patterns' spans and those that the tagger adds."""
    docs = _table(spark, sf_dir, "documents")
    return pii_crf.find(docs, pii_crf.fit(docs))


@_register("op4_elias_fano")
def op4_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id shards with Elias-Fano boundaries, written in doc_id order and read back."""
    return elias_fano.encode_and_read(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_register("op5_parity_sketch_join", parity_join.SQL)
def op5_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle-set sizes and the components of near duplicates."""
    return parity_join.jaccard_groups(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_register("op6_rare_word_licences")
def op6_rare_word_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    return license_index.scan(_table(spark, sf_dir, "documents"))


@_register("op7_posting_lists")
def op7_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for each vector whose vec_id is divisible by 50."""
    vectors = _table(spark, sf_dir, "embeddings")
    return posting_ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)


@_register("op8_merge_rounds")
def op8_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, with an end id, and the text that they decode to."""
    found = piece_rounds.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_register("op9_harmonic_packing")
def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return harmonic_pack.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_register("op10_whole_token_counts")
def op10_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_register("op11_pivotal_mix")
def op11_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by weight takes of every document."""
    found = pivotal_mix.mix(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "part")


@_register("op12_shallot_kmeans", shallot_kmeans.SQL)
def op12_shallot_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors of 64 components after 5 rounds from 40 centroids."""
    return shallot_kmeans.clusters(spark, _table(spark, sf_dir, "embeddings"))


@_register("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers lie over each other in every document."""
    return token_align.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
