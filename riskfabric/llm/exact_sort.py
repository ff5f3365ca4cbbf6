"""Exact deduplication by a content sort, in DataFrame operations only.

Splitters sampled by Spark's range partitioner deal the rows out by the first characters of
the normalised text and, where texts begin alike, by its digest, which spreads them and decides
nothing. Each partition is sorted externally by the whole text, so equal texts stand next
to each other, and a window's group boundaries come from comparing neighbouring rows in full.

A text whose copies weigh more than an average task is cut into pieces that follow each other in
that order: as many as it has tasks' weights, from the exact weight of every text. There are at most as many
such texts as tasks. The pieces' first rows, one a piece, are compared in full once more and joined.

Defined results: a null text counts as empty; empty texts are equal to each other;
a null identifier sorts below every other; of repeated rows (same identifier and
text) exactly one is kept; very long texts are compared whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfabric.llm.common import ascii_lower, scratch_table

#: Characters of the text that splitters hold: bounds what the sampler sends to the driver.
PREFIX_CHARS = 48
#: Weight of a row besides its text's bytes.
ROW_BYTES = 64
_PLACE = ["_prefix", "_sha", "_piece"]


def _digest(norm: Column) -> Column:
    """Spreads texts that begin alike; what is equal, comparisons decide."""
    return F.sha2(norm, 256)


def _placed(rows: DataFrame, tasks: int | None) -> DataFrame:
    """``rows`` (_id, _text, ...) with _prefix, _sha, _pieces (of its text, if it is heavy) and _piece (the row's own)."""
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_norm", ascii_lower(F.col("_text"))).withColumn("_sha", _digest(F.col("_norm")))
    weights = scratch_table(rows.groupBy("_sha").agg(F.sum(F.octet_length("_norm").cast("long") + ROW_BYTES).alias("w"), F.count(F.lit(1)).alias("n")), "content_weights")
    total = weights.agg(F.sum("w")).first()[0] or 0
    # Fewer than ``tasks`` texts can weigh more than a share of 1 / tasks each.
    heavy = weights.where((F.col("w") * tasks > total) & (F.col("n") > 1)).select(F.col("_sha").alias("_heavy"), F.greatest(F.lit(2), F.ceil(F.col("w") * tasks / total)).cast("int").alias("_pieces"))
    joined = rows.join(F.broadcast(heavy), F.col("_sha") == F.col("_heavy"), "left").drop("_heavy")
    # Repeated rows differ by the split that they come from.
    piece = F.when(F.col("_pieces") > 1, F.pmod(F.xxhash64("_id", F.spark_partition_id()), F.col("_pieces"))).otherwise(0).cast("int")
    placed = joined.withColumn("_piece", piece).withColumn("_prefix", ascii_lower(F.substring("_text", 1, PREFIX_CHARS)))
    return placed.drop("_norm")


def _dealt(placed: DataFrame) -> DataFrame:
    """Range-partitioned; the normalised text is made again behind the exchange, which so moves one text a row."""
    return placed.repartitionByRange(*_PLACE).withColumn("_norm", ascii_lower(F.col("_text")))


def _run():
    """Equal neighbours: the range partitioning covers the window's keys, so there is no second exchange."""
    return Window.partitionBy(*_PLACE, "_norm")


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tasks: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``tasks`` (the session's shuffle partitions by default) sets the weight beyond which a text is cut.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    run, heavy = _run(), F.col("_pieces") > 1
    rank = F.row_number().over(run.orderBy(F.desc_nulls_last("_id")))
    # Texts of one place that differ have numbers of their own, by the order of the texts themselves.
    number = F.dense_rank().over(Window.partitionBy(*_PLACE).orderBy("_norm"))
    local = _dealt(_placed(rows, tasks)).select(
        "_id", "_sha", "_piece", heavy.alias("_heavy"), number.alias("_run"), rank.alias("_rank"),
        F.max("_id").over(run).alias("_max"), F.count(F.lit(1)).over(run).alias("_size"),
        F.when(heavy & (rank == 1), F.col("_norm")).alias("_first"), F.when(heavy, F.col("_prefix")).alias("_begin"),
    )
    local = scratch_table(local, "content_runs")
    light = local.where("_heavy IS NULL OR NOT _heavy").select(
        F.col("_id").alias("doc_id"), F.col("_max").alias("keep_id"), F.col("_size").alias("group_size"), (F.col("_rank") == 1).alias("kept"), F.col("_sha").alias("text_sha256"),
    )
    # One row a piece of a heavy text: pieces of equal texts are neighbours again, compared in full.
    text = Window.partitionBy("_sha", "_first")
    pieces = local.where("_first IS NOT NULL").select(
        F.col("_sha").alias("p_sha"), F.col("_begin").alias("p_begin"), F.col("_piece").alias("p_piece"), F.col("_run").alias("p_run"), F.max("_max").over(text).alias("keep_id"),
        F.sum("_size").over(text).alias("group_size"), F.row_number().over(text.orderBy(F.desc_nulls_last("_max"), "_piece")).alias("p_order"),
    )
    same = (F.col("_sha") == F.col("p_sha")) & (F.col("_begin") == F.col("p_begin")) & (F.col("_piece") == F.col("p_piece")) & (F.col("_run") == F.col("p_run"))
    cut = local.where("_heavy").join(F.broadcast(pieces), same).select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", ((F.col("_rank") == 1) & (F.col("p_order") == 1)).alias("kept"), F.col("_sha").alias("text_sha256"),
    )
    return light.unionByName(cut)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tasks: int | None = None) -> DataFrame:
    """``docs`` with one row of each group of equal texts (the largest identifier), all columns unchanged.

    The whole row travels as one struct, so no input column can clash with a working column.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.struct("*").alias("_row"))
    placed, rank = _placed(rows, tasks), F.row_number().over(_run().orderBy(F.desc_nulls_last("_id")))
    light = _dealt(placed.where("_pieces IS NULL")).withColumn("_rank", rank).where("_rank = 1")
    # Of a heavy text one row a piece is left, which are compared in full once more.
    across = Window.partitionBy("_sha", "_norm").orderBy(F.desc_nulls_last("_id"), "_piece")
    heavy = _dealt(placed.where("_pieces IS NOT NULL")).withColumn("_rank", rank).where("_rank = 1")
    heavy = heavy.withColumn("_rank", F.row_number().over(across)).where("_rank = 1")
    return light.select("_row.*").unionByName(heavy.select("_row.*"))


SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM n
"""
