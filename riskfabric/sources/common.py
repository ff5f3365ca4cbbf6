"""Shared helpers for landing-file readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric import refdata
from riskfabric.functions import ids
from riskfabric.schemas import ARRIVAL, KEY_TEXT
from riskfabric.sources.dims import lookup_table


def with_arrival(scan: DataFrame) -> DataFrame:
    """Add the arrival order to rows just read from files: file path, start of the split, place in it.

    The place only has to grow within a split, which one task reads in order; path and split
    start order the rest, however Spark packs the splits into tasks.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    return scan.withColumn(ARRIVAL, place)


def arrival_of(df: DataFrame) -> list[str]:
    """The arrival column, if the rows have one (for a ``select``)."""
    return [ARRIVAL] if ARRIVAL in df.columns else []


def key_text_of(df: DataFrame, *parts: Column) -> list[Column]:
    """The text of a row's id, for rows that have an arrival column: those that a load keeps one a key of."""
    return [ids.key_text(*parts).alias(KEY_TEXT)] if ARRIVAL in df.columns else []


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted file paths matching a Hadoop glob (metadata only; no data read on the driver)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st = fs.globStatus(p)
    if st is None:
        return []
    return sorted(s.getPath().toString() for s in st if s.isFile())


def read_csv_strings(spark: SparkSession, path: str, header: bool = True, multi_line: bool = False,
                     **opts) -> DataFrame:
    """CSV as all-string columns (no inference), with the file name attached.

    ``multi_line`` allows quoted fields that span lines; it makes each file a
    single split, so it is only turned on for sources whose fields need it.
    """
    r = spark.read.option("header", header).option("inferSchema", False).option("multiLine", multi_line)
    r = r.option("escape", '"')
    for k, v in opts.items():
        r = r.option(k, v)
    return with_arrival(r.csv(path).withColumn("_source_file", F.col("_metadata.file_name")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def require_columns(df: DataFrame, required: list[str], what: str) -> None:
    """Raise listing the missing columns."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def overrides_df(spark: SparkSession) -> DataFrame:
    return lookup_table(spark, refdata.NAME_OVERRIDES, "name").drop("ord")


def col_or_null(df: DataFrame, name: str):
    """The column if the input has it, else a string NULL (optional source columns)."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")
