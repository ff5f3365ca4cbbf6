"""Dimension seeds (S8–S10) and country-code lookup tables.

Constant seed rows come from ``riskfabric.refdata`` (small, fixed lists). The
ISO-3166 country list is *data* supplied by the caller (for example a CSV read
with ``read_country_list``); it is not shipped with the library.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfabric import refdata, schemas
from riskfabric.functions import dates
from riskfabric.operators.store import insert_ignore


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(refdata.REGIONS, schemas.DIM_REGION)


def source_systems(spark: SparkSession) -> DataFrame:
    rows = [
        (c, n, u, a, _dt.date.fromisoformat(s) if s else None, _dt.date.fromisoformat(e) if e else None, notes)
        for c, n, u, a, s, e, notes in refdata.SOURCE_SYSTEMS
    ]
    return spark.createDataFrame(rows, schemas.DIM_SOURCE_SYSTEM)


def event_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(refdata.EVENT_TYPES, schemas.DIM_EVENT_TYPE)


def special_countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(refdata.SPECIAL_COUNTRIES, schemas.DIM_COUNTRY)


def region_map(spark: SparkSession, pairs: list[tuple[str, str]] = refdata.SEEDED_REGION_COUNTRIES) -> DataFrame:
    """(iso3, region_code) of the lists of countries by region; ``refdata.BACKFILL_REGION_COUNTRIES`` is the back-fill's."""
    lists = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(r).alias("region_code"), F.lit(c).alias("codes")) for r, c in pairs])))
    return lists.select(F.explode(F.split("codes", " ")).alias("iso3"), "region_code")


def date_dim(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per day between the bounds of a one-row DataFrame, inclusive, with calendar parts.

    ``bounds`` is typically ``spark.range(1).select(lit(d0).alias('start'), lit(d1).alias('end'))``
    or ``fact.agg(min(date), max(date))``.
    """
    days = bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date")))
                         .alias("date_key"))
    parts = dates.calendar_parts(F.col("date_key"))
    return days.select("date_key", *[v.alias(k) for k, v in parts.items()])


def calendar(spark: SparkSession, start: str = refdata.DATE_SPINE_START, end: str = refdata.DATE_SPINE_END) -> DataFrame:
    """The fixed 2010-01-01 … 2030-12-31 calendar."""
    b = spark.range(1).select(dates.as_date(start).alias("start"), dates.as_date(end).alias("end"))
    return date_dim(b)


def read_country_list(spark: SparkSession, path: str) -> DataFrame:
    """ISO-3166 list as CSV with header ``alpha_3,alpha_2,name``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("alpha_3", "alpha_2", "name")])
    return spark.read.schema(schema).option("header", True).csv(path)


def seed_countries(iso_countries: DataFrame, region_map: DataFrame, specials: DataFrame,
                   existing: DataFrame | None = None) -> DataFrame:
    """dim_country rows: ISO rows with mapped region, then special rows; insert-or-ignore (K5).

    ``region_map`` has (iso3, region_code). ISO rows come first inside the
    batch, so a special row whose code is already an ISO row is ignored.
    """
    iso = iso_countries.select(F.col("alpha_3").alias("iso3"), F.col("alpha_2").alias("iso2"), "name")
    rm = region_map.select("iso3", "region_code")
    base = iso.join(rm, "iso3", "left").select("iso3", "iso2", "name", "region_code").withColumn("_ord", F.lit(0))
    stage = base.unionByName(specials.withColumn("_ord", F.lit(1)))
    target = existing if existing is not None else stage.sparkSession.createDataFrame([], schemas.DIM_COUNTRY)
    merged = insert_ignore(target.withColumn("_ord", F.lit(-1)), stage, ["iso3"], ["_ord"])
    return merged.drop("_ord")


def lookup_table(spark: SparkSession, pairs: list[tuple], key: str = "key", value: str = "iso3") -> DataFrame:
    """A small two-column lookup DataFrame with an order column (for ordered lookups).

    A constant array, so that the optimizer knows its size.
    """
    rows = [F.struct(F.lit(k).cast("string").alias(key), F.lit(v).cast("string").alias(value), F.lit(i).alias("ord"))
            for i, (k, v) in enumerate(pairs)]
    return spark.range(1).select(F.inline(F.array(*rows)))
