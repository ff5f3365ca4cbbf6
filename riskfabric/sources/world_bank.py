"""Indicator JSON pages → ``fact_risk_indicator``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfabric import refdata, schemas
from riskfabric.operators import lookup
from riskfabric.schemas import ARRIVAL
from riskfabric.sources.common import arrival_of, with_arrival
from riskfabric.sources.dims import lookup_table

ITEM = T.StructType([
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("country", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("date", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
])


def read(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``<raw_dir>/<indicator>/page_*.json`` (each a JSON array) with the indicator from the folder name.

    A page is one API response (at most one page size of items), read whole as
    text and parsed with ``from_json`` as an array, so NULL array elements are
    dropped instead of turning the page into a corrupt record.
    """
    pages = with_arrival(spark.read.text(f"{raw_dir.rstrip('/')}/*/page_*.json", wholetext=True))
    ind = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/page_[^/]*\.json$", 1)
    codes = [c for c, _ in refdata.INDICATORS]
    items = pages.select(ind.alias("indicator_code"), ARRIVAL,
                         F.posexplode(F.from_json("value", T.ArrayType(ITEM))).alias("_place", "item"))
    items = items.where(F.col("indicator_code").isin(codes) & F.col("item").isNotNull())
    # A page is one row of the scan; an item's place in it comes last in the order.
    place = F.struct(F.col(f"{ARRIVAL}.file").alias("file"), F.col(f"{ARRIVAL}.block").alias("block"), F.col("_place").cast("long").alias("place"))
    return items.select("item.*", "indicator_code", place.alias(ARRIVAL))


def normalise(items: DataFrame, countries: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Rows with a value and an all-digit year; iso3 from the item, else alpha-2 lookup, else ''."""
    spark = items.sparkSession
    names = F.create_map(*[x for c, n in refdata.INDICATORS for x in (F.lit(c), F.lit(n))])
    if seen is not None:
        items = items.observe(seen, F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("value").isNull()).alias("without_value"),
                              F.count_if(~F.coalesce(F.col("date").rlike("^[0-9]+$"), F.lit(False))).alias("bad_dates"))
    f = items.where(F.col("value").isNotNull() & F.col("date").rlike("^[0-9]+$"))
    f = f.withColumn("_iso", F.upper(F.coalesce(F.col("countryiso3code"), F.lit(""))))
    f = f.withColumn("_a2", F.col("country.id"))
    special = lookup_table(spark, refdata.WB_SPECIAL_CODES, "code", "sp_iso3").drop("ord")
    a2 = countries.where(F.col("iso2").isNotNull()).select(F.upper("iso2").alias("code"),
                                                            F.col("iso3").alias("a2_iso3"))
    f = lookup.exact_lookup(f, "_a2", special, "code", "sp_iso3", "_sp")
    f = lookup.exact_lookup(f, "_a2", a2, "code", "a2_iso3", "_a2iso", normalise=F.upper)
    iso = F.when(F.col("_iso") != "", F.col("_iso")).otherwise(F.coalesce("_sp", "_a2iso", F.lit("")))
    out = f.select(
        iso.alias("country_iso3"),
        F.make_date(F.col("date").try_cast("int"), F.lit(1), F.lit(1)).alias("period_start"),
        "indicator_code",
        F.try_element_at(names, F.col("indicator_code")).alias("indicator_name"),
        F.col("value").cast("double").alias("value"),
        F.coalesce(F.col("unit"), F.lit("")).alias("unit"),
        F.lit("WORLD_BANK").alias("source_system"),
        F.concat(F.lit(refdata.INDICATOR_URL_PREFIX), F.col("indicator_code")).alias("source_url"),
        *arrival_of(items),
    )
    return schemas.present(out, "fact_risk_indicator")


def indicator_summary(rows: DataFrame) -> DataFrame:
    """Rows and distinct indicators loaded (A24) — one aggregate."""
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("indicator_code").alias("indicators"))
