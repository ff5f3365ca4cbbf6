"""News article lists (JSON) → ``fact_news_pulse``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfabric import refdata, schemas
from riskfabric.functions import ids
from riskfabric.operators import lookup
from riskfabric.operators.store import dedupe_first
from riskfabric.sources.common import overrides_df
from riskfabric.sources.dims import lookup_table

FIELDS = ("url", "title", "seendate", "domain", "sourcecountry", "themes", "tone")
#: Names of the article lists.
FILES = "artlist_*.json{,.gz}"
#: Articles as maps, so that a key that an article has can be told from one it lacks.
FILE = T.StructType([T.StructField("articles", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])


def read(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``artlist_*.json`` files, compressed (``.gz``) or not; one row per article with (file, position) for keep-first dedupe.

    A file that is not an object with ``articles`` yields no rows (explode drops NULL/empty).
    ``_has_themes`` tells whether the article has that key, even with a NULL.
    """
    # The folder, not a glob of its files: a glob makes each file a path of its own, listed by a task.
    df = spark.read.schema(FILE).options(multiLine=True, pathGlobFilter=FILES).json(raw_dir)
    df = df.select(F.col("_metadata.file_path").alias("_source_file"), F.posexplode("articles").alias("_pos", "a"))
    df = df.where(F.col("a").isNotNull())
    return df.select("_source_file", "_pos", *[F.col("a")[c].alias(c) for c in FIELDS], F.map_contains_key("a", F.lit("themes")).alias("_has_themes"))


def normalise(articles: DataFrame, countries: DataFrame, overrides: DataFrame | None = None,
              has_themes: bool | None = None) -> DataFrame:
    """Canonical news rows, first occurrence per item id kept (by file, position).

    ``topic_tags`` takes the ``themes`` column when any article of the input has that key
    (a choice for the whole input, as in the source); otherwise the ``tone`` text. The choice is a
    scalar subquery of the same job. Articles without ``_has_themes`` count by their values.
    """
    spark = articles.sparkSession
    ov = overrides if overrides is not None else overrides_df(spark)
    if has_themes is None:
        has = F.col("_has_themes") if "_has_themes" in articles.columns else F.col("themes").isNotNull()
        has_themes = articles.agg(F.coalesce(F.bool_or(has), F.lit(False)).alias("h")).scalar()
    else:
        has_themes = F.lit(has_themes)
    out = articles.select(
        "_source_file", "_pos",
        ids.key_text(F.coalesce("url", F.lit("nan")), F.coalesce("seendate", F.lit("nan"))).alias(schemas.KEY_TEXT),
        "seendate",
        F.col("sourcecountry").alias("_src_country"),
        "title", F.col("domain").alias("source_domain"), "url",
        F.substring(F.when(has_themes, F.col("themes")), 1, refdata.NEWS_TAGS_MAX).alias("_themes"),
        "tone",
    )
    # Articles with one id have one text; moved by it, they leave their ids behind and stand beside like ones.
    out = dedupe_first(out, [schemas.KEY_TEXT], ["_source_file", "_pos"])
    tags = F.when(has_themes, F.col("_themes")).otherwise(F.substring("tone", 1, refdata.NEWS_TAGS_MAX))
    out = out.select(
        ids.make_id(schemas.KEY_TEXT).alias("item_id"),
        F.try_to_timestamp(F.col("seendate"), F.lit(refdata.NEWS_TIME_FORMAT)).alias("published_at_utc"),
        "_src_country", "title", "source_domain", "url", tags.alias("topic_tags"), F.lit(1).alias("attention_count"),
        F.col("tone").try_cast("double").alias("tone"),
    )
    fips = lookup_table(spark, refdata.FIPS_EXTRA, "key", "iso3")
    out = lookup.news_country_to_iso3(out, "_src_country", countries, fips, ov, "country_focus_iso3")
    return schemas.present(out, "fact_news_pulse")
