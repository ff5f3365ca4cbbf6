"""Georeferenced conflict events (CSV, optionally zipped) → ``fact_incident``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskfabric import refdata, schemas
from riskfabric.functions import ids, text
from riskfabric.operators import lookup
from riskfabric.sources import archive
from riskfabric.sources.common import arrival_of, col_or_null, key_text_of, list_files, overrides_df, read_csv_strings, union_all

SOURCE = "UCDP_GED"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Plain or gzip CSV, all columns as strings. Free-text columns of this export may
    hold quoted line breaks, so records may span lines (one split per file)."""
    return read_csv_strings(spark, path, multi_line=True)


def read_zip(spark: SparkSession, path: str, columns: list[str] | None = None, first_only: bool = True) -> DataFrame:
    """CSV members of the zip archives at ``path`` (a glob), one task a member (``sources.archive``).

    An archive's first ``.csv`` member is read, or all of them.
    """
    return archive.read(spark, list_files(spark, path), columns, first_only)


def landed(spark: SparkSession, raw_dir: str) -> list[str]:
    """Archives and CSV files of the landing folder."""
    return [f for ext in ("zip", "csv", "csv.gz") for f in list_files(spark, f"{raw_dir.rstrip('/')}/*.{ext}")]


def read_landed(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    """All archives and CSV files of the landing folder, united by column name."""
    files = landed(spark, raw_dir)
    zips, plain = [f for f in files if f.endswith(".zip")], [f for f in files if not f.endswith(".zip")]
    frames = ([archive.read(spark, zips)] if zips else []) + [read(spark, f).drop("_source_file") for f in plain]
    return union_all(frames) if frames else None


#: Columns that a file may lack; a load then keeps what is stored.
OPTIONAL = [("adm_1", "admin1"), ("adm_2", "admin2"), ("where_description", "location_name"), ("source_article", "source_urls")]


def _violence_label(code):
    pairs = []
    for k, v in refdata.VIOLENCE_TYPES:
        pairs += [F.lit(float(k)), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), code)


def normalise(raw: DataFrame, countries: DataFrame, overrides: DataFrame | None = None,
              fuzzy: bool = False, seen: Observation | None = None) -> DataFrame:
    ov = overrides if overrides is not None else overrides_df(raw.sparkSession)
    vt = F.col("type_of_violence").try_cast("double")
    dyad = F.coalesce(col_or_null(raw, "dyad_name"), F.lit(""))
    # The best-estimate column is chosen per file: 'best', else 'deaths_best', else 0.
    best_col = "best" if "best" in raw.columns else ("deaths_best" if "deaths_best" in raw.columns else None)

    def deaths(c):
        return (F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c else F.lit(0.0)).try_cast("int")

    key = F.lit(SOURCE), F.coalesce(F.col("id").cast("string"), F.lit("nan"))
    out = raw.select(
        F.lit(SOURCE).alias("source_system"),
        F.col("id").cast("string").alias("source_event_id"),
        ids.make_id(*key).alias("incident_id"),
        F.try_to_timestamp(F.trim("date_start")).cast("date").alias("event_date"),
        F.try_to_timestamp(F.trim("date_end")).cast("date").alias("event_date_end"),
        F.col("country").alias("_country"),
        *[F.col(c).alias(name) for c, name in OPTIONAL if c in raw.columns],
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.col("where_prec").try_cast("double").try_cast("int").alias("geo_precision"),
        _violence_label(vt).alias("event_type"),
        text.blank_to_null(text.split_part(dyad, " - ", 0)).alias("actor1_name"),
        text.blank_to_null(text.split_part(dyad, " - ", 1)).alias("actor2_name"),
        F.coalesce(vt == 3, F.lit(False)).alias("civilian_targeting"),
        deaths(best_col).alias("fatalities_best"),
        deaths("low" if "low" in raw.columns else None).alias("fatalities_low"),
        deaths("high" if "high" in raw.columns else None).alias("fatalities_high"),
        *arrival_of(raw), *key_text_of(raw, *key),
    )
    if seen is not None:
        out = out.observe(seen, F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("event_date").isNull()).alias("bad_dates"))
    out = out.where(F.col("event_date").isNotNull())
    out = lookup.name_to_iso3(out, "_country", countries, ov, "country_iso3", fuzzy)
    return schemas.present(out, "fact_incident")
