"""Regional weekly conflict aggregates (CSV) → ``fact_incident``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskfabric import refdata, schemas
from riskfabric.functions import ids, text
from riskfabric.operators import lookup
from riskfabric.sources.common import arrival_of, list_files, overrides_df, read_csv_strings, union_all

SOURCE = "ACLED"


def regional_files(spark: SparkSession, raw_dir: str) -> list[str]:
    """Regional files by glob, summary files (``number_of_*``) excluded."""
    files = list_files(spark, f"{raw_dir.rstrip('/')}/{refdata.ACLED_FILE_GLOB}")
    return [f for f in files if not f.rsplit("/", 1)[-1].startswith(refdata.ACLED_SUMMARY_PREFIX)]


def _header_line(spark: SparkSession, path: str) -> str:
    """First line of a file through the Hadoop FS (reads a few bytes, not the file)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def read(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    """All regional files, headers trimmed and upper-cased, required columns checked per file.

    Files are grouped by their normalised header (read from each file's first
    line only); each group is ONE multi-file read, so the usual case — every
    region with the same header — is a single scan however many files there
    are. Groups with different column order or case are unioned by name.
    """
    import csv

    groups: dict[tuple[str, ...], list[str]] = {}
    for path in regional_files(spark, raw_dir):
        raw_cols = next(csv.reader([_header_line(spark, path)]), [])
        cols = tuple(c.strip().upper() for c in raw_cols)
        require_columns_list(cols, path.rsplit("/", 1)[-1])
        groups.setdefault(cols, []).append(path)
    frames = []
    for cols, paths in groups.items():
        df = read_csv_strings(spark, paths)
        frames.append(df.toDF(*[c if c.startswith("_") else c.strip().upper() for c in df.columns]))
    return union_all(frames) if frames else None


def require_columns_list(cols: tuple[str, ...], what: str) -> None:
    missing = sorted(set(refdata.ACLED_REQUIRED) - set(cols))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def normalise(raw: DataFrame, countries: DataFrame, overrides: DataFrame | None = None,
              fuzzy: bool = False, seen: Observation | None = None) -> DataFrame:
    """Canonical incident rows; rows with an unparseable week or a missing/negative count are dropped.

    ``seen`` counts them on the same pass.
    """
    ov = overrides if overrides is not None else overrides_df(raw.sparkSession)
    week = F.try_to_date(F.col("WEEK").cast("string"), "yyyy-MM-dd")
    country = text.text_or_empty("COUNTRY")
    admin1 = text.text_or_empty("ADMIN1")
    etype = text.text_or_empty("EVENT_TYPE")
    sub = text.text_or_empty("SUB_EVENT_TYPE")
    sid = ids.normalise_numeric_id("ID")
    events = F.bround(F.col("EVENTS").cast("string").try_cast("double")).try_cast("int")
    fat = F.bround(F.coalesce(F.col("FATALITIES").cast("string").try_cast("double"), F.lit(0.0))).try_cast("int")
    staged = raw.select(
        F.lit(SOURCE).alias("source_system"),
        F.concat_ws("|", F.coalesce(F.date_format(week, "yyyy-MM-dd"), F.lit("")), country, admin1, etype, sub, sid)
        .alias("source_event_id"),
        week.alias("event_date"),
        F.nullif(country, F.lit("")).alias("_country"),
        F.nullif(admin1, F.lit("")).alias("admin1"),
        F.nullif(admin1, F.lit("")).alias("location_name"),
        F.col("CENTROID_LATITUDE").cast("string").try_cast("double").alias("latitude"),
        F.col("CENTROID_LONGITUDE").cast("string").try_cast("double").alias("longitude"),
        F.nullif(etype, F.lit("")).alias("event_type"),
        F.nullif(sub, F.lit("")).alias("sub_event_type"),
        text.blank_to_null(F.coalesce(F.col("DISORDER_TYPE").cast("string"), F.lit(""))).alias("disorder_type"),
        (F.lower(etype) == F.lit(refdata.ACLED_CIVILIAN_EVENT)).alias("civilian_targeting"),
        events.alias("event_count"),
        fat.alias("fatalities_best"),
        fat.alias("fatalities_low"),
        fat.alias("fatalities_high"),
        F.lit(refdata.ACLED_NOTE).alias("notes"),
        *arrival_of(raw),
    )
    if seen is not None:
        staged = staged.observe(seen, F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("event_date").isNull()).alias("bad_dates"),
                                F.count_if(F.col("event_count").isNull() | (F.col("event_count") < 0)).alias("bad_counts"))
    staged = staged.where(F.col("event_date").isNotNull() & F.col("event_count").isNotNull()
                          & (F.col("event_count") >= 0))
    staged = staged.withColumn("incident_id", ids.make_id(F.lit(SOURCE), F.col("source_event_id")))
    staged = lookup.name_to_iso3(staged, "_country", countries, ov, "country_iso3", fuzzy)
    return schemas.present(staged, "fact_incident")
