"""Data-quality checks (G8; A18–A20; F10–F14).

Row-level checks on one table are computed in ONE scan with conditional counts
and unpivoted afterwards; duplicate-key checks are a grouped count (partial
aggregation before the shuffle). Results are small DataFrames; nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfabric.functions import dates


def duplicate_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of keys occurring more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
            .agg(F.count(F.lit(1)).alias("violations")))


def unmapped_countries(fact_risk_indicator: DataFrame, dim_country: DataFrame) -> DataFrame:
    """One row: distinct indicator countries absent from the dimension.

    ``NOT IN`` over a non-NULL primary key equals a left-anti join; NULL
    countries are excluded first, as ``NULL NOT IN (...)`` is never true.
    """
    f = fact_risk_indicator.where(F.col("country_iso3").isNotNull())
    anti = f.join(dim_country.select(F.col("iso3").alias("country_iso3")), "country_iso3", "left_anti")
    return anti.agg(F.countDistinct("country_iso3").alias("violations"))


def incident_row_checks(fact_incident: DataFrame) -> DataFrame:
    """Invalid coordinates, negative fatalities, invalid event_count — one scan."""
    lat, lon = F.col("latitude"), F.col("longitude")
    bad_geo = (lat.isNotNull() & ((lat < -90) | (lat > 90))) | (lon.isNotNull() & ((lon < -180) | (lon > 180)))
    neg = (F.col("fatalities_best") < 0) | (F.col("fatalities_low") < 0) | (F.col("fatalities_high") < 0)
    bad_ec = F.col("event_count").isNull() | (F.col("event_count") < 0)
    a = fact_incident.agg(
        F.count_if(F.coalesce(bad_geo, F.lit(False))).alias("geo"),
        F.count_if(F.coalesce(neg, F.lit(False))).alias("neg"),
        F.count_if(bad_ec).alias("ec"),
    )
    return a.selectExpr(
        "stack(3, 'fact_incident invalid lat/lon', geo, 'fact_incident negative fatalities', neg,"
        " 'fact_incident invalid event_count', ec) AS (check_name, violations)"
    )


def news_missing_country(fact_news_pulse: DataFrame) -> DataFrame:
    return fact_news_pulse.agg(F.count_if(F.col("country_focus_iso3").isNull()).alias("violations")).select(
        F.lit("fact_news_pulse missing country").alias("check_name"), "violations")


def incident_checks(fact_incident: DataFrame) -> DataFrame:
    """Duplicate ids plus the three row checks on fact_incident in ONE scan and one shuffle.

    Rows are grouped by id with the row-level violations counted per id; a global
    aggregate then counts ids seen more than once and sums the row counts.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    bad_geo = (lat.isNotNull() & ((lat < -90) | (lat > 90))) | (lon.isNotNull() & ((lon < -180) | (lon > 180)))
    neg = (F.col("fatalities_best") < 0) | (F.col("fatalities_low") < 0) | (F.col("fatalities_high") < 0)
    bad_ec = F.col("event_count").isNull() | (F.col("event_count") < 0)
    per_id = fact_incident.groupBy("incident_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(bad_geo, F.lit(False))).alias("geo"),
        F.count_if(F.coalesce(neg, F.lit(False))).alias("neg"),
        F.count_if(bad_ec).alias("ec"),
    )
    tot = per_id.agg(
        F.count_if(F.col("n") > 1).cast("long").alias("dup"),
        F.sum("geo").cast("long").alias("geo"), F.sum("neg").cast("long").alias("neg"),
        F.sum("ec").cast("long").alias("ec"),
    )
    return tot.selectExpr(
        "stack(4, 'fact_incident duplicate PKs', coalesce(dup, 0L), 'fact_incident invalid lat/lon', coalesce(geo, 0L),"
        " 'fact_incident negative fatalities', coalesce(neg, 0L), 'fact_incident invalid event_count', coalesce(ec, 0L))"
        " AS (check_name, violations)"
    )


def qa_checks(fact_incident: DataFrame, fact_diplomatic_action: DataFrame, fact_risk_indicator: DataFrame,
              fact_news_pulse: DataFrame, dim_country: DataFrame) -> DataFrame:
    """The seven (check_name, violations) checks in one DataFrame (G8 without the coverage check).

    Each fact table is scanned once.
    """
    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("check_name"), F.col("violations").cast("long").alias("violations"))

    parts = [
        incident_checks(fact_incident),
        named(duplicate_key_count(fact_diplomatic_action, ["action_id"]), "fact_diplomatic_action duplicate PKs"),
        named(unmapped_countries(fact_risk_indicator, dim_country), "fact_risk_indicator unmapped countries"),
        news_missing_country(fact_news_pulse).withColumn("violations", F.col("violations").cast("long")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def coverage_after(fact_incident: DataFrame, cutoff: str, source: str = "ACLED") -> DataFrame:
    """Rows/incidents after ``cutoff`` and the share from one source.

    SUM … FILTER is NULL when no row matches; ``sum(when(...))`` keeps that.
    """
    f = fact_incident.where(F.col("event_date") > dates.as_date(cutoff))
    is_src = F.col("source_system") == F.lit(source)
    inc = F.coalesce(F.col("event_count"), F.lit(1))
    return f.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(inc).cast("long").alias("total_incidents"),
        F.count_if(is_src).alias("acled_rows"),
        F.sum(F.when(is_src, inc)).cast("long").alias("acled_incidents"),
    ).select(F.lit(f"post-{cutoff[:4]} incident coverage ({source} only)").alias("check_name"), "*")
