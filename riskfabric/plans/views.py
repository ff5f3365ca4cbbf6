"""The four aggregate views over the fact tables (A1–A4).

All are single hash aggregations: Spark runs a map-side partial aggregate
before the shuffle, so a country holding a third of the rows is collapsed to
one row per (task, group) before it moves. ``countDistinct`` with other
aggregates plans as a two-level aggregate keyed by the extra column, which
keeps that property.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfabric.functions import dates


def _incidents(ec: str = "event_count"):
    """SUM(COALESCE(event_count, 1)) as BIGINT (one row may stand for many events)."""
    return F.sum(F.coalesce(F.col(ec), F.lit(1))).cast("long")


def _civilian_incidents():
    return F.sum(
        F.when(F.col("civilian_targeting"), F.coalesce(F.col("event_count"), F.lit(1))).otherwise(F.lit(0))
    ).cast("long")


def country_week_agg(fact_incident: DataFrame) -> DataFrame:
    """(week_start, country, region, event_type): incidents, fatalities, civilian incidents, source count."""
    return fact_incident.groupBy(
        dates.week_start("event_date").alias("week_start"), "country_iso3", "region_code", "event_type"
    ).agg(
        _incidents().alias("incident_count"),
        F.sum("fatalities_best").cast("long").alias("fatalities_total"),
        _civilian_incidents().alias("civilian_incidents"),
        F.countDistinct("source_system").alias("source_count"),
    )


def country_month_agg(fact_incident: DataFrame) -> DataFrame:
    """(month_start, country, region): incidents, fatalities, civilian incidents."""
    return fact_incident.groupBy(
        dates.month_start("event_date").alias("month_start"), "country_iso3", "region_code"
    ).agg(
        _incidents().alias("incident_count"),
        F.sum("fatalities_best").cast("long").alias("fatalities_total"),
        _civilian_incidents().alias("civilian_incidents"),
    )


def country_year_diplomatic(fact_diplomatic_action: DataFrame) -> DataFrame:
    """(year_start, coalesce(target, actor), action_type): action count; undated rows excluded."""
    return (
        fact_diplomatic_action.where(F.col("action_date").isNotNull())
        .groupBy(
            dates.year_start("action_date").alias("year_start"),
            F.coalesce("target_iso3", "actor_iso3").alias("country_iso3"),
            "action_type",
        )
        .agg(F.count(F.lit(1)).alias("action_count"))
    )


def country_week_news(fact_news_pulse: DataFrame) -> DataFrame:
    """(week_start, country, region): article count and mean tone; rows without a country excluded."""
    return (
        fact_news_pulse.where(F.col("country_focus_iso3").isNotNull())
        .groupBy(dates.week_start("published_at_utc").alias("week_start"), "country_focus_iso3", "region_code")
        .agg(F.count(F.lit(1)).alias("article_count"), F.avg("tone").alias("avg_tone"))
    )
