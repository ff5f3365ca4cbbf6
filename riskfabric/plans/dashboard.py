"""Named dashboard queries (T1–T11, A9–A16, A21, A23, G3–G9) as DataFrame functions.

Conventions:

* Every ``ORDER BY … LIMIT`` gets the key columns as final tie-breakers, so the
  top-k is deterministic. ``orderBy().limit()`` plans as
  ``TakeOrderedAndProject`` (a per-task top-k then a k-row merge), so a limit
  never moves more than k rows per task.
* Filters on the base date are written against the base column, so they reach
  the parquet scan as pushed filters; month-truncated bounds add the implied
  base-date range (``dates.month_range_filter``).
* Aggregate first, then join ``dim_country`` for names: the dimension join then
  sees at most #countries rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfabric import refdata
from riskfabric.functions import dates, scoring, text
from riskfabric.operators.latest import adjacent_pairs, latest_per_key
from riskfabric.plans import views


def _named(df: DataFrame, dim_country: DataFrame, key: str, name_alias: str) -> DataFrame:
    """Left lookup of the display name with fallback to the code."""
    dim = dim_country.select(F.col("iso3").alias("_dc_iso3"), F.col("name").alias("_dc_name"))
    j = df.join(dim, df[key] == dim["_dc_iso3"], "left")
    return j.withColumn(name_alias, F.coalesce(F.col("_dc_name"), F.col(key))).drop("_dc_iso3", "_dc_name")


# ---------------------------------------------------------------------------
# Shared
# ---------------------------------------------------------------------------


def run_state(state: DataFrame) -> DataFrame:
    """Run-state rows, newest first, last run rendered to the minute."""
    return state.select(
        "source_name", dates.format_minute("last_run_utc").alias("last_run"), "records_processed", "status",
        "last_run_utc",
    ).orderBy(F.desc_nulls_last("last_run_utc"), "source_name").drop("last_run_utc")


# ---------------------------------------------------------------------------
# Overview
# ---------------------------------------------------------------------------


def kpi_global(fact_incident: DataFrame, d0: str, d1: str) -> DataFrame:
    """Totals over an inclusive date range (raw event_count; NULL sums on an empty range)."""
    f = fact_incident.where(dates.between_dates("event_date", d0, d1))
    return f.agg(
        F.sum("event_count").cast("long").alias("total_incidents"),
        F.sum("fatalities_best").cast("long").alias("total_fatalities"),
        F.countDistinct("country_iso3").alias("countries_affected"),
        F.sum(F.when(F.col("civilian_targeting"), F.col("event_count")).otherwise(F.lit(0))).cast("long")
        .alias("civilian_incidents"),
    )


def prior_window(d0: str, d1: str) -> tuple[str, str]:
    """Prior period for a KPI delta: [d0 - span, d0 - 1] with span = d1 - d0 in days."""
    import datetime as dt

    a, b = dt.date.fromisoformat(d0), dt.date.fromisoformat(d1)
    span = (b - a).days
    return str(a - dt.timedelta(days=span)), str(a - dt.timedelta(days=1))


def kpi_period_delta(fact_incident: DataFrame, d0: str, d1: str) -> DataFrame:
    """Current and prior KPIs from ONE scan with conditional aggregation, plus deltas (NULL→0)."""
    p0, p1 = prior_window(d0, d1)
    lo = min(p0, d0)
    f = fact_incident.where(dates.between_dates("event_date", lo, d1))
    cur = dates.between_dates("event_date", d0, d1)
    pri = dates.between_dates("event_date", p0, p1)
    ec, fat, ctry = F.col("event_count"), F.col("fatalities_best"), F.col("country_iso3")
    civ = F.when(F.col("civilian_targeting"), ec).otherwise(F.lit(0))
    aggs = []
    for tag, cond in (("", cur), ("prior_", pri)):
        aggs += [
            F.sum(F.when(cond, ec)).cast("long").alias(f"{tag}total_incidents"),
            F.sum(F.when(cond, fat)).cast("long").alias(f"{tag}total_fatalities"),
            F.countDistinct(F.when(cond, ctry)).alias(f"{tag}countries_affected"),
            F.sum(F.when(cond, civ)).cast("long").alias(f"{tag}civilian_incidents"),
        ]
    k = f.agg(*aggs)
    metrics = ["total_incidents", "total_fatalities", "countries_affected", "civilian_incidents"]
    return k.select(
        *metrics, *[f"prior_{m}" for m in metrics],
        *[(F.coalesce(F.col(m), F.lit(0)) - F.coalesce(F.col(f"prior_{m}"), F.lit(0))).cast("long")
          .alias(f"delta_{m}") for m in metrics],
    )


def latest_scores(grs: DataFrame) -> DataFrame:
    """Latest scored month per country (J5): max(struct) aggregate, NULL country dropped."""
    return latest_per_key(grs.where(F.col("grs_0_100").isNotNull()), "country_iso3", "month_start")


def grs_latest(grs: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Latest score per country with display name, highest first."""
    j = _named(latest_scores(grs), dim_country, "country_iso3", "country_name")
    return j.orderBy(F.desc_nulls_last("grs_0_100"), "country_iso3").select(
        "country_iso3", "country_name", F.round("grs_0_100", 1).alias("grs_score"),
        F.col("month_start").alias("score_month"), "coverage_flag",
    )


def grs_top10(grs: DataFrame, dim_country: DataFrame, n: int = 10) -> DataFrame:
    """T5: top-n of the latest scores."""
    j = _named(latest_scores(grs), dim_country, "country_iso3", "country")
    top = j.orderBy(F.desc_nulls_last("grs_0_100"), "country_iso3").limit(n)
    return top.select(
        "country_iso3", "country", F.round("grs_0_100", 1).alias("grs_score"), "coverage_flag",
        F.col("month_start").alias("as_of"),
    )


def grs_heatmap(grs: DataFrame, dim_country: DataFrame, n: int = 40) -> DataFrame:
    """Top-n latest scores with the five rounded drivers."""
    j = _named(latest_scores(grs), dim_country, "country_iso3", "country_name")
    top = j.orderBy(F.desc_nulls_last("grs_0_100"), "country_iso3").limit(n)
    return top.select(
        "country_iso3", "country_name",
        F.round("score_inc_norm", 3).alias("conflict_incidents"),
        F.round("score_fat_norm", 3).alias("conflict_fatalities"),
        F.round("score_san_norm", 3).alias("sanctions"),
        F.round("score_mil_norm", 3).alias("militarization"),
        F.round("score_news_norm", 3).alias("news_tension"),
        F.round("grs_0_100", 1).alias("grs_score"),
        "coverage_flag",
    )


def grs_top_movers(grs: DataFrame, dim_country: DataFrame, n: int = 12) -> DataFrame:
    """Per country, the latest adjacent-month pair; largest |Δ| first."""
    scored = grs.where(F.col("grs_0_100").isNotNull()).select("country_iso3", "month_start", "grs_0_100")
    pairs = adjacent_pairs(scored, "country_iso3", "month_start", "grs_0_100")
    pairs = pairs.select(
        "country_iso3",
        (F.col("current_value") - F.col("prev_value")).alias("delta"),
        F.col("current_value").alias("current_grs"),
        F.col("current_period").alias("current_month"),
    )
    latest = latest_per_key(pairs, "country_iso3", "current_month")
    j = _named(latest, dim_country, "country_iso3", "country")
    top = j.orderBy(F.abs("delta").desc(), "country_iso3").limit(n)
    return top.select(
        "country_iso3", "country", F.round("current_grs", 1).alias("grs"), F.round("delta", 1).alias("delta"),
    )


def grs_movers_direction(movers: DataFrame) -> DataFrame:
    """Direction label from the sign of the displayed (rounded) change."""
    return movers.withColumn("direction", scoring.direction(F.col("delta")))


def diplomatic_feed(fact_diplomatic_action: DataFrame, n: int = 15) -> DataFrame:
    """T4: newest non-sanction dated actions."""
    f = fact_diplomatic_action.where((F.col("action_type") != "sanction") & F.col("action_date").isNotNull())
    top = f.orderBy(F.desc("action_date"), "action_id").limit(n)
    return top.select(
        "action_date", F.coalesce("actor_iso3", F.lit("")).alias("actor"),
        F.coalesce("target_iso3", F.lit("")).alias("target"), "action_type", "instrument_name", "status",
    )


# ---------------------------------------------------------------------------
# Incidents
# ---------------------------------------------------------------------------


def weekly_timeline(fact_incident: DataFrame, d0: str, d1: str, region: str | None = None) -> DataFrame:
    """Weekly totals for weeks starting inside [d0, d1], optionally one region.

    The filter on ``week_start`` is pushed below the aggregate by Catalyst; the
    implied base-date bound (``event_date >= d0``, ``event_date < d1 + 7``)
    reaches the parquet scan.
    """
    fi = fact_incident.where(
        (F.col("event_date") >= dates.as_date(d0)) & (F.col("event_date") < F.date_add(dates.as_date(d1), 7))
    )
    if region is not None:
        fi = fi.where(F.col("region_code") == F.lit(region))
    cw = views.country_week_agg(fi).where(dates.between_dates("week_start", d0, d1))
    return cw.groupBy("week_start").agg(
        F.sum("incident_count").cast("long").alias("incidents"),
        F.sum("fatalities_total").cast("long").alias("fatalities"),
        F.sum("civilian_incidents").cast("long").alias("civilian_incidents"),
    ).orderBy("week_start")


def weekly_timeline_routed(fact_incident: DataFrame, d0: str, d1: str, regions: list[str]) -> DataFrame:
    """exactly one selected region → that region's timeline; none or several → all regions."""
    return weekly_timeline(fact_incident, d0, d1, regions[0] if len(regions) == 1 else None)


def region_breakdown(fact_incident: DataFrame, d0: str, d1: str) -> DataFrame:
    """Month-aligned totals by region ('Unknown' for NULL)."""
    fi = fact_incident.where(dates.month_range_filter(dates.month_start("event_date"), "event_date", d0, d1))
    cm = views.country_month_agg(fi)
    return cm.groupBy(F.coalesce("region_code", F.lit("Unknown")).alias("region")).agg(
        F.sum("incident_count").cast("long").alias("incidents"),
        F.sum("fatalities_total").cast("long").alias("fatalities"),
    ).orderBy(F.desc("incidents"), "region")


def event_type_breakdown(fact_incident: DataFrame, d0: str, d1: str) -> DataFrame:
    """Raw event_count and fatalities by event type inside [d0, d1]."""
    f = fact_incident.where(dates.between_dates("event_date", d0, d1) & F.col("event_type").isNotNull())
    return f.groupBy("event_type").agg(
        F.sum("event_count").cast("long").alias("incident_count"),
        F.sum("fatalities_best").cast("long").alias("fatalities"),
    ).orderBy(F.desc("incident_count"), "event_type")


def top_fatalities(fact_incident: DataFrame, dim_country: DataFrame, d0: str, d1: str, n: int = 20) -> DataFrame:
    """Per-country fatalities and incidents; aggregate first, then name lookup."""
    f = fact_incident.where(dates.between_dates("event_date", d0, d1))
    agg = f.groupBy("country_iso3").agg(
        F.sum("fatalities_best").cast("long").alias("total_fatalities"),
        F.sum("event_count").cast("long").alias("total_incidents"),
    )
    j = _named(agg, dim_country, "country_iso3", "country")
    top = j.orderBy(F.desc_nulls_last("total_fatalities"), F.asc_nulls_last("country_iso3")).limit(n)
    return top.select("country_iso3", "country", "total_fatalities", "total_incidents")


def top_fatalities_nonzero(fact_incident: DataFrame, dim_country: DataFrame, d0: str, d1: str,
                           n: int = 20, show: int = 15) -> DataFrame:
    """the top-n list, rows with fatalities > 0 only, first ``show`` of them."""
    t = top_fatalities(fact_incident, dim_country, d0, d1, n)
    return t.where(F.col("total_fatalities") > 0).orderBy(
        F.desc_nulls_last("total_fatalities"), F.asc_nulls_last("country_iso3")).limit(show)


# ---------------------------------------------------------------------------
# Diplomatic actions
# ---------------------------------------------------------------------------


def sanctions_by_country(fact_diplomatic_action: DataFrame, dim_country: DataFrame,
                         n: int | None = 20) -> DataFrame:
    """Sanctions per target with the active subset; ``n=None`` keeps all targets."""
    f = fact_diplomatic_action.where((F.col("action_type") == "sanction") & F.col("target_iso3").isNotNull())
    agg = f.groupBy("target_iso3").agg(
        F.count(F.lit(1)).alias("total_sanctions"),
        F.count_if(F.col("status") == "active").alias("active_sanctions"),
    )
    j = _named(agg, dim_country, "target_iso3", "country_name")
    out = j.select(
        F.coalesce("target_iso3", F.lit("Unknown")).alias("target"), "country_name", "total_sanctions",
        "active_sanctions",
    ).orderBy(F.desc("total_sanctions"), "target")
    return out.limit(n) if n is not None else out


def sanction_kpis(fact_diplomatic_action: DataFrame, dim_country: DataFrame, n: int | None = 20) -> DataFrame:
    """Curated (non-sanction, dated) event count, designations total and number of
    sanctioned countries — the last two over the top-n list (``n=None``: all targets)."""
    s = sanctions_by_country(fact_diplomatic_action, dim_country, n)
    curated = events_timeline(fact_diplomatic_action).agg(F.count(F.lit(1))).scalar()
    return s.agg(
        F.count(F.lit(1)).alias("sanctioned_countries"),
        F.sum("total_sanctions").cast("long").alias("sanction_designations"),
    ).select(curated.alias("curated_events"), "sanctioned_countries", "sanction_designations")


def events_timeline(fact_diplomatic_action: DataFrame) -> DataFrame:
    """Dated non-sanction actions in date order."""
    f = fact_diplomatic_action.where((F.col("action_type") != "sanction") & F.col("action_date").isNotNull())
    return f.select(
        "action_date", F.coalesce("actor_iso3", F.lit("")).alias("actor_iso3"),
        F.coalesce("target_iso3", F.lit("")).alias("target_iso3"), "action_type", "action_subtype",
        "instrument_name", "status", "region", "notes", "source_url",
    ).orderBy("action_date")


def events_timeline_labelled(fact_diplomatic_action: DataFrame, d0: str, d1: str, label_chars: int = 55) -> DataFrame:
    """Timeline rows inside [d0, d1] with a short label and an 'actor → target' label."""
    t = events_timeline(fact_diplomatic_action).where(dates.between_dates("action_date", d0, d1))
    return t.select(
        "action_date", "action_type", "status",
        text.prefix("instrument_name", label_chars).alias("display_label"),
        text.arrow_label("actor_iso3", "target_iso3").alias("actor_target"),
    )


def feed_cards(fact_diplomatic_action: DataFrame, n: int = 10, chars: int = 60) -> DataFrame:
    """Overview feed cards: the newest ``n`` feed rows with a shortened instrument and an
    'actor → target' label (T4 + E11 + E13)."""
    feed = diplomatic_feed(fact_diplomatic_action, 15)
    top = feed.orderBy(F.desc("action_date"), "instrument_name").limit(n)
    return top.select(
        "action_date", "status", "action_type",
        text.prefix("instrument_name", chars).alias("headline"),
        text.arrow_label("actor", "target").alias("actors"),
    )


def actions_by_type(fact_diplomatic_action: DataFrame) -> DataFrame:
    """Non-sanction actions per type (NULL types drop out of ``!=``)."""
    f = fact_diplomatic_action.where(F.col("action_type") != "sanction")
    return f.groupBy("action_type").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "action_type")


# ---------------------------------------------------------------------------
# Risk score page
# ---------------------------------------------------------------------------


def grs_country_trend(grs: DataFrame, country: str) -> DataFrame:
    """One country's scored months."""
    g = grs.where((F.col("country_iso3") == F.lit(country)) & F.col("grs_0_100").isNotNull())
    return g.select(
        "month_start", F.round("grs_0_100", 1).alias("grs_score"),
        F.round("score_inc_norm", 3).alias("conflict_incidents"),
        F.round("score_fat_norm", 3).alias("conflict_fatalities"),
        F.round("score_san_norm", 3).alias("sanctions"),
        F.round("score_mil_norm", 3).alias("militarization"),
        F.round("score_news_norm", 3).alias("news_tension"),
    ).orderBy("month_start")


def driver_contributions(trend: DataFrame) -> DataFrame:
    """Per-driver contribution = round(score × weight × 100, 2), in long form (one row per driver).

    The rounding is done in exact decimal arithmetic (half-up), so a product that
    is a tie in decimal (e.g. 2.765) rounds the same way on every engine.
    """
    stack_args = ", ".join(
        f"'{name}', cast(round(cast({name} * {w} * 100 AS decimal(20, 6)), 2) AS double)"
        for name, w in refdata.DRIVER_WEIGHTS)
    return trend.selectExpr("month_start", f"stack({len(refdata.DRIVER_WEIGHTS)}, {stack_args}) AS (driver, contribution)")


def latest_band(grs: DataFrame) -> DataFrame:
    """G9 + G3: each country's latest score and its risk band."""
    latest = latest_scores(grs)
    return latest.select("country_iso3", "month_start", "grs_0_100",
                         scoring.band(F.col("grs_0_100")).alias("band"))


def indicators_country(fact_risk_indicator: DataFrame, country: str) -> DataFrame:
    """One country's indicators ordered by (name, period)."""
    f = fact_risk_indicator.where(F.col("country_iso3") == F.lit(country))
    return f.select("period_start", "indicator_name", F.round("value", 2).alias("value"), "unit").orderBy(
        F.asc_nulls_last("indicator_name"), "period_start")


def indicators_pivot(fact_risk_indicator: DataFrame, country: str, names: list[str], name_col: str = "indicator_name") -> DataFrame:
    """Indicators of one country pivoted to columns (mean per period); the column list is fixed."""
    f = fact_risk_indicator.where(F.col("country_iso3") == F.lit(country))
    return f.groupBy("period_start").pivot(name_col, names).agg(F.avg("value"))


def region_label(code: Column) -> Column:
    """Display label for a region code, falling back to the code."""
    pairs = []
    for k, v in refdata.REGION_LABELS:
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)
