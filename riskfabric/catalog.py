"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and,
where the query is SQL-expressible, an independent DuckDB oracle statement.

Parameters are fixed per query (the fixture data spans 1995-01 … 2001-11). All
queries run over the whole tables. Computed doubles whose value depends on
summation order are rounded to 6 digits on both sides (SURVEY §7.4).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric.oracle import with_fixtures
from riskfabric.plans import dashboard, grs, views
from riskfabric.sources import fixtures

# Query parameters (fixed for the correctness gate and the bench).
D0, D1 = "1996-01-01", "1998-12-31"
REGION = "ASIA"
COUNTRY = "N05"
COVERAGE_CUTOFF = "1999-12-31"


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doc: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, doc or (fn.__doc__ or "").strip())
        return fn

    return deco


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round the named double columns to 6 digits (order-dependent float sums)."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def _wh(spark: SparkSession, sf_dir: str) -> fixtures.Warehouse:
    return fixtures.warehouse(spark, sf_dir)


def _grs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grs.grs_from(_wh(spark, sf_dir))


# ---------------------------------------------------------------------------
# Aggregate views (A1–A4)
# ---------------------------------------------------------------------------


@register("country_week_agg", with_fixtures("""
SELECT cast(date_trunc('week', event_date) AS date) AS week_start, country_iso3, region_code, event_type,
       cast(sum(coalesce(event_count, 1)) AS bigint) AS incident_count,
       cast(sum(fatalities_best) AS bigint) AS fatalities_total,
       cast(sum(CASE WHEN civilian_targeting THEN coalesce(event_count, 1) ELSE 0 END) AS bigint) AS civilian_incidents,
       count(DISTINCT source_system) AS source_count
FROM fact_incident GROUP BY 1, 2, 3, 4""", ["fact_incident"]))
def q_country_week_agg(spark, sf_dir):
    return views.country_week_agg(fixtures.fact_incident(spark, sf_dir))


@register("country_month_agg", with_fixtures("""
SELECT cast(date_trunc('month', event_date) AS date) AS month_start, country_iso3, region_code,
       cast(sum(coalesce(event_count, 1)) AS bigint) AS incident_count,
       cast(sum(fatalities_best) AS bigint) AS fatalities_total,
       cast(sum(CASE WHEN civilian_targeting THEN coalesce(event_count, 1) ELSE 0 END) AS bigint) AS civilian_incidents
FROM fact_incident GROUP BY 1, 2, 3""", ["fact_incident"]))
def q_country_month_agg(spark, sf_dir):
    return views.country_month_agg(fixtures.fact_incident(spark, sf_dir))


@register("country_year_diplomatic", with_fixtures("""
SELECT cast(date_trunc('year', action_date) AS date) AS year_start,
       coalesce(target_iso3, actor_iso3) AS country_iso3, action_type, count(*) AS action_count
FROM fact_diplomatic_action WHERE action_date IS NOT NULL GROUP BY 1, 2, 3""", ["fact_diplomatic_action"]))
def q_country_year_diplomatic(spark, sf_dir):
    return views.country_year_diplomatic(fixtures.fact_diplomatic_action(spark, sf_dir))


@register("country_week_news", with_fixtures("""
SELECT cast(date_trunc('week', cast(published_at_utc AS date)) AS date) AS week_start,
       country_focus_iso3, region_code, count(*) AS article_count, round(avg(tone), 6) AS avg_tone
FROM fact_news_pulse WHERE country_focus_iso3 IS NOT NULL GROUP BY 1, 2, 3""", ["fact_news_pulse"]))
def q_country_week_news(spark, sf_dir):
    return r6(views.country_week_news(fixtures.fact_news_pulse(spark, sf_dir)), "avg_tone")


# ---------------------------------------------------------------------------
# Composite score parts (A5–A8, J1, J2) and the score
# ---------------------------------------------------------------------------


@register("incidents_monthly", with_fixtures("SELECT * FROM incidents_monthly", [], grs=True))
def q_incidents_monthly(spark, sf_dir):
    return grs.incidents_monthly(fixtures.fact_incident(spark, sf_dir))


@register("sanctions_monthly", with_fixtures("SELECT * FROM sanctions_monthly", [], grs=True))
def q_sanctions_monthly(spark, sf_dir):
    return grs.sanctions_monthly(fixtures.fact_diplomatic_action(spark, sf_dir))


@register("news_monthly", with_fixtures(
    "SELECT country_iso3, month_start, article_count, round(avg_tone, 6) AS avg_tone FROM news_monthly", [], grs=True))
def q_news_monthly(spark, sf_dir):
    return r6(grs.news_monthly(fixtures.fact_news_pulse(spark, sf_dir)), "avg_tone")


@register("asof_population", with_fixtures("""
SELECT country_iso3, month_start, incident_count, fatalities, population,
       round(incident_rate_100k, 6) AS incident_rate_100k, round(fatality_rate_100k, 6) AS fatality_rate_100k
FROM conflict_base""", [], grs=True))
def q_asof_population(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    cb = grs.conflict_base(wh.fact_incident, wh.fact_risk_indicator)
    return r6(cb, "incident_rate_100k", "fatality_rate_100k")


@register("asof_population_bucketed", with_fixtures("""
SELECT country_iso3, month_start, incident_count, fatalities, population,
       round(incident_rate_100k, 6) AS incident_rate_100k, round(fatality_rate_100k, 6) AS fatality_rate_100k
FROM conflict_base""", [], grs=True))
def q_asof_population_bucketed(spark, sf_dir):
    """The same as-of join through the skew-robust bucketed plan (used when the right side is large)."""
    wh = _wh(spark, sf_dir)
    cb = grs.conflict_base(wh.fact_incident, wh.fact_risk_indicator, strategy="bucketed")
    return r6(cb, "incident_rate_100k", "fatality_rate_100k")


@register("asof_milex", with_fixtures("""
SELECT country_iso3, month_start, milex_pct_gdp FROM conflict_base""",
    [], grs=True))
def q_asof_milex(spark, sf_dir):
    from riskfabric import refdata
    from riskfabric.functions import dates
    from riskfabric.operators.asof import asof_left

    wh = _wh(spark, sf_dir)
    im = grs.incidents_monthly(wh.fact_incident).select("country_iso3", "month_start")
    milex = grs.indicator_series(wh.fact_risk_indicator, refdata.MILITARY_CODE, "milex_pct_gdp")
    return asof_left(im, milex, "country_iso3", dates.year_start("month_start"), "period_start", ["milex_pct_gdp"])


@register("grs_combined", with_fixtures("""
SELECT country_iso3, month_start, round(incident_rate_100k, 6) AS incident_rate_100k,
       round(fatality_rate_100k, 6) AS fatality_rate_100k, sanction_count, milex_pct_gdp, article_count,
       round(avg_tone, 6) AS avg_tone
FROM combined""", [], grs=True))
def q_grs_combined(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    c = grs.combined(wh.fact_incident, wh.fact_diplomatic_action, wh.fact_risk_indicator, wh.fact_news_pulse)
    return r6(c, "incident_rate_100k", "fatality_rate_100k", "avg_tone")


@register("grs_bounds", with_fixtures("SELECT " + ", ".join(
    f"{f'round({side}({v}), 6)' if d in ('inc', 'fat') else f'{side}({v})'} AS {side}_{d}"
    for d, v in (("inc", "incident_rate_100k"), ("fat", "fatality_rate_100k"), ("san", "sanction_count"), ("mil", "milex_pct_gdp"), ("art", "article_count"))
    for side in ("max", "min")) + " FROM combined", [], grs=True))
def q_grs_bounds(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    c = grs.combined(wh.fact_incident, wh.fact_diplomatic_action, wh.fact_risk_indicator, wh.fact_news_pulse)
    return r6(grs.norm_bounds(c), "max_inc", "min_inc", "max_fat", "min_fat")


_GRS_COLS = ["score_inc_norm", "score_fat_norm", "score_san_norm", "score_mil_norm", "score_news_norm", "grs_0_100"]


@register("grs_monthly", with_fixtures(
    "SELECT country_iso3, month_start, " + ", ".join(f"round({c}, 6) AS {c}" for c in _GRS_COLS)
    + ", coverage_flag FROM grs_monthly", [], grs=True))
def q_grs_monthly(spark, sf_dir):
    """Flagship: monthly 0–100 composite risk score with sub-scores and coverage flag."""
    return r6(_grs(spark, sf_dir), *_GRS_COLS)


# ---------------------------------------------------------------------------
# Dashboard: risk-score queries
# ---------------------------------------------------------------------------

#: The last change of each country's score between months that follow each other.
MOVES_SQL = """
moves AS (
  SELECT country_iso3, arg_max(score, month_start) AS current_grs, arg_max(score - held, month_start) AS delta
  FROM (
    SELECT country_iso3, month_start, round(grs_0_100, 6) AS score,
           lag(round(grs_0_100, 6)) OVER months AS held, lag(month_start) OVER months AS held_month
    FROM grs_monthly WHERE grs_0_100 IS NOT NULL AND country_iso3 IS NOT NULL
    WINDOW months AS (PARTITION BY country_iso3 ORDER BY month_start)
  ) WHERE datediff('month', held_month, month_start) = 1
  GROUP BY country_iso3
)"""

_LATEST_SQL = """
latest AS (
  SELECT * FROM grs_monthly WHERE country_iso3 IS NOT NULL
  QUALIFY month_start = max(month_start) FILTER (grs_0_100 IS NOT NULL) OVER (PARTITION BY country_iso3)
)"""


@register("grs_latest", with_fixtures("""
SELECT l.country_iso3, coalesce(dc.name, l.country_iso3) AS country_name, round(round(l.grs_0_100, 6), 1) AS grs_score,
       l.month_start AS score_month, l.coverage_flag
FROM latest l LEFT JOIN dim_country dc ON dc.iso3 = l.country_iso3""", ["dim_country"], grs=True,
    extra_ctes=_LATEST_SQL))
def q_grs_latest(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return dashboard.grs_latest(r6(grs.grs_from(wh), *_GRS_COLS), wh.dim_country)


@register("grs_top10", with_fixtures("""
SELECT l.country_iso3, coalesce(dc.name, l.country_iso3) AS country, round(round(l.grs_0_100, 6), 1) AS grs_score,
       l.coverage_flag, l.month_start AS as_of
FROM latest l LEFT JOIN dim_country dc ON dc.iso3 = l.country_iso3
ORDER BY round(l.grs_0_100, 6) DESC NULLS LAST, l.country_iso3 LIMIT 10""", ["dim_country"], grs=True,
    extra_ctes=_LATEST_SQL))
def q_grs_top10(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return dashboard.grs_top10(r6(grs.grs_from(wh), *_GRS_COLS), wh.dim_country)


@register("grs_heatmap", with_fixtures("""
SELECT l.country_iso3, coalesce(dc.name, l.country_iso3) AS country_name,
       round(round(l.score_inc_norm, 6), 3) AS conflict_incidents,
       round(round(l.score_fat_norm, 6), 3) AS conflict_fatalities,
       round(round(l.score_san_norm, 6), 3) AS sanctions,
       round(round(l.score_mil_norm, 6), 3) AS militarization,
       round(round(l.score_news_norm, 6), 3) AS news_tension,
       round(round(l.grs_0_100, 6), 1) AS grs_score, l.coverage_flag
FROM latest l LEFT JOIN dim_country dc ON dc.iso3 = l.country_iso3
WHERE l.grs_0_100 IS NOT NULL
ORDER BY round(l.grs_0_100, 6) DESC NULLS LAST, l.country_iso3 LIMIT 40""", ["dim_country"], grs=True,
    extra_ctes=_LATEST_SQL))
def q_grs_heatmap(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return dashboard.grs_heatmap(r6(grs.grs_from(wh), *_GRS_COLS), wh.dim_country)


@register("grs_top_movers", with_fixtures("""
SELECT m.country_iso3, coalesce(name, m.country_iso3) AS country, round(current_grs, 1) AS grs, round(delta, 1) AS delta
FROM moves m LEFT JOIN dim_country d ON d.iso3 = m.country_iso3
ORDER BY abs(m.delta) DESC, 1 LIMIT 12""", ["dim_country"], grs=True, extra_ctes=MOVES_SQL))
def q_grs_top_movers(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return dashboard.grs_top_movers(r6(grs.grs_from(wh), *_GRS_COLS), wh.dim_country)


_TREND_COLS = """round(round(grs_0_100, 6), 1) AS grs_score,
       round(round(score_inc_norm, 6), 3) AS conflict_incidents,
       round(round(score_fat_norm, 6), 3) AS conflict_fatalities,
       round(round(score_san_norm, 6), 3) AS sanctions,
       round(round(score_mil_norm, 6), 3) AS militarization,
       round(round(score_news_norm, 6), 3) AS news_tension"""


@register("grs_country_trend", with_fixtures(f"""
SELECT month_start, {_TREND_COLS}
FROM grs_monthly WHERE country_iso3 = '{COUNTRY}' AND grs_0_100 IS NOT NULL""", [], grs=True))
def q_grs_country_trend(spark, sf_dir):
    return dashboard.grs_country_trend(r6(_grs(spark, sf_dir), *_GRS_COLS), COUNTRY)


@register("grs_driver_contributions", with_fixtures(f"""
SELECT month_start, driver, contribution FROM (
  SELECT month_start, {_TREND_COLS} FROM grs_monthly
  WHERE country_iso3 = '{COUNTRY}' AND grs_0_100 IS NOT NULL) t
CROSS JOIN LATERAL (VALUES
  ('conflict_incidents', cast(round(cast(t.conflict_incidents * 0.225 * 100 AS decimal(20, 6)), 2) AS double)),
  ('conflict_fatalities', cast(round(cast(t.conflict_fatalities * 0.225 * 100 AS decimal(20, 6)), 2) AS double)),
  ('sanctions', cast(round(cast(t.sanctions * 0.20 * 100 AS decimal(20, 6)), 2) AS double)),
  ('militarization', cast(round(cast(t.militarization * 0.15 * 100 AS decimal(20, 6)), 2) AS double)),
  ('news_tension', cast(round(cast(t.news_tension * 0.10 * 100 AS decimal(20, 6)), 2) AS double))) v(driver, contribution)""", [], grs=True))
def q_grs_driver_contributions(spark, sf_dir):
    trend = dashboard.grs_country_trend(r6(_grs(spark, sf_dir), *_GRS_COLS), COUNTRY)
    return dashboard.driver_contributions(trend)


@register("grs_band", with_fixtures("""
SELECT country_iso3, month_start, round(grs_0_100, 6) AS grs_0_100,
       CASE WHEN grs_0_100 IS NULL THEN 'No data' WHEN round(grs_0_100, 6) < 15 THEN 'Low'
            WHEN round(grs_0_100, 6) < 30 THEN 'Moderate' WHEN round(grs_0_100, 6) < 50 THEN 'Elevated'
            ELSE 'High' END AS band
FROM latest""", [], grs=True, extra_ctes=_LATEST_SQL))
def q_grs_band(spark, sf_dir):
    return dashboard.latest_band(r6(_grs(spark, sf_dir), *_GRS_COLS))


# ---------------------------------------------------------------------------
# Dashboard: overview / incidents / diplomatic
# ---------------------------------------------------------------------------


@register("kpi_global", with_fixtures(f"""
SELECT cast(sum(event_count) AS bigint) AS total_incidents, cast(sum(fatalities_best) AS bigint) AS total_fatalities,
       count(DISTINCT country_iso3) AS countries_affected,
       cast(sum(CASE WHEN civilian_targeting THEN event_count ELSE 0 END) AS bigint) AS civilian_incidents
FROM fact_incident WHERE event_date BETWEEN DATE '{D0}' AND DATE '{D1}'""", ["fact_incident"]))
def q_kpi_global(spark, sf_dir):
    return dashboard.kpi_global(fixtures.fact_incident(spark, sf_dir), D0, D1)


def _kpi_sql(d0: str, d1: str, tag: str) -> str:
    return f"""(SELECT cast(sum(event_count) AS bigint) AS {tag}total_incidents,
       cast(sum(fatalities_best) AS bigint) AS {tag}total_fatalities,
       count(DISTINCT country_iso3) AS {tag}countries_affected,
       cast(sum(CASE WHEN civilian_targeting THEN event_count ELSE 0 END) AS bigint) AS {tag}civilian_incidents
FROM fact_incident WHERE event_date BETWEEN DATE '{d0}' AND DATE '{d1}')"""


_P0, _P1 = dashboard.prior_window(D0, D1)


@register("kpi_period_delta", with_fixtures(f"""
SELECT c.*, p.*,
  cast(coalesce(c.total_incidents, 0) - coalesce(p.prior_total_incidents, 0) AS bigint) AS delta_total_incidents,
  cast(coalesce(c.total_fatalities, 0) - coalesce(p.prior_total_fatalities, 0) AS bigint) AS delta_total_fatalities,
  cast(coalesce(c.countries_affected, 0) - coalesce(p.prior_countries_affected, 0) AS bigint) AS delta_countries_affected,
  cast(coalesce(c.civilian_incidents, 0) - coalesce(p.prior_civilian_incidents, 0) AS bigint) AS delta_civilian_incidents
FROM {_kpi_sql(D0, D1, '')} c CROSS JOIN {_kpi_sql(_P0, _P1, 'prior_')} p""", ["fact_incident"]))
def q_kpi_period_delta(spark, sf_dir):
    return dashboard.kpi_period_delta(fixtures.fact_incident(spark, sf_dir), D0, D1)


_WEEKLY_SQL = """
SELECT week_start, cast(sum(incident_count) AS bigint) AS incidents, cast(sum(fatalities_total) AS bigint) AS fatalities,
       cast(sum(civilian_incidents) AS bigint) AS civilian_incidents
FROM (
  SELECT cast(date_trunc('week', event_date) AS date) AS week_start, country_iso3, region_code, event_type,
         sum(coalesce(event_count, 1)) AS incident_count, sum(fatalities_best) AS fatalities_total,
         sum(CASE WHEN civilian_targeting THEN coalesce(event_count, 1) ELSE 0 END) AS civilian_incidents
  FROM fact_incident GROUP BY 1, 2, 3, 4) cw
WHERE week_start BETWEEN DATE '{d0}' AND DATE '{d1}' {extra}
GROUP BY week_start"""


@register("weekly_timeline", with_fixtures(_WEEKLY_SQL.format(d0=D0, d1=D1, extra=""), ["fact_incident"]))
def q_weekly_timeline(spark, sf_dir):
    return dashboard.weekly_timeline(fixtures.fact_incident(spark, sf_dir), D0, D1)


@register("weekly_timeline_region", with_fixtures(
    _WEEKLY_SQL.format(d0=D0, d1=D1, extra=f"AND region_code = '{REGION}'"), ["fact_incident"]))
def q_weekly_timeline_region(spark, sf_dir):
    return dashboard.weekly_timeline(fixtures.fact_incident(spark, sf_dir), D0, D1, REGION)


@register("region_breakdown", with_fixtures(f"""
SELECT coalesce(region_code, 'Unknown') AS region, cast(sum(incident_count) AS bigint) AS incidents,
       cast(sum(fatalities_total) AS bigint) AS fatalities
FROM (
  SELECT cast(date_trunc('month', event_date) AS date) AS month_start, country_iso3, region_code,
         sum(coalesce(event_count, 1)) AS incident_count, sum(fatalities_best) AS fatalities_total
  FROM fact_incident GROUP BY 1, 2, 3) cm
WHERE month_start BETWEEN cast(date_trunc('month', DATE '{D0}') AS date) AND cast(date_trunc('month', DATE '{D1}') AS date)
GROUP BY 1""", ["fact_incident"]))
def q_region_breakdown(spark, sf_dir):
    return dashboard.region_breakdown(fixtures.fact_incident(spark, sf_dir), D0, D1)


@register("event_type_breakdown", with_fixtures(f"""
SELECT event_type, cast(sum(event_count) AS bigint) AS incident_count, cast(sum(fatalities_best) AS bigint) AS fatalities
FROM fact_incident WHERE event_date BETWEEN DATE '{D0}' AND DATE '{D1}' AND event_type IS NOT NULL
GROUP BY event_type""", ["fact_incident"]))
def q_event_type_breakdown(spark, sf_dir):
    return dashboard.event_type_breakdown(fixtures.fact_incident(spark, sf_dir), D0, D1)


_TOP_FAT_SQL = f"""
SELECT t.country_iso3, coalesce(name, t.country_iso3) AS country, dead AS total_fatalities, events AS total_incidents
FROM (
  SELECT country_iso3, sum(fatalities_best)::bigint AS dead, sum(event_count)::bigint AS events
  FROM fact_incident WHERE event_date >= '{D0}' AND event_date <= '{D1}' GROUP BY ALL
) t LEFT JOIN dim_country d ON d.iso3 = t.country_iso3
ORDER BY dead DESC NULLS LAST, t.country_iso3 NULLS LAST LIMIT 20"""


@register("top_fatalities", with_fixtures(_TOP_FAT_SQL, ["fact_incident", "dim_country"]))
def q_top_fatalities(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return dashboard.top_fatalities(wh.fact_incident, wh.dim_country, D0, D1)


@register("top_fatalities_nonzero", with_fixtures(
    f"SELECT * FROM ({_TOP_FAT_SQL}) t WHERE total_fatalities > 0 "
    "ORDER BY total_fatalities DESC NULLS LAST, country_iso3 ASC NULLS LAST LIMIT 15",
    ["fact_incident", "dim_country"]))
def q_top_fatalities_nonzero(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return dashboard.top_fatalities_nonzero(wh.fact_incident, wh.dim_country, D0, D1)


_SANCTIONS_SQL = """
SELECT t.iso3 AS target, coalesce(name, t.iso3) AS country_name, total_sanctions, active_sanctions
FROM (
  SELECT target_iso3 AS iso3, count(*) AS total_sanctions, count_if(status = 'active')::bigint AS active_sanctions
  FROM fact_diplomatic_action WHERE target_iso3 IS NOT NULL AND action_type = 'sanction' GROUP BY ALL
) t LEFT JOIN dim_country d ON d.iso3 = t.iso3
ORDER BY total_sanctions DESC, t.iso3 {limit}"""


@register("sanctions_by_country", with_fixtures(_SANCTIONS_SQL.format(limit="LIMIT 20"),
                                                ["fact_diplomatic_action", "dim_country"]))
def q_sanctions_by_country(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return dashboard.sanctions_by_country(wh.fact_diplomatic_action, wh.dim_country)


_CURATED_SQL = ("(SELECT count(*) FROM fact_diplomatic_action WHERE action_type != 'sanction' "
                "AND action_date IS NOT NULL) AS curated_events")


@register("sanction_kpis", with_fixtures(
    f"SELECT {_CURATED_SQL}, count(*) AS sanctioned_countries, cast(sum(total_sanctions) AS bigint) AS sanction_designations "
    f"FROM ({_SANCTIONS_SQL.format(limit='LIMIT 20')}) s", ["fact_diplomatic_action", "dim_country"]))
def q_sanction_kpis(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return dashboard.sanction_kpis(wh.fact_diplomatic_action, wh.dim_country)


@register("sanction_kpis_all", with_fixtures(
    f"SELECT {_CURATED_SQL}, count(*) AS sanctioned_countries, cast(sum(total_sanctions) AS bigint) AS sanction_designations "
    f"FROM ({_SANCTIONS_SQL.format(limit='')}) s", ["fact_diplomatic_action", "dim_country"]))
def q_sanction_kpis_all(spark, sf_dir):
    """A23 over every sanctioned target (not only the top 20)."""
    wh = _wh(spark, sf_dir)
    return dashboard.sanction_kpis(wh.fact_diplomatic_action, wh.dim_country, None)


@register("actions_by_type", with_fixtures("""
SELECT action_type, count(*) AS count FROM fact_diplomatic_action WHERE action_type != 'sanction'
GROUP BY action_type""", ["fact_diplomatic_action"]))
def q_actions_by_type(spark, sf_dir):
    return dashboard.actions_by_type(fixtures.fact_diplomatic_action(spark, sf_dir))


@register("diplomatic_feed", with_fixtures("""
SELECT action_date, coalesce(actor_iso3, '') AS actor, coalesce(target_iso3, '') AS target, action_type,
       instrument_name, status
FROM fact_diplomatic_action WHERE action_type != 'sanction' AND action_date IS NOT NULL
ORDER BY action_date DESC, action_id LIMIT 15""", ["fact_diplomatic_action"]))
def q_diplomatic_feed(spark, sf_dir):
    return dashboard.diplomatic_feed(fixtures.fact_diplomatic_action(spark, sf_dir))


@register("events_timeline", with_fixtures("""
SELECT action_date, coalesce(actor_iso3, '') AS actor_iso3, coalesce(target_iso3, '') AS target_iso3,
       action_type, action_subtype, instrument_name, status, region, notes, source_url
FROM fact_diplomatic_action WHERE action_type != 'sanction' AND action_date IS NOT NULL""",
    ["fact_diplomatic_action"]))
def q_events_timeline(spark, sf_dir):
    return dashboard.events_timeline(fixtures.fact_diplomatic_action(spark, sf_dir))


@register("actor_target_label", with_fixtures(f"""
SELECT action_date, action_type, status, substring(instrument_name, 1, 55) AS display_label,
       concat_ws(' → ', nullif(coalesce(actor_iso3, ''), ''), nullif(coalesce(target_iso3, ''), '')) AS actor_target
FROM fact_diplomatic_action
WHERE action_type != 'sanction' AND action_date IS NOT NULL AND action_date BETWEEN DATE '{D0}' AND DATE '{D1}'""",
    ["fact_diplomatic_action"]))
def q_actor_target_label(spark, sf_dir):
    return dashboard.events_timeline_labelled(fixtures.fact_diplomatic_action(spark, sf_dir), D0, D1)


@register("indicators_country", with_fixtures(f"""
SELECT period_start, indicator_name, round(value, 2) AS value, unit
FROM fact_risk_indicator WHERE country_iso3 = '{COUNTRY}'""", ["fact_risk_indicator"]))
def q_indicators_country(spark, sf_dir):
    return dashboard.indicators_country(fixtures.fact_risk_indicator(spark, sf_dir), COUNTRY)


@register("indicators_pivot", with_fixtures(f"""
SELECT period_start,
       avg(value) FILTER (WHERE indicator_code = 'SP.POP.TOTL') AS "SP.POP.TOTL",
       avg(value) FILTER (WHERE indicator_code = 'NY.GDP.PCAP.CD') AS "NY.GDP.PCAP.CD",
       avg(value) FILTER (WHERE indicator_code = 'MS.MIL.XPND.GD.ZS') AS "MS.MIL.XPND.GD.ZS"
FROM fact_risk_indicator WHERE country_iso3 = '{COUNTRY}' GROUP BY period_start""", ["fact_risk_indicator"]))
def q_indicators_pivot(spark, sf_dir):
    """A21 pivot; the fixture leaves indicator names NULL, so the pivot runs on the code column."""
    from riskfabric import refdata

    return dashboard.indicators_pivot(fixtures.fact_risk_indicator(spark, sf_dir), COUNTRY,
                                      [c for c, _ in refdata.INDICATORS], name_col="indicator_code")


@register("diplomatic_feed_cards", with_fixtures("""
SELECT action_date, status, action_type, substring(instrument_name, 1, 60) AS headline,
       concat_ws(' → ', nullif(actor, ''), nullif(target, '')) AS actors
FROM (
  SELECT action_date, coalesce(actor_iso3, '') AS actor, coalesce(target_iso3, '') AS target, action_type,
         instrument_name, status
  FROM fact_diplomatic_action WHERE action_type != 'sanction' AND action_date IS NOT NULL
  ORDER BY action_date DESC, action_id LIMIT 15) f
ORDER BY action_date DESC, instrument_name LIMIT 10""", ["fact_diplomatic_action"]))
def q_diplomatic_feed_cards(spark, sf_dir):
    """Overview feed cards: newest 10 of the 15-row feed, 60-character headline, actor → target label."""
    return dashboard.feed_cards(fixtures.fact_diplomatic_action(spark, sf_dir))
