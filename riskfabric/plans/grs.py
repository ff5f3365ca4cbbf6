"""Monthly composite geopolitical risk score (G1, G1a, G2) and its parts.

Plan shape (all lazily composed, one Catalyst plan):

    fact_incident ──agg(country, month)──┐
                                         ├─ as-of population ─┐
    fact_risk_indicator (pop, milex) ────┘                    │
    fact_diplomatic_action ─filter─agg(country, month)─ left ─┤
    fact_news_pulse ─filter─agg(country, month)──────── left ─┤
                                                      combined (country × month, small)
                                                         ├─ global min/max (scalar subquery)
                                                         └─ scores (bounds inlined as a value)

Every input is aggregated to (country, month) before any join, so the joins
run on data whose size is bounded by #countries × #months, not by the fact
tables. ``combined`` feeds both the bounds and the final projection, so it is
written once as a parquet table in the shared checkpoint folder
(``session.materialize``) and both consumers read that copy. The bounds are a global aggregate (partial per task,
one tiny final merge) used as a scalar subquery — never an unpartitioned window
and never a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfabric import refdata
from riskfabric.functions import dates, scoring
from riskfabric.operators.asof import asof_left
from riskfabric.session import materialize as write_and_read

KEYS = ["country_iso3", "month_start"]


def indicator_series(fact_risk_indicator: DataFrame, code: str, value_name: str) -> DataFrame:
    return fact_risk_indicator.where(F.col("indicator_code") == code).select(
        "country_iso3", "period_start", F.col("value").alias(value_name)
    )


def incidents_monthly(fact_incident: DataFrame) -> DataFrame:
    """(country, month): SUM(COALESCE(event_count,1)) and SUM(fatalities_best) (A5)."""
    return fact_incident.groupBy("country_iso3", dates.month_start("event_date").alias("month_start")).agg(
        F.sum(F.coalesce("event_count", F.lit(1))).cast("long").alias("incident_count"),
        F.sum("fatalities_best").cast("long").alias("fatalities"),
    )


def sanctions_monthly(fact_diplomatic_action: DataFrame) -> DataFrame:
    """(coalesce(target, actor), month): count of dated sanctions."""
    return (
        fact_diplomatic_action.where((F.col("action_type") == "sanction") & F.col("action_date").isNotNull())
        .groupBy(
            F.coalesce("target_iso3", "actor_iso3").alias("country_iso3"),
            dates.month_start("action_date").alias("month_start"),
        )
        .agg(F.count(F.lit(1)).alias("sanction_count"))
    )


def news_monthly(fact_news_pulse: DataFrame) -> DataFrame:
    """(country, month): article count and mean tone, rows with a country only."""
    return (
        fact_news_pulse.where(F.col("country_focus_iso3").isNotNull())
        .groupBy(
            F.col("country_focus_iso3").alias("country_iso3"),
            dates.month_start("published_at_utc").alias("month_start"),
        )
        .agg(F.count(F.lit(1)).alias("article_count"), F.avg("tone").alias("avg_tone"))
    )


def conflict_base(fact_incident: DataFrame, fact_risk_indicator: DataFrame, **asof_opts) -> DataFrame:
    """Monthly incidents with the as-of population (latest year ≤ the month's year) and per-100k rates."""
    im = incidents_monthly(fact_incident)
    pop = indicator_series(fact_risk_indicator, refdata.POPULATION_CODE, "population")
    cb = asof_left(im, pop, "country_iso3", dates.year_start("month_start"), "period_start",
                   ["population"], **asof_opts)
    return cb.select(
        "country_iso3", "month_start", "incident_count", "fatalities", "population",
        scoring.per_100k(F.col("incident_count"), F.col("population")).alias("incident_rate_100k"),
        scoring.per_100k(F.col("fatalities"), F.col("population")).alias("fatality_rate_100k"),
    )


def combined(
    fact_incident: DataFrame,
    fact_diplomatic_action: DataFrame,
    fact_risk_indicator: DataFrame,
    fact_news_pulse: DataFrame,
    **asof_opts,
) -> DataFrame:
    """Drivers per scored (country, month); only months with incidents are scored."""
    cb = conflict_base(fact_incident, fact_risk_indicator, **asof_opts)
    sm = sanctions_monthly(fact_diplomatic_action)
    nm = news_monthly(fact_news_pulse)
    milex = indicator_series(fact_risk_indicator, refdata.MILITARY_CODE, "milex_pct_gdp")
    c = cb.join(sm, KEYS, "left")
    c = asof_left(c, milex, "country_iso3", dates.year_start("month_start"), "period_start",
                  ["milex_pct_gdp"], **asof_opts)
    c = c.join(nm, KEYS, "left")
    return c.select(
        "country_iso3", "month_start", "incident_rate_100k", "fatality_rate_100k",
        F.coalesce("sanction_count", F.lit(0)).cast("long").alias("sanction_count"),
        "milex_pct_gdp",
        F.coalesce("article_count", F.lit(0)).cast("long").alias("article_count"),
        "avg_tone",
    )


_DRIVERS = [
    ("inc", "incident_rate_100k"),
    ("fat", "fatality_rate_100k"),
    ("san", "sanction_count"),
    ("mil", "milex_pct_gdp"),
    ("art", "article_count"),
]


def norm_bounds(comb: DataFrame) -> DataFrame:
    """One row: global MIN/MAX of the five drivers."""
    aggs = []
    for short, col in _DRIVERS:
        aggs += [F.max(col).alias(f"max_{short}"), F.min(col).alias(f"min_{short}")]
    return comb.agg(*aggs)


def grs_monthly(
    fact_incident: DataFrame,
    fact_diplomatic_action: DataFrame,
    fact_risk_indicator: DataFrame,
    fact_news_pulse: DataFrame,
    weights: dict[str, float] | None = None,
    materialize: bool = True,
    **asof_opts,
) -> DataFrame:
    """country_iso3, month_start, five normalised sub-scores, grs_0_100, coverage_flag."""
    comb = combined(fact_incident, fact_diplomatic_action, fact_risk_indicator, fact_news_pulse, **asof_opts)
    if materialize:
        # Two consumers (bounds, scores) read ``combined``; Catalyst would plan the
        # fact aggregations twice. Write it once as a table in the shared checkpoint
        # folder: it is bounded by #countries × #months at any data size, and the
        # written copy also cuts the lineage back to the fact scans.
        comb = write_and_read(comb, "grs_combined")
    # Global bounds as ONE scalar subquery (a struct of the ten min/max values):
    # Spark runs it once and inlines the value, so no cross join and no driver
    # round trip is needed.
    bounds = norm_bounds(comb)
    # project the subquery once; every score reads fields of that one column
    c = comb.withColumn("_bounds", bounds.select(F.struct(*bounds.columns).alias("b")).scalar())

    def bnd(s: str):
        return F.col(f"_bounds.min_{s}"), F.col(f"_bounds.max_{s}")

    inc = scoring.minmax(F.coalesce("incident_rate_100k", F.lit(0.0)), *bnd("inc"))
    fat = scoring.minmax(F.coalesce("fatality_rate_100k", F.lit(0.0)), *bnd("fat"))
    san = scoring.minmax(F.col("sanction_count"), *bnd("san"))
    # NULL milex keeps a NULL sub-score; the composite counts it as 0.
    mil = scoring.minmax(F.col("milex_pct_gdp"), *bnd("mil"))
    art = scoring.minmax(F.col("article_count"), *bnd("art"))
    scored = c.select(
        "country_iso3", "month_start",
        inc.alias("score_inc_norm"), fat.alias("score_fat_norm"), san.alias("score_san_norm"),
        mil.alias("score_mil_norm"), art.alias("score_news_norm"),
        scoring.tone_tension(F.col("avg_tone")).alias("_tone"),
        F.col("incident_rate_100k"), F.col("article_count"), F.col("milex_pct_gdp"),
    )
    return scored.select(
        "country_iso3", "month_start", "score_inc_norm", "score_fat_norm", "score_san_norm",
        "score_mil_norm", "score_news_norm",
        scoring.composite(F.col("score_inc_norm"), F.col("score_fat_norm"), F.col("score_san_norm"),
                          F.col("score_mil_norm"), F.col("score_news_norm"), F.col("_tone"),
                          weights).alias("grs_0_100"),
        F.when(F.col("incident_rate_100k").isNull() & (F.col("article_count") == 0), "NONE")
        .when(F.col("milex_pct_gdp").isNull(), "PARTIAL")
        .otherwise("FULL").alias("coverage_flag"),
    )


def grs_from(wh, **kw) -> DataFrame:
    """``grs_monthly`` over a ``Warehouse``."""
    return grs_monthly(wh.fact_incident, wh.fact_diplomatic_action, wh.fact_risk_indicator,
                       wh.fact_news_pulse, **kw)
