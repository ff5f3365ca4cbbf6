"""Properties of the composite score on the driver's smallest tables."""

from pyspark.sql import functions as F

from riskfabric import refdata
from riskfabric.plans import grs
from riskfabric.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_bounds_hit_zero_and_one_and_score_range(spark):
    g = grs.grs_from(fixtures.warehouse(spark, SF))
    cols = ["score_inc_norm", "score_fat_norm", "score_san_norm", "score_news_norm"]
    r = g.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols],
              F.min("grs_0_100").alias("lo"), F.max("grs_0_100").alias("hi"),
              F.count_if(F.col("grs_0_100").isNull()).alias("nulls")).first()
    for c in cols:
        assert abs(r[f"hi_{c}"] - 1.0) < 1e-12
        assert r[f"lo_{c}"] <= 1e-12   # missing rates map to 0 - min, so the minimum may dip below 0
    assert r["nulls"] == 0 and r["lo"] >= -1.0 and r["hi"] <= 100.0 + 1e-9


def test_score_is_sum_of_weighted_parts(spark):
    wh = fixtures.warehouse(spark, SF)
    g = grs.grs_from(wh)
    comb = grs.combined(wh.fact_incident, wh.fact_diplomatic_action, wh.fact_risk_indicator, wh.fact_news_pulse)
    c = comb.select(F.col("country_iso3").alias("c"), F.col("month_start").alias("m"), "avg_tone")
    j = g.join(c, g.country_iso3.eqNullSafe(c.c) & (g.month_start == c.m))
    w = refdata.GRS_WEIGHTS
    tone = F.when(F.col("avg_tone").isNull(), 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (10 - F.col("avg_tone")) / 20)))
    parts = 100 * (w["conflict"] * (0.5 * F.col("score_inc_norm") + 0.5 * F.col("score_fat_norm"))
                   + w["sanctions"] * F.col("score_san_norm") + w["militarization"] * F.coalesce("score_mil_norm", F.lit(0.0))
                   + w["news_volume"] * F.col("score_news_norm") + w["news_tone"] * tone)
    bad = j.where(F.abs(F.col("grs_0_100") - parts) > 1e-9).count()
    assert bad == 0 and j.count() == g.count()


def test_custom_weights(spark):
    wh = fixtures.warehouse(spark, SF)
    zero = {k: 0.0 for k in refdata.GRS_WEIGHTS}
    only_san = grs.grs_from(wh, weights={**zero, "sanctions": 1.0})
    r = only_san.agg(F.max(F.abs(F.col("grs_0_100") - 100 * F.col("score_san_norm")))).first()[0]
    assert r < 1e-9
