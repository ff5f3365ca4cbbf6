"""Scoring expressions: rates, min-max normalisation, tone inversion, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskfabric import refdata


def per_100k(count: Column, population: Column) -> Column:
    """count * 1e5 / population, NULL when population is NULL or 0."""
    return count * F.lit(1e5) / F.nullif(population, F.lit(0.0))


def minmax(value: Column, lo: Column, hi: Column) -> Column:
    """(value - lo) / (hi - lo), or 0 when the range is degenerate (or unknown)."""
    return F.when(hi > lo, (value - lo) / (hi - lo)).otherwise(F.lit(0.0))


def tone_tension(avg_tone: Column) -> Column:
    """Inverted tone clamped to [0, 1]; 0.5 when no tone is known."""
    inv = (-avg_tone + F.lit(10.0)) / F.lit(20.0)
    return F.when(avg_tone.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), inv))).otherwise(F.lit(0.5))


def composite(inc: Column, fat: Column, san: Column, mil: Column, news: Column, tone: Column,
              weights: dict[str, float] | None = None) -> Column:
    """0–100 composite over the normalised sub-scores (milex NULL counts as 0)."""
    w = {**refdata.GRS_WEIGHTS, **(weights or {})}
    return F.lit(100.0) * (
        F.lit(w["conflict"]) * (F.lit(0.5) * inc + F.lit(0.5) * fat)
        + F.lit(w["sanctions"]) * san
        + F.lit(w["militarization"]) * F.coalesce(mil, F.lit(0.0))
        + F.lit(w["news_volume"]) * news
        + F.lit(w["news_tone"]) * tone
    )


def band(score: Column) -> Column:
    """Risk band label for a 0–100 score."""
    expr = F.when(score.isNull(), F.lit(refdata.GRS_NO_DATA))
    for bound, label in refdata.GRS_BANDS:
        expr = expr.when(score < bound, F.lit(label))
    return expr.otherwise(F.lit(refdata.GRS_TOP_BAND))


def direction(delta: Column) -> Column:
    """Mover direction from the sign of a change."""
    return F.when(delta > 0, "up").when(delta < 0, "down").when(delta == 0, "flat")
