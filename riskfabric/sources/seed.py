"""Curated diplomatic events CSV → ``fact_diplomatic_action``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric import schemas
from riskfabric.functions import ids
from riskfabric.sources.common import arrival_of, col_or_null, key_text_of, read_csv_strings

COLUMNS = ["actor_iso3", "target_iso3", "action_type", "action_subtype", "instrument_name", "legal_basis",
           "status", "source_url", "region", "notes"]


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_strings(spark, path)


def _rendered(c):
    """Text as a dataframe library renders a missing cell: NULL -> 'nan'."""
    return F.coalesce(c, F.lit("nan"))


def normalise(raw: DataFrame) -> DataFrame:
    """Ids re-derived from (actor, target, date, type, instrument); confidence HIGH; 13 columns.

    The id hashes the parsed date rendered as ``yyyy-MM-dd HH:mm:ss`` (an
    unparseable date keeps its text) and missing cells rendered as ``nan``.
    """
    parsed = F.try_to_timestamp(F.trim(col_or_null(raw, "action_date")))
    date_txt = F.coalesce(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"), _rendered(col_or_null(raw, "action_date")))
    cols = {c: col_or_null(raw, c) for c in COLUMNS}
    key = [_rendered(cols["actor_iso3"]), _rendered(cols["target_iso3"]), date_txt, _rendered(cols["action_type"]), _rendered(cols["instrument_name"])]
    out = raw.select(
        ids.make_id(*key).alias("action_id"),
        parsed.cast("date").alias("action_date"),
        *[v.alias(k) for k, v in cols.items() if k in raw.columns],
        F.lit("HIGH").alias("confidence_flag"),
        *arrival_of(raw), *key_text_of(raw, *key),
    )
    return schemas.present(out, "fact_diplomatic_action")
