"""Sanctions list (headerless latin-1 CSV) → ``fact_diplomatic_action``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfabric import refdata, schemas
from riskfabric.functions import ids, text
from riskfabric.schemas import ARRIVAL
from riskfabric.operators import lookup
from riskfabric.sources.common import arrival_of, with_arrival

SOURCE = "OFAC_SDN"
RAW = T.StructType([T.StructField(c, T.StringType()) for c in refdata.SDN_COLUMNS])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Positional 12-column CSV. Over-long lines are skipped; short lines are NULL-padded.

    Spark reads an empty token like a missing one, so whether a line has a 13th token is asked
    of the line itself: its commas outside quotes are counted.
    """
    lines = with_arrival(spark.read.option("encoding", "ISO-8859-1").text(path)).where(F.trim("value") != "")
    plain = F.regexp_replace("value", '"[^"]*"', "")
    lines = lines.where(F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) < len(refdata.SDN_COLUMNS))
    parsed = F.from_csv("value", F.lit(RAW.simpleString()[len("struct<"):-1].replace(":", " ")), {"escape": '"'})
    df = lines.select(parsed.alias("r"), ARRIVAL)
    return df.select(*[F.nullif(F.col(f"r.{c}"), F.lit("")).alias(c) for c in refdata.SDN_COLUMNS], ARRIVAL)


def explode_programs(raw: DataFrame) -> DataFrame:
    """One row per (entity, program) with placeholders removed."""
    clean = raw.select(*[text.null_token(c, refdata.SDN_NULL_TOKEN).alias(c) for c in refdata.SDN_COLUMNS], *arrival_of(raw))
    progs = F.split(F.coalesce(F.col("program"), F.lit("")), ";")
    return clean.select("*", F.explode(progs).alias("_prog")).withColumn("_prog", F.trim("_prog"))


def normalise(raw: DataFrame, run_date: _dt.date | str) -> DataFrame:
    """Canonical sanction actions dated at the run date (the list carries no designation date)."""
    rd = run_date if isinstance(run_date, _dt.date) else _dt.date.fromisoformat(run_date)
    e = explode_programs(raw).withColumn("target_iso3", lookup.prefix_value(F.col("_prog"), refdata.SANCTION_PROGRAMS))
    instrument = F.format_string("SDN: %s (%s)", F.coalesce("sdn_name", F.lit("None")), F.col("_prog"))
    out = e.select(
        ids.make_id(F.lit(SOURCE), F.coalesce("ent_num", F.lit("None")), F.col("_prog")).alias("action_id"),
        F.lit(rd).alias("action_date"),
        F.lit("USA").alias("actor_iso3"),
        "target_iso3",
        F.lit("sanction").alias("action_type"),
        F.lit(SOURCE).alias("action_subtype"),
        F.substring(instrument, 1, refdata.INSTRUMENT_MAX).alias("instrument_name"),
        F.col("_prog").alias("legal_basis"),
        F.lit("active").alias("status"),
        F.lit("LOW").alias("confidence_flag"),
        F.lit(refdata.SDN_SOURCE_URL).alias("source_url"),
        F.col("remarks").alias("notes"),
        *arrival_of(raw),
    )
    return schemas.present(out, "fact_diplomatic_action")
