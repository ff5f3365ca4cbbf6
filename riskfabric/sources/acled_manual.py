"""Hand-maintained weekly backfill CSV → ``fact_incident``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskfabric.session import materialize
from riskfabric import refdata, schemas
from riskfabric.functions import dates, ids, text
from riskfabric.sources.common import arrival_of, key_text_of, read_csv_strings, require_columns

SOURCE = "ACLED_MANUAL"
#: Columns that the file may lack; a load then keeps what is stored.
OPTIONAL = [("region_code", "region_code"), ("sub_event_type", "sub_event_type"), ("notes", "notes"), ("source_url", "source_urls")]


def read(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv_strings(spark, path)
    return df.toDF(*[c.strip() for c in df.columns])


def _rules(raw: DataFrame) -> list:
    """Counts of rows that break a rule, by name."""
    week = F.try_to_date(F.col("week_start"), "yyyy-MM-dd")
    iso, et = text.text_or_empty("country_iso3"), text.text_or_empty("event_type")
    ec, fb = F.col("event_count").try_cast("double"), F.col("fatalities_best").try_cast("double")
    lo, hi = dates.as_date(refdata.MANUAL_WEEK_FIRST), dates.as_date(refdata.MANUAL_WEEK_LAST)
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(week.isNull()).alias("bad_week"),
        F.count_if(week.isNotNull() & ((week < lo) | (week > hi))).alias("out_of_range"),
        F.count_if((iso == "") | (et == "")).alias("blank"),
        F.count_if(ec.isNull() | fb.isNull()).alias("non_numeric"),
        F.count_if((ec < 0) | (fb < 0)).alias("negative"),
    ]


def verify(counts: dict) -> None:
    """Raise for the first rule that rows break, given the counts of a pass."""
    if counts["bad_week"]:
        raise ValueError("manual backfill contains invalid week_start values")
    if counts["out_of_range"]:
        raise ValueError(f"manual backfill week_start must stay within "
                         f"{refdata.MANUAL_WEEK_FIRST}..{refdata.MANUAL_WEEK_LAST}")
    if counts["blank"]:
        raise ValueError("manual backfill requires non-empty country_iso3 and event_type")
    if counts["non_numeric"]:
        raise ValueError("manual backfill event_count and fatalities_best must be numeric")
    if counts["negative"]:
        raise ValueError("manual backfill event_count and fatalities_best must be >= 0")


def validate(raw: DataFrame) -> None:
    """Fail-fast rules in one aggregate job, plus a grouped duplicate check; raises ValueError.

    A load counts the same rules while it stages the rows instead (``normalise`` with ``seen``) and reads the file once.
    """
    require_columns(raw, refdata.MANUAL_REQUIRED, "manual backfill file")
    verify(raw.agg(*_rules(raw)).first().asDict())
    dupes = duplicate_keys(raw)
    n = dupes.count()
    if n:
        table = materialize(dupes, "duplicate-manual-keys").orderBy("k")
        shown = [r["k"] for r in table.take(SHOWN_KEYS)]
        raise ValueError(f"Duplicate manual backfill keys: {n}, listed in {table.inputFiles()[0].rsplit('/', 1)[0]}, the first being {shown}")


#: Keys that the error's message shows; the table it names has all.
SHOWN_KEYS = 20


def duplicate_keys(raw: DataFrame) -> DataFrame:
    """Every key that occurs more than once (k, count)."""
    return raw.select(_key(raw).alias("k")).groupBy("k").count().where("count > 1")


def _key(raw: DataFrame):
    week = F.try_to_date(F.col("week_start"), "yyyy-MM-dd")
    return F.concat_ws("|", F.date_format(week, "yyyy-MM-dd"), F.upper(text.text_or_empty("country_iso3")),
                       text.text_or_empty("event_type"))


def normalise(raw: DataFrame, check: bool = True, seen: Observation | None = None) -> DataFrame:
    """Canonical rows; the rules are checked first, or counted by ``seen`` on the pass that reads the rows."""
    if seen is not None:
        require_columns(raw, refdata.MANUAL_REQUIRED, "manual backfill file")
        raw = raw.observe(seen, *_rules(raw))
    elif check:
        validate(raw)
    ec = F.bround(F.col("event_count").try_cast("double")).try_cast("int")
    fb = F.bround(F.col("fatalities_best").try_cast("double")).try_cast("int")
    key = _key(raw)
    out = raw.select(
        F.lit(SOURCE).alias("source_system"),
        key.alias("source_event_id"),
        ids.make_id(F.lit(SOURCE), key).alias("incident_id"),
        F.try_to_date(F.col("week_start"), "yyyy-MM-dd").alias("event_date"),
        F.upper(text.text_or_empty("country_iso3")).alias("country_iso3"),
        text.text_or_empty("event_type").alias("event_type"),
        *[text.blank_to_null(F.col(c)).alias(name) for c, name in OPTIONAL if c in raw.columns],
        F.lit(None).cast("boolean").alias("civilian_targeting"),
        ec.alias("event_count"),
        fb.alias("fatalities_best"), fb.alias("fatalities_low"), fb.alias("fatalities_high"),
        *arrival_of(raw), *key_text_of(raw, F.lit(SOURCE), key),
    )
    return schemas.present(out, "fact_incident")
