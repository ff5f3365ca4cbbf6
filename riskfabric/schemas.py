"""Canonical star schema: explicit StructTypes, primary keys, and ``conform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, TS, DBL, INT, LNG, BOOL = (
    T.StringType(),
    T.DateType(),
    T.TimestampType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DIM_REGION = _struct(("region_code", S), ("region_name", S))
DIM_COUNTRY = _struct(("iso3", S), ("iso2", S), ("name", S), ("region_code", S))
DIM_DATE = _struct(
    ("date_key", D), ("year", INT), ("month", INT), ("quarter", INT),
    ("week_iso", INT), ("day_of_week", INT), ("is_weekend", BOOL),
)
DIM_EVENT_TYPE = _struct(("event_type_code", S), ("label", S), ("source_system", S), ("parent_type", S))
DIM_SOURCE_SYSTEM = _struct(
    ("source_system_code", S), ("display_name", S), ("url", S), ("access_method", S),
    ("coverage_start", D), ("coverage_end", D), ("notes", S),
)
# last_run_utc is a zone-less UTC wall-clock time (rendering does not depend on the session zone)
PIPELINE_STATE = _struct(
    ("source_name", S), ("last_run_utc", T.TimestampNTZType()), ("last_event_date_ingested", D),
    ("records_processed", LNG), ("status", S),
)

FACT_INCIDENT = _struct(
    ("incident_id", S), ("source_system", S), ("source_event_id", S),
    ("event_date", D), ("event_date_end", D), ("country_iso3", S), ("region_code", S),
    ("admin1", S), ("admin2", S), ("location_name", S), ("latitude", DBL), ("longitude", DBL),
    ("geo_precision", INT), ("event_type", S), ("sub_event_type", S), ("disorder_type", S),
    ("actor1_name", S), ("actor2_name", S), ("interaction_code", S), ("civilian_targeting", BOOL),
    ("event_count", INT), ("fatalities_best", INT), ("fatalities_low", INT), ("fatalities_high", INT),
    ("notes", S), ("source_urls", S), ("ingested_at_utc", TS),
)
FACT_DIPLOMATIC_ACTION = _struct(
    ("action_id", S), ("action_date", D), ("actor_iso3", S), ("target_iso3", S),
    ("action_type", S), ("action_subtype", S), ("instrument_name", S), ("legal_basis", S),
    ("status", S), ("confidence_flag", S), ("source_url", S), ("region", S), ("notes", S),
    ("ingested_at_utc", TS),
)
FACT_RISK_INDICATOR = _struct(
    ("country_iso3", S), ("period_start", D), ("indicator_code", S), ("indicator_name", S),
    ("value", DBL), ("unit", S), ("source_system", S), ("source_url", S), ("ingested_at_utc", TS),
)
FACT_NEWS_PULSE = _struct(
    ("item_id", S), ("published_at_utc", TS), ("country_focus_iso3", S), ("region_code", S),
    ("title", S), ("source_domain", S), ("url", S), ("topic_tags", S),
    ("attention_count", INT), ("tone", DBL), ("ingested_at_utc", TS),
)

TABLES: dict[str, T.StructType] = {
    "dim_region": DIM_REGION,
    "dim_country": DIM_COUNTRY,
    "dim_date": DIM_DATE,
    "dim_event_type": DIM_EVENT_TYPE,
    "dim_source_system": DIM_SOURCE_SYSTEM,
    "_pipeline_state": PIPELINE_STATE,
    "fact_incident": FACT_INCIDENT,
    "fact_diplomatic_action": FACT_DIPLOMATIC_ACTION,
    "fact_risk_indicator": FACT_RISK_INDICATOR,
    "fact_news_pulse": FACT_NEWS_PULSE,
}

# Primary keys; Spark has no PK constraint, so writers take these explicitly.
PRIMARY_KEYS: dict[str, list[str]] = {
    "fact_incident": ["incident_id"],
    "fact_diplomatic_action": ["action_id"],
    "fact_news_pulse": ["item_id"],
    "fact_risk_indicator": ["country_iso3", "period_start", "indicator_code"],
    "dim_country": ["iso3"],
    "dim_region": ["region_code"],
    "dim_event_type": ["event_type_code"],
    "dim_source_system": ["source_system_code"],
    "dim_date": ["date_key"],
    "_pipeline_state": ["source_name"],
}

# Column defaults applied to *new* rows when a batch lacks the column.
COLUMN_DEFAULTS: dict[str, dict[str, object]] = {
    "fact_incident": {"event_count": 1},
    "fact_diplomatic_action": {"confidence_flag": "HIGH"},
    "fact_news_pulse": {"attention_count": 1},
}

# Tables whose ingest stamp is filled with the load time when absent.
STAMPED = {"fact_incident", "fact_diplomatic_action", "fact_risk_indicator", "fact_news_pulse"}


def conform(df: DataFrame, table: str, fill_defaults: bool = True) -> DataFrame:
    """Select the table's columns by name, casting each to its declared type.

    Columns missing from ``df`` become the table default (when ``fill_defaults``)
    or a typed NULL; extra columns are dropped. Casts use ``try_cast`` semantics
    so bad values become NULL instead of failing the job under ANSI mode.
    """
    schema = TABLES[table]
    defaults = COLUMN_DEFAULTS.get(table, {}) if fill_defaults else {}
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        if field.name in have:
            src = F.col(field.name)
            if have[field.name] != field.dataType:
                src = src.try_cast(field.dataType)
            cols.append(src.alias(field.name))
        elif field.name in defaults:
            cols.append(F.lit(defaults[field.name]).cast(field.dataType).alias(field.name))
        elif fill_defaults and field.name == "ingested_at_utc" and table in STAMPED:
            cols.append(F.current_timestamp().alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


#: A reader's total order of its rows: (file, block start, place in the split), compared field by field.
ARRIVAL = "_arrival"


#: The text that a reader's row has its id of (``ids.make_id``).
KEY_TEXT = "_key_text"


def present(df: DataFrame, table: str) -> DataFrame:
    """The table's columns that ``df`` has, typed and in the table's order, and its arrival order and key text if it has them.

    Unlike ``conform`` nothing is filled, so that an upsert keeps the stored values of the columns
    that a source doesn't deliver.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [
        (F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in TABLES[table].fields if f.name in have
    ]
    return df.select(*cols, *[c for c in (ARRIVAL, KEY_TEXT) if c in have])


def empty(spark, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])
