"""Registered queries for data-quality checks, table maintenance, dimension
building and the source normalisers.

Normaliser queries feed the library's ``normalise`` functions with raw-shaped
rows derived from the driver's tables (every row of the underlying table, as
strings, exactly as a landing file would carry them). The stand-in builders
only shape rows; all parsing, id derivation, lookups, filtering and
deduplication run in ``riskfabric.sources`` / ``riskfabric.operators``.
"""

from __future__ import annotations

import datetime as _dt
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric import refdata
from riskfabric.catalog import COVERAGE_CUTOFF, D0, D1, MOVES_SQL, register, r6
from riskfabric.functions import dates, ids
from riskfabric.operators import lookup, store
from riskfabric.oracle import with_fixtures
from riskfabric.plans import dashboard, quality
from riskfabric.sources import acled, dims, fixtures, gdelt, ofac, seed, ucdp, world_bank
from riskfabric.sources.common import overrides_df

RUN_DATE = "2026-03-03"
RUN_TS = _dt.datetime(2026, 3, 3, 12, 30, 0)


def _values_sql(rows: list[tuple], cols: list[str]) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


OVERRIDES_SQL = _values_sql(refdata.NAME_OVERRIDES, ["name", "iso3"])
FIPS_SQL = _values_sql(refdata.FIPS_EXTRA, ["code", "iso3"])
PROGRAMS_SQL = _values_sql([(k, v, i) for i, (k, v) in enumerate(refdata.SANCTION_PROGRAMS)], ["key", "iso3", "ord"])

# SQL: distinct-name → iso3 through overrides then exact alpha-3 / alpha-2 / name (lower-case).
NAME_LOOKUP_CTE = f"""
name_probe AS (
  SELECT probe, min(struct_pack(r := rank, i := iso3)).i AS iso3 FROM (
    SELECT lower(trim(iso3)) AS probe, iso3, 0 AS rank FROM dim_country
    UNION ALL SELECT lower(trim(iso2)), iso3, 1 FROM dim_country
    UNION ALL SELECT lower(trim(name)), iso3, 2 FROM dim_country) p
  WHERE probe IS NOT NULL AND probe <> '' GROUP BY probe
),
overrides AS (SELECT * FROM {OVERRIDES_SQL})"""


def _name_iso3_sql(expr: str) -> str:
    """Scalar SQL for the override → exact lookup cascade of a raw name expression."""
    return (f"coalesce((SELECT o.iso3 FROM overrides o WHERE o.name = lower(trim({expr}))), "
            f"(SELECT np.iso3 FROM name_probe np WHERE np.probe = lower(trim({expr}))))")


def _make_id_sql(*parts: str) -> str:
    return ("regexp_replace(substring(sha256(concat_ws('|', " + ", ".join(parts) + ")), 1, 32), "
            "'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5')")


def _wh(spark, sf_dir):
    return fixtures.warehouse(spark, sf_dir)


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------


_TWICE = "(SELECT count_if(n > 1)::bigint FROM (SELECT count(*) AS n FROM {t} GROUP BY {k}))"


@register("qa_checks", with_fixtures(f"""
SELECT unnest(['fact_incident duplicate PKs', 'fact_diplomatic_action duplicate PKs', 'fact_risk_indicator unmapped countries', 'fact_news_pulse missing country']) AS check_name,
       unnest([{_TWICE.format(t='fact_incident', k='incident_id')}, {_TWICE.format(t='fact_diplomatic_action', k='action_id')},
               (SELECT count(DISTINCT i.country_iso3)::bigint FROM fact_risk_indicator i ANTI JOIN dim_country d ON d.iso3 = i.country_iso3),
               (SELECT (count(*) - count(country_focus_iso3))::bigint FROM fact_news_pulse)]) AS violations
UNION ALL
SELECT unnest(['fact_incident invalid lat/lon', 'fact_incident negative fatalities', 'fact_incident invalid event_count']),
       unnest([count_if(abs(coalesce(latitude, 0)) > 90 OR abs(coalesce(longitude, 0)) > 180)::bigint,
               count_if(least(fatalities_best, fatalities_low, fatalities_high) < 0)::bigint,
               count_if(coalesce(event_count, -1) < 0)::bigint])
FROM fact_incident""",
    ["fact_incident", "fact_diplomatic_action", "fact_risk_indicator", "fact_news_pulse", "dim_country"]))
def q_qa_checks(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.qa_checks(wh.fact_incident, wh.fact_diplomatic_action, wh.fact_risk_indicator,
                             wh.fact_news_pulse, wh.dim_country)


@register("qa_coverage", with_fixtures(f"""
SELECT 'post-{COVERAGE_CUTOFF[:4]} incident coverage (ACLED only)' AS check_name,
       count(*) AS total_rows, cast(sum(coalesce(event_count, 1)) AS bigint) AS total_incidents,
       count(*) FILTER (WHERE source_system = 'ACLED') AS acled_rows,
       cast(sum(coalesce(event_count, 1)) FILTER (WHERE source_system = 'ACLED') AS bigint) AS acled_incidents
FROM fact_incident WHERE event_date > DATE '{COVERAGE_CUTOFF}'""", ["fact_incident"]))
def q_qa_coverage(spark, sf_dir):
    return quality.coverage_after(fixtures.fact_incident(spark, sf_dir), COVERAGE_CUTOFF)


@register("unmapped_countries", with_fixtures("""
SELECT cast(count(DISTINCT country_iso3) AS bigint) AS violations FROM fact_risk_indicator
WHERE country_iso3 NOT IN (SELECT iso3 FROM dim_country)""", ["fact_risk_indicator", "dim_country"]))
def q_unmapped_countries(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.unmapped_countries(wh.fact_risk_indicator, wh.dim_country).select(
        F.col("violations").cast("long").alias("violations"))


@register("duplicate_keys", with_fixtures("""
SELECT incident_id, count(*) AS n FROM (
  SELECT incident_id FROM fact_incident
  UNION ALL SELECT incident_id FROM fact_incident WHERE source_system = 'ACLED') d
GROUP BY incident_id HAVING count(*) > 1""", ["fact_incident"]))
def q_duplicate_keys(spark, sf_dir):
    """Duplicate primary keys after one source's batch was appended twice."""
    fi = fixtures.fact_incident(spark, sf_dir)
    redelivered = fi.unionByName(fi.where(F.col("source_system") == "ACLED"))
    return store.duplicate_keys(redelivered.select("incident_id"), ["incident_id"])


@register("make_id", with_fixtures("SELECT source_event_id, source_system, incident_id FROM fact_incident",
                                   ["fact_incident"]))
def q_make_id(spark, sf_dir):
    """E1 over every incident: SHA-256 of 'source|source_event_id' in UUID layout."""
    fi = fixtures.fact_incident(spark, sf_dir)
    return fi.select("source_event_id", "source_system", ids.make_id("source_system", "source_event_id").alias("incident_id"))


_ID_TEXT_SPARK = """CASE l_linenumber WHEN 1 THEN concat(cast(l_orderkey AS string), '.0')
  WHEN 2 THEN cast(l_orderkey AS string) WHEN 3 THEN concat(' X', cast(l_orderkey AS string), ' ')
  WHEN 4 THEN NULL WHEN 5 THEN concat(cast(l_orderkey AS string), '.5')
  ELSE concat(' ', cast(l_partkey AS string), '.000') END"""
_ID_TEXT_SQL = _ID_TEXT_SPARK.replace("AS string", "AS varchar")


@register("normalise_id", f"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN try_cast(trim(coalesce(t, '')) AS double) IS NOT NULL AND try_cast(trim(coalesce(t, '')) AS double) % 1 = 0
       THEN cast(cast(try_cast(trim(coalesce(t, '')) AS double) AS bigint) AS varchar)
       ELSE trim(coalesce(t, '')) END AS source_id
FROM (SELECT l_orderkey, l_linenumber, {_ID_TEXT_SQL} AS t FROM lineitem) s""")
def q_normalise_id(spark, sf_dir):
    """E2 over every lineitem: integral numbers lose '.0', NULL → '', other text trimmed."""
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    s = li.select("l_orderkey", "l_linenumber", F.expr(_ID_TEXT_SPARK).alias("t"))
    return s.select("l_orderkey", "l_linenumber", ids.normalise_numeric_id("t").alias("source_id"))


# ---------------------------------------------------------------------------
# Dimensions and maintenance
# ---------------------------------------------------------------------------


@register("dim_date", with_fixtures("""
SELECT d AS date_key, cast(year(d) AS int) AS year, cast(month(d) AS int) AS month, cast(quarter(d) AS int) AS quarter,
       cast(weekofyear(d) AS int) AS week_iso, cast(isodow(d) - 1 AS int) AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM (SELECT cast(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS date) AS d
      FROM fact_incident) s""", ["fact_incident"]))
def q_dim_date(spark, sf_dir):
    """S10 date spine over the incident date range, with ISO week and Monday=0 weekday."""
    fi = fixtures.fact_incident(spark, sf_dir)
    return dims.date_dim(fi.agg(F.min("event_date").alias("start"), F.max("event_date").alias("end")))


_REGION_MAP_SQL = """
region_map AS (
  SELECT concat('N', lpad(cast(n_nationkey AS varchar(20)), 2, '0')) AS iso3, r_name AS region_code
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
dim_bf AS (
  SELECT d.iso3, d.iso2, d.name, coalesce(d.region_code, m.region_code) AS region_code
  FROM dim_country d LEFT JOIN region_map m ON m.iso3 = d.iso3
)"""


def _region_map(spark, sf_dir) -> DataFrame:
    n = fixtures.read_table(spark, sf_dir, "nation")
    r = fixtures.read_table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        fixtures.nation_code(F.col("n_nationkey")).alias("iso3"), F.col("r_name").alias("region_code"))


@register("region_backfill", with_fixtures("""
SELECT fi.incident_id, coalesce(fi.region_code, d.region_code) AS region_code
FROM fact_incident fi LEFT JOIN dim_bf d ON d.iso3 = fi.country_iso3""", ["fact_incident", "dim_country"],
    extra_ctes=_REGION_MAP_SQL))
def q_region_backfill(spark, sf_dir):
    """K9 then K10: fill NULL regions in the country dimension from a mapping, then in the fact from the dimension."""
    wh = _wh(spark, sf_dir)
    dim = store.backfill_region_dim(wh.dim_country, _region_map(spark, sf_dir))
    return store.backfill_region_fact(wh.fact_incident, dim).select("incident_id", "region_code")


@register("backfill_report", with_fixtures("""
SELECT (SELECT count(region_code) FROM dim_bf) AS dim_assigned, (SELECT count(*) FROM dim_bf) AS dim_total,
       count(coalesce(fi.region_code, d.region_code)) AS fact_assigned, count(*) AS fact_total
FROM fact_incident fi LEFT JOIN dim_bf d ON d.iso3 = fi.country_iso3""", ["fact_incident", "dim_country"],
    extra_ctes=_REGION_MAP_SQL))
def q_backfill_report(spark, sf_dir):
    """assigned/total region counts after the backfill."""
    wh = _wh(spark, sf_dir)
    dim = store.backfill_region_dim(wh.dim_country, _region_map(spark, sf_dir))
    return store.backfill_report(dim, store.backfill_region_fact(wh.fact_incident, dim))


_DA_COLS = ["action_id", "action_date", "actor_iso3", "target_iso3", "action_type", "action_subtype",
            "instrument_name", "legal_basis", "status", "confidence_flag", "source_url", "region", "notes"]


def _upsert_stage(spark, sf_dir) -> DataFrame:
    """A re-delivery: every order twice (first copy wins) with a new status and notes, plus one new action per lineitem."""
    o = fixtures.read_table(spark, sf_dir, "orders")
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    a = o.select(F.col("o_orderkey").cast("string").alias("action_id"),
                 F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("status"),
                 F.concat(F.lit("redelivered "), F.col("o_orderpriority")).alias("notes"), F.lit(1).alias("_seq"))
    b = o.select(F.col("o_orderkey").cast("string").alias("action_id"), F.lit("superseded").alias("status"),
                 F.lit(None).cast("string").alias("notes"), F.lit(2).alias("_seq"))
    c = li.select(F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"),
                           F.col("l_linenumber").cast("string")).alias("action_id"),
                  F.col("l_returnflag").alias("status"), F.lit(None).cast("string").alias("notes"), F.lit(1).alias("_seq"))
    return a.unionByName(b).unionByName(c)


_UPSERT_SQL_CTES = """
stage_raw AS (
  SELECT cast(o_orderkey AS varchar) AS action_id, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS status,
         concat('redelivered ', o_orderpriority) AS notes, 1 AS seq FROM orders
  UNION ALL SELECT cast(o_orderkey AS varchar), 'superseded', NULL, 2 FROM orders
  UNION ALL SELECT concat('L', cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)), l_returnflag, NULL, 1
  FROM lineitem
),
stage AS (
  SELECT action_id, status, notes FROM (
    SELECT *, row_number() OVER (PARTITION BY action_id ORDER BY seq, status, notes NULLS FIRST) AS rn
    FROM stage_raw) s WHERE rn = 1
)"""


@register("upsert_result", with_fixtures("""
SELECT t.action_id, t.action_date, t.actor_iso3, t.target_iso3, t.action_type, t.action_subtype, t.instrument_name,
       t.legal_basis, t.status, t.confidence_flag, t.source_url, t.region, t.notes
FROM fact_diplomatic_action t WHERE t.action_id NOT IN (SELECT action_id FROM stage)
UNION ALL
SELECT s.action_id,
  CASE WHEN t.action_id IS NOT NULL THEN t.action_date END, CASE WHEN t.action_id IS NOT NULL THEN t.actor_iso3 END,
  CASE WHEN t.action_id IS NOT NULL THEN t.target_iso3 END, CASE WHEN t.action_id IS NOT NULL THEN t.action_type END,
  CASE WHEN t.action_id IS NOT NULL THEN t.action_subtype END, CASE WHEN t.action_id IS NOT NULL THEN t.instrument_name END,
  CASE WHEN t.action_id IS NOT NULL THEN t.legal_basis END, s.status,
  CASE WHEN t.action_id IS NOT NULL THEN t.confidence_flag ELSE 'HIGH' END,
  CASE WHEN t.action_id IS NOT NULL THEN t.source_url END, CASE WHEN t.action_id IS NOT NULL THEN t.region END, s.notes
FROM stage s LEFT JOIN fact_diplomatic_action t ON t.action_id = s.action_id""",
    ["fact_diplomatic_action"], extra_ctes=_UPSERT_SQL_CTES))
def q_upsert_result(spark, sf_dir):
    """K1–K3: INSERT OR REPLACE of a partial-column re-delivery; first in-batch row wins; absent columns keep old values."""
    target = fixtures.fact_diplomatic_action(spark, sf_dir)
    merged = store.upsert(target, _upsert_stage(spark, sf_dir), ["action_id"], "fact_diplomatic_action",
                          order_cols=["_seq"])
    return merged.select(*_DA_COLS)


@register("replace_source", with_fixtures(f"""
SELECT incident_id, source_system, fatalities_best FROM fact_incident WHERE source_system <> 'ACLED'
UNION ALL
SELECT incident_id, source_system, fatalities_best * 2 FROM fact_incident
WHERE source_system = 'ACLED' AND event_date < DATE '{D1}'""", ["fact_incident"]))
def q_replace_source(spark, sf_dir):
    """K4: one source replaced by a shorter re-delivery with revised fatalities."""
    fi = fixtures.fact_incident(spark, sf_dir)
    stage = (fi.where((F.col("source_system") == "ACLED") & (F.col("event_date") < dates.as_date(D1)))
             .withColumn("fatalities_best", F.col("fatalities_best") * 2))
    merged = store.replace_source(fi, stage, ["incident_id"], "source_system", "ACLED", "fact_incident")
    return merged.select("incident_id", "source_system", "fatalities_best")


@register("insert_ignore", with_fixtures("""
SELECT * FROM dim_country
UNION ALL
SELECT iso3, iso2, name, region_code FROM (
  SELECT *, row_number() OVER (PARTITION BY iso3 ORDER BY ord) AS rn FROM (
    SELECT concat('N', lpad(cast(n_nationkey AS varchar(20)), 2, '0')) AS iso3, NULL AS iso2, upper(n_name) AS name,
           r_name AS region_code, 0 AS ord
    FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT iso3, iso2, name, region_code, 1 FROM """ + _values_sql(refdata.SPECIAL_COUNTRIES, ["iso3", "iso2", "name", "region_code"]) + """
  ) u) s
WHERE rn = 1 AND iso3 NOT IN (SELECT iso3 FROM dim_country)""", ["dim_country"]))
def q_insert_ignore(spark, sf_dir):
    """K5: re-seeding the country dimension (every nation plus the special rows); existing rows win."""
    wh = _wh(spark, sf_dir)
    n = fixtures.read_table(spark, sf_dir, "nation")
    r = fixtures.read_table(spark, sf_dir, "region")
    iso = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        fixtures.nation_code(F.col("n_nationkey")).alias("alpha_3"), F.lit(None).cast("string").alias("alpha_2"),
        F.upper("n_name").alias("name"))
    return dims.seed_countries(iso, _region_map(spark, sf_dir), dims.special_countries(spark), wh.dim_country)


@register("dedupe_keep_first", with_fixtures("""
SELECT item_id, tone, file_no FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY file_no, pos) AS rn FROM (
    SELECT item_id, tone, 0 AS file_no, 0 AS pos FROM fact_news_pulse
    UNION ALL
    SELECT concat_ws('#', l_orderkey::varchar, (l_linenumber + 7 * (l_linenumber % 2))::varchar, l_partkey::varchar, l_suppkey::varchar),
           l_tax * 100, 1, l_linenumber
    FROM lineitem) u) s WHERE rn = 1""", ["fact_news_pulse"]))
def q_dedupe_keep_first(spark, sf_dir):
    """Two overlapping deliveries, the later one with new ids for odd lines; the first occurrence (file, position) of each item id is kept."""
    news = fixtures.fact_news_pulse(spark, sf_dir).select("item_id", "tone", F.lit(0).alias("file_no"),
                                                          F.lit(0).alias("pos"))
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber") + 7 * (F.col("l_linenumber") % 2)
    later = li.select(F.concat_ws("#", *[c.cast("string") for c in (F.col("l_orderkey"), line, F.col("l_partkey"), F.col("l_suppkey"))])
                      .alias("item_id"), (F.col("l_tax") * 100).alias("tone"), F.lit(1).alias("file_no"),
                      F.col("l_linenumber").alias("pos"))
    d = store.dedupe_first(news.unionByName(later), ["item_id"], ["file_no", "pos"])
    return d.select("item_id", "tone", "file_no")


@register("last_event_date", with_fixtures("""
SELECT source_system, max(event_date) AS last_event_date, count(*) AS records FROM fact_incident GROUP BY 1""",
    ["fact_incident"]))
def q_last_event_date(spark, sf_dir):
    """Latest event date and row count per source (the state-row payload)."""
    return fixtures.fact_incident(spark, sf_dir).groupBy("source_system").agg(
        F.max("event_date").alias("last_event_date"), F.count(F.lit(1)).alias("records"))


@register("run_state", with_fixtures(f"""
SELECT source_name, strftime(TIMESTAMP '{RUN_TS}', '%Y-%m-%d %H:%M') AS last_run, records_processed, status FROM (
  SELECT source_system AS source_name, cast(count(*) AS bigint) AS records_processed, 'success' AS status
  FROM fact_incident GROUP BY 1
  UNION ALL SELECT 'SEED', cast(count(*) AS bigint), 'success' FROM fact_diplomatic_action
  UNION ALL SELECT 'WB', cast(count(*) AS bigint), CASE WHEN count(*) = 0 THEN 'partial' ELSE 'success' END
  FROM fact_risk_indicator) s""", ["fact_incident", "fact_diplomatic_action", "fact_risk_indicator"]))
def q_run_state(spark, sf_dir):
    """K6 + T1: one state row per loaded source (upserted by source name), listed newest first."""
    from riskfabric import schemas

    wh = _wh(spark, sf_dir)
    rows = [wh.fact_incident.groupBy(F.col("source_system").alias("source_name")).agg(
        F.count(F.lit(1)).alias("records_processed"), F.max("event_date").alias("last_event_date_ingested"))]
    rows.append(wh.fact_diplomatic_action.agg(F.count(F.lit(1)).alias("records_processed"),
                                              F.max("action_date").alias("last_event_date_ingested"))
                .select(F.lit("SEED").alias("source_name"), "*"))
    rows.append(wh.fact_risk_indicator.agg(F.count(F.lit(1)).alias("records_processed"),
                                           F.max("period_start").alias("last_event_date_ingested"))
                .select(F.lit("WB").alias("source_name"), "*"))
    stage = rows[0].unionByName(rows[1]).unionByName(rows[2])
    stage = stage.select(
        "source_name", F.lit(RUN_TS).cast("timestamp_ntz").alias("last_run_utc"), "last_event_date_ingested",
        F.col("records_processed").cast("long").alias("records_processed"),
        F.when(F.col("records_processed") == 0, "partial").otherwise("success").alias("status"))
    state = store.upsert(schemas.empty(spark, "_pipeline_state"), stage, ["source_name"])
    return dashboard.run_state(state)


@register("date_windows", with_fixtures("""
SELECT nation, w AS window_start, least(w + INTERVAL 89 DAY, last_day)::date AS window_end FROM (
  SELECT nation, last_day, unnest(generate_series(first_day, last_day, INTERVAL 90 DAY))::date AS w FROM (
    SELECT c_nationkey AS nation, min(o_orderdate)::date AS first_day, max(o_orderdate)::date AS last_day
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) r) s""", []))
def q_date_windows(spark, sf_dir):
    """Each nation's order-date range split into ≤90-day windows."""
    o = fixtures.read_table(spark, sf_dir, "orders")
    c = fixtures.read_table(spark, sf_dir, "customer")
    r = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first_day"), F.max(F.col("o_orderdate").cast("date")).alias("last_day"))
    w = r.select("nation", F.explode(dates.windows(F.col("first_day"), F.col("last_day"), refdata.NEWS_WINDOW_DAYS)).alias("w"))
    return w.select("nation", "w.window_start", "w.window_end")


#: A display region for each of the fixture's: two have a label of their own, the others fall back to their code.
_CODED = "CASE region_code WHEN 'ASIA' THEN 'EAP' WHEN 'EUROPE' THEN 'EU_EUR' ELSE coalesce(region_code, 'Unknown') END"


@register("region_label", with_fixtures(f"""
SELECT region, CASE region WHEN 'EAP' THEN 'East Asia & Pacific' WHEN 'EU_EUR' THEN 'Europe & Eurasia' ELSE region END AS label, count(*) AS incidents
FROM (SELECT {_CODED} AS region FROM fact_incident) GROUP BY ALL""", ["fact_incident"]))
def q_region_label(spark, sf_dir):
    """Region label with fallback to the code."""
    fi = fixtures.fact_incident(spark, sf_dir)
    g = fi.groupBy(F.expr(_CODED).alias("region")).agg(F.count(F.lit(1)).alias("incidents"))
    return g.select("region", dashboard.region_label(F.col("region")).alias("label"), "incidents")


@register("grs_movers_direction", with_fixtures("""
SELECT m.country_iso3, coalesce(name, m.country_iso3) AS country, round(current_grs, 1) AS grs, round(m.delta, 1) AS delta,
       ['down', 'flat', 'up'][2 + sign(round(m.delta, 1))::int] AS direction
FROM moves m LEFT JOIN dim_country d ON d.iso3 = m.country_iso3
ORDER BY abs(m.delta) DESC, 1 LIMIT 12""", ["dim_country"], grs=True, extra_ctes=MOVES_SQL))
def q_grs_movers_direction(spark, sf_dir):
    """Top movers with the direction of the displayed (rounded) change."""
    from riskfabric.catalog import _GRS_COLS
    from riskfabric.plans import grs

    wh = _wh(spark, sf_dir)
    movers = dashboard.grs_top_movers(r6(grs.grs_from(wh), *_GRS_COLS), wh.dim_country)
    return dashboard.grs_movers_direction(movers)


# ---------------------------------------------------------------------------
# Source normalisers over raw-shaped rows (P1, P3, P4, P5, P6, P7; J11–J13)
# ---------------------------------------------------------------------------


_ACLED_RAW_COLS = {
    "WEEK": "CASE WHEN l_linenumber = 6 THEN 'bad-date' ELSE cast(cast(l_shipdate AS date) AS {s}) END",
    "REGION": "'R'",
    "COUNTRY": "CASE WHEN l_linenumber = 2 THEN lower(n_name) ELSE n_name END",
    "ADMIN1": "CASE WHEN l_linenumber = 3 THEN NULL ELSE c_mktsegment END",
    "EVENT_TYPE": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Violence against civilians' ELSE o_orderpriority END",
    "SUB_EVENT_TYPE": "l_returnflag",
    "EVENTS": "CASE WHEN l_linenumber = 5 THEN cast(-1 * l_quantity AS {s}) ELSE cast(l_quantity AS {s}) END",
    "FATALITIES": "CASE WHEN l_linenumber = 4 THEN NULL ELSE cast(cast(round(l_discount * 100) AS int) AS {s}) END",
    "DISORDER_TYPE": "l_linestatus",
    "ID": "concat(cast(l_orderkey AS {s}), '.0')",
    "CENTROID_LATITUDE": "cast(l_linenumber AS {s})",
    "CENTROID_LONGITUDE": "cast(l_partkey % 180 AS {s})",
}
def _acled_raw_df(spark, sf_dir) -> DataFrame:
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    o = fixtures.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = fixtures.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = fixtures.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    oc = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey)
    return j.select(*[F.expr(e.format(s="string")).alias(k) for k, e in _ACLED_RAW_COLS.items()])


_ACLED_RAW_SQL = ("SELECT " + ", ".join(f"{e.format(s='varchar')} AS {k}" for k, e in _ACLED_RAW_COLS.items())
                  + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
                  " JOIN nation ON c_nationkey = n_nationkey")


@register("acled_normalise", with_fixtures(f"""
SELECT incident_id, source_event_id, event_date, country_iso3, admin1, location_name, event_type, sub_event_type,
       disorder_type, civilian_targeting, event_count, fatalities_best, fatalities_low, fatalities_high, latitude
FROM (
  SELECT {_make_id_sql("'ACLED'", "sid")} AS incident_id, sid AS source_event_id, wk AS event_date,
         {_name_iso3_sql("a_country")} AS country_iso3,
         nullif(a_admin1, '') AS admin1, nullif(a_admin1, '') AS location_name, nullif(a_etype, '') AS event_type,
         nullif(a_sub, '') AS sub_event_type, nullif(trim(coalesce(DISORDER_TYPE, '')), '') AS disorder_type,
         lower(a_etype) = 'violence against civilians' AS civilian_targeting,
         ec AS event_count, fat AS fatalities_best, fat AS fatalities_low, fat AS fatalities_high,
         try_cast(CENTROID_LATITUDE AS double) AS latitude
  FROM (
    SELECT *, concat_ws('|', coalesce(strftime(wk, '%Y-%m-%d'), ''), a_country, a_admin1, a_etype, a_sub, idn) AS sid
    FROM (
      SELECT *, try_strptime(WEEK, '%Y-%m-%d')::date AS wk,
             trim(coalesce(COUNTRY, '')) AS a_country, trim(coalesce(ADMIN1, '')) AS a_admin1,
             trim(coalesce(EVENT_TYPE, '')) AS a_etype, trim(coalesce(SUB_EVENT_TYPE, '')) AS a_sub,
             CASE WHEN try_cast(trim(coalesce(ID, '')) AS double) % 1 = 0
                  THEN cast(cast(try_cast(trim(coalesce(ID, '')) AS double) AS bigint) AS varchar)
                  ELSE trim(coalesce(ID, '')) END AS idn,
             cast(round_even(try_cast(EVENTS AS double), 0) AS int) AS ec,
             cast(round_even(coalesce(try_cast(FATALITIES AS double), 0), 0) AS int) AS fat
      FROM raw) a) b
  WHERE wk IS NOT NULL AND ec IS NOT NULL AND ec >= 0) c""", ["dim_country"],
    extra_ctes=NAME_LOOKUP_CTE + ",\nraw AS (" + _ACLED_RAW_SQL + ")"))
def q_acled_normalise(spark, sf_dir):
    """P1 over raw weekly-aggregate rows (one per lineitem): ids, E2, name → iso3 (override → exact), F1 filter."""
    wh = _wh(spark, sf_dir)
    out = acled.normalise(_acled_raw_df(spark, sf_dir), wh.dim_country)
    return out.select("incident_id", "source_event_id", "event_date", "country_iso3", "admin1", "location_name",
                      "event_type", "sub_event_type", "disorder_type", "civilian_targeting", "event_count",
                      "fatalities_best", "fatalities_low", "fatalities_high", "latitude")


_UCDP_RAW_COLS = {
    "id": "cast(l_orderkey * 10 + l_linenumber AS {s})",
    "date_start": "CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE cast(l_shipdate AS {s}) END",
    "date_end": "cast(cast(l_shipdate AS date) AS {s})",
    "country": "n_name",
    "latitude": "cast(l_quantity AS {s})",
    "longitude": "cast(l_discount AS {s})",
    "where_prec": "cast(l_linenumber AS {s})",
    "type_of_violence": "cast(1 + (l_partkey % 3) AS {s})",
    "dyad_name": "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN c_mktsegment "
                 "ELSE concat('Gov ', n_name, ' - ', c_mktsegment) END",
    "best": "CASE WHEN l_linenumber = 3 THEN 'x' ELSE cast(l_quantity AS {s}) END",
    "low": "cast(cast(round(l_discount * 100) AS int) AS {s})",
    "high": "cast(l_partkey % 100 AS {s})",
}


def _ucdp_raw_df(spark, sf_dir) -> DataFrame:
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    o = fixtures.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = fixtures.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = fixtures.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    oc = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey)
    return j.select(*[F.expr(e.format(s="string")).alias(k) for k, e in _UCDP_RAW_COLS.items()])


_UCDP_RAW_SQL = ("SELECT " + ", ".join(f"{e.format(s='varchar')} AS {k}" for k, e in _UCDP_RAW_COLS.items())
                 + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
                 " JOIN nation ON c_nationkey = n_nationkey")


@register("ucdp_normalise", with_fixtures(f"""
SELECT id AS source_event_id, {_make_id_sql("'UCDP_GED'", "coalesce(id, 'nan')")} AS incident_id,
       try_cast(trim(date_start) AS timestamp)::date AS event_date, try_cast(trim(date_end) AS timestamp)::date AS event_date_end,
       {_name_iso3_sql("country")} AS country_iso3,
       CASE try_cast(type_of_violence AS double) WHEN 1 THEN 'state-based conflict' WHEN 2 THEN 'non-state conflict'
            WHEN 3 THEN 'one-sided violence' END AS event_type,
       nullif(trim(split_part(coalesce(dyad_name, ''), ' - ', 1)), '') AS actor1_name,
       nullif(trim(CASE WHEN len(string_split(coalesce(dyad_name, ''), ' - ')) >= 2
                        THEN string_split(coalesce(dyad_name, ''), ' - ')[2] END), '') AS actor2_name,
       coalesce(try_cast(type_of_violence AS double) = 3, false) AS civilian_targeting,
       cast(trunc(coalesce(try_cast(best AS double), 0)) AS int) AS fatalities_best,
       cast(trunc(coalesce(try_cast(low AS double), 0)) AS int) AS fatalities_low,
       cast(trunc(coalesce(try_cast(high AS double), 0)) AS int) AS fatalities_high,
       cast(trunc(try_cast(where_prec AS double)) AS int) AS geo_precision
FROM raw WHERE try_cast(trim(date_start) AS timestamp) IS NOT NULL""", ["dim_country"],
    extra_ctes=NAME_LOOKUP_CTE + ",\nraw AS (" + _UCDP_RAW_SQL + ")"))
def q_ucdp_normalise(spark, sf_dir):
    """P3 over raw event rows (one per lineitem): dyad split, violence labels, deaths, name → iso3, F2 filter."""
    wh = _wh(spark, sf_dir)
    out = ucdp.normalise(_ucdp_raw_df(spark, sf_dir), wh.dim_country)
    return out.select("source_event_id", "incident_id", "event_date", "event_date_end", "country_iso3", "event_type",
                      "actor1_name", "actor2_name", "civilian_targeting", "fatalities_best", "fatalities_low",
                      "fatalities_high", "geo_precision")


_SDN_RAW_COLS = {
    "ent_num": "cast(o_orderkey AS {s})",
    "sdn_name": "CASE WHEN o_orderstatus = 'P' THEN '-0-' ELSE concat('Entity ', cast(o_custkey AS {s})) END",
    "program": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'IRAN2X; SDGT' WHEN '2' THEN 'DPRK3' "
               "WHEN '3' THEN 'CUBA;RUSSIA-EO14024' WHEN '4' THEN '-0-' ELSE ' ukraine-eo13685-crimea ' END",
    "remarks": "CASE WHEN o_orderstatus = 'F' THEN '-0-' ELSE o_orderpriority END",
}


def _sdn_raw_df(spark, sf_dir) -> DataFrame:
    o = fixtures.read_table(spark, sf_dir, "orders")
    cols = [F.expr(_SDN_RAW_COLS[c].format(s="string")).alias(c) if c in _SDN_RAW_COLS else F.lit("-0-").alias(c)
            for c in refdata.SDN_COLUMNS]
    return o.select(*cols)


@register("ofac_normalise", with_fixtures(f"""
SELECT {_make_id_sql("'OFAC_SDN'", "coalesce(ent_num, 'None')", "prog")} AS action_id, DATE '{RUN_DATE}' AS action_date,
       'USA' AS actor_iso3, target_iso3, 'sanction' AS action_type, 'OFAC_SDN' AS action_subtype,
       substring(concat('SDN: ', coalesce(sdn_name, 'None'), ' (', prog, ')'), 1, 255) AS instrument_name,
       prog AS legal_basis, 'active' AS status, 'LOW' AS confidence_flag, notes
FROM (
  SELECT e.*, (SELECT min(struct_pack(ne := (m.key <> e.code), o := m.ord, i := m.iso3)).i FROM programs m
               WHERE e.code <> '' AND starts_with(e.code, m.key)) AS target_iso3
  FROM (
    SELECT ent_num, sdn_name, notes, trim(p) AS prog, upper(trim(p)) AS code
    FROM (SELECT nullif(ent_num, '-0-') AS ent_num, nullif(sdn_name, '-0-') AS sdn_name,
                 nullif(remarks, '-0-') AS notes, nullif(program, '-0-') AS program FROM raw) c,
         unnest(string_split(coalesce(program, ''), ';')) AS u(p)) e) s""", [],
    extra_ctes=f"programs AS (SELECT * FROM {PROGRAMS_SQL}),\nraw AS (SELECT "
    + ", ".join(f"{_SDN_RAW_COLS[c].format(s='varchar')} AS {c}" if c in _SDN_RAW_COLS else f"'-0-' AS {c}"
                for c in refdata.SDN_COLUMNS) + " FROM orders)"))
def q_ofac_normalise(spark, sf_dir):
    """P6 + J13 over one raw list row per order: placeholder removal, program explode, ordered prefix lookup."""
    out = ofac.normalise(_sdn_raw_df(spark, sf_dir), RUN_DATE)
    return out.select("action_id", "action_date", "actor_iso3", "target_iso3", "action_type", "action_subtype",
                      "instrument_name", "legal_basis", "status", "confidence_flag", "notes")


#: An article's country as a name, an alpha-2 code (one of them clashes with a FIPS code) or a FIPS code.
_NEWS_COUNTRY = ("CASE WHEN s_nationkey < 8 THEN n_name WHEN s_nationkey < 16 THEN concat(substring(n_name, 1, 1), chr(CAST(65 + n_nationkey AS int))) "
                 "WHEN s_nationkey % 2 = 0 THEN 'CH' ELSE ' iz ' END")


def _news_raw_df(spark, sf_dir) -> DataFrame:
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    s = fixtures.read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = fixtures.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
    return j.select(
        F.concat(F.lit("https://news.example/"), F.col("l_orderkey").cast("string"), F.lit("/"),
                 F.col("l_partkey").cast("string")).alias("url"),
        F.lit("t").alias("title"),
        F.date_format("l_shipdate", "yyyyMMdd'T'HHmmss'Z'").alias("seendate"),
        F.lit("news.example").alias("domain"),
        F.expr(_NEWS_COUNTRY).alias("sourcecountry"),
        F.lit(None).cast("string").alias("themes"),
        F.format_string("%.2f", F.col("l_tax") * 100 - 4).alias("tone"),
        F.lit("artlist").alias("_source_file"),
        F.col("l_linenumber").alias("_pos"),
    )


@register("gdelt_normalise", with_fixtures(f"""
SELECT item_id, published_at_utc, coalesce(code_iso3, {_name_iso3_sql("raw_country")}) AS country_focus_iso3,
       url, topic_tags, tone
FROM (
  SELECT a.*, coalesce((SELECT f.iso3 FROM fips f WHERE f.code = upper(trim(a.raw_country))),
                       (SELECT d.iso3 FROM dim_country d WHERE upper(d.iso2) = upper(trim(a.raw_country)))) AS code_iso3
  FROM (
    SELECT * FROM (
      SELECT {_make_id_sql("coalesce(url, 'nan')", "coalesce(seendate, 'nan')")} AS item_id,
             try_strptime(seendate, '%Y%m%dT%H%M%SZ') AS published_at_utc, sourcecountry AS raw_country, url,
             substring(tone, 1, 500) AS topic_tags, try_cast(tone AS double) AS tone,
             row_number() OVER (PARTITION BY url, seendate ORDER BY pos) AS rn
      FROM raw) r WHERE rn = 1) a) s""", ["dim_country"],
    extra_ctes=NAME_LOOKUP_CTE + f",\nfips AS (SELECT * FROM {FIPS_SQL}),\nraw AS ("
    "SELECT concat('https://news.example/', cast(l_orderkey AS varchar), '/', cast(l_partkey AS varchar)) AS url, "
    "strftime(l_shipdate, '%Y%m%dT%H%M%SZ') AS seendate, "
    + _NEWS_COUNTRY + " AS sourcecountry, "
    "printf('%.2f', l_tax * 100 - 4) AS tone, l_linenumber AS pos "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"))
def q_gdelt_normalise(spark, sf_dir):
    """P5 + J12 over one raw article per returned lineitem: id, time parse, FIPS → alpha-2 → name cascade, keep-first dedupe."""
    wh = _wh(spark, sf_dir)
    out = gdelt.normalise(_news_raw_df(spark, sf_dir), wh.dim_country, has_themes=False)
    return out.select("item_id", F.col("published_at_utc").cast("timestamp_ntz").alias("published_at_utc"),
                      "country_focus_iso3", "url", "topic_tags", "tone")


def _seed_raw_df(spark, sf_dir) -> DataFrame:
    da = fixtures.fact_diplomatic_action(spark, sf_dir)
    o = fixtures.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return da.join(o, da.action_id == o.o_orderkey.cast("string")).select(
        F.expr("CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE cast(cast(o_orderdate AS date) AS string) END")
        .alias("action_date"), "actor_iso3", "target_iso3", "action_type", "instrument_name", "status")


@register("seed_normalise", with_fixtures(f"""
SELECT {_make_id_sql("coalesce(actor_iso3, 'nan')", "coalesce(target_iso3, 'nan')",
                     "coalesce(strftime(try_cast(trim(action_date) AS timestamp), '%Y-%m-%d %H:%M:%S'), coalesce(action_date, 'nan'))",
                     "coalesce(action_type, 'nan')", "coalesce(instrument_name, 'nan')")} AS action_id,
       try_cast(trim(action_date) AS timestamp)::date AS action_date, actor_iso3, target_iso3, action_type, instrument_name,
       status, 'HIGH' AS confidence_flag
FROM (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE cast(cast(o_orderdate AS date) AS varchar) END AS action_date,
             actor_iso3, target_iso3, action_type, instrument_name, status
      FROM fact_diplomatic_action JOIN orders ON cast(o_orderkey AS varchar) = action_id) s""",
    ["fact_diplomatic_action"]))
def q_seed_normalise(spark, sf_dir):
    """P7 over one curated-catalog row per order: ids from pandas-style rendered text, date parse, HIGH confidence."""
    raw = _seed_raw_df(spark, sf_dir)
    out = seed.normalise(raw)
    return out.select("action_id", "action_date", "actor_iso3", "target_iso3", "action_type", "instrument_name",
                      "status", "confidence_flag")


_WB_RAW_COLS = {
    "countryiso3code": "CASE WHEN o_orderkey % 4 = 0 THEN '' "
                       "ELSE lower(concat('N', lpad(cast(c_nationkey AS {s}), 2, '0'))) END",
    "country_id": "CASE WHEN c_nationkey % 8 = 0 THEN 'XK' ELSE concat(substring(n_name, 1, 1), chr(CAST(65 + n_nationkey AS int))) END",
    "date": "CASE WHEN o_orderkey % 5 = 0 THEN '19x7' ELSE cast(year(o_orderdate) AS {s}) END",
    "value": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END",
    "unit": "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'u' END",
    "indicator_code": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'SP.POP.TOTL' "
                      "WHEN '2' THEN 'MS.MIL.XPND.GD.ZS' ELSE 'NY.GDP.PCAP.CD' END",
}


def _world_bank_raw_df(spark, sf_dir) -> DataFrame:
    o = fixtures.read_table(spark, sf_dir, "orders")
    c = fixtures.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = fixtures.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
    cols = {k: F.expr(e.format(s="string")) for k, e in _WB_RAW_COLS.items()}
    return j.select(
        cols["countryiso3code"].alias("countryiso3code"), F.struct(cols["country_id"].alias("id")).alias("country"),
        cols["date"].alias("date"), cols["value"].cast("double").alias("value"), cols["unit"].alias("unit"),
        cols["indicator_code"].alias("indicator_code"),
    )


@register("world_bank_normalise", with_fixtures("""
SELECT CASE WHEN upper(coalesce(countryiso3code, '')) <> '' THEN upper(countryiso3code)
            ELSE coalesce(CASE country_id WHEN 'KV' THEN 'XKX' WHEN 'XK' THEN 'XKX' END,
                          (SELECT min(d.iso3) FROM dim_country d WHERE upper(d.iso2) = upper(country_id)), '') END
         AS country_iso3,
       make_date(cast(date AS int), 1, 1) AS period_start, indicator_code,
       CASE indicator_code WHEN 'SP.POP.TOTL' THEN 'population_total' WHEN 'NY.GDP.PCAP.CD' THEN 'gdp_per_capita_usd'
            WHEN 'MS.MIL.XPND.GD.ZS' THEN 'military_exp_pct_gdp' END AS indicator_name,
       value, coalesce(unit, '') AS unit
FROM (SELECT """ + ", ".join(f"{e.format(s='varchar')} AS {k}" for k, e in _WB_RAW_COLS.items()) + """
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) r
WHERE value IS NOT NULL AND regexp_full_match(date, '[0-9]+')""", ["dim_country"]))
def q_world_bank_normalise(spark, sf_dir):
    """P4 + F3 over one raw indicator observation per order: iso3 fallback chain (item code, special
    codes, alpha-2 lookup, ''), value and all-digit-year filter, period start, indicator names."""
    wh, raw = _wh(spark, sf_dir), _world_bank_raw_df(spark, sf_dir)
    out = world_bank.normalise(raw, wh.dim_country)
    return out.select("country_iso3", "period_start", "indicator_code", "indicator_name", "value", "unit")


@register("weekly_timeline_routed", with_fixtures("""
SELECT week_start, cast(sum(incident_count) AS bigint) AS incidents, cast(sum(fatalities_total) AS bigint) AS fatalities,
       cast(sum(civilian_incidents) AS bigint) AS civilian_incidents
FROM (
  SELECT cast(date_trunc('week', event_date) AS date) AS week_start, sum(coalesce(event_count, 1)) AS incident_count,
         sum(fatalities_best) AS fatalities_total,
         sum(CASE WHEN civilian_targeting THEN coalesce(event_count, 1) ELSE 0 END) AS civilian_incidents
  FROM fact_incident GROUP BY event_date) cw
WHERE week_start BETWEEN DATE '""" + D0 + "' AND DATE '" + D1 + "' GROUP BY week_start", ["fact_incident"]))
def q_weekly_timeline_routed(spark, sf_dir):
    """two regions selected → the unfiltered timeline."""
    return dashboard.weekly_timeline_routed(fixtures.fact_incident(spark, sf_dir), D0, D1, ["ASIA", "EUROPE"])


@register("table_counts", with_fixtures("""
SELECT 'fact_incident' AS table_name, count(*) AS rows FROM fact_incident
UNION ALL SELECT 'fact_diplomatic_action', count(*) FROM fact_diplomatic_action
UNION ALL SELECT 'fact_risk_indicator', count(*) FROM fact_risk_indicator
UNION ALL SELECT 'fact_news_pulse', count(*) FROM fact_news_pulse""",
    ["fact_incident", "fact_diplomatic_action", "fact_risk_indicator", "fact_news_pulse"]))
def q_table_counts(spark, sf_dir):
    """Post-run row count per fact table."""
    wh = _wh(spark, sf_dir)
    return store.table_counts({"fact_incident": wh.fact_incident, "fact_diplomatic_action": wh.fact_diplomatic_action,
                               "fact_risk_indicator": wh.fact_risk_indicator, "fact_news_pulse": wh.fact_news_pulse})


@register("name_lookup_fuzzy", with_fixtures(f"""
SELECT r.c_custkey, r.country, coalesce({_name_iso3_sql("r.country")}, k.iso3) AS country_iso3
FROM raw r LEFT JOIN closest k ON k.country = r.country""", ["dim_country"], extra_ctes=NAME_LOOKUP_CTE + """,
raw AS (
  SELECT c_custkey, concat(substring(n_name, 1, 3), 'x', substring(n_name, 5)) AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
closest AS (
  SELECT country, min(struct_pack(d := edits, i := iso3)).i AS iso3 FROM (
    SELECT t.country, c.iso3, levenshtein(lower(trim(t.country)), lower(trim(c.name))) AS edits
    FROM (SELECT DISTINCT country FROM raw) t JOIN dim_country c ON c.name IS NOT NULL) e
  WHERE edits <= 2 GROUP BY country
)"""))
def q_name_lookup_fuzzy(spark, sf_dir):
    """J11 with the fuzzy step on: every customer's nation name with its fourth letter replaced,
    looked up by override → exact → fuzzy (the closest name within two edits); names the
    fuzzy step cannot place stay NULL.
    """
    c = fixtures.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = fixtures.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    typo = F.concat(F.substring("n_name", 1, 3), F.lit("x"), F.expr("substring(n_name, 5)"))
    raw = j.select("c_custkey", typo.alias("country"))
    wh = _wh(spark, sf_dir)
    return lookup.name_to_iso3(raw, "country", wh.dim_country, overrides_df(spark), "country_iso3", fuzzy=True)


# ---------------------------------------------------------------------------
# Incremental ingest
# ---------------------------------------------------------------------------


@register("incremental_events", """
SELECT cast(ts AS date) AS day, event_type, count(*) AS events, count(DISTINCT user_id) AS users,
       round(sum(value), 6) AS value_total
FROM events GROUP BY 1, 2""")
def q_incremental_events(spark, sf_dir):
    """The events file ingested by an availableNow file stream with a keyed upsert per
    micro-batch (fresh checkpoint = full refresh), then summarised per day and type."""
    import uuid

    from riskfabric.session import scratch_path
    from riskfabric.streaming import ingest

    run = uuid.uuid4().hex
    table = ingest.ingest_files(
        spark, sf_dir, ingest.EVENTS, scratch_path(spark, f"ingest/events-{run}"), ["event_id"],
        checkpoint=scratch_path(spark, f"ingest/events-{run}-ckpt"),
        options={"pathGlobFilter": "events.parquet"},
        # partitioned by day: a micro-batch merges into and rewrites only the days it touches
        partition_by=["event_day"], transform=ingest.with_event_day,
    )
    return ingest.daily_event_summary(table)


# ---------------------------------------------------------------------------
# SQL access with positional parameters
# ---------------------------------------------------------------------------


@register("kpi_global_sql", with_fixtures(f"""
SELECT cast(sum(event_count) AS bigint) AS total_incidents, cast(sum(fatalities_best) AS bigint) AS total_fatalities,
       count(DISTINCT country_iso3) AS countries_affected,
       cast(sum(CASE WHEN civilian_targeting THEN event_count ELSE 0 END) AS bigint) AS civilian_incidents
FROM fact_incident WHERE event_date BETWEEN DATE '{D0}' AND DATE '{D1}'""", ["fact_incident"]))
def q_kpi_global_sql(spark, sf_dir):
    """The KPI statement run through spark.sql with positional ? parameters over registered views."""
    from riskfabric.plans import sql

    prefix = f"rf_{zlib.crc32(sf_dir.encode())}_"
    sql.register_views(spark, {"fact_incident": fixtures.fact_incident(spark, sf_dir)}, prefix)
    return sql.query(spark, sql.KPI_GLOBAL.format(p=prefix), [D0, D1])


@register("weekly_timeline_region_sql", with_fixtures("""
SELECT week_start, cast(sum(incident_count) AS bigint) AS incidents, cast(sum(fatalities_total) AS bigint) AS fatalities,
       cast(sum(civilian_incidents) AS bigint) AS civilian_incidents
FROM (
  SELECT cast(date_trunc('week', event_date) AS date) AS week_start, country_iso3, region_code, event_type,
         sum(coalesce(event_count, 1)) AS incident_count, sum(fatalities_best) AS fatalities_total,
         sum(CASE WHEN civilian_targeting THEN coalesce(event_count, 1) ELSE 0 END) AS civilian_incidents
  FROM fact_incident GROUP BY 1, 2, 3, 4) cw
WHERE week_start BETWEEN DATE '""" + D0 + "' AND DATE '" + D1 + "' AND region_code = 'ASIA' GROUP BY week_start",
    ["fact_incident"]))
def q_weekly_timeline_region_sql(spark, sf_dir):
    """The regional weekly timeline as SQL over the registered aggregate view, three positional parameters."""
    from riskfabric.plans import sql

    prefix = f"rf_{zlib.crc32(sf_dir.encode())}_"
    sql.register_views(spark, {"fact_incident": fixtures.fact_incident(spark, sf_dir)}, prefix)
    return sql.query(spark, sql.WEEKLY_TIMELINE_REGION.format(p=prefix), [D0, D1, "ASIA"])


# ---------------------------------------------------------------------------
# Manual weekly backfill (S2, P2, F5) and indicator load summary
# ---------------------------------------------------------------------------

_MANUAL_RAW_COLS = {
    "country_iso3": "concat(' ', lower(concat('N', lpad(cast(c_nationkey AS {s}), 2, '0'))), ' ')",
    "week_start": "cast(date_add(DATE '2026-01-01', cast(o_orderkey % 59 AS int)) AS {s})",
    "event_type": "concat(o_orderpriority, ' #', cast(o_orderkey AS {s}))",
    "sub_event_type": "CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END",
    "event_count": "cast(cast(floor(o_totalprice / 1000) AS int) AS {s})",
    "fatalities_best": "concat(cast(o_custkey % 50 AS {s}), '.0')",
    "source_url": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE concat('https://src.example/', cast(o_orderkey AS {s})) END",
    "notes": "' '",
}


def _manual_raw_df(spark, sf_dir) -> DataFrame:
    o = fixtures.read_table(spark, sf_dir, "orders")
    c = fixtures.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(*[F.expr(e.format(s="string")).alias(k) for k, e in _MANUAL_RAW_COLS.items()])


@register("acled_manual_normalise", f"""
SELECT source_event_id, {_make_id_sql("'ACLED_MANUAL'", "source_event_id")} AS incident_id, event_date, country_iso3,
       event_type, sub_event_type, event_count, fatalities_best, notes, source_urls
FROM (
  SELECT concat_ws('|', strftime(wk, '%Y-%m-%d'), iso, et) AS source_event_id, wk AS event_date, iso AS country_iso3,
         et AS event_type, nullif(trim(sub_event_type), '') AS sub_event_type,
         cast(round_even(try_cast(event_count AS double), 0) AS int) AS event_count,
         cast(round_even(try_cast(fatalities_best AS double), 0) AS int) AS fatalities_best,
         nullif(trim(notes), '') AS notes, nullif(trim(source_url), '') AS source_urls
  FROM (
    SELECT *, try_strptime(week_start, '%Y-%m-%d')::date AS wk, upper(trim(coalesce(country_iso3, ''))) AS iso,
           trim(coalesce(event_type, '')) AS et
    FROM (SELECT """ + ", ".join(f"{e.format(s='varchar')} AS {k}" for k, e in _MANUAL_RAW_COLS.items()) + """
          FROM orders JOIN customer ON o_custkey = c_custkey) r) a) b""")
def q_acled_manual_normalise(spark, sf_dir):
    """One manual weekly row per order through the fail-fast rules (one aggregate job plus a
    grouped duplicate-key check), then the canonical projection with ids."""
    from riskfabric.sources import acled_manual

    out = acled_manual.normalise(_manual_raw_df(spark, sf_dir))
    return out.select("source_event_id", "incident_id", "event_date", "country_iso3", "event_type", "sub_event_type",
                      "event_count", "fatalities_best", "notes", "source_urls")


@register("indicator_summary", """
SELECT count(*) AS rows, count(DISTINCT indicator_code) AS indicators FROM (
  SELECT CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'SP.POP.TOTL' WHEN '2' THEN 'MS.MIL.XPND.GD.ZS'
              ELSE 'NY.GDP.PCAP.CD' END AS indicator_code,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS value,
         CASE WHEN o_orderkey % 5 = 0 THEN '19x7' ELSE cast(year(o_orderdate) AS varchar) END AS date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) r
WHERE value IS NOT NULL AND regexp_full_match(date, '[0-9]+')""")
def q_indicator_summary(spark, sf_dir):
    """Rows loaded and distinct indicators, over the normalised indicator observations."""
    return world_bank.indicator_summary(q_world_bank_normalise(spark, sf_dir))
