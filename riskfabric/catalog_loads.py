"""Registered queries over landed files: readers, loads into a catalog warehouse, streams, kept aggregates.

Each query writes rows of the driver's tables as the files a source would land (into the shared scratch
folder), reads or loads them through the library, and returns what came of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric import catalog_sources as raw
from riskfabric import runner
from riskfabric.catalog import REGISTRY, register
from riskfabric.catalog_sources import RUN_DATE, _make_id_sql, _wh
from riskfabric.operators import names
from riskfabric.operators.versioned import Warehouse
from riskfabric.oracle import with_fixtures
from riskfabric.plans import grs, kept
from riskfabric.session import scratch_path, shuffles_dropped
from riskfabric.sources import acled, acled_manual, fixtures, gdelt, ofac, seed, ucdp, world_bank
from riskfabric.sources.common import list_files, overrides_df
from riskfabric.streaming import ingest, latest

#: Items of a JSON file, as a source's page or article list has them.
PAGE = 1_000


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"landing/{name}-{uuid.uuid4().hex}")


def _warehouse(spark: SparkSession, name: str) -> Warehouse:
    unique = uuid.uuid4().hex[:12]
    return Warehouse(spark, f"rf_{name}_{unique}", scratch_path(spark, f"warehouses/{name}-{unique}"))


def _csv(df: DataFrame, path: str, header: bool = True, **options) -> str:
    with shuffles_dropped(df.sparkSession):
        df.write.options(header=header, escape='"', **options).csv(path)
    return path


def _renamed(spark: SparkSession, written: str, folder: str, name: str) -> str:
    """Give the part files of ``written`` the names that a source's files have; ``name`` holds the number."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for i, f in enumerate(list_files(spark, f"{written}/part-*")):
        fs.rename(path(f), path(f"{folder}/{name.format(i)}"))
    return folder


def _page_of(df: DataFrame) -> Column:
    """A row's page, of ``PAGE`` rows or so."""
    return F.pmod(F.xxhash64(*df.columns), F.greatest(F.lit(1), F.ceil(df.agg(F.count(F.lit(1)).alias("n")).scalar() / PAGE)))


def _pages(df: DataFrame, item, close: tuple[str, str]) -> DataFrame:
    """Text rows, one a page: ``PAGE`` items or so as a JSON array."""
    page = df.select(_page_of(df).alias("n"), F.to_json(item, {"ignoreNullFields": "false"}).alias("item"))
    body = F.array_join(F.collect_list("item"), ",")
    return page.groupBy("n").agg(F.concat(F.lit(close[0]), body, F.lit(close[1])).alias("value")).select("value")


def _same_result(name: str, like: str):
    """Register a query whose rows are those of another one, reached through files."""
    return register(name, REGISTRY[like].sql)


_PICKED = {
    "acled": ["incident_id", "source_event_id", "event_date", "country_iso3", "admin1", "location_name", "event_type", "sub_event_type", "disorder_type", "civilian_targeting",
              "event_count", "fatalities_best", "fatalities_low", "fatalities_high", "latitude"],
    "manual": ["source_event_id", "incident_id", "event_date", "country_iso3", "event_type", "sub_event_type", "event_count", "fatalities_best", "notes", "source_urls"],
    "ucdp": ["source_event_id", "incident_id", "event_date", "event_date_end", "country_iso3", "event_type", "actor1_name", "actor2_name", "civilian_targeting", "fatalities_best",
             "fatalities_low", "fatalities_high", "geo_precision"],
    "ofac": ["action_id", "action_date", "actor_iso3", "target_iso3", "action_type", "action_subtype", "instrument_name", "legal_basis", "status", "confidence_flag", "notes"],
    "seed": ["action_id", "action_date", "actor_iso3", "target_iso3", "action_type", "instrument_name", "status", "confidence_flag"],
}


@_same_result("acled_files", "acled_normalise")
def q_acled_files(spark, sf_dir):
    """Regional CSV files by glob, a summary file beside them left out."""
    folder = _folder(spark, "acled")
    rows = raw._acled_raw_df(spark, sf_dir)
    _renamed(spark, _csv(rows, f"{folder}/_written"), f"{folder}/acled", "Region{}_aggregated_data_up_to-2026-01-31.csv")
    _renamed(spark, _csv(rows.limit(1), f"{folder}/_summary"), f"{folder}/acled", "number_of_{}_aggregated_data_up_to-2026-01-31.csv")
    return acled.normalise(acled.read(spark, f"{folder}/acled"), _wh(spark, sf_dir).dim_country).select(*_PICKED["acled"])


@_same_result("acled_manual_files", "acled_manual_normalise")
def q_acled_manual_files(spark, sf_dir):
    """The manual backfill's file, its rules checked."""
    path = _csv(raw._manual_raw_df(spark, sf_dir), f"{_folder(spark, 'manual')}/acled_manual.csv")
    return acled_manual.normalise(acled_manual.read(spark, path)).select(*_PICKED["manual"])


@_same_result("ucdp_files", "ucdp_normalise")
def q_ucdp_files(spark, sf_dir):
    """S3: event files of the landing folder, records that may span lines."""
    folder = _folder(spark, "ucdp")
    _renamed(spark, _csv(raw._ucdp_raw_df(spark, sf_dir), f"{folder}/_written"), f"{folder}/ged", "ged{}.csv")
    return ucdp.normalise(ucdp.read_landed(spark, f"{folder}/ged"), _wh(spark, sf_dir).dim_country).select(*_PICKED["ucdp"])


@_same_result("world_bank_files", "world_bank_normalise")
def q_world_bank_files(spark, sf_dir):
    """One folder an indicator, JSON pages in it."""
    folder = _folder(spark, "wb")
    rows = raw._world_bank_raw_df(spark, sf_dir)
    for code in ("SP.POP.TOTL", "MS.MIL.XPND.GD.ZS", "NY.GDP.PCAP.CD"):
        one = rows.where(F.col("indicator_code") == code).select("countryiso3code", "country", "date", "value", "unit")
        _pages(one, F.struct("*"), ("[", "]")).write.option("maxRecordsPerFile", 1).text(f"{folder}/_{code}")
        _renamed(spark, f"{folder}/_{code}", f"{folder}/wb/{code}", "page_{:03d}.json")
    found = world_bank.normalise(world_bank.read(spark, f"{folder}/wb"), _wh(spark, sf_dir).dim_country)
    return found.select("country_iso3", "period_start", "indicator_code", "indicator_name", "value", "unit")


@_same_result("gdelt_files", "gdelt_normalise")
def q_gdelt_files(spark, sf_dir):
    """Article lists; of the articles with one id each has the same fields, so the first to arrive is any of them."""
    folder = _folder(spark, "gdelt")
    rows = raw._news_raw_df(spark, sf_dir).select("url", "title", "seendate", "domain", "sourcecountry", "tone")
    lists = rows.groupBy(_page_of(rows).alias("n")).agg(F.collect_list(F.struct(*rows.columns)).alias("articles")).select("articles")
    # The files get their names as they are written, and tasks commit them: the driver names none of them.
    named = {"mapreduce.output.basename": "artlist_", "mapreduce.fileoutputcommitter.algorithm.version": "2"}
    with shuffles_dropped(spark):
        lists.write.options(maxRecordsPerFile=1, ignoreNullFields="false", compression="gzip", **named).json(f"{folder}/gdelt")
    found = gdelt.normalise(gdelt.read(spark, f"{folder}/gdelt"), _wh(spark, sf_dir).dim_country)
    return found.select("item_id", F.col("published_at_utc").cast("timestamp_ntz").alias("published_at_utc"), "country_focus_iso3", "url", "topic_tags", "tone")


@_same_result("ofac_files", "ofac_normalise")
def q_ofac_files(spark, sf_dir):
    """The headerless list in its own encoding."""
    path = _csv(raw._sdn_raw_df(spark, sf_dir), f"{_folder(spark, 'ofac')}/sdn.csv", header=False, encoding="ISO-8859-1")
    return ofac.normalise(ofac.read(spark, path), RUN_DATE).select(*_PICKED["ofac"])


@_same_result("seed_files", "seed_normalise")
def q_seed_files(spark, sf_dir):
    """The curated catalog's file."""
    path = _csv(raw._seed_raw_df(spark, sf_dir), f"{_folder(spark, 'seed')}/diplomatic_events.csv")
    return seed.normalise(seed.read(spark, path)).select(*_PICKED["seed"])


# ---------------------------------------------------------------------------
# Loads (K1–K4, K6, K7, K12, S12)
# ---------------------------------------------------------------------------

_ACTION_ID = _make_id_sql("'USA'", "'IRN'", "strftime(o_orderdate, '%Y-%m-%d 00:00:00')", "'sanction'", "concat('I', cast(o_orderkey AS varchar))")


def _order_actions(spark, sf_dir, status, note=None, when=None) -> DataFrame:
    o = fixtures.read_table(spark, sf_dir, "orders")
    o = o.where(when) if when is not None else o
    cols = {"action_date": F.date_format("o_orderdate", "yyyy-MM-dd"), "actor_iso3": F.lit("USA"), "target_iso3": F.lit("IRN"), "action_type": F.lit("sanction"),
            "instrument_name": F.concat(F.lit("I"), F.col("o_orderkey").cast("string")), "status": status}
    return o.select(*[c.alias(n) for n, c in cols.items()], *([note.alias("notes")] if note is not None else []))


@register("runner_upsert", f"""
SELECT {_ACTION_ID} AS action_id,
       CASE WHEN o_orderkey % 3 = 0 THEN 'third' WHEN o_orderkey % 50 = 0 THEN 'first' ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 50 = 0 THEN 'short file' ELSE concat('n', cast(o_orderkey AS varchar)) END AS notes
FROM orders""")
def q_runner_upsert(spark, sf_dir):
    """K1–K3: every order in a long file, some of them in a short file that arrives before it (the first
    one wins), then a delivery of a third of them that lacks a column (its stored values stay)."""
    folder, wh = _folder(spark, "upsert"), _warehouse(spark, "upsert")
    spec = runner.SourceSpec("SEED", "fact_diplomatic_action", lambda s: True, lambda s: seed.normalise(seed.read(s, f"{folder}/{spec_files[0]}")))
    spec_files = ["first*"]
    key = F.col("o_orderkey")
    _csv(_order_actions(spark, sf_dir, F.lit("first"), F.lit("short file"), key % 50 == 0).coalesce(1), f"{folder}/first_1.csv")
    _csv(_order_actions(spark, sf_dir, F.col("o_orderstatus"), F.concat(F.lit("n"), key.cast("string"))), f"{folder}/first_2.csv")
    _csv(_order_actions(spark, sf_dir, F.lit("third"), None, key % 3 == 0), f"{folder}/second.csv")
    for files in ("first*", "second*"):
        spec_files[0] = files
        runner.run_source(spark, spec, wh)
    return wh.read("fact_diplomatic_action").select("action_id", "status", "notes")


def _weekly_rows(spark, sf_dir, source: str, when=None) -> DataFrame:
    """An incident per order, as a normaliser gives it."""
    o = fixtures.read_table(spark, sf_dir, "orders")
    o = o.where(when) if when is not None else o
    key = F.col("o_orderkey").cast("string")
    return o.select(F.concat(F.lit(f"{source}-"), key).alias("incident_id"), F.lit(source).alias("source_system"), key.alias("source_event_id"),
                    F.col("o_orderdate").cast("date").alias("event_date"), F.col("o_orderpriority").alias("event_type"),
                    F.floor(F.col("o_totalprice") / 1000).cast("int").alias("event_count"))


@register("runner_replace", """
SELECT concat('UCDP_GED-', cast(o_orderkey AS varchar)) AS incident_id, 'UCDP_GED' AS source_system, cast(floor(o_totalprice / 1000) AS int) AS event_count FROM orders
UNION ALL
SELECT concat('ACLED-', cast(o_orderkey AS varchar)), 'ACLED', cast(floor(o_totalprice / 1000) AS int) FROM orders WHERE o_orderstatus <> 'F'""")
def q_runner_replace(spark, sf_dir):
    """K4: two sources of every order, then one of them delivered anew without the finished orders: these go,
    the other source's partition keeps its files."""
    wh = _warehouse(spark, "replace")
    mk = lambda source, when=None: runner.SourceSpec(source, "fact_incident", lambda s: True, lambda s: _weekly_rows(s, sf_dir, source, when),
                                                     source if source == "ACLED" else None, ["source_system"])
    runner.run(spark, [mk("UCDP_GED"), mk("ACLED"), mk("ACLED", F.col("o_orderstatus") != "F")], wh)
    return wh.read("fact_incident").select("incident_id", "source_system", "event_count")


@register("landing_load", """
SELECT 'fact_incident' AS table_name, (SELECT count(*) FROM orders) + (SELECT count(DISTINCT l_orderkey * 10 + l_linenumber) FROM lineitem WHERE l_linenumber <> 7) AS rows
UNION ALL SELECT 'fact_diplomatic_action', (SELECT count(*) FROM orders)
UNION ALL SELECT '_pipeline_state', 3""")
def q_landing_load(spark, sf_dir):
    """Bootstrap, then the wired sources in one call over a landing folder; sources that have not landed are skipped."""
    folder, wh = _folder(spark, "landing"), _warehouse(spark, "landing")
    _renamed(spark, _csv(raw._ucdp_raw_df(spark, sf_dir), f"{folder}/_ged", compression="gzip"), f"{folder}/raw/ucdp_ged", "ged{}.csv.gz")
    _csv(raw._manual_raw_df(spark, sf_dir), f"{folder}/seeds/acled_manual_2026.csv", compression="gzip")
    _csv(_order_actions(spark, sf_dir, F.col("o_orderstatus"), F.lit("n")), f"{folder}/seeds/diplomatic_events.csv", compression="gzip")
    runner.bootstrap(spark, wh)
    runner.run(spark, runner.default_specs(runner.Landing(f"{folder}/raw", f"{folder}/seeds"), _wh(spark, sf_dir).dim_country, RUN_DATE), wh)
    counted = [wh.read(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows") for t in ("fact_incident", "fact_diplomatic_action", "_pipeline_state")]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _loaded_fixtures(spark, sf_dir, name: str) -> Warehouse:
    wh, tables = _warehouse(spark, name), _wh(spark, sf_dir)
    runner.bootstrap(spark, wh)
    for table, keys in (("fact_incident", ["incident_id"]), ("fact_diplomatic_action", ["action_id"]), ("fact_risk_indicator", ["country_iso3", "period_start", "indicator_code"]),
                        ("fact_news_pulse", ["item_id"])):
        rows = getattr(tables, table)
        rows = rows.withColumn("published_at_utc", F.col("published_at_utc").cast("timestamp")) if table == "fact_news_pulse" else rows
        wh.load(table, rows, keys, runner.PARTITIONS.get(table, ()))
    return wh


@_same_result("grs_view", "grs_monthly")
def q_grs_view(spark, sf_dir):
    """K7, G1: the score read from the persistent view of a bootstrapped catalog warehouse; no job but the query's own."""
    from riskfabric.catalog import _GRS_COLS, r6

    wh = _loaded_fixtures(spark, sf_dir, "grs")
    return r6(spark.table(wh.name("grs_monthly")), *_GRS_COLS)


@register("kept_week_agg", with_fixtures("""
SELECT week_start, country_iso3, region_code, event_type, cast(sum(ec) AS bigint) AS incident_count, cast(sum(fb) AS bigint) AS fatalities_total,
       cast(sum(civ) AS bigint) AS civilian_incidents, count(DISTINCT source_system) AS source_count
FROM (
  SELECT cast(date_trunc('week', event_date) AS date) AS week_start, country_iso3, region_code, event_type, source_system,
         CASE WHEN source_system = 'ACLED' THEN coalesce(event_count, 1) + 1 ELSE coalesce(event_count, 1) END AS ec, fatalities_best AS fb,
         CASE WHEN NOT coalesce(civilian_targeting, false) THEN 0 WHEN source_system = 'ACLED' THEN coalesce(event_count, 1) + 1 ELSE coalesce(event_count, 1) END AS civ
  FROM fact_incident) f
GROUP BY ALL""", ["fact_incident"]))
def q_kept_week_agg(spark, sf_dir):
    """A1 kept up: the state is built from the first load of all incidents, then changed by a second one that replaces a source."""
    wh, rows = _warehouse(spark, "kept"), fixtures.fact_incident(spark, sf_dir)
    view = kept.kept_views()[0]
    wh.load("fact_incident", rows, ["incident_id"], ["source_system"])
    kept.refresh(wh, view, ["source_system"])
    more = rows.where("source_system = 'ACLED'").withColumn("event_count", F.coalesce("event_count", F.lit(1)) + 1)
    wh.load("fact_incident", more, ["incident_id"], ["source_system"], ("source_system", "ACLED"))
    return kept.refresh(wh, view, ["source_system"])


# ---------------------------------------------------------------------------
# Streams (I1, I2)
# ---------------------------------------------------------------------------

_CORRECTED = """
SELECT cast(ts + CASE WHEN event_id % 10 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS date) AS day, event_type, count(*) AS events,
       count(DISTINCT user_id) AS users, round(sum(CASE WHEN event_id % 10 = 0 THEN value + 1 ELSE value END), 6) AS value_total
FROM events GROUP BY 1, 2"""


def _deliveries(spark, sf_dir, name: str) -> str:
    """All events, then all of them again, then corrections that move a tenth of them by a day."""
    folder, e = _folder(spark, name), fixtures.read_table(spark, sf_dir, "events")
    for part in ("d1", "d2"):
        _renamed(spark, _written(e, f"{folder}/_{part}"), f"{folder}/events", part + "_{:05d}.parquet")
    moved = e.where("event_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")).withColumn("value", F.col("value") + 1)
    _renamed(spark, _written(moved, f"{folder}/_d3"), f"{folder}/events", "d3_{:05d}.parquet")
    return f"{folder}/events"


def _written(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path


@register("stream_redelivery", _CORRECTED)
def q_stream_redelivery(spark, sf_dir):
    """A file stream upserts micro-batch by micro-batch into a catalog table whose key index finds the days that lose a row."""
    folder, wh = _deliveries(spark, sf_dir, "redelivery"), _warehouse(spark, "redelivery")
    options = {"partition_by": ["event_day"], "transform": ingest.with_event_day, "checkpoint": _folder(spark, "ckpt")}
    for part in ("d1", "d2", "d3"):
        ingest.ingest_files(spark, folder, ingest.EVENTS, (wh, "events"), ["event_id"], options={"pathGlobFilter": f"{part}_*"}, **options)
    return ingest.daily_event_summary(wh.read("events"))


@register("stream_state", _CORRECTED)
def q_stream_state(spark, sf_dir):
    """The same deliveries through keyed state: redelivered events change nothing, corrections name the day that they leave."""
    folder, wh = _deliveries(spark, sf_dir, "state"), _warehouse(spark, "state")
    ckpt = _folder(spark, "ckpt")
    for part in ("d1", "d2", "d3"):
        latest.ingest_latest(spark, folder, ingest.EVENTS, wh, "events", ["event_id"], "event_day", transform=ingest.with_event_day, checkpoint=ckpt,
                             options={"pathGlobFilter": f"{part}_*"})
    return ingest.daily_event_summary(wh.read("events"))


# ---------------------------------------------------------------------------
# Joins (J1, J11)
# ---------------------------------------------------------------------------


@_same_result("asof_population_ranged", "asof_population_bucketed")
def q_asof_population_ranged(spark, sf_dir):
    """J1 as a segmented prefix scan (the plan for a right side beyond the broadcast limit)."""
    from riskfabric.catalog import r6

    wh = _wh(spark, sf_dir)
    return r6(grs.conflict_base(wh.fact_incident, wh.fact_risk_indicator, strategy="ranged"), "incident_rate_100k", "fatality_rate_100k")


#: A customer's country in one of six spellings, by the customer's number.
_SPELT = """CASE c_custkey % 6 WHEN 0 THEN lower(n_name) WHEN 1 THEN concat('Republic of ', n_name) WHEN 2 THEN substring(n_name, 2, length(n_name) - 2)
            WHEN 3 THEN concat(n_name, ' (the)') WHEN 4 THEN concat('land ', cast(c_nationkey AS {s})) ELSE concat(substring(n_name, 1, 3), 'qz') END"""


@register("name_lookup_forms", """
WITH forms AS (
  SELECT n_nationkey AS k, concat('N', lpad(cast(n_nationkey AS varchar), 2, '0')) AS iso3, lower(n_name) AS name, concat('republic of ', lower(n_name)) AS official,
         concat('land ', cast(n_nationkey AS varchar)) AS alias FROM nation
), raw AS (SELECT c_custkey, """ + _SPELT.format(s="varchar") + """ AS country FROM customer JOIN nation ON c_nationkey = n_nationkey),
probes AS (SELECT DISTINCT country, lower(trim(country)) AS p FROM raw),
spelt AS (SELECT iso3, name AS form, 0 AS rank FROM forms UNION ALL SELECT iso3, official, 1 FROM forms UNION ALL SELECT iso3, alias, 2 FROM forms),
overridden AS (SELECT p, o.iso3 FROM probes JOIN (SELECT * FROM """ + raw.OVERRIDES_SQL + """) o ON o.name = p),
exact AS (SELECT p, min(struct_pack(r := rank, i := iso3)).i AS iso3 FROM probes JOIN spelt ON form = p GROUP BY p),
within AS (
  SELECT p, min(struct_pack(s := -points, i := iso3)).i AS iso3 FROM (
    SELECT p, iso3, sum(greatest(5, 30 - 2 * (strpos(form, p) - 1))) AS points FROM probes JOIN spelt ON contains(form, p) GROUP BY p, iso3) GROUP BY p
), words AS (SELECT form, iso3, unnest(list_distinct(list_filter(string_split_regex(form, '[^a-z0-9]+'), lambda w: w <> ''))) AS w FROM spelt),
idf AS (SELECT w, ln(((SELECT count(*) FROM spelt) + 1) / count(*)) AS f FROM words GROUP BY w),
asked AS (SELECT p, w, coalesce(f, ln((SELECT count(*) FROM spelt) + 1)) AS f
          FROM (SELECT DISTINCT p, unnest(list_filter(string_split_regex(p, '[^a-z0-9]+'), lambda w: w <> '')) AS w FROM probes) q LEFT JOIN idf USING (w)),
shares AS (
  SELECT p, iso3, round(common / (pw + fw - common), 9) AS share FROM (
    SELECT a.p, x.form, x.iso3, sum(a.f) AS common FROM asked a JOIN words x ON x.w = a.w GROUP BY 1, 2, 3) c
  JOIN (SELECT p, sum(f) AS pw FROM asked GROUP BY p) USING (p)
  JOIN (SELECT form, iso3, sum(f) AS fw FROM words JOIN idf USING (w) GROUP BY 1, 2) USING (form, iso3)
), by_words AS (SELECT p, min(struct_pack(s := -share, i := iso3)).i AS iso3 FROM shares WHERE share >= 0.6 GROUP BY p),
edits AS (SELECT p, min(struct_pack(d := levenshtein(p, name), i := iso3)).i AS iso3 FROM probes JOIN forms ON levenshtein(p, name) <= 2 GROUP BY p)
SELECT c_custkey, r.country, coalesce(v.iso3, e.iso3, h.iso3, b.iso3, d.iso3) AS country_iso3,
       CASE WHEN v.iso3 IS NOT NULL THEN 'override' WHEN e.iso3 IS NOT NULL THEN 'exact' WHEN h.iso3 IS NOT NULL THEN 'within' WHEN b.iso3 IS NOT NULL THEN 'words'
            WHEN d.iso3 IS NOT NULL THEN 'edits' END AS how
FROM raw r JOIN probes q ON q.country = r.country LEFT JOIN overridden v ON v.p = q.p LEFT JOIN exact e ON e.p = q.p LEFT JOIN within h ON h.p = q.p
LEFT JOIN by_words b ON b.p = q.p LEFT JOIN edits d ON d.p = q.p""")
def q_name_lookup_forms(spark, sf_dir):
    """Every customer's country in one of several spellings, by name forms, names within names, rare words and edits."""
    n = fixtures.read_table(spark, sf_dir, "nation")
    code = fixtures.nation_code(F.col("n_nationkey"))
    countries = n.select(code.alias("iso3"), F.col("n_name").alias("name"), F.concat(F.lit("Republic of "), "n_name").alias("official_name"))
    aliases = n.select(code.alias("iso3"), F.concat(F.lit("land "), F.col("n_nationkey").cast("string")).alias("alias"))
    c = fixtures.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", F.expr(_SPELT.format(s="string")).alias("country"))
    # Codes as probes are another query's; here only spelt forms are asked for.
    found = names.resolve(rows, "country", countries, overrides_df(spark), aliases).withColumnRenamed("raw", "country")
    return rows.join(found, "country", "left").select("c_custkey", "country", F.col("iso3").alias("country_iso3"), "how")
