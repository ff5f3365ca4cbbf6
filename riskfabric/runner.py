"""Per-source ETL runner.

``run_source`` = availability gate → read landing files → normalise → replace
(by source system) or upsert (by key) → commit → one state row. An error while
normalising or loading marks the source ``failed`` and the run moves on; an
empty result is ``partial``; an unavailable source writes no state row.

All work is Spark jobs; the driver only handles file listing (metadata), the
decision of which writer to use and the one-row state upsert.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskfabric import schemas
from riskfabric.functions import ids
from riskfabric.operators import store
from riskfabric.operators.versioned import COMPRESSION, Warehouse
from riskfabric.plans import sql
from riskfabric.session import drop_materialized, materialize, shuffles_dropped
from riskfabric.sources import acled, acled_manual, gdelt, ofac, seed, ucdp, world_bank

log = logging.getLogger(__name__)

# Date column whose maximum is recorded as the last ingested date, per table.
LAST_DATE_COLUMN = {
    "fact_incident": "event_date",
    "fact_diplomatic_action": "action_date",
    "fact_risk_indicator": "period_start",
    "fact_news_pulse": "published_at_utc",
}


@dataclass
class SourceSpec:
    """One source: whether it has landed, how its rows are built, and where they go.

    ``observed`` builds the rows like ``build`` and counts on the same pass what it reads and drops;
    ``verify`` gets these counts and raises where the source's rules are broken. With ``unique`` a key
    that the batch holds twice is an error, too.
    """

    name: str
    table: str
    available: Callable[[SparkSession], bool]
    build: Callable[[SparkSession], DataFrame | None] | None = None
    replace_source_system: str | None = None
    partition_by: list[str] = field(default_factory=list)
    observed: Callable[[SparkSession, Observation], DataFrame | None] | None = None
    verify: Callable[[dict], None] | None = None
    unique: bool = False


@dataclass
class RunResult:
    name: str
    status: str
    input_rows: int = 0
    #: Counts of the pass that read the files, ``dropped`` among them (a task that ran twice may count twice).
    counts: dict[str, int] = field(default_factory=dict)


def tables_at(spark: SparkSession, warehouse: str | Warehouse) -> store.PathTables | Warehouse:
    """A folder's tables, or a catalog warehouse as it is."""
    return store.PathTables(spark, warehouse) if isinstance(warehouse, str) else warehouse


def stage(spark: SparkSession, spec: SourceSpec) -> tuple[DataFrame | None, dict[str, int]]:
    """The source's batch, read once and written: one row a key (the first to arrive), ``_rows`` of each, and the counts."""
    seen = Observation(f"load-{spec.name}")
    batch = spec.observed(spark, seen) if spec.observed else spec.build(spark)
    if batch is None:
        return None, {}
    # Columns that the source lacks stay out, so that stored values survive.
    batch = schemas.present(batch, spec.table)
    if schemas.ARRIVAL not in batch.columns:  # rows that no reader has numbered come in the order of their partitions
        batch = batch.withColumn(schemas.ARRIVAL, F.monotonically_increasing_id())
    if spec.table in schemas.STAMPED and "ingested_at_utc" not in batch.columns:
        batch = batch.withColumn("ingested_at_utc", F.current_timestamp())
    keys = schemas.PRIMARY_KEYS[spec.table]
    if schemas.KEY_TEXT in batch.columns:
        # Rows with one id have one text; moved by it, they leave their ids behind and stand beside like ones.
        columns = [c for c in batch.columns if c not in (schemas.KEY_TEXT, schemas.ARRIVAL)]
        batch = store.dedupe_first(batch.drop(*keys), [schemas.KEY_TEXT], [schemas.ARRIVAL], count_as="_rows")
        batch = batch.withColumn(keys[0], ids.make_id(schemas.KEY_TEXT)).select(*columns, "_rows")
    else:
        batch = store.dedupe_first(batch, keys, [schemas.ARRIVAL], count_as="_rows").drop(schemas.ARRIVAL)
    batch = materialize(batch, f"batch-{spec.name.lower()}", COMPRESSION)
    counts = dict(seen.get) if spec.observed else {}
    if spec.verify:
        spec.verify(counts)
    if spec.unique:
        twice = batch.where("_rows > 1").count()
        if twice:
            raise ValueError(f"{spec.name}: {twice} keys occur more than once in {batch.inputFiles()[0].rsplit('/', 1)[0]}")
    return batch, counts


def run_source(spark: SparkSession, spec: SourceSpec, warehouse: str | Warehouse, run_ts: _dt.datetime | None = None) -> RunResult | None:
    """Run one source into its table of the warehouse and upsert its state row."""
    if not spec.available(spark):
        log.warning("%s skipped (source unavailable)", spec.name)
        return None
    with shuffles_dropped(spark):
        return _run_source(spark, spec, tables_at(spark, warehouse), run_ts)


def _run_source(spark: SparkSession, spec: SourceSpec, tables: store.PathTables | Warehouse, run_ts: _dt.datetime | None) -> RunResult:
    try:
        batch, counts = stage(spark, spec)
        last_col = LAST_DATE_COLUMN.get(spec.table)
        n, last = 0, None
        if batch is not None:
            last_date = F.max(F.col(last_col).cast("date")) if last_col else F.lit(None).cast("date")
            n, last = batch.agg(F.coalesce(F.sum("_rows"), F.lit(0)), last_date).first()
        if "rows_read" in counts:
            counts["dropped"] = counts["rows_read"] - n
        if n == 0:
            _write_state(spark, tables, spec.name, 0, None, "partial", run_ts)
            return RunResult(spec.name, "partial", 0, counts)
        replaced = ("source_system", spec.replace_source_system) if spec.replace_source_system else None
        tables.load(spec.table, batch.drop("_rows"), schemas.PRIMARY_KEYS[spec.table], spec.partition_by, replaced, stored=True)
        drop_materialized(batch)
        _write_state(spark, tables, spec.name, n, last, "success", run_ts)
        log.info("%s: %d rows, %s", spec.name, n, counts)
        return RunResult(spec.name, "success", n, counts)
    except Exception:  # noqa: BLE001 — the error isolates to this source
        log.exception("%s failed", spec.name)
        _write_state(spark, tables, spec.name, 0, None, "failed", run_ts)
        return RunResult(spec.name, "failed", 0)


def _write_state(spark, tables, name, n, last, status, run_ts) -> None:
    tables.load("_pipeline_state", store.state_row(spark, name, n, last, status, run_ts), ["source_name"])


def run(spark: SparkSession, specs: list[SourceSpec], warehouse: str | Warehouse) -> list[RunResult]:
    """Sources in order; one state row each (K12). Returns the per-source results."""
    out = []
    for spec in specs:
        r = run_source(spark, spec, warehouse)
        if r is not None:
            out.append(r)
    return out


def table_counts(spark: SparkSession, warehouse: str | Warehouse) -> DataFrame:
    """Post-run row counts of the fact tables."""
    tables = tables_at(spark, warehouse)
    return store.table_counts({t: tables.read(t) for t in LAST_DATE_COLUMN})


def bootstrap(spark: SparkSession, warehouse: str | Warehouse, iso_countries: DataFrame | None = None) -> list[str]:
    """Create every canonical table that is absent (empty, typed) and seed the dimensions with
    insert-or-ignore (K7, K5); a catalog warehouse gets the aggregate and score views, too.

    ``iso_countries`` (alpha_3, alpha_2, name) adds the ISO list to the country dimension.
    Returns the tables created or seeded.
    """
    from riskfabric.sources import dims

    tables = tables_at(spark, warehouse)
    iso = iso_countries if iso_countries is not None else spark.createDataFrame([], "alpha_3 string, alpha_2 string, name string")
    countries = dims.seed_countries(iso, dims.region_map(spark), dims.special_countries(spark))
    seeds = {"dim_region": dims.regions(spark), "dim_country": countries, "dim_source_system": dims.source_systems(spark),
             "dim_event_type": dims.event_types(spark), "dim_date": dims.calendar(spark)}
    touched = []
    for table, schema in schemas.TABLES.items():
        rows = seeds.get(table)
        if rows is not None:
            keys = schemas.PRIMARY_KEYS[table]
            rows = schemas.conform(rows, table).join(tables.read(table).select(*keys), keys, "left_anti")
            tables.load(table, materialize(rows, f"seed-{table}"), keys)
            touched.append(table)
        elif not tables.exists(table):
            tables.load(table, spark.createDataFrame([], schema), schemas.PRIMARY_KEYS[table], PARTITIONS.get(table, ()) if isinstance(tables, Warehouse) else ())
            touched.append(table)
    if isinstance(tables, Warehouse):
        for name, statement in sql.VIEWS.items():
            tables.view(name, statement)
    return touched


@dataclass
class Landing:
    """Where the sources' files land: ``raw`` for downloads, ``seeds`` for files kept by hand."""

    raw: str
    seeds: str
    manual: str = "acled_manual_*.csv"
    curated: str = "diplomatic_events*.csv"


#: Partition columns of the fact tables in a catalog warehouse.
PARTITIONS = {"fact_incident": ["source_system"]}


def default_specs(landing: Landing, countries: DataFrame, run_date: _dt.date | str, fuzzy: bool = False) -> list[SourceSpec]:
    """The seven sources in load order: conflict events, weekly aggregates, the manual backfill,
    indicators, sanctions, the curated catalog, news."""
    raw, seeds = landing.raw.rstrip("/"), landing.seeds.rstrip("/")
    manual, curated = f"{seeds}/{landing.manual}", f"{seeds}/{landing.curated}"

    def some(pattern: str) -> Callable[[SparkSession], bool]:
        return lambda s: store.path_exists(s, pattern)

    return [
        SourceSpec("UCDP", "fact_incident", lambda s: bool(ucdp.landed(s, f"{raw}/ucdp_ged")), partition_by=PARTITIONS["fact_incident"],
                   observed=lambda s, o: ucdp.normalise(ucdp.read_landed(s, f"{raw}/ucdp_ged"), countries, fuzzy=fuzzy, seen=o)),
        SourceSpec("ACLED", "fact_incident", lambda s: bool(acled.regional_files(s, f"{raw}/acled")), None, acled.SOURCE, PARTITIONS["fact_incident"],
                   observed=lambda s, o: acled.normalise(acled.read(s, f"{raw}/acled"), countries, fuzzy=fuzzy, seen=o)),
        SourceSpec("ACLED_MANUAL", "fact_incident", some(manual), None, acled_manual.SOURCE, PARTITIONS["fact_incident"],
                   observed=lambda s, o: acled_manual.normalise(acled_manual.read(s, manual), seen=o), verify=acled_manual.verify, unique=True),
        SourceSpec("WB", "fact_risk_indicator", some(f"{raw}/world_bank/*/page_*.json"),
                   observed=lambda s, o: world_bank.normalise(world_bank.read(s, f"{raw}/world_bank"), countries, seen=o)),
        SourceSpec("OFAC", "fact_diplomatic_action", some(f"{raw}/ofac/sdn.csv"), lambda s: ofac.normalise(ofac.read(s, f"{raw}/ofac/sdn.csv"), run_date)),
        SourceSpec("SEED", "fact_diplomatic_action", some(curated), lambda s: seed.normalise(seed.read(s, curated))),
        SourceSpec("GDELT", "fact_news_pulse", some(f"{raw}/gdelt/{gdelt.FILES}"),
                   lambda s: gdelt.normalise(gdelt.read(s, f"{raw}/gdelt"), countries)),
    ]


def validate_news_range(sources: list[str], start: _dt.date | None, end: _dt.date | None,
                        today: _dt.date | None = None, window_days: int = 90) -> tuple[_dt.date, _dt.date] | None:
    """News date-range rules (I4): none given → last ``window_days`` ending today; an end needs a
    start; a start alone runs to today; start ≤ end; dates need the news source selected."""
    today = today or _dt.date.today()
    if start is None and end is None:
        return (today - _dt.timedelta(days=window_days - 1), today) if "gdelt" in sources else None
    if "gdelt" not in sources:
        raise ValueError("news date arguments require the news source to be selected")
    if start is None:
        raise ValueError("an end date requires a start date")
    end = end or today
    if start > end:
        raise ValueError("start date cannot be after end date")
    return start, end
