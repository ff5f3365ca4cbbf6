"""Key-based table maintenance on plain parquet.

Spark has no primary-key constraint and plain parquet rejects MERGE, so the
merge semantics are DataFrame operations and the write is a staged, partition
-scoped overwrite:

* ``dedupe_first`` — keep the first row per key by an explicit order. Built as a
  ``min(struct(order, payload))`` aggregate, so map-side partial aggregation
  collapses a hot key before the shuffle (no per-key window, no group in one task).
* ``upsert`` — INSERT OR REPLACE: stage rows replace target rows with the same
  key; target columns *absent* from the stage keep their old value on replaced
  rows and take the table default on new rows; columns present in the stage
  overwrite, NULLs included.
* ``replace_source`` — delete one source's rows, then upsert, as one merged
  result that is committed in a single write.
* ``insert_ignore`` — existing rows win; first row wins inside the batch.
* ``commit_table`` — write the merged rows to a staging folder under the shared
  checkpoint directory (cuts lineage; survives executor loss), then overwrite only
  the partitions the batch touched (``partitionOverwriteMode=dynamic``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfabric import schemas
from riskfabric.operators.lookup import _bounded
from riskfabric.session import scratch_path


def _order_struct(order_cols: list[Column | str]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])


def dedupe_first(df: DataFrame, keys: list[str], order_cols: list[Column | str], count_as: str | None = None) -> DataFrame:
    """First row per key by ``order_cols`` (ascending; later columns break ties); ``count_as`` adds the key's rows."""
    payload = [c for c in df.columns if c not in keys]
    packed = F.struct(_order_struct(order_cols).alias("o"), F.struct(*payload).alias("p"))
    rows = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    g = df.groupBy(*keys).agg(F.min(packed).alias("_first"), *rows)
    return g.select(*keys, *[F.col(f"_first.p.{c}").alias(c) for c in payload], *g.columns[len(keys) + 1:]).select(
        *df.columns, *g.columns[len(keys) + 1:])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def upsert(target: DataFrame, stage: DataFrame, keys: list[str], table: str | None = None,
           order_cols: list[Column | str] | None = None) -> DataFrame:
    """Merged table rows after INSERT OR REPLACE of ``stage`` into ``target`` on ``keys``.

    One full outer join on the keys: each side is read and shuffled once. ``order_cols`` resolves
    in-batch key collisions (first row wins); without it the stage keys must be unique. ``table`` names the canonical table whose
    defaults apply to new rows for columns missing from the stage.
    """
    if order_cols is not None:
        stage = dedupe_first(stage, keys, order_cols)
    types = dict(target.dtypes)
    given = [c for c in target.columns if c in stage.columns]
    new = stage.select(*[F.col(c).cast(types[c]).alias(f"_new_{c}") for c in given], F.lit(True).alias("_is_new"))
    old = target.withColumn("_is_old", F.lit(True))
    both = old.join(new, [F.col(k) == F.col(f"_new_{k}") for k in keys], "full_outer")

    def merged(c: str) -> Column:
        if c in given:
            return F.when(F.col("_is_new"), F.col(f"_new_{c}")).otherwise(F.col(c))
        return F.when(F.col("_is_old").isNull(), _default(table, c).cast(types[c])).otherwise(F.col(c))

    return both.select(*[merged(c).alias(c) for c in target.columns])


def _default(table: str | None, column: str) -> Column:
    """What a new row gets in a column that its stage lacks."""
    return F.current_timestamp() if column == "ingested_at_utc" else F.lit(schemas.COLUMN_DEFAULTS.get(table or "", {}).get(column))


def inserted(schema: T.StructType, stage: DataFrame, table: str | None = None) -> DataFrame:
    """``upsert`` into a target of this schema that has no rows: no join."""
    return stage.select(*[(F.col(f.name) if f.name in stage.columns else _default(table, f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def evolve_event_count(fact_incident: DataFrame) -> DataFrame:
    """Column evolution (K8): add ``event_count`` when absent and backfill NULL → 1."""
    if "event_count" not in fact_incident.columns:
        return fact_incident.withColumn("event_count", F.lit(1).cast("int"))
    return fact_incident.withColumn("event_count", F.coalesce(F.col("event_count"), F.lit(1)).cast("int"))


def replace_source(target: DataFrame, stage: DataFrame, keys: list[str], source_col: str, source: str,
                   table: str | None = None, order_cols: list[Column | str] | None = None) -> DataFrame:
    """Delete ``source_col = source`` rows (NULL sources are kept), then upsert the stage (K4)."""
    rest = target.where(~F.col(source_col).eqNullSafe(F.lit(source)))
    return upsert(rest, stage, keys, table, order_cols)


def touched_partitions(target: DataFrame, stage: DataFrame, keys: list[str], partition_by: list[str],
                       source: tuple[str, str] | None = None) -> DataFrame:
    """Distinct partition values a batch touches: those it writes to, those in which the target
    holds one of its keys (a row that moves leaves its old partition), and, with ``source``
    (column, value), those with rows of a source that is replaced. Nothing is collected."""
    parts = stage.select(*partition_by)
    held = target.join(stage.select(*keys).distinct(), keys, "left_semi").select(*partition_by)
    parts = parts.union(held)
    if source is not None:
        parts = parts.union(target.where(F.col(source[0]) == source[1]).select(*partition_by))
    return parts.distinct()


def in_partitions(target: DataFrame, parts: DataFrame) -> DataFrame:
    """Target rows of the given partitions (NULL-safe); a join on partition columns, so that Spark prunes them at run time."""
    p = parts.select(*[F.col(c).alias(f"_part_{c}") for c in parts.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_part_{c}")) for c in parts.columns]
    return target.join(p, on, "left_semi")


def insert_ignore(target: DataFrame, stage: DataFrame, keys: list[str],
                  order_cols: list[Column | str] | None = None) -> DataFrame:
    """Existing rows win; within the batch the first row by ``order_cols`` wins (K5)."""
    if order_cols is not None:
        stage = dedupe_first(stage, keys, order_cols)
    stage = stage.select(*target.columns)
    new = stage.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def state_row(spark: SparkSession, source_name: str, records: int, last_date=None, status: str = "success",
              run_ts=None) -> DataFrame:
    """A one-row ``_pipeline_state`` DataFrame (K6); upsert it with key ``source_name``."""
    import datetime as dt

    ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame([(source_name, ts, last_date, int(records), status)], schemas.PIPELINE_STATE)


def backfill_region_dim(dim_country: DataFrame, mapping: DataFrame, order_col: str | None = None) -> DataFrame:
    """Fill NULL ``region_code`` in the country dimension from an (iso3, region_code) mapping (K9).

    With duplicate iso3 in the mapping the *last* row by ``order_col`` wins. Only
    NULL regions change.
    """
    m = mapping.select("iso3", F.col("region_code").alias("_map_region"),
                       *( [F.col(order_col).alias("_ord")] if order_col else []))
    if order_col:
        m = dedupe_first(m.withColumn("_neg", -F.col("_ord")), ["iso3"], ["_neg"]).drop("_neg", "_ord")
    j = dim_country.join(m, "iso3", "left")
    return j.withColumn("region_code", F.coalesce("region_code", "_map_region")).select(*dim_country.columns)


def backfill_region_fact(fact: DataFrame, dim_country: DataFrame, key: str = "country_iso3") -> DataFrame:
    """Fill NULL ``region_code`` on a fact from the country dimension."""
    # A country dimension has a few hundred rows, one a country, and is broadcast after a check of its
    # size: hashing the fact on the country would put a large country's rows into one task.
    d = _bounded(dim_country.select(F.col("iso3").alias("_bf_iso3"), F.col("region_code").alias("_bf_region")))
    j = fact.join(d, F.col(key) == F.col("_bf_iso3"), "left")
    return j.withColumn("region_code", F.coalesce(F.col("region_code"), F.col("_bf_region"))).select(*fact.columns)


def backfill_report(dim_country: DataFrame, fact: DataFrame) -> DataFrame:
    """Assigned/total region counts for the dimension and the fact."""
    d = dim_country.agg(F.count("region_code").alias("dim_assigned"), F.count(F.lit(1)).alias("dim_total"))
    f = fact.agg(F.struct(F.count("region_code").alias("a"), F.count(F.lit(1)).alias("t")).alias("s")).scalar()
    d = d.withColumn("_f", f)   # the subquery is projected once, then read field by field
    return d.select("dim_assigned", "dim_total", F.col("_f.a").alias("fact_assigned"), F.col("_f.t").alias("fact_total"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table as one DataFrame (K13); one aggregate job per table, no driver loop over rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Physical commit
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a canonical table, or an empty one of the right schema when it is absent."""
    try:
        return schemas.conform(spark.read.schema(schemas.TABLES[table]).parquet(path), table, fill_defaults=False)
    except Exception as e:  # noqa: BLE001 — missing path surfaces as AnalysisException
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return schemas.empty(spark, table)
        raise


def commit_table(spark: SparkSession, merged: DataFrame, path: str, partition_by: list[str] | None = None,
                 touched: DataFrame | None = None) -> int:
    """Stage ``merged`` under the checkpoint folder, then overwrite ``path``.

    With ``partition_by`` only partitions present in the staged rows are
    replaced (dynamic partition overwrite); those of ``touched`` (distinct partition
    values) in which no staged row lands are emptied. Returns the number of staged rows.
    """
    staging = scratch_path(spark, f"staging/{uuid.uuid4().hex}")
    touched_at = scratch_path(spark, f"staging/{uuid.uuid4().hex}")
    w = merged.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(staging)
    staged = spark.read.schema(merged.schema).parquet(staging)
    n = staged.count()
    emptied = []
    if partition_by and touched is not None:
        touched.write.mode("overwrite").parquet(touched_at)  # read before the table changes
        left = spark.read.parquet(touched_at).exceptAll(staged.select(*touched.columns).distinct())
        # Partitions that lose their last row: folder names, one at a time.
        for row in left.select(*[F.col(c).cast("string") for c in partition_by]).toLocalIterator():
            emptied.append("/".join([path.rstrip("/"), *[_partition_folder(c, row[c]) for c in partition_by]]))
    out = staged.write.mode("overwrite")
    if partition_by:
        # per-write option: replace only the partitions present in the staged rows
        out.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    else:
        out.parquet(path)
    for folder in emptied:
        _delete(spark, folder)
    _delete(spark, staging)
    _delete(spark, touched_at)
    return n


class PathTables:
    """Tables as plain parquet folders under ``root``: a load overwrites the partitions that it touches.

    A reader may see a load half done, and finding the partitions that hold a key scans the table's
    keys; ``versioned.Warehouse`` has neither fault and needs a catalog.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table), table)

    def load(self, table: str, batch: DataFrame, keys: list[str], partition_by: list[str] | tuple = (),
             source: tuple[str, str] | None = None, stored: bool = False) -> None:
        """``stored`` is for ``versioned.Warehouse``, which reads the keys of a stored batch several times."""
        target, parts = self.read(table), None
        if partition_by:
            # Merge only inside the partitions this batch touches, so that the scan of the
            # target is pruned to them and the commit rewrites only them.
            parts = touched_partitions(target, batch, keys, list(partition_by), source)
            target = in_partitions(target, parts)
        merged = replace_source(target, batch, keys, *source, table) if source else upsert(target, batch, keys, table)
        commit_table(self.spark, merged, self.path(table), list(partition_by) or None, parts)


def _partition_folder(col: str, value: str | None) -> str:
    """A partition's folder name as Spark writes it: a fixed name for NULL, special characters by their codes."""
    if value is None:
        return f"{col}=__HIVE_DEFAULT_PARTITION__"
    return f"{col}=" + "".join(f"%{ord(c):02X}" if c < " " or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in value)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(p, True)


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Hadoop glob check used by the source availability gate."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st = fs.globStatus(p)
    return st is not None and len(st) > 0
