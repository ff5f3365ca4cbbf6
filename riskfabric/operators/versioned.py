"""Tables as catalog views over versions: atomic loads, a key index, old versions kept (K1, K4, K7).

A table ``t`` of a ``Warehouse`` is a view over its current version, a catalog table of its
own. A load writes the partitions that it touches into a new folder, registers a new version
over them and over the untouched partitions' folders as they are, and then replaces the view:
one catalog operation, which a metastore runs as a transaction. Until it has run, every
reader sees the old rows; a query that has begun keeps reading the old version's files, which stay until
``vacuum``. A load that fails before the switch leaves an unreferenced version behind, nothing else.

*Key index.* A partitioned table whose partition columns aren't part of its key also has, per version,
an index table key → partition, itself partitioned by a hash bucket of the key. A load reads the buckets
that its keys fall into, and so knows the partitions that hold them without a scan of the table; it
rewrites the buckets of those that are new or have moved. Where the catalog shows that a load meets no stored rows, it writes its batch
without a join, and its entries as a run beside the stored ones (``RUNS`` at most a bucket). An entry whose row has gone (a replaced source) only makes a
later load read a partition in vain.

The driver handles partition values and bucket numbers (catalog metadata), never rows. Writers of one
table must take turns; a load that finds another version than it began with raises before the switch.
"""

from __future__ import annotations

import uuid
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfabric import schemas
from riskfabric.operators import store
from riskfabric.session import drop_materialized, materialize, shuffles_dropped

#: Buckets of a key index. A load of few keys reads a share of the index that grows with their number.
BUCKETS = 64
#: Runs of a bucket (one a load) that are read together before a load writes them as one.
RUNS = 8
#: Partition columns of a key index.
_PLACE = ["_run", "_bucket"]
#: Ids are hexadecimal digits, which this codec packs and Spark's usual one doesn't.
COMPRESSION = "zstd"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentLoad(RuntimeError):
    """Another load switched the table while this one was writing."""


def _quoted(*names: str) -> str:
    return ".".join(f"`{n}`" for n in names)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class Warehouse:
    """Tables of the database ``database``, their files under the folder ``root``."""

    def __init__(self, spark: SparkSession, database: str, root: str, buckets: int = BUCKETS):
        self.spark, self.database, self.root, self.buckets = spark, database, root.rstrip("/"), buckets
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{self.root}/_database'")

    # -- reading ---------------------------------------------------------

    def name(self, table: str) -> str:
        return _quoted(self.database, table)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def version(self, table: str) -> str | None:
        """The current version's name; None before the first load."""
        if not self.exists(table):
            return None
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)} ('version')").first()["value"]

    def property(self, table: str, key: str) -> str | None:
        """A property that the current version was given; None without table or property."""
        if not self.exists(table):
            return None
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").where(F.col("key") == key).first()
        return found["value"] if found else None

    def read(self, table: str) -> DataFrame:
        """The current rows; an empty DataFrame of a canonical table before its first load."""
        if not self.exists(table):
            return schemas.empty(self.spark, table)
        return self.spark.table(self.name(table))

    def read_version(self, version: str) -> DataFrame:
        return self.spark.table(self.name(version))

    def versions(self, table: str) -> list[str]:
        """Versions with files, oldest first."""
        found = self.spark.sql(f"SHOW TABLES IN {_quoted(self.database)} LIKE '{table}__v*'")
        return sorted(r["tableName"] for r in found.collect() if not r["tableName"].endswith("_keys"))

    # -- loading ---------------------------------------------------------

    def load(self, table: str, batch: DataFrame, keys: list[str], partition_by: list[str] | tuple = (), source: tuple[str, str] | None = None, moves: DataFrame | None = None, removed: DataFrame | None = None,
             stored: bool = False) -> str:
        """Upsert ``batch`` (unique keys) and return the new version.

        ``source`` (column, value) first deletes that source's rows. ``removed`` has keys
        whose rows go. ``moves`` has the partitions that hold batch keys or removed ones, where the caller
        knows them (then no index is kept or read). An empty text as partition value is NULL, as Spark stores it. Columns that the batch lacks keep their stored values.
        ``stored`` says that the batch is read from files; of another one the keys are written once where they are needed more than once.
        """
        with shuffles_dropped(self.spark):
            return self._load(table, batch, keys, list(partition_by), source, moves, removed, stored)

    def _load(self, table: str, batch: DataFrame, keys: list[str], parts: list[str], source, moves, removed, stored: bool) -> str:
        before = self.version(table)
        batch = _without_blank(batch, parts)
        indexed = bool(parts) and moves is None and not set(parts) <= set(keys)
        if before is None:
            schema = schemas.TABLES[table] if table in schemas.TABLES else batch.schema
            held = {}
        else:
            schema = self.read_version(before).schema
            held = self.partitions(before, parts) if parts else {}
        touched, placed, target, fresh = [], None, None, False
        if held:
            placed = batch.select(*dict.fromkeys([*keys, *parts]))
            if indexed and not stored:
                placed = materialize(placed, f"keys-{table}", COMPRESSION)
            touched = self._touched(before, placed, keys, parts, source, moves, held)
            # Rows that the batch may meet: those of touched partitions that exist and aren't the replaced source's.
            met = [r for r in touched if not _surely_new(schema, r, parts, held)]
            fresh = not met
            met = [r for r in met if not (source is not None and source[0] in parts and r[source[0]] == source[1])]
            target = self.read_version(before).where(_in_partitions(met, parts)) if met else None
        elif before is not None and not parts:
            target = self.read_version(before)
        if target is not None and source is not None:
            target = target.where(~F.col(source[0]).eqNullSafe(F.lit(source[1])))
        if target is not None and removed is not None:
            target = target.join(removed.select(*keys), keys, "left_anti")
        if not parts and target is not None and self.read_version(before).isEmpty():
            target = None
        merged = store.upsert(target, batch, keys, table) if target is not None else store.inserted(schema, batch, table)
        version = self._next(table, before)
        self._write(version, merged, parts, before, touched)
        if indexed:
            # The first rows of a table are read as they were written, not computed again.
            self._index(version, before, placed if placed is not None else self.read_version(version), keys, parts, fresh, touched)
        if placed is not None and indexed and not stored:
            drop_materialized(placed)
        self._switch(table, version, before, self.read(table).columns if before else schema.names)
        return version

    def replace(self, table: str, rows: DataFrame, partition_by: list[str], touched: list, properties: dict[str, str] | None = None) -> str:
        """Give the partitions ``touched`` (rows of partition values) exactly ``rows``; the others stay. Returns the new version."""
        before = self.version(table)
        version = self._next(table, before)
        with shuffles_dropped(self.spark):
            self._write(version, rows, list(partition_by), before, touched)
        self._switch(table, version, before, self.read(table).columns if before else rows.columns, properties)
        return version

    def changed(self, before: str, after: str, parts: list[str]) -> Column:
        """Filter for the partitions that two versions don't share, by the catalog's locations alone."""
        if not parts:
            return F.lit(before != after)
        old, new = ({k: e.location().toString() for k, e in self.partitions(v, parts).items()} for v in (before, after))
        kinds = {f.name: f.dataType for f in self.read_version(after).schema.fields}
        which = [k for k in {**old, **new} if old.get(k) != new.get(k)]
        each = [reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(None if v == NULL_PARTITION else v).cast(kinds[p])) for p, v in zip(parts, k, strict=True)]) for k in which]
        return reduce(lambda a, b: a | b, each) if each else F.lit(False)

    @staticmethod
    def _next(table: str, before: str | None) -> str:
        return f"{table}__v{int(before.split('__v')[1][:8]) + 1 if before else 1:08d}_{uuid.uuid4().hex[:8]}"

    def _touched(self, before: str, batch: DataFrame, keys: list[str], parts: list[str], source, moves: DataFrame | None, held: dict | None = None) -> list:
        """Partition values that the load writes to or takes rows from."""
        held = self.partitions(before, parts) if held is None else held
        found = batch.select(*parts)
        if moves is not None:
            found = found.unionByName(_without_blank(moves.select(*parts), parts))
        if source is not None:
            old = self.read_version(before).where(F.col(source[0]) == source[1])
            found = found.unionByName(old.select(*parts))
        found = found.distinct().collect()  # partition values: as many as the catalog holds
        if moves is None and not set(parts) <= set(keys) and set(held) - {_texts(r, parts) for r in found}:
            # Only entries of other partitions can add to these.
            index = self.index_of(before, batch, keys, ~F.coalesce(_in_partitions(found, parts), F.lit(False)) if found else None)
            found += index.select(*parts).distinct().collect()
        return found

    def _bucket(self, keys: list[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def index_of(self, version: str, batch: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
        """Index rows of the batch's keys, those that ``where`` takes. Only the buckets that the keys fall into are read."""
        asked = batch.select(*keys).withColumn("_bucket", self._bucket(keys))
        hit = [r[0] for r in asked.select("_bucket").distinct().collect()]  # at most ``buckets``
        index = self.read_version(f"{version}_keys").where(F.col("_bucket").isin(hit) if hit else F.lit(False))
        return (index if where is None else index.where(where)).join(asked, ["_bucket", *keys], "left_semi")

    def _index(self, version: str, before: str | None, batch: DataFrame, keys: list[str], parts: list[str], fresh: bool = False, touched: list | tuple = ()) -> None:
        """``fresh`` says that no partition holds one of the batch's keys; ``touched`` has the batch's partitions."""
        columns = [*keys, *[p for p in parts if p not in keys], "_bucket"]
        rows = batch.withColumn("_bucket", self._bucket(keys)).select(*columns)
        old = self.read_version(f"{before}_keys") if before is not None else None
        held = list(self.partitions(f"{before}_keys", _PLACE if "_run" in old.columns else ["_bucket"])) if old is not None else []
        runs, gone = Counter(place[-1] for place in held), []
        plain = bool(held) and len(held[0]) == 1  # an index without runs is written anew
        if held and (plain or not fresh or max(runs.values()) >= RUNS):
            old = old.select(*columns)
            # Entries that are stored as they are, in one of the batch's own partitions, need no writing.
            own = old.where(_in_partitions(touched, parts))
            stored = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(own[c]) for c in columns])
            new = rows if fresh else rows.join(own, stored, "left_anti")
            hit = new.select("_bucket").distinct().collect() if not plain else [{"_bucket": int(b)} for b in runs]
            within = _in_partitions(hit, ["_bucket"])
            rows, old = rows if plain else rows.where(within), old.where(within)
            rows = rows.unionByName(old if fresh else old.join(rows.select(*keys, "_bucket"), [*keys, "_bucket"], "left_anti"))
            texts = {_text(r["_bucket"]) for r in hit}
            gone = [dict(zip(_PLACE, place, strict=True)) for place in held if not plain and place[-1] in texts]
        rows = rows.withColumn("_run", F.lit(int(version.split("__v")[1][:8])))
        self._write(f"{version}_keys", rows, _PLACE, f"{before}_keys" if held and not plain else None, gone)

    def _write(self, version: str, rows: DataFrame, parts: list[str], before: str | None, touched: list | None) -> None:
        """Register ``version``, write ``rows`` into it and add the partitions of ``before`` that aren't touched."""
        by = f"PARTITIONED BY ({', '.join(map(_quoted, parts))})" if parts else ""
        self.spark.sql(f"CREATE TABLE {self.name(version)} ({_ddl(rows.schema)}) USING parquet OPTIONS (compression '{COMPRESSION}') {by} LOCATION '{self.root}/{version}'")
        table = self.spark.table(self.name(version))
        rows.select(*table.columns).write.insertInto(self.name(version))
        if parts and before is not None:
            self._add_partitions(before, version, {_texts(r, parts) for r in touched}, parts)
        self.spark.catalog.refreshTable(self.name(version))

    def _catalog(self):
        return self.spark._jsparkSession.sessionState().catalog()

    def _identifier(self, name: str):
        return self.spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(self.name(name))

    def partitions(self, version: str, parts: list[str]) -> dict[tuple, object]:
        """Partition values as text → the catalog's entry."""
        found = self._catalog().listPartitions(self._identifier(version), self.spark._jvm.scala.Option.empty()).iterator()
        out = {}
        while found.hasNext():
            entry = found.next()
            spec = entry.spec()
            out[tuple(v if (v := spec.apply(p)) is not None else NULL_PARTITION for p in parts)] = entry
        return out

    def _add_partitions(self, before: str, version: str, touched: set[tuple], parts: list[str]) -> None:
        kept = self.spark._jvm.java.util.ArrayList()
        for values, entry in self.partitions(before, parts).items():
            if values not in touched:
                kept.add(entry)
        if kept.size():
            seq = self.spark._jvm.org.apache.spark.api.python.PythonUtils.toSeq(kept)
            self._catalog().createPartitions(self._identifier(version), seq, True)

    def _switch(self, table: str, version: str, before: str | None, columns: list[str], properties: dict[str, str] | None = None) -> None:
        """The one step that readers see."""
        if self.version(table) != before:
            raise ConcurrentLoad(f"{table} changed during the load of {version}")
        held = ", ".join(f"'{k}' = '{v}'" for k, v in {**(properties or {}), "version": version}.items())
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(table)} TBLPROPERTIES ({held}) "
            f"AS SELECT {', '.join(map(_quoted, columns))} FROM {self.name(version)}"
        )

    def view(self, name: str, statement: str) -> None:
        """A persistent view over the tables; ``{db}`` in the statement is the database."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(name)} AS {statement.format(db=_quoted(self.database))}")

    # -- maintenance -----------------------------------------------------

    def roll_back(self, table: str, version: str) -> None:
        """Make an older version that is still kept the current one."""
        columns = self.read(table).columns
        self._switch(table, version, self.version(table), columns)

    def vacuum(self, table: str, keep: int = 2) -> list[str]:
        """Drop all versions but the current one and the ``keep`` - 1 before it, and folders that none of the rest refers to."""
        now = self.version(table)
        old = [v for v in self.versions(table) if v <= (now or "")]
        kept = set(old[-keep:]) | {now}
        dropped = [v for v in self.versions(table) if v not in kept]
        for name in [n for v in dropped for n in (v, f"{v}_keys") if self.exists(n)]:
            self.spark.sql(f"DROP TABLE {self.name(name)}")
        used = set()
        for name in [n for v in kept if v for n in (v, f"{v}_keys") if self.exists(n)]:
            used.add(name)
            by = [c.name for c in self.spark.catalog.listColumns(self.name(name)) if c.isPartition]
            for entry in self.partitions(name, by).values() if by else ():
                used.add(entry.location().toString().split(f"{self.root}/", 1)[1].split("/", 1)[0])
        for name in [n for v in dropped for n in (v, f"{v}_keys")]:
            if name not in used:
                store._delete(self.spark, f"{self.root}/{name}")
        return dropped


def _without_blank(rows: DataFrame, parts: list[str]) -> DataFrame:
    texts = [p for p in parts if dict(rows.dtypes)[p] == "string"]
    return rows.withColumns({p: F.nullif(F.col(p), F.lit("")) for p in texts}) if texts else rows


def _texts(row, parts: list[str]) -> tuple:
    """A row's partition values as the catalog's texts."""
    return tuple(NULL_PARTITION if row[p] is None else _text(row[p]) for p in parts)


def _surely_new(schema: T.StructType, row, parts: list[str], held: dict) -> bool:
    """Whether the catalog holds no partition of these values; values of some types have several texts."""
    plain = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
    return all(isinstance(schema[p].dataType, plain) for p in parts) and _texts(row, parts) not in held


def _text(value) -> str:
    """A partition value as the catalog writes it."""
    return str(value).lower() if isinstance(value, bool) else str(value)


def _in_partitions(values: list, parts: list[str]) -> Column:
    """Filter for the listed partition values; Spark turns it into partition pruning."""
    if len(parts) == 1:
        p = parts[0]
        some = [r[p] for r in values if r[p] is not None]
        found = F.col(p).isin(some) if some else F.lit(False)
        return found | F.col(p).isNull() if len(some) < len(values) else found
    each = [reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(r[p])) for p in parts]) for r in values]
    return reduce(lambda a, b: a | b, each) if each else F.lit(False)
