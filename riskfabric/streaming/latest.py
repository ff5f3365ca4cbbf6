"""Keyed streaming state: the last version of every key and the partition that holds it.

A stream of landed files is grouped by key into a state store that remembers, a key, the version that
the table holds, that row's partition and a hash of its content. Of a key's rows the one with the greatest version
wins, whatever files, order or micro-batches they come in: redelivered rows and older versions give
nothing, a correction gives its row and, where it moves, the partition to take the old one from. So a micro-batch
touches the partitions of its changes alone; no index and no scan of the table looks them up.

The keys are dealt by hash over a number of buckets. A bucket is one entry of the state store, a packed table of its
keys, so that a call of the processor serves all rows of a bucket, not of a key. ``buckets`` belongs to
the checkpoint, like the keys: a bucket's keys must fit a task's memory, and a micro-batch reads the buckets that it has keys of.

A micro-batch that runs again after a failure finds the state of its first run and gives the same changes, which the
table takes as an upsert.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfabric.operators.versioned import Warehouse
from riskfabric.session import drop_materialized, materialize, scratch_path
from riskfabric.streaming.ingest import file_stream

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What the processor gets of a row: names without a leading underscore, which rows of state batches lose.
_FED = ["id", "version", "part", "content", "payload"]
#: Buckets of keys in the state.
BUCKETS = 4096
#: Columns of a change besides the row: whether the key's old row lies in another partition, and that one as text.
_MOVED, _FROM = "_moved", "_from"
#: The row itself travels as JSON text: pandas would turn whole numbers beside NULLs into doubles.
_JSON = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "dateFormat": "yyyy-MM-dd"}


def _processor():
    """The processor class, made here so that it travels to the workers by value."""
    import pandas as pd
    import pyarrow as pa
    from pyspark.sql.streaming import StatefulProcessor

    kinds = pa.schema([("id", pa.string()), ("version", pa.string()), ("part", pa.string()), ("content", pa.int64())])

    def unpacked(state) -> dict:
        columns = pa.ipc.open_stream(bytes(state)).read_all().to_pydict()
        return {i: row for i, *row in zip(*columns.values(), strict=True)}

    def packed(held: dict) -> bytes:
        columns = [held.keys(), *(zip(*held.values(), strict=True))]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kinds, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds))
        return sink.getvalue().to_pybytes()

    class LastVersions(StatefulProcessor):
        def init(self, handle):
            self.last = handle.getValueState("last_of_bucket", "packed binary")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
            newest = {}
            for batch in rows:
                for i, *row in zip(*[batch[c] for c in _FED], strict=True):
                    if i not in newest or row > newest[i]:
                        newest[i] = row
            last = unpacked(self.last.get()[0]) if self.last.exists() else {}
            later = {i: row for i, row in newest.items() if i not in last or last[i][0] < row[0]}
            if not later:
                return
            # payload, whether the old row lies in another partition, and that one
            out = []
            for i, (_, part, content, payload) in later.items():
                held = last.get(i)
                if held is None or held[2] != content:
                    moved = held is not None and held[1] != part
                    out.append((payload, moved, held[1] if moved else ""))
            last.update((i, (version, part, int(content))) for i, (version, part, content, _) in later.items())
            self.last.update((packed(last),))
            if out:
                yield pd.DataFrame(out, columns=["payload", "moved", "held"])

        def close(self):
            pass

    return LastVersions


def _sortable(c: F.Column, kind: T.DataType) -> F.Column:
    """A version column as text that sorts like it."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # Flip the sign's order: negative numbers first, then by twenty digits.
        big = c.cast("decimal(38,0)") + F.lit(str(2**63)).cast("decimal(38,0)")
        return F.lpad(big.cast("string"), 20, "0")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, (T.DateType, T.StringType)):
        return c.cast("string")
    raise TypeError(f"a version column of type {kind.simpleString()} has no order as text")


def changes(stream: DataFrame, keys: list[str], partition: str, version: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``stream`` that change the table, with ``_moved`` and ``_from`` (the old partition, as text).

    Rows with a NULL key have no identity and are left out. Equal versions: the row whose content hashes highest wins.
    """
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    content = F.xxhash64(*[c for c in stream.columns if c not in version])
    # NULL versions come first.
    parts = [F.coalesce(F.concat(F.lit("1"), _sortable(F.col(c), kinds[c])), F.lit("0")) for c in version]
    order = F.concat_ws("\u0001", *parts, _sortable(content, T.LongType()))
    # A key as text; adding nothing makes a negative zero the zero that it equals.
    named = [(F.col(k) + F.lit(0).cast(kinds[k]) if isinstance(kinds[k], (T.FloatType, T.DoubleType)) else F.col(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    fed = stream.dropna(subset=keys).select(
        F.to_json(F.struct(*named), _JSON).alias("id"),
        order.alias("version"), F.coalesce(F.col(partition).cast("string"), F.lit("")).alias("part"), content.alias("content"),
        F.to_json(F.struct(*stream.columns), _JSON).alias("payload"),
    )
    fed = fed.select(F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket"), *_FED)
    out = "payload string, moved boolean, held string"
    keyed = fed.groupBy("bucket").transformWithStateInPandas(_processor()(), out, outputMode="Update", timeMode="None")
    row = F.from_json("payload", stream.schema, _JSON).alias("r")
    return keyed.select(row, F.col("moved").alias(_MOVED), F.col("held").alias(_FROM)).select("r.*", _MOVED, _FROM)


def ingest_latest(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    warehouse: Warehouse,
    table: str,
    keys: list[str],
    partition: str,
    *,
    version: list[str] | None = None,
    fmt: str = "parquet",
    checkpoint: str | None = None,
    options: dict[str, str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Bring ``table`` up to date with every file not yet seen; return its current rows.

    ``version`` columns decide between rows of a key (greatest wins); by default the file's path, so that
    a later delivery corrects an earlier one. A new ``checkpoint`` needs a new table: state and table belong together
    (so does a checkpoint that held one entry a key).
    """
    stream = file_stream(spark, source_path, schema, fmt, options, max_files_per_trigger)
    by = version or ["_file"]
    if transform:
        stream = transform(stream)
    stream = stream.drop("_block") if "_file" in by else stream.drop("_block", "_file")

    def write(batch: DataFrame, batch_id: int) -> None:
        found = materialize(batch, f"changes-{table}-{batch_id}")
        if found.isEmpty():
            return
        kind = found.schema[partition].dataType
        old = F.when(F.col(_FROM) != "", F.col(_FROM)).cast(kind)
        moves = found.where(_MOVED).select(old.alias(partition))
        warehouse.load(table, found.drop(_MOVED, _FROM, "_file"), keys, [partition], moves=moves)
        drop_materialized(found)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        query = (
            changes(stream, keys, partition, by, buckets).writeStream.foreachBatch(write).outputMode("update")
            .option("checkpointLocation", checkpoint or scratch_path(spark, f"streams/{warehouse.database}.{table}"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    return warehouse.read(table)
