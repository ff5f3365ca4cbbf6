"""Helpers shared by the operators: shipping code, Arrow slices, scratch tables."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Texts handed to Python at once; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 20


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package: add it once per application as a zip.

    The driver serves the zip to the executors, so no shared folder and no
    installation on the workers is needed.
    """
    sc = spark.sparkContext
    if getattr(sc, "_riskfabric_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="riskfabric-code-"), "riskfabric_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._riskfabric_shipped = True


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else, JVM-side.

    A text whose bytes and characters are equally many is ASCII, where ``lower``
    changes A-Z only; other texts go through ``translate``.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) with null texts as empty; every other column is left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], *columns: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds about ``most`` bytes of ``columns`` (``text`` if none are named; one row at least)."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in columns or ("text",):
            own = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
            sizes += own.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


_HELD: list = []
_OWNER: list[str] = [""]


def _give_back() -> None:
    """Return freed memory to the system; the C library and Arrow would keep it for this process."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def task_begins(owner: str) -> None:
    """Drop what another operator's tasks have kept in this worker process."""
    if _OWNER[0] != owner:
        _OWNER[0] = owner
        _HELD.clear()
        gc.collect()
        _give_back()


def held_alone(name: str, of: object, make):
    """This worker process's one large table: ``make()``, kept while the same ``name`` and object ``of`` are asked for."""
    if not _HELD or _HELD[0] != name or _HELD[1] is not of:
        _HELD.clear()
        made = make()
        _HELD[:] = [name, of, made]
    return _HELD[2]


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path.

    Spark gives a Python process to one operator's tasks after another's: what the last one kept is
    dropped first, and a task's freed memory is given back at its end.
    """
    ship_package(df.sparkSession)
    owner = f"{fn.__module__}.{fn.__qualname__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_begins(owner)
        yield from fn(batches)
        _give_back()

    return df.mapInArrow(run, schema)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (lineage ends there)."""
    return materialize(df, name)


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``scratch_table`` wrote and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def hash_sample(df: DataFrame, id_col: str, most: int, *ties: str) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of ``id_col`` (ties by it, then by ``ties``).

    The rows' number gives a hash under which about twice as many rows lie, so that all tasks
    together sort and send that many, not ``most`` each.
    """
    h = F.xxhash64(id_col)
    share = min(1.0, 2 * most / max(1, df.count()))
    highest = min(2**63 - 1, -(2**63) + int(share * 2**64))
    return df.where(h <= highest).orderBy(h, id_col, *ties).limit(most)
