"""CSV members of zip archives as a Spark data source: a partition per member (S3).

Spark has no zip codec, and a ``binaryFile`` row holds a whole archive (2 GiB at most). Here the
driver reads only the archives' directories; each member is a task of its own that decompresses it as a
stream and yields Arrow batches, so neither archive nor member is ever held whole.
"""

from __future__ import annotations

import csv
import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskfabric.schemas import ARRIVAL

NAME = "zip_csv"
#: Rows of an Arrow batch.
BATCH = 50_000


def _source():
    """The data source class, made here so that it travels to the workers by value."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    def opened(uri: str):
        import pyarrow.fs as pafs

        if uri.startswith("file:"):
            uri = "/" + uri.removeprefix("file:").lstrip("/")
        fs, at = (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)
        return fs.open_input_file(at)

    class Member(InputPartition):
        def __init__(self, archive: str, name: str):
            super().__init__((archive, name))

    class Reader(DataSourceReader):
        def __init__(self, columns: list[str], members: list[tuple[str, str]], batch: int):
            self.columns, self.members, self.batch = columns, members, batch

        def partitions(self):
            return [Member(a, m) for a, m in self.members]

        def read(self, partition):
            import zipfile as zf

            import pandas as pd
            import pyarrow as pa

            if partition is None:  # no member at all
                return
            archive, name = partition.value
            order = pa.struct([("file", pa.string()), ("block", pa.int64()), ("place", pa.int64())])
            at = 0
            with opened(archive) as f, zf.ZipFile(f) as z, z.open(name) as stream:
                for chunk in pd.read_csv(stream, dtype=str, chunksize=self.batch, keep_default_na=False, na_values=[""]):
                    n = len(chunk)
                    text = [pa.array(chunk[c], pa.string(), from_pandas=True) if c in chunk else pa.nulls(n, pa.string()) for c in self.columns]
                    place = pa.StructArray.from_arrays([pa.array([f"{archive}!{name}"] * n), pa.array([0] * n, pa.int64()), pa.array(range(at, at + n), pa.int64())], fields=list(order))
                    yield pa.RecordBatch.from_arrays([*text, place], names=[*self.columns, "_arrival"])
                    at += n

    class Source(DataSource):
        @classmethod
        def name(cls):
            return "zip_csv"

        def schema(self):
            import json

            fields = ", ".join(f"`{c}` string" for c in json.loads(self.options["columns"]))
            return f"{fields}, `_arrival` struct<file: string, block: bigint, place: bigint>"

        def reader(self, schema):
            import json

            members = [tuple(m) for m in json.loads(self.options["members"])]
            return Reader(json.loads(self.options["columns"]), members, int(self.options["batch"]))

    return Source, opened


def csv_members(archives: list[str], first_only: bool = True) -> list[tuple[str, str]]:
    """(archive, member) of the ``.csv`` members, from the archives' directories."""
    _, opened = _source()
    out = []
    for archive in archives:
        with opened(archive) as f, zipfile.ZipFile(f) as z:
            names = [n for n in z.namelist() if n.endswith(".csv")]
        if not names:
            raise ValueError(f"no CSV member inside {archive}")
        out += [(archive, n) for n in (names[:1] if first_only else names)]
    return out


def header(member: tuple[str, str]) -> list[str]:
    """The first line of a member; a few bytes are read."""
    _, opened = _source()
    with opened(member[0]) as f, zipfile.ZipFile(f) as z, z.open(member[1]) as stream:
        return next(csv.reader(io.TextIOWrapper(stream, "utf-8", newline="")), [])


def read(spark: SparkSession, archives: list[str], columns: list[str] | None = None, first_only: bool = True, batch: int = BATCH) -> DataFrame:
    """All rows of the archives' CSV members as text, with their arrival order.

    ``columns`` default to the members' headers, in order of appearance; a member that lacks one gives NULLs.
    """
    import json

    members = csv_members(archives, first_only)
    if columns is None:
        columns = list(dict.fromkeys(c for m in members for c in header(m)))
    spark.dataSource.register(_source()[0])
    return spark.read.format(NAME).options(columns=json.dumps(columns), members=json.dumps(members), batch=str(batch)).load()
