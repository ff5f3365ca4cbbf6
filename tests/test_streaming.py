"""Streams of landed files: arrival order, kept columns, and keyed state against one batch."""

import datetime as dt
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from riskfabric.operators.versioned import Warehouse
from riskfabric.streaming import ingest, latest

SCHEMA = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
                    ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    cols = list(zip(*rows, strict=True))
    pq.write_table(pa.table([pa.array(c, type=f.type) for c, f in zip(cols, SCHEMA, strict=True)], schema=SCHEMA), f"{folder}/{name}")


def event(i, day, value):
    return (i, dt.datetime(2024, 1, day, 9), 7, "click", value, "{}")


def table(df):
    return {r["event_id"]: (str(r["event_day"]), r["value"]) for r in df.collect()}


@pytest.mark.parametrize("catalog", [True, False])
def test_first_file_wins_and_order_columns_stay(spark, tmp_path, catalog):
    folder = str(tmp_path / "land")
    land(folder, "a.parquet", [event(1, 1, 1.0)])
    land(folder, "b.parquet", [event(i, 1, 2.0) for i in range(5_000)])
    target = (Warehouse(spark, f"s{random.randrange(10**9)}", str(tmp_path / "wh")), "ev") if catalog else str(tmp_path / "t")
    options = {"partition_by": ["event_day"], "transform": ingest.with_event_day, "checkpoint": str(tmp_path / "ckpt")}
    got = table(ingest.ingest_files(spark, folder, ingest.EVENTS, target, ["event_id"], **options))
    assert got[1] == ("2024-01-01", 1.0) and got[2] == ("2024-01-01", 2.0) and len(got) == 5_000
    land(folder, "c.parquet", [event(3, 2, 9.0), event(3, 3, 8.0)])
    got = ingest.ingest_files(spark, folder, ingest.EVENTS, target, ["event_id"], order_cols=["value"], **options)
    assert set(got.columns) == {*SCHEMA.names, "event_day"}
    assert table(got)[3] == ("2024-01-03", 8.0) and got.count() == 5_000


def test_state_gives_the_same_table_as_one_batch(spark, tmp_path):
    """Redelivery, corrections that move a day, older files late, a restart: all like one batch."""
    rng = random.Random(3)
    files = [[event(rng.randrange(40), rng.randrange(1, 6), float(rng.randrange(9))) for _ in range(30)] for _ in range(6)]
    files[3] = files[0]  # a redelivery under a later name counts as a correction
    want = {}
    wh = Warehouse(spark, f"s{random.randrange(10**9)}", str(tmp_path / "wh"))
    one = Warehouse(spark, f"s{random.randrange(10**9)}", str(tmp_path / "one"))
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    for n, rows in enumerate(files):
        unique = list({r[0]: r for r in rows}.values())  # a key once a file
        for folder in (step, whole):
            land(folder, f"f{n}.parquet", unique)
        want |= {r[0]: (str(r[1].date()), r[4]) for r in unique}
        if n % 2:  # two files a run, one a micro-batch; each run is a restart from the checkpoint
            got = latest.ingest_latest(spark, step, ingest.EVENTS, wh, "ev", ["event_id"], "event_day", transform=ingest.with_event_day,
                                       checkpoint=str(tmp_path / "ckpt"), max_files_per_trigger=1)
            assert table(got) == want
    got = latest.ingest_latest(spark, whole, ingest.EVENTS, one, "ev", ["event_id"], "event_day", transform=ingest.with_event_day, checkpoint=str(tmp_path / "ckpt1"))
    assert table(got) == want and got.count() == len(want)
    # Nothing new: no version more. A file that repeats what is held: no version either.
    versions = len(wh.versions("ev"))
    land(step, "f9.parquet", [(k, dt.datetime.fromisoformat(d + " 09:00"), 7, "click", v, "{}") for k, (d, v) in want.items()])
    for _ in range(2):
        got = latest.ingest_latest(spark, step, ingest.EVENTS, wh, "ev", ["event_id"], "event_day", transform=ingest.with_event_day, checkpoint=str(tmp_path / "ckpt"))
    assert table(got) == want and len(wh.versions("ev")) == versions


def test_version_columns_decide_in_any_order(spark, tmp_path):
    wh = Warehouse(spark, f"s{random.randrange(10**9)}", str(tmp_path / "wh"))
    folder = str(tmp_path / "land")
    land(folder, "a.parquet", [event(1, 5, 1.0), event(1, 3, 2.0), event(2, 1, 1.0), (None, dt.datetime(2024, 1, 1), 1, "x", 0.0, "{}")])
    options = {"version": ["ts"], "transform": ingest.with_event_day, "checkpoint": str(tmp_path / "ckpt")}
    got = latest.ingest_latest(spark, folder, ingest.EVENTS, wh, "ev", ["event_id"], "event_day", **options)
    assert table(got) == {1: ("2024-01-05", 1.0), 2: ("2024-01-01", 1.0)}
    land(folder, "b.parquet", [event(1, 4, 9.0), event(2, 2, 9.0)])  # older than what is held, and newer
    got = latest.ingest_latest(spark, folder, ingest.EVENTS, wh, "ev", ["event_id"], "event_day", **options)
    assert table(got) == {1: ("2024-01-05", 1.0), 2: ("2024-01-02", 9.0)}


def test_state_holds_a_bucket_of_keys_an_entry(spark, tmp_path):
    """One entry of the state store, and one call of the processor, serve many keys."""
    wh = Warehouse(spark, f"s{random.randrange(10**9)}", str(tmp_path / "wh"))
    folder, ckpt = str(tmp_path / "land"), str(tmp_path / "ckpt")
    options = {"transform": ingest.with_event_day, "checkpoint": ckpt}
    for name, first, value in (("a", 0, 1.0), ("b", 0, 1.0), ("c", 100, 2.0)):  # all, all again, some corrected
        land(folder, f"{name}.parquet", [event(i, 1 + (i % 3) + int(value) - 1, value) for i in range(first, 300)])
        got = latest.ingest_latest(spark, folder, ingest.EVENTS, wh, "ev", ["event_id"], "event_day", **options)
    assert table(got) == {i: (f"2024-01-0{1 + i % 3 + (i >= 100)}", 2.0 if i >= 100 else 1.0) for i in range(300)}
    state = spark.read.format("statestore").option("stateVarName", "last_of_bucket").load(ckpt)
    assert 0 < state.count() < 300
    one = Warehouse(spark, f"s{random.randrange(10**9)}", str(tmp_path / "one"))
    again = latest.ingest_latest(spark, folder, ingest.EVENTS, one, "ev", ["event_id"], "event_day", transform=ingest.with_event_day, checkpoint=str(tmp_path / "ckpt1"), buckets=2)
    assert table(again) == table(got)
    assert spark.read.format("statestore").option("stateVarName", "last_of_bucket").load(str(tmp_path / "ckpt1")).count() == 2
