"""Disk of loads: shuffle files, compressed files, key index entries, the text that rows are moved by."""

import datetime as dt
import gzip
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskfabric import runner, schemas
from riskfabric.functions import ids
from riskfabric.operators.versioned import RUNS, Warehouse
from riskfabric.session import shuffles_dropped
from riskfabric.sources import gdelt, seed

SF = "/root/testdata/sf0.001"
DDL = "id long, day date, v int"


@pytest.fixture()
def wh(spark, tmp_path):
    return Warehouse(spark, f"d{random.randrange(10**9)}", str(tmp_path / "wh"), buckets=4)


def day(n):
    return dt.date(2024, 1, n)


def shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


def left_of(spark, before):
    """New shuffle files, after the time that their deletion may take."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_loads_leave_no_shuffle_files(spark, wh, tmp_path):
    path = str(tmp_path / "diplomatic_events.csv")
    with open(path, "w") as fh:
        fh.write("action_date,actor_iso3,target_iso3,action_type,instrument_name,status\n" + "".join(f"2020-01-08,USA,IRN,sanction,I{i % 90},s\n" for i in range(100)))
    spec = runner.SourceSpec("SEED", "fact_diplomatic_action", lambda s: True, lambda s: seed.normalise(seed.read(s, path)))
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = shuffle_files(spark)
    for _ in range(2):
        assert runner.run_source(spark, spec, wh).input_rows == 100
    rows = spark.range(300).selectExpr("id", "date_add(DATE'2024-01-01', int(id % 7)) AS day", "1 AS v")
    for _ in range(2):
        wh.load("ev", rows.groupBy("id", "day").agg(F.sum("v").cast("int").alias("v")), ["id"], ["day"])
    assert not left_of(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert wh.read("ev").count() == 300 and wh.read("fact_diplomatic_action").count() == 90
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def entries(spark, wh, folder_of):
    """Entries that a version's index wrote itself."""
    path = f"{wh.root}/{folder_of}_keys"
    if not [f for _, _, files in os.walk(path) for f in files if f.endswith(".parquet")]:
        return []
    return sorted((r["id"], r["day"]) for r in spark.read.parquet(path).collect())


def test_the_index_writes_new_and_moved_entries_only(spark, wh):
    mk = lambda rows: spark.createDataFrame(rows, DDL)
    wh.load("ev", mk([(i, day(1 + i % 3), 0) for i in range(40)] + [(40, None, 0)]), ["id"], ["day"])
    fresh = wh.load("ev", mk([(i, day(9), 0) for i in range(100, 105)]), ["id"], ["day"])
    assert entries(spark, wh, fresh) == [(i, day(9)) for i in range(100, 105)]
    same = wh.load("ev", mk([(i, day(1 + i % 3), 1) for i in range(40)] + [(40, None, 1)]), ["id"], ["day"])
    assert entries(spark, wh, same) == []
    moved = wh.load("ev", mk([(3, day(7), 2), (4, day(2), 2)]), ["id"], ["day"])
    found = {r["id"]: r["day"] for r in wh.index_of(moved, mk([(i, day(1), 0) for i in (3, 4, 6, 40, 101)]), ["id"]).collect()}
    assert found == {3: day(7), 4: day(2), 6: day(1), 40: None, 101: day(9)}
    # Every key is in the index once, wherever its entry lies.
    assert wh.read_version(f"{moved}_keys").count() == 46 == wh.read("ev").count()
    assert {r["id"]: (r["day"], r["v"]) for r in wh.read("ev").where("id IN (3, 4, 40)").collect()} == {3: (day(7), 2), 4: (day(2), 2), 40: (None, 1)}


def test_runs_of_a_bucket_are_bounded(spark, wh):
    for n in range(RUNS + 3):
        wh.load("ev", spark.createDataFrame([(i + 100 * n, day(n + 1), n) for i in range(12)], DDL), ["id"], ["day"])
        index = wh.read_version(f"{wh.version('ev')}_keys")
        assert index.groupBy("_bucket").agg(F.countDistinct("_run").alias("n")).agg(F.max("n")).first()[0] <= RUNS
        assert index.count() == 12 * (n + 1)
    wh.vacuum("ev", keep=1)
    wh.load("ev", spark.createDataFrame([(5, day(20), -1), (1005, day(1), -1)], DDL), ["id"], ["day"])
    assert {r["id"]: r["day"] for r in wh.read("ev").where("v = -1").collect()} == {5: day(20), 1005: day(1)}
    assert wh.read("ev").count() == 12 * (RUNS + 3)


def test_an_index_without_runs_is_written_anew(spark, wh):
    first = wh.load("ev", spark.createDataFrame([(i, day(1), 0) for i in range(20)], DDL), ["id"], ["day"])
    old = wh.read_version(f"{first}_keys").drop("_run").collect()
    spark.sql(f"DROP TABLE {wh.name(first + '_keys')}")
    spark.createDataFrame(old, "id long, day date, _bucket int").write.partitionBy("_bucket").parquet(f"{wh.root}/old_keys")
    spark.sql(f"CREATE TABLE {wh.name(first + '_keys')} (id long, day date, _bucket int) USING parquet PARTITIONED BY (_bucket) LOCATION '{wh.root}/old_keys'")
    spark.sql(f"MSCK REPAIR TABLE {wh.name(first + '_keys')}")
    second = wh.load("ev", spark.createDataFrame([(3, day(2), 1), (50, day(2), 1)], DDL), ["id"], ["day"])
    assert sorted((r["id"], r["day"]) for r in wh.read_version(f"{second}_keys").collect()) == sorted([(i, day(2 if i == 3 else 1)) for i in range(20)] + [(50, day(2))])
    assert wh.read("ev").where("id = 3").first()["day"] == day(2) and wh.read("ev").count() == 21


def test_landed_and_loaded_files_are_packed(spark):
    loaded = E.queries()["landing_load"](spark, SF).inputFiles()
    assert loaded and all(f.endswith(".zstd.parquet") for f in loaded)


def test_article_lists_may_be_compressed(spark, tmp_path):
    """Ids of one text are one article, the first one; its id is that of its parts."""
    raw = str(tmp_path)
    mk = lambda url, seen, title: {"url": url, "title": title, "seendate": seen, "domain": "d", "sourcecountry": "Turkey", "tone": "1.50"}
    with gzip.open(f"{raw}/artlist_1.json.gz", "wt") as fh:
        json.dump({"articles": [mk("u|x", "20250102T030405Z", "first"), mk(None, "20250102T030405Z", "none")]}, fh)
    with open(f"{raw}/artlist_2.json", "w") as fh:
        json.dump({"articles": [mk("u", "x|20250102T030405Z", "late"), mk("v", "20250102T030405Z", "other")]}, fh)
    countries = spark.createDataFrame([("TUR", "TR", "Turkey", None)], schemas.DIM_COUNTRY)
    out = {r["title"]: r for r in gdelt.normalise(gdelt.read(spark, raw), countries).collect()}
    assert set(out) == {"first", "none", "other"}
    id_of = lambda *parts: spark.range(1).select(ids.make_id(*map(F.lit, parts))).first()[0]
    assert out["first"]["item_id"] == id_of("u|x", "20250102T030405Z") and out["none"]["item_id"] == id_of("nan", "20250102T030405Z")
    assert out["other"]["topic_tags"] == "1.50" and out["other"]["tone"] == 1.5 and out["none"]["url"] is None
    os.makedirs(f"{raw}/gdelt")
    os.rename(f"{raw}/artlist_1.json.gz", f"{raw}/gdelt/artlist_1.json.gz")
    spec = next(s for s in runner.default_specs(runner.Landing(raw, raw), countries, "2026-03-01") if s.name == "GDELT")
    assert spec.available(spark)


def test_ids_stay_behind_in_the_shuffle(spark, tmp_path):
    """The rows that are moved to be made one a key have no id: it is made of their text afterwards."""
    raw = str(tmp_path)
    with open(f"{raw}/artlist_1.json", "w") as fh:
        json.dump({"articles": [{"url": "u", "seendate": "20250102T030405Z", "tone": "1"}]}, fh)
    countries = spark.createDataFrame([("TUR", "TR", "Turkey", None)], schemas.DIM_COUNTRY)
    plan = gdelt.normalise(gdelt.read(spark, raw), countries, has_themes=False)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = next(i for i, line in enumerate(plan) if "hashpartitioning" in line and schemas.KEY_TEXT in line)
    assert any("sha2" in line for line in plan[:depth]) and not any("sha2" in line for line in plan[depth:])


def test_article_lists_are_packed(spark):
    lists = [f for f in E.queries()["gdelt_files"](spark, SF).inputFiles() if "/landing/" in f]
    assert lists and all(f.endswith(".json.gz") for f in lists)


def test_kept_aggregates_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    found = E.queries()["kept_week_agg"](spark, SF)
    assert not left_of(spark, before)
    assert all(f.endswith(".zstd.parquet") for f in found.inputFiles()) and found.count() > 0
