"""Catalog warehouse: atomic switch, key index, arrival order, kept columns, default sources, views."""

import datetime as dt
import json
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from riskfabric import runner, schemas
from riskfabric.operators.versioned import ConcurrentLoad, Warehouse
from riskfabric.plans import grs, views
from riskfabric.sources import acled_manual, archive, dims, seed, ucdp

DDL = "id long, day date, v int, note string"


@pytest.fixture()
def wh(spark, tmp_path):
    return Warehouse(spark, f"w{random.randrange(10**9)}", str(tmp_path / "wh"), buckets=16)


def day(n):
    return dt.date(2024, 1, n)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def held(wh, table="ev"):
    return {r["id"]: tuple(r)[1:] for r in wh.read(table).select("id", "day", "v", "note").collect()}


def test_random_loads_equal_a_plain_table(spark, wh):
    rng, plain = random.Random(4), {}
    for _ in range(6):
        rows = {rng.randrange(60): (rng.choice([None, *map(day, range(1, 8))]), rng.randrange(99)) for _ in range(25)}
        batch = spark.createDataFrame([(k, *v) for k, v in rows.items()], "id long, day date, v int")
        if rng.random() < 0.5:
            batch = batch.withColumn("note", F.lit("n"))
        wh.load("ev", batch if plain else batch.select("id", "day", "v", F.lit("first").alias("note")), ["id"], ["day"])
        for k, (d, v) in rows.items():
            note = "n" if "note" in batch.columns and plain else ("first" if not plain else plain.get(k, (0, 0, None))[2])
            rows[k] = (d, v, note)
        plain |= rows
        assert held(wh) == plain
    folders = {r["day"] for r in wh.read("ev").select("day").distinct().collect()}
    assert folders == {v[0] for v in plain.values()}  # emptied partitions are gone


def test_a_load_computes_its_batch_once_or_twice(spark, wh):
    """Into an empty table once, into others once for the keys and once for the rows; the rows stay those of an upsert."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        seen.add(1)
        return True

    def load(ids, source, note, replaced=None):
        before = seen.value
        batch = spark.createDataFrame([(i, source, note) for i in ids], "id long, source string, note string").where(counted("id"))
        wh.load("src", batch, ["id"], ["source"], replaced)
        return (seen.value - before) / len(ids)

    wh.load("src", spark.createDataFrame([], "id long, source string, note string"), ["id"], ["source"])
    assert load([1, 2, 3, 4], "a", "x") == 1
    assert load([5, 6], "b", "x") <= 2
    assert load([2, 7, 8, 6], "a", "y", ("source", "a")) <= 2  # 6 moves from b, 1, 3 and 4 go
    got = {tuple(r) for r in wh.read("src").select("id", "source", "note").collect()}
    assert got == {(5, "b", "x"), (2, "a", "y"), (7, "a", "y"), (8, "a", "y"), (6, "a", "y")}
    assert load([8, None], "c", "z") <= 2  # 8 moves to a new partition; a NULL key is a row of its own
    got = {tuple(r) for r in wh.read("src").select("id", "source", "note").collect()}
    assert got == {(5, "b", "x"), (2, "a", "y"), (7, "a", "y"), (8, "c", "z"), (6, "a", "y"), (None, "c", "z")}


def test_partition_values_of_any_kind(spark, wh):
    values = ["a/b", "x=y", "", None, "ü ñ", "50%", "a'b", "__x", "A"]
    kinds = "id long, s string, n int, d date, v int"
    first = [(i, s, n, d, 0) for i, (s, n, d) in enumerate((s, n, d) for s in values for n in (None, 3) for d in (None, day(2)))]
    wh.load("odd", spark.createDataFrame(first, kinds), ["id"], ["s", "n", "d"])
    wh.load("odd", spark.createDataFrame([(i, s, n, d, 1) for i, s, n, d, _ in first[::2]], kinds), ["id"], ["s", "n", "d"])
    wh.load("odd", spark.createDataFrame([(i, "moved", 7, None, 2) for i, *_ in first[::3]], kinds), ["id"], ["s", "n", "d"])
    want = {i: ((s or None, n, d, 1 if i % 2 == 0 else 0) if i % 3 else ("moved", 7, None, 2)) for i, s, n, d, _ in first}
    got = wh.read("odd").select("id", "s", "n", "d", "v").collect()
    assert len(got) == len(first) and {r[0]: tuple(r)[1:] for r in got} == want


def test_failure_before_the_switch_leaves_the_old_rows(spark, wh, monkeypatch):
    wh.load("ev", spark.createDataFrame([(1, day(1), 1, "a"), (2, day(2), 2, "a")], DDL), ["id"], ["day"])
    before, reader = held(wh), wh.read("ev")
    batch = spark.createDataFrame([(1, day(2), 9, "b"), (3, day(3), 9, "b")], DDL)
    monkeypatch.setattr(Warehouse, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        wh.load("ev", batch, ["id"], ["day"])
    assert held(wh) == before
    monkeypatch.undo()
    wh.load("ev", batch, ["id"], ["day"])
    assert held(wh) == {1: (day(2), 9, "b"), 2: (day(2), 2, "a"), 3: (day(3), 9, "b")}
    # A plan made before the load still reads the version that it began with.
    assert {r["id"]: r["v"] for r in reader.collect()} == {1: 1, 2: 2}


def test_writer_that_lost_its_turn_raises(spark, wh, monkeypatch):
    mk = lambda v: spark.createDataFrame([(1, day(1), v, "a")], DDL)
    wh.load("ev", mk(1), ["id"], ["day"])
    write = Warehouse._write

    def other_comes_first(self, version, *args):
        write(self, version, *args)
        if not version.endswith("_keys") and held(self)[1][1] == 1:
            monkeypatch.setattr(Warehouse, "_write", write)
            self.load("ev", mk(5), ["id"], ["day"])

    monkeypatch.setattr(Warehouse, "_write", other_comes_first)
    with pytest.raises(ConcurrentLoad):
        wh.load("ev", mk(2), ["id"], ["day"])
    assert held(wh)[1][1] == 5


def test_a_load_reads_its_buckets_and_partitions_only(spark, wh):
    rows = [(i, day(1 + i % 28), i, "x" * 50) for i in range(2_000)]
    wh.load("ev", spark.createDataFrame(rows, DDL), ["id"], ["day"])
    small = spark.createDataFrame([(5, day(20), -1, "moved")], DDL)
    version = wh.version("ev")
    plan = wh.index_of(version, small, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    touched = wh._touched(version, small, ["id"], ["day"], None, None)
    assert sorted(r["day"] for r in touched) == [day(6), day(20)]
    assert "_bucket" in plan
    bucket = wh.index_of(version, small, ["id"]).inputFiles()
    assert len({f.rsplit("/", 2)[1] for f in bucket}) == 1  # of 16 buckets
    files = set(wh.read("ev").where("day NOT IN (DATE'2024-01-06', DATE'2024-01-20')").inputFiles())
    wh.load("ev", small, ["id"], ["day"])
    # Partitions that the load doesn't touch keep their files, and only the two others are new.
    now = set(wh.read("ev").inputFiles())
    assert {f for f in now if version in f} == {f for f in files if "day=2024-01-06" not in f and "day=2024-01-20" not in f}
    assert {f.rsplit("/", 2)[1] for f in now if wh.version("ev") in f} == {"day=2024-01-06", "day=2024-01-20"}
    got = held(wh)
    assert len(got) == 2_000 and got[5] == (day(20), -1, "moved")


def test_vacuum_keeps_what_versions_refer_to(spark, wh):
    for n in range(5):
        wh.load("ev", spark.createDataFrame([(n, day(n + 1), n, "a")], DDL), ["id"], ["day"])
    before = held(wh)
    dropped = wh.vacuum("ev", keep=2)
    assert len(dropped) == 3 and len(wh.versions("ev")) == 2 and held(wh) == before
    wh.roll_back("ev", wh.versions("ev")[0])
    assert set(held(wh)) == {0, 1, 2, 3}
    one = Warehouse(spark, wh.database, wh.root)
    one.load("flat", spark.createDataFrame([(1, "a")], "k int, s string"), ["k"])
    one.load("flat", spark.createDataFrame([(1, "b"), (2, "c")], "k int, s string"), ["k"])
    assert one.vacuum("flat", keep=1) and {r["k"]: r["s"] for r in one.read("flat").collect()} == {1: "b", 2: "c"}


HEAD = "action_date,actor_iso3,target_iso3,action_type,instrument_name,status,notes"


@pytest.mark.parametrize("catalog", [True, False])
def test_first_file_and_line_win_and_absent_columns_stay(spark, wh, tmp_path, catalog):
    """A short first file against a long second one, in splits of any size; then a delivery without a column."""
    raw = str(tmp_path / "seeds")
    line = "2020-01-{:02d},USA,IRN,sanction,I{},{},{}"
    long = [line.format(1 + i % 28, i, "second", "KEEPME") for i in range(4_000)]
    put(f"{raw}/diplomatic_events_a.csv", "\n".join([HEAD, line.format(8, 7, "first", "KEEPME"), line.format(8, 7, "late", "x")]) + "\n")
    put(f"{raw}/diplomatic_events_b.csv", "\n".join([HEAD, *long]) + "\n")
    target = wh if catalog else str(tmp_path / "plain")
    spec = runner.SourceSpec("SEED", "fact_diplomatic_action", lambda s: True, lambda s: seed.normalise(seed.read(s, f"{raw}/*.csv")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert runner.run_source(spark, spec, target).input_rows == 4_002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    read = runner.tables_at(spark, target).read
    rows = {r["instrument_name"]: r for r in read("fact_diplomatic_action").collect()}
    assert len(rows) == 4_000 and rows["I7"]["status"] == "first" and rows["I8"]["status"] == "second"
    for name in ("a", "b"):
        os.remove(f"{raw}/diplomatic_events_{name}.csv")
    put(f"{raw}/diplomatic_events_c.csv", HEAD.removesuffix(",notes") + "\n2020-01-08,USA,IRN,sanction,I7,third\n")
    runner.run_source(spark, spec, target)
    row = read("fact_diplomatic_action").where("instrument_name = 'I7'").first()
    assert (row["status"], row["notes"], row["confidence_flag"]) == ("third", "KEEPME", "HIGH")


def test_manual_backfill_is_read_once_and_checked_while_it_loads(spark, wh, tmp_path):
    head = "country_iso3,week_start,event_type,event_count,fatalities_best"
    path = str(tmp_path / "seeds" / "acled_manual_weekly.csv")
    landing = runner.Landing(str(tmp_path / "raw"), str(tmp_path / "seeds"))
    countries = spark.createDataFrame([("UKR", "UA", "Ukraine", "EU_EUR")], schemas.DIM_COUNTRY)
    spec = next(s for s in runner.default_specs(landing, countries, "2026-03-01") if s.name == "ACLED_MANUAL")
    put(path, f"{head}\nUKR,2026-02-16,X,1,1\nUKR,2026-02-09,X,2,1\n")
    result = runner.run_source(spark, spec, wh)
    assert (result.status, result.input_rows, result.counts["rows_read"], result.counts["dropped"]) == ("success", 2, 2, 0)
    for line, rule in (("UKR,2025-12-01,X,1,1", "out_of_range"), ("UKR,2026-02-16,X,-1,1", "negative"), ("UKR,2026-02-16,X,1,1\nUKR,2026-02-16,X,1,1", None)):
        put(path, f"{head}\n{line}\n")
        assert runner.run_source(spark, spec, wh).status == "failed", rule
    assert wh.read("fact_incident").count() == 2
    scans = acled_manual.normalise(acled_manual.read(spark, path), check=False)._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans == 1


def test_seven_sources_with_one_call(spark, wh, tmp_path):
    raw, seeds = str(tmp_path / "raw"), str(tmp_path / "seeds")
    head = "id,date_start,date_end,country,type_of_violence,dyad_name,best,low,high,latitude,longitude,where_prec\n"
    os.makedirs(f"{raw}/ucdp_ged")
    with zipfile.ZipFile(f"{raw}/ucdp_ged/ged.zip", "w") as z:
        z.writestr("ged.csv", head + "1,2020-01-02,2020-01-03,Turkey,3,A - B,5,4,6,41,29,1\n2,bad,2020-01-03,Turkey,1,A - B,5,4,6,41,29,1\n")
    put(f"{raw}/acled/Europe_aggregated_data_up_to-2026-01-31.csv", "WEEK,REGION,COUNTRY,ADMIN1,EVENT_TYPE,SUB_EVENT_TYPE,EVENTS,FATALITIES,"
        "DISORDER_TYPE,ID,CENTROID_LATITUDE,CENTROID_LONGITUDE\n2026-01-04,Europe,Turkey,Izmir,Protests,Peaceful protest,2,0,D,48,39.9,32.8\n"
        "2026-01-04,Europe,Turkey,Izmir,Protests,Peaceful protest,-2,0,D,49,39.9,32.8\n")
    put(f"{seeds}/acled_manual_2026.csv", "country_iso3,week_start,event_type,event_count,fatalities_best\nTUR,2026-02-16,X,1,1\n")
    put(f"{raw}/world_bank/SP.POP.TOTL/page_001.json", json.dumps([{"countryiso3code": "TUR", "country": {"id": "TR"}, "date": "2020", "value": 8e7, "unit": ""},
                                                                  {"countryiso3code": "TUR", "country": {"id": "TR"}, "date": "2019", "value": None}]))
    put(f"{raw}/ofac/sdn.csv", '36,"A, B",-0-,"IRAN; SDGT",-0-,-0-,-0-,-0-,-0-,-0-,-0-,-0-\n37,"X",-0-,CUBA,-0-,-0-,-0-,-0-,-0-,-0-,-0-,-0-,\n')
    put(f"{seeds}/diplomatic_events_seed.csv", HEAD + "\n2020-01-08,USA,TUR,sanction,I7,third,\n")
    put(f"{raw}/gdelt/artlist_1.json", json.dumps({"articles": [{"url": "u", "title": "t", "seendate": "20250102T030405Z", "domain": "d", "sourcecountry": "Turkey",
                                                                  "themes": None, "tone": "1.5"}]}))
    iso = spark.createDataFrame([("TUR", "TR", "Turkey"), ("DEU", "DE", "Germany"), ("ALB", "AL", "Albania")], "alpha_3 string, alpha_2 string, name string")
    runner.bootstrap(spark, wh, iso)
    regions = {r["iso3"]: r["region_code"] for r in wh.read("dim_country").collect()}
    assert (regions["TUR"], regions["DEU"], regions["ALB"], regions["UNO"]) == ("EU_EUR", "EU_EUR", None, "GLO")
    specs = runner.default_specs(runner.Landing(raw, seeds), wh.read("dim_country"), "2026-03-01")
    for _ in range(2):
        results = runner.run(spark, specs, wh)
        assert [(r.name, r.status, r.input_rows) for r in results] == [
            ("UCDP", "success", 1), ("ACLED", "success", 1), ("ACLED_MANUAL", "success", 1), ("WB", "success", 1), ("OFAC", "success", 2), ("SEED", "success", 1), ("GDELT", "success", 1)]
    assert {r.name: r.counts.get("dropped") for r in results if r.counts} == {"UCDP": 1, "ACLED": 1, "ACLED_MANUAL": 0, "WB": 1}
    assert {r["source_system"]: r["country_iso3"] for r in wh.read("fact_incident").collect()} == {"UCDP_GED": "TUR", "ACLED": "TUR", "ACLED_MANUAL": "TUR"}
    assert {r["source_name"] for r in wh.read("_pipeline_state").collect()} == {s.name for s in specs}
    assert wh.read("fact_news_pulse").first()["topic_tags"] is None  # the key is there, its value is not
    # The persistent views read the current version and agree with the plans.
    views_of = {"country_week_agg": views.country_week_agg(wh.read("fact_incident")), "country_month_agg": views.country_month_agg(wh.read("fact_incident")),
                "country_year_diplomatic": views.country_year_diplomatic(wh.read("fact_diplomatic_action")), "country_week_news": views.country_week_news(wh.read("fact_news_pulse")),
                "grs_monthly": grs.grs_monthly(*[wh.read(t) for t in ("fact_incident", "fact_diplomatic_action", "fact_risk_indicator", "fact_news_pulse")])}
    for name, plan in views_of.items():
        got = spark.table(wh.name(name))
        assert got.columns == plan.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plan.collect()), key=str), name


def test_backfill_lists_cover_countries_once(spark):
    from riskfabric import refdata

    for pairs in (refdata.SEEDED_REGION_COUNTRIES, refdata.BACKFILL_REGION_COUNTRIES):
        codes = [c for _, text in pairs for c in text.split()]
        assert len(codes) == len(set(codes)) and {r for r, _ in pairs} <= {r for r, _ in refdata.REGIONS}
    both = dims.region_map(spark, refdata.SEEDED_REGION_COUNTRIES + refdata.BACKFILL_REGION_COUNTRIES)
    assert both.count() > 200 and both.select("iso3").distinct().count() == both.count()


def test_archive_members_are_tasks_of_their_own(spark, tmp_path):
    path = str(tmp_path / "two.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "id,country\n" + "".join(f"{i},\"X, {i}\nY\"\n" for i in range(700)))
        z.writestr("readme.txt", "no")
        z.writestr("b.csv", "country,id,best\nZ,1000,\n")
    both = archive.read(spark, [path], first_only=False, batch=100)
    assert both.rdd.getNumPartitions() == 2 and both.count() == 701
    rows = {r["id"]: r for r in both.collect()}
    assert rows["3"]["country"] == "X, 3\nY" and rows["3"]["best"] is None and rows["1000"]["best"] is None
    assert rows["699"]["_arrival"]["place"] == 699 and rows["3"]["_arrival"]["file"].endswith("two.zip!a.csv")
    assert archive.read(spark, [path]).count() == 700  # the first member alone, as the source reads it
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("readme.txt", "no")
    with pytest.raises(ValueError, match="no CSV member"):
        ucdp.read_zip(spark, path)
