import datetime as dt
import gzip
import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from riskfabric import schemas
from riskfabric.sources import acled, acled_manual, gdelt, ofac, seed, ucdp, world_bank


@pytest.fixture()
def countries(spark):
    rows = [("TUR", "TR", "Turkey", "EU_EUR"), ("JEY", "JE", "Jersey", "EU_EUR"), ("CHN", "CN", "China", "EAP"),
            ("CHE", "CH", "Switzerland", "EU_EUR"), ("ISR", "IL", "Israel", "MENA"), ("ISL", "IS", "Iceland", "EU_EUR"),
            ("FRA", "FR", "France", "EU_EUR"), ("XKX", "XK", "Kosovo", "EU_EUR"), ("USA", "US", "United States", "AME")]
    return spark.createDataFrame(rows, schemas.DIM_COUNTRY)


ACLED_HEADER = ("WEEK,REGION,COUNTRY,ADMIN1,EVENT_TYPE,SUB_EVENT_TYPE,EVENTS,FATALITIES,POPULATION_EXPOSURE,"
                "DISORDER_TYPE,ID,CENTROID_LATITUDE,CENTROID_LONGITUDE")


def _write(path, text, enc="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=enc) as fh:
        fh.write(text)


def test_acled_literal_cases(spark, tmp_path, countries):
    d = str(tmp_path / "acled")
    _write(f"{d}/Europe_aggregated_data_up_to-2026-01-31.csv", "\n".join([
        ACLED_HEADER,
        "2026-01-04,Europe,Turkey,Istanbul,Violence against civilians,Attack,3,5,,Political violence,47.0,41.0,29.0",
        "2026-01-11,Europe,Bailiwick of Jersey,Jersey,Protests,Peaceful protest,2,0,,Demonstrations,48,49.2,-2.1",
        "bad-date,Europe,Turkey,X,Protests,Peaceful protest,1,0,,Demonstrations,1,0,0",
        "2026-01-01,Europe,Turkey,X,Protests,Peaceful protest,-3,0,,Demonstrations,2,0,0",
    ]) + "\n")
    # decoys: summary file and a spreadsheet are not read
    _write(f"{d}/number_of_events_aggregated_data_up_to-2026-01-31.csv", ACLED_HEADER + "\n")
    _write(f"{d}/Europe_aggregated_data_up_to-2026-01-31.xlsx", "not a csv")
    raw = acled.read(spark, d)
    out = acled.normalise(raw, countries).orderBy("event_date").collect()
    assert len(out) == 2
    a, b = out
    assert a["country_iso3"] == "TUR" and a["civilian_targeting"] is True
    assert a["event_count"] == 3 and a["fatalities_best"] == 5 == a["fatalities_low"] == a["fatalities_high"]
    assert a["source_event_id"] == "2026-01-04|Turkey|Istanbul|Violence against civilians|Attack|47"
    assert a["incident_id"] == "acd6d28c-54c4-d428-42dc-4cf01851bb15"
    assert b["country_iso3"] == "JEY" and b["civilian_targeting"] is False
    assert a["event_date"] == dt.date(2026, 1, 4) and a["location_name"] == "Istanbul"


def test_acled_missing_required_column(spark, tmp_path):
    d = str(tmp_path / "acled2")
    _write(f"{d}/Asia_aggregated_data_up_to-2026-01-31.csv", "WEEK,COUNTRY\n2026-01-04,Turkey\n")
    with pytest.raises(ValueError, match="missing required columns"):
        acled.read(spark, d)


def test_acled_only_invalid_rows_gives_empty(spark, tmp_path, countries):
    d = str(tmp_path / "acled3")
    _write(f"{d}/Europe_aggregated_data_up_to-2026-01-31.csv", "\n".join([
        ACLED_HEADER,
        "bad-date,Europe,Turkey,X,Protests,Peaceful protest,1,0,,Demonstrations,1,0,0",
        "2026-01-01,Europe,Turkey,X,Protests,Peaceful protest,-3,0,,Demonstrations,2,0,0"]) + "\n")
    assert acled.normalise(acled.read(spark, d), countries).count() == 0


def test_name_overrides(spark, countries):
    from riskfabric.operators import lookup
    from riskfabric.sources.common import overrides_df

    names = ["Turkey", "Bailiwick of Jersey", "Bailiwick of Guernsey", "Caribbean Netherlands", "Akrotiri and Dhekelia"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = dict(lookup.resolve_names(df, "n", countries, overrides_df(spark)).collect())
    assert [got[n] for n in names] == ["TUR", "JEY", "GGY", "BES", "CYP"]


MANUAL_HEADER = "country_iso3,week_start,event_type,sub_event_type,event_count,fatalities_best,source_url,notes"


def test_manual_backfill(spark, tmp_path):
    p = str(tmp_path / "manual.csv")
    _write(p, MANUAL_HEADER + "\n ukr ,2026-02-16,Political violence (manual aggregate),,1401,925,http://x,\n")
    out = acled_manual.normalise(acled_manual.read(spark, p)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["country_iso3"] == "UKR" and r["incident_id"] == "7d205089-9a61-6cb3-6b3b-56f8836a6df6"
    assert r["civilian_targeting"] is None and r["event_count"] == 1401 and r["notes"] is None


@pytest.mark.parametrize("line,msg", [
    ("UKR,bad,X,,1,1,,", "invalid week_start"),
    ("UKR,2025-12-01,X,,1,1,,", "must stay within"),
    (",2026-02-16,X,,1,1,,", "non-empty"),
    ("UKR,2026-02-16,X,,abc,1,,", "numeric"),
    ("UKR,2026-02-16,X,,-1,1,,", ">= 0"),
])
def test_manual_rules(spark, tmp_path, line, msg):
    p = str(tmp_path / "m.csv")
    _write(p, MANUAL_HEADER + "\n" + line + "\n")
    with pytest.raises(ValueError, match=msg):
        acled_manual.normalise(acled_manual.read(spark, p))


def test_manual_duplicate_keys(spark, tmp_path):
    p = str(tmp_path / "m.csv")
    _write(p, MANUAL_HEADER + "\nUKR,2026-02-16,X,,1,1,,\nukr,2026-02-16,X,,2,1,,\n")
    with pytest.raises(ValueError, match="Duplicate"):
        acled_manual.normalise(acled_manual.read(spark, p))


UCDP_CSV = (
    "id,date_start,date_end,country,adm_1,latitude,longitude,where_prec,type_of_violence,dyad_name,best,low,high\n"
    "1,2020-01-02 00:00:00.000,2020-01-03,Turkey,Istanbul,41,29,1,3,Government of Turkey - Civilians,5,4,6\n"
    "2,not-a-date,2020-01-03,Turkey,,41,29,1,1,,1,1,1\n"
    "3,2020-02-02,2020-02-02,Russia,,55,37,2,1,Solo,2.7,,\n"
)


def test_ucdp_csv_and_zip(spark, tmp_path, countries):
    p = str(tmp_path / "ged.csv")
    _write(p, UCDP_CSV)
    out = {r["source_event_id"]: r for r in ucdp.normalise(ucdp.read(spark, p), countries).collect()}
    assert set(out) == {"1", "3"}
    r1, r3 = out["1"], out["3"]
    assert r1["incident_id"] == "2d7e7f05-46bc-6e04-319f-58a00aeca7f1"
    assert r1["event_type"] == "one-sided violence" and r1["civilian_targeting"] is True
    assert (r1["actor1_name"], r1["actor2_name"]) == ("Government of Turkey", "Civilians")
    assert r3["country_iso3"] == "RUS" and r3["fatalities_best"] == 2 and r3["fatalities_low"] == 0
    assert (r3["actor1_name"], r3["actor2_name"]) == ("Solo", None)
    z = str(tmp_path / "ged.zip")
    with zipfile.ZipFile(z, "w") as zf:
        zf.writestr("ged251.csv", UCDP_CSV)
    cols = UCDP_CSV.splitlines()[0].split(",")
    zraw = ucdp.read_zip(spark, z, cols)
    assert ucdp.normalise(zraw, countries).count() == 2


def test_world_bank_pages(spark, tmp_path, countries):
    d = str(tmp_path / "wb")
    _write(f"{d}/SP.POP.TOTL/page_001.json", json.dumps([
        {"countryiso3code": "tur", "country": {"id": "TR"}, "date": "2020", "value": 83.0, "unit": ""},
        {"countryiso3code": "", "country": {"id": "XK"}, "date": "2021", "value": 1.8, "unit": "n"},
        {"countryiso3code": "", "country": {"id": "FR"}, "date": "2021", "value": 67.0},
        {"countryiso3code": "", "country": {"id": "ZZ"}, "date": "2021", "value": 1.0},
        {"countryiso3code": "TUR", "country": {"id": "TR"}, "date": "20x1", "value": 1.0},
        {"countryiso3code": "TUR", "country": {"id": "TR"}, "date": "2019", "value": None},
        None,
    ]))
    _write(f"{d}/UNKNOWN.CODE/page_001.json", json.dumps([{"countryiso3code": "TUR", "date": "2020", "value": 1.0}]))
    out = world_bank.normalise(world_bank.read(spark, d), countries)
    got = sorted((r["country_iso3"], str(r["period_start"]), r["value"], r["unit"], r["indicator_name"])
                 for r in out.collect())
    assert got == [("", "2021-01-01", 1.0, "", "population_total"),
                   ("FRA", "2021-01-01", 67.0, "", "population_total"),
                   ("TUR", "2020-01-01", 83.0, "", "population_total"),
                   ("XKX", "2021-01-01", 1.8, "n", "population_total")]


def test_gdelt_articles(spark, tmp_path, countries):
    d = str(tmp_path / "gdelt")
    arts = [
        {"url": "u1", "title": "t1", "seendate": "20250102T030405Z", "domain": "d", "sourcecountry": "CH",
         "tone": "-2.5"},
        {"url": "u2", "title": "t2", "seendate": "20250102T030405Z", "domain": "d", "sourcecountry": "Israel",
         "tone": "x"},
        {"url": "u3", "title": "t3", "seendate": "bad", "domain": "d", "sourcecountry": "IS", "tone": "1"},
        {"url": "u4", "title": "t4", "seendate": "20250102T030405Z", "domain": "d", "sourcecountry": "Nowhere"},
    ]
    _write(f"{d}/artlist_20250101_20250131.json", json.dumps({"articles": arts}))
    _write(f"{d}/artlist_20250201_20250228.json", json.dumps({"articles": [dict(arts[0], title="dup")]}))
    _write(f"{d}/artlist_20250301_20250331.json", json.dumps(["not", "a", "dict"]))
    out = {r["url"]: r for r in gdelt.normalise(gdelt.read(spark, d), countries).collect()}
    assert set(out) == {"u1", "u2", "u3", "u4"}
    assert out["u1"]["country_focus_iso3"] == "CHN" and out["u1"]["title"] == "t1"   # FIPS wins, first kept
    assert out["u2"]["country_focus_iso3"] == "ISR" and out["u2"]["tone"] is None
    assert out["u3"]["country_focus_iso3"] == "ISR" and out["u3"]["published_at_utc"] is None
    assert out["u4"]["country_focus_iso3"] is None
    assert out["u1"]["published_at_utc"] == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert out["u1"]["topic_tags"] == "-2.5"   # no themes in the input: tags from tone


def test_ofac_programs(spark, tmp_path):
    p = str(tmp_path / "sdn.csv")
    lines = [
        '36,"AEROCARIBBEAN AIRLINES",-0-,CUBA,-0-,-0-,-0-,-0-,-0-,-0-,-0-,"Havana"',
        '100,"X CORP",-0-,"IRAN2X; SDGT",-0-,-0-,-0-,-0-,-0-,-0-,-0-,-0-',
        '101,"Y",-0-,"DPRK3",-0-,-0-,-0-,-0-,-0-,-0-,-0-,-0-',
        '102,"Z",-0-,-0-,-0-,-0-,-0-,-0-,-0-,-0-,-0-,-0-',
        '103,"SHORT",-0-,SYRIA',
        '104,"LONG",-0-,SYRIA,-0-,-0-,-0-,-0-,-0-,-0-,-0-,-0-,extra,more',
    ]
    _write(p, "\n".join(lines) + "\n", enc="latin-1")
    out = ofac.normalise(ofac.read(spark, p), "2026-03-03").collect()
    got = sorted((r["legal_basis"], r["target_iso3"], r["instrument_name"]) for r in out)
    assert got == [
        ("", None, "SDN: Z ()"),
        ("CUBA", None, "SDN: AEROCARIBBEAN AIRLINES (CUBA)"),
        ("DPRK3", "PRK", "SDN: Y (DPRK3)"),
        ("IRAN2X", "IRN", "SDN: X CORP (IRAN2X)"),
        ("SDGT", None, "SDN: X CORP (SDGT)"),
        ("SYRIA", "SYR", "SDN: SHORT (SYRIA)"),
    ]
    cuba = [r for r in out if r["legal_basis"] == "CUBA"][0]
    assert cuba["action_id"] == "0e328441-476e-9722-6580-0bed3d381da8"
    assert cuba["notes"] == "Havana" and cuba["action_date"] == dt.date(2026, 3, 3) and cuba["confidence_flag"] == "LOW"


def test_seed_ids(spark, tmp_path):
    p = str(tmp_path / "seed.csv")
    _write(p, "action_id,action_date,actor_iso3,target_iso3,action_type,action_subtype,instrument_name,legal_basis,"
              "status,source_url,region,notes\n"
              "x,2017-01-23,USA,,withdrawal,trade,TPP Withdrawal Memorandum,,completed,http://s,AME,\n")
    r = seed.normalise(seed.read(spark, p)).first()
    assert r["action_id"] == "c967b4d5-93a8-b439-7003-f58b2012423a"
    assert r["action_date"] == dt.date(2017, 1, 23) and r["confidence_flag"] == "HIGH" and r["target_iso3"] is None


def test_acled_files_with_different_headers(spark, tmp_path, countries):
    d = str(tmp_path / "acled4")
    row = "2026-01-04,Europe,Turkey,Istanbul,Violence against civilians,Attack,3,5,,PV,47.0,41.0,29.0"
    _write(f"{d}/Europe_aggregated_data_up_to-2026-01-31.csv", ACLED_HEADER + "\n" + row + "\n")
    _write(f"{d}/Asia_aggregated_data_up_to-2026-01-31.csv", ACLED_HEADER + "\n" + row.replace("Istanbul", "Izmir") + "\n")
    # same columns, lower case and a different order
    cols = ACLED_HEADER.lower().split(",")
    vals = "2026-01-11,Europe,Turkey,Ankara,Protests,Peaceful protest,2,0,,D,48,39.9,32.8".split(",")
    order = list(reversed(range(len(cols))))
    _write(f"{d}/Africa_aggregated_data_up_to-2026-01-31.csv",
           ",".join(cols[i] for i in order) + "\n" + ",".join(vals[i] for i in order) + "\n")
    out = {r.admin1: r for r in acled.normalise(acled.read(spark, d), countries).collect()}
    assert set(out) == {"Istanbul", "Izmir", "Ankara"}
    assert out["Ankara"].event_count == 2 and out["Ankara"].event_type == "Protests"


def test_gdelt_folder_is_one_path(spark, tmp_path):
    """The folder's lists are listed at once, not a path a file; other files and folders stay out."""
    d = tmp_path / "gdelt"
    (d / "older").mkdir(parents=True)
    for name in ("artlist_00000.json", "artlist_00001.json", "other.json", "older/artlist_00009.json"):
        (d / name).write_text(json.dumps({"articles": [{"url": f"u/{name}", "title": None}]}))
    found = gdelt.read(spark, str(d))
    assert sorted(r["url"] for r in found.collect()) == ["u/artlist_00000.json", "u/artlist_00001.json"]
    assert "InMemoryFileIndex(1 paths)" in found._jdf.queryExecution().toString()
