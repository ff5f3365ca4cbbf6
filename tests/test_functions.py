import datetime as dt

from pyspark.sql import functions as F

from riskfabric.functions import dates, ids, scoring, text


def test_golden_ids(spark):
    # Ids computed from the definition: SHA-256 of '|'-joined parts, 8-4-4-4-12.
    cases = [
        (["ACLED", "2026-01-04|Turkey|Istanbul|Violence against civilians|Attack|47"],
         "acd6d28c-54c4-d428-42dc-4cf01851bb15"),
        (["ACLED_MANUAL", "2026-02-16|UKR|Political violence (manual aggregate)"],
         "7d205089-9a61-6cb3-6b3b-56f8836a6df6"),
        (["OFAC_SDN", "36", "CUBA"], "0e328441-476e-9722-6580-0bed3d381da8"),
        (["UCDP_GED", "1"], "2d7e7f05-46bc-6e04-319f-58a00aeca7f1"),
        (["USA", "nan", "2017-01-23 00:00:00", "withdrawal", "TPP Withdrawal Memorandum"],
         "c967b4d5-93a8-b439-7003-f58b2012423a"),
    ]
    for parts, want in cases:
        got = spark.range(1).select(ids.make_id(*[F.lit(p) for p in parts]).alias("i")).first()["i"]
        assert got == want


def test_make_id_skips_nulls(spark):
    a = spark.range(1).select(ids.make_id(F.lit("A"), F.lit(None).cast("string"), F.lit("B")).alias("i")).first()["i"]
    b = spark.range(1).select(ids.make_id(F.lit("A"), F.lit("B")).alias("i")).first()["i"]
    assert a == b


def test_normalise_numeric_id(spark):
    df = spark.createDataFrame([("47.0",), ("48",), (None,), (" abc ",), ("1.5",)], "x string")
    got = [r[0] for r in df.select(ids.normalise_numeric_id("x")).collect()]
    assert got == ["47", "48", "", "abc", "1.5"]


def test_windows_90_days(spark):
    def run(a, b):
        r = spark.range(1).select(dates.windows(dates.as_date(a), dates.as_date(b), 90).alias("w")).first()["w"]
        return [(x["window_start"], x["window_end"]) for x in r]

    d = dt.date
    assert run("2020-01-01", "2020-06-30") == [
        (d(2020, 1, 1), d(2020, 3, 30)), (d(2020, 3, 31), d(2020, 6, 28)), (d(2020, 6, 29), d(2020, 6, 30))]
    assert run("2020-01-01", "2020-01-01") == [(d(2020, 1, 1), d(2020, 1, 1))]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),), (dt.date(2021, 1, 3),)], "d date")
    rows = df.select(*[v.alias(k) for k, v in dates.calendar_parts("d").items()]).collect()
    assert (rows[0]["day_of_week"], rows[0]["is_weekend"], rows[0]["week_iso"]) == (0, False, 1)
    assert (rows[1]["day_of_week"], rows[1]["is_weekend"]) == (6, True)
    assert rows[2]["week_iso"] == 53


def test_week_start_is_monday(spark):
    r = spark.range(1).select(dates.week_start(F.lit(dt.date(2026, 1, 4))).alias("w")).first()["w"]
    assert r == dt.date(2025, 12, 29)


def test_band_and_tone(spark):
    df = spark.createDataFrame([(None,), (0.0,), (14.99,), (15.0,), (29.9,), (30.0,), (49.9,), (50.0,)], "s double")
    got = [r[0] for r in df.select(scoring.band(F.col("s"))).collect()]
    assert got == ["No data", "Low", "Low", "Moderate", "Moderate", "Elevated", "Elevated", "High"]
    t = spark.createDataFrame([(None,), (-20.0,), (0.0,), (20.0,)], "t double")
    assert [r[0] for r in t.select(scoring.tone_tension(F.col("t"))).collect()] == [0.5, 1.0, 0.5, 0.0]


def test_arrow_label_and_split(spark):
    df = spark.createDataFrame([("USA", ""), ("", "RUS"), ("USA", "RUS"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(text.arrow_label("a", "b")).collect()] == ["USA", "RUS", "USA → RUS", ""]
    d = spark.createDataFrame([("A - B",), ("Solo",), ("",)], "x string")
    got = d.select(text.blank_to_null(text.split_part("x", " - ", 0)), text.blank_to_null(text.split_part("x", " - ", 1))).collect()
    assert [tuple(r) for r in got] == [("A", "B"), ("Solo", None), (None, None)]


def test_calendar_spine_size(spark):
    from riskfabric.sources import dims

    cal = dims.calendar(spark)
    r = cal.agg(F.count(F.lit(1)).alias("n"), F.min("date_key").alias("lo"), F.max("date_key").alias("hi")).first()
    assert (r.n, r.lo, r.hi) == (7670, dt.date(2010, 1, 1), dt.date(2030, 12, 31))
