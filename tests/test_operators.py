import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskfabric import schemas
from riskfabric.operators import asof, latest, lookup, store


def _brute_asof(left, right):
    out = []
    for k, t in left:
        cands = [(rt, v) for rk, rt, v in right if rk == k and k is not None and rt <= t]
        out.append((k, t, max(cands)[1] if cands else None))
    return sorted(out, key=lambda r: (str(r[0]), r[1]))


@pytest.mark.parametrize("strategy", ["interval", "bucketed", "auto"])
def test_asof_matches_brute_force(spark, strategy):
    rnd = random.Random(7)
    base = dt.date(2000, 1, 1)
    keys = ["A", "B", "C", None]
    left = [(rnd.choice(keys), base + dt.timedelta(days=rnd.randint(0, 3000))) for _ in range(400)]
    # key A is hot: a third of the right rows
    right = [(rnd.choice(["A", "A", "A", "B", "C", "D"]), base + dt.timedelta(days=rnd.randint(0, 3000)),
              float(i)) for i in range(300)]
    right = list({(k, t): (k, t, v) for k, t, v in right}.values())
    ldf = spark.createDataFrame(left, "k string, t date")
    rdf = spark.createDataFrame(right, "k string, rt date, v double")
    got = asof.asof_left(ldf, rdf, "k", "t", "rt", ["v"], strategy=strategy, bucket_width=90)
    got = sorted([(r.k, r.t, r.v) for r in got.collect()], key=lambda r: (str(r[0]), r[1]))
    assert got == _brute_asof(left, right)


def test_upsert_semantics_and_idempotence(spark):
    target = spark.createDataFrame([("1", "a", 9, "x"), ("2", "b", 8, "y")], "k string, v string, w int, z string")
    stage = spark.createDataFrame([("1", None, 0), ("3", "c", 0), ("3", "c2", 1)], "k string, v string, seq int")
    once = store.upsert(target, stage, ["k"], order_cols=["seq"])
    rows = {r.k: r for r in once.collect()}
    assert (rows["1"].v, rows["1"].w, rows["1"].z) == (None, 9, "x")   # present-but-NULL overwrites; absent kept
    assert (rows["2"].v, rows["2"].w) == ("b", 8)
    assert (rows["3"].v, rows["3"].w) == ("c", None)                  # first in batch wins; new row default NULL
    twice = store.upsert(once, stage, ["k"], order_cols=["seq"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_table_defaults(spark):
    target = schemas.conform(spark.createDataFrame([("a1",)], "action_id string"), "fact_diplomatic_action")
    stage = spark.createDataFrame([("a2", "sanction")], "action_id string, action_type string")
    merged = store.upsert(target, stage, ["action_id"], "fact_diplomatic_action")
    new = merged.where("action_id = 'a2'").first()
    assert new.confidence_flag == "HIGH" and new.ingested_at_utc is not None


def test_replace_source_and_insert_ignore(spark):
    t = spark.createDataFrame([("1", "ACLED", 1), ("2", "ACLED", 2), ("3", "UCDP_GED", 3), ("4", None, 4)],
                              "k string, source_system string, v int")
    s = spark.createDataFrame([("2", "ACLED", 20)], "k string, source_system string, v int")
    got = sorted(map(tuple, store.replace_source(t, s, ["k"], "source_system", "ACLED").collect()), key=str)
    assert got == sorted([("2", "ACLED", 20), ("3", "UCDP_GED", 3), ("4", None, 4)], key=str)
    ins = store.insert_ignore(t, spark.createDataFrame([("3", "X", 0), ("5", "X", 5), ("5", "Y", 6)],
                                                       "k string, source_system string, v int"),
                              ["k"], order_cols=["v"])
    rows = {r.k: r for r in ins.collect()}
    assert rows["3"].source_system == "UCDP_GED" and rows["5"].v == 5 and ins.count() == 5


def test_dedupe_first_hot_key(spark):
    rows = [("hot", i, f"p{i}") for i in range(3000)] + [("cold", 5, "c5"), ("cold", 2, "c2")]
    df = spark.createDataFrame(rows, "k string, o int, p string").repartition(8)
    got = {r.k: r.p for r in store.dedupe_first(df, ["k"], ["o"]).collect()}
    assert got == {"hot": "p0", "cold": "c2"}


def test_latest_and_pairs(spark):
    df = spark.createDataFrame([
        ("A", dt.date(2000, 1, 1), 1.0), ("A", dt.date(2000, 2, 1), 3.0), ("A", dt.date(2000, 4, 1), 2.0),
        ("B", dt.date(2000, 1, 1), 5.0), (None, dt.date(2001, 1, 1), 9.0)], "c string, m date, g double")
    lat = {r.c: (r.m, r.g) for r in latest.latest_per_key(df, "c", "m").collect()}
    assert lat == {"A": (dt.date(2000, 4, 1), 2.0), "B": (dt.date(2000, 1, 1), 5.0)}
    pairs = latest.adjacent_pairs(df, "c", "m", "g").collect()
    assert [(r.c, r.prev_period, r.current_period, r.current_value - r.prev_value) for r in pairs] == [
        ("A", dt.date(2000, 1, 1), dt.date(2000, 2, 1), 2.0)]


def test_prefix_lookup(spark):
    m = spark.createDataFrame([("IRAN", "IRN", 0), ("IRAN2", "IRN2", 1), ("SDGT", None, 2), ("DPRK", "PRK", 3)],
                              "key string, iso3 string, ord int")
    vals = spark.createDataFrame([("IRAN2",), ("iran2x",), ("SDGT-X",), ("DPRK9",), ("",), ("OTHER",), (None,)], "p string")
    got = dict(lookup.resolve_prefix(vals, "p", m).collect())
    assert got == {"IRAN2": "IRN2", "iran2x": "IRN", "SDGT-X": None, "DPRK9": "PRK", "OTHER": None}
    pairs = [("IRAN", "IRN"), ("IRAN2", "IRN2"), ("SDGT", None), ("DPRK", "PRK")]
    native = dict(vals.select("p", lookup.prefix_value(F.col("p"), pairs)).collect())
    assert native == got | {"": None, None: None}


def test_fuzzy_matches_brute_force(spark):
    from riskfabric.sources.common import overrides_df

    names = ["ALGERIA", "ARGENTINA", "BRAZIL", "CANADA", "EGYPT", "ETHIOPIA", "FRANCE", "GERMANY"]
    countries = spark.createDataFrame([(f"C{i}", None, n, None) for i, n in enumerate(names)], schemas.DIM_COUNTRY)
    probes = ["ALGERIx", "BRAZL", "GERMANI", "XYZ", "FRANCE", "xRANCE", "RANCEE", "JAPxx", "xxAPAN", "FRxNxE", "BxRAZIL"]
    got = dict(lookup.resolve_names(spark.createDataFrame([(p,) for p in probes], "n string"), "n", countries,
                                    overrides_df(spark), fuzzy=True).collect())

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            prev, d[0] = d[0], i
            for j, cb in enumerate(b, 1):
                prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (ca != cb))
        return d[-1]

    for p in probes:
        cands = sorted((lev(p.lower(), n.lower()), f"C{i}") for i, n in enumerate(names)
                       if lev(p.lower(), n.lower()) <= 2)
        assert got[p] == (cands[0][1] if cands else None), p


def test_asof_hot_timestamp(spark):
    base = dt.date(2010, 1, 1)
    left = [("A", base + dt.timedelta(days=30))] * 500 + [("A", base + dt.timedelta(days=400)), ("B", base)]
    right = [("A", base, 1.0), ("A", base + dt.timedelta(days=30), 2.0), ("A", base + dt.timedelta(days=31), 3.0),
             ("B", base + dt.timedelta(days=1), 4.0)]
    ldf = spark.createDataFrame(left, "k string, t date")
    rdf = spark.createDataFrame(right, "k string, rt date, v double")
    for strategy in ("interval", "bucketed"):
        got = sorted([(r.k, r.t, r.v) for r in asof.asof_left(ldf, rdf, "k", "t", "rt", ["v"], strategy=strategy,
                                                               bucket_width=7).collect()])
        assert got == _brute_asof(left, right)
