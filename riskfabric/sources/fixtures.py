"""Canonical-shape stand-in tables derived from the driver's test tables.

These only *shape* rows into the canonical star schema (FIXTURES.md §C); none of
the analytic work happens here. Every analytic query reads them through the
library's plans, so its cost grows with the underlying tables.

Join order is chosen for scale: the order-level side (orders ⋈ customer ⋈
nation ⋈ region) is assembled first and then joined once to lineitem on the
order key, so the lineitem-sized relation is shuffled exactly once. ``nation``
and ``region`` have a size fixed by the benchmark specification (25 and 5 rows
at every scale factor) and are broadcast; every other join is left to Spark's
size-checked strategy selection (auto-broadcast threshold + AQE).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric import schemas
from riskfabric.functions.ids import make_id


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``<sf_dir>/<name>.parquet``, listed anew each time."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_code(col: Column) -> Column:
    """Country code of nation ``n``: 'N' + two digits."""
    return F.concat(F.lit("N"), F.lpad(col.cast("string"), 2, "0"))


def iso2_code() -> Column:
    """Two-letter code of a nation row: its name's first letter and a letter of its own."""
    return F.concat(F.substring("n_name", 1, 1), F.char(F.lit(65) + F.col("n_nationkey")))


def _null_unless(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    return r.select(F.col("r_name").alias("region_code"), F.col("r_name").alias("region_name"))


def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation").where(F.col("n_nationkey") != 24)
    r = read_table(spark, sf_dir, "region")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return j.select(
        nation_code(F.col("n_nationkey")).alias("iso3"),
        iso2_code().alias("iso2"),
        _null_unless(F.col("n_nationkey") != 19, F.col("n_name")).alias("name"),
        _null_unless(F.col("n_nationkey") != 22, F.col("r_name")).alias("region_code"),
    )


def _customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    return c.join(geo, c.c_nationkey == geo.n_nationkey).select("c_custkey", "c_nationkey", "r_name")


def fact_incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    orders_geo = o.join(_customer_geo(spark, sf_dir), o.o_custkey == F.col("c_custkey"))
    j = li.join(orders_geo, li.l_orderkey == orders_geo.o_orderkey)
    nat = F.col("c_nationkey")
    qty = F.col("l_quantity")
    out = j.select(
        F.concat_ws("#", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("source_event_id"),
        F.when(F.col("l_linestatus") == "O", "ACLED").otherwise("UCDP_GED").alias("source_system"),
        F.col("l_shipdate").cast("date").alias("event_date"),
        _null_unless(nat != 23, nation_code(nat)).alias("country_iso3"),
        _null_unless(~nat.isin(22, 23), F.col("r_name")).alias("region_code"),
        _null_unless(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("event_type"),
        (qty * 4 - 100).alias("latitude"),
        (qty * 8 - 200).alias("longitude"),
        _null_unless(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R").alias("civilian_targeting"),
        _null_unless(F.col("l_linenumber") != 7, qty.cast("int")).alias("event_count"),
        F.round(F.col("l_discount") * 100).cast("int").alias("fatalities_best"),
    )
    # FIXTURES.md leaves the key unlisted; derive it the way every source does.
    out = out.withColumn("incident_id", make_id("source_system", "source_event_id"))
    return schemas.conform(out, "fact_incident", fill_defaults=False)


def fact_diplomatic_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    key = F.col("o_orderkey")
    prio = F.substring("o_orderpriority", 1, 1)
    out = j.select(
        key.cast("string").alias("action_id"),
        _null_unless(key % 97 != 0, F.col("o_orderdate").cast("date")).alias("action_date"),
        _null_unless(key % 11 != 0, nation_code(F.col("c_nationkey"))).alias("actor_iso3"),
        _null_unless(key % 7 != 0, nation_code((key + F.col("o_custkey")) % 25)).alias("target_iso3"),
        F.when(prio == "1", "sanction").when(prio == "2", "diplomacy")
        .when(prio == "3", "treaty").when(prio == "4", "alliance").alias("action_type"),
        F.when(F.col("o_orderstatus") == "O", "active")
        .when(F.col("o_orderstatus") == "F", "completed").otherwise("reversed").alias("status"),
        F.concat(F.lit("Order "), key.cast("string")).alias("instrument_name"),
    )
    return schemas.conform(out, "fact_diplomatic_action", fill_defaults=False)


def fact_risk_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population 1995–1999 and a sparse military series per nation (FIXTURES.md §C4).

    Both move with the nation's orders of the year, so that the series are derived from data that grows.
    """
    n = read_table(spark, sf_dir, "nation").select("n_nationkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = read_table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("o_year"))
    ordered = o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey", "o_year").agg(F.count(F.lit(1)).alias("orders"))
    years = F.explode(F.sequence(F.lit(1995), F.lit(1999))).alias("y")
    codes = F.explode(F.array(F.lit("SP.POP.TOTL"), F.lit("MS.MIL.XPND.GD.ZS"))).alias("code")
    grid = n.select("n_nationkey", years).select("n_nationkey", "y", codes)
    grid = grid.join(ordered, (F.col("c_nationkey") == F.col("n_nationkey")) & (F.col("o_year") == F.col("y")), "left")
    own = F.coalesce("orders", F.lit(0))
    nk, y, code = F.col("n_nationkey"), F.col("y"), F.col("code")
    keep = ((code == "SP.POP.TOTL") & (nk != 21)) | (
        (code == "MS.MIL.XPND.GD.ZS") & y.isin(1996, 1998) & ~nk.isin(20, 21)
    )
    value = F.when(code == "SP.POP.TOTL", (500000 + 10000 * nk + 1000 * (y - 1995) + own).cast("double")).otherwise(
        (1 + nk % 7 + own % 3).cast("double") + 0.5 * (y - 1996)
    )
    out = grid.where(keep).select(
        nation_code(nk).alias("country_iso3"),
        F.make_date(y, F.lit(1), F.lit(1)).alias("period_start"),
        code.alias("indicator_code"),
        value.alias("value"),
    )
    return schemas.conform(out, "fact_risk_indicator", fill_defaults=False)


def fact_news_pulse(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    out = j.select(
        F.concat_ws("#", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("item_id"),
        F.col("l_shipdate").alias("published_at_utc"),
        _null_unless((F.col("s_nationkey") < 12) & (F.col("s_nationkey") != 3), nation_code(F.col("s_nationkey"))).alias("country_focus_iso3"),
        _null_unless(F.col("l_linestatus") != "F", F.col("l_tax") * 100 - 4).alias("tone"),
    )
    # published_at_utc keeps the source's zone-less timestamp type (TIMESTAMP_NTZ),
    # which is what the parquet files hold; every other column takes its canonical type.
    return out.select(
        *[
            (out[f.name] if f.name == "published_at_utc"
             else (out[f.name].cast(f.dataType) if f.name in out.columns else F.lit(None).cast(f.dataType))
             ).alias(f.name)
            for f in schemas.FACT_NEWS_PULSE.fields
        ]
    )


@dataclass(frozen=True)
class Warehouse:
    """The canonical tables as lazy DataFrames."""

    fact_incident: DataFrame
    fact_diplomatic_action: DataFrame
    fact_risk_indicator: DataFrame
    fact_news_pulse: DataFrame
    dim_country: DataFrame
    dim_region: DataFrame


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(
        fact_incident=fact_incident(spark, sf_dir),
        fact_diplomatic_action=fact_diplomatic_action(spark, sf_dir),
        fact_risk_indicator=fact_risk_indicator(spark, sf_dir),
        fact_news_pulse=fact_news_pulse(spark, sf_dir),
        dim_country=dim_country(spark, sf_dir),
        dim_region=dim_region(spark, sf_dir),
    )
