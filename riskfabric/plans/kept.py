"""The aggregate views kept up with each load instead of recomputed (A1–A4, SURVEY §1.1).

A state table holds, per group of a view, sums and counts that can be added and taken away (per source
system where sources are counted). Two versions of a fact table share the folders of all
partitions that no load between them touched; the difference of the rest, the old rows taken from the
new ones, is what the groups change by. Only the state's months with such groups are written anew.

The state table names the fact version that it stands for; where that version is gone, the state is rebuilt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfabric.functions import dates
from riskfabric.operators.versioned import Warehouse, _in_partitions
from riskfabric.session import drop_materialized, materialize, shuffles_dropped

#: Partition column of the state tables: the month of a group's week, month or year.
MONTH = "state_month"
_TONE = "decimal(38,12)"


@dataclass(frozen=True)
class KeptView:
    """A view's groups, the sums that stand for them, and its rows from these sums."""

    name: str
    fact: str
    groups: dict[str, Column]
    period: str
    sums: dict[str, Column]
    keep: Column | None
    rows: dict[str, Column]
    #: Groups of the view itself; the state may be finer (a row per source system).
    shown: list[str]


def _n(c: Column | None = None) -> Column:
    return (F.lit(1) if c is None else F.when(c, F.lit(1)).otherwise(F.lit(0))).cast("long")


def kept_views() -> list[KeptView]:
    """The four aggregate views (columns need a running session, so they are made on call)."""
    events = F.coalesce("event_count", F.lit(1)).cast("long")
    sums = {
        "rows": _n(), "events": events, "dead": F.coalesce("fatalities_best", F.lit(0)).cast("long"),
        "dead_known": _n(F.col("fatalities_best").isNotNull()), "civilian": F.when(F.col("civilian_targeting"), events).otherwise(F.lit(0)).cast("long"),
    }
    shown = {
        "incident_count": F.sum("events"), "fatalities_total": F.when(F.sum("dead_known") > 0, F.sum("dead")), "civilian_incidents": F.sum("civilian"),
    }

    return [
        KeptView("country_week_agg", "fact_incident",
                 {"week_start": dates.week_start("event_date"), "country_iso3": F.col("country_iso3"), "region_code": F.col("region_code"),
                  "event_type": F.col("event_type"), "source_system": F.col("source_system")},
                 "week_start", sums, None, {**shown, "source_count": F.countDistinct("source_system")},
                 ["week_start", "country_iso3", "region_code", "event_type"]),
        KeptView("country_month_agg", "fact_incident",
                 {"month_start": dates.month_start("event_date"), "country_iso3": F.col("country_iso3"), "region_code": F.col("region_code")},
                 "month_start", sums, None, shown, ["month_start", "country_iso3", "region_code"]),
        KeptView("country_year_diplomatic", "fact_diplomatic_action",
                 {"year_start": dates.year_start("action_date"), "country_iso3": F.coalesce("target_iso3", "actor_iso3"), "action_type": F.col("action_type")},
                 "year_start", {"rows": _n()}, F.col("action_date").isNotNull(), {"action_count": F.sum("rows")}, ["year_start", "country_iso3", "action_type"]),
        KeptView("country_week_news", "fact_news_pulse",
                 {"week_start": dates.week_start("published_at_utc"), "country_focus_iso3": F.col("country_focus_iso3"), "region_code": F.col("region_code")},
                 "week_start", {"rows": _n(), "tone": F.coalesce(F.col("tone").cast(_TONE), F.lit(0).cast(_TONE)), "tone_known": _n(F.col("tone").isNotNull())},
                 F.col("country_focus_iso3").isNotNull(),
                 {"article_count": F.sum("rows"), "avg_tone": F.sum("tone").cast("double") / F.nullif(F.sum("tone_known"), F.lit(0))},
                 ["week_start", "country_focus_iso3", "region_code"]),
    ]


def state_rows(view: KeptView, fact: DataFrame, sign: int = 1) -> DataFrame:
    """Groups and sums of ``fact`` (one aggregate with map-side combining), with ``MONTH``."""
    rows = fact.where(view.keep) if view.keep is not None else fact
    rows = rows.select(*[c.alias(n) for n, c in view.groups.items()], *[(sign * c).alias(f"_{n}") for n, c in view.sums.items()])
    return _summed(view, rows.groupBy(*view.groups).agg(*[F.sum(f"_{n}").alias(n) for n in view.sums]))


def _summed(view: KeptView, rows: DataFrame) -> DataFrame:
    kinds = {n: _TONE if n == "tone" else "long" for n in view.sums}
    return rows.select(*view.groups, *[F.col(n).cast(k).alias(n) for n, k in kinds.items()], dates.month_start(view.period).alias(MONTH))


def refresh(warehouse: Warehouse, view: KeptView, partition_by: list[str]) -> DataFrame:
    """Bring the view's state up to the fact's current version and return the view's rows.

    ``partition_by`` are the fact table's partition columns.
    """
    table, now = f"{view.name}_state", warehouse.version(view.fact)
    of = warehouse.property(table, "of")
    if now is not None and of != now:
        with shuffles_dropped(warehouse.spark):
            if of is None or not warehouse.exists(of):
                state = materialize(state_rows(view, warehouse.read(view.fact)), f"state-{view.name}")
                touched = state.select(MONTH).distinct()
                held = warehouse.read(table).select(MONTH).distinct() if warehouse.exists(table) else touched.limit(0)
                warehouse.replace(table, state, [MONTH], touched.union(held).distinct().collect(), {"of": now})
            else:
                _apply(warehouse, view, table, of, now, partition_by)
    return rows(view, warehouse.read(table)) if warehouse.exists(table) else rows(view, state_rows(view, warehouse.read(view.fact)))


def _apply(warehouse: Warehouse, view: KeptView, table: str, of: str, now: str, partition_by: list[str]) -> None:
    changed = warehouse.changed(of, now, partition_by)
    delta = state_rows(view, warehouse.read_version(now).where(changed)).unionByName(state_rows(view, warehouse.read_version(of).where(changed), -1))
    delta = delta.groupBy(*view.groups).agg(*[F.sum(n).alias(n) for n in view.sums])
    some = [F.col(n) != 0 for n in view.sums]
    nonzero = some[0]
    for c in some[1:]:
        nonzero = nonzero | c
    delta = materialize(_summed(view, delta.where(nonzero)), f"delta-{view.name}")
    touched = delta.select(MONTH).distinct().collect()  # months
    held = warehouse.read(table).where(_in_partitions(touched, [MONTH])).drop(MONTH)
    both = held.unionByName(delta.drop(MONTH)).groupBy(*view.groups).agg(*[F.sum(n).alias(n) for n in view.sums])
    warehouse.replace(table, _summed(view, both.where("rows <> 0")), [MONTH], touched, {"of": now})
    drop_materialized(delta)


def rows(view: KeptView, state: DataFrame) -> DataFrame:
    """The view's rows from its state: groups and months, not facts, are read."""
    return state.groupBy(*view.shown).agg(*[c.cast("long").alias(n) if n != "avg_tone" else c.alias(n) for n, c in view.rows.items()])
