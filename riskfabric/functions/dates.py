"""Date helpers (E3, E7, E8, E20, E21) and range windows."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def week_start(col: Column | str) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.trunc(_c(col).cast("date"), "week")


def month_start(col: Column | str) -> Column:
    return F.trunc(_c(col).cast("date"), "month")


def year_start(col: Column | str) -> Column:
    return F.trunc(_c(col).cast("date"), "year")


def parse_date(col: Column | str, fmt: str | None = "yyyy-MM-dd") -> Column:
    """Text to DATE, unparseable -> NULL. ``fmt=None`` accepts any ISO-like date/time text."""
    c = _c(col).cast("string")
    if fmt is None:
        return F.coalesce(F.try_to_timestamp(F.trim(c)).cast("date"), F.try_to_date(F.trim(c)))
    return F.try_to_date(c, fmt)


def as_date(value: str | _dt.date) -> Column:
    return F.lit(value if isinstance(value, _dt.date) else _dt.date.fromisoformat(value))


def between_dates(col: Column | str, d0: str, d1: str) -> Column:
    """Inclusive date range."""
    return _c(col).between(as_date(d0), as_date(d1))


def month_range_filter(month_col: Column | str, base_col: Column | str, d0: str, d1: str) -> Column:
    """Month-aligned range (F7) plus the implied base-date range.

    ``month_col BETWEEN trunc(d0) AND trunc(d1)`` is what the query means; the
    extra ``base_col`` bounds are equivalent and reach the parquet scan as
    pushed filters (a truncated date is opaque to min/max statistics).
    """
    m0 = F.trunc(as_date(d0), "month")
    m1 = F.trunc(as_date(d1), "month")
    return _c(month_col).between(m0, m1) & (_c(base_col) >= m0) & (_c(base_col) < F.add_months(m1, 1))


def calendar_parts(col: Column | str) -> dict[str, Column]:
    """Calendar attributes of a DATE: ISO week, Monday=0 weekday, weekend flag."""
    d = _c(col)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "week_iso": F.weekofyear(d),
        "day_of_week": F.weekday(d),
        "is_weekend": F.weekday(d) >= 5,
    }


def format_minute(col: Column | str) -> Column:
    """'%Y-%m-%d %H:%M' rendering."""
    return F.date_format(_c(col), "yyyy-MM-dd HH:mm")


def window_starts(start: Column, end: Column, days: int) -> Column:
    """Array of window start dates stepping ``days`` from ``start`` while ≤ ``end``."""
    return F.sequence(start, end, F.expr(f"INTERVAL {int(days)} DAYS"))


def windows(start: Column, end: Column, days: int = 90) -> Column:
    """Array of struct(window_start, window_end) covering [start, end] in ``days``-day windows.

    Each window ends at ``least(start + days - 1, end)``; consecutive windows
    touch without overlap (I3).
    """
    return F.transform(
        window_starts(start, end, days),
        lambda w: F.struct(w.alias("window_start"), F.least(F.date_add(w, days - 1), end).alias("window_end")),
    )
