"""Column-expression helpers; every function returns a JVM-side ``Column``."""

from riskfabric.functions.dates import (
    as_date, between_dates, calendar_parts, format_minute, month_range_filter, month_start,
    parse_date, week_start, windows, year_start,
)
from riskfabric.functions.ids import make_id, normalise_numeric_id
from riskfabric.functions.scoring import band, composite, direction, minmax, per_100k, tone_tension
from riskfabric.functions.text import (
    arrow_label, blank_to_null, clean_text, null_token, prefix, split_part, text_or_empty,
)

__all__ = [
    "as_date", "between_dates", "calendar_parts", "format_minute", "month_range_filter",
    "month_start", "parse_date", "week_start", "windows", "year_start", "make_id",
    "normalise_numeric_id", "band", "composite", "direction", "minmax", "per_100k",
    "tone_tension", "arrow_label", "blank_to_null", "clean_text", "null_token", "prefix",
    "split_part", "text_or_empty",
]
