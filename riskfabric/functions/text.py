"""Text cleaning helpers (E9–E13, E22) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    """Trim, then turn the empty string into NULL."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def clean_text(col: Column | str) -> Column:
    """NULL-safe trimmed text: NULL stays NULL, '' stays ''."""
    return F.trim(_c(col).cast("string"))


def text_or_empty(col: Column | str) -> Column:
    """NULL -> '' then trim (pandas ``fillna('').astype(str).str.strip()``)."""
    return F.trim(F.coalesce(_c(col).cast("string"), F.lit("")))


def null_token(col: Column | str, token: str) -> Column:
    """Exact-match placeholder to NULL (no trimming), e.g. the SDN '-0-'."""
    return F.nullif(_c(col), F.lit(token))


def split_part(col: Column | str, sep: str, index: int) -> Column:
    """0-based element of a literal-separator split; NULL when out of range."""
    import re

    return F.get(F.split(_c(col), re.escape(sep)), index)


def prefix(col: Column | str, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(col), 1, n)


def arrow_label(actor: Column | str, target: Column | str, arrow: str = " → ") -> Column:
    """'actor → target', skipping blank or NULL parts."""
    return F.concat_ws(arrow, F.nullif(_c(actor), F.lit("")), F.nullif(_c(target), F.lit("")))
