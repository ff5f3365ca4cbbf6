"""Deterministic identifiers (E1) and source-id normalisation.

All functions return JVM-side Column expressions (no Python UDFs), so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUE: id text layout 8-4-4-4-12 over the first 32 hex digits of SHA-256.
_UUID_PATTERN = r"^(.{8})(.{4})(.{4})(.{4})(.{12})$"
_UUID_REPLACE = "$1-$2-$3-$4-$5"


def key_text(*parts: Column | str) -> Column:
    """The text of an id: parts joined by '|', NULL parts skipped. ``make_id`` of it is ``make_id`` of the parts."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def make_id(*parts: Column | str) -> Column:
    """Stable id from parts joined by '|' (NULL parts skipped), SHA-256, UUID layout.

    ``concat_ws`` skips NULL arguments, which is the "non-None parts" rule.
    """
    digest = F.sha2(key_text(*parts), 256)
    return F.regexp_replace(F.substring(digest, 1, 32), _UUID_PATTERN, _UUID_REPLACE)


def normalise_numeric_id(col: Column | str) -> Column:
    """'47.0' -> '47', NULL -> '', any other text trimmed and kept as is.

    Integral numbers (as parsed by a double cast) are rendered without a
    fractional part; non-numeric text and non-integral numbers keep their text.
    """
    c = F.col(col) if isinstance(col, str) else col
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    num = text.try_cast("double")
    integral = num.isNotNull() & (num % 1 == 0) & ~F.isnan(num) & (F.abs(num) < F.lit(9.2e18))
    return F.when(integral, num.cast("long").cast("string")).otherwise(text)
