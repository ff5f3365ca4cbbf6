"""Latest row per key (J5/A17) and adjacent-period pairs (J6), both aggregation/equi-join based.

Neither uses a per-key window: a key holding a third of the rows would otherwise
be sorted in one task. ``latest_per_key`` is a ``max(struct)`` aggregate (map-side
partial aggregation collapses a hot key before the shuffle), and
``adjacent_pairs`` is an equi-join on (key, period) where each (key, period) is
unique, so no group ever fans out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str] | str, order_col: str, drop_null_keys: bool = True) -> DataFrame:
    """One row per key: the row with the greatest ``order_col`` (ties: greatest remaining columns).

    Rows with a NULL ``order_col`` are ignored; NULL keys are dropped when
    ``drop_null_keys`` (the inner self-join semantics).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in keys and c != order_col]
    src = df.where(F.col(order_col).isNotNull())
    if drop_null_keys:
        for k in keys:
            src = src.where(F.col(k).isNotNull())
    top = src.groupBy(*keys).agg(F.max(F.struct(F.col(order_col), *[F.col(c) for c in others])).alias("_top"))
    return top.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in [order_col, *others]]).select(*df.columns)


def adjacent_pairs(
    df: DataFrame,
    keys: list[str] | str,
    period_col: str,
    value_col: str,
    step: Column | None = None,
) -> DataFrame:
    """Pairs (previous, current) of the same key where current = previous + one step.

    Output: keys, ``prev_period``, ``current_period``, ``prev_value``, ``current_value``.
    ``step`` maps a period to the next one (default ``add_months(p, 1)``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    nxt = step if step is not None else F.add_months(F.col(period_col), 1)
    a = df.select(*keys, F.col(period_col).alias("prev_period"), nxt.alias("_next"),
                  F.col(value_col).alias("prev_value"))
    b = df.select(*keys, F.col(period_col).alias("current_period"), F.col(value_col).alias("current_value"))
    cond = [a[k] == b[k] for k in keys] + [a["_next"] == b["current_period"]]
    j = a.join(b, cond, "inner")
    return j.select(*[a[k] for k in keys], "prev_period", "current_period", "prev_value", "current_value")
