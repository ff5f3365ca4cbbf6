"""As-of LEFT join: for every left row, the right row with equal key(s) and the
greatest right timestamp that is ≤ the left timestamp (J1, J2).

Spark has no public as-of join, so three plans are provided:

* ``interval`` — the right side is reduced to validity intervals
  ``[ts, next_ts)`` per key and joined as an equi-join on the keys with a range
  residual. Used when the reduced right side is small by the optimizer's
  estimate (``is_small``) before it is broadcast.
* ``ranged`` — for a right side of any size and keys of any weight, a segmented prefix scan:
  the distinct left (key, time) pairs and the right rows are range-partitioned together by
  (key, time), so that a key with all rows lies in many tasks; a running ``last`` answers
  within a segment, and what a segment inherits from the ones before it is a single value, as only its first
  key can have begun earlier. Those values, one a segment at most, are broadcast.
* ``bucketed`` — the same by fixed time buckets, without the write in between. The as-of is solved for the
  DISTINCT left (key, time) pairs only (rows sharing them share the answer),
  then joined back many-to-one on (key, time). Time is cut into fixed-width
  buckets; inside a (key, bucket) the latest right row at or before each probe
  comes from a running ``last(..., ignorenulls)`` window over probes ∪ right
  rows, and probes with no right row in their bucket take the carry from
  earlier buckets, computed on a per-(key, bucket) summary built with partial
  aggregation. A hot key is split across its buckets (choose ``bucket_width`` to
  taste), repeated timestamps collapse before any window, and the summary has
  at most (#keys × #buckets) rows. No pairs are ever emitted.

NULL keys never match (as in an equi-join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfabric.session import materialize

_LTS, _RTS, _NEXT, _B, _SIDE, _M = "_asof_lts", "_asof_rts", "_asof_next", "_asof_bucket", "_asof_side", "_asof_match"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _reduce_right(right: DataFrame, on: list[str], right_ts: Column | str, value_cols: list[str]) -> DataFrame:
    """One row per (key, ts) — deterministic pick on duplicates — with NULL keys/ts removed."""
    r = right.select(*on, _as_col(right_ts).alias(_RTS), *value_cols)
    r = r.where(F.col(_RTS).isNotNull())
    for k in on:
        r = r.where(F.col(k).isNotNull())
    return r.groupBy(*on, _RTS).agg(F.max(F.struct(*value_cols)).alias("_v")).select(*on, _RTS, "_v.*")


def _numeric_time(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return F.unix_date(col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")) if isinstance(dtype, T.TimestampNTZType) else F.unix_micros(col)
    return col.cast("long")


#: Bytes that a broadcast side may have by the optimizer's estimate.
BROADCAST_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Size check before a broadcast, by the optimizer's estimate in bytes; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= max_bytes


def asof_left(
    left: DataFrame,
    right: DataFrame,
    on: list[str] | str,
    left_ts: Column | str,
    right_ts: Column | str,
    value_cols: list[str],
    *,
    strategy: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    bucket_width: int | None = None,
) -> DataFrame:
    """Left rows plus ``value_cols`` from the as-of matching right row (NULL when none).

    ``strategy``: ``"auto"`` (interval when the reduced right side is estimated at
    ``broadcast_bytes`` or less, else ranged), ``"interval"``, ``"ranged"`` or ``"bucketed"``.
    ``bucket_width`` is in days for DATE time columns and microseconds for
    timestamps (default: 366 days / 1 day).
    """
    on = [on] if isinstance(on, str) else list(on)
    reduced = _reduce_right(right, on, right_ts, value_cols)
    if strategy == "auto":
        strategy = "interval" if is_small(reduced, broadcast_bytes) else "ranged"
    if strategy == "interval":
        return _asof_interval(left, reduced, on, _as_col(left_ts), value_cols)
    if strategy == "ranged":
        return _asof_ranged(left, reduced, on, _as_col(left_ts), value_cols)
    if strategy == "bucketed":
        return _asof_bucketed(left, reduced, on, _as_col(left_ts), value_cols, bucket_width)
    raise ValueError(f"unknown as-of strategy {strategy!r}")


def _asof_interval(left: DataFrame, reduced: DataFrame, on: list[str], lts: Column, value_cols: list[str]) -> DataFrame:
    # Validity intervals on the (size-checked) right side only.
    w = Window.partitionBy(*on).orderBy(_RTS)
    iv = reduced.withColumn(_NEXT, F.lead(_RTS).over(w))
    iv = iv.select(*[F.col(k).alias(f"_asof_k{i}") for i, k in enumerate(on)], _RTS, _NEXT, *value_cols)
    lft = left.withColumn(_LTS, lts)
    cond = [lft[k] == iv[f"_asof_k{i}"] for i, k in enumerate(on)]
    cond.append(lft[_LTS] >= iv[_RTS])
    cond.append(iv[_NEXT].isNull() | (lft[_LTS] < iv[_NEXT]))
    joined = lft.join(F.broadcast(iv), cond, "left")
    return joined.select(*[lft[c] for c in left.columns], *[iv[c] for c in value_cols])


def _segments(left: DataFrame, reduced: DataFrame, on: list[str], value_cols: list[str]) -> DataFrame:
    """Left (key, time) pairs and right rows in one order: on, _t, side, _rv and _part, the segment's number.

    Written once: the bounds of a range partitioning are sampled, so a second run may cut otherwise.
    """
    rv = F.struct(*[F.col(c) for c in value_cols])
    probes = left.select(*on, F.col(_LTS).alias("_t")).dropna(subset=on).distinct().withColumn(_SIDE, F.lit(1))
    rows = reduced.select(*on, F.col(_RTS).alias("_t"), F.lit(0).alias(_SIDE), rv.alias("_rv"))
    both = probes.unionByName(rows, allowMissingColumns=True)
    return materialize(both.repartitionByRange(*on, "_t", _SIDE).withColumn("_part", F.spark_partition_id()), "asof_segments")


def _asof_ranged(left: DataFrame, reduced: DataFrame, on: list[str], lts: Column, value_cols: list[str]) -> DataFrame:
    lft = left.withColumn(_LTS, lts)
    seg = _segments(lft, reduced, on, value_cols)
    running = Window.partitionBy("_part", *on).orderBy("_t", _SIDE).rowsBetween(Window.unboundedPreceding, 0)
    inside = seg.withColumn("_in", F.last("_rv", ignorenulls=True).over(running)).where(F.col(_SIDE) == 1)
    # The last right row of each key and segment: as many rows as keys and segments together.
    ends = seg.groupBy("_part", *on).agg(F.max(F.when(F.col(_SIDE) == 0, F.struct("_t", "_rv"))).alias("_end"))
    earlier = Window.partitionBy(*on).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier)).where("_carry IS NOT NULL")
    carry = carry.select("_part", *on, F.col("_carry._rv").alias("_carry"))
    ans = inside.join(F.broadcast(carry), ["_part", *on], "left")
    ans = ans.select(*on, F.col("_t").alias(_LTS), F.coalesce("_in", "_carry").alias(_M))
    res = lft.join(ans, [*on, _LTS], "left")
    return res.select(*[F.col(c) for c in left.columns], *[F.col(f"{_M}.{c}").alias(c) for c in value_cols])


def _asof_bucketed(left: DataFrame, reduced: DataFrame, on: list[str], lts: Column, value_cols: list[str],
                   bucket_width: int | None) -> DataFrame:
    lft = left.withColumn(_LTS, lts)
    ts_type = lft.schema[_LTS].dataType
    width = bucket_width or (366 if isinstance(ts_type, T.DateType) else 86_400_000_000)
    lb = F.floor(_numeric_time(F.col(_LTS), ts_type) / F.lit(width))
    rb = F.floor(_numeric_time(F.col(_RTS), ts_type) / F.lit(width))
    rv = F.struct(*[F.col(c) for c in value_cols])

    # Left rows that share (key, time) share the answer: solve for DISTINCT
    # (key, time) only (partial aggregation), then join the answers back.
    probes = lft.select(*on, _LTS).distinct().withColumn(_B, lb)

    # Per (key, bucket): the latest right row in that bucket (partial aggregation, skew-safe).
    right_b = reduced.withColumn(_B, rb)
    summary = right_b.groupBy(*on, _B).agg(F.max(F.struct(F.col(_RTS), rv.alias("v"))).alias("_last"))

    # Carry-in for each probed (key, bucket): latest right row from strictly earlier buckets.
    keyset = probes.select(*on, _B).distinct().withColumn("_is_left", F.lit(True))
    grid = keyset.unionByName(summary.withColumn("_is_left", F.lit(False)), allowMissingColumns=True)
    wc = Window.partitionBy(*on).orderBy(_B).rangeBetween(Window.unboundedPreceding, -1)
    carry = (
        grid.withColumn("_carry", F.last(F.col("_last.v"), ignorenulls=True).over(wc))
        .groupBy(*on, _B)
        .agg(F.max("_is_left").alias("_is_left"), F.first("_carry", ignorenulls=True).alias("_carry"))
        .where("_is_left")
        .drop("_is_left")
    )

    # In-bucket match: running last right value over probes ∪ right rows, right rows first on ties.
    prow = probes.select(*on, F.col(_B), F.col(_LTS).alias("_t"), F.lit(1).alias(_SIDE))
    rrow = right_b.select(*on, F.col(_B), F.col(_RTS).alias("_t"), F.lit(0).alias(_SIDE), rv.alias("_rv"))
    u = prow.unionByName(rrow, allowMissingColumns=True)
    wb = Window.partitionBy(*on, _B).orderBy("_t", _SIDE).rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_inb", F.last("_rv", ignorenulls=True).over(wb)).where(F.col(_SIDE) == 1)
    ans = u.join(carry, [*on, _B], "left").select(
        *on, F.col("_t").alias(_LTS), F.coalesce("_inb", "_carry").alias(_M))

    # Back to every left row: many-to-one on (key, time); NULL keys find no answer.
    res = lft.join(ans, [*on, _LTS], "left")
    return res.select(*[F.col(c) for c in left.columns], *[F.col(f"{_M}.{c}").alias(c) for c in value_cols])
