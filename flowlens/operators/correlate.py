"""Temporal correlation (W1/W2): repeated hits on one destination.

A session is *confirmed* when, counting itself, at least ``repeat_threshold``
sessions to the same ``dst_ip`` started within the trailing window
``[t - window_ms, t]``, where only sessions that come before it in
``(start_time, session_id)`` order are counted.  This is the ordered
"append, then drop entries older than the window" loop of the original
detector, with the tie order made deterministic: among equal start times the
later ``session_id`` sees the earlier one, never the reverse.  Rows with a
NULL ``start_time`` never confirm; a NULL ``dst_ip`` is one destination.

Why not ``Window.partitionBy("dst_ip")``: that puts every session of a
destination in one task, and one destination may carry a third of all
traffic.  Instead time is cut into buckets of ``bucket_ms`` (a divisor of the
window) and each group is ``(dst_ip, bucket)``:

* ``P_own``  -- sessions in the row's own bucket that come before it (running
  count inside the group);
* ``P_edge`` -- sessions in the bucket ``m = window/bucket`` steps back whose
  start is ``>= t - window``.  Every row is also sent, shifted forward by one
  window and with its payload nulled, as a *context* row into that later
  bucket, so this is a running count inside the same group, too;
* ``F``      -- all sessions in the ``m - 1`` whole buckets in between, a
  range-frame sum over the tiny per-``(dst_ip, bucket)`` count table.

``count = P_own + P_edge + F`` is exact for any data; a group holds at most
the rows of one destination in two buckets, however hot the destination.
There is one shuffle of the (narrow) rows, keyed by ``(dst_ip, bucket)``.
The count table is a partial aggregate over a second, pruned read of the
input (key and time only), and it is joined back on the same keys, so the
big side is not shuffled again.  When the input is expensive to recompute
(a model in the plan), the caller checkpoints it first
(``plans.detect.confirmed_sessions``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S

_KN, _KV, _B, _T, _KIND = "_cor_kn", "_cor_kv", "_cor_b", "_cor_t", "_cor_kind"
_HRUN, _CRUN, _CTOT, _HTOT, _FULL = "_cor_hrun", "_cor_crun", "_cor_ctot", "_cor_htot", "_cor_full"


def hit_counts(
    df: DataFrame,
    window_ms: int = S.CORRELATION_WINDOW_MS,
    key: str = "dst_ip",
    time_col: str = "start_time",
    order_col: str = S.SESSION_ID,
    bucket_ms: int = 1000,
    count_col: str = "hit_count",
) -> DataFrame:
    """Every row with a non-NULL time plus ``count_col``: the number of rows
    of the same ``key`` in ``[t - window_ms, t]`` up to and including itself
    in ``(time_col, order_col)`` order."""
    if window_ms <= 0:
        raise ValueError("window_ms must be positive")
    g = math.gcd(int(window_ms), max(1, int(bucket_ms)))  # bucket width divides the window
    m = int(window_ms) // g
    cols = df.columns

    t = F.col(time_col).cast("bigint")
    rows = df.filter(t.isNotNull()).withColumns(
        {
            _KN: F.col(key).isNull(),
            _KV: F.coalesce(F.col(key).cast("string"), F.lit("")),
            _B: ((t - F.pmod(t, F.lit(g))) / F.lit(g)).cast("bigint"),  # exact: numerator is a multiple of g
            _T: t,
        }
    )
    # Each row twice: as itself (kind 0) and as a narrow context copy one
    # window later (kind 1).  One scan; the copy carries only the group key
    # and its shifted time.
    both = rows.withColumn(_KIND, F.explode(F.array(F.lit(0), F.lit(1))))
    is_home = F.col(_KIND) == 0
    both = both.select(
        *[F.when(is_home, F.col(c)).alias(c) for c in cols],
        _KN,
        _KV,
        (F.col(_B) + F.col(_KIND) * F.lit(m)).alias(_B),
        (F.col(_T) + F.col(_KIND) * F.lit(int(window_ms))).alias(_T),
        _KIND,
    )

    grp = Window.partitionBy(_KN, _KV, _B)
    ordered = grp.orderBy(_T, _KIND, order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    home = (1 - F.col(_KIND)).cast("bigint")
    ctx = F.col(_KIND).cast("bigint")
    counted = both.select(
        "*",
        F.sum(home).over(ordered).alias(_HRUN),
        F.sum(ctx).over(ordered).alias(_CRUN),
        F.sum(ctx).over(grp).alias(_CTOT),
    ).filter(is_home)

    # Whole buckets strictly between the edge bucket and the own bucket: a
    # count per (key, bucket) with a map-side partial step, then a range
    # frame over each key's buckets.
    per_bucket = rows.groupBy(_KN, _KV, _B).agg(F.count(F.lit(1)).alias(_HTOT))
    between = per_bucket.select(
        _KN,
        _KV,
        _B,
        F.sum(_HTOT).over(Window.partitionBy(_KN, _KV).orderBy(_B).rangeBetween(-(m - 1), -1)).alias(_FULL),
    )
    joined = counted.join(between, [_KN, _KV, _B], "left")
    total = F.col(_HRUN) + (F.col(_CTOT) - F.col(_CRUN)) + F.coalesce(F.col(_FULL), F.lit(0))
    return joined.select(*[F.col(c) for c in cols], total.alias(count_col))


def temporal_correlation(
    df: DataFrame,
    window_ms: int = S.CORRELATION_WINDOW_MS,
    repeat_threshold: int = S.REPEAT_THRESHOLD,
    key: str = "dst_ip",
    time_col: str = "start_time",
    order_col: str = S.SESSION_ID,
    bucket_ms: int = 1000,
) -> DataFrame:
    """The confirmed rows (hit count >= ``repeat_threshold``), each with
    its ``hit_count``."""
    counted = hit_counts(df, window_ms, key, time_col, order_col, bucket_ms)
    return counted.filter(F.col("hit_count") >= F.lit(int(repeat_threshold)))
