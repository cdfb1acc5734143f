"""Temporal correlation as keyed state with event-time timers.

The counterpart of ``streaming.correlate`` inside one streaming query, without
``foreachBatch``: ``applyInPandasWithState`` on (destination, time bucket).  A row
goes to its own bucket and, as narrow context, to the ``window / bucket_ms`` ones
after it, whose rows may count it.  A group waits until the watermark has passed
its bucket, so everything that can count has arrived (Spark drops what is later);
its timer then counts the hits of all its rows in order, emits the confirmed ones
and removes the state.  No state outlives its bucket by more than the lateness,
and a destination with very many rows has a group for each bucket, so
``bucket_ms`` bounds what one task holds.

Rows are emitted when their bucket closes, up to ``bucket_ms`` later than by
``streaming.correlate``; which rows, and their counts, are the same.  Null
destinations are one destination, rows without a time never count.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schema as S

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def hits(times: np.ndarray, window_ms: int) -> np.ndarray:
    """Of sorted times: how many lie in the window up to and with each."""
    return np.arange(1, len(times) + 1) - np.searchsorted(times, times - window_ms, side="left")


def keyed_correlation(
    rows: DataFrame,
    window_ms: int = S.CORRELATION_WINDOW_MS,
    repeat_threshold: int = S.REPEAT_THRESHOLD,
    lateness_ms: int = S.CORRELATION_WINDOW_MS,
    bucket_ms: int | None = None,
) -> DataFrame:
    """A stream of narrow rows (``session_id``, ``dst_ip``, ``start_time`` and
    any payload) -> its confirmed rows with ``hit_count``, each once."""
    bucket_ms = int(bucket_ms or window_ms)
    if window_ms % bucket_ms:
        raise ValueError("bucket_ms must divide window_ms")
    after = window_ms // bucket_ms
    schema = rows.schema
    bucket = F.floor(F.col("start_time") / F.lit(bucket_ms)).cast("long")
    timed = (
        rows.filter(F.col("start_time").isNotNull())
        .withColumn("event_time", F.timestamp_millis("start_time"))
        .withWatermark("event_time", f"{int(lateness_ms)} milliseconds")
    )
    dealt = timed.select(
        F.col("dst_ip").alias("key"),
        F.col("start_time").alias("t"),
        F.col(S.SESSION_ID).cast("long").alias("id"),
        F.to_json(F.struct(*[F.col(c) for c in schema.names])).alias("row"),
        "event_time",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(after)), lambda k: F.struct((bucket + k).alias("bucket"), (k == 0).alias("home")))).alias("to"),
    ).select("key", "to.bucket", "t", "id", F.when(F.col("to.home"), F.col("row")).alias("row"), "event_time")

    def step(key, frames, state: GroupState):
        if state.hasTimedOut:
            t, i, row = (list(x) for x in state.get)
            state.remove()
            if any(r is not None for r in row):
                order = sorted(range(len(t)), key=lambda k: (t[k], i[k]))
                count = hits(np.array([t[k] for k in order], dtype=np.int64), window_ms)
                out = [(row[k], int(n)) for k, n in zip(order, count) if row[k] is not None and n >= repeat_threshold]
                if out:
                    yield pd.DataFrame(out, columns=["row", "hit_count"])
            return
        t, i, row = ([list(x) for x in state.get]) if state.exists else ([], [], [])
        for frame in frames:
            t.extend(frame["t"].tolist())
            i.extend(frame["id"].tolist())
            row.extend(None if pd.isna(x) else x for x in frame["row"])
        state.update((t, i, row))
        state.setTimeoutTimestamp((int(key[1]) + 1) * bucket_ms)

    found = dealt.groupBy("key", "bucket").applyInPandasWithState(
        step, "row string, hit_count long", "t array<bigint>, i array<bigint>, row array<string>", "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(F.from_json("row", schema).alias("row"), "hit_count").select("row.*", "hit_count")
