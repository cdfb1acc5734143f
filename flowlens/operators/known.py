"""A filter of fixed size over known pairs, ahead of the anti-join.

A history larger than memory makes suppression a shuffle of all new rows.  Most
new pairs are not known, and a bit map can say so for certain: each known pair
sets ``PROBES`` bits of ``2**bits``, a pair with one of its bits unset is new.
Such rows pass without a join; only the others (known pairs and the few false
positives) are shuffled and compared exactly, so the result is the same.

The map is built by Spark (bits are merged map-side) and has a fixed size
whatever the history: at most ``2**(bits - 6)`` numbers reach the driver and each
worker.  A history too large for it just lets fewer rows pass early.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROBES = 3
#: 16 MB: at eight million pairs one new pair in 1,000 is not told apart.
BITS = 27


def _probes(key: str, bits: int) -> list[Column]:
    """``PROBES`` places of a 64-bit hash (its low bits, and further up)."""
    return [F.pmod(F.shiftrightunsigned(F.col(key), 17 * k), F.lit(1 << bits)) for k in range(PROBES)]


def pair_map(pairs: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bit map of ``pairs`` (src_ip, dst_ip)."""
    keys = pairs.select(F.xxhash64("src_ip", "dst_ip").alias("key"))
    at = keys.select(F.explode(F.array(*_probes("key", bits))).alias("at"))
    cell = F.floor(F.col("at") / 64).alias("cell")
    cells = at.groupBy(cell).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 AS int)))").alias("bits")).toArrow()
    out = np.zeros(max(1, 1 << (bits - 6)), np.int64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return out.view(np.uint64)


def maybe_known(rows: DataFrame, pairs: DataFrame, bits: int = BITS) -> Column:
    """Whether a row's pair may be in ``pairs``: false only if it is not."""
    held = rows.sparkSession.sparkContext.broadcast(pair_map(pairs, bits))

    @F.pandas_udf("boolean")
    def look(key: pd.Series) -> pd.Series:
        x = key.to_numpy().astype(np.int64).view(np.uint64)
        on = np.ones(len(x), bool)
        for k in range(PROBES):
            at = (x >> np.uint64(17 * k)) & np.uint64((1 << bits) - 1)
            on &= (held.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return pd.Series(on)

    return look(F.xxhash64("src_ip", "dst_ip"))
