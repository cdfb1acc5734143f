"""Content-length list parsing and statistics, all native array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DOUBLE_ARRAY = T.ArrayType(T.DoubleType())


def parse_content_length(text: Column) -> Column:
    """Parse a JSON list of numbers into ``ARRAY<DOUBLE>``.

    Anything that is not a JSON array of numbers (NULL, ``abc``, ``123``,
    quoted numbers, truncated text) parses to NULL; ``[1,null,3]`` keeps its
    NULL element.
    """
    return F.from_json(text, _DOUBLE_ARRAY)


def empty_if_null(arr: Column) -> Column:
    """NULL array -> empty array (an empty array stays empty)."""
    return F.coalesce(arr, F.array().cast(_DOUBLE_ARRAY))


def content_length_stats(arr: Column) -> dict[str, Column]:
    """The six statistics over a (never NULL) ``ARRAY<DOUBLE>``.

    ``min``/``max`` skip NULL elements; ``sum`` is a left fold, so one NULL
    element makes sum, mean and std NULL; ``count`` counts NULL elements;
    ``std`` is the sample standard deviation (n - 1), 0.0 below two values.
    Linear in the list's length: the second fold carries the mean in its
    accumulator, where it is computed once, not once per element.
    """
    n = F.size(arr)
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    mean = F.when(n > 0, total / n).otherwise(F.lit(0.0))
    sq = F.aggregate(
        arr,
        F.struct(mean.alias("mean"), F.lit(0.0).alias("sq")),
        lambda acc, x: F.struct(acc["mean"].alias("mean"), (acc["sq"] + (x - acc["mean"]) * (x - acc["mean"])).alias("sq")),
        lambda acc: acc["sq"],
    )
    return {
        "content_len_min": F.when(n > 0, F.array_min(arr)).otherwise(F.lit(0.0)),
        "content_len_max": F.when(n > 0, F.array_max(arr)).otherwise(F.lit(0.0)),
        "content_len_sum": total,
        "content_len_count": n,
        "content_len_mean": mean,
        "content_len_std": F.when(n > 1, F.sqrt(sq / (n - 1))).otherwise(F.lit(0.0)),
    }
