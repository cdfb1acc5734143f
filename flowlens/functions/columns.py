"""Small native column helpers shared by the feature operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``n / d`` as DOUBLE, 0.0 when ``d`` is NULL or not positive.

    A NULL numerator over a positive denominator stays NULL (it is imputed to
    0 only when the model matrix is built).
    """
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double")).otherwise(F.lit(0.0))


def flag_present(flags: Column, letter: str) -> Column:
    """1 when the flag string contains ``letter`` (case-sensitive), else 0.

    A NULL flag string gives 0.
    """
    return F.when(flags.contains(letter), F.lit(1)).otherwise(F.lit(0))


def impute(c: Column) -> Column:
    """NULL, NaN, +inf and -inf become 0 (as DOUBLE)."""
    d = c.cast("double")
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(d)
