"""Means that do not depend on the order in which tasks finish.

A DOUBLE sum changes in its last digits with the order of addition.  Scores are
short decimals, so they are added as exact decimals; the rare value that does
not fit eight decimals is added as a DOUBLE beside them and nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(18,8)"


def exact_sums(value: Column) -> tuple[Column, Column]:
    """Aggregates (sum of exact decimals, sum of the other values)."""
    exact = value.try_cast(_EXACT)
    fits = exact.cast("double") == value
    return F.sum(F.when(fits, exact)), F.sum(F.when(~F.coalesce(fits, F.lit(False)), value))


def total(exact: Column, other: Column) -> Column:
    """DOUBLE total of two (re-aggregated) sums of ``exact_sums``."""
    return F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(other, F.lit(0.0))
