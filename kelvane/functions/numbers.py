"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def numeric_round(col: Column, digits: int) -> Column:
    """``round(col::numeric, digits)`` as a double.

    A double turns into ``numeric`` through its first 15 significant digits,
    so the noise of a summation order cannot tip a half over. Values that
    have no numeric form pass through, as do those from 1e23 on: at that size a
    double is a whole number.
    """
    as_decimal = F.format_string("%.14e", col).try_cast("decimal(38,15)")
    special = F.isnan(col) | col.isin(INF, -INF)
    return F.when(special, col).otherwise(
        F.coalesce(F.round(as_decimal, digits).cast("double"), col))


def infinite_to_zero(col: Column) -> Column:
    """Replace either infinity by 0.0."""
    return F.when(col.isin(INF, -INF), F.lit(0.0)).otherwise(col)


def exceeds(col: Column, threshold: float) -> Column:
    """Strict ``>`` under which NaN exceeds nothing (Spark orders NaN last)."""
    return ~F.isnan(col) & (col > F.lit(float(threshold)))
