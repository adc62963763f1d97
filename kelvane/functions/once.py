"""Keep costly columns from being evaluated twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Select ``keep`` and the given columns, each evaluated a single time.

    A filter on a computed column is otherwise rewritten in terms of the
    column's inputs and pushed below it, which evaluates long expressions once
    for the filter and again for the output. The optimizer does not push
    through a generator; the outer form adds no filter of its own.
    """
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select(*keep, F.explode_outer(F.array(packed)).alias("_once")).select(
        *keep, *[F.col("_once")[name].alias(name) for name in columns])
