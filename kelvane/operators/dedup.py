"""First-write-wins selection by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first in ``order``.

    A ranking of which only the first place is asked: each task keeps one row of
    a key before the shuffle, however many copies there are.
    """
    place = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")
