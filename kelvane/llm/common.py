"""What the operators share: session settings, inputs, checkpoints, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvane.session import conf_scope, shared_root, tune

# Rows in an Arrow batch: a batch of very long texts must fit a worker's memory.
BATCH_ROWS = 500
# For data frames made under it and run once.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def saved(rows: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder.

    What was shuffled for them is removed at once, as nothing reads it again; Spark
    by itself waits until the driver collects garbage, which small steps never cause.
    """
    shared_root(rows.sparkSession)
    with conf_scope(rows.sparkSession, SHUFFLES_GO):
        return rows.select("*").checkpoint()


def picked(rows: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names an operator works with.

    Everything else stays behind, so extra columns cannot clash.
    """
    return rows.select(*[F.col(f"`{column}`").alias(name) for name, column in columns.items()])


def map_batches(rows: DataFrame, schema: str,
                start: Callable[[], Callable[[list[list]], list[list]]],
                end: Callable[[], None] = lambda: None) -> DataFrame:
    """Per Arrow batch, turn lists of column values into lists of column values.

    ``start`` runs once per task and returns the function for its batches, so
    models and caches are set up once. ``end`` runs when the task is through: a
    worker lives on, and what it keeps adds to the memory of the steps after it.
    """
    names = rows.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        try:
            for batch in batches:
                if batch.num_rows:
                    columns = function([column.to_pylist() for column in batch.columns])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, field.type) for values, field in zip(columns, arrow)],
                        schema=arrow)
        finally:
            end()

    return rows.mapInArrow(run, schema)


def batch_column(values: Column, kind: str, start: Callable[[], Callable[[list], list]]) -> Column:
    """A column worked out per Arrow batch; the other columns stay in the JVM.

    ``start`` runs once per task. For a struct its function gives a tuple of
    lists, one for each field.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        function = start()
        for batch in batches:
            yield pd.Series(function(batch.tolist()), dtype=object)

    def run_struct(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        function = start()
        for batch in batches:
            yield pd.DataFrame(dict(zip(names, function(batch.tolist()))))

    names = [field.strip().split(" ")[0] for field in kind.split(",")] if ", " in kind else []
    return F.pandas_udf(run_struct if names else run, kind)(values)


def unused(rows: DataFrame, name: str) -> str:
    """``name``, with underscores until no column is called so."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
