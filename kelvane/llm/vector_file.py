"""Exact top-k by inner product with a vector-approximation file.

Vectors are quantised to one byte per dimension. A block of candidates is
scanned by its cells alone, which bound every score from both sides; exact
vectors are then read in the order of their upper bounds until no unread one can
reach the k-th score. Blocks of queries meet blocks of candidates, each pair in
a task of bounded size, and the k best of the blocks are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvane.llm.common import picked, saved

CELLS = 256
BLOCK = 4096
RESULT = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def _packed(vectors: list) -> np.ndarray:
    return np.array(vectors, dtype=np.int64).reshape(len(vectors), -1)


def _bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray):
    """Lower and upper bounds of queries x cells, from the cells alone."""
    floor = low + cells.astype(np.float64) * width
    ceiling = floor + (width - 1)
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    # Far above the rounding of these sums; nothing for components below 2**20.
    slack = queries.shape[1] * 2.0**-50 * np.abs(queries).max(initial=0) * max(
        np.abs(floor).max(initial=0), np.abs(ceiling).max(initial=0))
    lower = up @ floor.T + down @ ceiling.T - slack
    return lower, up @ ceiling.T + down @ floor.T + slack


def search_block(query_rows: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of one block for each query of one block."""
    found: list[tuple[int, int, int | None, int]] = []
    if len(query_rows) and len(rows):
        rows = rows.sort_values(["no_id", "vec_id"], kind="stable")
        exact = _packed(rows["vector"].tolist())
        ids, no_id = rows["vec_id"].to_numpy(), rows["no_id"].to_numpy(dtype=bool)
        low = exact.min(axis=0)
        width = (exact.max(axis=0) - low) // CELLS + 1
        cells = ((exact - low) // width).astype(np.uint8)
        for start in range(0, len(query_rows), 256):
            part = query_rows.iloc[start:start + 256]
            queries = _packed(part["vector"].tolist())
            lower, upper = _bounds(queries, cells, low.astype(float), width.astype(float))
            for j, (query_id, key) in enumerate(zip(part["query_id"], part["query_key"])):
                own = (ids == query_id) & ~no_id
                lower[j, own] = -np.inf
                upper[j, own] = -np.inf
                found += [(query_id, key, None if no_id[i] else int(ids[i]), score)
                          for score, i in _read_in_order(queries[j], exact, lower[j], upper[j], k)]
    names = ["query_id", "query_key", "vec_id", "score"]
    columns = list(zip(*found)) or [[]] * 4
    return pd.DataFrame({n: pd.array(list(c), dtype="Int64") for n, c in zip(names, columns)})


def _read_in_order(query, exact, lower, upper, k: int) -> list[tuple[int, int]]:
    """(score, row) of the k best rows; ties go to the smaller row."""
    n = int((upper > -np.inf).sum())
    if not n:
        return []
    least = np.partition(lower, len(lower) - k)[len(lower) - k] if n > k else -np.inf
    order = np.flatnonzero((upper >= least) & (upper > -np.inf))
    order = order[np.argsort(-upper[order], kind="stable")]
    best: list[tuple[int, int]] = []
    step = max(4 * k, 16)
    for start in range(0, len(order), step):
        if len(best) >= k and upper[order[start]] < best[k - 1][0]:
            break
        read = order[start:start + step]
        scores = exact[read] @ query
        best = sorted(best + list(zip(scores.tolist(), read.tolist())),
                      key=lambda x: (-x[0], x[1]))[:k]
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query's k best other rows.

    Components become ``floor(scale * x)`` and scores are integers. ``is_query``
    is a condition on ``vec_id``. Vectors that are null, empty or hold null or
    non-finite components take no part; vectors of different length are not
    compared; a row with the query's id is its own. Rows repeated whole as
    queries count once; as candidates they are separate rows. Null ids are no
    query and rank behind equal scores. Fewer than k candidates give fewer rows.
    Scores must fit a long.

    Of equal vectors only rows of the k + 1 smallest ids can be among the best k,
    as one of the ids may be the query's own, and of each id at most k rows.
    Equal rows are counted before the shuffle.
    """
    rows = picked(vectors, vec_id=id_col, vector=vector_col).filter(usable(F.col("vector")))
    rows = rows.select("vec_id", integers(F.col("vector"), scale).alias("vector"))
    same = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last())
    rows = rows.groupBy("vector", "vec_id").agg(F.count(F.lit(1)).alias("n"))
    # One row per id here, so a row limit is a limit of ids, and runs before the shuffle.
    rows = rows.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1)
    rows = saved(rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
                 .select("vec_id", "vector", "copy").withColumn("size", F.size("vector")))
    queries = picked(vectors, vec_id=id_col, vector=vector_col).filter(
        is_query & usable(F.col("vector")))
    queries = saved(queries.select(F.col("vec_id").alias("query_id"),
                                   integers(F.col("vector"), scale).alias("vector")).distinct()
                    .withColumn("size", F.size("vector"))
                    .withColumn("query_key", F.xxhash64("vector")))
    spread = lambda n: max(1, math.ceil(n / block))
    n_rows, n_queries = spread(rows.count()), spread(queries.count())
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("q", F.pmod(F.xxhash64("query_id", "vector"), F.lit(n_queries))).withColumn(
        "c", each(n_rows))
    right = rows.withColumn("c", F.pmod(F.xxhash64("vec_id", "copy", "vector"), F.lit(n_rows))).withColumn(
        "q", each(n_queries)).select(
        "size", "q", "c", "vector", F.coalesce("vec_id", F.lit(0)).alias("vec_id"),
        F.col("vec_id").isNull().alias("no_id"))
    keys = ["size", "q", "c"]

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return search_block(a, b, k)

    found = left.withColumn("c", F.col("c").cast("bigint")).groupBy(*keys).cogroup(
        right.withColumn("q", F.col("q").cast("bigint")).groupBy(*keys)).applyInPandas(search, RESULT)
    order = Window.partitionBy("query_id", "query_key").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
