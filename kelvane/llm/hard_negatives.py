"""Hard negatives by bounds along a spanning tree of anchors.

Scores are inner products. For an edge of length d between two anchors, the
scores of a candidate c at its ends differ by at most d |c|, so what is known at
the parent bounds the child. Anchors fall into groups of bounded size, each with
its minimum spanning tree, and candidates into blocks; a task walks one tree
over one block from the root down and works out a score only where the bounds
overlap the child's window of useful scores. The others pass their bounds on.

Two walks: the first finds each anchor's positives (window: from the k-th best
so far up), the second the negatives (window: between a share of a positive's
score and that score, from the k-th best so far up). The best of the blocks are
merged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvane.llm.common import picked, saved
from kelvane.llm.vector_file import integers, usable

GROUP, BLOCK = 2048, 16384
# Rows of a block that walk the tree together.
STEP = 1024
# Relative width that covers every rounding of a bound, far above 2**-53.
SLACK = 2.0**-40
TREE = ("size int, g bigint, anchor bigint, anchor_id bigint, label string, vector array<bigint>, "
        "place int, parent int, level int, edge double")


def _packed(vectors) -> np.ndarray:
    return np.array(list(vectors), dtype=np.int64).reshape(len(vectors), -1)


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``order, parent, level, edge`` of a minimum spanning tree.

    ``order`` lists the points by level, the root (nearest to the mean) first;
    ``parent`` holds places in that order, -1 at the root; ``edge`` is at least
    the distance to the parent.
    """
    n = len(points)
    at = points.astype(np.float64)
    root = int(((at - at.mean(axis=0)) ** 2).sum(axis=1).argmin())
    near, via = np.full(n, np.inf), np.full(n, -1)
    level, left = np.zeros(n, np.int64), np.ones(n, bool)
    new = root
    for _ in range(n):
        left[new] = False
        if via[new] >= 0:
            level[new] = level[via[new]] + 1
        closer = ((at - at[new]) ** 2).sum(axis=1)
        better = left & (closer < near)
        near[better], via[better] = closer[better], new
        near[new] = np.inf
        new = int(near.argmin())
    order = np.argsort(level, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    parent = np.where(via[order] >= 0, place[via[order]], -1)
    edge = np.sqrt(((at[order] - at[via[order]]) ** 2).sum(axis=1)) * (1 + SLACK)
    return order, parent, level[order], np.where(parent < 0, 0.0, edge)


def plant(rows: pd.DataFrame) -> pd.DataFrame:
    """Anchors of one group in the order of their tree."""
    order, parent, level, edge = spanning_tree(_packed(rows["vector"]))
    return rows.iloc[order].assign(place=np.arange(len(rows), dtype=np.int32), parent=parent.astype(np.int32),
                                   level=level.astype(np.int32), edge=edge)


@dataclass
class Best:
    """The k best rows of a window of scores: highest first, then by id, null ids last."""

    k: int
    low: float = -math.inf
    high: float = math.inf
    rows: list[tuple[int, bool, int]] = field(default_factory=list)  # (-score, no_id, vec_id)

    def least(self) -> float:
        """No lower score can enter."""
        return max(self.low, -self.rows[-1][0]) if len(self.rows) == self.k else self.low

    def offer(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        fits = np.flatnonzero((scores >= self.least()) & (scores <= self.high))
        if len(fits) > self.k:
            fits = fits[np.lexsort((ids[fits], no_id[fits], -scores[fits]))[:self.k]]
        if len(fits):
            new = zip((-scores[fits]).tolist(), no_id[fits].tolist(), ids[fits].tolist())
            self.rows = sorted([*self.rows, *new])[:self.k]


def walk(tree: pd.DataFrame, rows: pd.DataFrame, wanted: list[list[Best]], same_label: bool) -> int:
    """Offer the rows to ``wanted``, the windows of each anchor in tree order.

    Only rows of the anchor's label, or only those of others, are offered, and
    none with the anchor's id. Returns how many scores were worked out.
    """
    anchors, scored = _packed(tree["vector"]), 0
    anchor_ids = tree["anchor_id"].to_numpy()
    labels = pd.Index(pd.concat([tree["label"], rows["label"]]).unique())
    anchor_label = labels.get_indexer(tree["label"])
    parent, edge, level = (tree[c].to_numpy() for c in ("parent", "edge", "level"))
    edge = edge + SLACK * _norms(anchors).max()
    starts = np.searchsorted(level, np.arange(level[-1] + 2))
    for first in range(0, len(rows), STEP):
        part = rows.iloc[first:first + STEP]
        vectors = _packed(part["vector"])
        norms = _norms(vectors)
        # Sums of integers below 2**53 are exact in floating point, which is faster.
        exact = norms.max() * _norms(anchors).max() < 2**52
        at, to = (vectors.astype(np.float64), anchors.astype(np.float64)) if exact else (vectors, anchors)
        ids, no_id = part["vec_id"].to_numpy(), part["no_id"].to_numpy(dtype=bool)
        label = labels.get_indexer(part["label"])
        lower = np.empty((len(anchors), len(part)))
        upper = np.empty_like(lower)
        for a, b in zip(starts[:-1], starts[1:]):
            if a == 0:
                lower[0], upper[0] = -np.inf, np.inf
            else:
                margin = edge[a:b, None] * norms
                lower[a:b] = lower[parent[a:b]] - margin
                upper[a:b] = upper[parent[a:b]] + margin
            for j in range(a, b):
                if j == 0:
                    need = np.arange(len(part))
                elif not wanted[j]:
                    continue
                else:
                    floor = min(w.least() for w in wanted[j])
                    ceiling = max(w.high for w in wanted[j])
                    need = np.flatnonzero(((label == anchor_label[j]) == same_label)
                                          & (upper[j] >= floor) & (lower[j] <= ceiling))
                if not len(need):
                    continue
                scores = (at[need] @ to[j]).astype(np.int64)
                lower[j, need] = upper[j, need] = scores
                scored += len(need)
                fit = ((label[need] == anchor_label[j]) == same_label) & (no_id[need] | (ids[need] != anchor_ids[j]))
                for window in wanted[j]:
                    window.offer(scores[fit], no_id[need][fit], ids[need][fit])
    return scored


def _blocks(tree: DataFrame, rows: DataFrame, n_groups: int, n_blocks: int):
    """Each group of anchors beside each block of rows."""
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    keys = ["size", "g", "b"]
    right = rows.withColumn("b", F.pmod(F.xxhash64("row"), F.lit(n_blocks))).withColumn("g", each(n_groups)).select(
        *keys, F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("no_id"),
        "label", "vector")
    return tree.withColumn("b", each(n_blocks)).groupBy(*keys).cogroup(right.groupBy(*keys))


def _found(keys: list[tuple], names: list[str], wanted: list[list[Best]]) -> pd.DataFrame:
    """One row per row of a window, behind the window's keys."""
    out = [(*key, None if no_id else vec_id, -minus)
           for key, windows in zip(keys, wanted) for w in windows for minus, no_id, vec_id in w.rows]
    columns = list(zip(*out)) or [[]] * (len(names) + 2)
    return pd.DataFrame({n: pd.array(list(c), dtype="Int64") for n, c in zip([*names, "vec_id", "score"], columns)})


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: int = 80,
         scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``. An anchor's positives are the
    ``positives`` rows of its label with the highest scores; for each, the
    ``negatives`` highest-scoring rows of other labels that score at most as
    much and at least ``share`` in 100 of it. Ties go to the smaller id.

    ``is_anchor`` is a condition on ``vec_id``. Rows whose label or vector is
    null, whose vector is empty or holds null or non-finite components take no
    part; vectors of different length are not compared; rows with the anchor's
    id are its own. Rows repeated whole are one anchor, but separate positives
    and negatives: a positive that occurs twice has its rows twice. Null ids are
    no anchor and rank behind equal scores. Fewer candidates give fewer rows.
    Scores and their hundredfold must fit a long.
    """
    rows = picked(vectors, vec_id=id_col, vector=vector_col, label=label_col).filter(
        F.col("label").isNotNull() & usable(F.col("vector")))
    rows = saved(rows.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("string").alias("label"),
        integers(F.col("vector"), scale).alias("vector"), F.size("vector").alias("size")))
    anchors = saved(rows.filter(is_anchor).groupBy("size", "vec_id", "label", "vector").agg(
        F.min("row").alias("anchor")))
    spread = lambda n, most: max(1, math.ceil(n / most))
    n_groups, n_blocks = spread(anchors.count(), group), spread(rows.count(), block)
    tree = saved(anchors.select(
        "size", F.pmod(F.xxhash64("anchor"), F.lit(n_groups)).alias("g"), "anchor",
        F.col("vec_id").alias("anchor_id"), "label", "vector", *[F.lit(0).alias(c) for c in ("place", "parent", "level")],
        F.lit(0.0).alias("edge")).groupBy("size", "g").applyInPandas(plant, TREE))

    def near(nodes: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("place")
        wanted = [[Best(positives)] for _ in range(len(nodes))]
        if len(nodes) and len(part):
            walk(nodes, part, wanted, same_label=True)
        return _found([(a,) for a in nodes["anchor"]], ["anchor"], wanted)

    found = _blocks(tree, rows, n_groups, n_blocks).applyInPandas(near, "anchor bigint, vec_id bigint, score bigint")
    best = saved(_ranked(found, ["anchor"], positives))

    def below(nodes: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("place")
        keys, wanted = [], []
        for tops in nodes["tops"]:
            tops = sorted({int(t) for t in tops}, reverse=True) if tops is not None else []
            keys.append(tops)
            # The least score s with 100 s >= share * top.
            wanted.append([Best(negatives, -(-share * top // 100), top) for top in tops])
        if len(nodes) and len(part):
            walk(nodes, part, wanted, same_label=False)
        flat = [(a, top) for a, tops in zip(nodes["anchor"], keys) for top in tops]
        return _found(flat, ["anchor", "top"], [[w] for windows in wanted for w in windows])

    # Below zero no score lies between a share of the positive's and its own.
    tops = best.filter("score >= 0").groupBy("anchor").agg(F.collect_set("score").alias("tops"))
    found = _blocks(tree.join(tops, "anchor", "left"), rows, n_groups, n_blocks).applyInPandas(
        below, "anchor bigint, top bigint, vec_id bigint, score bigint")
    hard = _ranked(found, ["anchor", "top"], negatives).select(
        "anchor", F.col("top").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    pairs = best.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(hard, ["anchor", "positive_score"]).join(
        tree.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
