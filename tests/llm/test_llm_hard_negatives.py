"""Hard negatives against plain Python, and the tree they are found along."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kelvane.llm import hard_negatives

VECTORS = "vec_id bigint, embedding array<double>, label int"


def brute(rows, is_anchor, k=5, share=80, scale=256):
    rows = [(i, tuple(math.floor(scale * x) for x in v), label) for i, v, label in rows
            if label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, u, label in {r for r in rows if r[0] is not None and is_anchor(r[0])}:
        scored = sorted((-sum(x * y for x, y in zip(u, v)), i is None, i or 0, own == label)
                        for i, v, own in rows if i != a and len(v) == len(u))
        for top, none, i, _ in [r for r in scored if r[3]][:k]:
            hard = [r for r in scored if not r[3] and share * -top <= 100 * -r[0] <= 100 * -top][:k]
            out += [(a, None if none else i, n + 1, None if no_id else j, -top, -s)
                    for n, (s, no_id, j, _) in enumerate(hard)]
    return sorted(out, key=repr)


def mined(spark, rows, is_anchor, **options):
    frame = spark.createDataFrame(rows, VECTORS).withColumns({"row": F.lit(1), "anchor": F.lit("x"), "rank": F.lit(0)})
    found = hard_negatives.mine(frame, is_anchor, **options)
    return sorted([tuple(r) for r in found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()], key=repr)


@pytest.mark.parametrize("group, block", [(2048, 16384), (5, 40)])
def test_hard_negatives_equal_brute_force(spark, group, block):
    rng = random.Random(group)
    draw = lambda: [rng.randint(0, 4) / 4 - 0.375 for _ in range(4)]  # noqa: E731  ties abound
    rows = [(i, draw(), rng.randint(0, 2)) for i in range(150)] + [(200 + i, [0.5] * 4, i % 2) for i in range(40)]
    rows += [(300, None, 1), (301, [], 1), (302, [1.0, None, 1.0, 1.0], 1), (303, [float("nan")] * 4, 1),
             (304, [float("inf")] * 4, 1), (305, [0.5] * 4, None), (None, [0.875] * 4, 1), (None, [0.875] * 4, 2),
             (306, [1.0, 2.0], 1), (310, [1.0, 2.0], 2), (7, [0.375] * 4, 1), (7, [0.375] * 4, 1), (10, [0.5] * 4, 0),
             (320, [0.0] * 4, 1), (330, [-5.0] * 4, 1)]
    assert mined(spark, rows, F.col("vec_id") % 10 == 0, group=group, block=block) == brute(rows, lambda i: i % 10 == 0)


def test_little_and_nothing(spark):
    anchor = F.col("vec_id") == 0
    assert mined(spark, [], anchor) == []
    assert mined(spark, [(0, [1.0], 1)], anchor) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)], anchor) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)], anchor) == [(0, 1, 1, 2, 65536, 256 * 230)]


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**22, 1.0], 1), (1, [2.0**22, 0.0], 1), (2, [2.0**22, -1 / 256], 2), (3, [2.0**22, 0.0], 2)]
    anchor = F.col("vec_id") == 0
    assert mined(spark, rows, anchor) == brute(rows, lambda i: i == 0)


def test_tree_spans_and_bounds_hold():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 200
    points = np.floor(centres[rng.integers(0, 20, 300)] + rng.normal(size=(300, 16)) * 4).astype(np.int64)
    order, parent, level, edge = hard_negatives.spanning_tree(points)
    assert sorted(order) == list(range(300)) and parent[0] == -1 and (np.diff(level) >= 0).all()
    assert (parent[1:] < np.arange(1, 300)).all()
    placed = points[order].astype(float)
    assert (edge[1:] >= np.sqrt(((placed[1:] - placed[parent[1:]]) ** 2).sum(axis=1))).all()
    # No shorter edge leaves the part of the tree below a node.
    for i in range(1, 300, 37):
        below = {i}
        for j in range(i + 1, 300):
            if parent[j] in below:
                below.add(j)
        inside = sorted(below)
        outside = [j for j in range(300) if j not in below]
        least = np.sqrt(((placed[inside][:, None] - placed[outside][None]) ** 2).sum(axis=2)).min()
        assert edge[i] <= least * (1 + 1e-9)


def test_clustered_candidates_are_mostly_bounded_away():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 200
    near = lambda n: np.floor(centres[rng.integers(0, 20, n)] + rng.normal(size=(n, 16)) * 4).astype(np.int64)
    rows = pd.DataFrame({"vector": list(near(4000)), "vec_id": np.arange(4000), "no_id": False, "label": "a"})
    anchors = pd.DataFrame({"vector": list(near(200)), "anchor_id": np.arange(200) + 9000, "label": "b"})
    tree = hard_negatives.plant(anchors)
    exact = np.stack(tree["vector"]) @ np.stack(rows["vector"]).T
    wanted = [[hard_negatives.Best(5, int(0.9 * s.max()), int(s.max()))] for s in exact]
    scored = hard_negatives.walk(tree, rows, wanted, same_label=False)
    for s, [window] in zip(exact, wanted):
        best = np.lexsort((rows["vec_id"], -s))[:5]
        assert [(-s[i], False, i) for i in best if s[i] >= window.low] == window.rows
    assert scored < 0.25 * exact.size
