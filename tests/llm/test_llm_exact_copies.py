"""Exact duplicates against plain Python, with and without frequent texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from kelvane.llm import exact_copies


def brute(rows):
    """(doc_id, keep_id, group_size, digest) of every row, and how many stay per digest."""
    groups = {}
    for doc_id, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(hashlib.sha256(bare.encode()).digest(), []).append((doc_id, text or ""))
    out = []
    for digest, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(doc_id, keep, len(members), digest) for doc_id, _ in members]
    return sorted(out, key=repr)


ROWS = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "a\tb "), (8, " ab"),
        (9, "é\U0001f600 x"), (10, "é \U0001f600x"), (None, "a   b"), (None, "lone"), (11, "word " * 200_000),
        (12, " word" * 200_000), (13, "same"), (13, "same"), (13, "same"), (13, "s ame"), (None, "nul\0l"), (14, "null")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"row": F.lit(1), "digest": F.lit("x"), "place": F.lit(2), "winner": F.lit(3)})


@pytest.mark.parametrize("counters", [2000, 3, 1])
def test_marks_equal_brute_force(spark, counters):
    rng = random.Random(counters)
    rows = ROWS + [(20 + i, "hot te xt" if rng.random() < 0.5 else f"t{rng.randint(0, 30)}") for i in range(300)]
    found = exact_copies.mark(frame(spark, rows), counters=counters).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in found], key=repr) == brute(rows)
    stays = [r for r in found if r.kept]
    assert len(stays) == len({bytes(r.digest) for r in stays}) == len({bytes(r.digest) for r in found})
    assert all(r.doc_id == r.keep_id for r in stays)


def test_frequent_digests_are_found_and_verified(spark):
    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 3 == 1 and i % 2 else f"text {i}") for i in range(3000)]
    heavy = exact_copies.frequent(exact_copies.digests(frame(spark, rows)), counters=20).collect()
    assert {(r.winner.doc_id, r.group_size) for r in heavy} == {(0, 1000), (1, 500)}


def test_one_of_each_keeps_whole_rows(spark):
    kept = exact_copies.one_of_each(frame(spark, ROWS))
    assert kept.columns == frame(spark, ROWS).columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    texts = {re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in ROWS}
    assert len(found) == len(texts)
    assert (13, "s ame") in found and (None, "a   b") in found and (3, " \t\n\x0b\x0c\r") in found


def test_empty_table(spark):
    assert exact_copies.mark(frame(spark, [])).count() == 0
    assert exact_copies.one_of_each(frame(spark, [])).count() == 0
