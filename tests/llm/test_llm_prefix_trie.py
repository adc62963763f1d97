"""The prefix trie against one that is built from whole texts."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kelvane.llm import prefix_trie
from kelvane.llm.prefix_trie import Hashes

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None),
                                         key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, convs in members.items():
        d = len(node)
        below = [n for n in members if len(n) >= d and n[:d] == node]
        inner = {n[:-1] for n in members if n}
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == d))
        out.append((min(convs), d, min(members[node[:-1]]) if d else None, len(convs),
                    sum(len(n) == d + 1 for n in below), sum(n not in inner for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(spark, rows, partitions=None, **options):
    frame = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("conv", "depth", "part", "digest", "n")})
    return sorted(tuple(r) for r in prefix_trie.trie(frame, **options).select(*COLUMNS).collect())


def conversations(rng, n=260):
    """Few texts, so that prefixes are shared; bases that are short, absent or long."""
    rows = []
    for c in rng.sample(range(0, 900), n) + [0, 100, 300, -5, -100, -105]:
        if c in (200, 500):
            continue
        for turn in range(rng.randint(1, 2) if c == 300 else rng.randint(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant"][turn % 2:] + ["user"]), rng.choice(["a", "bb", "ccc é"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = conversations(rng)
    rows += [(400, None, "user", "late"), (400, None, "user", "early"), (400, None, None, None), (401, 3, "user", "twin"),
             (401, 3, "user", "twin"), (401, 3, "system", "z"), (None, 1, "user", "nobody"), (402, 1, "user", ""),
             (403, 1, "a", "b" * 300_000), (404, 1, "user", "\U0001f600" * 50), (405, 1, "ab", "c"), (406, 1, "a", "bc")]
    rng.shuffle(rows)
    assert built(spark, rows) == brute(rows)


def test_long_conversations_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    monkeypatch.setattr(prefix_trie, "ID_RANGE", 3)
    rows = [(c, t, "user", f"t{t % 7}") for c in (0, 7, 9) for t in range(150 + c)]
    rows += [(c, t, "user", f"t{t % 7}") for c in range(10, 60) for t in range(12)]
    rows += [(100, None, "user", f"{i:03d}") for i in range(200)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert built(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_collisions_are_seen_and_start_over(spark):
    rows = conversations(random.Random(3), 60)
    weak = Hashes((2, 2, 2), (1, 1, 1))
    assert built(spark, rows, hashes=[weak, Hashes.drawn(5)]) == brute(rows)
    with pytest.raises(ValueError):
        built(spark, rows, hashes=[weak])


def test_little_and_nothing(spark):
    assert built(spark, []) == []
    for rows in ([(100, 0, None, None)], [(105, 0, "user", "a")], [(7, 0, "user", "a"), (107, 1, "user", "a")]):
        assert built(spark, rows) == brute(rows)


def test_scan_is_the_running_product():
    hashes = Hashes.drawn(0)
    rng = random.Random(0)
    convs = [1] * 5 + [2] * 40 + [3] + [4] * 9
    digests = [rng.randbytes(32) for _ in convs]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(convs), pa.array([0] * len(convs), pa.int32()), pa.array(digests), pa.array([1] * len(convs))],
        ["conv", "part", "digest", "chars"])
    found = pa.Table.from_batches(prefix_trie._scanned(hashes)(batch.slice(i, 7) for i in range(0, len(convs), 7)))
    for i, (prime, base) in enumerate(zip(hashes.primes, hashes.bases)):
        last, n, total, expected, before = None, 0, 0, [], []
        for conv, digest in zip(convs, digests):
            if conv != last:
                last, n, total = conv, 0, 0
            before.append(total)
            total = (total + int.from_bytes(digest[8 * i:8 * i + 8], "little") * pow(base, n, prime)) % prime
            n += 1
            expected.append(total)
        assert found[f"s{i}"].to_pylist() == expected and found[f"u{i}"].to_pylist() == before
    assert (prefix_trie.powers(hashes.bases[0], np.arange(2000), hashes.primes[0])
            == [pow(hashes.bases[0], n, hashes.primes[0]) for n in range(2000)]).all()
