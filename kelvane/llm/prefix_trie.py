"""Prefix trie of conversations that are rebuilt from a shared head and an own tail.

A run of turns has the fingerprint (n, S) with S = v0 + v1 B + ... mod p, where
v is a turn's digest; runs combine as (n, S)(m, T) = (n + m, S + B^n T), so the
fingerprint of a rebuilt conversation's first d turns follows from prefixes of
two stored conversations, and no text is moved or rebuilt: turns are sorted
once, scanned with running products, and pieces of a long conversation that lie
in several tasks are joined by the same rule.

Prefixes of one depth and fingerprint form a node. That they are equal indeed is
verified by the digests of their last stored turns and the fingerprints before
them, which settles all depths by induction; a collision starts over with other
numbers.

Sums over subtrees need no walk. Each node is owned by its smallest member, and
a conversation owns its deepest nodes. A node below x is owned by a member of x,
so what lies below x is the sum over its members of what they own at its depth
or deeper.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvane.llm.common import picked, saved

PARTS = 3
# Depths of an owner that are summed in one group.
CHUNK = 4096
# Range of ids whose ends are listed in one group.
ID_RANGE = 10_000
# Range partitioning compares so many characters, sorting all.
KEY_CHARS = 32
NODE = ["depth", *[f"f{i}" for i in range(PARTS)]]
BEFORE = [f"e{i}" for i in range(PARTS)]
SCAN = ("conv bigint, part int, n bigint, "
        + ", ".join(f"{x}{i} bigint" for x in "su" for i in range(PARTS)) + ", digest binary, chars bigint")
CARRY = "conv bigint, part int, n0 bigint, " + ", ".join(f"{x}{i} bigint" for x in "cq" for i in range(PARTS))
_NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Hashes:
    """Moduli below 2**31 and bases of the running products."""

    primes: tuple[int, ...]
    bases: tuple[int, ...]

    @staticmethod
    def drawn(seed: int) -> Hashes:
        primes = (2**31 - 1, 2**31 - 19, 2**31 - 61)
        rng = np.random.default_rng(seed)
        return Hashes(primes, tuple(int(rng.integers(2**20, p - 1)) for p in primes))

    def power(self, i: int, exponent: int) -> int:
        return pow(self.bases[i], exponent, self.primes[i])


def powers(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    found, square, left = np.ones(len(exponents), np.int64), base, exponents.copy()
    while left.any():
        found = np.where(left & 1, found * square % prime, found)
        square, left = square * square % prime, left >> 1
    return found


def _scanned(hashes: Hashes):
    """Per task: place and product of each turn within its conversation's rows of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, length, sums = None, 0, [0] * PARTS
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            starts = np.append(conv[0] != last, conv[1:] != conv[:-1])
            segment = np.cumsum(starts)
            first = np.append(-length, np.flatnonzero(starts))
            place = np.arange(len(conv)) - first[segment]
            words = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u8").reshape(len(conv), 4)
            upto, before = [], []
            for i, (prime, base) in enumerate(zip(hashes.primes, hashes.bases)):
                term = (words[:, i] % np.uint64(prime)).astype(np.int64) * powers(base, place, prime) % prime
                total = np.cumsum(term)
                offset = np.append(-sums[i], (total - term)[starts])[segment]
                upto.append((total - offset) % prime)
                before.append((total - term - offset) % prime)
                sums[i] = int(upto[i][-1])
            last, length = conv[-1], int(place[-1]) + 1
            columns = [batch.column("conv"), batch.column("part"), pa.array(place + 1), *map(pa.array, upto + before),
                       batch.column("digest"), batch.column("chars")]
            yield pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in SCAN.split(", ")])

    return run


def _carried(hashes: Hashes):
    """Of a conversation in several tasks: what comes before each of its pieces."""
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        out, length, sums = [], 0, [0] * PARTS
        for piece in pieces.sort_values("part").itertuples():
            shift = [hashes.power(i, length) for i in range(PARTS)]
            out.append((piece.conv, piece.part, length, *sums, *shift))
            sums = [(s + q * int(getattr(piece, f"s{i}"))) % hashes.primes[i] for i, (s, q) in enumerate(zip(sums, shift))]
            length += int(piece.n)
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in CARRY.split(", ")])

    return run


def _prefixes(turns: DataFrame, hashes: Hashes) -> DataFrame:
    """``conv, n, s.., u.., digest, chars`` of every stored turn: its place, the
    product of its conversation up to it (s) and before it (u)."""
    # Turns with equal numbers are dealt by the beginnings of role and text.
    role, text = F.left("role", F.lit(KEY_CHARS)), F.left("text", F.lit(KEY_CHARS))
    dealt = turns.repartitionByRange(
        "conv", F.col("turn").asc_nulls_first(), role,
        F.when(F.length("role") <= KEY_CHARS, text).asc_nulls_last())
    in_order = dealt.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text").select(
        "conv", F.spark_partition_id().alias("part"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.length("text").cast("long").alias("chars"))
    scanned = saved(in_order.mapInArrow(_scanned(hashes), SCAN))
    # Only the first and last conversation of a task can reach into others.
    ends = scanned.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    crossing = ends.select("part", F.explode(F.array("low", "high")).alias("conv")).groupBy("conv").agg(
        F.count_distinct("part").alias("n")).filter("n > 1").select("conv")
    sums = [f"s{i}" for i in range(PARTS)]
    pieces = scanned.join(F.broadcast(crossing), "conv").groupBy("conv", "part").agg(
        F.max("n").alias("n"), F.max_by(F.struct(*sums), "n").alias("s")).select("conv", "part", "n", "s.*")
    carry = pieces.groupBy("conv").applyInPandas(_carried(hashes), CARRY)
    # At most two rows for each task.
    rows = scanned.join(F.broadcast(carry), ["conv", "part"], "left")
    whole = lambda x, i: F.when(F.col("n0").isNull(), F.col(f"{x}{i}")).otherwise(
        (F.col(f"c{i}") + F.col(f"q{i}") * F.col(f"{x}{i}")) % hashes.primes[i]).alias(f"{x}{i}")
    return rows.select("conv", (F.col("n") + F.coalesce("n0", F.lit(0))).alias("n"),
                       *[whole(x, i) for x in "su" for i in range(PARTS)], "digest", "chars")


def _conversations(prefixes: DataFrame, shared: int, span: int) -> DataFrame:
    """Per conversation: ``head``, the turns taken from its base; ``own``, its
    product up to where its own tail begins; ``tail``, the tail's length."""
    few = F.struct("n", *[f"{x}{i}" for x in "su" for i in range(PARTS)], "digest", "chars")
    convs = saved(prefixes.groupBy("conv").agg(
        F.max("n").alias("length"), F.sort_array(F.collect_list(F.when(F.col("n") < shared, few))).alias("first")))
    convs = convs.withColumn("cut", _cut(F.col("conv"), shared))
    bases = convs.filter(F.col("conv") % span == 0).select(F.col("conv").alias("base"), F.col("first").alias("head"))
    none = F.array().cast(convs.schema["first"].dataType)
    joined = convs.withColumn("base", F.col("conv") - F.col("conv") % span).join(bases, "base", "left")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("cut"))
    own = F.when((F.col("cut") > 0) & (F.col("length") >= F.col("cut")), F.get("first", F.col("cut") - 1))
    return saved(joined.select("conv", "cut", head.alias("head"), own.alias("own"),
                               F.greatest(F.col("length") - F.col("cut"), F.lit(0)).alias("tail")))


def _cut(conv: Column, shared: int) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % shared).cast("int")


def _members(prefixes: DataFrame, convs: DataFrame, hashes: Hashes, shared: int) -> DataFrame:
    """Every prefix of every rebuilt conversation: its node, the fingerprint
    before its last turn, that turn's digest and length, and whether it ends there."""
    size = F.size("head").cast("long")
    empty = F.lit(None).cast("struct<n bigint," + ",".join(
        f"{x}{i}:bigint" for x in "su" for i in range(PARTS)) + ",digest:binary,chars:bigint>")
    heads = convs.select("conv", (size + F.col("tail")).alias("length"),
                         F.posexplode(F.concat(F.array(empty), "head")).alias("depth", "t")).select(
        "conv", F.col("depth").cast("long").alias("depth"),
        *[F.coalesce(f"t.s{i}", F.lit(0)).alias(f"f{i}") for i in range(PARTS)],
        *[F.col(f"t.u{i}").alias(f"e{i}") for i in range(PARTS)], "t.digest",
        F.coalesce("t.chars", F.lit(0)).alias("chars"), (F.col("depth") == F.col("length")).alias("ended"))

    def after_head(x: str, i: int) -> Column:
        """Product of the head and the tail up to here: the tail moves to the head's end."""
        prime = hashes.primes[i]
        shift = F.get(F.array(*[F.lit(hashes.power(i, -n)) for n in range(shared)]), F.col("cut") - F.size("head"))
        start = F.coalesce(F.get("head", F.size("head") - 1).getField(f"s{i}"), F.lit(0))
        tail = (F.col(f"{x}{i}") - F.coalesce(F.col(f"own.s{i}"), F.lit(0)) + prime) % prime
        return (start + shift * tail) % prime

    depth = size + F.col("n") - F.col("cut")
    tails = prefixes.filter(F.col("n") > _cut(F.col("conv"), shared)).join(convs, "conv").select(
        "conv", depth.alias("depth"), *[after_head("s", i).alias(f"f{i}") for i in range(PARTS)],
        *[after_head("u", i).alias(f"e{i}") for i in range(PARTS)], "digest", "chars",
        (depth == size + F.col("tail")).alias("ended"))
    return saved(heads.union(tails))


def _nodes(members: DataFrame) -> tuple[DataFrame, bool]:
    """The groups of equal prefixes, and whether each holds equal ones indeed."""
    before = F.struct(*BEFORE)
    groups = saved(members.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("owner"), F.count_if("ended").alias("n_ends"),
        F.min("chars").alias("chars"), F.min("digest").alias("digest"), F.max("digest").alias("other"),
        F.min(before).alias("before"), F.max(before).alias("before_other")))
    mixed = groups.filter((F.col("digest") != F.col("other")) | (F.col("before") != F.col("before_other")))
    return groups.drop("other", "before_other"), mixed.isEmpty()


def _below(nodes: DataFrame) -> DataFrame:
    """``owner, depth, below``: what an owner's nodes save from each depth on."""
    own = nodes.select("owner", "depth", F.expr(f"depth div {CHUNK}").alias("chunk"),
                       ((F.col("n_convs") - 1) * F.col("chars")).alias("w"))
    deeper = Window.partitionBy("owner").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    chunks = own.groupBy("owner", "chunk").agg(F.sum("w").alias("w")).select(
        "owner", "chunk", F.coalesce(F.sum("w").over(deeper), F.lit(0)).alias("deeper"))
    here = Window.partitionBy("owner", "chunk").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return own.withColumn("w", F.sum("w").over(here)).join(chunks, ["owner", "chunk"]).select(
        "owner", "depth", (F.col("w") + F.col("deeper")).alias("below"))


def _digests_of_ends(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a node, ascending, joined by commas.

    Ids are listed in groups of a bounded range; the lists of a node pass
    through one digest in order, one at a time.
    """
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    lists = members.filter("ended").groupBy(*NODE, F.expr(f"conv div {ID_RANGE}").alias("chunk")).agg(
        F.array_join(ids, ",").alias("ids"))
    in_order = lists.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids")
    schema = ", ".join(f"{c} bigint" for c in NODE) + ", ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield _batch(done, [*NODE, "ends_sha256"])
        if node is not None:
            yield _batch([(*node, digest.hexdigest())], [*NODE, "ends_sha256"])

    return in_order.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)


def trie(conversations: DataFrame, shared: int = 6, span: int = 100, conv_col: str = "conv_id",
         turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
         hashes: Iterable[Hashes] | None = None) -> DataFrame:
    """One row for each distinct run of first turns of the rebuilt conversations.

    Turns are ordered by number (null first), then role, then text. Conversation
    c takes the first h turns of conversation ``c - c % span`` (all if it has
    fewer, none if it is absent) and then its own from the (h + 1)-th on, with
    h = crc32 of decimal c, modulo ``shared``.

    Columns: ``conv_id`` (smallest member) and ``depth``, which name the node;
    ``parent_conv_id`` (null at the root); ``n_convs``, ``n_children``,
    ``n_leaves``; ``saved_tokens``, over the subtree (members - 1) times the code
    points of the last text; ``ends_sha256``; ``turn_digest``, the SHA-256 of the
    last turn's ``<code points of the role>:<role><text>`` (null at the root).

    Null roles and texts are empty; rows without a conversation take no part; a
    row repeated whole is a turn of its own; an empty table gives no rows.
    """
    turns = picked(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col).filter(
        F.col("conv").isNotNull()).select(
        F.col("conv").cast("long").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    for drawn in hashes or map(Hashes.drawn, count()):
        prefixes = _prefixes(turns, drawn)
        convs = _conversations(prefixes, shared, span)
        members = _members(prefixes, convs, drawn, shared)
        nodes, right = _nodes(members)
        if right:
            return _described(nodes, members)
    raise ValueError("prefixes collide under all the hashes given")


def _described(nodes: DataFrame, members: DataFrame) -> DataFrame:
    owners = saved(nodes.groupBy("owner").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"),
        F.sum((F.col("n_convs") - 1) * F.col("chars")).alias("saves"),
        F.max_by(F.col("n_ends") == F.col("n_convs"), "depth").alias("is_leaf")))
    # What members other than the owner bring: all their own nodes lie deeper.
    others = members.select("conv", *NODE).join(owners.withColumnRenamed("owner", "conv"), "conv").filter(
        F.col("depth") < F.col("top")).groupBy(*NODE).agg(
        F.count_if("is_leaf").alias("leaves"), F.sum("saves").alias("saves"),
        F.count_if(F.col("top") == F.col("depth") + 1).alias("branches"))
    rows = nodes.join(owners.select("owner", "top", "bottom", "is_leaf"), "owner").join(
        _below(nodes), ["owner", "depth"]).join(others, NODE, "left").join(_digests_of_ends(members), NODE, "left")
    rows = saved(rows.select(
        *NODE, F.col("owner").alias("conv_id"), "before", "top", "n_convs",
        (F.coalesce("branches", F.lit(0)) + F.when(F.col("depth") < F.col("bottom"), 1).otherwise(0)).alias("n_children"),
        (F.coalesce("leaves", F.lit(0)) + F.col("is_leaf").cast("long")).alias("n_leaves"),
        (F.coalesce("saves", F.lit(0)) + F.col("below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"), F.col("digest").alias("turn_digest")))
    names = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_digest"]
    # Below its topmost node a conversation owns the parents too.
    inner = rows.filter("depth = 0 OR depth > top").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id"), *names)
    parents = nodes.select((F.col("depth") + 1).alias("depth"),
                           *[F.col(f"f{i}").alias(f"e{i}") for i in range(PARTS)], F.col("owner").alias("parent_conv_id"))
    tops = rows.filter("depth > 0 AND depth = top").select("conv_id", "depth", "before.*", *names).join(
        parents, ["depth", *BEFORE])
    return inner.union(tops.select(*inner.columns))
