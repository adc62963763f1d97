"""Near-duplicate documents by consistent weighted sampling.

A document is its five-word shingles weighted by TF-IDF. Improved consistent
weighted sampling draws 30 samples of it, in 10 bands of three; documents that
share a band are candidates, and those whose weighted Jaccard similarity, worked
out from the whole texts, reaches the threshold are linked. Candidates are left
out only where their total weights show that they cannot reach it. Connected
documents form a class.

Copies are one node. The members of a bucket are first compared with one hub,
then those outside the bucket's main component with a few of its members; only
members that are still outside are compared with all others.
So a bucket of g near copies costs some g comparisons, and any two of its texts
in different classes at the end have been compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvane.llm.common import map_batches, picked, saved, unused
from kelvane.llm.graph import components
from kelvane.llm.merges import Memo

SHINGLE = 5
BANDS, ROWS = 10, 3
SAMPLES = BANDS * ROWS
DF_BUCKETS = 1 << 18
# Rounds in which members outside meet so many of the main component, in each of
# their buckets. They end early where all that is left to compare is at most
# DIRECT pairs per member.
ROUNDS, PIVOTS, DIRECT = 1, 12, 10
# Bits of a text's shingle mask, in words of 64.
MASK_BITS = 1024
_MEMO = 400_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Shingles:
    """64-bit hashes of a text's shingles, distinct, with how often each occurs."""

    def __init__(self) -> None:
        self.words = Memo(lambda w: xxhash.xxh64_intdigest(w), _MEMO)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        if not len(words):
            return hashes, np.zeros(0, np.int64)
        n = max(1, len(words) - SHINGLE + 1)
        rolled = np.zeros(n, np.uint64)
        for i in range(min(SHINGLE, len(words))):
            rolled = (rolled ^ hashes[i:i + n]) * _STEP
            rolled ^= rolled >> np.uint64(29)
        return np.unique(rolled, return_counts=True)


def mask_of(shingles: np.ndarray) -> list[int]:
    """One bit for each shingle, several may share one, as signed 64-bit words."""
    bits = np.zeros(MASK_BITS, bool)
    bits[(shingles >> np.uint64(8)).astype(np.int64) % MASK_BITS] = True
    return np.packbits(bits).view(np.int64).tolist()


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(20)).astype(np.int64) % DF_BUCKETS


def document_counts(rows: DataFrame) -> np.ndarray:
    """How many documents hold a shingle of each bucket, over all documents.

    Tasks count into one array each, so what is shuffled is at most one row per
    bucket and task, and what the driver gets one per bucket.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, total = Shingles(), np.zeros(DF_BUCKETS, np.int64)
        for batch in batches:
            shingles.words.trim()
            for text in batch.column("text").to_pylist():
                total[np.unique(_bucket(shingles.of(text)[0]))] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = rows.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(
        F.sum("n").alias("n"))
    found = counted.toArrow()  # at most DF_BUCKETS rows of two numbers
    total = np.zeros(DF_BUCKETS, np.int64)
    total[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return total


def inverse_frequency(counts: np.ndarray, n_docs: int) -> np.ndarray:
    """Weights between 1 and 1.25: a shingle of one document against one of all.

    The span is narrow so that similarity keeps its scale: a shared shingle is
    in more documents than one that an edit made.
    """
    return (1 + 0.25 * np.log((n_docs + 1) / (counts + 1)) / np.log(n_docs + 2)).astype(np.float32)


class Weights:
    """Shingles of a text with their TF-IDF weights."""

    def __init__(self, idf: np.ndarray) -> None:
        self.idf, self.shingles = idf, Shingles()

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        shingles, counts = self.shingles.of(text)
        return shingles, counts * self.idf[_bucket(shingles)]

    def similarity(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
        """Weighted Jaccard: sum of the smaller weights over sum of the larger."""
        _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
        shared = np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64)
        total = a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - shared
        return float(shared / total) if total else 0.0


class Sampler:
    """Improved consistent weighted sampling, many documents at a time.

    The three random numbers of a shingle come from its hash through tables of
    their quantiles.
    """

    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.keys = rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)

        def draws(n: int) -> np.ndarray:
            x = rng.random((64, n))  # changed in place: every task makes its own
            x *= rng.random((64, n))
            np.negative(np.log(x, out=x), out=x)
            x.sort(axis=1)
            return x.mean(axis=0)

        self.r = draws(1 << 12).astype(np.float32)
        self.log_c = np.log(draws(1 << 16)).astype(np.float32)

    def samples(self, shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """documents x samples; ``starts``: where each document's shingles begin."""
        log_w = np.log(weights).astype(np.float32)
        found = np.empty((len(starts), SAMPLES), np.uint32)
        for k in range(SAMPLES):
            h = (shingles ^ self.keys[k]) * _STEP
            h ^= h >> np.uint64(32)
            h *= _MIX
            h ^= h >> np.uint64(29)
            r = self.r[(h & np.uint64(0xFFF)).astype(np.int32)]
            log_c = self.log_c[((h >> np.uint64(12)) & np.uint64(0xFFFF)).astype(np.int32)]
            beta = ((h >> np.uint64(28)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2**-16)
            t = np.floor(log_w / r + beta)
            value = log_c - r * (t - beta) - r
            # Order as an unsigned number: the value in front, the sample's name behind.
            bits = value.view(np.int32)
            order = (bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64) + (1 << 31)
            name = (h >> np.uint64(32)) ^ ((t.astype(np.int64) & 0xFFFF).astype(np.uint64) * np.uint64(0x9E3779B1))
            packed = (order.astype(np.uint64) << np.uint64(32)) | (name & np.uint64(0xFFFFFFFF))
            found[:, k] = np.minimum.reduceat(packed, starts) & np.uint64(0xFFFFFFFF)
        return found


def _sign(idf: np.ndarray):
    """Of texts: total weight, shingle mask and the keys of the bands; null without words."""
    weights, sampler = Weights(idf), Sampler()

    def run(columns: list[list]) -> list[list]:
        weights.shingles.words.trim()
        texts = columns[-1]
        total: list[float | None] = [None] * len(texts)
        masks: list[list[int]] = [[] for _ in texts]
        bands: list[list[int]] = [[] for _ in texts]
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> None:
            starts = np.append(0, np.cumsum([len(x[1]) for x in held])[:-1])
            found = sampler.samples(np.concatenate([x[1] for x in held]),
                                    np.concatenate([x[2] for x in held]), starts)
            for (i, shingles, weight), row in zip(held, found):
                total[i] = float(weight.sum(dtype=np.float64))
                masks[i] = mask_of(shingles)
                bands[i] = [xxhash.xxh64_intdigest(row[b * ROWS:(b + 1) * ROWS].tobytes(), b) - (1 << 63)
                            for b in range(BANDS)]

        for i, text in enumerate(texts):
            shingles, weight = weights.of(text)
            if len(shingles):
                held.append((i, shingles, weight))
                size += len(shingles)
            if held and (size > 50_000 or i == len(texts) - 1):
                flush()
                held, size = [], 0
        if held:
            flush()
        return [*columns[:-1], total, masks, bands]

    return run


def _possible(a: str, b: str, threshold: float) -> Column:
    """Whether texts ``a`` and ``b`` can reach the threshold, by total weight and mask.

    A bit that only one text has stands for a shingle, of weight 1 at least, that
    the other has not. So what they share is at most the total weight of either
    less its own such bits. No pair that reaches the threshold is lost.
    """
    def without(x: str, y: str) -> Column:
        only = [F.bit_count(F.col(f"mask_{x}")[i].bitwiseAND(F.bitwise_not(F.col(f"mask_{y}")[i])))
                for i in range(MASK_BITS // 64)]
        return F.col(f"total_{x}") - sum(only[1:], only[0])

    shared = F.least(without(a, b), without(b, a))
    return shared * (1 + threshold) >= (F.col(f"total_{a}") + F.col(f"total_{b}")) * (threshold * (1 - 1e-5))


def _signed(rows: DataFrame, signatures: DataFrame, node: str) -> DataFrame:
    """``rows`` with the total weight and mask of the texts in column ``node``."""
    return rows.join(signatures.select(F.col("node").alias(node), F.col("total").alias(f"total_{node}"),
                                       F.col("mask").alias(f"mask_{node}")), node)


def _linked(pairs: DataFrame, signatures: DataFrame, texts: DataFrame, idf: np.ndarray,
            threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose texts reach the threshold."""
    named = lambda rows, c, name: rows.select(F.col("node").alias(c), F.col(name).alias(f"{name}_{c}"))
    close = _signed(_signed(pairs, signatures, "a"), signatures, "b").filter(
        _possible("a", "b", threshold)).select("a", "b")
    joined = close.join(named(texts, "a", "text"), "a").join(named(texts, "b", "text"), "b").select(
        "a", "b", "text_a", "text_b")

    def start():
        weights = Weights(idf)
        hub: dict[int, tuple] = {}

        def run(columns):
            weights.shingles.words.trim()
            keep = []
            for a, b, text_a, text_b in zip(*columns):
                if b not in hub:  # rows come sorted by b: one at a time is enough
                    hub.clear()
                    hub[b] = weights.of(text_b)
                keep.append(weights.similarity(weights.of(text_a), hub[b]) >= threshold)
            return [columns[0], columns[1], keep]

        return run

    return saved(map_batches(joined, "a bigint, b bigint, same boolean", start).filter("same").select("a", "b"))


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` of all nodes after their components are joined by ``edges``."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"component_{c}"))
    between = edges.join(of("a"), "a").join(of("b"), "b").select(
        F.col("component_a").alias("a"), F.col("component_b").alias("b")).distinct()
    joined = components(between).select(
        F.col("node").alias("component"), F.col("component").alias("joined"))
    return saved(labels.join(joined, "component", "left").select(
        "node", F.coalesce("joined", "component").alias("component")))


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with ``main``,
    the component most of the bucket's members are in."""
    placed = members.join(labels, "node")
    main = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("band").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("band", "main")
    return saved(placed.join(main, "band"))


def _with_pivots(mixed: DataFrame, signatures: DataFrame, threshold: float, turn: int) -> DataFrame:
    """Members outside with those of a few of the main component, others every
    turn, that they can be linked with."""
    order = Window.partitionBy("band").orderBy(F.xxhash64("node", F.lit(turn)), "node")
    pivots = mixed.filter("component = main").withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= PIVOTS).select("band", F.col("node").alias("b"))
    outside = mixed.filter("component <> main").select("band", F.col("node").alias("a"))
    mine, other = _signed(outside, signatures, "a"), _signed(pivots, signatures, "b")
    return mine.join(other, (mine["band"] == other["band"]) & _possible("a", "b", threshold)).select("a", "b").distinct()


def _with_all(mixed: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """Members outside with all of other components that they can be linked with.

    Two texts that share several bands meet in the least of them: as their
    components differ, one of them is outside in each.
    """
    bands = lambda node: signatures.select(F.col("node").alias(node), F.col("bands").alias(f"bands_{node}"))
    other = _signed(mixed.select(
        "band", F.col("node").alias("b"), F.col("component").alias("component_b"),
        (F.col("component") != F.col("main")).alias("outside_b")), signatures, "b").join(bands("b"), "b")
    mine = _signed(mixed.filter("component <> main").select(
        "band", F.col("node").alias("a"), F.col("component").alias("component_a")), signatures, "a").join(bands("a"), "a")
    return mine.join(other, (mine["band"] == other["band"]) & (F.col("component_a") != F.col("component_b"))
                     & (~F.col("outside_b") | (F.col("a") < F.col("b")))
                     & _possible("a", "b", threshold)
                     & (F.array_min(F.array_intersect("bands_a", "bands_b")) == mine["band"])).select("a", "b")


def text_classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``node, least_id, component`` of every distinct text.

    ``node`` is the 64-bit hash of the text, ``least_id`` the smallest id that
    has it. Texts with one hash are taken for copies.
    """
    rows = picked(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    counts = document_counts(rows)
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n"))
    nodes = saved(nodes)
    idf = inverse_frequency(counts, nodes.agg(F.sum("n")).first()[0] or 0)
    # Copies are signed where they lie and folded before the shuffle; no text moves.
    signatures = saved(map_batches(rows.select("node", "text"),
                                   "node bigint, total double, mask array<bigint>, bands array<bigint>",
                                   lambda: _sign(idf))
                       .filter(F.col("total").isNotNull()).groupBy("node").agg(*[
                           F.first(c).alias(c) for c in ("total", "mask", "bands")]))
    every = signatures.select("node", F.explode("bands").alias("band"))
    hubs = every.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = saved(every.join(hubs.select("band", "hub"), "band"))
    near = saved(members.select("node").distinct())
    signatures = saved(signatures.join(near, "node"))
    texts = saved(rows.groupBy("node").agg(F.first("text").alias("text")).join(near, "node"))
    link = lambda pairs: _linked(pairs, signatures, texts, idf, threshold)
    labels = _merged(near.select("node", F.col("node").alias("component")), link(
        members.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()))
    most = DIRECT * members.count()
    for turn in range(ROUNDS + 1):
        mixed = _mixed(members, labels)
        left = mixed.groupBy("band").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("component") != F.col("main")).alias("outside")).agg(
            F.sum(F.col("n") * F.col("outside")).alias("pairs")).first()["pairs"]
        if not left:
            break
        last = turn == ROUNDS or left <= most
        found = link(_with_all(mixed, signatures, threshold) if last else _with_pivots(mixed, signatures, threshold, turn))
        if not found.isEmpty():
            labels = _merged(labels, found)
        if last:
            break
    return saved(nodes.join(labels, "node", "left").select(
        "node", "least_id", F.coalesce("component", "node").alias("component")))


def classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, class_texts`` for every row of ``docs``.

    ``class_id`` is the smallest id in the class, ``class_texts`` the number of
    its distinct texts. Null texts are empty; texts without words are alike only
    if equal; shorter texts than five words are one shingle. Repeated rows are
    each returned; null ids are no class id unless all are null; an empty table
    gives no rows.
    """
    texts = text_classes(docs, threshold, id_col, text_col)
    named = texts.groupBy("component").agg(F.min("least_id").alias("class_id"),
                                           F.count(F.lit(1)).alias("class_texts"))
    rows = picked(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("node"))
    return rows.join(texts.join(named, "component").select("node", "class_id", "class_texts"), "node").select(
        "doc_id", "class_id", "class_texts")


def one_of_each(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class, once each.

    In a class without ids one of its texts stays. Rows are kept as they are;
    further columns may have any name. Null texts are empty; of rows that tie in
    id and text one stays; an empty table gives no rows.
    """
    texts = text_classes(docs, threshold, id_col, text_col)
    node = unused(docs, "node")
    chosen = texts.groupBy("component").agg(
        F.coalesce(F.min_by("node", "least_id"), F.min("node")).alias("chosen"), F.min("least_id").alias("least"))
    rows = docs.withColumn(node, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    kept = rows.join(chosen, (rows[node] == chosen["chosen"]) & rows[f"`{id_col}`"].eqNullSafe(chosen["least"]),
                     "left_semi")
    # Rows repeated whole are left, and two null ids with one text.
    return kept.dropDuplicates([node]).drop(node)
