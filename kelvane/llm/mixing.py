"""Document rates that bring sources to target weights, with soft membership.

A classifier fitted on a labelled table gives every document a probability for
each domain. Nonnegative rates are found by projected gradient descent on the
squared gap between the expected tokens of the domains and their targets; a
step needs one sum per domain over all documents.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvane.llm.common import batch_column, picked, saved
from kelvane.llm.merges import Memo

BUCKETS = 1 << 12
MEMO = 400_000


class Classifier:
    """Softmax regression on the shares of hashed words."""

    def __init__(self, domains: list[str], weights: np.ndarray, bias: np.ndarray) -> None:
        self.domains, self.weights, self.bias = domains, weights, bias
        self.memo = Memo(_bucket, MEMO)

    def __getstate__(self):
        return self.domains, self.weights, self.bias

    def __setstate__(self, state):
        self.__init__(*state)

    @staticmethod
    def fit(texts: list[str], labels: list[str], domains: list[str], rounds: int = 200) -> Classifier:
        """``domains`` may name more than occur; those stay at probability 0."""
        seen = np.array([d in set(labels) for d in domains])
        bias = np.where(seen, 0.0, -np.inf)
        weights = np.zeros((BUCKETS, len(domains)), np.float32)
        if seen.any():
            x = np.zeros((len(texts), BUCKETS), np.float32)
            for row, text in zip(x, texts):
                words = text.lower().split()
                if words:
                    np.add.at(row, [_bucket(w) for w in words], 1.0 / len(words))
            y = np.array([[d == label for d in domains] for label in labels], dtype=float)
            moment, speed = np.zeros_like(weights), np.zeros_like(weights)
            shift = np.zeros(len(domains))
            for step in range(1, rounds + 1):
                gap = (_softmax(x @ weights + bias + shift) - y) / len(texts)
                slope = (gap.astype(np.float32).T @ x).T
                moment += 0.1 * (slope - moment)
                speed += 0.01 * (slope * slope - speed)
                weights -= (0.3 * (moment / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.99**step)) + 1e-8)
                            ).astype(np.float32)
                shift -= 0.5 * gap.sum(axis=0)
            bias = bias + shift
        return Classifier(domains, weights, bias)

    def __call__(self, texts: list[str | None]) -> tuple[list, list]:
        """Number of words and the probabilities of the domains."""
        self.memo.trim()
        sizes, logits = [], []
        for text in texts:
            words = (text or "").lower().split()
            sizes.append(len(words))
            places = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
            logits.append(self.weights[places].mean(axis=0) if words else np.zeros(len(self.domains)))
        if not np.isfinite(self.bias).any():
            chances = [[0.0] * len(self.domains)] * len(sizes)
        else:
            chances = _softmax(np.array(logits) + self.bias).tolist() if logits else []
        return sizes, chances


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "domain", sample_rows: int = 4000) -> Classifier:
    """Fit on at most ``sample_rows`` labelled documents, chosen by a hash of the id.

    An id labelled more than once has its smallest label; of texts that share an
    id one is taken; labels that are not among ``domains`` are left out.
    """
    known = picked(labelled, doc_id=id_col, label=label_col).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(*domains)).groupBy("doc_id").agg(
        F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # At most sample_rows short rows.
    rows = picked(docs, doc_id=id_col, text=text_col).filter(F.col("text").isNotNull()).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    taken = sorted((r["text"], r["label"]) for r in rows.select("text", "label").toLocalIterator())
    return Classifier.fit([t for t, _ in taken], [d for _, d in taken], domains)


def membership(text: Column, classifier: Classifier) -> Column:
    """Of a text column: ``n_tokens`` and ``membership``, as a struct."""
    return batch_column(text, "n_tokens bigint, membership array<double>", lambda: classifier)


def _rate(steps: list[list[float]], least: float = 0.0) -> Column:
    """The rate after the given steps, from 1, never below ``least``."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(v)) for v in step]) for step in steps])
    along = lambda v: sum((F.col("membership")[i] * v[i] for i in range(len(steps[0]))), F.lit(0.0))
    return F.aggregate(moves, F.lit(1.0), lambda r, v: F.greatest(F.lit(least), r - along(v)))


def solve(members: DataFrame, weights: list[float], total: str = "same", rounds: int = 60,
          tolerance: float = 1e-7) -> Column:
    """The rate of each document, as a column over ``members``.

    ``weights``: share of the tokens that each domain shall have. ``total``:
    ``same`` keeps the number of tokens, ``grow`` takes the smallest one for
    which no domain has to shrink, with rates of 1 and more, so that no document
    goes. A document's step is its membership times the gap, scaled by the inverse
    of the domains' overlap; with that scaling a step of one never overshoots, and
    clipping at the least rate (0, or 1 with ``grow``) projects onto the rates
    allowed. Targets that cannot be met are met as nearly as rates allow.
    """
    k = len(weights)
    tokens = F.col("n_tokens").cast("double")
    share = lambda i: F.col("membership")[i]
    sums = members.agg(
        F.sum(tokens).alias("n"), *[F.sum(tokens * share(i)).alias(f"d{i}") for i in range(k)],
        *[F.sum(tokens * share(i) * share(j)).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    if not sums["n"]:
        return F.lit(1.0)
    least = 1.0 if total == "grow" else 0.0
    goal = np.array(weights, float) / sum(weights)
    now = np.array([sums[f"d{i}"] for i in range(k)]) / sums["n"]
    if total == "grow":
        goal = goal * max((now[i] / goal[i] for i in range(k) if goal[i] > 0), default=1.0)
    overlap = np.array([[sums[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / sums["n"]
    scale = np.linalg.pinv(overlap, rcond=1e-9, hermitian=True)
    steps: list[list[float]] = []
    for _ in range(rounds):
        gap = now - goal
        move = scale @ gap
        if np.abs(overlap @ move).max() < tolerance:
            break
        steps.append(move.tolist())
        rated = members.agg(*[F.sum(tokens * share(i) * _rate(steps, least)).alias(f"d{i}") for i in range(k)]).first()
        after = np.array([rated[f"d{i}"] for i in range(k)]) / sums["n"]
        if np.abs(after - now).max() < tolerance:
            break
        now = after
    return _rate(steps, least)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: str = "same",
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "domain",
        sample_rows: int = 4000) -> DataFrame:
    """``doc_id, n_tokens, domain, membership, rate`` for every row of ``docs``.

    ``membership`` follows the sorted names of ``targets``; ``domain`` is the
    likeliest. Texts without words have the shares of the classifier's bias and
    weigh nothing. Without labels nothing is known: memberships are 0, the
    domain is null and rates are 1. Repeated rows are each rated; an empty table
    gives no rows.
    """
    domains = sorted(targets)
    classifier = fit_classifier(docs, labelled, domains, id_col, text_col, label_col, sample_rows)
    rows = picked(docs, doc_id=id_col, text=text_col)
    members = saved(rows.select("doc_id", membership(F.col("text"), classifier).alias("m")).select("doc_id", "m.*"))
    rate = solve(members, [targets[d] for d in domains], total)
    best = F.array_position("membership", F.array_max("membership")).cast("int") - 1
    names = F.array(*[F.lit(d) for d in domains])
    return members.select("doc_id", "n_tokens", F.when(F.array_max("membership") > 0, F.get(names, best)).alias("domain"),
                          "membership", rate.alias("rate"))


def resampled(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: str = "grow",
              id_col: str = "doc_id", text_col: str = "text", label_col: str = "domain") -> DataFrame:
    """The rows of ``docs``, each as often as its rate says.

    The whole part of the rate counts in full; a hash of id and text decides
    about the fraction, so that a rerun decides alike. With ``grow`` the rates are
    solved for under a least rate of 1, so no row goes. Columns stay as they are.

    Null and empty texts weigh nothing and follow the classifier's bias; rows
    that agree in id and text repeat equally often; without labels every rate is
    1; an empty table gives no rows.
    """
    domains = sorted(targets)
    classifier = fit_classifier(docs, labelled, domains, id_col, text_col, label_col)
    text = F.col(f"`{text_col}`")
    members = saved(docs.select(membership(text, classifier).alias("m")).select("m.*"))
    rate = solve(members, [targets[d] for d in domains], total)
    keep = [f"`{c}`" for c in docs.columns]
    packed = docs.select(F.struct(*keep).alias("row"), text.alias("text"),
                         F.xxhash64(F.col(f"`{id_col}`"), text).alias("hash"))
    rated = packed.select("row", "hash", membership(F.col("text"), classifier).alias("m")).select(
        "row", "hash", "m.*").select("row", "hash", rate.alias("rate"))
    chance = F.pmod("hash", F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("int")
    return rated.select("row", F.explode(F.array_repeat(F.lit(0), copies))).select("row.*")
