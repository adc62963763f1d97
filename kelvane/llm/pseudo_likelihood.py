"""Document scores by masked pseudo-likelihood.

A small network predicts every token from the two tokens on either side; the sum
of the log-probabilities scores the document. A word outside the network's
vocabulary has the probability of its ending class times its share of the class,
by counts of all words over all documents; that table grows with the corpus and
stays distributed. All documents train the network in numpy, each task from
the same start on its own texts, and the tasks' weights are averaged in a tree.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvane.llm.common import picked, saved
from kelvane.llm.merges import Memo

CLASSES, PER_CLASS = 32, 64
TOKENS = CLASSES * PER_CLASS
ENDINGS = 256  # tokens for the words outside the vocabulary, by a hash of their last letters
EDGE = TOKENS  # stands before the first and behind the last token
UNITS = 16
OFFSETS = (-2, -1, 1, 2)
BATCH = 8192
MEMO = 400_000  # words a task counts before it passes them on
# Words with at least this part of all tokens are looked up in the tasks, so there
# are no more than LISTED of them; the counts of all others are joined.
LISTED = 1 << 17


def _words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _ending(word: str) -> int:
    return zlib.crc32(word[-2:].encode()) % ENDINGS


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n`` of every distinct word; counts are combined before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(
                list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(_words(text))
                if len(held) > MEMO:
                    yield flushed()
                    held.clear()
        yield flushed()

    return saved(picked(docs, text=text_col).mapInArrow(count, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")))


def vocabulary(counts: DataFrame) -> list[str]:
    """The most frequent of the counted words; ties in order of the words.

    The list has a fixed length, so it is all that the driver gets.
    """
    top = counts.orderBy(F.col("n").desc(), "word").limit(TOKENS - ENDINGS)
    return [row["word"] for row in top.collect()]


def _listed(counts: DataFrame) -> dict[str, int]:
    """The counts of at most ``LISTED`` words, by their part of all tokens."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r["word"]: r["n"] for r in counts.filter(F.col("n") * LISTED >= total).collect()}


def _class_counts(counts: DataFrame, words: list[str]) -> np.ndarray:
    """Tokens of each ending class, without the words of the vocabulary; at least 1."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = set(words), np.zeros(ENDINGS, np.int64)
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if word not in known:
                    total[_ending(word)] += n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ENDINGS)), pa.array(total)], ["ending", "n"])

    found = counts.select("word", "n").mapInArrow(add, "ending bigint, n bigint").groupBy("ending").agg(
        F.sum("n").alias("n")).collect()
    total = np.zeros(ENDINGS, np.int64)
    for row in found:
        total[row["ending"]] = row["n"]
    return np.maximum(total, 1)


class Tokens:
    """Texts as token numbers: a word of the vocabulary, or the class of its ending.

    ``listed`` words have numbers of their own behind the tokens, which tell
    token and share at once, so that each word of a text is looked up one time.
    """

    def __init__(self, words: list[str], listed: dict[str, float] | None = None) -> None:
        numbers = {w: i for i, w in enumerate(words)}
        others = [w for w in listed or () if w not in numbers]
        # Token of each number, and its share where the number tells it.
        self.token = np.append(np.arange(TOKENS), [TOKENS - ENDINGS + _ending(w) for w in others]).astype(np.int64)
        self.share = np.zeros(len(self.token))
        self.share[TOKENS - ENDINGS:TOKENS] = np.nan
        self.share[TOKENS:] = [listed[w] for w in others]
        self.known = numbers | {w: TOKENS + i for i, w in enumerate(others)}
        # By the last letters: few enough to stay near, unlike the words themselves.
        self.endings = Memo(lambda end: TOKENS - ENDINGS + _ending(end), MEMO)

    def read(self, texts: list[str | None]):
        """Words and their numbers, targets, contexts, and the number of tokens of each text."""
        self.endings.trim()
        split = [_words(t) for t in texts]
        sizes = np.array([len(w) for w in split], dtype=np.int64)
        words = list(chain.from_iterable(split))
        edge = len(OFFSETS) // 2
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(numbers < 0)
        numbers[unknown] = [self.endings[words[i][-2:]] for i in unknown.tolist()]
        padded = np.full(len(words) + edge * (len(texts) + 1), EDGE, np.int64)
        places = np.arange(len(words)) + edge * (1 + np.repeat(np.arange(len(texts)), sizes))
        padded[places] = self.token[numbers]
        return words, numbers, padded[places], np.stack([padded[places + o] for o in OFFSETS], axis=1), sizes

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Targets, their contexts, and the number of tokens of each text."""
        return self.read(texts)[2:]


def _sorting(tokens: np.ndarray) -> np.ndarray:
    """The order that sorts token numbers; short integers are sorted by radix."""
    return np.argsort(tokens.astype(np.int16), kind="stable")


class Network:
    """A window network with a two-step softmax: first the class, then the token in it."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @staticmethod
    def fresh(seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return Network({
            "embed": draw(TOKENS + 1, UNITS) * 3, "mix": draw(len(OFFSETS), UNITS, UNITS) * 2,
            "bias": np.zeros(UNITS, np.float32), "class": draw(UNITS, CLASSES),
            "class_bias": np.zeros(CLASSES, np.float32), "token": draw(CLASSES, UNITS, PER_CLASS),
            "token_bias": np.zeros((CLASSES, PER_CLASS), np.float32)})

    def hidden(self, contexts: np.ndarray) -> np.ndarray:
        total = np.tile(self.w["bias"], (len(contexts), 1))
        for j in range(len(OFFSETS)):
            total += (self.w["embed"] @ self.w["mix"][j]).take(contexts[:, j], axis=0)
        return np.tanh(total)

    # Logits stand in columns, one for each token: sums and maxima then run along rows.
    @staticmethod
    def _log_chosen(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Log-softmax of one entry of each column; ``x`` is used up."""
        x -= x.max(axis=0)
        found = x[chosen, np.arange(len(chosen))]
        np.exp(x, out=x)
        return found - np.log(x.sum(axis=0))

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        x -= x.max(axis=0)
        np.exp(x, out=x)
        x /= x.sum(axis=0)
        return x

    def log_probs(self, targets: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Log-probability of each target, natural."""
        order = _sorting(targets // PER_CLASS)
        targets, h = targets[order], self.hidden(contexts[order])
        kinds = targets // PER_CLASS
        found = self._log_chosen(self.w["class"].T @ h.T + self.w["class_bias"][:, None], kinds)
        bounds = np.searchsorted(kinds, np.arange(CLASSES + 1))
        for c in range(CLASSES):
            part = slice(bounds[c], bounds[c + 1])
            if part.stop > part.start:
                found[part] += self._log_chosen(
                    self.w["token"][c].T @ h[part].T + self.w["token_bias"][c][:, None], targets[part] % PER_CLASS)
        back = np.empty_like(found)
        back[order] = found
        return back

    def gradients(self, targets: np.ndarray, contexts: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability."""
        order = _sorting(targets // PER_CLASS)
        targets, contexts, n = targets[order], contexts[order], np.float32(len(targets))
        h, kinds = self.hidden(contexts), targets // PER_CLASS
        d_class = self._softmax(self.w["class"].T @ h.T + self.w["class_bias"][:, None])
        d_class[kinds, np.arange(len(h))] -= 1
        d_class /= n
        grads = {"class": (d_class @ h).T, "class_bias": d_class.sum(axis=1),
                 "token": np.zeros_like(self.w["token"]), "token_bias": np.zeros_like(self.w["token_bias"])}
        d_h = (self.w["class"] @ d_class).T
        bounds = np.searchsorted(kinds, np.arange(CLASSES + 1))
        for c in range(CLASSES):
            part = slice(bounds[c], bounds[c + 1])
            if part.stop > part.start:
                d = self._softmax(self.w["token"][c].T @ h[part].T + self.w["token_bias"][c][:, None])
                d[targets[part] % PER_CLASS, np.arange(d.shape[1])] -= 1
                d /= n
                grads["token"][c], grads["token_bias"][c] = (d @ h[part]).T, d.sum(axis=1)
                d_h[part] += (self.w["token"][c] @ d).T
        d_sum = np.ascontiguousarray(d_h * (1 - h * h))
        grads["bias"] = d_sum.sum(axis=0)
        grads["embed"], grads["mix"] = np.zeros_like(self.w["embed"]), np.zeros_like(self.w["mix"])
        for j in range(len(OFFSETS)):
            # Sums of the rows that share a context token.
            by = _sorting(contexts[:, j])
            sorted_tokens = contexts[by, j]
            first = np.flatnonzero(np.append(True, sorted_tokens[1:] != sorted_tokens[:-1]))
            used, total = sorted_tokens[first], np.add.reduceat(d_sum.take(by, axis=0), first)
            grads["embed"][used] += total @ self.w["mix"][j].T
            grads["mix"][j] = self.w["embed"][used].T @ total
        return grads

    def train(self, targets: np.ndarray, contexts: np.ndarray, moments: dict, rate: float = 0.007) -> None:
        """One pass in small batches, by Adam."""
        order = np.random.default_rng(len(targets)).permutation(len(targets))
        for start in range(0, len(order), BATCH):
            part = order[start:start + BATCH]
            grads = self.gradients(targets[part], contexts[part])
            moments["step"] = step = moments.get("step", 0) + 1
            for k, g in grads.items():
                m, v = moments.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                self.w[k] -= (rate / (1 - 0.9**step)) * m / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    def packed(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.w.values()])

    def unpacked(self, values: np.ndarray) -> Network:
        weights, at = {}, 0
        for k, x in self.w.items():
            weights[k] = values[at:at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size
        return Network(weights)


def _trained_by_task(docs: DataFrame, words: list[str], net: Network) -> Network:
    """Average of the networks that the tasks trained, by their tokens."""
    start = net.packed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, own, moments, seen = Tokens(words), net.unpacked(start.copy()), {}, 0
        for batch in batches:
            targets, contexts, _ = tokens.of(batch.column(0).to_pylist())
            if len(targets):
                own.train(targets, contexts, moments)
                seen += len(targets)
        if seen:
            sums = (own.packed().astype(np.float64) * seen).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([sums], pa.binary())], ["n", "sums"])

    def add(a, b):
        return a[0] + b[0], a[1] + b[1]

    by_task = docs.select("text").mapInArrow(run, "n bigint, sums binary")
    # A tree, since one task or the driver must not gather what all tasks send.
    n, sums = by_task.rdd.map(lambda r: (r["n"], np.frombuffer(r["sums"]))).treeAggregate(
        (0, np.zeros(len(start))), add, add, depth=3)
    return net.unpacked(sums / n) if n else net


def fit(docs: DataFrame, text_col: str = "text", rounds: int = 2,
        counts: DataFrame | None = None) -> tuple[list[str], Network]:
    """Vocabulary and network of all documents.

    Each round trains on its share of the documents, by a hash of the text,
    starting from the average of the round before; every document is used once.
    ``counts``: the documents' ``word_counts``, where they are at hand.
    """
    rows = picked(docs, text=text_col).filter(F.col("text").isNotNull())
    words, net = vocabulary(word_counts(rows) if counts is None else counts), Network.fresh()
    for turn in range(rounds):
        net = _trained_by_task(rows.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn), words, net)
    return words, net


def score(docs: DataFrame, words: list[str], net: Network, id_col: str = "doc_id",
          text_col: str = "text", counts: DataFrame | None = None) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_prob`` for every row of ``docs``.

    ``counts``: the ``word_counts`` of the documents that were fitted; without
    them, those of ``docs``. A word that is not counted weighs as if counted once.
    Null and empty texts have no tokens, a log-likelihood of 0 and a null mean;
    repeated rows are each returned; an empty table gives no rows.
    """
    rows = picked(docs, doc_id=id_col, text=text_col)
    kind = dict(rows.dtypes)["doc_id"]
    counts = word_counts(rows, "text") if counts is None else counts
    of_class = -np.log(_class_counts(counts, words))
    listed = {w: float(np.log(n)) for w, n in _listed(counts).items()} | dict.fromkeys(words, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(words, listed)
        for batch in batches:
            texts, sums, sizes, ends, left = batch.column(1).to_pylist(), [], [], [0], []
            for at in range(0, len(texts), 50):
                flat, numbers, targets, contexts, own = tokens.read(texts[at:at + 50])
                logs = net.log_probs(targets, contexts).astype(np.float64)
                shares = tokens.share[numbers]
                open_ = np.isnan(shares)
                logs += np.where(open_, 0.0, shares)
                rare = targets >= TOKENS - ENDINGS
                logs[rare] += of_class[targets[rare] - (TOKENS - ENDINGS)]
                stops = np.cumsum(own)
                sums += np.diff(np.append(0, np.append(0, np.cumsum(logs))[stops])).tolist()
                sizes += own.tolist()
                places = np.flatnonzero(open_)
                ends += (len(left) + np.searchsorted(places, stops)).tolist()
                left += [flat[i] for i in places.tolist()]
            # The words whose counts are joined, as they stand in the text.
            others = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(left, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()), others],
                ["doc_id", "n_tokens", "log_likelihood", "others"])

    scored = saved(rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, log_likelihood double, others array<string>").withColumn(
        "row", F.monotonically_increasing_id()))
    # A word counted once, or not at all, adds log(1) and needs no partner.
    joined = scored.select("row", F.explode("others").alias("word")).join(counts.filter("n > 1"), "word")
    shares = joined.groupBy("row").agg(F.sum(F.log(F.col("n").cast("double"))).alias("share"))
    whole = scored.drop("others").join(shares, "row", "left").select(
        "doc_id", "n_tokens", (F.col("log_likelihood") + F.coalesce("share", F.lit(0.0))).alias("log_likelihood"))
    return whole.withColumn("mean_log_prob", F.when(
        F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on ``docs`` and score them."""
    counts = word_counts(docs, text_col)
    words, net = fit(docs, text_col, counts=counts)
    return score(docs, words, net, id_col, text_col, counts)
