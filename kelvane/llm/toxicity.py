"""Toxicity scores of a bidirectional gated recurrent network.

A word enters as a learned vector, as the mean of its character n-grams' learned
vectors, and with two log-odds of toxic against clean documents, of the word and
of its most telling n-gram. Two gated recurrent layers read a window of words in
both directions, attention pools them, and a document's score is that of its
worst window. Trained in numpy on a bounded sample of labelled rows; tasks score
all overlapping windows of whole texts.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvane.llm.common import batch_column, picked, unused

WORD = re.compile(r"\w+")
LENGTH, STRIDE = 32, 24
UNITS = 8  # state of one direction
WORD_DIMS = CHAR_DIMS = 8
BUCKETS = 1 << 15
GRAMS = (4, 5)
PRIOR = 3.0
MEMO = 100_000  # words whose table rows a task remembers; a run of texts may add its own
RUN = 250  # texts scored at a time
STEPS = 400  # at least so many steps, however few the rows


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams_of(word: str) -> list[int]:
    """Buckets of the n-grams of a word between its bounds."""
    marked = f"^{word}$"
    found = [marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)] or [marked]
    return [zlib.crc32(g.encode()) % BUCKETS for g in found]


def spans_of(n: int) -> list[tuple[int, int]]:
    """Windows that cover n words, each overlapping the one before it."""
    if n <= LENGTH:
        return [(0, n)]
    starts = list(range(0, n - LENGTH, STRIDE)) + [n - LENGTH]
    return [(s, s + LENGTH) for s in starts]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def _log_odds(toxic, clean, n_toxic: int, n_clean: int):
    """Log ratio of document rates, shrunk so that an unseen item has 0."""
    share = n_clean / n_toxic
    return np.clip(np.log((toxic + PRIOR) * share / (clean + PRIOR * share)), -3, 5).astype(np.float32)


@dataclass
class Network:
    """Weights, and what turns a word into its input."""

    weights: dict[str, np.ndarray]
    vocabulary: dict[str, int] = field(default_factory=dict)
    word_odds: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))
    gram_odds: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    constant: float | None = None  # the score of every text, where nothing could be learned

    @staticmethod
    def fresh(n_words: int, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.15, shape).astype(np.float32)
        d, h = WORD_DIMS + CHAR_DIMS + 2, UNITS
        weights = {"word": draw(n_words + 1, WORD_DIMS) * 0.2, "char": draw(BUCKETS, CHAR_DIMS) * 0.2,
                   "att": draw(2 * h), "out": draw(2 * h), "bias": np.full(1, -2, np.float32)}
        for side in "fb":
            weights |= {f"x{side}": draw(d, 3 * h) * 2, f"h{side}": draw(h, 3 * h) * 2,
                        f"b{side}": np.zeros(3 * h, np.float32)}
        weights["word"][0] = 0
        return Network(weights)

    def inputs(self, ids, odds, grams, offsets):
        """Rows of inputs for words with vocabulary ids, log-odds and n-gram lists."""
        sizes = np.diff(np.append(offsets, len(grams)))
        chars = np.add.reduceat(self.weights["char"][grams], offsets) / sizes[:, None]
        return np.hstack([self.weights["word"][ids], chars, odds]).astype(np.float32)

    def drive(self, x):
        """What the inputs add to the gates, both directions side by side."""
        return np.hstack([x @ self.weights[f"x{s}"] + self.weights[f"b{s}"] for s in "fb"])


def _gates(drive, h, u):
    """One step of one direction: new state and what the way back needs."""
    k = UNITS
    hu = h @ u
    zr = _sigmoid(drive[:, :2 * k] + hu[:, :2 * k])
    z, r = zr[:, :k], zr[:, k:]
    new = np.tanh(drive[:, 2 * k:] + r * hu[:, 2 * k:])
    return new + z * (h - new), (h, z, r, new, hu[:, 2 * k:])


def _forward(net: Network, drive, mask):
    """drive: windows x steps x 6 units; mask: true for words. Logits and a trace."""
    n, steps, k = drive.shape[0], drive.shape[1], UNITS
    states, traces = np.zeros((n, steps, 2 * k), np.float32), {}
    for side, cut, order in (("f", slice(0, 3 * k), range(steps)),
                             ("b", slice(3 * k, 6 * k), range(steps - 1, -1, -1))):
        h, own = np.zeros((n, k), np.float32), slice(0, k) if side == "f" else slice(k, 2 * k)
        for t in order:
            new, trace = _gates(drive[:, t, cut], h, net.weights[f"h{side}"])
            h = np.where(mask[:, t, None], new, h)
            states[:, t, own], traces[side, t] = h, trace
    score = np.where(mask, states @ net.weights["att"], -1e9)
    weight = np.exp(score - score.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    pooled = np.einsum("nt,ntk->nk", weight, states)
    return pooled @ net.weights["out"] + net.weights["bias"][0], (states, weight, pooled, traces)


def _backward(net: Network, mask, trace, d_logit):
    """Gradients of the recurrent weights and of ``drive``."""
    states, weight, pooled, traces = trace
    w, k, steps = net.weights, UNITS, mask.shape[1]
    grads = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
    d_pooled = np.outer(d_logit, w["out"])
    d_weight = np.einsum("nk,ntk->nt", d_pooled, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    grads["att"] = np.einsum("nt,ntk->k", d_score, states)
    d_states = weight[:, :, None] * d_pooled[:, None, :] + d_score[:, :, None] * w["att"]
    d_drive = np.zeros((*mask.shape, 6 * k), np.float32)
    for side, cut, own, order in (("f", slice(0, 3 * k), slice(0, k), range(steps - 1, -1, -1)),
                                  ("b", slice(3 * k, 6 * k), slice(k, 2 * k), range(steps))):
        u, d_h = w[f"h{side}"], np.zeros((len(mask), k), np.float32)
        grads[f"h{side}"] = np.zeros_like(u)
        for t in order:
            d_h = d_h + d_states[:, t, own]
            h, z, r, new, hn = traces[side, t]
            live = mask[:, t, None] * d_h
            d_new = live * (1 - z) * (1 - new * new)
            d_z = live * (h - new) * z * (1 - z)
            d_r = d_new * hn * r * (1 - r)
            d_drive[:, t, cut] = np.hstack([d_z, d_r, d_new])
            d_hu = np.hstack([d_z, d_r, d_new * r])
            grads[f"h{side}"] += h.T @ d_hu
            d_h = np.where(mask[:, t, None], live * z + d_hu @ u.T, d_h)
    return grads, d_drive


def _side_by_side(net: Network) -> np.ndarray:
    """Recurrent weights of both directions, arranged as z, z, r, r, new, new."""
    k = UNITS
    zero = np.zeros((k, k), np.float32)
    parts = [(net.weights["hf"][:, i * k:(i + 1) * k], net.weights["hb"][:, i * k:(i + 1) * k])
             for i in range(3)]
    return np.hstack([np.vstack([np.hstack([f, zero]), np.hstack([zero, b])]) for f, b in parts])


def _no_word() -> np.ndarray:
    """Gate inputs that keep the state as it is."""
    row = np.zeros((1, 6 * UNITS), np.float32)
    row[0, [*range(UNITS), *range(3 * UNITS, 4 * UNITS)]] = 40.0
    return row


def window_logits(net: Network, table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Logits of windows given as rows of ``table``; row 0 is no word.

    Both directions advance in one state, so a step is one small product.
    """
    k, (n, steps), u = UNITS, places.shape, _side_by_side(net)
    places = np.ascontiguousarray(places.T)
    live = places > 0
    h = np.zeros((n, 2 * k), np.float32)
    states = np.zeros((steps, n, 2 * k), np.float32)
    drive = np.empty((n, 6 * k), np.float32)
    view, rows = drive.reshape(n, 3, 2, k), table.reshape(-1, 2, 3, k)
    for t in range(steps):
        view[:, :, 0] = rows[places[t], 0]
        view[:, :, 1] = rows[places[steps - 1 - t], 1]
        hu = h @ u
        zr = drive[:, :4 * k]
        zr += hu[:, :4 * k]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        new = hu[:, 4 * k:]
        new *= zr[:, 2 * k:]
        new += drive[:, 4 * k:]
        np.tanh(new, out=new)
        h -= new
        h *= zr[:, :2 * k]
        h += new
        states[t, :, :k] = h[:, :k]
        states[steps - 1 - t, :, k:] = h[:, k:]
    score = np.where(live, states @ net.weights["att"], np.float32(-1e9))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.zeros((n, 2 * k), np.float32)
    for t in range(steps):
        pooled += weight[t, :, None] * states[t]
    return pooled @ net.weights["out"] + net.weights["bias"][0]


class _Adam:
    def __init__(self, weights, rate: float = 0.01) -> None:
        self.rate, self.step = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def apply(self, weights, grads) -> None:
        self.step += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            size = np.sqrt(self.v[k] / (1 - 0.99**self.step)) + 1e-6
            weights[k] -= (self.rate * self.m[k] / (1 - 0.9**self.step) / size).astype(np.float32)


def train(texts: list[str], labels: list[int], rounds: int = 4, batch: int = 64) -> Network:
    """A network for labelled texts.

    A toxic text need not be toxic everywhere, so each round trains on its two
    worst windows as the network sees them, against the worst and some random
    windows of clean texts. A text's own label is left out of the log-odds it
    trains with; they would give it away.
    """
    n_toxic, n_clean = sum(labels), len(labels) - sum(labels)
    if not n_toxic or not n_clean:
        net = Network.fresh(0)
        net.constant = (n_toxic + 0.5) / (len(labels) + 1) if labels else 0.0
        return net
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in words_of(t)] or [0], dtype=np.int64)
            for t in texts]
    index = index or {"": 0}
    listed = [np.array(grams_of(w), np.int32) for w in index]
    sizes = np.array([len(g) for g in listed])
    grams = np.concatenate(listed).astype(np.int64)
    offsets = np.append(0, np.cumsum(sizes)[:-1])
    del listed
    counts = np.zeros((2, len(index)))
    gram_counts = np.zeros((2, BUCKETS))
    for words, label in zip(docs, labels):
        own = np.unique(words)
        counts[label, own] += 1
        seen = np.unique(np.concatenate([grams[offsets[i]:offsets[i] + sizes[i]] for i in own]))
        gram_counts[label, seen] += 1

    def odds(toxic_less: int, clean_less: int):
        word = _log_odds(np.maximum(counts[1] - toxic_less, 0), np.maximum(counts[0] - clean_less, 0),
                         n_toxic, n_clean)
        gram = _log_odds(np.maximum(gram_counts[1] - toxic_less, 0),
                         np.maximum(gram_counts[0] - clean_less, 0), n_toxic, n_clean)
        return np.column_stack([word, np.maximum.reduceat(gram[grams], offsets)]), word, gram

    by_label = [odds(0, 1)[0], odds(1, 0)[0]]
    _, word_odds, gram_odds = odds(0, 0)
    usual = np.flatnonzero(counts.sum(axis=0) >= 5)
    ids = np.zeros(len(index), np.int64)
    ids[usual] = np.arange(1, len(usual) + 1)
    net = Network.fresh(len(usual))
    names = list(index)
    net.vocabulary = {names[i]: int(ids[i]) for i in usual}
    net.word_odds = np.append(np.float32(0), word_odds[usual])
    net.gram_odds = gram_odds
    # A word outside the kept vocabulary has no odds of its own when scoring.
    for table in by_label:
        table[ids == 0, 0] = 0

    owner, rows, mask = [], [], []
    for d, words in enumerate(docs):
        for a, b in spans_of(len(words)):
            owner.append(d)
            rows.append(np.pad(words[a:b], (0, LENGTH - (b - a))))
            mask.append(np.arange(LENGTH) < b - a)
    owner, rows, mask = np.array(owner), np.array(rows), np.array(mask)
    target = np.array(labels, dtype=np.int64)[owner]
    rng, adam = np.random.default_rng(11), _Adam(net.weights)

    def ranked(values):
        """Each window's place among its document's, 0 for the worst."""
        order = np.lexsort((-values, owner))
        place = np.empty(len(order), np.int64)
        first = np.searchsorted(owner, owner[order])
        place[order] = np.arange(len(order)) - first
        return place

    turn = 0
    while turn < rounds or adam.step < STEPS:
        if turn == 0:
            hints = [table.sum(axis=1) for table in by_label]
            value = np.where(mask, np.where(target[:, None] == 1, hints[1][rows], hints[0][rows]), -9).max(axis=1)
        elif turn < rounds:
            value = np.empty(len(rows))
            for label in (0, 1):
                table = _drives(net, ids, by_label[label], grams, offsets)
                own = np.flatnonzero(target == label)
                for part in np.array_split(own, len(own) // 2048 + 1):
                    value[part] = window_logits(net, table, np.where(mask[part], rows[part] + 1, 0))
        place = ranked(value)
        chosen = np.flatnonzero(np.where(target == 1, place < 2 - (turn > 1),
                                         (place < 2) | (rng.random(len(place)) < 0.02)))
        rng.shuffle(chosen)
        gain = (target[chosen] == 0).sum() / max(1, (target[chosen] == 1).sum())
        for start in range(0, len(chosen), batch):
            part = chosen[start:start + batch]
            _step(net, adam, ids, by_label, grams, offsets, sizes, rows[part], mask[part], target[part],
                  min(gain, 4.0))
        turn += 1
    return net


def _drives(net: Network, ids, odds, grams, offsets, part: int = 4096) -> np.ndarray:
    """``Network.drive`` of all words behind a row of no word, a part at a time:
    what it takes in between is several times as large."""
    table = np.empty((len(ids) + 1, 6 * UNITS), np.float32)
    table[:1] = _no_word()
    bounds = np.append(offsets, len(grams))
    for a in range(0, len(ids), part):
        b = min(a + part, len(ids))
        table[a + 1:b + 1] = net.drive(net.inputs(
            ids[a:b], odds[a:b], grams[bounds[a]:bounds[b]], offsets[a:b] - offsets[a]))
    return table


def _step(net, adam, ids, by_label, grams, offsets, sizes, rows, mask, target, gain) -> None:
    """One step of gradient descent on a batch of windows."""
    keys, inverse = np.unique(rows * 2 + target[:, None], return_inverse=True)
    words, label = keys // 2, keys % 2
    lists = [np.arange(offsets[w], offsets[w] + sizes[w]) for w in words]
    own = grams[np.concatenate(lists)]
    starts = np.append(0, np.cumsum(sizes[words])[:-1])
    odds = np.where(label[:, None] == 1, by_label[1][words], by_label[0][words])
    x = net.inputs(ids[words], odds, own, starts)
    inverse = inverse.reshape(rows.shape)
    logit, trace = _forward(net, net.drive(x)[inverse], mask)
    d_logit = ((_sigmoid(logit) - target) * np.where(target == 1, gain, 1.0) / len(target)).astype(np.float32)
    grads, d_drive = _backward(net, mask, trace, d_logit)
    k = 3 * UNITS
    total = np.zeros((len(keys), 2 * k), np.float32)
    np.add.at(total, inverse.ravel(), d_drive.reshape(-1, 2 * k))
    d_x = np.zeros_like(x)
    for side, cut in (("f", slice(0, k)), ("b", slice(k, 2 * k))):
        grads[f"x{side}"] = x.T @ total[:, cut]
        grads[f"b{side}"] = total[:, cut].sum(axis=0)
        d_x += total[:, cut] @ net.weights[f"x{side}"].T
    grads["word"] = np.zeros_like(net.weights["word"])
    np.add.at(grads["word"], ids[words], d_x[:, :WORD_DIMS])
    grads["word"][0] = 0
    each = np.repeat(d_x[:, WORD_DIMS:WORD_DIMS + CHAR_DIMS] / sizes[words][:, None], sizes[words], axis=0)
    grads["char"] = np.zeros_like(net.weights["char"])
    np.add.at(grads["char"], own, each)
    for name in ("word", "char", "xf", "xb"):
        grads[name] += 1e-5 * net.weights[name]
    adam.apply(net.weights, grads)


class Scorer:
    """Scores texts; remembers what the words it met add to the gates."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.rows: dict[str, int] = {}
        self.table = _no_word()
        self.met = np.zeros(1, np.int64)  # how often each row was read

    def _trim(self) -> None:
        """Keep the words met most often, a third of what may be remembered."""
        kept = 1 + np.sort(np.argsort(-self.met[1:len(self.rows) + 1], kind="stable")[:MEMO // 3])
        names = list(self.rows)
        self.rows = {names[i - 1]: row for row, i in enumerate(kept.tolist(), 1)}
        self.table = np.vstack([_no_word(), self.table[kept]])
        self.met = np.zeros(len(self.table), np.int64)

    def _learn(self, words: list[str], part: int = 4096) -> None:
        """Table rows for new words, a part at a time: what it takes in between is
        several times as large."""
        first = len(self.rows) + 1
        need = first + len(words)
        if need > len(self.table):
            grown = np.zeros((need + need // 4, 6 * UNITS), np.float32)
            grown[:first] = self.table[:first]
            self.table, self.met = grown, np.append(self.met, np.zeros(len(grown) - len(self.met), np.int64))
        for a in range(0, len(words), part):
            own = words[a:a + part]
            listed = [grams_of(w) for w in own]
            sizes = np.array([len(g) for g in listed])
            grams, offsets = np.array([g for x in listed for g in x]), np.append(0, np.cumsum(sizes)[:-1])
            ids = np.array([self.net.vocabulary.get(w, 0) for w in own])
            odds = np.column_stack([self.net.word_odds[ids],
                                    np.maximum.reduceat(self.net.gram_odds[grams], offsets)])
            self.table[first + a:first + a + len(own)] = self.net.drive(self.net.inputs(ids, odds, grams, offsets))
        self.rows.update(zip(words, range(first, need)))

    def scores(self, texts: list[str | None]) -> list[float]:
        if self.net.constant is not None:
            return [self.net.constant] * len(texts)
        return [x for i in range(0, len(texts), RUN) for x in self._scores(texts[i:i + RUN])]

    def _scores(self, texts: list[str | None]) -> list[float]:
        if len(self.rows) > MEMO:
            self._trim()
        docs = [words_of(t) for t in texts]
        new = list({w for words in docs for w in words if w not in self.rows})
        if new:
            self._learn(new)
        get = self.rows.__getitem__
        flat = np.fromiter((r for words in docs for r in map(get, words)), np.int64)
        self.met += np.bincount(flat, minlength=len(self.met))
        flat = np.append(flat, np.zeros(LENGTH, np.int64))
        starts, ends, owner, at = [], [], [], 0
        for d, words in enumerate(docs):
            for a, b in spans_of(len(words)):
                starts.append(at + a)
                ends.append(at + b)
                owner.append(d)
            at += len(words)
        starts, ends = np.array(starts), np.array(ends)
        best = np.full(len(texts), -np.inf)
        for i in range(0, len(starts), 2048):
            places = starts[i:i + 2048, None] + np.arange(LENGTH)
            rows = np.where(places < ends[i:i + 2048, None], flat[places], 0)
            np.maximum.at(best, owner[i:i + 2048], window_logits(self.net, self.table, rows))
        return _sigmoid(best).tolist()


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learned: a fifth, by a checksum of the id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> DataFrame:
    """At most so many labelled texts of either class, by a hash of the id.

    An id labelled more than once is toxic if any label says so; of texts that
    share an id one is taken.
    """
    known = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    part = lambda c, n: known.filter(c).orderBy(order, "doc_id").limit(n)
    chosen = part(F.col("label") > 0, toxic_rows).unionByName(part(F.col("label") <= 0, clean_rows))
    # At most toxic_rows + clean_rows short rows.
    return docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", toxic_rows: int = 1000, clean_rows: int = 2000) -> Network:
    """Train on at most ``toxic_rows + clean_rows`` labelled documents."""
    rows = sample(picked(docs, doc_id=id_col, text=text_col),
                  picked(labels, doc_id=id_col, label=label_col), toxic_rows, clean_rows)
    taken = sorted(((r["text"] or "", int(r["label"] > 0)) for r in rows.select("text", "label").toLocalIterator()))
    unique = dict(taken)  # a text that recurs trains once
    return train(list(unique), list(unique.values()))


def score(text: Column, net: Network) -> Column:
    """The score of a text column; it sees nothing else.

    Null and empty texts get the score of a window without words. Without labels
    of both classes every text gets one constant.
    """
    return batch_column(text, "double", lambda: Scorer(net).scores)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Repeated rows are each returned, null ids are not held out, an empty table
    gives no rows.
    """
    net = fit(docs, labels, id_col, text_col, label_col)
    rows = picked(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score(F.col("text"), net).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, as they are.

    Null and empty texts score as a window without words. Rows repeated whole all
    stay or go; without labels of both classes every text has one score. Further
    columns may have any name; an empty table gives no rows.
    """
    net = fit(docs, labels, id_col, text_col, label_col)
    name = unused(docs, "score")
    scored = docs.withColumn(name, score(F.col(f"`{text_col}`"), net))
    return scored.filter(F.col(name) < threshold).drop(name)
