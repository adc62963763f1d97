"""Near duplicates, language models, mixing, toxicity and tokenizers against plain Python."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kelvane.llm import (
    byte_pairs, common, mixing, near_duplicates, pseudo_likelihood, token_counts, toxicity,
)
from kelvane.llm.graph import components

ODD = [
    None, "", " ", "\n\n", " a  b   c\n d", "▁x ▁ y", "<s> </s> <unk> <0x0A>", "it's we'll I'M 'S",
    "<|endoftext|>", "a<|endoftext|> b<|startoftext|>c", "ΣΑΣ İı ß", "日本語 ゼ🙂́", "a" * 3000, " " * 300,
    "tab\tcr\r\nnul\x00\x1c\x85nbsp end",
]


def documents(spark, rows, extra="n_tokens int"):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], f"doc_id bigint, text string, {extra}")


def odd_texts():
    rng = random.Random(4)
    letters = list("abcdeABC  \n\t'\"▁.éßΣσ日ゼ🙂<|>s1")
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]


def test_token_counts_equal_the_library(spark):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, texts = sentencepiece.SentencePieceProcessor(model_file=path), odd_texts()
    rows = token_counts.count_tokens(documents(spark, enumerate(texts)), path, limit=50).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        n = len(library.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 50), repr(text)
    assert token_counts.count_tokens(documents(spark, []), path).count() == 0


def test_byte_pairs_equal_the_library(spark):
    from tokenizers import Tokenizer
    path, texts = public_tokenizers.path("word_bpe_49k.json"), odd_texts()
    library = Tokenizer.from_file(path)
    rows = byte_pairs.encode_decode(documents(spark, enumerate(texts)), path).collect()
    packed = byte_pairs.encode_decode(documents(spark, enumerate(texts)), path, ids_as="binary").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens) == (ids, len(ids)), repr(texts[r.doc_id])
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert {p.doc_id: list(memoryview(bytes(p.ids)).cast("I")) for p in packed} == {r.doc_id: r.ids for r in rows}
    assert byte_pairs.encode_decode(documents(spark, []), path).count() == 0


def near_texts():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(120)] for _ in range(8)]
    texts = [" ".join(b) for b in base]
    for _ in range(70):  # one or two edits each: links among many, not all, of them
        words = list(base[0])
        for _ in range(rng.choice([1, 1, 2])):
            words[rng.randrange(120)] = word()
        texts.append(" ".join(words))
    texts += [texts[0]] * 20 + [texts[1] + " " + texts[2]] + ["a b c", "a b c ", "", "", None, " "]
    return texts


def test_near_duplicates_equal_brute_force(spark):
    texts = near_texts()
    rows = near_duplicates.classes(documents(spark, enumerate(texts), "node int")).collect()
    assert len(rows) == len(texts)
    shingles = near_duplicates.Shingles()
    counts = np.zeros(near_duplicates.DF_BUCKETS, np.int64)
    for t in texts:
        counts[np.unique(near_duplicates._bucket(shingles.of(t)[0]))] += 1
    weights = near_duplicates.Weights(near_duplicates.inverse_frequency(counts, len(texts)))
    vectors = [weights.of(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if group[i] != group[j] and (same or weights.similarity(vectors[i], vectors[j]) >= 0.8):
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min(i for i in range(len(texts)) if group[i] == g) for g in set(group)}
    assert {r.doc_id: r.class_id for r in rows} == {i: least[group[i]] for i in range(len(texts))}


def signatures_of(spark, weights, texts):
    rows = [(i, float(w.sum(dtype=np.float64)), near_duplicates.mask_of(s)) for i, t in texts for s, w in [weights.of(t)]]
    return spark.createDataFrame(rows, "node bigint, total double, mask array<bigint>")


def test_masks_rule_out_no_pair_that_reaches_the_threshold(spark):
    counts = np.random.default_rng(1).integers(1, 400, near_duplicates.DF_BUCKETS)
    weights, rng = near_duplicates.Weights(near_duplicates.inverse_frequency(counts, 400)), random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts, pairs = [], []
    for size in (1, 3, 20, 60, 200, 900, 3000):
        words = [word() for _ in range(size)]
        for edits in (0, 1, 2, 5, 20, 60):
            edited = list(words)
            for _ in range(min(edits, size)):
                edited[rng.randrange(size)] = word()
            edited += edited[:rng.choice([0, 0, size // 4])]
            texts += [" ".join(words), " ".join(edited)]
            pairs.append((len(texts) - 2, len(texts) - 1))
    vectors = [weights.of(t) for t in texts]
    signed = signatures_of(spark, weights, enumerate(texts))
    frame = near_duplicates._signed(near_duplicates._signed(
        spark.createDataFrame(pairs, "a bigint, b bigint"), signed, "a"), signed, "b")
    ruled_out = 0
    for threshold in (0.3, 0.6, 0.8, 0.95):
        possible = {(r.a, r.b) for r in frame.filter(near_duplicates._possible("a", "b", threshold)).collect()}
        assert all((a, b) in possible for a, b in pairs if weights.similarity(vectors[a], vectors[b]) >= threshold)
        ruled_out += len(pairs) - len(possible)
    assert ruled_out > 40


def test_band_partners_are_compared_however_few_samples_agree(spark):
    idf = near_duplicates.inverse_frequency(np.ones(near_duplicates.DF_BUCKETS, np.int64), 400)
    weights, sampler, rng = near_duplicates.Weights(idf), near_duplicates.Sampler(), random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))

    def signed(text):
        shingles, weight = weights.of(text)
        return sampler.samples(shingles, weight, np.array([0]))[0]

    # An isolated pair that shares a band with fewer than half of the samples alike.
    while True:
        words = [word() for _ in range(60)]
        edited = list(words)
        for i in rng.sample(range(60), 4):
            edited[i] = word()
        a, b = " ".join(words), " ".join(edited)
        same = signed(a) == signed(b)
        if same.sum() < 15 and same.reshape(near_duplicates.BANDS, near_duplicates.ROWS).all(axis=1).any():
            break
    found = near_duplicates._linked(
        spark.createDataFrame([(1, 2)], "a bigint, b bigint"),
        signatures_of(spark, weights, [(1, a), (2, b)]),
        spark.createDataFrame([(1, a), (2, b)], "node bigint, text string"), idf,
        weights.similarity(weights.of(a), weights.of(b)))
    assert [tuple(r) for r in found.collect()] == [(1, 2)]


def test_near_duplicates_keep_one_of_each_and_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (3, text), (3, text), (9, text + " more"), (1, "other words"), (None, "lone"), (7, None), (8, "")]
    frame = documents(spark, rows, "_node int")
    kept = near_duplicates.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [
        (-1, "lone"), (1, "other words"), (3, text), (7, None)]
    assert near_duplicates.one_of_each(frame.limit(0)).count() == 0


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(3)
    sampler, found, wanted = near_duplicates.Sampler(), [], []
    for _ in range(200):
        keys = np.sort(rng.integers(1, 1 << 63, 60, dtype=np.uint64))
        a, b = rng.integers(1, 4, 60).astype(np.float32), rng.integers(1, 4, 60).astype(np.float32)
        x, y = (sampler.samples(keys, w, np.array([0]))[0] for w in (a, b))
        found.append((x == y).mean())
        wanted.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(found) - np.mean(wanted)) < 0.02


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


def test_probabilities_of_the_window_network_add_up():
    net = pseudo_likelihood.Network.fresh()
    contexts = np.tile(np.array([[3, 9, pseudo_likelihood.EDGE, 1]]), (pseudo_likelihood.TOKENS, 1))
    logs = net.log_probs(np.arange(pseudo_likelihood.TOKENS), contexts)
    assert abs(np.exp(logs.astype(float)).sum() - 1) < 1e-3


def test_gradients_of_the_window_network():
    rng = np.random.default_rng(1)
    net = pseudo_likelihood.Network.fresh()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    targets = rng.integers(0, pseudo_likelihood.TOKENS, 12)
    contexts = rng.integers(0, pseudo_likelihood.TOKENS + 1, (12, 4))
    grads = net.gradients(targets, contexts)
    for name in net.w:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        kept, sides = net.w[name][at], []
        for step in (1e-4, -1e-4):
            net.w[name][at] = kept + step
            sides.append(-net.log_probs(targets, contexts).mean())
        net.w[name][at] = kept
        assert abs((sides[0] - sides[1]) / 2e-4 - grads[name][at]) < 1e-3 * max(1, abs(grads[name][at])), name


def test_pseudo_likelihood_scores(spark):
    rng = random.Random(1)
    usual = [" ".join(rng.choice(["the cat sat", "a dog ran"]) for _ in range(40)) for _ in range(120)]
    words = usual[0].split()
    rng.shuffle(words)
    texts = usual + [" ".join(words), None, "", "lone"]
    frame = documents(spark, enumerate(texts))
    rows = {r.doc_id: r for r in pseudo_likelihood.score_corpus(frame).collect()}
    assert len(rows) == len(texts)
    assert rows[0].mean_log_prob > rows[120].mean_log_prob  # order matters
    assert (rows[121].n_tokens, rows[121].log_likelihood, rows[121].mean_log_prob) == (0, 0.0, None)
    words, net = pseudo_likelihood.fit(frame)
    targets, contexts, sizes = pseudo_likelihood.Tokens(words).of(texts)
    logs = net.log_probs(targets, contexts)
    starts = np.append(0, np.cumsum(sizes))
    for i in (0, 50, 120, 123):
        assert abs(logs[starts[i]:starts[i + 1]].sum() - rows[i].log_likelihood) < 0.05 * sizes[i] + 1e-3
    assert pseudo_likelihood.score_corpus(frame.limit(0)).count() == 0


def test_words_outside_the_vocabulary_are_tokens_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "LISTED", 50)  # most of the rare words are joined
    usual = [f"w{i:04d}x" for i in range(pseudo_likelihood.TOKENS - pseudo_likelihood.ENDINGS)] * 20
    rare = ["qqing"] * 8 + ["zzing"] * 2 + ["ooing"]
    texts = [" ".join(usual), *[f"w0001x {w} w0002x" for w in rare], "QQing\u00a0zzing", None]
    frame = documents(spark, enumerate(texts))
    rows = {r.doc_id: r for r in pseudo_likelihood.score_corpus(frame).collect()}
    assert len(rows) == len(texts) and rows[12].n_tokens == 2
    words, net = pseudo_likelihood.fit(frame)
    found = pseudo_likelihood.Tokens(words)

    def of_classes(text):
        return float(net.log_probs(*found.of([text])[:2]).sum())

    # 9 + 3 + 1 tokens of one class, so their shares add up to the class.
    for i, n in ((1, 9), (9, 3), (11, 1)):
        assert abs(rows[i].log_likelihood - rows[1].log_likelihood - np.log(n / 9)) < 1e-6
    again = {r.doc_id: r for r in pseudo_likelihood.score(frame, words, net).collect()}
    for i, share in ((1, np.log(9 / 13)), (9, np.log(3 / 13)), (12, np.log(9 / 13) + np.log(3 / 13))):
        assert abs(again[i].log_likelihood - of_classes(texts[i]) - share) < 1e-3


def test_whole_documents_score_as_a_plain_loop(spark, monkeypatch):
    """Every token by its own forward pass, every word by counts over all texts."""
    pl = pseudo_likelihood
    monkeypatch.setattr(pl, "LISTED", 40)
    rng = random.Random(6)
    usual = [f"w{i:04d}x" for i in range(pl.TOKENS - pl.ENDINGS)]
    texts = [" ".join(usual * 5)]
    texts += [" ".join(rng.choice(usual[:30] + ["Qqing", "zzing", "ooing", "\u00e9t\u00e9", "x"]) for _ in range(n))
              for n in (0, 1, 2, 3, 40, 130)] + ["once only here", None, "  \n "]
    texts += [" ".join(usual[:3] + ["rare"] * 4000)]
    frame = documents(spark, enumerate(texts))
    words, net = pl.fit(frame)
    rows = {r.doc_id: r for r in pl.score(frame, words, net).collect()}
    counts, known = {}, {w: i for i, w in enumerate(words)}
    for text in texts:
        for word in (text or "").lower().split():
            counts[word] = counts.get(word, 0) + 1
    w = {k: v.astype(np.float64) for k, v in net.w.items()}

    def token(word):
        return known.get(word, pl.TOKENS - pl.ENDINGS + pl._ending(word))

    def chosen(logits, i):
        return logits[i] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()

    for doc, text in enumerate(texts):
        split = (text or "").lower().split()
        at, total = [token(x) for x in split], 0.0
        for i, word in enumerate(split):
            hidden = w["bias"].copy()
            for j, offset in enumerate(pl.OFFSETS):
                near = at[i + offset] if 0 <= i + offset < len(at) else pl.EDGE
                hidden += w["embed"][near] @ w["mix"][j]
            hidden = np.tanh(hidden)
            c, inside = divmod(at[i], pl.PER_CLASS)
            total += chosen(hidden @ w["class"] + w["class_bias"], c)
            total += chosen(hidden @ w["token"][c] + w["token_bias"][c], inside)
            if word not in known:
                total += np.log(counts[word] / sum(n for x, n in counts.items() if x not in known
                                                   and pl._ending(x) == pl._ending(word)))
        assert rows[doc].n_tokens == len(split)
        assert abs(rows[doc].log_likelihood - total) <= 1e-3 * max(1, len(split)) ** 0.5, doc


def languages(spark):
    rng = random.Random(2)
    words = {"x": ["ba", "be", "bi", "bo"], "y": ["ka", "ke", "ki", "ko"], "z": ["ma", "me", "mi", "mo"]}
    rows = [(i, " ".join(rng.choice(words[d]) for _ in range(rng.randrange(5, 60))), d)
            for i, d in enumerate("x" * 60 + "y" * 30 + "z" * 10)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, domain string")


def test_reading_remembers_endings_and_not_words():
    pl = pseudo_likelihood
    tokens = pl.Tokens(["known"], {"known": 0.0, "listed": 0.5})
    words = [f"{i}x{i % 7}" for i in range(5000)]
    found, numbers, targets, _, sizes = tokens.read(["known listed " + " ".join(words), None])
    assert found == ["known", "listed", *words] and sizes.tolist() == [5002, 0]
    assert numbers[:2].tolist() == [0, pl.TOKENS]
    assert targets.tolist() == [0] + [pl.TOKENS - pl.ENDINGS + pl._ending(w) for w in ["listed", *words]]
    assert max(len(v) for v in vars(tokens).values() if isinstance(v, dict)) < 100


def test_mixing_meets_its_targets(spark):
    docs = languages(spark)
    targets = {"x": 0.2, "y": 0.3, "z": 0.5}
    rows = mixing.mix(docs, docs, targets).collect()
    total = sum(r.n_tokens for r in rows)
    for i, d in enumerate(sorted(targets)):
        got = sum(r.rate * r.n_tokens * r.membership[i] for r in rows)
        assert abs(got / total - targets[d]) < 1e-4
    assert all(r.rate >= 0 and abs(sum(r.membership) - 1) < 1e-9 for r in rows)
    assert sum(r.domain == d.domain for r, d in zip(sorted(rows), sorted(docs.collect()))) == 100


def test_mixing_with_a_domain_to_leave_out_and_odd_rows(spark):
    docs = languages(spark)
    odd = spark.createDataFrame([(900, None, "x"), (901, "", "x"), (None, "ba be", "x")], docs.schema)
    rows = mixing.mix(docs.union(odd), docs, {"x": 1.0, "y": 0.0, "z": 1.0}).collect()
    assert len(rows) == 103
    left = sum(r.rate * r.n_tokens * r.membership[1] for r in rows) / sum(r.n_tokens for r in rows)
    assert left < 0.02
    nothing = mixing.mix(docs, docs.limit(0), {"x": 1.0, "y": 1.0}).collect()
    assert {(r.domain, r.rate) for r in nothing} == {(None, 1.0)}
    assert mixing.mix(docs.limit(0), docs, {"x": 1.0}).count() == 0


def test_resampling_repeats_scarce_domains_and_drops_none(spark):
    docs = languages(spark).withColumns({"m": F.lit(1), "rate": F.lit("r")})
    found = mixing.resampled(docs, docs, {"x": 0.4, "y": 0.3, "z": 0.3})
    assert found.columns == docs.columns
    n = {r.doc_id: r.n for r in found.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert len(n) == 100 and sum(n[i] for i in range(90, 100)) >= 25


def test_growing_rates_are_solved_under_a_least_rate_of_one(spark):
    kinds = [[0.9, 0.1]] * 60 + [[0.6, 0.4]] * 30 + [[0.3, 0.7]] * 10
    members = spark.createDataFrame([(10, m) for m in kinds], "n_tokens bigint, membership array<double>")
    rate = mixing.solve(members, [0.5, 0.5], total="grow", rounds=200)
    found = {tuple(r.membership): r.rate for r in members.select("membership", rate.alias("rate")).collect()}
    assert min(found.values()) == 1.0 and found[0.9, 0.1] == 1.0
    # The least squares under that bound, in the solver's scaling.
    m = np.array(kinds)
    scale = np.linalg.pinv(m.T @ m / len(m))
    rates = np.ones(len(m))
    for _ in range(20_000):
        gap = m.T @ rates / len(m) - m.mean(axis=0).max() / 0.5 * np.array([0.5, 0.5])
        rates = np.maximum(1.0, rates - m @ scale @ gap)
    assert all(abs(found[tuple(k)] - r) < 0.02 for k, r in zip(kinds, rates))


def test_gradients_of_the_toxicity_network():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh(5)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    drive = rng.normal(size=(3, 6, 6 * toxicity.UNITS))
    mask = np.arange(6) < np.array([6, 4, 1])[:, None]
    target = np.array([1.0, 0.0, 1.0])

    def loss(d):
        logit = toxicity._forward(net, d, mask)[0]
        return np.log1p(np.exp(-logit * (2 * target - 1))).sum()

    logit, trace = toxicity._forward(net, drive, mask)
    grads, d_drive = toxicity._backward(net, mask, trace, 1 / (1 + np.exp(-logit)) - target)
    for name in ("hf", "hb", "att", "out", "bias"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        kept, sides = net.weights[name][at], []
        for step in (1e-3, -1e-3):
            net.weights[name][at] = kept + step
            sides.append(loss(drive))
        net.weights[name][at] = kept
        assert abs((sides[0] - sides[1]) / 2e-3 - grads[name][at]) < 2e-2 * max(1, abs(grads[name][at])), name
    at = np.unravel_index(np.abs(d_drive).argmax(), d_drive.shape)
    sides = []
    for step in (1e-3, -1e-3):
        moved = drive.copy()
        moved[at] += step
        sides.append(loss(moved))
    assert abs((sides[0] - sides[1]) / 2e-3 - d_drive[at]) < 2e-2


def test_fast_windows_equal_the_trained_form():
    rng = np.random.default_rng(5)
    net = toxicity.Network.fresh(0)
    table = np.vstack([toxicity._no_word(), rng.normal(size=(9, 6 * toxicity.UNITS)).astype(np.float32)])
    places = rng.integers(1, 10, (7, toxicity.LENGTH))
    places[2, 5:], places[3, :] = 0, 0
    slow = toxicity._forward(net, table[places], places > 0)[0]
    assert np.allclose(toxicity.window_logits(net, table, places), slow, atol=1e-4)


def toxic_texts():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abdeginorst") for _ in range(rng.randrange(2, 8)))
    plain, bad = [word() for _ in range(300)], ["vilez", "grumpf", "stunk"]
    out = []
    for i in range(700):
        words = [rng.choice(plain) for _ in range(rng.randrange(10, 250))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(["", "er", "ish"])
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_toxicity_on_held_out_documents(spark):
    rows = toxic_texts()
    docs = documents(spark, [(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (None, "lone"), (0, rows[0][1])],
                     "score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (None, 1)], "doc_id bigint, toxic int")
    found = toxicity.classify(docs, labels).collect()
    assert len(found) == len(rows) + 4
    truth = {i: y for i, _, y in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in found if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in found)


@pytest.mark.parametrize("labels", [[], [(3, 0), (4, 0)]])
def test_toxicity_without_two_classes_is_a_constant(spark, labels):
    docs = documents(spark, [(3, "a b"), (4, "c"), (5, None)])
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = toxicity.classify(docs, frame).collect()
    assert len({r.score for r in found}) == 1 and {r.predicted for r in found} == {0}


def test_saved_rows_leave_no_shuffles_behind(spark):
    import glob
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for d in disks.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = shuffles()
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    found = common.saved(rows.join(rows.withColumnRenamed("n", "m"), "k"))
    assert not shuffles() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept
    for _ in range(2):
        assert found.filter("n = m").count() == 7 and rows.count() == 7


def test_scores_stay_while_words_are_forgotten(monkeypatch):
    net = toxicity.Network.fresh(0)
    texts = [" ".join(f"w{(7 * i + j) % 500}" for j in range(40)) for i in range(60)] + ["", None]
    whole = toxicity.Scorer(net).scores(texts)
    monkeypatch.setattr(toxicity, "MEMO", 90)
    monkeypatch.setattr(toxicity, "RUN", 2)
    scorer = toxicity.Scorer(net)
    assert np.allclose(scorer.scores(texts), whole, atol=1e-6)
    assert len(scorer.rows) <= 90 + 2 * 40 and len(scorer.table) <= 2 * (90 + 2 * 40)


def test_a_worker_keeps_no_words_when_byte_pairs_are_done(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string").coalesce(1)
    byte_pairs.encode_decode(docs, path).collect()

    def held(batches):
        for _ in batches:
            coder = byte_pairs._coder(path)
            yield pa.RecordBatch.from_arrays([pa.array([len(coder.words) + len(coder.chunks)])], ["n"])

    assert [r.n for r in spark.range(1).coalesce(1).mapInArrow(held, "n long").collect()] == [0]
