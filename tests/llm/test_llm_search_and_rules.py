"""Exact search, host rules, personal data and licences against plain Python."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from kelvane.llm import host_quality, licenses, personal_data, vector_file

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_top_k(rows, is_query, k, scale=256):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
              if v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in usable if i is not None and is_query(i)}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), c is None, c or 0)
                        for c, b in usable if c != q and len(b) == len(a))
        out |= {(q, n + 1, None if none else c, -s) for n, (s, none, c) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_top_k_equals_brute_force(spark, block):
    rng = random.Random(block)
    draw = lambda: [rng.randint(-3, 3) / 4 + 0.125 for _ in range(5)]  # noqa: E731  ties abound
    rows = [(i, draw()) for i in range(60)] + [(100 + i, [0.5] * 5) for i in range(25)]
    rows += [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0]), (93, [float("nan")] * 5),
             (95, [float("inf")] * 5), (None, [0.875] * 5), (96, [1.0, 2.0]), (7, [0.375] * 5), (7, [0.375] * 5)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    found = vector_file.top_k(frame, F.col("vec_id") % 5 == 0, k=5, block=block).collect()
    assert len(found) == len(set(map(tuple, found)))
    assert set(map(tuple, found)) == brute_top_k(rows, lambda i: i % 5 == 0, 5)


def test_top_k_finds_the_twin_of_a_query_repeated_often(spark):
    twin = [0.5, 0.25, -1.0]
    rows = [(0, twin)] * 10 + [(7, twin)] * 2 + [(9, twin), (None, twin), (None, twin)]
    rows += [(i, [0.1 * i, 0.0, 0.0]) for i in range(20, 24)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {(r.query_id, r.rank): r.vec_id for r in vector_file.top_k(frame, F.col("vec_id") == 0, 4).collect()}
    assert found == {(0, 1): 7, (0, 2): 7, (0, 3): 9, (0, 4): None}


def test_top_k_of_nothing_and_of_little(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_file.top_k(empty, F.col("vec_id") % 5 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 0)], VECTORS).withColumn("q", F.lit(1))
    assert [tuple(r) for r in vector_file.top_k(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 131072)]


TEXTS = [
    None, "", " \t\n", "one", "a b c d e f g h " * 9, "x " * 30, "# * $ | < >\nline\nline\n\n \nline",
    " ".join(f"w{i}" for i in range(400)), "é ü\x0bß\x0c日本 z" * 5, "a b c d e f g h i a b c d e f g h",
    " ".join(random.Random(1).choice("ab") for _ in range(200)), "nbsp here\x1cone",
]


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_rules_equal_brute_force(spark):
    frame = spark.createDataFrame([(i, t, "h", 1, 2) for i, t in enumerate(TEXTS)],
                                  "doc_id bigint, text string, source string, words int, host int")
    rows = {r.doc_id: r for r in host_quality.judge(frame).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) \
            == brute_rules(text), repr(text)


def test_a_bad_host_takes_its_documents_and_a_small_one_is_shrunk(spark):
    good, bad = " ".join(f"w{i}" for i in range(40)), "# " * 40
    rows = [(i, good, "fine") for i in range(300)] + [(1000 + i, bad, "spam") for i in range(300)]
    rows += [(2000 + i, good, "spam") for i in range(30)] + [(3000, good + " # # # # #", "tiny"), (3001, good, None)]
    rows += [(4000 + h * 10 + i, good, f"other{h}") for h in range(20) for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.doc_id: r for r in host_quality.judge(frame).collect()}
    assert found[0].kept and found[3000].kept and found[3001].kept and found[4000].kept
    assert not found[2000].kept and not found[2000].base_failed and not found[2000].host_kept
    assert host_quality.judge(frame.limit(0)).count() == 0


PRIVATE = [
    None, "", "a@b.c d@e", "a@b.cd@e.f a@b.c_d@e.f x..y@z-1.co.uk.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255",
    "4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111-5", "+1 (654) 555-9716 +12 +1234567890123456",
    "日本 a@b.de \U0001F600 +49 30 1234567", "\x01a@b.c\x01 +1-2-3-4-5-6-7-8 ", "a" * 5000 + "@x " + "1" * 3000,
    "@" * 50 + "a@b.c." * 200, "call (654) 555-9716 now", 'password = "abc123def456abc7"',
    "mail me: joe [at] site [dot] org",
]


def brute_spans(text):
    def luhn(digits):
        worth = [int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
        return sum(worth) % 10 == 0

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[ -]", "", m)) <= 19
         and luhn(re.sub("[ -]", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m[0])]


def test_strict_spans_equal_the_plain_patterns(spark):
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(PRIVATE)],
                                  "doc_id bigint, text string, spans int")
    rows = {r.doc_id: r.spans for r in personal_data.find(frame).collect()}
    for i, text in enumerate(PRIVATE):
        assert [(s.kind, s.start, s.end) for s in rows[i] if s.base] == brute_spans(text), repr(text)
    proposed = {(s.kind, PRIVATE[i][s.start:s.end]) for i, spans in rows.items() for s in spans if not s.base}
    assert ("phone", "(654) 555-9716") in proposed and ("secret", 'password = "abc123def456abc7"') in proposed
    assert personal_data.find(frame.limit(0)).count() == 0


def test_redaction_keeps_the_rest(spark):
    text = "日 a@b.de +49 30 1234567, 1.2.3.4."
    frame = spark.createDataFrame([(1, text), (2, "plain"), (3, None)], "doc_id bigint, text string")
    marked = personal_data.with_spans(frame, "found")
    rows = marked.select("doc_id", personal_data.redacted(F.col("text"), F.col("found")).alias("t")).collect()
    assert {r.doc_id: r.t for r in rows} == {1: "日 <EMAIL> <PHONE>, <IP>.", 2: "plain", 3: None}


def test_digest_of_spans(spark):
    frame = spark.createDataFrame([(1, "a@b.de 1.2.3.4")], "doc_id bigint, text string")
    found = personal_data.find(frame).select(F.sha2(personal_data.written(F.col("spans")), 256).alias("d"))
    assert found.first().d == hashlib.sha256(b"email:0:6,ip:7:14").hexdigest()


def test_reliabilities_are_learned():
    """Labelers that agree with the hidden class are found more reliable."""
    rng, rows = random.Random(2), {}
    for _ in range(4000):
        true = rng.random() < 0.5
        votes = tuple(int(true) if rng.random() < right else int(not true) for right in (0.95, 0.9, 0.9, 0.85, 0.55))
        rows[votes] = rows.get(votes, 0) + 1
    patterns = [dict(zip(personal_data.LABELERS, v)) | {"k": 0, "size": 0, "n": n} for v, n in rows.items()]
    judged = personal_data.learn(patterns)
    gap = {name: yes - no for name, (no, yes) in judged.reliability.items()}
    assert gap["pattern"] > 0.7 and gap["valid"] > 0.6 and gap["edge"] < 0.3


FILES = [
    (1, "LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    (2, "src/a.py", "# Licensed under the Apache License, Version 2.0.\n" + "code " * 20), (3, "src/b.py", "print()"),
    (4, "lib/deep/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
    (5, "lib/deep/x/y.c", None), (6, "lib/z.c", ""), (7, "src/c.py", "the word licence alone says little of anything here"),
    (8, None, "nothing"), (9, "lib/deep/x/y.c", "All rights reserved."),
]


def test_licences_are_own_or_inherited(spark):
    frame = spark.createDataFrame([(*f, "x") for f in FILES], "doc_id int, path string, text string, dir string")
    rows = {r.doc_id: (r.own_license, r.license, r.inherited_from) for r in licenses.scan(frame).collect()}
    assert rows[2] == ("Apache-2.0", "Apache-2.0", None) and rows[1][1] == "MIT"
    assert rows[3] == (None, "MIT", "") and rows[6] == (None, "MIT", "")
    assert rows[5][1] is not None and rows[5][2] in ("lib/deep", "lib/deep/x")
    assert rows[7][:2] == (None, "MIT") and rows[8] == (None, None, None) and rows[9][0] == "Proprietary"
    assert licenses.scan(frame.limit(0)).count() == 0


def test_cosine_equals_brute_force(spark):
    line = "Licensed under the very Apache License, Version 2.0 and some"
    frame = spark.createDataFrame([(1, "a", line), (2, "b", "All rights reserved")], "doc_id int, path string, text string")
    found = licenses.scan(frame, threshold=0.0).filter("doc_id = 1").first()
    words = lambda t: re.findall(licenses.TOKEN, t.lower())
    units = [words(t) for _, t in licenses.TEMPLATES] + [words(line), words("All rights reserved")]
    known = {w for _, t in licenses.TEMPLATES for w in words(t)}
    idf = lambda w: math.log((1 + len(units)) / (1 + (sum(w in u for u in units) if w in known else 0))) + 1
    vec = lambda ws: {w: ws.count(w) * idf(w) for w in ws}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    a = vec(words(line))
    best = max((sum(a[w] * b.get(w, 0) for w in a) / norm(a) / norm(b), name)
               for name, t in licenses.TEMPLATES for b in [vec(words(t))])
    assert found.own_license == best[1] == "Apache-2.0" and found.score == round(best[0], 6)
