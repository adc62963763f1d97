"""The registered queries of the operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvane.llm import (
    byte_pairs, exact_copies, hard_negatives, host_quality, licenses, mixing, near_duplicates, personal_data,
    prefix_trie, pseudo_likelihood, token_counts, toxicity, vector_file,
)
from kelvane.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_near_duplicates(spark, folder):
    """The near-duplicate class of every document."""
    return near_duplicates.classes(table(spark, folder, "documents"))


@_query
def op2_pseudo_likelihood(spark, folder):
    """Log-likelihood of every document under a network trained on all of them."""
    return pseudo_likelihood.score_corpus(table(spark, folder, "documents"))


def document_paths(spark, folder) -> DataFrame:
    """Documents as files: source and language are their directories."""
    docs = table(spark, folder, "documents")
    part = lambda c: F.coalesce(F.col(c), F.lit("_"))
    return docs.withColumn("path", F.concat_ws("/", part("source"), part("lang"), F.col("doc_id").cast("string")))


@_query
def op3_licenses(spark, folder):
    """Licence of every document, its own or that of the nearest directory."""
    return licenses.scan(document_paths(spark, folder))


_NOTICE_TEMPLATES = ", ".join(
    f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(licenses.TEMPLATES))

SQL["op3_licenses"] = rf"""
WITH files AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    coalesce(source, '_') || '/' || coalesce(lang, '_') AS dir,
    concat_ws('/', coalesce(source, '_'), coalesce(lang, '_'), CAST(doc_id AS VARCHAR)) AS path
  FROM documents
), lines AS (
  SELECT k, unnest(string_split(text, chr(10))) AS line FROM files
), notices AS (
  SELECT row_number() OVER () AS u, k, tok FROM (
    SELECT k, regexp_extract_all(lower(line), '{licenses.TOKEN}') AS tok FROM lines
    WHERE regexp_matches(line, '{licenses.NOTICE}')) WHERE len(tok) > 0
), templates AS (
  SELECT ord, name, regexp_extract_all(lower(text), '{licenses.TOKEN}') AS tok
  FROM (VALUES {_NOTICE_TEMPLATES}) AS t(ord, name, text)
), units AS (SELECT tok FROM notices UNION ALL SELECT tok FROM templates),
total AS (SELECT count(*) AS n FROM units),
known AS (SELECT DISTINCT unnest(tok) AS t FROM templates),
idf AS (
  SELECT t, ln((1 + (SELECT n FROM total)) / (1 + count(*))) + 1 AS w
  FROM (SELECT unnest(list_distinct(tok)) AS t FROM units) JOIN known USING (t) GROUP BY t
), notice_weights AS (
  SELECT u, x.t, tf * coalesce(w, ln(1 + (SELECT n FROM total)) + 1) AS w FROM (
    SELECT u, t, count(*) AS tf FROM (SELECT u, unnest(tok) AS t FROM notices) GROUP BY u, t) x
  LEFT JOIN idf ON x.t = idf.t
), template_weights AS (
  SELECT ord, x.t, tf * w AS w FROM (
    SELECT ord, t, count(*) AS tf FROM (SELECT ord, unnest(tok) AS t FROM templates) GROUP BY ord, t) x
  JOIN idf ON x.t = idf.t
), cosines AS (
  SELECT u, ord, round(sum(a.w * b.w) / any_value(norm_u) / any_value(norm_t), 6) AS score
  FROM notice_weights a JOIN template_weights b ON a.t = b.t
  JOIN (SELECT u, sqrt(sum(w * w)) AS norm_u FROM notice_weights GROUP BY u) USING (u)
  JOIN (SELECT ord, sqrt(sum(w * w)) AS norm_t FROM template_weights GROUP BY ord) USING (ord)
  GROUP BY u, ord
), best AS (
  SELECT k, name, score, size FROM (
    SELECT n.k, t.name, c.score, len(n.tok) AS size,
      row_number() OVER (PARTITION BY n.k ORDER BY c.score DESC, c.ord, len(n.tok) DESC) AS r
    FROM cosines c JOIN notices n USING (u) JOIN templates t USING (ord)) WHERE r = 1 AND score >= {licenses.THRESHOLD}
), own AS (
  SELECT f.k, f.doc_id, f.path, f.dir, b.name, b.score,
    coalesce(b.size / len(regexp_extract_all(lower(f.text), '{licenses.TOKEN}')), 0) AS covers
  FROM files f LEFT JOIN best b ON f.k = b.k
), given AS (
  SELECT dir, name FROM (
    SELECT dir, name, row_number() OVER (PARTITION BY dir ORDER BY score DESC, name DESC) AS r
    FROM own WHERE name IS NOT NULL AND covers >= 0.5) WHERE r = 1
), nearest AS (
  SELECT dir, source_dir, name AS given FROM (
    SELECT d.dir, g.dir AS source_dir, g.name,
      row_number() OVER (PARTITION BY d.dir ORDER BY length(g.dir) DESC) AS r
    FROM (SELECT DISTINCT dir FROM own) d JOIN given g ON d.dir = g.dir OR starts_with(d.dir, g.dir || '/')) WHERE r = 1
)
SELECT o.doc_id, o.path, CAST(coalesce(c.n, 0) AS INTEGER) AS n_notices, o.name AS own_license, o.score,
  coalesce(o.name, n.given) AS license, CASE WHEN o.name IS NULL THEN n.source_dir END AS inherited_from
FROM own o LEFT JOIN nearest n ON o.dir = n.dir
LEFT JOIN (SELECT k, count(*) AS n FROM notices GROUP BY k) c ON o.k = c.k
"""


# Shares of tokens that the languages shall have.
LANGUAGES = {"de": 0.2, "en": 0.5, "es": 0.15, "fr": 0.15}


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The language of the labelled documents of good quality."""
    good = labels.filter("quality = 1").select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(good, "doc_id", "left_semi")


@_query
def op4_mixing(spark, folder):
    """Rate of every document for the target shares of the languages."""
    docs = table(spark, folder, "documents")
    return mixing.mix(docs, labelled_languages(docs, table(spark, folder, "labels")), LANGUAGES)


@_query
def op5_exact_top_k(spark, folder):
    """The 5 best other rows by inner product, for every vec_id divisible by 50."""
    return vector_file.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0).select(
        "query_id", "rank", "vec_id", "score")


SQL["op5_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


@_query
def op6_personal_data(spark, folder):
    """Spans of personal data in every document: counts and digest of the strict ones, and all."""
    found = personal_data.find(table(spark, folder, "documents"))
    strict = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(strict, lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in personal_data.STRICT],
        F.sha2(personal_data.written(strict), 256).alias("base_sha256"),
        personal_data.written(F.col("spans")).alias("spans"))


@_query
def op7_quality_rules(spark, folder):
    """Rule counts and verdict of every document, with its source as the host."""
    return host_quality.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_kept")


_SPREAD = """sum(docs * pow({r} / docs - (SELECT sum({r}) / sum(docs) FROM hosts), 2)) / sum(docs)"""


def _prior_sql(rule: str) -> str:
    return f"""(SELECT m, CASE WHEN v - noise <= 0 THEN 10000.0
      ELSE least(greatest(m * (1 - m) / (v - noise) - 1, 10.0), 10000.0) END AS s FROM (
      SELECT sum({rule}) / sum(docs) AS m, {_SPREAD.format(r=rule)} AS v,
        sum({rule}) / sum(docs) * (1 - sum({rule}) / sum(docs)) * count(*) / sum(docs) AS noise FROM hosts))"""


SQL["op7_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(string_split(translate(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '),
      lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '') AS lines
  FROM d
), windows AS (
  SELECT k, p, array_to_string(words[p:p + 7], ' ') AS win
  FROM (SELECT k, words, unnest(range(1, len(words) - 6)) AS p FROM w WHERE len(words) >= 8)
), twice AS (
  SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT p + o) AS n FROM twice, (SELECT unnest(range(0, 8)) AS o) GROUP BY k
), counts AS (
  SELECT w.k, doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered c ON w.k = c.k
), failed AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeated,
    10 * n_symbols > n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS many_lines FROM counts
), hosts AS (
  SELECT host, CAST(count(*) AS DOUBLE) AS docs, CAST(count(*) FILTER (short) AS DOUBLE) AS short,
    CAST(count(*) FILTER (repeated) AS DOUBLE) AS repeated, CAST(count(*) FILTER (symbols) AS DOUBLE) AS symbols,
    CAST(count(*) FILTER (many_lines) AS DOUBLE) AS many_lines
  FROM failed WHERE host IS NOT NULL GROUP BY host
), verdicts AS (
  SELECT host, """ + " AND ".join(
    f"({rule} + {rule}_p.m * {rule}_p.s) / (docs + {rule}_p.s) <= 0.5"
    for rule in ("short", "repeated", "symbols", "many_lines")) + """ AS host_kept
  FROM hosts""" + "".join(f", {_prior_sql(rule)} AS {rule}_p"
                          for rule in ("short", "repeated", "symbols", "many_lines")) + """
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  short OR repeated AS base_failed,
  NOT (short OR repeated) AND coalesce(host_kept, true) AS kept, coalesce(host_kept, true) AS host_kept
FROM failed f LEFT JOIN verdicts v ON f.host = v.host
"""


@_query
def op8_token_counts(spark, folder):
    """Token counts of every document in the piece vocabulary."""
    return token_counts.count_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op9_toxicity(spark, folder):
    """Toxicity score of every document, learned from the labelled ones that are not held out."""
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query
def op10_byte_pairs(spark, folder):
    """Identifiers and decoded text of every document, as digests."""
    coded = byte_pairs.encode_decode(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids_as="binary")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op11_prefix_trie(spark, folder):
    """Every prefix that rebuilt conversations share, with counts over what lies below it."""
    return prefix_trie.trie(table(spark, folder, "conversations")).drop("turn_digest")


# Decimal c as bytes, each followed by eight shifts (-1), folded into its crc32.
_CUT = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
  string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 6"""

SQL["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, h, least(h, coalesce((SELECT count(*) FROM t WHERE t.conv_id = x.conv_id - x.conv_id % 100), 0)) AS k
  FROM (SELECT DISTINCT conv_id, CAST({_CUT} AS BIGINT) AS h FROM t) x
), turns AS (
  SELECT c.conv_id, t.p AS d, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.p <= c.k
  UNION ALL
  SELECT c.conv_id, c.k + t.p - c.h, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.p > c.h
), runs AS (
  SELECT conv_id, d, text, list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d) AS run
  FROM turns
), members AS (
  SELECT conv_id, d, length(text) AS chars, md5(array_to_string(run, '')) AS node,
    CASE WHEN d = 1 THEN '' ELSE md5(array_to_string(run[1:d - 1], '')) END AS parent,
    d = max(d) OVER (PARTITION BY conv_id) AS ended FROM runs
  UNION ALL
  SELECT conv_id, 0, 0, '', NULL, NOT EXISTS (SELECT 1 FROM turns WHERE turns.conv_id = c.conv_id) FROM c
), nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM members GROUP BY node, d
), children AS (SELECT parent AS node, d - 1 AS d, count(*) AS n FROM nodes GROUP BY ALL),
above AS (
  SELECT m.node AS low, m.d AS low_d, a.node, a.d
  FROM (SELECT node, d, conv_id FROM nodes) m JOIN members a ON a.conv_id = m.conv_id AND a.d <= m.d
), sums AS (
  SELECT above.node, above.d, count(*) FILTER (children.n IS NULL) AS n_leaves,
    CAST(sum((low.n_convs - 1) * low.chars) AS BIGINT) AS saved_tokens
  FROM above JOIN nodes low ON low.node = above.low AND low.d = above.low_d
  LEFT JOIN children ON children.node = above.low AND children.d = above.low_d
  GROUP BY above.node, above.d
)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
  n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums USING (node, d) LEFT JOIN children USING (node, d)
LEFT JOIN nodes up ON up.node = nodes.parent AND up.d = nodes.d - 1
"""


@_query
def op12_exact_copies(spark, folder):
    """The row that stays of every document's equals, which differ in white space at most."""
    return exact_copies.mark(table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL["op12_exact_copies"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST, k)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""


@_query
def op13_hard_negatives(spark, folder):
    """Negatives just below the positives of every vec_id divisible by 100, with labels shifted on every seventh row."""
    vectors = table(spark, folder, "embeddings")
    shifted = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                                 .otherwise(F.col("label")))
    return hard_negatives.mine(shifted, F.col("vec_id") % 100 == 0)


SQL["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.e) = len(c.e)
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5
), r AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS n
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM r WHERE n <= 5
"""
