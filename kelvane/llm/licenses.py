"""Licence scan of files, in DataFrame functions only.

Notices (lines that speak of a licence) are compared with templates by sparse
TF-IDF cosine. A file with a notice has that licence; a licence file gives its
own to its directory, and files without one take that of the nearest directory
above them, found by joining paths.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvane.functions.once import computed_once
from kelvane.llm.common import picked, saved

# Short public notices by which licences are known.
TEMPLATES = (
    ("AGPL-3.0", "GNU Affero General Public License version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved"),
)
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"
NOTICE = r"(?i)licen[sc]|copyright|rights reserved|public domain|hereby granted|redistribution|\bcc[ -]by\b|\bcc0\b"
FILE_NAME = r"(?i)^(?:licen[sc]e|copying|notice|unlicense)(?:[.-].*)?$"
THRESHOLD = 0.7


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def _template_tokens() -> list[tuple[str, list[str]]]:
    return [(name, re.findall(TOKEN, text.lower())) for name, text in TEMPLATES]


def inverse_frequency(notices: DataFrame) -> dict[str, float]:
    """Weights of the templates' tokens, counted over all notices and templates.

    ``notices`` has one array of tokens a row. The table has one entry per token
    of the templates, whatever the size of the input.
    """
    templates = _template_tokens()
    known = sorted({t for _, words in templates for t in words})
    own = {t: sum(t in words for _, words in templates) for t in known}
    rows = notices.agg(F.count(F.lit(1))).first()[0] + len(templates)
    counted = notices.select(F.explode(F.array_distinct("tokens")).alias("token")).filter(
        F.col("token").isin(*known)).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()
    total = own | {r["token"]: own[r["token"]] + r["n"] for r in counted}
    return {t: _weight(rows, total[t]) for t in known} | {"": _weight(rows, 0)}


def _weight(rows: int, n: int) -> float:
    return math.log((1 + rows) / (1 + n)) + 1


def _scores(words: Column, idf: dict[str, float]) -> list[tuple[str, Column]]:
    """Cosine of a token array with each template; unknown tokens weigh as if in no row."""
    unknown = idf[""]
    table = F.create_map(*[F.lit(x) for t, w in idf.items() if t for x in (t, w)])
    tf = lambda x: F.size(F.filter(words, lambda y: y == x)).cast("double")
    pairs = F.transform(F.array_distinct(words), lambda x: F.struct(
        x.alias("t"), (tf(x) * F.coalesce(F.try_element_at(table, x), F.lit(unknown))).alias("w")))

    def against(entries: Column, words_of: list[str]) -> Column:
        weights = {t: words_of.count(t) * idf[t] for t in sorted(set(words_of))}
        length = sum(w * w for w in weights.values()) ** 0.5
        own = F.create_map(*[F.lit(x) for t, w in weights.items() for x in (t, w)])
        dot = F.aggregate(entries, F.lit(0.0), lambda a, e: a + e["w"] * F.coalesce(
            F.try_element_at(own, e["t"]), F.lit(0.0)))
        norm = F.sqrt(F.aggregate(entries, F.lit(0.0), lambda a, e: a + e["w"] * e["w"]))
        return F.when(norm > 0, dot / norm / length).otherwise(0.0)

    def scored(words_of: list[str]) -> Column:
        return F.transform(F.array(pairs), lambda entries: against(entries, words_of))[0]

    return [(name, scored(words_of)) for name, words_of in _template_tokens()]


def own_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``file_id, path, n_words, n_notices, license, score, covers`` of each row.

    ``covers``: share of the text's words that its best notice makes up.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.when(text.rlike(NOTICE), F.filter(F.split(text, "\n", -1), lambda x: x.rlike(NOTICE))).otherwise(
        F.array().cast("array<string>"))
    rows = saved(computed_once(
        files, ["file_id", "path"],
        notices=F.filter(F.transform(lines, tokens), lambda t: F.size(t) > 0),
        n_words=F.when(text.rlike(NOTICE), F.size(tokens(text))).otherwise(0)))
    idf = inverse_frequency(rows.select(F.explode("notices").alias("tokens")))
    best = lambda words: F.array_max(F.array(*[
        F.struct(F.round(score, 6).alias("score"), F.lit(-i).alias("order"), F.size(words).alias("size"))
        for i, (_, score) in enumerate(_scores(words, idf))]))
    rows = computed_once(rows, ["file_id", "path", "n_words", "notices"],
                         best=F.array_max(F.transform("notices", best)))
    names = F.array(*[F.lit(name) for name, _ in TEMPLATES])
    found = F.col("best")["score"] >= threshold
    return rows.select(
        "file_id", "path", F.size("notices").alias("n_notices"),
        F.when(found, F.get(names, -F.col("best")["order"])).alias("license"),
        F.when(found, F.col("best")["score"]).alias("score"),
        F.when(found, F.col("best")["size"] / F.col("n_words")).otherwise(0.0).alias("covers"))


def parent(path: Column) -> Column:
    """The directory of a path; the topmost one is the empty string."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
         threshold: float = THRESHOLD, whole: float = 0.5) -> DataFrame:
    """``doc_id, path, n_notices, own_license, score, license, inherited_from``.

    A licence file is named like one, or at least ``whole`` of its words are a
    notice; the best of a directory counts, by score, then the last by name.
    ``license`` is a file's own or else that of the nearest directory at or above
    its own; null if there is none. Null texts have no notice; a null path has no
    directory; repeated rows are each returned; an empty table gives no rows.
    Directories are resolved once each, so a directory with a third of all files
    is one row when paths are joined.
    """
    rows = saved(own_licenses(picked(files, file_id=id_col, path=path_col, text=text_col), threshold).withColumn(
        "dir", parent(F.col("path"))))
    is_file = F.regexp_extract("path", "[^/]*$", 0).rlike(FILE_NAME) | (F.col("covers") >= whole)
    given = rows.filter(F.col("license").isNotNull() & F.col("dir").isNotNull() & is_file).groupBy("dir").agg(
        F.max(F.struct("score", "license")).alias("best")).select(
        "dir", F.col("best")["license"].alias("given"))
    dirs = rows.filter(F.col("dir").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/", -1)
    above = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))))
    up = dirs.select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "ancestor"))
    nearest = up.join(given.withColumnRenamed("dir", "ancestor"), "ancestor").groupBy("dir").agg(
        F.max(F.struct("depth", "ancestor", "given")).alias("n")).select(
        "dir", F.col("n")["ancestor"].alias("source_dir"), F.col("n")["given"].alias("given"))
    joined = rows.join(nearest, "dir", "left")
    return joined.select(
        F.col("file_id").alias("doc_id"), "path", "n_notices", F.col("license").alias("own_license"), "score",
        F.coalesce("license", "given").alias("license"),
        F.when(F.col("license").isNull(), F.col("source_dir")).alias("inherited_from"))
