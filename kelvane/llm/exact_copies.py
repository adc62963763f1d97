"""Exact duplicates, with frequent texts split off before the shuffle.

Texts are equal when they agree after all white space is deleted; a digest of
what is left stands for them. A Misra-Gries summary names every digest that
holds more than one row in ``counters``, along with some that hold fewer. Of
those candidates the exact counts and the row that stays are worked out with
map-side combining, and the ones that are frequent indeed are broadcast: their
copies are marked where they lie. What is left has no group larger than a task's
fair share and is shuffled by digest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvane.llm.common import picked, saved, unused

# Fixed by the contract: what does not count when texts are compared.
SPACES = "\t\n\x0b\x0c\r "
# Counters of the summary: at most so many digests are broadcast, 32 bytes and a
# few numbers each, whatever the input.
COUNTERS = 2000


def without_spaces(text: Column) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), SPACES, text)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, digest, length`` of every row, kept: texts are read once.

    ``row`` numbers the rows, so that rows repeated whole stay apart.
    """
    text = F.coalesce("text", F.lit(""))
    rows = picked(docs, doc_id=id_col, text=text_col)
    return saved(rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.unhex(F.sha2(without_spaces(text), 256)).alias("digest"), F.length(text).alias("length")))


def frequent(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``digest, winner, group_size`` of the digests in more than 1 of ``counters`` rows.

    The summary may name digests that are not frequent; none that is can be
    missing. Its at most ``counters`` candidates are counted exactly.
    """
    named = rows.freqItems(["digest"], 1.0 / counters)
    candidates = named.select(F.explode("digest_freqItems").alias("digest"))
    counted = rows.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(
        _winner().alias("winner"), F.count(F.lit(1)).alias("group_size"))
    return saved(counted.filter(F.col("group_size") * counters > rows.count()))


def _winner() -> Column:
    """The longest original, then the smallest id, then the first of equal rows."""
    return F.min(F.struct((-F.col("length")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"),
                          "doc_id", "row"))


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         counters: int = COUNTERS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for every row of ``docs``.

    Of equal texts the row with the most code points stays, then the smallest
    id; of rows that tie in both, one. Null texts are empty, and all texts
    without a visible character are equal. Null ids rank behind others, so
    ``keep_id`` is null only where no row of the group has an id. Other columns
    are ignored; an empty table gives no rows.
    """
    rows = digests(docs, id_col, text_col)
    heavy = frequent(rows, counters)
    marked = rows.join(F.broadcast(heavy), "digest").select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"), "digest")
    same = Window.partitionBy("digest")
    first = F.row_number().over(same.orderBy(
        F.col("length").desc(), F.col("doc_id").asc_nulls_last(), "row"))
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").withColumns({
        "place": first, "group_size": F.count(F.lit(1)).over(same)})
    # The winner comes first in its group, so its id is the first value.
    rest = rest.withColumn("keep_id", F.first("doc_id").over(same.orderBy("place")))
    return marked.union(rest.select("doc_id", "keep_id", "group_size", (F.col("place") == 1).alias("kept"), "digest"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that agree in id and text count as one; for nulls and ties see ``mark``.
    """
    digest, key = unused(docs, "digest"), unused(docs, "key")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    kept = mark(docs, id_col, text_col, counters).filter("kept").select(
        F.col("digest").alias(digest), F.col("doc_id").alias(key))
    rows = docs.withColumn(digest, F.unhex(F.sha2(without_spaces(text), 256)))
    stay = rows.join(kept, (rows[digest] == kept[digest]) & rows[f"`{id_col}`"].eqNullSafe(kept[key]), "left_semi")
    # Rows of one id that differ in white space, or not at all, are left: the longest stays.
    order = Window.partitionBy(digest).orderBy(F.length(text).desc())
    place = unused(docs, "place")
    return stay.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).drop(place, digest)
