"""Quality rules with host verdicts, in DataFrame functions only.

Every document gets its rule counts; failures are summed per host, each host's
failure rates are shrunk towards a beta prior fitted to all hosts, and a host
whose shrunk rate passes ``host_limit`` takes its documents with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvane.functions.once import computed_once
from kelvane.llm.common import picked, saved

WINDOW = 8
SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
RULES = ("short", "repeated", "symbols", "lines")
# Documents that the prior weighs as many as: below some ten of its own a host
# cannot be rejected.
MIN_STRENGTH, MAX_STRENGTH = 10.0, 10_000.0


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use`` as a lambda variable."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(hashes: Column) -> Column:
    """Words lying in windows whose hash occurs more than once in the array."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    places = _let(placed, lambda s: F.sort_array(F.transform(
        F.filter(s, lambda v, j: (v["h"] == F.get(s, j - 1)["h"]) | (v["h"] == F.get(s, j + 1)["h"])),
        lambda v: v["p"])))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n"),
                              (p + WINDOW).alias("end")),
        lambda a: a["n"])
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(0)


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source") -> DataFrame:
    """Counts per document: one row for each row of ``docs``, no shuffle.

    Columns ``doc_id, host, n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words``. A null text has no words. Windows are
    compared by a 64-bit hash of their eight words.
    """
    rows = picked(docs, doc_id=id_col, text=text_col, host=host_col).withColumn(
        "text", F.coalesce("text", F.lit("")))
    text = F.col("text")
    with_word = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    rows = computed_once(
        rows, ["doc_id", "host"],
        words=F.array_remove(F.split(text, SPACE), ""),
        word_chars=F.length(_without(text, " \t\n\x0b\x0c\r")).cast("long"),
        n_symbols=(F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"),
        line_counts=_let(with_word, lambda lines: F.struct(
            F.size(lines).cast("long").alias("n"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"))))
    windows = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - WINDOW + 1, F.lit(1))),
        lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    keep = ["doc_id", "host", "word_chars", "n_symbols", "line_counts"]
    rows = computed_once(rows, keep, n_words=F.size("words").cast("long"), hashes=windows)
    return rows.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols",
        F.col("line_counts")["n"].alias("n_lines"), F.col("line_counts")["dup"].alias("n_dup_lines"),
        _repeated_words(F.col("hashes")).cast("long").alias("n_repeat_words"))


def failures() -> dict[str, Column]:
    """The document rules, each true where a document fails it."""
    return {
        "short": F.col("n_words") < 20,
        "repeated": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }


def _prior(mean: float, spread: float, hosts: int, rows: int) -> tuple[float, float]:
    """Beta parameters with the hosts' mean and their variance beyond chance."""
    noise = mean * (1 - mean) * hosts / rows
    between = spread - noise
    strength = MAX_STRENGTH if between <= 0 else mean * (1 - mean) / between - 1
    strength = min(max(strength, MIN_STRENGTH), MAX_STRENGTH)
    return mean * strength, (1 - mean) * strength


def host_verdicts(counts: DataFrame, host_limit: float = 0.5) -> DataFrame:
    """One row per host: documents, shrunk failure rate per rule, ``host_kept``.

    Rows without a host belong to none. The prior is one row of sums over all
    hosts; counts are combined before the shuffle, so a host with a third of all
    rows is one row per task.
    """
    hosts = saved(counts.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"),
        *[F.sum(failed.cast("long")).alias(rule) for rule, failed in failures().items()]))
    totals = hosts.agg(F.sum("docs").alias("rows"), F.count(F.lit(1)).alias("hosts"),
                       *[F.sum(rule).alias(rule) for rule in RULES]).first()
    rates: list[Column] = []
    if totals["hosts"]:
        means = {rule: totals[rule] / totals["rows"] for rule in RULES}
        spreads = hosts.agg(*[
            (F.sum(F.col("docs") * F.pow(F.col(rule) / F.col("docs") - means[rule], 2))
             / totals["rows"]).alias(rule) for rule in RULES]).first()
        for rule in RULES:
            a, b = _prior(means[rule], spreads[rule], totals["hosts"], totals["rows"])
            rates.append(((F.col(rule) + a) / (F.col("docs") + a + b)).alias(f"{rule}_rate"))
    else:
        rates = [F.lit(0.0).alias(f"{rule}_rate") for rule in RULES]
    shrunk = hosts.select("host", "docs", *rates)
    worst = F.greatest(*[F.col(f"{rule}_rate") for rule in RULES])
    return shrunk.withColumn("host_kept", worst <= host_limit)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", host_limit: float = 0.5) -> DataFrame:
    """Rule counts of every document, ``base_failed``, ``host_kept`` and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated
    8-word windows. ``kept``: not ``base_failed`` and the host is kept.
    Null or empty texts have no words and fail; a null host is never rejected;
    a null id stays as it is; repeated rows each count and are each returned; an
    empty table gives no rows.
    """
    counts = saved(rule_counts(docs, id_col, text_col, host_col))
    verdicts = host_verdicts(counts, host_limit).select("host", "host_kept")
    failed = failures()["short"] | failures()["repeated"]
    return counts.join(verdicts, "host", "left").select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"),
        F.coalesce("host_kept", F.lit(True)).alias("host_kept")).withColumn(
        "kept", ~F.col("base_failed") & F.col("host_kept"))
