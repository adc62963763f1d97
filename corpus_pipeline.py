"""A corpus pipeline of five stages, each over all that the one before it kept.

Every stage but the last takes and returns rows with the columns of
``documents``; ``run`` writes each result as Parquet into the shared folder and
reads it again for the next.

In every stage null texts are empty and null ids are ids like others; further
columns stay, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvane.llm import byte_pairs, mixing, near_duplicates, personal_data, queries, toxicity
from kelvane.llm.common import prepare, table, unused
from kelvane.session import scratch_path


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the rest go.

    The network learns from the labelled documents among ``docs`` whose labels
    are not held out. Texts without words have one score for all; of rows
    repeated whole all stay or go; without labels of both classes every text has
    the same score.
    """
    prepare(spark)
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the smallest id.

    Texts that are null or empty are one class, other texts without words are
    alike only if equal. Of rows that tie in id and text one stays, also where
    they differ elsewhere; a document without id stays only where its class has
    no id.
    """
    prepare(spark)
    return near_duplicates.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each span of personal data replaced by its kind; ``n_chars`` follows.

    Documents without spans stay as they are, null and empty texts among them;
    rows repeated whole are changed alike.
    """
    prepare(spark)
    marked, spans = unused(docs, "marked"), unused(docs, "spans")
    found = personal_data.with_spans(docs, spans)
    rows = found.withColumn(marked, personal_data.redacted(F.col("text"), F.col(spans)))
    changed = F.size(spans) > 0
    return rows.withColumns({
        "n_chars": F.when(changed, F.length(marked).cast("long")).otherwise(F.col("n_chars")),
        "text": F.when(changed, F.col(marked)).otherwise(F.col("text"))}).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target shares of the languages ask for.

    The total grows until no language has to shrink: scarce languages repeat,
    and no document goes for its language's sake. Texts without words weigh
    nothing; rows that agree in id and text repeat equally often; without labels
    every document stays once.
    """
    prepare(spark)
    labels = table(spark, sf_dir, "labels")
    return mixing.resampled(docs, queries.labelled_languages(docs, labels), queries.LANGUAGES)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of identifiers and decoded text, for every row.

    Null and empty texts have no tokens; rows repeated whole are each returned.
    """
    prepare(spark)
    coded = byte_pairs.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), ids_as="binary")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean_of_toxicity),
    ("near_duplicates", one_of_near_duplicates),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
    ("byte_pairs", encoded),
]

# The stages train models, sample and solve; no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results are passed on as Parquet."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
