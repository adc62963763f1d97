"""The pipeline's stages over the smallest tables, one after the other."""

import hashlib
import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kelvane.llm.common import saved
from kelvane.llm import byte_pairs, near_duplicates, personal_data, queries, toxicity

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = found[name] = spark.read.parquet(path)
    return found


def test_columns_and_order(stages):
    names = list(stages)
    assert names == ["", "toxicity", "near_duplicates", "personal_data", "mixing", "byte_pairs"]
    for name in names[:-1]:
        assert stages[name].dtypes == stages[""].dtypes, name


def test_toxic_documents_go_and_the_rest_stays(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = {r.doc_id: r.predicted for r in toxicity.classify(stages[""], labels).collect()}
    assert {r.doc_id for r in stages["toxicity"].collect()} == {i for i, p in judged.items() if not p}


def test_one_document_of_each_class_stays(stages):
    classes = {r.doc_id: r.class_id for r in near_duplicates.classes(stages["toxicity"]).collect()}
    assert sorted(r.doc_id for r in stages["near_duplicates"].collect()) == sorted(set(classes.values()))


def test_no_personal_data_is_left(stages):
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    after = stages["personal_data"].collect()
    assert {r.doc_id for r in after} == set(before)
    assert all(r.n_chars == len(r.text) for r in after if r.text != before[r.doc_id].text)
    left = personal_data.find(stages["personal_data"]).filter(F.exists("spans", lambda x: x["base"]))
    assert left.count() == 0 and any(r.text != before[r.doc_id].text for r in after)


def test_mixing_keeps_every_document(stages):
    before, after = ({r.doc_id for r in stages[n].collect()} for n in ("personal_data", "mixing"))
    assert after == before
    assert stages["mixing"].count() >= stages["personal_data"].count()


def test_codes_are_those_of_the_texts(stages):
    coder = byte_pairs.WordBytePairs(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in stages["mixing"].collect()}
    rows = stages["byte_pairs"].collect()
    assert len(rows) == stages["mixing"].count()
    for r in rows:
        packed, decoded = coder.encode(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_queries_are_registered(spark):
    import __spark_entry__ as contract
    names = set(contract.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    from compare import database, differences
    assert differences(queries.QUERIES[name](spark, FOLDER), database(FOLDER), queries.SQL[name]) is None


def test_native_queries_run_no_python(spark):
    for name in ("op3_licenses", "op6_personal_data", "op7_quality_rules", "op12_exact_copies"):
        plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_documents_pass_through_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0, name


def test_odd_documents_pass_through_every_stage(spark):
    """Nulls, empty and very long texts, repeated rows, extra columns with the operators' own names."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    long = " ".join(f"word{i % 700}" for i in range(6_000))
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, None, None, "s", None), (-3, " \n\t", "en", None, 3),
         (-4, long, "en", "s", len(long)), (-5, "twin words of a text", "en", "s", 20), (-5, "twin words of a text", "en", "s", 20),
         (None, "no id here", "fr", "s", 10), (-6, "write to a.b@example.com now", "en", "s", 28)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    rows = docs.select(*odd.columns).union(odd)
    for name in ("score", "node", "spans", "rate", "row", "hash", "marked", "m", "n_tokens"):
        rows = rows.withColumn(name, F.lit(f"own {name}"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, rows = rows, saved(stage(spark, rows, FOLDER))
        kept[name] = rows.collect()
        if name != "byte_pairs":
            assert rows.dtypes == before.dtypes, name
            assert all(r.score == "own score" and r.m == "own m" for r in kept[name])
    ids = lambda name: [r.doc_id for r in kept[name]]
    assert ids("toxicity").count(-5) == 2 and {-1, -2, -3, -4, -6, None} <= set(ids("toxicity"))
    # Null and empty texts are alike; so is the one of white space to itself alone.
    assert ids("near_duplicates").count(-5) == 1 and sorted(i for i in ids("near_duplicates") if i in (-1, -2)) == [-2]
    assert {-3, -4, None} <= set(ids("near_duplicates"))
    texts = {r.doc_id: (r.text, r.n_chars) for r in kept["personal_data"]}
    assert texts[-6] == ("write to <EMAIL> now", 20) and texts[-4] == (long, len(long)) and texts[-2] == (None, None)
    assert set(ids("mixing")) == set(ids("personal_data")) == set(ids("near_duplicates"))
    assert len(kept["byte_pairs"]) == len(kept["mixing"]) and {r.n_tokens for r in kept["byte_pairs"] if r.doc_id == -2} == {0}
