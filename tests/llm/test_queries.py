"""The registered queries, and the pipeline."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import connection, spark_result, sql_result
from riskstream.llm.queries import ORACLE, QUERIES
from riskstream.session import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert spark_result(QUERIES[name](spark, SF_DIR)) == sql_result(connection(SF_DIR), ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op4_decontamination", "op8_nearest", "op10_url_filter", "op13_hard_negatives"}))
def test_a_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id")
    found = stored(QUERIES[name](spark, SF_DIR), "test")
    assert found.count() == docs.count() and found.select("doc_id").exceptAll(docs).isEmpty()


def test_url_filter_needs_no_python(spark):
    plan = QUERIES["op10_url_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def through(spark, docs, sf_dir=SF_DIR):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
        out.append(docs)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    *filtered, last = through(spark, docs)
    for after in filtered:
        assert after.schema.simpleString() == docs.schema.simpleString()
        assert after.select("doc_id").subtract(before.select("doc_id")).isEmpty() and after.count() <= before.count()
        before = after
    assert last.select("doc_id").exceptAll(before.select("doc_id")).isEmpty() and last.count() == before.count() > 100
    texts = before.select("doc_id", F.sha2("text", 256).alias("sha"))
    assert last.join(texts, "doc_id").where("sha <> decoded_sha256").isEmpty(), "encoding is undone by decoding"
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert whole.exceptAll(last).isEmpty() and last.exceptAll(whole).isEmpty()


def test_planted_cases(spark):
    """What each stage must catch, next to documents it must leave alone."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(60)
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").limit(2).collect()]

    def clean(n, words=70):  # no two of its words repeat a passage of another
        return " ".join(hashlib.md5(f"{n} {i}".encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))[: 3 + i % 5] for i in range(words))

    passage = clean("shared", 60)
    planted = [(9000 + n, clean(n)) for n in range(8)]
    near = planted[0][1].split()
    near[30] = "changed"
    planted += [(9100, planted[0][1]), (9101, " ".join(near)), (9102, None), (9103, "12 34 !!"), (9104, f"{clean(50)} {passage} {clean(51)}"), (9105, f"{clean(52)} {passage} {clean(53)}"),
                (9106, f"{clean(54)} {items[0]} {clean(55)}"), (9107, passage), (9000, planted[0][1])]
    extra = spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in planted], docs.schema)
    language, near, passages, benchmark, encoded = ({r.doc_id: r for r in df.collect()} for df in through(spark, docs.unionByName(extra)))
    assert {9102, 9103}.isdisjoint(language) and {9001, 9100, 9106} <= language.keys()
    assert {9100, 9101}.isdisjoint(near) and 9000 in near and {9001, 9104, 9105, 9106} <= near.keys()
    assert passages[9104].text == f"{clean(50)} {clean(51)}" and passages[9105].text == f"{clean(52)} {clean(53)}"
    assert passages[9104].n_chars == len(passages[9104].text) and 9107 not in passages
    assert [passages[9000 + n].text for n in range(8)] == [t for _, t in planted[:8]], "clean texts stay as they are"
    assert 9106 in passages and 9106 not in benchmark and {9000, 9104, 9105} <= benchmark.keys() == encoded.keys()


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    assert [df.count() for df in through(spark, docs)] == [0] * 5
