import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seedloom.llm.oracles import ORACLES
from seedloom.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_one_query_for_each_operator():
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted(f"op{n}" for n in range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_keep_columns_and_clean_documents(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame(
        [(10_001, None, "en", "s", 0), (10_002, "123 ...", "en", "s", 7), (10_003, "call 372-555-7739 the then", None, None, None)],
        docs.schema,
    )
    docs = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before and len(ids) > 0.6 * len(before), name
        if name == "language-id":
            assert before - ids == {10_001, 10_002}
        path_rows = after.collect()
        docs = spark.createDataFrame(path_rows, after.schema)
    left = {r.doc_id: r.text for r in docs.collect()}
    assert 10_003 in left and "372-555-7739" not in left[10_003]


def test_near_duplicates_with_repeated_and_null_ids(spark):
    one, clean, other = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    rows = [
        (1, one), (2, one + " more"), (2, clean), (3, other), (3, other), (None, other), (None, one),
        (4, "alone with words"), (4, "alone with words"), (None, "nameless words"), (None, "nameless words"), (7, ""), (8, None),
    ]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], table(spark, SF, "documents").schema)
    left = corpus_pipeline.near_duplicates(spark, frame.repartition(3), SF)
    assert left.columns == frame.columns
    want = [(1, one), (2, clean), (3, other), (4, "alone with words"), (None, "nameless words"), (7, ""), (8, None)]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(want, key=repr)


def test_language_stage_decides_by_score_and_fills_in(spark):
    docs = table(spark, SF, "documents")
    odd = [(20_001, "ZQX 88 WVZQ 0x", None, "s", 1), (20_002, docs.filter("lang IS NOT NULL").first().text, None, "s", 1)]
    left = corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(odd, docs.schema)), SF)
    langs = {r.doc_id: r.lang for r in left.filter("doc_id > 20000").collect()}
    assert langs[20_002] is not None
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, SF).count() == docs.count()


def test_decontamination_with_null_and_shared_ids(spark):
    passage = table(spark, SF, "benchmark").orderBy(F.length("text").desc()).first().text
    clean = " ".join(f"clean{k}" for k in range(60))
    rows = [(None, passage), (5, clean + " " + passage), (5, clean), (5, clean), (None, clean), (6, None), (7, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], table(spark, SF, "documents").schema)
    left = corpus_pipeline.decontamination(spark, frame, SF)
    assert left.columns == frame.columns
    want = [(5, clean), (5, clean), (None, clean), (6, None), (7, "")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(want, key=repr)


def test_personal_data_without_counts(spark):
    frame = spark.createDataFrame([(1, "call 372-555-7739"), (1, None)], "doc_id long, text string")
    left = corpus_pipeline.personal_data(spark, frame, SF)
    assert left.columns == frame.columns and left.count() == 2


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(rows[0].asDict())


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
