import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from barloom.llm import mixing, queries, simhash
from tests.llm.cases import ROWS, documents

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in queries.queries()}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert {"pipeline", *queries.queries()} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_stages_on_awkward_documents(spark):
    docs = documents(spark)
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        following = stage(spark, docs, "").cache()
        assert following.columns == docs.columns, name
        counts.append(following.count())
        docs = following
    rejected = sum(1 for r in ROWS if not r[1] or not any(c.isalpha() for c in r[1]))
    assert counts[0] == len(ROWS) - rejected
    assert counts[1] <= counts[0] and counts[2] == counts[1]
    assert "hunter2" not in " ".join(r.text for r in docs.collect())


def test_stages_on_no_documents(spark):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_run_equals_its_stages_by_hand(spark):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    groups = simhash.simhash_groups(given.where("text rlike '[\\\\p{L}]'")).collect()
    first = {r.doc_id for r in groups if r.doc_id == r.component_id}
    kept = given.where(given.doc_id.isin(list(first)))
    got = sorted((r.doc_id, r.n_tokens > 0) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    clean = corpus_pipeline.mask_secrets(spark, kept, SF_DIR)
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(clean).collect()}
    assert got == sorted((i, True) for i, n in plan.items() for _ in range(n))
