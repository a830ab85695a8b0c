"""The registered corpus queries against their SQL on the small driver table, and the pipeline against brute force."""

import os

import pytest

import corpus_pipeline
from scrimlens.llm import queries
from scrimlens.llm.toxicity import toxicity
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    result = con.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == sorted(result.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns = docs.columns
    toxic = {r.doc_id for r in toxicity(docs, labels).where("predicted = 1").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic)
    first = {}
    for i, t in rows:
        first.setdefault(t, i)
    rows = [(i, t) for i, t in rows if first[t] == i]
    near = brute.near_classes(rows)
    rows = [(i, t) for i, t in rows if near[i][1] == i]
    want = brute.repeats(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == columns, name
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == set(want)
    for i, t in rows:
        assert len(got[i].text.split()) == want[i][0] - want[i][1] and got[i].n_chars == len(got[i].text)
        if not want[i][1]:
            assert got[i].text == t
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {p.doc_id for p in pieces} == set(want)
