"""The pipeline against a brute-force version of its stages, and the registered queries."""

import os
import re

import brute
import duckdb

import __spark_entry__ as contract
import corpus_pipeline
from mendtable.llm import common

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def test_pipeline_agrees_with_brute_force(spark, plain_docs):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    told = {r[0]: r for r in brute.languages([(i, t, langs[i]) for i, t in plain_docs])}
    rows = [(i, t) for i, t in plain_docs if told[i][2] != "und" and told[i][3] >= 0.5]
    kept = {r[0] for r in brute.exact_copies(rows) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    rows = [r for r, near in zip(rows, brute.near_copies(rows)) if near[0] == near[2]]
    clean = {r[0] for r in brute.overlaps(rows, items) if not r[5]}
    rows = [r for r in rows if r[0] in clean]
    mark = common.written()
    run = corpus_pipeline.run(spark, SF)
    assert common.written() == mark + 1 and len(run.inputFiles()) > 0
    found = {r.doc_id: r for r in run.collect()}
    path = common._written[-1]
    common.remove_written(spark, mark, last=True)
    assert common.written() == mark and not os.path.exists(path)
    assert set(found) == clean and len(clean) < len(plain_docs)
    for i, t in rows:
        assert found[i].decoded_sha256 == brute.sha(t) and found[i].n_tokens == len(found[i].ids)


def test_stages_keep_the_columns_of_documents(spark, docs_of, odd_texts):
    docs = docs_of(odd_texts)
    for given in (docs, docs.limit(0)):
        step = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            step = stage(spark, step, SF)
            assert step.columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, step, SF)
        assert (last.count() > 0) == (given is docs)
