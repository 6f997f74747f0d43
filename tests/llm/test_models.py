"""The trained operators: held-out accuracy, folds and odd rows."""

import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from mendtable.llm import language, toxicity

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_language_on_held_out_documents(spark, documents):
    rows = contract.queries()["op4_language_id"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(documents)
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == documents[r.doc_id].lang for r in held]) > 0.97


def test_language_never_sees_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "xx").otherwise(F.col("lang")))
    one, two = ({tuple(r) for r in language.languages(d).collect()} for d in (docs, hidden))
    assert one == two


def test_language_of_odd_rows(docs_of, odd_texts):
    rows = odd_texts + [(30, "1234 !!"), (31, "é")]
    found = {r.doc_id: r for r in language.languages(docs_of(rows)).collect()}
    assert len(found) == len({i for i, _ in rows})
    assert {found[i].lang_pred for i in (1, 2, 3, 30)} == {"und"} and found[30].score == 0
    assert found[31].lang_pred == "en" and found[None].held_out is False


def test_language_without_training_rows(docs_of, odd_texts):
    docs = docs_of(odd_texts).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.languages(docs).collect()} == {"und"}
    assert language.languages(docs.limit(0)).count() == 0


def test_language_agrees_with_second_version(spark, docs_of, odd_texts):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows = rows[:120] + [(None, None, "en"), (7000, "", None), (7001, "12 34", "en"), (7002, rows[0][1], None), (None, rows[1][1], "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for given in (docs, docs.withColumn("lang", F.lit("one")), docs.withColumn("lang", F.lit(None).cast("string"))):
        read = [tuple(r) for r in given.collect()]
        want = brute.languages(read)
        got = language.languages(given).collect()
        key = lambda r: (repr(r[0]), r[2], round(r[3], 6))
        assert len(got) == len(want)
        for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
            assert g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-6


def test_ties_go_to_the_smaller_name(spark):
    ids = [i for i in range(40) if remainder(i, 3) != 1][:6]
    rows = [(i, "same words here", lang) for i, lang in zip(ids, ("b", "a", "c") * 2)]
    found = language.languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert {r.lang_pred for r in found} == {"a"}


def test_columns_of_the_same_names_are_replaced(docs_of, odd_texts):
    docs = docs_of(odd_texts).withColumns({"held_out": F.lit(3), "lang_pred": F.lit("x"), "score": F.lit("y")})
    found = language.with_language(docs)
    assert sorted(found.columns) == sorted(docs.columns)
    assert {r.lang_pred for r in found.select("lang_pred").collect()} <= {"en", "und"}


def test_documents_in_wanted_languages(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) > 200").withColumn("row_", F.lit(1))
    total = docs.count()
    kept, rejected = language.in_languages(docs, ["fr", "de"])
    assert kept.columns == docs.columns
    langs = [r.lang for r in kept.select("lang").collect()]
    assert np.mean([x in ("fr", "de") for x in langs]) > 0.99
    assert sum(r.rejected for r in rejected.collect()) == total - len(langs)
    assert language.drop_unknown(docs).count() > 0.99 * total
    assert language.drop_unknown(docs, least=1.1).count() == 0


def test_nothing_is_rejected_where_nothing_was_learned(spark, docs_of, odd_texts):
    rows = odd_texts + [(40, "1234 !!")]
    docs = docs_of(rows).withColumn("lang", F.lit(None).cast("string"))
    kept = language.drop_unknown(docs, ["en"])
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in rows)
    assert language.drop_unknown(docs.limit(0)).count() == 0


def test_mixture_finds_the_languages_of_a_mixed_text():
    # two languages that share no words, a third that fits nothing well
    logs = np.log(np.array([[0.9, 0.05, 0.05]] * 60 + [[0.05, 0.9, 0.05]] * 40))
    share = language.mixtures(logs.T, np.zeros(100, int), np.ones(100))
    assert share[2, 0] == 0 and abs(share[0, 0] - 0.6) < 0.05
    share = language.mixtures(logs[:60].T, np.zeros(60, int), np.ones(60))
    assert share[:, 0].tolist() == [1, 0, 0]


def test_unknown_documents_are_rejected(docs_of, odd_texts):
    docs = docs_of(odd_texts + [(30, "1234")])
    kept = language.drop_unknown(docs)
    assert kept.columns == docs.columns
    assert {1, 2, 3, 30}.isdisjoint(r.doc_id for r in kept.collect()) and kept.count() == len(odd_texts) - 3


def test_toxicity_on_held_out_documents(spark):
    rows = {r.doc_id: r for r in contract.queries()["op3_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    assert all(r.held_out == (remainder(i, 4) == 2) and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [(rows[x.doc_id].predicted, x.toxic) for x in labels if rows[x.doc_id].held_out]
    hit = sum(p and t for p, t in held)
    assert hit / sum(t for _, t in held) > 0.85 and hit / sum(p for p, _ in held) > 0.85


def test_toxicity_never_sees_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({tuple(r) for r in toxicity.toxicity(docs, x).collect()} for x in (labels, turned))
    assert one == two


def test_toxicity_of_odd_rows(spark, docs_of, odd_texts):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, None), (None, 1), (99, 1), (8, 3)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity(docs_of(odd_texts), labels).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.toxicity(docs_of(odd_texts), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.toxicity(docs_of([]), labels).count() == 0
