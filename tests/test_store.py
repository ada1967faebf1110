"""Versioned tables and stored text models."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lexispark.operators import features, store, terms, textmodel
from lexispark.plans import jobs
from lexispark.session import scratch_path


def test_versions_are_read_only_once_committed(spark):
    path = scratch_path(spark, "store")
    assert store.versions(spark, path) == []
    with pytest.raises(ValueError):
        store.load_version(spark, path)
    one = spark.range(3).withColumn("x", F.col("id") * 1.5)
    assert store.save_version(spark, path, {"a": one, "b": spark.range(2)}, {"n": 1}) == 0
    one.write.parquet(f"{path}/data/1-half/a")  # a writer that died before its commit
    tables, info = store.load_version(spark, path)
    assert info == {"n": 1} and sorted(tables) == ["a", "b"] and tables["a"].count() == 3 and tables["a"].dtypes == one.dtypes
    assert store.save_version(spark, path, {"a": one.limit(0)}) == 1
    assert store.versions(spark, path) == [0, 1]
    assert store.load_version(spark, path)[0]["a"].count() == 0
    assert store.load_version(spark, path, 0)[1] == {"n": 1}
    store.save_version(spark, path, {"a": spark.range(9)}, version=1)  # a second attempt at a version replaces it
    assert store.load_version(spark, path, 1)[0]["a"].count() == 9


def test_a_failed_fit_commits_nothing(spark):
    path = scratch_path(spark, "store")
    bad = spark.range(3).select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception):
        store.save_version(spark, path, {"good": spark.range(2), "bad": bad})
    assert store.versions(spark, path) == []


def test_stored_nb_scores_unseen_documents(spark):
    path = scratch_path(spark, "nb")
    train = spark.createDataFrame([(1, "red apple pie", 0), (2, "green apple tart", 0), (3, "fast car engine", 1),
                                   (4, "car wheel", 1), (5, "car boat", 1), (6, "a boat", None), (7, None, 0)],
                                  "doc_id long, text string, label int")
    assert textmodel.fit_nb(train, terms.corpus_lemmas(train), path) == 0
    new = spark.createDataFrame([(10, "an apple"), (11, "cars and wheels"), (12, "zebra"), (13, None), (None, "tart pie")],
                                "doc_id long, text string")
    got = {r["doc_id"]: (r["pred"], list(r["scores"])) for r in textmodel.score_nb(new, path).collect()}
    assert got[10][0] == 0 and got[11][0] == 1
    assert got[12] == got[13] and got[12][0] in (0, 1)  # no known word: the larger prior
    with pytest.raises(ValueError):
        textmodel.project_lsa(new, path)


def test_stored_lsa_projects_as_the_fit_does(spark):
    docs = jobs.documents(spark, SF_SMALL, ("doc_id", "text")).where("doc_id < 120").checkpoint()
    train, path = docs.where("doc_id % 3 > 0"), scratch_path(spark, "lsa")
    lemmas = terms.corpus_lemmas(train)
    textmodel.fit_lsa(train, lemmas, path, 5)
    got = {r["doc_id"]: np.abs(r["lsa"]) for r in textmodel.project_lsa(docs.where("doc_id % 3 = 0"), path).collect()}
    t = terms.normalize_terms(train, lemmas=lemmas)
    w, idf, _ = features.tfidf_fit_transform(t, F.lit(True))
    cols = {r["term"]: i for i, r in enumerate(idf.select("term").collect())}
    rows = {r["doc_id"]: i for i, r in enumerate(train.select("doc_id").collect())}
    x = np.zeros((len(rows), len(cols)))
    for r in w.collect():
        x[rows[r["doc_id"]], cols[r["term"]]] = r["weight"]
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    tf = features.term_counts(features.doc_terms(terms.normalize_terms(docs.where("doc_id % 3 = 0"), lemmas=lemmas)))
    new = {}
    for r in features.tfidf(tf, idf).collect():
        new.setdefault(r["doc_id"], np.zeros(len(cols)))[cols[r["term"]]] = r["weight"]
    assert sorted(got) == sorted(new)
    for k, v in new.items():
        assert np.allclose(np.abs(vt[:5] @ v), got[k], atol=1e-6)
