"""Stored text models (S6 with M2, M3, M6): the tables that scoring needs,
kept as a version (``store``), and scoring of documents that no fit has seen.

A model's features are its lemma table and its IDF; a naive Bayes model adds
its class-term counts and class constants, an LSA model its term numbers and
the blocks of its vectors.  All of them are tables joined by term, so neither
a vocabulary nor a vector goes through the driver.

Defined results: words the model doesn't know are left out; a document without
a known word gets the class with the largest prior (NB) or no row (LSA)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settled
from . import bayes, features, models, terms
from .store import load_version, save_version


def fit_nb(train: DataFrame, lemmas: DataFrame, path: str, label_col: str = "label", text_col: str = "text",
           id_col: str = "doc_id", tokens_col: str | None = None) -> int:
    """Fits TF-IDF and naive Bayes on ``train`` and commits the model under
    ``path``; returns its version.  Rows without a label only count in the IDF.
    ``tokens_col``: texts that ``terms.normalized_texts`` has tokenised already."""
    spark = train.sparkSession
    docs = settled(terms.normalize_terms(train, text_col, id_col, keep=[label_col], lemmas=lemmas, tokens_col=tokens_col)
                   .withColumnRenamed(label_col, "label"), "terms")
    w, idf, n = features.tfidf_fit_transform(docs, F.lit(True), id_col=id_col, keep=["label"])
    size = idf.count()
    counts, classes = bayes.fit(w.select(id_col, "label", "term", "weight"), docs.select(id_col, "label"), size, id_col)
    return save_version(spark, path, {"lemmas": lemmas, "idf": idf, "class_terms": counts.select("label", "term", "cnt"),
                                      "classes": classes}, {"kind": "nb", "n_train": n, "n_terms": size})


def fit_lsa(train: DataFrame, lemmas: DataFrame, path: str, k: int, text_col: str = "text", id_col: str = "doc_id") -> int:
    """Fits TF-IDF and LSA and commits the model; returns its version."""
    spark = train.sparkSession
    docs = settled(terms.normalize_terms(train, text_col, id_col, lemmas=lemmas), "terms")
    w, idf, n = features.tfidf_fit_transform(docs, F.lit(True), id_col=id_col)
    numbers = settled(models.term_numbers(idf), "numbers")
    s, v = models.lsa(w.join(numbers, "term").select(id_col, "tid", "weight"), k, id_col)
    return save_version(spark, path, {"lemmas": lemmas, "idf": idf, "numbers": numbers, "vectors": v},
                        {"kind": "lsa", "n_train": n, "singular_values": [float(x) for x in s]})


def weigh(docs: DataFrame, tables: dict, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, term, tf, weight) of documents by a stored model's features."""
    t = terms.normalize_terms(docs, text_col, id_col, lemmas=tables["lemmas"])
    tf = features.term_counts(features.doc_terms(t, id_col=id_col), id_col)
    return features.tfidf(tf, tables["idf"], id_col)


def _load(spark: SparkSession, path: str, version: int | None, kind: str):
    tables, info = load_version(spark, path, version)
    if info.get("kind") != kind:
        raise ValueError(f"{path} holds a model of kind {info.get('kind')}, not {kind}")
    return tables, info


def score_nb(docs: DataFrame, path: str, version: int | None = None, text_col: str = "text",
             id_col: str = "doc_id") -> DataFrame:
    """(id, scores, pred) of every document by a stored model."""
    tables, _ = _load(docs.sparkSession, path, version, "nb")
    w = settled(weigh(docs, tables, text_col, id_col), "weights")
    return bayes.predict(w, docs.select(id_col), tables["class_terms"], tables["classes"], id_col)


def project_lsa(docs: DataFrame, path: str, version: int | None = None, text_col: str = "text",
                id_col: str = "doc_id") -> DataFrame:
    """(id, lsa) of every document with a known word by a stored model."""
    tables, info = _load(docs.sparkSession, path, version, "lsa")
    x = weigh(docs, tables, text_col, id_col).join(tables["numbers"], "term").select(id_col, "tid", "weight")
    return models.lsa_project(x, tables["vectors"], len(info["singular_values"]), id_col)
