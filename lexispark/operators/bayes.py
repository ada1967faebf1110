"""Multinomial naive Bayes on TF-IDF triples.

theta(c,t) = (sum_{d in c} w(d,t) + alpha) / (sum_{d in c, t} w + alpha*|V|)
score(d,c) = ln(n_c/n) + sum_t w(d,t) ln theta(c,t)

The score splits into a class constant, a per-document total weight and a
sum over the terms the document shares with class c:
  score = ln(n_c/n) - W_d ln(T_c + |V|) + sum_t w(d,t) ln(cnt_c(t) + 1)
(alpha = 1, so terms absent from class c add ln 1 = 0).  Scoring is one
equi-join on term and one aggregate per document; the class constants are one
row with an array a class, and there is no document x class product.  Rows
without a label are not trained on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled
from .metrics import argmax


def fit(train_w: DataFrame, labels: DataFrame, vocab_size: int, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Returns (class_terms(label, term, cnt, log_theta), classes(label, n_c,
    tot, log_prior, log_denom)).

    ``train_w`` is (id, label, term, weight); ``labels`` is (id, label) over
    every training document, also those without in-vocabulary terms (they
    still count in the prior).  Rows with a null label are left out."""
    ct = settled(train_w.where(F.col("label").isNotNull()).groupBy("label", "term").agg(F.sum("weight").alias("cnt")), "class_terms")
    tot = ct.groupBy("label").agg(F.sum("cnt").alias("tot"))
    per = labels.where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n_c"))
    n = F.lit(float(labels.where(F.col("label").isNotNull()).count()))
    classes = per.join(tot, "label", "left").select(
        "label", "n_c", F.coalesce("tot", F.lit(0.0)).alias("tot"), F.log(F.col("n_c") / n).alias("log_prior"),
        F.log(F.coalesce("tot", F.lit(0.0)) + F.lit(float(vocab_size))).alias("log_denom")).checkpoint()
    ct = ct.join(classes.select("label", "log_denom"), "label").select(
        "label", "term", "cnt", (F.log(F.col("cnt") + 1.0) - F.col("log_denom")).alias("log_theta"))
    return ct, classes


def predict(weights: DataFrame, docs: DataFrame, class_terms: DataFrame, classes: DataFrame,
            id_col: str = "doc_id") -> DataFrame:
    """(id, scores, pred) for every row of ``docs`` (id column only needed);
    ``scores`` is in label order, ``pred`` the label of the best (the lowest
    on ties)."""
    rows = classes.orderBy("label").collect()  # one row a class
    per_term = class_terms.groupBy("term").agg(F.collect_list(F.struct("label", F.log(F.col("cnt") + 1.0).alias("v"))).alias("vs"))
    j = weights.select(id_col, "term", "weight").join(per_term, "term", "left")
    total = weights.groupBy(id_col).agg(F.sum("weight").alias("W"))
    shared = (j.select(id_col, "weight", F.explode("vs").alias("x"))
              .groupBy(id_col, "x.label").agg(F.sum(F.col("weight") * F.col("x.v")).alias("s"))
              .groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("label", "s"))).alias("m")))
    d = docs.select(id_col).join(total, id_col, "left").join(shared, id_col, "left")
    consts = F.array(*[F.struct(F.lit(r["label"]).alias("c"), F.lit(r["log_prior"]).alias("p"),
                                F.lit(r["log_denom"]).alias("q")) for r in rows])
    w = F.coalesce("W", F.lit(0.0))
    scores = F.transform(consts, lambda c: c["p"] + F.coalesce(F.try_element_at("m", c["c"]), F.lit(0.0)) - w * c["q"])
    label = F.get(F.array(*[F.lit(r["label"]) for r in rows]), argmax(F.col("scores")))
    return d.select(id_col, scores.alias("scores")).withColumn("pred", label)
