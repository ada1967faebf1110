"""Corpus cleaning (F1-F7, P4, P5) and its audit (F16).

All steps are column expressions; the job is one narrow stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

STEPS = ("translit", "lower", "contractions", "urls", "letter_runs", "parens", "stopwords")


def clean_corpus(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 url_mode: str = "greedy", keep: list[str] | None = None) -> DataFrame:
    """Cleaned, non-empty documents: (id, clean_text, *keep)."""
    keep = keep or []
    out = T.apply_steps(df.select(id_col, *keep, text_col), text_col, "clean_text",
                        T.clean_steps(url_mode), once=True).drop(text_col)
    return out.where(F.col("clean_text").isNotNull() & (F.col("clean_text") != ""))


def rejected_docs(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                  url_mode: str = "greedy") -> DataFrame:
    """P5 second output: documents dropped by cleaning and why."""
    base = df.select(id_col, F.col(text_col).isNull().alias("_null"), text_col)
    return (T.apply_steps(base, text_col, "_c", T.clean_steps(url_mode), once=True)
              .where(F.col("_null") | (F.col("_c") == ""))
              .select(id_col, F.when(F.col("_null"), "null").otherwise("empty").alias("reason")))


def cleaning_audit(df: DataFrame, class_col: str, text_col: str = "text",
                   url_mode: str = "greedy") -> DataFrame:
    """Per class: documents, non-ASCII documents, documents changed by each
    step, and documents emptied.  Steps are materialised one projection
    after another so each is evaluated once."""
    staged = df.select(F.col(class_col).alias("class"), F.col(text_col).cast("string").alias("s0"))
    fns = [T.transliterate, F.lower, T.expand_contractions,
           lambda c: T.remove_urls(c, url_mode), T.squeeze_letter_runs,
           T.drop_parentheses, T.drop_stopwords_single_space]
    for i, fn in enumerate(fns, start=1):
        staged = staged.withColumn(f"s{i}", fn(F.col(f"s{i - 1}")))
    aggs = [F.count(F.lit(1)).alias("n_docs"),
            F.count_if(F.octet_length("s0") > F.length("s0")).alias("n_non_ascii")]
    for i, name in enumerate(STEPS, start=1):
        aggs.append(F.count_if(F.col(f"s{i}") != F.col(f"s{i - 1}")).alias(f"n_{name}"))
    aggs.append(F.count_if(F.col("s7").isNull() | (F.col("s7") == "")).alias("n_rejected"))
    return staged.groupBy("class").agg(*aggs)
