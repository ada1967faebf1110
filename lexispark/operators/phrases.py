"""Keyphrases (F15, W2, T4, P8, A6): RAKE (Rose et al. 2010) as a
relational job.

Per document: phrases are maximal runs of content tokens between
delimiters (stopwords or punctuation-only tokens).  freq(w) = occurrences
of w in phrases, deg(w) = sum of the lengths of the phrases holding each
occurrence, word score = deg/freq, phrase score = sum of its word scores.
Repeated phrases are kept.  Closed form: no co-occurrence pairs are ever
built.

Phase cutting is narrow: delimiters are replaced by a marker and the joined
token string is split on it.  The documents are hash-partitioned by id once;
the per-(doc, word) window, the per-phrase sum and the per-document rank
all reuse that partitioning, so the whole job has one shuffle.  Its number of
partitions is given: phrases take many times the memory of their texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import posexplode_rows
from ..functions.resources import STOPWORDS_EN

MARK = "\u0001"
MARK_SPLIT = r" ?\x01 ?"


def phrase_arrays(text, stopwords=STOPWORDS_EN):
    """Array of phrase strings (content words joined by one space)."""
    toks = T.rake_tokens(text)
    marked = F.transform(toks, lambda t: F.when(T.is_rake_delimiter(t, stopwords), F.lit(MARK)).otherwise(t))
    return F.filter(F.split(F.array_join(marked, " "), MARK_SPLIT, -1), lambda p: p != "")


def rake_phrases(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 keep: list[str] | None = None, stopwords=STOPWORDS_EN) -> DataFrame:
    """(id, *keep, rank, phrase, n_words, score): every phrase of every
    document, best first (score desc, phrase desc)."""
    keep = keep or []
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(id_col, *keep, text_col).repartition(parts, id_col)
    ph = posexplode_rows(docs, phrase_arrays(F.col(text_col), stopwords), "pidx", "phrase", id_col, *keep)
    ph = ph.withColumn("words", F.split("phrase", " ", -1)).withColumn("n_words", F.size("words").cast("long"))
    # the phrase itself goes with its first word only, so the exploded rows stay linear in the text
    words = posexplode_rows(ph, F.col("words"), "widx", "word", id_col, *keep, "pidx", "phrase", "n_words").withColumn(
        "phrase", F.when(F.col("widx") == 0, F.col("phrase")))
    ww = Window.partitionBy(id_col, "word")
    scored = words.withColumn("wscore", F.sum("n_words").over(ww) / F.count(F.lit(1)).over(ww))
    phrases = (scored.groupBy(id_col, *keep, "pidx", "n_words")
                     .agg(F.sum("wscore").alias("score"), F.max("phrase").alias("phrase")))
    wr = Window.partitionBy(id_col).orderBy(F.round("score", 9).desc(), F.col("phrase").desc())
    return phrases.select(id_col, *keep, F.row_number().over(wr).cast("long").alias("rank"),
                          "phrase", "n_words", "score")


def phrase_frequencies(phrases: DataFrame, min_words: int = 2,
                       by: list[str] | None = None) -> DataFrame:
    """A6 with P8: occurrences of phrases of at least ``min_words`` words."""
    by = by or []
    return (phrases.where(F.col("n_words") >= min_words)
                   .groupBy(*by, "phrase").agg(F.count(F.lit(1)).alias("freq")))
