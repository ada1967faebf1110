"""Extractive summary (N5, re-aimed from an abstractive model).

Sentences are scored by the mean IDF of their word tokens; the summary is
the best sentence with at least ``min_tokens`` tokens (any sentence if none
has that many), cut to its first ``max_words`` words.  IDF is computed over
the whole corpus with the same smooth formula as TF-IDF."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import posexplode_rows
from ..session import settled
from . import features

SENTENCE = r"[^.!?\n]+[.!?]*"


def sentences(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", *keep: str) -> DataFrame:
    """(id, *keep, sidx, sentence) with blank pieces dropped (sidx keeps text order)."""
    s = posexplode_rows(df, F.regexp_extract_all(F.col(text_col), F.lit(SENTENCE), 0), "sidx", "sentence", id_col, *keep)
    return s.withColumn("sentence", T.strip_ws("sentence")).where(F.col("sentence") != "")


def extractive_summary(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                       min_tokens: int = 5, max_words: int = 30) -> DataFrame:
    """One row a document; one without a word token has an empty summary.

    The text is tokenised once, to counts by blocks of documents
    (``features.packed_counts``), which are written; document frequencies and
    scores come from them, and the winning sentence is cut from its text by its
    number at the end.  What meets the IDF is a block's distinct terms."""
    sents = T.apply_steps(sentences(df, text_col, id_col), "sentence", "text",
                          [F.lower, T.remove_punctuation, T.split_merged_text, T.blanks])  # split_ws without its list
    parts = features.block_count(df.sparkSession)
    rows = sents.select(features.block_of(id_col, parts).cast("int").alias("b"), F.col(id_col).alias("id"), "sidx", F.lit(True).alias("all"), "text")
    counts = settled(features.packed_counts(rows.repartitionById(parts, "b"), ["id", "sidx", "all"], 1, once=True), "sentence_counts")
    n_docs = df.select(id_col).distinct().count()
    blocks = features.known_terms(counts, features.fit_block_idf(counts, n_docs), idf="double")

    def scores(batches):
        import pyarrow as pa
        for t in batches:
            for k in range(t.num_rows):
                docs, ends, c, tf, idf = (t.column(x)[k].values for x in ("docs", "ends", "c", "tf", "idf"))
                ends, c, tf, idf = (x.to_numpy() for x in (ends, c, tf, idf))
                doc = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
                n = np.bincount(doc, tf, len(ends)).astype(np.int64)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([*[docs.field(x).take(pa.array(at)) for x in ("id", "sidx")],
                                                  pa.array(np.bincount(doc, tf * idf[c], len(ends))[at] / n[at]), pa.array(n[at])],
                                                 names=["id", "sidx", "score", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    scored = blocks.select("docs", "ends", "c", "tf", "idf").mapInArrow(scores, f"id {kind}, sidx int, score double, n_tokens long")
    best = scored.groupBy(F.col("id").alias("_id")).agg(F.max(F.struct(
        (F.col("n_tokens") >= min_tokens).alias("enough"), F.round("score", 9).alias("rounded"), (-F.col("sidx")).alias("back"),
        "score", "n_tokens")).alias("b"))
    out = df.select(id_col, text_col).join(best, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    sidx = -F.col("b.back")
    sentence = T.strip_ws(F.get(F.regexp_extract_all(F.col(text_col), F.lit(SENTENCE), 0), sidx))
    words = F.slice(T.split_ws(sentence), 1, max_words)
    return out.select(id_col, sidx.cast("long").alias("sentence_index"),
                      F.coalesce(F.array_join(words, " "), F.lit("")).alias("summary"),
                      F.round("b.score", 6).alias("score"),
                      F.coalesce("b.n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
