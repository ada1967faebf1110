"""Sentence ranking by a similarity graph.

The sentences of a document are nodes, their similarity is the cosine of their
TF-IDF vectors, and a sentence's rank is its weight in the stationary
distribution of a random walk with restarts over that graph.  The graph is
never built: with A the sentences' unit vectors, a step of the walk is
A (A^T y) without the diagonal, two sums over the (sentence, term) postings, so
a document costs a step as much as it has postings, and sentences meet through
shared terms only.

Documents are dealt to blocks by a hash; a task iterates the documents of its
block together until every rank changes by less than ``tol``.  Postings are
written by blocks (``features.packed_counts``), as numbers beside the block's
terms, and stay there: what moves to the vocabulary and back is a block's
distinct terms.

Defined results: documents without a word have no sentence here (and an empty
summary); a sentence that shares no term with another one has the restart's
share alone; rows without an id, or with a repeated one, are documents of
their own, told apart by their text (equal rows share their sentences' ranks
and are returned each); of equal ranks the earlier sentence counts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import settled
from . import features
from .summary import SENTENCE, sentences

DAMPING = 0.85
POSTINGS = 2_000_000  # of a block, at most about
CHARS = 6  # of a text that a posting stands for, about


def walk(sentence: np.ndarray, term: np.ndarray, weight: np.ndarray, doc: np.ndarray, damping: float = DAMPING,
         tol: float = 1e-9, most: int = 500) -> np.ndarray:
    """Ranks of the sentences 0.. of postings (sentence, term, unit weight);
    ``term`` is numbered within its document, ``doc`` is each sentence's
    document."""
    n, terms = len(doc), int(term.max()) + 1 if len(term) else 0
    own = np.bincount(sentence, weight * weight, n)
    degree = np.bincount(sentence, weight * np.bincount(term, weight, terms)[term], n) - own
    linked = degree > 1e-12
    restart = (1 - damping) / np.bincount(doc)[doc]
    rank = 1.0 / np.bincount(doc)[doc]
    for _ in range(most):
        y = np.where(linked, rank / np.where(linked, degree, 1), 0.0)
        new = restart + damping * (np.bincount(sentence, weight * np.bincount(term, weight * y[sentence], terms)[term], n) - own * y)
        done = np.abs(new - rank).max(initial=0) < tol
        rank = new
        if done:
            break
    return rank


def sentence_ranks(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", damping: float = DAMPING,
                   tol: float = 1e-9) -> DataFrame:
    """(_doc, sidx, rank, n_tokens) of each sentence with a word; ``_doc`` is
    a struct of id and text hash."""
    keyed = df.where(F.col(text_col).isNotNull()).select(document_key(id_col, text_col).alias("_doc"), text_col)
    n_docs, chars = keyed.agg(F.countDistinct("_doc"), F.sum(F.length(text_col))).first()
    parts = max(features.block_count(df.sparkSession), -(-(chars or 0) // (CHARS * POSTINGS)))
    # the texts move once: counts and a term's documents are found where the document is
    docs = keyed.withColumn("b", features.block_of("_doc", parts).cast("int")).repartitionById(parts, "b").dropDuplicates(["b", "_doc"])
    docs = docs.withColumn("dn", F.monotonically_increasing_id())
    sents = T.apply_steps(sentences(docs, text_col, "_doc", "b", "dn"), "sentence", "text",
                          [F.lower, T.remove_punctuation, T.split_merged_text, T.blanks])
    rows = sents.select("b", "dn", "_doc.id", "_doc.h1", "_doc.h2", "sidx", F.lit(True).alias("all"), "text")
    counts = features.packed_counts(rows, ["dn", "id", "h1", "h2", "sidx", "all"], 1, once=True)
    counts = settled(counts.withColumn("dn", F.col("docs.dn")), "postings")  # fixes the numbers
    blocks = features.known_terms(counts.drop("dn"), features.fit_block_idf(counts, n_docs), idf="double")

    def rank(batches):
        import pyarrow as pa
        for t in batches:
            for k in range(t.num_rows):
                docs, ends, c, tf, idf = (t.column(x)[k].values for x in ("docs", "ends", "c", "tf", "idf"))
                ends, c, tf, idf = (x.to_numpy() for x in (ends, c, tf, idf))
                many = np.diff(np.r_[0, ends])
                at = np.flatnonzero(many)  # sentences with a word
                s = np.repeat(np.arange(len(at)), many[at])
                _, doc = np.unique(docs.field("dn").to_numpy()[at], return_inverse=True)
                _, term = np.unique(doc[s].astype(np.int64) * max(1, len(idf)) + c, return_inverse=True)
                w = tf * idf[c]
                norm = np.sqrt(np.bincount(s, w * w, len(at)))
                r = walk(s, term, w / norm[s], doc, damping, tol)
                own = [docs.field(x).take(pa.array(at)) for x in ("id", "h1", "h2", "sidx")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(r), pa.array(np.bincount(s, tf, len(at)).astype(np.int64))],
                                                 names=["id", "h1", "h2", "sidx", "rank", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    ranks = blocks.select("docs", "ends", "c", "tf", "idf").mapInArrow(rank, f"id {kind}, h1 long, h2 long, sidx int, rank double, n_tokens long")
    return settled(ranks, "ranks").select(F.struct("id", "h1", "h2").alias("_doc"), "sidx", "rank", "n_tokens")


def document_key(id_col: str, text_col: str):
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.lit(1), text_col).alias("h1"), F.xxhash64(F.lit(2), text_col).alias("h2"))


def ranked_summary(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", top: int = 2, min_tokens: int = 5,
                   max_words: int = 60) -> DataFrame:
    """(id, sentences, summary) of every row: its ``top`` sentences by rank
    (those of ``min_tokens`` words first), in the text's order, cut to
    ``max_words``."""
    order = Window.partitionBy("_doc").orderBy((F.col("n_tokens") >= min_tokens).desc(), F.round("rank", 9).desc(), "sidx")
    best = (sentence_ranks(df, text_col, id_col).withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= top)
            .groupBy("_doc").agg(F.sort_array(F.collect_list("sidx")).alias("s")))
    out = df.select(id_col, text_col, document_key(id_col, text_col).alias("_doc")).join(best, "_doc", "left")
    parts = F.regexp_extract_all(F.col(text_col), F.lit(SENTENCE), 0)
    chosen = F.transform("s", lambda i: T.strip_ws(F.get(F.col("_parts"), i)))
    words = F.slice(T.split_ws(F.array_join("_chosen", " ")), 1, max_words)
    out = out.withColumn("_parts", parts).withColumn("_chosen", chosen)
    return out.select(id_col, F.coalesce("s", F.array().cast("array<int>")).alias("sentences"),
                      F.coalesce(F.array_join(words, " "), F.lit("")).alias("summary"))
