"""Token tables, stopword anti join, corpus lemma table and term
normalisation (P9, J2, J6, F9-F14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import explode_rows, posexplode_rows
from ..functions.resources import STOPWORDS_EN
from ..session import settled

# fixed values: noun suffix rules of the lemmatiser, in this order
LEMMA_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def explode_tokens(df: DataFrame, tokens, id_col: str = "doc_id",
                   keep: list[str] | None = None, outer: bool = False) -> DataFrame:
    """(id, *keep, pos, token): the exploded form of a token array (0-based
    pos).  ``outer`` keeps documents without tokens as one null row."""
    keep = keep or []
    out = posexplode_rows(df, tokens, "pos", "token", id_col, *keep, keep_empty=outer)
    return out.withColumn("pos", F.col("pos").cast("long"))


def stopword_table(spark: SparkSession, stopwords=STOPWORDS_EN) -> DataFrame:
    return spark.createDataFrame([(w,) for w in stopwords], "token string")


def stopword_filter(tokens: DataFrame, stopwords=STOPWORDS_EN) -> DataFrame:
    """Left anti join against the fixed stopword table.  The table is a
    literal of known size, so broadcasting it is safe at any data scale."""
    stop = F.broadcast(stopword_table(tokens.sparkSession, stopwords))
    return tokens.join(stop, "token", "left_anti")


def _candidates(term):
    """Rule outputs of a term as an array of (ord, cand); rules that do not
    apply give null and are filtered out."""
    cands = [F.when(term.endswith(old), F.struct(F.lit(i).alias("ord"),
                    F.concat(F.expr(f"substring(term, 1, length(term) - {len(old)})"),
                             F.lit(new)).alias("cand")))
             for i, (old, new) in enumerate(LEMMA_RULES)]
    return F.filter(F.array(*cands), lambda x: x.isNotNull())


def lemma_table(vocab: DataFrame) -> DataFrame:
    """(term, lemma) for every vocabulary term that one suffix rule maps
    onto another vocabulary term; shortest candidate wins, then rule order.

    The join is vocabulary against vocabulary (distinct terms, not the token
    stream), so it stays small relative to the corpus."""
    vocab = vocab.select(F.col("token").alias("term")).distinct()
    cands = (explode_rows(vocab, _candidates(F.col("term")), "c", "term")
                  .select("term", "c.ord", "c.cand"))
    hits = cands.join(vocab.select(F.col("term").alias("cand")), "cand", "left_semi")
    best = hits.groupBy("term").agg(F.min(F.struct(F.length("cand"), "ord", "cand")).alias("b"))
    return best.select("term", F.col("b.cand").alias("lemma"))


def normalized_token_table(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                           outer: bool = False, keep: list[str] | None = None) -> DataFrame:
    """(id, *keep, pos, token) after lower, punctuation, stem, tokenise, stopwords."""
    keep = keep or []
    staged = T.apply_steps(df.select(id_col, *keep, text_col), text_col, "_toks", T.normalized_steps())
    return explode_tokens(staged, F.col("_toks"), id_col, keep=keep, outer=outer)


def normalized_texts(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """(id, *keep, tokens): the tokens after the steps of ``normalize_terms``
    but for the lemmas, written (``settled``) as one string a document: tokens
    hold no blank, and a list costs as much to write as to tokenise."""
    keep = keep or []
    base = T.apply_steps(df.select(id_col, *keep, text_col), text_col, "_toks", T.normalized_steps())
    return settled(base.select(id_col, *keep, F.array_join("_toks", " ").alias("tokens")), "tokens")


def _listed(tokens):
    return F.array_remove(F.split(tokens, " "), "")  # no token: an empty list


def corpus_lemmas(df: DataFrame, text_col: str = "text", tokens_col: str | None = None) -> DataFrame:
    """(term, lemma) of the words of ``df`` after the steps of
    ``normalize_terms``, or of the column ``tokens_col`` of ``normalized_texts``."""
    if tokens_col:
        return lemma_table(explode_rows(df, _listed(F.col(tokens_col)), "token"))
    staged = T.apply_steps(df.select(text_col), text_col, "_toks", T.normalized_steps())
    return lemma_table(explode_rows(staged, F.col("_toks"), "token"))


def normalize_terms(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", lemmatise: bool = True,
                    keep: list[str] | None = None, lemmas: DataFrame | None = None, tokens_col: str | None = None) -> DataFrame:
    """(id, *keep, terms) with the corpus lemma table applied, or
    ``lemmas`` (term, lemma) where another corpus gave them.

    The texts are tokenised once (``normalized_texts``), or were before
    (``tokens_col``).  Only a document's distinct tokens meet the lemma table,
    which is written first, so that a small one is broadcast by its size and
    the tokens stay where they are; the few that it changes come back as a map
    of the document, to its one string.  Documents whose token list is empty
    have an empty string, null texts stay null."""
    keep = keep or []
    if not lemmatise:
        base = T.apply_steps(df.select(id_col, *keep, text_col), text_col, "_toks", T.normalized_steps())
        return base.select(id_col, *keep, F.array_join("_toks", " ").alias("terms"))
    if tokens_col:
        base = df.select(id_col, *keep, F.col(tokens_col).alias("tokens"))
    else:
        base = normalized_texts(df, text_col, id_col, keep)
    lem = settled(corpus_lemmas(base, tokens_col="tokens"), "lemmas") if lemmas is None else lemmas
    own = explode_rows(base, F.array_distinct(_listed(F.col("tokens"))), "term", id_col)
    maps = own.join(lem, "term").groupBy(id_col).agg(F.collect_set(F.struct("term", "lemma")).alias("_l"))
    base = base.join(maps.withColumnRenamed(id_col, "_id"), F.col(id_col).eqNullSafe(F.col("_id")), "left")
    changed = F.transform(_listed(F.col("tokens")), lambda t: F.coalesce(F.try_element_at("_m", t), t))
    return base.withColumn("_m", F.map_from_entries("_l")).select(
        id_col, *keep, F.when(F.col("_l").isNull(), F.col("tokens")).otherwise(F.array_join(changed, " ")).alias("terms"))
