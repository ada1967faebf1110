"""Sequence preparation.

A corpus vocabulary gives every distinct token an id (ordered by md5 of the
token, ranked with the two-phase rank, so no single-task sort); documents
are cut to the first ``max_len - 2`` tokens *before* any join, and their
distinct tokens mapped to ids with one join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import explode_rows
from .rank import global_rank, hash_key, hash_rank

# fixed values: special token ids
PAD, CLS, SEP, UNK = 0, 1, 2, 3
FIRST_ID = 4


def with_seq_tokens(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Word tokens of the lower-cased text (punctuation removed), one
    projection per step (see ``apply_steps``)."""
    return T.apply_steps(df, text_col, out, [F.lower] + T.WORD_TOKEN_STEPS)


def vocabulary(tokens: DataFrame, term_col: str = "token") -> DataFrame:
    """(token, id): ids from FIRST_ID in md5(token) order."""
    v = tokens.select(F.col(term_col).alias("token")).where(F.col("token").isNotNull()).distinct()
    # the ranking reads the vocabulary three times: materialise it once
    v = v.withColumn("_k", F.md5(F.col("token"))).checkpoint()
    r = hash_rank(v, "_k", "_rn")
    return r.select("token", (F.col("_rn") + (FIRST_ID - 1)).cast("int").alias("id"))


def token_ids(df: DataFrame, cols: list[str], vocab: DataFrame, id_cols: list[str]) -> DataFrame:
    """``df`` with its token array columns ``cols`` replaced by id arrays.

    Only a row's distinct tokens meet the vocabulary (one join for all of the
    columns); the ids come back as a map of the row.  Rows are told apart by
    their ids and a hash of their tokens, compared as one struct in which null
    equals null, so rows without an id or with a repeated one keep their own
    tokens, and rows equal in both share a map that fits them all."""
    df = df.withColumn("_row", F.struct(*id_cols, F.xxhash64(*cols).alias("_h")))
    every = F.array_distinct(F.concat(*[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in cols]))
    own = explode_rows(df, every, "token", "_row")
    maps = own.join(vocab, "token").groupBy("_row").agg(
        F.map_from_entries(F.collect_set(F.struct("token", "id"))).alias("_m"))
    out = df.join(maps, "_row", "left")
    for c in cols:
        out = out.withColumn(c, F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")),
                                            lambda t: F.coalesce(F.try_element_at("_m", t), F.lit(UNK))))
    return out.drop("_m", "_row")


def subword_vocabulary(tokens: DataFrame, tokenizer_json: str, term_col: str = "token") -> DataFrame:
    """(token, ids): the subword ids of each distinct word, by a public
    tokenizer's file (its content).  A word is encoded once, however often the
    corpus has it."""
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)  # a vocabulary file: of fixed size

    def run(batches):
        import pyarrow as pa
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(shared.value)
        for batch in batches:
            found = tokenizer.encode_batch(batch.column("token").to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column("token"), pa.array([e.ids for e in found], pa.list_(pa.int32()))],
                                             names=["token", "ids"])

    words = tokens.select(F.col(term_col).alias("token")).where(F.col("token").isNotNull()).distinct()
    return words.mapInArrow(run, "token string, ids array<int>").checkpoint()


def pack_subwords(df: DataFrame, vocab: DataFrame, start: int, end: int, tokens_col: str = "tokens", id_col: str = "doc_id",
                  max_len: int = 150, keep: list[str] | None = None) -> DataFrame:
    """N1 in subwords: (id, input_ids, attention_mask, n_tokens) with the
    tokenizer's ``start`` and ``end`` ids, cut to ``max_len``.  A word has one
    id at least, so only the first ``max_len - 2`` words of a row are looked
    up; words that ``vocab`` (token, ids) doesn't have give no id."""
    keep = keep or []
    words = F.coalesce(F.slice(tokens_col, 1, max_len - 2), F.array().cast("array<string>"))
    df = df.select(id_col, *keep, words.alias("_w")).withColumn("_row", F.struct(id_col, F.xxhash64("_w").alias("_h")))
    own = explode_rows(df, F.array_distinct("_w"), "token", "_row")
    maps = own.join(vocab, "token").groupBy("_row").agg(F.map_from_entries(F.collect_set(F.struct("token", "ids"))).alias("_m"))
    none = F.array().cast("array<int>")
    ids = F.flatten(F.transform("_w", lambda w: F.coalesce(F.try_element_at("_m", w), none)))
    out = df.join(maps, "_row", "left").withColumn("input_ids", F.concat(
        F.array(F.lit(start)), F.slice(ids, 1, max_len - 2), F.array(F.lit(end))))
    return out.select(id_col, *keep, "input_ids", F.size("input_ids").cast("long").alias("n_tokens"),
                      F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"))


def pack_sequences(df: DataFrame, vocab: DataFrame, tokens_col: str = "tokens", id_col: str = "doc_id",
                   max_len: int = 150, keep: list[str] | None = None) -> DataFrame:
    """(id, input_ids, attention_mask, n_tokens) with CLS/SEP markers,
    from a column of tokens (``with_seq_tokens``)."""
    keep = keep or []
    cut = df.select(id_col, *keep, F.slice(tokens_col, 1, max_len - 2).alias("ids"))
    ids = token_ids(cut, ["ids"], vocab, [id_col])
    full = F.concat(F.array(F.lit(CLS)), F.col("ids"), F.array(F.lit(SEP)))
    return (ids.withColumn("input_ids", full)
               .withColumn("n_tokens", F.size("input_ids").cast("long"))
               .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
               .drop("ids"))


def pair_budget(la: F.Column, lb: F.Column, budget: int):
    """N2 longest-first cut of a pair to ``budget`` content tokens: the
    shorter side keeps min(len, budget//2), the longer takes the rest; equal
    sides give the first budget//2 and the second the rest."""
    half = budget // 2
    fits = (la + lb) <= budget
    a = (F.when(fits, la).when(la < lb, F.least(la, F.lit(half)))
          .when(lb < la, F.lit(budget) - F.least(lb, F.lit(half))).otherwise(F.lit(half)))
    b = (F.when(fits, lb).when(lb < la, F.least(lb, F.lit(half)))
          .when(la < lb, F.lit(budget) - F.least(la, F.lit(half))).otherwise(F.lit(budget - half)))
    return a, b


def pack_pairs(pairs: DataFrame, vocab: DataFrame, id_cols: list[str], max_len: int = 150) -> DataFrame:
    """Pairs (id_cols, a, b) of token arrays -> input_ids, token_type_ids."""
    budget = max_len - 3
    pairs = token_ids(pairs.select(*id_cols, F.slice("a", 1, budget).alias("a_ids"), F.slice("b", 1, budget).alias("b_ids")),
                      ["a_ids", "b_ids"], vocab, id_cols)
    la, lb = F.size("a_ids"), F.size("b_ids")
    na, nb = pair_budget(la, lb, budget)
    p = pairs.withColumn("_na", na).withColumn("_nb", nb)
    ids = F.concat(F.array(F.lit(CLS)), F.slice("a_ids", 1, F.col("_na")), F.array(F.lit(SEP)),
                   F.slice("b_ids", 1, F.col("_nb")), F.array(F.lit(SEP)))
    types = F.concat(F.array_repeat(F.lit(0), F.col("_na") + 2), F.array_repeat(F.lit(1), F.col("_nb") + 1))
    return p.select(*id_cols, ids.alias("input_ids"), types.alias("token_type_ids"),
                    F.size(ids).cast("long").alias("n_tokens"))


def pack_batches(seqs: DataFrame, id_col: str = "doc_id", batch_size: int = 4, seed="15",
                 split_col: str = "split", shuffled: str = "train", ordered: tuple = ("valid", "test")) -> DataFrame:
    """N3/N4/W4/W5, per split: the ``shuffled`` part in seeded order, the
    others by id; batch = floor((rank-1)/size); each sequence padded to the
    longest of its batch, the padding masked.

    Ranks and batch maxima are made on (row, id, split, length) rows; the id
    arrays are joined to them once, by a row number that the checkpoint
    fixes, so rows without an id or with a repeated one stay apart.  Rows
    without an id are shuffled by their row number."""
    seqs = seqs.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    narrow = seqs.select("_row", id_col, split_col, "n_tokens")
    key = F.coalesce(hash_key(id_col, seed), hash_key("_row", f"{seed}-row"))
    parts = [hash_rank(narrow.where(F.col(split_col) == shuffled).withColumn("_k", key), "_k", "_rn").drop("_k")]
    parts += [global_rank(narrow.where(F.col(split_col) == s), id_col, "_rn") for s in ordered]
    ranked = parts[0]
    for p in parts[1:]:
        ranked = ranked.unionByName(p)
    b = ranked.withColumn("batch", F.floor((F.col("_rn") - 1) / batch_size).cast("long"))
    b = b.withColumn("_m", F.max("n_tokens").over(Window.partitionBy(split_col, "batch")).cast("int"))
    b = b.select("_row", id_col, split_col, "batch", "_rn", "_m").join(seqs.select("_row", "input_ids"), "_row")
    pad = F.col("_m") - F.size("input_ids")
    return b.select(id_col, split_col, "batch", F.col("_rn").cast("long").alias("position"),
                    F.concat("input_ids", F.array_repeat(F.lit(PAD), pad)).alias("input_ids"),
                    F.concat(F.array_repeat(F.lit(1), F.size("input_ids")),
                             F.array_repeat(F.lit(0), pad)).alias("attention_mask"))
