"""Operator 5, LM scoring by stupid backoff, computed relationally.

The units are the ids of a public tokenizer's fixed vocabulary (16 bits an id,
so an n-gram of up to three units is one long).  Documents are encoded where
the scan has them and dealt, as units, to blocks of bounded size.  Each block
is exploded to its distinct n-grams with their counts; these rows go to the
count table, partitioned by n-gram, where the counts of all blocks are summed.
Back to a block go only the n-grams whose corpus count isn't the block's own:
the block counts the others, most of them, itself.  Then its documents are
scored:

    S(w | context) = count(context w) / count(context)   if count(context w) >= min_count
                     backoff * S(w | shorter context)    otherwise
    S(w) = count(w) / number of units

With ``leave_one_out`` a document's own occurrences are taken from every count
that scores it, so that it isn't evidence for itself and what stands nowhere
else backs off; a unit that no other document has counts as ``backoff`` times
one occurrence.  A document's score is the sum of log10 S over its units.  The
counts are taken over all documents.  An n-gram has one row a block at most, so
the most frequent one costs its partition no more rows than there are blocks,
and no group holds more than one block's distinct n-grams.

Defined results: null or empty text has 0 units, score 0.0 and a null mean and
perplexity; texts of any length are encoded whole, also very long runs of
white space; repeated rows count and are scored each; a lone document scored
by the others has nothing to go by, so each unit backs off through all orders
to ``backoff``; empty input gives an empty result.  Only the named columns are read, so others may have
any name."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, row_chunks, text_batches
from .tokencounts import Codec, encode_text, read_ranks

BACKOFF = 0.4
UNIT_BITS = 16
BLOCK_CHARS = 24_000_000
CHUNK_UNITS = 1 << 18       # units that are sorted at a time
TEXT_BITS = 15
CHUNK_TEXTS = (1 << TEXT_BITS) - 1  # texts of a chunk: their number stands below an n-gram in one long


def encoder(ranks_path: str, pattern: str):
    """Units of texts: ids of a tiktoken vocabulary, from 1 (0 is no unit)."""
    import tiktoken
    codec = tiktoken.Encoding("units", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})

    def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text's number, unit) of every unit of ``texts``."""
        return _flat([_units(codec, t) for t in texts])

    return units


def _units(codec, text: str) -> np.ndarray:
    if codec.max_token_value + 1 >= 1 << UNIT_BITS:
        raise ValueError("the vocabulary has more ids than an n-gram key can hold")
    return (encode_text(codec, text) + 1).astype("<u2")


def _flat(units: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.concatenate(units).astype(np.int64) if units else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(units)), [len(u) for u in units]), flat


def ngrams(doc: np.ndarray, unit: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each unit, for n = 1..order; 0 where
    the text has no n units up to there."""
    keys = [unit]
    for n in range(2, order + 1):
        k = np.zeros(len(unit), np.int64)
        same = doc[n - 1:] == doc[:len(doc) - n + 1]
        k[n - 1:] = np.where(same, (keys[-1][n - 2:-1] << UNIT_BITS) | unit[n - 1:], 0)
        keys.append(k)
    return keys


def _chunks(units: list[np.ndarray]):
    """Lists of consecutive texts' units, bounded in units and in texts."""
    for a, b in row_chunks([len(u) for u in units], CHUNK_UNITS):
        for c in range(a, b, CHUNK_TEXTS):
            yield c, units[c:min(b, c + CHUNK_TEXTS)]


def count_ngrams(units: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams in order, their counts) of a block."""
    parts: list = []
    for _, own in _chunks(units):
        g = np.concatenate(ngrams(*_flat(own), order))
        parts.append(np.unique(g[g > 0], return_counts=True))
        while len(parts) > 1 and len(parts[-2][0]) <= 2 * len(parts[-1][0]):  # sizes fall, so each n-gram is merged few times
            parts[-2:] = [_merged(parts[-2:])]
    return _merged(parts) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _merged(parts):
    g, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(g, kind="stable")
    g, n = g[order], n[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    return g[first], np.add.reduceat(n, first) if len(g) else n


def score_block(units: list[np.ndarray], g: np.ndarray, c: np.ndarray, total: int, order: int, min_count: int,
                backoff: float, leave_one_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """(units, sum of log10 S) of each text, with the corpus counts ``c`` of
    the sorted n-grams ``g``."""
    size, score = np.zeros(len(units), np.int64), np.zeros(len(units))
    for at, own in _chunks(units):
        doc, unit = _flat(own)
        lengths = np.bincount(doc, minlength=len(own))
        size[at:at + len(own)] = lengths
        if not len(unit):
            continue
        counts = []
        for keys in ngrams(doc, unit, order):
            mark = (keys << TEXT_BITS) | doc  # in the order of the keys, so that they are looked up in order
            place = np.argsort(mark)
            mark = mark[place]
            first = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]])
            here, key = np.diff(np.r_[first, len(mark)]), mark[first] >> TEXT_BITS
            n = c[np.minimum(np.searchsorted(g, key), len(g) - 1)] - (here if leave_one_out else 0)
            found = np.empty(len(mark))
            found[place] = np.repeat(np.where(key > 0, n, 0), here)
            counts.append(found)
        rest = total - (lengths[doc] if leave_one_out else 0)
        s = np.where(counts[0] > 0, counts[0], backoff) / np.maximum(rest, 1)
        for n in range(1, order):
            context = np.r_[0.0, counts[n - 1][:-1]]  # of the n units before
            known = counts[n] >= min_count
            inside = np.r_[np.zeros(n, bool), doc[n:] == doc[:-n]][:len(doc)]
            s = np.where(known, counts[n] / np.where(known, context, 1), np.where(inside, backoff * s, s))
        score[at:at + len(own)] = np.bincount(doc, weights=np.log10(s), minlength=len(own))
    return size, score


def unit_blocks(docs: DataFrame, ranks_path: str, pattern: str, text: str, doc_id: str, block_chars: int) -> DataFrame:
    """(block, doc_id, u): the units of every row, partitioned by block."""
    vocabulary = Codec(docs.sparkSession, ranks_path, pattern)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))

    def run(batches):
        import pyarrow as pa
        codec = vocabulary.get()
        for batch in batches:
            u = pa.array([_units(codec, t.as_py() or "").tobytes() for t in batch.column("t")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("doc_id"), u], names=["block", "doc_id", "u"])

    block = F.pmod(F.xxhash64("doc_id", "t"), F.lit(blocks)).cast("int").alias("block")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return text_batches(rows.select(block, "doc_id", "t")).mapInArrow(run, f"block int, doc_id {kind}, u binary").repartition("block")


def lm_scores(docs: DataFrame, ranks_path: str, pattern: str, order: int = 2, min_count: int = 2,
              backoff: float = BACKOFF, leave_one_out: bool = False, text: str = "text", doc_id: str = "doc_id",
              block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_units, lm_score, mean_score, perplexity) of every row."""
    if order not in (1, 2, 3):
        raise ValueError("an n-gram key holds one to three units")
    blocks = unit_blocks(docs, ranks_path, pattern, text, doc_id, block_chars)
    kind = blocks.schema["doc_id"].dataType.simpleString()

    def opened(table) -> list[np.ndarray]:
        return [np.frombuffer(u.as_py(), "<u2") for u in table.column("u")]

    def explode(key, table):
        import pyarrow as pa
        units = opened(table)
        g, n = count_ngrams(units, order)
        g, n = np.r_[0, g], np.r_[sum(map(len, units)), n]  # 0 stands for the units themselves
        give_back()
        return pa.table({"block": pa.array(np.full(len(g), key[0].as_py(), np.int32)), "g": pa.array(g), "n": pa.array(n)})

    def score(key, left, right):
        import pyarrow as pa
        units = opened(left)
        g, c = count_ngrams(units, order)
        other, known = right.column("g").to_numpy(), right.column("c").to_numpy()
        total = int(known[other == 0][0])
        c[np.searchsorted(g, other[other > 0])] = known[other > 0]
        del other, known
        n, s = score_block(units, g, c, total, order, min_count, backoff, leave_one_out)
        del g, c
        give_back()
        return pa.table({"doc_id": left.column("doc_id"), "n_units": pa.array(n), "lm_score": pa.array(s)})

    held = blocks.groupBy("block").applyInArrow(explode, "block int, g long, n long")
    total = F.sum("n").over(Window.partitionBy("g"))
    answers = held.select("block", "g", "n", total.alias("c")).where("g = 0 or c <> n").select("block", "g", "c")
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, n_units long, lm_score double")
    mean = F.when(F.col("n_units") > 0, F.col("lm_score") / F.col("n_units"))
    return scored.select("doc_id", "n_units", "lm_score", mean.alias("mean_score"), F.pow(F.lit(10.0), -mean).alias("perplexity"))
