"""Operator 2, language ID by language-bitmask n-gram filters.

Training counts the letter trigrams of a bounded sample of labelled texts and
keeps, for each language, those that are typical of it.  A bit-sliced Bloom
filter holds them all: one array of ``2**slots_log2`` slots, and each slot is
a bitmask with one bit a language.  A trigram sets its languages' bits in
``hashes`` slots; the AND of these slots is the set of the languages that
contain it.  Prediction takes every trigram of the whole text, counts each
language's bits (popcounts), takes off the false positives expected from how
full that language's bit slice is, and takes the language with the highest
corrected share.

Defined results: null text, or text without a letter: ``und``, score 0.
Ties: the language that sorts first.  Repeated rows: one result each.  Empty
input: empty result; no labelled row at all: every result is ``und``.  Only
the columns named by arguments are read, so others may have any name."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_chunks, text_batches

UND = "und"
SPACE = 32
SAMPLE_STEPS = 1 << 30


@dataclass(frozen=True)
class LanguageFilter:
    langs: tuple[str, ...]
    masks: np.ndarray          # (words, slots) uint64, bit l % 64 of word l // 64: language l
    hashes: int
    false_positive: np.ndarray  # by language


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, trigram code) of each letter of ``texts`` with its
    two neighbours; what isn't a letter counts as a space."""
    low = [t.lower() for t in texts]
    joined = " " + " ".join(low) + " "
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = np.where(_letters()[cp], cp, SPACE).astype(np.uint64)
    doc = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])
    mid = cp[1:-1]
    at = np.flatnonzero(mid != SPACE)
    code = (cp[at] << np.uint64(42)) | (mid[at] << np.uint64(21)) | cp[at + 2]
    return doc[at], code


def slots_of(code: np.ndarray, hashes: int, slots_log2: int) -> list[np.ndarray]:
    """``hashes`` slot numbers of each code, by multiplicative hashing."""
    out = []
    for k in range(hashes):
        odd = np.uint64((0x9E3779B97F4A7C15 + 2 * k * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF | 1)
        x = code * odd
        x ^= x >> np.uint64(29)
        x = x * odd
        out.append((x >> np.uint64(64 - slots_log2)).astype(np.int64))
    return out


def learn(docs: DataFrame, per_lang: int = 2000, slots_log2: int = 20, hashes: int = 3,
          min_count: int = 3, min_share: float = 0.2, text: str = "text", lang: str = "lang",
          doc_id: str = "doc_id") -> LanguageFilter:
    """Fit the filter on about ``per_lang`` rows a language (the documented
    bound of the sample; texts are whole): those whose id hashes below that
    share of the language's rows, so all if there are no more than that.  Rows without an id, a label or a text are left out.  A trigram is typical
    of a language if it has it ``min_count`` times or more and at
    ``min_share`` of the highest rate among the languages or more.  Only the
    ``2**slots_log2`` slots reach the driver."""
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(lang).alias("l")).where(
        "i is not null and t is not null and l is not null")
    sizes = {r["l"]: r["count"] for r in rows.groupBy("l").count().collect()}  # one row a language
    langs = tuple(sorted(sizes))
    reach = [(x, int(min(1.0, per_lang / sizes[x]) * SAMPLE_STEPS)) for x in langs]
    limits = docs.sparkSession.createDataFrame(reach, "l string, reach long")
    sample = (rows.join(F.broadcast(limits), "l").where(F.pmod(F.xxhash64("i"), F.lit(SAMPLE_STEPS)) < F.col("reach"))
              .select("l", "t"))

    def count(batches):
        for pdf in batches:
            for label, group in pdf.groupby("l"):
                for a, b in row_chunks(group["t"].str.len().tolist()):
                    code, n = np.unique(trigrams(group["t"].tolist()[a:b])[1], return_counts=True)
                    yield pd.DataFrame({"l": label, "g": code.view(np.int64), "n": n})

    counts = text_batches(sample).mapInPandas(count, "l string, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n"))
    rate = F.col("n") / F.sum("n").over(Window.partitionBy("l"))
    typical = (counts.withColumn("r", rate).withColumn("top", F.max("r").over(Window.partitionBy("g")))
               .where((F.col("n") >= min_count) & (F.col("r") >= min_share * F.col("top"))))
    place = {x: i for i, x in enumerate(langs)}

    def spread(batches):
        for pdf in batches:
            at = pdf["l"].map(place).to_numpy()
            bit = (np.uint64(1) << (at % 64).astype(np.uint64)).view(np.int64)
            for s in slots_of(pdf["g"].to_numpy().view(np.uint64), hashes, slots_log2):
                yield pd.DataFrame({"w": at // 64, "s": s, "m": bit})

    slots = (typical.select("l", "g").mapInPandas(spread, "w long, s long, m long")
             .groupBy("w", "s").agg(F.bit_or("m").alias("m")).toPandas())
    masks = np.zeros((max(1, -(-len(langs) // 64)), 1 << slots_log2), np.uint64)
    masks[slots["w"].to_numpy(np.int64), slots["s"].to_numpy(np.int64)] = slots["m"].to_numpy(np.int64).view(np.uint64)
    full = np.array([np.count_nonzero(masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(langs))])
    return LanguageFilter(langs, masks, hashes, (full / (1 << slots_log2)) ** hashes)


def score_texts(texts: list[str], filt: LanguageFilter) -> tuple[list[str], list[float]]:
    """Language and corrected share of each text."""
    n_lang, out_l, out_s = len(filt.langs), [], []
    log2 = filt.masks.shape[1].bit_length() - 1
    for a, b in row_chunks([len(t) for t in texts]):
        doc, code = trigrams(texts[a:b])
        total = np.bincount(doc, minlength=b - a).astype(float)
        share = np.zeros((b - a, max(1, n_lang)))
        slots = slots_of(code, filt.hashes, log2)
        for w in range(filt.masks.shape[0]):
            found = filt.masks[w][slots[0]]
            for s in slots[1:]:
                found &= filt.masks[w][s]
            for i in range(64 * w, min(n_lang, 64 * w + 64)):
                bit = (found >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
                hits = np.bincount(doc[bit], minlength=b - a)
                fp = filt.false_positive[i]
                share[:, i] = np.clip((hits / np.maximum(total, 1) - fp) / max(1 - fp, 1e-9), 0, 1)
        best = share.argmax(1)
        for k in range(b - a):
            known = total[k] > 0 and n_lang > 0
            out_l.append(filt.langs[best[k]] if known else UND)
            out_s.append(float(share[k, best[k]]) if known else 0.0)
    return out_l, out_s


def predict(docs: DataFrame, filt: LanguageFilter, keep: tuple[str, ...] = ("doc_id",),
            text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row and ``lang_pred``, ``score``.  Ids and
    labels in ``keep`` are only carried along."""
    docs = docs.select(*keep, *([] if text in keep else [text]))
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType(fields + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(filt)  # 2**slots_log2 slots, whatever the input's size

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            lang, score = score_texts(texts, shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*keep, "lang_pred", "score"])

    return text_batches(docs).mapInArrow(run, schema)
