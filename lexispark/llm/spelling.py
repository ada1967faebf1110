"""Operator 11, spelling variant grouping by permuterm rotations.

A word w is marked with a terminator and rotated: the rotation that begins
behind its character i reads w[i+1:] $ w[:i], and then w[i].  Two words of one
length that differ by a replacement at i have the same rotation up to that
last character, and a word without w[i] has it as a whole rotation.  So each
word gives one key for each character left out and one for each whole
rotation; the keys are sorted, and rows with one key are a group: the words
that differ in the one character that was left out, and at most one word that
lacks it.  A group therefore has no more words than there are characters that
words are made of, plus one, whatever the size of the corpus.  Deleting any
character of a run such as ``ee`` gives the same word: only the first of a run
links two words of different length, so each pair of near words meets in
exactly one group and nothing is counted twice.

Keys are 127-bit rolling fingerprints of the rotations (polynomials modulo
the prime 2**127 - 1), so a word of a million letters costs two rows a letter
and not a copy of itself a letter.  Words are named by their rank (most
frequent first, then by code points), so the best near word is the smallest
rank.

Defined results: null or empty text has no runs; a null id reads as the empty
text in ``<id>:<run>``; repeated rows count as rows of their own; ties between
forms go to the smallest word; a word without a near word has ``n_near`` 0 and
is its own root; empty input gives an empty result.  Only the named columns
are read, so others may have any name."""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_batches, written
from .positions import positions

RUN = re.compile("[A-Za-zÀ-ÿ]+")
GAP = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPAN = 1 << 20       # code points of a text that are searched at a time
HELD = 1 << 18       # words that a task counts before it hands them on
ROWS = 1 << 15       # rows of a batch of keys
PRIME = (1 << 127) - 1
BASE = 0x5851F42D4C957F2D14057B7EF767814F  # any number below PRIME would do
END = 1              # the terminator; letters have code points above it


def _runs(text: str):
    """Lists of the letter runs of ``text``, in order."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + SPAN)
        end = gap.start() if gap else len(text)
        yield RUN.findall(text, at, end)
        at = end


def word_counts(docs: DataFrame, min_chars: int = 6, min_count: int = 5, drop_every: int | None = None,
                text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n): the lower-cased letter runs of all texts, at least
    ``min_chars`` long and ``min_count`` times there.  With ``drop_every``, a
    run whose crc32 of ``<id>:<run>`` it divides loses the code point at that
    number modulo its length."""
    def count(batches):
        import pyarrow as pa

        def out(held):
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                              names=["word", "n"])

        held = Counter()
        for batch in batches:
            for key, t in zip(batch.column("id"), batch.column("t")):
                seed = zlib.crc32(f"{key.as_py()}:".encode())
                for found in _runs(t.as_py()):
                    for run, n in Counter(found).items():
                        run = run.translate(LOWER)
                        if drop_every:
                            h = zlib.crc32(run.encode(), seed)
                            if h % drop_every == 0:
                                k = h % len(run)
                                run = run[:k] + run[k + 1:]
                        if len(run) >= min_chars:
                            held[run] += n
                if len(held) >= HELD:
                    yield out(held)
                    held = Counter()
        yield out(held)

    rows = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("t"))
    return (text_batches(rows).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def rotation_keys(word: str):
    """(left out, whole): for each character, the fingerprint of the rotation
    behind it without it; for each start, that of the whole rotation."""
    marked = [*map(ord, word), END]
    top = pow(BASE, len(word), PRIME)
    turn = 0
    for c in marked:
        turn = (turn * BASE + c) % PRIME
    without, whole = [], []
    for c in marked:
        whole.append(turn)
        rest = (turn - c * top) % PRIME
        without.append(rest)
        turn = (rest * BASE + c) % PRIME
    return without[:-1], whole


def _keys(words: DataFrame) -> DataFrame:
    """(hi, lo, kind, rank) of every key of every word: kind 0 is a whole
    rotation, 1 and 2 leave a character out, 2 the first of a run."""
    def turn(batches):
        import numpy as np
        import pyarrow as pa

        def out(keys, kinds, ranks):
            two = np.frombuffer(b"".join(k.to_bytes(16, "little") for k in keys), "<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(two[:, 1]), pa.array(two[:, 0]), pa.array(np.array(kinds, np.int8)), pa.array(np.array(ranks, np.int64))],
                names=["hi", "lo", "kind", "rank"])

        for batch in batches:
            keys, kinds, ranks = [], [], []
            for rank, word in zip(batch.column("rank").to_pylist(), batch.column("word")):
                word = word.as_py()
                without, whole = rotation_keys(word)
                keys += without + whole
                kinds += [1 if i and c == word[i - 1] else 2 for i, c in enumerate(word)] + [0] * len(whole)
                ranks += [rank] * (len(without) + len(whole))
                if len(keys) >= ROWS:
                    yield out(keys, kinds, ranks)
                    keys, kinds, ranks = [], [], []
            if keys:
                yield out(keys, kinds, ranks)

    return words.select("rank", "word").mapInArrow(turn, "hi long, lo long, kind byte, rank long")


def groups(words: DataFrame) -> DataFrame:
    """(others, firsts, whole) of each key that two words or more share: the
    ranks of the words that leave a character out, in order; those of them
    that leave out the first of a run; the word that lacks it (or null).
    Every two of ``others``, and each of ``firsts`` and ``whole``, are near."""
    kind = F.col("kind")
    found = _keys(words).groupBy("hi", "lo").agg(
        F.sort_array(F.collect_list(F.when(kind > 0, F.col("rank")))).alias("others"),
        F.sort_array(F.collect_list(F.when(kind == 2, F.col("rank")))).alias("firsts"),
        F.max(F.when(kind == 0, F.col("rank"))).alias("whole"))
    return found.select("others", "firsts", "whole").where(
        (F.size("others") > 1) | (F.col("whole").isNotNull() & (F.size("firsts") > 0)))


def neighbours(words: DataFrame) -> DataFrame:
    """(rank, n_near, best) of each word that has a near word: their number,
    and the smallest rank among them.  Each group is scanned once and gives
    one row a word, not one a pair."""
    whole = F.col("whole")

    def of_other(r):
        beside = whole.isNotNull() & F.array_contains("firsts", r)
        return F.struct(r.alias("rank"), (F.size("others") - 1 + beside.cast("int")).cast("long").alias("n"),
                        F.least(F.when(r == F.get("others", F.lit(0)), F.get("others", F.lit(1)))
                                .otherwise(F.get("others", F.lit(0))), F.when(beside, whole)).alias("best"))

    lone = F.when(whole.isNotNull() & (F.size("firsts") > 0), F.array(F.struct(
        whole.alias("rank"), F.size("firsts").cast("long").alias("n"), F.get("firsts", F.lit(0)).alias("best"))))
    each = F.concat(F.transform("others", of_other), F.coalesce(lone, F.array().cast(
        "array<struct<rank:bigint,n:bigint,best:bigint>>")))
    return (groups(words).select(F.explode(each).alias("x")).where("x.n > 0")
            .groupBy("x.rank").agg(F.sum("x.n").alias("n_near"), F.min("x.best").alias("best")))


def _roots(links: DataFrame) -> DataFrame:
    """(rank, up) -> (rank, root): each round follows the link of a link, so
    the chains that are left halve."""
    at = cut(links.withColumnRenamed("up", "root"))
    while True:
        up = at.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        at = cut(at.select("rank", "root").join(up, "root", "left").select(
            "rank", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if at.where("moved").isEmpty():
            return at.select("rank", "root")


def variants(counts: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``counts`` (word, n): a word's
    form is its most frequent near word, if that one is ``ratio`` times as
    frequent at least; its root is where following forms ends."""
    words = written(positions(written(counts, "spelling_counts"), [], [F.col("n").desc(), F.col("word")], "rank"), "spelling_words")
    best = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    close = neighbours(words).join(best, "best")
    t = words.join(close, "rank", "left").withColumn("better", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
    t = written(t.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                         *[F.when(F.col("better"), F.col(c)).alias(c) for c in ("best", "form", "form_n")]), "spelling_forms")
    roots = _roots(t.where("best is not null").select("rank", F.col("best").alias("up")))
    named = roots.join(words.select(F.col("rank").alias("root"), F.col("word").alias("last")), "root").select("rank", "last")
    return t.join(named, "rank", "left").select(
        "word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5,
                      drop_every: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``variants`` of the words of ``docs``."""
    return variants(word_counts(docs, min_chars, min_count, drop_every, text, doc_id), ratio)
