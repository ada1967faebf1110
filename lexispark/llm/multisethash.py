"""Operator 4, document fingerprints by a homomorphic multiset hash (DataFrame
functions only).

A text is the multiset of its paragraphs: its lines, and lines cut after a
sentence's end.  Each paragraph is hashed by SHA-256 to a wide vector: eight
32-bit words, summed modulo 2**32 (equality), and 128 bits, each counted
modulo 2**32 (likeness).  A text's fingerprint is the sum of its paragraphs'
vectors: it doesn't depend on their order, and a paragraph is inserted or
deleted by adding or subtracting its vector (``add`` and ``subtract``).

Likeness: a bit's count c of n paragraphs gives the signed sum 2c - n.  For
two multisets, the mean square of the differences of the 128 signed sums
estimates the sum over paragraphs of the squared difference of their counts,
so 1 - |A - B|^2 / (|A|^2 + |B|^2), kept within 0 to 1, is the share of
paragraphs in common (2 |A and B| / (|A| + |B|) where none repeats).

The next document is found without a global sort: at most ``buckets`` ids that
stand in the data (quantiles) bound the buckets, each bucket also gets the row
that begins the next one, and the rest happens inside the buckets, in one
shuffle of the texts.

Defined results: null text counts as empty; the empty text has no paragraph
and the zero vector, and two zero vectors have likeness 1; a row without an id
counts as the lowest id; rows that repeat an id follow each other by text;
with one row, it is its own next; empty input gives an empty result.  Only the
named columns are read, so others may have any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 8          # 32-bit words of the equality part
BITS = 128         # bit counters of the likeness part
MOD = 1 << 32
LOWEST = -(1 << 63)
#: Where a text is cut: line ends, and white space after a sentence's end.
CUT = r"\n|(?<=[.!?]) +"
PAIR = 0x0000000100000001


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, CUT, -1), lambda x: x != "")


def _word(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _vector_sums(digest_words: list[Column]) -> list[Column]:
    """The equality sums, and the bit counts, two to a long: with words v and
    w, count i of v is in the low half and count i of w in the high half."""
    out = [F.sum(w).alias(f"e{k}") for k, w in enumerate(digest_words)]
    for k in range(0, BITS // 32, 2):
        both = digest_words[k].bitwiseOR(F.shiftleft(digest_words[k + 1], 32))
        out += [F.sum(F.shiftrightunsigned(both, i).bitwiseAND(F.lit(PAIR))).alias(f"b{k}_{i}") for i in range(32)]
    return out


def _gathered() -> Column:
    """The summed columns as one array: number of paragraphs, equality words
    modulo 2**32, bit counts modulo 2**32."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    half = lambda c: [zero(c).bitwiseAND(F.lit(MOD - 1)), F.shiftrightunsigned(zero(c), 32)]
    counts = [x for k in range(0, BITS // 32, 2) for i in range(32) for x in half(f"b{k}_{i}")]
    return F.array(zero("n"), *[zero(f"e{k}") % MOD for k in range(WORDS)], *counts)


def add(a: Column, b: Column) -> Column:
    """The vector of the union of two multisets."""
    return F.zip_with(a, b, lambda x, y: (x + y) % MOD)


def subtract(a: Column, b: Column) -> Column:
    """The vector of multiset a without the paragraphs of b."""
    return F.zip_with(a, b, lambda x, y: (x - y + MOD) % MOD)


def as_text(v: Column) -> Column:
    """The fingerprint as a string of hexadecimal words: 64 digits of the
    equality part, a dash, the bit counts."""
    word = lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")
    return F.concat(F.array_join(F.transform(F.slice(v, 2, WORDS), word), ""), F.lit("-"),
                    F.array_join(F.transform(F.slice(v, WORDS + 2, BITS), lambda x: F.lower(F.hex(x))), "."))


def likeness(a: Column, b: Column) -> Column:
    signed = lambda v: F.transform(F.slice(v, WORDS + 2, BITS), lambda c: 2 * c - v[0])
    norm = lambda v: F.aggregate(v, F.lit(0).cast("long"), lambda s, x: s + x * x)
    apart = norm(F.zip_with(signed(a), signed(b), lambda x, y: x - y))
    whole = norm(signed(a)) + norm(signed(b))
    return F.when(whole == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1.0 - apart / whole))


def vectors(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys..., v): the vector of each row's text.  Where the rows lie
    together by some of ``keys``, nothing is shuffled."""
    parts = rows.select(*keys, F.explode_outer(paragraphs(F.col(text))).alias("__p")).select(
        *keys, "__p", F.sha2(F.col("__p"), 256).alias("__d"))
    words = parts.select(*keys, F.col("__p").isNotNull().cast("long").alias("__n"),
                         *[_word(F.col("__d"), k).alias(f"__w{k}") for k in range(WORDS)])
    return (words.groupBy(*keys).agg(F.sum("__n").alias("n"), *_vector_sums([F.col(f"__w{k}") for k in range(WORDS)]))
            .select(*keys, _gathered().alias("v")))


def _bucket(bounds: list[int]) -> tuple[Column, Column]:
    """Two columns to add, the first as ``top``; the second is the number of the last bound at or below ``id``, in two steps of about the
    square root of their number."""
    step = max(1, int(len(bounds) ** 0.5))
    tops = bounds[::step]
    chunks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    top = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in tops]), lambda b: b <= F.col("id"))) - 1
    chunk = F.element_at(F.array(*[F.array(*[F.lit(x).cast("long") for x in c]) for c in chunks]), F.col("top") + 1)
    inner = F.size(F.filter(chunk, lambda b: b <= F.col("id"))) - 1
    return top, F.col("top") * step + inner


def next_texts(docs: DataFrame, buckets: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(bucket, k, doc_id, text, next, guest): each row with the text of the
    row that follows it by id, the last with the first row's.  Rows lie
    together by ``bucket``; ``guest`` rows only repeat the next bucket's
    first row, for what is looked up there."""
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST)).alias("id"))
    found = rows.agg(F.percentile_approx("id", [i / buckets for i in range(buckets)], 100 * buckets), F.min("id")).first()
    bounds = sorted({found[1], *(found[0] or [])}) if found[1] is not None else [LOWEST]
    top, bucket = _bucket(bounds)
    edge = F.array_contains(F.array(*[F.lit(x).cast("long") for x in bounds]), F.col("id"))
    dealt = rows.withColumn("top", top).withColumn("own", bucket).select(
        "doc_id", "text", "id", F.explode(F.when(edge, F.array(
            F.struct(F.col("own").alias("bucket"), F.lit(0).alias("guest")),
            F.struct(F.pmod(F.col("own") - 1, F.lit(len(bounds))).alias("bucket"), F.lit(1).alias("guest"))))
            .otherwise(F.array(F.struct(F.col("own").alias("bucket"), F.lit(0).alias("guest"))))).alias("x")
    ).select("doc_id", "text", "id", "x.bucket", "x.guest")
    order = Window.partitionBy("bucket").orderBy("guest", "id", "text")
    return dealt.select("bucket", F.row_number().over(order).alias("k"), "doc_id", "text",
                        F.lead("text").over(order).alias("next"), "guest")


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n/2) code points replaced by the first as
    many (or all) of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def edited_fingerprints(docs: DataFrame, buckets: int | None = None, text: str = "text",
                        doc_id: str = "doc_id") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and the likeness of
    its fingerprint to the edited text's and to the next row's."""
    rows = next_texts(docs, buckets, text, doc_id).withColumn(
        "kinds", F.when(F.col("guest") == 1, F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t"))))
        .otherwise(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")),
                           F.struct(F.lit(1).alias("kind"), edited_text(F.col("text"), F.col("next")).alias("t")))))
    texts = rows.select("bucket", "k", "doc_id", "guest", F.explode("kinds").alias("x")).select(
        "bucket", "k", "doc_id", "guest", "x.kind", "x.t").select(
        "*", F.length("t").cast("long").alias("n_chars"),
        F.when(F.col("kind") == 1, F.sha2(F.col("t"), 256)).alias("sha"))
    v = vectors(texts, ["bucket", "k", "doc_id", "guest", "kind", "n_chars", "sha"], "t")
    order = Window.partitionBy("bucket").orderBy("k", "kind")
    own = v.select("*", F.lead(F.struct("v", "sha")).over(order).alias("edited"), F.lead("v", 2).over(order).alias("following"))
    return own.where("guest = 0 and kind = 0").select(
        "doc_id", "n_chars", F.col("edited.sha").alias("edited_sha256"), as_text(F.col("v")).alias("fingerprint"),
        as_text(F.col("edited.v")).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("edited.v")).alias("near_edited"),
        likeness(F.col("v"), F.col("following")).alias("near_next"))
