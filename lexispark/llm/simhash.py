"""Operator 9, SimHash near-dedup by segment-popcount embedding.

A text's fingerprint has a bit set if over half of its shingles' 64-bit hashes
have it.  Fingerprints link at ``max_bits`` (2) or fewer differing bits.

Search: the embedding maps a fingerprint to the bit counts of its 32 two-bit
segments; the Manhattan distance of two such vectors is never above the bit
distance, so vectors of linked fingerprints lie at distance 2 or less.  The
segments are dealt to ``groups`` groups: a distance of 2 touches two of them
at most, so linked fingerprints agree in all counts of some ``groups - 2``
groups.  Each such choice of groups is a grid of unit cells, and a range join
on the cell finds every candidate; the Manhattan distance over all segments
and then the exact bit distance are checked.  More fingerprints take more
groups, so that cells stay small; any number gives the same links.

Cells with over ``DENSE`` fingerprints (many near copies) are not paired up.
Two fingerprints differ in 2 bits or fewer exactly if they share one of the 65
values made by flipping no bit or one bit; each such value links its
fingerprints to the smallest of them, which gives the same components with
work linear in the cell.

Equal fingerprints are put together first, so exact copies cost one row.

Defined results: null or wordless text has fingerprint 0 and is linked like
any other; a bit that exactly half of the hashes have isn't set; texts of any
length are read whole; fewer than ``shingle`` words make one shingle; a null doc_id has
its row but never is a component_id unless its component has no other id;
repeated rows have one result each; empty input gives an empty result."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_batches
from .components import components

SEED = 42
DENSE = 64
LOW_BITS = 0x5555555555555555
SEGMENTS = 32


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(start[:n].tolist(), end[k - 1:].tolist())), np.uint64, n)
    count = np.zeros(64, np.int64)
    for a in range(0, n, 4096):
        bits = np.unpackbits(h[a:a + 4096].view(np.uint8), bitorder="little").reshape(-1, 64)
        count += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def text_key(text: str):
    """128 bits that stand for a text (null is a text of its own)."""
    return F.struct(*[F.xxhash64(F.lit(k), F.col(text)).alias(f"h{k}") for k in (1, 2)], F.col(text).isNull().alias("none"))


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, key): the fingerprint as a signed long, and the text's
    key, for every row."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("t")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64)), batch.column("key")],
                                             names=["doc_id", "fp", "key"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), text_key(text).alias("key"))
    return text_batches(rows).mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long, key {rows.schema['key'].dataType.simpleString()}")


def embed(fp):
    """Counts of the 32 two-bit segments, two bits each, in one long."""
    high = F.shiftrightunsigned(fp, 1)
    ones = fp.bitwiseXOR(high).bitwiseAND(F.lit(LOW_BITS))
    twos = fp.bitwiseAND(high).bitwiseAND(F.lit(LOW_BITS))
    return ones.bitwiseOR(F.shiftleft(twos, 1))


def manhattan(a, b):
    """Manhattan distance of two embeddings: count codes 0, 1, 2 that differ
    by 2 have XOR 10, those that differ by 1 have XOR 01 or 11."""
    x = a.bitwiseXOR(b)
    low = x.bitwiseAND(F.lit(LOW_BITS))
    high = F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(LOW_BITS))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grids(n: int, max_bits: int) -> list[int]:
    """Masks of the segments that each grid keeps: all choices of all but
    ``max_bits`` groups.  A two-bit count holds 1.5 bits; cells should be
    several times as many as the ``n`` fingerprints."""
    groups = max_bits + 2
    while groups < 16 and 1.5 * SEGMENTS * (groups - max_bits) / groups < np.log2(max(n, 2)) + 4:
        groups += 1
    of = [sum(3 << (2 * s) for s in range(SEGMENTS) if s % groups == g) for g in range(groups)]
    return [_signed(sum(c)) for c in combinations(of, groups - max_bits)]


def link_fingerprints(fps: DataFrame, n: int, max_bits: int = 2) -> DataFrame:
    """(a, b): links between the distinct ``fps`` (column fp) whose closure
    has the components of all pairs at ``max_bits`` or fewer bits."""
    if max_bits != 2:
        raise ValueError("dense cells are linked by one-bit flips, which is exact for 2 bits")
    masks = grids(n, max_bits)
    cells = (fps.withColumn("v", embed(F.col("fp")))
             .select("fp", "v", F.posexplode(F.array(*[F.col("v").bitwiseAND(F.lit(m)) for m in masks])).alias("g", "cell"))
             .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g", "cell"))).where("n > 1"))
    cells = cut(cells)
    few = cells.where(F.col("n") <= DENSE).drop("n")
    a, b = few.alias("a"), few.alias("b")
    pairs = (a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp")))
             .where(manhattan(F.col("a.v"), F.col("b.v")) <= max_bits)
             .where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)
             .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]
    near = cells.where(F.col("n") > DENSE).select("fp").distinct().select("fp", F.explode(F.array(*flips)).alias("at"))
    hub = near.groupBy("at").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    stars = near.join(hub, "at").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint, component_id): every row with its fingerprint
    and the smallest doc_id that links reach from it."""
    return _linked(docs, shingle, max_bits, text, doc_id).select("doc_id", "fingerprint", "component_id")


def _linked(docs: DataFrame, shingle: int, max_bits: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    rows = cut(fingerprints(docs, shingle, text, doc_id))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    links = cut(link_fingerprints(distinct.select("fp"), distinct.count(), max_bits))
    rooted = distinct.join(components(links).withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = rooted.join(low, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "key")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the row in it whose doc_id
    is the component's.  Equal rows count as one; of rows without an id, those in
    a component that has one go, and equal ones of the others count as one.
    The texts move once, to meet the ids that stay; only rows of a repeated id
    are compared whole."""
    found = _linked(docs, shingle, max_bits)
    rows = cut(found.groupBy(F.struct("doc_id", "key").alias("__row")).agg(
        F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("__keep"), F.count(F.lit(1)).alias("__n")).where("__keep"))
    row = F.struct(F.col("doc_id"), text_key("text").alias("key"))  # in a struct, null equals null
    of = lambda n: docs.join(rows.where(n).select("__row"), row == F.col("__row"), "left_semi")
    return of("__n = 1").unionByName(of("__n > 1").dropDuplicates(["doc_id", "text"]))
