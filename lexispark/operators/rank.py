"""Positional semantics without a single-task global sort.

A global ``row_number()`` over the whole table pulls every row into one
task.  Here ranks are computed in two phases: rows are put into equi-depth
buckets that follow the sort order (hash prefixes for md5 keys, approximate
quantiles for numeric keys), the per-bucket counts (a bounded table) become
offsets, and ``row_number`` runs inside each bucket only."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import read_written, write_table

ROWS_PER_BUCKET = 200_000   # target bucket size of the two-phase rank
MAX_BUCKETS = 65_536


def hash_key(id_col: str, seed) -> F.Column:
    """md5 of ``seed-id``: the same value in Spark and in SQL engines."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def hex_bucket(key: F.Column, bits: int = 16) -> F.Column:
    """Uniform bucket from the leading hex digits of an md5 key."""
    digits = math.ceil(bits / 4)
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


def _bucket_count(n: int) -> int:
    return int(min(MAX_BUCKETS, max(1, n // ROWS_PER_BUCKET)))


def numeric_buckets(df: DataFrame, key: str, out: str = "_bucket") -> DataFrame:
    """Equi-depth range buckets of a numeric key from approximate quantiles
    (one sketch pass); Bucketizer then does a binary search per row."""
    n = df.count()
    b = _bucket_count(n)
    if b <= 1:
        return df.withColumn(out, F.lit(0).cast("long"))
    probs = [i / b for i in range(1, b)]
    qs = sorted(set(df.approxQuantile(key, probs, 1.0 / (4 * b))))
    splits = [-float("inf")] + qs + [float("inf")]
    tmp = f"{out}_k"
    bz = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    # null keys come first, in a bucket of their own
    return (bz.transform(df.withColumn(tmp, F.col(key).cast("double")))
              .drop(tmp).withColumn(out, F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.col(out)).cast("long")))


def rank_in_buckets(df: DataFrame, order: list, bucket: str = "_bucket",
                    out: str = "rn") -> DataFrame:
    """1-based global rank given a bucket column that follows the order.

    Per-bucket counts are collected (at most MAX_BUCKETS rows), turned into
    offsets and broadcast back; the window is partitioned by bucket."""
    counts = df.groupBy(bucket).count().collect()
    if len(counts) > MAX_BUCKETS + 1:
        raise ValueError("too many rank buckets")
    offsets, run = [], 0
    for r in sorted(counts, key=lambda r: (r[0] is None, r[0])):
        offsets.append((r[0], run))
        run += r[1]
    spark = df.sparkSession
    off = spark.createDataFrame(offsets, "_of long, _offset long")
    w = Window.partitionBy(bucket).orderBy(*order)
    return (df.join(F.broadcast(off), F.col(bucket).eqNullSafe(F.col("_of")), "left")
              .withColumn(out, (F.col("_offset") + F.row_number().over(w)).cast("long"))
              .drop("_of", "_offset"))


def global_rank(df: DataFrame, key: str, out: str = "rn") -> DataFrame:
    """1-based rank by a numeric key (ties broken arbitrarily: use a unique key)."""
    return rank_in_buckets(numeric_buckets(df, key), [F.col(key)], out=out).drop("_bucket")


def hash_rank(df: DataFrame, key_col: str, out: str = "rn") -> DataFrame:
    """1-based rank by an md5 hex key; buckets are its leading digits."""
    n = df.count()
    bits = 4 * max(1, min(4, math.ceil(math.log2(max(2, _bucket_count(n))) / 4)))
    b = df.withColumn("_bucket", hex_bucket(F.col(key_col), bits))
    return rank_in_buckets(b, [F.col(key_col)], out=out).drop("_bucket")


def row_slice(df: DataFrame, key: str, start: int, end: int) -> DataFrame:
    """``.loc[start:end]`` by position in ``key`` order, both ends
    included (0-based positions in ``pos``; null keys first).  Of the
    two-phase rank, only the buckets that the slice touches are ranked."""
    if end < start:
        return df.limit(0).withColumn("pos", F.lit(0).cast("long"))
    bucketed = numeric_buckets(df, key)
    touched, before, run = [], 0, 0
    for r in sorted(bucketed.groupBy("_bucket").count().collect()):  # MAX_BUCKETS + 1 rows at most
        if run <= end and run + r["count"] > start:
            before = before if touched else run
            touched.append(r["_bucket"])
        run += r["count"]
    if not touched:
        return df.limit(0).withColumn("pos", F.lit(0).cast("long"))
    own = bucketed.where(F.col("_bucket").between(touched[0], touched[-1]))
    ranked = rank_in_buckets(own, [F.col(key)], out="pos").drop("_bucket")
    return ranked.withColumn("pos", F.col("pos") - 1 + F.lit(before)).where(F.col("pos").between(start, end))


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    """P10: first n rows in key order (a top-k sort: each task keeps n)."""
    top = df.orderBy(F.col(key)).limit(n)
    return top.withColumn("pos", (F.row_number().over(Window.orderBy(F.col(key))) - 1).cast("long"))


def with_chunks(df: DataFrame, key: str, chunk_rows: int = 1000) -> DataFrame:
    """Chunk number = floor((rank-1)/chunk_rows) in key order."""
    r = global_rank(df, key, "_rn")
    return r.withColumn("chunk", F.floor((F.col("_rn") - 1) / chunk_rows).cast("long")).drop("_rn")


def chunked_union(df: DataFrame, key: str, chunk_rows: int = 1000, path: str | None = None) -> DataFrame:
    """Write the chunks, then read the whole directory back as one
    table (each chunk exactly once).  A chunk lies in one file, next to its
    neighbours; the number of files follows the size of the data."""
    path = path or scratch_path(df.sparkSession, "chunks")
    write_table(with_chunks(df, key, chunk_rows).repartitionByRange("chunk").sortWithinPartitions("chunk"), path)
    return read_written(df.sparkSession, path)
