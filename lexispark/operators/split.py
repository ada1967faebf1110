"""Exact, repeatable splits (U2, U3, Q8, Q9) and the leak report (U4).

Rows are ordered by ``md5(seed-id)``; the test part is the first
``ceil(p*n)`` rows (per stratum if asked).  Instead of ranking every row,
the k-th smallest key of each stratum is found from a histogram of the keys'
leading hex digits (map-side counts), a running sum over it, and a rank inside
the one bucket that holds the boundary.  All of it stays in tables with a row
a stratum or a bucket, whatever their number; the split itself is a comparison
with the stratum's threshold."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .labels import attach
from .rank import hash_key, hex_bucket

HIST_BITS = 16


def thresholds(df: DataFrame, key: str, p: float, strata: list[str]) -> DataFrame:
    """(*strata, _thr): the largest key inside the first ceil(p*n) rows of
    each stratum (no row where that count is 0).  Rows without a key aren't
    counted."""
    b = df.where(F.col(key).isNotNull()).select(*strata, key, hex_bucket(F.col(key), HIST_BITS).alias("_b"))
    hist = b.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*strata)  # a stratum has 2**HIST_BITS buckets at most
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    k = F.ceil(F.lit(p) * F.sum("_c").over(whole))
    cum = hist.withColumn("_k", k).withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    bound = cum.where((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_before") + F.col("_c"))).select(
        *[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)], F.col("_b").alias("_bb"),
        (F.col("_k") - F.col("_before")).alias("_r"))
    same = F.col("_b") == F.col("_bb")
    for i, s in enumerate(strata):
        same = same & F.col(s).eqNullSafe(F.col(f"_s{i}"))
    edge = b.join(bound, same).select(*strata, "_b", key, "_r")
    place = F.row_number().over(Window.partitionBy(*strata, "_b").orderBy(key))
    return edge.withColumn("_p", place).where(F.col("_p") == F.col("_r")).select(*strata, F.col(key).alias("_thr"))


def flag_first(df: DataFrame, key: str, p: float, strata: list[str], out: str) -> DataFrame:
    """``df`` with boolean ``out``: inside the first ceil(p*n) rows of the
    stratum."""
    thr = thresholds(df, key, p, strata)
    if not strata:
        row = thr.first()
        return df.withColumn(out, F.lit(False) if row is None else F.coalesce(F.col(key) <= F.lit(row["_thr"]), F.lit(False)))
    flagged = attach(df, thr, strata)
    return flagged.withColumn(out, F.coalesce(F.col(key) <= F.col("_thr"), F.lit(False))).drop("_thr")


def exact_split(df: DataFrame, id_col: str = "doc_id", test_p: float = 0.1,
                test_seed="1", valid_p: float = 0.15, valid_seed="15",
                stratify: str | None = None) -> DataFrame:
    """Adds ``split`` in {train, valid, test}: test = first ceil(test_p*n)
    by md5(test_seed-id); valid = first ceil(valid_p*n_rest) of the rest by
    md5(valid_seed-id).  ``stratify`` applies the counts per class.  Rows
    without an id have no place in that order: they aren't counted in n and go
    to train; rows that repeat an id go to one part."""
    if test_seed is None or valid_seed is None:
        raise ValueError("a seed is required")
    strata = [stratify] if stratify else []
    cols = df.columns
    h = df.withColumn("_k1", hash_key(id_col, test_seed)).withColumn("_k2", hash_key(id_col, valid_seed))
    h = flag_first(h, "_k1", test_p, strata, "_test")
    # the rows of the test part have no second key, so they are neither counted nor taken
    h = h.withColumn("_k2", F.when(~F.col("_test"), F.col("_k2")))
    if valid_p > 0:
        thr = thresholds(h, "_k2", valid_p, strata)
        if strata:
            h = attach(h, thr, strata)
        else:
            row = thr.first()
            h = h.withColumn("_thr", F.lit(row["_thr"] if row else None).cast("string"))
    else:
        h = h.withColumn("_thr", F.lit(None).cast("string"))
    split = F.when(F.col("_test"), "test").when(F.col("_k2") <= F.col("_thr"), "valid").otherwise("train")
    return h.withColumn("split", split).select(*cols, "split")


def split_leak_report(df: DataFrame, text_col: str = "text") -> DataFrame:
    """U4: texts shared between splits.  One aggregate keyed by the text's
    md5 (partial aggregation removes duplicates map-side, so a text copied
    into a third of the rows sends one row per task), then a global sum."""
    per_text = (df.groupBy(F.md5(F.col(text_col)).alias("_h"))
                  .agg(*[F.count_if(F.col("split") == s).alias(s) for s in ("train", "valid", "test")]))
    pairs = [("train", "valid"), ("train", "test"), ("valid", "test")]
    aggs = []
    for a, b in pairs:
        both = (F.col(a) > 0) & (F.col(b) > 0)
        aggs += [F.count_if(both).alias(f"{a}_{b}_texts"),
                 F.sum(F.when(both, F.col(b)).otherwise(0)).cast("long").alias(f"{a}_{b}_rows")]
    tot = per_text.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', {a}_{b}_texts, {a}_{b}_rows" for a, b in pairs)
    return tot.selectExpr(f"stack({len(pairs)}, {stack}) AS (split_a, split_b, n_shared_texts, n_leaked_rows)")


# ---- splits that keep groups together ------------------------------------------

def fill_threshold(groups: DataFrame, target: int) -> str:
    """The key up to which whole ``groups`` (key, size), taken in the order of
    their md5 keys, come to no more than ``target`` rows.

    A histogram of the keys' leading digits gives the bucket in which the
    target is passed; only that bucket's groups are put in order.  The result
    need not be a key itself: it is the bucket's prefix if not even its first
    group fits."""
    hist = groups.groupBy(hex_bucket(F.col("key"), HIST_BITS).alias("b")).agg(F.sum("size").alias("c"))
    run = hist.withColumn("upto", F.sum("c").over(Window.orderBy("b")))  # 2**HIST_BITS rows at most
    edge = run.where(F.col("upto") > target).orderBy("b").first()
    if edge is None:
        return "g"  # behind every hexadecimal key
    prefix = f"{edge['b']:0{HIST_BITS // 4}x}"
    own = groups.where(F.col("key").startswith(prefix))
    placed = own.withColumn("upto", F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy("key")) + (edge["upto"] - edge["c"]))
    return placed.where(F.col("upto") <= target).agg(F.max("key")).first()[0] or prefix


def _fill(groups: DataFrame, target: int) -> DataFrame:
    """(h) of the groups that are taken: whole groups in key order as long as
    they fit, then single rows in key order for what is left."""
    first = fill_threshold(groups, target)
    taken = groups.where(F.col("key") <= first)
    rest = groups.where((F.col("key") > first) & (F.col("size") == 1))
    lacking = target - (taken.agg(F.sum("size")).first()[0] or 0)
    second = fill_threshold(rest, lacking)
    return taken.select("h").unionByName(rest.where(F.col("key") <= second).select("h"))


def exact_split_grouped(df: DataFrame, group_col: str = "text", test_p: float = 0.1, test_seed="1",
                        valid_p: float = 0.15, valid_seed="15") -> DataFrame:
    """U2/U3 without a leak: as ``exact_split``, but rows with one value of
    ``group_col`` (null is a value) stay in one part.

    Groups are taken whole in md5(seed-group) order while the part doesn't
    pass ceil(p*n) rows, then single rows fill what is left.  So a part has
    exactly that many rows if there are enough single rows, and lacks less
    than the largest group has if not.  Rows are reduced to their groups'
    sizes before any of it; a group of any size costs a row a task."""
    if test_seed is None or valid_seed is None:
        raise ValueError("a seed is required")
    spark = df.sparkSession
    # a null has a mark of its own, which no md5 is
    h = F.coalesce(F.md5(F.col(group_col).cast("string")), F.lit("null"))
    path = scratch_path(spark, "split_groups")
    df.groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("size")).write.parquet(path)
    groups = spark.read.schema("h string, size long").parquet(path)
    n = groups.agg(F.sum("size")).first()[0] or 0
    keyed = lambda g, seed: g.withColumn("key", F.md5(F.concat(F.lit(f"{seed}-"), "h")))
    test = _fill(keyed(groups, test_seed), math.ceil(test_p * n)).withColumn("split", F.lit("test")).checkpoint()
    left = groups.join(test.select("h"), "h", "left_anti").checkpoint()
    valid = _fill(keyed(left, valid_seed), math.ceil(valid_p * (left.agg(F.sum("size")).first()[0] or 0))).withColumn(
        "split", F.lit("valid"))
    parts = test.unionByName(valid).withColumnRenamed("h", "_h").withColumnRenamed("split", "_part")
    return attach(df.withColumn("_h", h), parts, ["_h"]).select(*df.columns, F.coalesce("_part", F.lit("train")).alias("split"))
