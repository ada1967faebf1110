"""Frequency top-k.

Corpus top-n is ``orderBy(...).limit(n)``, which plans as
TakeOrderedAndProject (each task keeps its own n best, then one merge).
Per-class top-n uses ``row_number() <= n``; Catalyst adds a partial
WindowGroupLimit before the shuffle, so at most n rows per class leave each
task even when one class holds most of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def term_frequencies(tokens: DataFrame, term_col: str = "token",
                     by: list[str] | None = None) -> DataFrame:
    """A4/A5: occurrences per term (optionally per class).  Partial
    aggregation combines map-side, so a hot term sends one row per task."""
    by = by or []
    return tokens.groupBy(*by, term_col).agg(F.count(F.lit(1)).alias("freq"))


def top_n(freqs: DataFrame, n: int, term_col: str = "token") -> DataFrame:
    """``most_common(n)``; ties broken by term (first-seen order of a
    Counter is not reproducible in a distributed run)."""
    top = freqs.orderBy(F.col("freq").desc(), F.col(term_col).asc()).limit(n)
    w = Window.orderBy(F.col("freq").desc(), F.col(term_col).asc())
    # the window runs over at most n rows
    return top.select(F.row_number().over(w).cast("long").alias("rank"), term_col, "freq")


def skip_expr(class_col: str, skips: dict, default: int = 0) -> Column:
    """Per-class offset as a literal lookup (a small fixed table)."""
    if not skips:
        return F.lit(default)
    m = F.create_map(*[x for k, v in skips.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, F.col(class_col)), F.lit(default))


def class_top_n(freqs: DataFrame, class_col: str, n: int, skips: dict | None = None,
                term_col: str = "token", default_skip: int = 0) -> DataFrame:
    """Per class, ranks skip+1 .. n (``most_common(n)[skip:]``)."""
    w = Window.partitionBy(class_col).orderBy(F.col("freq").desc(), F.col(term_col).asc())
    ranked = freqs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return (ranked.where(F.col("_rn") > skip_expr(class_col, skips or {}, default_skip))
                  .select(class_col, F.col("_rn").cast("long").alias("rank"), term_col, "freq"))
