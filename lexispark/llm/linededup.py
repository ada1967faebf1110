"""Operator 8, line dedup by site-relative frequency.

For each host, a line's ratio is the number of the host's pages that contain
it divided by the number of the host's pages; lines above ``max_ratio`` (and
on ``min_pages`` pages or more) are boilerplate and leave every page of that
host.  Only a line's 64-bit hash is shuffled, once for each page and line, and
summed up before the shuffle, so a host with a third of all pages costs no
task more than its partial counts.

Defined results: null text stays null (its row counts as a page without
lines); a null host is one host of its own; blank lines are never boilerplate;
repeated rows count as pages of their own; a line exactly at the ratio stays
(a tie drops nothing); texts of any length are read whole; empty input gives
empty output.  A
text whose lines all go becomes empty; its row stays.  With ``by_text`` a page
is a distinct whole text of the host, so that copies of one page, whatever
their number, don't make its lines boilerplate.  The documents' columns
are kept and only ``text`` and ``n_chars`` change, so other columns may have
any name that doesn't begin with two underscores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

BROADCAST_HOSTS = 20_000  # rows (hosts) of the boilerplate table that are broadcast
SALTS = 32


def boilerplate(docs: DataFrame, max_ratio: float = 0.05, min_pages: int = 5,
                host: str = "source", text: str = "text", by_text: bool = False) -> DataFrame:
    """(host, line_hash, pages, ratio) of the lines above the ratio.  A host's
    ratios add up to its mean number of lines a page, so it has at most that
    number divided by ``max_ratio`` of them."""
    rows = docs.select(F.col(host).alias("host"), F.col(text).alias("t"))
    hashes = F.array_distinct(F.transform(
        F.filter(F.split("t", "\n", -1), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))
    if by_text:
        rows = rows.select("host", F.md5("t").alias("k"), hashes.alias("h")).groupBy("host", "k").agg(F.first("h").alias("h"))
        hashes = F.col("h")
    pages = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    lines = rows.select("host", F.explode(hashes).alias("line_hash"))
    seen = lines.groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    return (seen.join(pages, seen.host.eqNullSafe(pages.host)).select(
        seen.host, "line_hash", "pages", (F.col("pages") / F.col("host_pages")).alias("ratio"))
        .where(F.col("ratio") > max_ratio))


def drop_boilerplate(docs: DataFrame, max_ratio: float = 0.05, min_pages: int = 5,
                     host: str = "source", text: str = "text", by_text: bool = False) -> DataFrame:
    """``docs`` without boilerplate lines, ``n_chars`` (if there is one)
    counted anew, and ``n_lines``, ``n_dropped`` of each row."""
    found = cut(boilerplate(docs, max_ratio, min_pages, host, text, by_text).groupBy("host").agg(
        F.collect_set("line_hash").alias("__drop")))
    hosts = found.count()
    if hosts <= BROADCAST_HOSTS:
        both = docs.join(F.broadcast(found.withColumnRenamed("host", "__host")),
                         F.col("__host").eqNullSafe(F.col(host)), "left")
    else:  # many hosts: a shuffled join, the pages of a host dealt over SALTS keys
        right = found.withColumnRenamed("host", "__host").withColumn(
            "__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = docs.withColumn("__s", F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int"))
        both = left.join(right, F.col("__host").eqNullSafe(F.col(host)) & (F.col("__s") == F.col("__salt")), "left")
    both = both.withColumn("__lines", F.split(text, "\n", -1)).withColumn(
        "__kept", F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(F.filter(
            "__lines", lambda x: ~F.array_contains(F.col("__drop"), F.xxhash64(x)))))
    new = {text: F.array_join("__kept", "\n"),
           "n_lines": F.coalesce(F.size("__lines"), F.lit(0)).cast("long"),
           "n_dropped": F.coalesce(F.size("__lines") - F.size("__kept"), F.lit(0)).cast("long")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(F.array_join("__kept", "\n")).cast("long")
    kept = [c for c in docs.columns if c not in new]
    out = both.select(*kept, *[v.alias(k) for k, v in new.items()])
    return out.select(*docs.columns, *[c for c in ("n_lines", "n_dropped") if c not in docs.columns])
