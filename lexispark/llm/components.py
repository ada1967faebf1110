"""Connected components of a link table, by alternating large and small stars.

Each round is two groupings by node with map-side minima; the link table stays
linear in the links, nothing reaches the driver but a count and a checksum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, root): the smallest node that each linked
    node reaches.  Nodes without a link to another node have no row."""
    e = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        e = cut(small.where("a <> b").distinct())
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == last:
            return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        last = now
