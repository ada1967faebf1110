"""Documents dealt to blocks of bounded size by a hash, for operators that
look up what a block holds (its n-grams, its words) in a table partitioned by
hash and bring the answers back to the block: each distinct thing crosses the
network once a block instead of once a place."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 24_000_000


def in_blocks(docs: DataFrame, doc_id: str, text: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(block, doc_id, t) of every row, hash-partitioned by block; a block
    has about ``block_chars`` characters (or one longer text)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    return rows.select(F.pmod(F.xxhash64("doc_id", "t"), F.lit(blocks)).cast("int").alias("block"),
                       "doc_id", "t").repartition("block")
