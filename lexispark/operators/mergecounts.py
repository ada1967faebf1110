"""Mergeable term counts (X2 with A4-A6): a new batch of documents doesn't
recount the corpus.

Each batch's counts are a committed table of their own (``store``).  The total
is their sum; a batch that is taken back is subtracted.  ``compact`` replaces
the sum so far by one table, after which a total reads that table and the
batches added or taken back since.  A batch has a name, and adding a name that
is there changes nothing, so a job that is run again counts once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import commits, load_version, save_version


def _state(spark: SparkSession, path: str):
    """(live batches, version of the last compaction, batches in it, version
    of each batch's table)."""
    live, inside, base, table = set(), set(), None, {}
    for version, info, _ in commits(spark, path):
        if info["kind"] == "add":
            live.add(info["batch"])
            table[info["batch"]] = version
        elif info["kind"] == "remove":
            live.discard(info["batch"])
        else:
            base, inside = version, {(b, v) for b, v in info["batches"]}
    return live, base, inside, table


def batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches that are counted."""
    return sorted(_state(spark, path)[0])


def add_batch(path: str, batch: str, tokens: DataFrame, term_col: str = "token", by: list[str] | None = None) -> bool:
    """Counts a batch's tokens and commits them; False if it is there already."""
    spark = tokens.sparkSession
    if batch in _state(spark, path)[0]:
        return False
    counts = tokens.groupBy(*(by or []), term_col).agg(F.count(F.lit(1)).alias("freq"))
    save_version(spark, path, {"counts": counts}, {"kind": "add", "batch": batch})
    return True


def remove_batch(spark: SparkSession, path: str, batch: str) -> bool:
    """Takes a batch back; False if it isn't there."""
    if batch not in _state(spark, path)[0]:
        return False
    save_version(spark, path, {}, {"kind": "remove", "batch": batch})
    return True


def totals(spark: SparkSession, path: str) -> DataFrame:
    """(*by, term, freq) over the batches that are counted."""
    live, base, inside, table = _state(spark, path)
    now = {(b, table[b]) for b in live}
    parts = [(base, 1)] if base is not None else []
    parts += [(v, 1) for _, v in sorted(now - inside)] + [(v, -1) for _, v in sorted(inside - now)]
    if not parts:
        raise ValueError(f"no batch was ever counted in {path}" if not table else "every batch was taken back")
    both = None
    for version, sign in parts:
        t = load_version(spark, path, version)[0]["counts"]
        t = t.withColumn("freq", F.col("freq") * sign)
        both = t if both is None else both.unionByName(t)
    keys = [c for c in both.columns if c != "freq"]
    return both.groupBy(*keys).agg(F.sum("freq").alias("freq")).where("freq > 0")


def compact(spark: SparkSession, path: str) -> int:
    """Commits the total as one table; returns its version."""
    live, _, _, table = _state(spark, path)
    return save_version(spark, path, {"counts": totals(spark, path)},
                        {"kind": "compact", "batches": sorted([b, table[b]] for b in live)})
