"""Chunked work that can be stopped and resumed.

Rows are numbered once by key and written in the order of their chunks; that
plan is committed before any work.  Work then goes in the chunks' order,
``at_once`` of them in a job: a job reads the files that its run of chunks
lies in, by their smallest and largest chunk, applies the given function and
commits its result as a version (``store``).  After a crash only chunks that
no commit names are computed; what a dead job has written isn't read, so the
result has each chunk exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .rank import with_chunks
from .store import commits, load_version, save_version

AT_ONCE = 16
JOBS = 32


def plan_chunks(df: DataFrame, key: str, path: str, chunk_rows: int = 1000) -> list[int]:
    """Deals ``df`` to chunks under ``path``, or finds the plan that is there;
    the chunks' numbers."""
    spark = df.sparkSession
    plan = f"{path}/plan"
    if not commits(spark, plan):
        dealt = with_chunks(df, key, chunk_rows).withColumn("chunk", F.col("chunk").cast("long"))
        save_version(spark, plan, {"rows": dealt.repartitionByRange("chunk").sortWithinPartitions("chunk"), "chunks": dealt.select("chunk").distinct()},
                     {"chunk_rows": chunk_rows})
    tables, _ = load_version(spark, plan)
    return sorted(r["chunk"] for r in tables["chunks"].collect())  # a number a chunk


def done_chunks(spark: SparkSession, path: str) -> list[int]:
    return sorted(c for _, info, _ in commits(spark, f"{path}/done") for c in info["chunks"])


def run_chunks(df: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], path: str, chunk_rows: int = 1000,
               at_once: int | None = None, stop_after: int | None = None) -> DataFrame | None:
    """``work`` applied to each chunk of ``df`` that isn't done yet; the union
    of all chunks' results, or None if ``stop_after`` jobs ended it early.
    ``work`` gets the chunk number as column ``chunk`` and has to keep it.
    Without ``at_once`` a job takes AT_ONCE chunks, or as many as end the run
    after JOBS jobs."""
    spark = df.sparkSession
    chunks = plan_chunks(df, key, path, chunk_rows)
    rows = load_version(spark, f"{path}/plan")[0]["rows"]
    done = set(done_chunks(spark, path))
    todo = [c for c in chunks if c not in done]
    at_once = at_once or max(AT_ONCE, -(-len(todo) // JOBS))
    waves = [todo[i:i + at_once] for i in range(0, len(todo), at_once)]
    for wave in waves if stop_after is None else waves[:stop_after]:
        own = F.col("chunk").between(wave[0], wave[-1]) & ~F.col("chunk").isin([c for c in done if wave[0] < c < wave[-1]])
        save_version(spark, f"{path}/done", {"rows": work(rows.where(own))}, {"chunks": wave})
    if stop_after is not None and stop_after < len(waves):
        return None
    found = commits(spark, f"{path}/done")
    if not found:
        return work(rows)
    schema = load_version(spark, f"{path}/done")[0]["rows"].schema
    return spark.read.schema(schema).parquet(*[f"{folder}/rows" for _, _, folder in found])
