"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, scratch_path

TEXT_ROWS = 1_000
CHUNK_CHARS = 1 << 20  # code points that a vectorised step holds at a time


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, whose texts are about to go to Python: a batch gets TEXT_ROWS
    rows at most, since texts are long and both sides hold a batch whole.  The
    session's setting is only ever lowered."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= TEXT_ROWS:
        conf.set(key, str(TEXT_ROWS))
    return df


def give_back() -> None:
    """Called in a task that is done with large arrays: hands the freed memory
    back, which an idle Python worker would otherwise keep."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the shared folder, so a lost
    executor costs a read of its files and no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """The table written once to the shared folder and read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_chunks(lengths, limit: int = CHUNK_CHARS):
    """Ranges ``(start, end)`` of consecutive rows whose lengths add up to
    about ``limit``; a longer row is a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield start, len(lengths)
