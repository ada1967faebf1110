"""Scans and sinks.

Tables are read with an explicit column list so Catalyst prunes the
parquet scan; CSV passages are read with a fixed schema (no inference)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

NULL_MARK = "\\N"
PARTITION_BYTES = 2 << 20  # of the read files that a shuffle partition stands for
JOINED_BYTES = 8 << 20  # of a shuffle, compressed, that AQE may put into one task
PASSAGE_SCHEMA = T.StructType([
    T.StructField("discourse_text", T.StringType(), True),
    T.StructField("discourse_type", T.StringType(), True),
])


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_passages_csv(spark: SparkSession, path: str,
                      schema: T.StructType = PASSAGE_SCHEMA,
                      id_col: str = "doc_id") -> DataFrame:
    """Quoted multi-line CSV with a header and a fixed schema.

    A file with an id column in ``schema`` keeps it.  Otherwise the id is a
    hash of the file's path, the row's content and its number among the equal
    rows of that file: it doesn't change when other files land or the scan is
    cut differently.  Spark has no zip codec: land the file unpacked or
    gzip-compressed."""
    df = _csv_reader(spark, schema).csv(path)
    if id_col in schema.fieldNames():
        return df
    content = F.md5(F.to_json(F.struct(*[F.col(c) for c in schema.fieldNames()])))
    keyed = df.select("*", F.col("_metadata.file_path").alias("_file"), content.alias("_row"))
    same = Window.partitionBy("_file", "_row").orderBy(F.lit(0))  # equal rows: any order gives the same table
    return keyed.select(F.md5(F.concat_ws("|", "_file", "_row", F.row_number().over(same).cast("string"))).alias(id_col),
                        *schema.fieldNames())


RECORD = "_record"  # column of a record that doesn't fit the schema


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) records of CSV files, plain or
    gzip-compressed, each parsed once and written down.

    ``accepted`` has the schema's columns and ``file``; ``rejected`` has
    (file, record, reason, column, value): the raw record, and ``columns`` if
    it has more or fewer fields than the schema, else ``type`` with the first
    field that its column can't hold.  Every record is in one of the two.  A
    quote that is never closed takes the rest of its file into one record."""
    raw = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    reader = _csv_reader(spark, raw).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    folder = scratch_path(spark, "ingest")
    (reader.option("nullValue", NULL_MARK).csv(path).withColumn("file", F.col("_metadata.file_path"))
     .withColumn("ok", F.col(RECORD).isNull()).write.partitionBy("ok").parquet(folder))
    parsed = spark.read.schema(T.StructType([*raw.fields, T.StructField("file", T.StringType()),
                                             T.StructField("ok", T.BooleanType())])).parquet(folder)
    accepted = parsed.where("ok").select(*schema.fieldNames(), "file")
    strings = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields))]
                           + [T.StructField(RECORD, T.StringType())])
    again = F.from_csv(RECORD, F.lit(strings.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")),
                       {"escape": '"', "columnNameOfCorruptRecord": RECORD, "nullValue": NULL_MARK, "multiLine": "true"})
    x = F.col("x")
    wrong = [F.when(x[f"c{i}"].isNotNull() & x[f"c{i}"].try_cast(f.dataType).isNull(),
                    F.struct(F.lit(f.name).alias("column"), x[f"c{i}"].alias("value")))
             for i, f in enumerate(schema.fields)]
    short = x[RECORD].isNotNull() | F.coalesce(*wrong).isNull()
    rejected = parsed.where("not ok").select("file", F.col(RECORD).alias("record"), again.alias("x")).select(
        "file", "record", F.when(short, "columns").otherwise("type").alias("reason"),
        *[F.when(~short, F.coalesce(*wrong)[c]).alias(c) for c in ("column", "value")])
    return accepted, rejected


def record_counts(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """(file, accepted, rejected): the accounts of an ingestion."""
    both = accepted.select("file", F.lit(1).alias("a"), F.lit(0).alias("r")).unionByName(
        rejected.select("file", F.lit(0).alias("a"), F.lit(1).alias("r")))
    return both.groupBy("file").agg(F.sum("a").alias("accepted"), F.sum("r").alias("rejected"))


def _csv_reader(spark: SparkSession, schema: T.StructType):
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
            .option("lineSep", "\n").option("emptyValue", ""))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """Parquet (default) or CSV with a header; never writes an index.  CSV
    keeps edge spaces, line ends and quotes; null is written as NULL_MARK, so
    that it differs from an empty text."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        (w.option("header", True).option("escape", '"').option("lineSep", "\n").option("emptyValue", '""').option("nullValue", NULL_MARK)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        w.format(fmt).save(path)
    return path


def read_written(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """The written table; CSV has no types, so it needs the schema."""
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table is read with its schema")
        return _csv_reader(spark, schema).option("nullValue", NULL_MARK).csv(path)
    return spark.read.format(fmt).load(path)


def _bytes(size: str) -> int:
    """A size as Spark's settings write it: 8m, 64MB, 1048576b."""
    text = size.strip().lower().removesuffix("b")
    unit = "kmgtp".find(text[-1]) + 1
    return int(text[:-1] if unit else text) << 10 * unit


def sized_partitions(df: DataFrame) -> int:
    """Shuffle partitions for a job over the files of the scan ``df``: the
    session's number, which is raised to one for every PARTITION_BYTES.

    With a fixed number a task's share, and what it sorts or counts in memory,
    would grow with the input; where that makes too many, AQE puts them
    together again, up to JOINED_BYTES.  By AQE's own limit (64 MB) a task
    sorts several GB of rows once the input is large enough to reach it."""
    spark = df.sparkSession
    held = 0
    if df.inputFiles():
        files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
        held = files.agg(F.sum("file_size")).first()[0] or 0
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if _bytes(spark.conf.get(advised)) > JOINED_BYTES:
        spark.conf.set(advised, JOINED_BYTES)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if math.ceil(held / PARTITION_BYTES) > n:
        n = math.ceil(held / PARTITION_BYTES)
        spark.conf.set("spark.sql.shuffle.partitions", n)
    return n


def spread(df: DataFrame, key: str | None = None, target: int | None = None) -> DataFrame:
    """Make sure the scan feeds enough tasks (``sized_partitions``).

    A table stored as a few large row groups arrives in a few partitions and
    every per-row text step would run in those few tasks.  Only then is it
    hash-repartitioned (by ``key``, so later per-key aggregates and windows
    reuse the partitioning).  A scan of many files is left alone."""
    target = target or sized_partitions(df)
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
