"""Counts and null checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_distribution(df: DataFrame, class_col: str, text_col: str = "text") -> DataFrame:
    """A1/A3: documents and distinct texts per class, most frequent first.

    One partial+final hash aggregate; the distinct count is on the md5 of
    the text so the shuffle carries 32-byte keys, not whole texts."""
    return (df.groupBy(F.col(class_col).alias("class"))
              .agg(F.count(F.lit(1)).alias("n_docs"),
                   F.countDistinct(F.md5(F.col(text_col))).alias("n_distinct_texts"))
              .orderBy(F.desc("n_docs"), "class"))


def class_pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """A2: ``value_counts`` over two columns."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def null_report(df: DataFrame) -> DataFrame:
    """Per column whether it holds nulls and how many, in one scan."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(f"__{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', __{i}" for i, c in enumerate(cols))
    return (agg.selectExpr("__n AS n_rows", f"stack({len(cols)}, {stack}) AS (column_name, n_null)")
               .select("column_name", "n_rows", F.coalesce("n_null", F.lit(0)).cast("long").alias("n_null"))
               .withColumn("has_null", F.col("n_null") > 0))
