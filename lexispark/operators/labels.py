"""Label encoding (J1): a class dimension as a table, and a left join to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000  # counted rows of a dimension up to which it is broadcast
SALTS = 16


def attach(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` left-joined (null-safe) to a dimension with one row a key.

    The dimension is computed once and counted: within BROADCAST_ROWS it is
    broadcast, so the rows of ``df`` don't move; a larger one is joined by a
    shuffle, the rows of each key dealt over SALTS keys."""
    dim = dim.checkpoint()
    named = dim.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in dim.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    if dim.count() <= BROADCAST_ROWS:
        out = df.join(F.broadcast(named), same, "left")
    else:
        salted = named.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = df.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        out = left.join(salted, same & (F.col("__part") == F.col("__salt")), "left").drop("__part", "__salt")
    return out.drop(*[f"__{k}" for k in keys])


def class_dimension(df: DataFrame, class_col: str, classes: list | None = None, label_col: str = "label") -> DataFrame:
    """(class_col, label): label ids from 0 in alphabetical order (the
    reference's ``enumerate(set(...))`` order changes per process), or in the
    order of ``classes``.  The window runs over distinct classes only."""
    if classes is not None:
        return df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(classes)], f"{class_col} string, {label_col} int")
    found = df.select(class_col).where(F.col(class_col).isNotNull()).distinct()
    return found.withColumn(label_col, (F.row_number().over(Window.orderBy(class_col)) - 1).cast("int"))


def label_encode(df: DataFrame, class_col: str, classes: list | None = None,
                 label_col: str = "label") -> DataFrame:
    """``df`` with the label id; classes that the dimension doesn't have, and
    null, get null."""
    return attach(df, class_dimension(df, class_col, classes, label_col), [class_col])
