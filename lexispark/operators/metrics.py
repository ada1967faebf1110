"""Scores, losses and training histories.

Logit vectors stay arrays and are reduced with higher-order functions
inside the row; histories are two-level aggregates that shrink the data to
one row per (epoch, batch) before anything else happens."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def centroids(df: DataFrame, vec_col: str, label_col: str) -> list[tuple]:
    """(class, mean vector) of each class, in class order: one value a class
    and dimension reaches the driver."""
    cells = df.where(F.col(label_col).isNotNull()).select(F.col(label_col).alias("c"), F.posexplode(vec_col).alias("i", "x"))
    means = cells.groupBy("c", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    rows = means.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("v")).orderBy("c").collect()
    return [(r["c"], [x["m"] for x in r["v"]]) for r in rows]


def logits(vec_col: str, means: list[tuple]) -> F.Column:
    """Scores of a vector: its dot product with each class's mean."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    dot = lambda m: F.aggregate(F.zip_with(v, F.array(*[F.lit(x) for x in m]), lambda x, y: x * y),
                                F.lit(0.0), lambda s, x: s + x)
    return F.array(*[dot(m) for _, m in means])


def argmax(arr: F.Column) -> F.Column:
    """0-based index of the largest value, lowest index on ties."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def log_sum_exp(arr: F.Column) -> F.Column:
    m = F.array_max(arr)
    s = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.exp(x - m))
    return m + F.log(s)


def cross_entropy(arr: F.Column, label: F.Column) -> F.Column:
    """A12 per row: logsumexp(logits) - logits[label] (label is 0-based)."""
    return log_sum_exp(arr) - F.try_element_at(arr, label + 1)


def epoch_history(df: DataFrame, epoch: F.Column, batch: F.Column, loss: F.Column,
                  split: F.Column | None = None) -> DataFrame:
    """Epoch loss = mean of batch means (a short last batch counts as a
    whole batch).  (epoch, split, loss)."""
    s = split if split is not None else F.lit("train")
    per_batch = (df.select(epoch.alias("epoch"), s.alias("split"), batch.alias("batch"), loss.alias("loss"))
                   .groupBy("epoch", "split", "batch").agg(F.avg("loss").alias("batch_loss")))
    return per_batch.groupBy("epoch", "split").agg(F.avg("batch_loss").alias("loss"))


def best_checkpoint(per_epoch: DataFrame, metric: str = "metric", seed: float = 0.0) -> DataFrame:
    """An epoch is saved when its metric beats the best so far, seeded
    with ``seed`` (strictly greater).  The window runs over the per-epoch
    table (one row per epoch, bounded by the length of training)."""
    w = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.greatest(F.lit(seed), F.coalesce(F.max(metric).over(w), F.lit(seed)))
    return (per_epoch.withColumn("best_before", best_before)
                     .withColumn("saved", F.col(metric) > F.col("best_before")))
