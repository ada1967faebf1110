"""Places of rows in an order, without a task that sorts a whole group.

The rows are dealt to ranges of the order, so a group of any size lies in as
many ranges as it needs.  Within a range rows are numbered by a window; a group
that began in an earlier range gets the number of its rows there added.  Only
a range's first group can have begun earlier, so that table has fewer rows
than there are ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut


def positions(rows: DataFrame, by: list[str], order: list[Column], out: str = "pos") -> DataFrame:
    """``rows`` with ``out``: the place from 0 of each row among those equal
    in ``by`` (null equals null), in the given order.  Rows that tie in all of
    it follow each other in any order; they don't crowd a range.  ``rows``
    should be a written or checkpointed table, since it is read twice."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    ranged = cut(tied.repartitionByRange(parts, *by, *order, "__tie").withColumn("__part", F.spark_partition_id()))
    counts = ranged.groupBy("__part", *by).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    begun = (counts.withColumn("__before", F.sum("__n").over(before)).where("__before is not null")
             .select(F.col("__part").alias("__p"), "__before", *[F.col(c).alias(f"__by_{c}") for c in by]))
    same = F.col("__part") == F.col("__p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    place = F.row_number().over(Window.partitionBy("__part", *by).orderBy(*order, "__tie"))
    numbered = ranged.withColumn(out, place - 1)
    return (numbered.join(F.broadcast(begun), same, "left")  # fewer rows than ranges
            .withColumn(out, (F.col(out) + F.coalesce("__before", F.lit(0))).cast("long")).select(*rows.columns, out))
