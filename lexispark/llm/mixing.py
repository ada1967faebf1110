"""Operator 13, mixing sources to target weights by entropy balancing
(DataFrame functions only).

Targets: sources share the whole size by their weights, and none gets more
than ``most`` times its own size; what is over goes to the others by weight.
Rates: of all rates r within 0 and ``most`` that meet their source's target
sum(r * size), those closest to 1 in entropy (sum of r log r - r + 1 over the
documents) are exponential tilts r = min(most, exp(lambda * size)).  The
multiplier of each source minimises the convex dual, whose slope is
sum(r * size) - target.  Newton steps find it for all sources at once: each
step is one aggregation of the table of (source, size, documents), in which a
rate only depends on the row; a step that leaves the bracket known so far is
replaced by its middle.

Rounding: in each source, documents in order of size (largest first) get the
copies by which the running sum of rates, cut to whole copies, grows, so a
document gets its rate rounded up or down, and a source's taken size misses its
target by less than its largest document.  The sum begins at that one of
``OFFSETS`` fractions of a copy that comes nearest to the target.  Documents of
one size take turns by the hash of their ids.

Rates are whole multiples of 1/``UNIT`` and all sums are exact decimals, so
the result doesn't depend on partitions or on the order in which rows arrive.
A source with most of the rows is one row a distinct size from the first
aggregation on; its documents are numbered by ranges (``positions``).

Defined results: null text has size 0, and documents of size 0 take 0; a null
source is a source of its own, the last one; a source without words has target
0; a null id is an id of its own; rows that repeat an id are documents of their
own; of equal rows, which one takes more is arbitrary; empty input gives an
empty result.  Only the named columns are read, so others may have any
name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.labels import attach
from .common import cut, written
from .positions import positions

SPACE = " \t\n\x0b\x0c\r"
UNIT_BITS = 24
UNIT = 1 << UNIT_BITS
OFFSETS = 32
WEIGHTS = (5, 2, 1)
STEPS = 100  # halving a bracket of doubles ends before


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not white space."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"[\x20\x09-\x0D]+", -1))).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, most: int = 3) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.  The weights repeat
    over the sources by code point, null last."""
    placed = cut(positions(sources, [], [F.col("source").asc_nulls_last()], "k").select(
        "source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                              (F.col("k") % len(weights) + 1).cast("int")).alias("weight")))
    ceiling = most * F.col("source_size")
    level, capped = 0.0, -1
    while True:  # the sources at their ceiling only grow in number
        full = ceiling <= level * F.col("weight")
        r = placed.agg(F.count_if(full), F.sum(F.when(full, ceiling)), F.sum(F.when(~full, F.col("weight"))),
                       F.sum("source_size")).first()
        if r[0] == capped or not r[2]:
            return placed.select("source", "source_size", F.when(full, ceiling.cast("double")).otherwise(
                level * F.col("weight")).alias("target"))
        capped, level = r[0], (r[3] - (r[1] or 0)) / r[2]


def _rate(tilt: Column, size: Column, most: int) -> Column:
    """The rate in units of 1/UNIT."""
    return F.round(F.least(F.lit(float(most)), F.exp(tilt * size)) * UNIT).cast("long")


def _copies(start: Column, more: Column) -> Column:
    """Whole copies by which a running sum of units grows from ``start``."""
    return F.shiftright(start + more, UNIT_BITS) - F.shiftright(start, UNIT_BITS)


def _exact(c: Column, digits: int = 19) -> Column:
    return c.cast(f"decimal({digits},0)")


def tilts(cells: DataFrame, most: int = 3) -> DataFrame:
    """``cells`` (key, target, source_size, size, n), sizes above 0, with the
    ``rate`` of each row (whole multiples of 1/UNIT)."""
    cells = cut(cells.repartition("key"))
    least = cells.groupBy("key").agg(F.min("size").alias("low"), F.first("target").alias("target"),
                                     F.first("source_size").alias("whole"))
    full = F.col("target") >= most * F.col("whole")
    side = F.col("target") > F.col("whole")
    edge = F.when(side, F.log(F.lit(float(most)))).otherwise(F.log(F.col("target") / F.col("whole"))) / F.col("low")
    state = cut(least.select(
        "key", "target", F.when(full, 2 * edge).otherwise(0.0).alias("tilt"), F.least(edge, F.lit(0.0)).alias("lo"),
        F.greatest(edge, F.lit(0.0)).alias("hi"), (full | (F.col("target") == F.col("whole"))).alias("done")))
    for _ in range(STEPS):
        open_ = state.where("not done")
        if open_.isEmpty():
            break
        tokens = _exact(F.col("n") * F.col("size"))
        rate = _rate(F.col("tilt"), F.col("size"), most)
        sums = (cells.select("key", "size", "n").join(open_, "key").withColumn("rate", rate)
                .groupBy("key", "target", "tilt", "lo", "hi")
                .agg((F.sum(tokens * _exact(F.col("rate"), 9)) / UNIT).cast("double").alias("taken"),
                     (F.sum(F.when(F.col("rate") < most * UNIT, tokens * _exact(F.col("size"), 9) * _exact(F.col("rate"), 9)))
                      / UNIT).cast("double").alias("slope")))
        gap = F.col("taken") - F.col("target")
        sums = sums.withColumn("lo", F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo"))).withColumn(
            "hi", F.when(gap > 0, F.col("tilt")).otherwise(F.col("hi")))
        newton, middle = F.col("tilt") - gap / F.col("slope"), (F.col("lo") + F.col("hi")) / 2
        inside = F.coalesce((newton > F.col("lo")) & (newton < F.col("hi")), F.lit(False))
        step = F.when(inside, newton).otherwise(middle)
        near = (F.abs(gap) <= F.greatest(F.lit(0.5), F.col("target") * 1e-9)) | (step == F.col("tilt"))
        moved = sums.select("key", "target", F.when(near, F.col("tilt")).otherwise(step).alias("tilt"), "lo", "hi", near.alias("done"))
        state = cut(moved.unionByName(state.where("done")))
    return cells.join(state.select("key", "tilt"), "key").withColumn("rate", _rate(F.col("tilt"), F.col("size"), most)).drop("tilt")


def mix(docs: DataFrame, weights=WEIGHTS, most: int = 3, text: str = "text", doc_id: str = "doc_id",
        source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) of
    every row."""
    if most * len(weights) < 1 or min(weights) <= 0:
        raise ValueError("weights are above 0 and most is 1 or more")
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    sized = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
                    .withColumn("key", key), "mix_sizes")
    counted = cut(sized.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = targets(cut(counted.groupBy("key", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))), weights, most)
    sources = cut(sources.withColumn("key", key))
    cells = tilts(counted.where("size > 0").select("key", "size", "n").join(
        sources.select("key", "target", "source_size"), "key"), most)
    # the running sum of rates before a cell, of which only the part of a copy matters
    before = Window.partitionBy("key").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    run = F.coalesce(F.sum(_exact(F.col("n")) * _exact(F.col("rate"), 9)).over(before), F.lit(0).cast("decimal(38,0)"))
    based = cut(cells.withColumn("base", F.pmod(run, F.lit(UNIT).cast("decimal(38,0)")).cast("long")))
    # of OFFSETS places to begin rounding at, the one that brings a source nearest to its target
    words = [F.sum(F.col("size") * _copies(F.col("base") + j * UNIT // OFFSETS, F.col("n") * F.col("rate"))) for j in range(OFFSETS)]
    chosen = based.groupBy("key").agg(F.array_min(F.array(*[
        F.struct(F.abs(w - F.first("target")).alias("gap"), F.lit(j * UNIT // OFFSETS).alias("offset"))
        for j, w in enumerate(words)])).alias("best"))
    dim = based.join(chosen, "key").select("key", "size", "rate", (F.col("base") + F.col("best.offset")).alias("start"))
    all_cells = counted.select("key", "size").join(sources.select("key", "source_size", "target"), "key").join(dim, ["key", "size"], "left")
    placed = positions(sized, ["key", "size"], [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")], "k")
    copies = _copies(F.col("start") + F.col("k") * F.col("rate"), F.col("rate"))
    return attach(placed, all_cells, ["key", "size"]).withColumn("copies", F.coalesce(copies, F.lit(0).cast("long"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("rate") / UNIT).alias("rate"), "copies",
        (F.col("copies") * F.col("size")).alias("taken"))
