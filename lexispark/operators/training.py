"""Training a classification head by epochs.

The head is a two-layer network (linear, GELU, linear) over vectors that are
already there.  Rows are dealt once to mini-batches by a hash of their ids; the
order of the batches changes with the epoch.  Each step needs the one before
it.  So an epoch's rows are put in the order of its batches, in runs of
RUN_ROWS rows, and a job takes the steps of one run in one task, from the
parameters that the run before it has left; only these, as large as the head
and not as the data, go through the driver.  Batches of over ROWS_PER_TASK rows
have a folder each, and a step is a job: a gradient summed inside the tasks,
then over the tasks, ``FAN_IN`` at a time.  The optimiser is AdamW with decoupled
weight decay and a rate that falls linearly to 0.  After each epoch the parameters, the optimiser's moments and the history
so far are committed as a version (``store``): a fit that is stopped goes on
behind its last committed epoch and ends with the same rows.

Loss of an epoch is the mean of the batches' mean losses, as they were met
(training) or at the end of the epoch (validation).  An epoch is ``saved``
when its validation accuracy beats all before it.

Defined results: rows without a vector of the head's width, a label or a
split, aren't used (``predict`` gives them no row either); rows without an id
are dealt by their vector; a repeated row counts twice; without validation
rows, accuracy is null and nothing is saved; without training rows a fit is
refused."""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import load_version, save_version, versions

ROWS_PER_TASK = 16_384
RUN_ROWS = 32_768
FAN_IN = 32
BETA1, BETA2, EPS = 0.9, 0.999, 1e-8  # fixed values: the optimiser's usual constants
GRADIENT = "part int, n long, loss double, hits long, g binary"
TAKEN = "p binary, m binary, v binary, step long, n array<long>, loss array<double>, hits array<long>"


# ---- the head --------------------------------------------------------------------

def init_head(d: int, hidden: int, k: int, seed: int) -> np.ndarray:
    """All parameters in one array: weights and biases of both layers, uniform
    within 1/sqrt(inputs)."""
    rng = np.random.RandomState(seed)
    return np.concatenate([rng.uniform(-1, 1, n) / math.sqrt(fan) for n, fan in (
        (d * hidden, d), (hidden, d), (hidden * k, hidden), (k, hidden))])


def _layers(p: np.ndarray, d: int, hidden: int, k: int):
    a, b, c = d * hidden, d * hidden + hidden, d * hidden + hidden + hidden * k
    return p[:a].reshape(d, hidden), p[a:b], p[b:c].reshape(hidden, k), p[c:]


def _phi(z: np.ndarray) -> np.ndarray:
    """The normal distribution function."""
    erf = np.frompyfunc(math.erf, 1, 1)
    return 0.5 * (1.0 + erf(z / math.sqrt(2.0)).astype(float))


def head_scores(p: np.ndarray, x: np.ndarray, hidden: int, k: int) -> np.ndarray:
    """Logits of the rows of ``x``."""
    w1, b1, w2, b2 = _layers(p, x.shape[1], hidden, k)
    z = x @ w1 + b1
    return (z * _phi(z)) @ w2 + b2


def head_gradient(p: np.ndarray, x: np.ndarray, y: np.ndarray, hidden: int, k: int) -> tuple[float, int, np.ndarray]:
    """(sum of the cross entropies, rows with the right class, their gradient
    summed over the rows)."""
    w1, b1, w2, b2 = _layers(p, x.shape[1], hidden, k)
    z = x @ w1 + b1
    phi = _phi(z)
    act = z * phi
    s = act @ w2 + b2
    top = s.max(1, keepdims=True)
    e = np.exp(s - top)
    total = e.sum(1, keepdims=True)
    at = np.arange(len(y))
    loss = float((np.log(total) + top)[:, 0].sum() - s[at, y].sum())
    ds = e / total
    ds[at, y] -= 1
    dz = (ds @ w2.T) * (phi + z * np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi))
    g = np.concatenate([(x.T @ dz).ravel(), dz.sum(0), (act.T @ ds).ravel(), ds.sum(0)])
    return loss, int((s.argmax(1) == y).sum()), g


def adamw(p, g, m, v, step: int, rate: float, decay: float):
    """One step; returns the new (p, m, v)."""
    m, v = BETA1 * m + (1 - BETA1) * g, BETA2 * v + (1 - BETA2) * g * g
    hat = (m / (1 - BETA1 ** step)) / (np.sqrt(v / (1 - BETA2 ** step)) + EPS)
    return p - rate * decay * p - rate * hat, m, v


# ---- batches ---------------------------------------------------------------------

def deal_batches(df: DataFrame, path: str, batch_rows: int, seed: int, vec_col: str = "embedding", label_col: str = "label",
                 id_col: str = "vec_id", split_col: str = "split") -> DataFrame:
    """Writes the usable rows as (split, batch, share, v, y) under ``path``: a
    batch has about ``batch_rows`` rows, and a share is what one task reads."""
    spark = df.sparkSession
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = df.select(F.col(split_col).alias("split"), v.alias("v"), F.col(label_col).cast("int").alias("y"),
                     F.coalesce(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(0)).alias("_h"), F.col(id_col).alias("_id"))
    rows = rows.withColumn("_h", F.when(F.col("_id").isNull(), F.xxhash64(F.lit(seed), "v")).otherwise(F.col("_h")))
    rows = rows.where("split is not null and y >= 0 and size(v) > 0 and not exists(v, x -> x is null or isnan(x))")
    n = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    batches = F.element_at(F.create_map(*[F.lit(x) for s, c in n.items() for x in (s, max(1, math.ceil(c / batch_rows)))]),
                           F.col("split")) if n else F.lit(1)
    shares = max(1, math.ceil(batch_rows / ROWS_PER_TASK))
    dealt = rows.withColumn("batch", F.pmod("_h", batches).cast("int")).withColumn(
        "share", F.pmod(F.shiftright("_h", 32), F.lit(shares)).cast("int"))
    folders = ["split"] if batch_rows <= ROWS_PER_TASK else ["split", "batch"]
    (dealt.select("split", "batch", "share", "v", "y").repartition("split", "batch", "share")
     .sortWithinPartitions("split", "batch", "share").write.mode("overwrite").partitionBy(*folders).parquet(path))
    return spark.read.schema("split string, batch int, share int, v array<double>, y int").parquet(path)


def _sums(rows: DataFrame, p: np.ndarray, d: int, hidden: int, k: int, gradient: bool) -> DataFrame:
    """One row a task and batch: rows, loss, hits and, if asked for, the
    gradient's sum."""
    def run(batches):
        import pyarrow as pa

        held: dict = {}
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y, key = batch.column("y").to_numpy(), batch.column("batch").to_numpy()
            for b in np.unique(key):
                loss, hits, g = head_gradient(p, x[key == b], y[key == b], hidden, k)
                n0, l0, h0, g0 = held.get(b, (0, 0.0, 0, 0.0))
                held[b] = n0 + int((key == b).sum()), l0 + loss, h0 + hits, (g0 + g) if gradient else 0.0
        n = len(held)
        cols = list(zip(*held.values())) if n else [[], [], [], []]
        g = [x.astype("<f8").tobytes() if gradient else b"" for x in cols[3]] if gradient else [b""] * n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(map(int, held)), pa.int32()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.float64()),
             pa.array(cols[2], pa.int64()), pa.array(g, pa.binary())], names=["part", "n", "loss", "hits", "g"])

    return rows.where(F.size("v") == d).select("v", "y", "batch").mapInArrow(run, GRADIENT)


def _added(parts: DataFrame, tasks: int) -> list:
    """The tasks' rows, added up FAN_IN at a time until a driver can hold them."""
    def add(rows):
        import pyarrow as pa
        g = sum(np.frombuffer(x, "<f8") for x in rows.column("g").to_pylist())
        return pa.table({"part": pa.array([0], pa.int32()), "n": pa.array([sum(rows.column("n").to_pylist())], pa.int64()),
                         "loss": [math.fsum(rows.column("loss").to_pylist())],
                         "hits": pa.array([sum(rows.column("hits").to_pylist())], pa.int64()), "g": [g.astype("<f8").tobytes()]})

    while tasks > FAN_IN:
        tasks = math.ceil(tasks / FAN_IN)
        parts = parts.groupBy(F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).alias("_k")).applyInArrow(add, GRADIENT)
    return parts.collect()


def _in_runs(rows: DataFrame, order: list[int], batch_rows: int, path: str) -> int:
    """Writes the training ``rows`` under ``path`` in runs of the batches'
    ``order``, a folder a run; the number of runs."""
    spark = rows.sparkSession
    long = max(1, RUN_ROWS // batch_rows)
    placed = spark.createDataFrame([(b, i, i // long) for i, b in enumerate(order)], "batch int, at int, run int")
    (rows.join(placed, "batch").select("run", "at", "v", "y").repartition("run").sortWithinPartitions("run", "at")
     .write.mode("overwrite").partitionBy("run").parquet(path))
    return -(-len(order) // long)


def _taken(rows: DataFrame, p, m, v, step: int, steps: int, rate: float, decay: float, d: int, hidden: int, k: int):
    """The steps of one run (at, v, y), in the order of ``at``: (p, m, v, step,
    [(mean loss, hits, rows) of each])."""
    def run(batches):
        import pyarrow as pa

        state, met, held = [p, m, v, step], [], []

        def take():
            x, y = (np.concatenate(c) for c in zip(*held))
            loss, hits, g = head_gradient(state[0], x, y, hidden, k)
            met.append((loss / len(y), hits, len(y)))
            state[3] += 1
            state[:3] = adamw(state[0], g / len(y), state[1], state[2], state[3],
                              rate * max(0.0, 1 - (state[3] - 1) / steps), decay)

        last = None
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y, at = batch.column("y").to_numpy(), batch.column("at").to_numpy()
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
            for a, b in zip(first, [*first[1:], len(at)]):
                if held and at[a] != last:
                    take()
                    held = []
                held.append((x[a:b], y[a:b]))
                last = at[a]
        if held:
            take()
        loss, hits, n = zip(*met) if met else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([s.astype("<f8").tobytes()], pa.binary()) for s in state[:3]], pa.array([state[3]], pa.int64()),
             pa.array([list(n)], pa.list_(pa.int64())), pa.array([list(loss)], pa.list_(pa.float64())),
             pa.array([list(hits)], pa.list_(pa.int64()))], names=["p", "m", "v", "step", "n", "loss", "hits"])

    own = rows.where(F.size("v") == d).select("at", "v", "y").coalesce(1).sortWithinPartitions("at")
    r = own.mapInArrow(run, TAKEN).first()
    return (*[np.frombuffer(r[c], "<f8") for c in "pmv"], r["step"], list(zip(r["loss"], r["hits"], r["n"])))


# ---- fit and predict ---------------------------------------------------------------

def fit_head(df: DataFrame, path: str, epochs: int, batch_rows: int = 128, rate: float = 1e-3, decay: float = 0.01,
             hidden: int | None = None, seed: int = 15, stop_after: int | None = None, vec_col: str = "embedding",
             label_col: str = "label", id_col: str = "vec_id", split_col: str = "split") -> DataFrame:
    """Trains on the rows whose split is ``train``, validates on ``valid``;
    returns the history (epoch, split, loss, accuracy, saved).

    The batches and the versions lie under ``path``; called again with it, the
    fit goes on behind the last committed epoch.  ``stop_after`` ends it early,
    as a lost driver would."""
    spark = df.sparkSession
    done = versions(spark, path)
    if done:
        tables, info = load_version(spark, path)
        state = {r["name"]: np.array(r["value"]) for r in tables["state"].collect()}
        p, m, v, step = state["p"], state["m"], state["v"], info["step"]
        d, hidden, k, history = info["d"], info["hidden"], info["classes"], [tuple(r) for r in info["history"]]
        batches = spark.read.schema("split string, batch int, share int, v array<double>, y int").parquet(info["batches"])
        rows_path = info["batches"]
    else:
        rows_path = f"{path}/batches"
        batches = deal_batches(df, rows_path, batch_rows, seed, vec_col, label_col, id_col, split_col)
        top = batches.where("split = 'train'").agg(F.max("y"), F.mode(F.size("v"))).first()
        if top[0] is None:
            raise ValueError("no labelled training rows with a vector")
        k, d = top[0] + 1, top[1]
        hidden = hidden or max(1, d // 2)
        p = init_head(d, hidden, k, seed)
        m, v, step, history = np.zeros_like(p), np.zeros_like(p), 0, []
    batches = batches.where(F.col("y") < k)
    train = sorted(r["batch"] for r in batches.where("split = 'train'").select("batch").distinct().collect())
    tasks = max(1, math.ceil(batch_rows / ROWS_PER_TASK))
    steps = epochs * len(train)
    for epoch in range(len(done), epochs if stop_after is None else min(epochs, stop_after)):
        met = []
        order = [int(b) for b in np.random.RandomState(zlib.crc32(f"{seed}-{epoch}".encode())).permutation(train)]
        if batch_rows <= ROWS_PER_TASK:
            folder = f"{path}/order/{epoch}-{uuid.uuid4().hex}"
            for i in range(_in_runs(batches.where("split = 'train'"), order, batch_rows, folder)):
                own = spark.read.schema("at int, v array<double>, y int").parquet(f"{folder}/run={i}")
                p, m, v, step, own_met = _taken(own, p, m, v, step, steps, rate, decay, d, hidden, k)
                met += own_met
        for b in order if batch_rows > ROWS_PER_TASK else ():
            own = batches.where((F.col("split") == "train") & (F.col("batch") == b))
            found = [r for r in _added(_sums(own, p, d, hidden, k, True), tasks) if r["n"]]
            if not found:
                continue
            n = sum(r["n"] for r in found)
            g = sum(np.frombuffer(r["g"], "<f8") for r in found) / n
            met.append((math.fsum(r["loss"] for r in found) / n, sum(r["hits"] for r in found), n))
            step += 1
            p, m, v = adamw(p, g, m, v, step, rate * max(0.0, 1 - (step - 1) / steps), decay)
        loss, accuracy = _epoch(met)
        history.append((epoch, "train", loss, accuracy, False))
        valid = _sums(batches.where("split = 'valid'"), p, d, hidden, k, False).groupBy("part").agg(
            F.sum("n").alias("n"), F.sum("loss").alias("loss"), F.sum("hits").alias("hits"))
        loss, accuracy = _epoch([(r["loss"] / r["n"], r["hits"], r["n"]) for r in valid.orderBy("part").collect()])
        best = max((r[3] for r in history if r[1] == "valid" and r[3] is not None), default=0.0)
        history.append((epoch, "valid", loss, accuracy, accuracy is not None and accuracy > best))
        state = spark.createDataFrame([(name, x.tolist()) for name, x in (("p", p), ("m", m), ("v", v))],
                                      "name string, value array<double>")
        save_version(spark, path, {"state": state.coalesce(1)}, {
            "step": step, "d": d, "hidden": hidden, "classes": k, "batches": rows_path, "history": history}, epoch)
    return spark.createDataFrame(history, "epoch long, split string, loss double, accuracy double, saved boolean")


def _epoch(met: list) -> tuple[float | None, float | None]:
    if not met:
        return None, None
    return math.fsum(x[0] for x in met) / len(met), sum(x[1] for x in met) / sum(x[2] for x in met)


def best_epoch(spark: SparkSession, path: str) -> int:
    """The last epoch that was saved (the last of all if none was)."""
    _, info = load_version(spark, path)
    saved = [r[0] for r in info["history"] if r[4]]
    return saved[-1] if saved else info["history"][-1][0]


def predict_head(df: DataFrame, path: str, epoch: int | None = None, vec_col: str = "embedding",
                 id_col: str = "vec_id", keep: tuple = ()) -> DataFrame:
    """(id, *keep, pred) by a stored epoch, the best one if not given."""
    spark = df.sparkSession
    tables, info = load_version(spark, path, best_epoch(spark, path) if epoch is None else epoch)
    p = np.array(tables["state"].where("name = 'p'").first()["value"])
    d, hidden, k = info["d"], info["hidden"], info["classes"]

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            x = batch.column("_v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            pred = head_scores(p, x, hidden, k).argmax(1) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (id_col, *keep)], pa.array(pred.astype(np.int32))],
                                             names=[id_col, *keep, "pred"])

    rows = df.select(id_col, *keep, F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("_v")).where(
        f"size(_v) = {d} and not exists(_v, x -> x is null or isnan(x))")
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (id_col, *keep))
    return rows.mapInArrow(run, f"{kinds}, pred int")
