"""Training by epochs against a numpy run, and its stored versions."""
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lexispark.operators import store, training
from lexispark.plans import jobs
from lexispark.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    return jobs.embedding_splits(spark, SF_SMALL)


def numpy_history(rows, epochs, batch_rows, rate, seed, decay=0.01):
    """The same training, one row at a time in the gradient and without tasks."""
    got = [(r["split"], np.array(r["embedding"], float), r["label"], r["h"]) for r in rows.select(
        "*", F.xxhash64(F.lit(seed), "vec_id").alias("h")).collect()]
    d, k = len(got[0][1]), 1 + max(r[2] for r in got if r[0] == "train")
    hidden = d // 2
    n = {s: sum(r[0] == s for r in got) for s in ("train", "valid")}
    batch = {s: {} for s in n}
    for s, x, y, h in got:
        if s in n:
            batch[s].setdefault(h % math.ceil(n[s] / batch_rows), []).append((x, y))
    rng = np.random.RandomState(seed)
    w = [rng.uniform(-1, 1, size) / math.sqrt(fan) for size, fan in ((d * hidden, d), (hidden, d), (hidden * k, hidden), (k, hidden))]
    w[0], w[2] = w[0].reshape(d, hidden), w[2].reshape(hidden, k)
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]

    def forward(x):
        z = x @ w[0] + w[1]
        cdf = np.array([0.5 * (1 + math.erf(t / math.sqrt(2))) for t in z])
        s = (z * cdf) @ w[2] + w[3]
        return z, cdf, s, np.exp(s - s.max()) / np.exp(s - s.max()).sum()

    step, steps, history, best = 0, epochs * len(batch["train"]), [], 0.0
    for epoch in range(epochs):
        losses, hits = [], 0
        for b in np.random.RandomState(zlib.crc32(f"{seed}-{epoch}".encode())).permutation(sorted(batch["train"])):
            g = [np.zeros_like(x) for x in w]
            loss = 0.0
            for x, y in batch["train"][b]:
                z, cdf, s, prob = forward(x)
                loss -= math.log(prob[y])
                hits += int(s.argmax() == y)
                ds = prob - np.eye(k)[y]
                dz = (w[2] @ ds) * (cdf + z * np.exp(-z * z / 2) / math.sqrt(2 * math.pi))
                for i, part in enumerate((np.outer(x, dz), dz, np.outer(z * cdf, ds), ds)):
                    g[i] += part
            size = len(batch["train"][b])
            losses.append(loss / size)
            step += 1
            lr = rate * (1 - (step - 1) / steps)
            for i in range(4):
                m[i] = 0.9 * m[i] + 0.1 * g[i] / size
                v[i] = 0.999 * v[i] + 0.001 * (g[i] / size) ** 2
                w[i] = w[i] * (1 - lr * decay) - lr * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        history.append((epoch, "train", np.mean(losses), hits / n["train"], False))
        losses, hits = [], 0
        for part in batch["valid"].values():
            out = [(forward(x), y) for x, y in part]
            losses.append(np.mean([-math.log(o[3][y]) for o, y in out]))
            hits += sum(int(o[2].argmax() == y) for o, y in out)
        accuracy = hits / n["valid"]
        history.append((epoch, "valid", np.mean(losses), accuracy, accuracy > best))
        best = max(best, accuracy)
    return history


def test_history_equals_a_numpy_run(spark, rows):
    opts = dict(epochs=3, batch_rows=100, rate=5e-3, seed=15)
    got = training.fit_head(rows, scratch_path(spark, "t"), **opts).orderBy("epoch", "split").collect()
    want = sorted(numpy_history(rows, **opts))
    assert len(got) == len(want) == 6
    for g, e in zip(got, want):
        assert (g["epoch"], g["split"], g["saved"]) == (e[0], e[1], e[4])
        assert g["loss"] == pytest.approx(e[2], abs=1e-6) and g["accuracy"] == pytest.approx(e[3], abs=1e-9)


def test_a_stopped_fit_resumes_to_the_same_rows(spark, rows):
    opts = dict(epochs=3, batch_rows=200, rate=5e-3, seed=3)
    whole_path, path = scratch_path(spark, "t"), scratch_path(spark, "t")
    whole = training.fit_head(rows, whole_path, **opts).orderBy("epoch", "split").collect()
    assert len(training.fit_head(rows, path, stop_after=1, **opts).collect()) == 2
    # a version that was never committed is not read
    spark.createDataFrame([("p", [0.0])], "name string, value array<double>").write.parquet(f"{path}/data/1-half/state")
    assert store.versions(spark, path) == [0]
    again = training.fit_head(rows, path, **opts).orderBy("epoch", "split").collect()
    for a, b in zip(whole, again):
        assert (a["epoch"], a["split"], a["saved"]) == (b["epoch"], b["split"], b["saved"])
        assert a["loss"] == pytest.approx(b["loss"], abs=1e-9)
    assert store.versions(spark, path) == [0, 1, 2]
    saved = [r["epoch"] for r in again if r["saved"]]
    assert training.best_epoch(spark, path) == (saved[-1] if saved else 2)
    test = rows.where("split = 'test'")
    one = {r["vec_id"]: r["pred"] for r in training.predict_head(test, path).collect()}
    two = {r["vec_id"]: r["pred"] for r in training.predict_head(test, whole_path).collect()}
    assert one == two and len(one) == test.count()


def test_the_head_learns(spark):
    rng = np.random.RandomState(1)
    data = [(i, [float(x) for x in rng.normal(size=6) + 3 * (i % 3 == np.arange(6))], i % 3) for i in range(600)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn(
        "split", F.when(F.col("vec_id") % 5 == 0, "valid").otherwise("train"))
    h = training.fit_head(df, scratch_path(spark, "t"), epochs=5, batch_rows=60, rate=0.05, hidden=16).orderBy("epoch", "split").collect()
    assert h[-1]["accuracy"] > 0.9 and h[-1]["loss"] < h[1]["loss"]


def test_unusable_rows_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_TASK", 1)  # many tasks a batch: sums are added up in rounds
    good = [(i, [float(i % 2), 1.0], i % 2, "train" if i % 3 else "valid") for i in range(60)] + [(None, [0.0, 1.0], 0, "train")] * 5
    bad = [(100, None, 1, "train"), (101, [1.0], 1, "train"), (102, [None, 1.0], 0, "train"), (103, [1.0, 1.0], None, "train"),
           (104, [float("nan"), 1.0], 0, "train"), (105, [1.0, 2.0], 9, "valid"), (106, [1.0, 2.0], 1, None)]
    schema = "vec_id long, embedding array<double>, label int, split string"
    run = lambda rows: training.fit_head(spark.createDataFrame(rows, schema), scratch_path(spark, "t"), 2, 80, seed=2).orderBy(
        "epoch", "split").collect()
    for a, b in zip(run(good), run(good + bad)):
        assert a["loss"] == pytest.approx(b["loss"], abs=1e-9) and a["accuracy"] == b["accuracy"]
    with pytest.raises(ValueError):
        run([bad[0], bad[2], bad[5]])
