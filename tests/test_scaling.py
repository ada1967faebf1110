"""What a job costs must not hang on a fixed number of tasks or grow faster than
its rows."""

import glob

import numpy as np
import pytest

from lexispark.functions import text as T
from lexispark.operators import chunks, features, sentencegraph, summary, terms, training
from lexispark.plans import jobs
from lexispark.session import ensure_checkpoint_dir
from lexispark.sources import tables


@pytest.fixture
def partitions(spark):
    n = spark.conf.get("spark.sql.shuffle.partitions")
    yield int(n)
    spark.conf.set("spark.sql.shuffle.partitions", n)


def test_shuffle_partitions_follow_the_files(spark, tmp_path, partitions, monkeypatch):
    rows = [(i, f"word{i} " * 50) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = tables.read_table(spark, str(tmp_path), "documents", ["doc_id", "text"])
    assert tables.spread(docs, "doc_id").rdd.getNumPartitions() == partitions
    monkeypatch.setattr(tables, "PARTITION_BYTES", 200)
    n = tables.spread(docs, "doc_id").rdd.getNumPartitions()
    assert n > partitions and int(spark.conf.get("spark.sql.shuffle.partitions")) == n
    monkeypatch.setattr(tables, "PARTITION_BYTES", 1 << 30)
    assert tables.sized_partitions(docs) == n  # never lowered
    assert tables.sized_partitions(spark.createDataFrame(rows, "doc_id long, text string")) == n


def test_tasks_of_joined_partitions_are_bounded(spark, tmp_path, partitions, monkeypatch):
    """AQE puts no more into a task than JOINED_BYTES, however many rows come
    (its own limit is 64 MB, which a small input never reaches)."""
    for size, want in (("8m", 8 << 20), ("64MB", 64 << 20), ("1048576b", 1 << 20), ("123", 123)):
        assert tables._bytes(size) == want
    name, least = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    old, old_least = spark.conf.get(name), spark.conf.get(least)
    spark.createDataFrame([(i, f"t{i}") for i in range(5000)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = tables.read_table(spark, str(tmp_path), "documents", ["doc_id", "text"])
    try:
        monkeypatch.setattr(tables, "JOINED_BYTES", 10_000)
        spark.conf.set(name, "64MB")
        spark.conf.set(least, "1b")
        tables.sized_partitions(docs)
        assert tables._bytes(spark.conf.get(name)) == 10_000
        assert docs.groupBy("text").count().rdd.getNumPartitions() > 4
        spark.conf.set(name, "1k")
        tables.sized_partitions(docs)
        assert spark.conf.get(name) == "1k"  # never raised
    finally:
        spark.conf.set(name, old)
        spark.conf.set(least, old_least)


def test_phrase_partitions_follow_the_files(spark, tmp_path, partitions, monkeypatch):
    monkeypatch.setattr(tables, "PARTITION_BYTES", 100)
    rows = [(i, f"red fox{i} the blue sky", "en") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    out = jobs.doc_phrases(spark, str(tmp_path))
    assert out.rdd.getNumPartitions() > partitions and out.count() == 400


def test_texts_are_tokenised_once(spark):
    docs = spark.createDataFrame([(1, "cats and dogs"), (None, "cat"), (2, None), (1, "cats and dogs"), (3, "")],
                                 "doc_id long, text string")
    out = terms.normalize_terms(docs)
    assert "regexp" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r["doc_id"] or 0, r["terms"]) for r in out.collect() if r["terms"] is not None)
    assert len(got) == 4 and got[0] == (0, "cat") and got[1] == got[2] and got[3] == (3, "")


def test_sequences_are_tokenised_once(spark, tmp_path):
    spark.createDataFrame([(1, "Some words, some"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = jobs.document_sequences(spark, str(tmp_path))
    assert "lower(" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert {r["doc_id"]: r["n_tokens"] for r in plan.collect()} == {1: 5, 2: 2}


def test_epochs_take_a_job_a_run_of_batches(spark, tmp_path):
    rng = np.random.RandomState(3)
    rows = [(i, rng.normal(size=4).tolist(), i % 2, "valid" if i % 10 == 0 else "train") for i in range(200)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, split string").checkpoint()
    group = f"head-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, "head")
    history = training.fit_head(e, str(tmp_path / "head"), epochs=2, batch_rows=4).collect()
    taken = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    batches = spark.read.parquet(str(tmp_path / "head/batches")).where("split = 'train'").select("batch").distinct().count()
    assert len(history) == 4 and batches > 30
    assert taken < batches  # two epochs took over 2 * batches jobs


def test_runs_of_batches_give_the_steps_of_single_batches(spark, tmp_path, monkeypatch):
    rng = np.random.RandomState(4)
    rows = [(i, rng.normal(size=4).tolist(), i % 3, "valid" if i % 5 == 0 else "train") for i in range(90)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, split string").checkpoint()
    got = {}
    for name, run_rows, rows_per_task in (("one", 32_768, 16_384), ("short", 16, 16_384), ("jobs", 32_768, 7)):
        monkeypatch.setattr(training, "RUN_ROWS", run_rows)
        monkeypatch.setattr(training, "ROWS_PER_TASK", rows_per_task)
        h = training.fit_head(e, str(tmp_path / name), epochs=2, batch_rows=8).orderBy("epoch", "split").collect()
        got[name] = [x for r in h for x in (r["loss"], r["accuracy"])]
    assert got["one"] == pytest.approx(got["jobs"], abs=1e-9) and got["short"] == pytest.approx(got["jobs"], abs=1e-9)


def test_chunk_runs_end_after_a_bounded_number_of_jobs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chunks, "AT_ONCE", 2)
    monkeypatch.setattr(chunks, "JOBS", 3)
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(30)], "doc_id long, text string")
    path = str(tmp_path / "run")
    chunks.run_chunks(docs, "doc_id", lambda d: d, path, 2, at_once=2, stop_after=1)
    out = chunks.run_chunks(docs, "doc_id", lambda d: d, path, 2)
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(30))
    assert len(chunks.commits(spark, f"{path}/done")) == 4  # the stopped one and three
    assert chunks.done_chunks(spark, path) == list(range(15))


def test_postings_are_written_compressed_under_a_number(spark):
    text = "Red fox runs far today. Red fox sleeps here now. Blue sky."
    docs = spark.createDataFrame([(1, text), (None, text), (1, "Other words. Other things."), (1, text)], "doc_id long, text string")
    ranks = sentencegraph.sentence_ranks(docs)
    assert len({(r["_doc"], r["sidx"]) for r in ranks.collect()}) == ranks.count() == 8
    found = glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/lexispark/postings/*")
    assert found and "dn" in spark.read.parquet(found[0]).columns


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_small_lemma_table_leaves_the_tokens_where_they_are(spark):
    docs = spark.createDataFrame([(1, "cats and a cat"), (1, "cats"), (None, "cats"), (2, None), (3, "the of"), (4, "")], "doc_id long, text string")
    out = terms.normalize_terms(docs)
    assert "BroadcastHashJoin [term" in plan_of(out)  # a sort-merge join moved every document's tokens
    assert sorted((str(r["doc_id"]), str(r["terms"])) for r in out.collect()) == [
        ("1", "cat"), ("1", "cat cat"), ("2", "None"), ("3", ""), ("4", ""), ("None", "cat")]


def test_weights_hash_the_vocabulary(spark):
    """The counts, many times as many rows as there are terms, are not sorted by term."""
    docs = spark.createDataFrame([(1, "aa bb\tbb  c"), (1, "aa"), (2, "aa cc"), (None, "bb"), (3, None)], "doc_id long, terms string")
    tf = features.term_counts(features.doc_terms(docs))
    assert {(r["doc_id"], r["term"]): r["tf"] for r in tf.collect()} == {
        (1, "aa"): 2, (1, "bb"): 2, (2, "aa"): 1, (2, "cc"): 1, (None, "bb"): 1}
    w = features.tfidf(tf, features.fit_idf(tf, 5))
    assert "ShuffledHashJoin [term" in plan_of(w) and w.count() == 5


def test_white_space_is_cut_without_a_regular_expression_a_row(spark):
    texts = ["", " \n", "a", " a  b\n\nc\x1d", "a  b", "　", " a\x85b "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string").select("i", T.split_ws("t").alias("o"))
    assert "split(regexp_replace" in plan_of(df)
    got = {r["i"]: r["o"] for r in df.collect()}
    assert got == {**{i: t.split() for i, t in enumerate(texts)}, 99: None}


def test_summaries_hash_the_vocabulary(spark):
    texts = spark.createDataFrame([(1, "Red fox runs far away. Blue sky."), (1, "Red fox."), (None, "One two\x1dthree four five"), (2, None)],
                                  "doc_id long, text string")
    s = summary.extractive_summary(texts)
    plan = plan_of(s)
    assert "ShuffledHashJoin [term" in plan and "SortMergeJoin [term" not in plan
    got = sorted((r["doc_id"] or 0, r["sentence_index"], r["n_tokens"]) for r in s.collect() if r["summary"])
    assert got == [(0, 0, 5), (1, 0, 7), (1, 0, 7)]
