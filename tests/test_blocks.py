"""TF-IDF by blocks of documents, and what jobs keep on disk."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lexispark.operators import features, logistic, sentencegraph, summary, terms
from lexispark.plans import jobs

ROWS = [(1, 0, "aa BB\tbb  c"), (1, 1, "aa dd"), (1, 0, "aa"), (None, 0, "bb"), (None, None, "bb ee"), (2, 1, None), (3, 1, ""),
        (4, 0, "dd zz zz"), (5, 1, "yy")]
SCHEMA = "doc_id long, label int, terms string"


def test_blocks_give_the_weights_of_single_rows(spark):
    """Repeated and null ids, several labels of an id, terms that no training document has."""
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("split", F.when(F.col("doc_id") > 3, "test").otherwise("train"))
    keep, train = ["label", "split"], F.col("split") == "train"
    w, idf, n = features.tfidf_fit_transform(docs, train, keep=keep)
    tf = features.term_counts(features.doc_terms(docs, keep=keep), keep=keep)
    want_idf = features.fit_idf(tf.where(train), n)
    key = lambda r: tuple(map(str, r))
    assert sorted(idf.collect(), key=key) == sorted(want_idf.collect(), key=key)
    rounded = lambda df: sorted((key(r[:-1]), round(r["weight"], 12)) for r in df.select("doc_id", *keep, "term", "tf", "weight").collect())
    assert rounded(w) == rounded(features.tfidf(tf, want_idf)) and w.where("term = 'zz' or term = 'yy'").count() == 0
    blocks = features.with_known_terms(features.count_blocks(docs, train, keep=keep), idf, idf="double")
    for value in ("test", "train"):
        assert rounded(features.block_rows(blocks, keep=keep, where=("split", [value]))) == rounded(w.where(F.col("split") == value))


def test_a_block_asks_once_for_a_term(spark):
    """What moves to the vocabulary is a row a block and term, not one an entry."""
    docs = spark.createDataFrame([(i, "aa bb cc") for i in range(400)], "doc_id long, terms string")
    blocks = features.count_blocks(docs, F.lit(True))
    sent = blocks.agg(F.sum(F.size("terms")), F.sum(F.size("c"))).first()
    assert sent[0] <= 3 * int(spark.conf.get("spark.sql.shuffle.partitions")) and sent[1] == 1200


@pytest.mark.parametrize("name", ["tfidf_weights", "text_classify_nb"])
def test_weights_are_neither_shuffled_nor_written_by_entry(spark, name, monkeypatch):
    made = []
    monkeypatch.setattr(features, "block_rows", lambda *a, f=features.block_rows, **b: made.append(f(*a, **b)) or made[-1])
    out = jobs.JOBS[name](spark, SF_SMALL)
    assert made and all("Exchange" not in w._jdf.queryExecution().executedPlan().toString() for w in made)
    assert out.count() and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_a_stored_model_is_fitted_on_texts_that_were_tokenised_once(spark, monkeypatch):
    """The corpus for the lemmas and the fit, then the test texts: before, each use of the lemmas tokenised the corpus again."""
    taken, steps = [], terms.T.normalized_steps
    monkeypatch.setattr(terms.T, "normalized_steps", lambda *a: taken.append(1) or steps(*a))
    assert jobs.JOBS["score_saved_nb"](spark, SF_SMALL).count() and len(taken) == 2


TEXTS = [(1, "Red fox runs far away today. Blue sky. Red fox sleeps here now."), (1, "Red fox. Other words stand here too."), (None, "One two three."),
         (None, "One two three."), (2, None), (3, "..."), (4, "Blue sky here. Red sky there.")]


def test_words_of_summaries_do_not_move_one_by_one(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    s = summary.extractive_summary(docs)
    assert "explode(split(" not in s._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["doc_id"], r["summary"]): (r["n_tokens"], r["score"]) for r in s.collect()}
    one, two = (math.log(6 / (d + 1)) + 1 for d in (1, 2))  # five ids; words of one and of two documents
    assert got[(4, "Red sky there.")] == (3, round((one + two + two) / 3, 6))
    assert got[(None, "One two three.")] == (6, round(one, 6))  # rows of one id count together
    assert got[(2, "")] == got[(3, "")] == (0, None)


def test_ranks_need_no_postings_from_elsewhere(spark):
    """Postings aren't shuffled by term and by block: ranks are read from a table of blocks."""
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    ranks = sentencegraph.sentence_ranks(docs)
    assert "Exchange" not in ranks._jdf.queryExecution().executedPlan().toString()
    by = {}
    for r in ranks.collect():
        by.setdefault((r["_doc"]["id"], r["_doc"]["h1"]), []).append(r["rank"])
    assert sorted(map(len, by.values())) == [1, 2, 2, 3] and all(abs(sum(v) - 1) < 1e-6 or min(v) > 0 for v in by.values())


def test_the_rows_of_a_document_matrix(spark):
    """Repeated ids get the same row, ids that are null or without a term an empty one."""
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("split", F.lit("train"))
    n = features.block_count(spark)
    counts, idf, _ = features.tfidf_blocks(docs, F.lit(True), keep=["label", "split"], parts=n)
    known = idf.withColumn("tid", (F.xxhash64("term") % 7 + 7).cast("long"))
    blocks = features.with_known_terms(counts, known, idf="double", tid="long")
    numbered, size = logistic.number_documents(docs.select("doc_id", features.block_of("doc_id", n).alias("b")))
    x = logistic.document_matrix(blocks, numbered, size, 14)
    got = {}
    for cell in x.cells.collect():
        for r, c, v in zip(*(np.frombuffer(cell[k], kind) for k, kind in zip("rcv", ("<i4", "<i4", "<f8")))):
            got.setdefault(int(cell["db"] * size + r), []).append((int(cell["tb"] * x.block_terms + c), round(float(v), 12)))
    ids = {r["dn"]: r["doc_id"] for r in numbered.collect()}
    want = {}
    for r in features.block_rows(blocks, term="tid").collect():
        want.setdefault(r["doc_id"], []).append((r["tid"], round(r["weight"], 12)))
    assert len(ids) == len(ROWS)
    for dn, i in ids.items():
        assert sorted(got.get(dn, [])) == (sorted(want.get(i, [])) if i is not None else [])
