"""Sentence ranking against a dense version."""
import math
from collections import Counter

import numpy as np

from conftest import SF_SMALL
from lexispark.operators import sentencegraph, summary
from lexispark.plans import jobs


def dense_ranks(vectors, damping=0.85):
    """Power iteration on the full similarity matrix."""
    terms = sorted({t for v in vectors for t in v})
    a = np.array([[v.get(t, 0.0) for t in terms] for v in vectors])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    s = a @ a.T
    np.fill_diagonal(s, 0)
    degree = s.sum(0)
    p = np.divide(s, degree, out=np.zeros_like(s), where=degree > 1e-12)
    r = np.full(len(s), 1 / len(s))
    for _ in range(2000):
        r = (1 - damping) / len(s) + damping * p @ r
    return r


def test_ranks_equal_a_dense_version(spark, monkeypatch):
    monkeypatch.setattr(sentencegraph, "POSTINGS", 500)  # several blocks
    rows = [(r["doc_id"], r["text"]) for r in jobs.documents(spark, SF_SMALL, ("doc_id", "text")).limit(25).collect()]
    rows += [(900, "One lone sentence."), (901, "apple pie. zebra crossing! apple tart? 12 34."), (902, "a b. a b. a b."), (903, "?!"), (904, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["_doc"]["id"], r["sidx"]): (r["rank"], r["n_tokens"]) for r in sentencegraph.sentence_ranks(df).collect()}
    from lexispark.functions import text as T
    from pyspark.sql import functions as F
    toks = T.apply_steps(summary.sentences(df), "sentence", "t", [F.lower] + T.WORD_TOKEN_STEPS).collect()
    by = {}
    for r in toks:
        if r["t"]:
            by.setdefault(r["doc_id"], {})[r["sidx"]] = Counter(r["t"])
    n = sum(t is not None for _, t in rows)
    df_of = Counter(w for d in by.values() for w in set().union(*d.values()))
    want = {}
    for d, sents in by.items():
        order = sorted(sents)
        r = dense_ranks([{w: c * (math.log((1 + n) / (df_of[w] + 1)) + 1) for w, c in sents[i].items()} for i in order])
        want |= {(d, i): (x, sum(sents[i].values())) for i, x in zip(order, r)}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k][0] - want[k][0]) < 1e-6 and got[k][1] == want[k][1]


def test_summary_of_odd_rows(spark):
    text = "The red apple pie is good. Nothing else here at all. A red apple pie is a good apple pie. Short."
    rows = [(1, text), (1, text), (1, "Other words stand in this text."), (None, text), (None, None), (2, ""), (3, "...")]
    got = sentencegraph.ranked_summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = "The red apple pie is good. A red apple pie is a good apple pie."
    assert [r["summary"] for r in got].count(want) == 3
    assert {r["summary"] for r in got if r["doc_id"] in (2, 3)} == {""}
    assert sorted(tuple(r["sentences"]) for r in got if r["summary"] == want) == [(0, 2)] * 3
