"""Operator properties and brute-force checks on small inputs."""
import collections
import hashlib
import math

import numpy as np
import pytest
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lexispark.functions.resources import STOPWORDS_EN
from lexispark.operators import bayes, evaluate, features, phrases, rank, sequences, split
from lexispark.plans import jobs


def test_exact_split_sizes(spark):
    docs = jobs.documents(spark, SF_SMALL)
    s = split.exact_split(docs, test_p=0.1, valid_p=0.15).groupBy("split").count().collect()
    got = {r["split"]: r["count"] for r in s}
    n = docs.count()
    k_test = math.ceil(0.1 * n)
    k_valid = math.ceil(0.15 * (n - k_test))
    assert got == {"test": k_test, "valid": k_valid, "train": n - k_test - k_valid}


def test_exact_split_stratified_sizes(spark):
    docs = jobs.documents(spark, SF_SMALL)
    s = split.exact_split(docs, test_p=0.2, valid_p=0.0, stratify="lang")
    per = {(r["lang"], r["split"]): r["count"] for r in s.groupBy("lang", "split").count().collect()}
    for r in docs.groupBy("lang").count().collect():
        assert per.get((r["lang"], "test"), 0) == math.ceil(0.2 * r["count"])


def test_exact_split_requires_seed(spark):
    with pytest.raises(ValueError):
        split.exact_split(jobs.documents(spark, SF_SMALL), test_seed=None)


@pytest.mark.parametrize("rows_per_bucket", [7, 1_000_000])
def test_global_rank_matches_row_number(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", rows_per_bucket)
    df = spark.range(0, 500).select((F.col("id") * 7919 % 1000).alias("k")).distinct()
    got = rank.global_rank(df, "k").select("k", "rn")
    want = df.select("k", F.row_number().over(Window.orderBy("k")).alias("rn"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hash_rank_orders_by_key(spark, monkeypatch):
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", 5)
    df = spark.range(0, 300).withColumn("k", F.md5(F.col("id").cast("string")))
    got = {r["id"]: r["rn"] for r in rank.hash_rank(df, "k").collect()}
    want = {i: j + 1 for j, i in enumerate(sorted(range(300), key=lambda i: __import__("hashlib").md5(str(i).encode()).hexdigest()))}
    assert got == want


def test_row_slice_paths_agree(spark, monkeypatch):
    docs = jobs.documents(spark, SF_SMALL, ("doc_id", "lang"))
    a = rank.row_slice(docs, "doc_id", 10, 60).collect()
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", 13)
    b = rank.row_slice(docs, "doc_id", 10, 60).collect()
    assert len(a) == 51
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_tfidf_golden(spark):
    docs = spark.createDataFrame([(1, "aa bb bb"), (2, "aa cc")], "doc_id long, terms string")
    w, idf, n = features.tfidf_fit_transform(docs, F.lit(True))
    got = {(r["doc_id"], r["term"]): round(r["weight"], 4) for r in w.collect()}
    assert got == {(1, "aa"): 0.3352, (1, "bb"): 0.9422, (2, "aa"): 0.5797, (2, "cc"): 0.8148}
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n2")).collect()
    assert all(abs(r["n2"] - 1) < 1e-9 for r in norms)


def test_naive_bayes_matches_dense_formula(spark):
    rows = [(1, "aa bb", 0), (2, "bb cc cc", 1), (3, "aa aa dd", 0), (4, "cc dd", 1), (5, "aa cc", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, terms string, label int")
    w, idf, n = features.tfidf_fit_transform(docs, F.lit(True), keep=["label"])
    ww = w.select("doc_id", "term", "weight")
    ct, classes = bayes.fit(w.select("doc_id", "label", "term", "weight"), docs.select("doc_id", "label"), idf.count())
    pred = {r["doc_id"]: r["scores"] for r in bayes.predict(ww, docs, ct, classes).collect()}
    vocab = sorted(r["term"] for r in idf.collect())
    X = np.zeros((5, len(vocab)))
    for r in ww.collect():
        X[r["doc_id"] - 1, vocab.index(r["term"])] = r["weight"]
    y = np.array([r[2] for r in rows])
    for c in (0, 1):
        fc = X[y == c].sum(0) + 1.0
        logp = np.log(fc / fc.sum())
        prior = math.log((y == c).sum() / len(y))
        for d in range(5):
            assert abs(pred[d + 1][c] - (prior + X[d] @ logp)) < 1e-9


def test_report_identities(spark):
    p = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (1, 0)], "label int, pred int")
    rep = {r["class"]: r for r in evaluate.classification_report(p).collect()}
    assert abs(rep["weighted avg"]["recall"] - rep["accuracy"]["f1"]) < 1e-12
    assert rep["accuracy"]["support"] == 6
    acc = evaluate.accuracy_macro_f1(p).first()
    assert abs(acc["accuracy"] - 0.5) < 1e-12
    assert abs(acc["macro_f1"] - rep["macro avg"]["f1"]) < 1e-12


def _rake_brute(text):
    toks = regex.findall(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+", text.lower())
    phrases_, cur = [], []
    for t in toks:
        if t in STOPWORDS_EN or not regex.search(r"[\p{L}\p{N}_]", t):
            if cur:
                phrases_.append(cur)
            cur = []
        else:
            cur.append(t)
    if cur:
        phrases_.append(cur)
    freq, deg = {}, {}
    for ph in phrases_:
        for w in ph:
            freq[w] = freq.get(w, 0) + 1
            deg[w] = deg.get(w, 0) + len(ph)
    return sorted(round(sum(deg[w] / freq[w] for w in ph), 9) for ph in phrases_)


def test_rake_matches_brute_force(spark):
    texts = ["Compatibility of systems of linear constraints over the set of natural numbers. "
             "Criteria of compatibility of a system of linear Diophantine equations are considered.",
             "Das ist gut, sehr gut!", "", "the of and"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = phrases.rake_phrases(df).collect()
    for i, t in enumerate(texts):
        got = sorted(round(r["score"], 9) for r in out if r["doc_id"] == i)
        assert got == _rake_brute(t)


@pytest.mark.parametrize("la,lb", [(10, 20), (100, 20), (20, 100), (80, 80), (74, 75), (73, 200), (0, 500)])
def test_pair_budget(spark, la, lb):
    df = spark.createDataFrame([(la, lb)], "la int, lb int")
    a, b = sequences.pair_budget(F.col("la"), F.col("lb"), 147)
    r = df.select(a.alias("a"), b.alias("b")).first()
    assert r["a"] + r["b"] == min(la + lb, 147)
    assert r["a"] <= la and r["b"] <= lb
    if la + lb > 147 and min(la, lb) <= 73 and la != lb:
        assert min(r["a"], r["b"]) == min(la, lb)


def test_lemmas_and_null_text(spark):
    """``women`` maps to ``woman`` because the corpus holds ``woman``; a null
    text stays null, one without words is empty."""
    from lexispark.operators import terms
    df = spark.createDataFrame([(1, "Two women and a woman."), (2, "The men, the man!"), (3, "the of"), (4, None), (4, None)],
                               "doc_id long, text string")
    got = sorted(((r["doc_id"], r["terms"]) for r in terms.normalize_terms(df).collect()), key=str)
    assert got == [(1, "two woman woman"), (2, "man man"), (3, ""), (4, None), (4, None)]


def test_split_of_many_strata_and_rows(spark):
    """64 classes, one of them null and one with a third of 3 million rows."""
    n = 3_000_000
    c = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 62).cast("string")))
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 997 == 0, F.lit(None)).otherwise(c).alias("c"))
    s = split.exact_split(df, "doc_id", test_p=0.1, valid_p=0.15, stratify="c")
    got = {}
    for r in s.groupBy("c", "split").count().collect():
        got.setdefault(r["c"], {})[r["split"]] = r["count"]
    assert len(got) == 64 and sum(sum(v.values()) for v in got.values()) == n
    for v in got.values():
        total = sum(v.values())
        test = math.ceil(0.1 * total)
        assert v == {"test": test, "valid": math.ceil(0.15 * (total - test)),
                     "train": total - test - math.ceil(0.15 * (total - test))}


def test_stratified_split_beyond_the_broadcast(spark, monkeypatch):
    from lexispark.operators import labels
    df = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("c"))
    want = sorted(map(tuple, split.exact_split(df, stratify="c").collect()))
    monkeypatch.setattr(labels, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, split.exact_split(df, stratify="c").collect())) == want


@pytest.mark.parametrize("rows_per_bucket", [7, 1_000_000])
def test_null_keys_rank_first(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", rows_per_bucket)
    df = spark.range(60).select(F.when(F.col("id") > 1, F.col("id")).alias("k"), F.col("id").alias("v"))
    got = rank.global_rank(df, "k").collect()
    assert sorted(r["rn"] for r in got if r["k"] is None) == [1, 2]
    assert {r["k"]: r["rn"] for r in got if r["k"] is not None} == {k: k + 1 for k in range(2, 60)}
    assert sorted(r["pos"] for r in rank.row_slice(df, "k", 1, 4).collect()) == [1, 2, 3, 4]
    assert rank.chunked_union(df, "k", 10).groupBy("chunk").count().where("count = 10").count() == 6


def test_naive_bayes_leaves_unlabelled_rows_out(spark):
    rows = [(1, "aa bb", 0), (2, "cc ee ff", 1), (5, "cc gg ff", 1), (3, "aa dd", None), (4, "", 0), (6, "aa", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, terms string, label int")
    w, idf, _ = features.tfidf_fit_transform(docs, F.lit(True), keep=["label"])
    ct, classes = bayes.fit(w, docs.select("doc_id", "label"), idf.count())
    assert {r["label"]: r["n_c"] for r in classes.collect()} == {0: 3, 1: 2}
    assert {r["label"] for r in ct.collect()} == {0, 1}
    pred = {r["doc_id"]: r["pred"] for r in bayes.predict(w, docs, ct, classes).collect()}
    assert pred == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1, 6: 0}


def test_summary_has_every_document(spark):
    from lexispark.operators import summary
    rows = [(1, "..."), (2, None), (3, "!!! ???"), (4, "One good sentence with many words. Two."), (5, "--- ---")]
    got = {r["doc_id"]: (r["summary"], r["n_tokens"]) for r in summary.extractive_summary(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("", 0), 2: ("", 0), 3: ("", 0), 4: ("One good sentence with many words.", 6), 5: ("", 0)}


def test_phrase_rows_are_linear_in_the_text(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    out = phrases.rake_phrases(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(out) == 1 and out[0]["phrase"] == text and out[0]["n_words"] == 3000


def test_batches_do_not_mix_splits(spark):
    seqs = spark.range(50).select(F.col("id").alias("doc_id"), F.array(F.lit(1), F.lit(2)).alias("input_ids"),
                                  F.lit(2).cast("long").alias("n_tokens"),
                                  F.expr("case when id < 30 then 'train' when id < 41 then 'valid' else 'test' end").alias("split"))
    got = sequences.pack_batches(seqs, batch_size=4).collect()
    by = {}
    for r in got:
        by.setdefault((r["split"], r["batch"]), []).append(r)
    assert len(got) == 50 and len(by) == 8 + 3 + 3
    valid = sorted((r["position"], r["doc_id"]) for r in got if r["split"] == "valid")
    assert [i for _, i in valid] == list(range(30, 41))
    train = [i for _, i in sorted((r["position"], r["doc_id"]) for r in got if r["split"] == "train")]
    assert train != sorted(train)


def test_csv_ids_are_stable(spark, tmp_path):
    from pyspark.sql import types as T
    from lexispark.sources import tables
    schema = T.StructType([T.StructField("discourse_text", T.StringType()), T.StructField("discourse_type", T.StringType())])
    odd = spark.createDataFrame([('a "quoted",\nline', "x"), ("", None), (None, " edge "), ("x\r\ny", "")], schema)
    tables.write_table(odd, str(tmp_path / "odd"), "csv")
    again = tables.read_written(spark, str(tmp_path / "odd"), "csv", schema)
    assert sorted(map(str, again.collect())) == sorted(map(str, odd.collect()))
    one = spark.createDataFrame([('a "quoted",\nline', "x"), ("same", "y"), ("same", "y"), ("z", "y"), ("w", "y")], schema)
    tables.write_table(one.coalesce(1), str(tmp_path / "d"), "csv")
    first = tables.read_passages_csv(spark, str(tmp_path / "d")).collect()
    assert sorted(tuple(r)[1:] for r in first) == sorted(tuple(r) for r in one.collect())
    assert len({r["doc_id"] for r in first}) == 5
    tables.write_table(one.coalesce(1), str(tmp_path / "e"), "csv")
    import glob
    import shutil
    shutil.copy(glob.glob(str(tmp_path / "e" / "part*"))[0], tmp_path / "d" / "part-later.csv")
    second = {r["doc_id"] for r in tables.read_passages_csv(spark, str(tmp_path / "d")).collect()}
    assert len(second) == 10 and {r["doc_id"] for r in first} <= second


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace as N
    from lexispark.session import ensure_checkpoint_dir
    sc = N(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: N(get=lambda k, d: d))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(N(sparkContext=sc))


@pytest.mark.parametrize("text, want", [
    ("Привет мир", "Privet mir"), ("Ελλάδα", "Ellada"), ("Tiếng Việt", "Tieng Viet"), ("ﬁne ½ © € ™", "fine 1/2 (c) EUR TM"),
    ("Щука ψ Ёж Straße", "Shchuka ps Ezh Strasse"), ("日本", "")])
def test_transliteration(spark, text, want):
    from lexispark.functions import text as T
    assert spark.createDataFrame([(text,)], "t string").select(T.transliterate("t").alias("x")).first()["x"] == want


# ---- rows without an id, and repeated ids ------------------------------------------

def test_exact_split_leaves_rows_without_an_id_uncounted(spark):
    rows = [(i if i % 4 else None, f"t{i}") for i in range(1000)]
    got = split.exact_split(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    parts = collections.Counter((r["doc_id"] is None, r["split"]) for r in got)
    assert parts == {(True, "train"): 250, (False, "test"): 75, (False, "valid"): 102, (False, "train"): 573}
    alone = {r["doc_id"]: r["split"] for r in split.exact_split(
        spark.createDataFrame([r for r in rows if r[0] is not None], "doc_id long, text string")).collect()}
    assert {r["doc_id"]: r["split"] for r in got if r["doc_id"] is not None} == alone


def test_sequences_of_rows_without_an_id_or_with_a_repeated_one(spark):
    texts = [(1, "red green"), (1, "blue"), (None, "red blue"), (None, "green"), (None, "green"), (2, None), (3, "")]
    df = sequences.with_seq_tokens(spark.createDataFrame(texts, "doc_id long, text string"), "text", "_t")
    vocab = sequences.vocabulary(df.select(F.explode("_t").alias("token")))
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    packed = sequences.pack_sequences(df, vocab, tokens_col="_t", max_len=8)
    want = sorted((d is None, d or 0, [1] + [ids[w] for w in (t or "").split()] + [2]) for d, t in texts)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["input_ids"]) for r in packed.collect()) == want
    batches = sequences.pack_batches(packed.withColumn("split", F.lit("train")), batch_size=3).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["input_ids"][:sum(r["attention_mask"])]) for r in batches) == want
    assert sorted(r["position"] for r in batches) == list(range(1, 8))
    pairs = spark.createDataFrame([(None, ["red"], ["blue"]), (None, ["green"], ["red"])], "k long, a array<string>, b array<string>")
    got = sequences.pack_pairs(pairs, vocab, ["k"], 8).collect()
    assert sorted(r["input_ids"] for r in got) == sorted([[1, ids["red"], 2, ids["blue"], 2], [1, ids["green"], 2, ids["red"], 2]])


# ---- splits that keep equal texts together ---------------------------------------------

def brute_grouped(texts, p, q, seeds=("1", "15")):
    h = lambda t: "null" if t is None else hashlib.md5(t.encode()).hexdigest()
    size = collections.Counter(h(t) for t in texts)
    out = {}
    for name, share, seed in (("test", p, seeds[0]), ("valid", q, seeds[1])):
        left = sorted((hashlib.md5(f"{seed}-{g}".encode()).hexdigest(), g) for g in size if g not in out)
        room = math.ceil(share * sum(size[g] for _, g in left))
        while left and size[left[0][1]] <= room:
            g = left.pop(0)[1]
            out[g], room = name, room - size[g]
        for _, g in left:
            if size[g] == 1 and room:
                out[g], room = name, room - 1
    return {t: out.get(h(t), "train") for t in texts}


@pytest.mark.parametrize("hot", [0, 3, 400])
@pytest.mark.parametrize("bits", [4, 16])
def test_grouped_split_against_brute_force(spark, monkeypatch, hot, bits):
    monkeypatch.setattr(split, "HIST_BITS", bits)
    texts = [f"t{i}" for i in range(300)] + [f"g{i % 9}" for i in range(100)] + ["same"] * hot + [None] * 5 + ["", ""]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, h string")
    got = split.exact_split_grouped(df, "text", 0.1, "1", 0.15, "15")
    assert got.columns == ["doc_id", "text", "h", "split"]
    rows = got.collect()
    want = brute_grouped(texts, 0.1, 0.15)
    assert {r["text"]: r["split"] for r in rows} == want and len(rows) == len(texts)
    assert all(r["split"] == want[r["text"]] for r in rows)  # one part a text
    n = math.ceil(0.1 * len(texts))
    assert sum(r["split"] == "test" for r in rows) == n  # single texts fill the part
    report = split.split_leak_report(got.where("text is not null")).collect()
    assert all(r["n_shared_texts"] == 0 for r in report)


def test_grouped_split_without_single_rows(spark):
    texts = [f"g{i // 7}" for i in range(700)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    part = collections.Counter(r["split"] for r in split.exact_split_grouped(df).collect())
    assert 0 <= 70 - part["test"] < 7 and 0 <= math.ceil(0.15 * (700 - part["test"])) - part["valid"] < 7
    assert split.exact_split_grouped(df.limit(0)).count() == 0


def test_subword_sequences_equal_the_library(spark):
    from tokenizers import Tokenizer
    path = f"{jobs.TOKENIZERS}/{jobs.SUBWORDS[0]}"
    lib = Tokenizer.from_file(path)
    texts = [(1, "Unbelievable tokenizations, of words!"), (1, "other text"), (None, "naïve café"), (None, "x" * 400), (2, None), (3, "")]
    texts += [(r["doc_id"], r["text"]) for r in jobs.documents(spark, SF_SMALL, ("doc_id", "text")).limit(60).collect()]
    df = sequences.with_seq_tokens(spark.createDataFrame(texts, "doc_id long, text string"), "text", "_t").checkpoint()
    with open(path, encoding="utf-8") as f:
        vocab = sequences.subword_vocabulary(df.select(F.explode("_t").alias("token")), f.read())
    got = sequences.pack_subwords(df, vocab, 7, 8, tokens_col="_t", max_len=40).collect()
    want = [(r["doc_id"], [7] + lib.encode(" ".join(r["_t"] or []), add_special_tokens=False).ids[:38] + [8]) for r in df.collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r["doc_id"], r["input_ids"]) for r in got], key=key) == sorted(want, key=key)
    assert all(r["n_tokens"] == len(r["input_ids"]) == sum(r["attention_mask"]) <= 40 for r in got)


@pytest.mark.parametrize("rows_per_bucket", [7, 1_000_000])
def test_row_slice_ranks_its_buckets_only(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", rows_per_bucket)
    keys = [None, None, None] + [3 * k % 101 for k in range(101)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    order = sorted(keys, key=lambda k: (k is not None, k or 0))
    for a, b in ((0, 0), (0, 4), (2, 3), (50, 70), (100, 103), (103, 500), (104, 110), (5, 4)):
        got = rank.row_slice(df, "k", a, b).collect()
        assert sorted((r["pos"], -1 if r["k"] is None else r["k"]) for r in got) == [
            (p, -1 if k is None else k) for p, k in enumerate(order) if a <= p <= b]
