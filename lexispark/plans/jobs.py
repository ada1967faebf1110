"""Corpus jobs: each is ``job(spark, sf_dir) -> DataFrame`` over the full
test tables.  ``JOBS`` is the registry exported by ``__spark_entry__``."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import explode_rows
from ..operators import (
    bayes, chunks, clean, evaluate, features, labels, logistic, mergecounts, metrics, models, phrases, profile, rank,
    sentencegraph, sequences,
    split, summary, terms, textmodel, topk, training,
)
from ..session import dropped, ensure_checkpoint_dir, free_shuffles, scratch_path, settled
from pyspark.ml.functions import array_to_vector, vector_to_array
from ..sources.tables import ingest_csv, read_table, read_written, record_counts, sized_partitions, spread, write_table
from .fixtures import augmented_documents, broken_csv, lemma_documents

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Per-class offsets of the top-80 tables (the reference drops the first few
# generic words of each class; these are the same idea for the test classes)
TOKEN_SKIPS = {"de": 4, "en": 6, "es": 5, "fr": 5}
PHRASE_SKIPS = {"de": 3, "en": 3, "es": 4, "fr": 3}
TOP_CLASS_N = 80
TOP_TOKENS_N = 15
TOP_PHRASES_N = 20


def job(name: str):
    """Register a job.  The registered callable first makes sure the session
    has a checkpoint folder (read from ``spark.checkpoint.dir``; a local one
    only when it is unset)."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ensure_checkpoint_dir(spark)
            free_shuffles(spark)
            return fn(spark, sf_dir)
        JOBS[name] = run
        return fn
    return deco


def documents(spark, sf_dir, cols=("doc_id", "text", "lang"), spread_rows: bool = True):
    docs = read_table(spark, sf_dir, "documents", list(cols))
    return spread(docs, "doc_id") if spread_rows else docs


def labelled_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return docs.join(lab, "doc_id", "left")


# ---- 1. profile ------------------------------------------------------------

@job("class_distribution")
def class_distribution(spark, sf_dir):
    return profile.class_distribution(documents(spark, sf_dir, ("text", "lang"), spread_rows=False), "lang")


@job("class_pair_counts")
def class_pair_counts(spark, sf_dir):
    return profile.class_pair_counts(labelled_documents(spark, sf_dir), "lang", "quality")


@job("null_report")
def null_report(spark, sf_dir):
    return profile.null_report(labelled_documents(spark, sf_dir))


# ---- 2. labels -------------------------------------------------------------

@job("label_encode")
def label_encode(spark, sf_dir):
    return labels.label_encode(documents(spark, sf_dir, ("doc_id", "lang")), "lang")


# ---- 3. cleaning -----------------------------------------------------------

@job("clean_corpus")
def clean_corpus(spark, sf_dir):
    return clean.clean_corpus(augmented_documents(spark, sf_dir))


@job("clean_corpus_strict")
def clean_corpus_strict(spark, sf_dir):
    return clean.clean_corpus(augmented_documents(spark, sf_dir), url_mode="strict")


@job("rejected_docs")
def rejected_docs(spark, sf_dir):
    return clean.rejected_docs(augmented_documents(spark, sf_dir))


@job("cleaning_audit")
def cleaning_audit(spark, sf_dir):
    return clean.cleaning_audit(augmented_documents(spark, sf_dir), "lang")


# ---- 4. terms --------------------------------------------------------------

@job("stopword_filter")
def stopword_filter(spark, sf_dir):
    docs = T.apply_steps(documents(spark, sf_dir, ("doc_id", "text")), "text", "_t",
                         [F.lower] + T.WORD_TOKEN_STEPS)
    toks = terms.explode_tokens(docs, F.col("_t"))
    return terms.stopword_filter(toks).select("doc_id", "pos", "token")


@job("normalize_terms")
def normalize_terms(spark, sf_dir):
    return terms.normalize_terms(lemma_documents(spark, sf_dir))


@job("lemma_vocab")
def lemma_vocab(spark, sf_dir):
    """The lemma table of the unstemmed vocabulary, where the rules apply."""
    docs = T.apply_steps(documents(spark, sf_dir, ("doc_id", "text")), "text", "_t", [F.lower] + T.WORD_TOKEN_STEPS)
    return terms.lemma_table(explode_rows(docs, F.col("_t"), "token"))


# ---- 5. token top-k (EDA reads the cleaned corpus) -------------------------

def clean_tokens(spark, sf_dir):
    cleaned = clean.clean_corpus(documents(spark, sf_dir), keep=["lang"])
    toks = T.apply_steps(cleaned, "clean_text", "_t", T.WORD_TOKEN_STEPS)
    return terms.explode_tokens(toks, F.col("_t"), keep=["lang"])


@job("token_topk")
def token_topk(spark, sf_dir):
    return topk.top_n(topk.term_frequencies(clean_tokens(spark, sf_dir)), TOP_TOKENS_N)


@job("class_token_topk")
def class_token_topk(spark, sf_dir):
    freqs = topk.term_frequencies(clean_tokens(spark, sf_dir), by=["lang"])
    return topk.class_top_n(freqs, "lang", TOP_CLASS_N, TOKEN_SKIPS)


# ---- 6. keyphrases (on the raw text, as the reference does) -----------------

def doc_phrases(spark, sf_dir):
    # the keyphrase job hash-partitions by doc_id itself, into as many as this
    docs = documents(spark, sf_dir, spread_rows=False)
    sized_partitions(docs)
    return phrases.rake_phrases(docs, keep=["lang"])


@job("rake_phrases")
def rake_phrases(spark, sf_dir):
    return doc_phrases(spark, sf_dir).select(
        "doc_id", "rank", "phrase", "n_words", F.round("score", 6).alias("score"))


@job("phrase_topk")
def phrase_topk(spark, sf_dir):
    freqs = phrases.phrase_frequencies(doc_phrases(spark, sf_dir), 2)
    return topk.top_n(freqs, TOP_PHRASES_N, term_col="phrase")


@job("class_phrase_topk")
def class_phrase_topk(spark, sf_dir):
    freqs = phrases.phrase_frequencies(doc_phrases(spark, sf_dir), 2, by=["lang"])
    return topk.class_top_n(freqs, "lang", TOP_CLASS_N, PHRASE_SKIPS, term_col="phrase")


# ---- 7. positions, chunks, splits -------------------------------------------

SPLIT = dict(test_p=0.1, test_seed="1", valid_p=0.15, valid_seed="15")
CHUNK_ROWS = 1000
SLICE = (100, 150)


@job("row_slice")
def row_slice(spark, sf_dir):
    """``.loc[:500]`` of the training table (501 rows)."""
    return rank.row_slice(documents(spark, sf_dir, ("doc_id", "lang")), "doc_id", 0, 500)


@job("row_slice_window")
def row_slice_window(spark, sf_dir):
    """A window inside the table (the reference takes ``.loc[1000:1200]`` of a longer one)."""
    return rank.row_slice(documents(spark, sf_dir, ("doc_id", "lang")), "doc_id", *SLICE)


@job("head_rows")
def head_rows(spark, sf_dir):
    return rank.head(documents(spark, sf_dir, ("doc_id", "lang", "text")), "doc_id", 5)


@job("chunked_union")
def chunked_union(spark, sf_dir):
    out = rank.chunked_union(documents(spark, sf_dir, ("doc_id", "lang")), "doc_id", CHUNK_ROWS)
    return out.select("doc_id", "lang", F.col("chunk").cast("long").alias("chunk"))


def split_documents(spark, sf_dir, stratify=None):
    return split.exact_split(documents(spark, sf_dir), "doc_id", stratify=stratify, **SPLIT)


@job("exact_split")
def exact_split(spark, sf_dir):
    return split_documents(spark, sf_dir).select("doc_id", "split")


@job("exact_split_stratified")
def exact_split_stratified(spark, sf_dir):
    return split_documents(spark, sf_dir, stratify="lang").select("doc_id", "lang", "split")


@job("split_leak_report")
def split_leak_report(spark, sf_dir):
    return split.split_leak_report(split_documents(spark, sf_dir))


@job("exact_split_grouped")
def exact_split_grouped(spark, sf_dir):
    """Equal texts stay in one part."""
    return split.exact_split_grouped(documents(spark, sf_dir), "text", **SPLIT).select("doc_id", "split")


@job("split_leak_report_grouped")
def split_leak_report_grouped(spark, sf_dir):
    return split.split_leak_report(split.exact_split_grouped(documents(spark, sf_dir), "text", **SPLIT))


# ---- 8-10. features, naive Bayes, reports ----------------------------------

def model_table(spark, sf_dir, target="lang"):
    """(doc_id, label, split, terms): split, label-encoded, normalised.  The
    target is the language, or a column of ``labels`` (null where a document
    has no label)."""
    sp = split_documents(spark, sf_dir)
    if target != "lang":
        sp = sp.join(read_table(spark, sf_dir, "labels", ["doc_id", target]), "doc_id", "left")
    sp = labels.label_encode(sp, target)
    # read by several counts
    return settled(terms.normalize_terms(sp, keep=["label", "split"]), "terms")


TRAIN = ("split", ["train", "valid"])
TEST = ("split", ["test"])


def tfidf_model(spark, sf_dir, target="lang"):
    """(the documents' labels, splits and blocks, blocks of counts, idf)."""
    mt = model_table(spark, sf_dir, target)
    n = features.block_count(spark)
    counts, idf, _ = features.tfidf_blocks(mt, F.col("split") != "test", keep=["label", "split"], parts=n)
    return mt.select("doc_id", "label", "split", features.block_of("doc_id", n).alias("b")), counts, idf


def weights(blocks, where=None, term="term"):
    return features.block_rows(blocks, keep=["label", "split"], where=where, term=term)


@job("doc_term_counts")
def doc_term_counts(spark, sf_dir):
    nt = terms.normalize_terms(documents(spark, sf_dir, ("doc_id", "text")))
    return features.term_counts(features.doc_terms(nt))


@job("tfidf_weights")
def tfidf_weights(spark, sf_dir):
    _, counts, idf = tfidf_model(spark, sf_dir)
    w = weights(features.with_known_terms(counts, idf, idf="double"))
    return w.select("doc_id", "term", "tf", F.round("weight", 6).alias("weight"))


PHRASE_SPLIT = dict(test_p=0.75, test_seed="42", valid_p=0.0, valid_seed="42")


@job("phrase_tfidf_weights")
def phrase_tfidf_weights(spark, sf_dir):
    """M8: TF-IDF of the keyphrases of two or more words as terms, fitted on a
    quarter of the documents."""
    sp = split.exact_split(documents(spark, sf_dir), "doc_id", **PHRASE_SPLIT)
    ph = phrases.rake_phrases(sp, keep=["split"]).where(F.col("n_words") >= 2)
    tf = features.term_counts(ph.select("doc_id", "split", F.col("phrase").alias("term")), keep=["split"]).checkpoint()
    n_train = sp.where(F.col("split") != "test").count()
    w = features.tfidf(tf, features.fit_idf(tf.where(F.col("split") != "test"), n_train))
    return w.select("doc_id", "term", "tf", F.round("weight", 6).alias("weight"))


def nb_model(spark, sf_dir, target="lang"):
    """(the documents' labels and splits, weights by blocks, class terms, classes)."""
    docs, counts, idf = tfidf_model(spark, sf_dir, target)
    blocks = features.with_known_terms(counts, idf, idf="double")
    dropped(counts)
    train_labels = docs.where(F.col("split") != "test").select("doc_id", "label")
    ct, classes = bayes.fit(weights(blocks, TRAIN).select("doc_id", "label", "term", "weight"), train_labels, idf.count())
    return docs, blocks, ct, classes


@job("nb_fit")
def nb_fit(spark, sf_dir):
    _, _, ct, _ = nb_model(spark, sf_dir)
    return ct.select("label", "term", F.round("cnt", 6).alias("cnt"), F.round("log_theta", 6).alias("log_theta"))


def nb_predictions(spark, sf_dir, target="lang"):
    docs, blocks, ct, classes = nb_model(spark, sf_dir, target)
    test = docs.where(F.col("split") == "test").select("doc_id", "label")
    pred = bayes.predict(weights(blocks, TEST), test.select("doc_id"), ct, classes)
    return test.join(pred.select("doc_id", "pred"), "doc_id")


@job("score_saved_nb")
def score_saved_nb(spark, sf_dir):
    """A naive Bayes model fitted on the training rows and
    stored; the test rows' texts scored with what was stored alone."""
    docs, path = labels.label_encode(split_documents(spark, sf_dir), "lang"), scratch_path(spark, "nb_model")
    # tokenised once, for the lemmas and for the fit
    tokens = terms.normalized_texts(docs, keep=["label", "split"])
    lemmas = settled(terms.corpus_lemmas(tokens, tokens_col="tokens"), "lemmas")
    textmodel.fit_nb(tokens.where("split <> 'test'"), lemmas, path, tokens_col="tokens")
    test = docs.where("split = 'test'")
    return test.select("doc_id", "label").join(textmodel.score_nb(test, path).select("doc_id", "pred"), "doc_id")


@job("text_classify_nb")
def text_classify_nb(spark, sf_dir):
    return nb_predictions(spark, sf_dir)


@job("quality_classify_nb")
def quality_classify_nb(spark, sf_dir):
    return nb_predictions(spark, sf_dir, "quality")


@job("quality_report")
def quality_report(spark, sf_dir):
    return _round_report(evaluate.classification_report(nb_predictions(spark, sf_dir, "quality")))


@job("toxic_report")
def toxic_report(spark, sf_dir):
    return _round_report(evaluate.classification_report(nb_predictions(spark, sf_dir, "toxic")))


def _round_report(df):
    return df.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@job("classification_report")
def classification_report(spark, sf_dir):
    return _round_report(evaluate.classification_report(nb_predictions(spark, sf_dir)))


@job("report_long")
def report_long(spark, sf_dir):
    r = evaluate.report_long(evaluate.classification_report(nb_predictions(spark, sf_dir)))
    return r.select("class", "metric", F.round("value", 6).alias("value"))


@job("accuracy_macro_f1")
def accuracy_macro_f1(spark, sf_dir):
    r = evaluate.accuracy_macro_f1(nb_predictions(spark, sf_dir))
    return r.select("n_rows", F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"))


# ---- 12. sequences ---------------------------------------------------------

MAX_LEN = 150
BATCH_SIZE = 4


def _ids_text(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


def document_sequences(spark, sf_dir, with_split=False):
    docs = split_documents(spark, sf_dir) if with_split else documents(spark, sf_dir, ("doc_id", "text"))
    keep = ["split"] if with_split else []
    # tokenised once, for the vocabulary and for the sequences
    docs = settled(sequences.with_seq_tokens(docs, "text", "_t").select("doc_id", *keep, "_t"), "tokens")
    vocab = sequences.vocabulary(explode_rows(docs, F.col("_t"), "token"))
    return sequences.pack_sequences(docs, vocab, tokens_col="_t", max_len=MAX_LEN,
                                    keep=keep)


@job("pack_sequences")
def pack_sequences(spark, sf_dir):
    s = document_sequences(spark, sf_dir)
    return s.select("doc_id", _ids_text("input_ids").alias("input_ids"), "n_tokens")


# fixed values: the public tokenizer's file and its start and end ids
SUBWORDS = ("word_bpe_49k.json", 49406, 49407)
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


@job("pack_subwords")
def pack_subwords(spark, sf_dir):
    """N1 in the subwords of a public tokenizer."""
    docs = sequences.with_seq_tokens(documents(spark, sf_dir, ("doc_id", "text")), "text", "_t")
    docs = settled(docs.select("doc_id", "_t"), "tokens")
    name, start, end = SUBWORDS
    with open(os.path.join(TOKENIZERS, name), encoding="utf-8") as f:
        vocab = sequences.subword_vocabulary(explode_rows(docs, F.col("_t"), "token"), f.read())
    s = sequences.pack_subwords(docs, vocab, start, end, tokens_col="_t", max_len=MAX_LEN)
    return s.select("doc_id", _ids_text("input_ids").alias("input_ids"), "n_tokens")


@job("pack_pairs")
def pack_pairs(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    conv = sequences.with_seq_tokens(conv, "text", "_t")
    vocab = sequences.vocabulary(explode_rows(conv, F.col("_t"), "token"))
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("_t").alias("a"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("_t").alias("b"))
    packed = sequences.pack_pairs(u.join(a, ["conv_id", "turn"]), vocab, ["conv_id", "turn"], MAX_LEN)
    return packed.select("conv_id", "turn", _ids_text("input_ids").alias("input_ids"),
                         _ids_text("token_type_ids").alias("token_type_ids"), "n_tokens")


@job("pack_batches")
def pack_batches(spark, sf_dir):
    b = sequences.pack_batches(document_sequences(spark, sf_dir, with_split=True), batch_size=BATCH_SIZE)
    return b.select("doc_id", "split", "batch", "position", _ids_text("input_ids").alias("input_ids"),
                    _ids_text("attention_mask").alias("attention_mask"))


# ---- 13. scores and losses over precomputed vectors -------------------------

def scored_vectors(spark, sf_dir):
    """(vec_id, label, at, l): dot products with the class means as logits,
    and the label's place among the classes."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    means = metrics.centroids(e, "embedding", "label")
    classes = F.array(*[F.lit(c) for c, _ in means])
    return e.select("vec_id", "label", (F.array_position(classes, F.col("label")) - 1).cast("int").alias("at"),
                    metrics.logits("embedding", means).alias("l")), classes


@job("argmax_predict")
def argmax_predict(spark, sf_dir):
    e, classes = scored_vectors(spark, sf_dir)
    return e.select("vec_id", "label", F.get(classes, metrics.argmax(F.col("l"))).alias("pred"))


@job("cross_entropy")
def cross_entropy(spark, sf_dir):
    e, _ = scored_vectors(spark, sf_dir)
    return e.select("vec_id", "label", F.round(metrics.cross_entropy(F.col("l"), F.col("at")), 6).alias("loss"))


@job("batch_losses")
def batch_losses(spark, sf_dir):
    """Mean loss of each batch, in id order."""
    e, _ = scored_vectors(spark, sf_dir)
    loss = e.select("vec_id", metrics.cross_entropy(F.col("l"), F.col("at")).alias("loss"))
    per = rank.with_chunks(loss, "vec_id", BATCH_SIZE).groupBy(F.col("chunk").alias("batch"))
    return per.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("loss"), 6).alias("loss"))


@job("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """The documents written as CSV and read with their schema."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    path = write_table(docs, scratch_path(spark, "csv"), "csv")
    return read_written(spark, path, "csv", docs.schema)


# ---- 14. histories (events as a metric log) ---------------------------------

def _epoch():
    return F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long")


@job("epoch_history")
def epoch_history(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    h = metrics.epoch_history(ev, _epoch(), F.col("event_id") % 16, F.col("value"), F.col("event_type"))
    return h.select("epoch", "split", F.round("loss", 6).alias("loss"))


@job("best_checkpoint")
def best_checkpoint(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["ts", "event_type"])
    per_epoch = ev.groupBy(_epoch().alias("epoch")).agg(
        (F.count_if(F.col("event_type") == "purchase") / F.count(F.lit(1))).alias("metric"))
    b = metrics.best_checkpoint(per_epoch, "metric", 0.0)
    return b.select("epoch", F.round("metric", 6).alias("metric"), F.round("best_before", 6).alias("best_before"), "saved")


# ---- 15. summaries ---------------------------------------------------------

@job("extractive_summary")
def extractive_summary(spark, sf_dir):
    return summary.extractive_summary(documents(spark, sf_dir, ("doc_id", "text")))


@job("ranked_summary")
def ranked_summary(spark, sf_dir):
    """The two sentences that rank highest in each document's graph."""
    s = sentencegraph.ranked_summary(documents(spark, sf_dir, ("doc_id", "text")))
    return s.select("doc_id", F.array_join(F.col("sentences").cast("array<string>"), " ").alias("sentences"), "summary")


# ---- 11. MLlib classifiers, LSA and the vector head (rows-only checks) ------

LSA_K = 500


def ml_matrix(spark, sf_dir):
    """(model table, matrix entries with label and split, number of terms)."""
    docs, blocks, n_terms = ml_blocks(spark, sf_dir)
    return docs.drop("b"), weights(blocks, term="tid").drop("tf"), n_terms


def ml_blocks(spark, sf_dir):
    """(model table, weights by blocks with the terms' numbers, number of terms)."""
    docs, counts, idf = tfidf_model(spark, sf_dir)
    numbered = idf.join(models.term_numbers(idf), "term")
    blocks = features.with_known_terms(counts, numbered, idf="double", tid="long")
    dropped(counts)
    return docs, blocks, idf.count()


def _classified(feats, features, path=None):
    """Logistic regression fitted on the labelled training rows; predictions
    for the test rows."""
    feats = models.spread_by_id(feats).checkpoint()
    train = feats.where((F.col("split") != "test") & F.col("label").isNotNull()).withColumn("label", F.col("label").cast("double"))
    model = models.fit_save_load(models.logistic(train.count(), features=features), train, path)
    pred = model.transform(feats.where(F.col("split") == "test"))
    return pred.select("doc_id", "label", F.col("prediction").cast("int").alias("pred"))


def lr_predictions(spark, sf_dir):
    """M4: fitted on the labelled training rows, the coefficients in blocks of
    terms; predictions for the test rows."""
    docs, blocks, n_terms = ml_blocks(spark, sf_dir)
    docs, size = logistic.number_documents(docs)
    x = logistic.document_matrix(blocks, docs, size, n_terms)
    dropped(blocks)
    train, top = docs.select("dn", F.when(F.col("split") != "test", F.col("label")).alias("label")), docs.agg(F.max("label")).first()[0]
    model = logistic.fit_matrix(x, train, top + 1)
    pred = logistic.predictions(model, top + 1)
    return docs.where(F.col("split") == "test").join(pred, "dn").select("doc_id", "label", "pred")


@job("text_classify_lr")
def text_classify_lr(spark, sf_dir):
    return lr_predictions(spark, sf_dir)


@job("lr_report")
def lr_report(spark, sf_dir):
    return _round_report(evaluate.classification_report(lr_predictions(spark, sf_dir)))


def lsa_vectors(spark, sf_dir):
    """(docs, (doc_id, lsa), singular values): fitted on the training rows,
    every row projected."""
    docs, x, _ = ml_matrix(spark, sf_dir)
    s, v = models.lsa(x.where(F.col("split") != "test"), LSA_K)
    return docs, models.lsa_project(x, v, len(s)), s


@job("lsa_project")
def lsa_project(spark, sf_dir):
    """(doc_id, component, value): size of each document's projection; the sign
    of a component is arbitrary."""
    _, proj, _ = lsa_vectors(spark, sf_dir)
    return proj.select("doc_id", F.posexplode("lsa").alias("component", "value")).select(
        "doc_id", "component", F.round(F.abs("value"), 6).alias("value"))


def lsa_lr_predictions(spark, sf_dir):
    docs, proj, s = lsa_vectors(spark, sf_dir)
    zero = F.array_repeat(F.lit(0.0), len(s))
    feats = docs.join(proj, "doc_id", "left").select(
        "doc_id", "label", "split", array_to_vector(F.coalesce("lsa", zero)).alias("lsa"))
    return _classified(feats, "lsa")


@job("text_classify_lsa_lr")
def text_classify_lsa_lr(spark, sf_dir):
    return lsa_lr_predictions(spark, sf_dir)


@job("lsa_lr_report")
def lsa_lr_report(spark, sf_dir):
    return _round_report(evaluate.classification_report(lsa_lr_predictions(spark, sf_dir)))


@job("embedding_head")
def embedding_head(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    e = split.exact_split(e, "vec_id", test_p=0.15, test_seed="15", valid_p=0.0, valid_seed="15")
    e = e.select("vec_id", F.col("label").cast("double").alias("label"), "split",
                 array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    e = models.spread_by_id(e, "vec_id").checkpoint()
    k, d = e.agg(F.max("label"), F.max(F.size(vector_to_array("features")))).first()
    model = models.mlp_head(int(d), int(k) + 1).fit(e.where(F.col("split") == "train"))
    pred = model.transform(e.where(F.col("split") == "test"))
    return pred.select("vec_id", F.col("label").cast("int").alias("label"),
                       F.col("prediction").cast("int").alias("pred"))


# ---- 16. training by epochs, and its stored versions -------------------------

HEAD = dict(epochs=5, batch_rows=128, rate=5e-3, seed=15)


def embedding_splits(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return split.exact_split(e, "vec_id", test_p=0.1, test_seed="1", valid_p=0.15, valid_seed="15").checkpoint()


@job("head_epochs")
def head_epochs(spark, sf_dir):
    """The history of a fit by epochs."""
    h = training.fit_head(embedding_splits(spark, sf_dir), scratch_path(spark, "head"), **HEAD)
    return h.select("epoch", "split", F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"), "saved")


@job("head_best_predictions")
def head_best_predictions(spark, sf_dir):
    """A fit that is stopped halfway, resumed from its stored
    version, and the test rows' classes by its best epoch."""
    e, path = embedding_splits(spark, sf_dir), scratch_path(spark, "head")
    training.fit_head(e, path, stop_after=HEAD["epochs"] // 2, **HEAD)
    training.fit_head(e, path, **HEAD)
    return training.predict_head(e.where("split = 'test'"), path, keep=("label",))


# ---- 17. ingestion, resumable chunks, mergeable counts -----------------------

def _ingested(spark, sf_dir):
    schema = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "n_chars"]).schema
    return ingest_csv(spark, broken_csv(spark, sf_dir), schema, header=False)


@job("csv_ingest")
def csv_ingest(spark, sf_dir):
    """Records of gzip CSV files, those that don't fit the schema with
    the reason."""
    accepted, rejected = _ingested(spark, sf_dir)
    none = F.lit(None).cast("string")
    return accepted.select("doc_id", "text", "lang", "n_chars", F.lit("accepted").alias("status"), none.alias("column"),
                           none.alias("value")).unionByName(rejected.select(
        F.split_part("record", F.lit(","), F.lit(1)).cast("long").alias("doc_id"), none.alias("text"), none.alias("lang"),
        F.lit(None).cast("long").alias("n_chars"), F.col("reason").alias("status"), "column", "value"))


@job("csv_accounts")
def csv_accounts(spark, sf_dir):
    """Accepted and rejected records over all files; together all that was written."""
    return record_counts(*_ingested(spark, sf_dir)).agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"),
        F.sum(F.col("accepted") + F.col("rejected")).alias("records"))


RUN_CHUNK_ROWS = 150


@job("chunk_run_resumed")
def chunk_run_resumed(spark, sf_dir):
    """Cleaning by chunks, stopped after the first job and resumed."""
    docs, path = documents(spark, sf_dir), scratch_path(spark, "chunk_run")
    work = lambda rows: clean.clean_corpus(rows, keep=["chunk"])
    chunks.run_chunks(docs, "doc_id", work, path, RUN_CHUNK_ROWS, at_once=2, stop_after=1)
    return chunks.run_chunks(docs, "doc_id", work, path, RUN_CHUNK_ROWS).select("doc_id", "chunk", "clean_text")


@job("token_topk_batches")
def token_topk_batches(spark, sf_dir):
    """The corpus counted in three batches, one of them added twice
    and one taken back and added again, compacted on the way; the top words."""
    toks, path = clean_tokens(spark, sf_dir).checkpoint(), scratch_path(spark, "counts")
    batch = lambda k: toks.where(F.pmod("doc_id", F.lit(3)) == k)
    for k in (0, 1, 0):
        mergecounts.add_batch(path, f"batch{k}", batch(k))
    mergecounts.compact(spark, path)
    mergecounts.remove_batch(spark, path, "batch1")
    mergecounts.add_batch(path, "batch2", batch(2))
    mergecounts.add_batch(path, "batch1", batch(1))
    return topk.top_n(mergecounts.totals(spark, path), TOP_TOKENS_N)
