"""Operators 1, 5, 6 and 10 against the tokenizers' libraries and brute force,
and their edge cases; the pipeline against brute force."""
import collections
import itertools
import math
import random

import numpy as np
import pytest

from lexispark.llm import decontaminate, lmscore, sentencepieces, tokencounts
from lexispark.llm.queries import BYTE_BPE_EOD, BYTE_BPE_PATTERN, TOKENIZERS

SF = "/root/testdata/sf0.001"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def some(spark, n=40):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n).collect()]


ODD = [(2001, None), (2002, ""), (2003, " "), (2004, "a  b"), (2005, "日本語 😀 \x00\x01 é"), (2005, "日本語 😀 \x00\x01 é"),
       (None, "=" * 300 + " " * 40 + "x" * 150 + "\n\n\tcode"), (2007, "word " * 20_000)]


# ---- SentencePiece -------------------------------------------------------------------

def test_sentencepiece_equals_the_library(spark):
    import sentencepiece
    path = f"{TOKENIZERS}/piece_bpe_32k.model"
    lib, model = sentencepiece.SentencePieceProcessor(model_file=path), sentencepieces.read_model(path)
    rng = random.Random(2)
    odd = [(3000 + i, "".join(rng.choice("ab  etion=-.\nthe日é😀") for _ in range(rng.randrange(150)))) for i in range(40)]
    df = spark.createDataFrame(some(spark) + ODD + odd, "doc_id long, text string").selectExpr("*", "1 as block", "2 as unit", "3 as ids")
    got = sentencepieces.decode(sentencepieces.encode(df, model, decoded=True, block_chars=60_000), model, name="again").collect()
    assert len(got) == df.count()
    for r in got:
        assert r["ids"] == lib.encode(r["t"] or "") and r["decoded"] == r["again"] == (r["t"] or "")
    assert sentencepieces.encode(df.limit(0), model).count() == 0


def test_viterbi_equals_brute_force(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) for _ in range(14)} | {"a"}
    pieces = [(w, i, -rng.random() * 5) for i, w in enumerate(sorted(words))]
    model = sentencepieces.Model(False, False, pieces, None, 99, 100, {})
    units = ["a" * 5, "abab", "b", "bbabba", "aabbaabb", "acb"]
    got = {r["unit"]: r["ids"] for r in sentencepieces.encode_units(spark.createDataFrame([(u, 0, len(u)) for u in units], "unit string, low int, size int"), model).collect()}
    table = {p: (i, s) for p, i, s in pieces}
    floor = min(s for _, _, s in pieces) - 10

    def all_cuts(u):
        for cuts in itertools.product([0, 1], repeat=len(u) - 1):
            at = [0] + [i + 1 for i, c in enumerate(cuts) if c] + [len(u)]
            yield [u[a:b] for a, b in zip(at, at[1:])]

    for u in units:
        score = {}
        for parts in all_cuts(u):
            if all(p in table or len(p) == 1 for p in parts):
                ids = tuple(table[p][0] if p in table else 99 for p in parts)
                score[ids] = sum(table[p][1] if p in table else floor for p in parts)
        assert math.isclose(score[tuple(got[u])], max(score.values()))
        assert sentencepieces.encode_long(model, table, u) == got[u] or math.isclose(
            score[tuple(sentencepieces.encode_long(model, table, u))], max(score.values()))


# ---- LM scoring ------------------------------------------------------------------------

@pytest.mark.parametrize("order", [1, 2, 3])
def test_stupid_backoff_by_hand(spark, order):
    rows = some(spark, 30) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as g", "2 as c", "3 as block")
    got = collections.Counter((r["doc_id"], r["n_units"], round(r["lm_score"], 5)) for r in lmscore.lm_scores(
        df, RANKS, BYTE_BPE_PATTERN, order=order, block_chars=20_000).collect())
    units = lmscore.encoder(RANKS, BYTE_BPE_PATTERN)
    ids = [units([t or ""])[1].tolist() for _, t in rows]
    count = collections.Counter(tuple(x[j:j + n]) for x in ids for n in range(1, order + 1) for j in range(len(x) - n + 1))
    total = sum(map(len, ids))

    def s(x, j, n):
        if n == 1:
            return count[(x[j],)] / total
        g = tuple(x[j - n + 1:j + 1])
        return count[g] / count[g[:-1]] if count[g] >= 2 else 0.4 * s(x, j, n - 1)

    want = collections.Counter((i, len(x), round(sum(math.log10(s(x, j, min(order, j + 1))) for j in range(len(x))), 5))
                               for (i, _), x in zip(rows, ids))
    assert got == want


def leave_one_out_by_hand(ids, order, backoff=0.4):
    """Scores of each text's units by the counts of the others."""
    grams = [collections.Counter(tuple(x[j:j + n]) for n in range(1, order + 1) for j in range(len(x) - n + 1)) for x in ids]
    count, total, taken = sum(grams, collections.Counter()), sum(map(len, ids)), collections.Counter()

    def s(x, own, j, n):
        g = tuple(x[j - n + 1:j + 1])
        here = count[g] - own[g]
        if n == 1:
            return (here or backoff) / max(1, total - len(x))
        if here >= 1:
            return here / (count[g[:-1]] - own[g[:-1]])
        taken["backoff"] += 1
        return backoff * s(x, own, j, n - 1)

    scores = [sum(math.log10(s(x, own, j, min(order, j + 1))) for j in range(len(x))) for x, own in zip(ids, grams)]
    return scores, taken["backoff"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_leave_one_out_by_hand(spark, monkeypatch, order):
    monkeypatch.setattr(lmscore, "CHUNK_UNITS", 500)
    monkeypatch.setattr(lmscore, "CHUNK_TEXTS", 3)
    rows = some(spark, 30) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string")
    units = lmscore.encoder(RANKS, BYTE_BPE_PATTERN)
    ids = [units([t or ""])[1].tolist() for _, t in rows]
    scores, backed_off = leave_one_out_by_hand(ids, order)
    want = collections.Counter((i, len(x), round(v, 5)) for (i, _), x, v in zip(rows, ids, scores))
    for block_chars in (20_000, 10_000_000):
        got = lmscore.lm_scores(df, RANKS, BYTE_BPE_PATTERN, order, 1, leave_one_out=True, block_chars=block_chars)
        assert collections.Counter((r["doc_id"], r["n_units"], round(r["lm_score"], 5)) for r in got.collect()) == want
    assert order == 1 or backed_off > 100


def test_registered_lm_leaves_the_document_out(spark, tmp_path):
    from lexispark.llm.queries import op5_lm_score
    rows = [(1, "one two three four"), (2, "one two five"), (3, "six"), (4, "one two three")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    units = lmscore.encoder(RANKS, BYTE_BPE_PATTERN)
    ids = [units([t])[1].tolist() for _, t in rows]
    want = {i: v for (i, _), v in zip(rows, leave_one_out_by_hand(ids, 3)[0])}
    for r in op5_lm_score(spark, str(tmp_path)).collect():
        assert abs(r["lm_score"] - want[r["doc_id"]]) < 1e-9


def test_blocks_are_encoded_once(spark):
    """Both readers of the blocks share one exchange."""
    df = lmscore.lm_scores(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), RANKS, BYTE_BPE_PATTERN)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("MapInArrow") == 1


def test_very_long_white_space(spark):
    import tiktoken
    codec = tiktoken.Encoding("t", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=tokencounts.read_ranks(RANKS), special_tokens={})
    for n in (4095, 4096, 4097, 9000):
        for run in ("\n" * n, " " * n, " \n" * n, "\u3000\t" * n):
            for text in (run, f"a{run}", f"{run}b", f"a{run} b", f"a{run}\nb.", f"a {run}'s {run}1"):
                assert tokencounts.encode_text(codec, text).tolist() == codec.encode_ordinary(text)
    rows = [(1, "\n" * 2_000_000), (2, "a" + " " * 2_000_000 + "b"), (3, "plain text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = {i: len(tokencounts.encode_text(codec, t)) for i, t in rows}
    assert {r["doc_id"]: r["n_units"] for r in lmscore.lm_scores(df, RANKS, BYTE_BPE_PATTERN, leave_one_out=True).collect()} == n
    assert {r["doc_id"]: r["n_tokens"] for r in tokencounts.document_token_counts(
        df, RANKS, BYTE_BPE_PATTERN, BYTE_BPE_EOD).collect()} == n


def test_lm_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lmscore.lm_scores(df, RANKS, BYTE_BPE_PATTERN).count() == 0
    r = lmscore.lm_scores(spark.createDataFrame([(1, None)], "doc_id long, text string"), RANKS, BYTE_BPE_PATTERN).first()
    assert (r["n_units"], r["lm_score"], r["mean_score"], r["perplexity"]) == (0, 0.0, None, None)


# ---- decontamination ---------------------------------------------------------------------

def semi_global(p, t):
    """Fewest edits between ``p`` and any part of ``t``."""
    prev = np.zeros(len(t) + 1, int)
    tc = np.array([ord(c) for c in t])
    for i, c in enumerate(p):
        cur = np.minimum(prev[1:] + 1, prev[:-1] + (tc != ord(c)))
        cur = np.r_[i + 1, cur]
        cur = np.minimum.accumulate(cur - np.arange(len(cur))) + np.arange(len(cur))
        prev = cur
    return int(prev.min())


def test_search_equals_full_alignment(spark, monkeypatch):
    rng = random.Random(6)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    s = decontaminate.Segments.of(items, 120, 0.1, 24)
    texts = []
    for k in range(60):
        x = list(decontaminate.normalise(items[k % len(items)][1]))
        for _ in range(rng.randrange(0, int(0.16 * len(x)))):
            j, what = rng.randrange(len(x)), rng.randrange(3)
            x[j:j + 1] = [] if what == 0 else [rng.choice("abcd ")] if what == 1 else [x[j], rng.choice("abcd")]
        texts.append(decontaminate.normalise("some words before " + "".join(x) + " and words after it"))
    for hits, piece in ((8_000_000, 1 << 20), (300, 200)):
        monkeypatch.setattr(decontaminate, "MAX_HITS", hits)
        monkeypatch.setattr(decontaminate, "PIECE_CHARS", piece)
        got = {(i, g): e for i, g, e, _, _ in decontaminate.search(texts, s)}
        for i, t in enumerate(texts):
            for g, seg in enumerate(s.texts):
                if s.items[g] == items[i % len(items)][0]:
                    edits = semi_global(seg, t)
                    assert got.get((i, g)) == (edits if edits <= s.budget[g] else None)


def test_leaks_of_the_documents(spark, monkeypatch):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    norm = decontaminate.normalise
    items = [(r["item_id"], norm(r["text"])) for r in bench.collect()]
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in norm(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert want and got == want
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2_000)  # several blocks
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == want
    kept = decontaminate.drop_leaks(docs, bench, tuple(docs.columns))
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {i for i, _ in want}


def test_edits_that_need_shorter_qgrams():
    """Three edits in 30 characters leave no 8-gram for sure."""
    rng = random.Random(9)
    items = [(k, "".join(rng.choice("abcdefgh") for _ in range(n))) for k, n in enumerate([30, 31, 24, 25, 45])]
    for error in (0.1, 0.2, 0.34):
        s = decontaminate.Segments.of(items, 120, error, 24)
        texts, want = [], {}
        for k, t in items:
            for _ in range(12):
                x = list(t)
                for _ in range(rng.randrange(0, int(error * len(t)) + 3)):
                    j, what = rng.randrange(len(x)), rng.randrange(3)
                    x[j:j + 1] = [] if what == 0 else [rng.choice("abcd")] if what == 1 else [x[j], "z"]
                texts.append("xyz " + "".join(x) + " xyz")
                for m, u in items:
                    edits = semi_global(u, texts[-1])
                    if edits <= int(error * len(u)):
                        want[len(texts) - 1, m] = edits
        assert {(i, s.item(g)): e for i, g, e, _, _ in decontaminate.search(texts, s)} == want
        assert any(e == 3 for (_, m), e in want.items() if m == 0)


def test_short_items_are_found_exactly(spark):
    bench = spark.createDataFrame([(1, "Tiny  item"), (2, "tiny item"), (3, "yes"), (4, ""), (5, "c++")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a TINY\nitem."), (2, "tiny items"), (3, "eyes, YES!"), (4, "eyes"), (5, "in c++ and"),
                                  (6, "tinyitem")], "doc_id long, text string")
    got = decontaminate.leaks(docs, bench, short_items=True).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in got) == [(1, 1, 0), (1, 2, 0), (3, 3, 0), (5, 5, 0)]
    assert {tuple(r["spans"][0]) for r in got if r["doc_id"] == 3} == {(6, 9, 0)}
    kept = decontaminate.drop_leaks(docs, bench, ("doc_id",), short_items=True)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 6]
    assert decontaminate.leaks(docs, bench).count() == 0


def test_leak_edges(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "tiny"), (4, "Exactly this  question should be found again"),
                                   (5, "exactly this question should be found AGAIN")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "tiny"), (None, "so: EXACTLY this question should be\nfound again!"),
         (7, "x " * 700_000 + "exactly this question should be found again"), (7, "a b")], "doc_id long, text string")
    got = decontaminate.leaks(docs.selectExpr("*", "1 as item_id", "2 as edits"), bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in got) == [(0, 4), (0, 5), (7, 4), (7, 5)]
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.drop_leaks(docs, bench, ("doc_id",)).count() == 4


# ---- token counts ------------------------------------------------------------------------

@pytest.mark.parametrize("run", [1024, 2])
@pytest.mark.parametrize("open_tail", [False, True])
def test_separator_scan_by_hand(spark, monkeypatch, run, open_tail):
    monkeypatch.setattr(tokencounts, "RUN", run)
    rng = np.random.default_rng(3)
    rows, want = [], collections.Counter()
    for f, (n, p) in enumerate([(0, .1), (1, 1.0), (50, 0.0), (400, .02), (333, .4), (64, 1.0), (700, .005)]):
        ids = np.where(rng.random(n) < p, 9, rng.integers(0, 9, n)).astype("<u2")
        rows += [(f"f{f}", b, ids[b * 16:b * 16 + 16].tobytes()) for b in range(-(-n // 16))]
        size, k = 0, 0
        for x in ids.tolist():
            if x == 9:
                want[f"f{f}", k, size] += 1
                size, k = 0, k + 1
            else:
                size += 1
        if open_tail and size:
            want[f"f{f}", k, size] += 1
    rows.append(("none", 0, None))
    df = spark.createDataFrame(rows, "file string, block long, payload binary").selectExpr("*", "1 as run", "2 as first")
    got = tokencounts.count_tokens(df, 9, open_tail=open_tail).collect()
    assert collections.Counter(map(tuple, got)) == want


def test_document_token_counts(spark):
    import tiktoken
    codec = tiktoken.Encoding("t", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=tokencounts.read_ranks(RANKS), special_tokens={})
    rows = some(spark) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as file", "2 as block").repartition(5)
    got = tokencounts.document_token_counts(df, RANKS, BYTE_BPE_PATTERN, BYTE_BPE_EOD).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in got) == collections.Counter(
        (i, len(codec.encode_ordinary(t or ""))) for i, t in rows)
    assert tokencounts.document_token_counts(df.limit(0), RANKS, BYTE_BPE_PATTERN, BYTE_BPE_EOD).count() == 0


# ---- pipeline ------------------------------------------------------------------------------

def test_pipeline_by_hand(spark):
    import sentencepiece

    import corpus_pipeline as P
    from lexispark.llm import langid, simhash
    from test_language_lines_simhash import closure, lines_by_hand, simhash_by_hand

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*P.DOCUMENT).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    filt = langid.learn(df.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    lang, score = langid.score_texts([r[1] or "" for r in rows], filt)
    rows = [r for r, x, s in zip(rows, lang, score) if x != "und" and s >= P.MIN_LANGUAGE_SCORE]
    texts = lines_by_hand(rows, 0.05, 5)
    fps = {r[0]: simhash_by_hand(t) for r, t in zip(rows, texts)}
    root = closure(set(fps.values()))
    first = {}
    for i, f in sorted(fps.items()):
        first.setdefault(root[f], i)
    norm = decontaminate.normalise
    items = [norm(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    lib = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    want = {r[0]: lib.encode(t) for r, t in zip(rows, texts)
            if r[0] in set(first.values()) and not any(x in norm(t) for x in items)}
    got = P.run(spark, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want and len(got) == len(want)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert simhash.SEED == 42
