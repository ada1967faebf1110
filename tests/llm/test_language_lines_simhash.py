"""Operators 2, 8 and 9 against brute force, and their edge cases."""
import collections
import hashlib
import random

import pytest
import xxhash

from lexispark.llm import components, langid, linededup, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame(rows, schema)


# ---- language ID -------------------------------------------------------------

def test_language_held_out_accuracy(spark, docs):
    held = "crc32(cast(doc_id as string)) % 4 = 2"
    filt = langid.learn(docs.where(f"not ({held})"))
    got = langid.predict(docs.where(held), filt, keep=("doc_id", "lang")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_bit_sliced_filter_has_no_false_negatives(spark):
    rows = [(i, "the cat sat on the mat " * 3, "en", "s", 1) for i in range(5)]
    rows += [(9 + i, "der hund und die katze " * 3, "de", "s", 1) for i in range(5)]
    filt = langid.learn(frame(spark, rows), slots_log2=12)
    assert filt.langs == ("de", "en")
    for text, lang in (("the cat", "en"), ("die katze", "de")):
        _, code = langid.trigrams([text])
        found = filt.masks[0][langid.slots_of(code, filt.hashes, 12)[0]]
        for s in langid.slots_of(code, filt.hashes, 12)[1:]:
            found = found & filt.masks[0][s]
        assert all(int(m) >> filt.langs.index(lang) & 1 for m in found)
        assert langid.score_texts([text], filt)[0] == [lang]


def test_language_edge_cases(spark):
    rows = [(1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "12 !?", "en", "s", 5),
            (None, "hello there", "en", "s", 5), (5, "word " * 300_000, "en", "s", 5)]
    df = frame(spark, rows).selectExpr("*", "'x' as lang_pred_", "'y' as l", "1 as s")
    filt = langid.learn(df)
    got = langid.predict(df, filt).collect()
    assert len(got) == 6
    assert [r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)] == ["und"] * 4
    assert langid.predict(df.limit(0), filt).count() == 0
    none = langid.learn(df.where("lang is null"))
    assert {r["lang_pred"] for r in langid.predict(df, none).collect()} == {"und"}


# ---- line dedup ----------------------------------------------------------------

def lines_by_hand(rows, max_ratio, min_pages):
    pages, seen = collections.Counter(), collections.defaultdict(collections.Counter)
    for _, text, _, host, _ in rows:
        pages[host] += 1
        for line in set((text or "").split("\n")):
            seen[host][line] += 1
    bad = {(h, x) for h in seen for x, n in seen[h].items() if x.strip(" ") and n >= min_pages and n / pages[h] > max_ratio}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (h, x) not in bad) for _, t, _, h, _ in rows]


@pytest.mark.parametrize("limit", [linededup.BROADCAST_HOSTS, 0])
def test_line_dedup_by_hand(spark, monkeypatch, limit):
    monkeypatch.setattr(linededup, "BROADCAST_HOSTS", limit)  # 0: the salted join
    rng = random.Random(5)
    lines = [f"line {i}" for i in range(30)] + ["", " ", "menu", "menu", "menu"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(6))), "en", rng.choice(["a", "b", None]), 0)
            for i in range(120)]
    rows += [(500, None, "en", "a", 0), (501, "", "en", "a", 0), (rows[0])]
    got = linededup.drop_boilerplate(frame(spark, rows), 0.1, 3).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in got) == collections.Counter(
        zip((r[0] for r in rows), lines_by_hand(rows, 0.1, 3)))
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    assert any(r["n_dropped"] for r in got)


def test_pipeline_keeps_one_of_a_large_copy_group(spark):
    """Copies over the ratio on two hosts; the menu of all pages still goes."""
    import corpus_pipeline
    text = lambda k: "\n".join(" ".join(hashlib.md5(f"{k}.{j}.{w}".encode()).hexdigest()[:6] for w in range(12)) for j in range(4))
    rows = [(i, f"menu\n{text(i)}", "en", "ab"[i % 2], 0) for i in range(60)]
    rows += [(1000 + i, f"menu\n{text('copied')}", "en", "a", 0) for i in range(30)]
    rows += [(2000 + i, f"menu\n{text('other')}", "en", "b", 0) for i in range(10)]
    lines = corpus_pipeline.line_dedup(spark, frame(spark, rows), None)
    assert {r["text"] for r in lines.collect()} == {t.removeprefix("menu\n") for _, t, *_ in rows}
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.near_dedup(spark, lines, None).collect()}
    assert set(kept) == {*range(60), 1000, 2000} and kept[1000] == text("copied") and kept[2000] == text("other")


def test_line_dedup_keeps_columns_and_empty(spark):
    df = frame(spark, [(1, "a\nb", "en", "h", 3)]).selectExpr("*", "7 as host", "8 as pages", "9 as line_hash")
    out = linededup.drop_boilerplate(df)
    assert out.columns == df.columns + ["n_lines", "n_dropped"]
    assert out.first()["text"] == "a\nb" and out.first()["host"] == 7
    assert linededup.drop_boilerplate(df.limit(0)).count() == 0


# ---- SimHash -------------------------------------------------------------------

def simhash_by_hand(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def test_fingerprint_by_hand():
    for t in (None, "", " \n ", "One", "one two", "A b\tc\x0bd É x", "a b c d " * 50, "a\x1fb c\x85d e f"):
        assert simhash.fingerprint(t, 3) == simhash_by_hand(t)


def closure(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and bin(a ^ b).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("dense", [2, 64])
@pytest.mark.parametrize("n", [50, 10**9])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, dense, n):
    """Small and large cells, and the grids of few and of very many fingerprints."""
    monkeypatch.setattr(simhash, "DENSE", dense)
    rng = random.Random(1)
    fps = {0, 1, 3, 2**64 - 1}
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 9])):
            fps.add(f)
            for _ in range(rng.randrange(4)):
                f ^= 1 << rng.randrange(64)
    want = closure(fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    got = {f: f for f in fps}
    for r in components.components(simhash.link_fingerprints(df, n)).collect():
        got[r["node"] % 2**64] = r["root"] % 2**64
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert groups(got) == groups(want)


def test_near_duplicates_by_hand(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, rows[5][1]), (3, rows[3][1]), (1003, rows[7][1] + " x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fp = [simhash_by_hand(t) for _, t in rows]
    root = closure(set(fp))
    low = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            low[root[f]] = min(i, low.get(root[f], i))
    want = collections.Counter((i, f"{f:016x}", low[root[f]]) for (i, _), f in zip(rows, fp))
    got = simhash.near_duplicates(df).collect()
    assert collections.Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    kept = simhash.keep_one(df.selectExpr("*", "1 as fp", "2 as root")).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(low.values()))
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (5, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


# ---- ties and long texts ---------------------------------------------------------

def test_a_line_at_the_ratio_stays_and_long_texts_are_read_whole(spark):
    rows = [(i, f"own {i}\n" + "one\n" * (i == 0) + "two\n" * (i < 2) + "end", None, "h", 0) for i in range(20)]
    long_text = "\n".join(f"line {k}" for k in range(60_000)) + "\ntwo"
    rows[1] = (1, long_text, None, "h", 0)
    got = {r["doc_id"]: r for r in linededup.drop_boilerplate(frame(spark, rows), 0.05, 1).collect()}
    assert [r["text"] for _, r in sorted(got.items())] == lines_by_hand(rows, 0.05, 1)
    assert "one" in got[0]["text"].split("\n") and "two" not in got[0]["text"].split("\n")
    assert got[1]["n_lines"] == 60_001 and got[1]["n_dropped"] == 1


def test_simhash_bits_at_half_are_zero_and_long_texts_count_whole(spark):
    one, two = (xxhash.xxh64_intdigest(g, 42) for g in (b"a b c", b"b c d"))
    assert simhash.fingerprint("a b c d", 3) == one & two  # a bit that one of two shingles has is a tie
    rng = random.Random(1)
    text = " ".join(rng.choice(["red", "blue", "green", "day", "night"]) + str(rng.randrange(50)) for _ in range(20_000))
    df = frame(spark, [(1, text, None, None, 0), (2, text[:-1], None, None, 0), (3, "w " * 400_000, None, None, 0)])
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.near_duplicates(df).collect()}
    assert got[1] == f"{simhash_by_hand(text):016x}" and got[3] == f"{simhash_by_hand('w w w'):016x}"
