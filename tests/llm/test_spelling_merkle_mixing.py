"""Operators 11 to 13 against brute force, and their edge cases."""
import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexispark.llm import merkle, mixing, queries, spelling
from lexispark.llm.positions import positions

SF = "/root/testdata/sf0.001"
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame(rows, schema)


def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing column names."""
    rows = [(1, None, "en", "s", None), (1, None, "en", "s", None), (2, "", None, None, 0), (None, "ÀB cd", "en", "s", 5),
            (None, "ab", None, "t", 2), (3, "Word " * 200_000, "", "", 1_000_000), (4, "x" * 300_000, "zz", "s", 300_000),
            (4, "x" * 300_000, "zz", "s", 300_000)] + [(9, "same Words", "en", "s", 10)] * 40
    return frame(spark, rows).selectExpr("*", "1 as rank", "2 as tree", "3 as k", "'q' as key", "4 as size", "5 as pos", "6 as `__part`")


# ---- positions ------------------------------------------------------------------

def test_positions_number_every_group(spark):
    rows = [(None if i % 3 else "a", i % 5) for i in range(500)] + [("hot", 7)] * 1500
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    got = positions(df, ["g"], [F.col("v").desc()]).collect()
    for g in (None, "a", "hot"):
        own = sorted((r["pos"], -r["v"]) for r in got if r["g"] == g)
        assert [p for p, _ in own] == list(range(sum(x[0] == g for x in rows)))
        assert [v for _, v in own] == sorted(v for _, v in own)


# ---- spelling variants -------------------------------------------------------------

def near_of(words):
    letters = sorted({c for w in words for c in w})
    out = {}
    for w in words:
        close = {w[:i] + w[i + 1:] for i in range(len(w))}
        close |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        close |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        out[w] = (close & words.keys()) - {w}
    return out


def brute_variants(words, ratio=5):
    near, form = near_of(words), {}
    for w, close in near.items():
        if close:
            f = min(close, key=lambda y: (-words[y], y))
            if words[f] >= ratio * words[w]:
                form[w] = f

    def root(w):
        while w in form:
            w = form[w]
        return w
    return Counter((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


def brute_words(rows, every=199, least=6, count=5):
    c = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= least and n >= count}


def as_counter(df):
    return Counter((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def test_spelling_query_against_brute_force(spark, docs):
    assert as_counter(queries.op11_spelling(spark, SF)) == brute_variants(brute_words(docs.collect()))


def test_dense_words_chains_and_ties(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(3, 6))): rng.choice([1, 1, 5, 5, 25, 200]) for _ in range(600)}
    words |= {"a" * k: 7 ** (k % 4) for k in range(1, 9)}
    want = brute_variants(words)
    got = as_counter(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == want
    assert any(r[1] and r[1] != r[2] for r in want)  # some chain of more than one step


def test_rotation_keys_are_of_the_rotations():
    def fingerprint(codes):
        h = 0
        for c in codes:
            h = (h * spelling.BASE + c) % spelling.PRIME
        return h
    without, whole = spelling.rotation_keys("abca")
    w = [*map(ord, "abca")]
    assert without == [fingerprint([*w[i + 1:], spelling.END, *w[:i]]) for i in range(4)]
    assert whole == [fingerprint([*w[i:], spelling.END, *w[:i]]) for i in range(5)]


def test_spelling_edge_cases(spark):
    df = odd(spark)
    got = as_counter(spelling.spelling_variants(df, min_chars=2, min_count=2, drop_every=7))
    assert {r[0]: r[3] for r in got} == brute_words(df.collect(), 7, 2, 2)
    assert spelling.spelling_variants(df.limit(0)).count() == 0
    text = "abcdef " * 300_000 + "B" * 10
    long = frame(spark, [(1, text, None, None, 0)])
    assert {r["word"]: r["n"] for r in spelling.word_counts(long, 6, 1).collect()} == brute_words(long.collect(), None, 6, 1)


# ---- Merkle manifest ------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_tree(digests):
    paths, nodes = [[] for _ in digests], [(d, [i]) for i, d in enumerate(digests)]
    while len(nodes) > 1:
        above = []
        for a in range(0, len(nodes), 8):
            run = nodes[a:a + 8]
            for j, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(("".join(x[0] for x in run[:j]), "".join(x[0] for x in run[j + 1:])))
            above.append((H(*[x[0] for x in run]), [i for x in run for i in x[1]]))
        nodes = above
    return nodes[0][0], paths


def brute_manifest(rows):
    def leaf(r, t):
        return H(field(r["doc_id"]), field(r["source"]), field(r["lang"]), field(r["n_chars"]), field(t))

    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for x in langs:
        groups[x].sort(key=lambda g: g[:3])
        trees.append(brute_tree([g[2] for g in groups[x]]))
    root, up = brute_tree([t[0] for t in trees])
    out = []
    for x, (sub, paths), more in zip(langs, trees, up):
        for (_, _, own, r), path in zip(groups[x], paths):
            path, h = path + more, own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                h = leaf(r, r["text"] and r["text"].translate(LOW))
            for a, b in path:
                h = H(a, h, b)
            out.append((r["doc_id"], own, sub, root, H(*[a + b for a, b in path]), h, h == root))
    return Counter(out)


def manifest_of(df):
    return Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
                   for r in df.collect())


def test_merkle_query_against_brute_force(spark, docs):
    got = manifest_of(queries.op12_merkle(spark, SF))
    assert got == brute_manifest(docs.collect())
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [65, 1, 8], [1] * 10, [600, 3, 1, 64, 1, 1, 1, 9, 17]])
def test_merkle_shapes(spark, sizes):
    rows = [(1000 * k + i, f"Text {i}", f"l{k}", None, i) for k, n in enumerate(sizes) for i in range(n)]
    df = frame(spark, rows).repartition(3)
    assert manifest_of(merkle.tampered_manifest(df)) == brute_manifest(df.collect())


def test_many_jumps_use_salts(spark, monkeypatch):
    """A binary fan makes the trees high enough for salted rounds."""
    monkeypatch.setattr(merkle, "FAN", 2)
    rows = spark.range(700).selectExpr("id", "cast(id % 3 = 0 as string) g", "sha2(cast(id as string), 256) leaf")
    got = merkle.proofs(*merkle.leaf_table(rows, "g", "id")).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path")))
    rows = got.collect()
    assert len(rows) == 700 and len({r["root"] for r in rows}) == 1 and all(r["folded"] == r["root"] for r in rows)
    assert {len(r["path"]) for r in rows} == {9 + 1, 8 + 1}


def test_merkle_edge_cases(spark):
    df = odd(spark)
    assert manifest_of(merkle.tampered_manifest(df)) == brute_manifest(df.collect())
    empty = merkle.tampered_manifest(df.limit(0))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


# ---- mixing -----------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        share = (total - sum(most * sizes[s] for s in full)) / max(1e-300, sum(w[s] for s in rest)) if rest else 0
        over = {s for s in rest if share * w[s] >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else share * w[s] for s in names}
        full |= over


def check_mix(rows, texts):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter(r["size"] for r in rows) == Counter(size(t) for t in texts)
    whole, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        s = r["source"]
        whole[s] += r["size"]
        taken[s] += r["taken"]
        most[s] = max(most[s], r["size"])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        assert r["rate"] is None or abs(r["copies"] - r["rate"]) < 1
    want = brute_targets(whole)
    for r in rows:
        s = r["source"]
        assert r["source_size"] == whole[s] and r["target"] == pytest.approx(want[s], rel=1e-9)
        assert abs(taken[s] - r["target"]) <= most[s]


def test_mixing_is_the_entropy_optimum(spark, docs):
    got = mixing.mix(docs).collect()
    check_mix(got, [r["text"] for r in docs.collect()])
    by = defaultdict(list)
    for r in got:
        if r["size"]:
            by[r["source"]].append(r)
    import math
    for rows in by.values():
        mean = sum(r["rate"] * r["size"] for r in rows)
        assert mean == pytest.approx(rows[0]["target"], abs=1 + 1e-6 * rows[0]["target"])
        tilt = [math.log(r["rate"]) / r["size"] for r in rows if 0.01 < r["rate"] < 2.999]
        if tilt:  # one multiplier a source; rates are cut to whole units
            assert max(tilt) - min(tilt) < 1e-4 * max(abs(t) for t in tilt) + 1e-6
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixing_hot_cell_and_ceiling(spark):
    rows = [(i, "one two three", None, "hot", 0) for i in range(700)] + [(900 + i, "w " * (i + 1), None, "b", 0) for i in range(30)]
    rows += [(2000, "tiny text", None, "a", 0), (2001, None, None, None, 0), (2002, "", None, "z", 0)]
    df = frame(spark, rows)
    got = mixing.mix(df).collect()
    check_mix(got, [r[1] for r in rows])
    assert {r["taken"] for r in got if r["source"] == "a"} == {6}  # first weight, so at three times its size
    assert len({r["copies"] for r in got if r["source"] == "hot"}) <= 2


def test_mixing_edge_cases(spark):
    df = odd(spark)
    check_mix(mixing.mix(df).collect(), [r["text"] for r in df.collect()])
    assert mixing.mix(df.limit(0)).count() == 0
    none = mixing.mix(frame(spark, [(1, "  ", None, "s", 0), (2, None, None, "t", 0)])).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in none} == {(0, 0.0, 0)}
    space = frame(spark, [(1, "\x0b a\x0cb c \r\n d ", None, "s", 0)])
    assert mixing.mix(space).first()["size"] == 3
