"""Operators 3, 4 and 7 against brute force, and their edge cases."""
import collections
import hashlib
import html as H
import re

import pytest

from lexispark.llm import htmltext, licenses, multisethash

SF = "/root/testdata/sf0.001"


# ---- HTML ------------------------------------------------------------------------

def test_articles_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in htmltext.main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        body = re.search("<article>(.*)</article>", r["html"], re.S).group(1)
        plain = H.unescape(re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", " ", body)))
        assert got[r["page_id"]]["text"] == " ".join(plain.split())
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


@pytest.mark.parametrize("wrapper", ["class='content has-sidebar'", "id='layout-sidebar-right'", "class='post comments-open'", "class='no-ads'"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_a_wrapper_is_no_mark(wrapper, inner):
    text = "A sentence of the article, long enough to count as content. " * 4
    aside = "<div class='sidebar'><p>Short aside.</p></div><div class='comments'><p>" + "Long comment of a reader. " * 60 + "</p></div>"
    page = f"<body><nav>Home</nav><div {wrapper}><{inner}><h1>Head</h1><p>{text}</p><p>{text}</p></{inner}>{aside}</div><footer>f</footer></body>"
    assert htmltext.extract(page) == f"Head {text.strip()} {text.strip()}"
    short = f"<body><div class='post'><h1>Head</h1><p>{text}</p></div><div class='comments'><article>{'Long comment of a reader. ' * 60}</article></div>"
    assert htmltext.extract(short) == f"Head {text.strip()}"


LONG = "A sentence of the article, long enough to count as content. " * 4


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<script>var a = '<p>no</p>';</script><style>p{}</style>", ""),
    ("plain &lt;text&gt; &eacute;&#33;", "plain <text> é!"),
    (f"<body><div id='menu'><ul><li><a>Home</a><li><a>More</a></ul></div><div class='post'><h2>Head</h2><p>{LONG}</p><p>Short.</p>"
     f"<p>{LONG}</p><div class='comments'><p>{LONG}</p></div></div><div class='sidebar widget'>{LONG}</div><footer>{LONG}</footer></body>",
     f"Head {LONG.strip()} Short. {LONG.strip()}"),
    (f"<header>{LONG}</header><main><h1>T</h1><p>a<b>b</b>c<br>d<form>Search <input></form><p>{LONG}<aside>{LONG}</aside></main>",
     f"T abc d {LONG.strip()}"),
    (f"<article><header><h1>Kept</h1></header><p>{LONG}</article><article class=x><p>Two</p></article><nav>n</nav>",
     f"Kept {LONG.strip()} Two"),
    (f"<div role='navigation'>x</div><div class='cookie-notice'>{LONG}</div><article><p>Only<p>this</article>", "Only this"),
    ("<![if x]><p>odd <!-- c --> markup</p></div></b><p>end", "odd markup end"),
])
def test_extract(page, want):
    assert htmltext.extract(page) == want


def test_large_and_broken_pages_are_read_in_linear_time():
    import time
    text = "This is the main text of the page, long enough to be found. " * 5
    pages = ["<body><article><p>" + text + "</p></article>" + "<div class='comment'><p>one more</p></div>" * 20_000,
             "<p>" + text + "</p>" + "<a " * 100_000, "<b>" * 50_000 + "<p>" + text + "</p>" + "</i>" * 50_000,
             "<div>" * 20_000 + "<p>" + text + "</p>" + "<p>x</p>" * 5_000]
    began = time.time()
    found = [htmltext.extract(p) for p in pages]
    assert time.time() - began < 30
    assert all(text.strip() in x for x in found) and "one more" not in found[0]


def test_html_edges(spark):
    df = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<p>x")], "page_id long, url string, html string")
    got = htmltext.main_text(df.selectExpr("*", "'z' as text", "3 as n_chars")).collect()
    assert sorted((r["text"], r["n_chars"]) for r in got) == [("", 0), ("", 0), ("x", 1)]
    assert htmltext.main_text(df.limit(0)).count() == 0
    assert htmltext.extract("<p>" + "word " * 400_000) == ("word " * 400_000).strip()


# ---- fingerprints --------------------------------------------------------------------

def vector_by_hand(text):
    parts = [p for p in re.split(multisethash.CUT, text) if p]
    words = [[int(hashlib.sha256(p.encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(8)] for p in parts]
    sums = [sum(w[k] for w in words) % 2**32 for k in range(8)]
    counts = [sum(w[k + half] >> i & 1 for w in words) for k in (0, 2) for i in range(32) for half in (0, 1)]
    return [len(parts), *sums, *counts]


def likeness_by_hand(a, b):
    x, y = ([2 * c - v[0] for c in v[9:]] for v in (a, b))
    whole = sum(i * i for i in x) + sum(i * i for i in y)
    return max(0.0, 1.0 - sum((i - j) ** 2 for i, j in zip(x, y)) / whole) if whole else 1.0


def text_of(v):
    return "".join(f"{x:08x}" for x in v[1:9]) + "-" + ".".join(f"{x:x}" for x in v[9:])


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_fingerprints_by_hand(spark, buckets):
    rows = [(r["doc_id"] * 7 - 50, r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(5000, None), (5001, ""), (5002, "x"), (5003, "😀é b. C d"), (20, "same id, other text"), (20, "same id, other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as k", "2 as bucket", "3 as guest")
    got = multisethash.edited_fingerprints(df, buckets).collect()
    order = sorted((i, t or "") for i, t in rows)
    want = collections.Counter()
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        e = t[:len(t) - half] + n[:half]
        v, w, x = vector_by_hand(t), vector_by_hand(e), vector_by_hand(n)
        want[i, len(t), hashlib.sha256(e.encode()).hexdigest(), text_of(v), text_of(w),
             round(likeness_by_hand(v, w), 9), round(likeness_by_hand(v, x), 9)] += 1
    assert collections.Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got) == want


def test_homomorphism(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0, "a\nb\nc"), (1, "c\na\nb"), (2, "b\nc"), (3, "a")], "i int, t string")
    v = {r["i"]: r["v"] for r in multisethash.vectors(df, ["i"], "t").collect()}
    assert v[0] == v[1]
    w = spark.createDataFrame([(v[0], v[2], v[3])], "x array<long>, y array<long>, z array<long>").select(
        multisethash.add(F.col("y"), F.col("z")).alias("sum"), multisethash.subtract(F.col("x"), F.col("z")).alias("less")).first()
    assert w["sum"] == v[0] and w["less"] == v[2]


def test_fingerprint_edges(spark):
    df = spark.createDataFrame([(None, "lone text")], "doc_id long, text string")
    r = multisethash.edited_fingerprints(df).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0 and r[0]["doc_id"] is None
    assert multisethash.edited_fingerprints(df.limit(0)).count() == 0


# ---- licenses ----------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def scan_by_hand(text, threshold=0.9):
    w = WORD.findall(lower(text))
    places = [(label, i) for phrase, label in licenses.BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    blocks = set()
    for k, line in enumerate((text or "").split("\n")):
        held = set(WORD.findall(lower(line)))
        for label, t in licenses.TEMPLATES:
            s = set(t.split())
            if len(s & held) >= threshold * len(s) - 1e-9:
                blocks.add((label, k, len(s & held) / len(s)))
    return len(w), sorted(places), sorted(blocks)


def test_license_scan_by_hand(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    gpl = licenses.TEMPLATES[9][1].upper()
    rows += [(9001, None), (9002, ""), (9003, "cc by cc BY, Apache-License\nmit license mit license"), (9003, "cc by cc BY, Apache-License\nmit license mit license"),
             (9004, f"x\n{gpl}!"), (9005, "MIT\nLicense"), (9006, "Ünder the mit Licensé"), (9007, " ".join(gpl.split()[:-4])),
             (9008, "word " * 50_000 + "released under the MIT license"), (None, "Licensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as label", "3 as w")
    got = collections.Counter((r["doc_id"], r["n_words"], tuple(sorted((p["label"], p["start"]) for p in r["places"])),
                               tuple((b["label"], b["line"], b["containment"]) for b in r["blocks"])) for r in licenses.scan(df).collect())
    want = collections.Counter((i, n, tuple(p), tuple(b)) for i, t in rows for n, p, b in [scan_by_hand(t)])
    assert got == want
    d = {r["doc_id"]: r for r in licenses.digest(licenses.scan(df)).collect()}
    assert (d[9003]["n_base"], d[9003]["first_word"], d[9003]["last_word"]) == (5, 0, 8)
    assert d[9003]["base_labels"] == "apache,cc-by,mit" and d[9001]["labels"] == "" and d[9001]["first_word"] is None
    assert "gpl" in d[9004]["labels"].split(",") and d[9005]["base_labels"] == "mit" and d[None]["labels"] == "cc-by,cc-by-nc"


def test_wrapped_notices(spark):
    """Every template wrapped at 72 columns or less, in comments, anywhere in a text."""
    import textwrap
    rows, want = [], {}
    for k, (label, t) in enumerate(licenses.TEMPLATES):
        for m, (before, mark, width) in enumerate([("", "", 72), ("int x;\n" * 9 + "a b c d e f g\n" * k, "# ", 40), ("word " * (11 * k + 3) + "\n", " * ", 24)]):
            rows.append((100 * k + m, before + "\n".join(mark + x for x in textwrap.wrap(t.capitalize(), width)) + "\nint main() { return 0; }\n" * 20))
            want[100 * k + m] = label
    df = spark.createDataFrame(rows + [(9999, None)], "doc_id long, text string")
    found = licenses.scan(df)
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.digest(found).collect()}
    assert all(label in got[i] for i, label in want.items())
    step, texts = licenses.run_step(licenses.TEMPLATES), dict(rows)
    for r in found.where("doc_id < 9999").collect():
        w = WORD.findall(lower(texts[r["doc_id"]]))
        brute = sorted((label, i, len(s & held) / len(s)) for i in range(0, len(w), step) for held in [set(w[i:i + 2 * step])]
                       for label, s in [(a, set(b.split())) for a, b in licenses.TEMPLATES] if len(s & held) >= 0.9 * len(s) - 1e-9)
        assert [tuple(x) for x in r["runs"]] == sorted(set(brute))


def test_license_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.digest(licenses.scan(df)).count() == 0
