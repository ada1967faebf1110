"""Each pipeline stage on rows with nulls, empty and long texts, repeated
rows, an empty table and clashing column names; and language ID against exact
sets of trigrams."""
import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from lexispark.llm import langid

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows(spark):
    base = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*P.DOCUMENT).collect()]
    texts = {r[0]: r[1] for r in base}
    long_text = "\n".join(f"{texts[i]} part {k}" for k in range(60) for i in (0, 1, 2))
    odd = [(1000, None, "en", "src0", None), (1000, None, "en", "src0", None), (1001, "", None, None, 0), (1002, "12 !? 34", None, "src1", 8),
           base[7], base[7], (None, texts[9], None, "src2", 5), (None, texts[9] + " and some more words here", "en", None, None),
           (1003, long_text, None, "src3", len(long_text)), (1004, texts[11], "en", "src4", 1), (1005, texts[11], None, None, 1)]
    return base + odd


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = {c: F.lit(k) for k, c in enumerate(("fp", "block", "host", "line", "unit", "h", "l", "t", "row", "ids", "score"))}
    return spark.createDataFrame(rows, SCHEMA).withColumns(clash).repartition(4)


def counted(df):
    assert df.columns == list(P.DOCUMENT)
    return collections.Counter(tuple(r) for r in df.collect())


def test_language_id_stage(spark, docs, rows):
    got = counted(P.language_id(spark, docs, SF))
    rejected = collections.Counter(rows) - got
    assert not got - collections.Counter(rows)
    assert {r[0] for r in rejected if r[0] is not None and r[0] >= 1000} == {1000, 1001, 1002}
    assert got[rows[7]] == 3 and sum(r[0] is None for r in got) == 2  # repeated rows, rows without an id
    assert len(rejected) <= 3 + 0.05 * len(rows)


def test_line_dedup_stage(spark, docs, rows):
    got = P.line_dedup(spark, docs, SF)
    assert got.columns == list(P.DOCUMENT)
    got = got.collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in rows)
    assert {r["text"] for r in got if r["doc_id"] == 1000} == {None} and {r["text"] for r in got if r["doc_id"] == 1001} == {""}
    for r in got:
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


def test_near_dedup_stage(spark, docs, rows):
    got = P.near_dedup(spark, docs, SF)
    assert got.columns == list(P.DOCUMENT)
    ids = collections.Counter(r["doc_id"] for r in got.collect())
    assert ids[7] == 1 and ids[1000] == 1 and ids[1001] == 0  # equal rows; one of the texts without a word
    assert ids[1004] == ids[1005] == 0 and ids[11] == 1       # copies of 11
    assert ids[None] <= 1 and ids[1003] == 1                  # the copy without an id goes


def test_decontamination_stage(spark, docs, rows):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    more = spark.createDataFrame([(None, f"so: {item}", None, None, None), (2000, f"{item}!", None, None, 1), (2001, "clean", None, None, 1)], SCHEMA)
    got = P.decontamination(spark, docs.select(*P.DOCUMENT).unionByName(more), SF)
    ids = collections.Counter(r["doc_id"] for r in got.collect())
    assert ids[2000] == 0 and ids[2001] == 1 and ids[None] == 2 and ids[1000] == 2 and ids[1001] == 1


def test_sentencepiece_stage(spark, docs, rows):
    got = P.sentencepiece(spark, docs, SF).collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1000, 1001)} == {0}
    assert [r["n_tokens"] for r in got if r["doc_id"] == 1003][0] > 10_000


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_of_an_empty_table(spark, docs, name):
    out = dict(P.STAGES)[name](spark, docs.limit(0), SF)
    assert out.count() == 0 and (name == "sentencepiece" or out.columns == list(P.DOCUMENT))


def test_language_id_against_exact_sets(spark):
    """The same rule without the Bloom filter."""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    held = "crc32(cast(doc_id as string)) % 4 = 2"
    train = base.where(f"not ({held})").collect()
    grams = lambda t: collections.Counter(langid.trigrams([t])[1].tolist())
    counts = collections.defaultdict(collections.Counter)
    for r in train:
        if r["lang"] is not None:
            counts[r["lang"]].update(grams(r["text"]))
    rate = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}
    top = collections.Counter()
    for x in rate:
        for g, v in rate[x].items():
            top[g] = max(top[g], v)
    typical = {x: {g for g, n in counts[x].items() if n >= 3 and rate[x][g] >= 0.2 * top[g]} for x in counts}
    got = {r["doc_id"]: r for r in langid.predict(base, langid.learn(base.where(f"not ({held})"))).collect()}
    same = 0
    for r in base.collect():
        c = grams(r["text"])
        share = {x: sum(n for g, n in c.items() if g in typical[x]) / max(1, sum(c.values())) for x in sorted(typical)}
        best = max(share, key=share.get)
        p = got[r["doc_id"]]
        assert abs(p["score"] - share[best]) < 0.03
        same += p["lang_pred"] == best
    assert same >= 0.99 * base.count()
