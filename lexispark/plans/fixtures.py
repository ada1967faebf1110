"""Inputs for steps the test tables never exercise (URLs, contractions,
texts that become empty, null texts).  Every document row is kept; the
pattern of FIXTURES.md appends fixed text to rows chosen by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import read_table, spread

FIXTURE_SQL = """
SELECT doc_id, lang,
       CASE WHEN doc_id % 100 = 2 THEN 'the of'
            WHEN doc_id % 100 = 3 THEN NULL
            WHEN doc_id % 4 = 0 THEN concat(text, ' I can''t say (really) it''s soooo good.')
            WHEN doc_id % 4 = 1 THEN concat(text, ' See ', url, ' for more, then stop.')
            ELSE text END AS text
FROM documents JOIN pages ON page_id = doc_id % (SELECT count(*) FROM pages)
"""


def augmented_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents", ["doc_id", "lang", "text"]), "doc_id")
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    n_pages = pages.count()
    j = docs.join(pages, pages.page_id == docs.doc_id % F.lit(n_pages))
    m100 = F.col("doc_id") % 100
    m4 = F.col("doc_id") % 4
    text = (F.when(m100 == 2, F.lit("the of"))
              .when(m100 == 3, F.lit(None).cast("string"))
              .when(m4 == 0, F.concat("text", F.lit(" I can't say (really) it's soooo good.")))
              .when(m4 == 1, F.concat("text", F.lit(" See "), "url", F.lit(" for more, then stop.")))
              .otherwise(F.col("text")))
    return j.select("doc_id", "lang", text.alias("text"))


LEMMA_SQL = """
SELECT doc_id, CASE WHEN doc_id % 50 = 1 THEN concat('Two women, a woman and men; the man. ', text) ELSE text END AS text
FROM documents
"""


def lemma_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; some begin with words that the lemma rules change."""
    docs = spread(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id")
    return docs.select("doc_id", F.when(F.col("doc_id") % 50 == 1, F.concat(
        F.lit("Two women, a woman and men; the man. "), "text")).otherwise(F.col("text")).alias("text"))


def broken_csv(spark: SparkSession, sf_dir: str) -> str:
    """Folder of gzip CSV files (doc_id, text, lang, n_chars; no header) of every
    document; some records have a word in a number's place, lack a field or
    have one too many."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "n_chars"])
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    m = F.col("doc_id") % 20
    line = F.concat_ws(",", F.col("doc_id").cast("string"), quoted(F.col("text")), quoted(F.col("lang")),
                       F.when(m == 3, F.lit("many")).when(m == 7, F.lit(None)).otherwise(F.col("n_chars").cast("string")),
                       F.when(m == 11, F.lit("more")))
    path = scratch_path(spark, "broken_csv")
    docs.select(line.alias("value")).repartition(4).write.option("compression", "gzip").text(path)
    return path
