"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, SentencePiece encoding.  Each stage takes the documents that
its predecessor kept and returns a table; ``run`` writes each stage's table
as Parquet in the shared folder and reads it again for the next stage.

Every stage reads the columns of ``DOCUMENT`` alone, so others may have any
name that doesn't begin with two underscores; it reads whole texts of any
length; an empty table gives an empty one.  What null and empty texts, missing
ids, ties and repeated rows come to is said at each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm import decontaminate, langid, linededup, sentencepieces, simhash
from lexispark.llm.common import table, written
from lexispark.llm.queries import TOKENIZERS

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
MIN_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (``und``) and texts of whose letter
    trigrams less than MIN_LANGUAGE_SCORE is known in any one language.  With
    no labelled text to learn from, every text is rejected; so are null and
    empty texts.  Each of repeated rows has the same result; rows without an id
    aren't learned from and are kept like others; of languages that tie, the
    first by name counts."""
    filt = langid.learn(docs.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))))
    found = langid.predict(docs, filt, keep=DOCUMENT)
    return found.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*DOCUMENT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops boilerplate lines; every document stays.  Copies of a text and
    repeated rows count as one page, so that ``near_dedup`` finds them whole.
    A null text stays null, one whose lines all go becomes empty; a null host
    is a host; a line exactly at the ratio stays."""
    return linededup.drop_boilerplate(docs, by_text=True).select(*DOCUMENT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked at 2 bits or fewer (3-word
    shingles): the one of the smallest id.  Rows equal in id and text count as
    one; a row without an id goes if its group has an id, else equal ones count
    as one.  Null and empty texts have fingerprint zero and are one group."""
    return simhash.keep_one(docs).select(*DOCUMENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item.  Null and empty texts leak
    nothing; each of repeated rows goes or stays by its text, ids play no part;
    items of under 24 characters are not searched, since a document that
    says so little of the benchmark is a clean one."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), keep=DOCUMENT)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every document; ``round_trip`` says if decoding gives back its
    text (null reads as empty).  Null and empty texts have no ids; repeated
    rows and rows without an id have one result each."""
    model = sentencepieces.read_model(f"{TOKENIZERS}/piece_bpe_32k.model")
    return sentencepieces.encode(docs, model, decoded=True).select("doc_id", "ids", F.size("ids").alias("n_tokens"),
                          (F.col("decoded") == F.coalesce("t", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None  # models, 64-bit hashes and alignments are beyond SQL: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *DOCUMENT)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline/{name}")
    return docs
