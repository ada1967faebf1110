"""The registered queries ``opN_<name>(spark, sf_dir)`` with production
parameters; each applies its operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from . import (decontaminate, htmltext, langid, licenses, linededup, lmscore, merkle, mixing, multisethash, sentencepieces, simhash,
               spelling, tokencounts)
from .common import table


TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
# Fixed values of the byte-level BPE vocabulary: the pattern that cuts words, and the id that is free for end of document.
BYTE_BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BYTE_BPE_EOD = 50256


def op1_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = sentencepieces.read_model(f"{TOKENIZERS}/piece_bpe_32k.model")
    return sentencepieces.encode(docs, model, decoded=True).select(
        "doc_id", "ids", F.size("ids").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("t", F.lit(""))).alias("round_trip"))


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    filt = langid.learn(docs.where(~held_out))
    out = langid.predict(docs.select("doc_id", "text"), filt)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_html_text(spark, sf_dir):
    return htmltext.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_fingerprint(spark, sf_dir):
    return multisethash.edited_fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_lm_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lmscore.lm_scores(docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken", BYTE_BPE_PATTERN, order=3, min_count=1, leave_one_out=True)


def op6_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), short_items=True)


def op7_licenses(spark, sf_dir):
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text")))


def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text", "n_chars")
    return linededup.drop_boilerplate(docs)


def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokencounts.document_token_counts(
        docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken", BYTE_BPE_PATTERN, BYTE_BPE_EOD)


def op11_spelling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return spelling.spelling_variants(docs, min_chars=6, min_count=5, ratio=5, drop_every=199)


def op12_merkle(spark, sf_dir):
    return merkle.tampered_manifest(table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


def op13_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs, weights=(5, 2, 1), most=3).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_language_id, op3_html_text, op4_fingerprint, op5_lm_score, op6_decontamination,
                                  op7_licenses, op8_line_dedup, op9_simhash, op10_token_counts, op11_spelling, op12_merkle,
                                  op13_mixing)}

ORACLE = {
    "op7_licenses": licenses.oracle(),
    "op8_line_dedup": """
WITH l AS (SELECT DISTINCT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents),
n AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY source),
drops AS (
  SELECT l.source, l.line FROM l JOIN n ON n.source IS NOT DISTINCT FROM l.source
  WHERE trim(l.line) <> '' GROUP BY l.source, l.line, n.host_pages
  HAVING count(*) >= 5 AND count(*) / n.host_pages > 0.05),
p AS (SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS k,
             unnest(string_split(text, chr(10))) AS line FROM documents),
kept AS (SELECT p.doc_id, p.k, p.line FROM p LEFT JOIN drops d ON d.source IS NOT DISTINCT FROM p.source AND d.line = p.line
         WHERE d.line IS NULL),
t AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY k) AS text, count(*) AS n FROM kept GROUP BY doc_id),
r AS (SELECT d.doc_id, d.source, CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text,
             coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines, coalesce(t.n, 0) AS n_kept
      FROM documents d LEFT JOIN t USING (doc_id))
SELECT doc_id, source, text, length(text) AS n_chars, n_lines, n_lines - n_kept AS n_dropped FROM r
""",
}
