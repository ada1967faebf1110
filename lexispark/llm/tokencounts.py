"""Operator 10, token counts by a separator scan.

A flat token file is one run of fixed-width token ids in which the
end-of-document id closes each document; nothing says where documents begin.
It is kept as blocks of ``block_tokens`` ids (rows of file, block number,
bytes; the last block of a file may be shorter), cut with no regard to
documents.  Each block is searched for the separator in one vectorised
comparison.  Documents inside a block are counted there; those that cross
blocks are stitched by a prefix scan over the blocks' summaries: the number of
separators before a block, and the place of the last one before it.  The scan
runs in two levels (runs of ``RUN`` blocks, then blocks within a run), so one
very large file doesn't meet in one task.

Defined results: a file without a separator has no complete document; tokens
behind the last separator are one more document only if ``open_tail`` is set;
two separators in a row are an empty document (0 tokens); empty or null
payloads hold no tokens; empty input gives an empty result.  A null text
encodes as an empty document.  Only the named columns are read, so others may
have any name."""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_batches, written

RUN = 1024
WIDTH = {1: np.uint8, 2: np.dtype("<u2"), 4: np.dtype("<u4")}


def scan_separators(blocks: DataFrame, eod: int, width: int = 2) -> DataFrame:
    """(file, block, tokens, separators, head, tail, inner): tokens before the
    first separator, behind the last one, and between neighbours."""
    kind = WIDTH[width]

    def run(batches):
        for pdf in batches:
            rows = []
            for file, block, payload in zip(pdf["file"], pdf["block"], pdf["payload"]):
                ids = np.frombuffer(payload or b"", kind)
                at = np.flatnonzero(ids == eod)
                n = len(ids)
                rows.append((file, block, n, len(at), int(at[0]) if len(at) else n,
                             n - 1 - int(at[-1]) if len(at) else n, np.diff(at) - 1))
            yield pd.DataFrame(rows, columns=["file", "block", "tokens", "separators", "head", "tail", "inner"])

    return blocks.select("file", "block", "payload").mapInPandas(
        run, "file string, block long, tokens long, separators long, head long, tail long, inner array<long>")


def count_tokens(blocks: DataFrame, eod: int, width: int = 2, open_tail: bool = False) -> DataFrame:
    """(file, ordinal, n_tokens): the tokens of each document of each file, in
    file order from 0, the separator not counted."""
    s = cut(scan_separators(blocks, eod, width)).withColumn("run", F.floor(F.col("block") / RUN))
    # of a run of blocks: its separators, its tokens, and the tokens behind its last separator
    order = F.struct("block", "tail")
    runs = s.groupBy("file", "run").agg(
        F.sum("separators").alias("n"), F.sum("tokens").alias("all"),
        F.max(F.when(F.col("separators") > 0, order)).alias("last"), F.collect_list(F.struct("block", "tokens")).alias("sizes"))
    runs = runs.withColumn("behind", F.aggregate(F.filter("sizes", lambda x: F.col("last").isNull() | (
        x["block"] > F.col("last.block"))), F.coalesce("last.tail", F.lit(0).cast("long")), lambda a, x: a + x["tokens"]))
    w = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("all").over(upto)
    runs = runs.withColumn("mark", F.when(F.col("n") > 0, end - F.col("behind"))).select(
        "file", "run", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("all").over(w), F.lit(0)).alias("t0"), F.coalesce(F.max("mark").over(w), F.lit(0)).alias("m0"))
    b = Window.partitionBy("file", "run").orderBy("block")
    before, upto = b.rowsBetween(Window.unboundedPreceding, -1), b.rowsBetween(Window.unboundedPreceding, 0)
    t = s.join(runs, ["file", "run"]).withColumn("start", F.col("t0") + F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    t = t.withColumn("mark", F.when(F.col("separators") > 0, F.col("start") + F.col("tokens") - F.col("tail")))
    t = t.select("file", "start", "tokens", "separators", "head", "inner", "block",
                 (F.col("n0") + F.coalesce(F.sum("separators").over(before), F.lit(0))).alias("first"),
                 F.coalesce(F.max("mark").over(before), F.col("m0")).alias("open"))
    # the first separator of a block closes the document that is open since the last separator before the block
    closed = F.concat(F.array(F.col("start") + F.col("head") - F.col("open")), "inner")
    docs = t.where("separators > 0").select("file", "first", F.posexplode(closed).alias("k", "n_tokens")).select(
        "file", (F.col("first") + F.col("k")).alias("ordinal"), "n_tokens")
    if not open_tail:
        return docs
    last = s.groupBy("file").agg(F.sum("separators").alias("ordinal"), F.sum("tokens").alias("all")).join(
        t.groupBy("file").agg(F.max(F.when(F.col("separators") > 0, F.col("start") + F.col("head") + 1 + F.aggregate(
            "inner", F.lit(0).cast("long"), lambda a, x: a + x + 1))).alias("mark")), "file")
    return docs.union(last.select("file", "ordinal", (F.col("all") - F.coalesce("mark", F.lit(0))).alias("n_tokens"))
                      .where("n_tokens > 0"))


#: Long runs of what ``\\s`` matches in the tokenizer's pattern.
LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{4096,}")


def encode_text(codec, text: str) -> np.ndarray:
    """Ids of ``text`` by a codec whose pattern takes white space as
    ``\\s+(?!\\S)|\\s+``.  That pattern's stack overflows on a very long run of
    white space, so such a run is cut out: it is one piece to the end of the
    text, or to its last character if something follows, which is what the
    pattern makes of it; the ids are the same."""
    parts, at = [], 0
    for m in LONG_SPACE.finditer(text):
        a, b = m.span()
        b = b if b == len(text) else b - 1
        parts += [codec.encode_to_numpy(text[at:a], disallowed_special=()),
                  np.array(codec._encode_single_piece(text[a:b]), np.uint32)]
        at = b
    parts.append(codec.encode_to_numpy(text[at:] if at else text, disallowed_special=()))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


@functools.lru_cache(maxsize=2)
def _codec(file: bytes, pattern: str):
    import tiktoken
    return tiktoken.Encoding("units", pat_str=pattern, mergeable_ranks=_ranks(file), special_tokens={})


class Codec:
    """A tiktoken vocabulary for tasks: the driver alone reads its file, and
    each Python worker builds the encoder once."""

    def __init__(self, spark, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            self.file = spark.sparkContext.broadcast(f.read())  # a vocabulary file: of fixed size
        self.pattern = pattern

    def get(self):
        return _codec(self.file.value, self.pattern)


def _ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return _ranks(f.read())


def token_files(docs: DataFrame, ranks_path: str, pattern: str, eod: int, width: int = 2, block_tokens: int = 1 << 16,
                text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Encodes ``docs`` to flat token files, one a task, written once to the
    shared folder: (blocks, manifest) with the blocks (file, block, payload)
    and the ids in the order written (file, first, ids).  A task holds one
    Arrow batch of texts and less than two blocks of ids."""
    kind, vocabulary = WIDTH[width], Codec(docs.sparkSession, ranks_path, pattern)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        codec = vocabulary.get()
        file = f"{TaskContext.get().partitionId():08d}"
        held, size, block, first = [], 0, 0, 0

        def out(file_kind, numbers, payloads, ids):
            n = len(numbers)
            return pa.RecordBatch.from_arrays(
                [pa.array([file_kind] * n, pa.string()), pa.array([file] * n, pa.string()), pa.array(numbers, pa.int64()),
                 pa.array(payloads, pa.binary()), pa.array(ids, pa.list_(pa.int64()))],
                names=["kind", "file", "block", "payload", "ids"])

        for batch in batches:
            yield out("ids", [first], [None], [batch.column("doc_id").to_pylist()])
            first += batch.num_rows
            numbers, payloads = [], []
            for t in batch.column("t"):
                ids = np.append(encode_text(codec, t.as_py() or ""), eod)
                held.append(ids.astype(kind))
                size += len(ids)
                if size >= block_tokens:
                    flat = np.concatenate(held)
                    full = size // block_tokens
                    payloads += [flat[k * block_tokens:(k + 1) * block_tokens].tobytes() for k in range(full)]
                    numbers += range(block, block + full)
                    block += full
                    held, size = [flat[full * block_tokens:]], size - full * block_tokens
            yield out("tokens", numbers, payloads, [None] * len(numbers))
        if size:
            yield out("tokens", [block], [np.concatenate(held).tobytes()], [None])

    made = written(text_batches(rows).mapInArrow(run, "kind string, file string, block long, payload binary, ids array<long>"), "token_files")
    blocks = made.where("kind = 'tokens'").select("file", "block", "payload")
    return blocks, made.where("kind = 'ids'").select("file", F.col("block").alias("first"), "ids")


def document_token_counts(docs: DataFrame, ranks_path: str, pattern: str, eod: int, text: str = "text",
                          doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens) of every row, scanned from its flat token file."""
    blocks, manifest = token_files(docs, ranks_path, pattern, eod, text=text, doc_id=doc_id)
    counts = count_tokens(blocks, eod)
    ids = manifest.select("file", "first", F.posexplode("ids").alias("k", "doc_id")).select(
        "file", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    return ids.join(counts, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
