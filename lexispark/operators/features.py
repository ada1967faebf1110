"""Term counts and TF-IDF.

TF-IDF follows the common smooth form: idf = ln((1+n)/(1+df)) + 1 with n
the number of training documents, weight = tf*idf, then L2 normalised per
document after unseen terms are dropped.  Everything stays sparse, nothing is
densified.

A corpus' counts are kept by blocks of documents (``count_blocks``): a block has
its terms once and its entries as numbers.  So what moves to the vocabulary
and back is one row a block and term, not one an entry, and the triples
(doc_id, term, value) are made where they are read (``block_rows``)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import settled


def doc_terms(df: DataFrame, terms_col: str = "terms", id_col: str = "doc_id",
              keep: list[str] | None = None) -> DataFrame:
    """(id, *keep, term) of the vectoriser's tokens (two or more chars).

    Pieces of less than two characters go after the explode."""
    keep = keep or []
    return df.select(id_col, *keep, F.explode_outer(T.split_ws(F.lower(terms_col))).alias("term")).where(F.length("term") >= 2)


def term_counts(terms: DataFrame, id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """M1: (id, *keep, term, tf).  Partial aggregation does the counting in
    the task that holds the document; the shuffle moves distinct pairs."""
    keep = keep or []
    return terms.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_idf(tf: DataFrame, n_docs: int, rows=None) -> DataFrame:
    """(term, df, idf) over the training documents; ``rows`` counts a
    term's documents if a row isn't one."""
    rows = F.count(F.lit(1)) if rows is None else rows
    return (tf.groupBy("term").agg(rows.alias("df"))
              .withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1.0)) + 1.0))


def tfidf(tf: DataFrame, idf: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """J5 + M2: inner join on the training vocabulary (unseen terms drop
    out before the norm), weight, L2 normalise per document (a window, so
    no join back).  A task's part of the vocabulary is hashed, so the counts,
    many times as many rows, are not sorted by term."""
    w = tf.join(idf.select("term", "idf").hint("shuffle_hash"), "term", "inner").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.withColumn("weight", F.col("w") / norm).drop("w", "idf")


def _codes(column):
    """(numbers, values): an Arrow column as numbers of its distinct values; null is one."""
    x = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return x.indices.to_numpy(zero_copy_only=False), x.dictionary


def _lists(schema: str, values: list):
    """An Arrow table of one row; a list or array becomes its column's one list."""
    import pyarrow as pa
    held = [pa.array([v]) if isinstance(v, int) else pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if isinstance(v, pa.Array) else pa.array(v))
            for v in values]
    return pa.table(dict(zip(schema.split(), held)))


BLOCK = "b docs ends c tf terms"


def block_count(spark) -> int:
    """Blocks of documents: the session's shuffle partitions, which follow the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_of(id_col: str, blocks: int):
    """The block of documents of an id: a document is whole in it."""
    return F.pmod(F.xxhash64(id_col), F.lit(blocks))


def packed_counts(rows: DataFrame, cols: list[str], min_chars: int = 2, once: bool = False) -> DataFrame:
    """(b, docs, ends, c, tf, terms, seen) of ``rows`` (b, *cols, text), one row
    a block, counted in its task: texts are words between blanks.

    ``docs`` are its distinct ``cols``, ``ends`` where each one's entries end,
    ``c`` and ``tf`` the entries (a place in ``terms``, a count), ``seen`` how
    many docs have the term, those alone whose last of ``cols`` is true.
    ``once``: docs that agree in the first of ``cols`` count as one."""
    def pack(key, t):
        import pyarrow as pa
        import pyarrow.compute as pc
        combined = np.zeros(t.num_rows, np.int64)
        for x in cols:
            code, values = _codes(t.column(x))
            combined = combined * len(values) + code
        _, first, doc = np.unique(combined, return_index=True, return_inverse=True)
        words = pc.split_pattern(t.column("text").combine_chunks(), " ")
        doc = np.repeat(doc, pc.fill_null(pc.list_value_length(words), 0).to_numpy())
        words = words.flatten()
        taken = pc.greater_equal(pc.utf8_length(words), min_chars)
        c, terms = _codes(_chunked(words.filter(taken)))
        n = max(1, len(terms))
        entries, tf = np.unique(doc[taken.to_numpy(zero_copy_only=False)] * n + c, return_counts=True)
        doc, c = np.divmod(entries, n)
        counted = t.column(cols[-1]).to_numpy().astype(bool)[first][doc]
        seen = c[counted]
        if once:
            seen = np.unique(_codes(t.column(cols[0]))[0][first][doc][counted].astype(np.int64) * n + seen) % n
        own = pa.StructArray.from_arrays([t.column(x).combine_chunks().take(pa.array(first)) for x in cols], names=cols)
        return _lists(f"{BLOCK} seen", [key[0].as_py(), own, np.cumsum(np.bincount(doc, minlength=len(first))).astype(np.int32),
                                        c.astype(np.int32), tf, terms, np.bincount(seen, minlength=len(terms))])

    struct = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rows.select(*cols).schema.fields)
    schema = f"b long, docs array<struct<{struct}>>, ends array<int>, c array<int>, tf array<long>, terms array<string>, seen array<long>"
    return rows.groupBy("b").applyInArrow(pack, schema)


def count_blocks(docs: DataFrame, train_flag, terms_col: str = "terms", id_col: str = "doc_id",
                 keep: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """M1 by blocks: ``packed_counts`` of documents (id, *keep, _train), written,
    in ``parts`` blocks (``block_count``).  Terms are those of ``doc_terms``."""
    cols = [id_col, *(keep or []), "_train"]
    parts = parts or block_count(docs.sparkSession)
    rows = docs.withColumn("_train", train_flag).select(
        *cols, T.blanks(F.lower(terms_col)).alias("text"), block_of(id_col, parts).cast("int").alias("b"))
    return settled(packed_counts(rows.repartitionById(parts, "b"), cols), "counts")


def fit_block_idf(blocks: DataFrame, n_docs: int) -> DataFrame:
    """A7 from ``count_blocks``."""
    seen = blocks.select(F.explode(F.arrays_zip("terms", "seen")).alias("x")).select(F.col("x.terms").alias("term"), "x.seen")
    return fit_idf(seen.where(F.col("seen") > 0), n_docs, F.sum("seen"))


def with_known_terms(blocks: DataFrame, known: DataFrame, **cols: str) -> DataFrame:
    """``known_terms``, written."""
    return settled(known_terms(blocks, known, **cols), "weights")


def known_terms(blocks: DataFrame, known: DataFrame, **cols: str) -> DataFrame:
    """J5 by blocks: (b, docs, ends, c, tf, terms, *cols) with the entries of
    the terms of ``known`` (term, *cols) alone; ``cols`` are its columns of
    numbers with their types, one value a term of the block."""
    asked = blocks.select(F.col("b").alias("asker"), F.posexplode("terms").alias("i", "term"))
    found = asked.join(known.select("term", *cols).hint("shuffle_hash"), "term").select("asker", "i", *cols)

    def join(key, left, right):
        import pyarrow as pa
        x = {n: left.column(n).combine_chunks().values for n in left.column_names if n != "b"}
        i = np.sort(right.column("i").to_numpy())
        order = np.argsort(right.column("i").to_numpy())
        place = np.full(len(x["terms"]), -1, np.int32)
        place[i] = np.arange(len(i))
        c, ends = place[x["c"].to_numpy()], x["ends"].to_numpy()
        own = np.cumsum(np.r_[0, c >= 0])[ends].astype(np.int32)
        held = [key[0].as_py(), x["docs"], own, c[c >= 0], x["tf"].to_numpy()[c >= 0], x["terms"].take(pa.array(i))]
        return _lists(" ".join([BLOCK, *cols]), [*held, *[right.column(n).to_numpy()[order] for n in cols]])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.drop("seen").schema.fields],
                        *[f"`{n}` array<{kind}>" for n, kind in cols.items()]])
    return blocks.drop("seen").groupBy("b").cogroup(found.groupBy("asker")).applyInArrow(join, schema)


def opened(row: dict, id_col: str):
    """(docs, doc, c, tf, weight) of a block with IDF: its documents, and the
    entries' documents, terms, counts and L2-normalised weights.  Rows of one
    id share a norm."""
    ends, c, tf = (row[n].to_numpy() for n in ("ends", "c", "tf"))
    doc = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    own, ids = _codes(_chunked(row["docs"].field(id_col)))
    w = tf * row["idf"].to_numpy()[c]
    return row["docs"], doc, c, tf, w / np.sqrt(np.bincount(own[doc], w * w, len(ids)))[own[doc]]


def _chunked(x):
    import pyarrow as pa
    return pa.chunked_array([x])


ROWS = 100_000  # of a batch that a task hands over


def block_rows(blocks: DataFrame, id_col: str = "doc_id", keep: list[str] | None = None, where: tuple | None = None,
               term: str = "term") -> DataFrame:
    """M2: (id, *keep, ``term``, tf, weight), the entries of a table of
    ``with_known_terms`` that has IDF; ``term`` is the term or a column of
    numbers in its place.  ``where``: a column of the documents and the values
    that it may have."""
    cols, source = [id_col, *(keep or [])], "terms" if term == "term" else term
    used = ["docs", "ends", "c", "tf", "idf", source]

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for t in batches:
            for k in range(t.num_rows):
                row = {n: t.column(n)[k].values for n in used}
                docs, doc, c, tf, w = opened(row, id_col)
                if where:
                    taken = pc.is_in(docs.field(where[0]), pa.array(where[1], docs.field(where[0]).type)).to_numpy(zero_copy_only=False)[doc]
                    doc, c, tf, w = doc[taken], c[taken], tf[taken], w[taken]
                for a in range(0, len(doc), ROWS):
                    at = slice(a, a + ROWS)
                    yield pa.RecordBatch.from_arrays([*[docs.field(x).take(pa.array(doc[at])) for x in cols], row[source].take(pa.array(c[at])),
                                                      pa.array(tf[at]), pa.array(w[at])], names=[*cols, term, "tf", "weight"])

    docs = blocks.schema["docs"].dataType.elementType
    schema = [*[f"`{x}` {docs[x].dataType.simpleString()}" for x in cols], f"`{term}` {blocks.schema[source].dataType.elementType.simpleString()}"]
    return blocks.select(*dict.fromkeys(used)).mapInArrow(run, ", ".join([*schema, "tf long, weight double"]))


def tfidf_blocks(docs: DataFrame, train_flag, terms_col: str = "terms", id_col: str = "doc_id", keep: list[str] | None = None,
                 parts: int | None = None):
    """Fit on the rows where ``train_flag`` holds: (counts by blocks, idf(term,
    df, idf), n_train).  The counts are made once and written."""
    counts = count_blocks(docs, train_flag, terms_col, id_col, keep, parts)
    n_train = docs.where(train_flag).count()
    return counts, settled(fit_block_idf(counts, n_train), "idf"), n_train


def tfidf_fit_transform(docs: DataFrame, train_flag, terms_col: str = "terms",
                        id_col: str = "doc_id", keep: list[str] | None = None):
    """Fit on the rows where ``train_flag`` holds, transform all rows.

    Returns (weights(id, *keep, term, tf, weight), idf(term, df, idf), n_train);
    the weights are made from written blocks, each time that they are read."""
    counts, idf, n_train = tfidf_blocks(docs, train_flag, terms_col, id_col, keep)
    return block_rows(with_known_terms(counts, idf, idf="double"), id_col, keep), idf, n_train
