"""CSV ingestion with rejects, chunked work that resumes, mergeable counts."""
import gzip

import pytest
from pyspark.sql import functions as F

from lexispark.operators import chunks, mergecounts
from lexispark.session import scratch_path
from lexispark.sources.tables import ingest_csv, record_counts


def gz(spark, name, text):
    import pathlib
    path = pathlib.Path(scratch_path(spark, "csv").removeprefix("file:"))
    path.mkdir(parents=True)
    with gzip.open(path / name, "wt", encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


def test_records_are_accepted_or_rejected_with_a_reason(spark):
    path = gz(spark, "a.csv.gz", 'id,text,n\n1,"two\nlines, and ""quotes""",5\n2,short\n3,"x",many\nx,"y",3\n4,a,1,2\n5,"",\\N\n6,"é",7\n')
    schema = spark.createDataFrame([], "id long, text string, n int").schema
    good, bad = ingest_csv(spark, path, schema)
    assert {(r["id"], r["text"], r["n"]) for r in good.collect()} == {(1, 'two\nlines, and "quotes"', 5), (5, "", None), (6, "é", 7)}
    assert {(r["record"], r["reason"], r["column"], r["value"]) for r in bad.collect()} == {
        ("2,short", "columns", None, None), ('3,"x",many', "type", "n", "many"), ('x,"y",3', "type", "id", "x"),
        ("4,a,1,2", "columns", None, None)}
    counts = record_counts(good, bad).collect()
    assert [(r["accepted"], r["rejected"]) for r in counts] == [(3, 4)] and counts[0]["file"].endswith("a.csv.gz")


def test_an_open_quote_takes_its_own_file_only(spark):
    path = gz(spark, "a.csv.gz", 'id,text,n\n1,"never closed,5\n2,b,6\n')
    with gzip.open(f"{path}/b.csv.gz", "wt") as f:
        f.write("id,text,n\n3,c,7\n")
    good, bad = ingest_csv(spark, path, spark.createDataFrame([], "id long, text string, n int").schema)
    assert [r["id"] for r in good.collect()] == [3] and bad.count() == 1
    empty, none = ingest_csv(spark, gz(spark, "e.csv.gz", "id,text,n\n"), spark.createDataFrame([], "id long, text string, n int").schema)
    assert empty.count() == 0 and none.count() == 0


def test_chunks_are_computed_once_each_whatever_stops_the_run(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(47)], "doc_id long, text string")
    path, seen = scratch_path(spark, "chunks"), []

    def work(rows):
        seen.append(sorted(r["chunk"] for r in rows.select("chunk").distinct().collect()))
        if len(seen) == 2:
            raise RuntimeError("lost")
        return rows.select("doc_id", "chunk", F.upper("text").alias("u"))

    assert chunks.run_chunks(df, "doc_id", work, path, 10, at_once=2, stop_after=1) is None
    assert chunks.done_chunks(spark, path) == [0, 1]
    with pytest.raises(RuntimeError):
        chunks.run_chunks(df, "doc_id", work, path, 10, at_once=2)
    assert chunks.done_chunks(spark, path) == [0, 1]
    spark.range(3).write.parquet(f"{path}/done/data/9-half/rows")  # written and never committed
    out = chunks.run_chunks(df, "doc_id", work, path, 10, at_once=2).collect()
    assert seen == [[0, 1], [2, 3], [2, 3], [4]]
    assert sorted((r["doc_id"], r["chunk"], r["u"]) for r in out) == [(i, i // 10, f"T{i}") for i in range(47)]
    again = chunks.run_chunks(df, "doc_id", work, path, 10)
    assert len(seen) == 4 and again.count() == 47
    assert chunks.run_chunks(df.limit(0), "doc_id", lambda r: r, scratch_path(spark, "chunks"), 10).count() == 0


def test_counts_merge_subtract_and_compact(spark):
    path = scratch_path(spark, "counts")
    toks = lambda s: spark.createDataFrame([(w, "c") for w in s.split()], "token string, lang string")
    total = lambda: {(r["lang"], r["token"]): r["freq"] for r in mergecounts.totals(spark, path).collect()}
    with pytest.raises(ValueError):
        mergecounts.totals(spark, path)
    assert mergecounts.add_batch(path, "a", toks("x x y"), by=["lang"])
    assert not mergecounts.add_batch(path, "a", toks("x x y"), by=["lang"])
    mergecounts.add_batch(path, "b", toks("y z"), by=["lang"])
    assert total() == {("c", "x"): 2, ("c", "y"): 2, ("c", "z"): 1}
    mergecounts.compact(spark, path)
    mergecounts.add_batch(path, "d", toks("z z"), by=["lang"])
    assert mergecounts.remove_batch(spark, path, "a") and not mergecounts.remove_batch(spark, path, "a")
    assert total() == {("c", "y"): 1, ("c", "z"): 3}
    mergecounts.add_batch(path, "a", toks("q"), by=["lang"])  # the name comes back with other rows
    assert total() == {("c", "q"): 1, ("c", "y"): 1, ("c", "z"): 3}
    mergecounts.compact(spark, path)
    assert total() == {("c", "q"): 1, ("c", "y"): 1, ("c", "z"): 3}
    assert mergecounts.batches(spark, path) == ["a", "b", "d"]
