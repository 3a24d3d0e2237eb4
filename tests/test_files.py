"""Readers of the mining file formats on files of several splits."""

from collections import Counter

from pyspark.sql import functions as F

from minewright.functions import text
from minewright.operators import vectorize
from minewright.registry import load_all
from minewright.sources import files


def test_schedule_is_read_in_splits_and_keeps_file_order(spark, tmp_path, monkeypatch):
    want, seen = [], Counter()
    for name, n in (("b.txt", 700), ("a.txt", 900)):
        lines = []
        for k in range(n):
            lines += [f"{'LGA' if k % 7 else 'BOS'},{'DAL' if k % 2 else 'OMA'},{k // 60 % 24}:{k % 60:02d},23:59,{k}", "" if k % 5 else "  "]
        (tmp_path / name).write_bytes(("\r\n" if name == "a.txt" else "\n").join(lines).encode())
    for name, n in (("a.txt", 900), ("b.txt", 700)):
        for k in range(n):
            route = ("LGA" if k % 7 else "BOS", "DAL" if k % 2 else "OMA")
            want.append((*route, seen[route], k % 1440, 1439, k))
            seen[route] += 1
    read = []
    whole = files.numbered
    monkeypatch.setattr(files, "numbered", lambda rows, *rest: read.append(rows) or whole(rows, *rest))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = files.load_schedule(spark, str(tmp_path))
        got = sorted(map(tuple, found.select("origin", "dest", "idx", "dep_min", "arr_min", "price").collect()))
        tasks = read[0].rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(want) and tasks > 10


def test_matrix_in_column_blocks(spark, tmp_path):
    counts = [("f", "b", 2), ("f", "d", 1), ("g", "a", 4), ("g", "e", 5), ("g", "zz", 9), ("h", "zz", 1)]
    df = spark.createDataFrame(counts, "feed STRING, word STRING, n LONG")
    words = vectorize.word_blocks(spark.createDataFrame([(w,) for w in "edcba"], "word STRING"), 2)
    assert sorted((r.word, r.block, r.place) for r in words.collect()) == [("a", 0, 0), ("b", 0, 1), ("c", 1, 0), ("d", 1, 1), ("e", 2, 0)]
    blocks = vectorize.matrix_blocks(df, words, df)
    assert max(len(r.counts) for r in blocks.collect()) == 2
    files.write_matrix(blocks, words, str(tmp_path / "m"))
    got = {(r.row_name, r.column): r.value for r in files.read_matrix(spark, str(tmp_path / "m")).collect()}
    known = {(f, w): float(n) for f, w, n in counts}
    assert got == {(f, w): known.get((f, w), 0.0) for f in "fgh" for w in "abcde"}
    (tmp_path / "one.txt").write_text("Blog\tx\ty\nf\t1\t2\n\ng\t3\t4\n")
    plain = {(r.row_name, r.column): r.value for r in files.read_matrix(spark, str(tmp_path / "one.txt")).collect()}
    assert plain == {("f", "x"): 1.0, ("f", "y"): 2.0, ("g", "x"): 3.0, ("g", "y"): 4.0}
    assert vectorize.matrix_blocks(df, words.limit(0), df).count() == 0


def test_matrix_counts_the_words_once(spark, monkeypatch):
    asked = []
    whole = vectorize.matrix_blocks
    monkeypatch.setattr(vectorize, "matrix_blocks", lambda counts, *rest: asked.append(counts) or whole(counts, *rest))
    folder = "/root/testdata/sf0.001"
    for key in ("read_matrix", "doc_term_matrix"):
        load_all()[key](spark, folder)
    assert len(asked) == 2 and not [f for counts in asked for f in counts.inputFiles() if folder in f]


def test_letters_are_told_from_the_rest_at_every_code_point(spark):
    tagged = "".join(chr(c) + "a" for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF) + "<b>x<c"
    row = spark.createDataFrame([(tagged,)], "html STRING").select(
        text.html_pieces(F.col("html")).alias("got"), F.split(F.regexp_replace("html", "<[^>]+", ""), "[^A-Z^a-z]+").alias("want")).first()
    assert row["got"] == row["want"] and len(row["got"]) > 1_000_000
