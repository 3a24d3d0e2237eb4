"""The log of counts behind the streaming classifier."""

import os

from pyspark.sql import functions as F

from minewright.operators import bayes
from minewright.streaming.classify import GuessThenLearn, run_parts


def size(path):
    return sum(os.path.getsize(f"{top}/{name}") for top, _, names in os.walk(path) for name in names)


def test_segments_cover_every_batch_once():
    sink = GuessThenLearn(None, "", fold=3)
    for last in range(60):
        covered = []
        for level, end in sink.segments(last):
            covered += range(end - 3 ** level + 1, end + 1)
        assert covered == list(range(last + 1)) and len(sink.segments(last)) <= 2 * 4 + 1
    assert sink.segments(-1) == []


def test_what_is_written_follows_the_batch(spark, tmp_path):
    sink = GuessThenLearn(spark, str(tmp_path), fold=2)
    words = [" ".join(f"word{k:04d}{j}" for j in range(300)) for k in range(4)]
    rows = [(k, text, "xy"[k % 2]) for k, text in enumerate(words)] + [(4, "word00000 word00001", "x"), (5, "word00000", "y")]
    for batch, row in enumerate(rows):
        sink(spark.createDataFrame([row], "doc_id LONG, text STRING, category STRING"), batch)
    assert size(tmp_path / "features" / "batch=4") < size(tmp_path / "features" / "batch=3")
    everything = spark.createDataFrame(rows, "doc_id LONG, text STRING, category STRING")
    assert sorted(map(tuple, sink.model(5).features.collect())) == sorted(map(tuple, bayes.train(everything).features.collect()))
    sink(spark.createDataFrame([rows[5]], "doc_id LONG, text STRING, category STRING"), 5)  # again, after a failure
    assert sorted(map(tuple, sink.model(5).categories.collect())) == [("x", 3), ("y", 3)]


def test_parts_are_learned_in_the_order_of_their_numbers(spark, tmp_path):
    rows = [(k, f"common {'sun' if k % 2 else 'rain'} words", "good" if k % 2 else "bad", 5 - k // 2) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, category STRING, part INT")
    for part in (3, 0, 5, 1, 4, 2):  # file times say nothing
        df.where(F.col("part") == part).drop("part").write.parquet(str(tmp_path / "in" / f"part={part}"))
    sink = run_parts(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = {r.doc_id: (r.batch, r.guess) for r in sink.guesses().collect()}
    for k, _, category, part in rows:
        assert got[k] == (part, category if part else None)
