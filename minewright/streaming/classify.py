"""Read, guess, then learn: a streaming classifier over labelled text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.operators import bayes

SCHEMA = "doc_id BIGINT, text STRING, category STRING"


class GuessThenLearn:
    """``foreachBatch`` sink: scores a batch with the counts of the batches before, then adds its labels.

    The model is a log of count tables: a batch writes only what it adds, and every ``fold`` tables of one size are
    summed into one of the next, so what is written follows the batches and a model is read from a few tables. All
    are named by batch ids: a batch that is run again after a failure reads the same state and replaces its own
    tables, counts are never added twice.
    """

    def __init__(self, spark: SparkSession, folder: str, fold: int = 8):
        self.spark = spark
        self.folder = folder
        self.fold = fold

    def _path(self, what: str, batch_id: int, level: int = 0) -> str:
        return f"{self.folder}/{what}{f'-{level}' if level else ''}/batch={batch_id}"

    def segments(self, batch_id: int) -> list[tuple[int, int]]:
        """``(level, last batch)`` of the tables that together hold all batches up to this one."""
        found, done, level = [], 0, 0
        while self.fold ** (level + 1) <= batch_id + 1:
            level += 1
        for level in range(level, -1, -1):
            while done + self.fold ** level <= batch_id + 1:
                done += self.fold ** level
                found.append((level, done - 1))
        return found

    def model(self, batch_id: int) -> bayes.Model:
        found = self._summed(self.segments(batch_id))
        return found or bayes.Model(self.spark.createDataFrame([], "feature STRING, category STRING, n BIGINT"),
                                    self.spark.createDataFrame([], "category STRING, n BIGINT"))

    def _summed(self, segments: list[tuple[int, int]]) -> bayes.Model | None:
        tables = [[self.spark.read.parquet(self._path(what, last, level)) for level, last in segments] for what in ("features", "categories")]
        if not segments:
            return None
        features, categories = (reduce(DataFrame.unionByName, t) for t in tables)
        return bayes.Model(features.groupBy("feature", "category").agg(F.sum("n").alias("n")), categories.groupBy("category").agg(F.sum("n").alias("n")))

    def _write(self, model: bayes.Model, batch_id: int, level: int) -> None:
        model.features.write.mode("overwrite").parquet(self._path("features", batch_id, level))
        model.categories.write.mode("overwrite").parquet(self._path("categories", batch_id, level))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        known = self.model(batch_id - 1)
        scores = bayes.log_probabilities(bayes.document_features(batch), batch, known)
        guesses = bayes.classify(scores).withColumnRenamed("category", "guess")
        (batch.select("doc_id", "category").join(guesses, "doc_id", "left")
         .write.mode("overwrite").parquet(self._path("guesses", batch_id)))
        self._write(bayes.train(batch), batch_id, 0)
        level, size = 1, self.fold
        while (batch_id + 1) % size == 0:
            step = size // self.fold
            self._write(self._summed([(level - 1, last) for last in range(batch_id + step - size, batch_id + 1, step)]), batch_id, level)
            level, size = level + 1, size * self.fold

    def guesses(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/guesses")


def run_parts(spark: SparkSession, source: str, folder: str) -> GuessThenLearn:
    """Work through ``source``, folders ``part=0`` and so on, part by part, and stop.

    The order is that of the numbers, not of file times: a micro-batch is divided by its parts. A part must be complete
    and must not come before a smaller one; otherwise its numbers say that it has been learned already, which is an error.
    """
    sink, done = GuessThenLearn(spark, folder), {}

    def learn(batch: DataFrame, batch_id: int) -> None:
        parts = sorted(row["part"] for row in batch.select("part").distinct().collect())
        late = [part for part in parts if done.get(part, batch_id) != batch_id or any(part < other and at != batch_id for other, at in done.items())]
        if late:
            raise ValueError(f"parts {late} come after larger ones")
        for part in parts:
            done[part] = batch_id
            sink(batch.where(F.col("part") == part).drop("part"), part)

    (spark.readStream.schema(f"{SCHEMA}, part INT").parquet(source)
     .writeStream.foreachBatch(learn).option("checkpointLocation", f"{folder}/progress")
     .trigger(availableNow=True).start().awaitTermination())
    return sink


def run_available(spark: SparkSession, source: str, folder: str, files_per_batch: int = 1) -> GuessThenLearn:
    """Work through everything stored under ``source`` and stop."""
    sink = GuessThenLearn(spark, folder)
    (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(source)
     .writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/progress")
     .trigger(availableNow=True).start().awaitTermination())
    return sink
