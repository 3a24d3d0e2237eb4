"""Toxicity grades by cumulative-link ordinal regression over hashed words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.llm.batches import lean
from minewright.llm.words import IS_SPACE, LOWER, chunks, span_hashes, word_spans

#: Labelled rows per label that the model is fitted on, and buckets of hashed words.
FIT_ROWS, BUCKETS = 4000, 1 << 20
GRADES = 4
#: Weight under the L1 penalty from which a term is picked.
PICKED = 0.25
#: Everything in ASCII that is no letter or digit ends a word.
ENDS = IS_SPACE.copy()
ENDS[[c for c in range(128) if not chr(c).isalnum()]] = True


def _terms(column: pa.Array, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """``(first row, row of each word, bucket of each word, rows)``: all words of whole texts, A-Z lower-cased."""
    for first, offsets, raw in chunks(column):
        data = LOWER[raw]
        starts, ends = word_spans(offsets, np.where(ENDS[data], np.uint8(0x20), data))
        rows = np.searchsorted(offsets, starts, "right") - 1
        yield first, rows, (span_hashes(data, starts, ends) % np.uint64(buckets)).astype(np.int64), len(offsets) - 1


@dataclass
class OrdinalModel:
    """One weight per word bucket, shared by all thresholds: P(grade > k) = sigmoid(score - thresholds[k])."""

    buckets: np.ndarray  # ascending, those with a weight
    weights: np.ndarray
    thresholds: np.ndarray
    size: int = BUCKETS

    def scores(self, column: pa.Array) -> np.ndarray:
        """Sum of the weights of each text's distinct words."""
        dense = np.zeros(self.size, np.float64)
        dense[self.buckets] = self.weights
        out = np.zeros(len(column))
        for first, rows, bucket, _ in _terms(column, self.size):
            hit = dense[bucket] != 0
            own = np.unique(rows[hit] * self.size + bucket[hit])
            np.add.at(out, first + own // self.size, dense[own % self.size])
        return out

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) per text and threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -60, 60)))


def _fit_terms(buckets: int):
    def run(batches):
        for batch in batches:
            toxic = batch.column("toxic")
            for first, rows, bucket, n in _terms(batch.column("text"), buckets):
                own = np.unique(rows * buckets + bucket)
                cuts = np.searchsorted(own // buckets, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays([toxic.slice(first, n), pa.ListArray.from_arrays(
                    pa.array(cuts, pa.int32()), pa.array(own % buckets, pa.int32()))], names=["toxic", "terms"])
    return run


def grades_of(toxic: np.ndarray, rows: np.ndarray, terms: np.ndarray, buckets: int) -> np.ndarray:
    """Severity 0 to 3: 0 if not labelled toxic; else by the distinct marker terms: up to one, two or three, more.

    A marker is a term of at least three toxic rows whose share of them is eight times that of the others or more.
    """
    bad = np.bincount(terms[toxic[rows] == 1], minlength=buckets)
    good = np.bincount(terms[toxic[rows] == 0], minlength=buckets)
    n_bad, n_good = max(1, int((toxic == 1).sum())), max(1, int((toxic == 0).sum()))
    marker = (bad >= 3) & ((bad + 0.5) / n_bad >= 8 * (good + 0.5) / n_good)
    found = np.bincount(rows[marker[terms]], minlength=len(toxic))
    return np.where(toxic == 1, 1 + (found >= 2) + (found >= 4), 0)


def fit_ordinal(grades: np.ndarray, rows: np.ndarray, terms: np.ndarray, buckets: int = BUCKETS, penalty: float = 2e-3,
                rounds: int = 300) -> OrdinalModel:
    """Proportional odds with an L1 penalty, which picks the terms, and again on those terms almost without a penalty,
    which gives each its full weight."""
    picked = _fitted(grades, rows, terms, buckets, penalty, rounds)
    chosen = np.isin(terms, picked.buckets[np.abs(picked.weights) >= PICKED])
    return _fitted(grades, rows[chosen], terms[chosen], buckets, penalty / 100, rounds)


def _fitted(grades: np.ndarray, rows: np.ndarray, terms: np.ndarray, buckets: int, penalty: float, rounds: int) -> OrdinalModel:
    """Accelerated proximal gradient steps."""
    used, column = np.unique(terms, return_inverse=True)
    n = len(grades)
    wanted = (grades[:, None] > np.arange(GRADES - 1)).astype(float)
    per_row = np.bincount(rows, minlength=n)
    step = 4.0 / max(1.0, np.quantile(per_row, 0.9)) if len(rows) else 1.0
    weights, thresholds = np.zeros(len(used)), np.arange(GRADES - 1) + 1.0
    ahead, ahead_t, speed = weights, thresholds, 1.0
    for _ in range(rounds):
        score = np.bincount(rows, ahead[column], n)
        wrong = 1 / (1 + np.exp(-np.clip(score[:, None] - ahead_t, -60, 60))) - wanted
        slope = np.bincount(column, wrong.sum(1)[rows], len(used)) / n
        new = ahead - step * slope * 4
        new = np.sign(new) * np.maximum(0, np.abs(new) - step * 4 * penalty)
        new_t = np.maximum.accumulate(ahead_t + step * 20 * wrong.mean(0))
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead, ahead_t = new + (speed - 1) / faster * (new - weights), new_t + (speed - 1) / faster * (new_t - thresholds)
        if ((ahead - new) * (new - weights)).sum() < 0:  # the momentum points the wrong way
            ahead, ahead_t, faster = new, new_t, 1.0
        weights, thresholds, speed = new, new_t, faster
    kept = weights != 0
    return OrdinalModel(used[kept], weights[kept], thresholds, buckets)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, buckets: int = BUCKETS) -> OrdinalModel:
    """The model of at most ``fit_rows`` toxic and as many other labelled documents, those whose hashed ids come first."""
    known = labels.where("toxic is not null and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = None
    for toxic in (0, 1):
        part = known.where(F.col("toxic") == toxic).orderBy(order, "doc_id").limit(fit_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = (texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")  # two times fit_rows at most
             .mapInArrow(lean(_fit_terms(buckets)), "toxic int, terms array<int>").toPandas())
    toxic = found["toxic"].to_numpy(np.int64)
    if not (toxic == 1).any() or not (toxic == 0).any():
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES - 1, 60.0), buckets)
    counts = found["terms"].map(len).to_numpy()
    rows, terms = np.repeat(np.arange(len(found)), counts), np.concatenate(found["terms"].to_list()).astype(np.int64)
    return fit_ordinal(grades_of(toxic, rows, terms, buckets), rows, terms, buckets)


def graded(docs: DataFrame, model: OrdinalModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row the id, ``severity`` (expected grade, 0 to 3), ``p_toxic`` (of a grade above 0), ``grade`` (the likeliest),
    ``toxic`` (``p_toxic`` of one half or more).

    A null or empty text scores as one without known words. Null ids and repeated rows are scored like others; other
    columns are not read; an empty table gives an empty result. Without toxic or without other labelled documents there
    is no model: severity 0, nothing is toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            above = model.above(model.scores(batch.column("text")))
            likely = -np.diff(np.column_stack([np.ones(len(above)), above, np.zeros(len(above))]), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(above.sum(1)), pa.array(above[:, 0]),
                                              pa.array(likely.argmax(1).astype(np.int32)), pa.array(above[:, 0] >= 0.5)],
                                             names=[id_column, "severity", "p_toxic", "grade", "toxic"])

    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return texts.mapInArrow(lean(run), f"`{id_column}` long, severity double, p_toxic double, grade int, toxic boolean")


def clean(docs: DataFrame, model: OrdinalModel, text_column: str = "text") -> DataFrame:
    """The rows that are not toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column)).cast(pa.string())
            yield batch.filter(pa.array(model.above(model.scores(texts))[:, 0] < 0.5))

    return docs.mapInArrow(lean(run), docs.schema)
