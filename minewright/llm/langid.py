"""Language identification by prediction by partial matching: code lengths under frozen byte context trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.llm.batches import lean
from minewright.llm.words import chunks

#: Documents per language that the trees are grown on, and the bytes of context.
FIT_DOCS, ORDER = 1000, 3
UNKNOWN = "und"
PAD = 0x20  # what stands before a text


def _contexts(offsets: np.ndarray, symbols: np.ndarray, pad: int) -> list[np.ndarray]:
    """The symbols one, two, ... ORDER places before each symbol of the same row."""
    starts, ends = offsets[:-1], offsets[1:]
    before = []
    for k in range(1, ORDER + 1):
        prior = np.full(len(symbols), pad, symbols.dtype)
        prior[k:] = symbols[:-k]
        for j in range(k):
            at = starts + j
            prior[at[at < ends]] = pad
        before.append(prior)
    return before


@dataclass
class Trees:
    """Every context tree as one table: code lengths in bits by (context, next byte) for all languages.

    ``row`` leads from the last ORDER bytes to the longest context that any language has met; a language that has not
    met it codes with its own longest shorter one, from which escapes lead further down.
    """

    languages: list[str]
    symbol: np.ndarray  # of each byte value; the last symbol stands for bytes never met
    row: np.ndarray
    bits: np.ndarray  # (contexts * symbols, languages)

    def lengths(self, column: pa.Array) -> np.ndarray:
        """Code length in bits of every whole text for every language."""
        out = np.zeros((len(column), len(self.languages)))
        size = int(self.symbol.max()) + 1
        for first, offsets, data in chunks(column, 1 << 19):
            if not len(data):
                continue
            symbols = self.symbol[data]
            key = np.zeros(len(symbols), np.int32)
            for prior in reversed(_contexts(offsets, symbols, int(self.symbol[PAD]))):
                key = key * size + prior
            found = self.bits[self.row[key] * size + symbols]
            rows = np.flatnonzero(np.diff(offsets))
            out[first + rows] = np.add.reduceat(found, offsets[rows], axis=0, dtype=np.float64)
        return out


def grow(languages: list[str], language: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> Trees:
    """Trees from the counts of (language number, ORDER + 1 bytes packed in an integer, oldest first).

    Escape method C: a context met n times with d different next bytes codes a byte met c times with
    c / (n + d), and anything else with d / (n + d) followed by its code in the context one byte shorter; below the
    empty context all 256 bytes are alike.
    """
    met = np.unique(np.concatenate([(grams >> (8 * k)) & 255 for k in range(ORDER + 1)] + [np.array([PAD])]))
    symbol = np.full(256, len(met), np.int32)
    symbol[met] = np.arange(len(met))
    size, many = len(met) + 1, len(languages)
    history = [symbol[(grams >> (8 * k)) & 255].astype(np.int64) for k in range(ORDER + 1)]  # 0: the byte itself
    shorter, parent_keys = np.full((1, size, many), 8.0), np.zeros(1, np.int64)
    row = np.zeros(size ** ORDER, np.int32)
    tables, base = [], 0
    for order in range(ORDER + 1):
        key = np.zeros(len(grams), np.int64)
        for k in range(order, 0, -1):
            key = key * size + history[k]
        contexts, where = np.unique(key, return_inverse=True)
        parents = np.searchsorted(parent_keys, contexts % size ** max(0, order - 1))
        table = shorter[parents]
        tally = np.zeros((len(contexts), size, many))
        np.add.at(tally, (where, history[0], language), counts)
        total, kinds = tally.sum(1, keepdims=True), (tally > 0).sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            coded = np.where(tally > 0, -np.log2(tally / (total + kinds)), table - np.log2(kinds / (total + kinds)))
        table = np.where(total > 0, coded, table)
        # All full-length contexts that end with one of these lead here unless a longer one is met.
        ends_with = np.full(size ** order, -1, np.int32)
        ends_with[contexts] = base + np.arange(len(contexts))
        spread = np.tile(ends_with, size ** (ORDER - order))
        row = np.where(spread >= 0, spread, row)
        tables.append(table.astype(np.float32).reshape(-1, many))
        base += len(contexts)
        shorter, parent_keys = table, contexts
    return Trees(languages, symbol, row, np.concatenate(tables))


def _grams(batches):
    for batch in batches:
        names = batch.column("lang").to_pylist()
        for first, offsets, data in chunks(batch.column("text")):
            gram = data.astype(np.int64)
            for k, prior in enumerate(_contexts(offsets, data, PAD), 1):
                gram |= prior.astype(np.int64) << (8 * k)
            own = np.array(names[first:first + len(offsets) - 1], object)
            owner = np.repeat(np.arange(len(own)), np.diff(offsets))
            for name in set(own.tolist()):
                found, n = np.unique(gram[(own == name)[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found), pa.array(n)], names=["lang", "gram", "n"])


def held_out(id_: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> Trees:
    """Trees from at most ``fit_docs`` whole texts per language, those whose hashed ids come first.

    Only texts with a language, an id and a remainder other than 2 (``held_out``) are looked at.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).where(
        "lang is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
    chosen = known.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= fit_docs).select("doc_id", "lang").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    found = (texts.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text")  # fit_docs per language at most
             .mapInArrow(lean(_grams), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(set(found["lang"]))
    if not languages:
        return Trees([], np.zeros(256, np.int32), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    number = found["lang"].map(languages.index).to_numpy(np.int64)
    return grow(languages, number, found["gram"].to_numpy(np.int64), found["n"].to_numpy(np.float64))


def identified(docs: DataFrame, trees: Trees, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row the id, ``held_out``, ``lang_pred`` (shortest code; ties: first name), ``score`` (its share of 2 to the minus code
    length over all languages), ``bits_per_byte``.

    A null text and one without a letter is ``und`` with score 0, as is every text if no language was learned. Null ids are
    not held out; repeated rows are scored each; other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        trees = shared.value
        for batch in batches:
            texts = batch.column("text")
            lettered = pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
            if trees.languages:
                bits = trees.lengths(texts)
                best = bits.argmin(1)
                least = bits[np.arange(len(bits)), best]
                score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
                rate = least / np.maximum(1, pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False))
                names = [trees.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)]
            else:
                names, score, rate = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(names, pa.string()),
                                              pa.array(np.where(lettered, score, 0.0)), pa.array(rate.astype(np.float64))],
                                             names=[id_column, "held_out", "lang_pred", "score", "bits_per_byte"])

    id_ = F.col(id_column).cast("long")
    texts = docs.select(id_.alias("id"), held_out(id_).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return texts.mapInArrow(lean(run), f"`{id_column}` long, held_out boolean, lang_pred string, score double, bits_per_byte double")
