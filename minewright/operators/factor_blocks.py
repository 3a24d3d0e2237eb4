"""The rounds of a factorisation over blocks of the matrix: cells as arrays, one array product per block and half round.

Rows and columns are numbered and ``SIDE`` neighbours are a block. Spark places the blocks, joins them with the blocks of the
factor that stays and sums what they pull; a task never holds more than a block of a factor and a piece of the matrix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.operators.ranks import numbered
from minewright.session import cut, laid_out

#: Keys in a block, and blocks of the other side whose cells lie in one row of a layout.
SIDE, CHUNK = 1024, 256
#: Sums of blocks that a task keeps before it hands them on.
HELD = 256


def numbers(matrix: DataFrame, key: str) -> DataFrame:
    """``key, block, place`` of every key that has a cell, in key order."""
    at = numbered(matrix.select(key).where(F.col(key).isNotNull()).distinct(), [], [key], "_at")
    return cut(at.select(key, F.floor(F.col("_at") / SIDE).alias("block"), F.pmod("_at", F.lit(SIDE)).cast("int").alias("place")), "numbers")


FACTOR = "block long, m binary, g array<double>"


def _block(block: pa.ChunkedArray, m: np.ndarray) -> pa.Table:
    """One row of a factor: its vectors as a matrix of doubles, and the sums of products of every two factors."""
    return pa.table({"block": block[:1], "m": pa.array([m.tobytes()], pa.binary()), "g": pa.array([(m.T @ m).ravel()], pa.list_(pa.float64()))})


def factor_of(starts: DataFrame, places: DataFrame, key: str, vector: str) -> DataFrame:
    """The vectors of ``starts(key, vector)`` in blocks."""
    def packed(group: pa.Table) -> pa.Table:
        place = group.column("place").to_numpy()
        vectors = np.array(group.column(vector).to_pylist(), np.float64)
        return _block(group.column("block"), vectors[np.argsort(place)])

    return starts.join(places, key).select("block", "place", vector).groupBy("block").applyInArrow(packed, FACTOR)


def vectors_of(factor: DataFrame, places: DataFrame, key: str, vector: str, factors: int) -> DataFrame:
    """``key, vector``: a factor in blocks as one array per key."""
    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, m in zip(batch.column("block").to_pylist(), batch.column("m").to_pylist()):
                values = np.frombuffer(m)
                rows = len(values) // factors
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(rows, block)), pa.array(np.arange(rows, dtype=np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * factors), pa.array(values))], names=["block", "place", vector])

    return (factor.select("block", "m").mapInArrow(opened, f"block long, place int, {vector} array<double>").join(places, ["block", "place"]).select(key, vector))


def _piece(group: pa.Table) -> pa.Table:
    """One row for the cells of a block: their places in it, values, and the numbers they pull, in the order of these."""
    other = group.column("other").to_numpy()
    order = np.argsort(other, kind="stable")
    wanted, starts = np.unique(other[order], return_index=True)
    arrays = (group.column("place").to_numpy()[order], group.column("v").to_numpy()[order], wanted, starts)
    return pa.table({"block": group.column("block")[:1]} | {
        name: pa.array([a.astype(kind).tobytes()], pa.binary())
        for name, a, kind in zip(("places", "v", "wanted", "starts"), arrays, (np.int32, np.float64, np.int64, np.int64))})


def layout(cells: DataFrame, own: str, other: str, label: str) -> DataFrame:
    """The cells by blocks of ``own``, bucketed by block: ``block, places, v, wanted, starts`` (see ``_piece``)."""
    rows = cells.select(F.col(f"{own}_block").alias("block"), F.col(f"{own}_place").alias("place"),
                        (F.col(f"{other}_block") * SIDE + F.col(f"{other}_place")).alias("other"), "v",
                        F.floor(F.col(f"{other}_block") / CHUNK).alias("chunk"))
    pieces = rows.groupBy("block", "chunk").applyInArrow(_piece, "block long, places binary, v binary, wanted binary, starts binary")
    return laid_out(pieces, ["block"], label)


def pulled(pieces: DataFrame, fixed: DataFrame, factors: int) -> DataFrame:
    """``block, pull``: V times the factor that stays, per block of the other side, summed in every task."""
    def handed(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([p.tobytes() for p in held.values()], pa.binary())],
                                          names=["block", "pull"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                places, v, wanted, starts, m = (np.frombuffer(batch.column(name)[k].as_buffer(), kind) for name, kind in (
                    ("places", np.int32), ("v", np.float64), ("wanted", np.int64), ("starts", np.int64), ("m", np.float64)))
                sums = np.add.reduceat(m.reshape(-1, factors)[places] * v[:, None], starts, axis=0)
                block, place = wanted // SIDE, wanted % SIDE
                edges = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                for a, b in zip(edges, np.append(edges[1:], len(block))):
                    to = held.get(int(block[a]))
                    if to is None:
                        if len(held) == HELD:
                            yield handed(held)
                            held = {}
                        to = held[int(block[a])] = np.zeros((SIDE, factors))
                    to[place[a:b]] += sums[a:b]
        if held:
            yield handed(held)

    met = pieces.join(fixed, "block").select("places", "v", "wanted", "starts", "m")
    return met.mapInArrow(run, "block long, pull binary")


def gram(factor: DataFrame) -> Column:
    """Sums of products of every two factors, row after row in one array."""
    sums = factor.select(F.posexplode("g").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    return sums.agg(F.array_sort(F.collect_list(F.struct("at", "s"))).alias("g")).select("g.s").scalar()


def updated(pieces: DataFrame, fixed: DataFrame, moved: DataFrame, factors: int) -> DataFrame:
    """One multiplicative update of ``moved``: times (V · fixed) over (moved · gram of fixed); a zero denominator gives 0."""
    def run(sums: pa.Table, block: pa.Table) -> pa.Table:
        m = np.frombuffer(block.column("m")[0].as_buffer()).reshape(-1, factors)
        top = np.zeros((SIDE, factors))
        for pull in sums.column("pull"):
            top += np.frombuffer(pull.as_buffer()).reshape(SIDE, factors)
        down = m @ np.array(block.column("products")[0].as_py()).reshape(factors, factors)
        with np.errstate(divide="ignore", invalid="ignore"):
            new = np.where(down != 0, m * top[:len(m)] / down, 0.0)
        return _block(block.column("block"), new)

    rows = moved.select("block", "m", gram(fixed).alias("products"))
    return pulled(pieces, fixed, factors).groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(run, FACTOR)


def cost(cells: DataFrame, by_i: DataFrame, w: DataFrame, h: DataFrame, factors: int) -> float:
    """Squared error over all cells, from the entries, V times W and the two small products."""
    def dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = 0.0
        for batch in batches:
            for k in range(batch.num_rows):
                m = np.frombuffer(batch.column("m")[k].as_buffer())
                out += float(m @ np.frombuffer(batch.column("pull")[k].as_buffer())[:len(m)])
        yield pa.RecordBatch.from_arrays([pa.array([out])], names=["s"])

    met = pulled(by_i, w, factors).join(h, "block").select("m", "pull").mapInArrow(dots, "s double").agg(F.sum("s")).scalar()
    both = (cells.agg(F.coalesce(F.sum(F.col("v") * F.col("v")), F.lit(0.0)).alias("vv")).withColumn("vwh", F.coalesce(met, F.lit(0.0)))
            .withColumn("gw", gram(w)).withColumn("gh", gram(h)))
    trace = F.aggregate(F.zip_with("gw", "gh", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return both.select((F.col("vv") - 2 * F.col("vwh") + F.coalesce(trace, F.lit(0.0))).alias("cost")).first()["cost"] or 0.0

