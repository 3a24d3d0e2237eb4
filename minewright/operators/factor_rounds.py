"""The rounds of a factorisation whose smaller side fits a task: that side travels, and the cells are read in place once a round.

The keys of the other side lie in blocks with all their cells. A pass over a block updates its vectors from the side that travels and
adds up what the new vectors pull for that side in turn, so a round is one pass and a sum over the tasks. Numbers are exact to the order of sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minewright.session import cut, discarded, laid_out, small_batches

#: Bytes of a side that may travel, cells of a block, and vectors in a row of what is pulled.
TRAVELS, CELLS, CHUNK = 64 << 20, 1 << 19, 1 << 13
SUMS = pa.schema({"chunk": pa.int32(), "m": pa.binary()})


def uniform(text: bytes, vector: str, factors: int) -> list[float]:
    """The starting weights of a key, as ``factor.start`` has them."""
    return [(int(hashlib.md5(text + f"-{vector}{a}".encode()).hexdigest()[:7], 16) + 1) / 268435457.0 for a in range(factors)]


def block_numbers(spark: SparkSession, buckets: int, each: int) -> list[int]:
    """``each`` numbers for every bucket, so that all buckets have as many blocks."""
    bucket = F.pmod(F.hash("id"), F.lit(buckets)).alias("bucket")
    found = spark.range(64 * buckets * (each + 8), numPartitions=1).groupBy(bucket).agg(F.slice(F.sort_array(F.collect_list("id")), 1, each).alias("ids")).collect()
    return [k for row in sorted(found) for k in row["ids"]]


def layout(matrix: DataFrame, own: str, other: str, vector: str, places: DataFrame, blocks: list[int], buckets: int, factors: int) -> DataFrame:
    """The cells by blocks of ``own``, bucketed by block: the keys of a block, their starting vectors and their cells key after key.

    ``places(other, at)``: the numbers of the side that travels. A key without cells keeps its vector.
    """
    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per batch and block: its keys, and the cells of each key that has any."""
        for batch in batches:
            coded = batch.column(own).dictionary_encode()
            code, has = coded.indices.to_numpy(), batch.column("at").is_valid().to_numpy(zero_copy_only=False)
            first = np.unique(code, return_index=True)[1]
            block = batch.column("block").to_numpy()[first]
            keys = np.argsort(block, kind="stable")  # one block's keys side by side, and so their cells
            rank = np.empty_like(keys)
            rank[keys] = np.arange(len(keys))
            place = rank[code[has]]
            order = np.argsort(place, kind="stable")
            at, v = batch.column("at").drop_null().to_numpy()[order], batch.column("v").to_numpy()[has][order]
            counts = np.bincount(place, minlength=len(keys)).astype(np.int32)
            ends = np.append(0, np.cumsum(counts))
            edges = np.flatnonzero(np.append(True, block[keys][1:] != block[keys][:-1])) if len(keys) else []
            for a, b in zip(edges, [*edges[1:], len(keys)]):
                taken = first[keys[a:b]]
                yield pa.RecordBatch.from_arrays([pa.array(block[keys[a:a + 1]]), *(pa.array([x.tobytes()], pa.binary()) for x in (
                    counts[a:b], at[ends[a]:ends[b]].astype(np.int32), v[ends[a]:ends[b]])),
                    *(pa.array([batch.column(name).take(pa.array(taken))], pa.list_(batch.column(name).type)) for name in names)], names=["block", "counts", "at", "v", *names])

    def packed(group: pa.Table) -> pa.Table:
        coded = group.column(own).combine_chunks().flatten().dictionary_encode()
        names = group.column(named).combine_chunks().flatten() if named else coded.dictionary.cast(pa.string())
        if named:
            names = names.take(pa.array(np.unique(coded.indices.to_numpy(), return_index=True)[1]))
        start = np.array([uniform(text, vector, factors) for text in names.cast(pa.binary()).to_pylist()])
        counts, at, v = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(name)]) for name, kind in (
            ("counts", np.int32), ("at", np.int32), ("v", np.float64)))
        place = np.repeat(coded.indices.to_numpy(), counts)
        order = np.argsort(place, kind="stable")
        at, v, counts = at[order], v[order], np.bincount(place, minlength=len(coded.dictionary)).astype(np.int32)
        at = at.astype(np.uint16 if at.max(initial=0) < 1 << 16 else np.int32)
        with np.errstate(invalid="ignore"):
            short = v.astype(np.uint8)
        v = short if np.array_equal(short, v) else v
        return pa.table({"block": group.column("block")[:1], "keys": pa.array([coded.dictionary], pa.list_(coded.dictionary.type)),
                         "start": pa.array([start.tobytes()], pa.binary()), "kinds": [f"{at.dtype.str} {v.dtype.str}"]} | {
            name: pa.array([a.tobytes()], pa.binary()) for name, a in (("counts", counts), ("at", at), ("v", v))})

    kind = dict(matrix.dtypes)[own]
    named = None if kind in ("string", "tinyint", "smallint", "int", "bigint") else "name"
    names = [own, named] if named else [own]
    block = F.get(F.array(*[F.lit(k) for k in blocks]), F.pmod(F.xxhash64(own), F.lit(len(blocks))).cast("int")).cast("long")
    cells = (matrix.where(F.col(own).isNotNull()).join(places, other, "left")
             .select(block.alias("block"), own, "at", "v", *([F.col(own).cast("string").alias(named)] if named else [])))
    with small_batches(matrix.sparkSession, 1 << 18):
        parts = cells.mapInArrow(grouped, f"block long, counts binary, at binary, v binary, {own} array<{kind}>" + (f", {named} array<string>" if named else ""))
        pieces = parts.repartition(buckets, "block").groupBy("block").applyInArrow(
            packed, f"block long, keys array<{kind}>, start binary, kinds string, counts binary, at binary, v binary")
        return laid_out(pieces, ["block"], "pieces", placed=True, buckets=buckets)


def passed(pieces: DataFrame, state: DataFrame, travelling, products: np.ndarray | None) -> DataFrame:
    """``block, chunk, m``: the vectors of every block (no chunk), updated if there are ``products``, and per task what they pull
    for the side that travels, a row per chunk of it, with the products of every two factors behind the last one.

    One multiplicative update: times (V · the side that travels) over (vectors · its products); a zero denominator gives 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = np.ascontiguousarray(travelling.value.T)
        factors, length = side.shape
        pull, gram, block = np.zeros((factors, length)), np.zeros((factors, factors)), None
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.column("block")[k].as_py()
                kinds = batch.column("kinds")[k].as_py().split()
                counts, at, v, m = (np.frombuffer(batch.column(name)[k].as_buffer(), kind) for name, kind in (
                    ("counts", np.int32), ("at", kinds[0]), ("v", kinds[1]), ("m", np.float64)))
                m, at, v, filled = m.reshape(-1, factors), at.astype(np.intp), v.astype(np.float64), counts > 0
                if products is not None:
                    starts, top = (np.cumsum(counts) - counts)[filled], np.zeros((factors, len(m)))
                    for a in range(factors if len(at) else 0):
                        top[a, filled] = np.add.reduceat(side[a][at] * v, starts)
                    down = m @ products
                    with np.errstate(divide="ignore", invalid="ignore"):
                        m = np.where(down != 0, m * top.T / down, 0.0)
                for a in range(factors if len(at) else 0):
                    pull[a] += np.bincount(at, np.repeat(m[:, a], counts) * v, minlength=length)
                gram += m.T @ m
                yield handed(block, [-1], [m])
        if block is not None:
            sums = [pull[:, a:a + CHUNK].T for a in range(0, length, CHUNK)]
            for chunk, part in enumerate([*sums, gram]):
                yield handed(block, [chunk], [part])

    def handed(block: int, chunks: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array(chunks, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                                          names=["block", "chunk", "m"])

    met = pieces.select("block", "kinds", "counts", "at", "v").join(state.hint("merge"), "block")
    return met.select("block", "kinds", "counts", "at", "v", "m").mapInArrow(run, "block long, chunk int, m binary")


def summed(state: DataFrame, length: int, factors: int, tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """What all ``tasks`` pull for the side that travels, and the sums of products of every two factors."""
    def added(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(m.as_buffer()) for m in group.column("m")], axis=0)
        return pa.table([group.column("chunk")[:1], pa.array([total.tobytes()], pa.binary())], schema=SUMS)

    rows = state.where("chunk >= 0").select("chunk", "m")
    if tasks * length * factors * 8 <= TRAVELS:
        rows = rows.toArrow()
        rows = pa.concat_tables([rows.slice(0, 0).cast(SUMS), *[added(rows.filter(pc.equal(rows.column("chunk"), k))) for k in pc.unique(rows.column("chunk"))]])
    else:
        rows = rows.groupBy("chunk").applyInArrow(added, "chunk int, m binary").toArrow()
    parts = dict(zip(rows.column("chunk").to_pylist(), (np.frombuffer(m.as_buffer()).reshape(-1, factors) for m in rows.column("m"))))
    if not parts:
        return np.zeros((length, factors)), np.zeros((factors, factors))
    return np.concatenate([parts[k] for k in range(len(parts) - 1)]), parts[len(parts) - 1]


def factorized(matrix: DataFrame, start: DataFrame, own: str, other: str, vectors: tuple[str, str], cells: int, squares: float, factors: int,
               rounds: int, check_every: int) -> tuple[DataFrame, DataFrame]:
    """``own, vector`` and ``other, vector`` after ``rounds`` of H and then W, or earlier if the product is exact.

    ``own`` are the keys in blocks and ``other`` those that travel, from ``start(other, vector)``; ``vectors`` are the names in this order,
    "h" and "w" or "w" and "h". ``squares``: the sum of the squares of all ``cells``.
    """
    spark = matrix.sparkSession
    buckets = spark.sparkContext.defaultParallelism
    begun = start.toArrow().combine_chunks()
    side = begun.column(vectors[1]).combine_chunks().flatten().to_numpy().reshape(-1, factors).copy()
    numbers = pa.table({other: begun.column(other), "at": np.arange(len(begun), dtype=np.int32)})
    places = cut(spark.createDataFrame(numbers, start.select(other).schema.add("at", T.IntegerType())), "places")
    pieces = layout(matrix, own, other, vectors[0], places, block_numbers(spark, buckets, -(-cells // (CELLS * buckets))), buckets, factors)
    state, stored = pieces.select("block", F.col("start").alias("m")), None
    with small_batches(spark, 2):
        def half(products: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
            """One pass over the cells; what the pass before wrote is let go."""
            nonlocal state, stored
            travelling = spark.sparkContext.broadcast(side)
            written = laid_out(passed(pieces, state, travelling, products), ["block"], "state", placed=True, buckets=buckets)
            travelling.destroy()
            if stored is not None:
                discarded(stored)
            state, stored = written.where("chunk = -1").select("block", "m"), written
            return summed(written, len(side), factors, buckets)

        def moved(pull: np.ndarray, gram: np.ndarray) -> np.ndarray:
            down = side @ gram
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(down != 0, side * pull / down, 0.0)

        first = vectors[0] == "w"  # H is updated first: from the blocks as they start, if it is what travels
        if first and rounds:
            pull, gram = half(None)
        for done in range(1, rounds + 1):
            if first:
                side = moved(pull, gram)
                pull, gram = half(side.T @ side)
            else:
                pull, gram = half(side.T @ side)
                side = moved(pull, gram)
            if done % check_every == 0 and done < rounds and squares - 2 * (pull * side).sum() + (gram * (side.T @ side)).sum() == 0.0:
                break
    last = spark.sparkContext.broadcast(side)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                m = np.frombuffer(batch.column("m")[k].as_buffer())
                yield listed(batch.column("keys")[k].values, m)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield listed(batch.column(other), last.value[batch.column("at").to_numpy()].ravel(), other, vectors[1])

    def listed(keys: pa.Array, m: np.ndarray, key: str = own, vector: str = vectors[0]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * factors), pa.array(m))], names=[key, vector])

    kinds = dict(matrix.dtypes)
    return (cut(pieces.select("block", "keys").join(state, "block").select("keys", "m").mapInArrow(opened, f"{own} {kinds[own]}, {vectors[0]} array<double>"), vectors[0]),
            places.select(other, "at").mapInArrow(found, f"{other} {kinds[other]}, {vectors[1]} array<double>"))
