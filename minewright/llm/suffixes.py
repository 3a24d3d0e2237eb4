"""Repeated passages: Burrows-Wheeler transforms of aligned passages, merged by interleave refinement."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.llm.batches import lean, rereadable
from minewright.llm.words import chunks, gram_hashes, hashes_of, mixed, running_sums
from minewright.session import cut

#: Passages with one core that meet in one task; more of them are told apart by longer cores.
BLOCK = 20_000
#: Passages that are merged at once, and bytes of a text that are looked at at once.
HELD, PIECE = 4000, 1 << 20
#: A symbol after every byte: the end of a passage.
_END = 256
_LOW = np.uint64(0xFFFFFFFF)


def _pieces(column: pa.Array, length: int, piece: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, place in it, offsets, bytes)``: rows together, or of a very long row the strings that start in a piece."""
    for row, offsets, data in chunks(column):
        if len(offsets) > 2 or len(data) <= 2 * piece:
            yield row, 0, offsets, data
        else:
            for at in range(0, len(data), piece):
                part = data[at:at + piece + length - 1]
                yield row, at, np.array([0, len(part)]), part


def passages(offsets: np.ndarray, data: np.ndarray, length: int, width: int) -> tuple[np.ndarray, ...]:
    """Row, first start, last start, core start, core hash and passage hash of all strings of ``length`` bytes inside rows.

    The least hashed gram of a string is its anchor; equal strings have it at the same place. Consecutive
    strings with one anchor and the same half of places for it are a passage. All its strings hold its
    core: ``length - width + 1`` bytes that start where its last possible string does.
    """
    gram = min(16, length // 2)
    running = running_sums(data)
    size = len(data) - length + 1
    if size <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    least = gram_hashes(running, gram)
    least = (least & ~_LOW) | np.arange(len(least), dtype=np.uint64)
    grams, span = length - gram + 1, 1
    while 2 * span <= grams:
        least = np.minimum(least[:len(least) - span], least[span:])
        span *= 2
    least = np.minimum(least[:size], least[grams - span:grams - span + size])
    starts = np.arange(size)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:size]
    inside = starts + length <= ends
    starts = starts[inside]
    anchor = (least[inside] & _LOW).astype(np.int64)
    half = (anchor - starts >= width).astype(np.int64)
    mark = 2 * anchor + half
    new = np.flatnonzero(np.append(True, mark[1:] != mark[:-1])) if len(mark) else np.zeros(0, np.int64)
    first, last = starts[new], starts[np.append(new[1:], len(mark)) - 1] if len(new) else starts[new]
    core = anchor[new] - half[new] * width
    core_hash = mixed(hashes_of(running, core, core + length - width + 1) + half[new].astype(np.uint64))
    passage_hash = mixed(hashes_of(running, first, last + length) + (core - first).astype(np.uint64))
    return np.searchsorted(offsets, first, "right") - 1, first, last, core, core_hash, passage_hash


def _passages(length: int, width: int, piece: int):
    names = ["row", "core_hash", "passage_hash", "first", "last", "core"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for row, at, offsets, data in _pieces(batch.column("text"), length, piece):
                own, first, last, core, core_hash, passage_hash = passages(offsets, data, length, width)
                base = at - offsets[own]
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[row + own]), pa.array(core_hash.view(np.int64)), pa.array(passage_hash.view(np.int64)),
                    *(pa.array((x + base).astype(np.int32)) for x in (first, last, core))], names=names)

    return run


def _matrix(column: pa.Array, width: int, backwards: bool = False) -> np.ndarray:
    """The bytes of every row from column 0 on, then ``_END``."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    out = np.full((len(column), width), _END, np.int16)
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    place = np.arange(len(data)) - offsets[row]
    if backwards:
        place = np.diff(offsets)[row] - 1 - place
    out[row, place] = data
    return out


def _refined(block: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The stable order by block and symbol."""
    return np.argsort(block * (_END + 1) + symbol, kind="stable")


def interleaved(following: np.ndarray, group: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The common order of the sorted shards of every group, and the common prefix of each row with the one before.

    Rows come by group, shard and the shard's own order. At first all shards of a group interleave as they
    stand; every round refines the blocks by one further symbol. A block of one shard is finished: its
    order and common prefixes are the shard's. The round that parts two neighbours is their common prefix.
    """
    size, width = following.shape
    order, prefix = np.arange(size), np.full(size, -1)
    own = np.zeros(size, np.int64)
    differ = following[1:] != following[:-1]
    own[1:] = np.where(differ.any(1), differ.argmax(1), width) if width else 0
    first = np.append(True, group[1:] != group[:-1])
    prefix[first] = 0
    rows, place, block = order, order, group
    for depth in range(width + 1):
        begin = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
        ends = np.append(begin[1:], len(block))
        several = shard[rows[begin]] != shard[rows[ends - 1]] if len(begin) else np.zeros(0, bool)
        kept = np.repeat(several, ends - begin)
        rows, place, block = rows[kept], place[kept], block[kept]
        if depth == width or not len(rows):
            break
        symbol = following[rows, depth].astype(np.int64)
        turned = _refined(block, symbol)
        rows, symbol = rows[turned], symbol[turned]
        order[place] = rows
        parted = np.append(False, (block[1:] == block[:-1]) & (symbol[1:] != symbol[:-1]))
        prefix[place[parted]] = depth
        block = np.cumsum(np.append(False, block[1:] != block[:-1]) | parted)
    unknown = np.flatnonzero(prefix < 0)
    neighbours = (order[unknown] == order[unknown - 1] + 1) & (shard[order[unknown]] == shard[order[unknown - 1]])
    prefix[unknown] = np.where(neighbours, own[order[unknown]], width)
    return order, prefix


class Least:
    """The least of any run of values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            below, span = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-span], below[span:]))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least of ``start`` to ``end``, both included."""
        level = np.frexp(end - start + 1)[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][start[at]], self.levels[k][end[at] - 2 ** k + 1])
        return out


def repeated(preceding: np.ndarray, following: np.ndarray, group: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """For every row and number of symbols before the core: does the string that starts there occur in another row?

    The suffixes that begin at the core are merged first. Then each step puts one symbol of the transform, the
    one before, in front of all suffixes: within a block of equal beginnings the merged order holds, so two
    neighbours share the least common prefix between them. Blocks of one suffix go.
    """
    size, width = len(group), following.shape[1] + 1
    found = np.zeros((size, width), bool)
    order, prefix = interleaved(following, group, shard)
    least = Least(prefix)
    rows, rank, block = order, np.arange(size), group[order]
    for before in range(width):
        if not len(rows):
            break
        with_next = np.append(block[1:] == block[:-1], False)
        alone = ~(with_next | np.append(False, with_next[:-1]))
        if alone.any():
            rows, rank, block = rows[~alone], rank[~alone], block[~alone]
            with_next = with_next[~alone]
        at = np.flatnonzero(with_next)
        at = at[least.of(rank[at] + 1, rank[at + 1]) >= width - 1 - before]
        found[rows[at], before] = found[rows[at + 1], before] = True
        if before == width - 1:
            break
        symbol = preceding[rows, before].astype(np.int64)
        if (symbol == _END).any():
            kept = symbol != _END
            rows, rank, block, symbol = rows[kept], rank[kept], block[kept], symbol[kept]
        same = block[1:] == block[:-1]
        if (same & (symbol[1:] != symbol[:-1])).any():
            turned = _refined(block, symbol)
            rows, rank, symbol = rows[turned], rank[turned], symbol[turned]
            block = np.cumsum(np.append(False, (block[1:] != block[:-1]) | (symbol[1:] != symbol[:-1])))
    return found


def _whole_groups(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Whole groups of equal ``core_hash`` from rows sorted by it, about ``most`` rows at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        key = batch.column("core_hash").to_numpy()
        while size + batch.num_rows >= most and batch.num_rows:
            changes = np.flatnonzero(key[1:] != key[:-1]) + 1
            if held and held[-1].column("core_hash")[held[-1].num_rows - 1].as_py() != key[0]:
                changes = np.append(0, changes)
            if not len(changes):
                break
            at = int(changes[min(np.searchsorted(changes, max(0, most - size)), len(changes) - 1)])
            held.append(batch.slice(0, at))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            batch, key, held, size = batch.slice(at), key[at:], [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _merged(width: int):
    """Rows by core, shard and place: the starts, as distances before the core, of strings that occur elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            key = batch.column("core_hash").to_numpy()
            core = _matrix(batch.column("core"), len(batch.column("core")[0].as_py()))
            group = np.cumsum(np.append(False, (key[1:] != key[:-1]) | (core[1:] != core[:-1]).any(1)))
            preceding, following = _matrix(batch.column("left"), width - 1, True), _matrix(batch.column("right"), width - 1)
            found = repeated(preceding, following, group, batch.column("shard").to_numpy())
            found[batch.column("several").to_numpy(zero_copy_only=False)] = True
            distance = np.arange(width)
            found &= distance <= (preceding != _END).sum(1)[:, None]
            found &= width - 1 - distance <= (following != _END).sum(1)[:, None]
            edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, least = np.nonzero(edges == 1)
            most = np.nonzero(edges == -1)[1] - 1
            shift = batch.column("shift").to_numpy()[row]
            if len(row):
                yield pa.RecordBatch.from_arrays([
                    batch.column("id_hash").take(pa.array(row)), batch.column("passage_hash").take(pa.array(row)),
                    pa.array((least + shift).astype(np.int32)), pa.array((most + shift).astype(np.int32))],
                    names=["core_hash", "passage_hash", "least", "most"])

    return run


MARKS = "core_hash long, passage_hash long, least int, most int"


def _merge(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """Every task sorts its passages as a shard; where the shards of a core meet, they are merged."""
    shards = rows.sortWithinPartitions("core_hash", "core", "right").select(
        "*", F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("place"))
    return (shards.repartition(parts, "core_hash").sortWithinPartitions("core_hash", "core", "shard", "place")
            .mapInArrow(lean(_merged(width)), MARKS))


def _longer_cores(rows: DataFrame, length: int, width: int) -> tuple[DataFrame, int]:
    """Every passage in two, each with the longer core that its own strings share, and their width.

    Strings that start less than ``half`` before the core share more of what follows, the others more of what precedes.
    """
    half = (width + 1) // 2
    size = length - half + 1
    after = "concat(core, right)"
    near = (f"substring(left, {1 - half}, {half - 1})" if half > 1 else "substring(left, 1, 0)", f"substring({after}, 1, {size})",
            f"substring({after}, {size + 1}, {half - 1})", "shift", f"length({after}) >= {size}")
    far = (f"substring(left, 1, length(left) - {half})", f"concat(substring(left, {-half}, {half}), substring({after}, 1, {size - half}))",
           f"substring({after}, {size - half + 1}, {half - 1})", f"shift + {half}", f"length(left) >= {half} and length({after}) >= {size - half}")
    out = None
    for cell, (left, core, right, shift, inside) in enumerate((near, far)):
        part = (rows.where(inside).selectExpr("id_hash", "passage_hash", "several", f"{left} as left", f"{core} as core", f"{right} as right",
                                              f"cast({shift} as int) as shift", "core_hash as wide")
                .withColumn("core_hash", F.xxhash64("wide", F.lit(cell), "core")).drop("wide"))
        out = part if out is None else out.unionByName(part)
    return out, half


def _marks(rows: DataFrame, length: int, width: int, parts: int, block: int) -> DataFrame:
    """Distances before the core, ``least`` to ``most``, at which strings of a passage start that occur elsewhere."""
    found = None
    while True:
        crowded = cut(rows.groupBy("core_hash").agg(F.count("*").alias("n")).where(F.col("n") > block).select("core_hash"), "crowded")
        some = not crowded.isEmpty()
        calm = rows.join(crowded, "core_hash", "left_anti") if some else rows
        part = _merge(calm, width, parts)
        found = part if found is None else found.unionByName(part)
        if not some:
            return found
        hot = rows.join(crowded, "core_hash", "left_semi")
        if width == 1:  # the core is the whole string
            return found.unionByName(hot.select(F.col("id_hash").alias("core_hash"), "passage_hash", F.col("shift").alias("least"),
                                                F.col("shift").alias("most")))
        divided, width = _longer_cores(hot, length, width)
        rows = cut(divided, "divided")


def _spans(docs: DataFrame, texts: DataFrame, length: int, block: int, piece: int) -> DataFrame:
    """``row, spans``: bytes from ``start`` to before ``end`` that strings cover which start elsewhere too."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = (length - min(16, length // 2) + 2) // 2
    kinds = "row long, core_hash long, passage_hash long, first int, last int, core int"
    starts = cut(texts.mapInArrow(lean(_passages(length, width, piece)), kinds), "passages")
    # Written first: only a join of two plain shuffles can divide the passages of one very common core.
    often = cut(starts.groupBy("core_hash").agg(F.count("*").alias("n")).where("n > 1").select("core_hash"), "often")
    shared = cut(starts.join(often, "core_hash", "left_semi"), "shared")
    one = cut(shared.groupBy("core_hash", "passage_hash").agg((F.count("*") > 1).alias("several"), F.min(F.struct("row", "first", "last", "core")).alias("one"))
              .select("one.row", F.struct("core_hash", "passage_hash", "several", "one.first", "one.last", "one.core").alias("p")), "one")
    wanted = one.groupBy("row").agg(F.collect_list("p").alias("wanted"))
    # Both sides grow with the corpus: a shuffled join at every size, whose texts the last join uses again.
    cored = length - width + 1
    rows = (texts.join(wanted.hint("merge"), "row").select(F.explode("wanted").alias("p"), F.expr("cast(text as binary)").alias("bytes"))
            .selectExpr("p.core_hash", "p.core_hash as id_hash", "p.passage_hash", "p.several", "0 as shift",
                        "substring(bytes, p.first + 1, p.core - p.first) as left", f"substring(bytes, p.core + 1, {cored}) as core",
                        f"substring(bytes, p.core + {cored + 1}, p.last + {length} - p.core - {cored}) as right"))
    crowds = one.groupBy("p.core_hash").agg(F.count("*").alias("n")).where(F.col("n") > block)
    if crowds.isEmpty():
        marks = _merge(rows, width, parts)
    else:
        marks = _marks(cut(rows, "rows"), length, width, parts, block)
    places = shared.join(marks, ["core_hash", "passage_hash"]).select(
        "row", F.struct((F.col("core") - F.col("most")).alias("start"), (F.col("core") - F.col("least") + length).alias("end")).alias("span"))
    return places.groupBy("row").agg(F.collect_list("span").alias("spans"))


def _joined(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).fill_null(b"")
        removed, kept = [], []
        for k, spans in enumerate(batch.column("spans").to_pylist()):
            text, at, left = texts[k].as_py(), 0, []
            runs = _joined(spans or [])
            for start, end in runs:
                left.append(text[at:start])
                at = end
            left.append(text[at:])
            removed.append([{"start": a, "end": b} for a, b in runs])
            kept.append(b"".join(left))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(t) for t in texts.to_pylist()], pa.int64()), pa.array(removed, kind),
                                          pa.array(kept, pa.binary())], names=["id", "n_bytes", "removed", "kept"])


def without_repeats(docs: DataFrame, length: int = 400, id_column: str = "doc_id", text_column: str = "text", block: int = BLOCK,
                    piece: int = PIECE) -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``removed`` (maximal spans of bytes) and ``kept``, the other bytes.

    A byte of a text's UTF-8 is removed if a string of ``length`` bytes covers it that starts anywhere else as well, in
    the same text or another; strings never cross texts and are judged on the input.

    1. Every string has an anchor, its least hashed gram; strings with one anchor form passages around a core
       of more than half of ``length`` bytes. Equal strings have equal cores at the same place, so only passages with a core
       that occurs twice are looked at. Equal passages are one, with their number.
    2. The passages of a core are aligned strings: the suffixes that can be equal stand in one column. Each task
       sorts its passages by what follows the core, a shard; the bytes before the core are the columns of its
       transform. Where the shards of a core meet, their orders are merged by interleave refinement, which gives the common
       prefixes; then one column after the other of the transform is put in front.
    3. Neighbours that share ``length`` bytes mark the string. Marks return to all equal passages and are joined per text.

    A core with more than ``block`` different passages is told apart by longer cores (twice as many passages, half as wide), up to
    whole strings. A text is looked at ``piece`` bytes at a time. A null text counts as empty; a text shorter than ``length`` keeps all. Repeated rows are repeats of each
    other. ``kept`` need not be valid UTF-8. Other columns are not read; an empty table gives an empty result.
    """
    if length < 2:
        raise ValueError("a string has two bytes or more")
    docs = rereadable(docs)
    row = F.monotonically_increasing_id().alias("row")
    texts = docs.select(row, F.col(text_column).cast("string").alias("text"))
    ids = docs.select(row, F.col(id_column).cast("long").alias("id"))
    judged = ids.join(_spans(docs, texts, length, block, piece).hint("merge"), "row", "left").hint("merge")
    found = texts.join(judged, "row").mapInArrow(
        lean(_left_over), "id long, n_bytes long, removed array<struct<start: int, end: int>>, kept binary")
    return found.withColumnRenamed("id", id_column)
