"""Exact duplicates: Patricia tries own the distinct texts of their length-and-hash partition."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.llm.batches import lean, rereadable, unused

#: Bytes of labels that a trie holds before it hands on its finished subtrees.
TRIE_BYTES = 16 << 20


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner = label, {}, None


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving slices."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            n = middle
    return low


class PatriciaTrie:
    """A compressed radix trie over byte strings; a terminal node holds its string's owner."""

    def __init__(self):
        self.root, self.bytes = Node(b""), 0

    def terminal(self, key: bytes) -> Node:
        """The terminal node of ``key``, made if it is new (then without owner)."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.bytes += len(child.label) + 200
                return child
            same = len(child.label) if key.startswith(child.label, at) else shared_length(child.label, key[at:at + len(child.label)])
            if same < len(child.label):
                upper = Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = child = upper
                self.bytes += 200
            node, at = child, at + same
        return node

    def owners(self, node: Node | None = None) -> Iterator:
        stack = [node or self.root]
        while stack:
            node = stack.pop()
            if node.owner is not None:
                yield node.owner
            stack.extend(node.children.values())

    def spill(self, upto: bytes) -> Iterator:
        """Owners of the subtrees left of the path of ``upto``; those subtrees leave the trie.

        With keys inserted in byte order nothing can reach them any more.
        """
        node, at = self.root, 0
        while at < len(upto):
            for byte in [b for b in node.children if b < upto[at]]:
                yield from self.owners(node.children.pop(byte))
            node = node.children[upto[at]]
            at += len(node.label)
        self.bytes = len(upto) + 200


def _normal(batch: pa.RecordBatch) -> list[bytes]:
    return pc.ascii_lower(batch.column("text").fill_null("")).cast(pa.binary()).to_pylist()


def _first(a: tuple, b: tuple) -> tuple:
    """The owner of the two (id, row): larger id, then smaller row; a null id comes last."""
    return a if (a[0] is not None, a[0] or 0, -a[1]) >= (b[0] is not None, b[0] or 0, -b[1]) else b


def _last(a: tuple, b: tuple) -> tuple:
    """The owner of the two (id, row): smaller id, then smaller row; a null id comes last."""
    return a if (a[0] is None, a[0] or 0, a[1]) <= (b[0] is None, b[0] or 0, b[1]) else b


def _batch_owners(batch: pa.RecordBatch, better) -> tuple[list[bytes], list[int], dict[int, list]]:
    """Texts, the row number of each row's owner inside the batch, and the owners with their counts."""
    keys, trie = _normal(batch), PatriciaTrie()
    ids, rows = batch.column("id").to_pylist(), batch.column("row").to_pylist()
    nodes = []
    for key, id_, row in zip(keys, ids, rows):
        node = trie.terminal(key)
        if node.owner is None:
            node.owner = [(id_, row), 0, key]
        node.owner[0] = better(node.owner[0], (id_, row))
        node.owner[1] += 1
        nodes.append(node)
    owners = {node.owner[0][1]: node.owner for node in nodes}
    return keys, [node.owner[0][1] for node in nodes], owners


def _rows(better):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, local, owners = _batch_owners(batch, better)
            digests = {row: hashlib.sha256(owner[2]).hexdigest() for row, owner in owners.items()}
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("row"), pa.array(local, pa.int64()),
                pa.array([digests[row] for row in local], pa.string())], names=["id", "row", "local", "text_sha256"])
    return run


def _local_owners(better):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners = list(_batch_owners(batch, better)[2].values())
            yield pa.RecordBatch.from_arrays([
                pa.array([o[0][0] for o in owners], pa.int64()), pa.array([o[0][1] for o in owners], pa.int64()),
                pa.array([o[1] for o in owners], pa.int64()), pa.array([len(o[2]) for o in owners], pa.int64()),
                pa.array([hashlib.blake2b(o[2], digest_size=8).digest() for o in owners], pa.binary()),
                pa.array([o[2] for o in owners], pa.binary())], names=["id", "row", "n", "length", "hash", "key"])
    return run


def _trie_owners(better, most_bytes: int):
    """Rows of one partition in byte order of ``key``: the owner and size of every string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()
        for batch in batches:
            key = None
            for id_, row, n, key in zip(*(batch.column(c).to_pylist() for c in ("id", "row", "n", "key"))):
                node = trie.terminal(key)
                if node.owner is None:
                    node.owner = [(id_, row), 0, []]
                node.owner[0] = better(node.owner[0], (id_, row))
                node.owner[1] += n
                node.owner[2].append(row)
                trie.bytes += 40
            if trie.bytes > most_bytes and key:
                yield from _found(trie.spill(key))
        yield from _found(trie.owners())
    return run


def _found(owners: Iterator) -> Iterator[pa.RecordBatch]:
    rows = [(local, id_, row, n) for (id_, row), n, locals_ in owners for local in locals_]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)],
                                         names=["local", "keep_id", "keep_row", "group_size"])


def _decided(docs: DataFrame, id_column: str, text_column: str, keep: str, trie_bytes: int) -> DataFrame:
    better = {"largest": _first, "smallest": _last}[keep]
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_column).cast("string").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = (rows.mapInArrow(lean(_local_owners(better)), "id long, row long, n long, length long, hash binary, key binary")
              .repartition(parts, "length", "hash").sortWithinPartitions("key")
              .mapInArrow(lean(_trie_owners(better, trie_bytes)), "local long, keep_id long, keep_row long, group_size long"))
    return (rows.mapInArrow(lean(_rows(better)), "id long, row long, local long, text_sha256 string").join(owners, "local")
            .withColumn("kept", F.col("row") == F.col("keep_row")))


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest",
                     trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; ``keep`` says whether the ``largest`` or
    ``smallest`` id of equal texts stays. Every batch of rows first goes through a small trie, so that
    a text travels once per batch however often it occurs there. The distinct texts are dealt by
    length and content hash, sorted, and inserted whole into the Patricia trie of their partition;
    over ``trie_bytes`` it hands on the subtrees that the sorted order has passed. Owners return
    to the rows through the batch's own owner row, so no join key holds more than a batch.

    A null text counts as empty; the empty text is a text like others. A null id ranks behind all ids and
    stays only in a group without ids. Of repeated rows (same id and text) one is kept. Other columns are not
    read; an empty table gives an empty result.
    """
    return _decided(rereadable(docs), id_column, text_column, keep, trie_bytes).select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", "text_sha256")


def without_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest",
                       trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The rows that ``exact_duplicates`` keeps, with all their columns."""
    docs, row = rereadable(docs), unused(docs, "row")
    kept = _decided(docs, id_column, text_column, keep, trie_bytes).where("kept").select(F.col("row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(kept, row, "left_semi").drop(row)
