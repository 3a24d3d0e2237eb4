"""Chat formatting: segments of all turns copied into one preallocated Arrow buffer."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: ``### role: text</turn>`` and a line end. In role and text no raw ``#`` or ``<`` is left, in a role no ``:`` either.
OPEN, MIDDLE, CLOSE = b"### ", b": ", b"</turn>\n"
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l"}
ROLE_ESCAPES = ESCAPES | {":": "\\c"}
_PLAIN = {after: before for before, after in ROLE_ESCAPES.items()}
_ESCAPED = re.compile(r"\\[\\hlc]")
#: Bytes of text that are assembled at once.
PART_BYTES = 1 << 22

PARTS = "conv_id long, part long, whole boolean, n_turns long, text string, loss_start array<long>, loss_end array<long>"


def escaped(texts: pa.Array, escapes: dict[str, str] = ESCAPES) -> pa.Array:
    texts = texts.fill_null("")
    for before, after in escapes.items():  # the backslash comes first
        texts = pc.replace_substring(texts, before, after)
    return texts


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[0]], text) if "\\" in text else text


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    turns = [turn[len(OPEN):].partition(": ") for turn in text.split("</turn>\n")[:-1]]
    return [(unescaped(role), unescaped(content)) for role, _, content in turns]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return np.diff(offsets), data[offsets[0]:offsets[-1]]


def _scatter(out: np.ndarray, to: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> None:
    """Copy consecutive segments of ``data`` to the places ``to``."""
    begin = np.cumsum(lengths) - lengths
    out[np.repeat(to - begin, lengths) + np.arange(len(data))] = data


def assembled(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns, the first byte of each, and per turn its characters and those before its text."""
    roles, texts = escaped(roles, ROLE_ESCAPES), escaped(texts)
    (role_bytes, role_data), (text_bytes, text_data) = _bytes(roles), _bytes(texts)
    n = len(roles)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2], lengths[:, 3], lengths[:, 4] = len(OPEN), role_bytes, len(MIDDLE), text_bytes, len(CLOSE)
    to = np.cumsum(lengths).reshape(n, 5) - lengths
    out = np.empty(int(lengths.sum()), np.uint8)
    for k, fixed in ((0, OPEN), (2, MIDDLE), (4, CLOSE)):
        out[to[:, k, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    _scatter(out, to[:, 1], role_bytes, role_data)
    _scatter(out, to[:, 3], text_bytes, text_data)
    head = pc.utf8_length(roles).to_numpy(zero_copy_only=False).astype(np.int64) + len(OPEN) + len(MIDDLE)
    return out, to[:, 0], head + pc.utf8_length(texts).to_numpy(zero_copy_only=False) + len(CLOSE), head


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = np.cumsum(pc.binary_length(batch.column("text").fill_null("")).to_numpy(zero_copy_only=False)) // PART_BYTES
    edges = [0, *(np.flatnonzero(np.diff(size)) + 1), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() << 33
    waiting = None  # the last parts, of which is not known yet whether their conversation goes on
    first = True
    for batch in batches:
        for rows in _slices(batch):
            out = _parts(rows, part)
            part += out.num_rows
            if waiting is not None:
                goes_on = out.column("conv_id")[0].as_py() == waiting.column("conv_id")[waiting.num_rows - 1].as_py()
                out = _whole(out, 0, not goes_on)
                yield _whole(waiting, waiting.num_rows - 1, not goes_on)
            elif first:
                out = _whole(out, 0, False)
            waiting, first = out, False
    if waiting is not None:
        yield _whole(waiting, waiting.num_rows - 1, False)


def _whole(out: pa.RecordBatch, at: int, yes: bool) -> pa.RecordBatch:
    """A part is a whole conversation unless it may go on in the part before or after."""
    flags = out.column("whole").to_numpy(zero_copy_only=False).copy()
    flags[at] &= yes
    return out.set_column(2, "whole", pa.array(flags))


def _parts(rows: pa.RecordBatch, first: int) -> pa.RecordBatch:
    conv, role = rows.column("conv_id"), rows.column("role")
    data, starts, chars, head = assembled(role, rows.column("text"))
    known = conv.fill_null(0).to_numpy()
    null = conv.is_null().to_numpy(zero_copy_only=False)
    begins = np.concatenate([[0], np.flatnonzero((known[1:] != known[:-1]) | (null[1:] != null[:-1])) + 1])
    n = len(begins)
    texts = pa.StringArray.from_buffers(n, pa.py_buffer(np.append(starts[begins], len(data)).astype(np.int32)), pa.py_buffer(data))
    ends = np.cumsum(chars)
    own = np.repeat((ends - chars)[begins], np.diff(np.append(begins, len(known))))  # characters before the part
    loss = np.flatnonzero(pc.equal(role.fill_null(""), "assistant").to_numpy(zero_copy_only=False))
    cuts = pa.array(np.searchsorted(loss, np.append(begins, len(known))), pa.int32())
    spans = [pa.ListArray.from_arrays(cuts, pa.array(place[loss])) for place in (ends - chars + head - own, ends - len(CLOSE) - own)]
    return pa.RecordBatch.from_arrays([
        conv.take(pa.array(begins)), pa.array(first + np.arange(n)), pa.array(np.ones(n, bool)),
        pa.array(np.diff(np.append(begins, len(known)))), texts, *spans],
        names=["conv_id", "part", "whole", "n_turns", "text", "loss_start", "loss_end"])


def format_chats(turns: DataFrame) -> DataFrame:
    """Formatted conversations of ``turns(conv_id, turn, role, text)``, the turns of a conversation in the order of ``turn``.

    ``conv_id, part, whole, n_turns, text, loss_start, loss_end``: a conversation is the texts of its parts in the
    order of ``part``; it is one part (``whole``) unless it is very long or lies on a partition's edge. The loss spans are
    the characters of a part's text that hold assistant texts. Rows are range-partitioned by conversation and turn,
    so a huge conversation spreads over tasks.

    A null role or text counts as empty; rows without conversation form one of their own; a null turn comes first, equal
    turns follow by role and text; repeated rows are turns each. Other columns are not read; an empty table gives
    an empty result. ``parsed`` gives back roles and texts exactly.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_formatted, PARTS)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, starts, ends) -> None:
        for role, content in parsed(text):
            self.turns.update(f"{role}\n{content}\n".encode())
            self.n_turns += 1
        for a, b in zip(starts, ends):
            plain = unescaped(text[a:b])
            self.loss.update(plain.encode())
            self.loss_chars += len(plain)
        self.chars += len(text)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its parts, which follow one another."""
    conv, digest, done = None, None, []
    for batch in batches:
        for id_, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss_start", "loss_end"))):
            if digest is None or id_ != conv:
                if digest:
                    done.append((conv, digest))
                conv, digest = id_, _Digest()
            digest.add(text, starts, ends)
        if done:
            yield _digests(done)
            done = []
    if digest:
        yield _digests([(conv, digest)])


def _digests(done: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([c for c, _ in done], pa.int64()), pa.array([d.n_turns for _, d in done], pa.int64()), pa.array([d.turns.hexdigest() for _, d in done]),
        pa.array([d.loss_chars for _, d in done], pa.int64()), pa.array([d.loss.hexdigest() for _, d in done]),
        pa.array([d.chars for _, d in done], pa.int64())], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` read back from written ``format_chats``.

    Only conversations of several parts move; a digest of one needs its parts in order, streamed through one task.
    """
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    parts = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    divided = formatted.where("not whole").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part")
    return formatted.where("whole").mapInArrow(_digested, out).unionByName(divided.mapInArrow(_digested, out))
