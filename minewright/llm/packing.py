"""Order-preserving packing of token streams into sequences, by dynamic programming over cut places."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.llm.batches import lean
from minewright.llm.bpe import encoder

#: The id after each document.
END = 0
#: What a cut costs, in padding tokens: after a document, after a sentence, elsewhere.
CUT_COSTS = (0, 2, 12)
#: So many windows in a row may be full before one ends with a sentence or document again.
FULL_WINDOWS = 3
#: Tokens that one run of the dynamic programme holds.
HELD = 500_000
#: Sequence numbers of a partition.
SEQUENCES = 1 << 33


def best_cuts(places: np.ndarray, costs: np.ndarray, width: int) -> list[int]:
    """Indices of the chosen ``places``: those of the cuts with the least padding plus cut costs.

    ``places`` ascend from 0 to the stream's end, at most ``width`` apart. A window costs ``width`` less
    its length, and its end's cost. With g(i) = best(i) + place(i) the best of j is its own cost plus width - place(j)
    plus the least g over the last ``width`` tokens; a queue with ascending g holds the candidates, so every place
    enters and leaves it once. The last window's padding does not count: it is divided later.
    """
    at, cost = places.tolist(), costs.tolist()
    last = len(at) - 1
    before = [0] * (last + 1)
    queue: deque = deque([(0, 0, 0)])
    pop, popleft, push = queue.pop, queue.popleft, queue.append
    for j in range(1, last):
        place = at[j]
        low = place - width
        while queue[0][1] < low:
            popleft()
        g, _, i = queue[0]
        before[j] = i
        g += cost[j] + width
        while queue and queue[-1][0] >= g:
            pop()
        push((g, place, j))
    if last:
        low = at[last] - width
        fit = [(g - place, -place, i) for g, place, i in queue if place >= low]
        before[last] = min(fit)[2]
    cuts = [last]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    return cuts[::-1]


def cut_places(ids: np.ndarray, document_ends: np.ndarray, sentence_end: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut and what that costs.

    Document and sentence ends; up to ``FULL_WINDOWS`` times ``width`` tokens after each of them, so that windows
    from there can be full; and every ``width`` tokens of a longer stretch without an end.
    """
    size = len(ids)
    cost = np.full(size + 1, 255, np.uint8)
    sentences = np.flatnonzero(sentence_end[ids]) + 1
    ends = np.concatenate([[0], sentences, document_ends])
    for windows in range(1, FULL_WINDOWS + 1):
        full = ends + windows * width
        cost[full[full < size]] = CUT_COSTS[2]
    cost[sentences] = CUT_COSTS[1]
    cost[document_ends] = CUT_COSTS[0]
    cost[[0, size]] = 0
    places = np.flatnonzero(cost < 255)
    gaps = np.diff(places)
    wide = np.flatnonzero(gaps > width)
    if len(wide):
        places = np.sort(np.concatenate([places, *(np.arange(places[k] + width, places[k + 1], width) for k in wide)]))
        cost[places] = np.minimum(cost[places], CUT_COSTS[2])
    return places, cost[places]


def power_parts(length: int, width: int, waste: int) -> list[int]:
    """Lengths into which a last window is divided: powers of two until less than ``waste`` would be padding."""
    parts = []
    while length and width - length > waste and length & (length - 1):
        parts.append(1 << (length.bit_length() - 1))
        length -= parts[-1]
    return [*parts, length] if length else parts


class _Packer:
    """Documents of one partition in their order; gives the pieces of finished sequences."""

    def __init__(self, sentence_end: np.ndarray, width: int, first: int):
        self.sentence_end, self.width, self.sequence = sentence_end, width, first
        self.ids, self.docs = [], []  # token arrays, and (doc_id, tokens, tokens already packed)

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids), 0))

    def packed(self, finish: bool) -> pa.RecordBatch | None:
        """Pieces of all sequences but the last one, which waits for more documents unless this is the end."""
        if not self.docs:
            return None
        ids = np.concatenate(self.ids)
        ends = np.cumsum([len(own) for own in self.ids])
        places, costs = cut_places(ids, ends, self.sentence_end, self.width)
        cuts = [int(places[k]) for k in best_cuts(places, costs, self.width)]
        if finish:
            at = cuts.pop(-2)
            for part in power_parts(cuts.pop() - at, self.width, CUT_COSTS[2]):
                cuts.append(cuts[-1] + part if cuts and cuts[-1] >= at else at)
                if cuts[-1] == at:
                    cuts.append(at + part)
        else:
            cuts.pop()
        return self._pieces(ids, ends, cuts)

    def _pieces(self, ids: np.ndarray, ends: np.ndarray, cuts: list[int]) -> pa.RecordBatch | None:
        stop = cuts[-1]
        begins = ends - [len(own) for own in self.ids]
        edges = np.unique(np.concatenate([cuts, begins[begins < stop]]))
        left, right = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, left, "right")
        window = np.searchsorted(cuts, left, "right") - 1
        raw = memoryview(ids.astype("<u4")).cast("B")
        batch = None
        if len(left):
            done = np.array([d[2] for d in self.docs])[doc]
            batch = pa.RecordBatch.from_arrays([
                pa.array([self.docs[d][0] for d in doc], pa.int64()), pa.array(left - begins[doc] + done, pa.int64()),
                pa.array(right - left, pa.int64()), pa.array([raw[4 * a:4 * b] for a, b in zip(left.tolist(), right.tolist())], pa.binary()),
                pa.array([self.docs[d][1] for d in doc], pa.int64()), pa.array(self.sequence + window, pa.int64()),
                pa.array(left - np.asarray(cuts)[window], pa.int64())], names=list(PIECES))
        self.sequence += len(cuts) - 1
        rest = int(np.searchsorted(ends, stop, "right"))
        if rest < len(ends) and begins[rest] < stop:
            name, tokens, packed = self.docs[rest]
            self.docs[rest] = (name, tokens, packed + stop - int(begins[rest]))
            self.ids[rest] = self.ids[rest][stop - int(begins[rest]):]
        self.ids, self.docs = self.ids[rest:], self.docs[rest:]
        return batch


PIECES = {"doc_id": "long", "start": "long", "length": "long", "ids": "binary", "doc_tokens": "long", "sequence_id": "long", "offset": "long"}


def _packing(ranks_path: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path)
        sentence_end = np.zeros(max(encode.tokens.values()) + 1, bool)
        for token, rank in encode.tokens.items():
            sentence_end[rank] = b"\n" in token or token.rstrip(b"\"')")[-1:] in (b".", b"!", b"?")
        packer, held = _Packer(sentence_end, width, TaskContext.get().partitionId() * SEQUENCES), 0
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, ids, counts in encode.encode(batch.column("text")):
                ends = np.cumsum(counts)
                for k, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
                    packer.add(names[first + k], np.append(ids[a:b], np.int32(END)))
                held += len(ids)
                if held >= HELD:
                    out, held = packer.packed(False), 0
                    if out:
                        yield out
        out = packer.packed(True)
        if out:
            yield out

    return run


def pack(docs: DataFrame, ranks_path: str, width: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most ``width`` tokens: the id, ``start`` (tokens of the document before it),
    ``length``, ``ids`` (unsigned 32-bit little-endian), ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence.

    A document is its ids in the vocabulary of ``ranks_path`` and the id 0. Each input partition is packed in
    its own order, so nothing moves between tasks; windows end where padding plus cut costs are least. The last,
    shorter sequence of a partition is divided into powers of two, which need no padding.

    A null or empty text is the id 0 alone. A null id stays null; repeated rows are packed each. A text longer than
    ``width`` takes several sequences. Other columns are not read; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return texts.mapInArrow(lean(_packing(ranks_path, width)), ", ".join(f"{c} {kind}" for c, kind in PIECES.items())).withColumnRenamed("doc_id", id_column)
