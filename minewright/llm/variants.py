"""Spelling variants: the vocabulary's minimal acceptor, composed with a one-edit transducer and itself."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.llm.batches import lean
from minewright.llm.words import LOWER, chunks
from minewright.session import cut

#: A run loses a letter when this divides its checksum.
MISPRINT = 31
#: Words that meet in one initial state; more of them are told apart by further letters.
BLOCK = 50_000
#: Distinct words a task counts, and states of its acceptor, before it hands them on.
HELD_WORDS, HELD_STATES = 200_000, 500_000

_ASCII = np.zeros(256, bool)
_ASCII[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_LATIN = 0xC3  # first byte of U+00C0 to U+00FF, and of nothing else


def _checksum_table(polynomial: int = 0xEDB88320) -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(polynomial), table >> 1).astype(np.uint32)
    return table


_TABLE = _checksum_table()


def letter_runs(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, end byte and code points of every maximal run of letters; a row's edge ends a run."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    lead = data == _LATIN
    inside = _ASCII[data] | lead
    inside[1:] |= lead[:-1]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    first[edges] |= inside[edges]
    last = np.append(~inside[1:], True)
    last[:-1] |= first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(inside & last) + 1
    leads = np.concatenate([[0], np.cumsum(lead)])
    return starts, ends, ends - starts - (leads[ends] - leads[starts])


def checksums(seeds: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, slow: int = 64) -> np.ndarray:
    """CRC-32 of every span of ``data``, continued from ``seeds``: one table step for all spans at a time."""
    out = seeds.copy()
    lengths = ends - starts
    for k in np.flatnonzero(lengths > slow):
        out[k] = zlib.crc32(data[starts[k]:ends[k]].tobytes(), int(seeds[k]))
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] <= slow]
    state, at, lengths = seeds[order] ^ np.uint32(0xFFFFFFFF), starts[order], lengths[order]
    for k in range(int(lengths[0]) if len(lengths) else 0):
        active = int(np.searchsorted(-lengths, -k, "left"))
        now = state[:active]
        state[:active] = _TABLE[(now ^ data[at[:active] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _counted(least: int):
    """Words of the texts, misprints applied, with their occurrences in this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for row, offsets, raw in chunks(batch.column("text"), 1 << 20):
                data = LOWER[raw]
                starts, ends, length = letter_runs(offsets, data)
                long = length >= least
                starts, ends, length = starts[long], ends[long], length[long]
                rows = np.searchsorted(offsets, starts, "right") - 1
                seeds = np.array([zlib.crc32(f"{id_ or ''}:".encode()) for id_ in ids[row:row + len(offsets) - 1]], np.uint32)
                sums = checksums(seeds[rows], data, starts, ends)
                marks = np.zeros(len(data) + 1, np.int32)
                np.add.at(marks, starts, 1)
                np.add.at(marks, ends, -1)
                kept = data[np.cumsum(marks[:-1]) > 0]
                places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
                words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(kept.tobytes()))
                misprint = sums % MISPRINT == 0
                tally = pc.value_counts(words.filter(pa.array(~misprint)))
                found.update(dict(zip(tally.field("values").to_pylist(), tally.field("counts").to_pylist())))
                for k in np.flatnonzero(misprint & (length > least)):
                    word, at = words[k].as_py(), int(sums[k] % length[k])
                    found[word[:at] + word[at + 1:]] += 1
                if len(found) >= HELD_WORDS:
                    yield _tally(found)
                    found = Counter()
        yield _tally(found)

    return run


def _tally(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n`` of the letter runs of all texts, A-Z lower-cased.

    A run whose checksum with its document's id is a multiple of 31 loses one letter. Words of fewer than
    ``least_length`` code points or ``least_count`` occurrences go. A null text has no words, a null id counts as
    the empty string; repeated rows count each.
    """
    texts = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    return (texts.mapInArrow(lean(_counted(least_length)), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


class Acceptors:
    """Minimal acyclic acceptors of sets of equally long words, with one register of states.

    State 0 accepts the empty word. Every state knows how many words it accepts and every arc how many come
    before its own, so that a path adds up to the word's place in its sorted set.
    """

    def __init__(self):
        self.arcs: list[dict] = [{}]
        self.count = [1]
        self.register: dict = {(): 0}
        self.apart: set = set()

    def _state(self, arcs: list) -> int:
        key = tuple(arcs)
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.arcs)
            before, out = 0, {}
            for letter, target in arcs:
                out[letter] = (target, before)
                before += self.count[target]
            self.arcs.append(out)
            self.count.append(before)
        return state

    def initial(self, words: list[str]) -> int:
        """The initial state of the acceptor of ``words`` (sorted, distinct, equally long)."""
        open_states: list[list] = [[]]
        letters: list[str] = []
        for word in words:
            same = 0
            while same < len(letters) and word[same] == letters[same]:
                same += 1
            self._close(open_states, letters, same)
            for letter in word[same:]:
                letters.append(letter)
                open_states.append([])
        self._close(open_states, letters, 0)
        return self._state(open_states[0])

    def _close(self, open_states: list[list], letters: list[str], depth: int) -> None:
        while len(letters) > depth:
            state = self._state(open_states.pop())
            open_states[-1].append((letters.pop(), state))

    def common(self, p: int, q: int, but: str | None = None) -> list[tuple[int, int]]:
        """Places of the words that both states accept; none begins with ``but``."""
        if p == q and but is None:
            return [(k, k) for k in range(self.count[p])]
        if (p, q, but) in self.apart:
            return []
        found, seen, stack = [], [(p, q, but)], [(p, q, 0, 0, but)]
        while stack:
            p, q, i, j, but = stack.pop()
            there = self.arcs[q]
            for letter, (t, before) in self.arcs[p].items():
                other = there.get(letter)
                if other is None or letter == but:
                    continue
                u, ahead = other
                if t == u:
                    found.extend((i + before + k, j + ahead + k) for k in range(self.count[t]))
                elif (t, u, None) not in self.apart:
                    seen.append((t, u, None))
                    stack.append((t, u, i + before, j + ahead, None))
        if not found:  # then every pair on the way leads nowhere
            self.apart.update(seen)
        return found

    def replaced(self, initial: int) -> Iterator[tuple[int, int]]:
        """Places of the pairs of words that differ in one letter, each pair once."""
        stack = [(initial, 0)]
        while stack:
            state, at = stack.pop()
            arcs = list(self.arcs[state].values())
            for k, (t, before) in enumerate(arcs):
                if self.count[t] > 1:
                    stack.append((t, at + before))
                for u, ahead in arcs[k + 1:]:
                    for x, y in self.common(t, u):
                        yield at + before + x, at + ahead + y

    def deleted(self, longer: int, shorter: int, closed: bool) -> Iterator[tuple[int, int]]:
        """Places of a longer and a shorter word where one letter less makes the one the other, each pair once.

        Of equal neighbouring letters the last one goes. ``closed``: not the last letter of the word.
        """
        stack = [(longer, shorter, 0, 0)]
        while stack:
            p, q, i, j = stack.pop()
            there = self.arcs[q]
            for letter, (t, before) in self.arcs[p].items():
                if q == 0:
                    if not closed:
                        yield i + before, j
                    continue
                for x, y in self.common(t, q, letter):
                    yield i + before + x, j + y
                if letter in there:
                    u, ahead = there[letter]
                    stack.append((t, u, i + before, j + ahead))


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by initial state, length and rest: the number and the best of a word's near words there."""
    machine, group, key = Acceptors(), [], None
    out: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "long", "rest", "closed", "word", "n"))):
            if row[0] != key:
                out += _near(machine, group)
                key, group = row[0], []
                if len(machine.arcs) > HELD_STATES or len(machine.apart) > HELD_STATES:
                    machine = Acceptors()
                if len(out) > 10_000:
                    yield _best(out)
                    out = []
            group.append(row[1:])
    out += _near(machine, group)
    yield _best(out)


def _near(machine: Acceptors, group: list[tuple]) -> list[tuple]:
    short = [row for row in group if not row[0]]
    if len(group) < 2 or not short:
        return []
    long = group[len(short):]
    near: dict[int, list] = {}

    def met(x: int, y: int) -> None:
        for own, other in ((x, y), (y, x)):
            rank = (-group[other][4], group[other][3])
            known = near.get(own)
            if known is None:
                near[own] = [1, rank]
            else:
                known[0] += 1
                known[1] = min(known[1], rank)

    initial = machine.initial([row[1] for row in short])
    for x, y in machine.replaced(initial):
        met(x, y)
    if long:
        for x, y in machine.deleted(machine.initial([row[1] for row in long]), initial, group[0][2]):
            met(len(short) + x, y)
    return [(group[k][3], n, -rank[0], rank[1]) for k, (n, rank) in near.items()]


def _best(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "near", "best_n", "best"])


def _told_apart(rows: DataFrame) -> DataFrame:
    """Every row under the first and under the last half of its rest: one edit leaves one of them whole.

    ``long`` rests have a letter more than the others of their key. An edit at the border of the halves
    belongs to the first half's states, so the last half's are ``closed`` at their end.
    """
    size = F.char_length("rest")
    short = size - F.col("long").cast("int")
    half = F.floor(short / 2).cast("int")

    def entry(mark: str, shared: Column, rest: Column, closed: Column) -> Column:
        return F.struct(F.concat("key", F.lit(mark), shared).alias("key"), rest.alias("rest"), closed.alias("closed"))

    first = entry(">", F.col("rest").substr(F.lit(1), half), F.col("rest").substr(half + 1, size), F.col("closed"))
    last = entry("<", F.col("rest").substr(size - short + half + 1, size), F.col("rest").substr(F.lit(1), size - short + half), F.lit(True))
    return (rows.withColumn("_entry", F.explode(F.array(first, last)))
            .select("_entry.key", "long", "_entry.rest", "_entry.closed", "word", "n"))


def near_words(words: DataFrame, least_length: int = 7, block: int = BLOCK) -> DataFrame:
    """``word, n_near, form_n, form``: how many words are one edit away, and the most frequent of these.

    1. Two words one edit apart share their first or their last half (halves of the shorter one). What
       is shared names an initial state of the vocabulary's acceptor; a word enters it with the rest of its letters. A state
       with more than ``block`` words is divided by half of the rest, again and again, so that no task holds a hot one.
    2. In every initial state the rests are compiled to minimal acceptors, which are composed with the
       one-edit transducer and with themselves. Equal states accept the same words, so shared endings are
       walked once; pairs of states without a common word are remembered.
    3. Pairs are only counted in the task; a row per word and state leaves it.

    Ties of the form: the smallest word in code-point order. Words must be distinct and have ``least_length`` (2 at
    least) code points or more. An empty table gives an empty result; words without near ones are not in it.
    """
    if least_length < 2:
        raise ValueError("words of one letter have no half to share")
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("long")).select(
        F.concat(size - F.col("long").cast("int"), F.lit("")).alias("key"), "long", F.col("word").alias("rest"), F.lit(False).alias("closed"), "word", "n")
    rows = _told_apart(rows.where(size - F.col("long").cast("int") >= least_length))
    ready = []
    while True:
        divisible = (F.char_length("rest") - F.col("long").cast("int")) > 1
        crowded = cut(rows.where(divisible).groupBy("key").agg(F.count("*").alias("words")).where(F.col("words") > block).select("key"), "crowded")
        if crowded.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(crowded, "key", "left_anti"))
        rows = cut(_told_apart(rows.join(crowded, "key", "left_semi")), "divided")
    met = None
    for part in ready:
        met = part if met is None else met.unionByName(part)
    found = met.repartition(parts, "key").sortWithinPartitions("key", "long", "rest").mapInArrow(
        lean(_composed), "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("form")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("form_n"), F.col("b.form").alias("form"))


def spelling_variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, times: int = 10, id_column: str = "doc_id",
                      text_column: str = "text", block: int = BLOCK) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``vocabulary``.

    ``form`` is the most frequent near word, if it occurs ``times`` as often as the word or more; ``root`` is
    where the forms lead to. Since every form is ``times`` as frequent, roots are found by a few rounds of doubling.
    Nulls, ties and repeated rows: as ``vocabulary`` and ``near_words`` say. Very long runs are words like others.
    Other columns are not read; an empty table gives an empty result.
    """
    words = cut(vocabulary(docs, least_length, least_count, id_column, text_column), "words")
    enough = F.col("form_n") >= times * F.col("n")
    forms = cut(words.join(near_words(words, least_length, block), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")), "forms")
    roots = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = cut(roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if roots.where("further is not null").isEmpty():
            break
        roots = roots.drop("further")
    return forms.join(roots.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
