"""N-gram Jaccard self-join: candidates by rare n-grams, links by a prefix-tree join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.llm.batches import lean, rereadable, unused
from minewright.llm.components import Forest, components
from minewright.llm.words import mixed, shingle_sets
from minewright.session import cut

#: Frequent n-grams that the order knows; it only decides which n-grams are looked at first.
ORDERED = 1 << 18
#: Documents of a candidate n-gram, and n-grams of a candidate group, that meet in one task at once.
BLOCK_DOCS, BLOCK_SHINGLES = 4096, 1_000_000
#: Counters of the profile that bounds two sets' difference from below: one for 8 n-grams, rounded up to a power of two in this range.
PROFILE, FINEST = 64, 4096
#: N-grams that a task holds at once.
HELD = 300_000


def _flushed(batches: Iterator[pa.RecordBatch], n: int, flush) -> Iterator[pa.RecordBatch]:
    """Hand ``flush`` the (batch, row, hashes, lengths) of many documents at a time."""
    held, size = [], 0
    for batch in batches:
        for row, hashes, lengths in shingle_sets(batch.column("text"), n):
            held.append((batch, row, hashes, lengths))
            size += len(hashes)
            if size >= HELD:
                yield from flush(held)
                held, size = [], 0
    yield from flush(held)


def _repeats(n: int):
    """N-grams that several documents of one task share, with their number."""
    def flush(held):
        if held:
            found = np.sort(np.concatenate([h for _, _, h, _ in held]))
            starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            counts = np.diff(np.append(starts, len(found)))
            often = counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(found[starts[often]].view(np.int64)), pa.array(counts[often].astype(np.int64))],
                                             names=["token", "n"])

    return lambda batches: _flushed(batches, n, flush)


def frequent_ngrams(texts: DataFrame, n: int, most: int = ORDERED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of the n-grams that most documents share, at most ``most``.

    Counted over all documents, but only where two documents of one task share them. The table serves as an
    order, nothing depends on its counts being exact.
    """
    counts = cut(texts.select("text").mapInArrow(lean(_repeats(n)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
                 .where("n >= 4"), "ngrams")
    level = F.floor(F.log2("n") * 4).cast("int")
    floor, room = None, most
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        room -= row["count"]
        if room < 0:
            break
        floor = row["level"]
    if floor is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = counts.where(level >= floor).toPandas()
    tokens, n_docs = found["token"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(tokens)
    return tokens[order], n_docs[order]


def profile_of(hashes: np.ndarray) -> bytes:
    """How many n-grams fall to each counter, 16 bits each. Half the counters: fold the upper half onto the lower."""
    counters = min(FINEST, max(PROFILE, 1 << (max(1, len(hashes) // 8) - 1).bit_length()))
    return np.minimum(np.bincount((hashes & np.uint64(counters - 1)).astype(np.int64), minlength=counters), 65535).astype("<u2").tobytes()


def folded(profile: bytes, counters: int) -> np.ndarray:
    fine = np.frombuffer(profile, "<u2").astype(np.int32)
    return fine.reshape(-1, counters).sum(0) if len(fine) > counters else fine


def _prefix(size: int, percent: int) -> int:
    """So many n-grams, first in the order, of which two linked sets must share one."""
    return size - (percent * size + 99) // 100 + 1


def _sketched(n: int, percent: int, frequent):
    """Kind 0: a row per document with the 128-bit name, size and profile of its set. Kind 1: a row per candidate n-gram."""
    def flush(held):
        tokens, counts = frequent.value
        batches = {id(b): b for b, _, _, _ in held}
        seen, first, sets = set(), [], []
        for batch, row, hashes, lengths in held:
            rehashed = mixed(hashes)
            name = (int(np.bitwise_xor.reduce(rehashed)), int(rehashed.sum(dtype=np.uint64)))
            sets.append((id(batch), row, name, len(hashes), profile_of(hashes)))
            if name in seen:
                continue
            seen.add(name)
            weight = -lengths
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
                weight = np.where(tokens[at] == hashes, counts[at] << 32, weight)
            first.append((hashes[np.lexsort((hashes, weight))[:_prefix(len(hashes), percent)]], name[0]))
        columns = {c: [] for c in ("row", "doc_id")}
        for key, batch in batches.items():
            rows = pa.array([s[1] for s in sets if s[0] == key], pa.int64())
            for c in columns:
                columns[c].append(batch.column(c).take(rows))
        names = np.array([s[2] for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
        count = len(sets)
        yield _rows(count, kind=pa.array(np.zeros(count, np.int8)), high=pa.array(names[:, 0].copy()), low=pa.array(names[:, 1].copy()),
                    n=pa.array([s[3] for s in sets], pa.int64()), profile=pa.array([s[4] for s in sets], pa.binary()),
                    **{c: pa.concat_arrays(v) for c, v in columns.items()})
        token = np.concatenate([t for t, _ in first]).view(np.int64)
        high = np.repeat(np.array([h for _, h in first], np.uint64), [len(t) for t, _ in first]).view(np.int64)
        for at in range(0, len(token), 200_000):
            part = slice(at, at + 200_000)
            yield _rows(len(token[part]), kind=pa.array(np.ones(len(token[part]), np.int8)), token=pa.array(token[part]), high=pa.array(high[part]))

    def run(batches):
        def all_documents(held_batches):
            for batch in held_batches:
                empty = batch.filter(_wordless(batch.column("text")))
                if empty.num_rows:
                    waiting.append(_rows(empty.num_rows, kind=pa.array(np.zeros(empty.num_rows, np.int8)), n=pa.array(np.zeros(empty.num_rows, np.int64)),
                                         **{c: empty.column(c) for c in ("row", "doc_id")}))
                yield batch
        waiting: list = []
        for out in _flushed(all_documents(batches), n, lambda held: flush(held) if held else ()):
            yield out
            while waiting:
                yield waiting.pop()
        yield from waiting

    return run


SKETCH = {"kind": ("byte", pa.int8()), "row": ("long", pa.int64()), "doc_id": ("long", pa.int64()),
          "high": ("long", pa.int64()), "low": ("long", pa.int64()), "n": ("long", pa.int64()), "profile": ("binary", pa.binary()),
          "token": ("long", pa.int64())}


def _rows(count: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(count, kind)) for c, (_, kind) in SKETCH.items()], names=list(SKETCH))


def _wordless(texts: pa.Array) -> pa.Array:
    return pc.invert(pc.match_substring_regex(texts.fill_null(""), "[^\\x20\\x09-\\x0D]"))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Whole groups of equal ``keys`` from rows sorted by them, many groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        changes = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
        if held and (marks[:, 0] != [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in keys]).any():
            yield _together(held)
            held = []
        if len(changes):
            held.append(batch.slice(0, changes[-1]))
            yield _together(held)
            held = [batch.slice(changes[-1])]
        else:
            held.append(batch)
    if held:
        yield _together(held)


def _together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    marks = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
    return np.concatenate([[0], np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1, [batch.num_rows]])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and set, those whose token several sets have; repeats of a row go."""
    waiting = None  # the last row, if it is not known yet whether its token is shared
    token, high, shared = 0, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens, highs = batch.column("token").to_numpy(), batch.column("high").to_numpy()
        if waiting is not None:
            tokens, highs = np.append([token], tokens), np.append([high], highs)
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (highs[1:] != highs[:-1])
        tokens, highs = tokens[new], highs[new]
        same = tokens[1:] == tokens[:-1]
        kept = np.append(same, False) | np.append(False, same)
        kept[0] |= waiting is not None and shared and len(kept) > 0
        done = kept.copy()
        if waiting is not None and shared:
            done[0] = False  # it has been given already
        last = len(tokens) - 1
        shared = bool(kept[last]) and (last > 0 and bool(same[last - 1]) or (last == 0 and shared))
        waiting, token, high = True, tokens[last], highs[last]
        if done.any():
            yield pa.RecordBatch.from_arrays([pa.array(tokens[done]), pa.array(highs[done])], names=["token", "high"])


def _profiled(percent: int):
    """Spanning edges of the pairs that share a candidate n-gram and whose profiles leave a link possible."""
    def possible(p, fine, n, a, b):
        ok = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        a, b = a[ok], b[ok]
        far = np.abs(p[a] - p[b]).sum(1)
        ok = (100 + percent) * far <= (100 - percent) * (n[a] + n[b])
        a, b = a[ok], b[ok]
        large = np.flatnonzero(np.minimum(n[a], n[b]) > 8 * PROFILE)  # these have finer counters to tell them apart
        if len(large):
            ok = np.ones(len(a), bool)
            for k in large:
                one, two = fine[a[k]].as_py(), fine[b[k]].as_py()
                counters = min(len(one), len(two)) // 2
                far = np.abs(folded(one, counters) - folded(two, counters)).sum()
                ok[k] = (100 + percent) * far <= (100 - percent) * (n[a[k]] + n[b[k]])
            a, b = a[ok], b[ok]
        return a, b

    def crowd(p, fine, n, at, end):
        """Pairs of one crowded n-gram: a row that has met a set is not held against others of that set."""
        order = at + np.argsort(n[at:end], kind="stable")
        label = np.arange(len(order))
        for x in range(1, len(order)):
            low = np.searchsorted(n[order[:x]] * 100, percent * n[order[x]])
            others = order[low:x]
            a, _ = possible(p, fine, n, others, np.full(len(others), order[x]))
            if len(a):
                met = np.zeros(end - at, bool)
                met[a - at] = True
                labels, where = np.unique(label[low:x][met[others - at]], return_index=True)
                partners = others[met[others - at]][where]
                for y in partners:
                    yield y, order[x]
                label[np.isin(label, labels)] = x
                label[x] = x

    def run(batches):
        for batch in _groups(batches, ["token", "left", "right"]):
            forest = Forest()
            high, n = batch.column("high").to_numpy(), batch.column("n").to_numpy()
            profile = batch.column("profile")
            p = np.array([folded(own, PROFILE) for own in profile.to_pylist()])
            starts = _starts(batch, ["token", "left", "right"])
            sizes = np.diff(starts)
            for size in np.unique(sizes[(sizes > 1) & (sizes <= 64)]):
                i, j = np.triu_indices(size, 1)
                of = starts[:-1][sizes == size]
                step = max(1, 20_000 // len(i))
                for at in range(0, len(of), step):
                    base = of[at:at + step, None]
                    for a, b in zip(*possible(p, profile, n, (base + i).ravel(), (base + j).ravel())):
                        forest.join(int(high[a]), int(high[b]))
            for k in np.flatnonzero(sizes > 64):
                for a, b in crowd(p, profile, n, starts[k], starts[k + 1]):
                    forest.join(int(high[a]), int(high[b]))
            pairs = [(x, forest.root(x)) for x in list(forest.parent)]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())], names=["a", "b"])

    return run


class Branch:
    """A node of the set trie: a run of n-gram ranks, the sets that end here, and the sizes below."""

    __slots__ = ("run", "children", "ends", "least", "most", "one", "same")

    def __init__(self, run, size, item):
        self.run, self.children, self.ends = run, {}, []
        self.least = self.most = size
        self.one, self.same = item, True


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that span every component of the sets: ``percent`` of the union or more is shared.

    The sets are written in one order (frequent n-grams first) and kept in a trie, so that equal beginnings
    are compared once. A branch is left when the n-grams already missed on either side rule out a link for all
    sizes below it, or when all its sets are known to belong with the probe.
    """
    if len(sets) < 2:
        return []
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(tokens))
    cuts = np.cumsum([0, *map(len, sets)])
    ranked = [np.sort(rank[inverse[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    present = np.zeros(len(tokens), bool)
    forest, links, root = Forest(), [], Branch(ranked[0][:0], 0, -1)
    root.same = False
    for x in sorted(range(len(sets)), key=lambda i: len(ranked[i])):
        own, size = ranked[x], len(ranked[x])
        if root.children:
            present[own] = True
            _probe(root, x, own, size, present, percent, forest, links)
            present[own] = False
        _insert(root, x, own, size, forest)
    return links


def _probe(root, x, own, size, present, percent, forest, links) -> None:
    base = 100 + percent
    stack = [(child, 0, 0, False) for child in root.children.values()]
    while stack:
        node, depth, hits, left = stack.pop()
        if left:  # all below has been seen: note whether it is one component by now
            top = forest.root(node.one)
            node.same = all(c.same and forest.root(c.one) == top for c in node.children.values()) and all(forest.root(e) == top for e in node.ends)
            continue
        if node.same and forest.root(node.one) == forest.root(x):
            continue
        hits += int(np.count_nonzero(present[node.run]))
        depth += len(node.run)
        passed = int(np.searchsorted(own, node.run[-1], "right"))
        most, least = node.most, max(node.least, -(-percent * size // 100))
        if base * (depth - hits) > 100 * most - percent * size or base * (passed - hits) > 100 * size - percent * least:
            continue
        for end in node.ends:
            if 100 * hits >= percent * (size + depth - hits):
                if forest.join(x, end):
                    links.append((x, end))
        if node.children:
            stack.append((node, 0, 0, True))
            stack.extend((child, depth, hits, False) for child in node.children.values())


def _insert(root, x, own, size, forest) -> None:
    node, at = root, 0
    while at < size:
        child = node.children.get(own[at])
        if child is None:
            child = node.children[own[at]] = Branch(own[at:], size, x)
            child.ends.append(x)
            return
        part = own[at:at + len(child.run)]
        same = len(part)
        if same < len(child.run) or not np.array_equal(part, child.run):
            differ = np.flatnonzero(part != child.run[:same])
            same = int(differ[0]) if len(differ) else same
            upper = Branch(child.run[:same], child.least, child.one)
            upper.most, upper.same = child.most, child.same
            child.run = child.run[same:]
            upper.children[child.run[0]] = child
            node.children[own[at]] = child = upper
        child.least, child.most = min(child.least, size), max(child.most, size)
        child.same = child.same and forest.root(child.one) == forest.root(x)
        node, at = child, at + same
    node.ends.append(x)


def _joined(n: int, percent: int):
    def run(batches):
        for batch in _groups(batches, ["component", "left", "right"]):
            starts = _starts(batch, ["component", "left", "right"])
            vertex, texts = batch.column("vertex").to_pylist(), batch.column("text")
            out = []
            for a, b in zip(starts[:-1], starts[1:]):
                sets = {}
                for row, hashes, _ in shingle_sets(texts.slice(a, b - a), n):
                    sets.setdefault(vertex[a + row], hashes)
                names = list(sets)
                out += [(names[i], names[j]) for i, j in linked(list(sets.values()), percent)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([j for _, j in out], pa.int64())], names=["a", "b"])

    return run


def _blocked(df: DataFrame, key: str, blocks: str, item: str) -> DataFrame:
    """Each row once per pair of blocks that its block is part of: ``left <= right``. One block: once."""
    own = F.pmod(F.xxhash64(F.lit(7), item), F.col(blocks))
    return (df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
            .withColumn("left", F.least("_own", "_other")).withColumn("right", F.greatest("_own", "_other")).drop("_own", "_other", blocks))


def _decided(docs: DataFrame, n: int, percent: int, id_column: str, text_column: str, ordered: int, block_docs: int,
             block_shingles: int) -> DataFrame:
    """``row, doc_id, n, component (a row number), component_id`` of every row."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"),
                         F.col(text_column).cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_ngrams(source, n, ordered))
    sketch = cut(source.mapInArrow(lean(_sketched(n, percent, frequent)), ", ".join(f"{c} {kind}" for c, (kind, _) in SKETCH.items())), "sketch")
    rows = sketch.where("kind = 0").select("row", "doc_id", "high", "low", "n")
    vertices = cut(sketch.where("kind = 0 and n > 0").groupBy("high", "low")
                   .agg(F.min("doc_id").alias("low_id"), F.min("n").alias("n"), F.min(F.struct("row", "profile")).alias("c"))
                   .select("high", "low", "low_id", "n", F.col("c.row").alias("vertex"), F.col("c.profile").alias("profile")), "vertices")

    entries = sketch.where("kind = 1").select("token", "high")
    shared = cut(entries.repartition(parts, "token").sortWithinPartitions("token", "high").mapInArrow(lean(_shared), "token long, high long"), "shared")
    crowded = (shared.groupBy("token").agg(F.count("*").alias("met")).where(F.col("met") > block_docs)
               .select("token", F.ceil(F.col("met") / block_docs).alias("blocks")))
    met = (shared.join(crowded, "token", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
           .join(vertices.select("high", "n", "profile"), "high"))
    edges = (_blocked(met, "token", "blocks", "high").select("token", "left", "right", "high", "n", "profile")
             .repartition(parts, "token", "left", "right").sortWithinPartitions("token", "left", "right")
             .mapInArrow(lean(_profiled(percent)), "a long, b long"))
    # Written before the next Python step: two in one stage would keep twice as many workers in memory.
    candidates = components(cut(edges, "edges"))

    wanted = cut(vertices.join(candidates, F.col("high") == F.col("id")).select(
        "vertex", "n", F.col("root").alias("component")), "wanted")
    blocks = wanted.groupBy("component").agg(F.ceil(F.sum("n") / block_shingles).alias("blocks"))
    meeting = _blocked(wanted.join(blocks, "component"), "component", "blocks", "vertex")
    # Both sides grow with the corpus, so this is planned as a shuffled join whatever the size.
    links = (source.select("row", "text").join(meeting.hint("merge"), F.col("row") == F.col("vertex"))
             .select("component", "left", "right", "vertex", "text")
             .repartition(parts, "component", "left", "right").sortWithinPartitions("component", "left", "right")
             .mapInArrow(lean(_joined(n, percent)), "a long, b long"))
    found = components(cut(links, "spans"))

    named = cut(vertices.select("high", "low", "low_id", F.col("vertex").alias("id")).join(found, "id", "left"), "named")
    lowest = named.where("root is not null").groupBy("root").agg(F.min("low_id").alias("component_id"))
    names = named.join(lowest, "root", "left").select(
        "high", "low", F.coalesce("root", "id").alias("component"), F.coalesce("component_id", "low_id").alias("component_id"))
    alone = F.col("n") == 0
    return rows.join(names, ["high", "low"], "left").select(
        "row", "doc_id", "n", F.when(alone, F.col("row")).otherwise(F.col("component")).alias("component"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text",
                       ordered: int = ORDERED, block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per input row: the id, ``n_shingles``, ``component_id``.

    Sets of distinct n-word shingles (A-Z lower-cased) link when they share ``percent`` of their union or
    more; ``component_id`` is the smallest id that links lead to.

    1. Frequent shingles are found to write every set in one order, rare shingles first.
    2. Equal sets become one vertex. A vertex is entered under the first shingles of its set, of which
       two linked sets share one. Where several vertices meet, sizes and hashed counters of both sets bound
       their difference; what may still link becomes an edge of the candidate graph.
    3. The texts of a component of that graph come together and a prefix-tree join finds links that span the
       true components. Crowded shingles and large components are cut into blocks, and each pair of blocks
       meets, so no pair is lost; pairs are compared inside tasks and never written out.

    Texts with fewer than n words have their whole sequence as one shingle. Null, empty and blank texts have 0
    shingles, link with nothing and carry their own id. A null id takes part but never names a component that has
    another. Repeated rows are equal sets. Other columns are not read; an empty table gives an empty result.
    """
    return _decided(rereadable(docs), n, percent, id_column, text_column, ordered, block_docs, block_shingles).select(
        F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component, that with the smallest id (a null id last), with all its columns.

    Every text without words stays: it is linked with nothing.
    """
    docs = rereadable(docs)
    found = _decided(docs, n, percent, id_column, text_column, ORDERED, BLOCK_DOCS, BLOCK_SHINGLES)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    row = unused(docs, "row")
    stays = found.groupBy("component").agg(F.min_by("row", order).alias(row)).select(row)
    return docs.withColumn(row, F.monotonically_increasing_id()).join(stays, row, "left_semi").drop(row)
