"""Exact and near duplicates against plain Python."""

import hashlib
import random
import string
from collections import defaultdict

from minewright.llm import exact_dedup, jaccard
from minewright.llm.components import components
from minewright.llm.exact_dedup import PatriciaTrie

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_exact(rows, largest=True):
    groups = defaultdict(list)
    for id_, text in rows:
        groups[(text or "").translate(LOWER)].append(id_)
    out = []
    for key, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        for k, id_ in enumerate(ids):
            out.append((id_, keep, len(ids), id_ == keep and ids.index(keep) == k, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def words_of(text):
    return [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ") if w]


def brute_components(rows, n, percent):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for k, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[root(k)] = min(id_, least.get(root(k), id_))
    return sorted(((id_, len(s), least.get(root(k)) if s else id_) for k, ((id_, _), s) in enumerate(zip(rows, sets))), key=str)


def test_exact_duplicates_odd_rows(docs_of, odd_rows):
    for keep in ("largest", "smallest"):
        for trie_bytes in (1, exact_dedup.TRIE_BYTES):
            found = exact_dedup.exact_duplicates(docs_of(odd_rows), keep=keep, trie_bytes=trie_bytes).collect()
            assert sorted(map(tuple, found), key=str) == brute_exact(odd_rows, keep == "largest")
    assert exact_dedup.exact_duplicates(docs_of([])).count() == 0


def test_kept_rows_have_all_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = exact_dedup.without_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(t or "").translate(LOWER) for _, t in odd_rows})


def test_trie_holds_prefixes_and_spills_finished_subtrees():
    draw = random.Random(3)
    keys = sorted({bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 12))) for _ in range(500)})
    trie, out = PatriciaTrie(), []
    for k, key in enumerate(keys):
        node = trie.terminal(key)
        assert node.owner is None and trie.terminal(key) is node
        node.owner = key
        if k % 37 == 0:
            out += trie.spill(key)
    assert sorted([*out, *trie.owners()]) == keys


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(250)] + [(1000 + k, 1001 + k) for k in range(60)] + [(7, 7), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()))
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    assert found == {x: root(x) for x in parent}


def test_jaccard_odd_rows(docs_of, odd_rows):
    for n, percent in ((3, 90), (5, 80), (1, 50)):
        found = jaccard.jaccard_components(docs_of(odd_rows), n, percent).collect()
        assert sorted(map(tuple, found), key=str) == brute_components(odd_rows, n, percent)
    assert jaccard.jaccard_components(docs_of([])).count() == 0


def near_copies(seed=1):
    """Chains and crowds of edited texts, some just below the threshold, beside texts that share a long passage."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(12):
        text = [word() for _ in range(draw.randint(5, 120))]
        for _ in range(draw.randint(1, 12)):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(draw.randint(0, 1 + len(text) // 25)):
                text[draw.randrange(len(text))] = word()
    rows += [(len(rows) + k, " ".join(passage + [word() for _ in range(draw.randint(0, 30))])) for k in range(30)]
    return rows


def test_jaccard_near_copies_in_blocks(docs_of):
    """Tiny blocks and orders give the same components as one block."""
    rows = near_copies()
    wanted = brute_components(rows, 3, 90)
    for options in ({}, {"block_docs": 3, "block_shingles": 200, "ordered": 2}):
        assert sorted(map(tuple, jaccard.jaccard_components(docs_of(rows), 3, 90, **options).collect()), key=str) == wanted


def test_trie_join_finds_all_components():
    import numpy as np

    for seed in range(4):
        rows = near_copies(seed)
        sets = [np.unique(np.array([hash(tuple(w[i:i + 3])) & 0xFFFFFFFF for i in range(max(1, len(w) - 2))], np.uint64)) for w in (words_of(t) for _, t in rows)]
        for percent in (60, 80, 90, 100):
            parent = list(range(len(sets)))

            def root(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for i in range(len(sets)):
                for j in range(i):
                    o = len(np.intersect1d(sets[i], sets[j]))
                    if 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                        parent[root(i)] = root(j)
            links = jaccard.linked(sets, percent)
            spanned = len(sets) - len({root(i) for i in range(len(sets))})
            assert len(links) == spanned and all(root(i) == root(j) for i, j in links)


def test_one_of_each(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    stays = jaccard.one_of_each(docs, 3, 90)
    assert stays.columns == docs.columns
    assert sorted((r.doc_id for r in stays.collect()), key=str) == [1, 10, 11, 2, 3, 4, 6, 8, None]


def test_shared_tokens_across_batches():
    import pyarrow as pa

    draw = random.Random(11)
    rows = sorted((draw.randint(0, 30), draw.randint(0, 5)) for _ in range(80))
    wanted = sorted({(t, h) for t, h in rows if len({x for u, x in rows if u == t}) > 1})
    for size in (1, 2, 3, 7, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows[k:k + size]], pa.int64()), pa.array([h for _, h in rows[k:k + size]], pa.int64())],
                                              names=["token", "high"]) for k in range(0, len(rows), size)]
        out = [pair for b in jaccard._shared(iter(batches)) for pair in zip(b.column("token").to_pylist(), b.column("high").to_pylist())]
        assert out == wanted


def test_profiles_bound_the_difference():
    import numpy as np

    draw = np.random.default_rng(4)
    for size in (10, 700, 3000, 9000):
        a = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[size // 3:], draw.integers(0, 1 << 63, size, dtype=np.uint64)]))
        one, two = jaccard.profile_of(a), jaccard.profile_of(b)
        counters = min(len(one), len(two)) // 2
        apart = len(np.setxor1d(a, b))
        assert np.abs(jaccard.folded(one, counters) - jaccard.folded(two, counters)).sum() <= apart
        assert np.abs(jaccard.folded(one, 64) - jaccard.folded(two, 64)).sum() <= apart
