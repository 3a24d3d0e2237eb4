"""Repeated passages against all strings in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from minewright.llm import suffixes


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (id_, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = True
        edges = np.flatnonzero(np.diff(np.append(False, gone).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((id_, len(t), tuple(spans), bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def found_by(docs, **options):
    rows = suffixes.without_repeats(docs, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept)) for r in rows), key=str)


def test_odd_rows(docs_of, odd_rows):
    rows = [*odd_rows, (30, "a" * 900), (31, "ab" * 500 + "c"), (32, "x" + "ab" * 230), (33, "é" * 300), (34, "z" * 400), (35, "y" * 399), (36, "y" * 399)]
    for piece in (suffixes.PIECE, 20_000):
        assert found_by(docs_of(rows), piece=piece) == brute(rows, 400)
    assert found_by(docs_of([])) == []
    assert found_by(docs_of([(1, None), (None, "short")])) == [(1, 0, (), b""), (None, 5, (), b"short")]


@pytest.mark.parametrize("length,block", [(2, 20_000), (3, 1), (9, 2), (40, 1), (41, 3), (40, 20_000)])
def test_shared_passages(docs_of, length, block):
    draw = random.Random(length + block)
    stock = ["".join(draw.choice("abc é") for _ in range(draw.randint(1, 3 * length))) for _ in range(12)]
    rows = [(k, "".join(draw.choice([*stock, "".join(draw.choice("abcdefgh") for _ in range(length))]) for _ in range(draw.randint(0, 6))))
            for k in range(60)]
    want = brute(rows, length)
    assert any(w[2] for w in want)
    assert found_by(docs_of(rows), length=length, block=block) == want


def test_a_core_with_many_surroundings(docs_of):
    draw = random.Random(5)
    core = "".join(draw.choice("abcdefgh") for _ in range(30))
    around = ["".join(draw.choice("ab") for _ in range(10)) for _ in range(300)]
    rows = [(k, a[::-1] + core + a) for k, a in enumerate(around)]
    for block in (4, 20_000):
        assert found_by(docs_of(rows), length=40, block=block) == brute(rows, 40)


def test_interleave_equals_sorting():
    draw = np.random.default_rng(3)
    for width in (0, 1, 4):
        following = draw.integers(0, 3, (200, width)).astype(np.int16)
        group, shard = np.sort(draw.integers(0, 6, 200)), draw.integers(0, 4, 200)
        keys = [*following.T[::-1], shard, group]
        rows = np.lexsort(keys)
        following, group, shard = following[rows], group[rows], shard[rows]
        order, prefix = suffixes.interleaved(following, group, shard)
        assert np.array_equal(following[order], following[np.lexsort([*following.T[::-1], group])])
        assert np.array_equal(group[order], group)
        for k in range(1, 200):
            if group[k] == group[k - 1]:
                a, b = following[order[k - 1]], following[order[k]]
                assert prefix[k] == next((i for i in range(width) if a[i] != b[i]), width)
