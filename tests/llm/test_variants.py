"""Spelling variants against all pairs in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from minewright.llm import variants
from minewright.llm.variants import Acceptors
from tests.llm.test_dedup import LOWER


def brute_words(rows, least_length=7, least_count=2):
    found = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_length:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(words, times=10):
    forms = {}
    for w, n in words.items():
        others = [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = (n, len(others), best if best and words[best] >= times * n else None)
    out = set()
    for w, (n, n_near, form) in forms.items():
        root = w
        while forms[root][2]:
            root = forms[root][2]
        out.add((w, form, root, n, n_near, words[form] if form else None))
    return out


def found_by(docs, **options):
    rows = variants.spelling_variants(docs, **options).collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_of_odd_rows(docs_of, odd_rows):
    rows = odd_rows + [(20 + k, "xÀÿéöü Überwältigend überwältigend, ÜBERWÄLTIGEND.Überwaltigend " * 3 + "z" * 5000 + " " + "z" * 5001 + " related relation relations" * k)
                       for k in range(40)]
    assert found_by(docs_of(rows)) == brute_variants(brute_words(rows))
    assert found_by(docs_of([])) == set()
    assert found_by(docs_of([(1, None), (None, ""), (2, "a b")])) == set()


@pytest.mark.parametrize("block", [1, 3, 50_000])
def test_variants_of_similar_words(docs_of, block):
    draw = random.Random(block)
    words = ["".join(draw.choice("aabé") for _ in range(draw.randint(2, 6))) for _ in range(150)]
    rows = [(k, " ".join(draw.choice(words) for _ in range(draw.choice([3, 400])))) for k in range(30)]
    want = brute_variants(brute_words(rows, 2, 1), 2)
    assert sum(1 for w in want if w[1]) > 20 and any(w[1] != w[2] for w in want if w[1])
    assert found_by(docs_of(rows), least_length=2, least_count=1, times=2, block=block) == want


def test_acceptors_are_minimal_and_pairs_come_once():
    draw = random.Random(9)
    for closed in (False, True):
        short = sorted({"".join(draw.choice("ab") for _ in range(6)) for _ in range(40)})
        long = sorted({"".join(draw.choice("ab") for _ in range(7)) for _ in range(80)})
        machine = Acceptors()
        first, second = machine.initial(short), machine.initial(long)
        assert machine.count[first] == len(short) and machine.count[second] == len(long)
        assert len({tuple(sorted(a.items())) for a in machine.arcs}) == len(machine.arcs)
        pairs = list(machine.replaced(first))
        assert sorted(pairs) == [(i, j) for i, a in enumerate(short) for j, b in enumerate(short) if i < j and near(a, b)]
        pairs = list(machine.deleted(second, first, closed))
        assert sorted(pairs) == [(i, j) for i, a in enumerate(long) for j, b in enumerate(short) if near(a, b) and not (closed and a[:-1] == b)]
