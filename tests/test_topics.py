"""Topic reports read the tables as they are now."""

import os
import random
from datetime import date, timedelta
from types import SimpleNamespace

import numpy as np
import pytest

from minewright.operators import factor, factor_blocks, factor_rounds, vectorize
from minewright.plans import factors
from minewright.session import laid_out


def test_topics_are_computed_by_every_query(monkeypatch):
    spark, calls = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="one")), []
    monkeypatch.setattr(factors, "article_cells", lambda t: t.cells)
    monkeypatch.setattr(factors.factor, "factorize", lambda cells, k: calls.append(cells) or (cells, cells))
    for cells in ("old", "old", "rewritten"):
        assert factors.finished_topics(SimpleNamespace(spark=spark, folder="f", cells=cells)) == (cells, cells)
    assert calls == ["old", "old", "rewritten"]


def test_a_round_moves_no_matrix(spark):
    """Both layouts of the matrix are read in place: no exchange stands on a scan of them."""
    rng = random.Random(4)
    cells = spark.createDataFrame([(i, f"w{j}", float(rng.randint(1, 9))) for i in range(40) for j in range(30) if rng.random() < 0.3], "i LONG, j STRING, v DOUBLE")
    by_i, by_j = laid_out(cells, ["i"], "matrix_i"), laid_out(cells, ["j"], "matrix_j")
    w, h = laid_out(factor.start(cells, "i", "w", 3), ["i"], "w"), laid_out(factor.start(cells, "j", "h", 3), ["j"], "h")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fresh in (factor._updated(by_i, w, h, "i", "j", "w", "h", 3), factor._updated(by_j, h, w, "j", "i", "h", "w", 3)):
            plan = fresh._jdf.queryExecution().executedPlan().toString().splitlines()
            scans = [k for k, line in enumerate(plan) if "FileScan" in line and "matrix_" in line]
            assert scans
            for k in scans:
                above = [line for line in plan[max(0, k - 4):k]]
                assert not any("Exchange" in line and "hashpartitioning" in line for line in above[-3:]), above
            assert sum("Exchange hashpartitioning" in line for line in plan) == 1  # the sums per moved key
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cost_equals_the_dense_error(spark):
    rng = random.Random(5)
    cells = [(i, j, float(rng.randint(1, 9))) for i in range(12) for j in range(7) if rng.random() < 0.5]
    matrix = spark.createDataFrame(cells, "i LONG, j LONG, v DOUBLE")
    w, h = factor.factorize(matrix, 2, rounds=3)
    left, right = {r.i: r.w for r in w.collect()}, {r.j: r.h for r in h.collect()}
    dense = {(i, j): v for i, j, v in cells}
    want = sum((dense.get((i, j), 0.0) - sum(a * b for a, b in zip(left[i], right[j]))) ** 2 for i in left for j in right)
    assert factor.cost(matrix, w, h, 2).first()["cost"] == pytest.approx(want)


def test_rounds_over_several_blocks_equal_the_dense_rounds(spark):
    """1500 rows and 1100 columns are two blocks a side; a layout has one row per block, and no cell is lost."""
    rng = random.Random(6)
    cells = [(i, f"w{rng.randrange(1100):04d}", float(rng.randint(0, 4))) for i in range(1500) for _ in range(4)]
    matrix = spark.createDataFrame(cells, "i LONG, j STRING, v DOUBLE")
    w, h = factor.factorize(matrix, 2, rounds=2)
    left, right = ({r[0]: r[1] for r in side.collect()} for side in (w, h))
    rows, columns = sorted({c[0] for c in cells}), sorted({c[1] for c in cells})
    assert sorted(left) == rows and sorted(right) == columns
    v = np.zeros((len(rows), len(columns)))
    np.add.at(v, ([rows.index(c[0]) for c in cells], [columns.index(c[1]) for c in cells]), [c[2] for c in cells])
    begin_w, begin_h = ({r[0]: r[1] for r in factor.start(matrix, *side, 2).collect()} for side in (("i", "w"), ("j", "h")))
    dense_w, dense_h = np.array([begin_w[i] for i in rows]), np.array([begin_h[j] for j in columns])
    for _ in range(2):  # a zero denominator gives 0
        with np.errstate(invalid="ignore"):
            dense_h = np.nan_to_num(dense_h * (v.T @ dense_w) / (dense_h @ (dense_w.T @ dense_w)))
            dense_w = np.nan_to_num(dense_w * (v @ dense_h) / (dense_w @ (dense_h.T @ dense_h)))
    assert np.allclose([left[i] for i in rows], dense_w) and np.allclose([right[j] for j in columns], dense_h)


def test_a_layout_has_a_row_per_block(spark):
    cells = spark.createDataFrame([(0, k % 1024, k // 700, k % 700, 1.0) for k in range(3000)],
                                  "i_block LONG, i_place INT, j_block LONG, j_place INT, v DOUBLE")
    assert factor_blocks.layout(cells, "i", "j", "by_i").count() == 1
    assert factor_blocks.layout(cells, "j", "i", "by_j").count() == 5


def test_a_round_is_one_pass_over_the_cells_and_keeps_no_older_round(spark, monkeypatch):
    """The smaller side travels: a round lays out one table, of which only the last stays, and no other reads or moves the cells."""
    laid, gone = [], []
    real, discard = factor_rounds.laid_out, factor_rounds.discarded
    monkeypatch.setattr(factor_rounds, "laid_out", lambda df, keys, label, **how: laid.append(label) or real(df, keys, label, **how))
    monkeypatch.setattr(factor_rounds, "discarded", lambda table: gone.append(table.inputFiles()[0]) or discard(table))
    cells = spark.createDataFrame([(i, f"w{j}", float(i + j)) for i in range(9) for j in range(20)], "i LONG, j STRING, v DOUBLE")
    w, h = factor.factorize(cells, 2, rounds=4)
    assert laid == ["pieces"] + ["state"] * 4 and len(gone) == 3 and not any(os.path.exists(f.removeprefix("file://")) for f in gone)
    assert w.count() == 9 and h.count() == 20


@pytest.mark.parametrize("wide", [False, True])
def test_both_ways_of_the_rounds_give_the_same_vectors(spark, monkeypatch, wide):
    """Repeated cells, missing keys and values, fractions, and keys whose every partner is missing, with either side travelling."""
    rng = random.Random(7)
    days = [date(2020, 1, 1) + timedelta(k) for k in range(40 if wide else 7)]
    cells = [(rng.choice(days), f"w{rng.randrange(7 if wide else 40)}", rng.choice([1.0, 300.0, 0.25, 0.0, None])) for _ in range(150)]
    cells += [(None, "alone", 2.0), (days[0], None, 1.0), (date(2030, 1, 1), None, 3.0), *cells[:5]]
    matrix = spark.createDataFrame(cells, "i DATE, j STRING, v DOUBLE")
    got = [{r[0]: r[1] for r in side.collect()} for side in factor.factorize(matrix, 3, rounds=5)]
    monkeypatch.setattr(factor_rounds, "TRAVELS", -1)
    want = [{r[0]: r[1] for r in side.collect()} for side in factor.factorize(matrix, 3, rounds=5)]
    for mine, others in zip(got, want):
        assert mine.keys() == others.keys() and all(np.allclose(mine[k], others[k], rtol=1e-9, atol=1e-12) for k in mine)


def test_words_of_articles_with_one_number_are_added_up(spark):
    rows = [(1, "Alpha", "alpha Beta-betaébeta ab"), (1, "Gamma", "beta <b>x</b> delta_1<i"), (None, None, "alpha"), (2, "T", None), (None, "Beta", "beta")]
    entries = spark.createDataFrame(rows, "doc_id LONG, title STRING, summary STRING")
    got = {(r.doc_id, r.word): r.n for r in vectorize.article_words(entries).collect()}
    assert got == {(1, "alphaalpha"): 1, (1, "beta"): 3, (1, "gammabeta"): 1, (1, "delta_1"): 1, (None, "betabeta"): 1}
