"""Populations of formulas against the compiled form, formula by formula."""

import random
import time

import pytest
from pyspark.sql import functions as F

from minewright.operators import formula


def grown(draw, depth):
    if depth == 0 or draw.random() < 0.2:
        return draw.choice([("p", 0), ("p", 1), draw.randint(-5, 5)])
    name = draw.choice(["add", "subtract", "multiply", "isgreater", "if"])
    return (name, *(grown(draw, depth - 1) for _ in range(formula.TAKES[name])))


@pytest.mark.parametrize("at_once", [7, 10_000])
def test_scores_equal_compiled_formulas(spark, at_once):
    draw = random.Random(3)
    rows = [(draw.choice([None, float(draw.randint(-4, 4)), float("nan")]), draw.choice([None, draw.randint(-9, 9)]), draw.choice([None, 2.0, -7.5])) for _ in range(60)]
    samples = spark.createDataFrame(rows * 2, "x DOUBLE, y INT, target DOUBLE").repartition(3)
    formulas = [grown(draw, 4) for _ in range(40)] + [formula.example_tree(), ("p", 1), 3]
    got = {r.formula_id: r.score for r in formula.scores(samples, formulas, ["x", "y"], at_once=at_once).collect()}
    want = samples.agg(*[F.sum(F.abs(formula.compiled(f, ["x", "y"]) - F.col("target"))).alias(f"f{k}") for k, f in enumerate(formulas)]).first()
    for k in range(len(formulas)):
        if want[k] is None:
            assert k not in got
        else:
            assert got[k] == pytest.approx(want[k], nan_ok=True), formulas[k]


def test_ten_thousand_formulas_in_one_scan(spark):
    draw = random.Random(4)
    formulas = [grown(draw, 3) for _ in range(10_000)]
    samples = spark.range(2000).select((F.col("id") % 40).alias("x"), (F.col("id") % 7).alias("y"), F.col("id").cast("double").alias("target"))
    started = time.time()
    scored = formula.scores(samples, formula.population(spark, formulas), ["x", "y"])
    assert scored._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    assert scored.count() == 10_000 and time.time() - started < 120
    best = formula.ranked(scored).where("rank <= 3").orderBy("rank").collect()
    assert [r["rank"] for r in best] == [1, 2, 3] and best[0].score <= best[1].score <= best[2].score
    assert formula.scores(samples.limit(0), formulas[:3], ["x", "y"]).count() == 0
    assert formula.scores(samples, [], ["x", "y"]).count() == 0
