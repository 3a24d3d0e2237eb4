"""A population of formulas scored against the line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.operators import formula
from minewright.registry import Tables, plan


def population():
    """Guesses around the true formula x² + 2y + 3x + 5, with and without branches."""
    x, y = ("p", 0), ("p", 1)
    square = ("multiply", x, x)
    found = [
        ("add", ("add", ("multiply", a, square), ("multiply", b, y)), ("add", ("multiply", c, x), 5))
        for a in (0, 1, 2) for b in (1, 2, 3) for c in (2, 3, 4)]
    branched = [("if", ("isgreater", x, cut), f, ("subtract", f, y)) for cut in (2, 4, 6) for f in found[9:18]]
    return [*found, *branched, formula.example_tree()]


def sql(f) -> str:
    """The formula as SQL text, for the oracle."""
    if not isinstance(f, tuple):
        return f"{float(f)}::DOUBLE"
    name, *parts = f
    if name == "p":
        return ("x", "y")[parts[0]]
    v = [sql(p) for p in parts]
    shapes = {"if": "(CASE WHEN {0} > 0 THEN {1} ELSE {2} END)", "isgreater": "(CASE WHEN {0} > {1} THEN 1 ELSE 0 END)::DOUBLE",
              "add": "({0} + {1})", "subtract": "({0} - {1})", "multiply": "({0} * {1})"}
    return shapes[name].format(*v)


def rows(t: Tables):
    x, y = F.col("l_linenumber").cast("long"), F.col("l_quantity").cast("long")
    return t.lineitem.select(x.alias("x"), y.alias("y"), (x * x + 2 * y + 3 * x + 5).alias("target"))


ROWS = """samples AS (
  SELECT l_linenumber::DOUBLE AS x, floor(l_quantity) AS y, l_linenumber * l_linenumber + 2 * floor(l_quantity) + 3 * l_linenumber + 5 AS target FROM lineitem)"""


def scores_oracle():
    parts = [f"SELECT {i} AS formula_id, sum(abs({sql(f)} - target)) AS score FROM samples" for i, f in enumerate(population())]
    return f"WITH {ROWS}, scores AS ({' UNION ALL '.join(parts)})"


@plan("formula_eval", f"WITH {ROWS} SELECT DISTINCT x, y, {sql(formula.example_tree())} AS value FROM samples")
def formula_eval(t: Tables):
    return (rows(t).select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).distinct()
            .withColumn("value", formula.compiled(formula.example_tree(), ["x", "y"])))


@plan("formula_score", f"{scores_oracle()} SELECT formula_id, score FROM scores")
def formula_score(t: Tables):
    return formula.scores(rows(t), population(), ["x", "y"])


@plan("formula_rank", f"{scores_oracle()} SELECT CAST(row_number() OVER (ORDER BY score, formula_id) AS INT) AS rank, formula_id, score FROM scores")
def formula_rank(t: Tables):
    return formula.ranked(formula.scores(rows(t), population(), ["x", "y"]))
