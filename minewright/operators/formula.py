"""Scoring a population of formulas in one pass over the samples.

A formula is a nested tuple: ``("add", f, g)``, ``("subtract", f, g)``, ``("multiply", f, g)``,
``("if", test, f, g)`` (``f`` when the test is above 0), ``("isgreater", f, g)`` (1 or 0),
``("p", i)`` for the i-th parameter, or a number. A population is a table ``formula_id, steps``: the steps of a formula in
postfix order, each an operation with its number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.operators.ranks import numbered

Formula = tuple | int | float

#: Operations and how many values they take from the stack.
TAKES = {"number": 0, "p": 0, "add": 2, "subtract": 2, "multiply": 2, "isgreater": 2, "if": 3}
STEPS = "array<struct<op: string, value: double>>"
#: Formulas of one pass, samples that are worked on at once.
AT_ONCE, ROWS = 10_000, 4096


def example_tree() -> Formula:
    return ("if", ("isgreater", ("p", 0), 3), ("add", ("p", 1), 5), ("subtract", ("p", 1), 2))


def compiled(formula: Formula, parameters: list[str]) -> Column:
    """The formula as a column over double parameters."""
    if not isinstance(formula, tuple):
        return F.lit(float(formula))
    name, *parts = formula
    if name == "p":
        return F.col(parameters[parts[0]]).cast("double")
    values = [compiled(part, parameters) for part in parts]
    if name == "if":
        return F.when(values[0] > 0, values[1]).otherwise(values[2])
    left, right = values
    if name == "isgreater":
        return F.when(left > right, 1.0).otherwise(0.0)
    return {"add": lambda: left + right, "subtract": lambda: left - right, "multiply": lambda: left * right}[name]()


def postfix(formula: Formula) -> list[tuple[str, float]]:
    """The steps that leave the formula's value on a stack."""
    steps, waiting = [], [(formula, False)]
    while waiting:
        part, ready = waiting.pop()
        if not isinstance(part, tuple):
            steps.append(("number", float(part)))
        elif part[0] == "p":
            steps.append(("p", float(part[1])))
        elif ready:
            steps.append((part[0], 0.0))
        else:
            waiting.append((part, True))
            waiting.extend((own, False) for own in reversed(part[1:]))
    return steps


def population(spark: SparkSession, formulas: list[Formula]) -> DataFrame:
    """``formula_id, steps`` of a list of formulas, numbered from 0."""
    return spark.createDataFrame([(k, postfix(f)) for k, f in enumerate(formulas)], f"formula_id int, steps {STEPS}")


def evaluated(steps: list, values: list[np.ndarray], known: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The value of a formula on all samples at once, and where it has one; parameters may be missing (not ``known``).

    NaN is larger than every number, as in a table's order.
    """
    stack: list[tuple[np.ndarray, np.ndarray]] = []
    size = len(values[0]) if values else 0
    for op, value in steps:
        taken = [stack.pop() for _ in range(TAKES[op])][::-1]
        if op == "number":
            stack.append((np.full(size, value), np.ones(size, bool)))
        elif op == "p":
            stack.append((values[int(value)], known[int(value)]))
        elif op == "if":
            (test, there), (yes, yes_known), (no, no_known) = taken
            first = there & ~(test <= 0)
            stack.append((np.where(first, yes, no), np.where(first, yes_known, no_known)))
        else:
            (left, left_known), (right, right_known) = taken
            both = left_known & right_known
            if op == "isgreater":
                stack.append(((both & ((left > right) | (np.isnan(left) & ~np.isnan(right)))).astype(float), np.ones(size, bool)))
            else:
                stack.append(({"add": np.add, "subtract": np.subtract, "multiply": np.multiply}[op](left, right), both))
    return stack.pop()


def _errors(some, parameters: list[str]):
    """Summed errors of every formula over the samples of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formulas = some.value
        total, met = np.zeros(len(formulas)), np.zeros(len(formulas), bool)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                columns = [batch.column(c) for c in (*parameters, "_target")]
                values = [c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in columns]
                known = [c.is_valid().to_numpy(zero_copy_only=False) for c in columns]
                times = batch.column("_n").to_numpy()
                with np.errstate(all="ignore"):
                    for k, (_, steps) in enumerate(formulas):
                        found, there = evaluated(steps, values[:-1], known[:-1])
                        there = there & known[-1]
                        if there.any():
                            met[k] = True
                            total[k] += (np.abs(found - values[-1]) * times)[there].sum()
        some_met = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array([formulas[k][0] for k in some_met], pa.int32()), pa.array(total[some_met])], names=["formula_id", "score"])

    return run


def scores(samples: DataFrame, formulas: DataFrame | list[Formula], parameters: list[str], target: str = "target", at_once: int = AT_ONCE) -> DataFrame:
    """``formula_id, score``: summed absolute errors of every formula of the population.

    Equal samples are counted once. A pass reads the distinct samples once for up to ``at_once`` formulas, which
    travel to the tasks as their steps; a task keeps one sum per formula and works on arrays of samples. A sample without target,
    or on which a formula has no value, does not count; a formula without any such sample has no score.
    """
    spark = samples.sparkSession
    table = formulas if isinstance(formulas, DataFrame) else population(spark, formulas)
    distinct = samples.groupBy(*[F.col(p).cast("double").alias(p) for p in parameters], F.col(target).cast("double").alias("_target")).agg(F.count("*").alias("_n"))
    found, after = None, None
    while True:
        rest = table if after is None else table.where(F.col("formula_id") > after)
        rows = [(r["formula_id"], [(s["op"], s["value"]) for s in r["steps"]]) for r in rest.orderBy("formula_id").limit(at_once).collect()]
        if rows or found is None:
            part = distinct.mapInArrow(_errors(spark.sparkContext.broadcast(rows), parameters), "formula_id int, score double")
            found = part if found is None else found.unionByName(part)
        if len(rows) < at_once:
            return found.groupBy("formula_id").agg(F.sum("score").alias("score"))
        after = rows[-1][0]


def ranked(scored: DataFrame) -> DataFrame:
    """Best first; ``rank`` over the population, numbered without one task for all."""
    return numbered(scored, [], ["score", "formula_id"], "rank", start=1).select(F.col("rank").cast("int").alias("rank"), "formula_id", "score")
