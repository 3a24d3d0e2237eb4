"""Candidate schedules and layouts."""

import re

from pyspark.sql import functions as F

from minewright.operators import assign
from minewright.plans import assignments
from minewright.registry import Tables


def test_candidates_are_made_in_as_many_tasks_as_there_are_shuffle_partitions(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    found = assignments.solutions(t, assignments.flights(t))
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_choices_never_pass_through_the_driver(spark):
    """A solution is one row of few bytes to the planner and many rows in truth: of what is broadcast, nothing holds the choices."""
    solutions = spark.range(1000).select(F.col("id").alias("sol_id"), F.array_repeat(F.pmod("id", F.lit(3)), 8).alias("choices"))
    seats = spark.createDataFrame([(k, 10 * k) for k in range(4)], "seat INT, origin INT")
    flights = spark.range(3).select(F.explode(F.array(*[F.lit(10 * k) for k in range(4)])).alias("origin"), F.col("id").alias("idx")).select(
        "origin", F.explode(F.array(F.lit(0), F.lit(1))).alias("direction"), "idx", *[F.col("idx").alias(c) for c in ("dep_min", "arr_min", "price")])
    rows = assign.schedule_rows(solutions, seats, flights.repartition(4))
    assert rows.count() == 8000
    plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[\s:|+\-*]*", line).group()) for line in plan]
    sent = [k for k, line in enumerate(plan) if "BroadcastExchange" in line]
    below = [line for k in sent for line in plan[k + 1:next((n for n in range(k + 1, len(plan)) if depth[n] <= depth[k]), len(plan))]]
    assert sent and not any("Generate" in line and "posexplode" in line for line in below)


def test_copies_of_edges_and_nodes_meet_once_by_their_number(spark, monkeypatch):
    met, real = [], assign.paired
    monkeypatch.setattr(assign, "paired", lambda rows, key, item: met.append(rows.count()) or real(rows, key, item))
    ends = [(10, 10), (30, 30), (10, 30), (30, 10)]
    nodes = spark.createDataFrame([(0, 4 * k + i, x, y) for k in range(25) for i, (x, y) in enumerate(ends)], "sol_id INT, node LONG, x INT, y INT")
    edges = spark.createDataFrame([(2 * k + i, 4 * k + 2 * i, 4 * k + 2 * i + 1) for k in range(25) for i in range(2)], "edge LONG, a LONG, b LONG")
    cost = assign.layout_cost(nodes, edges).first()["cost"]
    side, across = 1 - 20 / 50, 1 - 800 ** 0.5 / 50
    assert abs(cost - (25 * 25 + 4 * 25 * 24 / 2 + 25 * 25 * (4 * side + 2 * across))) < 1e-6
    assert met[0] == 2 and met[1] == 4 * 9
