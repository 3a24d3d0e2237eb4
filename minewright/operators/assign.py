"""Scoring candidate assignments: travel schedules, rooms and graph layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.operators.pairs import paired, spread
from minewright.session import cut

# Surcharge, room penalties and the spacing below which nodes are penalised.
LATE_FEE = 50
SECOND_CHOICE, NO_CHOICE = 1, 3
SPACING = 50.0


def schedule_rows(solutions: DataFrame, travellers: DataFrame, flights: DataFrame) -> DataFrame:
    """The chosen flights: one row per solution, traveller and direction (0 out, 1 back).

    ``solutions(sol_id, choices)``: the choices of traveller d sit at 2d and 2d+1;
    ``travellers(seat, origin)``; ``flights(origin, direction, idx, dep_min, arr_min, price)``.
    The planner takes the choices for as small as the solutions that they come out of, and would send them all through the
    driver: the seats are sent instead, no more of them than choices in a row, and choices and flights meet sorted.
    """
    chosen = solutions.select("sol_id", F.posexplode("choices").alias("place", "idx")).select(
        "sol_id", F.floor(F.col("place") / 2).cast("int").alias("seat"),
        (F.col("place") % 2).cast("int").alias("direction"), "idx")
    return (chosen.join(F.broadcast(travellers), "seat").join(flights.hint("merge"), ["origin", "direction", "idx"])
            .select("sol_id", "seat", "origin", "direction", "idx", "dep_min", "arr_min", "price"))


def schedule_cost(rows: DataFrame) -> DataFrame:
    """Prices, waiting minutes and the late fee per solution, from one aggregation.

    Waiting for the latest arrival sums to ``n · latest − Σ arrivals``; the same holds on the way back.
    """
    out, back = F.col("direction") == 0, F.col("direction") == 1
    latest = F.greatest(F.max(F.when(out, F.col("arr_min"))), F.lit(0))
    earliest = F.least(F.min(F.when(back, F.col("dep_min"))), F.lit(24 * 60))
    waits = (F.count_if(out) * latest - F.sum(F.when(out, F.col("arr_min")))
             + F.sum(F.when(back, F.col("dep_min"))) - F.count_if(back) * earliest)
    return rows.groupBy("sol_id").agg(
        (F.sum("price") + waits + F.when(latest > earliest, LATE_FEE).otherwise(0)).alias("cost"))


def random_solutions(spark, domain: list[int], candidates: int = 10000, seed: int = 17) -> DataFrame:
    """``candidates`` random choice vectors below the domain sizes; drawn by a hash, so any partitioning gives the same."""
    ids = spark.range(candidates).withColumnRenamed("id", "sol_id")

    def draw(place: int) -> Column:
        return F.conv(F.substring(F.md5(F.concat_ws("-", "sol_id", F.lit(str(seed)), F.lit(str(place)))), 1, 7), 16, 10).cast("long")

    return ids.select("sol_id", F.array(*[F.pmod(draw(place), F.lit(size)).cast("int") for place, size in enumerate(domain)]).alias("choices"))


def cheapest(costs: DataFrame) -> DataFrame:
    """The first of the cheapest solutions."""
    return costs.agg(F.min(F.struct("cost", "sol_id")).alias("best")).select("best.sol_id", "best.cost")


def assigned_rooms(choices: Column, rooms: int, slots: int = 2) -> Column:
    """Room number per person: each choice takes and removes one of the remaining slots."""
    start = F.array(*[F.lit(r) for r in range(rooms) for _ in range(slots)])
    none = F.array().cast("array<int>")
    state = F.struct(start.alias("left"), none.alias("taken"))

    def take(acc, choice):
        left, at = acc["left"], choice + 1
        rest = F.concat(F.slice(left, 1, choice), F.slice(left, at + 1, F.greatest(F.size(left) - at, F.lit(0))))
        return F.struct(rest.alias("left"), F.concat(acc["taken"], F.array(F.get(left, choice))).alias("taken"))

    return F.aggregate(choices, state, take, lambda acc: acc["taken"])


def room_cost(rooms: Column, wanted: Column) -> Column:
    """0, 1 or 3 per person for the first, second or no wish; ``wanted`` is an array of (first, second)."""
    paid = F.zip_with(rooms, wanted, lambda room, wish: F.when(room == wish["first"], 0)
                      .when(room == wish["second"], SECOND_CHOICE).otherwise(NO_CHOICE))
    return F.aggregate(paid, F.lit(0), lambda total, one: total + one)


def layout_cost(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edge crossings plus crowding per layout, from ``nodes(sol_id, node, x, y)`` and ``edges(edge, a, b)``.

    The plane is cut into squares of one spacing. Two edges are compared only in squares both may
    pass, and a crossing counts in the one square that holds the crossing point; crowded nodes are
    at most one square apart. So no pair far apart is ever formed. Edges with the same ends, and nodes in
    one place, are met once by their number: copies never cross each other, and nodes in one place are a spacing too close.
    """
    ends = nodes.select("sol_id", "node", F.col("x").cast("double"), F.col("y").cast("double"))
    segments = (edges.join(ends.select("sol_id", F.col("node").alias("a"), F.col("x").alias("x1"), F.col("y").alias("y1")), "a")
                .join(ends.select("sol_id", F.col("node").alias("b"), F.col("x").alias("x2"), F.col("y").alias("y2")), ["sol_id", "b"])
                .groupBy("sol_id", "x1", "y1", "x2", "y2").agg(F.min("edge").alias("edge"), F.count("*").cast("double").alias("n")))
    places = cut(ends.groupBy("sol_id", "x", "y").agg(F.min("node").alias("node"), F.count("*").cast("double").alias("n")), "places")
    both = F.col("x.n") * F.col("y.n")

    def span(low, high):
        return F.explode(F.sequence(F.floor((F.least(low, high) - 1e-6) / SPACING), F.floor((F.greatest(low, high) + 1e-6) / SPACING)))

    segments = spread(cut(segments, "segments"), ["sol_id", "edge"])
    squares = segments.select("*", span("x1", "x2").alias("cx")).select("*", span("y1", "y2").alias("cy"))
    met = paired(squares, ["sol_id", "cx", "cy"], "edge")
    x1, y1, x2, y2 = (F.col(f"x.{c}") for c in ("x1", "y1", "x2", "y2"))
    x3, y3, x4, y4 = (F.col(f"y.{c}") for c in ("x1", "y1", "x2", "y2"))
    den = (y4 - y3) * (x2 - x1) - (x4 - x3) * (y2 - y1)
    crossings = (met.withColumn("ua", F.try_divide((x4 - x3) * (y1 - y3) - (y4 - y3) * (x1 - x3), den))
                 .withColumn("ub", F.try_divide((x2 - x1) * (y1 - y3) - (y2 - y1) * (x1 - x3), den))
                 .where((F.col("ua") > 0) & (F.col("ua") < 1) & (F.col("ub") > 0) & (F.col("ub") < 1))
                 .where((F.floor((x1 + F.col("ua") * (x2 - x1)) / SPACING) == F.col("cx"))
                        & (F.floor((y1 + F.col("ua") * (y2 - y1)) / SPACING) == F.col("cy")))
                 .select("sol_id", both.alias("part")))

    home = places.select("*", F.floor(F.col("x") / SPACING).alias("hx"), F.floor(F.col("y") / SPACING).alias("hy"))
    around = home.select("*", F.explode(F.array(*[
        F.struct((F.col("hx") + dx).alias("cx"), (F.col("hy") + dy).alias("cy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])).alias("c"))
    near = (around.select("sol_id", "node", "n", "x", "y", "hx", "hy", "c.cx", "c.cy"))
    close = paired(near, ["sol_id", "cx", "cy"], "node")
    # Both nodes see several common squares; the pair counts in the home square of its first node.
    gap = F.sqrt((F.col("x.x") - F.col("y.x")) * (F.col("x.x") - F.col("y.x")) + (F.col("x.y") - F.col("y.y")) * (F.col("x.y") - F.col("y.y")))
    crowded = (close.where((F.col("x.hx") == F.col("cx")) & (F.col("x.hy") == F.col("cy")))
               .select("sol_id", both.alias("both"), gap.alias("gap")).where(F.col("gap") < SPACING)
               .select("sol_id", (F.col("both") * (1.0 - F.col("gap") / SPACING)).alias("part")))
    stacked = places.where("n > 1").select("sol_id", (F.col("n") * (F.col("n") - 1) / 2).alias("part"))
    parts = crossings.unionByName(crowded).unionByName(stacked).groupBy("sol_id").agg(F.sum("part").alias("cost"))
    return (nodes.select("sol_id").distinct().join(parts, "sol_id", "left")
            .select("sol_id", F.coalesce("cost", F.lit(0.0)).alias("cost")))
