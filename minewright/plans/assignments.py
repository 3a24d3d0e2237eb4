"""Candidate schedules over nations, rooms and layouts over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.operators import assign
from minewright.operators.pairs import spread
from minewright.operators.ranks import numbered
from minewright.registry import Tables, plan
from minewright.session import cut


def flights(t: Tables):
    """Every order is a flight of its customer's nation, numbered per route in order."""
    rows = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_nationkey").alias("origin"), (F.col("o_orderkey") % 2).cast("int").alias("direction"), "o_orderkey",
                    (300 + F.col("o_orderkey") % 900).alias("dep_min"),
                    (360 + F.col("o_orderkey") % 900 + F.col("o_custkey") % 180).alias("arr_min"),
                    F.floor(F.col("o_totalprice") / 1000).alias("price")))
    return cut(numbered(rows, ["origin", "direction"], ["o_orderkey"], "idx"), "flights")


def solutions(t: Tables, found):
    """One candidate per customer: every nation's traveller takes hashed flights out and back.

    Choices are kept below the number of flights of the route, so each one exists. A customer becomes two rows
    per nation, so the few bytes of the customers are dealt out first: as read they may be one task.
    """
    sizes = found.groupBy("origin", "direction").agg(F.count("*").alias("size"))
    # One row for the whole domain: two route sizes for each of the nations.
    domain = sizes.agg(F.array_sort(F.collect_list(F.struct("origin", "direction", "size"))).alias("routes"))
    customers = spread(t.customer.select("c_custkey"), ["c_custkey"])
    return customers.withColumn("routes", domain.scalar()).select(
        F.col("c_custkey").alias("sol_id"),
        F.transform("routes", lambda r: F.pmod(
            F.col("c_custkey") * (7 - 4 * r["direction"]) + r["origin"] * (3 - 2 * r["direction"]), r["size"])).alias("choices"))


def travellers(t: Tables, found):
    """Seats in origin order, for the nations that have flights both ways."""
    both = found.select("origin").distinct()
    return numbered(both, [], ["origin"], "seat").select(F.col("seat").cast("int").alias("seat"), "origin")


FLIGHTS = """flights AS (
  SELECT origin, direction, row_number() OVER (PARTITION BY origin, direction ORDER BY o_orderkey) - 1 AS idx,
    dep_min, arr_min, price FROM (
    SELECT c_nationkey AS origin, o_orderkey % 2 AS direction, o_orderkey, 300 + o_orderkey % 900 AS dep_min,
      360 + o_orderkey % 900 + o_custkey % 180 AS arr_min, CAST(floor(o_totalprice / 1000) AS BIGINT) AS price
    FROM orders JOIN customer ON o_custkey = c_custkey)),
routes AS (SELECT origin, direction, count(*) AS size FROM flights GROUP BY origin, direction),
seats AS (SELECT row_number() OVER (ORDER BY origin) - 1 AS seat, origin FROM (SELECT DISTINCT origin FROM routes)),
chosen AS (
  SELECT c_custkey AS sol_id, seat, origin, direction, (c_custkey * (7 - 4 * direction) + origin * (3 - 2 * direction)) % size AS idx
  FROM customer CROSS JOIN routes JOIN seats USING (origin)),
rows AS (SELECT sol_id, seat, origin, direction, idx, dep_min, arr_min, price FROM chosen JOIN flights USING (origin, direction, idx)),
edges AS (
  SELECT sol_id, greatest(max(arr_min) FILTER (direction = 0), 0) AS latest, least(min(dep_min) FILTER (direction = 1), 1440) AS earliest
  FROM rows GROUP BY sol_id)"""


def _chosen(t: Tables):
    found = flights(t)
    return assign.schedule_rows(solutions(t, found), travellers(t, found), found)


@plan("schedule_cost", f"""WITH {FLIGHTS}
SELECT sol_id, CAST(sum(price) + sum(CASE WHEN direction = 0 THEN latest - arr_min ELSE dep_min - earliest END)
  + CASE WHEN any_value(latest) > any_value(earliest) THEN 50 ELSE 0 END AS BIGINT) AS cost
FROM rows JOIN edges USING (sol_id) GROUP BY sol_id""")
def schedule_cost(t: Tables):
    return assign.schedule_cost(_chosen(t))


@plan("schedule_rows", f"""WITH {FLIGHTS}
SELECT sol_id, CAST(seat AS INT) AS seat, origin, CAST(direction AS INT) AS direction, idx, dep_min, arr_min, price FROM rows""")
def schedule_rows(t: Tables):
    return _chosen(t)


DRAWN = FLIGHTS.replace("""SELECT c_custkey AS sol_id, seat, origin, direction, (c_custkey * (7 - 4 * direction) + origin * (3 - 2 * direction)) % size AS idx
  FROM customer CROSS JOIN routes JOIN seats USING (origin)""", """SELECT sol_id, seat, origin, direction,
    ('0x' || substr(md5(sol_id || '-17-' || (row_number() OVER (PARTITION BY sol_id ORDER BY origin, direction) - 1)), 1, 7))::BIGINT % size AS idx
  FROM (SELECT unnest(range(10000)) AS sol_id) CROSS JOIN routes JOIN seats USING (origin)""")


@plan("random_search", f"""WITH {DRAWN}, costs AS (
  SELECT sol_id, CAST(sum(price) + sum(CASE WHEN direction = 0 THEN latest - arr_min ELSE dep_min - earliest END)
    + CASE WHEN any_value(latest) > any_value(earliest) THEN 50 ELSE 0 END AS BIGINT) AS cost FROM rows JOIN edges USING (sol_id) GROUP BY sol_id)
SELECT sol_id, cost FROM costs ORDER BY cost, sol_id LIMIT 1""")
def random_search(t: Tables):
    found = flights(t)
    sizes = found.groupBy("origin", "direction").agg(F.count("*").alias("size")).orderBy("origin", "direction").collect()
    candidates = assign.random_solutions(t.spark, [row["size"] for row in sizes])
    return assign.cheapest(assign.schedule_cost(assign.schedule_rows(candidates, travellers(t, found), found)))


ROOMS, PEOPLE = 5, 10


def room_candidates(t: Tables):
    """Each order proposes a room choice for ten people and carries their wishes."""
    key = F.col("o_orderkey")
    return t.orders.select(
        key.alias("sol_id"),
        F.array(*[F.pmod(key * (i + 3) + F.col("o_custkey"), F.lit(PEOPLE - i)).cast("int") for i in range(PEOPLE)]).alias("choices"),
        F.array(*[F.struct(F.pmod(F.col("o_custkey") + i, F.lit(ROOMS)).cast("int").alias("first"),
                           F.pmod(F.col("o_custkey") * 2 + i + 1, F.lit(ROOMS)).cast("int").alias("second"))
                  for i in range(PEOPLE)]).alias("wanted"))


def picked(people: int = PEOPLE, rooms: int = ROOMS) -> str:
    """``p{people}``: the slots left and the rooms taken after every person, one pick after the other."""
    slots = [r for r in range(rooms) for _ in range(2)]
    parts = [f"p0 AS (SELECT o_orderkey AS sol_id, o_custkey AS c, {slots} AS rest, []::INT[] AS taken FROM orders)"]
    for i in range(people):
        choice = f"(sol_id * {i + 3} + c) % {people - i}"
        parts.append(f"""p{i + 1} AS (SELECT sol_id, c, rest[:{choice}] || rest[{choice} + 2:] AS rest, list_append(taken, rest[{choice} + 1]) AS taken FROM p{i})""")
    return ",\n".join(parts)


ROOM_ROWS = f"""{picked()}, room_rows AS (
  SELECT sol_id, c, CAST(generate_subscripts(taken, 1) - 1 AS INT) AS person, CAST(unnest(taken) AS INT) AS room FROM p{PEOPLE})"""


@plan("room_cost", f"""WITH {ROOM_ROWS} SELECT sol_id, CAST(sum(CASE WHEN room = (c + person) % {ROOMS} THEN 0
  WHEN room = (c * 2 + person + 1) % {ROOMS} THEN 1 ELSE 3 END) AS INT) AS cost FROM room_rows GROUP BY sol_id""")
def room_cost(t: Tables):
    rooms = assign.assigned_rooms(F.col("choices"), ROOMS)
    return room_candidates(t).select("sol_id", assign.room_cost(rooms, F.col("wanted")).alias("cost"))


@plan("room_rows", f"WITH {ROOM_ROWS} SELECT sol_id, person, room FROM room_rows")
def room_rows(t: Tables):
    rooms = assign.assigned_rooms(F.col("choices"), ROOMS)
    return room_candidates(t).select("sol_id", F.posexplode(rooms).alias("person", "room"))


def layouts(t: Tables):
    """Four candidate layouts of all vectors; each node is joined to one hashed other node."""
    count = t.embeddings.agg(F.count("*")).scalar()
    ids = t.embeddings.select("vec_id").withColumn("n", count)
    nodes = ids.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("sol_id"), F.col("vec_id").alias("node")).select(
        "sol_id", "node", (10 + (F.col("node") + F.col("sol_id") * 37) * 7919 % 361).alias("x"),
        (10 + (F.col("node") + F.col("sol_id") * 37) * 104729 % 361).alias("y"))
    edges = ids.select(F.col("vec_id").alias("edge"), F.col("vec_id").alias("a"),
                       ((F.col("vec_id") * 7 + 3) % F.col("n")).alias("b")).where("a <> b")
    return nodes, edges


@plan("layout_cost", """WITH nodes AS (
  SELECT sol_id, vec_id AS node, 10 + (vec_id + sol_id * 37) * 7919 % 361 AS x, 10 + (vec_id + sol_id * 37) * 104729 % 361 AS y
  FROM embeddings, (SELECT unnest(range(4)) AS sol_id)),
edges AS (SELECT vec_id AS edge, vec_id AS a, (vec_id * 7 + 3) % (SELECT count(*) FROM embeddings) AS b FROM embeddings),
segments AS (
  SELECT p.sol_id, edge, CAST(p.x AS DOUBLE) AS x1, CAST(p.y AS DOUBLE) AS y1, CAST(q.x AS DOUBLE) AS x2, CAST(q.y AS DOUBLE) AS y2
  FROM edges JOIN nodes p ON p.node = a JOIN nodes q ON q.node = b AND q.sol_id = p.sol_id WHERE a <> b),
crossed AS (
  SELECT s.sol_id, ((t.x2 - t.x1) * (s.y1 - t.y1) - (t.y2 - t.y1) * (s.x1 - t.x1)) / den AS ua,
    ((s.x2 - s.x1) * (s.y1 - t.y1) - (s.y2 - s.y1) * (s.x1 - t.x1)) / den AS ub
  FROM segments s JOIN segments t ON s.sol_id = t.sol_id AND s.edge < t.edge,
  LATERAL (SELECT nullif((t.y2 - t.y1) * (s.x2 - s.x1) - (t.x2 - t.x1) * (s.y2 - s.y1), 0) AS den)),
gaps AS (
  SELECT p.sol_id, sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) AS gap
  FROM nodes p JOIN nodes q ON p.sol_id = q.sol_id AND p.node < q.node),
parts AS (
  SELECT sol_id, 1.0::DOUBLE AS part FROM crossed WHERE ua > 0 AND ua < 1 AND ub > 0 AND ub < 1
  UNION ALL SELECT sol_id, 1 - gap / 50 FROM gaps WHERE gap < 50)
SELECT CAST(sol_id AS INT) AS sol_id, round(sum(part), 6) AS cost FROM parts GROUP BY sol_id""")
def layout_cost(t: Tables):
    nodes, edges = layouts(t)
    return assign.layout_cost(nodes, edges).withColumn("cost", F.round("cost", 6))
