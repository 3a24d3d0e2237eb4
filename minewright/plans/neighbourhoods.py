"""Nearest-neighbour queries: orders are the samples, suppliers and customers ask."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.functions import kernels
from minewright.operators import neighbors
from minewright.registry import Tables, plan
from minewright.session import cut


def _profile(lines, key, result):
    """Mean quantity, discount and tax of a key's line items as its input vector."""
    return (lines.groupBy(F.col(key).alias("id"))
            .agg(F.avg("l_quantity").alias("d0"), F.avg(F.round(F.col("l_discount") * 100)).alias("d1"),
                 F.avg(F.round(F.col("l_tax") * 100)).alias("d2"), result.alias("result"))
            .select("id", F.array("d0", "d1", "d2").alias("input"), "result"))


def _spent():
    return F.round(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")) / 1000000, 6)


def samples(t: Tables):
    return cut(_profile(t.lineitem, "l_orderkey", _spent()), "samples")


def questions(t: Tables):
    return _profile(t.lineitem, "l_suppkey", F.count("*")).select(F.col("id").alias("qid"), "input")


def shoppers(t: Tables):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return cut(_profile(lines, "o_custkey", _spent()), "shoppers")


VECTOR = "avg(l_quantity) AS d0, avg(round(l_discount * 100)) AS d1, avg(round(l_tax * 100)) AS d2"
PRICE = "round(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 1000000, 6) AS result"
D = "sqrt((q.d0 - s.d0) * (q.d0 - s.d0) + (q.d1 - s.d1) * (q.d1 - s.d1) + (q.d2 - s.d2) * (q.d2 - s.d2))"
NEAR = f"""samples AS (SELECT l_orderkey AS id, {VECTOR}, {PRICE} FROM lineitem GROUP BY l_orderkey),
questions AS (SELECT l_suppkey AS qid, {VECTOR} FROM lineitem GROUP BY l_suppkey),
near AS (
  SELECT qid, id, result, distance, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank
  FROM (SELECT q.qid, s.id, s.result, {D} AS distance FROM questions q CROSS JOIN samples s) QUALIFY rank <= 5)"""


def near(t: Tables, k: int):
    return neighbors.nearest(samples(t), questions(t), k, 3, ["qid"])


@plan("euclidean", """SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(embedding, nxt),
  lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))), 6) AS distance
FROM (SELECT a.vec_id, a.embedding, b.embedding AS nxt FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)""")
def euclidean(t: Tables):
    nxt = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("nxt"))
    return (t.embeddings.join(nxt, "vec_id")
            .select("vec_id", F.round(kernels.euclidean(F.col("embedding"), F.col("nxt")), 6).alias("distance")))


@plan("knn_distances", f"WITH {NEAR} SELECT qid, id, CAST(rank AS INT) AS rank, round(distance, 6) AS distance FROM near")
def knn_distances(t: Tables):
    return near(t, 5).select("qid", "id", "rank", F.round("distance", 6).alias("distance"))


@plan("knn_estimate", f"WITH {NEAR} SELECT qid, round(avg(result), 6) AS guess FROM near WHERE rank <= 3 GROUP BY qid")
def knn_estimate(t: Tables):
    return neighbors.estimate(near(t, 3), ["qid"]).withColumn("guess", F.round("guess", 6))


@plan("weight_fns", f"""WITH {NEAR}
SELECT qid, id, round(1 / (distance + 0.1), 6) AS inverse, round(greatest(1 - distance, 0), 6) AS subtract,
  round(exp(-(distance * distance) / 200), 6) AS gaussian FROM near""")
def weight_fns(t: Tables):
    d = F.col("distance")
    return near(t, 5).select("qid", "id", F.round(kernels.inverse_weight(d), 6).alias("inverse"),
                             F.round(kernels.subtract_weight(d), 6).alias("subtract"), F.round(kernels.gaussian(d), 6).alias("gaussian"))


@plan("weighted_knn", f"""WITH {NEAR}
SELECT qid, round(sum(exp(-(distance * distance) / 200) * result) / nullif(sum(exp(-(distance * distance) / 200)), 0), 6) AS guess
FROM near GROUP BY qid""")
def weighted_knn(t: Tables):
    return neighbors.weighted_estimate(near(t, 5), ["qid"]).withColumn("guess", F.round("guess", 6))


def held(row, trial, share):
    first = f"(({row} * 48271 + {trial} * 69621 + 1) % 2147483647)"
    return f"((({first} * {first}) % 2147483647) * 48271 + {first}) % 2147483647 < {int(share * 2147483647)}"


SHOPPERS = f"""shoppers AS (
  SELECT o_custkey AS id, {VECTOR}, {PRICE} FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)"""


def tested(trials, k, share, source="shoppers", by=""):
    same = "AND q.scale_id = s.scale_id" if by else ""
    return f"""tests AS (SELECT *, CAST(trial AS BIGINT) AS t FROM {source}, (SELECT unnest(range({trials})) AS trial) WHERE {held('id', 'trial', share)}),
met AS (
  SELECT {by} q.t AS trial, q.id, q.result AS actual, s.result, row_number() OVER (PARTITION BY {by} q.t, q.id ORDER BY {D}, s.id) AS rank
  FROM tests q JOIN {source} s ON NOT ({held('s.id', 'q.t', share)}) {same} QUALIFY rank <= {k}),
guesses AS (SELECT {by} trial, id, any_value(actual) AS actual, avg(result) AS guess FROM met GROUP BY {by} trial, id),
errors AS (SELECT {by} trial, avg((actual - guess) * (actual - guess)) AS error FROM guesses GROUP BY {by} trial)"""


@plan("split_train_test", f"WITH {SHOPPERS} SELECT id, {held('id', '0', 0.05)} AS test FROM shoppers")
def split_train_test(t: Tables):
    return neighbors.split(shoppers(t), 0).select("id", "test")


@plan("mse", f"WITH {SHOPPERS}, {tested(1, 3, 0.05)} SELECT round(error, 5) AS error FROM errors")
def mse(t: Tables):
    errors = neighbors.test_errors(shoppers(t), 1, 3)
    return neighbors.mean_squared(errors, ["trial"]).select(F.round("error", 5).alias("error"))


@plan("cross_validate", f"WITH {SHOPPERS}, {tested(100, 3, 0.05)} SELECT round(avg(error), 5) AS error FROM errors")
def cross_validate(t: Tables):
    return neighbors.cross_validate(shoppers(t), 3).withColumn("error", F.round("error", 5))


@plan("rescale", f"""WITH {SHOPPERS} SELECT id, round(d0 * 1, 6) AS s0, round(d1 * 4, 6) AS s1, round(d2 * 0.5, 6) AS s2 FROM shoppers""")
def rescale(t: Tables):
    bent = kernels.rescaled(F.col("input"), F.array(F.lit(1.0), F.lit(4.0), F.lit(0.5)))
    return shoppers(t).select("id", bent.alias("b")).select("id", *[F.round(F.col("b")[i], 6).alias(f"s{i}") for i in range(3)])


SCALES = [(0, [1.0, 1.0, 1.0]), (1, [0.0, 10.0, 1.0]), (2, [5.0, 0.0, 20.0]), (3, [20.0, 2.0, 0.0])]
SCALE_ROWS = ", ".join(f"({i}, {f[0]}::DOUBLE, {f[1]}::DOUBLE, {f[2]}::DOUBLE)" for i, f in SCALES)


@plan("scale_search", f"""WITH {SHOPPERS}, bent AS (
  SELECT scale_id, id, d0 * f0 AS d0, d1 * f1 AS d1, d2 * f2 AS d2, result
  FROM shoppers, (VALUES {SCALE_ROWS}) v(scale_id, f0, f1, f2)), {tested(10, 3, 0.05, 'bent', 'q.scale_id,').replace('SELECT q.scale_id, trial', 'SELECT scale_id, trial').replace('GROUP BY q.scale_id,', 'GROUP BY scale_id,')}
SELECT scale_id, round(avg(error), 5) AS error FROM errors GROUP BY scale_id""")
def scale_search(t: Tables):
    scales = t.spark.createDataFrame(SCALES, "scale_id INT, factors ARRAY<DOUBLE>")
    return neighbors.scale_search(shoppers(t), scales, 3).withColumn("error", F.round("error", 5))


@plan("knn_r2", f"""WITH {SHOPPERS}, {tested(1, 5, 0.07)}
SELECT count(*) AS tests, round(1 - sum((actual - guess) * (actual - guess)) / (var_pop(actual) * count(*)), 6) AS r2 FROM guesses""")
def knn_r2(t: Tables):
    return neighbors.r_squared(neighbors.test_errors(shoppers(t), 1, 3, k=5, share=0.07)).withColumn("r2", F.round("r2", 6))


HIGH = 50.0
W = "exp(-(distance * distance) / 200)"


@plan("prob_guess", f"""WITH {NEAR}
SELECT qid, round(coalesce(sum(CASE WHEN result >= 10 AND result <= 25 THEN {W} ELSE 0 END) / nullif(sum({W}), 0), 0), 6) AS prob
FROM near GROUP BY qid""")
def prob_guess(t: Tables):
    return neighbors.prob_guess(near(t, 5), ["qid"], 10.0, 25.0).withColumn("prob", F.round("prob", 6))


@plan("cumulative_prob", f"""WITH {NEAR}
SELECT qid, CAST(v AS INT) AS step_no,
  round(coalesce(sum(CASE WHEN result >= 0 AND result <= v * 0.1::DOUBLE THEN {W} ELSE 0 END) / nullif(sum({W}), 0), 0), 6) AS prob
FROM near, (SELECT unnest(range(500)) AS v) GROUP BY qid, v""")
def cumulative_prob(t: Tables):
    return neighbors.cumulative(near(t, 5), ["qid"], HIGH).withColumn("prob", F.round("prob", 6))


@plan("smoothed_prob", f"""WITH {NEAR}, bins AS (
  SELECT qid, v, sum(CASE WHEN result >= v * 0.1::DOUBLE AND result <= v * 0.1::DOUBLE + 0.1::DOUBLE THEN {W} ELSE 0 END) / nullif(sum({W}), 0) AS p
  FROM near, (SELECT unnest(range(500)) AS v) GROUP BY qid, v)
SELECT a.qid, CAST(a.v AS INT) AS bin, round(coalesce(sum(exp(-((abs(a.v - b.v) * 0.1::DOUBLE) ** 2) / 50) * b.p), 0), 6) AS prob
FROM bins a JOIN bins b ON a.qid = b.qid GROUP BY a.qid, a.v""")
def smoothed_prob(t: Tables):
    return neighbors.smoothed(near(t, 5), ["qid"], HIGH).withColumn("prob", F.round("prob", 6))
