"""Linear and kernel classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.functions import kernels, text
from minewright.operators import kernel_means, learners, margin
from minewright.plans.neighbourhoods import questions
from minewright.plans.texts import INTERESTS, interests
from minewright.registry import Tables, plan


def vectors(t: Tables):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("data"), (F.col("label") % 2).alias("match"))


VECTORS = """cells AS (
  SELECT vec_id AS id, label % 2 AS match, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS v FROM embeddings),
means AS (SELECT match, dim, avg(v) AS mean FROM cells GROUP BY match, dim)"""


@plan("class_means", f"WITH {VECTORS} SELECT match, CAST(dim AS INT) AS dim, round(mean, 6) AS mean FROM means")
def class_means(t: Tables):
    means = margin.mean_vectors(vectors(t), "match")
    return means.select("match", F.posexplode("mean").alias("dim", "mean")).withColumn("mean", F.round("mean", 6))


NEXT = """pair_cells AS (SELECT a.id, sum(a.v * b.v) AS dot, sum((a.v - b.v) * (a.v - b.v)) AS gap, sum(a.v * a.v) AS len
  FROM cells a JOIN cells b ON b.id = a.id + 1 AND b.dim = a.dim GROUP BY a.id)"""


def _with_next(t: Tables):
    rows = vectors(t)
    return rows.join(rows.select((F.col("id") - 1).alias("id"), F.col("data").alias("nxt")), "id")


@plan("dot_product", f"WITH {VECTORS}, {NEXT} SELECT id, round(dot, 6) AS dot, round(len, 6) AS len FROM pair_cells")
def dot_product(t: Tables):
    return _with_next(t).select("id", F.round(kernels.dot(F.col("data"), F.col("nxt")), 6).alias("dot"),
                                F.round(kernels.squared_length(F.col("data")), 6).alias("len"))


@plan("rbf", f"WITH {VECTORS}, {NEXT} SELECT id, round(exp(-0.05 * gap), 6) AS kernel FROM pair_cells")
def rbf(t: Tables):
    return _with_next(t).select("id", F.round(kernels.rbf(F.col("data"), F.col("nxt"), 0.05), 6).alias("kernel"))


@plan("dp_classify", f"""WITH {VECTORS}
SELECT id, CASE WHEN sum(v * m0.mean) - sum(v * m1.mean) + (sum(m1.mean * m1.mean) - sum(m0.mean * m0.mean)) / 2 > 0 THEN 0 ELSE 1 END AS match
FROM cells JOIN means m0 ON m0.dim = cells.dim AND m0.match = 0 JOIN means m1 ON m1.dim = cells.dim AND m1.match = 1 GROUP BY id""")
def dp_classify(t: Tables):
    rows = vectors(t)
    return margin.dp_classify(rows, margin.mean_vectors(rows, "match"))


@plan("numeric_features", f"""WITH {INTERESTS}, people AS (
  SELECT c_custkey AS person, CAST(c_nationkey + 20 AS DOUBLE) AS age, CASE WHEN c_acctbal >= 5000 THEN 'yes' WHEN c_acctbal < 0 THEN 'no' ELSE '' END AS smokes,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'yes' WHEN 'MACHINERY' THEN 'no' ELSE '' END AS children, interests, c_nationkey AS place
  FROM customer JOIN interests ON person = c_custkey),
yn AS (SELECT *, CASE smokes WHEN 'yes' THEN 1 WHEN 'no' THEN -1 ELSE 0 END AS s, CASE children WHEN 'yes' THEN 1 WHEN 'no' THEN -1 ELSE 0 END AS c FROM people)
SELECT a.person AS id, a.age AS age_a, CAST(a.s AS BIGINT) AS smokes_a, CAST(a.c AS BIGINT) AS children_a, b.age AS age_b, CAST(b.s AS BIGINT) AS smokes_b,
  CAST(b.c AS BIGINT) AS children_b,
  CAST(len(list_filter(string_split(a.interests, ':'), lambda v: list_contains(string_split(b.interests, ':'), v))) AS BIGINT) AS shared,
  CAST(abs(a.place - b.place) AS BIGINT) AS distance
FROM yn a JOIN yn b ON b.person = a.person + 1""")
def numeric_features(t: Tables):
    people = t.customer.join(interests(t), F.col("c_custkey") == F.col("person")).select(
        "person", (F.col("c_nationkey") + 20).cast("double").alias("age"),
        text.yes_no(F.when(F.col("c_acctbal") >= 5000, "yes").when(F.col("c_acctbal") < 0, "no").otherwise("")).alias("smokes"),
        text.yes_no(F.when(F.col("c_mktsegment") == "HOUSEHOLD", "yes").when(F.col("c_mktsegment") == "MACHINERY", "no").otherwise("")).alias("children"),
        "interests", F.col("c_nationkey").alias("place"))
    left = people.select(F.col("person").alias("id"), *[F.col(c).alias(f"{c}_a") for c in people.columns[1:]])
    right = people.select((F.col("person") - 1).alias("id"), *[F.col(c).alias(f"{c}_b") for c in people.columns[1:]])
    return left.join(right, "id").select(
        "id", "age_a", "smokes_a", "children_a", "age_b", "smokes_b", "children_b",
        text.match_count(F.col("interests_a"), F.col("interests_b")).alias("shared"),
        F.abs(F.col("place_a") - F.col("place_b")).cast("long").alias("distance"))


@plan("minmax_scale", f"""WITH {VECTORS}, b AS (SELECT dim, min(v) AS low, max(v) AS high FROM cells GROUP BY dim)
SELECT id, CAST(dim AS INT) AS dim, round(coalesce((v - low) / nullif(high - low, 0), 0), 6) AS v FROM cells JOIN b USING (dim)""")
def minmax_scale(t: Tables):
    return (margin.minmax_scale(vectors(t)).select("id", F.posexplode("data").alias("dim", "v"))
            .withColumn("v", F.round("v", 6)))


GAMMA = 10.0


def line_vectors(t: Tables):
    """Every line item as a point; the class says whether it was returned."""
    return t.lineitem.select(
        F.array("l_quantity", F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)).alias("data"),
        (F.col("l_returnflag") == "R").cast("int").alias("match"))


KINDS = """kinds AS (
  SELECT l_quantity AS d0, round(l_discount * 100) AS d1, round(l_tax * 100) AS d2, (l_returnflag = 'R')::INT AS match, count(*) AS n FROM lineitem GROUP BY ALL),
sizes AS (SELECT sum(n) FILTER (match = 0) AS n0, sum(n) FILTER (match = 1) AS n1 FROM kinds),
pair_sums AS (
  SELECT a.match, sum(a.n * b.n * exp(-10 * ((a.d0 - b.d0) * (a.d0 - b.d0) + (a.d1 - b.d1) * (a.d1 - b.d1) + (a.d2 - b.d2) * (a.d2 - b.d2)))) AS s
  FROM kinds a JOIN kinds b ON a.match = b.match GROUP BY a.match),
shift AS (
  SELECT (SELECT s FROM pair_sums WHERE match = 1) / (n1 * n1) - (SELECT s FROM pair_sums WHERE match = 0) / (n0 * n0) AS off FROM sizes)"""


@plan("rbf_offset", f"WITH {KINDS} SELECT round(off * 1000000, 6) AS micro_offset FROM shift")
def rbf_offset(t: Tables):
    return margin.rbf_offset(line_vectors(t), GAMMA, 3).select(F.round(F.col("offset") * 1000000, 6).alias("micro_offset"))


@plan("rbf_classify", f"""WITH {KINDS}, q AS (
  SELECT l_suppkey AS id, avg(l_quantity) AS d0, avg(round(l_discount * 100)) AS d1, avg(round(l_tax * 100)) AS d2 FROM lineitem GROUP BY l_suppkey),
k AS (
  SELECT id, match, n * exp(-10 * ((q.d0 - s.d0) * (q.d0 - s.d0) + (q.d1 - s.d1) * (q.d1 - s.d1) + (q.d2 - s.d2) * (q.d2 - s.d2))) AS w FROM q, kinds s)
SELECT id, CASE WHEN sum(CASE WHEN match = 0 THEN w ELSE 0 END) / any_value(n0) - sum(CASE WHEN match = 1 THEN w ELSE 0 END) / any_value(n1) + any_value(off) > 0
  THEN 0 ELSE 1 END AS match FROM k, sizes, shift GROUP BY id""")
def rbf_classify(t: Tables):
    rows = line_vectors(t)
    points = questions(t).select(F.col("qid").alias("id"), F.col("input").alias("point"))
    return margin.rbf_classify(points, rows, margin.rbf_offset(rows, GAMMA, 3), GAMMA, 3)


FEATURES = 256


def scaled_vectors(t: Tables):
    """The same line items with every column on 0..1, where no kernel sum vanishes."""
    return margin.minmax_scale(line_vectors(t))


def scaled_questions(t: Tables):
    """Mean scaled line item of every supplier."""
    lines = t.lineitem.select("l_suppkey", F.array("l_quantity", F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)).alias("data"))
    data = margin.minmax_scale(lines)
    return data.groupBy(F.col("l_suppkey").alias("id")).agg(F.array(*[F.avg(F.get("data", F.lit(i))) for i in range(3)]).alias("point"))


def means_oracle() -> str:
    """The features and class means spelled out: the frequencies and phases are numbers of the query."""
    frequencies, phases = kernel_means.waves(3, FEATURES, GAMMA)
    params = ", ".join(f"({k}, {w[0]!r}::DOUBLE, {w[1]!r}::DOUBLE, {w[2]!r}::DOUBLE, {b!r}::DOUBLE)" for k, (w, b) in enumerate(zip(frequencies.tolist(), phases.tolist())))
    feature = f"sqrt(2.0::DOUBLE / {FEATURES}) * cos(w0 * d0 + w1 * d1 + w2 * d2 + b)"
    scaled = ", ".join(f"(x{i} - (SELECT min(x{i}) FROM raw)) / (SELECT max(x{i}) - min(x{i}) FROM raw) AS d{i}" for i in range(3))
    return f"""waves(k, w0, w1, w2, b) AS (VALUES {params}),
raw AS MATERIALIZED (SELECT l_suppkey, l_quantity::DOUBLE AS x0, round(l_discount * 100)::DOUBLE AS x1, round(l_tax * 100)::DOUBLE AS x2, (l_returnflag = 'R')::INT AS match FROM lineitem),
unit AS MATERIALIZED (SELECT l_suppkey, match, {scaled} FROM raw),
kinds AS MATERIALIZED (SELECT d0, d1, d2, match, count(*) AS n FROM unit GROUP BY ALL),
mu AS MATERIALIZED (SELECT match, k, sum(n * {feature}) / sum(n) AS m FROM kinds, waves GROUP BY match, k),
shift AS (SELECT sum(CASE WHEN match = 1 THEN m * m ELSE -m * m END) AS off FROM mu),
asked AS MATERIALIZED (SELECT l_suppkey AS id, avg(d0) AS d0, avg(d1) AS d1, avg(d2) AS d2 FROM unit GROUP BY l_suppkey),
margins AS (SELECT id, sum({feature} * CASE WHEN match = 0 THEN m ELSE -m END) + any_value(off) AS margin FROM asked, waves JOIN mu USING (k), shift GROUP BY id)"""


@plan("rbf_mean_offset", f"WITH {means_oracle()} SELECT round(off, 6) AS mean_offset FROM shift")
def rbf_mean_offset(t: Tables):
    means = kernel_means.class_means(scaled_vectors(t), GAMMA, FEATURES)
    return t.spark.range(1).select(F.round(F.lit(kernel_means.offset(means)), 6).alias("mean_offset"))


@plan("rbf_mean_classify", f"WITH {means_oracle()} SELECT id, round(margin, 6) AS margin, CASE WHEN margin > 0 THEN 0 ELSE 1 END AS match FROM margins")
def rbf_mean_classify(t: Tables):
    means = kernel_means.class_means(scaled_vectors(t), GAMMA, FEATURES)
    return kernel_means.classify(scaled_questions(t), means, GAMMA, FEATURES).withColumn("margin", F.round("margin", 6))


@plan("rff_svm")
def rff_svm(t: Tables):
    """Scored on the held-out line items of a pattern no single plane can separate."""
    many, cheap = F.col("l_quantity") >= 26, F.col("l_discount") >= 0.05
    rows = t.lineitem.select(
        F.array("l_quantity", F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)).alias("data"), (many == cheap).cast("int").alias("match"),
        (F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(20)) == 0).alias("test"))
    rows = margin.minmax_scale(rows)
    predict = learners.kernel_machine(rows.where("NOT test"), 3, gamma=2.0)
    asked = rows.where("test").groupBy("data", "match").agg(F.count("*").alias("n"))
    return predict(asked).groupBy("match", "prediction").agg(F.sum("n").alias("n"))
