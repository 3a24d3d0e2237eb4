"""Similarity and recommendation queries over customers and brands."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.operators import similarity as sim
from minewright.plans.bindings import NEIGHBOURS, PREFS, neighbours, prefs, stored_prefs
from minewright.registry import Tables, plan
from minewright.session import cut, laid_out

SHARED = f"""{PREFS}, {NEIGHBOURS}, met AS (
  SELECT p.a, p.b, x.item, x.rating AS x, y.rating AS y FROM pairs p
  JOIN prefs x ON x.person = p.a JOIN prefs y ON y.person = p.b AND y.item = x.item)"""

CENTERED = """CASE WHEN var_pop(x) > 1e-20 * avg(x * x) AND var_pop(y) > 1e-20 * avg(y * y)
  THEN covar_pop(x, y) / sqrt(var_pop(x) * var_pop(y)) END"""
PEARSON = """CASE WHEN var_pop(x) > 1e-20 * avg(x * x) AND var_pop(y) > 1e-20 * avg(y * y)
  THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END"""
OFFSET = 1e5
DISTANCE = "1 / (1 + sum((x - y) * (x - y)))"


def _pair_oracle(measure, shared=SHARED):
    return f"""WITH {shared}, scored AS (SELECT a, b, {measure} AS sim, true AS met FROM met GROUP BY a, b)
SELECT a, b, round(CASE WHEN met THEN sim ELSE 0 END, 6) AS sim FROM pairs LEFT JOIN scored USING (a, b)"""


def _rounded(df, column, digits=6):
    return df.withColumn(column, F.round(column, digits))


def _pair_query(t: Tables, measure, offset: float = 0.0):
    ratings = stored_prefs(t).withColumn("rating", F.col("rating") + offset)
    return _rounded(sim.similarity(ratings, neighbours(ratings), measure), "sim")


@plan("shared_items", f"WITH {SHARED} SELECT a, b, item FROM met")
def shared_items(t: Tables):
    ratings = stored_prefs(t)
    return sim.shared_items(ratings, neighbours(ratings)).select("a", "b", "item")


@plan("sim_distance", _pair_oracle(DISTANCE))
def sim_distance(t: Tables):
    return _pair_query(t, sim.distance_similarity)


@plan("sim_pearson", _pair_oracle(PEARSON))
def sim_pearson(t: Tables):
    return _pair_query(t, sim.pearson)


@plan("sim_pearson_offset", _pair_oracle(PEARSON, SHARED.replace("x.rating AS x, y.rating AS y", f"x.rating + {OFFSET} AS x, y.rating + {OFFSET} AS y")))
def sim_pearson_offset(t: Tables):
    """The same ratings on a scale that begins far from zero."""
    return _pair_query(t, sim.pearson, OFFSET)


@plan("sim_pearson_centered", _pair_oracle(CENTERED))
def sim_pearson_centered(t: Tables):
    return _pair_query(t, sim.pearson_centered)


@plan("transpose", f"WITH {PREFS} SELECT item AS person, person AS item, round(rating, 6) AS rating FROM prefs")
def transpose(t: Tables):
    return _rounded(sim.transpose(prefs(t)), "rating")


def _idlest(ratings):
    """The target: the person with the fewest rated items (most to recommend), lowest key on ties."""
    return (ratings.groupBy("person").agg(F.count("*").alias("n"))
            .orderBy("n", "person").limit(1).select("person"))


AGAINST = f"""{PREFS}, target AS (SELECT person FROM prefs GROUP BY person ORDER BY count(*), person LIMIT 1),
mine AS (SELECT item, rating AS x FROM prefs WHERE person = (SELECT person FROM target)),
met AS (SELECT p.person AS other, x, rating AS y FROM prefs p JOIN mine USING (item) WHERE p.person <> (SELECT person FROM target)),
scored AS (SELECT other, {CENTERED} AS sim, true AS met FROM met GROUP BY other),
sims AS (
  SELECT o.other, CASE WHEN met THEN sim ELSE 0 END AS sim
  FROM (SELECT DISTINCT person AS other FROM prefs WHERE person <> (SELECT person FROM target)) o LEFT JOIN scored USING (other))"""


@plan("top_matches", f"""WITH {AGAINST}
SELECT other, round(sim, 6) AS sim FROM sims ORDER BY round(sims.sim, 6) DESC NULLS LAST, other DESC LIMIT 5""")
def top_matches(t: Tables):
    ratings = stored_prefs(t)
    return sim.top_matches(ratings, _idlest(ratings), 5, lambda x, y: F.round(sim.pearson_centered(x, y), 6))


@plan("recommend_user", f"""WITH {AGAINST}
SELECT item, round(sum(rating * sim) / sum(sim), 6) AS score FROM prefs JOIN sims ON person = other
WHERE sim > 0 AND item NOT IN (SELECT item FROM mine WHERE x <> 0) GROUP BY item""")
def recommend_user(t: Tables):
    ratings = stored_prefs(t)
    return _rounded(sim.recommendations(ratings, _idlest(ratings)), "score")


MATCHES = f"""{PREFS}, scored AS (
  SELECT p.item AS item, q.item AS other, round(1 / (1 + sum((p.rating - q.rating) * (p.rating - q.rating))), 12) AS sim
  FROM prefs p JOIN prefs q ON p.person = q.person AND p.item <> q.item GROUP BY p.item, q.item),
matches AS (
  SELECT item, other, sim, row_number() OVER (PARTITION BY item ORDER BY sim DESC, other DESC) AS rank FROM scored
  QUALIFY rank <= 10)"""


def _matches(ratings):
    return sim.similar_items(ratings, 10, lambda x, y: F.round(sim.distance_similarity(x, y), 12))


@plan("similar_items", f"WITH {MATCHES} SELECT item, other, sim, CAST(rank AS INT) AS rank FROM matches")
def similar_items(t: Tables):
    return _matches(prefs(t))


@plan("recommend_item", f"""WITH {MATCHES}
SELECT p.person, m.other AS item, round(sum(m.sim * p.rating) / sum(m.sim), 6) AS score
FROM prefs p JOIN matches m ON p.item = m.item
WHERE NOT EXISTS (SELECT 1 FROM prefs r WHERE r.person = p.person AND r.item = m.other)
GROUP BY p.person, m.other""")
def recommend_item(t: Tables):
    """The ratings lie by person, so that what a person is reached by is summed in place."""
    ratings = laid_out(prefs(t), ["person"], "prefs")
    return _rounded(sim.recommended_items(ratings, cut(_matches(ratings), "matches")), "score")
