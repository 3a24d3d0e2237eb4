"""Matrix factorisation and topics: articles by words, months by brands."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.operators import factor
from minewright.plans.bindings import articles
from minewright.plans.texts import ARTICLES, TFIDF, article_counts, tfidf_weights
from minewright.registry import Tables, plan
from minewright.session import cut


def volumes(t: Tables):
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("p_brand").alias("ticker"), F.date_format("l_shipdate", "yyyy-MM").alias("date"))
            .agg(F.sum("l_quantity").alias("volume")))


VOLUMES = """volumes AS (
  SELECT p_brand AS ticker, strftime(l_shipdate, '%Y-%m') AS date, sum(l_quantity) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
aligned AS (
  SELECT * FROM volumes WHERE date IN (
    SELECT date FROM volumes GROUP BY date HAVING count(DISTINCT ticker) = (SELECT count(DISTINCT ticker) FROM volumes)))"""


def volume_cells(t: Tables):
    return factor.aligned(volumes(t), "ticker", "date").select(F.col("date").alias("i"), F.col("ticker").alias("j"), F.col("volume").alias("v"))


@plan("volume_matrix", f"WITH {VOLUMES} SELECT date, ticker, volume FROM aligned")
def volume_matrix(t: Tables):
    return factor.aligned(volumes(t), "ticker", "date").select("date", "ticker", "volume")


def rounds_oracle(source, k, rounds=1):
    """``w{rounds}`` and ``h{rounds}`` in long form: the updates spelled out round by round over one list per key."""
    def unit(key, side):
        return "[" + ", ".join(f"(('0x' || substr(md5({key} || '-{side}{a}'), 1, 7))::BIGINT + 1) / 268435457.0::DOUBLE" for a in range(k)) + "]"

    def gram(side):
        return "[" + ", ".join("[" + ", ".join(f"sum({side}[{min(a, b)}] * {side}[{max(a, b)}])" for b in range(1, k + 1)) + "]" for a in range(1, k + 1)) + "]"

    def update(n, fixed, moved, key, other, fixed_round, moved_round):
        pull = ", ".join(f"sum(v * {fixed}[{a}])" for a in range(1, k + 1))
        fresh = ", ".join(f"coalesce({moved}[{a}] * p[{a}] / nullif(list_inner_product({moved}, g[{a}]), 0), 0)" for a in range(1, k + 1))
        return f"""{moved}s{n} AS MATERIALIZED (
  SELECT {key}, [{fresh}] AS {moved} FROM {moved}s{moved_round} JOIN (
    SELECT {key}, [{pull}] AS p FROM m JOIN {fixed}s{fixed_round} USING ({other}) GROUP BY {key}) USING ({key}),
    (SELECT {gram(fixed)} AS g FROM {fixed}s{fixed_round}))"""

    parts = [f"""m AS MATERIALIZED ({source}),
ws0 AS MATERIALIZED (SELECT i, {unit('i', 'w')} AS w FROM (SELECT DISTINCT i FROM m)),
hs0 AS MATERIALIZED (SELECT j, {unit('j', 'h')} AS h FROM (SELECT DISTINCT j FROM m))"""]
    for n in range(1, rounds + 1):
        parts += [update(n, "w", "h", "j", "i", n - 1, n - 1), update(n, "h", "w", "i", "j", n, n - 1)]
    parts.append(f"""w{rounds} AS (SELECT i, generate_subscripts(w, 1) - 1 AS a, unnest(w) AS w FROM ws{rounds}),
h{rounds} AS (SELECT j, generate_subscripts(h, 1) - 1 AS a, unnest(h) AS h FROM hs{rounds})""")
    return ",\n".join(parts)


VOLUME_CELLS = "SELECT date AS i, ticker AS j, volume AS v FROM aligned"
VOLUME_STEP = f"{VOLUMES}, {rounds_oracle(VOLUME_CELLS, 5)}"
VOLUME_ROUNDS = f"{VOLUMES}, {rounds_oracle(VOLUME_CELLS, 5, 50)}"


def first_step(cells, k):
    cells = cut(cells, "matrix")
    w, h = factor.start(cells, "i", "w", k), factor.start(cells, "j", "h", k)
    w, h = factor.step(cells, cut(w, "w"), cut(h, "h"), k)
    return cells, cut(w, "w"), cut(h, "h")


@plan("nmf_step", f"""WITH {VOLUME_STEP}
SELECT 'w' AS side, i AS key, CAST(a AS INT) AS factor, round(w, 6) AS weight FROM w1
UNION ALL SELECT 'h', j, CAST(a AS INT), round(h, 6) FROM h1""")
def nmf_step(t: Tables):
    _, w, h = first_step(volume_cells(t), 5)
    return _sides(w, h).withColumn("weight", F.round("weight", 6))


def _sides(w, h):
    return (factor.long(w, "i", "w").select(F.lit("w").alias("side"), F.col("i").cast("string").alias("key"), "factor", "weight")
            .unionByName(factor.long(h, "j", "h").select(F.lit("h").alias("side"), F.col("j").alias("key"), "factor", "weight")))


@plan("nmf_cost", f"""WITH {VOLUME_STEP}
SELECT round(sum((coalesce(v, 0) - wh) * (coalesce(v, 0) - wh)), 2) AS cost
FROM (SELECT i, j, sum(w * h) AS wh FROM w1 JOIN h1 USING (a) GROUP BY i, j) LEFT JOIN m USING (i, j)""")
def nmf_cost(t: Tables):
    cells, w, h = first_step(volume_cells(t), 5)
    return factor.cost(cells, w, h, 5).select(F.round("cost", 2).alias("cost"))


def article_cells(t: Tables):
    return article_counts(t).select(F.col("doc_id").alias("i"), F.col("word").alias("j"), F.col("n").alias("v"))


def titles(t: Tables):
    return articles(t).select(F.col("doc_id").alias("i"), "title")


TOPICS = 10
ARTICLE_ROUNDS = f"""{ARTICLES}, {rounds_oracle('SELECT doc_id AS i, word AS j, n::DOUBLE AS v FROM article_matrix', TOPICS, 50)},
top_words AS (
  SELECT a, string_agg(j, ' ' ORDER BY rank) AS words FROM (
    SELECT a, j, row_number() OVER (PARTITION BY a ORDER BY h DESC, j DESC) AS rank FROM h50) WHERE rank <= 6 GROUP BY a),
titled AS (SELECT title, a, w FROM w50 JOIN articles ON doc_id = i)"""


def finished_topics(t: Tables):
    """W and H of the articles after all rounds, computed by every query that reports topics."""
    return factor.factorize(article_cells(t), TOPICS)


@plan("nmf", f"""WITH {ARTICLE_ROUNDS}
SELECT 'w' AS side, i::VARCHAR AS key, CAST(a AS INT) AS factor, round(w, 4) AS weight FROM w50
UNION ALL SELECT 'h', j, CAST(a AS INT), round(h, 4) FROM h50""")
def nmf(t: Tables):
    return _sides(*finished_topics(t)).withColumn("weight", F.round("weight", 4))


@plan("topic_words", f"WITH {ARTICLE_ROUNDS} SELECT CAST(a AS INT) AS factor, words FROM top_words")
def topic_words(t: Tables):
    return factor.topic_words(finished_topics(t)[1])


@plan("topic_titles", f"""WITH {ARTICLE_ROUNDS}
SELECT CAST(a AS INT) AS factor, CAST(rank AS INT) AS rank, title, round(w, 4) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY w DESC, title DESC) AS rank FROM titled) WHERE rank <= 3""")
def topic_titles(t: Tables):
    w, _ = finished_topics(t)
    return factor.topic_titles(w, titles(t)).withColumn("weight", F.round("weight", 4))


@plan("article_topics", f"""WITH {ARTICLE_ROUNDS}
SELECT title, CAST(rank AS INT) AS rank, round(w, 4) AS weight, words FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY w DESC, a DESC) AS rank FROM titled) JOIN top_words USING (a) WHERE rank <= 3""")
def article_topics(t: Tables):
    w, h = finished_topics(t)
    return factor.article_topics(w, h, titles(t)).withColumn("weight", F.round("weight", 4))


@plan("tfidf_topics", f"""WITH {TFIDF}, {rounds_oracle('SELECT doc_id AS i, word AS j, weight AS v FROM tfidf', TOPICS, 50)}
SELECT CAST(a AS INT) AS factor, CAST(rank AS INT) AS rank, j, round(h, 4) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY h DESC, j DESC) AS rank FROM h50) WHERE rank <= 20""")
def tfidf_topics(t: Tables):
    cells = tfidf_weights(t).select(F.col("doc_id").alias("i"), F.col("word").alias("j"), F.col("weight").alias("v"))
    _, h = factor.factorize(cells, TOPICS)
    return factor.top_keys(h, "j", "h", 20).withColumn("weight", F.round("weight", 4))


@plan("volume_factors", f"""WITH {VOLUME_ROUNDS}
SELECT CAST(a AS INT) AS factor, 'ticker' AS side, CAST(rank AS INT) AS rank, j AS key, round(h, 4) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY h DESC, j DESC) AS rank FROM h50) WHERE rank <= 12
UNION ALL SELECT CAST(a AS INT), 'date', CAST(rank AS INT), i, round(w, 4) FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY w DESC, i DESC) AS rank FROM w50) WHERE rank <= 3""")
def volume_factors(t: Tables):
    """Per factor the twelve strongest brands and the three strongest months."""
    w, h = factor.factorize(volume_cells(t), 5)
    brands = factor.top_keys(h, "j", "h", 12).select("factor", F.lit("ticker").alias("side"), "rank", F.col("j").alias("key"), "weight")
    months = factor.top_keys(w, "i", "w", 3).select("factor", F.lit("date").alias("side"), "rank", F.col("i").alias("key"), "weight")
    return brands.unionByName(months).withColumn("weight", F.round("weight", 4))
