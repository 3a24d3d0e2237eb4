"""Click-feedback queries: shoppers' segment and priority are the words, suppliers the urls."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from minewright.operators import feedback
from minewright.registry import Tables, plan
from minewright.session import cut


class Log:
    """The click log summed up per distinct query: its words, its results and the most used result."""

    def __init__(self, t: Tables):
        lines = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
                 .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
                 .select((100 + F.ascii("c_mktsegment")).cast("long").alias("segment"),
                         F.substring("o_orderpriority", 1, 1).cast("long").alias("priority"),
                         F.col("l_suppkey").alias("url_id")))
        used = cut(lines.withColumn("query_id", F.col("segment") * 1000 + F.col("priority"))
                   .groupBy("query_id", "segment", "priority", "url_id").agg(F.count("*").alias("n")), "log")
        self.queries = cut(used.select("query_id", F.explode(F.array("segment", "priority")).alias("word_id")).distinct(), "queries")
        self.results = used.select("query_id", "url_id")
        self.clicked = used.groupBy("query_id").agg(F.min_by("url_id", F.struct(-F.col("n"), "url_id")).alias("url_id"))

    @cached_property
    def net(self):
        """The connections before training, worked out when a query first needs them."""
        net = feedback.hidden_nodes(self.queries, self.results)
        return feedback.Network(cut(net.word_hidden, "weights"), cut(net.hidden_url, "weights"))


LOG = """used AS (
  SELECT segment * 1000 + priority AS query_id, segment, priority, url_id, count(*) AS n FROM (
    SELECT CAST(100 + ascii(c_mktsegment) AS BIGINT) AS segment, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority, l_suppkey AS url_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey) GROUP BY ALL),
queries AS (SELECT DISTINCT query_id, unnest([segment, priority]) AS word_id FROM used),
results AS (SELECT query_id, url_id FROM used),
clicked AS (SELECT query_id, url_id FROM used QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, url_id) = 1),
keys AS (
  SELECT query_id, string_agg(CAST(word_id AS VARCHAR), '_' ORDER BY CAST(word_id AS VARCHAR)) AS node, count(*) AS words
  FROM queries GROUP BY query_id HAVING count(*) <= 3),
word_hidden AS (SELECT DISTINCT word_id, node, 1.0::DOUBLE / words AS strength FROM queries JOIN keys USING (query_id)),
hidden_url AS (SELECT DISTINCT node, url_id, 0.1::DOUBLE AS strength FROM results JOIN keys USING (query_id)),
touched AS (
  SELECT query_id, node FROM queries JOIN word_hidden USING (word_id)
  UNION SELECT query_id, node FROM results JOIN hidden_url USING (url_id)),
hidden AS (
  SELECT t.query_id, t.node, tanh(sum(coalesce(w.strength, -0.2))) AS active FROM touched t
  JOIN queries q USING (query_id) LEFT JOIN word_hidden w ON w.word_id = q.word_id AND w.node = t.node GROUP BY t.query_id, t.node),
outputs AS (
  SELECT r.query_id, r.url_id, tanh(sum(h.active * coalesce(u.strength, 0))) AS output FROM results r
  JOIN hidden h USING (query_id) LEFT JOIN hidden_url u ON u.node = h.node AND u.url_id = r.url_id GROUP BY r.query_id, r.url_id),
delta_out AS (
  SELECT o.query_id, o.url_id, (1 - output * output) * ((CASE WHEN c.url_id IS NULL THEN 0 ELSE 1 END) - output) AS delta
  FROM outputs o LEFT JOIN clicked c USING (query_id, url_id)),
delta_in AS (
  SELECT h.query_id, h.node, (1 - any_value(active) * any_value(active)) * sum(d.delta * coalesce(u.strength, 0)) AS delta
  FROM hidden h JOIN delta_out d USING (query_id) LEFT JOIN hidden_url u ON u.node = h.node AND u.url_id = d.url_id GROUP BY h.query_id, h.node)"""


@plan("hidden_nodes", f"""WITH {LOG}
SELECT 'in' AS layer, node, word_id AS other, round(strength, 6) AS strength FROM word_hidden
UNION ALL SELECT 'out', node, url_id, strength FROM hidden_url""")
def hidden_nodes(t: Tables):
    return _layers(Log(t).net)


def _layers(net):
    return (net.word_hidden.select(F.lit("in").alias("layer"), "node", F.col("word_id").alias("other"), F.round("strength", 6).alias("strength"))
            .unionByName(net.hidden_url.select(F.lit("out").alias("layer"), "node", F.col("url_id").alias("other"),
                                               F.round("strength", 6).alias("strength"))))


@plan("hidden_for_query", f"WITH {LOG} SELECT query_id, node FROM touched")
def hidden_for_query(t: Tables):
    log = Log(t)
    return feedback.hidden_for_query(log.queries, log.results, log.net)


@plan("click_forward", f"WITH {LOG} SELECT query_id, url_id, round(output, 6) AS output FROM outputs")
def click_forward(t: Tables):
    log = Log(t)
    return feedback.forward(log.queries, log.results, log.net).withColumn("output", F.round("output", 6))


@plan("click_backprop", f"""WITH {LOG}
SELECT 'in' AS layer, node, word_id AS other, round(coalesce(any_value(w.strength), -0.2) + sum(0.5 * d.delta), 6) AS strength
FROM delta_in d JOIN queries q USING (query_id) LEFT JOIN word_hidden w USING (word_id, node) GROUP BY node, word_id
UNION ALL
SELECT 'out', h.node, d.url_id, round(coalesce(any_value(u.strength), 0) + sum(0.5 * d.delta * h.active), 6)
FROM hidden h JOIN delta_out d USING (query_id) LEFT JOIN hidden_url u ON u.node = h.node AND u.url_id = d.url_id GROUP BY h.node, d.url_id""")
def click_backprop(t: Tables):
    log = Log(t)
    return _layers(feedback.backward(log.queries, log.results, log.clicked, log.net))


@plan("click_train")
def click_train(t: Tables):
    log = Log(t)
    return _layers(feedback.train(log.queries, log.results, log.clicked, passes=3))


@plan("score_click", f"""WITH {LOG}
SELECT query_id, url_id, round(output / (CASE WHEN top = 0 THEN 0.00001 ELSE top END), 6) AS score
FROM outputs JOIN (SELECT query_id, max(output) AS top FROM outputs GROUP BY query_id) USING (query_id)""")
def score_click(t: Tables):
    log = Log(t)
    scores = feedback.click_scores(feedback.forward(log.queries, log.results, log.net))
    return scores.withColumn("score", F.round("score", 6))
