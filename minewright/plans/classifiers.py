"""Text classification of the documents, trained on the quality labels."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from minewright.operators import bayes
from minewright.plans.bindings import LABELLED, labelled
from minewright.registry import Tables, plan
from minewright.session import cut, scratch_path
from minewright.streaming.classify import run_parts

MODEL = rf"""{LABELLED}, words AS (
  SELECT DISTINCT doc_id, lower(w) AS feature FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '\W+')) AS w FROM documents) WHERE length(w) BETWEEN 3 AND 19),
fc AS (SELECT feature, category, count(*) AS n FROM words JOIN labelled USING (doc_id) GROUP BY feature, category),
cc AS (SELECT category, count(*) AS n FROM labelled GROUP BY category),
totals AS (SELECT feature, sum(n) AS total FROM fc GROUP BY feature),
fprob AS (SELECT feature, category, fc.n / cc.n AS prob FROM fc JOIN cc USING (category)),
cprob AS (SELECT feature, category, prob / sum(prob) OVER (PARTITION BY feature) AS prob FROM fprob),
weighted AS (
  SELECT feature, category, (0.5 + total * coalesce(f.prob, 0)) / (1 + total) AS prob, (0.5 + total * coalesce(c.prob, 0)) / (1 + total) AS shared
  FROM totals CROSS JOIN (SELECT category FROM cc) LEFT JOIN fprob f USING (feature, category) LEFT JOIN cprob c USING (feature, category)),
sums AS (
  SELECT d.doc_id, cc.category, cc.n, count(w.feature) AS features,
    coalesce(sum(ln(coalesce(p.prob, 0.5))) FILTER (w.feature IS NOT NULL), 0) AS logs,
    coalesce(sum(ln(coalesce(p.shared, 0.5))) FILTER (w.feature IS NOT NULL), 0) AS shared_logs
  FROM documents d CROSS JOIN cc LEFT JOIN words w USING (doc_id)
  LEFT JOIN weighted p ON p.feature = w.feature AND p.category = cc.category GROUP BY d.doc_id, cc.category, cc.n),
nb AS (SELECT doc_id, category, logs + ln(n / (SELECT sum(n) FROM cc)) AS log_prob FROM sums),
fisher AS (
  SELECT doc_id, category, CASE WHEN features = 0 THEN 1 ELSE (
    SELECT least(sum(exp(shared_logs + i * ln(-shared_logs) - lgamma(i + 1))), 1) FROM (SELECT unnest(range(0, features)) AS i)) END AS prob
  FROM sums)"""


class Setup:
    """The model, worked out when a query first needs it, and the documents' words, which a query reads in one pass."""

    def __init__(self, t: Tables):
        self.tables = t
        self.docs = t.documents.select("doc_id", "text")

    @cached_property
    def model(self):
        trained = bayes.train(labelled(self.tables))
        return bayes.Model(cut(trained.features, "features"), cut(trained.categories, "categories"))

    @property
    def features(self):
        return bayes.document_features(self.docs)

    def nb(self):
        return bayes.log_probabilities(self.features, self.docs, self.model)

    def fisher(self):
        return bayes.fisher_probabilities(self.features, self.docs, self.model)


def _prob(df, column="prob"):
    return df.withColumn(column, F.round(column, 6))


@plan("nb_feature_counts", f"WITH {MODEL} SELECT feature, category, n FROM fc")
def nb_feature_counts(t: Tables):
    return bayes.train(labelled(t)).features


@plan("nb_category_counts", f"WITH {LABELLED} SELECT category, count(*) AS n FROM labelled GROUP BY category")
def nb_category_counts(t: Tables):
    return bayes.train(labelled(t)).categories


@plan("nb_fprob", f"WITH {MODEL} SELECT feature, category, round(prob, 6) AS prob FROM fprob")
def nb_fprob(t: Tables):
    return _prob(bayes.feature_probabilities(bayes.train(labelled(t))))


@plan("nb_weighted", f"WITH {MODEL} SELECT feature, category, round(prob, 6) AS prob FROM weighted")
def nb_weighted(t: Tables):
    return _prob(bayes.weighted_probabilities(Setup(t).model))


@plan("nb_prob", f"WITH {MODEL} SELECT doc_id, category, round(log_prob, 6) AS log_prob FROM nb")
def nb_prob(t: Tables):
    return _prob(Setup(t).nb(), "log_prob")


@plan("nb_classify", f"""WITH {MODEL}, ranked AS (
  SELECT *, row_number() OVER w AS rank, lead(log_prob) OVER w AS second FROM nb
  WINDOW w AS (PARTITION BY doc_id ORDER BY log_prob DESC, category))
SELECT doc_id, CASE WHEN coalesce(second + ln(CASE category WHEN 'good' THEN 3 ELSE 1 END) > log_prob, false) THEN 'unknown' ELSE category END AS category
FROM ranked WHERE rank = 1""")
def nb_classify(t: Tables):
    return bayes.classify(Setup(t).nb(), {"good": 3.0}, "unknown")


@plan("fisher_cprob", f"WITH {MODEL} SELECT feature, category, round(prob, 6) AS prob FROM cprob")
def fisher_cprob(t: Tables):
    return _prob(bayes.category_probabilities(Setup(t).model))


@plan("fisher_prob", f"WITH {MODEL} SELECT doc_id, category, round(prob, 6) AS prob FROM fisher")
def fisher_prob(t: Tables):
    return _prob(Setup(t).fisher())


@plan("fisher_classify", f"""WITH {MODEL}, rounded AS (SELECT doc_id, category, round(prob, 6) AS prob FROM fisher)
SELECT d.doc_id, coalesce(best, 'unknown') AS category FROM documents d LEFT JOIN (
  SELECT doc_id, arg_min(category, (-prob, category)) AS best FROM rounded
  WHERE prob > (CASE category WHEN 'bad' THEN 0.6 WHEN 'good' THEN 0.2 ELSE 0 END) AND prob > 0 GROUP BY doc_id) b USING (doc_id)""")
def fisher_classify(t: Tables):
    return bayes.fisher_classify(_prob(Setup(t).fisher()), {"bad": 0.6, "good": 0.2}, "unknown")


PARTS = 8


@plan("stream_classify", rf"""WITH {LABELLED}, words AS (
  SELECT DISTINCT doc_id, lower(w) AS feature FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '\W+')) AS w FROM labelled) WHERE length(w) BETWEEN 3 AND 19),
fc AS (SELECT doc_id % {PARTS} AS part, feature, category, count(*) AS n FROM words JOIN labelled USING (doc_id) GROUP BY ALL),
steps AS (SELECT unnest(range({PARTS})) AS batch),
cc AS (SELECT batch, category, count(*) AS n FROM labelled JOIN steps ON doc_id % {PARTS} < batch GROUP BY ALL),
known AS (SELECT batch, feature, category, sum(n) AS n FROM fc JOIN steps ON part < batch GROUP BY ALL),
totals AS (SELECT batch, feature, sum(n) AS total FROM known GROUP BY ALL),
logs AS (
  SELECT d.doc_id, d.batch, cc.category, ln(any_value(cc.n) / (SELECT sum(n) FROM cc c WHERE c.batch = d.batch))
    + coalesce(sum(CASE WHEN w.feature IS NULL THEN 0 WHEN t.total IS NULL THEN ln(0.5) ELSE ln((0.5 + t.total * coalesce(k.n, 0) / cc.n) / (1 + t.total)) END), 0) AS log_prob
  FROM (SELECT doc_id, doc_id % {PARTS} AS batch FROM labelled) d JOIN cc ON cc.batch = d.batch LEFT JOIN words w ON w.doc_id = d.doc_id
  LEFT JOIN totals t ON t.batch = d.batch AND t.feature = w.feature
  LEFT JOIN known k ON k.batch = d.batch AND k.feature = w.feature AND k.category = cc.category GROUP BY d.doc_id, d.batch, cc.category)
SELECT l.doc_id, l.category, g.guess, CAST(l.doc_id % {PARTS} AS INT) AS batch FROM labelled l LEFT JOIN (
  SELECT doc_id, arg_min(category, (-round(log_prob, 9), category)) AS guess FROM logs GROUP BY doc_id) g USING (doc_id)""")
def stream_classify(t: Tables):
    """The labelled documents as a stream of eight parts: each is guessed with what the parts before have taught."""
    source = scratch_path(t.spark, "labelled")
    labelled(t).withColumn("part", F.pmod("doc_id", F.lit(PARTS))).write.partitionBy("part").parquet(source)
    return run_parts(t.spark, source, scratch_path(t.spark, "stream")).guesses()
