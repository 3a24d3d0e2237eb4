"""Scores of documents from a trained model."""

import math

import pytest
from pyspark.sql import functions as F

from minewright.operators import bayes

ROWS = [("milk", "good", 3), ("milk", "bad", 1), ("tea", "bad", 2)]
SIZES = {"bad": 4, "good": 6}
ASKED = {1: ["milk", "tea", "rare", None], 2: ["rare"], 3: []}


@pytest.fixture(scope="module")
def known(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("words") / "asked")
    spark.createDataFrame([(d, w) for d, words in ASKED.items() for w in words], "doc_id LONG, feature STRING").write.parquet(path)
    model = bayes.Model(spark.createDataFrame(ROWS, "feature STRING, category STRING, n LONG"),
                        spark.createDataFrame(list(SIZES.items()), "category STRING, n LONG"))
    return spark.read.parquet(path), spark.createDataFrame([(d,) for d in ASKED], "doc_id LONG"), model


def test_words_are_read_once(known):
    for scores in (bayes.log_probabilities(*known), bayes.fisher_probabilities(*known)):
        assert scores._jdf.queryExecution().optimizedPlan().toString().count("feature#") and \
            scores._jdf.queryExecution().sparkPlan().toString().count("asked") == 1


def test_unknown_and_missing_words_have_the_assumed_probability(known):
    counts = {(w, c): n for w, c, n in ROWS}
    got = {(r["doc_id"], r["category"]): r["log_prob"] for r in bayes.log_probabilities(*known).collect()}
    want = {}
    for doc, words in ASKED.items():
        for category, size in SIZES.items():
            want[doc, category] = math.log(size / sum(SIZES.values()))
            for w in words:
                total = sum(counts.get((w, c), 0) for c in SIZES)
                want[doc, category] += math.log((0.5 + total * counts.get((w, category), 0) / size) / (1 + total))
    assert got == pytest.approx(want)


def test_chi2_of_both_forms(spark):
    asked = [(0.0, 5), (3.5, 1), (3.5, 9), (699.0, 720), (1399.0, 1400), (1400.0, 1300), (1401.0, 1400), (2400.0, 2500)]
    got = spark.createDataFrame([(i, *a) for i, a in enumerate(asked)], "id LONG, half DOUBLE, terms LONG").select(
        "id", bayes.inverse_chi2(F.col("half"), F.col("terms")).alias("p")).collect()
    want = [1.0 if h == 0 else sum(math.exp(-h + k * math.log(h) - math.lgamma(k + 1)) for k in range(n)) for h, n in asked]
    assert [r["p"] for r in sorted(got)] == pytest.approx(want, rel=1e-9)
