"""Where the click network's tables lie."""

from minewright.operators import feedback


def test_training_leaves_weights_where_their_urls_are(spark):
    queries = spark.createDataFrame([(q, w) for q in range(4) for w in (100 + q % 2, 200 + q)], "query_id LONG, word_id LONG")
    results = spark.createDataFrame([(q, u) for q in range(4) for u in range(50) if (q + u) % 3], "query_id LONG, url_id LONG")
    net = feedback.train(queries, results, results.groupBy("query_id").min("url_id").toDF("query_id", "url_id"), passes=2)
    by_url = net.hidden_url.join(net.hidden_url.withColumnRenamed("node", "other").drop("strength"), "url_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in by_url._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Every query's nodes: those of its words and those that have a weight to one of its results.
    assert net.word_hidden.count() == 24 and net.hidden_url.select("node").distinct().count() == 4
