"""Click-feedback ranking: a word–hidden–url network trained from a click log in batches.

Frames: ``queries(query_id, word_id)``, ``results(query_id, url_id)``, ``clicked(query_id, url_id)``;
the network is ``word_hidden(word_id, node, strength)`` and ``hidden_url(node, url_id, strength)``.
All queries of a batch see the same weights; a batch of one query is the classic step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.session import cut, laid_out

# Weights of missing connections, starting weights and learning rate.
MISSING_IN = -0.2
START_OUT = 0.1
RATE = 0.5


@dataclass
class Network:
    word_hidden: DataFrame
    hidden_url: DataFrame


def node_keys(queries: DataFrame, most_words: int | None = None) -> DataFrame:
    """``query_id, node, words``: one node per distinct set of words, of at most ``most_words`` if that is given."""
    sizes = queries.groupBy("query_id").agg(F.count("*").alias("words"))
    if most_words is not None:
        sizes = sizes.where(F.col("words") <= most_words)
    return (queries.join(sizes, "query_id").groupBy("query_id", "words")
            .agg(F.array_join(F.array_sort(F.collect_list(F.col("word_id").cast("string"))), "_").alias("node"))
            .select("query_id", "node", "words"))


def hidden_nodes(queries: DataFrame, results: DataFrame, known: DataFrame | None = None, most_words: int | None = None) -> Network:
    """Connections of the nodes the queries create; nodes in ``known`` are left alone."""
    keys = node_keys(queries, most_words)
    if known is not None:
        keys = keys.join(known.select("node").distinct(), "node", "left_anti")
    return Network(
        queries.join(keys, "query_id").select("word_id", "node", (1.0 / F.col("words")).alias("strength")).distinct(),
        results.join(keys, "query_id").select("node", "url_id").distinct().withColumn("strength", F.lit(START_OUT)))


def hidden_for_query(queries: DataFrame, results: DataFrame, net: Network) -> DataFrame:
    """``query_id, node`` of every node connected to a word or a result of the query."""
    by_word = queries.join(net.word_hidden, "word_id").select("query_id", "node")
    by_url = results.join(net.hidden_url, "url_id").select("query_id", "node")
    return by_word.union(by_url).distinct()


def activations(queries: DataFrame, net: Network) -> DataFrame:
    """``query_id, node, active, idle`` of the nodes sharing a word with the query.

    Every other node has the same activation ``idle`` (all its word weights are missing), so
    only the nodes reached through a word need a row.
    """
    idle = queries.groupBy("query_id").agg(F.tanh(F.count("*") * MISSING_IN).alias("idle"), F.count("*").alias("m"))
    reached = (queries.join(net.word_hidden, "word_id").groupBy("query_id", "node")
               .agg(F.sum(F.col("strength") - MISSING_IN).alias("lift")))
    return reached.join(idle, "query_id").select(
        "query_id", "node", F.tanh(F.col("lift") + F.col("m") * MISSING_IN).alias("active"), "idle")


def forward(queries: DataFrame, results: DataFrame, net: Network) -> DataFrame:
    """``query_id, url_id, output`` for every result.

    A url's input is the idle activation times all its weights, corrected for the nodes that
    share a word with the query; nodes without a weight to the url add nothing. The weights meet the activations by node and are
    summed where they lie: weights laid out by url do not move for it.
    """
    reached = cut(activations(queries, net), "active")
    idle = queries.groupBy("query_id").agg(F.tanh(F.count("*") * MISSING_IN).alias("idle"))
    all_weights = net.hidden_url.groupBy("url_id").agg(F.sum("strength").alias("weight"))
    shifts = (net.hidden_url.join(reached, "node").groupBy("query_id", "url_id")
              .agg(F.sum((F.col("active") - F.col("idle")) * F.col("strength")).alias("shift")))
    return (results.join(idle, "query_id").join(all_weights, "url_id", "left").join(shifts, ["query_id", "url_id"], "left")
            .select("query_id", "url_id", F.tanh(
                F.col("idle") * F.coalesce("weight", F.lit(0.0)) + F.coalesce("shift", F.lit(0.0))).alias("output")))


def backward(queries: DataFrame, results: DataFrame, clicked: DataFrame, net: Network) -> Network:
    """The network after one batch: the weight changes of all its queries added up.

    Outputs are laid out by url, as ``train`` lays out results and weights. The nodes of a query's results are
    those that its outputs blame, so outputs and weights meet once.
    """
    target = clicked.select("query_id", "url_id", F.lit(1.0).alias("target"))
    out = (forward(queries, results, net).join(target, ["query_id", "url_id"], "left")
           .select("query_id", "url_id", ((1 - F.col("output") * F.col("output"))
                                          * (F.coalesce("target", F.lit(0.0)) - F.col("output"))).alias("delta")))
    out = laid_out(out, ["url_id"], "deltas")
    blame = cut(out.join(net.hidden_url, "url_id").groupBy("query_id", "node")
                .agg(F.sum(F.col("delta") * F.col("strength")).alias("error")), "blame")
    idle = queries.groupBy("query_id").agg(F.tanh(F.count("*") * MISSING_IN).alias("rest"))
    by_word = queries.join(net.word_hidden, "word_id").select("query_id", "node")
    nodes = (by_word.union(blame.select("query_id", "node")).distinct().join(idle, "query_id")
             .join(activations(queries, net).select("query_id", "node", "active"), ["query_id", "node"], "left")
             .select("query_id", "node", F.coalesce("active", "rest").alias("active")))
    nodes = cut(nodes, "nodes")
    inner = (nodes.join(blame, ["query_id", "node"], "left")
             .select("query_id", "node", ((1 - F.col("active") * F.col("active"))
                                          * F.coalesce("error", F.lit(0.0))).alias("delta")))
    out_change = (nodes.join(out, "query_id").groupBy("node", "url_id")
                  .agg(F.sum(F.col("delta") * F.col("active") * RATE).alias("change")))
    in_change = (inner.join(queries, "query_id").groupBy("word_id", "node")
                 .agg(F.sum(F.col("delta") * RATE).alias("change")))
    return Network(
        _moved(net.word_hidden, in_change, ["word_id", "node"], MISSING_IN),
        _moved(net.hidden_url, out_change, ["node", "url_id"], 0.0))


def _moved(weights: DataFrame, change: DataFrame, keys: list[str], missing: float) -> DataFrame:
    return weights.join(change, keys, "full").select(
        *keys, (F.coalesce("strength", F.lit(missing)) + F.coalesce("change", F.lit(0.0))).alias("strength"))


def train(queries: DataFrame, results: DataFrame, clicked: DataFrame, net: Network | None = None, passes: int = 1,
          most_words: int | None = None) -> Network:
    """Create missing nodes, then repeat forward and backward over the batch."""
    fresh = hidden_nodes(queries, results, net.word_hidden if net else None, most_words)
    if net:
        fresh = Network(net.word_hidden.unionByName(fresh.word_hidden), net.hidden_url.unionByName(fresh.hidden_url))
    net = Network(cut(fresh.word_hidden, "weights"), laid_out(fresh.hidden_url, ["url_id"], "weights"))
    results, clicked = laid_out(results, ["url_id"], "results"), cut(clicked, "clicked")
    for _ in range(passes):
        moved = backward(queries, results, clicked, net)
        net = Network(cut(moved.word_hidden, "weights"), laid_out(moved.hidden_url, ["url_id"], "weights"))
    return net


def click_scores(outputs: DataFrame) -> DataFrame:
    """Outputs of each query against its largest one."""
    top = outputs.groupBy("query_id").agg(F.max("output").alias("top"))
    return outputs.join(top, "query_id").select(
        "query_id", "url_id", (F.col("output") / F.when(F.col("top") == 0, 0.00001).otherwise(F.col("top"))).alias("score"))
