"""The posting store, the laid-out page rank and the narrow choice of first rows."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from minewright.functions import text
from minewright.operators import index, links, ranking, vectorize
from minewright.session import scratch_path


def scanned_rows(df):
    """Rows that the file scan of an executed plan without shuffles has read."""
    df.collect()
    nodes = [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if "Scan parquet" in node.nodeName():
            return node.metrics().apply("numOutputRows").value()
        nodes += [node.children().apply(k) for k in range(node.children().size())]
    raise AssertionError("no scan")


def grouped(rows):
    return rows.groupBy("word", "url").agg(F.sort_array(F.collect_list("location")).alias("locations"))


def test_grouped_postings_equal_postings(spark):
    html = ["<p>The cat and a cat, it is the CAT of cats</p>", "", None, "<p>the of</p>", "dog " * 500 + "<b>Cat</b>"]
    pages = spark.createDataFrame([(f"u{k}", h) for k, h in enumerate(html)], "url STRING, html STRING")
    want = {}
    for r in index.postings(pages).collect():
        want.setdefault((r.word, r.url), []).append(r.location)
    assert {(r.word, r.url): list(r.locations) for r in index.grouped_postings(pages).collect()} == {k: sorted(v) for k, v in want.items()}
    assert want["cat", "u0"] == [1, 4, 8]


def test_a_query_reads_the_row_groups_of_its_words(spark):
    rows = spark.range(40_000).select(F.format_string("page%05d", F.col("id") % 200).alias("url"), F.col("id").cast("int").alias("location"),
                                      F.format_string("word%04d", F.floor(F.col("id") / 20)).alias("word"))
    store = index.posting_store(grouped(rows), scratch_path(spark, "store"), row_group=1 << 14)
    assert store.count() == 40_000
    some = store.where(F.col("word").isin("word0500", "word1700"))
    assert "PushedFilters: [In(word, [word0500,word1700])]" in some._jdf.queryExecution().executedPlan().toString()
    assert scanned_rows(some) < 0.2 * 40_000
    query = spark.createDataFrame([(3, "word0500"), (7, "nowhere"), (9, "word0500")], "word_no INT, word STRING")
    got = ranking.asked(store, query).select("word_no", "url").collect()
    assert Counter(r.word_no for r in got) == {0: 20, 1: 20}


def test_matched_pages_and_scores(spark):
    places = [("p", 0, "a"), ("p", 4, "a"), ("p", 2, "b"), ("q", 9, "a"), ("q", 1, "b"), ("r", 5, "a")]
    store = index.posting_store(grouped(spark.createDataFrame(places, "url STRING, location INT, word STRING")), scratch_path(spark, "store"))
    query = spark.createDataFrame([(0, "a"), (1, "zzz"), (2, "b")], "word_no INT, word STRING")
    pages = ranking.matched_pages(store, query)
    assert {(r.url, r.frequency, r.location) for r in pages.collect()} == {("p", 2.0, 2.0), ("q", 1.0, 10.0)}
    scores = ranking.page_scores(pages, {"rank": spark.createDataFrame([("q", 3.0)], "url STRING, value DOUBLE")}, {"location"})
    got = {r.url: r.score for r in ranking.weighted(scores, {"frequency": 1, "location": 2, "rank": 4}).collect()}
    assert got == {"p": 1 + 2, "q": pytest.approx(0.5 + 0.4 + 4)}
    nothing = spark.createDataFrame([(0, "zzz")], "word_no INT, word STRING")
    assert ranking.matched_pages(store, nothing).count() == 0 and ranking.match_rows(index.locations(store), nothing).count() == 0


def plain_rank(nodes, edges, rounds=20):
    out, into = Counter(a for a, _ in edges), defaultdict(set)
    for a, b in edges:
        into[b].add(a)
    score = dict.fromkeys(nodes, 1.0)
    for _ in range(rounds):
        score = {n: 0.15 + 0.85 * sum(score[a] / out[a] for a in into[n] if a in score) for n in nodes}
    return score


@pytest.mark.parametrize("hub", [links.HUB, 16])
def test_page_rank_with_a_hub(spark, hub):
    draw = random.Random(7)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(300)] + [(5, draw.randrange(60)) for _ in range(150)] + [(draw.randrange(60), 5) for _ in range(150)]
    nodes = list(range(55))
    want = plain_rank(nodes, edges)
    df = links.page_rank(spark.createDataFrame([(n,) for n in nodes + [3]], "url_id LONG"), spark.createDataFrame(edges, "from_id LONG, to_id LONG"), hub=hub)
    assert {r.url_id: r.score for r in df.collect()} == {n: pytest.approx(s) for n, s in want.items()}
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    scans = [k for k, line in enumerate(lines) if "shares_" in line and "FileScan" in line]
    assert scans
    for k in scans:  # what lies under an exchange of its own would move
        assert not any("Exchange hash" in line for line in lines[k - 2:k]), lines[k - 2:k]


def test_first_rows(spark):
    rows = [(1, "a", "x"), (0, "a", "y"), (2, None, "z"), (1, None, "w"), (7, "c", "u"), (7, "c", "v"), (None, "d", "t"), (3, "d", "s")]
    df = spark.createDataFrame(rows, "seq INT, key STRING, other STRING").repartition(3)
    got = {r.key: (r.seq, r.other) for r in vectorize.first_by(df, "key", "seq").collect()}
    assert got["a"] == (0, "y") and got[None] == (1, "w") and got["c"] in {(7, "u"), (7, "v")} and got["d"] == (None, "t") and len(got) == 4
    assert vectorize.first_by(df, "key", "seq").count() == 4


def test_page_words_equal_the_words_of_the_page_text(spark):
    odd = ["a&amp;lt;b &l<b>t; c&nbsp;d&ampx;", "x<!-- <b>no</b> -->y<script>n</script >o</script>z", "<p\n class='q'>one<br>two", "tail <b unclosed\nwords\n", "",
           "éİKK <STYLE a>s</style>v", "a < b > c <> d", "<<a>b>c", None, "   ", "&#39;s &quot;t&gt;u&", "the <!-x-> of <scriptx>kept</scriptx>", "-" * 20000 + "end"]
    pages = spark.createDataFrame([(str(k), html) for k, html in enumerate(odd)], "url STRING, html STRING")
    want = pages.select("url", text.plain_words(text.page_text(F.col("html")))).collect()
    got = pages.select("url", text._lower_nonempty(text.page_words(F.col("html")))).collect()
    assert got == want
    rows = {(r.word, r.url): list(r.locations) for r in index.grouped_postings(pages).collect()}
    found = {}
    for url, location, word in index.postings(pages).collect():
        found.setdefault((word, url), []).append(location)
    assert rows == {k: sorted(v) for k, v in found.items()}


def test_a_store_takes_its_pages_once(spark):
    pages, seen = spark.createDataFrame([(f"u{k}", f"word{k} again") for k in range(40)], "url STRING, html STRING"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    store = index.posting_store(index.grouped_postings(pages.mapInArrow(counted, pages.schema)), scratch_path(spark, "postings"))
    assert store.count() == 80
    assert seen.value == 40
