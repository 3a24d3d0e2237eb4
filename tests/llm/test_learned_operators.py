"""Language, toxicity and main text: held-out accuracy, exact restatements and odd inputs; the pipeline against plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from minewright.llm import html_extract, langid, toxicity
from minewright.llm.html_blocks import leaves
from minewright.llm.words import span_hashes

SMALL = "/root/testdata/sf0.01"


def brute_bits(training, text, order=3):
    """Escape method C, byte by byte, over the counts of ``training`` texts."""
    counts: dict = {}
    pad = b" " * order
    for own in training:
        data = pad + own.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts.setdefault(data[i - k:i], Counter())[data[i]] += 1
    total, data = 0.0, pad + text.encode()
    for i in range(order, len(data)):
        k = order
        while k >= 0 and data[i - k:i] not in counts:
            k -= 1
        bits = 0.0
        while k >= 0:
            met = counts[data[i - k:i]]
            n, d = sum(met.values()), len(met)
            if data[i] in met:
                bits -= math.log2(met[data[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
            k -= 1
        total += bits + (8 if k < 0 else 0)
    return total


def test_code_lengths_are_exact():
    training = {"a": ["abra cadabra", "abc ab é"], "b": ["bcd bcd xyz", ""]}
    names = sorted(training)
    language, grams, counts = [], [], []
    for k, name in enumerate(names):
        for out in langid._grams([pa.RecordBatch.from_arrays([pa.array([name] * len(training[name])), pa.array(training[name])], names=["lang", "text"])]):
            language += [k] * out.num_rows
            grams += out.column("gram").to_pylist()
            counts += out.column("n").to_pylist()
    trees = langid.grow(names, np.array(language), np.array(grams), np.array(counts, float))
    texts = ["abra", "", "bcd xyz", "unseen 世 bytes", "a", None, "ab" * 400_000]
    got = trees.lengths(pa.array(texts))
    for text, bits in zip(texts[:-1], got):
        assert bits == pytest.approx([brute_bits(training[n], text or "") for n in names], rel=1e-5)


def test_languages_of_held_out_documents(spark, docs_of):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: r for r in langid.identified(docs, langid.fit(docs)).collect()}
    known = docs.where("lang is not null").collect()
    held = [r for r in known if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(found[r.doc_id].held_out for r in held) and sum(f.held_out for f in found.values()) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in found)
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    # Nothing is learned from held-out rows, and nothing but the text is used.
    swapped = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 4 = 2, 'zz', lang) as lang")
    assert langid.fit(swapped).languages == langid.fit(docs).languages
    odd = docs_of([(1, None, None, "en"), (None, "12 34 !?", None, None), (2, "the and of", "s", "en"), (2, "the and of", "s", "en"), (3, "the " * 100_000, "s", "de")])
    got = langid.identified(odd, langid.fit(docs)).collect()
    assert Counter(r.lang_pred for r in got if r.doc_id in (1, None)) == {"und": 2} and all(0 <= r.score <= 1 for r in got) and len(got) == 5
    nothing = langid.identified(odd, langid.fit(docs_of([])))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    assert langid.identified(docs_of([]), langid.fit(docs)).count() == 0


def test_toxic_documents_are_caught(spark, docs_of):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.graded(docs, model).collect()}
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert sum(found[i].toxic for i in toxic) >= 0.9 * len(toxic) and sum(found[i].toxic for i in clean) <= 0.01 * len(clean)
    for r in found.values():
        assert 0 <= r.severity <= 3 and r.grade in range(4) and r.toxic == (r.p_toxic >= 0.5)
    odd = docs_of([(1, None), (None, ""), (2, "some words"), (2, "some words"), (3, "word " * 100_000)])
    assert [r.toxic for r in toxicity.graded(odd, model).collect()] == [False] * 5
    assert toxicity.clean(odd, model).columns == odd.columns and toxicity.clean(odd, model).count() == 5
    untaught = toxicity.fit(docs, labels.limit(0))
    assert toxicity.graded(docs, untaught).where("toxic or severity > 0.001").count() == 0
    assert toxicity.graded(docs_of([]), model).count() == 0


def test_scores_and_grades_restated(spark, docs_of, odd_rows):
    """Every column of ``graded`` from the model's weights, word by word in plain Python."""
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit(docs, labels)
    weights = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    letters = set(b"0123456789abcdefghijklmnopqrstuvwxyz")

    def words(text):
        data, out, word = (text or "").encode(), [], bytearray()
        for byte in data + b" ":
            byte += 32 * (65 <= byte <= 90)
            if byte in letters or byte >= 128:
                word.append(byte)
            elif word:
                out.append(bytes(word))
                word = bytearray()
        return set(out)

    buckets = {}

    def bucket(word):
        if word not in buckets:
            data = np.frombuffer(word, np.uint8)
            buckets[word] = int(span_hashes(data, np.array([0]), np.array([len(data)]))[0] % np.uint64(model.size))
        return buckets[word]

    rows = [(r.doc_id, r.text) for r in docs.limit(300).collect()] + odd_rows
    found = toxicity.graded(docs_of(rows).coalesce(1), model).collect()
    want = []
    for id_, text in rows:
        score = sum(weights.get(b, 0.0) for b in {bucket(w) for w in words(text)})
        above = [1 / (1 + math.exp(-max(-60.0, min(60.0, score - t)))) for t in model.thresholds]
        shares = [a - b for a, b in zip([1.0, *above], [*above, 0.0])]
        want.append((id_, sum(above), above[0], shares.index(max(shares)), above[0] >= 0.5))
    key = lambda r: (str(r[0]), r[1])
    for got, (id_, severity, p_toxic, grade, toxic) in zip(sorted(map(tuple, found), key=key), sorted(want, key=key)):
        assert got[0] == id_ and got[1] == pytest.approx(severity, abs=1e-9) and got[2] == pytest.approx(p_toxic, abs=1e-9)
        assert (got[3], got[4]) == (grade, toxic)
    assert any(w[4] for w in want) and not all(w[4] for w in want)


def test_thresholds_share_weights_in_order():
    draw = random.Random(1)
    rows, terms, grades = [], [], []
    for k in range(600):
        grade = k % 4
        own = {draw.randrange(10, 60) for _ in range(5)} | set(range(grade))  # terms 0, 1, 2 mark the grades
        rows += [k] * len(own)
        terms += sorted(own)
        grades.append(grade)
    model = toxicity.fit_ordinal(np.array(grades), np.array(rows), np.array(terms), 64)
    assert list(model.thresholds) == sorted(model.thresholds)
    weight = dict(zip(model.buckets.tolist(), model.weights))
    assert min(weight.get(k, 0) for k in range(3)) > 2 * max([abs(w) for t, w in weight.items() if t >= 10], default=0)


def test_blocks_of_odd_markup():
    assert leaves("") == [] and leaves("<div") == [] and leaves("<script>x") == [] and leaves("<!-- x <p>y") == []
    assert [b[0] for b in leaves("<p>x<p>y<b>z</p>w&amp;v &am &#233;")] == ["x", "yz", "w&v &am é"]
    assert [b[0] for b in leaves("<ul><li>a<li>b</ul><P>A<BR>B  C</P>")] == ["a", "b", "A B C"]
    assert [b[0] for b in leaves("<p title='a>b'>q</p><style>p{}</style>r<SCRIPT>1</SCRIPT>s")] == ["q", "rs"]
    assert len(leaves("<p>x" * 20_000)) == 20_000 and leaves("<" * 50_000)[0][0] == "<" * 50_000
    assert leaves("<a title=\"" + "x" * 200_000) == []


def test_only_scripts_and_styles_lose_their_text():
    for tag in ("svg", "math", "object", "canvas", "iframe", "noscript", "template"):
        for page, want in ((f'<article><p>a <{tag} class="i"/> b</p><p>c</p></article>', ["a b", "c"]), (f"<p>a <{tag}> b</p><p>c</p>", ["a b", "c"]),
                           (f"<p>a <{tag} x>in</{tag}> b</p><p>c</p>", ["a in b", "c"]), (f"<p>a <{tag}/> b</p><p>c <{tag}>in</{tag}></p>", ["a b", "c in"])):
            assert [b[0] for b in leaves(page)] == want, page
    assert [b[0] for b in leaves("<p>pick <select><option>a<option>b</select> now</p><p>c <select> d</p>")] == ["pick", "a", "b", "now", "c", "d"]
    assert [(b[0], b[1][-1][0]) for b in leaves("<p>a <svg><title>in</title></svg> b</p>")] == [("a", "p"), ("in", "title"), ("b", "p")]
    assert [b[0] for b in leaves("<p>a<script-box>b</script-box><style-x>c</style-x></p><script src=x/>d</script>e<style>f")] == ["abc", "e"]


def test_main_text_around_and_in_other_elements(spark):
    model = html_extract.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))
    inside = {1: '<p>a word <svg class="i"/> and more of it.</p><p>The last one.</p>', 2: "<p>With <math><mi>x</mi>=<mn>2</mn></math> in it.</p><p>The last one.</p>",
              3: "<p>Then <object data=o>its own text</object> here.</p><noscript><p>Seen without scripts.</p></noscript><p>The last one.</p>"}
    pages = spark.createDataFrame([(k, "u", f"<html><body><nav><a href=/>menu</a></nav><article><h1>The name</h1>{v}</article></body></html>") for k, v in inside.items()],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extracted(pages, model).collect()}
    assert got == {1: "The name\na word and more of it.\nThe last one.", 2: "The name\nWith x=2 in it.\nThe last one.",
                   3: "The name\nThen its own text here.\nSeen without scripts.\nThe last one."}


def test_layouts_that_say_little(spark):
    """Unmarked elements, fragments and comments inside the article; the fit does not depend on the files' layout."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    model = html_extract.fit(pages)
    again = html_extract.fit(pages.repartition(7).orderBy("url"))
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)
    body = "<p>The first of the paragraphs, with some words in it.</p><p>A second one that goes on from there.</p><p>And a third to end with.</p>"
    want = "The first of the paragraphs, with some words in it.\nA second one that goes on from there.\nAnd a third to end with."
    comments = "<p>I liked it a lot</p><p>so did we, thanks for it</p></section>"
    html = {1: f'<html><body><nav><a href=/>Home</a><a href=/x>More</a></nav><div class="zq1">{body}</div><footer>Imprint and terms</footer></body></html>',
            2: f'<article>{body}<section class="comments">{comments}</article>', 3: f"<div>{body}</div>",
            4: f'<body><div class="menu"><a href=/>Home</a></div><section class="kv7">{body}</section><div class="sidebar"><p>Other pages to read</p></div></body>',
            5: f'<main>{body}<section class="reader-comments">{comments}</main>'}
    found = {r.page_id: r.text for r in html_extract.extracted(spark.createDataFrame([(k, "u", v) for k, v in html.items()], "page_id long, url string, html string"), model).collect()}
    assert found == dict.fromkeys(html, want)


def test_backpropagation_equals_differences():
    composer = html_extract.Composer(["some words of a text. And more of them"], seed=1)
    pages = [composer.page() for _ in range(3)]
    group = [(html_extract._inputs(blocks).astype(np.float64), labels.astype(np.float64)) for blocks, labels in pages]
    model = html_extract.Labeller.fresh(2)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}

    def loss():
        total = n = 0.0
        for (x, y), (blocks, _) in zip(group, pages):
            p = np.clip(model.keep([blocks])[0], 1e-9, 1 - 1e-9)
            total -= (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
            n += len(y)
        return total / n

    slopes, draw = html_extract._slopes(model, group), random.Random(3)
    for name in ("hf", "hb", "cf", "cb", "out"):
        flat, slope = model.weights[name].reshape(-1), slopes[name].reshape(-1)
        for at in draw.sample(range(len(flat)), 5):
            model.paths.clear()
            flat[at] += 1e-3
            up = loss()
            model.paths.clear()
            flat[at] -= 2e-3
            down = loss()
            flat[at] += 1e-3
            assert (up - down) / 2e-3 == pytest.approx(slope[at], rel=0.05, abs=2e-4)


def test_main_text(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    model = html_extract.fit(pages)
    composer = html_extract.Composer(["Another text, with other words than those of training. It goes on."], seed=77)
    made = [composer.page() for _ in range(200)]
    wrong = sum(((keep >= 0.5) != labels).sum() for keep, (_, labels) in zip(model.keep([b for b, _ in made]), made))
    assert wrong <= 0.01 * sum(len(labels) for _, labels in made)
    import re
    from html import unescape

    html = {r.page_id: r.html for r in pages.collect()}
    for r in html_extract.extracted(pages, model).collect():
        inside = re.search("<article>(.*)</article>", html[r.page_id], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, "u", None, "x"), (None, None, "", "x"), (2, "u", "<nav>menu</nav>", "x"), (3, "u", "<article><p>" + "long text " * 50_000, "x")], "page_id long, url string, html string, row string")
    got = {r.page_id: r.text for r in html_extract.extracted(odd, model).collect()}
    assert got[1] == got[None] == got[2] == "" and len(got[3]) == 499_999
    assert html_extract.extracted(odd.limit(0), model).count() == 0 and html_extract.extracted(odd, html_extract.fit(odd.limit(0))).count() == 4


def test_pipeline_stages(spark):
    import corpus_pipeline
    from tests.llm.test_dedup import LOWER, brute_components

    docs, stages = spark.read.parquet(f"{SMALL}/documents.parquet"), dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.cut(stage(spark, docs, SMALL), "stage")
        after[name] = (before.collect(), docs.collect())
        assert name == "packing" or docs.columns == before.columns
    was, now = after["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    gone = {r.doc_id for r in was} - {r.doc_id for r in now}
    assert sum(labels.get(i) == 1 for i in gone) >= 0.9 * sum(v == 1 for v in labels.values()) and sum(labels.get(i) == 0 for i in gone) <= 3
    was, now = after["exact dedup"]
    last: dict = {}
    for r in was:
        key = (r.text or "").translate(LOWER)
        last[key] = max(last.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in now) == sorted(last.values())
    was, now = after["n-gram Jaccard join"]
    components = brute_components([(r.doc_id, r.text) for r in was], 5, 80)
    assert sorted(r.doc_id for r in now) == sorted(i for i, n, c in components if i == c)
    was, now = after["mixing sources to target weights"]
    copies = Counter(r.doc_id for r in now)
    assert set(copies) <= {r.doc_id for r in was} and max(copies.values()) <= 3
    was, now = after["packing"]
    assert sum(r.length for r in now if r.start == 0) > 0 and {r.doc_id for r in now} == {r.doc_id for r in was} and stages["packing"]
