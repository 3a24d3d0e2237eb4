"""Main text of web pages: a bidirectional LSTM in numpy labels every leaf block from the whole page."""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.llm.html_blocks import BLOCKS, leaves
from minewright.llm.words import LOWER, chunks, span_hashes, word_spans

#: Pages that the model is fitted on; hidden units per direction; buckets of unknown path words and of text words.
FIT_PAGES, HIDDEN, PATH_BUCKETS, WORD_BUCKETS = 200, 16, 32, 32
#: Path words with a feature of their own. Fixed values; "select" is hashed like unknown words.
PATH_WORDS = sorted(BLOCKS - {"select"}) + """ad ads advert advertisement alert article author banner bar blog body bottom box breadcrumb button byline caption
    col comment comments consent contact container content cookie cookies copyright date discussion disqus document entry feed foot gdpr
    hentry inner item legal list login masthead menu meta modal navbar navigation navigator newsletter notice notification overlay page pager
    pagination panel popup post privacy promo promotion region related reply responses rail recommended search share side sidebar signup site
    skip social sponsor sponsored story subscribe tags teaser text toolbar top topbar utility warning widget wrap wrapper""".split()
_PATH_INDEX = {w: k for k, w in enumerate(PATH_WORDS)}
PATH_SIZE = 2 * (len(PATH_WORDS) + PATH_BUCKETS)
NUMBERS = 5
INPUT = PATH_SIZE + WORD_BUCKETS + NUMBERS


def path_vector(path: tuple) -> np.ndarray:
    """Which words stand anywhere above the block, and which in its two nearest elements."""
    out = np.zeros(PATH_SIZE, np.float32)
    half = PATH_SIZE // 2
    for depth, (tag, words) in enumerate(reversed(path)):
        for word in (tag, *words):
            at = _PATH_INDEX.get(word)
            if at is None:
                at = len(PATH_WORDS) + zlib.crc32(word.encode()) % PATH_BUCKETS
            out[at] = 1
            if depth < 2:
                out[half + at] = 1
    return out


def text_vectors(blocks: list, places: np.ndarray) -> np.ndarray:
    """Hashed words of every whole block as shares, and its length, links, place on the page and closing sign."""
    n = len(blocks)
    out = np.zeros((n, WORD_BUCKETS + NUMBERS), np.float32)
    for first, offsets, raw in chunks(pa.array([b[0] for b in blocks], pa.large_string())):
        data = LOWER[raw]
        starts, ends = word_spans(offsets, data)
        row = np.searchsorted(offsets, starts, "right") - 1
        bucket = (span_hashes(data, starts, ends) % np.uint64(WORD_BUCKETS)).astype(np.int64)
        rows = len(offsets) - 1
        bags = np.bincount(row * WORD_BUCKETS + bucket, minlength=rows * WORD_BUCKETS).reshape(rows, WORD_BUCKETS)
        words = np.maximum(1, bags.sum(1))
        out[first:first + rows, :WORD_BUCKETS] = bags / words[:, None]
        out[first:first + rows, WORD_BUCKETS] = np.log1p(words) / 6
    sizes = np.array([len(b[0]) for b in blocks], float)
    out[:, WORD_BUCKETS + 1] = np.minimum(1, np.array([b[2] for b in blocks]) / np.maximum(1, sizes))
    out[:, WORD_BUCKETS + 2] = places
    out[:, WORD_BUCKETS + 3] = [b[0][-1] in ".!?:;" for b in blocks]
    out[:, WORD_BUCKETS + 4] = np.log1p(sizes) / 12
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Labeller:
    """Weights of both directions (inputs, recurrence, bias; gates in the order input, forget, output, cell) and of the last layer."""

    weights: dict[str, np.ndarray]
    paths: dict = field(default_factory=dict)  # projections of paths met, kept by the worker

    @staticmethod
    def fresh(seed: int = 5) -> Labeller:
        draw = np.random.default_rng(seed)
        weights = {}
        for d in "fb":
            weights["x" + d] = draw.normal(0, 0.15, (INPUT, 4 * HIDDEN)).astype(np.float32)
            weights["h" + d] = draw.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            weights["c" + d] = np.zeros(4 * HIDDEN, np.float32)
            weights["c" + d][HIDDEN:2 * HIDDEN] = 1
        weights["out"] = draw.normal(0, 0.3, 2 * HIDDEN + 1).astype(np.float32)
        return Labeller(weights)

    def __getstate__(self):
        return {"weights": self.weights, "paths": {}}

    def projected(self, blocks: list, places: np.ndarray, d: str, extra: np.ndarray) -> np.ndarray:
        """Gate inputs of all blocks; a path is projected once per worker."""
        w = self.weights["x" + d]
        known = self.paths.setdefault(d, {})
        if len(known) > 50_000:
            known.clear()
        table, rows, numbers = [], np.empty(len(blocks), np.int64), {}
        for k, block in enumerate(blocks):
            path = block[1]
            at = numbers.get(path)
            if at is None:
                if path not in known:
                    known[path] = path_vector(path) @ w[:PATH_SIZE] + self.weights["c" + d]
                at = numbers[path] = len(table)
                table.append(known[path])
            rows[k] = at
        return np.array(table)[rows] + extra @ w[PATH_SIZE:]

    def keep(self, pages: list[list]) -> list[np.ndarray]:
        """For every page, P(block is main text) of all its blocks."""
        lengths = np.array([len(p) for p in pages], np.int64)
        blocks = [b for p in pages for b in p]
        if not blocks:
            return [np.zeros(0)] * len(pages)
        begin = np.cumsum(lengths) - lengths
        places = (np.arange(len(blocks)) - np.repeat(begin, lengths)) / np.maximum(1, np.repeat(lengths, lengths) - 1)
        extra = text_vectors(blocks, places)
        score = np.full(len(blocks), float(self.weights["out"][-1]))
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        for k, d in enumerate("fb"):
            gates = self.projected(blocks, places, d, extra)
            out = self.weights["out"][k * HIDDEN:(k + 1) * HIDDEN]
            for at in range(0, len(order), 256):
                own = order[at:at + 256]
                h, c = np.zeros((len(own), HIDDEN), np.float32), np.zeros((len(own), HIDDEN), np.float32)
                for t in range(int(lengths[own].max())):
                    alive = int(np.searchsorted(lengths[own], t, "right"))  # shorter pages have ended
                    rows = begin[own[alive:]] + (t if d == "f" else lengths[own[alive:]] - 1 - t)
                    h, c = self._step(gates[rows], h[-len(rows):], c[-len(rows):], d)[:2]
                    score[rows] += h @ out
        return np.split(_sigmoid(score), np.cumsum(lengths)[:-1])

    def _step(self, gates, h, c, d):
        z = gates + h @ self.weights["h" + d]
        ifo = _sigmoid(z[:, :3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN:])
        c = ifo[:, HIDDEN:2 * HIDDEN] * c + ifo[:, :HIDDEN] * g
        return ifo[:, 2 * HIDDEN:] * np.tanh(c), c, ifo, g


def _inputs(page: list) -> np.ndarray:
    places = np.arange(len(page)) / max(1, len(page) - 1)
    return np.hstack([np.array([path_vector(b[1]) for b in page]), text_vectors(page, places)])


def train(pages: list[tuple[list, np.ndarray]], epochs: int = 14, batch: int = 24, rate: float = 0.01, seed: int = 5) -> Labeller:
    """Adam on the cross-entropy of all blocks, with full backpropagation through both directions."""
    model, draw = Labeller.fresh(seed), np.random.default_rng(seed)
    data = [(_inputs(blocks), labels.astype(np.float32)) for blocks, labels in pages if blocks]
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.weights.items()}
    step = 0
    for _ in range(epochs):
        shuffled = draw.permutation(len(data))
        by_length = sorted(shuffled, key=lambda k: len(data[k][1]))  # stable: random among equal lengths
        groups = [by_length[at:at + batch] for at in range(0, len(by_length), batch)]
        for g in draw.permutation(len(groups)):
            slopes = _slopes(model, [data[k] for k in groups[g]])
            step += 1
            for k, slope in slopes.items():
                m, v = moments[k]
                slope = np.clip(slope, -1, 1)
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                model.weights[k] -= rate * (m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8) + 1e-4 * model.weights[k])
    return model


def _slopes(model: Labeller, group: list) -> dict[str, np.ndarray]:
    lengths = np.array([len(y) for _, y in group])
    n, most = len(group), int(lengths.max())
    x, y, mask = np.zeros((n, most, INPUT), np.float32), np.zeros((n, most), np.float32), np.zeros((n, most), np.float32)
    for k, (own, labels) in enumerate(group):
        x[k, :len(labels)], y[k, :len(labels)], mask[k, :len(labels)] = own, labels, 1
    w, runs = model.weights, {}
    score = np.full((n, most), w["out"][-1], np.float32)
    for k, d in enumerate("fb"):
        gates = x @ w["x" + d] + w["c" + d]
        h = c = np.zeros((n, HIDDEN), np.float32)
        run = [None] * most
        for t in (range(most) if d == "f" else range(most - 1, -1, -1)):
            before = (h, c)
            h, c, ifo, g = model._step(gates[:, t], h, c, d)
            alive = mask[:, t, None]  # padding leaves the state as it was at the start
            h, c = h * alive, c * alive
            run[t] = (*before, h, c, ifo, g)
            score[:, t] += h @ w["out"][k * HIDDEN:(k + 1) * HIDDEN]
        runs[d] = run
    wrong = (_sigmoid(score) - y) * mask / mask.sum()
    slopes = {k: np.zeros_like(v) for k, v in w.items()}
    slopes["out"][-1] = wrong.sum()
    for k, d in enumerate("fb"):
        out = w["out"][k * HIDDEN:(k + 1) * HIDDEN]
        dh = dc = np.zeros((n, HIDDEN), np.float32)
        dz_all = np.zeros((n, most, 4 * HIDDEN), np.float32)
        for t in (range(most - 1, -1, -1) if d == "f" else range(most)):
            h0, c0, h, c, ifo, g = runs[d][t]
            slopes["out"][k * HIDDEN:(k + 1) * HIDDEN] += wrong[:, t] @ h
            alive = mask[:, t, None]
            dh = (dh + wrong[:, t, None] * out) * alive
            dc = dc * alive
            i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN:2 * HIDDEN], ifo[:, 2 * HIDDEN:]
            tanh = np.tanh(c)
            dc = dc + dh * o * (1 - tanh * tanh)
            dz = np.hstack([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g * g)])
            dz_all[:, t] = dz
            slopes["h" + d] += h0.T @ dz
            dh, dc = dz @ w["h" + d].T, dc * f
        slopes["x" + d] += x.reshape(-1, INPUT).T @ dz_all.reshape(-1, 4 * HIDDEN)
        slopes["c" + d] += dz_all.sum((0, 1))
    return slopes


_YES, _NO = "\u0002", "\u0003"  # first character of a block in a made page


class Composer:
    """Made pages with known labels: texts of real pages in many layouts."""

    CONTENT = ['<article{}>', '<main{}>', '<div class="content"{}>', '<div class="post-content"{}>', '<div id="article-body"{}>', '<section class="story"{}>',
               '<div class="entry hentry"{}>', '<div role="main"{}>']
    ASIDE = ['<nav>', '<div class="menu">', '<ul class="navigation">', '<div class="breadcrumb">', '<header>', '<div class="header">', '<div id="masthead">', '<footer>',
             '<div class="footer">', '<div id="copyright">', '<aside>', '<div class="sidebar">', '<div class="widget">', '<section class="related">',
             '<div class="ad">', '<div class="advert banner">', '<div class="sponsored">', '<div class="promo">', '<ins class="ads"><div class="ads">',
             '<div class="cookie-notice">', '<div class="notice">', '<div class="consent">', '<div role="alert">', '<div class="popup modal">', '<form>',
             '<div class="newsletter"><form>', '<form class="search">', '<div class="login-form">', '<section class="comments">', '<div id="comments">',
             '<div class="comment">', '<ol class="comment-list">', '<div class="discussion">', '<section class="reader-comments">', '<div class="share social">',
             '<div class="tags">', '<dialog>', '<div class="pagination">']

    SAID = ['<section class="comments">', '<div id="comments">', '<div class="comment">', '<ol class="comment-list">', '<section class="reader-comments">',
            '<div class="discussion">']

    def __init__(self, texts: list[str], seed: int = 5):
        self.draw, self.texts = random.Random(seed), [t for t in texts if t.split()] or ["text of a page without words."]

    def words(self, least: int, most: int) -> str:
        out: list[str] = []
        want = self.draw.randint(least, most)
        while len(out) < want:
            out += self.draw.choice(self.texts).split()[:want]
        return " ".join(out[:want])

    def inside(self, mark: str) -> str:
        draw, out = self.draw, []
        kind = draw.random()
        if kind < 0.35:
            return "".join(f'<li><a href="/x">{mark}{self.words(1, 3)}</a></li>' for _ in range(draw.randint(2, 8)))
        for _ in range(draw.randint(1, 4)):
            tag = draw.choice(["p", "div", "h3", "li", "span", "label", "p", ""])
            text = mark + self.words(2, draw.choice([6, 20, 80]))
            out.append(f"<{tag}>{text}</{tag}>" if tag and tag != "span" else f"<div>{text}</div>" if tag else text + "<hr>")
        return "".join(out)

    def content(self) -> str:
        draw, out = self.draw, []
        if draw.random() < 0.85:
            out.append(f"<h1>{_YES}{self.words(2, 9)}</h1>")
        for _ in range(draw.choice([0, 1, 2, 3, 5, 8, 14])):
            kind = draw.random()
            text = _YES + self.words(1, draw.choice([5, 30, 100, 300]))
            if kind < 0.7:
                out.append(f"<p>{text}" + draw.choice(["</p>", "</p>", "<br>", ""]))
            elif kind < 0.8:
                out.append(f"<h2>{_YES}{self.words(1, 8)}</h2>")
            elif kind < 0.88:
                out.append("<ul>" + "".join(f"<li>{_YES}{self.words(1, 25)}</li>" for _ in range(draw.randint(1, 5))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.95:
                out.append(f"<table><tr><td>{_YES}{self.words(1, 6)}</td><td>{_YES}{self.words(1, 6)}</td></tr></table>")
            else:
                out.append(draw.choice([f"<pre>{text}</pre>", f"<figure><figcaption>{text}</figcaption></figure>", f"<div>{text}</div>"]))
            if draw.random() < 0.07:
                out.append(self.aside())
        return "".join(out) or f"<p>{_YES}{self.words(3, 40)}"

    def aside(self) -> str:
        open_ = self.draw.choice(self.ASIDE)
        tags = [t[1:].split()[0].rstrip(">") for t in open_.replace("><", "> <").split(" <") for t in [t if t[0] == "<" else "<" + t]]
        return open_ + self.inside(_NO) + "".join(f"</{t}>" for t in reversed(tags))

    def unmarked(self) -> str:
        """An element whose name and class say nothing."""
        letters = "".join(self.draw.choice("abcdefghjkqvwxz") for _ in range(self.draw.randint(2, 5))) + str(self.draw.randint(0, 99))
        return self.draw.choice(["<div>", "<section>", f'<div class="{letters}">', f'<div id="{letters}">', f'<section class="{letters}">'])

    def page(self) -> tuple[list, np.ndarray]:
        draw, fragment = self.draw, self.draw.random() < 0.15
        html = [] if fragment else [f"<html><head><title>{_NO}{self.words(2, 9)}</title></head><body>"]
        html += [self.aside() for _ in range(0 if fragment and draw.random() < 0.5 else draw.randint(0, 4))]
        wrap = draw.choice(["", "", '<div class="wrapper">', '<div id="page"><div class="container">', self.unmarked()])
        kind = draw.random()
        open_ = draw.choice(self.CONTENT).format("") if kind < 0.7 else self.unmarked() if kind < 0.9 else ""
        tag = open_[1:].split()[0].rstrip(">") if open_ else ""
        said = draw.choice(self.SAID) if tag and draw.random() < 0.2 else ""  # readers' comments inside the article
        comments = f"{said}{self.inside(_NO)}</{said[1:].split()[0]}>" if said else ""
        closed = "".join(f"</{t[1:].split()[0].rstrip('>')}>" for t in reversed(wrap.replace("><", "> <").split(" <")) for t in [t if t[0] == "<" else "<" + t]) if wrap else ""
        html += [wrap, open_, self.content(), comments, f"</{tag}>" if tag else "", closed]
        html += [self.aside() for _ in range(0 if fragment and draw.random() < 0.5 else draw.randint(0, 5))]
        found = leaves("".join(html) + "</body></html>")
        labels = np.array([b[0][0] == _YES for b in found])
        return [(b[0].replace(_YES, "").replace(_NO, "") or "x", b[1], b[2]) for b in found], labels


#: Elements whose blocks are main text, and elements that never hold any, in the weak labels of real pages.
_MAIN, _REST = {"article", "main"}, {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "title"}
_REST_WORDS = {"ad", "ads", "advert", "banner", "menu", "nav", "sidebar", "cookie", "notice", "comment", "comments", "footer", "header", "promo", "related"}


def weak_labels(page: list) -> np.ndarray | None:
    """Labels of a page that marks its main element itself; None if it has none."""
    labels = np.zeros(len(page), bool)
    for k, (_, path, _) in enumerate(page):
        tags = [t for t, _ in path]
        main = max((i for i, t in enumerate(tags) if t in _MAIN), default=None)
        labels[k] = main is not None and not any(t in _REST or _REST_WORDS & set(w) for t, w in path[main + 1:]) and not any(t in _REST for t in tags[:main])
    return labels if labels.any() else None


#: Longer pages are not trained on (every page is extracted), and so many block texts are the stock of the composed pages.
FIT_CHARS, FIT_BLOCKS = 100_000, 20_000


def fit(pages: DataFrame, fit_pages: int = FIT_PAGES, made: int = 400, fit_chars: int = FIT_CHARS, fit_blocks: int = FIT_BLOCKS) -> Labeller:
    """A labeller from a bounded sample: at most ``fit_pages`` pages, weakly labelled, and ``made`` pages composed of their texts.

    The sample are the rows of least (hashed id, id, html) among those with fewer than ``fit_chars`` characters, whatever files
    they lie in; the composed pages draw from the first ``fit_blocks`` block texts. Null ids and null or empty pages are
    not trained on; of repeated ids each row counts. Without pages the labeller learns from the composed ones alone.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    rows = rows.where("page_id IS NOT NULL").where(F.length("html") < fit_chars)
    order = [F.md5(F.col("page_id").cast("string")), "page_id"]
    chosen = rows.select("page_id").distinct().orderBy(*order).limit(fit_pages)  # ids alone are compared first
    html = [r["html"] for r in rows.join(F.broadcast(chosen), "page_id", "left_semi").orderBy(*order, "html").limit(fit_pages).collect()]
    real = [page for page in map(leaves, html) if page]
    composer = Composer([b[0] for page in real for b in page][:fit_blocks])
    examples = [(page, labels) for page in real if (labels := weak_labels(page)) is not None]
    return train(examples + [composer.page() for _ in range(made)])


def extracted(pages: DataFrame, model: Labeller) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_kept`` of every page: its main blocks, one per line.

    A null or empty html, and a page without main blocks, has an empty text. Repeated rows and null ids are extracted each;
    other columns are not read; an empty table gives an empty result. Malformed markup is borne, nothing is cut off.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found = [leaves(html or "") for html in batch.column("html").to_pylist()]
                kept = [k >= 0.5 for k in model.keep(found)]
                texts = ["\n".join(b[0] for b, yes in zip(page, own) if yes) for page, own in zip(found, kept)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(p) for p in found], pa.int64()), pa.array([int(k.sum()) for k in kept], pa.int64())],
                    names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
