"""Main text of HTML pages by gradient-boosted trees over block elements and a hierarchical choice.

Each block element has features of its subtree (text, tag and link density), attribute words, depth, place and siblings.
Trees give the log odds that it belongs to the article. Then the best consistent choice is taken: an element counts
only inside elements that count, and the sum of log odds, weighted by text, is largest.

Nobody has labelled the given pages, so labels come from construction: at most ``TRAIN_PAGES`` pages are taken (by a
hash of their ids), parts of them that HTML itself names (article or main; navigation, footers, asides, forms) are
labelled as such, and their paragraphs are laid out anew in ``LAYOUTS`` generated pages with every kind of part known.

A null or empty html gives an empty text, and so does a page without article. Repeated rows give repeated results. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as markup
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import ship, table
from daybook.llm.dom import GOLD, Page

TRAIN_PAGES = 200
LAYOUTS = 900
TREES = 90
DEPTH = 4
RATE = 0.3
BINS = 32
PAGES_AT_ONCE = 64

EXTRACTED = "page_id long, url string, text string, n_chars long"


@dataclass
class Trees:
    """Complete binary trees: features and cuts of the inner nodes, values of the leaves."""

    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Second-order boosting of the log loss on binned features."""
    model = Trees()
    if not len(y):
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1)
    share = np.clip(np.average(y, weights=weight), 0.01, 0.99)
    model.start = float(np.log(share / (1 - share)))
    logits = np.full(len(y), model.start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logits))
        g, h = weight * (p - y), weight * p * (1 - p)
        feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            low = 2**level - 1
            place = node - low
            best = np.full(2**level, 1e-6)
            at = [(0, len(cuts[0]))] * 2**level
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                slot, shape = place * (len(c) + 1) + binned[:, j], (2**level, len(c) + 1)
                gl = np.bincount(slot, g, shape[0] * shape[1]).reshape(shape).cumsum(axis=1)
                hl = np.bincount(slot, h, shape[0] * shape[1]).reshape(shape).cumsum(axis=1)
                gs, hs = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                top = gain[:, :-1].argmax(axis=1)
                value = gain[np.arange(shape[0]), top]
                for k in np.flatnonzero(value > best):
                    best[k], at[k] = value[k], (j, int(top[k]))
            for k, (j, b) in enumerate(at):
                feature[low + k] = j
                cut[low + k] = cuts[j][b] if b < len(cuts[j]) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - (2**DEPTH - 1)
        value = -RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        logits += value[leaf]
        model.feature.append(feature)
        model.cut.append(cut)
        model.value.append(value)
    return model


# How pages mark up their parts. {0} is filled with paragraphs or items, {1} with a link list.
MAINS = (
    '<article data-y="1">{0}</article>', '<main data-y="1">{0}</main>', '<div class="post-content" data-y="1">{0}</div>',
    '<div id="content" data-y="1">{0}</div>', '<section class="story-body" data-y="1">{0}</section>', '<div data-y="1">{0}</div>',
    '<div class="entry" data-y="1"><div class="text">{0}</div></div>', '<main><article class="blog-post" data-y="1">{0}</article></main>',
    '<div class="col-8"><div itemprop="articleBody" data-y="1">{0}</div></div>', '<table><tr><td data-y="1">{0}</td></tr></table>',
)
TOPS = (
    '<header data-y="0"><a href="/">{2}</a><nav>{1}</nav></header>', '<nav data-y="0">{1}</nav>', '<div class="menu" data-y="0">{1}</div>',
    '<div id="header" data-y="0"><div class="logo">{2}</div>{1}</div>', '<header class="site-header" data-y="0"><p>{2}</p></header>',
    '<div class="navbar" data-y="0">{1}</div>', '<div class="breadcrumb" data-y="0">{1}</div>', '<ul class="nav" data-y="0">{1}</ul>',
    '<div class="cookie-notice" data-y="0"><p>{2}</p><button>OK</button></div>', '<div class="alert notice" data-y="0">{2}</div>',
    '<header data-y="0"><h1>{2}</h1><p>{3}</p></header>', '<menu data-y="0"><li>{3}</li><li>{2}</li></menu>',
    '<div id="cookie-consent" role="dialog" data-y="0"><p>{0}</p></div>', '<div class="topbar" data-y="0">{2}</div>',
)
MIDDLES = (
    '<div class="ad" data-y="0">{2}</div>', '<div class="advertisement" data-y="0"><p>{2}</p></div>', '<aside data-y="0"><p>{2}</p></aside>',
    '<div class="share-buttons" data-y="0">{1}</div>', '<div class="newsletter" data-y="0"><p>{2}</p><form><input><button>Go</button></form></div>',
    '<div class="promo" data-y="0">{2}</div>', '<aside class="related" data-y="0"><h3>{3}</h3>{1}</aside>', '<form data-y="0"><label>{3}</label><input></form>',
    '<div class="sponsored" data-y="0"><p>{0}</p></div>', '<div id="ad-1" data-y="0">{2}</div>',
    '<aside data-y="0">{0}</aside>', '<aside data-y="0">{2}</aside>', '<div role="alert" data-y="0">{0}</div>', '<div class="notice" data-y="0"><p>{0}</p></div>',
    '<nav data-y="0">{1}</nav>', '<div class="share" data-y="0">{3}</div>', '<div class="author-bio" data-y="0">{2}</div>',
)
ENDS = (
    '<aside class="sidebar" data-y="0"><h3>{3}</h3><p>{0}</p>{1}</aside>', '<div class="sidebar" data-y="0"><div class="widget"><p>{2}</p></div>{1}</div>',
    '<section class="comments" data-y="0"><h2>{3}</h2><div class="comment"><p>{0}</p></div><div class="comment"><p>{2}</p></div></section>',
    '<div id="comments" data-y="0"><ol><li><p>{0}</p></li><li><p>{2}</p></li></ol></div>', '<ul class="comment-list" data-y="0"><li>{0}</li><li>{2}</li></ul>',
    '<footer data-y="0">{2}</footer>', '<div id="footer" data-y="0"><p>{2}</p>{1}</div>', '<footer class="site-footer" data-y="0">{1}<p>{2}</p></footer>',
    '<div class="related-posts" data-y="0"><h3>{3}</h3>{1}</div>', '<form class="search" data-y="0"><label>{3}</label><input></form>',
    '<form id="subscribe" data-y="0"><p>{2}</p><input><button>{3}</button></form>', '<div class="copyright" data-y="0">{2}</div>',
    '<section id="reader-comments" data-y="0"><article class="comment"><header>{3}</header><p>{0}</p></article></section>', '<aside data-y="0">{1}</aside>',
    '<div class="pagination" data-y="0">{1}</div>', '<div class="legal" data-y="0">{0}</div>',
)


def layout(texts: list[str], rng: random.Random) -> str:
    """A page made of paragraphs, in which each part's label is known."""

    def some() -> str:
        return markup.escape(rng.choice(texts), quote=False)

    def short() -> str:
        words = some().split()
        return " ".join(words[: rng.randint(2, 12)])

    def fill(template: str) -> str:
        names = [short().split()[0] for _ in range(rng.randint(2, 8))]
        links = "".join(f'<li><a href="/{i}">{name}</a></li>' for i, name in enumerate(names))
        many = "</p><p>".join(some() for _ in range(rng.choice((1, 1, 2))))
        return template.format(many, f"<ul>{links}</ul>", short(), short())

    tag = rng.choice(("p",) * 6 + ("div",))

    def part() -> str:
        kind = rng.random()
        if kind < 0.7:
            return f"<{tag}>{some()}</{tag}>"
        if kind < 0.76:
            return f"<h2>{short()}</h2><{tag}>{some()}</{tag}>"
        if kind < 0.8:
            return f"<ul><li>{some()}</li><li>{short()}</li></ul>"
        if kind < 0.85:
            return rng.choice(("<blockquote><p>{0}</p></blockquote>", "<blockquote>{0}</blockquote>", "<pre>{0}</pre>")).format(some())
        if kind < 0.88:
            return f"<figure><img src=x><figcaption>{short()}</figcaption></figure>"
        if kind < 0.9:
            return f"<table><tr><td>{short()}</td><td>{some()}</td></tr></table>"
        return fill(rng.choice(MIDDLES))

    title = rng.choice(("<h1>{0}</h1>",) * 4 + ("<header><h1>{0}</h1></header>", '<div class="title"><h1>{0}</h1></div>', "<h2>{0}</h2>", ""))
    main = title.format(short()) + "".join(part() for _ in range(rng.choice((1, 2, 3, 5, 8, 13))))
    if rng.random() < 0.25:
        main += fill(rng.choice(ENDS))
    if rng.random() < 0.3:
        main = main.replace("<p>", '<p class="text">')
    body = "".join(fill(t) for t in rng.sample(TOPS, rng.randint(1, 3)))
    if rng.random() < 0.4:
        body += fill(rng.choice(MIDDLES))
    if rng.random() < 0.2:
        body += fill(rng.choice(ENDS))
    body += rng.choice(MAINS).format(main) + "".join(fill(t) for t in rng.sample(ENDS, rng.randint(1, 4)))
    return f"<html><body>{rng.choice(('{}', '<div class="wrap">{}</div>', '<div id="page"><div>{}</div></div>')).format(body)}</body></html>"


def _named(html: str) -> str:
    """The same page with labels on the parts that HTML names, for pages that name an article."""
    html = GOLD.sub("", html)
    for tag, label in (("article", 1), ("main", 1), ("nav", 0), ("footer", 0), ("aside", 0), ("form", 0), ("header", 0)):
        html = html.replace(f"<{tag}", f'<{tag} data-y="{label}"')
    return html.replace('class="ad"', 'class="ad" data-y="0"')


def train(pages: list[str]) -> Trees:
    """Fit on pages' html."""
    rng = random.Random(7)
    texts = sorted({t for html in pages for node, t in Page(html).leaves if len(t) >= 40})
    # A page that names no part is still usable as a source of text.
    examples = [_named(h) for h in pages if "<article" in h or "<main" in h]
    examples += [layout(texts, rng) for _ in range(LAYOUTS if texts else 0)]
    rows, labels, weights = [], [], []
    for html in examples:
        page = Page(html)
        gold = np.array([-1 if y is None else y for y in page.gold])
        picked = np.flatnonzero(gold >= 0)
        rows.append(page.features()[picked])
        labels.append(gold[picked])
        weights.append(np.ones(len(picked)))
    if not rows:
        return Trees()
    return boost(np.concatenate(rows), np.concatenate(labels).astype(float), np.concatenate(weights))


def fit(pages: DataFrame, limit: int = TRAIN_PAGES) -> Trees:
    picked = pages.select(F.col("page_id").cast("long"), "html").where("html IS NOT NULL")
    ids = picked.select("page_id").where("page_id IS NOT NULL").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(limit)
    # ``limit`` ids, and one page of each: where an id repeats, the one whose html has the smallest hash.
    chosen = picked.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(
        F.min(F.struct(F.xxhash64("html").alias("h"), "html")).alias("row")
    )
    return train(sorted(r["html"] for r in chosen.select("row.html").collect()))


def extract(pages: DataFrame, model: Trees) -> DataFrame:
    """page_id, url, main text and its length in code points, for every row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                parsed = [Page(html or "") for html in part["html"].to_pylist()]
                features = [p.features() for p in parsed]
                ends = np.cumsum([len(f) for f in features])
                logits = np.split(model.logits(np.concatenate(features)), ends[:-1])
                texts = [p.text(x) for p, x in zip(parsed, logits, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(read, EXTRACTED)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
