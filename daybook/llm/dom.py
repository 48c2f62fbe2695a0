"""Block elements of an HTML page as a tree, with features, from one pass over its tags."""

from __future__ import annotations

import re
from html import unescape

import numpy as np

# A tag without "<" or ">" in its attributes, which nearly all are, or a lone "<". Nothing is read twice: no part gives
# back what it took, and none goes beyond the next "<".
MARK = re.compile(
    r"<(?:(/?)([a-zA-Z][^\s/<>]*+)([^<>\"']*+(?:\"[^\"<>]*+\"[^<>\"']*+|'[^'<>]*+'[^<>\"']*+)*+)>)?"
)
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)")
SPECIAL = re.compile("[>\"']")
# Elements whose inside is no text of the page.
RAW = frozenset("script style title noscript template svg iframe textarea select object".split())
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label|itemprop|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
GOLD = re.compile(r"data-y=\"([01])\"")
WORD = re.compile(r"[a-z]+")

# Elements by kind.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul "
    "button head title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())
SCOPES = frozenset("ul ol dl table tbody thead tfoot tr div section article body html nav aside footer header form main".split())
KINDS = (
    ("p",), ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"), ("li", "dt", "dd"), ("ul", "ol", "dl", "menu"), ("div", "section", "center"),
    ("article", "main"), ("nav",), ("header",), ("footer", "address"), ("aside", "dialog", "details", "summary"),
    ("form", "fieldset", "label", "legend", "option", "button"), ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"),
    ("blockquote", "pre", "figure", "figcaption"), ("head", "title"), ("html", "body"),
)
# Words of class, id and role attributes, by what they say of an element.
TOKENS = (
    ("content", "article", "post", "entry", "story", "body", "text", "main", "articlebody", "prose", "blog", "page"),
    ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "tabs", "toc", "dropdown"),
    ("header", "masthead", "topbar", "banner", "logo", "top", "branding"),
    ("footer", "foot", "copyright", "bottom", "legal", "colophon", "contentinfo"),
    ("sidebar", "aside", "side", "widget", "rail", "complementary", "secondary"),
    ("cookie", "cookies", "notice", "consent", "gdpr", "alert", "popup", "modal", "overlay", "message", "warning", "privacy"),
    ("ad", "ads", "advert", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "commercial"),
    ("form", "search", "newsletter", "subscribe", "signup", "login", "register", "contact", "feedback", "input"),
    ("comment", "comments", "reply", "replies", "discussion", "disqus", "respond", "reader", "commentlist", "thread"),
    ("share", "social", "related", "recommended", "tags", "meta", "byline", "popular", "trending", "links", "more", "follow", "recent", "author", "bio"),
)
KIND_OF = {tag: i for i, tags in enumerate(KINDS) for tag in tags}
TOKEN_OF: dict[str, list[int]] = {}
for _i, _words in enumerate(TOKENS):
    for _word in _words:
        TOKEN_OF.setdefault(_word, []).append(_i)
OUTSIDE = (6, 7, 8, 9, 10)  # kinds that are about the page rather than its article
N_FEATURES = len(KINDS) + 2 * len(TOKENS) + 20


class Tags:
    """Tags, comments and raw elements of a page in page order, in time linear in its length, however broken it is.

    Iteration gives (start, end, closing, name, attributes); the name is None for what is skipped as a whole. A tag ends at
    its first ">" outside quotes; where there is none, or a quote stays open, its "<" is text.
    """

    def __init__(self, html: str):
        self.html = html
        self._ends: dict[int, int] = {}  # by place of a quote or ">" outside quotes: where a tag that gets there ends
        self._special = self._close = (0, 0)  # the next of them from a place on, as (place, found)

    def __iter__(self):
        html, at = self.html, 0
        while True:
            for m in MARK.finditer(html, at):
                name = m[2]
                start, end = m.span()
                if name is None:
                    found = self._slow(start)
                    if found is None:
                        continue
                    end, closing, name, attributes = found
                else:
                    closing, attributes = m[1], m[3]
                    name = name.lower()
                    if closing or name not in RAW:
                        yield start, end, closing, name, attributes
                        continue
                if name in RAW and not closing:
                    last = RAW_END[name].search(html, end)
                    end, name = last.end() if last else len(html), None
                yield start, end, closing, name, attributes
                at = end
                break
            else:
                return

    def _slow(self, start: int) -> tuple[int, str, str | None, str] | None:
        """What begins at a "<": its end and parts; None where it is text."""
        html = self.html
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            return (len(html) if end < 0 else end + 3), "", None, ""
        if html.startswith(("<!", "<?"), start):
            self._close = self._next(self._close, start, lambda at: html.find(">", at))
            end = self._close[1]
            return None if end < 0 else (end + 1, "", None, "")
        m = NAME.match(html, start)
        if not m:
            return None
        self._special = self._next(self._special, m.end(), self._find_special)
        end = self._end(self._special[1])
        return None if end < 0 else (end, m[1], m[2].lower(), html[m.end() : end - 1])

    @staticmethod
    def _next(known: tuple[int, int], at: int, find) -> tuple[int, int]:
        """What was found before still is the next one if ``at`` lies before it."""
        since, found = known
        return known if since < at and (found < 0 or at <= found) else (at, find(at))

    def _find_special(self, at: int) -> int:
        m = SPECIAL.search(self.html, at)
        return m.start() if m else -1

    def _end(self, at: int) -> int:
        """Behind the first ">" outside quotes, from a quote or ">" on; -1 where none comes."""
        html, ends, path = self.html, self._ends, []
        while at >= 0 and at not in ends:
            path.append(at)
            if html[at] == ">":
                ends[at] = at + 1
                break
            closed = html.find(html[at], at + 1)
            at = self._find_special(closed + 1) if closed >= 0 else -1
        end = ends[at] if at >= 0 else -1
        ends.update(dict.fromkeys(path, end))
        return end


class Page:
    """Block elements in page order: ``parent`` of each, and its features; ``leaves`` are (element, text) in page order."""

    def __init__(self, html: str):
        self.parent, self.kind, self.tokens, self.gold = [-1], [len(KINDS) - 1], [0], [None]
        self.depth, self.start, self.tags, self.links = [0], [0], [0], [0]
        self.leaves: list[tuple[int, str]] = []
        self._read(html)

    def _open(self, tag: str, attributes: str, parent: int, at: int) -> int:
        bits = 0
        gold = None
        if "=" in attributes:
            for found in ATTRIBUTE.findall(attributes):
                for word in WORD.findall("".join(found).lower()):
                    for i in TOKEN_OF.get(word, ()):
                        bits |= 1 << i
            if "data-y" in attributes and (m := GOLD.search(attributes)):
                gold = int(m[1])
        self.parent.append(parent)
        self.kind.append(KIND_OF.get(tag, 4))
        self.tokens.append(bits)
        self.gold.append(gold if gold is not None else self.gold[parent])
        self.depth.append(self.depth[parent] + 1)
        self.start.append(at)
        self.tags.append(0)
        self.links.append(0)
        return len(self.parent) - 1

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # open elements; inline ones carry their block's number
        places: dict[str, list[int]] = {}  # where in the stack each tag is open
        scopes = [0]  # where in the stack elements are open that shield those outside them
        pieces: list[str] = []
        in_link = 0
        at = 0

        def flush() -> None:
            if pieces:
                text = "".join(pieces)
                if "&" in text:
                    text = unescape(text)
                text = " ".join(text.split())
                if text:
                    self.leaves.append((stack[-1][1], text))
                pieces.clear()

        def open_(tag: str, node: int) -> None:
            places.setdefault(tag, []).append(len(stack))
            if tag in SCOPES:
                scopes.append(len(stack))
            stack.append((tag, node))

        def close(depth: int) -> int:
            closed = 0
            while len(stack) > depth:
                tag, _ = stack.pop()
                places[tag].pop()
                if tag in SCOPES:
                    scopes.pop()
                closed += tag == "a"
            return closed

        for start, end, closing, tag, attributes in Tags(html):
            if start > at:
                text = html[at:start]
                pieces.append(text)
                if in_link:
                    self.links[stack[-1][1]] += len(text)
            at = end
            if tag is None:
                continue
            own = stack[-1][1]
            if closing:
                if places.get(tag):
                    if tag in BLOCKS:
                        flush()
                    in_link -= close(places[tag][-1])
                elif tag in BLOCKS:
                    flush()
                continue
            self.tags[own] += 1
            if tag in VOID:
                if tag in ("br", "hr"):
                    pieces.append(" ")
                continue
            if tag in ("html", "body") and len(stack) <= 2:
                flush()
                continue
            if tag not in BLOCKS:
                open_(tag, own)
                in_link += tag == "a"
                continue
            flush()
            # A block closes an open paragraph; an item or cell closes its open predecessor.
            opened = max((places[name][-1] for name in {"p", tag if tag in CLOSED_BY_SAME else "p"} if places.get(name)), default=0)
            if opened and opened >= scopes[-1]:
                in_link -= close(opened)
            open_(tag, self._open(tag, attributes, stack[-1][1], start))
        if at < len(html):
            rest = html[at:]
            cut = rest.find("<")
            # A tag that the page's end cuts off is no text.
            pieces.append(rest[:cut] if cut >= 0 and next(iter(Tags(rest[cut:] + ">")), (1,))[0] == 0 else rest)
        flush()
        self.length = max(1, len(html))

    def features(self) -> np.ndarray:
        """A row per block element."""
        n = len(self.parent)
        parent = np.array(self.parent)
        own_text, marks, digits = np.zeros(n), np.zeros(n), np.zeros(n)
        for node, text in self.leaves:
            own_text[node] += len(text)
            marks[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
        kind, depth = np.array(self.kind), np.array(self.depth)
        total, tags, links = own_text.copy(), np.array(self.tags, dtype=float), np.array(self.links, dtype=float)
        all_marks = marks.copy()
        children = np.bincount(parent[1:], minlength=n)
        elements = np.ones(n)
        above_tokens, above_kinds = [0] * n, [0] * n
        for i in range(1, n):  # parents come first
            p = self.parent[i]
            above_tokens[i] = above_tokens[p] | self.tokens[p]
            above_kinds[i] = above_kinds[p] | 1 << self.kind[p]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            total[p] += total[i]
            tags[p] += tags[i] + 1
            links[p] += links[i]
            all_marks[p] += all_marks[i]
            elements[p] += elements[i]
        # Siblings, in page order: place among them, and the texts before and after.
        order = np.lexsort((np.arange(n), parent))
        group = parent[order]
        first = np.concatenate([[True], group[1:] != group[:-1]])
        begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        index = np.empty(n)
        index[order] = np.arange(n) - begin
        siblings = np.where(parent >= 0, children[np.maximum(parent, 0)], 1)
        before, after = np.zeros(n), np.zeros(n)
        before[order[1:]] = np.where(first[1:], 0, total[order[:-1]])
        after[order[:-1]] = np.where(first[1:], 0, total[order[1:]])
        same = np.zeros(n)
        pairs = np.maximum(parent, 0) * len(KINDS) + kind
        same[:] = np.bincount(pairs, minlength=pairs.max() + 1)[pairs] / np.maximum(1, siblings)

        bits = np.arange(len(TOKENS))
        kinds_above = np.array(above_kinds)
        columns = [
            np.eye(len(KINDS))[kind],
            (np.array(self.tokens)[:, None] >> bits) & 1,
            (np.array(above_tokens)[:, None] >> bits) & 1,
            np.stack([
                depth, children, np.log1p(tags), np.log1p(total), np.log1p(own_text), links / np.maximum(1, total),
                total / (tags + 1), all_marks / np.maximum(1, total), elements / (tags + 1), np.array(self.start) / self.length,
                siblings, index / np.maximum(1, siblings - 1), total / max(1.0, total[0]), same, np.log1p(before), np.log1p(after),
                (kinds_above >> 5) & 1, sum((kinds_above >> k) & 1 for k in OUTSIDE) > 0, total / np.maximum(1, total[np.maximum(parent, 0)]),
                total / np.maximum(1, elements),
            ], axis=1),
        ]
        return np.hstack(columns).astype(np.float32)

    def text(self, logits: np.ndarray) -> str:
        """Text of the elements kept. An element can only be kept inside kept ones; the choice with the best sum wins.

        Where no element is kept, text directly in body is the article.
        """
        n = len(self.parent)
        weight = np.zeros(n)
        for node, text in self.leaves:
            weight[node] += len(text)
        total = weight.copy()
        for i in range(n - 1, 0, -1):
            total[self.parent[i]] += total[i]
        gain = (logits * (weight + 0.5 * (total - weight))).tolist()
        for i in range(n - 1, 0, -1):
            if gain[i] > 0 or self.parent[i] < 0:
                gain[self.parent[i]] += gain[i]
        kept = [True] * n
        for i in range(1, n):
            kept[i] = kept[self.parent[i]] and gain[i] > 0
        inside = [text for node, text in self.leaves if kept[node] and node]
        # Text that stands in body itself is the article of a page that has no other.
        return " ".join(inside or (text for node, text in self.leaves if not node))
