"""The page reader against a plain one, and its time on pages that never close what they open."""

import random
import re
import time

import pytest

from daybook.llm.dom import RAW, Page, Tags

PARTS = (
    "<a ", "<p>", "</p>", '"', "'", ">", "x ", '<div class="a">', "</div>", "<!--", "-->", "<li>", "<ul>", "</ul>", "<script>",
    "</script>", "</SCRIPT >", "<br/>", "<!x>", '<b y="1>2">', "<", "</", "<td>", "<tr>", "<i>", "=", "<?php ", "<Title",
)


def plain_tags(html):
    """Character by character, from the definition."""
    at = 0
    while (start := html.find("<", at)) >= 0:
        at = start + 1
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = len(html) if end < 0 else end + 3
            yield start, at, None
            continue
        if html[start + 1 : start + 2] in ("!", "?"):
            if (end := html.find(">", start)) >= 0:
                at = end + 1
                yield start, at, None
            continue
        m = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)").match(html, start)
        if not m:
            continue
        i, quote = m.end(), ""
        while i < len(html) and (quote or html[i] != ">"):
            if quote:
                quote = "" if html[i] == quote else quote
            elif html[i] in "\"'":
                quote = html[i]
            i += 1
        if i == len(html):
            continue
        at, name = i + 1, m[2].lower()
        if name in RAW and not m[1]:
            last = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at, name = last.end() if last else len(html), None
        yield start, at, name


def test_tags_equal_plain_ones():
    rng = random.Random(1)
    for _ in range(5000):
        html = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16)))
        assert [(a, b, name) for a, b, _, name, _ in Tags(html)] == list(plain_tags(html)), html


@pytest.mark.parametrize("unit", ["<a ", 'x <b y "', "<b y '\"", "<aaa", "<!", "<script ", '</a "', "<h1>", "<i>", "<li>", "<p>", "<p", "&"])
def test_long_broken_pages_take_linear_time(unit):
    """A quadratic reader takes hours for each of these."""
    started = time.monotonic()
    Page(unit * (3_000_000 // len(unit)))
    assert time.monotonic() - started < 60


def test_text_before_a_tag_that_is_cut_off():
    assert [t for _, t in Page("<p>one</p>two <a href=").leaves] == ["one", "two"]
    assert [t for _, t in Page("<p>1 < 2 and 3 > 2</p>").leaves] == ["1 < 2 and 3 > 2"]
    assert [t for _, t in Page("<p>a" + "<i>" * 3000 + "b</p><footer>c</footer>").leaves] == ["ab", "c"]
