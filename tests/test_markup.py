"""Pages of any markup are read without errors."""

import random
import time

from ledgerline.functions.markup import PageParser
from ledgerline.sources.pages import CONTAINERS, _Anchors

PIECES = ["<![foo[", "<![", "<![if x]>", "<![CDATA[", "]]>", "<!DOCTYPE ", "[", "<!x", "<!--", "-->", "<!", "<?", "?>", "<p>", "</p>", "<div>", "</div>", "<a href='x'>", "</a>", "text ", "&amp;", "&#x110000;", "&#99999999999;", "&", "<", "</", ">", '<td class="tablecell comments">', "\x00", "\ud800", "<script>", "</script>", "<title>", "'", '"', "=", "<p", "/>", "<!ELEMENT ", "%"]


def odd_pages(n=4000):
    rng = random.Random(1)
    for _ in range(n):
        yield "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14)))


def test_anchors_of_odd_pages():
    for text in odd_pages():
        _Anchors(CONTAINERS).read(text)


def test_an_unknown_section_is_a_comment():
    seen = []

    class Tags(PageParser):
        def handle_starttag(self, tag, attrs):
            seen.append(tag)

    p = Tags()
    p.feed("<p>a<![foo[ x ]]><li>b<![ y><td>c<![CDATA[<h1>]]><dt>")
    p.close()
    assert [t for t in seen if t != "h1"] == ["p", "li", "td", "dt"]


def test_what_never_ends_takes_time_in_proportion():
    began = time.process_time()
    for text in ("<p " * 40_000, "<p a='" * 40_000, "<!--" * 50_000, "<!--<p>" * 50_000, "<!x " * 50_000, "<?x " * 50_000, "</p " * 50_000, "<![x[" * 50_000):
        p = PageParser()
        p.feed(text)
        p.close()
    assert time.process_time() - began < 20


def test_cut_pages_keep_their_text():
    seen = []

    class Text(PageParser):
        def handle_data(self, data):
            seen.append(data)

    p = Text()
    p.feed("<p>a &amp; b <a href='x")
    p.close()
    assert "".join(seen) == "a & b <a href='x"
