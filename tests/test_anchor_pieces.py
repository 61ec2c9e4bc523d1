"""Pages are read up to the end of their last container, with the same anchors as when they are read whole."""

import random

from ledgerline.sources.pages import CONTAINERS, _Anchors


def whole(text):
    p = _Anchors(CONTAINERS)
    p.feed(text)
    p.close()
    return p.found


def test_same_as_the_whole_page():
    rng = random.Random(5)
    pieces = ['<blockquote class="abstract">', "</blockquote>", '<td class="tablecell comments">', "</td>", '<div class="x extra-services">', "</div>", "<div>", '<a href="https://h/a/b">code', "</a>", "text & more", "<p>", "<br>", "<!-- comments -->", "<script>var t='</td>';</script>", "&amp;", "filler " * 60, '<a href="/x">', "abstract"]
    for _ in range(600):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        text = text[: rng.randint(0, len(text))] if rng.random() < 0.3 else text
        assert _Anchors(CONTAINERS).read(text) == whole(text), text


def test_the_rest_is_left_unread():
    p = _Anchors(CONTAINERS)
    p.read('<td class="tablecell comments"><a href="u">x</a></td>' + "<p>y</p>" * 10_000)
    assert p.seen < 200 and len(p.found) == 1
