"""The region of a page: which element, which repeated lines and which sections belong to the article."""

import numpy as np

from ledgerline.llm.boilerplate import main_lines, read_lines, text_key


def prose(k):
    return f"The {'abcdefghij'[k % 10] * (k + 1)} measures every part of the corpus and reports what it finds in plain words over many runs, because it is new."


MENU = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav>"
FOOT = "<footer><p>All marks belong to their owners.</p></footer>"


def wrap(body):
    return read_lines(f"<title>On a subject - Site</title>{MENU}{body}{FOOT}")


def test_text_beside_the_title_element_is_in_the_region():
    text = "".join(f"<p>{prose(k)}</p>" for k in range(4))
    marks = {text_key("All marks belong to their owners.")}
    # Blocks 1-2 are the menu, 3 the title, 4 the authors, 5-8 the text.
    for body in (
        f"<main><header><h1>On a subject</h1><p>Ann Lee</p></header><div>{text}</div></main>",
        f"<header><h1>On a subject</h1><p>Ann Lee</p></header><div>{text}</div>",
        f"<h1>On a subject</h1><p>Ann Lee</p><div>{text}</div>",
    ):
        assert main_lines(wrap(body), marks, marks) == [3, 4, 5, 6, 7, 8], body


def test_longer_comments_do_not_move_the_region():
    body = "<div><h1>On a subject</h1><p>Ann Lee</p><p>A short text of the article is here.</p></div>"
    comments = f"<div><h3>Reader comments</h3>{''.join(f'<p>{prose(k)}</p>' for k in range(4))}</div>"
    assert main_lines(wrap(body + comments), {text_key("Reader comments")}, set()) == [3, 4, 5]


CODE = "Code: https://forge.example/a/kit"


def test_a_shared_source_line_stays_without_an_own_element():
    """A line on 3 % of a site's pages, but not on 25 %, after a title at page level."""
    body = f"<h1>On a subject</h1>{''.join(f'<p>{prose(k)}</p>' for k in range(3))}<p>{CODE}</p>"
    foot = text_key("All marks belong to their owners.")
    assert main_lines(wrap(body), {foot, text_key(CODE)}, {foot}) == [3, 4, 5, 6, 7]
    assert main_lines(read_lines(f"<title>On a subject</title>{body}<p>All marks belong to their owners."), {foot, text_key(CODE)}, {foot}) == [1, 2, 3, 4, 5]
    # On most pages it is the site's; and a notice between the blocks of a page without elements is too.
    assert main_lines(wrap(body), {foot, text_key(CODE)}, {foot, text_key(CODE)}) == [3, 4, 5, 6]
    notice = body.replace(CODE, "We use cookies.")
    assert main_lines(read_lines(f"<title>On a subject</title>{notice}"), {text_key("We use cookies.")}, set()) == [1, 2, 3, 4]


def test_the_relief_over_a_site(spark):
    def html(k):
        name = "".join("abcdefghij"[int(c)] for c in str(k))
        return f"<title>On {name}</title><h1>On {name}</h1>{''.join(f'<p>{name} {prose(n)}</p>' for n in range(3))}{f'<p>{CODE}</p>' if k < 5 else ''}<p>All marks belong to their owners."

    from ledgerline.llm.boilerplate import main_content

    df = spark.createDataFrame([(f"p{k}", f"https://flat.example/{k}", html(k)) for k in range(60)], "id string, u string, h string")
    got = {(r.id, r.block_no) for r in main_content(df, "id", "u", "h").collect()}
    assert got == {(f"p{k}", b) for k in range(60) for b in range(1, 6 if k < 5 else 5)}


def test_sections_below_fixed_heads_are_the_articles():
    sections = "".join(f"<h2>{head}</h2><p>{prose(2 * k)}</p><p>{prose(2 * k + 1)}</p>" for k, head in enumerate(("Abstract", "Methods", "References")))
    more = "<h3>You may also like</h3><ul><li><a href=/x>Another work of the site</a><li><a href=/y>A third work of the site</a></ul>"
    fixed = {text_key(t) for t in ("Abstract", "Methods", "References", "You may also like", "All marks belong to their owners.")}
    for body in (f"<article><h1>On a subject</h1><p>Ann Lee</p>{sections}{more}</article>", f"<h1>On a subject</h1><p>Ann Lee</p>{sections}{more}"):
        # Blocks 1-2 are the menu, 3 the title, 4 the authors, 5-13 the sections, then a list of other works.
        assert main_lines(wrap(body), fixed, fixed) == list(range(3, 14)), body


def test_a_section_ends_with_its_element():
    aside = "<aside><h3>You may also like</h3><p><a href=/x>Another work of the site</a></p></aside>"
    body = f"<article><h1>On a subject</h1><p>{prose(0)}</p>{aside}<p>{prose(1)}</p><p>{prose(2)}</p></article>"
    assert main_lines(wrap(body), {text_key("You may also like")}, {text_key("You may also like")}) == [3, 4, 7, 8]


def test_many_tags_and_many_elements(spark):
    from ledgerline.llm.boilerplate import main_content

    spans = f"<h1>On a subject</h1><p>{prose(0)}</p><pre>{'<span>x</span>' * 50000}</pre>"
    boxes = f"{'<div></div>' * 50000}<div><h1>On a subject</h1><p>{prose(0)}</p></div>"
    df = spark.createDataFrame([("a", "https://s.example/1", spans), ("b", "https://t.example/2", boxes)], "id string, u string, h string")
    assert {(r.id, r.block_no) for r in main_content(df, "id", "u", "h").collect()} == {("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2)}


def test_the_clusters_of_ratios_decide(spark, monkeypatch):
    """Random numbers in place of smoothed ratios lose the article; without them it is whole."""
    from ledgerline.llm import boilerplate

    pages = []
    for k in range(40):
        sections = "".join(f"<h2>Part {'abcdefghij'[n]} of {k}</h2><p>{prose(n)}</p><p>{prose(n + 1)}</p>" for n in range(4))
        pages.append(wrap(f"<main><h1>On a subject</h1><p>Ann Lee</p>{sections}</main>"))
    marks = {text_key("All marks belong to their owners.")}
    assert all(main_lines(p, marks, marks) == list(range(3, 17)) for p in pages)
    rng = np.random.RandomState(1)
    monkeypatch.setattr(boilerplate, "_smooth", lambda x, sigma: rng.rand(len(x)))
    found = sum(len(set(main_lines(p, marks, marks)) & set(range(3, 17))) for p in pages)
    assert found < 0.8 * 14 * len(pages)


def test_text_repeated_on_few_sites_or_many_is_found_alike(spark):
    """The shared and the salted way of meeting a site's texts give the same rows."""
    from ledgerline.llm.boilerplate import main_content

    rows = [(f"p{k}", f"https://s{k % 3}.example/{k}", f"<title>On {'abcdefghij'[k % 10] * k}</title>{MENU}<h1>On {'abcdefghij'[k % 10] * k}</h1><p>{prose(k)}</p><p>{prose(k + 1)} {k * 'x'}</p>{FOOT}") for k in range(1, 31)]
    df = spark.createDataFrame(rows, "id string, u string, h string")
    assert sorted(map(tuple, main_content(df, "id", "u", "h").collect())) == sorted(map(tuple, main_content(df, "id", "u", "h", most_shared=0).collect()))
