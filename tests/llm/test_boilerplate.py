import numpy as np

from ledgerline.llm.boilerplate import _smooth, _threshold, main_content, main_lines, read_lines

PROSE = "The {0} measures every {1} of the corpus and reports what it finds in plain words over many runs, because the {0} is new."


def word(k):
    return "".join("abcdefghij"[int(c)] for c in str(k))


def page(k, head="h1", flat=False, extra="", title=None):
    title = title or f"On subject {word(k)} and its measure"
    box, end = ("", "") if flat else ('<div class="a">', "</div>")
    body = "".join(f"<p>{PROSE.format(f'subject {word(k)}', f'part {word(n)}')}</p>\n" for n in range(4))
    return (
        f"<html><head><title>{title} - Site</title><script>var t='<p>x</p>';</script></head><body>\n<ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul>\n"
        f"{box}<{head} title='a > b'>{title}</{head}><!-- <p>no</p> -->\n<p>Ann {word(k)}; Cid {word(k * 3)}</p>\n{body}<div class=x><p>{k * 7} people look at this. Join them.</p></div><pre>run --seed {k}</pre>{extra}{end}\n"
        f"<h3>Reader comments</h3><p>Very good text, number {word(k)}, I would say so again and again to all.</p>\n<p>All marks belong to the owners of Site, who run it with the help of many member libraries.</p></body></html>"
    )


def blocks(html):
    return read_lines(html)


def test_blocks_are_counted_in_page_order():
    p = read_lines("<p>a<li>b<td><p></p><script>'<p>'</script><style>p{}</style><!--<p>--><blockquote>q<p>r</blockquote><H2 x='<p>'>h</H2>")
    assert len(p["tag"]) == 7 and p["chars"] == [1, 1, 0, 0, 1, 1, 1]
    assert read_lines("")["tag"] == [] and main_lines(read_lines(""), set()) == []


def test_smoothing_and_threshold():
    x = np.array([0.0, 0.0, 9.0, 9.0, 9.0, 0.0])
    s = _smooth(x, 1.0)
    assert s[3] > s[1] > s[0] and abs(_smooth(np.ones(5), 2.0) - 1).max() < 1e-9
    assert 0 < _threshold(x) < 9 and _threshold(np.array([3.0])) == 3.0


def test_main_content_over_a_site(spark):
    rows = [(f"p{k}", f"https://Site.example/abs/{k}", page(k, head="h1" if k % 2 else "h2", flat=k % 3 == 0)) for k in range(40)]
    rows += rows[:5] + [("again", "https://site.example/abs/1", page(1))] * 1 + [(f"r{k}", "https://site.example/abs/1", page(1)) for k in range(30)]
    rows += [("null", "https://site.example/x", None), ("empty", None, ""), (None, "https://site.example/y", page(1)), ("cut", "https://site.example/z", page(99)[:700]), ("lone", "https://other.example/1", page(77))]
    df = spark.createDataFrame(rows, "id string, source_url string, html string").withColumn("site", df_lit(spark)).withColumn("block_no", df_lit(spark))
    got = {}
    for r in main_content(df, "id", "source_url", "html").collect():
        assert r.block_no not in got.setdefault(r.id, [])
        got[r.id].append(r.block_no)
    # Blocks 1-2 are the menu, 3 the title, 4 the authors, 5-8 text, 9 the notice, 10 code, then comments and marks.
    for k in range(40):
        assert sorted(got[f"p{k}"]) == [3, 4, 5, 6, 7, 8, 10], k
    assert sorted(got["r3"]) == [3, 4, 5, 6, 7, 8, 10] and set(got["lone"]) >= {3, 4, 5, 6, 7, 8, 10} and min(got["cut"]) == 3
    assert not {"null", "empty"} & set(got)
    assert main_content(df.limit(0), "id", "source_url", "html").count() == 0


def df_lit(spark):
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_a_very_long_page(spark):
    html = page(1, extra="".join(f"<p>{PROSE.format('long', n)}</p>" for n in range(5000)))
    df = spark.createDataFrame([("a", "https://s.example/1", html)], "id string, u string, h string")
    assert main_content(df, "id", "u", "h").count() >= 5000
