"""Pages of any markup have lines, and a main body or none, without errors."""

import random

from ledgerline.llm.boilerplate import main_content, main_lines, read_lines

PIECES = ["<![foo[", "<![", "<![if x]>", "<!DOCTYPE ", "<!x", "<!--", "-->", "<!", "<?", "<p>", "</p>", "<div>", "</div>", "<main>", "<a href='x'>", "</a>", "<h1>", "<h2>", "<li>", "<td>", "text of some words, longer than others. ", "&amp;", "&#x110000;", "&", "<", "</", ">", "\x00", "<script>", "</script>", "<title>", "</title>", "<button>", "'", '"', "<p", "/>"]


def odd_pages(n):
    rng = random.Random(2)
    for _ in range(n):
        yield "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 20)))


def test_odd_pages():
    for text in odd_pages(4000):
        page = read_lines(text)
        texts = {h for h in page["text"] if h % 2}
        for repeated, common in ((set(), set()), (texts, texts), (texts, set()), (texts, None)):
            found = main_lines(page, repeated, common)
            assert found == sorted(set(found)) and all(1 <= k <= len(page["tag"]) for k in found)


def test_odd_pages_in_a_table(spark):
    rows = [(str(k), f"https://s{k % 3}.example/{k}", text) for k, text in enumerate(odd_pages(200))]
    assert main_content(spark.createDataFrame(rows, "id string, u string, h string"), "id", "u", "h").count() > 0
