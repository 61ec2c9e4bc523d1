"""Main content of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering.

Each page is read once by the standard library's streaming parser into lines, one a block. The logarithm of a line's text-to-tag ratio is
smoothed over its neighbours; two-means clustering of the smoothed ratios sets the threshold above which lines are content. A region is the
lines of one element from heading to heading; it is selected if enough of its text stands in content lines, and no block outside the
selected regions comes out. Text that a site repeats on many of its pages counts as no text, so that long legal notes don't pass for
content; which text that is, is counted over all pages of each site. The selected regions are then checked exactly: of elements the
lowest with the content's text and the title heading counts, from that heading on, without insets, repeated lines and sections below repeated headings.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.markup import PageParser
from ledgerline.operators.skew import salted_lookup
from ledgerline.session import cut

#: Start tags that open a block.
BLOCK_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "dt", "dd", "td", "pre", "blockquote", "figcaption")
_NUMBER = {t: k for k, t in enumerate(BLOCK_TAGS)}
_CONTAINERS = frozenset(("div", "main", "article", "section", "nav", "aside", "header", "footer", "form"))
#: Tags that mark words within a text, as highlighted code has in numbers; they say nothing about the page's structure and aren't counted.
_MARKS = frozenset(("span", "b", "i", "u", "s", "em", "strong", "code", "tt", "var", "kbd", "samp", "sub", "sup", "small", "big", "mark", "font", "q", "cite", "abbr", "dfn"))
_CONTROLS = frozenset(("button", "input", "select", "textarea"))
#: A text is a site's own if on this share of its other pages.
SHARE = 0.03
#: Within the article's own element a line must be on this share of the site's pages to count as the site's: few articles share a sentence by chance.
COMMON = 0.25
#: Standard deviation of the smoothing, in lines, and the share of a region's text that content lines must hold.
SIGMA, MOST = 0.75, 0.3
#: Sites' repeated texts go to all tasks up to this many hashes (8 MB); beyond, pages and texts meet in a salted join.
MOST_SHARED = 1 << 20
#: Tags whose text is compared with the site's repeated texts: not code, terms or table cells, whose short texts recur by nature.
_COMPARED = frozenset(_NUMBER[t] for t in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "blockquote", "figcaption"))
_HEADINGS = range(6)
_AFTER_HEADINGS = 6  # headings have the first numbers
_P, _LI, _TD = _NUMBER["p"], _NUMBER["li"], _NUMBER["td"]


class _Lines(PageParser):
    """Events of one page into lines: [tag, container, parent container, text, link chars, tags, controls]."""

    def __init__(self) -> None:
        super().__init__()
        self.lines: list[list] = []
        self.stack: list[tuple[str, int]] = []
        self.parents = {0: -1}
        self.here: list | None = None
        self.link = self.hidden = self.in_title = False
        self.title: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _NUMBER:
            self.here = [_NUMBER[tag], self.stack[-1][1] if self.stack else 0, [], 0, 1, 0]
            self.lines.append(self.here)
            self.link = False
        elif tag in _CONTAINERS:
            k = len(self.parents)
            self.parents[k] = self.stack[-1][1] if self.stack else 0
            self.stack.append((tag, k))
            self.here = None
        elif tag in ("script", "style"):
            self.hidden = True
        elif tag == "title":
            self.in_title = not self.lines
        elif self.lines:
            self.lines[-1][4] += tag not in _MARKS
            if tag == "a":
                self.link = True
            elif tag in _CONTROLS and (self.here is None or self.here is self.lines[-1]):
                self.lines[-1][5] += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.hidden = False
        elif tag == "title":
            self.in_title = False
        elif tag in _CONTAINERS:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == tag:
                    del self.stack[k:]
                    break
            self.here = None
        elif self.lines:
            self.lines[-1][4] += tag not in _MARKS
            if tag == "a":
                self.link = False

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title.append(data)
        elif self.here is not None and not self.hidden:
            self.here[2].append(data)
            if self.link:
                self.here[3] += len(data.strip())


_DIGITS = re.compile(r"\d+")


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def text_key(text: str) -> int:
    """A hash under which texts that differ in digits only are one: counts and dates don't make a notice another notice."""
    return _hash(_DIGITS.sub("0", text))


def read_lines(html: str) -> dict[str, list]:
    """One page's lines as parallel lists; number counts blocks from 1."""
    p = _Lines()
    p.feed(html)
    p.close()
    title = " ".join("".join(p.title).split())
    out: dict[str, list] = {k: [] for k in ("tag", "box", "chars", "links", "tags", "control", "title", "closed", "address", "text")}
    for tag, box, parts, links, tags, control in p.lines:
        text = " ".join("".join(parts).split())
        for key, value in zip(out, (tag, box, len(text), min(links, len(text)), tags, control > 0, bool(text) and title.startswith(text), text[-1:] in ".!?:;…", "://" in text, text_key(text) if text else 0)):
            out[key].append(value)
    out["parents"] = [p.parents[k] for k in range(len(p.parents))]
    return out


def _smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    radius = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(x)), kernel, "full")[radius : radius + len(x)]
    return np.convolve(x, kernel, "full")[radius : radius + len(x)] / weight


def _threshold(x: np.ndarray) -> float:
    """Between the means of two clusters on a line."""
    low, high = float(x.min()), float(x.max())
    for _ in range(20):
        middle = (low + high) / 2
        upper = x > middle
        if not upper.any() or upper.all():
            break
        new = float(x[~upper].mean()), float(x[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def content_lines(chars: np.ndarray, links: np.ndarray, tags: np.ndarray, own: np.ndarray, sigma: float = SIGMA, judged: np.ndarray | None = None) -> np.ndarray:
    """The content cluster: lines whose smoothed log text-to-tag ratio is above the threshold, which all lines or those in `judged` set; lines that are the site's own have no text."""
    smoothed = _smooth(np.log1p(np.where(own, 0.0, np.maximum(chars - links, 0.0) / np.maximum(tags, 1.0))), sigma)
    return smoothed >= _threshold(smoothed if judged is None else smoothed[judged])


def selected_regions(content: np.ndarray, chars: np.ndarray, tag: np.ndarray, box: np.ndarray, own: np.ndarray, title: int | None = None, most: float = MOST) -> np.ndarray:
    """Lines of the regions that the content cluster selects: those with `most` of their text in it, and the title's (if told its line) where the next is one, as names may stand alone below a title. A region is the lines of one element from heading to heading; elements within and the site's own lines don't end it, but aren't of it."""
    heads, region = (tag < _AFTER_HEADINGS) & ~own, np.zeros(len(tag), int)
    order = np.lexsort((np.arange(len(tag)), own, box))
    cuts = heads[order]
    cuts[1:] |= (box[order][1:] != box[order][:-1]) | (own[order][1:] != own[order][:-1])
    region[order] = np.cumsum(cuts)
    text, held = np.bincount(region, chars), np.bincount(region, np.where(content, chars, 0.0))
    chosen = (held > 0) & (held >= most * text)
    if title is not None:
        after = np.flatnonzero((region == region[title] + 1) & (box == box[title]) & ~own)
        chosen[region[title]] |= len(after) > 0 and chosen[region[title] + 1]
    return chosen[region]


def main_lines(page: dict, repeated: set[int], common: set[int] | None = None, sigma: float = SIGMA) -> list[int]:
    """Block numbers (from 1) of the main body of one page, given the texts its site repeats, and those it repeats on many pages (all, if not told)."""
    n = len(page["tag"])
    if n == 0:
        return []
    tag, box, chars = np.array(page["tag"]), np.array(page["box"]), np.array(page["chars"], float)
    links, tags, parents = np.array(page["links"], float), np.array(page["tags"], float), page["parents"]
    again = np.array([t in _COMPARED and h in repeated for t, h in zip(tag, page["text"])])
    own = (again & ~np.array(page["title"])) | np.array(page["control"])
    content = content_lines(chars, links, tags, own, sigma)
    # The article's element is the lowest that holds both the content cluster's text and the title. Text before the title or below a heading
    # that the site repeats doesn't choose it, unless there is no other.
    mass = np.bincount(box, np.where(content & ~own, chars, 0.0), minlength=len(parents))
    heads = [k for k in range(n) if tag[k] in _HEADINGS and page["title"][k]] or [k for k in range(n) if tag[k] == 0 and not own[k]]
    first = heads[0] if heads else 0
    free = content & ~own & (np.arange(n) >= first) & ~_headed(own, tag, box, parents)
    weight = np.bincount(box, np.where(free, chars, 0.0), minlength=len(parents))
    peak = int((weight if weight.any() else mass).argmax())
    if not heads and not mass[peak]:
        return []
    around = _ancestors(int(box[first]), parents) if heads else [peak]
    outer = set(around)
    home = next(b for b in _ancestors(peak, parents) if b in outer)
    if not home and (not weight.any() or 2 * mass[peak] < mass.sum()):  # only the page holds both: the cluster must be mostly there
        home = peak = around[0]
    # The elements on the way from the region to the cluster's text and to the title belong to it.
    way = {home} | {b for line in (_ancestors(peak, parents), around) for b in line[: line.index(home)]}
    # The relief for lines of the article's own element. Without one it takes that the page keeps its furniture in elements; on pages without
    # any, nothing tells a notice between the article's blocks from these but that an article names its sources by their addresses.
    if common is not None:
        spared = (box == home) & (np.arange(n) >= first) & (bool(home) or len(parents) > 1 or np.array(page["address"]))
        own &= ~spared | np.array(page["control"]) | np.array([h in common for h in page["text"]])
        content = content_lines(chars, links, tags, own, sigma)
    keep = selected_regions(content, chars, tag, box, own, first if heads else None) & (chars > 0) & ~own
    on_way = np.zeros(len(parents), bool)
    on_way[list(way)] = True
    on_way = on_way[box]
    beside = _headed(own, tag, box, parents)
    if beside.any() and not beside.all() and not keep[on_way].any():  # longer text beside the article sets the threshold above it
        content = content_lines(chars, links, tags, own, sigma, ~beside)
        keep = selected_regions(content, chars, tag, box, own, first if heads else None) & (chars > 0) & ~own
    # Page furniture stands beside an article without an element of its own, so only the way belongs to that.
    keep &= on_way | (_within(home or peak, parents)[box] if home or peak else False)
    if not home:
        keep &= ~((tag == _TD) & np.array([h in repeated for h in page["text"]]))
    # Sections below repeated headings, to the next heading that isn't or the end of its element; below other repeated labels, the lists and
    # tables that follow. A section in the region that holds text of the content cluster is the article's, and its heading with it.
    text = content & ~own & (links < 0.9 * chars)
    fixed = _fixed(keep, text, own, beside, tag, box, chars, home)
    under = 0
    for k in range(n):
        if fixed[k]:
            keep[k] |= tag[k] in _HEADINGS
            under = 0
        elif own[k]:
            under = 2 if tag[k] in _HEADINGS else max(under if beside[k] else 0, 1) if tag[k] == _P and chars[k] and not page["closed"][k] and _labels(k, tag, chars, links) else under if under == 2 and beside[k] else 0
        elif under == 2 and not beside[k] or under == 1 and tag[k] not in (_LI, _TD):
            under = 0
        if under and tag[k] != 0:
            keep[k] = False
    return (np.flatnonzero(keep) + 1).tolist()


def _labels(k: int, tag: np.ndarray, chars: np.ndarray, links: np.ndarray) -> bool:
    """Whether what follows line k at once is a list of nothing but links, or a table."""
    end = k + 1
    while end < len(tag) and tag[end] == _LI:
        end += 1
    run = slice(k + 1, end)
    return bool((links[run] >= 0.9 * chars[run]).all()) if end > k + 1 else end < len(tag) and tag[end] == _TD


def _ancestors(b: int, parents: list[int]) -> list[int]:
    """An element and those around it, from the inside, down to the page (0)."""
    out = [b]
    while parents[out[-1]] >= 0:
        out.append(parents[out[-1]])
    return out


def _headed(own: np.ndarray, tag: np.ndarray, box: np.ndarray, parents: list[int]) -> np.ndarray:
    """Which lines stand below a heading that is the site's, to the next heading or the end of its element."""
    out, inside, known = np.zeros(len(tag), bool), None, {}
    for k in range(len(tag)):
        if tag[k] in _HEADINGS:
            b = int(box[k])
            if own[k] and b not in known:
                known[b] = _within(b, parents)
            inside = known[b] if own[k] else None
        elif inside is not None and not inside[box[k]]:
            inside = None
        out[k] = inside is not None
    return out


def _fixed(keep: np.ndarray, text: np.ndarray, own: np.ndarray, below: np.ndarray, tag: np.ndarray, box: np.ndarray, chars: np.ndarray, home: int) -> np.ndarray:
    """Lines of the article's sections below headings that the site repeats: those with text of the content cluster.

    At page level the notes of readers may follow the article under such headings, so there they are the article's only if most of the text is theirs.
    """
    out = np.zeros(len(tag), bool)
    if not home and chars[keep & text & below].sum() <= chars[keep & text & ~below].sum():
        return out
    first, inside = int(np.argmax(keep)), np.bincount(box[keep], minlength=int(box.max()) + 1)[box] > 0
    for k in np.flatnonzero(below & (tag < _AFTER_HEADINGS) & inside & (np.arange(len(tag)) > first)):
        end = k + 1
        while end < len(tag) and below[end] and tag[end] not in _HEADINGS:
            end += 1
        if (keep & text)[k:end].any():
            out[k:end] = True
            out[k + 1 : end] &= ~own[k + 1 : end]
    return out


def _within(home: int, parents: list[int]) -> np.ndarray:
    inside = np.zeros(len(parents), bool)
    for k in range(len(parents)):  # parents come before their children
        inside[k] = k == home or (parents[k] >= 0 and inside[parents[k]])
    return inside


_PAGE_SCHEMA = "id string, site string, url bigint, tag array<tinyint>, box array<int>, chars array<int>, links array<int>, tags array<int>, control array<boolean>, title array<boolean>, closed array<boolean>, address array<boolean>, text array<bigint>, parents array<int>"


def _site(url: str | None) -> str:
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", url or "")
    return m.group(1).lower() if m else ""


def main_content(df: DataFrame, record_id: str, url: str, html: str, share: float = SHARE, most_shared: int = MOST_SHARED) -> DataFrame:
    """(id, block_no): one row for each block of the main body of each page.

    Pages are parsed once, into compact lines that are written to the shared folder. Texts are counted over all pages of each site (a
    site is a URL's host; a URL fetched again and again counts once); a site's repeated texts number at most (blocks a page) / share. They
    are sent to all tasks while there are at most most_shared of them; else they are looked up with hot sites spread over tasks. Python gets of
    them what stands on the page. NULL ids and pages give nothing, as do pages without blocks; rows written twice (same id)
    count once; pages without a URL are one site. Blocks without visible text are left out. Columns besides the three named are not read.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{"id": i, "site": _site(u), "url": _hash(u or ""), **read_lines(h)} for i, u, h in zip(pdf["id"], pdf["url"], pdf["html"])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _PAGE_SCHEMA.split(", ")])

    pages = df.select(F.col(record_id).cast("string").alias("id"), F.col(url).alias("url"), F.col(html).alias("html")).where(F.col("id").isNotNull() & F.col("html").isNotNull())
    lines = cut(pages.mapInPandas(parse, _PAGE_SCHEMA))
    seen = lines.select("site", "url", F.explode(F.array_distinct("text")).alias("text")).where(F.col("text") != 0).distinct().groupBy("site", "text").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    total = lines.select("site", "url").distinct().groupBy("site").agg(F.count(F.lit(1)).alias("n_pages"))
    repeated = cut(
        seen.join(total, "site")
        .where(F.col("n") - 1 >= share * (F.col("n_pages") - 1))
        .groupBy("site")
        .agg(F.collect_list("text").alias("repeated"), F.collect_list(F.when(F.col("n") >= COMMON * F.col("n_pages"), F.col("text"))).alias("common"))
    )
    few = (repeated.agg(F.sum(F.size("repeated"))).first()[0] or 0) <= most_shared
    met = lines.join(F.broadcast(repeated), "site", "left") if few else salted_lookup(lines, repeated, "site", "id")
    here = met.withColumns({c: F.coalesce(F.array_intersect("text", c), F.array().cast("array<bigint>")) for c in ("repeated", "common")}).drop("site", "url")

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, numbers = [], []
            for row in pdf.to_dict("records"):
                found = main_lines(row, set(row["repeated"].tolist()), set(row["common"].tolist()))
                ids += [row["id"]] * len(found)
                numbers += found
            yield pd.DataFrame({"id": pd.Series(ids, dtype=object), "block_no": pd.Series(numbers, dtype="int64")})

    return here.mapInPandas(choose, "id string, block_no bigint").distinct()


def page_blocks(df: DataFrame, record_id: str, html: str) -> DataFrame:
    """(id, blocks): how many blocks each page has, as main_content numbers them; NULL ids and pages give nothing, rows written twice count once."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "blocks": pd.Series([len(read_lines(h)["tag"]) for h in pdf["html"]], dtype="int64", index=pdf.index)})

    pages = df.select(F.col(record_id).cast("string").alias("id"), F.col(html).alias("html")).where(F.col("id").isNotNull() & F.col("html").isNotNull())
    return pages.mapInPandas(count, "id string, blocks bigint").distinct()
