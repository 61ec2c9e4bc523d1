"""Explicit links inside the content containers of article pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.markup import PageParser
from ledgerline.functions.urls import RESERVED_OWNERS, repo_url
from ledgerline.operators.associate import first_of_each

# The containers whose links are evidence, as (tag or "", classes), in order of precedence.
CONTAINERS = (("blockquote", ("abstract",)), ("td", ("tablecell", "comments")), ("td", ("tablecell", "jref")), ("", ("extra-services",)), ("", ("full-text-links",)))
# Elements that have no end.
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer"))


#: Characters parsed at once past the last mention of a container's class.
_PIECE = 256


class _Anchors(PageParser):
    """Anchors by container: an end tag closes the nearest open element of its name and all within; others are ignored; nothing closes by itself."""

    def __init__(self, containers: Sequence[tuple[str, Sequence[str]]]):
        super().__init__()
        self.containers = containers
        self.open: list[list] = []  # [tag, anchor or None, [(container's order, its number, tag, classes)]]
        self.seen = 0
        self.found: list[list] = []  # [order, number, tag, classes, href, text parts]

    def read(self, text: str) -> list[list]:
        """The anchors found; what follows the last container's end isn't parsed."""
        at = max((text.rfind(c[-1]) for _, c in self.containers), default=-1)
        if at < 0:  # where no container's class stands in the text there is none in the page
            return []
        # Pieces end before a tag, so that no text between two tags is cut.
        after = lambda k: (text.find("<", k) + 1 or len(text) + 1) - 1
        last = end = after(at)
        self.feed(text[:end])
        # On while the last mention may be in a tag that isn't whole yet, or a container is open.
        while end < len(text) and (end - len(self.rawdata) < last or self.open and self.open[-1][2]):
            start, end = end, after(end + _PIECE)
            self.feed(text[start:end])
        self.close()
        return self.found

    def handle_starttag(self, tag: str, attrs: list) -> None:
        values = dict(attrs)
        classes = (values.get("class") or "").split()
        around = list(self.open[-1][2]) if self.open else []
        anchors = []
        if tag == "a" and values.get("href"):
            anchors = [[order, number, t, c, values["href"], []] for order, number, t, c in around]
            self.found += anchors
        for order, (t, wanted) in enumerate(self.containers):
            if t in ("", tag) and all(w in classes for w in wanted):
                around.append((order, self.seen, tag, classes))
        self.seen += 1
        if tag not in _VOID:
            self.open.append([tag, anchors, around])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        text = data.strip()
        if text:
            for element in self.open:
                for anchor in element[1]:
                    anchor[5].append(text)


_SCHEMA = "page_id string, page_url string, observed_at timestamp, container_order int, container_no int, anchor_no int, container string, href string, evidence_text string"


def anchors(pages: DataFrame, page_id: str, page_url: str, html: str, observed_at: str, containers: Sequence[tuple[str, Sequence[str]]] = CONTAINERS) -> DataFrame:
    """One row for each link with an address in each container it lies in; containers in order of precedence, then of the page.

    NULL pages and pages without containers give nothing. evidence_text is the link's visible text, NULL if it has none.
    """
    columns = [c.split()[0] for c in _SCHEMA.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, url, text, at in zip(pdf["page_id"], pdf["page_url"], pdf["html"], pdf["observed_at"]):
                out += [(i, url, at, order, number, k, ".".join([tag, *classes]), href, "".join(parts) or None) for k, (order, number, tag, classes, href, parts) in enumerate(_Anchors(containers).read(text))]
            yield pd.DataFrame(out, columns=columns)

    pages = pages.select(F.col(page_id).cast("string").alias("page_id"), F.col(page_url).alias("page_url"), F.col(html).alias("html"), F.col(observed_at).cast("timestamp").alias("observed_at"))
    return pages.where(F.col("html").isNotNull()).mapInPandas(rows, _SCHEMA)


def link_candidates(found: DataFrame, host: str = "github.com", reserved: Sequence[str] = RESERVED_OWNERS) -> DataFrame:
    """Repository candidates of each page from anchors: canonical URL, locator, text; of a page's links to one repository the first."""
    known = found.withColumn("repo_url", F.explode(F.array(repo_url(F.col("href"), host, reserved=reserved)))).where(F.col("repo_url").isNotNull())
    one = first_of_each(known, ["page_id", "repo_url"], ["container_order", "container_no", "anchor_no"])
    # Fixed form of a locator: <a> in {tag.classes}, text='{text}'.
    locator = F.concat(F.lit("<a> in "), F.col("container"), F.when(F.col("evidence_text").isNotNull(), F.concat(F.lit(", text='"), F.col("evidence_text"), F.lit("'"))).otherwise(""))
    return one.select(
        "page_id", "repo_url", F.lit("authoritative_paper_page").alias("evidence_type"), F.lit(1).alias("evidence_strength"), F.col("page_url").alias("evidence_source_url"),
        locator.alias("evidence_locator"), "evidence_text", F.lit("explicit_link_parsed").alias("association_method"), "observed_at",
    )
