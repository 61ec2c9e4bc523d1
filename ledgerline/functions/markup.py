"""The standard library's page parser, for pages as they come."""

from __future__ import annotations

from html import unescape
from html.parser import HTMLParser


class PageParser(HTMLParser):
    """Events of any text, in a time in proportion to its length.

    Declarations that the library doesn't know are comments up to the next ">", as browsers have it, instead of errors. What begins a tag or
    comment but never ends is text; the library looks for the end of each to the end of the page, here once is enough. Positions in
    the source aren't kept.
    """

    def __init__(self) -> None:
        #: Characters at the end of what was fed that hold no ">", and no end of a comment.
        self._bare = self._uncommented = 0
        super().__init__(convert_charrefs=True)

    def feed(self, data: str) -> None:
        at = data.rfind(">")
        self._bare = len(data) - at - 1 if at >= 0 else len(data) + len(self.rawdata) - self.rawdata.rfind(">") - 1
        self._uncommented = 0
        super().feed(data)

    def close(self) -> None:
        if self.rawdata and self.cdata_elem is None and ">" not in self.rawdata:
            rest, self.rawdata = self.rawdata, ""
            self.handle_data(unescape(rest))
        super().close()

    def _endless(self, i: int) -> bool:
        return len(self.rawdata) - i <= self._bare

    def parse_starttag(self, i: int) -> int:
        return -1 if self._endless(i) else super().parse_starttag(i)

    def parse_endtag(self, i: int) -> int:
        return -1 if self._endless(i) else super().parse_endtag(i)

    def parse_pi(self, i: int) -> int:
        return -1 if self._endless(i) else super().parse_pi(i)

    def parse_comment(self, i: int, report: int = 1) -> int:
        rest = len(self.rawdata) - i
        if rest <= max(self._bare, self._uncommented):
            return -1
        end = super().parse_comment(i, report)
        if end < 0:
            self._uncommented = rest
        return end

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def parse_html_declaration(self, i: int) -> int:
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def updatepos(self, i: int, j: int) -> int:
        return j
