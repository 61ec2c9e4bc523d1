"""Deeply nested records into linked flat tables by vectorised structural indexing.

A block of payloads is laid end to end in one byte array. Bitmaps of quotes, brackets and delimiters come from whole-array
comparisons; prefix sums of them give which bytes lie in strings and how deep each token nests; sorting tokens by depth pairs each
opening with its closing and each token with the container it lies in. Only the spans that are wanted become Python objects.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html import unescape
from xml.parsers import expat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes indexed at once; it bounds a task's memory, not what is read: a longer payload makes a block of its own.
BLOCK_BYTES = 2_000_000
ATOM = "http://www.w3.org/2005/Atom"
#: Keys of a claim object; an object with none of them that holds containers is a wrapper.
CLAIM_KEYS = ("field", "value", "evidence_quote", "supported")
PROVIDERS = ("gemini", "cohere", "groq")


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK_BYTES together."""
    start = total = 0
    for k, t in enumerate(texts):
        if k > start and total + len(t) > BLOCK_BYTES:
            yield start, k
            start, total = k, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def _lay(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts, each followed by a line feed; the bytes as an array; the texts' starts and the end."""
    raw = b"\n".join(texts) + b"\n"
    return raw, np.frombuffer(raw, np.uint8), np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))


def _enclosing(position: np.ndarray, depth: np.ndarray, doc: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """For each token, the index of the last token before it (itself excluded) of the same text that opens the level `depth` lies in; -1: none.

    opens marks tokens that open a container; its content has the token's own depth plus one. Tokens are in text order.
    """
    n = len(position)
    index = np.arange(n)
    # One list of openings, at the level of their content, and of questions, at their own level; sorted by text, level and place.
    level = np.concatenate((depth[opens] + 1, depth))
    place = np.concatenate((index[opens] * 2 + 1, index * 2))
    order = np.lexsort((place, level, np.concatenate((doc[opens], doc))))
    owner = np.concatenate((index[opens], np.full(n, -1)))[order]
    group = np.concatenate(([0], np.cumsum((np.diff(level[order]) != 0) | (np.diff(np.concatenate((doc[opens], doc))[order]) != 0)))) if n else np.zeros(0, int)
    last = np.maximum.accumulate(np.where(owner >= 0, np.arange(len(owner)), -1)) if len(owner) else owner
    found = np.where((last >= 0) & (group[np.maximum(last, 0)] == group), owner[np.maximum(last, 0)], -1)
    result = np.full(n, -1)
    asked = order >= int(opens.sum())
    result[order[asked] - int(opens.sum())] = found[asked]
    return result


class JsonIndex:
    """Structure of a block of JSON texts: tokens { } [ ] : , outside strings, with depth, container and key spans."""

    def __init__(self, texts: list[bytes]):
        self.raw, b, self.starts = _lay(texts)
        at = np.arange(len(b))
        # A quote counts unless an odd run of backslashes stands before it.
        plain = np.maximum.accumulate(np.where(b != 0x5C, at, -1))
        quotes = np.flatnonzero(b == 0x22)
        quotes = quotes[((quotes - 1 - np.where(quotes > 0, plain[np.maximum(quotes - 1, 0)], -1)) & 1) == 0]
        bitmap = np.zeros(len(b), np.int32)
        bitmap[quotes] = 1
        parity = np.cumsum(bitmap)
        doc_of = lambda p: np.searchsorted(self.starts, p, "right") - 1
        base = np.concatenate(([0], parity[self.starts[1:] - 1]))
        structural = np.flatnonzero((b == 0x7B) | (b == 0x7D) | (b == 0x5B) | (b == 0x5D) | (b == 0x3A) | (b == 0x2C))
        doc = doc_of(structural)
        outside = ((parity[structural] - base[doc]) & 1) == 0
        self.position, self.doc = structural[outside], doc[outside]
        self.char = b[self.position]
        self.opens = (self.char == 0x7B) | (self.char == 0x5B)
        closes = (self.char == 0x7D) | (self.char == 0x5D)
        run = np.cumsum(self.opens.astype(np.int32) - closes)
        first = np.searchsorted(self.doc, np.arange(len(texts)))
        before = np.where(first > 0, run[np.maximum(first - 1, 0)], 0) if len(run) else np.zeros(len(texts), int)
        # The level a token lies in: an opening in its parent's, a closing likewise.
        self.depth = run - before[self.doc] - self.opens if len(run) else run
        self.parent = _enclosing(self.position, self.depth, self.doc, self.opens)
        self.quotes = quotes
        # Openings and closings of one level alternate.
        brackets = np.flatnonzero(self.opens | closes)
        brackets = brackets[np.lexsort((brackets, self.depth[brackets], self.doc[brackets]))]
        self.closing = np.full(len(self.position), -1)
        at = np.flatnonzero(self.opens[brackets][:-1] & ~self.opens[brackets][1:])
        self.closing[brackets[at]] = self.position[brackets[at + 1]]
        self._by_parent = np.argsort(self.parent, kind="stable")
        self._parents = self.parent[self._by_parent]
        # A value ends at the next comma or closing of the level it lies in.
        ends = np.flatnonzero((self.char == 0x2C) | closes)
        level = self.depth[ends] + closes[ends]
        colons = np.flatnonzero(self.char == 0x3A)
        merged = np.concatenate((colons, ends))
        order = np.lexsort((merged, np.concatenate((self.depth[colons], level)), self.doc[merged]))
        is_end = order >= len(colons)
        upcoming = np.minimum.accumulate(np.where(is_end, np.arange(len(order)), len(order))[::-1])[::-1] if len(order) else order
        self.end = np.full(len(self.position), -1)
        ok = ~is_end & (upcoming < len(order))
        self.end[merged[order[ok]]] = self.position[merged[order[upcoming[ok]]]]
        self.colons = colons[self.end[colons] >= 0] if len(colons) else colons

    def within(self, token: int) -> np.ndarray:
        """The tokens that lie directly in a container, in text order."""
        a, z = np.searchsorted(self._parents, (token, token + 1))
        return self._by_parent[a:z]

    def keys(self, wanted: dict[bytes, str]) -> list[tuple[int, str, int, int, int, int]]:
        """(text, name, depth, parent token, value start, value end) of members whose key is wanted, in text order."""
        q = np.searchsorted(self.quotes, self.position[self.colons])
        close, start = self.quotes[np.maximum(q - 1, 0)], self.quotes[np.maximum(q - 2, 0)] + 1
        out = []
        lengths = {len(k) for k in wanted}
        # Keys with escapes are longer than they look; they are rare and decoded one by one.
        escaped = np.zeros(len(self.colons), bool) if b"\\" not in self.raw else np.fromiter((b"\\" in self.raw[s:c] for s, c in zip(start, close)), bool, len(self.colons))
        for k in np.flatnonzero(np.isin(close - start, list(lengths)) | escaped):
            key = self.raw[start[k] : close[k]]
            name = wanted.get(json.loads(b'"' + key + b'"').encode() if escaped[k] else key)
            if name is not None:
                t = self.colons[k]
                out.append((int(self.doc[t]), name, int(self.depth[t]), int(self.parent[t]), int(self.position[t]) + 1, int(self.end[t])))
        return out


def _loads(text: str | bytes):
    try:
        return True, json.loads(text)
    except (ValueError, RecursionError):
        return False, None


_TOKEN = re.compile(r"""[ \t\n\r]*(?:("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity)|([{}\[\],:]))""")


def _well_nested(text: str) -> bool:
    """Whether a text is JSON, with a stack of its own: for what nests deeper than the standard library's parser goes."""
    stack: list[str] = []
    state, at = "value", 0
    while m := _TOKEN.match(text, at):
        at = m.end()
        string, scalar, mark = m.groups()
        if state in ("value", "first value"):
            if mark in ("{", "["):
                stack.append(mark)
                state = "first key" if mark == "{" else "first value"
            elif mark is None:
                state = "after"
            elif mark == "]" and state == "first value":
                stack.pop()
                state = "after"
            else:
                return False
        elif state in ("key", "first key"):
            if string is not None:
                state = "colon"
            elif mark == "}" and state == "first key":
                stack.pop()
                state = "after"
            else:
                return False
        elif state == "colon":
            if mark != ":":
                return False
            state = "value"
        elif not stack:
            return False
        elif mark == ",":
            state = "key" if stack[-1] == "{" else "value"
        elif mark == {"{": "}", "[": "]"}[stack[-1]]:
            stack.pop()
        else:
            return False
    return state == "after" and not stack and not text[at:].strip(" \t\n\r")


def _readable(text: str) -> bytes | None:
    """The exact check of a JSON text; a text that is itself a JSON string is unwrapped."""
    while True:  # each layer is shorter than the one around it
        try:
            value = json.loads(text)
        except ValueError:
            return None
        except RecursionError:
            return text.encode("utf-8", "surrogatepass") if _well_nested(text) else None
        if not isinstance(value, str):
            return text.encode("utf-8", "surrogatepass") if isinstance(value, (dict, list)) else None
        text = value


def _value_text(v) -> str | None:
    return None if v is None else v if isinstance(v, str) else v.text if isinstance(v, _Span) else json.dumps(v, ensure_ascii=False)


class _Span(list):
    """A container as it stands in the text, where it nests too deep to be read."""

    def __init__(self, text: str):
        self.text = text


def _claim(value: dict) -> tuple | None:
    """(field, value, evidence_quote, supported) of a claim object; None for a wrapper."""
    if not any(k in value for k in CLAIM_KEYS) and any(isinstance(v, (dict, list)) for v in value.values()):
        return None
    supported = value.get("supported")
    return _value_text(value.get("field")) or "", _value_text(value.get("value")), _value_text(value.get("evidence_quote")), supported if isinstance(supported, bool) else None


class _Extractions:
    """Finds extractions and their claims in blocks of JSON texts, in as many rounds as texts nest within strings."""

    WANTED = {k.encode(): k for k in ("final_extraction", *PROVIDERS, "result", "corrected_extraction", "claims")}

    def run(self, ids: list[str], texts: list[str | None]) -> list[tuple]:
        """(record_id, node, parent_no 0, claim_no, field, value, evidence_quote, supported)"""
        # Rows go by their place here: a row written twice must not go on with the numbers of its copy.
        todo = [(k, "", raw, "root") for k, t in enumerate(texts) if t is not None and (raw := _readable(t)) is not None]
        claims: list[tuple] = []  # row, node, place in reading order, (field, value, evidence_quote, supported)
        while todo:
            later: list[tuple] = []
            for a, z in _blocks([t[2] for t in todo]):
                self._block(todo[a:z], claims, later)
            todo = later
        claims.sort(key=lambda c: (c[0], c[1], c[2]))
        out, last, number = [], None, 0
        for row, node, _, claim in claims:
            number = number + 1 if last == (row, node) else 1
            last, record = (row, node), ids[row]
            out.append((record, node, 0, number, *claim))
        return out

    def _block(self, items: list[tuple], claims: list, later: list) -> None:
        index = JsonIndex([t[2] for t in items])
        members: dict[tuple[int, int, str], tuple[int, int]] = {}
        for doc, name, depth, parent, start, end in index.keys(self.WANTED):
            if parent >= 0 and index.char[parent] == 0x7B:
                members[doc, parent, name] = (start, end)  # of equal keys the last counts, as JSON readers have it
        token_at = lambda p: int(np.searchsorted(index.position, p))

        def inner(span: tuple[int, int] | None) -> tuple[str, int] | None:
            """What a value's span holds: an object's or array's token, or a string's start."""
            if span is None:
                return None
            s, e = span
            while s < e and index.raw[s] in b" \t\r\n":
                s += 1
            c = index.raw[s : s + 1]
            return ("object", token_at(s)) if c == b"{" else ("array", token_at(s)) if c == b"[" else ("string", s) if c == b'"' else None

        # Order within a text is that of its bytes; place has where the texts around it stand, for a text within a string.
        # Values to go on at; stage names what is expected there. A stack of their own, as texts may nest deeper than calls can; claims are sorted later.
        pending: list[tuple[int, str, tuple, tuple[int, int] | None, str]] = []

        def follow(*value) -> None:
            pending.append(value)

        for doc, (_, node, raw, stage) in enumerate(items):
            place = ()
            if stage != "root":
                stage, place = stage
            follow(doc, node, place, (int(index.starts[doc]), int(index.starts[doc + 1]) - 1), stage)
        while pending:
            doc, node, place, span, stage = pending.pop()
            record, what = items[doc][0], inner(span)
            if what is None:
                continue
            if what[0] == "string":
                ok, text = _loads(index.raw[span[0] : span[1]])
                if ok and isinstance(text, str) and (raw := _readable(text)) is not None:
                    later.append((record, node, raw, (stage, (*place, span[0]))))
            elif what[0] == "object" or stage == "claims":
                self._enter(index, members, doc, record, node, place, what[1], stage, follow, claims)

    @staticmethod
    def _members(index: JsonIndex, token: int) -> dict:
        """An object's members by their spans, containers unread."""
        out, key, start = {}, None, int(index.position[token]) + 1
        for t in [*index.within(token), None]:
            end = int(index.closing[token]) if t is None else int(index.position[t])
            if t is None or index.char[t] in (0x2C, 0x3A):
                text = index.raw[start:end].strip()
                if t is not None and index.char[t] == 0x3A:
                    key = json.loads(text)
                elif key is not None:
                    out[key] = _Span(text.decode("utf-8", "replace")) if text[:1] in b"{[" else json.loads(text)
                start = end + 1
        return out

    def _enter(self, index, members, doc, record, node, place, token, stage, follow: Callable, claims: list) -> None:
        if stage == "root":
            follow(doc, "final_extraction", (), members.get((doc, token, "final_extraction")), "extraction")
            for p in PROVIDERS:
                follow(doc, p, (), members.get((doc, token, p)), "provider")
        elif stage == "provider":
            follow(doc, node, (), members.get((doc, token, "result")), "review" if node == "cohere" else "extraction")
        elif stage == "review":
            follow(doc, node, (), members.get((doc, token, "corrected_extraction")), "extraction")
        elif stage == "extraction":
            follow(doc, node, (), members.get((doc, token, "claims")), "claims")
        else:
            start = int(index.position[token])
            if index.char[token] == 0x7B:
                try:
                    value = json.loads(index.raw[start : int(index.closing[token]) + 1])
                    claim = _claim(value)
                except RecursionError:
                    claim = _claim(self._members(index, token))
                if claim is not None:
                    claims.append((record, node, (*place, start), claim))
                    return
            # Children of an array or wrapper: containers by token, and strings that may hold JSON.
            piece = start + 1
            for t in index.within(token):
                if index.char[t] == 0x2C:
                    follow(doc, node, place, (piece, int(index.position[t])), "claims")
                if index.char[t] in (0x2C, 0x3A):
                    piece = int(index.position[t]) + 1
            follow(doc, node, place, (piece, int(index.closing[token])), "claims")


_SKIPPED = re.compile(rb"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>", re.S)
_XMLNS = re.compile(rb"""\sxmlns(?::([^\s=]+))?\s*=\s*(?:"([^"]*)"|'([^']*)')""")


class XmlIndex:
    """Structure of a block of XML texts: tags outside comments, CDATA and instructions, with depth and parent element."""

    def __init__(self, texts: list[bytes]):
        self.raw, b, self.starts = _lay(texts)
        hidden = np.zeros(len(b) + 1, np.int32)
        for m in _SKIPPED.finditer(self.raw):
            hidden[m.start()] += 1
            hidden[m.end()] -= 1
        seen = np.cumsum(hidden[:-1]) == 0
        left = np.flatnonzero((b == 0x3C) & seen)
        right = np.flatnonzero((b == 0x3E) & seen)
        doc = np.searchsorted(self.starts, left, "right") - 1
        k = np.searchsorted(right, left)
        whole = k < len(right)
        left, doc, k = left[whole], doc[whole], k[whole]
        end = right[k] if len(left) else left
        # A ">" within an attribute value doesn't end the tag: an odd number of quotes before it says so.
        for mark in (0x22, 0x27):
            count = np.concatenate(([0], np.cumsum(b == mark)))
            for t in np.flatnonzero((count[end] - count[left]) & 1) if len(left) else ():
                m = re.compile(rb"""<(?:[^>"']|"[^"]*"|'[^']*')*>""").match(self.raw, int(left[t]))
                end[t] = m.end() - 1 if m else end[t]
        close = b[left + 1] == 0x2F if len(left) else np.zeros(0, bool)
        single = ~close & (b[np.maximum(end - 1, 0)] == 0x2F) if len(left) else close
        self.left, self.end, self.doc, self.close = left, end, doc, close
        step = np.where(close, -1, np.where(single, 0, 1))
        run = np.cumsum(step)
        first = np.searchsorted(doc, np.arange(len(texts)))
        before = np.where(first > 0, run[np.maximum(first - 1, 0)], 0) if len(run) else np.zeros(len(texts), int)
        self.opens = ~close & ~single
        #: The level an element lies in: 0 for the root.
        self.depth = run - before[doc] - self.opens if len(run) else run
        self.parent = _enclosing(left, self.depth, doc, self.opens)
        self.text_end = np.concatenate((left[1:], [len(b)])) if len(left) else left
        self.colons = np.flatnonzero(b == 0x3A)
        self._bytes, self._known = b, {}
        self._ends = np.zeros(256, bool)
        self._ends[list(b" \t\r\n/>")] = True
        # Texts in which another tag than the root declares a namespace.
        declares = np.array([m.start() for m in re.finditer(b"xmlns", self.raw)], int)
        tag = np.searchsorted(left, declares) - 1
        inner = (tag >= 0) & (self.depth[np.maximum(tag, 0)] > 0) if len(left) else np.zeros(len(declares), bool)
        self.redeclared = set(np.unique(doc[tag[inner]]).tolist()) if len(left) else set()

    def named(self, local: bytes, level: int) -> np.ndarray:
        """Indices of start tags of elements in the Atom namespace with this local name at this level.

        Names are compared for all tags at once, byte by byte: after "<", or after the first colon of a prefixed name. What is left is
        held against the namespace its prefix is bound to.
        """
        tags = np.flatnonzero(~self.close & (self.depth == level))
        if not len(tags):
            return tags
        start = self.left[tags] + 1
        k = np.searchsorted(self.colons, start)
        colon = np.where(k < len(self.colons), self.colons[np.minimum(k, max(len(self.colons) - 1, 0))], -1) if len(self.colons) else np.full(len(tags), -1)
        plain, prefixed = self._spells(start, local), (colon > 0) & (colon < self.end[tags]) & self._spells(colon + 1, local)
        hits = np.flatnonzero(plain | prefixed)
        prefixes = [b"" if plain[h] else self.raw[start[h] : colon[h]] for h in hits]
        return tags[[h for h, p in zip(hits, prefixes) if not re.search(rb"[\s/>]", p) and self._in_atom(int(tags[h]), p)]]

    def _spells(self, at: np.ndarray, name: bytes) -> np.ndarray:
        """Whether a name stands at each place, and ends there."""
        b, last = self._bytes, len(self._bytes) - 1
        same = np.ones(len(at), bool)
        for k, c in enumerate(name):
            same &= b[np.minimum(at + k, last)] == c
        return same & self._ends[b[np.minimum(at + len(name), last)]]

    def _in_atom(self, t: int, prefix: bytes) -> bool:
        """Whether a prefix is bound to the Atom namespace at a tag; once a text and prefix where the root alone declares any."""
        doc = int(self.doc[t])
        if doc in self.redeclared:
            return self._namespace(t, prefix) == ATOM.encode()
        key = (doc, prefix)
        if key not in self._known:
            self._known[key] = self._namespace(t, prefix) == ATOM.encode()
        return self._known[key]

    def _namespace(self, t: int, prefix: bytes) -> bytes | None:
        """The namespace a prefix is bound to at a tag: the nearest declaration on the tag or an ancestor."""
        while t >= 0:
            tag = self.raw[self.left[t] : self.end[t] + 1]
            if b"xmlns" in tag:
                for p, a, c in _XMLNS.findall(tag):
                    if p == prefix:
                        return a or c
            t = int(self.parent[t])
        return None

    def text(self, t: int) -> str:
        """An element's text before its first child: comments dropped, CDATA unwrapped, entities decoded."""
        raw = self.raw[self.end[t] + 1 : self.text_end[t]]
        if self.raw[self.end[t] - 1] == 0x2F:
            return ""
        out, at = [], 0
        for m in _SKIPPED.finditer(raw):
            out.append(unescape(raw[at : m.start()].decode("utf-8", "replace")))
            if m.group().startswith(b"<![CDATA["):
                out.append(m.group()[9:-3].decode("utf-8", "replace"))
            at = m.end()
        out.append(unescape(raw[at:].decode("utf-8", "replace")))
        return "".join(out)


def _well_formed(text: str) -> bytes | None:
    """The exact check of an XML text, by the standard library's parser without handlers; its bytes in UTF-8."""
    raw = re.sub(r"^﻿?(<\?xml[^>]*?)\s+encoding\s*=\s*(\"[^\"]*\"|'[^']*')", r"\1", text).encode("utf-8", "surrogatepass")
    try:
        expat.ParserCreate("utf-8", " ").Parse(raw, True)
    except expat.ExpatError:
        return None
    return raw


_FEED_FIELDS = (b"id", b"title", b"published", b"updated", b"summary")


def _feeds(ids: list[str], texts: list[str | None]) -> tuple[list[tuple], list[tuple]]:
    """Rows of entries (record_id, entry_no, id, title, published, updated, summary) and of authors (record_id, entry_no, author_no, name)."""
    good = [(i, raw) for i, t in zip(ids, texts) if t is not None and (raw := _well_formed(t)) is not None]
    entries, authors = [], []
    for a, z in _blocks([g[1] for g in good]):
        block = good[a:z]
        x = XmlIndex([g[1] for g in block])
        found = x.named(b"entry", 1)
        number = np.zeros(len(x.left), int)
        fields: dict[int, dict[bytes, str]] = {int(t): {} for t in found}
        if len(found):
            number[found] = np.arange(len(found)) - np.searchsorted(x.doc[found], x.doc[found]) + 1
        for f in _FEED_FIELDS:
            for t in x.named(f, 2):
                p = int(x.parent[t])
                if number[p] and f not in fields[p]:
                    fields[p][f] = x.text(t)
        entries += [(block[x.doc[t]][0], int(number[t]), *(fields[int(t)].get(f) for f in _FEED_FIELDS)) for t in found]
        people = x.named(b"author", 2)
        names: dict[int, str] = {}
        for t in x.named(b"name", 3):
            names.setdefault(int(x.parent[t]), x.text(t))
        last, count = -1, 0
        for t in people:
            p, name = int(x.parent[t]), names.get(int(t), "").strip()
            if not number[p]:
                continue
            count, last = (count if p == last else 0), p
            if name:
                count += 1
                authors.append((block[x.doc[t]][0], int(number[p]), count, name))
    return entries, authors


KEY_SCHEMA = "record_id string, node string, parent_no bigint, child_no bigint, claim_field string"
FLAT_SCHEMA = KEY_SCHEMA + ", name string, title string, published string, updated string, body string, supported boolean"
_KEYS = [c.split()[0] for c in KEY_SCHEMA.split(", ")]
_COLUMNS = [c.split()[0] for c in FLAT_SCHEMA.split(", ")]


def _feed_rows(ids: list[str], texts: list[str]) -> list[tuple]:
    entries, authors = _feeds(ids, texts)
    rows = [(i, "entry", 0, k, "", name, title, published, updated, body, None) for i, k, name, title, published, updated, body in entries]
    return rows + [(i, "author", p, k, "", name, None, None, None, None, None) for i, p, k, name in authors]


def _claim_rows(ids: list[str], texts: list[str]) -> list[tuple]:
    return [(i, node, p, k, field, value, None, None, None, quote, ok) for i, node, p, k, field, value, quote, ok in _Extractions().run(ids, texts)]


def flatten_feeds(df: DataFrame, record_id: str, xml: str, keys_only: bool = False) -> DataFrame:
    """Linked flat rows of Atom feeds, in FLAT_SCHEMA: node `entry` (parent_no 0) and node `author` (parent_no its entry's child_no).

    Entries are the root's own entry children, numbered in order; authors are an entry's own, numbered among those with a visible name.
    For an entry, name is its id. NULL, empty and malformed texts give nothing; rows written twice (same record_id) count once. keys_only
    leaves the fields out (KEY_SCHEMA). An empty table gives no rows; columns besides the two named are not read.
    """
    return _flatten(df, record_id, xml, _feed_rows, keys_only)


def flatten_results(df: DataFrame, record_id: str, text: str, keys_only: bool = False) -> DataFrame:
    """Linked flat rows of extraction results (JSON text), in FLAT_SCHEMA: one for each claim object, parent_no 0.

    node is the extraction the claim belongs to; child_no its place in reading order however lists, wrappers or JSON within strings hold
    it. For a claim, name is its value and body its quote, as text. NULL and unreadable texts give nothing; rows written twice (same
    record_id) count once. keys_only leaves the fields out (KEY_SCHEMA). An empty table gives no rows; other columns are not read.
    """
    return _flatten(df, record_id, text, _claim_rows, keys_only)


def _flatten(df: DataFrame, record_id: str, payload: str, parse: Callable, keys_only: bool) -> DataFrame:
    """Payloads are parsed where they are read; only the flat rows are shuffled, to drop those of rows written twice."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = parse(pdf["record_id"].tolist(), pdf["payload"].tolist())
            out = pd.DataFrame([r[: len(_KEYS)] for r in found] if keys_only else found, columns=_KEYS if keys_only else _COLUMNS)
            yield out if keys_only else out.astype({"supported": object})

    one = df.select(F.col(record_id).cast("string").alias("record_id"), F.col(payload).alias("payload")).where(F.col("payload").isNotNull() & F.col("record_id").isNotNull())
    flat = one.mapInPandas(rows, KEY_SCHEMA if keys_only else FLAT_SCHEMA)
    return flat.distinct() if keys_only else flat.dropDuplicates(_KEYS[:4])
