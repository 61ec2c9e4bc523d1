"""Text and hash expressions that match the evidence records' conventions; all in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.isspace sees it: Java's (?U)\s and the four separators \x1c-\x1f.
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def collapse_space(c: Column) -> Column:
    """Runs of white space become one space, the ends are bare; NULL stays NULL, blank text becomes ''."""
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def strip_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{_SPACE}|{_SPACE}$", "")


def content_hash(c: Column) -> Column:
    """SHA-256 in hex of the UTF-8 bytes (or of a binary column); NULL stays NULL."""
    return F.sha2(c.cast("binary"), 256)


def record_id(*parts: Column) -> Column:
    """A repeatable id from a natural key: the same after a task is run again, unlike uuid()."""
    return F.sha2(F.concat_ws("\u001f", *(F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts)), 256)


def feed_id(url: Column, stop_at_v: bool = True) -> Column:
    """The record id inside a feed entry's URL, NULL if there is none.

    stop_at_v keeps the known quirk of ending at the first letter v anywhere (so ids with a v in the name are cut);
    False cuts only a trailing version like v2.
    """
    if stop_at_v:
        return F.nullif(F.regexp_extract(url, r"abs/([^v]+)", 1), F.lit(""))
    return F.nullif(F.regexp_replace(F.regexp_extract(url, r"abs/(.+)$", 1), r"v\d+$", ""), F.lit(""))


def feed_time(c: Column) -> Column:
    """Timestamp of yyyy-MM-ddTHH:mm:ssZ text, NULL where the text has another form."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))


def iso_text(ts: Column) -> Column:
    """ISO text in UTC with an offset; the fraction only where there is one, as Python writes it."""
    micros = F.unix_micros(ts.cast("timestamp")) % 1_000_000
    return F.when(micros == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def uuid_key(c: Column) -> Column:
    """The form in which UUID text is compared: letter case carries no meaning."""
    return F.lower(F.trim(c))
