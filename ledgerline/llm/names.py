"""Variant spellings of names: MinHash banding over padded q-grams, Monge-Elkan verification, star clustering.

Spellings that differ only in case, spacing, punctuation, order or titles are one form. Two kinds of views of a form are banded: the
q-grams of the rest of a name beside one part that is spelt alike (so a frequent family name alone makes no bucket), and the q-grams of the
family name beside an initial, once for all forms that share both. Two forms meet if they differ by a slip in one part, or if one has an
initial or a short form where the other has the whole given name. Candidates are verified by the Monge-Elkan similarity of their parts,
and a slip by how often each part occurs; star clustering then gives each form to its best centre.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.skew import salted_lookup
from ledgerline.session import cut

#: Texts that stand in author lists but name nobody.
FILLERS = frozenset(("et al", "and others", "others", "and", "unknown", "anonymous", "none", "n a", "na", "various", "various authors", "tba", "author", "authors", "null", "nan"))
#: Titles and suffixes.
TITLES = frozenset(("dr", "prof", "professor", "mr", "mrs", "ms", "jr", "sr", "phd", "md", "msc", "eds", "editor"))
#: Parts of family names that aren't names.
PARTICLES = frozenset(("de", "van", "von", "der", "den", "al", "la", "le", "del", "della", "di", "da", "dos", "du", "el", "bin", "ibn", "ter", "ten"))
#: Words for a collaboration.
COLLABORATION = frozenset(("collaboration", "collaborations", "collab", "coll", "consortium", "group", "team", "the"))
#: Rows of a letter keyboard; slips hit neighbours.
KEYBOARD = ("qwertyuiop", "asdfghjkl", "zxcvbnm")

#: Similarity (Jaccard, of q-grams) at which `RECALL` of the pairs must meet in a band: any slip in a name of four letters or more, or a short
#: form made of a name's beginning or end; and any slip in a family name of five letters or more.
REST_TARGET, FAMILY_TARGET, RECALL = 0.38, 0.45, 0.99
#: Rows of a band: two where a part spelt alike keeps buckets small, three beside an initial alone.
REST_ROWS, FAMILY_ROWS = 2, 3
#: Family names with no more letters have too few q-grams for their slips to be similar: less any one letter each is a key besides.
SHORT = 5
#: Least Monge-Elkan similarity of a link (see the README for recall and precision by threshold).
LEAST_SIMILARITY = 0.8
#: A text of more parts is no name but a list of them or a sentence; its spellings belong together only if they are one form.
MOST_PARTS = 32
BLOCK = 500
#: Rounds of star clustering by rank.
ROUNDS = 20
#: Tables of forms, words and pairs of families go to all tasks up to this many rows (some 20 MB); beyond, they are shuffled.
MOST_SHARED = 1 << 18


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of `rows` hashes each so that a pair of this similarity meets with probability `recall`: 1 - (1 - s**r)**b."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


REST_BANDS, FAMILY_BANDS = bands_for(REST_TARGET, RECALL, REST_ROWS), bands_for(FAMILY_TARGET, RECALL, FAMILY_ROWS)


def fold(s: str) -> str:
    """Lower case without marks on letters."""
    return "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c)).replace("ø", "o").replace("đ", "d").replace("ł", "l").replace("ß", "ss").replace("æ", "ae")


_LETTERS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_PARENTHESES = re.compile(r"\([^()]*\)")


def parse_name(name: str | None) -> tuple[str, str] | None:
    """(form, family) of a spelling: the form is "long parts sorted|initials in order|particles|c for a collaboration"; None for blanks and fillers."""
    if name is None:
        return None
    text = _PARENTHESES.sub(" ", unicodedata.normalize("NFKC", name))
    words = []
    for m in _LETTERS.finditer(text):
        # A double given name stays one part; particles, initials and the words of a collaboration don't.
        parts = m.group().split("-")
        whole = len(parts) == 1 or not any(len(x) == 1 or x.lower() in PARTICLES for x in parts)
        words += [(m.group(), m.start())] if whole else [(x, m.start()) for x in parts]
    if any("-" in w for w, _ in words) and any(w.lower() in COLLABORATION and w.lower() != "the" for w, _ in words):
        words = [(x, p) for w, p in words for x in w.split("-")]
    if not words or " ".join(w.lower() for w, _ in words) in FILLERS:
        return None
    mixed = any(w[1:].islower() for w, _ in words)
    # Two capitals beside a name in mixed case are initials, even if they read like a title.
    named = [(w, p) for w, p in words if w.lower() not in TITLES or (mixed and len(w) == 2 and w.isupper())] or words
    together = [w for w in named if w[0].lower() not in COLLABORATION]
    collaboration = bool(together) and any(w.lower() in COLLABORATION and w.lower() != "the" for w, _ in named)
    if collaboration or (together and named[0][0].lower() == "the"):
        named = together
    shouting = all(w.isupper() for w, _ in named if len(w) > 3)
    capitals = any(w.isupper() for w, _ in named if len(w) > 3)
    long, initials, particles = [], [], []
    for w, p in named:
        low = w.lower()
        if low in PARTICLES and len(named) > 1 and (w.islower() or (w.isupper() and capitals)):
            particles.append(low)
        elif len(w) == 1:
            initials.append(fold(low))
        elif len(w) <= 3 and w.isupper() and not shouting:
            initials += list(fold(low))
        else:
            long.append((low, w, p))
    comma = text.find(",")
    family = ""
    if long and not collaboration:
        loud = [x for x in long if x[1].isupper()] if len(long) > 1 and any(not x[1].isupper() for x in long) else []
        before = [x for x in long if x[2] < comma] if comma > 0 and text[comma - 1] != " " else []
        family = (loud[-1] if loud else before[-1] if before and len(before) < len(long) + len(initials) else long[-1])[0]
    return "|".join((" ".join(sorted(x[0] for x in long)), " ".join(initials), " ".join(sorted(particles)), "c" if collaboration else "")), family


_A = np.random.RandomState(7).randint(1, 2**63 - 1, max(REST_BANDS * REST_ROWS, FAMILY_BANDS * FAMILY_ROWS), dtype=np.int64).astype(np.uint64) | np.uint64(1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _h64(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def padded_grams(words: list[str]) -> set[str]:
    """2-grams of each word with its ends marked, and its letters with one between: of these two letters swapped keep most."""
    out = set()
    for w in words:
        p = f"^{w}$"
        out.update(p[k : k + 2] for k in range(len(p) - 1))
        out.update(p[k] + p[k + 2] for k in range(len(p) - 2))
    return out


def _buckets(anchor: str, words: list[str], bands: int, rows: int, seen: dict[str, int]) -> np.ndarray:
    """Bucket keys of one view: the anchor and `rows` minima for each band; seen keeps the hashes of q-grams."""
    grams = padded_grams(words)
    for g in grams:
        if g not in seen:
            seen[g] = _h64(g)
    x = np.fromiter(map(seen.__getitem__, grams), np.uint64, len(grams))
    mixed = x[:, None] * _A[: bands * rows][None, :]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _PRIME
    minima = (mixed >> np.uint64(16)).min(axis=0).reshape(bands, rows)
    key = np.full(bands, _h64(anchor), np.uint64) + np.arange(bands, dtype=np.uint64) * _PRIME
    for r in range(rows):
        key = (key ^ minima[:, r]) * _PRIME
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _rest_views(form: str) -> list[tuple[str, list[str]]]:
    """(part spelt alike, the rest) for each part of a form of several."""
    words = [fold(w) for w in form.split("|")[0].split()]
    return [(f"F{t}", words[:n] + words[n + 1 :]) for n, t in enumerate(words)] if 1 < len(words) <= MOST_PARTS else []


def _lone(form: str) -> str:
    """The part of a form of one word without any initial, "" of others: it meets others like it by slips alone."""
    longs, initials, _, group = form.split("|")
    return fold(longs) + group if longs and " " not in longs and not initials else ""


def _homes(form: str, family: str, expansions: list[str] | None) -> tuple[bool, list[tuple[str, str]]]:
    """Whether the form asks (it has an initial or a short form for a given name), and (initial, family name) of it."""
    longs, initials, _, group = form.split("|")
    words, initials = [fold(w) for w in longs.split()], initials.split()
    if not words or group or len(words) > MOST_PARTS:
        return False, []
    home = fold(family)
    firsts = {w[0] for w in words if w != home} or set(initials[:1])
    return len(words) == 1 and bool(initials) or bool(expansions), [(i, home) for i in sorted(firsts | {fold(e)[0] for e in expansions or [] if e})]


def _home_keys(initial: str, home: str, seen: dict[str, int]) -> np.ndarray:
    keys = _buckets(f"I{initial}", [home], FAMILY_BANDS, FAMILY_ROWS, seen)
    if len(home) > SHORT + 1:  # two words of SHORT letters at most differ by no more than a letter of one of them
        return keys
    return np.concatenate((keys, np.array([_h64(f"D{initial}{w}") for w in sorted(_less_one(home))], np.uint64).view(np.int64)))


def _less_one(word: str) -> set[str]:
    """A word, and the word with each one letter left out: two words that `slips` puts at 2 or less share one of these."""
    return {word} | {word[:k] + word[k + 1 :] for k in range(len(word))}


def slips(a: str, b: str) -> int:
    """Typing slips between two words: 0; 1 (a letter left out or added, two swapped, a neighbouring key); 2 for another letter in one's place; 3 for more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 1:
        return 3
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    if len(a) < len(b):
        return 1 if a[k:] == b[k + 1 :] else 3
    if a[k + 1 :] == b[k + 1 :]:
        return 1 if _near(a[k], b[k]) else 2
    return 1 if k + 1 < len(a) and a[k] == b[k + 1] and a[k + 1] == b[k] and a[k + 2 :] == b[k + 2 :] else 3


_PLACE = {c: (y, x + 0.5 * y) for y, row in enumerate(KEYBOARD) for x, c in enumerate(row)}


def _near(a: str, b: str) -> bool:
    p, q = _PLACE.get(a), _PLACE.get(b)
    return p is not None and q is not None and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1.0


def _part_similarity(a: str, b: str) -> tuple[float, tuple[str, str] | None]:
    """Similarity of two parts, and the folded parts if they differ by a slip."""
    if a == b:
        return 1.0, None
    x, y = fold(a), fold(b)
    if x == y:
        return 0.98, None
    n = slips(x, y)
    return (1 - n / max(len(x), len(y)), (x, y)) if n <= 2 else (0.0, None)


def _is_short(short: str, given: str) -> bool:
    """Whether a given name's beginning (with another last letter at most) or end is used as its short form."""
    if "-" in given:
        return False
    if not 3 <= len(short) <= 5 or len(short) >= len(given):
        return False
    return given.startswith(short) or given.endswith(short) or (len(short) > 3 and given.startswith(short[:-1]) and short[-1] in "aeiouy")


def _matched(la: list[str], lb: list[str]) -> tuple[float, tuple[str, str], list[str]] | None:
    """Sum of the similarities of la's parts to their best of lb's, each used once; the parts of the one slip; lb's parts left over."""
    total, left, slip = 0.0, list(lb), ("", "")
    for t in sorted(la, key=lambda w: w not in lb):
        best, differ, chosen = 0.0, None, None
        for u in left:
            s, d = _part_similarity(t, u)
            if s > best:
                best, differ, chosen = s, d, u
        if chosen is None or (differ and slip[0]):
            return None
        left.remove(chosen)
        total += best
        slip = differ or slip
    return total, slip, left


def compare(a: tuple[str, str, list[str] | None], b: tuple[str, str, list[str] | None]) -> tuple[float, str, str]:
    """(Monge-Elkan similarity of two forms or 0, the two parts that differ by a slip or ""). A form: (form, family, given names its short form stands for).

    One slip at most may lie between two forms; whether it may be one is then judged by how usual both parts are. Initials must agree.
    """
    (la, ia, _, ga), (lb, ib, _, gb) = a[0].split("|"), b[0].split("|")
    la, lb, ia, ib = la.split(), lb.split(), ia.split(), ib.split()
    none = 0.0, "", ""
    if ga != gb:
        return none
    same_initials = not (ia and ib) or ia[: min(len(ia), len(ib))] == ib[: min(len(ia), len(ib))]
    if len(la) == len(lb) and (len(la) > 1 or ia[:1] == ib[:1] or ga):
        if not same_initials:
            return none
        if m := _matched(la, lb):
            return m[0] / len(la), *m[1]
    da, db = [x for t in la for x in t.split("-")], [x for t in lb for x in t.split("-")]
    if len(la) != len(lb) and len(da) == len(db) and same_initials:  # a double name with and without its hyphen
        if m := _matched(da, db):
            return m[0] / len(da) - 0.01, *m[1]
    sides = ((la, ia, a[1], a[2], lb, ib, b[1]), (lb, ib, b[1], b[2], la, ia, a[1]))
    for lx, ix, fx, ex, ly, iy, fy in sides:  # x is the shorter way to write the name
        if len(lx) > 1 and len(ly) == len(lx) + 1 and not ga:  # a middle name in full
            if m := _matched(lx, ly):
                extra = m[2][0]
                if extra != fy and (not ix or ix[0] == fold(extra)[0]):
                    return m[0] / len(lx) - (0.02 if ix else 0.06), *m[1]
        given = [t for t in ly if t != fy]
        if not given or ga:
            continue
        s, slip = _part_similarity(fx, fy)
        if s == 0:
            continue
        if len(lx) == 1 and ix:
            letters = [x[0] for t in sorted(given, key=lambda t: fold(t)[0] != ix[0]) for x in fold(t).split("-")] + iy
            if letters[0] == ix[0] and (len(ix) == 1 or len(letters) == 1 or ix[1] in letters[1:]):
                return (0.9 + s) / 2, *(slip or ("", ""))
        elif len(lx) == len(ly) == 2 and same_initials:
            short = [t for t in lx if t != fx]
            names = {fold(given[0]), fold(given[0]).split("-")[0]}  # of a double name, the first may be used alone
            if len(short) == 1 and ex and any(fold(e) in names for e in ex):
                return (0.92 + s) / 2, *(slip or ("", ""))
            if len(short) == 1 and not slip and any(_is_short(fold(short[0]), n) for n in names):
                return (0.88 + s) / 2, "", ""
    return none


def name_forms(df: DataFrame, names: str, short_forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spellings: name, form) and (forms: form, id, family, mentions, expansions) of an array column of names."""

    @F.pandas_udf("struct<form string, family string>")
    def parsed(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_name(x) or (None, None) for x in s], columns=["form", "family"])

    mentions = df.select(F.explode(names).alias("name")).where(F.col("name").isNotNull()).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    # The filter stands behind the cut: before it, names would be parsed once for each mention.
    spellings = cut(mentions.withColumn("p", parsed("name")).select("name", "n", "p.form", "p.family")).where(F.col("form").isNotNull())
    # One shuffle, by form, serves both aggregations.
    votes = spellings.repartition("form").groupBy("form", "family").agg(F.sum("n").alias("n"))
    forms = votes.groupBy("form").agg(F.max_by("family", F.struct("n", "family")).alias("family"), F.sum("n").alias("mentions"))
    known = short_forms.select(F.lower("short_form").alias("short"), F.lower("given_name").alias("given")).where(F.col("short").isNotNull() & F.col("given").isNotNull()).groupBy("short").agg(F.array_sort(F.collect_set("given")).alias("given"))
    known = cut(known)
    part = forms.select("form", "family", F.explode(F.split(F.split_part("form", F.lit("|"), F.lit(1)), " ")).alias("short"))
    expanded = part.where((F.col("short") != F.col("family")) & (F.col("short") != "")).join(_sent(known, _few(known)), "short")
    expanded = expanded.groupBy("form").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("given")))).alias("expansions"))
    forms = forms.join(expanded, "form", "left")
    return spellings.select("name", "form"), forms.withColumn("id", F.xxhash64("form"))


def _few(df: DataFrame) -> bool:
    return df.count() <= MOST_SHARED


def _sent(df: DataFrame, few: bool) -> DataFrame:
    """df as the side of a join that all tasks get, if it was found to be small."""
    return F.broadcast(df) if few else df


def bucket_pairs(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b: the ids of rows (bucket, id, asks) that share a bucket and of which one asks; each pair perhaps several times.

    Rows are shuffled once, by bucket. Buckets of up to `block` rows are paired where they are; larger ones are compared in blocks, in
    many tasks; none is cut.
    """
    # Most buckets hold one row; the others are stored, as two ways lead on from here.
    sized = cut(rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).where(F.col("n") > 1))
    one = F.struct("id", "asks")
    lists = sized.where(F.col("n") <= block).groupBy("bucket").agg(F.collect_list(one).alias("all")).where(F.exists("all", lambda x: x["asks"]))
    met = lists.select(F.explode("all").alias("x"), "all").select("x", F.explode(F.filter("all", lambda y: (F.col("x.id") < y["id"]) & (F.col("x.asks") | y["asks"]))).alias("y"))
    large = sized.where(F.col("n") > block).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    left = large.select("bucket", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("salt"), one.alias("x"))
    right = large.select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"), one.alias("y"))
    crossed = left.join(right, ["bucket", "salt"]).where((F.col("x.id") < F.col("y.id")) & (F.col("x.asks") | F.col("y.asks"))).select("x", "y")
    return met.unionByName(crossed).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _exploded(df: DataFrame, views, columns: list[str]) -> DataFrame:
    """(bucket, id, asks) of df's rows; views(row's columns, seen) gives bucket keys."""

    def banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for pdf in batches:
            keys = [views(seen, *v) for v in zip(*(pdf[c] for c in columns))]
            sizes = [len(k) for k in keys]
            yield pd.DataFrame({"bucket": np.concatenate(keys) if keys else np.zeros(0, np.int64), "id": np.repeat(pdf["id"].to_numpy(np.int64), sizes), "asks": np.repeat(pdf["asks"].to_numpy(bool), sizes)})

    return df.select(*columns, "id", "asks").mapInPandas(banded, "bucket bigint, id bigint, asks boolean")


def name_links(forms: DataFrame, block: int = BLOCK, least: float = LEAST_SIMILARITY) -> DataFrame:
    """(a, b, score): verified links between forms, a < b, with a Monge-Elkan similarity of `least` or more."""
    few = _few(forms)

    @F.pandas_udf("struct<asks boolean, homes array<struct<initial string, home string>>, lone string>")
    def read(form: pd.Series, family: pd.Series, expansions: pd.Series) -> pd.DataFrame:
        rows = []
        for f, h, e in zip(form, family, expansions):
            asks, homes = _homes(f, h, None if e is None else list(e))
            rows.append((asks, [{"initial": i, "home": w} for i, w in homes], _lone(f)))
        return pd.DataFrame(rows, columns=["asks", "homes", "lone"])

    @F.pandas_udf("array<string>")
    def folded(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [fold(w) for w in x.split("|")[0].split()])

    forms = cut(forms.withColumn("r", read("form", "family", "expansions")).select("form", "family", "expansions", "id", "r.*", folded("form").alias("words")))

    def rest(seen: dict[str, int], form: str) -> np.ndarray:
        views = [_buckets(t, words, REST_BANDS, REST_ROWS, seen) for t, words in _rest_views(form)]
        lone = _lone(form)
        if lone:
            views.append(_buckets("M", [lone], FAMILY_BANDS, FAMILY_ROWS, seen))
        return np.concatenate(views) if views else np.zeros(0, np.int64)

    beside = bucket_pairs(_exploded(forms.withColumn("asks", F.lit(True)), rest, ["form"]), block)
    # Family names beside an initial: once for all forms that share both; equal ones are one row and need no band.
    homes = forms.select("id", "asks", F.explode("homes").alias("h")).select("id", "asks", "h.*", F.xxhash64("h.initial", "h.home").alias("home_id"))
    kinds = cut(homes.groupBy(F.col("home_id").alias("id")).agg(F.first("initial").alias("initial"), F.first("home").alias("home"), F.max("asks").alias("asks")))
    alike = bucket_pairs(_exploded(kinds, lambda seen, initial, home: _home_keys(initial, home, seen), ["initial", "home"]), block).distinct()
    few_kinds = _few(kinds)
    named = lambda x: kinds.select(F.col("id").alias(x), F.col("home").alias(f"home_{x}"))

    @F.pandas_udf("int")
    def slip_count(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([slips(p, q) for p, q in zip(x, y)], dtype="int32")

    slipped = alike.join(_sent(named("a"), few_kinds), "a").join(_sent(named("b"), few_kinds), "b").where(slip_count("home_a", "home_b") <= 2).select("a", "b")
    near = cut(slipped.unionByName(slipped.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(kinds.where("asks").select(F.col("id").alias("a"), F.col("id").alias("b"))))
    # Those that ask meet all who share the initial and a family name alike; hot family names are spread over tasks.
    asking = homes.where("asks").select(F.col("id").alias("x"), F.col("home_id").alias("a"))
    asked = asking.join(_sent(near, _few(near)), "a").select("x", F.col("b").alias("home_id"))
    met = salted_lookup(homes.select(F.col("id").alias("y"), "home_id"), asked, "home_id", "y").where(F.col("x").isNotNull() & (F.col("x") != F.col("y")))
    pairs = beside.unionByName(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct()
    text = lambda x: forms.select(F.col("id").alias(x), F.struct("form", "family", "expansions").alias(f"form_{x}"))

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(a, b, *compare(_plain(x), _plain(y))) for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["form_a"], pdf["form_b"])]
            yield pd.DataFrame([(*f, slips(f[3], f[4])) for f in found if f[2] >= least], columns=["a", "b", "score", "part_a", "part_b", "slips"])

    links = cut(pairs.join(_sent(text("a"), few), "a").join(_sent(text("b"), few), "b").mapInPandas(verified, "a bigint, b bigint, score double, part_a string, part_b string, slips int"))
    # A slip makes a rare part out of a usual one; two parts that are both usual are two names.
    slipped = links.where(F.col("part_a") != "")
    frequency = forms.select(F.explode("words").alias("word")).where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    wanted = slipped.select(F.explode(F.array("part_a", "part_b")).alias("word")).distinct()
    frequency = cut(frequency.join(wanted, "word", "left_semi"))
    few_words = _few(frequency)
    count = lambda x: _sent(frequency.select(F.col("word").alias(f"part_{x}"), F.col("n").alias(f"n_{x}")), few_words)
    judged = slipped.join(count("a"), "part_a", "left").join(count("b"), "part_b", "left")
    low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    usual = F.when(F.col("slips") <= 1, (low <= 2) | (low * 4 <= high)).otherwise(((low <= 1) & (high >= 3)) | (low * 10 <= high))
    return links.where(F.col("part_a") == "").select("a", "b", "score").unionByName(judged.where(usual).select("a", "b", "score"))


def _plain(row) -> tuple[str, str, list[str] | None]:
    e = row["expansions"]
    return row["form"], row["family"], None if e is None else list(e)


def star_clusters(nodes: DataFrame, links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(id, center): star clustering of nodes (id, rank) under links (a, b, score).

    A node is a centre if no node linked to it that ranks higher (rank, then id) is one; others belong to their most similar centre, of
    equally similar ones to the highest in rank. Found in rounds, each over the undecided nodes only; between rounds the state is written to the
    shared folder. A round decides all nodes that outrank their undecided neighbours, so there are as many as the longest chain of falling ranks;
    after `rounds` of them the rest go by a hash of their ids instead of rank, which leaves a number of rounds in the logarithm of the nodes. Nodes
    without links are their own centres. No links or no nodes give no errors.
    """
    few = _few(nodes)
    order = lambda x: F.struct(F.col(f"rank_{x}"), F.col(x))
    ranked = lambda x: _sent(nodes.select(F.col("id").alias(x), F.col("rank").alias(f"rank_{x}")), few)
    both = links.select("a", "b", "score").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    edges = cut(both.groupBy("a", "b").agg(F.max("score").alias("score")).join(ranked("a"), "a").join(ranked("b"), "b"))
    open_edges, centers, n = edges.select("a", "b", "rank_a", "rank_b"), None, 0
    while True:
        n += 1
        if n == rounds + 1:
            open_edges = open_edges.withColumns({"rank_a": F.xxhash64("a"), "rank_b": F.xxhash64("b")})
        # Among undecided nodes: those that outrank every undecided neighbour.
        new = cut(open_edges.groupBy("a", "rank_a").agg(F.max(order("b")).alias("top")).where(order("a") > F.col("top")).select(F.col("a").alias("id")))
        size = new.count()
        if not size:
            break
        few_new = size <= MOST_SHARED
        centers = new if centers is None else centers.unionByName(new)
        taken = open_edges.join(_sent(new.select(F.col("id").alias("b")), few_new), "b", "left_semi").select("a").unionByName(new.select(F.col("id").alias("a")))
        gone = cut(taken.distinct())
        few_gone = few_new and _few(gone)
        open_edges = cut(open_edges.join(_sent(gone, few_gone), "a", "left_anti").join(_sent(gone.select(F.col("a").alias("b")), few_gone), "b", "left_anti"))
    if centers is None:
        return nodes.select("id", F.col("id").alias("center"))
    # Everyone else is a centre too: a node whose neighbours all belong to other centres has dropped out of the open links undecided.
    few_centers = _few(centers)
    satellites = cut(edges.join(_sent(centers.select(F.col("id").alias("b")), few_centers), "b", "left_semi").select(F.col("a").alias("id")).distinct())
    few_satellites = _few(satellites)
    own = edges.join(_sent(satellites.select(F.col("id").alias("a")), few_satellites), "a", "left_semi").join(_sent(satellites.select(F.col("id").alias("b")), few_satellites), "b", "left_anti")
    best = own.groupBy(F.col("a").alias("id")).agg(F.max_by("b", F.struct("score", order("b"))).alias("center"))
    return nodes.select("id").join(best, "id", "left").withColumn("center", F.coalesce("center", "id"))


def link_names(df: DataFrame, names: str, short_forms: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """(name, entity): one row for each distinct spelling in an array column of names, exactly as stored; equal entities are one person or group.

    short_forms (given_name, short_form) lists given names' short forms; links need a Monge-Elkan similarity of `least`. NULL arrays, NULL names, blanks and fillers ("et al." ..)
    belong to nobody and are left out. Texts of more than MOST_PARTS parts are linked to spellings of the same form only. Repeated mentions count for a spelling's rank only. Empty tables give no rows; other columns
    are not read.
    """
    spellings, forms = name_forms(df, names, short_forms)
    forms = cut(forms)
    whole = (F.size(F.split(F.split_part("form", F.lit("|"), F.lit(1)), " ")) > 1) & F.col("expansions").isNull()
    clusters = star_clusters(forms.select("id", (F.col("mentions") + F.when(whole, F.lit(1 << 40)).otherwise(F.lit(0))).alias("rank")), name_links(forms, least=least))
    return spellings.join(forms.select("form", "id"), "form").join(clusters, "id").select("name", F.col("center").alias("entity"))


def name_pairs(linked: DataFrame) -> DataFrame:
    """(name_a, name_b) of link_names' result: the spellings of each entity in pairs, name_a < name_b by code point."""
    a, b = linked.select("entity", F.col("name").alias("name_a")), linked.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")
