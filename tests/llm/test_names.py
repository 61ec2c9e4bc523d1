import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import names as N

SCHEMA = "authors array<string>, name string, form string, id string"


@pytest.mark.parametrize(
    "a, b",
    [("Dr. Zorren Vomnorath", "VOMNORATH Zorren"), ("Livgoaru, Koldan M.", "Koldan M. Livgoaru"), ("Koldan Livgoaru (ed.)", "koldan  livgoaru"), ("Koldan ,Livgoaru", "Koldan. Livgoaru"), ("Koldan Livgoaru, PhD", "Koldan Livgoaru Jr."), ("BN Menbamark", "B. N. Menbamark"), ("P-Corpus Collaboration", "The P Corpus Collab"), ("M. van Gurbaesti", "van Gurbaesti, M."), ("MR Gevsaashi", "M. R. Gevsaashi")],
)
def test_same_form(a, b):
    assert N.parse_name(a)[0] == N.parse_name(b)[0]


def test_nobody():
    for x in (None, "", " ", "et al.", "And others", "123", "-"):
        assert N.parse_name(x) is None
    assert N.parse_name("van")[0] and N.parse_name("A.") is not None


def test_slips():
    assert [N.slips(a, b) for a, b in [("abc", "abc"), ("abc", "ac"), ("abc", "abbc"), ("abcd", "acbd"), ("gosvoualt", "gosvpualt"), ("botgo", "bezgo"), ("bat", "bpt"), ("a", "abc")]] == [0, 1, 1, 1, 1, 3, 2, 3]


def form(x, e=None):
    return (*N.parse_name(x), e)


def test_compare():
    same = [("Zorren Vomnorath", "Zorren Vomnoarth"), ("Z. Vomnorath", "Zorren Vomnorath"), ("Z. K. Vomnorath", "Zorren K. Vomnorath"), ("Zorren Kalmo Vomnorath", "Zorren K. Vomnorath"), ("Zor Vomnorath", "Zorren Vomnorath"), ("Zorren Vómnorath", "Zorren Vomnorath"), ("Z.-V. Mora", "Zist-Vel Mora"), ("Zist Vel Mora", "Zist-Vel Mora")]
    other = [("Zorren Vomnorath", "Kalmo Vomnorath"), ("K. Vomnorath", "Zorren Vomnorath"), ("Zorren K. Vomnorath", "Zorren L. Vomnorath"), ("Z. L. Vomnorath", "Zorren K. Vomnorath"), ("Vel Mora", "Zist-Vel Mora"), ("Vuklaic Grid Collaboration", "Vuklaic Survey Collaboration"), ("Zorrem Vomnorat", "Zorren Vomnorath")]
    for a, b in same:
        assert N.compare(form(a), form(b))[0] > 0 and N.compare(form(b), form(a))[0] > 0, (a, b)
    for a, b in other:
        assert N.compare(form(a), form(b))[0] == 0 and N.compare(form(b), form(a))[0] == 0, (a, b)
    assert N.compare(form("Dra Mora", ["gendra"]), form("Gendra Mora"))[0] > 0


def test_collision_curve():
    """Bands meet as often as the curve they are tuned by says."""
    rng = random.Random(0)
    letters = "abcdefghijklmnopqrstuvwxyz"
    met = expected = n = 0
    for _ in range(300):
        w = "".join(rng.choice(letters) for _ in range(8))
        k = rng.randrange(6)
        v = w[:k] + w[k + 1] + w[k] + w[k + 2 :]
        a, b = N.padded_grams([w]), N.padded_grams([v])
        s = len(a & b) / len(a | b)
        hit = set(N._buckets("x", [w], N.REST_BANDS, N.REST_ROWS, {})) & set(N._buckets("x", [v], N.REST_BANDS, N.REST_ROWS, {}))
        met += bool(hit)
        expected += 1 - (1 - s**N.REST_ROWS) ** N.REST_BANDS
        n += 1
    assert abs(met - expected) / n < 0.03 and met / n > 0.97
    assert N.bands_for(0.5, 0.99, 2) == 17


def make(rng, families=12, people=60):
    part = lambda: rng.choice("bdgklmnprstvz") + rng.choice("aeiou") + rng.choice("lmnrst")
    family = [(part() + part() + rng.choice(["quist", "oander", "ell"])).capitalize() for _ in range(families)]
    out, used = {}, set()
    while len(out) < people:
        f, g = rng.choice(family), (part() + part()).capitalize()
        if (f, g[0]) in used:
            continue
        used.add((f, g[0]))
        k = rng.randrange(1, len(f) - 2)
        typo = f[:k] + f[k + 1] + f[k] + f[k + 2 :]
        out[f"{g} {f}"] = [f"{g} {f}"] * 9 + [f"{f}, {g}", f"{g.upper()} {f.upper()}", f"{g[0]}. {f}", f"{f} {g[0]}", f"{g} {typo}" if typo != f else f"{g} {f}"]
    return out


def test_links_recall_and_precision(spark):
    people = make(random.Random(4))
    mentions = [n for v in people.values() for n in v]
    random.Random(1).shuffle(mentions)
    rows = [(mentions[k : k + 3] + ["et al.", None, " "], "n", "f", "i") for k in range(0, len(mentions), 3)] + [(None, "n", "f", "i"), ([], "n", "f", "i")]
    short = spark.createDataFrame([], "given_name string, short_form string")
    linked = N.link_names(spark.createDataFrame(rows, SCHEMA), "authors", short)
    found = {tuple(r) for r in N.name_pairs(linked).collect()}
    true = {tuple(sorted(p)) for v in people.values() for p in itertools.combinations(set(v), 2)}
    assert all(a < b for a, b in found)
    assert len(found & true) / len(true) > 0.95 and len(found & true) / len(found) > 0.97
    assert linked.select("name").distinct().count() == linked.count() == len(set(mentions))


def test_blocks_of_hot_buckets_lose_nothing(spark):
    people = make(random.Random(6), families=2, people=20)
    rows = [(v, "n", "f", "i") for v in people.values()]
    _, forms = N.name_forms(spark.createDataFrame(rows, SCHEMA), "authors", spark.createDataFrame([("Zorren", "Zor")], "given_name string, short_form string"))
    forms = forms.cache()
    assert sorted(map(tuple, N.name_links(forms, block=2).collect())) == sorted(map(tuple, N.name_links(forms, block=10_000).collect()))


def test_star_clusters(spark):
    nodes = spark.createDataFrame([(1, 10), (2, 9), (3, 8), (4, 7), (5, 1)], "id long, rank long")
    links = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.8), (1, 2, 0.5)], "a long, b long, score double")
    assert {r.id: r.center for r in N.star_clusters(nodes, links).collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}
    assert N.star_clusters(nodes, links.limit(0)).where("id = center").count() == 5
    # Brute force on random graphs: the greedy choice in order of rank.
    rng = random.Random(3)
    n = 60
    pairs = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(120)})
    edges = [(a, b, rng.choice([0.5, 0.7, 0.9])) for a, b in pairs]
    rank = {k: rng.randint(0, 9) for k in range(n)}
    near = {k: {} for k in range(n)}
    for a, b, s in edges:
        near[a][b] = near[b][a] = s
    centers = set()
    for k in sorted(range(n), key=lambda k: (rank[k], k), reverse=True):
        if not centers & set(near[k]):
            centers.add(k)
    expected = {k: k if k in centers else max((s, rank[c], c) for c, s in near[k].items() if c in centers)[2] for k in range(n)}
    got = N.star_clusters(spark.createDataFrame(list(rank.items()), "id long, rank long"), spark.createDataFrame(edges, "a long, b long, score double"))
    assert {r.id: r.center for r in got.collect()} == expected


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    short = spark.createDataFrame([(None, "x"), ("y", None)], "given_name string, short_form string")
    assert N.link_names(none, "authors", short).count() == 0
    one = spark.createDataFrame([(["A. B.", "Solo", "x" * 5000], "n", "f", "i")], SCHEMA)
    assert N.name_pairs(N.link_names(one, "authors", short)).count() == 0
    assert np.isfinite(N.REST_BANDS) and one.select(F.size("authors")).first()[0] == 3


def test_one_family_of_many_forms(spark):
    """A family name that all names share: each slip in a given name is met, and no two names that only share it are linked."""
    rng = random.Random(8)
    given = sorted({"".join(rng.choice("bdgklmnprstvz") + rng.choice("aeiou") for _ in range(4)).capitalize() for _ in range(5000)})
    slipped = {g: g[:3] + g[4] + g[3] + g[5:] for g in given[::50]}
    rows = [([f"{g} Wagner"] * 5,) for g in given] + [([f"{v} Wagner"],) for v in slipped.values()]
    short = spark.createDataFrame([], "given_name string, short_form string")
    _, forms = N.name_forms(spark.createDataFrame(rows, "authors array<string>"), "authors", short)
    forms = forms.cache()
    name = {r.id: next(w for w in r.form.split("|")[0].split() if w != "wagner") for r in forms.collect()}
    links = {frozenset((name[r.a], name[r.b])) for r in N.name_links(forms).collect()}
    true = {frozenset((g.lower(), v.lower())) for g, v in slipped.items()}
    assert len(links & true) >= 0.97 * len(true)
    assert all(N.slips(*sorted(p, key=len)) <= 2 for p in links)


def test_tables_too_large_to_share_give_the_same(spark, monkeypatch):
    people = make(random.Random(9), families=5, people=25)
    df = spark.createDataFrame([(v, "n", "f", "i") for v in people.values()], SCHEMA)
    short = spark.createDataFrame([("Zorren", "Zor")], "given_name string, short_form string")
    near = {tuple(r) for r in N.name_pairs(N.link_names(df, "authors", short)).collect()}
    monkeypatch.setattr(N, "MOST_SHARED", 0)
    assert near == {tuple(r) for r in N.name_pairs(N.link_names(df, "authors", short)).collect()} and near


def test_star_clusters_end_after_bounded_rounds(spark):
    """A chain of falling ranks, longer than the rounds by rank: the rest still comes to a star clustering."""
    n = 30
    nodes = spark.createDataFrame([(k, n - k) for k in range(n)], "id long, rank long")
    links = spark.createDataFrame([(k, k + 1, 0.9) for k in range(n - 1)], "a long, b long, score double")
    got = {r.id: r.center for r in N.star_clusters(nodes, links, rounds=2).collect()}
    centers = {c for c in got.values()}
    assert all(got[c] == c for c in centers) and all(k == c or abs(k - c) == 1 for k, c in got.items())
    assert not any(k in centers and k + 1 in centers for k in range(n - 1)) and [got[0], got[1]] == [0, 0]


def test_texts_that_are_no_names(spark):
    """Sentences and lists of names in one text, however long, are spellings of their own form only."""
    long = " ".join(f"{'abcdefghij'[k % 10] * (k % 7 + 2)}" for k in range(20_000))
    rows = [([long, long.upper(), "Ann Lee", "LEE Ann", "(" * 200_000, "a-" * 50_000],)]
    short = spark.createDataFrame([], "given_name string, short_form string")
    found = N.name_pairs(N.link_names(spark.createDataFrame(rows, "authors array<string>"), "authors", short)).collect()
    assert {tuple(r) for r in found} == {(long.upper(), long), ("Ann Lee", "LEE Ann")}
