"""Names with an initial meet whole names whose family name differs by one slip, however short it is."""

import random

from ledgerline.llm import names as N


def keys(name):
    form, family = N.parse_name(name)
    return {int(b) for initial, home in N._homes(form, family, None)[1] for b in N._home_keys(initial, home, {})}


def slipped(w):
    """Every word that one slip makes of w."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(len(w)):
        yield w[:k] + w[k + 1 :]
        yield w[: k + 1] + w[k:]
        yield w[:k] + w[k + 1 : k + 2] + w[k] + w[k + 2 :]
        for c in letters:
            yield w[:k] + c + w[k + 1 :]


def test_any_one_slip_is_met():
    rng = random.Random(3)
    for n in (3, 4, 5, 6, 7, 9):
        w = "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", n))
        whole = keys(f"John {w.capitalize()}")
        for v in set(slipped(w)):
            if len(v) > 2:
                assert N.slips(*sorted((w, v), key=len)) <= 2 and whole & keys(f"J. {v.capitalize()}"), (w, v)


def test_a_slip_inside_a_short_family_is_linked(spark):
    rows = [(["John Wagner", "Mia Holt"],)] * 9 + [(["J. Wanger", "M. Hlot"],)]
    short = spark.createDataFrame([], "given_name string, short_form string")
    linked = N.name_pairs(N.link_names(spark.createDataFrame(rows, "authors array<string>"), "authors", short))
    assert {tuple(r) for r in linked.collect()} == {("J. Wanger", "John Wagner"), ("M. Hlot", "Mia Holt")}
