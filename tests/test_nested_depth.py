"""Claims nested deeper than calls can be, and JSON in many layers of strings."""

import json

import pytest

from ledgerline.operators.nested import _claim_rows, _well_nested

CLAIM = '{"field":"deep","value":1}'


@pytest.mark.parametrize("depth", [600, 5000, 50_000, 300_000])
def test_deep_claims(depth):
    arrays = '{"final_extraction":{"claims":' + "[" * depth + CLAIM + "," + CLAIM.replace("deep", "next") + "]" * depth + "}}"
    wrappers = '{"final_extraction":{"claims":' + '{"w":' * 600 + CLAIM + "}" * 600 + "}}"
    rows = [r[:5] for r in _claim_rows(["a", "b"], [arrays, wrappers])]
    assert rows == [("a", "final_extraction", 0, 1, "deep"), ("a", "final_extraction", 0, 2, "next"), ("b", "final_extraction", 0, 1, "deep")]


def test_many_layers_of_strings():
    text = '{"final_extraction":{"claims":[' + CLAIM + "]}}"
    for _ in range(7):
        text = json.dumps(text)
    assert [r[:5] for r in _claim_rows(["a", "b"], [text, '"""'])] == [("a", "final_extraction", 0, 1, "deep")]


def test_a_claim_whose_value_nests_deep():
    for depth in (600, 100_000):
        value = "[" * depth + "1" + "]" * depth
        text = '{"final_extraction":{"claims":[{"field":"a","value":' + value + ',"supported":true},' + CLAIM + "]}}"
        rows = _claim_rows(["r"], [text])
        assert [r[:5] for r in rows] == [("r", "final_extraction", 0, 1, "a"), ("r", "final_extraction", 0, 2, "deep")]
        assert rows[0][5] == value and rows[0][-1] is True


def test_well_nested_is_what_the_parser_reads():
    import random

    rng = random.Random(1)
    good = ['{"a":[1,-2.5e3,null,true,{}],"b":"x\\u00e9\\n"}', "[]", "{}", " [ 1 , [ ] ] ", '"s"', "0", "[NaN]"]
    texts = good + ["", "[1,]", "{,}", '{"a"}', '{"a":}', "[1 2]", "[}", "01", '["a\n"]', "[1]]", "nul", '{"a":1,}', "{1:2}"]
    texts += ["".join(t[k] for k in sorted(rng.sample(range(len(t)), len(t) - rng.randint(1, 2)))) for t in good if len(t) > 3 for _ in range(200)]
    for t in texts:
        try:
            json.loads(t)
            ok = True
        except ValueError:
            ok = False
        assert _well_nested(t) == ok, t


def test_deep_texts_that_are_broken_give_nothing():
    broken = '{"final_extraction":{"claims":' + "[" * 50_000 + CLAIM + "]" * 49_999 + "}}"
    assert _claim_rows(["r"], [broken]) == []
