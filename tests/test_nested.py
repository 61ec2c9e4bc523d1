import json
import random
import xml.etree.ElementTree as ET

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.operators.nested import PROVIDERS, JsonIndex, _claim_rows, _feed_rows, flatten_feeds, flatten_results

NS = "{http://www.w3.org/2005/Atom}"


def brute_feed(i, x):
    try:
        root = ET.fromstring(x)
    except ET.ParseError:
        return set()
    out = set()
    for k, e in enumerate(root.findall(NS + "entry"), 1):
        out.add((i, "entry", 0, k, e.findtext(NS + "id")))
        names = [n.strip() for a in e.findall(NS + "author") if (n := a.findtext(NS + "name")) and n.strip()]
        out |= {(i, "author", k, m, n) for m, n in enumerate(names, 1)}
    return out


FEEDS = [
    '<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title><entry><id>a</id><title>x</title><author><name>N &amp; M</name></author><author><name> </name></author><author><name><![CDATA[C <d>]]></name></author></entry><!-- <entry><id>no</id></entry> --><entry/></feed>',
    '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry at="1>2"><a:id>b</a:id><a:author><a:affiliation>z</a:affiliation><a:name>Q<!-- c -->R</a:name></a:author></a:entry></a:feed>',
    '<feed xmlns="http://www.w3.org/2005/Atom"><entry xmlns="urn:other"><id>c</id></entry><x:entry xmlns:x="http://www.w3.org/2005/Atom"><x:id>d</x:id></x:entry></feed>',
    "<feed><entry><id>no namespace</id></entry></feed>",
    '<feed xmlns="http://www.w3.org/2005/Atom"><entry><source><author><name>inner</name></author><entry/></source></entry></feed>',
    "<not valid xml",
    "",
    '<feed xmlns="http://www.w3.org/2005/Atom"/>',
]


def test_feeds_against_a_tree():
    ids = [str(k) for k in range(len(FEEDS))]
    got = {(r[0], r[1], r[2], r[3], r[5]) for r in _feed_rows(ids, FEEDS)}
    assert got == set().union(*(brute_feed(i, x) for i, x in zip(ids, FEEDS)))
    assert sum(r[1] == "entry" for r in _feed_rows(ids, FEEDS)) == 5


def unwrap(v):
    """A value, or what JSON within strings within strings holds."""
    while isinstance(v, str):
        try:
            v = json.loads(v)
        except ValueError:
            return None
    return v


def flat(v):
    v = unwrap(v)
    if isinstance(v, dict):
        yield v
    elif isinstance(v, list):
        for x in v:
            yield from flat(x)


def brute_claims(i, text):
    dec = lambda v: x if isinstance(x := unwrap(v), dict) else {}
    o = dec(text)
    nodes = {"final_extraction": dec(o.get("final_extraction"))}
    for p in PROVIDERS:
        r = dec(dec(o.get(p)).get("result"))
        nodes[p] = dec(r.get("corrected_extraction")) if p == "cohere" else r
    return [(i, n, 0, k, c["field"] if isinstance(c.get("field"), str) else "") for n, x in nodes.items() for k, c in enumerate(flat(x.get("claims")), 1)]


claims = st.recursive(
    st.one_of(st.none(), st.fixed_dictionaries({"field": st.one_of(st.none(), st.text(max_size=6)), "value": st.one_of(st.booleans(), st.text(alphabet='a"\\{}[],:\n', max_size=8))})),
    lambda x: st.one_of(st.lists(x, max_size=3), x.map(json.dumps)),
    max_leaves=6,
)
extraction = st.one_of(st.none(), st.fixed_dictionaries({"claims": claims, "x": st.text(max_size=5)}))
results = st.fixed_dictionaries({}, optional={"final_extraction": st.one_of(extraction, extraction.map(json.dumps)), "gemini": st.one_of(st.none(), st.fixed_dictionaries({"result": extraction})), "cohere": st.fixed_dictionaries({"result": st.fixed_dictionaries({"corrected_extraction": extraction})}), "more": st.text(max_size=9)})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(results, st.sampled_from([None, 1]), st.booleans()), min_size=1, max_size=5))
def test_claims_against_a_tree(items):
    texts = [json.dumps(r, indent=i, ensure_ascii=a) for r, i, a in items] + ['{"final_extraction": {"claims": [{"field": "cut"', "", "null", "7"]
    ids = [str(k) for k in range(len(texts))]
    got = [tuple(r[:5]) for r in _claim_rows(ids, texts)]
    assert sorted(got) == sorted(c for i, t in zip(ids, texts) for c in brute_claims(i, t))


def test_index_depth_and_escapes():
    texts = [rb'{"a\\": [1, {"b\"]": "}"}], "c": {}}', b'{"d": "open', b'[{"e": 1}]']
    x = JsonIndex(texts)
    assert [(d, n) for d, n, *_ in x.keys({b"c": "c", b"e": "e"})] == [(0, "c"), (2, "e")]
    assert [k[2] for k in x.keys({b"c": "c", b"e": "e"})] == [1, 2]


def test_copies_in_one_batch_are_numbered_alike():
    text = json.dumps({"final_extraction": {"claims": [{"field": "a"}, {"field": "b"}]}})
    rows = [r[:5] for r in _claim_rows(["1", "1", "2"], [text] * 3)]
    assert rows == [("1", "final_extraction", 0, 1, "a"), ("1", "final_extraction", 0, 2, "b")] * 2 + [("2", "final_extraction", 0, 1, "a"), ("2", "final_extraction", 0, 2, "b")]
    feeds = [r[:4] for r in _feed_rows(["1", "1"], FEEDS[:1] * 2)]
    assert len(feeds) == 2 * len(set(feeds))


def test_large_block_equals_small_blocks(monkeypatch):
    rng = random.Random(3)
    texts = [json.dumps({"final_extraction": {"claims": [{"field": str(rng.random())} for _ in range(rng.randint(0, 5))]}}) for _ in range(60)]
    ids = [str(k) for k in range(60)]
    whole = _claim_rows(ids, texts)
    monkeypatch.setattr("ledgerline.operators.nested.BLOCK_BYTES", 100)
    assert _claim_rows(ids, texts) == whole


def test_operators_on_odd_tables(spark):
    df = spark.createDataFrame([("a", FEEDS[0], "x"), ("a", FEEDS[0], "x"), (None, FEEDS[0], "x"), ("n", None, "x"), ("b", FEEDS[5], "x")], "id string, xml string, record_id string")
    rows = flatten_feeds(df, "id", "xml").collect()
    assert sorted((r.node, r.parent_no, r.child_no) for r in rows) == [("author", 1, 1), ("author", 1, 2), ("entry", 0, 1), ("entry", 0, 2)]
    assert {r.name for r in rows if r.node == "author"} == {"N & M", "C <d>"}
    assert flatten_feeds(df.limit(0), "id", "xml", keys_only=True).count() == 0
    long = json.dumps({"final_extraction": {"claims": [{"field": "f", "value": "v" * 5_000_000}]}})
    some = spark.createDataFrame([(1, long, "q"), (1, long, "q"), (2, None, "q"), (3, "{", "q")], "result_id long, result_json string, node string")
    assert [tuple(r) for r in flatten_results(some, "result_id", "result_json", keys_only=True).collect()] == [("1", "final_extraction", 0, 1, "f")]
