import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm.mixing import SEEDS, fit_rate, fit_rotation, mix_sources, poisson_steps
from ledgerline.llm.packing import dot_product_pack, pack_documents, packing_report
from ledgerline.llm.tokens import VOCABULARY, canonical_source, token_counts


def test_dot_product_pack_against_plain_python():
    rng = random.Random(2)
    for _ in range(20):
        n = rng.randint(0, 40)
        items = np.array([(rng.randint(1, 100), 1, rng.randint(0, 50)) for _ in range(n)], float).reshape(n, 3)
        limits = np.array([100, rng.choice([2, 5, 50]), 50.0])
        bins = dot_product_pack(items, limits)
        assert (bins >= 0).all() if n else len(bins) == 0
        for b in set(bins.tolist()):
            inside = items[bins == b]
            assert (inside.sum(0) <= limits + 1e-6).all()
        assert bins.tolist() == plain(items, limits)


def test_an_item_beyond_a_limit_is_an_error():
    with pytest.raises(ValueError):
        dot_product_pack(np.array([[5.0, 1, 60]]), np.array([100.0, 2, 50]))


def test_rows_of_one_id_are_spread_over_shards(spark):
    df = spark.range(0, 4000, 1, 4).select(F.lit(7).cast("long").alias("doc_id"), F.lit(50).cast("long").alias("tokens"), F.lit(0).cast("long").alias("head_tokens"))
    packed = pack_documents(df.cache(), spark.createDataFrame([("c", 512)], "container string, capacity_tokens int"), shard_docs=500).collect()
    assert len(packed) == 4000 and len({r.bin.split("/")[1] for r in packed}) == 8


def plain(items, limits):
    scaled = items / limits
    weight = scaled.sum(0) / max(scaled.sum(), 1e-12)
    order = sorted(range(len(items)), key=lambda k: tuple(-scaled[k]))
    bins, opened = [-1] * len(items), 0
    while left := [k for k in order if bins[k] < 0]:
        room, k = np.ones(3), left[0]
        while k is not None:
            bins[k] = opened
            room = room - scaled[k]
            fit = [j for j in order if bins[j] < 0 and (scaled[j] <= room + 1e-9).all()]
            k = max(fit, key=lambda j: sum(weight * room * scaled[j])) if fit else None
        opened += 1
    return bins


def sizes(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = [(k, max(1, int(rng.lognormvariate(5.2, 0.8))), "x") for k in range(n)] + [(n, 5000, "x"), (n + 1, 1024, "x"), (n + 2, 0, "x"), (n + 3, None, "x")]
    return spark.createDataFrame([(k, t, (t or 0) // 5, b) for k, t, b in rows], "doc_id long, tokens long, head_tokens long, bin string")


CAPACITIES = [("short", 512), ("long", 8192), ("short", 512), (None, 9), ("zero", 0)]


def test_pack_documents(spark):
    caps = spark.createDataFrame(CAPACITIES, "container string, capacity_tokens int")
    df = sizes(spark)
    packed = pack_documents(df, caps, shard_docs=1000).cache()
    want = {r.doc_id: r.tokens or 0 for r in df.collect()}
    for name, capacity in (("short", 512), ("long", 8192)):
        rows = packed.where(F.col("container") == name).collect()
        by, bins = {}, {}
        for r in rows:
            by.setdefault(r.doc_id, []).append(r)
            if r.bin is not None:
                bins.setdefault(r.bin, []).append(r)
        assert {k: sum(r.tokens for r in v) for k, v in by.items()} == want
        for k, v in by.items():
            pieces = sorted(v, key=lambda r: r.piece_no)
            assert len(pieces) == 1 or want[k] > capacity
            assert [r.first_token for r in pieces] == [n * capacity for n in range(len(pieces))]
            natural = [max(0, r.first_token + r.tokens - max(r.first_token, want[k] // 5)) for r in pieces]
            assert [r.loss_tokens for r in pieces] == [min(x, int(0.95 * capacity)) for x in natural]
        for v in bins.values():
            assert sum(r.tokens for r in v) <= capacity
            assert sum(r.loss_tokens for r in v) <= 0.95 * capacity and len(v) <= capacity // 64
        assert by[3002][0].bin is None and by[3003][0].bin is None
    # Where segments hardly bind, little room is lost even in shards of a few bins.
    fill = {r.container: r for r in packing_report(pack_documents(df, caps, shard_docs=1000, tokens_a_segment=16), caps).collect()}
    assert fill["short"].fill > 0.95 and fill["long"].fill > 0.97 and fill["long"].documents == 3002
    assert pack_documents(df.limit(0), caps).count() == 0 and pack_documents(df, caps.limit(0)).count() == 0


def test_loss_and_segments_bind(spark):
    df = spark.createDataFrame([(k, 10, 0) for k in range(100)], "doc_id long, tokens long, head_tokens long")
    caps = spark.createDataFrame([("c", 100)], "container string, capacity_tokens int")
    assert pack_documents(df, caps, loss_share=0.5, tokens_a_segment=10).groupBy("bin").count().agg(F.max("count")).first()[0] == 5
    assert pack_documents(df, caps, loss_share=1.0, tokens_a_segment=25).groupBy("bin").count().agg(F.max("count")).first()[0] == 4


def test_poisson():
    steps = poisson_steps(1.5, 6)
    assert [round(s, 6) for s in steps] == [round(sum(math.exp(-1.5) * 1.5**j / math.factorial(j) for j in range(k + 1)), 6) for k in range(6)]
    assert poisson_steps(math.inf, 2) == [0.0, 0.0]
    mass = np.full(SEEDS, 10.0)
    assert fit_rate(mass, 2 * mass.sum(), 2) == math.inf and fit_rate(mass, 0, 2) == 0.0 and fit_rate(np.zeros(SEEDS), 5, 2) == 0.0
    assert abs(fit_rate(mass, 0.5 * mass.sum(), 1) - math.log(2)) < 0.01
    lumpy = mass.copy()
    lumpy[1000] = mass.sum()
    turn, rate = fit_rotation(lumpy, 0.3 * mass.sum(), 1)
    drawn = np.roll(lumpy, turn)[(np.arange(SEEDS) + 0.5) / SEEDS > math.exp(-rate)].sum()
    assert abs(drawn - 0.3 * mass.sum()) < 0.01 * mass.sum()


def test_mix_sources(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(["big", "BIG ", "mid-dle", "small"] if k % 40 == 0 else ["big"]), int(rng.lognormvariate(5, 1)) + 1, "x") for k in range(8000)] + [(9001, None, 50, "x"), (9002, "odd", 50, "x"), (9003, "big", None, "x"), (9004, "big", 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, tokens long, seed string")
    targets = spark.createDataFrame([("big", 0.9, 1), ("mid_dle", 0.02, 4), ("small", 0.5, 3), ("gone", 0.1, 2), (None, 1.0, 1)], "source string, target_share double, max_repeats int")
    draws, shares = mix_sources(df, targets)
    by = {r.source: r for r in shares.collect()}
    total = sum(r[2] or 0 for r in rows)
    assert abs(by["big"].reached_share - 0.9) < 0.002 and abs(by["mid_dle"].reached_share - 0.02) < 0.003
    assert by["small"].draws == 3 * by["small"].documents and by["gone"].draws == 0 and by["big"].total_tokens == total
    got = draws.collect()
    assert len(got) == sum(r.draws for r in by.values()) and len({(r.doc_id, r.copy_no) for r in got}) == len(got)
    assert max(r.copy_no for r in got if r.source == "big") == 1 and max(r.copy_no for r in got) <= 4
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    assert {r.source for r in got} == {"big", "mid_dle", "small"}
    again, _ = mix_sources(df.repartition(3), targets)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
    assert sorted(r.doc_id for r in mix_sources(df, targets, seed=9)[0].where("source = 'big'").collect()) != sorted(r.doc_id for r in got if r.source == "big")
    assert mix_sources(df.limit(0), targets)[0].count() == 0 and mix_sources(df, targets.limit(0))[0].count() == 0


def test_canonical_source(spark):
    df = spark.createDataFrame([(" Page-Text ",), ("JOB_POST",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(canonical_source(F.col("s"))).collect()] == ["page_text", "job_post", None, None]


def test_token_counts(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    from ledgerline.llm.tokens import PATTERN

    try:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    except OSError:
        pytest.skip("no vocabulary file here")
    encode = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    texts = ["# Title\n\nSome text, naïve.", "one line", "", None, "\n\nx", "word " * 200_000]
    df = spark.createDataFrame([(k, t, "s", 1) for k, t in enumerate(texts)], "doc_id long, text string, source string, tokens int")
    got = {r.doc_id: (r.tokens, r.head_tokens) for r in token_counts(df, "doc_id", "text", "source").collect()}
    assert {k: v[0] for k, v in got.items()} == {k: len(encode(t)) if t else 0 for k, t in enumerate(texts)}
    assert got[0][1] == len(encode("# Title\n")) and got[1][1] == got[4][1] == 0


def test_long_runs_of_white_space():
    """They are counted as the tokenizer counts shorter ones, and end nothing however long they are."""
    import base64

    import tiktoken

    from ledgerline.llm.tokens import PATTERN, encoder

    with open(VOCABULARY, "rb") as f:
        raw = f.read()
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    encode = encoder(raw)
    rng = random.Random(4)
    for _ in range(60):
        run = lambda: "".join(rng.choice([" ", "\n", " \t", "\u3000", "\xa0"]) for _ in range(rng.choice([1, 3, 9_999, 10_000, 12_000])))
        text = "".join(rng.choice(["word", " it's", "12", "!?", "é"]) + run() for _ in range(rng.randint(1, 4))) + rng.choice(["", "end", "\x1c"])
        text = text if rng.random() < 0.7 else run() + text
        assert encode(text) == plain(text)
    assert len(encode("a" + " " * 3_000_000 + "b")) == 3_000_001
