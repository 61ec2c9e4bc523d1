import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerline.operators.history import change_history, repository_history
from ledgerline.operators.orphans import Reference, bloom_words, evidence_orphans, find_orphans, might_contain, orphan_report
from ledgerline.operators.skew import hot_keys, salted_lookup

T0 = datetime(2025, 1, 1)


def brute(rows):
    out = []
    for key in {r[0] for r in rows if r[0] is not None and r[1] is not None}:
        mine = sorted({(t, v) for k, t, v in rows if k == key and t is not None}, key=lambda x: x[0])
        last = object()
        starts = []
        for t, v in mine:
            if v != last:
                starts.append((t, v))
                last = v
        out += [(key, n, v, t, starts[n][0] if n < len(starts) else None) for n, (t, v) in enumerate(starts, 1)]
    return sorted(out, key=str)


def test_history_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abbbbbbb"), T0 + timedelta(minutes=k), rng.choice([1, 1, 1, 2, None])) for k in range(0, 4000, 7)]
    rng.shuffle(rows)
    rows += rows[:50] + [(None, T0, 1), ("a", None, 1)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int").withColumn("version", F.lit("clash")).withColumn("valid_from", F.lit(0))
    got = change_history(df, "k", "t", ["v"]).collect()
    assert sorted(((r.k, r.version, r.v, r.valid_from, r.valid_to) for r in got), key=str) == brute(rows)
    for block in ("minute", "day", "year"):
        assert sorted(((r.k, r.version, r.v, r.valid_from, r.valid_to) for r in change_history(df, "k", "t", ["v"], block).collect()), key=str) == brute(rows)
    assert change_history(df.limit(0), "k", "t", ["v"]).count() == 0


def test_repository_history_tells_states(spark):
    u = "https://codeforge.example/o/r"
    rows = [(u, 5, 0, "OK"), (u + ".git", None, 1, "ERROR"), (" " + u + "/", 5, 2, "OK"), (u, None, 3, "OK"), (u, None, 4, "NOT_FOUND"), (u, 9, 5, "NOT_FOUND"), (u, 5, 6, "OK"), ("junk", 1, 7, "OK"), (None, 1, 8, "OK"), (u, 6, 9, None)]
    df = spark.createDataFrame([(a, b, T0 + timedelta(hours=c), d) for a, b, c, d in rows], "repo_url string, stargazers_count int, stars_fetched_at timestamp, api_status string")
    got = repository_history(df).orderBy("version").collect()
    assert [(r.gone, r.stargazers_count, (r.valid_from - T0).seconds // 3600) for r in got] == [(False, 5, 0), (True, None, 4), (False, 5, 6)]


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    others = spark.range(10_000, 30_000).select(F.col("id").cast("string").alias("k"))
    for max_bits, parts in ((1 << 26, 1), (1 << 13, 3)):  # in one part, and in three
        made = bloom_words(keys, "k", 2000, max_bits=max_bits)
        assert made[2] == parts and might_contain(keys, "k", made).where(~F.col("__possible")).count() == 0
        assert might_contain(others, "k", made).where("__possible").count() < 1000
    none = bloom_words(keys.limit(0), "k", 0)
    assert might_contain(keys, "k", none).where("__possible").count() == 0
    small = bloom_words(keys, "k", 2000, max_bits=64)
    assert small[1:] == (64, 16) and might_contain(keys, "k", small).where(~F.col("__possible")).count() == 0
    assert might_contain(keys.select(F.lit(None).cast("string").alias("k")), "k", small).where("__possible IS NULL").count() == 2000


def test_orphans_whatever_the_filter_and_the_skew(spark):
    rng = random.Random(2)
    parents = [(f"p{k}", T0 + timedelta(days=k), T0 + timedelta(days=k + 10) if k % 3 == 0 else None) for k in range(20)] + [(None, T0, None)]
    refs = [(f"r{k}", rng.choice(["p1"] * 20 + [f"p{j}" for j in range(30)] + [None]), T0 + timedelta(days=rng.randint(0, 40))) for k in range(600)] + [("u", "p1", None), ("v", "px", None)]
    p, r = spark.createDataFrame(parents, "k string, since timestamp, until timestamp"), spark.createDataFrame(refs + refs[:40], "id string, k string, t timestamp")
    by = {k: (s, u) for k, s, u in parents}

    def judge(k, t):
        if k not in by:
            return "missing"
        s, u = by[k]
        return "late" if t and t < s else "removed" if t and u and t >= u else None

    expected = sorted(("ref", i, t and t.strftime("%Y-%m"), judge(k, t)) for i, k, t in refs if k is not None and judge(k, t))
    for bits, shared in ((64, 0), (1 << 26, 0), (1 << 26, 1000)):
        got = find_orphans([Reference("ref", r, F.col("id"), F.col("k"), F.col("t"))], p, "k", "since", "until", max_bits=bits, most_shared=shared)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    report = orphan_report(got).agg(F.sum("n_rows")).first()[0]
    assert report == len(expected)
    assert find_orphans([Reference("ref", r.limit(0), F.col("id"), F.col("k"), F.col("t"))], p, "k", "since").count() == 0
    assert find_orphans([Reference("ref", r, F.col("id"), F.col("k"), F.col("t"))], p.limit(0), "k", "since").where("kind <> 'missing'").count() == 0


def test_evidence_orphans_compare_canonical_keys(spark):
    url = "https://codeforge.example/o/r"
    links = spark.createDataFrame([("l1", "HTTPS://codeforge.example//o/r/", T0), ("l2", "https://codeforge.example/o/R", T0), ("l3", None, T0)], "id string, repo_url string, observed_at timestamp")
    snaps = spark.createDataFrame([("s1", url, T0 - timedelta(days=9)), ("s2", "junk", T0)], "id string, repo_url string, stars_fetched_at timestamp")
    records = spark.createDataFrame([("v1", "ABC", T0), ("v2", "abd", T0), ("v3", None, T0)], "id string, paper_id string, validated_at timestamp")
    registry = spark.createDataFrame([(url, T0 - timedelta(days=1), None)], "repo_url string, registered_at timestamp, removed_at timestamp")
    papers = spark.createDataFrame([("abc", T0)], "id string, first_seen_at timestamp")
    got = {(r.row_id, r.kind) for r in evidence_orphans(links, snaps, records, registry, papers).collect()}
    assert got == {("l2", "missing"), ("s1", "late"), ("s2", "missing"), ("v2", "missing")}


def test_salted_lookup_is_a_left_join(spark):
    rows = spark.createDataFrame([(str(k), "hot" if k % 3 else f"c{k % 50}") for k in range(3000)] + [("n", None)], "id string, k string")
    keys = spark.createDataFrame([("hot", 1), ("c3", 2), ("zz", 3)], "k string, v int")
    plain = rows.join(keys, "k", "left")
    for lot in (50, 300, 250_000):  # many salts, some, no hot key
        got = salted_lookup(rows, keys, "k", "id", rows_a_task=lot)
        assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, plain.select("id", "k", "v").collect()))
    assert hot_keys(rows, "k", 10, 300).count() == 1 and hot_keys(rows.limit(0), "k").count() == 0 and hot_keys(rows, "k").count() == 0


def test_history_in_lists_and_nulls(spark):
    """Attributes that are lists, and NULLs that change places, are told apart."""
    rows = [("a", 0, None, 5, ["x", None]), ("a", 1, 5, None, ["x", None]), ("a", 2, 5, None, [None, "x"]), ("a", 3, 5, None, [None, "x"])]
    df = spark.createDataFrame([(k, T0 + timedelta(minutes=t), p, q, v) for k, t, p, q, v in rows], "k string, t timestamp, p int, q int, v array<string>")
    got = change_history(df, "k", "t", ["p", "q", "v"]).orderBy("version").collect()
    assert [(r.p, r.q, r.v) for r in got] == [(None, 5, ["x", None]), (5, None, ["x", None]), (5, None, [None, "x"])]

