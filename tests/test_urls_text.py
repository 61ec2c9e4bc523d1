import random
from datetime import datetime, timezone
from urllib.parse import urlparse

from pyspark.sql import functions as F

from ledgerline.functions.text import collapse_space, content_hash, feed_id, feed_time, iso_text
from ledgerline.functions.urls import RESERVED_OWNERS, owner_and_repo, repo_url


def by_parser(u):
    try:
        p = urlparse(u.strip())
    except ValueError:
        return None
    if p.netloc.lower() not in ("github.com", "www.github.com"):
        return None
    parts = [q for q in p.path.split("/") if q]
    if len(parts) < 2 or parts[0].lower() in RESERVED_OWNERS:
        return None
    repo = parts[1].removesuffix(".git")
    return f"https://github.com/{parts[0]}/{repo}" if repo else None


def test_repo_url_agrees_with_a_parser(spark):
    rng = random.Random(11)
    schemes = ["https:", "http:", "", "HTTP:", "ftp:", "git+ssh:", "mailto:"]
    hosts = ["github.com", "www.github.com", "GitHub.com", "github.com:443", "u@github.com", "x.com"]
    parts = ["a", "Bc", ".git", "r.git", "r.git.git", "r;x", ";x", "topics", "Orgs", "", "a b", "r.git;z", " ", "é", "r?q", "#f", "tree", "\t", "r ", "\xa0"]
    urls = sorted({rng.choice(["", " ", "\n", "\xa0"]) + rng.choice(schemes) + rng.choice(["//", "//", "/"]) + rng.choice(hosts) + "/" + "/".join(rng.choice(parts) for _ in range(rng.randint(0, 4))) + rng.choice(["", "/", "?a=b", "#x", " "]) for _ in range(4000)})
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(repo_url(F.col("u"))).collect()]
    assert [(u, g) for u, g in zip(urls, got) if g != by_parser(u)] == []
    assert sum(g is not None for g in got) > 200
    assert spark.createDataFrame([(None,)], "u string").select(repo_url(F.col("u"))).first()[0] is None


def test_lookup_and_ids(spark):
    df = spark.createDataFrame([("see github.com/a/b.git",), ("http://h/abs/2508.01234v2",), ("x/abs/solv-int/9901001v1",), (None,)], "u string")
    owner, repo = owner_and_repo(F.col("u"))
    rows = df.select(owner, repo, feed_id(F.col("u")), feed_id(F.col("u"), stop_at_v=False)).collect()
    assert tuple(rows[0])[:2] == ("a", "b")
    assert rows[1][2] == "2508.01234" and rows[2][2] == "sol" and rows[2][3] == "solv-int/9901001"
    assert tuple(rows[3]) == (None,) * 4


def test_text_and_time(spark):
    df = spark.createDataFrame([("  a\x1c\xa0 b\n",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(collapse_space(F.col("t"))).collect()] == ["a b", "", None]
    assert df.where("t = ''").select(content_hash(F.col("t"))).first()[0].startswith("e3b0c442")
    times = spark.createDataFrame([("2025-01-02T03:04:05Z",), ("2025-01-02",), (None,)], "t string").select(feed_time(F.col("t")).alias("x")).select("x", iso_text(F.col("x"))).collect()
    assert times[0][1] == "2025-01-02T03:04:05+00:00" and times[1][0] is None and times[2][0] is None
    fraction = spark.sql("SELECT timestamp_micros(1) AS x").select(iso_text(F.col("x"))).first()[0]
    assert fraction == datetime.fromtimestamp(1e-6, timezone.utc).isoformat()
