"""Rules looked up by digest, shipped or dealt by ranges, against comparing every rule."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import url_filter
from weftline.llm.settings import URL_RULES


def brute(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([len(rest), *[rest.find(c) for c in "/?#" if c in rest]])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([len(path), *[path.find(c) for c in "?#" if c in path]])]
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len((h + p).encode()), len(h.encode()), v == "block")
            if best is None or rank > best[0]:
                best = (rank, h + p, v)
    return host, path, best and best[1], best[2] if best else "allow"


def pages():
    rng = random.Random(1)
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.NET/en/x", "https://a.b.example.net/EN/", "x://net", "x://net/", "x://.net/a"]
    urls += ["http://é.net/ü/é?q=1", "http://org/fr/#x", "http://www.org?/fr/", "a://b://net/", "http://user@net:80/", "http://notexample.com/de/"]
    for _ in range(300):
        host = ".".join(rng.choices(["net", "example", "com", "org", "a", "B", "é"], k=rng.randint(1, 4)))
        path = "".join(rng.choices(["/", "en", "de/", "/fr/", "?", "#", "x", "é"], k=rng.randrange(5)))
        urls.append(f"http://{host}{path}")
    return [*urls, urls[30], urls[30]]


MORE = [*URL_RULES, ("a.net", "/", "allow"), ("net", "/", "allow"), ("é.net", "/ü", "block"), ("com", "", "block"), ("example.com", "/é", "allow")]


@pytest.mark.parametrize("rules", [URL_RULES, MORE, []])
@pytest.mark.parametrize("bounds", [{}, {"max_rules": -1}, {"max_rules": -1, "range_bytes": 40}])
def test_against_every_rule(spark, rules, bounds):
    """By the shipped file, and beyond its bound by one and by many ranges of digests."""
    rows = [(i, u, "x") for i, u in enumerate(pages())]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    listed = spark.createDataFrame([*rules, (None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = url_filter.judge_urls(df, listed, **bounds).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["page"]["url"], rules), r


def test_digests_are_those_of_spark(spark):
    keys = ["", "a", "net\x00/", "é" * 40, "x" * 1000]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(F.xxhash64("k").alias("h")).collect()
    assert [r["h"] % (1 << 64) for r in df] == [
        url_filter.xxhash.xxh64_intdigest(k.encode(), url_filter.DIGEST_SEED) for k in keys
    ]


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda key, seed: 7)
    file = tmp_path / "digests"
    file.write_bytes(url_filter._merged([("a", "/", True), ("b", "/", False), ("c", "/", True)]))
    array = url_filter.DigestArray(np.memmap(file, dtype="u1", mode="r"))
    assert array.probe([b"b\x00/", b"c\x00/", b"d\x00/", b"a\x00/"]) == [0, 1, None, 1]


def test_empty_pages(spark):
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge_urls(none, listed, max_rules=-1).count() == 0
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id bigint, url string"), listed).count() == 0
