import random

import numpy as np
import xxhash
from pyspark import SparkFiles

from clipwright.llm import urls
from clipwright.llm.urls import RULES, Index, digests, judge, layout, publish


def plain(url, rules, blocked=()):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        path = rest[n:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    return host, path, None, "block" if url is not None and url in blocked else "allow"


def check(spark, texts, rules, blocked=()):
    df = spark.createDataFrame([(i, u, 1, "x") for i, u in enumerate(texts)], "page_id long, url string, host int, rule string").repartition(3)
    listed = spark.createDataFrame([(u, 1) for u in blocked], "url string, page_id int") if blocked else None
    got = {r.page_id: tuple(r)[1:] for r in judge(df, rules=rules, blocked=listed).collect()}
    assert got == {i: plain(u, rules, blocked) for i, u in enumerate(texts)}


def test_matches_brute_force(spark):
    rnd = random.Random(6)
    bits = ["http://", "https://", "://", "net", "NET", "example.net", "example.com", "org", ".", "m.", "/", "/en/", "/de/", "/fr/", "/fr/x", "?", "#", "x", "É", "/en", "..", "\n"]
    texts = [None, "", "net/", "http://", "http://net", "http://net/", "http://a.NET/en/", "http://example.net/en/1", "http://xexample.net/en/1", "a://b://net/", "http://org/fr/?q#/", "http://example.com/de/é", "http://" + "a." * 20_000 + "net/x"]
    texts += ["".join(rnd.choices(bits, k=rnd.randint(1, 8))) for _ in range(1500)]
    check(spark, texts, RULES)
    more = (("com", "", "block"), ("example.com", "/", "allow"), ("e.com", "/d", "block"), ("a.e.com", "/", "allow"), ("", "", "block"))
    check(spark, [*texts, "http://a.e.com/d/", "http://e.com", "http://example.com"], more)
    check(spark, texts, RULES[:1], blocked=(None, *(t for t in texts[20:300] if t), *(t for t in texts[20:30] if t)))
    check(spark, texts[:40], (), blocked=texts[5:9])
    check(spark, texts[:40], ())


def test_colliding_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "digests", lambda keys: np.fromiter((xxhash.xxh64_intdigest(k) % 6 for k in keys), np.uint64, len(keys)))
    keys = [f"k{i}".encode() for i in range(200)]
    halves = [[i for i in range(100) if xxhash.xxh64_intdigest(keys[i]) % 6 // 3 == h] for h in (0, 1)]
    for h, own in enumerate(halves):
        (tmp_path / f"s{h}").write_bytes(layout(urls.digests([keys[i] for i in own]), [keys[i] for i in own], np.array(own)))
    index = Index(np.array([0, 3], np.uint64), ["s0", "s1"], lambda name: str(tmp_path / name))
    assert index.find(keys).tolist() == [*range(100), *[-1] * 100]
    assert digests([b"a"])[0] == xxhash.xxh64_intdigest(b"a")


def test_a_long_list_in_many_shards(spark):
    listed = spark.range(300_000).selectExpr("concat('http://h', id % 977, '.example.org/p/', id) as url")
    entries = listed.selectExpr("encode(url, 'utf-8') as key", "cast(1 as long) as value")
    firsts, names = publish(entries, 1 << 20)
    assert len(names) > 10 and sorted(firsts.tolist()) == firsts.tolist()
    found = Index(firsts, names, SparkFiles.get).find([f"http://h{i % 977}.example.org/p/{i}".encode() for i in range(0, 600_000, 7)])
    assert found.tolist() == [1 if i < 300_000 else -1 for i in range(0, 600_000, 7)]
    pages = spark.range(0, 600_000, 7).selectExpr("id as page_id", "concat('http://h', id % 977, '.example.org/p/', id) as url")
    got = judge(pages, blocked=listed).groupBy("verdict").count().collect()
    assert dict(map(tuple, got)) == {"block": len(range(0, 300_000, 7)), "allow": len(range(0, 600_000, 7)) - len(range(0, 300_000, 7))}


def test_empty(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
