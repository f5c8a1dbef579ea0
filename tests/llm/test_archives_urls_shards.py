import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldlake.llm import queries, sharding, url_filter, warc

PAGES = "page_id long, url string, html string, n int"
BIG = "x" * 1200
ROWS = [(1, "http://a/", BIG, 0), (5, "http://b/", BIG, 0), (3, None, BIG, 0), (2, "http://c/\r\nX: y", None, 0), (4, "http://d/", "", 0), (6, "http://e/", "short", 0),
        (7, "http://f/", "short", 0), (8, "http://g/", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40, 0), (9, "http://h/", BIG + "y", 0), (9, "http://h/", BIG + "y", 0)]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, PAGES).withColumn("kept", F.lit(1)).withColumn("sha1", F.lit("z"))
    warc.write(pages, f"{tmp_path}/w", rows_per_file=3)
    records = warc.read(spark, f"{tmp_path}/w")
    whole = warc.captures(records).collect()
    assert len(whole) == len(ROWS) and all(len(r.requests) == 1 and len(r.metadata) == 1 for r in whole)
    assert warc.orphans(records).count() == 0
    page = {r.capture_id: int(r.metadata[0].fields[0].value) for r in whole}
    html = {i: (h or "").encode() for i, _, h, _ in ROWS}
    for r in whole:
        i, of = page[r.capture_id], r.response
        assert of.payload_bytes == len(html[i]) and of.payload_digest == hashlib.sha1(html[i]).hexdigest()
        if i in (1, 3):
            assert of.type == "revisit" and page[of.refers_to] == 5 and of.payload is None
        else:
            assert of.type == "response" and bytes(of.payload) == html[i]


def test_no_pages(spark, tmp_path):
    warc.write(spark.createDataFrame([], PAGES), f"{tmp_path}/w")
    assert warc.captures(warc.read(spark, f"{tmp_path}/w")).count() == 0


def test_records_meet_over_files_and_hops(spark):
    row = lambda i, kind, to: (i, kind, to, None, "u", "d", 1, "x", {"k": i}, None)
    records = spark.createDataFrame([
        row("r1", "response", []), row("q1", "request", ["r1"]), row("m1", "metadata", ["q1"]), row("m2", "metadata", ["r1"]), row("m2", "metadata", ["r1"]),
        row("r2", "response", []), row("q9", "request", ["gone"])], warc.RECORD)
    got = {r.capture_id: ([x.record_id for x in r.requests], [x.record_id for x in r.metadata]) for r in warc.captures(records).collect()}
    assert got == {"r1": (["q1"], ["m1", "m2"]), "r2": ([], [])}
    assert [r.record_id for r in warc.orphans(records).collect()] == ["q9"]


def test_damaged_archives_are_errors():
    good = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nk:v\r\n\r\n"
    assert len(list(warc.parse(good * 2, True))) == 2
    for bad in (good[:-3], b"junk" + good, good.replace(b"h: 3", b"h: 9")):
        with pytest.raises(ValueError):
            list(warc.parse(bad, True))


URLS = ["http://A.Example.NET/en/x?q#f", "https://example.net/en", "http://net/", "http://xnet/", "ftp://a.org/fr/1", "http://org/de/", "http://m.example.com/de/1.html", "nothing", "", None,
        "://", "http://h?x/en/", "http://h#/fr/", "http://user@H:80/Path;p?x", "a://b://c/d", "http://é.Ñ.org/fr/", "http://x\n.net/a\nb?c", "http://example.net" + "/long" * 5000]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_filter.RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def test_url_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("_found", F.lit(1))
    got = url_filter.judge(pages, url_filter.RULES, ([0.0] * 64, -1.0)).collect()
    for r in got:
        host, path, best = plain(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0]), URLS[r.page_id]
        assert r.verdict == (best[1] if best else "allow")


def test_url_model_learns(spark):
    good = [(f"http://www.garden{i}.example/plants/rose-{i}", 0) for i in range(60)]
    bad = [(f"http://casino{i}.example/win/bonus-{i}", 1) for i in range(60)]
    train = spark.createDataFrame(good[:40] + bad[:40] + [(None, 1), ("http://x/", None)], "url string, label int")
    model = url_filter.train(train, buckets=512, steps=12)
    held = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(good[40:] + bad[40:])], "page_id long, url string, y int")
    got = {r.page_id: r.verdict for r in url_filter.judge(held, [], model).collect()}
    assert sum(got[r.page_id] == ("block" if r.y else "allow") for r in held.collect()) >= 38


def test_url_model_without_both_labels(spark):
    for rows in ([], [("http://a/", 1)] * 3):
        weights, bias = url_filter.train(spark.createDataFrame(rows, "url string, label int"), buckets=16)
        assert set(weights) == {0.0} and (bias > 0) == bool(rows)


def test_url_query(spark, small):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = queries.op5_url_logistic(spark, small).collect()
    assert Counter(r.page_id for r in rows) == Counter(pages.keys())
    for r in rows:
        host, path, best = plain(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0]) and r.verdict in ("allow", "block") and (not best or r.verdict == best[1])


def test_shards(spark, docs_of):
    texts = [None, "", "é", "a" * 50_000] + ["same"] * 300 + [(None, "x"), (3, "again"), (3, "again")]
    rows = sharding.place(docs_of(texts).withColumn("shard", F.lit(9)).withColumn("_part", F.lit(1)), 40).collect()
    assert len(rows) == len(texts)
    for shard in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    assert all(0 <= r.shard < 40 and r.grown_shard in (r.shard, 40) and r.law == "key" for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[0].size, by_id[0].text_crc32, by_id[2].size, by_id[2].text_crc32) == (16, 0, 18, zlib.crc32("é".encode()))
    assert sharding.place(docs_of([]), 40).count() == 0


def test_moves_stay_inside_changed_subtrees(spark):
    ids = spark.range(20_000).withColumn("k", F.xxhash64("id"))
    place = lambda leaves: sharding.shard_of(F.col("k"), leaves)
    heavier = sharding.tree(40, {7: 3.0})
    rows = ids.select(*[place(x).alias(n) for n, x in (("a", sharding.tree(40)), ("b", sharding.tree(41)), ("c", sharding.tree(42)), ("h", heavier))]).collect()
    assert {r.b for r in rows if r.b != r.a} == {40} and {r.c for r in rows if r.c != r.b} == {41}
    region = lambda s: s // 10
    assert all(region(r.h) == region(7) for r in rows if r.h != r.a)  # rows only move into the region that grew, or inside it
    sizes = Counter(r.a for r in rows)
    assert len(sizes) == 40 and max(sizes.values()) < 1.3 * 500 and min(sizes.values()) > 0.7 * 500
    assert 0.8 < Counter(r.h for r in rows)[7] / (20_000 * 3 / 42) < 1.2


def plain_shard(doc_id, leaves):
    """The three draws of a row, spelled out: per child the first eight bytes' hash of (key, level, child) as an arrival."""
    def hashed(*parts):
        seed = 42
        for value, size in parts:
            seed = xxhash.xxh64_intdigest(value.to_bytes(size, "little", signed=True), seed=seed)
        return seed

    key = hashed((doc_id, 8))
    key -= (key >> 63) << 64
    for level, name in enumerate(("region", "rack", "shard")):
        draws = []
        for node in {getattr(leaf, name) for leaf in leaves}:
            below = [leaf for leaf in leaves if getattr(leaf, name) == node]
            share = ((hashed((key, 8), (level, 4), (node, 4)) >> 11) + 0.5) / 2**53
            draws.append((-math.log(share) / sum(leaf.weight for leaf in below), node, below))
        leaves = min(draws, key=lambda d: d[:2])[2]
    return leaves[0].shard


def test_shards_equal_plain_draws(spark):
    leaves = sharding.tree(43, {3: 4.0, 17: 0.0, 20: 0.5, 41: 2.0})
    ids = [*range(-500, 2500), 2**62, -(2**63)]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", sharding.shard_of(F.xxhash64("doc_id"), leaves).alias("shard")).collect()
    assert {r.doc_id: r.shard for r in rows} == {i: plain_shard(i, leaves) for i in ids}


def test_shard_shares_follow_weights(spark):
    leaves = sharding.tree(42, {0: 5.0, 40: 3.0, 12: 0.0})
    n, total = 60_000, sum(leaf.weight for leaf in leaves)
    counted = dict(spark.range(n).select(sharding.shard_of(F.xxhash64("id"), leaves).alias("s")).groupBy("s").count().collect())
    for leaf in leaves:
        share = leaf.weight / total
        assert abs(counted[leaf.shard] - n * share) < 5 * math.sqrt(n * share)
    assert 12 not in counted and sum(counted.values()) == n


def plain_grams(host, path, buckets):
    out = set()
    for kind, value in ((b"h", host), (b"p", path)):
        marked = "\x02" + value + "\x03"
        for n in (3, 4):
            for i in range(len(marked) - n + 1):
                h = xxhash.xxh64_intdigest(marked[i : i + n].encode(), seed=xxhash.xxh64_intdigest(kind, seed=42))
                out.add((h - ((h >> 63) << 64)) % buckets)
    return sorted(out)


def test_url_weights_equal_plain_gradient_descent(spark):
    buckets, steps, rate, ridge = 97, 8, 4.0, 1e-3
    rows = [(f"http://{'ads' if i % 3 else 'news'}{i % 7}.example/{'pop' if i % 5 else 'article'}/é{i}", int(i % 3 > 0)) for i in range(60)]
    rows += [("http://a", 1), ("no mark", 0), ("http://b/?q=1", 0), (rows[0][0], rows[0][1])]
    got, got_bias = url_filter.train(spark.createDataFrame(rows + [(None, 1), ("http://x", None)], "url string, label int"), buckets=buckets, steps=steps, rate=rate, ridge=ridge)
    x, y = np.zeros((len(rows), buckets)), np.array([label for _, label in rows], float)
    for r, (url, _) in enumerate(rows):
        rest = url.partition("://")[2]
        host = re.split("[/?#]", rest)[0]
        own = plain_grams(host.lower(), re.split("[?#]", rest[len(host) :])[0], buckets)
        x[r, own] = 1 / math.sqrt(max(len(own), 1))
    w, bias = np.zeros(buckets), math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(bias + x @ w))) - y
        w, bias = w * (1 - rate * ridge) - rate * (x.T @ error) / len(y), bias - rate * error.sum() / len(y)
    assert np.abs(w).max() > 0.5 and np.allclose(got, w, atol=1e-9) and abs(got_bias - bias) < 1e-9
