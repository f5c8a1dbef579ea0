"""Ranked search, hard negatives and exact copies against plain computations."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlake.llm import exact_dedup, hard_negatives, lexical

TEXTS = "doc_id long, text string, score int, rank string"
ITEMS = "item_id long, text string, doc_id int"


def texts_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], TEXTS)


def last(x):
    """Ascending, null last."""
    return x is None, x or 0


# ranked search


def terms(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        found = []
        for doc, c in counted:
            m = 100 - 75 + (75 * c.total() * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text))
            if s > 0:
                found.append((-s, last(doc), doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(found, key=lambda f: f[:2])[:k])]
    return sorted(out)


def search(spark, docs, items, **sizes):
    index = lexical.build(texts_frame(spark, docs))
    return sorted(tuple(r) for r in lexical.search(index, spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS), **sizes).collect())


def odd_documents():
    rng = random.Random(5)
    words = ["de", "la", "El", "ñu", "Straße", "x1", "été", "ПРИВЕТ", "zz"] + [f"w{k}" for k in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights=[30] * 9 + [1] * 60, k=rng.choice([1, 3, 3, 9, 40, 400])))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " .,-\x7f\t"), (None, "zz zz zz unique"), (7, "w1 w2 w3"), (7, "w1 w2 w3"), (203, "a\u0001b" + "é" * 50)]
    docs += [(300 + i, "same text for many w5 w6") for i in range(25)] + [(400, "w7 " * 30_000)]
    rng.shuffle(docs)
    return docs


ASKED = [(1, "de la W1 w2 zz zz"), (2, "same text w5"), (3, "nothing-known here"), (4, None), (5, ""), (6, "ПРИВЕТ été w7"), (1, "de la W1 w2 zz zz"), (8, "unique zz")]


def test_search_equals_brute_force(spark):
    docs = odd_documents()
    assert search(spark, docs, ASKED) == plain_search(docs, ASKED)


def test_strata_in_parts_and_items_in_blocks(spark, monkeypatch):
    """Limits of a size that split every stratum, hold few postings and send single items."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 4)
    docs = odd_documents()
    assert search(spark, docs, ASKED) == plain_search(docs, ASKED)
    counted = texts_frame(spark, docs).select("doc_id", "text").coalesce(1).mapInArrow(lexical._count_terms, lexical.COUNTED)
    batches = counted.withColumn("m", F.lit(3).cast("long")).select("m", "doc_id", "size", "terms", "tfs").toArrow().to_batches()
    monkeypatch.setattr(lexical, "ROW_POSTINGS", 50)
    rows = list(lexical._stratify(iter(batches)))
    assert len(rows) > 10 and sum(len(r.column("doc_ids")[0]) for r in rows) == counted.count()
    for r in rows:  # frequencies fall within a term, and every posting is where its offsets say
        at, group_at, tfs, n = (r.column(c)[0].values.to_pylist() for c in ("term_at", "group_at", "tfs", "counts"))
        for t, count in enumerate(n):
            assert tfs[at[t] : at[t + 1]] == sorted(set(tfs[at[t] : at[t + 1]]), reverse=True)
            assert group_at[at[t + 1]] - group_at[at[t]] == count


def test_bounds_leave_out_strata_but_no_document(spark, monkeypatch):
    docs, seen = odd_documents(), []
    index = lexical.build(texts_frame(spark, docs))
    rows = index.rows.toArrow().to_batches()
    weights = sorted(tuple(r) for r in lexical.weights(index, spark.createDataFrame([(2, "same text w5", 0)], ITEMS)).collect())
    add = lexical._Best.add
    monkeypatch.setattr(lexical._Best, "add", lambda self, *a: (seen.append(1), add(self, *a)))
    task = lexical._search([2], np.array([0, len(weights)]), np.arange(len(weights)), np.array([w[2] for w in weights]), [w[1] for w in weights], 10)
    out = next(task(iter(rows)))
    assert len(seen) < sum(b.num_rows for b in rows) / 2
    assert sorted(zip(out.column("doc_id").to_pylist(), out.column("score").to_pylist())) == sorted((d, s) for _, _, d, s in plain_search(docs, [(2, "same text w5")]))


def test_search_of_empty_tables(spark):
    assert search(spark, [], ASKED) == [] and search(spark, odd_documents(), []) == [] and search(spark, [(1, None), (2, "")], ASKED) == []


# hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, row string, score int, v int"


def plain_mine(rows, every=50, k=5, m=3):
    ok = [(n, i, [math.floor(256 * x) for x in v], y) for n, (i, v, y) in enumerate(rows) if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v, y in ok:
        if i is None or i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), last(j), o, j, z) for o, j, w, z in ok if o != n and len(w) == len(v)), key=lambda s: s[:3])
        for p in [s for s in scored if s[4] == y][:k]:
            inside = [s for s in scored if s[4] != y and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]]
            out += [(i, p[3], r + 1, s[3], -p[0], -s[0]) for r, s in enumerate(inside[:m])]
    return sorted(out, key=lambda r: tuple(map(last, r)))


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, y, "r", 1, 2) for i, v, y in rows], VECTORS).coalesce(1)
    return sorted((tuple(r) for r in hard_negatives.mine(frame, **options).collect()), key=lambda r: tuple(map(last, r)))


def test_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=5) + (i % 3), 2)], i % 4) for i in range(400)]
    rows += [(500 + i, [1.5, 1.0, 0.5, 0.0, 2.0], i % 2) for i in range(60)] + rows[:60]  # ties, repeated rows
    rows += [(600, None, 1), (650, [1.0, None, 1.0, 1.0, 1.0], 1), (700, [math.inf] * 5, 1), (750, [math.nan] * 5, 1), (800, [1.0] * 5, None),
             (None, [1.0] * 5, 1), (850, [0.0] * 5, 2), (900, [], 1), (901, [], 1), (902, [], 2), (950, [1.0, 2.0], 1), (951, [2.0, 1.0], 1), (952, [2.0, 0.5], 3)]
    want = plain_mine(rows)
    assert len(want) > 100 and mined(spark, rows) == want


def test_many_stripes_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=4)], i % 3) for i in range(300)]
    monkeypatch.setattr(hard_negatives, "STRIPE_VALUES", 100)
    monkeypatch.setattr(hard_negatives, "BLOCK", 64)
    assert mined(spark, rows, every=20) == plain_mine(rows, every=20)


def test_large_scores_come_back_exactly():
    rng = np.random.default_rng(10)
    for top, dims in ((300, 64), (20_000_000, 100), (9_000_000, 1100)):
        a, b = rng.integers(-top, top + 1, (20, dims)), rng.integers(-top, top + 1, (30, dims))
        a[0], b[0], b[1] = top, top, -top
        primes = hard_negatives.primes_for(dims * top * top)
        got = hard_negatives.scores(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
        assert got.tolist() == [[sum(x * y for x, y in zip(r, s)) for s in b.tolist()] for r in a.tolist()]
    assert len(hard_negatives.primes_for(64 * 256 * 256)) == 4 and len(hard_negatives.primes_for(hard_negatives.MOST_SCORE)) == 8


def test_components_out_of_range_and_no_rows(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 2.0], 0), (2, [8e4, 2.0], 1), (50, [-1e300, 0.0], 1)]
    assert {r[3] for r in mined(spark, rows)} <= {0, 1, 2, 50}
    assert mined(spark, []) == [] and mined(spark, [(0, [1.0], 1)]) == []


# exact copies


def plain_copies(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for text in set(texts):
        ids = sorted((i for (i, _), t in zip(rows, texts) if t == text), key=last)
        out += [(i, ids[0], len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(out, key=lambda r: tuple(map(last, r[:2])) + (not r[3], r[4]))


def copies(spark, rows, parts=4, **options):
    found = exact_dedup.find_copies(texts_frame(spark, rows).repartition(parts), **options).collect()
    return sorted((tuple(r) for r in found), key=lambda r: tuple(map(last, r[:2])) + (not r[3], r[4]))


ODD = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (4, " a b"), (1, None), (2, ""), (6, " \n "), (7, " "), (8, "A b"), (None, "a b"), (None, "only nameless"),
       (None, "only nameless"), (5, "a b"), (3, "a b"), (10, "x" * 300_000), (11, "x" * 300_000), (12, "x" * 299_999 + "y"), (13, "a b"), (14, "é \r\n ü"), (15, "é ü")]


@pytest.mark.parametrize("budget", [exact_dedup.BUDGET, 2_000])
def test_copies_equal_brute_force_with_and_without_spilling(spark, budget):
    rng = random.Random(2)
    rows = ODD + [(100 + i, f"text {rng.randrange(150)} " + "filler " * rng.randrange(4)) for i in range(600)] + [(1000 + i, "hot  text") for i in range(400)]
    assert copies(spark, rows, budget=budget) == plain_copies(rows)


def test_local_tables_leave_in_stretches(spark, monkeypatch):
    rows = [(i, f"t {i % 7}") for i in range(200)]
    batches = texts_frame(spark, rows).select("doc_id", "text").coalesce(1).toArrow().to_batches()
    monkeypatch.setattr(exact_dedup, "LOCAL_ROWS", 30)
    out = [r for b in exact_dedup._merge_locally(iter(batches)) for r in b.to_pylist()]
    assert len(out) == 7 * 7 and sorted(i for r in out for i in r["ids"]) == list(range(200))


def test_a_full_table_still_absorbs_its_own(spark):
    """Whatever meets a full table and is not in it is spilled, with all its copies."""
    table = exact_dedup.ContentTable()
    contents = [f"content {i}".encode() for i in range(5_000)]
    for c in contents:
        assert table.find(hashlib.sha256(c).digest(), c) == -1
        table.add(hashlib.sha256(c).digest(), c)
    assert [table.find(hashlib.sha256(c).digest(), c) for c in contents] == list(range(5_000))
    # equal digests are no proof: contents are compared
    table.add(b"\0" * 32, b"one")
    assert table.find(b"\0" * 32, b"two") == -1 and table.find(b"\0" * 32, b"one") == 5_000


def test_no_documents(spark):
    assert copies(spark, []) == []
