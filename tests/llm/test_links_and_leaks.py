import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from fieldlake.llm import components, decontaminate, ngram_join, queries, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain_components(texts):
    """Per document (id, set size, smallest id reachable), by comparing all that share a shingle."""
    sets = [(i, plain_set(t)) for i, t in texts]
    above, near = list(range(len(sets))), defaultdict(list)

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b, n in Counter(b for g in s for b in near[g]).items():
            if 100 * n >= 80 * (len(s) + len(sets[b][1]) - n):
                above[max(top(a), top(b))] = min(top(a), top(b))
        for g in s:
            near[g].append(a)
    least = {}
    for a, (i, _) in enumerate(sets):
        least[top(a)] = min(least.get(top(a), i), i)
    return sorted((i, len(s), least[top(a)]) for a, (i, s) in enumerate(sets))


def prose(seed, n):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 400, n))


def edited(text, seed, edits):
    w, rng = text.split(), np.random.default_rng(seed)
    for at in rng.integers(0, len(w), edits):
        w[at] = f"e{seed}"
    return " ".join(w)


def test_sets_equal_plain_ones():
    texts = [None, "", " \t\n", "A", "a b c d", "a b c d e", "a b c d E f", "É é x y z É é x y z", "w " * 300_000, "x y z  q\x0br\x0cs"] + [prose(i, 50) for i in range(20)]
    assert [len(s) for s in shingles.sets(pa.array(texts, pa.string()))] == [len(plain_set(t)) for t in texts]
    same = shingles.sets(pa.array(["A B c d e", "a b\nc  d\te ", "a b", "a b c d", "ab"]))
    assert same[0].tolist() == same[1].tolist() and len({s.tobytes() for s in same}) == 4


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=25), min_size=1, max_size=12), st.integers(0, 10))
def test_tree_join_equals_all_pairs(sets, cut):
    arrays = [np.sort(np.array(list(s), np.uint64) << np.uint64(50)) for s in sets]
    levels = np.random.default_rng(0).integers(0, 3, 1 << ngram_join.BITS).astype(np.uint8)
    similar = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if similar(sets[i], sets[j])}
    assert {tuple(sorted(p)) for p in ngram_join.join(arrays, None, levels, True)} == want
    forest = ngram_join.join(arrays, None, levels, False)
    assert len(forest) < len(sets) and {tuple(sorted(p)) for p in forest} <= want
    n = min(cut, len(sets) - 1)
    if 0 < n:
        cross = {(i, j) for i in range(n) for j in range(len(sets) - n) if similar(sets[i], sets[n + j])}
        assert set(ngram_join.join(arrays[:n], arrays[n:], levels, True)) == cross


def test_components(spark):
    path = [(i, i + 1) for i in range(60)]
    edges = spark.createDataFrame([*path, *[(100, x) for x in range(101, 160)], (200, 200), (301, 300), (301, 300)], "a long, b long")
    got = {r.node: r.label for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert components.components(edges.limit(0)).count() == 0


def test_join_equals_brute_force(spark, docs_of, monkeypatch):
    base, hub = prose(1, 200), prose(2, 80)
    texts = [None, "", "   ", "short", "SHORT", "a b c d", base, base, base.upper(), base + " more"]
    texts += [edited(base, 100 + i, 1 + i % 4) for i in range(40)] + [hub + " " + prose(300 + i, 15 + 8 * i) for i in range(25)] + [prose(400 + i, 60) for i in range(15)]
    texts += [prose(9, 30) + " " + prose(500, 5 + i) for i in range(10)]
    pairs = [(7 * i % 131, t) for i, t in enumerate(texts)]
    want = plain_components(pairs)
    docs = docs_of(pairs).withColumn("node", F.lit("clash")).withColumn("label", F.lit(1)).repartition(3)
    assert sorted(map(tuple, ngram_join.join_documents(docs).collect())) == want
    monkeypatch.setattr(ngram_join, "PART", 700)  # blocks in several parts
    assert sorted(map(tuple, ngram_join.join_documents(docs).collect())) == want


def test_join_of_contained_documents_with_two_frequency_levels(spark, docs_of):
    """Each family: a text of 80 frequent shingles, 38 of one level and 42 of the next, and the same with 20 own ones: 0.8."""
    texts = []
    for f in range(6):
        words = [f"f{f}x{i}" for i in range(84)]
        own = lambda k, n=120, f=f: " ".join(f"f{f}o{k}x{i}" for i in range(n))
        texts += [" ".join(words), " ".join(words) + " " + own(0, 20)]
        texts += [" ".join(words) + " " + own(1 + k) for k in range(16)] + [" ".join(words[38:]) + " " + own(100 + k) for k in range(60)]
    pairs = list(enumerate(texts))
    want = plain_components(pairs)
    assert sum(i != c for i, _, c in want) == 6
    assert sorted(map(tuple, ngram_join.join_documents(docs_of(pairs).coalesce(1)).collect())) == want


def test_join_of_repeated_and_nameless_rows(spark, docs_of):
    text = prose(3, 40)
    rows = [(4, text), (4, text), (None, text), (2, text + " more"), (9, "other words"), (9, "two texts of one id"), (9, "two texts of one id"), (5, None)]
    got = sorted(ngram_join.join_documents(docs_of(rows)).collect(), key=str)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(2, 2), (4, 2), (4, 2), (5, 5), (9, 9), (9, 9), (9, 9)]
    assert [r.component_id for r in got if r.doc_id is None] == [2]
    kept = ngram_join.representatives(docs_of(rows)).collect()
    assert sorted(r.doc_id for r in kept) == [2, 5, 9, 9]  # two texts of one id
    assert ngram_join.join_documents(docs_of([])).count() == 0


def test_all_links_between_classes(spark, docs_of):
    texts = [prose(3, 100)] + [edited(prose(3, 100), i, 1) for i in range(6)] + [prose(8, 60), None]
    named, links = ngram_join.linked(docs_of(texts), every=True)
    by = {r.node: r.doc_id for r in named.collect()}
    sets = list(map(plain_set, texts))
    want = {(i, j) for i in range(8) for j in range(i + 1, 8) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert {tuple(sorted((by[r.a], by[r.b]))) for r in links.collect()} == want


def test_join_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op10_ngram_jaccard(spark, small).collect())) == plain_components(sorted(map(tuple, docs)))


def test_representatives_go_by_row(spark, docs_of):
    a, b, c, d = (prose(600 + i, 40) for i in range(4))
    rows = [(1, a), (None, a), (None, b), (None, b), (None, c), (None, ""), (7, a), (7, d), (7, d), (7, None)]
    kept = ngram_join.representatives(docs_of(rows)).collect()
    want = [(1, a), (None, b), (None, c), (None, ""), (7, d), (7, None)]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(want, key=str)


def test_leaking_rows_go_by_their_text(spark, docs_of):
    items = spark.createDataFrame([(1, prose(610, 30))], "item_id long, text string")
    leak, clean = "x " + prose(610, 30) + " y", prose(611, 50)
    kept = decontaminate.without_leaks(docs_of([(None, leak), (None, clean), (None, None), (3, leak), (3, clean), (4, leak)]), items).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(None, clean), (None, None), (3, clean)], key=str)


def plain_leaks(docs, items, least=0.8):
    """All (doc, item) of which an item-sized window reaches the similarity, by trying every window."""
    out = {}
    for i, text in docs:
        words = WORD.findall((text or "").lower())
        for k, item in items:
            own = WORD.findall((item or "").lower())
            n, size = len(own), min(5, len(own))
            grams = lambda w, s=size: Counter(tuple(w[a : a + s]) for a in range(len(w) - s + 1))
            want = grams(own)
            for at in range(max(1, len(words) - n + 1)) if n else ():  # a shorter document is one window
                got = grams(words[at : at + n])
                same, every = sum((got & want).values()), sum((got | want).values())
                if same >= least * every - 1e-12:
                    out[i, k] = max(out.get((i, k), (0, 0)), (same / every, -at))
    return {(i, k): (round(s, 9), -at) for (i, k), (s, at) in out.items()}


def test_leaks_equal_brute_force(spark, docs_of):
    items = [(0, prose(21, 40)), (1, prose(22, 18)), (2, prose(23, 33)), (3, "three little words"), (4, ""), (5, None), (6, "a b a b a b a b a b a b"), (7, prose(21, 40)), (7, prose(21, 40))]
    texts = [None, "", prose(50, 300), items[0][1], prose(51, 90) + " " + items[0][1].upper() + "\n" + prose(52, 70), items[1][1] + " " + items[1][1], prose(53, 30) + " " + edited(items[2][1], 5, 1) + " end",
             "say Three little  WORDS now", "three little", "x a b a b a b a b a b a b y", prose(54, 20) + " " + items[0][1][: len(items[0][1]) // 2], edited(items[0][1], 9, 12), prose(55, 4000) + " " + items[2][1]]
    docs = [(i, t) for i, t in enumerate(texts)] + [(12, texts[12])]
    frame = docs_of(docs).withColumn("all", F.lit(1)).withColumn("item_id", F.lit(2)).withColumn("key", F.lit(3))
    rows = decontaminate.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in rows}
    assert len(rows) == len(got) and got == plain_leaks(docs, items)
    kept = decontaminate.without_leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in docs} - {i for i, _ in got}) and kept.columns == frame.columns


def test_edited_passages_equal_brute_force(spark, docs_of):
    """One word of fifty changed: similarity 0.804, where a narrow radius misses one passage in a hundred."""
    items = [(k, " ".join(f"i{k}w{i}" for i in range(50))) for k in range(6)]
    docs = []
    for k, text in items:
        for e in range(100):
            words = text.split()
            words[5 + e % 40] = f"edit{k}x{e}"
            docs.append((100 * k + e, " ".join(words)))
    rows = decontaminate.leaks(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in rows} == plain_leaks(docs, items)


def test_documents_shorter_than_an_item(spark, docs_of):
    """Documents that are 75 to 100 % of an item, from either end, alone and with words of their own."""
    items = [(0, prose(71, 100)), (1, prose(72, 99)), (2, prose(73, 14)), (3, "a b c d e"), (4, "a b c d")]
    docs = []
    for _, text in items[:3]:
        w = text.split()
        for n in range(3 * len(w) // 4, len(w) + 1):
            for own in ([], ["own"], ["own", "words", "here"]):
                docs += [own + w[:n], w[-n:] + own, own + w[-n:]]
    docs += [w.split() for w in ("a b c d", "a b c", "a b c d e f", "b c d e")]
    pairs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    rows = decontaminate.leaks(docs_of(pairs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain_leaks(pairs, items)
    assert {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in rows} == want
    short = {(i, k) for i, k in want if k < 3 and len(docs[i]) < len(items[k][1].split())}
    assert len(short) > 100 and all(r.n_words == min(len(docs[r.doc_id]), len(items[r.item_id][1].split())) for r in rows)


def test_windows_between_hits_equal_brute_force(spark, docs_of):
    """Repeated and overlapping passages: each start with enough shingles is a window, each once."""
    item = prose(81, 30).split()
    rng = np.random.default_rng(8)
    docs = []
    for i in range(40):
        w = [x for _ in range(4) for x in [*item[rng.integers(0, 4) : rng.integers(26, 31)], *[f"n{i}x{j}" for j in range(rng.integers(0, 5))]]]
        docs.append((i, " ".join(w)))
    items = [(0, " ".join(item)), (1, " ".join(item[:20])), (2, " ".join(item + item[:9]))]
    rows = decontaminate.leaks(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain_leaks(docs, items)
    assert want and {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in rows} == want


def test_no_items_or_documents(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs_of(["a b c d e f"]), none).count() == 0
    assert decontaminate.leaks(docs_of([]), spark.createDataFrame([(1, "a b c d e f")], none.schema)).count() == 0


def test_index_misses_nothing_within_the_radius():
    rng = np.random.default_rng(7)
    near = set(decontaminate.near_values(15))
    for _ in range(500):
        a = rng.integers(0, 1 << 16, 4)
        flips = rng.choice(64, rng.integers(0, 16), replace=False)
        b = a.copy()
        for f in flips:
            b[f // 16] ^= 1 << (f % 16)
        assert any(int(x ^ y) in near for x, y in zip(a, b, strict=True))


def test_both_sides_of_the_index_meet_within_the_radius(spark):
    """256-bit prints with up to 63 bits changed: an item's and a window's listings share a block value; sizes are fixed."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(60):
        a = rng.integers(0, 1 << 16, 16)
        b = a.copy()
        for f in rng.choice(256, rng.integers(40, 64), replace=False):
            b[f // 16] ^= 1 << (f % 16)
        rows.append((i, a.tolist(), b.tolist()))
    frame = spark.createDataFrame(rows, "key long, a array<int>, b array<int>")
    side = lambda c, n: decontaminate.listed_under(frame.select("key", F.col(c).alias("print")), ["key"], n)
    items, windows = side("a", 2), side("b", 1)
    assert items.count() == 60 * 16 * 137 and windows.count() == 60 * 16 * 17
    assert items.join(windows, ["key", "block", "value"]).select("key").distinct().count() == 60


def test_long_fingerprints(spark):
    frame = spark.createDataFrame([(1, [5, -7, 99]), (2, [5, -7, 99]), (3, [8])], "key long, w array<long>")
    got = {r.key: r["print"] for r in decontaminate.fingerprints(frame, ["key"], decontaminate.PARTS).collect()}
    short = {r.key: r["print"] for r in decontaminate.fingerprints(frame, ["key"]).collect()}
    assert got[1] == got[2] != got[3] and all(len(got[k]) == 16 and got[k][:4] == short[k] for k in got)
    assert len({tuple(got[3][i : i + 4]) for i in range(0, 16, 4)}) == 4


def test_fingerprints(spark):
    lists = {1: [5, -7, 123456789012345], 2: [-1], 3: list(range(-50, 50))}
    frame = spark.createDataFrame(list(lists.items()), "key long, w array<long>")
    for r in decontaminate.fingerprints(frame, ["key"]).collect():
        bits = [2 * sum((h >> b) & 1 for h in lists[r.key]) > len(lists[r.key]) for b in range(64)]
        assert r["print"] == [sum(bits[16 * k + b] << b for b in range(16)) for k in range(4)]


def test_leak_query(spark, small):
    docs = sorted(map(tuple, spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()))
    items = list(map(tuple, spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()))
    inside = lambda t, i: " ".join(WORD.findall(i.lower())) in " ".join(WORD.findall(t.lower()))
    got = {(r.doc_id, r.item_id) for r in queries.op9_simhash_leaks(spark, small).collect()}
    assert got >= {(d, k) for d, t in docs for k, i in items if inside(t, i)} and len(got) < 30


def test_pipeline(spark, small):
    out = corpus_pipeline.run(spark, small).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    kept = {r.doc_id for r in out}
    assert len(kept) > 0.8 * len(docs)
    rejected = {r.doc_id for r in queries.op7_ordinal_toxicity(spark, small).collect() if r.rejected}
    leaking = {r.doc_id for r in queries.op9_simhash_leaks(spark, small).collect()}
    assert rejected and not kept & rejected and not kept & leaking
    clean = plain_components([(i, t) for i, t in sorted(docs.items()) if i not in rejected])
    assert kept == {i for i, _, c in clean if i == c} - leaking
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null, repeated and missing ids, texts without words, no labels, extra columns, then no documents at all."""
    item, a, b = prose(90, 40), prose(91, 60), prose(92, 60)
    rows = [(1, a), (2, a + " more"), (None, b), (None, item + " tail"), (3, prose(93, 30)), (3, prose(94, 30)), (4, None), (5, ""), (6, "short"), (7, item[: 9 * len(item) // 10])]
    docs = spark.createDataFrame([(*r, "web", i) for i, r in enumerate(rows)], "doc_id long, text string, source string, node int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame([(1, item)], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/some/{name}.parquet")
        (df.limit(0) if name == "documents" else df).write.parquet(f"{tmp_path}/none/{name}.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert Counter(r.doc_id for r in out) == Counter([1, None, 3, 3, 4, 5, 6])
    at = 0
    for r in sorted(out, key=lambda r: (r.start, r.n_tokens)):
        assert r.start == at
        at += r.n_tokens
    assert sum(r.n_tokens == 1 for r in out) == 2  # without text: the end id alone
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
